"""Token ids of whole texts from a `tokenizers` file whose words never cross white space, as packed little-endian bytes.

A worker keeps the words it has encoded lately as packed arrays, until another operator's work drops them. A text holding one of the characters that Python splits at
and the tokenizer does not (U+001C to U+001F) is encoded in one piece. Nulls and empty texts give no ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import add_file, at_work, local_file, ship, slices

SLICE_CHARS = 8_000_000
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_ODD_BYTES = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")


# Letters of the plain way: Latin ones that are in composed form and have one small form of one character.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_WORD = re.compile(f"[{_LATIN}]+")
_LETTERS = frozenset(chr(c) for c in range(0x180) if _WORD.match(chr(c)))
# Signs that no rule of that pattern but the last one takes, and that no added token holds.
_ENDS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
# Fixed value: the pre-tokenizer's pattern for which the plain way holds.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_letters(path: str) -> bool:
    """Whether a tokenizer file lower-cases, cuts runs of letters from signs and then knows bytes only, so that Latin words can go to its model."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
    cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": _SPLIT} and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed"
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and made["model"]["type"] == "BPE" and not made["model"]["dropout"] and all("<" in t["content"] for t in made["added_tokens"])
    )


class CodedWords:
    """Encoded words, kept between batches and tasks of a worker as packed arrays and found by a hash join, so that words
    already known never become Python strings. Over `limit` bytes, those not seen for the longest time go, half of them or more.

    `encode` gets a list of distinct unknown words and returns their ids, as bytes, in the same order.
    """

    ENTRY = 28  # bytes of an entry besides its word and ids

    def __init__(self, encode: Callable[[list[str]], list[bytes]], dtype: np.dtype, limit: int = 24_000_000, chunk: int = 40_000):
        self._encode, self._limit, self._chunk = encode, limit, chunk
        self._words = pa.array([], pa.large_string())
        self._turn, self._seen = 0, np.zeros(0, np.int32)
        self.ids, self.starts, self.sizes = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def held(self) -> int:
        return self.ENTRY * len(self._words) + self._words.nbytes + self.ids.nbytes

    def find(self, words: pa.LargeStringArray) -> np.ndarray:
        """Where `starts` and `sizes` have the place in `ids` of each of these distinct words; good until the next call."""
        if self.held() > self._limit:
            self._keep(np.flatnonzero(self._seen > np.median(self._seen)))
            if self.held() > self._limit:
                self._keep(np.zeros(0, np.int64))
        found = pc.index_in(words, value_set=self._words)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        unknown = words.filter(found.is_null())
        at[at < 0] = len(self._words) + np.arange(len(unknown))
        coded: list[bytes] = []
        for start in range(0, len(unknown), self._chunk):
            coded += self._encode(unknown.slice(start, self._chunk).to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, coded), np.int64, len(unknown)) // self.ids.itemsize
        self._words = pa.concat_arrays([self._words, unknown])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), self.ids.dtype)])
        self._turn += 1
        self._seen = np.concatenate([self._seen, np.zeros(len(unknown), np.int32)])
        self._seen[at] = self._turn
        return at

    def _keep(self, at: np.ndarray) -> None:
        self.ids = self.laid_out(at)
        self._words, self._seen, self.sizes = self._words.take(pa.array(at)), self._seen[at], self.sizes[at]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def laid_out(self, at: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after the other."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(self.ids)) < 2**31 else np.int64
        places = np.repeat((self.starts[at] - (ends - sizes)).astype(kind), sizes)
        places += np.arange(total, dtype=kind)
        return self.ids[places]


class WordTokenizer:
    """Where the tokenizer file allows it (`splits_at_letters`), signs at a word's end are cut off after a letter, as the tokenizer does it,
    and words of Latin letters go straight to the model; all else goes through the whole tokenizer. The ids are the same.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(dtype)
        self.model = self.tokenizer.model if splits_at_letters(path) else None
        coded = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.small = {ord(c): coded.pre_tokenize_str(c.lower())[0][0] for c in _LETTERS}
        self.words = CodedWords(self._encode if self.model else self._encode_whole, self.dtype)

    def _encode_whole(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a in range(0, len(words), 4_000):
            found = self.tokenizer.encode_batch_fast(words[a : a + 4_000], add_special_tokens=False)
            out += [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]
        return out

    def _encode(self, words: list[str]) -> list[bytes]:
        """Arrow cuts the signs off and tells the plain words; the model sees each of these once, in small letters."""
        every = pa.array(words, pa.large_string())
        cores = pc.utf8_rtrim(every, _ENDS)
        plain = pc.match_substring_regex(cores, f"^[{_LATIN}]+$")
        known = pc.utf8_lower(cores.filter(plain)).dictionary_encode()
        tokenize, small = self.model.tokenize, self.small
        found: list[int] = []
        ends = [0]
        for core in known.dictionary.to_pylist():
            found += [t.id for t in tokenize(core if core.isascii() else core.translate(small))]
            ends.append(len(found))
        width = self.dtype.itemsize
        ids = np.array(found, dtype=self.dtype).tobytes()
        coded = [ids[a * width : b * width] for a, b in pairwise(ends)]
        out: list[bytes] = [b""] * len(words)
        at = np.flatnonzero(plain).tolist()
        for i, core in zip(at, known.indices.to_numpy().tolist(), strict=True):
            out[i] = coded[core]
        length = pc.utf8_length(cores)
        tails: dict[str, list[int]] = {}
        lengths = length.to_numpy()
        for i in np.flatnonzero(pc.and_(plain, pc.less(length, pc.utf8_length(every)))).tolist():
            tails.setdefault(words[i][lengths[i] :], []).append(i)
        for tail, found in zip(tails, self._encode_whole(list(tails)), strict=True):
            for i in tails[tail]:
                out[i] += found
        rest = np.flatnonzero(pc.invert(plain)).tolist()
        for i, found in zip(rest, self._encode_whole([words[i] for i in rest]), strict=True):
            out[i] = found
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a, b in slices(map(len, texts), SLICE_CHARS):
            out += self._encode_slice(texts[a:b])
        return out

    def _encode_slice(self, texts: list[str]) -> list[bytes]:
        """Each distinct word is looked up once; the words' ids are then laid out for all texts at once."""
        plain, odd = pa.array(texts, pa.large_string()), []
        written = plain.buffers()[2].to_pybytes()
        if any(c in written for c in _ODD_BYTES):
            odd = [i for i, text in enumerate(texts) if _ODD_SPACE.search(text)]
            plain = pa.array(["" if _ODD_SPACE.search(t) else t for t in texts], pa.large_string())
        pieces = pc.utf8_split_whitespace(plain)
        coded = pieces.flatten().dictionary_encode()
        at = self.words.find(coded.dictionary)[coded.indices.to_numpy()]
        ids = self.words.laid_out(at).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.words.sizes[at])])
        cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy())])] * self.dtype.itemsize
        out = [ids[a:b] for a, b in pairwise(cuts.tolist())]
        for i in odd:
            out[i] = self._encode_whole([texts[i]])[0]
        return out


@lru_cache(maxsize=1)
def word_tokenizer(name: str, dtype: str) -> WordTokenizer:
    at_work("tokens", word_tokenizer.cache_clear)
    return WordTokenizer(local_file(name), dtype)


def id_type(path: str) -> str:
    """The narrowest little-endian integer that holds every id of a tokenizer file and one number more, for filling."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() < 1 << 16 else "<u4"


def packed_ids(spark: SparkSession, path: str, dtype: str, closing_id: int | None = None):
    """A function Column -> Column: texts to packed ids, `closing_id` appended to each."""
    ship(spark)
    name = add_file(spark, path)
    closing = b"" if closing_id is None else np.array([closing_id], dtype=dtype).tobytes()

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = word_tokenizer(name, dtype)
        for batch in batches:
            yield pa.array([ids + closing for ids in tokenizer.encode([t or "" for t in batch.to_pylist()])], pa.binary())

    return encode.asNondeterministic()
