"""Byte-level BPE by recursive SQL: each Python worker runs DuckDB over the distinct words of its batch.

Encoding: a word's bytes are rows (word, position, token). Each step of a recursive query pairs a row with its right
neighbour, joins the pairs with the merge table, and contracts the leftmost pair of lowest rank of each word, until no
pair of the word is in the table. Decoding joins the token rows with the pieces and aggregates them in order.

Nulls and empty texts give an empty list and empty bytes. Texts are encoded whole, of any length; special tokens are
never made. Repeated texts are encoded alike. Columns beside the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import WordCache, add_file, local_file, ship, slices

# Words up to this many bytes take the plain recursion; longer ones contract all equal pairs of a step at once.
LONG_WORD = 128
SLICE_CHARS = 3_000_000
SLICE_TOKENS = 400_000

_STEP_ONE_PAIR = """
WITH RECURSIVE walk AS (
  SELECT word, pos, id, false AS done FROM start
  UNION ALL
  SELECT p.word, p.pos, CASE WHEN p.pos = l.pos THEN l.rank ELSE p.id END AS id, l.rank IS NULL AS done
  FROM (SELECT word, pos, id FROM walk WHERE NOT done) p
  LEFT JOIN (
    SELECT word, (low >> 40)::INT AS rank, ((low >> 20) & 1048575)::INT AS pos, (low & 1048575)::INT AS gone
    FROM (
      SELECT n.word, min((m.rank::BIGINT << 40) | (n.pos::BIGINT << 20) | n.next_pos) AS low
      FROM (
        SELECT word, pos, id, lead(id) OVER w AS next_id, lead(pos) OVER w AS next_pos, lead(word) OVER w AS next_word
        FROM walk WHERE NOT done WINDOW w AS (ORDER BY word, pos)
      ) n
      JOIN merges m ON m.first = n.id AND m.second = n.next_id
      WHERE n.next_word = n.word
      GROUP BY n.word
    )
  ) l ON l.word = p.word
  WHERE l.gone IS NULL OR p.pos <> l.gone
)
SELECT word, list(id ORDER BY pos) AS ids FROM walk WHERE done GROUP BY word ORDER BY word
"""

# Equal pairs of lowest rank are contracted together where that cannot change the outcome: no token of a lower rank
# begins or ends with the merged one, so no contraction can come between them. Overlapping pairs (a a a) are taken
# from the left, every second one. All other ranks contract their leftmost pair only.
_STEP_EQUAL_PAIRS = """
WITH RECURSIVE walk AS (
  SELECT word, pos, id, false AS done FROM start
  UNION ALL
  SELECT word, pos, id, done FROM (
    SELECT word, pos, CASE WHEN picked THEN rank ELSE id END AS id, low IS NULL AS done,
           lag(picked, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
    FROM (
      SELECT word, pos, id, rank, low,
             coalesce(hit AND (place - max(CASE WHEN hit AND NOT hit_before THEN place END)
               OVER (PARTITION BY word ORDER BY pos)) % 2 = 0, false) AS picked
      FROM (
        SELECT word, pos, id, rank, low, place, hit, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS hit_before
        FROM (
          SELECT r.word, r.pos, r.id, r.rank, r.place, l.low >> 32 AS low,
                 coalesce(r.rank = (l.low >> 32) AND (r.alone IS NULL OR r.pos = (l.low & 4294967295)), false) AS hit
          FROM (
            SELECT n.word, n.pos, n.id, n.place, m.rank, u.rank AS alone
            FROM (
              SELECT word, pos, id, lead(id) OVER w AS next_id, row_number() OVER w AS place
              FROM walk WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)
            ) n
            LEFT JOIN merges m ON m.first = n.id AND m.second = n.next_id
            LEFT JOIN one_by_one u ON u.rank = m.rank
          ) r
          LEFT JOIN (
            SELECT n.word, min((m.rank::BIGINT << 32) | n.pos) AS low
            FROM (
              SELECT word, pos, id, lead(id) OVER w AS next_id
              FROM walk WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)
            ) n
            JOIN merges m ON m.first = n.id AND m.second = n.next_id
            GROUP BY n.word
          ) l ON l.word = r.word
        )
      )
    )
  ) WHERE NOT gone
)
SELECT word, list(id ORDER BY pos) AS ids FROM walk WHERE done GROUP BY word ORDER BY word
"""

_DECODE = """
SELECT doc, array_to_string(list(piece ORDER BY pos), '') AS pieces
FROM tokens JOIN pieces USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """The tables of one rank file in a DuckDB of its own; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.words = WordCache(self._encode_words)
        merges = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        one_by_one = {
            inner
            for token, rank in ranks.items()
            for i in range(1, len(token))
            for inner in (ranks.get(token[:i], -1), ranks.get(token[i:], -1))
            if inner > rank
        }
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self._load("merges", {"first": [m[0] for m in merges], "second": [m[1] for m in merges], "rank": [m[2] for m in merges]})
        self._load("one_by_one", {"rank": sorted(one_by_one)})
        # A byte is written as the character 256 + byte, so that every piece is valid text, zero bytes included.
        pieces = ["".join(chr(256 + b) for b in token) for token in ranks]
        self.con.register("given", pa.table({"id": pa.array(ranks.values(), pa.int32()), "piece": pa.array(pieces, pa.string())}))
        self.con.execute("CREATE TABLE pieces AS SELECT * FROM given")

    def _load(self, name: str, columns: dict[str, list[int]]) -> None:
        self.con.register("given", pa.table({k: pa.array(v, pa.int32()) for k, v in columns.items()}))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")

    def _walk(self, sql: str, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        firsts = np.cumsum(lengths) - lengths
        start = pa.table({
            "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": (np.arange(lengths.sum()) - np.repeat(firsts, lengths)).astype(np.int32),
            "id": self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)],
        })
        self.con.register("start", start)
        ids = self.con.sql(sql).to_arrow_table()["ids"].combine_chunks()
        flat, ends = ids.values.to_numpy().astype(np.int32, copy=False).tobytes(), (ids.offsets.to_numpy() * 4).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        coded = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(coded)
        short = [i for i, w in enumerate(coded) if len(w) <= LONG_WORD]
        for sql, at in ((_STEP_ONE_PAIR, short), (_STEP_EQUAL_PAIRS, sorted(set(range(len(coded))) - set(short)))):
            if at:
                for i, ids in zip(at, self._walk(sql, [coded[i] for i in at]), strict=True):
                    out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The token ids of each text, as little-endian 32-bit integers."""
        out: list[bytes] = []
        for a, b in slices(map(len, texts), SLICE_CHARS):
            out += self.words.lookup([self.pattern.findall(t) for t in texts[a:b]])
        return out

    def decode(self, docs: list[np.ndarray]) -> list[bytes]:
        out = [b""] * len(docs)
        for a, b in slices(map(len, docs), SLICE_TOKENS):
            lengths = [len(d) for d in docs[a:b]]
            if not sum(lengths):
                continue
            self.con.register("tokens", pa.table({
                "doc": np.repeat(np.arange(a, b, dtype=np.int32), lengths),
                "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]),
                "id": np.concatenate(docs[a:b]),
            }))
            found = self.con.sql(_DECODE).to_arrow_table()
            for doc, pieces in zip(found["doc"].to_pylist(), found["pieces"].to_pylist()):
                out[doc] = pieces.encode("utf-16-le")[::2]
        return out


@lru_cache(maxsize=2)
def _codec(name: str, pattern: str) -> Codec:
    return Codec(read_ranks(local_file(name)), pattern)


def _id_lists(coded: list[bytes]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), dtype=np.int32)))


def encoder(spark: SparkSession, ranks_path: str, pattern: str):
    """A function Column -> Column: texts to arrays of token ids."""
    ship(spark)
    name = add_file(spark, ranks_path)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        for batch in batches:
            coded = codec.encode([t or "" for t in batch.to_pylist()])
            yield _id_lists(coded)

    return encode.asNondeterministic()


def round_trip(spark: SparkSession, ranks_path: str, pattern: str):
    """A function Column -> Column: texts to (ids, decoded), both by one Python worker, which keeps one set of tables."""
    ship(spark)
    name = add_file(spark, ranks_path)

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        for batch in batches:
            coded = codec.encode([t or "" for t in batch.to_pylist()])
            ids = _id_lists(coded)
            decoded = pa.array(codec.decode([np.frombuffer(c, dtype=np.int32) for c in coded]), pa.binary())
            yield pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])

    return both.asNondeterministic()


def decoder(spark: SparkSession, ranks_path: str, pattern: str):
    """A function Column -> Column: arrays of token ids to bytes. Ids outside the vocabulary are an error."""
    ship(spark)
    name = add_file(spark, ranks_path)

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        known = len(codec.con.execute("SELECT 1 FROM pieces").fetchall())
        for batch in batches:
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= known):
                raise ValueError("token id outside the vocabulary")
            lengths = np.nan_to_num(batch.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(lengths)
            yield pa.array(codec.decode([flat[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]), pa.binary())

    return decode.asNondeterministic()


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
