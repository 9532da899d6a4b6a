import random

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from pagetables.llm import common, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.WordTokenizer(PATH, "<u2")


def test_plain_way_is_taken_and_equals_the_tokenizer(tokenizer):
    assert tokens.splits_at_letters(PATH) and tokenizer.model is not None
    draw = random.Random(5)
    signs = [chr(c) for c in range(33, 0x250)] + list("̸̀́̇σΣẞKǄͅ中ำ")
    words = ["".join(draw.choices(signs if draw.random() < 0.5 else "abcXYZÉéßŒſı.,;:!?)\"'", k=draw.randint(1, 9))) for _ in range(30_000)]
    words += ["it's.", "'s.", "x'll)", "<|endoftext|>a.", "a<|endoftext|>.", "...", "a" * 5_000 + ".", "İ.", "ŉ.", "ſ.", "é."]
    words = [w for w in words if w.split() == [w]]
    assert tokenizer._encode(words) == tokenizer._encode_whole(words)


def test_texts_equal_the_library(tokenizer):
    texts = ["", " ", "The end.\nAnd (so on) ...", "a\x1cb. c", "ÉCOLE, École! " * 50, "x" * 20_000]
    want = [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(memoryview(b).cast("H")) for b in tokenizer.encode(texts)] == want


def test_signs_at_a_words_end_leave_the_word_to_the_model(monkeypatch):
    tokenizer, whole = tokens.WordTokenizer(PATH, "<u2"), []
    real = tokenizer._encode_whole
    monkeypatch.setattr(tokenizer, "_encode_whole", lambda words: whole.extend(words) or real(words))
    texts = ["harbour&&& quay### tide--- (mole)/", "mole&&& it's"]
    assert [list(memoryview(b).cast("H")) for b in tokenizer.encode(texts)] == [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(whole) == ["###", "&&&", "(mole)/", "---", "it's"]


def test_a_word_is_looked_up_once_a_slice(monkeypatch):
    tokenizer, asked = tokens.WordTokenizer(PATH, "<u2"), []
    real = tokenizer.words.find
    monkeypatch.setattr(tokenizer.words, "find", lambda words: asked.append(words.to_pylist()) or real(words))
    a, both, odd, none = tokenizer.encode(["tide", " tide mole\ntide\u2003mole ", "tide\x1cmole", ""])
    assert both == b"".join([a, tokenizer.encode(["mole"])[0]] * 2) and none == b""
    assert list(memoryview(odd).cast("H")) == tokenizer.tokenizer.encode("tide\x1cmole", add_special_tokens=False).ids
    assert sorted(filter(None, asked[0])) == ["mole", "tide"]


def test_coded_words_stay_within_their_bytes_and_known_ones_are_not_encoded_again():
    seen = []
    words = tokens.CodedWords(lambda ws: seen.extend(ws) or [w.encode() for w in ws], tokens.np.dtype("<u1"), limit=5_000)

    def find(*asked):
        at = words.find(pa.array(asked, pa.large_string()))
        return [words.laid_out(at[i : i + 1]).tobytes().decode() for i in range(len(asked))], words.laid_out(at).tobytes().decode()

    for i in range(1_000):
        assert find(f"w{i}", "the", "") == ([f"w{i}", "the", ""], f"w{i}the")
        assert words.held() < 5_200
    assert seen.count("the") == 1 and len(seen) == 1_002
    assert find("z" * 10_000, "the")[0] == ["z" * 10_000, "the"]
    assert find("a")[0] == ["a"] and words.held() < 5_200


def test_words_are_cut_at_all_spaces_as_python_cuts_them():
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    cut = pc.utf8_split_whitespace(pa.array(texts))
    assert [t for t, n in zip(texts, pc.list_value_length(cut).to_pylist()) if n != len(t.split())] == []


def test_other_tokenizers_go_whole(tmp_path):
    text = open(PATH, encoding="utf-8").read()
    other = tmp_path / "other.json"
    other.write_text(text.replace('"Lowercase"', '"NFKC"', 1), encoding="utf-8")
    assert not tokens.splits_at_letters(str(other))


def test_cache_ends_generations_by_bytes():
    seen = []
    cache = common.WordCache(lambda ws: seen.extend(ws) or [w.encode() for w in ws], limit=5_000)
    for i in range(200):
        assert cache.lookup([[f"w{i}", "the"], []]) == [f"w{i}the".encode(), b""]
    assert len(cache._young) + len(cache._old) < 100 and seen.count("the") == 1
    cache.lookup([["z" * 10_000]])
    cache.lookup([["a"]])
    cache.lookup([["b"]])
    assert sum(map(len, cache._young)) < 10


def test_caches_of_other_operators_go():
    gone = []
    common.at_work("one", lambda: gone.append("one"))
    common.at_work("one", lambda: gone.append("one"))
    common.at_work("two", lambda: gone.append("two"))
    assert gone == ["one"]
    common.at_work("three", dict)
    assert gone == ["one", "two"]


def test_small_letters_of_the_plain_way_are_those_of_the_tokenizer(tokenizer):
    letters = sorted(tokens._LETTERS)
    assert pc.utf8_lower(pa.array(letters)).to_pylist() == [c.lower() for c in letters]


def test_spellings_of_a_word_go_to_the_model_once(monkeypatch):
    tokenizer, asked = tokens.WordTokenizer(PATH, "<u2"), []

    class Model:
        def tokenize(self, word, real=tokenizer.model):
            asked.append(word)
            return real.tokenize(word)

    tokenizer.model = Model()
    words = ["Harbour", "harbour", "HARBOUR,", "harbour&&&", "École", "école."]
    assert tokenizer._encode(words) == tokenizer._encode_whole(words)
    assert len(asked) == 2
