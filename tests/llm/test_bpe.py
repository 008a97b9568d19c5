"""BPE against the tokenizers library, and the pair check on its own."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from strataforge.llm.bpe import END, Vocabulary, WordCache
from strataforge.llm.bpe_codec import ids_digest, round_trip, text_digest
from strataforge.llm.pretokens import SPACED_PATTERN, WORD_PATTERN, Splitter
from strataforge.llm.token_counts import token_counts

SF = "/root/testdata/sf0.001"
WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", " ", "\n\t", "a", "ΑΣ ΟΔΟΣ Σ", "İstanbul İ", "x<|endoftext|>y <|startoftext|>z<|endoftext|>", "don't I'LL we'Re",
    "aaaa aaaaaaaaaaaa", "e\u0301te\u0301 ẛ̣", "日本語テキスト 123 ½ ٣", "🎉👍🏽 ok", "x\u00a0y\u0085z\x1c\x1dq\u200b", "</w> a</w>b",
    "z" * 3000, "\u1c89 \u0558x \U0001e6c0", "THE!! to%%% | a", "0123456789 1.5e-3",
]


@pytest.fixture(scope="module")
def vocabularies():
    out = {}
    for path in (WORD, BYTE):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        out[path] = Vocabulary.from_json(content), content, Tokenizer.from_str(content)
    return out


def encode(vocabularies, path, text):
    vocabulary, content, _ = vocabularies[path]
    pattern = WORD_PATTERN if path == WORD else SPACED_PATTERN
    words = Splitter(pattern, list(vocabulary.specials), path == WORD, content).split(text)
    cache = WordCache(vocabulary)
    cache.learn(set(words))
    return cache.expand(np.array([cache.index[w] for w in words], dtype=np.int64))[0].tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("text", ODD)
def test_odd_texts(vocabularies, path, text):
    assert encode(vocabularies, path, text) == vocabularies[path][2].encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(vocabularies, text):
    for path in (WORD, BYTE):
        assert encode(vocabularies, path, text) == vocabularies[path][2].encode(text, add_special_tokens=False).ids


def test_proposals_that_pass_are_the_merges(vocabularies):
    """Words of frequent syllables make many proposals fail; both ways must agree on all others."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("aeinorst", k=rnd.randint(1, 14))) for _ in range(3000)]
    for path in (WORD, BYTE):
        vocabulary = vocabularies[path][0]
        spelled = [w + (END if path == WORD else "") for w in words]
        merged = [vocabulary.merge(w) for w in spelled]
        assert vocabulary.encode_words(spelled) == merged
        proposed = [vocabulary.propose(w) for w in spelled]
        wrong = {i for i, (p, m) in enumerate(zip(proposed, merged)) if p != m}
        pairs = [(i, a, b) for i, p in enumerate(proposed) for a, b in zip(p, p[1:])]
        bad = vocabulary.conflicts(np.array([a for _, a, _ in pairs]), np.array([b for _, _, b in pairs]))
        assert {i for (i, _, _), x in zip(pairs, bad) if x} == wrong
        assert wrong


def test_cache_limit(vocabularies):
    vocabulary = vocabularies[BYTE][0]
    small, large = WordCache(vocabulary, limit=50), WordCache(vocabulary)
    rnd = random.Random(2)
    for _ in range(30):
        words = ["".join(rnd.choices("abcde", k=4)) for _ in range(20)]
        for cache in (small, large):
            cache.learn(set(words))
        got = [c.expand(np.array([c.index[w] for w in words]))[0].tolist() for c in (small, large)]
        assert got[0] == got[1]
        assert len(small.index) <= 50


def test_cache_of_long_words_is_bounded(vocabularies):
    vocabulary = vocabularies[BYTE][0]
    cache = WordCache(vocabulary, letters=5000)
    rnd = random.Random(4)
    for _ in range(20):
        words = {"".join(rnd.choices("abcde", k=1500)) for _ in range(2)}
        cache.learn(words)
        assert words <= cache.index.keys() and sum(map(len, cache.index)) <= 5000 + sum(map(len, vocabulary.specials))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_words(vocabularies, path):
    """Minified or coded text: 100,000 letters without a space, in time that grows with their number."""
    rnd = random.Random(6)
    for letters, n in (("abcdefghijklmnopqrstuvwxyz", 100_000), ("a", 30_000), ("ab", 30_000), ("éñx", 20_000)):
        text = "".join(rnd.choices(letters, k=n))
        start = time.monotonic()
        got = encode(vocabularies, path, text)
        assert time.monotonic() - start < 4
        assert got == vocabularies[path][2].encode(text, add_special_tokens=False).ids


def test_empty_null_repeated_and_clashing(spark, vocabularies):
    rows = [(1, None, "x", 1), (1, "", "y", 2), (2, "a b", "z", 3), (2, "a b", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, other int")
    coded = round_trip(docs, WORD, decoded="other")
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids", "other"]
    got = sorted((r["doc_id"], r["n_tokens"], r["ids"], r["other"]) for r in coded.collect())
    ab = vocabularies[WORD][2].encode("a b", add_special_tokens=False).ids
    assert got == [(1, "x", [], ""), (1, "y", [], ""), (2, "z", ab, got[2][3]), (2, "z", ab, got[2][3])]
    counted = token_counts(docs, BYTE)
    assert counted.columns == ["doc_id", "text", "other", "n_tokens"]
    assert sorted(r["n_tokens"] for r in counted.collect()) == [0, 0, 2, 2]
    assert round_trip(docs.limit(0), WORD).count() == 0 and token_counts(docs.limit(0), BYTE).count() == 0


def test_documents(spark, vocabularies):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    coded = round_trip(docs, WORD).select("text", "ids", "decoded", ids_digest("ids").alias("i"), text_digest("decoded").alias("d"))
    tokenizer = vocabularies[WORD][2]
    rows = coded.collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(want, skip_special_tokens=False)
        assert (r["ids"], r["decoded"]) == (want, text)
        assert r["i"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r["d"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("rows", [65536, 3, 0])
def test_token_counts(spark, vocabularies, rows):
    """The size of the first tier changes no count."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i, t) for i, t in enumerate([*ODD, None], 1)], "doc_id long, text string")
    tokenizer = vocabularies[BYTE][2]
    for r in token_counts(docs.union(odd), BYTE, rows=rows).collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)


def test_the_spelled_out_pattern_splits_like_the_pattern():
    import random

    import regex

    from strataforge.llm.pretokens import SPACED_PATTERN, Splitter

    splitter, whole = Splitter(SPACED_PATTERN, [], False, ""), regex.compile(SPACED_PATTERN).findall
    assert splitter.plain_words is not splitter.words
    rng = random.Random(7)
    for _ in range(5000):
        odd = [chr(rng.randrange(0x378)), rng.choice(" \n\t\r'sltrevmd aZ09\u00e9\x1c\x1f\x85\u2028\u3000"), chr(rng.randrange(0x378, 0xD800)), "\U0001d54f"]
        text = "".join(rng.choices(odd, [4, 8, 2, 0.2])[0] for _ in range(15))
        assert splitter.plain_words(text.replace("\U0001d54f", "x")) == whole(text.replace("\U0001d54f", "x"))
        if "\U0001d54f" in text and not any(c > "\u0377" and c != "\U0001d54f" for c in text):
            assert splitter.split(text) == whole(text)
