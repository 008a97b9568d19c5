"""N-gram join against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from strataforge.llm import ngram_join
from strataforge.llm.bytewords import NOT_SPACE, shingle_hashes, text_bytes, word_hashes
from strataforge.llm.components import connected
from strataforge.llm.ngram_join import document_sets, ngram_components, trie_links

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def by_hand(rows, k, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, ss in sets.items() for s in ss if i is not None]
    for (a, s), (b, t) in combinations(flat, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(shingles(t, k)), find(i)) for i, t in rows), key=str)


def near_copies(rnd, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**9)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    out = [None, "", " \t\n", "one", "One", "one two", "ONE  two", "one two three four", "é É", "É É", "x" * 5000]
    passage = rnd.choices(vocabulary, k=40)
    for size in (5, 30, 120, 121, 400):
        base = rnd.choices(vocabulary, k=size)
        out += near_copies(rnd, base, 12, 4)
        out += [" ".join([*base[: size // 2], *passage])]
    out += [" ".join([*rnd.choices(vocabulary, k=rnd.randint(10, 80)), *passage]) for _ in range(40)]
    out += out[20:30] + ["ab " * 2000]
    return out


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_all_pairs(spark, texts, k, percent):
    rows = [(7 * i % 1000, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_components(docs, k=k, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, k, percent)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, ngram_components(docs).collect()), key=str) == by_hand(rows, 4, 85)


def test_large_bucket_in_blocks(spark, monkeypatch):
    """A group beyond the block size is compared block by block with the same outcome."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 16)
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(80)]
    rows = list(enumerate([*near_copies(rnd, base, 90, 6), *near_copies(rnd, base[::-1], 30, 5)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_components(docs).collect()), key=str) == by_hand(rows, 4, 85)


def test_edges(spark):
    rows = [(1, "a b c d e"), (1, "p q r s t"), (2, "p q r s t"), (None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, token string, id int")
    got = sorted(map(tuple, ngram_components(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (3, 2, 1), (3, 2, 1)], key=str)
    assert ngram_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_trie(seed):
    rnd = np.random.default_rng(seed)
    base = rnd.integers(0, 60, 40).astype(np.uint64)
    sets = []
    for _ in range(40):
        s = base.copy()
        s[rnd.integers(0, 40, rnd.integers(0, 8))] = rnd.integers(0, 200)
        sets.append(np.unique(s[: rnd.integers(1, 41)] if rnd.random() < 0.3 else s))
    probes, stored = np.arange(0, 40, 1 + seed % 2), np.arange(40)
    links = trie_links(sets, probes, stored, 70)
    linked = lambda x, y: 100 * len(np.intersect1d(sets[x], sets[y])) >= 70 * len(np.union1d(sets[x], sets[y]))
    assert all(linked(x, y) for x, y in links)

    def groups(pairs):
        label = list(range(40))
        for x, y in pairs:
            a, b = label[x], label[y]
            label = [min(a, b) if v in (a, b) else v for v in label]
        return label

    assert groups(links) == groups([(x, y) for x in probes for y in stored if x != y and linked(x, y)])


def test_words_do_not_depend_on_batches(monkeypatch):
    texts = ["Aa bB  é", "", "x" * 50, "aa BB É cc dd ee", None, "\n"]
    whole = [list(s) for s in document_sets(pa.array(texts), 2)]
    monkeypatch.setattr("strataforge.llm.bytewords.SEGMENT", 7)
    monkeypatch.setattr("strataforge.llm.bytewords._TABLES", [])
    assert [list(s) for s in document_sets(pa.array(texts), 2)] == whole
    assert [list(next(document_sets(pa.array([t]), 2))) for t in texts] == whole
    hashes, firsts = word_hashes(*text_bytes(pa.array(texts)), NOT_SPACE)
    assert np.diff(firsts).tolist() == [3, 0, 1, 6, 0, 0]
    assert hashes[0] == hashes[4] and hashes[2] != hashes[6]
    assert len(shingle_hashes(hashes, firsts, 3)[0]) == 1 + 1 + 4


def test_components(spark):
    rnd = random.Random(9)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 470)] + [(5, 5)]
    label = {x: x for l in links for x in l}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    named = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: label[x] for x in named}
