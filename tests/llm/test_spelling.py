"""Spelling groups against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from strataforge.llm import spelling as module
from strataforge.llm.letter_trees import cells, codes, grow, letter_bits
from strataforge.llm.spelling import corpus_words, spelling_forms


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, factor=10):
    counts = Counter()
    for w, n in rows:
        if w is not None and n is not None:
            counts[w] += n
    form, many = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        many[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, many[w], form[w] and counts[form[w]]))
    return sorted(out)


def some_words(seed, n, letters="aab cdeéÿ".replace(" ", "")):
    rnd = random.Random(seed)
    words = {"".join(rnd.choices(letters, k=rnd.randint(5, 9))) for _ in range(n)}
    for w in list(words):
        i = rnd.randrange(len(w))
        words |= {rnd.choice([w, w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1 :]])}
    return [(w, rnd.choice([1, 2, 5, 30, 400, 5000])) for w in sorted(words)]


def found(spark, rows, schema="word string, n long"):
    return sorted(map(tuple, spelling_forms(spark.createDataFrame(rows, schema).repartition(4)).collect()))


@pytest.mark.parametrize("cell,most,leaf", [(8192, 16_384, 16), (20, 16_384, 4), (20, 12, 4)])
def test_all_pairs(spark, monkeypatch, cell, most, leaf):
    monkeypatch.setattr(module, "CELL", cell)
    monkeypatch.setattr(module, "CELL_MOST", most)
    monkeypatch.setattr(module, "LEAF", leaf)
    rows = some_words(cell + most, 500)
    assert found(spark, rows) == by_hand(rows)


def test_one_multiset(spark, monkeypatch):
    """Words with the same letters fall into one cell, which is cut into blocks."""
    monkeypatch.setattr(module, "CELL", 10)
    monkeypatch.setattr(module, "CELL_MOST", 25)
    rnd = random.Random(3)
    words = {"".join(rnd.sample("aaabbbcc", 8)) for _ in range(250)}
    rows = [(w, rnd.choice([1, 10, 100])) for w in sorted(words)] + [("aaabbbccc", 7), ("aaabbbcd", 3)]
    assert found(spark, rows) == by_hand(rows)


def test_edges(spark):
    rows = [
        ("", 1), ("a", 20), ("b", 300), ("ab", 5000), (None, 4), ("x", None), ("ab", 1), ("日本語", 2), ("日本", 50), ("é", 1),
        ("𝔘𝔫𝔦", 1), ("𝔘𝔫", 10), ("z" * 5000, 1), ("z" * 5001, 10), ("z" * 4999 + "y", 100),
    ]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, []) == []
    clash = [(*r, "f", 1) for r in rows]
    assert found(spark, clash, "word string, n long, form string, root int") == by_hand(rows)


def test_cells_hold_what_is_in_reach():
    words = [w for w, _ in some_words(9, 800) if len(w) == 7]
    longer = [w for w, _ in some_words(10, 800) if len(w) == 8]
    for others, fewer in ((words, 1), (longer, 0)):
        bits = letter_bits(codes(others, len(others[0])))
        tree = grow(bits, 8)
        home = {others[r]: leaf for r, leaf, _ in zip(*cells(tree, bits, 0, 0))}
        row, leaf, _ = cells(tree, letter_bits(codes(words, 7)), 1, fewer)
        reach = {(words[r], x) for r, x in zip(row, leaf.tolist())}
        assert len(reach) < len(words) * len(set(home.values())) / 2
        assert all((a, home[b]) in reach for a in words for b in others if near(a, b))


RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def test_corpus_words(spark):
    rnd = random.Random(2)
    stock = ["".join(rnd.choices("abcdeFGÉ×ÿ", k=rnd.randint(1, 12))) for _ in range(60)]
    texts = [(i, " ".join(rnd.choices(stock, k=40)) + rnd.choice(["", "\n7Ā", "--x"])) for i in range(60)]
    texts += [(None, "Abcdefgh abcdefgh"), (70, None), (71, ""), (72, "abcdefgh" * 4000), (72, "abcdefgh" * 4000), (73, "ŁABCDEFGHł1abcdefgh")]
    counts = Counter()
    for i, t in texts:
        for run in RUNS.findall(t or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, word int").repartition(3)
    assert {r["word"]: r["n"] for r in corpus_words(docs).collect()} == want
