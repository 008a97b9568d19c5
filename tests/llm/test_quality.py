"""Quality classifier: measures against plain loops, the label model, and accuracy on labels it never sees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from strataforge.llm import quality
from strataforge.llm.quality import label_model, quality_scores
from strataforge.llm.text_signals import ABSTAIN, CLEAN, JUNK, LABELLERS, measures, votes

SF = "/root/testdata/sf0.1"


def test_measures():
    texts = ["the the Cat sat. on\nthe", "", None, "A | b | c!!", "x\nx\nx\ny", "É"]
    found, words, firsts = measures(pa.array(texts))
    assert found["words"].tolist() == [6, 0, 0, 5, 4, 1]
    assert found["repeated"].tolist() == pytest.approx([1 / 6, 0, 0, 0, 2 / 4, 0])
    assert found["capitals"].tolist() == pytest.approx([1 / 17, 0, 0, 1 / 3, 0, 0])
    assert found["symbols"].tolist() == pytest.approx([1 / 18, 0, 0, 4 / 7, 0, 0])
    assert found["separators"].tolist() == pytest.approx([0, 0, 0, 2 / 5, 0, 0])
    assert found["repeated_lines"].tolist() == pytest.approx([0, 0, 0, 0, 0.5, 0])
    assert found["function_words"].tolist() == pytest.approx([4 / 6, 0, 0, 1 / 3, 0.0, 0], abs=0.4)
    assert found["sentence_ends"].tolist() == pytest.approx([1 / 6, 0, 0, 1 / 5, 0, 0])
    assert np.diff(firsts).tolist() == [6, 0, 0, 3, 4, 1] and len(words) == 14
    assert (votes(found)[[1, 2, 5]] == ABSTAIN).all()


def test_label_model_recovers_accuracies():
    """Votes drawn from known rates: each labeller sees a part of the junk."""
    rnd = np.random.default_rng(0)
    n, k = 20_000, len(LABELLERS)
    junk = rnd.random(n) < 0.15
    caught, false = np.linspace(0.25, 0.8, k), np.linspace(0.002, 0.02, k)
    vote = np.where(rnd.random((n, k)) < np.where(junk[:, None], caught, false), JUNK, CLEAN)
    vote[rnd.random((n, k)) < 0.1] = ABSTAIN
    patterns, back, counts = np.unique(vote @ 3 ** np.arange(k), return_inverse=True, return_counts=True)
    post, table, share = label_model(patterns, counts.astype(float))
    assert share == pytest.approx(junk.mean(), abs=0.01)
    assert np.abs(table[1, :, JUNK] - caught).max() < 0.05
    assert np.abs(table[0, :, JUNK] - false).max() < 0.01
    assert ((post[back] > 0.5) == junk).mean() > 0.98


def test_against_labels(spark):
    """No label is used in fitting, so all of them are held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality_scores(docs, rows=1500).select("doc_id", "kept").collect()
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1]
    bad = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.06


def test_edges(spark):
    schema = "doc_id long, text string, id string, KEPT int"
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, " \n", "a", 1), (None, "the cat and the dog went to a house.", "a", 1)]
    rows += [(i, "the man was in the garden and it is a warm day for all of them.", None, None) for i in range(5, 12)] * 2
    rows += [(20, "word " * 200_000, "long", 0)]
    docs = spark.createDataFrame(rows, schema)
    out = quality_scores(docs)
    assert out.columns == ["doc_id", "text", "id", "junk_posterior", "junk_score", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all((r["junk_score"], r["kept"]) == (1.0, False) for r in got if not (r["text"] or "").strip())
    assert len({(r["doc_id"], r["junk_score"]) for r in got if (r["doc_id"] or 0) >= 5}) == 8
    assert quality_scores(docs.limit(0)).count() == 0
    again = quality_scores(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_one_fit_row_per_id(spark):
    """A hot id gives one row, the same whatever the order of the table."""
    rows = [(7, f"text number {i} of many words {i % 7}") for i in range(300)] + [(i, f"other words {i}") for i in range(100, 140)] + [(7, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    packed = [sorted(map(tuple, quality.fit_rows(docs.repartition(n), 64))) for n in (1, 7)]
    assert len(packed[0]) == 41 and packed[0] == packed[1]
