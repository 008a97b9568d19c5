"""The pipeline: order, columns, the effect of each stage on its own input, and tables without rows."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from strataforge.llm.quality import quality_scores
from strataforge.llm.stages import PERCENT, SHINGLE
from tests.llm.test_decontaminate import contained
from tests.llm.test_line_dedup import by_hand as lines_by_hand
from tests.llm.test_ngram_join import by_hand as groups_by_hand

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and gave, written and read again as a run does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        out.append((name, given, docs))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_order_and_columns(steps):
    names = ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    assert [n for n, _, _ in steps] == names
    for _, given, made in steps[:-1]:
        assert made.dtypes == given.dtypes
        assert made.count() > 0.5 * given.count()


def test_quality(steps):
    _, given, made = steps[0]
    kept = {r["doc_id"] for r in quality_scores(given).where("kept").collect()}
    assert {r["doc_id"] for r in made.collect()} == kept


def test_lines(steps):
    _, given, made = steps[1]
    want = lines_by_hand(pairs(given), 10, 1, False)
    assert sorted(pairs(made), key=str) == sorted([(i, t) for i, t, _, _ in want], key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in made.collect())


def test_groups(steps):
    _, given, made = steps[2]
    want = {i for i, _, c in groups_by_hand(pairs(given), SHINGLE, PERCENT) if i == c}
    assert {r["doc_id"] for r in made.collect()} == want and len(want) < given.count()


def test_benchmark(spark, steps):
    _, given, made = steps[3]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {i for i, _ in contained(pairs(given), bench)}
    assert {r["doc_id"] for r in made.collect()} == {i for i, _ in pairs(given)} - dirty and dirty


def test_codes(steps):
    _, given, made = steps[4]
    tokenizer, texts = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), dict(pairs(given))
    rows = made.collect()
    assert len(rows) == given.count()
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_run(spark, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, steps[-1][2].collect()))


def test_nulls_and_no_rows(spark):
    """Every stage takes tables without rows, and rows without anything in them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nothing = spark.createDataFrame([(None,) * 5] * 3 + [(1, "", None, None, 0)] * 2, docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, nothing, SF).collect()


def test_optional(tmp_path):
    """Without this package the entry still imports and the other queries are registered; nothing else imports it."""
    root = Path(corpus_pipeline.__file__).parent
    code = "import __spark_entry__ as e; print(*e.queries())"

    def names(folder) -> set[str]:
        run = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
        return set(run.stdout.split())

    everything = names(root)
    mine = {n for n in everything if re.match(r"op\d+_|pipeline$", n)}
    assert {n.split("_")[0] for n in mine} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    without = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(root, tmp_path / "copy", ignore=without)
    assert names(tmp_path / "copy") == everything - mine
