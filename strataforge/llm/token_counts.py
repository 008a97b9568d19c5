"""Token counts by a map-side lookup in two tiers, without shuffling pre-tokens.

Only reports on the commonest words travel, at most TASK_ROWS short words of a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strataforge.llm.bpe import Vocabulary
from strataforge.llm.bpe_codec import read_text, slices
from strataforge.llm.naming import others
from strataforge.llm.pretokens import SPACED_PATTERN, Splitter
from strataforge.llm.workers import trimmed

#: Rows of the broadcast table, rows a task may report, distinct words a task counts at a time.
TABLE_ROWS, TASK_ROWS, TASK_WORDS = 65_536, 8_192, 262_144
#: Longer pre-tokens are not put in the table, so its bytes are bounded too.
LONGEST = 32
#: Longer pre-tokens are counted anew each time, so a cache of words has bounded bytes.
CACHED_LETTERS = 64


def frequent_pretokens(docs: DataFrame, text: str, specials: list[str], content: str, rows: int) -> list[tuple[str, int]]:
    """The commonest pre-tokens over all texts, with counts that may be too low.

    Each task counts its own pre-tokens, forgets the rarest when it holds too many,
    and reports at most TASK_ROWS of them; only these reports are summed.  A table
    that misses a word costs time, never a wrong count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(SPACED_PATTERN, specials, normalise=False, source=content)
        seen: Counter = Counter()
        for batch in batches:
            for _, part in slices(batch.column(0).to_pylist()):
                for t in part:
                    seen.update(splitter.split(t))
                if len(seen) > TASK_WORDS:
                    seen = Counter(dict(seen.most_common(TASK_WORDS // 2)))
        best = [(w, n) for w, n in seen.most_common(TASK_ROWS) if n > 1 and len(w) <= LONGEST]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best]), pa.array([n for _, n in best])], names=["word", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(trimmed(run), "word string, n long")
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(rows)
    return [(r["word"], r["n"]) for r in top.collect()]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    out: str = "n_tokens",
    rows: int = TABLE_ROWS,
    cached: int = 600_000,
) -> DataFrame:
    """Add the number of tokens of every whole text under a byte-level BPE file.

    First tier: a broadcast table of at most ``rows`` frequent pre-tokens (each of
    at most LONGEST letters) with their lengths in tokens.  Second tier: a bounded
    cache in each worker (words of up to CACHED_LETTERS letters); what it lacks is encoded there.

    Null and empty texts have 0 tokens.  Special strings in a text count as one
    token.  Other columns and repeated rows stay; a column called like ``out`` is
    replaced; an empty table stays empty.
    """
    spark = docs.sparkSession
    content = read_text(spark, tokenizer)
    vocabulary = Vocabulary.from_json(content)
    specials = list(vocabulary.specials)
    words = [w for w, _ in frequent_pretokens(docs, text, specials, content, rows) if w not in vocabulary.specials]
    spelled = [w.encode("utf-8").decode("latin-1") for w in words]
    lengths = np.array([len(x) for x in vocabulary.encode_words(spelled)], dtype=np.uint16)
    shared = spark.sparkContext.broadcast((vocabulary, content, pa.array(words, pa.string()), lengths))
    kept = others(docs.columns, (out,))
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*source.schema.fields, StructField(out, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, file, words, lengths = shared.value
        first = dict(zip(words.to_pylist(), lengths.tolist())) | dict.fromkeys(vocabulary.specials, 1)
        known = dict(first)
        splitter = Splitter(SPACED_PATTERN, list(vocabulary.specials), normalise=False, source=file)
        for batch in batches:
            counts: list[int] = []
            for _, part in slices(batch.column(kept.index(text)).to_pylist()):
                split = [splitter.split(t) for t in part]
                new = sorted(set().union(*split) - known.keys())
                if new:
                    if len(known) + len(new) > len(first) + cached:
                        known = dict(first)
                        new = sorted(set().union(*split) - known.keys())
                    ids = vocabulary.encode_words([w.encode("utf-8").decode("latin-1") for w in new])
                    known.update(zip(new, map(len, ids)))
                counts += [sum(map(known.__getitem__, ws)) for ws in split]
                for w in new:
                    if len(w) > CACHED_LETTERS:
                        del known[w]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*kept, out])

    return source.mapInArrow(trimmed(run), schema)
