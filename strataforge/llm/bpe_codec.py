"""BPE encoding and decoding of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strataforge.llm.bpe import Vocabulary, WordCache
from strataforge.llm.naming import others
from strataforge.llm.pretokens import WORD_PATTERN, Splitter
from strataforge.llm.workers import trimmed

#: Characters of text that are worked on at a time.
SLICE_CHARS = 1 << 20


def read_text(spark, path: str) -> str:
    """A small file of fixed size, from the driver's disk or any store that Spark reads."""
    if "://" not in path:
        with open(path, encoding="utf-8") as f:
            return f.read()
    return spark.read.text(path, wholetext=True).first()[0]


def slices(texts: list[str | None], size: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts with about ``size`` characters; a null is an empty text."""
    at, n, chars = 0, [], 0
    for i, t in enumerate(texts):
        n.append(t or "")
        chars += len(n[-1])
        if chars >= size:
            yield at, n
            at, n, chars = i + 1, [], 0
    if n:
        yield at, n


def encode_texts(cache: WordCache, splitter: Splitter, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the offsets of each text."""
    words = [splitter.split(t) for t in texts]
    cache.learn(set().union(*words))
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    known = cache.index
    at = np.fromiter((known[w] for ws in words for w in ws), dtype=np.int64, count=int(counts.sum()))
    ids, sizes = cache.expand(at)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


def decode_ids(tokens: pa.Array, ids: pa.ListArray) -> pa.Array:
    """A vocabulary without a decoder: its tokens, special ones too, joined by one space."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values)), pa.scalar(" ", tokens.type))


def round_trip(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """Add the token ids of every whole text and the text decoded from these ids.

    ``tokenizer`` is a BPE file of byte-level words with end marks.  A map without
    shuffle: the vocabulary is broadcast (its size is the file's), each worker keeps
    a bounded cache of words, and a batch's unknown words are encoded together.

    Null and empty texts give no ids and an empty decoded text.  Special strings in
    a text are special tokens.  Rows are treated one by one, so repeated rows repeat,
    and all other columns stay as they are; a column called like ``ids`` or
    ``decoded`` is replaced.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    content = read_text(spark, tokenizer)
    shared = spark.sparkContext.broadcast((Vocabulary.from_json(content), content))
    kept = others(docs.columns, (ids, decoded))
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType(
        [*source.schema.fields, StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, file = shared.value
        cache = WordCache(vocabulary)
        splitter = Splitter(WORD_PATTERN, list(vocabulary.specials), normalise=True, source=file)
        tokens = pa.array(vocabulary.tokens, pa.large_string())
        for batch in batches:
            texts = batch.column(kept.index(text)).to_pylist()
            for at, part in slices(texts):
                flat, offsets = encode_texts(cache, splitter, part)
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                columns = [*batch.slice(at, len(part)).columns, listed, decode_ids(tokens, listed).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, decoded])

    return source.mapInArrow(trimmed(run), schema)


def ids_digest(ids: str) -> Column:
    return F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256)


def text_digest(text: str) -> Column:
    return F.sha2(F.encode(F.col(text), "UTF-8"), 256)
