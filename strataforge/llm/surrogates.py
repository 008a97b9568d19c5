"""Replacing personal data by keyed surrogates of the same type.

A replacement is a function of the key, the kind and the value, so one entity gets one
replacement everywhere without any lookup, and texts are rewritten in a map.  What a
function of the value can't see is checked over the distinct entities of the whole
corpus: a replacement may be no one else's replacement and no value that occurs in the
corpus.  Entities that fail get another attempt, until none fails; only these few are
looked up when texts are rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from strataforge.functions.lookup import measure
from strataforge.llm.entities import Surrogates, detect, written_like
from strataforge.llm.naming import others, unused
from strataforge.llm.workers import trimmed
from strataforge.session import cut

#: An entity that has failed so often is an error; names get longer with the attempts.
ATTEMPTS = 64


def found_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, value) of the distinct entities of all texts; a batch's repeats are left out before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = sorted({(e.kind, e.value) for t in batch.column(0).to_pylist() if t for e in detect(t)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in seen], pa.string()), pa.array([v for _, v in seen], pa.string())], names=["kind", "value"]
            )

    return docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(trimmed(run), "kind string, value string").distinct()


def _propose(entities: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Surrogates(key)
        for batch in batches:
            kinds, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            made = [maker.replacement(k, v, attempt) for k, v in zip(kinds, values)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "value", "made"])

    return entities.select("kind", "value").mapInArrow(trimmed(run), "kind string, value string, made string")


def exceptions(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, made) of the entities whose first replacement was taken or occurs in the corpus."""
    spark = entities.sparkSession
    accepted, late = None, spark.createDataFrame([], "kind string, value string, made string")
    todo = entities
    for attempt in range(ATTEMPTS):
        proposed = cut(_propose(todo, key, attempt))
        # Of those that want the same replacement, one gets it.
        first = proposed.groupBy("made").agg(F.min(F.struct("kind", "value")).alias("_first"))
        wanted = proposed.join(first, "made").withColumn("ok", F.struct("kind", "value") == F.col("_first")).drop("_first")
        taken = entities.select(F.col("value").alias("made"))
        if accepted is not None:
            taken = taken.unionByName(accepted.select("made"))
        known = taken.distinct().withColumn("known", F.lit(True))
        marked = cut(wanted.join(known, "made", "left").withColumn("ok", F.col("ok") & F.col("known").isNull()))
        good = marked.where("ok").select("kind", "value", "made")
        accepted = good if accepted is None else cut(accepted.unionByName(good))
        if attempt:
            late = late.unionByName(good)
        todo = marked.where("not ok").select("kind", "value")
        if todo.isEmpty():
            return late
    raise RuntimeError(f"no free replacement after {ATTEMPTS} attempts")


def replace_entities(docs: DataFrame, key: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with personal data replaced, ``n_entities`` and sorted distinct ``kinds``.

    Kinds: email, phone, ip, ip6, card, iban, ssn, key, secret, and names after forms of
    address (given names and surnames apart, up to three; initials and particles stay).  All other places of the same text that
    have one of these names as a whole word, before or after, get the same replacement.
    Persons whom a text never names with a form of address are not found.
    Replacements keep separators, lengths, check digits, script, capitals and gender.

    Null texts stay null with 0 entities, empty ones empty.  Repeated rows and other
    columns stay (columns with the added names are replaced); an empty table stays
    empty.  The same key gives the same replacements as long as the corpus does not
    come to hold one of them as a value of its own.
    """
    added = ("n_entities", "kinds")
    kept = others(docs.columns, added)
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    late = cut(exceptions(cut(found_entities(docs, text)), key))
    schema = StructType(
        [
            *[StructField(f.name, StringType()) if f.name == text else f for f in source.schema.fields],
            StructField("n_entities", LongType()),
            StructField("kinds", ArrayType(StringType())),
        ]
    )
    if measure(late).fits():
        table = {(r["kind"], r["value"]): r["made"] for r in late.collect()}
        return source.mapInArrow(trimmed(_rewrite(docs.sparkSession.sparkContext.broadcast(table), key, kept, text, None)), schema)

    # Too many to broadcast: each text gets the exceptions among its own entities.
    row = F.xxhash64(F.col(f"`{text}`"))
    slim = docs.select(row.alias("_row"), F.col(f"`{text}`").cast("string").alias("text")).distinct()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (r, e.kind, e.value)
                for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for e in {(e.kind, e.value): e for e in detect(t or "")}.values()
            ]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "kind", "value"])

    mine = slim.mapInArrow(trimmed(own), "_row long, kind string, value string").join(late, ["kind", "value"])
    packed = mine.groupBy("_row").agg(F.collect_set(F.struct("kind", "value", "made")).alias("_late"))
    key_name, late_name = unused(kept, "_row"), unused(kept, "_late")
    packed = packed.select(F.col("_row").alias(key_name), F.col("_late").alias(late_name))
    joined = source.withColumn(key_name, row).join(packed, key_name, "left").select(*[F.col(f"`{c}`") for c in kept], late_name)
    return joined.mapInArrow(trimmed(_rewrite(None, key, kept, text, len(kept))), schema)


def _rewrite(shared, key: bytes, kept: list[str], text: str, own: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Surrogates(key)
        table = shared.value if shared is not None else {}
        at = kept.index(text)
        for batch in batches:
            lates = batch.column(own).to_pylist() if own is not None else None
            texts, counts, kinds = [], [], []
            for i, t in enumerate(batch.column(at).to_pylist()):
                found = detect(t) if t else []
                if lates is not None:
                    table = {(x["kind"], x["value"]): x["made"] for x in lates[i] or []}
                if found:
                    out, done = [], 0
                    for e in found:
                        made = table.get((e.kind, e.value)) or maker.replacement(e.kind, e.value)
                        out += [t[done : e.start], written_like(t[e.start : e.end], made, e.kind)]
                        done = e.end
                    t = "".join([*out, t[done:]])
                texts.append(t)
                counts.append(len(found))
                kinds.append(sorted({e.kind for e in found}))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(kept))]
            columns += [pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_entities", "kinds"])

    return run
