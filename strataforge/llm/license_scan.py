"""License scan: signature rules behind a keyword gate, with DataFrame functions only.

A text is read as words.  Texts without any keyword stop there.  For the others rules
are looked up by their longest word, and only those all of whose words occur are tried.  Detections that lie inside another one are
suppressed: the longer one stays, of equal ones that with the higher priority.
Nothing is shuffled; all work on a text is done in its row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.llm.license_rules import anchor, rules
from strataforge.llm.line_dedup import lower_ascii
from strataforge.llm.naming import others

#: Words: runs of letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_RULE = "array<struct<label:string,pattern:string,priority:int,confidence:double,words:array<string>>>"


def _constant(values: list | dict, schema: str) -> Column:
    """One literal instead of an expression per entry; it is folded when the plan is made."""
    return F.from_json(F.lit(json.dumps(values)), schema)


def phrase_starts(words: Column, phrase: list[str]) -> Column:
    """Word numbers at which the phrase's words stand consecutively; empty where it can't."""
    last = F.size(words) - len(phrase)

    def here(i: Column) -> Column:
        found = F.get(words, i) == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            found = found & (F.get(words, i + k) == w)
        return found

    none = F.array().cast("array<int>")
    all_there = F.lit(True)
    for w in dict.fromkeys(phrase):
        all_there = all_there & F.array_contains(words, w)
    return F.when((last >= 0) & all_there, F.filter(F.sequence(F.lit(0), last), here)).otherwise(none)


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _matches(spaced: Column, rule: Column) -> Column:
    """Detections of one rule: the pieces between matches say how many words come before."""
    both = F.arrays_zip(
        F.split(spaced, rule["pattern"], -1).alias("before"),
        F.regexp_extract_all(spaced, rule["pattern"], F.lit(0)).alias("match"),
    )
    found = F.filter(both, lambda x: x["match"].isNotNull())
    empty = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,priority:int,label:string,confidence:double>>").alias("all"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + _spaces(x["before"])
        end = start + _spaces(x["match"])
        one = F.struct(
            start.alias("start"), end.alias("end"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence"),
        )
        return F.struct(end.alias("at"), F.concat(acc["all"], F.array(one)).alias("all"))

    return F.aggregate(found, empty, step, lambda acc: acc["all"])


def _suppress(detections: Column) -> Column:
    """Sorted so that a containing or stronger detection comes first, one look at the furthest end so far decides."""
    ordered = F.array_sort(
        F.transform(
            detections,
            lambda d: F.struct(
                d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("weak"),
                d["label"].alias("label"), d["confidence"].alias("confidence"),
            ),
        )
    )
    empty = F.struct(
        F.lit(-1).alias("far"), F.array().cast("array<struct<start:int,end:int,label:string,confidence:double>>").alias("all")
    )

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        one = F.struct(d["start"].alias("start"), end.alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence"))
        stays = end > acc["far"]
        return F.struct(
            F.greatest(acc["far"], end).alias("far"),
            F.when(stays, F.concat(acc["all"], F.array(one))).otherwise(acc["all"]).alias("all"),
        )

    return F.aggregate(ordered, empty, step, lambda acc: acc["all"])


def _labelled(words: Column, found: Column, phrase: list[str], label: str) -> Column:
    gate = F.size(found) >= len(set(phrase))
    starts = F.when(gate, phrase_starts(words, phrase)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def license_scan(docs: DataFrame, phrases: dict[str, str], text: str = "text") -> DataFrame:
    """Add what the scan finds in every whole text.

    ``phrases`` maps phrases (words in lower case) to labels; all their places count,
    whatever the rules say.  Columns added, replacing columns of these names:
    ``n_words``; ``places`` array of (start, label) of the phrases by start;
    ``detections`` array of (start, end, label, confidence) of the rules, words
    counted from 0, end exclusive; ``labels`` sorted, of both; ``score`` 0 to 1, the
    highest confidence, 0.5 for phrases alone and 0 for nothing.

    Null and empty texts have no words.  Rows are independent: repeated ones repeat,
    other columns stay, an empty table stays empty.
    """
    table = rules()
    by_anchor: dict[str, list[dict]] = {}
    for r in table:
        by_anchor.setdefault(anchor(r), []).append(r)
    keywords = sorted({w for r in table for w in r["words"]} | {w for p in phrases for w in p.split()})
    added = ("n_words", "places", "detections", "labels", "score")
    kept = others(docs.columns, added)
    worded = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in"),
        F.regexp_extract_all(lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(WORD), F.lit(0)).alias("_words"),
    )
    # The gate: which keywords occur at all.
    gated = worded.select("*", F.array_intersect("_words", F.lit(keywords)).alias("_found"))
    looked_up = _constant(by_anchor, f"map<string,{_RULE}>")
    near = F.flatten(F.transform(F.array_intersect("_found", F.lit(sorted(by_anchor))), lambda a: F.element_at(looked_up, a)))
    tried = F.filter(near, lambda r: F.forall(r["words"], lambda w: F.array_contains("_found", w)))
    no_rules = F.array().cast(_RULE)
    chosen = gated.select(
        "*",
        F.when(F.size("_found") > 0, tried).otherwise(no_rules).alias("_rules"),
        F.array_sort(
            F.concat(
                F.array().cast("array<struct<start:int,label:string>>"),
                *[_labelled(F.col("_words"), F.col("_found"), p.split(), label) for p, label in phrases.items()],
            )
        ).alias("places"),
    )
    spaced = F.when(F.size("_rules") > 0, F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")))
    joined = chosen.select("*", spaced.alias("_spaced"))
    raw = F.flatten(F.transform("_rules", lambda r: _matches(F.col("_spaced"), r)))
    detected = joined.select(
        "_in",
        F.size("_words").cast("long").alias("n_words"),
        "places",
        _suppress(raw).alias("detections"),
    )
    names = F.array_union(
        F.transform("places", lambda x: x["label"]), F.transform("detections", lambda x: x["label"])
    )
    best = F.array_max(F.transform("detections", lambda x: x["confidence"]))
    return detected.select(
        *[F.col(f"_in.`{c}`").alias(c) for c in kept],
        "n_words",
        "places",
        "detections",
        F.array_sort(F.array_distinct(names)).alias("labels"),
        F.coalesce(best, F.when(F.size("places") > 0, 0.5), F.lit(0.0)).alias("score"),
    )
