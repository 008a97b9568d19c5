"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

Everything runs as DataFrame expressions and Spark ML on the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from strataforge.functions.lookup import lookup
from strataforge.llm.line_dedup import lower_ascii
from strataforge.llm.naming import others
from strataforge.session import cut

#: Labelled rows that the trees are fitted on, half of each verdict at most.
FIT_ROWS = 20_000
ROUNDS, DEPTH, SEED = 10, 4, 17
#: Weight of the overall rate in a suffix's block rate.
PRIOR_ROWS = 20

FEATURES = ["length", "depth", "digit_ratio", "entropy", "n_params", "host_labels", "suffix_length", "suffix_rate"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def _rule_parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does.

    One condition per rule, so meant for lists of up to some hundreds.
    """

    def fits(rule: str) -> Column:
        h, p = _rule_parts(rule)
        return ((host == h) | host.endswith("." + h)) & path.startswith(p)

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    chain = lambda value: F.coalesce(*[F.when(fits(r), F.lit(value(v, r))) for v, r in ordered])
    return chain(lambda v, r: r), chain(lambda v, r: v)


def _entropy(url: Column) -> Column:
    """Bits per character."""
    n = F.length(url)
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    bits = lambda acc, c: acc - share(c) * F.log2(share(c))
    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), bits)).otherwise(0.0)


def _lexical(df: DataFrame) -> DataFrame:
    url = F.col("_url")
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    asked = F.when(F.locate("?", url) > 0, F.substring_index(F.substring(url, F.locate("?", url) + 1, F.length(url)), "#", 1))
    return df.select(
        "*",
        F.length(url).cast("double").alias("length"),
        count(F.col("host_path"), "/").cast("double").alias("depth"),
        F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0).alias("digit_ratio"),
        _entropy(url).alias("entropy"),
        F.coalesce(F.when(F.length(asked) > 0, count(asked, "&") + 1), F.lit(0)).cast("double").alias("n_params"),
        F.when(F.length("_host") > 0, count(F.col("_host"), ".") + 1).otherwise(0).cast("double").alias("host_labels"),
        F.substring_index("_host", ".", -1).alias("suffix"),
    )


def url_filter(
    pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = "allow", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null where none fits), ``verdict`` and ``block_score``.

    URLs that a rule fits are the labelled ones.  The trees learn from at most
    ``fit_rows`` of them, chosen by a hash of the URL, and judge all URLs without a
    rule.  Counts and block rates of suffixes are taken over all rows.

    Null URLs and URLs without ``://`` have an empty host and path.  Without labelled
    rows of both verdicts there is nothing to learn: the rest gets ``default``.
    Repeated rows and other columns stay (columns with the added names are replaced);
    an empty table stays empty.
    """
    added = ("host", "path", "rule", "verdict", "block_score")
    kept = others(pages.columns, added)
    source = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in")
    host, path = host_and_path(F.col("_url"))
    parsed = pages.select(source, F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("_url")).select(
        "*", host.alias("_host"), path.alias("_path")
    )
    rule, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    ruled = parsed.select("*", rule.alias("_rule"), verdict.alias("_ruled"), F.col("_path").alias("host_path"))

    blocked = F.when(F.col("_ruled") == "block", 1.0).when(F.col("_ruled").isNotNull(), 0.0)
    suffixes = cut(
        ruled.groupBy(F.substring_index("_host", ".", -1).alias("suffix")).agg(
            F.count("*").alias("n"), F.count("_ruled").alias("labelled"), F.coalesce(F.sum(blocked), F.lit(0.0)).alias("blocked")
        )
    )
    total = suffixes.agg(F.sum("labelled"), F.sum("blocked")).first()
    labelled, bad = (total[0] or 0), (total[1] or 0.0)
    if not 0 < bad < labelled:
        return _result(ruled, kept, F.lit(default), F.lit(None).cast("double"))
    rate = bad / labelled
    table = suffixes.select(
        "suffix",
        F.length("suffix").cast("double").alias("suffix_length"),
        ((F.col("blocked") + PRIOR_ROWS * rate) / (F.col("labelled") + PRIOR_ROWS)).alias("suffix_rate"),
        "n",
    )

    def with_features(df: DataFrame) -> DataFrame:
        return lookup(_lexical(df), table, ["suffix"], weight="n")

    # Labelled URLs with the smallest hashes, as many of each verdict.
    order = F.xxhash64("_url")
    slim = ruled.select("_url", "_host", "host_path", "_ruled", order.alias("_order"))
    halves = [
        slim.where(F.col("_ruled") == v).orderBy("_order", "_url").limit(fit_rows // 2) for v in ("allow", "block")
    ]
    # Half of the rows are learnt from as if their suffix had no labels, as most unlabelled URLs will be.
    unknown = F.when(F.pmod("_order", F.lit(2)) == 0, F.lit(rate)).otherwise(F.col("suffix_rate"))
    chosen = with_features(reduce(DataFrame.unionByName, halves)).withColumn("suffix_rate", unknown)
    fit = cut(chosen.select(*FEATURES, blocked.alias("label")))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    model = trees.fit(assembler.transform(fit))
    judged = model.transform(assembler.transform(with_features(ruled)))
    score = vector_to_array("probability")[1]
    return _result(judged, kept, F.when(F.col("prediction") > 0.5, "block").otherwise("allow"), score)


def _result(df: DataFrame, kept: list[str], rest: Column, score: Column) -> DataFrame:
    return df.select(
        *[F.col(f"_in.`{c}`").alias(c) for c in kept],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_ruled", rest).alias("verdict"),
        score.alias("block_score"),
    )
