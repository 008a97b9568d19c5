"""The worked example tables that the registered queries run on.

They are derived by Spark from the given tables (orders, customer, nation), in
full, with planted signal; ``plans/fixture_sql.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataforge.functions.hashing import md5_bucket
from strataforge.session import cut

SCORE_MODELS = {"m1": (20, 100), "m2": (40, 100), "m3": (60, 200), "m4": (0, 50)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; a scan of a single split is dealt by the table's first column, so that later stages are not one task."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(8, rows.columns[0]) if rows.rdd.getNumPartitions() == 1 else rows


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    chance = 10 + 10 * F.substring("o_orderpriority", 1, 1).cast("int") + cust % 20
    state2 = (
        F.when(cust % 9 == 0, F.lit(""))
        .when(cust % 3 == 0, F.col("n_name"))
        .otherwise(F.concat(F.lit("S"), (cust % 25).cast("string")))
    )
    rows = orders.join(customer, cust == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        key.alias("id"),
        (md5_bucket("y", key) % 100 < chance).cast("int").alias("y"),
        (md5_bucket("f", key) % 10 + 1).cast("int").alias("fold10"),
        F.when(key % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("o_orderpriority").alias("prio"),
        F.col("o_orderstatus").alias("st"),
        F.col("n_name").alias("state1"),
        state2.alias("state2"),
        F.concat(F.lit("city"), F.floor(F.sqrt(cust)).cast("int").cast("string")).alias("city"),
        F.concat(F.col("o_orderpriority"), F.lit("_"), (cust % 20).cast("string")).alias("lvl"),
        F.when(key % 7 != 0, price).alias("n1"),
        (price * 2 + 1).alias("n2"),
        (-price).alias("n3"),
        F.col("c_acctbal").alias("n4"),
        (price + F.col("c_acctbal")).alias("n5"),
        F.lit(7).alias("n6"),
        F.lit(None).cast("double").alias("n7"),
        (price * 2 + 1).alias("n8"),
        F.lit(1.0).alias("k"),
        (cust % 1000).cast("int").alias("zip"),
    )


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")

    def text(d):
        return F.concat(F.upper(F.date_format(d, "ddMMMyy")), F.lit(":00:00:00"))

    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.when(key % 4 == 0, F.lit("")).otherwise(text(day)).alias("d1"),
        F.when(key % 6 != 0, text(F.date_add(day, 400))).alias("d2"),
        F.when(key % 2 == 0, text(day)).otherwise(F.lit("")).alias("d3"),
        F.when(key % 3 == 0, F.lit("xx")).otherwise(text(F.date_sub(day, 9500))).alias("d4"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long (id, model, score, y)."""
    rows = base(spark, sf_dir).select("id", "y")
    cells = []
    for model, (a, m) in SCORE_MODELS.items():
        raw = F.lit(a) * F.col("y") + md5_bucket(model, F.col("id")) % m
        cells.append(
            F.struct(
                F.lit(model).alias("model"),
                (raw.cast("double") / F.lit(float(a + m))).alias("score"),
            )
        )
    return rows.select("id", "y", F.inline(F.array(*cells)))


def scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base(spark, sf_dir).select("id", "y")
    return rows.select(
        "id",
        "y",
        *[
            (
                (F.lit(a) * F.col("y") + md5_bucket(model, F.col("id")) % m).cast("double")
                / F.lit(float(a + m))
            ).alias(model)
            for model, (a, m) in SCORE_MODELS.items()
        ],
    )


def contest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw train and test tables under the contest's column names, and (ID, fold10)."""
    b, d = base(spark, sf_dir), dates(spark, sf_dir)
    rows = b.join(d, "id").select(
        F.col("id").alias("ID"),
        F.col("y").alias("target"),
        "split",
        "fold10",
        F.when(F.col("zip") % 2 == 0, F.lit("true")).when(F.col("zip") % 5 == 0, F.lit("")).otherwise("false").alias("VAR_0008"),
        F.col("prio").alias("VAR_0005"),
        F.col("st").alias("VAR_0467"),
        F.col("d1").alias("VAR_0073"),
        F.col("d2").alias("VAR_0075"),
        F.col("state1").alias("VAR_0237"),
        F.col("state2").alias("VAR_0274"),
        F.col("city").alias("VAR_0200"),
        F.when(F.col("zip") % 7 != 0, F.concat(F.lit("job"), (F.col("zip") % 4).cast("string"))).otherwise("-1").alias("VAR_0404"),
        F.when(F.col("zip") % 3 != 0, F.concat(F.lit("job"), (F.col("zip") % 6).cast("string"))).otherwise("").alias("VAR_0493"),
        F.when(F.col("id") % 11 != 0, F.col("zip") * 1000.0).alias("VAR_0212"),
        (F.col("zip") % 50).alias("VAR_0241"),
        *[F.col(f"n{i}").alias(f"VAR_100{i}") for i in range(1, 9)],
        (10.0 * F.substring("prio", 1, 1).cast("int") + F.col("zip") % 20).alias("VAR_1009"),
        (20.0 * F.substring("prio", 1, 1).cast("int") + 2 * (F.col("zip") % 20) + F.col("fold10")).alias("VAR_1010"),
    )
    rows = cut(rows)  # the raw tables are files, read many times by a build
    train = rows.where("split = 'train'").drop("split", "fold10")
    test = rows.where("split = 'test'").drop("split", "fold10", "target")
    return train, test, rows.where("split = 'train'").select("ID", "fold10")
