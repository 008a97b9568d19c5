"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strataforge.operators.encode import level_counts
from strataforge.operators.models import class_one
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import with_base, with_scores
from strataforge.plans.registry import query
from strataforge.plans.score_and_stack import write_scores
from strataforge.session import cut, fresh_path
from strataforge.sources import delimited, sinks, sparse_text, store

BASE_SCHEMA = "id long, y int, prio string, state1 string, state2 string, n1 double, n4 double"


def _narrow(spark, sf):
    return fx.base(spark, sf).select("id", "y", "prio", "state1", "state2", "n1", "n4")


def _as_csv(spark, df, label, sep=","):
    path = fresh_path(spark, label)
    sinks.write_table(df, path, "csv", sep)
    return path


def _model(spark, sf, model):
    return fx.scores_wide(spark, sf).select(F.col("id").alias("ID"), F.col(model).alias("target"))


@query("s1_scan_csv", with_base("select id, y, prio, state1, state2, n1, n4 from base"))
def s1(spark, sf):
    path = _as_csv(spark, _narrow(spark, sf), "scan")
    return delimited.read_table(spark, path, BASE_SCHEMA)


@query(
    "s2_scan_rows_as_text",
    with_base("select cast(id as varchar) as id, cast(y as varchar) as y, prio, state1 from base"),
)
def s2(spark, sf):
    path = _as_csv(spark, _narrow(spark, sf).select("id", "y", "prio", "state1"), "text")
    return delimited.read_text_rows(spark, path)


@query("s3_scan_pruned", with_base("select id from base"))
def s3(spark, sf):
    path = _as_csv(spark, _narrow(spark, sf), "pruned")
    return delimited.read_columns(spark, path, ["id"], BASE_SCHEMA)


@query("s4_scan_headerless", with_scores("select round(m1, 6) as score, count(*) as n from wide group by 1"))
def s4(spark, sf):
    path = fresh_path(spark, "headerless")
    fx.scores_wide(spark, sf).select("m1").write.csv(path)
    return (
        delimited.read_headerless(spark, path)
        .groupBy(F.round("V1", 6).alias("score"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "s5_scan_delimited",
    with_scores("select y as click, round(m1, 6) as m1, round(m2, 6) as m2, round(m3, 6) as m3 from wide"),
)
def s5(spark, sf):
    table = fx.scores_wide(spark, sf).select("id", F.col("y").alias("click"), "m1", "m2", "m3")
    path = _as_csv(spark, table, "block", " ")
    schema = "id long, click int, m1 double, m2 double, m3 double"
    block = delimited.read_score_block(spark, path, "click", 2, schema)
    return block.select("click", *[F.round(m, 6).alias(m) for m in ("m1", "m2", "m3")])


@query(
    "s6_scan_libsvm",
    with_base(
        """select cast(y as double) as label,
             cast(1 + (zip <> 0)::int + (n1 is not null)::int as bigint) as filled,
             count(*) as n, cast(sum(fold10) as bigint) as sum_fold from base group by 1, 2"""
    ),
)
def s6(spark, sf):
    path = fresh_path(spark, "libsvm")
    lines = sparse_text.libsvm_lines(fx.base(spark, sf), "y", ["fold10", "zip", "n1"])
    sparse_text.write_lines(lines, path)
    rows = sparse_text.read_libsvm(spark, path, 3, parts=12).select(
        "label", vector_to_array("features").alias("x")
    )
    return rows.groupBy("label", F.size(F.filter("x", lambda v: v != 0)).cast("long").alias("filled")).agg(
        F.count("*").alias("n"), F.sum(F.col("x")[0]).cast("long").alias("sum_fold")
    )


@query("s7_scan_glob_models", with_scores("select model, id as \"ID\", round(score, 6) as target from scores"))
def s7(spark, sf):
    root = fresh_path(spark, "models")
    long = cut(fx.scores(spark, sf))
    for m in fx.SCORE_MODELS:
        write_scores(long.where(F.col("model") == m), root, "predValid_", m)
    read = delimited.read_scores(spark, root, "predValid_")
    return read.select("model", "ID", F.round("target", 6).alias("target"))


@query("s8_sink_csv", with_base("select id, state2, n1 from base"))
def s8(spark, sf):
    path = _as_csv(spark, _narrow(spark, sf).select("id", "state2", "n1"), "sink", "\t")
    return delimited.read_table(spark, path, "id long, state2 string, n1 double", "\t")


@query("s9_sink_submission", with_scores("select id as \"ID\", round(m2, 6) as target from wide where id % 5 = 0"))
def s9(spark, sf):
    path = fresh_path(spark, "submission")
    ids = fx.base(spark, sf).where("split = 'test'").select(F.col("id").alias("ID"))
    sinks.write_submission(ids, _model(spark, sf, "m2"), path)
    read = delimited.read_table(spark, path, "ID long, target double")
    return read.select("ID", F.round("target", 6).alias("target"))


FAMILIES = {"f": ["st"], "a": ["prio"], "l": ["state1", "state2", "city"], "j": ["lvl"], "t": []}


@query(
    "s10_sink_vw",
    with_base(
        """select concat(cast(case when split = 'train' then 2 * y - 1 else 1 end as varchar), ' ''',
             cast(id as varchar), ' |r fold10:', cast(fold10 as varchar), ' zip:', cast(zip as varchar),
             ' |f st_', st, ' |a prio_', prio, ' |l state1_', state1, ' state2_', state2, ' city_', city,
             ' |j lvl_', lvl, ' |t') as value from base"""
    ),
)
def s10(spark, sf):
    path = fresh_path(spark, "namespaced")
    rows = fx.base(spark, sf).withColumn("target", F.when(F.col("split") == "train", F.col("y")))
    lines = sparse_text.namespaced_rows(rows, "id", FAMILIES, ["fold10", "zip"], "target")
    sparse_text.write_lines(lines, path)
    return spark.read.text(path)


@query(
    "s11_materialize",
    with_base(
        """select 'prio' as var, prio as level, count(*) as n from base group by prio
           union all select 'city', city, count(*) from base group by city"""
    ),
)
def s11(spark, sf):
    return store.materialize(level_counts(fx.base(spark, sf), ["prio", "city"]), "levels").select(
        "var", "level", "n"
    )


@query("s12_model_io", with_base("select count(*) as n_rows, count(*) as n_same from base"))
def s12(spark, sf):
    rows = fx.base(spark, sf).withColumn("prio_no", F.substring("prio", 1, 1).cast("double"))
    stages = [
        VectorAssembler(inputCols=["prio_no", "zip", "n2"], outputCol="features"),
        DecisionTreeClassifier(labelCol="y", maxDepth=4, seed=1),
    ]
    model = Pipeline(stages=stages).fit(rows)
    path = fresh_path(spark, "model")
    store.save_model(model, path)
    again = store.load_model(path, PipelineModel)
    first = model.transform(rows).select("id", class_one().alias("a"))
    second = again.transform(rows).select("id", class_one().alias("b"))
    return first.join(second, "id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_same")
    )


@query(
    "s13_versioned_path",
    with_scores(
        """select 'v9r5' as version, model as config, 10 as seed, count(*) as n,
             strftime(current_date, '%Y%m%d') as run_date from scores group by model"""
    ),
)
def s13(spark, sf):
    path = fresh_path(spark, "versions")
    long = cut(fx.scores(spark, sf))
    for m in fx.SCORE_MODELS:
        sinks.write_versioned(long.where(F.col("model") == m).select("id", "score"), path, "v9_r5", 10, m)
    return (
        spark.read.parquet(path)
        .groupBy("version", "config", "seed", F.col("run_date").cast("string").alias("run_date"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "s14_split_outputs",
    with_base(
        """select part, count(*) as n, cast(sum(id) as bigint) as sum_id, cast(sum(y) as bigint) as sum_y
           from (select part, id, case when part <> 'test' then y end as y from parts
                 union all select 'full', id, y from parts where part <> 'test') group by part""",
        """parts as (select id, y, case when split = 'test' then 'test' when fold10 = 1 then 'valid'
             else 'train' end as part from base)""",
    ),
)
def s14(spark, sf):
    path = fresh_path(spark, "splits")
    rows = fx.base(spark, sf)
    train = rows.where("split = 'train'").select("id", "y", (F.col("fold10") == 1).cast("int").alias("valid"))
    sinks.write_splits(train, rows.where("split = 'test'").select("id"), path)
    out = None
    for part in ("full", "valid", "train", "test"):
        piece = sinks.read_split(spark, path, part).agg(
            F.count("*").alias("n"), F.sum("id").alias("sum_id"), F.sum("y").alias("sum_y")
        )
        piece = piece.select(F.lit(part).alias("part"), "n", "sum_id", "sum_y")
        out = piece if out is None else out.unionByName(piece)
    return out


@query("s15_sink_into_template", with_scores("select id as \"ID\", round(m3, 6) as target from wide"))
def s15(spark, sf):
    filled = sinks.fill_template(_model(spark, sf, "m1"), _model(spark, sf, "m3"))
    path = _as_csv(spark, filled, "template")
    read = delimited.read_table(spark, path, "ID long, target double")
    return read.select("ID", F.round("target", 6).alias("target"))
