"""Models of this library on shared storage: a one-row description with a kind and a version, and slot tables beside it."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import SparkSession

from strataforge.operators.factors import FactorModel, FactorParams
from strataforge.operators.ftrl import FtrlModel, FtrlParams
from strataforge.operators.networks import Network
from strataforge.operators.stumps import BaggedStumps, BoostedStumps

VERSION = 1


def write_about(spark: SparkSession, path: str, kind: str, content: dict) -> None:
    row = (kind, VERSION, json.dumps(content))
    spark.createDataFrame([row], "kind string, version int, content string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def read_about(spark: SparkSession, path: str, kind: str) -> dict:
    row = spark.read.parquet(f"{path}/about").first()
    if (row["kind"], row["version"]) != (kind, VERSION):
        raise ValueError(f"{path} holds {row['kind']} of version {row['version']}, not {kind} of version {VERSION}")
    return json.loads(row["content"])


def _stumps_out(m: BoostedStumps) -> dict:
    return {
        "features": m.features, "edges": m.edges, "scores": [np.asarray(s, dtype=float).tolist() for s in m.scores],
        "scale": m.scale, "rounds": m.rounds, "history": m.history,
    }


def _stumps_in(d: dict) -> BoostedStumps:
    return BoostedStumps(
        d["features"], d["edges"], [np.array(s, dtype=float) for s in d["scores"]], d["scale"], d["rounds"], [tuple(h) for h in d["history"]]
    )


def save_stumps(model: BoostedStumps | BaggedStumps, spark: SparkSession, path: str) -> None:
    members = model.members if isinstance(model, BaggedStumps) else [model]
    write_about(spark, path, type(model).__name__, {"members": [_stumps_out(m) for m in members]})


def load_stumps(spark: SparkSession, path: str, kind: type = BoostedStumps) -> BoostedStumps | BaggedStumps:
    members = [_stumps_in(d) for d in read_about(spark, path, kind.__name__)["members"]]
    return BaggedStumps(members) if kind is BaggedStumps else members[0]


def _save_slots(model: FtrlModel | FactorModel, spark: SparkSession, path: str, kind: str) -> None:
    model.table.write.mode("overwrite").parquet(f"{path}/slots")
    write_about(spark, path, kind, {"bias": list(model.bias), "params": vars(model.params)})


def save_ftrl(model: FtrlModel, spark: SparkSession, path: str) -> None:
    _save_slots(model, spark, path, "ftrl")


def load_ftrl(spark: SparkSession, path: str) -> FtrlModel:
    about = read_about(spark, path, "ftrl")
    return FtrlModel(spark.read.parquet(f"{path}/slots"), tuple(about["bias"]), FtrlParams(**about["params"]))


def save_factors(model: FactorModel, spark: SparkSession, path: str) -> None:
    _save_slots(model, spark, path, "factors")


def load_factors(spark: SparkSession, path: str) -> FactorModel:
    about = read_about(spark, path, "factors")
    return FactorModel(spark.read.parquet(f"{path}/slots"), tuple(about["bias"]), FactorParams(**about["params"]))


def save_network(model: Network, spark: SparkSession, path: str) -> None:
    weights = spark.createDataFrame([(model.flat.astype("<f8").tobytes(),)], "weights binary")
    weights.coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    write_about(spark, path, "network", {"features": model.features, "sizes": model.sizes, "history": model.history})


def load_network(spark: SparkSession, path: str) -> Network:
    about = read_about(spark, path, "network")
    flat = np.frombuffer(bytes(spark.read.parquet(f"{path}/weights").first()["weights"]), dtype="<f8")
    return Network(about["features"], about["sizes"], flat, [tuple(h) for h in about["history"]])
