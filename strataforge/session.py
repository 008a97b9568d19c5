"""Session, checkpoint folder and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import AtomicType

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strataforge")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a fresh
    temporary folder.  On a cluster a machine-local folder would be invisible
    to the other executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="strataforge-")
    return _LOCAL_ROOTS[app]


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the copy.

    Used where a plan is read more than once and must give the same rows each
    time (range slices), and to keep iterative plans short.  The copy outlives
    lost executors.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


#: Rows of a partition of a spread table, and partitions at least.
SPREAD_ROWS, SPREAD_PARTS = 1_000_000, 8


def spread(df: DataFrame) -> DataFrame:
    """``cut`` for tables that many later passes train on or multiply (rows x candidates).

    Rows are placed and ordered by their values, in a number of partitions that only
    depends on the number of rows.  Spark ML draws its samples per partition, so what
    is fitted does not depend on the cluster or on where rows came from.
    """
    keys = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    rows = df.count()
    parts = max(SPREAD_PARTS, -(-rows // SPREAD_ROWS))
    return cut(df.repartition(parts, *[F.col(f"`{k}`") for k in keys]).sortWithinPartitions(*[F.col(f"`{k}`") for k in keys]))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
