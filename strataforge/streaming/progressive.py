"""Predict-then-update over a stream, with the mean loss so far.

Each micro-batch is scored with the weights of the batch before it, and then
updates them.  A batch writes the slots that it touched and its progress under
its id, so a batch that is run again reads the same input version and writes the
same output.  Every COMPACT batches the changes are folded into a whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from strataforge.operators.ftrl import WEIGHT_SCHEMA, FtrlModel, FtrlParams, empty_model, update
from strataforge.session import cut
from strataforge.sources.store import remove_path

#: Batches between two whole tables: a read takes one of these and fewer changes than this.
COMPACT = 16
PROGRESS_SCHEMA = "batch_id long, n_rows long, loss double, total_rows long, total_loss double"


class ProgressiveLearner:
    """State folder plus the step that a micro-batch runs."""

    def __init__(self, spark: SparkSession, root: str, params: FtrlParams = FtrlParams(), compact: int = COMPACT):
        self.spark, self.root, self.params, self.compact = spark, root.rstrip("/"), params, compact

    def _base(self, batch_id: int) -> int:
        """The last batch up to this one after which a whole table was written; -1 before the first."""
        return (batch_id + 1) // self.compact * self.compact - 1

    def model_after(self, batch_id: int, spark: SparkSession | None = None) -> FtrlModel:
        """Of every slot the latest numbers: the last whole table and the changes since then."""
        spark = spark or self.spark
        if batch_id < 0:
            return empty_model(spark, self.params)
        base = self._base(batch_id)
        paths = [(b, f"{self.root}/changes/{b}") for b in range(base + 1, batch_id + 1)]
        if base >= 0:
            paths.insert(0, (base, f"{self.root}/whole/{base}"))
        parts = [spark.read.schema(WEIGHT_SCHEMA).parquet(path).withColumn("_at", F.lit(b)) for b, path in paths]
        rows = reduce(DataFrame.unionByName, parts)
        latest = rows.groupBy("slot").agg(F.max_by(F.struct("z", "n"), "_at").alias("_last")).select("slot", "_last.z", "_last.n")
        table = latest if len(parts) > 1 else rows.drop("_at")
        bias = table.where("slot = 0").first()
        return FtrlModel(table.where("slot <> 0"), (bias["z"], bias["n"]), self.params)

    def totals_after(self, batch_id: int) -> tuple[int, float]:
        if batch_id < 0:
            return 0, 0.0
        row = self.spark.read.parquet(f"{self.root}/progress/{batch_id}").first()
        return row["total_rows"], row["total_loss"]

    def step(self, batch: DataFrame, batch_id: int, row_id: str, label: str, indices: str) -> None:
        spark = batch.sparkSession
        before = self.model_after(batch_id - 1, spark)
        needed = batch.select(F.explode(indices).alias("slot")).distinct()
        mine = FtrlModel(cut(before.table.join(needed, "slot", "left_semi")), before.bias, self.params)
        model, loss, rows = update(batch, mine, row_id, label, indices, touched=True)
        seen, total = self.totals_after(batch_id - 1)
        z, n = model.bias
        bias = spark.createDataFrame([(0, float(z), float(n))], WEIGHT_SCHEMA)
        model.table.unionByName(bias).write.mode("overwrite").parquet(f"{self.root}/changes/{batch_id}")
        row = (batch_id, rows, float(loss), seen + rows, float(total + loss))
        spark.createDataFrame([row], PROGRESS_SCHEMA).write.mode("overwrite").parquet(
            f"{self.root}/progress/{batch_id}"
        )
        if self._base(batch_id) == batch_id:
            untouched = before.table.join(model.table, "slot", "left_anti")
            whole = untouched.unionByName(model.table).unionByName(bias)
            whole.write.mode("overwrite").parquet(f"{self.root}/whole/{batch_id}")
        if batch_id and self._base(batch_id - 1) == batch_id - 1:
            # The whole table before this batch has served: what it was made of may go.
            old = batch_id - 1
            for b in range(old - self.compact + 1, old + 1):
                remove_path(spark, f"{self.root}/changes/{b}")
            remove_path(spark, f"{self.root}/whole/{old - self.compact}")

    def progress(self) -> DataFrame:
        """One row per batch with the mean loss over all rows so far."""
        rows = self.spark.read.schema(PROGRESS_SCHEMA).parquet(f"{self.root}/progress/*")
        return rows.select(
            "batch_id", "n_rows", (F.col("loss") / F.col("n_rows")).alias("batch_loss"),
            (F.col("total_loss") / F.col("total_rows")).alias("mean_loss"),
        )


def start(
    stream: DataFrame, learner: ProgressiveLearner, prepare: Callable[[DataFrame], DataFrame],
    row_id: str = "id", label: str = "y", indices: str = "indices", available_now: bool = True,
) -> StreamingQuery:
    """Run the learner over a stream of raw rows; ``prepare`` adds label and slots."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        learner.step(prepare(batch), batch_id, row_id, label, indices)

    writer = stream.writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", f"{learner.root}/offsets"
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
