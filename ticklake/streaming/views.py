"""Dashboard values that follow a stream: keyed aggregates in the state store, kept as a stored view.

The aggregate is Spark's own, in update mode: its state per symbol is a fixed number of values in the
RocksDB store, so a micro-batch costs what its own symbols cost, and emits those symbols' rows.
``KeyedView`` keeps the emitted rows in runs (see ``runs``); a symbol's row is that of the latest batch
that has one, and merging runs drops the others, so the view stays as large as its symbols.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ticklake.functions import indicators
from ticklake.operators import stats
from ticklake.plans import dashboard
from ticklake.streaming import runs
from ticklake.streaming.jobs import Trigger, started

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class KeyedView:
    """A table with one row per key, from batches of changed rows; a batch that comes again changes nothing."""

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str], fan: int = runs.FAN) -> None:
        self.path, self.keys, self.fan = path, list(keys), fan
        self.columns = [field.name for field in schema]
        self.stored = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", batch_id bigint"

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        run = f"{self.path}/run={runs.run_name(0, batch_id, batch_id)}"
        changed = rows.select(*self.columns, F.lit(batch_id).cast("bigint").alias("batch_id"))
        changed.write.mode("overwrite").parquet(run)
        runs.merge_due(spark, self.path, self.stored, self.fan, self.keys[0], self._newest)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Each key's row of its latest batch; of a replayed batch's equal rows, one."""
        others = [name for name in rows.columns if name not in self.keys]
        picked = rows.groupBy(*self.keys).agg(*(F.max_by(name, "batch_id").alias(name) for name in others))
        return picked.select(*self.columns, "batch_id")

    def read(self, spark: SparkSession) -> DataFrame:
        return self._newest(runs.read(spark, runs.listed(spark, self.path), self.stored)).drop("batch_id")


def _in_rocksdb(spark: SparkSession) -> None:
    if not spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)


def latest_view(ticks: DataFrame, path: str) -> KeyedView:
    """The stored view that ``follow_latest`` keeps of these ticks."""
    rows = stats.latest_per_symbol(indicators.with_dashboard_indicators(ticks), dashboard.LATEST_COLUMNS)
    return KeyedView(path, rows.schema, ["symbol"])


def follow_latest(
    ticks: DataFrame,
    view: KeyedView,
    checkpoint: str,
    trigger: Trigger | None = None,
    order: str = "timestamp_ts",
) -> StreamingQuery:
    """Keeps the last non-NULL value of each column per symbol, in whatever order ticks come.

    ``order`` has no ties inside a symbol, as for the batch form. Top lists and alerts are read from the view
    with the same operators as from ``dashboard.latest``.
    """
    _in_rocksdb(ticks.sparkSession)
    rows = indicators.with_dashboard_indicators(ticks)
    latest = stats.latest_per_symbol(rows, dashboard.LATEST_COLUMNS, order)
    writer = latest.writeStream.foreachBatch(view)
    return started(writer, checkpoint, trigger, mode="update")
