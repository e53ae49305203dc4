"""The same operators on streams.

Filters, projections and lookups against a static collection are stateless, so
the batch functions take a streaming DataFrame as it is. The two jobs that keep
something between micro-batches write it to a folder all executors share, as
versions with numbers of their own, in the order in which they were written. What
a stream's batch numbers are plays no part in that order: they begin at 0 again
with every new checkpoint. One stream at a time writes to a folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.logs import DEFAULT_HISTORY, DEFAULT_THRESHOLD, at_or_above, log_history
from ..operators.lookup import first_per_key
from ..operators.writes import content_order, upsert_latest
from ..sources.shared import drop_versions, is_file, read_versions, versions, write_version

#: States of a history that stay behind the present one, for readers that have them open.
KEPT_VERSIONS = 10

BatchWriter = Callable[[DataFrame, int], None]


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files in the folder ``path`` as a stream; or one parquet file."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_file(spark, path):
        # a stream watches folders, so a single file is picked out of its folder
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def run_available(
    df: DataFrame, sink: str | BatchWriter, checkpoint: str, output_mode: str = "append"
) -> None:
    """Run a stream over everything there is now, then stop. ``sink`` is a
    parquet folder or a function of micro-batch and batch number."""
    writer = df.writeStream.trigger(availableNow=True).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if callable(sink):
        query = writer.foreachBatch(sink).start()
    else:
        query = writer.format("parquet").option("path", sink).start()
    query.awaitTermination()


def stream_batch(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch: the stream it belongs to (a new checkpoint is a new
    stream) and its number there. Outside a stream the number alone."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream or 'none'}.{batch_id}"


class HistorySink:
    """The last ``size`` events at or above a level, kept up to date by a stream.

    ``id_col`` identifies an event: one that arrives twice is held once, the later
    one by ``ts``. A batch is merged into the newest state, and merging it again
    changes nothing, so neither a batch that is run again nor a stream put back to an
    earlier point loses an event. ``kept_versions`` older states stay for open readers.
    """

    def __init__(
        self, path: str, ts: str, level: str, id_col: str,
        threshold: str = DEFAULT_THRESHOLD, size: int = DEFAULT_HISTORY, kept_versions: int = KEPT_VERSIONS,
    ) -> None:
        self.path, self.ts, self.level, self.id_col = path, ts, level, id_col
        self.threshold, self.size, self.kept_versions = threshold, size, kept_versions

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch; pass this to ``run_available``."""
        spark = batch.sparkSession
        loud = batch.filter(at_or_above(self.level, self.threshold)(batch))
        # at most ``size`` rows leave each side, so the stored state never grows
        rows = self._last(self._once(loud))
        done = versions(spark, self.path)
        if done:
            kept = read_versions(spark, self.path, [done[max(done)]])
            rows = self._last(self._once(rows.unionByName(kept)))
        write_version(rows, self.path, max(done, default=-1) + 1)
        old = list(done.values())
        drop_versions(spark, self.path, old[:max(0, len(old) - self.kept_versions)])

    def _once(self, df: DataFrame) -> DataFrame:
        return first_per_key(df, self.id_col, [F.desc(self.ts), *content_order(df)])

    def _last(self, df: DataFrame) -> DataFrame:
        return log_history(df, self.ts, self.level, self.threshold, self.size, id_col=self.id_col)

    def read(self, spark: SparkSession, since=None) -> DataFrame:
        """The present history, or the part of it later than ``since``."""
        done = versions(spark, self.path)
        if not done:
            raise LookupError(f"no history under {self.path!r}")
        df = read_versions(spark, self.path, [done[max(done)]])
        return log_history(df, self.ts, self.level, self.threshold, self.size, since, self.id_col)


class UpsertTable:
    """A collection that is written by a stream: insert or replace by key.

    A micro-batch writes only its own rows, one per key, so the cost of a batch
    does not depend on the size of the collection. Readers merge the change sets
    into the last full state; ``compact`` folds them into a new full state.
    """

    def __init__(self, path: str, key: str | list[str], order: str | list[str]) -> None:
        self.key = [key] if isinstance(key, str) else list(key)
        self.order = [order] if isinstance(order, str) else list(order)
        self._full, self._changes = f"{path}/full", f"{path}/changes"

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch; pass this to ``run_available``. A batch of the same
        stream that is run again replaces what it wrote."""
        spark, writer = batch.sparkSession, stream_batch(batch, batch_id)
        done = versions(spark, self._changes)
        number = next((n for n, name in done.items() if name.partition(".")[2] == writer), None)
        if number is None:
            number = max([*done, *versions(spark, self._full)], default=-1) + 1
        order = [*(F.col(c).desc_nulls_last() for c in self.order), *content_order(batch)]
        rows = first_per_key(batch, self.key, order)
        write_version(rows.withColumn("__batch", F.lit(number)), self._changes, number, writer)

    def read(self, spark: SparkSession) -> DataFrame:
        """The present state: one row per key."""
        full, changed = versions(spark, self._full), versions(spark, self._changes)
        pending = [name for n, name in changed.items() if n > max(full, default=-1)]
        if not full and not pending:
            raise LookupError(f"nothing written to {self._changes!r}")
        changes = None
        if pending:
            # of rows with equal order the one that was written later counts
            latest = [F.col(c).desc_nulls_last() for c in (*self.order, "__batch")]
            changes = first_per_key(read_versions(spark, self._changes, pending), self.key, latest).drop("__batch")
        if not full:
            return changes
        state = read_versions(spark, self._full, [full[max(full)]])
        if changes is None:
            return state
        return upsert_latest(state, changes, self.key, self.order, current_unique=True)

    def compact(self, spark: SparkSession) -> None:
        """Write the present state in full, under the number of the last change set
        in it; what is written later has a higher one. Readers of the old state are
        not disturbed."""
        last, full = max(versions(spark, self._changes), default=-1), max(versions(spark, self._full), default=-1)
        if last > full:
            write_version(self.read(spark), self._full, last)

    def vacuum(self, spark: SparkSession) -> None:
        """Delete what the last full state has made needless: older full states
        and the change sets in it. Run it when no reader uses them any more."""
        full = versions(spark, self._full)
        if full:
            last = max(full)
            drop_versions(spark, self._full, [name for n, name in full.items() if n < last])
            folded = [name for n, name in versions(spark, self._changes).items() if n <= last]
            drop_versions(spark, self._changes, folded)
