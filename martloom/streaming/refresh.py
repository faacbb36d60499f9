"""Incremental refresh (I1): changed rows replace their old versions, from a table or from a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.latest import latest_per_key
from martloom.session import cut_lineage
from martloom.sinks.versions import VersionedTable

# The part of a bucketed table, and what its version notes about the stream that feeds it.
BUCKET, BATCH, BUCKETS = "bucket", "last_batch", "buckets"


def changed_since(df: DataFrame, changed_on: str, last_success: datetime | Column | None) -> DataFrame:
    """Rows whose change time is the bound or later, or not known; all rows before the first success.

    Take the bound from the start of the last good run (``runlog.last_good_start``). A row that comes again is replaced by
    itself, so taking too many does no harm.
    """
    if last_success is None:
        return df
    bound = last_success if isinstance(last_success, Column) else F.lit(last_success)
    return df.filter((F.col(changed_on) >= bound) | F.col(changed_on).isNull())


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with ``changes`` replacing rows of the same key and new keys added. ``changes`` has unique keys."""
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(changes.select(*target.columns))


class BucketedTable:
    """A stored table whose parts are buckets of its key's hash, so that a change rewrites only the buckets it falls into.

    The version that a batch writes also notes the batch's number. Both become visible in one step, so a batch that is
    delivered again after a failure is known to be in the table already, and is skipped without reading anything.
    The number of buckets is chosen once, with the table: large enough that a bucket is a few files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], buckets: int = 64) -> None:
        self.table = VersionedTable(spark, path)
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.keys = list(keys)
        known = self.table.current()
        self.buckets = int(known.note[BUCKETS]) if known else buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; none of a table that was never written."""
        if not self.table.exists():
            return self.table.spark.createDataFrame([], self.schema)
        return self.table.read(self.schema, None if buckets is None else {BUCKET: list(buckets)})

    def last_batch(self, stream: str) -> int:
        known = self.table.current()
        return int(known.note.get(f"{BATCH} {stream}", -1)) if known else -1

    def apply(self, changes: DataFrame, newest: Sequence[str], stream: str = "load", batch: int | None = None) -> int:
        """Let changed rows replace those of their key; returns the buckets rewritten.

        Of several versions of a key in the changes the newest wins; it also has to be as new as the row it replaces, so
        batches that arrive late do not undo later ones. A batch whose number the stream has passed is skipped.
        """
        if batch is not None and batch <= self.last_batch(stream):
            return 0
        latest = cut_lineage(latest_per_key(changes.select(*self.schema.names), self.keys, newest))
        # At most as many as there are buckets.
        touched = [r[BUCKET] for r in latest.select(self._bucket().alias(BUCKET)).distinct().collect()]
        note = {BUCKETS: str(self.buckets)} | ({} if batch is None else {f"{BATCH} {stream}": str(batch)})
        both = self.read(touched).unionByName(latest)
        rows = latest_per_key(both, self.keys, newest).withColumn(BUCKET, self._bucket())
        self.table.sweep()
        self.table.replace_parts(rows, [BUCKET], [(b,) for b in touched], note=note)
        return len(touched)


def refresh_from_stream(
    changes: DataFrame, target: BucketedTable, newest: Sequence[str], checkpoint: str, stream: str = "stream", available_now: bool = True
) -> StreamingQuery:
    """Apply a stream of changed rows batch by batch. Each batch is in the table once, however often it is delivered."""

    def apply(batch: DataFrame, number: int) -> None:
        target.apply(batch, newest, stream, number)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
