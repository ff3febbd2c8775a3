"""Running counters over streams of finished calls."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tracked
from ..storage import delete, new_path


def read_events(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream over Parquet files of events; the schema is read once from the files there are."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        # A stream reads folders; a table in one file is its folder's only match.
        stream = reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    else:
        stream = reader.parquet(path)
    # Event time must be an instant.
    return stream.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def tool_counts(events: DataFrame, key: str = "event_type") -> DataFrame:
    """Calls a tool so far."""
    return events.groupBy(key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour", key: str = "event_type") -> DataFrame:
    """Calls a tool and window of event time; rows later than `late` are dropped by the watermark."""
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", key: str = "user_id") -> DataFrame:
    """Sessions of a user: calls less than `gap` apart."""
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(s.alias("s"), key).agg(F.count("*").alias("n")).select(key, F.col("s.start").alias("start"), "n")


def new_patterns(events: DataFrame, late: str = "1 hour", keys: tuple[str, ...] = ("user_id", "event_type")) -> DataFrame:
    """The first event of each pattern within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


def track(calls: DataFrame, state: tracked.StateTable, gap: datetime.timedelta, late: str = "1 hour", marks: str | None = None) -> None:
    """Runs a stream of calls(conv, tool, domain, ts) to its end; each micro-batch adds its finished conversations to the state as the next version.

    A conversation's calls may come in any order; it ends when event time is `gap` beyond its last one. Calls later than
    `late` behind the latest of the batches before are dropped.
    """
    held = OpenConversations(calls.sparkSession, f"{state.path}/open", gap, late)
    rows = calls.select("conv", F.col("tool").cast("string").alias("tool"), F.col("domain").cast("string").alias("domain"), "ts")
    run_to_end(rows, lambda c: c, each=lambda batch, k: state.commit(k, tracked.contributions(held.ended(k, batch))), marks=marks)


class OpenConversations:
    """Conversations that have not ended, as a table a micro-batch: (conv, calls, last), last in microseconds.

    Version k adds batch k to what version k - 1 left open, so a batch that is run again replaces its own version. Only
    grouping and files are used; no state is asked for key by key.
    """

    def __init__(self, spark: SparkSession, path: str, gap: datetime.timedelta, late: str):
        self.spark, self.path, self.gap, self.late = spark, path, gap // datetime.timedelta(microseconds=1), late

    def _mark(self, version: int) -> int | None:
        """The watermark after a version, in microseconds."""
        return self.spark.read.schema("mark long").parquet(f"{self.path}/marks/{version}").first()["mark"] if version >= 0 else None

    def _over(self, mark: int | None) -> Column:
        return F.lit(False) if mark is None else F.coalesce(F.col("last") + self.gap < mark, F.lit(True))

    def _read(self, batch: DataFrame, version: int) -> DataFrame:
        schema = f"conv {batch.schema['conv'].dataType.simpleString()}, calls {tracked.CALLS}, last long"
        return batch.sparkSession.read.schema(schema).parquet(f"{self.path}/held/{version}")

    def ended(self, version: int, batch: DataFrame) -> DataFrame:
        """(conv, calls) of the conversations that end with this batch."""
        before = self._mark(version - 1)
        rows = batch.where("conv is not null").select("conv", "tool", "domain", F.lit(1).cast("long").alias("n"), F.unix_micros("ts").alias("last"))
        if before is not None:
            rows = rows.where(F.coalesce(F.col("last") > before, F.lit(True)))
        if version:
            rows = rows.unionByName(self._read(batch, version - 1).where(~self._over(before)).select("conv", F.inline("calls"), "last"))
        each = rows.repartition("conv").groupBy("conv", "tool", "domain").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        held = each.groupBy("conv").agg(F.collect_list(F.struct("tool", "domain", "n")).alias("calls"), F.max("last").alias("last"))
        held.write.mode("overwrite").parquet(f"{self.path}/held/{version}")
        latest = batch.agg(F.unix_micros(F.max("ts") - F.expr(f"interval {self.late}")).alias("mark"))
        latest.select(F.greatest("mark", F.lit(before)).cast("long").alias("mark")).write.mode("overwrite").parquet(f"{self.path}/marks/{version}")
        # A batch that is run again needs the version before it only.
        delete(self.spark, f"{self.path}/held/{version - 2}")
        return self._read(batch, version).where(self._over(self._mark(version))).select("conv", "calls")


#: When the last marker of an ended stream stands; no event may be later.
END_OF_TIME = "9999-01-01 00:00:00"


def run_once(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there and reads what it wrote.

    Appended rows go to files in the shared folder. Complete results are rewritten a batch, so their last batch counts.
    Windows and sessions that later events could still change stay open; run_to_end() closes them, too.
    """
    spark = stream.sparkSession
    out, marks = new_path(spark, "stream"), new_path(spark, "stream-marks")
    _run(stream, mode, out, marks)
    return spark.read.schema(stream.schema).parquet(out)


def _run(stream: DataFrame, mode: str, out: str, marks: str, each: Callable[[DataFrame, int], None] | None = None) -> None:
    writer = stream.writeStream.option("checkpointLocation", marks).trigger(availableNow=True)
    if each is not None:
        writer = writer.outputMode(mode).foreachBatch(each)
    elif mode == "append":
        writer = writer.format("parquet").option("path", out).outputMode("append")
    else:
        writer = writer.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    writer.start().awaitTermination()


def run_to_end(events: DataFrame, transform: Callable[[DataFrame], DataFrame], time: str = "ts", each: Callable[[DataFrame, int], None] | None = None, marks: str | None = None) -> DataFrame | None:
    """run_once() of transform(events) for a stream that has ended: what it leaves open comes out as well.

    A second source, empty until all events are through, then holds one marker at the end of time. The query starts again
    from its checkpoint, the marker moves the watermark past all events, and their windows and sessions close; the
    marker's own stays open for good. With `each`, micro-batches go there, and nothing is returned; a run that was broken
    off goes on from its checkpoint when `marks` names it again.
    """
    spark = events.sparkSession
    out, marks = new_path(spark, "stream"), marks or new_path(spark, "stream-marks")
    markers = f"{marks}-markers"
    folder = spark._jvm.org.apache.hadoop.fs.Path(markers)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    stream = transform(events.unionByName(spark.readStream.schema(events.schema).parquet(markers)))
    _run(stream, "append", out, marks, each)
    marker = [F.lit(END_OF_TIME if f.name == time else None).cast(f.dataType).alias(f.name) for f in events.schema]
    spark.range(1).select(*marker).write.mode("append").parquet(markers)
    _run(stream, "append", out, marks, each)
    return None if each else spark.read.schema(stream.schema).parquet(out)
