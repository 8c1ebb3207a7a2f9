"""Streaming: windowed aggregates with watermarks, sessions, incremental feeds and upserts by batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.session import table


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """The event files of a folder as a stream, as many files a trigger as there are."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and type; late events within the watermark still count."""
    base = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = base.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of a user's events with no gap of `gap` or more."""
    base = events.withWatermark("ts", late) if events.isStreaming else events
    g = base.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


def first_seen(events: DataFrame) -> DataFrame:
    """Flags a user's first event, with state per user: the trigger of an incremental feed."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        n = sum(len(f) for f in frames)
        state.update((seen + n,))
        yield pd.DataFrame({"user_id": [key[0]], "is_new": [seen == 0], "events": [seen + n]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, is_new boolean, events long", "n long", "update", GroupStateTimeout.NoTimeout)


def _steps(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished steps below a path, ascending; one that a failure left unfinished isn't among them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [f.getPath() for f in fs.listStatus(hadoop) if f.getPath().getName().startswith("step=")]
    return sorted(int(p.getName()[5:]) for p in names if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The state that upsert_by_batch keeps, or None before its first batch: of every bucket the last step that wrote it."""
    steps = _steps(spark, path)
    if not steps:
        return None
    rows = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/step={k}" for k in steps])
    last = rows.groupBy("bucket").agg(F.max("step").alias("step"))  # a row per bucket
    return rows.join(F.broadcast(last), ["bucket", "step"], "left_semi").drop("bucket", "step")


def upsert_by_batch(path: str, keys: list[str], version: str | None = None, buckets: int = 16):
    """For foreachBatch: keeps the latest row of every key, in buckets of keys; a batch rewrites the buckets that it touches alone.

    Latest is the largest version, in the batch and against the state; without one the batch comes after the state, and of a batch's
    equal keys the largest row. The numbers of batches don't matter: a batch that runs again, or the first one after a lost
    checkpoint, is put on what stands. Null keys are a key.
    """

    def latest(df: DataFrame, names: list[str]) -> DataFrame:
        order = F.struct(*([version] if version else []), *names)
        return df.groupBy(*keys).agg(F.max(F.struct(order.alias("o"), F.struct(*names).alias("row"))).alias("x")).select("x.row.*")

    def apply(batch: DataFrame, number: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = latest(batch, names).withColumn("bucket", bucket)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # `buckets` values at most
        if not touched:
            return
        old = current(spark, path)
        if old is not None:
            kept = old.withColumn("bucket", bucket).where(F.col("bucket").isin(*touched))
            if version:
                both = new.drop("bucket").unionByName(kept.drop("bucket"), allowMissingColumns=True)
                new = latest(both, both.columns).withColumn("bucket", bucket)
            else:
                mine = new.select(*[F.col(k).alias(f"_{k}") for k in keys])
                same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
                new = new.unionByName(kept.join(mine, same, "left_anti"), allowMissingColumns=True)
        step = max(_steps(spark, path), default=-1) + 1
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/step={step}")

    return apply


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(_events(spark, sf_dir))


def event_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed(_events(spark, sf_dir), "1 day", "12 hours")


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(_events(spark, sf_dir))


QUERIES = {f.__name__: f for f in (event_windows, event_sliding_windows, event_sessions)}
_TS = "'%Y-%m-%d %H:%M:%S'"
SQL = {
    "event_windows": f"select strftime(date_trunc('hour', ts), {_TS}) window_start, event_type, count(*) n, round(sum(value), 4) total from events group by 1, 2",
    "event_sliding_windows": f"with w as (select *, unnest([time_bucket(interval 12 hours, ts, timestamp '1970-01-01'), time_bucket(interval 12 hours, ts, timestamp '1970-01-01') - interval 12 hours]) s from events) select strftime(s, {_TS}) window_start, event_type, count(*) n, round(sum(value), 4) total from w group by 1, 2",
    "event_sessions": f"with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end b from events), s as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) k from g) select user_id, strftime(min(ts), {_TS}) session_start, count(*) n from s group by user_id, k",
}
