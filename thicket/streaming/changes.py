"""Change feeds: filtering, polling state and a streaming upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.operators.documents import latest

MAX_EMPTY = 30


def changed_ids(feed: DataFrame, kind: str = "ft") -> DataFrame:
    """Distinct non-blank ids of feed(nregistro, cambio array) whose changes hold kind."""
    return feed.filter(F.array_contains("cambio", kind) & (F.trim("nregistro") != "")).select(F.trim("nregistro").alias("nregistro")).distinct()


def next_state(state: dict, n_rows: int, now: str) -> tuple[dict, bool]:
    """(state to store after the run has succeeded, whether to refresh everything)."""
    empty = 0 if n_rows else state.get("consecutive_empty_responses", 0) + 1
    full = state.get("last_execution") is None or empty >= MAX_EMPTY
    return {"last_execution": now, "consecutive_empty_responses": 0 if full else empty}, full


def poll(spark: SparkSession, fetch: Callable[[str | None], list[dict]], state: dict, now: str, kind: str = "ft") -> tuple[DataFrame, dict, bool]:
    """(changed ids, state to store once the run has succeeded, whether to refresh everything).

    fetch(last_execution) gives the rows {nregistro, cambio} of the feed since then.
    """
    rows = [(r.get("nregistro"), r.get("cambio") or []) for r in fetch(state.get("last_execution"))]
    feed = spark.createDataFrame(rows, "nregistro string, cambio array<string>")
    return changed_ids(feed, kind), *next_state(state, len(rows), now)


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """The last version of each key of both tables."""
    return latest(current.unionByName(changes, allowMissingColumns=True), key, F.desc_nulls_last(version))


def stream_upsert(spark: SparkSession, source: str, schema: str, target: str, key: str, version: str, checkpoint: str, buckets: int = 64):
    """upsert_stream() of a folder of JSON files."""
    return upsert_stream(spark.readStream.schema(schema).json(source), target, key, (version,), checkpoint, buckets)


def upsert_stream(feed: DataFrame, target: str, key: str, versions: Sequence[str], checkpoint: str, buckets: int = 64):
    """Upserts each micro-batch of a stream into a table dealt to buckets by key; runs until what is there has been read.

    Of the rows of a key the one of the highest versions stays.  Only the
    buckets that a batch touches are written anew, below target/data/epoch=n;
    a manifest says which epoch holds each bucket.  A batch that is repeated
    writes the same files.  snapshot() reads the table.
    """
    spark, columns = feed.sparkSession, feed.schema
    order = [F.desc_nulls_last(v) for v in versions]

    def apply(batch: DataFrame, epoch: int) -> None:
        new = batch.withColumn("bucket", F.pmod(F.hash(key), F.lit(buckets)))
        held = _manifest(spark, target, epoch - 1)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # one row a bucket
        old = [f"{target}/data/epoch={held[b]}/bucket={b}" for b in touched if b in held]
        if old:
            new = new.unionByName(spark.read.schema(columns).parquet(*old).withColumn("bucket", F.pmod(F.hash(key), F.lit(buckets))))
        latest(new, key, *order).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/epoch={epoch}")
        now = held | dict.fromkeys(touched, epoch)
        spark.createDataFrame(sorted(now.items()), "bucket int, epoch long").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/{epoch}")

    return feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_epoch(spark: SparkSession, target: str) -> int:
    """The newest epoch of a table that upsert_stream() writes; -1 if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return max((int(f.getPath().getName()) for f in system.listStatus(at)), default=-1) if system.exists(at) else -1


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leaves a stream as a failure between writing its last batch and recording it would: the batch is repeated."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = path(f"{checkpoint}/commits")
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max((f.getPath().getName() for f in system.listStatus(at) if f.getPath().getName().isdigit()), key=int)
    system.delete(path(f"{checkpoint}/commits/{last}"), False)


def _manifest(spark: SparkSession, target: str, epoch: int) -> dict[int, int]:
    return {r.bucket: r.epoch for r in spark.read.parquet(f"{target}/manifest/{epoch}").collect()} if epoch >= 0 else {}


def snapshot(spark: SparkSession, target: str, schema: str, epoch: int) -> DataFrame:
    """The table of upsert_stream as of an epoch."""
    held = _manifest(spark, target, epoch)
    paths = [f"{target}/data/epoch={e}/bucket={b}" for b, e in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def windowed_counts(events: DataFrame, ts: str = "ts", kind: Column | str = "event_type", lateness: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts by window and kind; on a stream late rows are dropped after lateness."""
    rows = events.withWatermark(ts, lateness) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")
