"""Streaming forms: masking, rate breaches, liveness, throttling, tokenization."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wardlake.operators.masking import MaskRule, apply_masking
from wardlake.operators.reports import THROTTLE_SECONDS
from wardlake.operators.thresholds import RATE_UNITS, rate_rules
from wardlake.operators.tokens import VAULT_DDL, vault_tokenize


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def mask_stream(stream: DataFrame, tags: Mapping[str, str], rules: Sequence[MaskRule], role: str) -> DataFrame:
    """The batch projection; it holds no state."""
    return apply_masking(stream, tags, rules, role)


def stream_rate_breaches(stream: DataFrame, rules: DataFrame, unit: str, delay: str,
                         user: str = "consuming_user", ts: str = "event_time",
                         role: str = "executing_role") -> DataFrame:
    """Closed windows in which a user passed a rule's limit for one unit.

    Counts combine before the state update, so a busy user costs one state row.
    """
    name = unit.upper()
    if name not in RATE_UNITS:
        raise ValueError(f"unknown access rate unit {unit!r}")
    counts = (
        stream.withWatermark(ts, delay)
        .groupBy(user, role, F.window(ts, RATE_UNITS[name])).agg(F.count(F.lit(1)).alias("accesses"))
    )
    limits = rate_rules(rules).filter(F.col("unit") == name)
    return (
        counts.withColumnRenamed(role, "role").join(limits, "role")
        .filter(F.col("accesses") > F.col("access_rate_limit"))
        .select("rule_id", user, "unit", F.col("window.start").alias("window_start"),
                "accesses", "access_rate_limit", "action")
    )


def stream_instance_liveness(stream: DataFrame, gap: str, delay: str, owner: str = "agent_id",
                             ts: str = "checkin_time", dedup: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per closed up-time of an instance: check-ins no further apart than the gap."""
    seen = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(dedup))
    return (
        seen.groupBy(owner, "instance_id", F.session_window(ts, gap).alias("up"))
        .agg(F.count(F.lit(1)).alias("checkins"))
        .select(owner, "instance_id", F.col("up.start").alias("up_from"), F.col("up.end").alias("up_to"),
                "checkins")
    )


class Throttle(StatefulProcessor):
    """Keeps the last accepted time of a definition and gives each trigger its verdict on arrival.

    The triggers of one micro-batch are judged in the order of time and tie-breaker.
    What is older than the last acceptance is refused. When the watermark has passed
    the interval behind the last acceptance, a timer drops the state: what may still
    arrive is free to be accepted, and what lies behind the watermark is refused.
    """

    def __init__(self, seconds: int):
        self.gap = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["us", "tie"], kind="stable")
        us = pdf["us"].to_numpy(np.int64)
        accepted = np.zeros(len(us), bool)
        known = self.last.exists()
        last = int(self.last.get()[0]) if known else None
        open_from = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        at = int(np.searchsorted(us, max(open_from, last + self.gap) if known else open_from, side="left"))
        if at < len(us):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            while at < len(us):
                accepted[at], last = True, int(us[at])
                at = int(np.searchsorted(us, last + self.gap, side="left"))
            self.last.update((last,))
            self.handle.registerTimer(-(-(last + self.gap) // 1000))
        yield pd.DataFrame({"key": key[0], "us": us, "tie": pdf["tie"].to_numpy(), "accepted": accepted})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_throttle(stream: DataFrame, seconds: int = THROTTLE_SECONDS, delay: str = "1 hour",
                    key: str = "definition_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The triggers of a stream with ``accepted``, at most one per key within ``seconds`` of the last accepted.

    State is one time per key in the state store, so a query that starts again from its
    checkpoint goes on where it stopped; the session's new streams use RocksDB from here
    on. Verdicts follow the order of arrival: a trigger older than the last acceptance
    is refused. What is older than the watermark (``delay`` behind the latest trigger
    of earlier batches) is refused too, and Spark may leave it out of the result.
    Triggers without key or time are left out.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    time = F.col(ts).cast("timestamp")
    rows = stream.select(
        F.col(key).cast("string").alias("key"), time.alias("at"), F.unix_micros(time).alias("us"),
        F.col(tie).cast("long").alias("tie")).where("key is not null and at is not null")
    judged = (
        rows.withWatermark("at", delay).groupBy("key")
        .transformWithStateInPandas(Throttle(seconds), "key string, us long, tie long, accepted boolean", "Append", "EventTime")
    )
    back = F.timestamp_micros("us").cast(stream.schema[ts].dataType)
    return judged.select(F.col("key").alias(key), back.alias(ts), F.col("tie").alias(tie), "accepted")


def stream_tokenize(stream: DataFrame, cols: Sequence[str], root: str, checkpoint: str,
                    *, secret: str, retired: DataFrame | None = None) -> StreamingQuery:
    """Tokenized rows below ``root/rows`` and the pairs they need below ``root/log``, both by batch.

    The vault is a log: a batch writes its own pairs, in buckets of the token, and reads
    none of the earlier ones, so its cost does not grow with the vault. Folders are named
    by batch, so a repeated batch overwrites itself. ``read_vault`` gives each pair once,
    ``compact_vault`` merges the log from time to time. Values in ``retired`` had their
    token deleted and get one of their next generation.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        rows, pairs = vault_tokenize(batch, cols, None, secret=secret, retired=retired)
        rows.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")
        _in_buckets(pairs).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/log/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _in_buckets(pairs: DataFrame) -> DataFrame:
    """Pairs with the first two hexadecimal digits of their token, one task for each bucket or a part of it."""
    bucket = F.substring(F.substring_index("token", "_", -1), 1, 2)
    return pairs.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "token")


def _stored(spark: SparkSession, path: str, by: str) -> DataFrame:
    """A folder of pairs by batch and bucket; empty before the first one is written."""
    ddl = f"{VAULT_DDL}, {by} long, bucket string"
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def read_vault(spark: SparkSession, root: str) -> DataFrame:
    """Each pair of the log once: the last compaction, and the batches after it."""
    compacted = _stored(spark, f"{root}/compacted", "upto")
    last = compacted.agg(F.max("upto")).first()[0]
    last = -1 if last is None else last
    log = _stored(spark, f"{root}/log", "batch").where(F.col("batch") > last)
    return compacted.where(F.col("upto") == last).drop("upto").unionByName(log.drop("batch")).distinct().drop("bucket")


def compact_vault(spark: SparkSession, root: str) -> int | None:
    """Write the pairs of all batches so far as one table in buckets; gives the last batch that is in it.

    Runs apart from the stream, which goes on writing batches; readers take up the
    compaction when it is complete. Older tables and batches may be deleted after that.
    """
    upto = _stored(spark, f"{root}/log", "batch").agg(F.max("batch")).first()[0]
    if upto is None:
        return None
    earlier = _stored(spark, f"{root}/compacted", "upto")
    last = earlier.agg(F.max("upto")).first()[0]
    last = -1 if last is None else last
    if upto > last:
        log = _stored(spark, f"{root}/log", "batch").where((F.col("batch") > last) & (F.col("batch") <= upto))
        pairs = earlier.where(F.col("upto") == last).drop("upto").unionByName(log.drop("batch")).distinct().drop("bucket")
        _in_buckets(pairs).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/compacted/upto={upto}")
    return max(upto, last)


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stateless or append-mode stream over what is available and read the result."""
    query = (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)

