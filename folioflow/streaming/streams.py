"""The jobs that also run on arriving data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioflow.functions.keys import one_per_key
from folioflow.operators.chunks import chunk_fixed
from folioflow.operators.limits import RATE_LIMIT
from folioflow.operators.memory import KEPT_ROLES, LAST_K, TURN_DAYS
from folioflow.session import SESSION_CONF, new_run_folder
from folioflow.sources import ledger

CHUNKS = "chunk_id STRING, doc_key STRING, chunk_no INT, text STRING, version BIGINT"
VERSIONS = "doc_key STRING, digest STRING, version BIGINT"
HISTORY = "session_id STRING, position INT, seq BIGINT, role STRING, text STRING"
TURN_EVENTS = "session_id STRING, seq BIGINT, role STRING, text STRING, event STRING"


def run_available(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append", timers: bool = False
):
    """Work through what has arrived, batch by batch, then stop.

    State with a processing-time TTL asks for one more batch after every batch,
    so without the first setting such a run would go on with empty batches for
    ever; and such state needs the store of the second. Event-time ``timers`` need an
    empty batch to fire after the last rows, and ask for no more than that. The query
    copies its settings when it starts; the session's are put back.
    """
    settings = stream.sparkSession.conf
    needed = {
        "spark.sql.streaming.noDataMicroBatches.enabled": str(timers).lower(),
        "spark.sql.streaming.stateStore.providerClass": SESSION_CONF["spark.sql.streaming.stateStore.providerClass"],
    }
    before = {name: settings.get(name, None) for name in needed}
    for name, value in needed.items():
        settings.set(name, value)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(each)
            .start()
        )
    finally:
        for name, value in before.items():
            settings.unset(name) if value is None else settings.set(name, value)
    query.awaitTermination()
    return query


# --- Index ----------------------------------------------------------------------


def index_batch(documents: DataFrame, path: str, batch: str | None = None) -> None:
    """Bring the index up to date with (doc_key, text).

    A document whose text has changed gets a new version, whose chunks take the place
    of the old ones; one with a NULL text leaves; one that is as it was is not
    touched. Of several texts of a key the one with the least digest counts, and any
    text before none. Versions and chunks count together, with the batch's record in
    the ledger. Only keys and digests are compared; texts meet the keys that have
    changed, which are broadcast where they are few.
    """
    spark = documents.sparkSession
    batch = batch or uuid.uuid4().hex
    done = ledger.committed(spark, path)
    if batch in done:
        return
    keyed = documents.select(
        F.col("doc_key").cast("string").alias("doc_key"), "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    )
    given = keyed.groupBy("doc_key").agg(F.min(F.struct(F.col("digest").isNull().alias("gone"), "digest")).alias("g"))
    state = ledger.read(spark, path, VERSIONS, "versions").groupBy("doc_key").agg(
        F.max_by("digest", "version").alias("known")
    )
    changed = (
        given.select("doc_key", "g.digest")
        .join(state, "doc_key", "left")
        .filter(~F.col("digest").eqNullSafe(F.col("known")))
        .select("doc_key", "digest", F.lit(len(done)).cast("bigint").alias("version"))
    )
    versions = ledger.batch_folder(path, batch, "versions")
    changed.write.mode("overwrite").parquet(versions)
    fresh = spark.read.schema(VERSIONS).parquet(versions).filter(F.col("digest").isNotNull())
    texts = one_per_key(keyed.join(fresh.select("doc_key", "digest"), ["doc_key", "digest"], "left_semi"), "doc_key", [F.col("digest")])
    chunks = chunk_fixed(texts).select("chunk_id", "doc_key", "chunk_no", "text", F.lit(len(done)).cast("bigint").alias("version"))
    chunks.write.mode("overwrite").parquet(ledger.batch_folder(path, batch))
    ledger.commit(spark, path, batch, version=len(done))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of the newest version of each document that is still there.

    Versions that others have replaced are a table of keys, and chunks of those are
    left out; the chunks that stay are not shuffled where such versions are few.
    """
    versions = ledger.read(spark, path, VERSIONS, "versions")
    newest = versions.groupBy("doc_key").agg(F.max("version").alias("newest"))
    old = versions.join(newest, "doc_key").filter(F.col("version") < F.col("newest")).select("doc_key", "version")
    folder = new_run_folder(spark, "old-versions")
    old.write.parquet(folder)
    old = spark.read.schema("doc_key STRING, version BIGINT").parquet(folder)
    return ledger.read(spark, path, CHUNKS).drop("batch").join(old, ["doc_key", "version"], "left_anti").drop("version")


def index_incremental(documents: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """``index_batch``, and then the index."""
    index_batch(documents, path, batch)
    return read_index(documents.sparkSession, path)


def index_stream(documents: DataFrame, path: str, checkpoint: str, name: str = "index"):
    """The same for a document stream; a batch that is run again counts once."""
    return run_available(documents, checkpoint, lambda rows, number: index_batch(rows, path, f"{name}-{number}"))


# --- Rates ----------------------------------------------------------------------


def rate_limit_stream(
    requests: DataFrame,
    n: int = RATE_LIMIT,
    minutes: int = 5,
    slide: str = "30 seconds",
    lateness: str = "10 minutes",
) -> DataFrame:
    """(key, window_start, window_end, requests) of windows over the limit.

    Sliding windows; rows as late as ``lateness`` still count, and rows whose windows
    have closed are dropped. Counting is combined before the shuffle, so a hot key
    sends one row per task and window. In update mode a window comes again, with more
    requests, when more arrive; see ``newest_alerts``.
    """
    return (
        requests.withWatermark("ts", lateness)
        .groupBy(F.window("ts", f"{minutes} minutes", slide), "key")
        .agg(F.count(F.lit(1)).alias("requests"))
        .filter(F.col("requests") > n)
        .select(
            "key",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "requests",
        )
    )


def newest_alerts(alerts: DataFrame) -> DataFrame:
    """The last word on each window; its count only grows."""
    return alerts.groupBy("key", "window_start", "window_end").agg(F.max("requests").alias("requests"))


# --- Turns ------------------------------------------------------------------------


class ExpiringTurns(StatefulProcessor):
    """Tells of turns when they come and when they leave, at the time of the events."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        number = T.StructType().add("at", T.LongType()).add("seq", T.LongType())
        turn = T.StructType().add("role", T.StringType()).add("text", T.StringType())
        self.turns = handle.getMapState("turns", number, turn)

    @staticmethod
    def _rows(session: str, turns: list[tuple], event: str) -> pd.DataFrame:
        seq, role, text = zip(*turns) if turns else ((), (), ())
        return pd.DataFrame(
            {
                "session_id": pd.Series([session] * len(turns), dtype=object),
                "seq": pd.Series(seq, dtype="int64"),
                "role": pd.Series(role, dtype=object),
                "text": pd.Series(text, dtype=object),
                "event": pd.Series([event] * len(turns), dtype=object),
            }
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            turns = list(frame[["seq", "role", "text", "at"]].itertuples(index=False, name=None))
            for seq, role, text, at in turns:
                self.turns.updateValue((int(at), int(seq)), (role, text))
                self.handle.registerTimer(int(at))
            yield self._rows(key[0], [(int(s), r, t) for s, r, t, _ in turns], "append")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        gone = [(at, seq, role, text) for (at, seq), (role, text) in self.turns.iterator() if at <= due]
        for at, seq, _, _ in gone:
            self.turns.removeKey((at, seq))
        yield self._rows(key[0], [(seq, role, text) for _, seq, role, text in gone], "expire")

    def close(self) -> None:
        pass


def turn_events(turns: DataFrame, days: int = TURN_DAYS) -> DataFrame:
    """(session_id, seq, role, text, event) of arriving (session_id, seq, ts, role, text).

    Turns with text are appended, and expire ``days`` after their own time, which is
    when the newest turn of all is so much newer: the watermark lags by as many days,
    so it passes a turn's time just then. What comes in after that has expired
    already and is dropped. So what is appended and not expired is the same for any
    order of arrival. State is kept per session and hour, so that a busy session is
    spread.
    """
    spoken = turns.filter(F.coalesce(F.col("text"), F.lit("")) != "")
    return (
        spoken.select(
            F.col("session_id").cast("string").alias("session_id"),
            F.col("seq").cast("bigint").alias("seq"),
            "role",
            "text",
            F.col("ts").cast("timestamp").alias("ts"),
        )
        .withColumn("at", F.unix_millis("ts"))
        .withColumn("hour", F.floor(F.col("at") / 3_600_000))
        .withWatermark("ts", f"{days} days")
        .groupBy("session_id", "hour")
        .transformWithStateInPandas(
            statefulProcessor=ExpiringTurns(), outputStructType=TURN_EVENTS, outputMode="Append", timeMode="EventTime"
        )
    )


def live_turns(events: DataFrame) -> DataFrame:
    """Turns that have come and not left, from stored ``turn_events``."""
    left = events.filter(F.col("event") == "expire").select("session_id", "seq")
    return events.filter(F.col("event") == "append").drop("event").join(left, ["session_id", "seq"], "left_anti")


# --- History --------------------------------------------------------------------


class NewestMessages(StatefulProcessor):
    """Keeps one session's newest messages, at most ``2k`` rows of state."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Spelled out, as a worker has no session to parse a schema string.
        schema = (
            T.StructType().add("seq", T.LongType()).add("role", T.StringType()).add("text", T.StringType())
        )
        self.kept = handle.getListState(
            "kept", schema, ttlDurationMs=TURN_DAYS * 24 * 3600 * 1000
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(list(self.kept.get()), columns=["seq", "role", "text"])
        for frame in rows:
            both = frame[["seq", "role", "text"]]
            kept = both if kept.empty else pd.concat([kept, both])
            kept = kept.sort_values("seq").tail(2 * self.k)
        self.kept.put([(int(s), r, t) for s, r, t in kept.itertuples(index=False)])
        shown = kept.assign(role=kept["role"].str.lower())
        shown = shown[shown["role"].isin(KEPT_ROLES)].reset_index(drop=True)
        yield pd.DataFrame(
            {
                "session_id": key[0],
                "position": pd.Series(range(1, len(shown) + 1), dtype="int32"),
                "seq": shown["seq"].astype("int64"),
                "role": shown["role"],
                "text": shown["text"],
            }
        )

    def close(self) -> None:
        pass


def newest_per_task(turns: DataFrame, k: int) -> DataFrame:
    """At most ``2k`` rows per session from each Arrow batch.

    The newest of all are among the newest of each part, so this loses nothing,
    and a busy session sends few rows through the shuffle.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("seq").groupby("session_id", sort=False).tail(2 * k)

    return turns.mapInPandas(cut, "session_id string, seq bigint, role string, text string")


def stream_last_k(turns: DataFrame, k: int = LAST_K) -> DataFrame:
    """Every touched session's current history, as updates.

    State is a list of ``2k`` rows per session in the state store, and leaves
    after seven idle days. Needs the RocksDB provider (see ``session``).
    """
    narrow = turns.select(F.col("session_id").cast("string"), F.col("seq").cast("bigint"), "role", "text")
    return (
        newest_per_task(narrow, k)
        .groupBy("session_id")
        .transformWithStateInPandas(
            statefulProcessor=NewestMessages(k),
            outputStructType=HISTORY,
            outputMode="Update",
            timeMode="ProcessingTime",
        )
    )


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of one Parquet table in a folder of several tables.

    A table is a file or a folder of files. The path is a pattern, as a stream takes
    no single file by its plain path.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}*.parquet")


def in_waves(waves: list[DataFrame], work: Callable[[DataFrame], None]) -> None:
    """Let rows arrive wave by wave, and ``work`` through what is there after each.

    ``work`` gets a stream of the folder that the waves are written to.
    """
    spark = waves[0].sparkSession
    folder = new_run_folder(spark, "arrivals")
    for wave in waves:
        wave.write.mode("append").parquet(folder)
        work(spark.readStream.schema(wave.schema).parquet(folder))
