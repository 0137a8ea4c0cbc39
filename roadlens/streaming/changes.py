"""Live feed: landing folder → event records → new and changed ones → event store.

``start_ingest`` works in numbered micro-batches with DataFrame operators only. A poll delivered again, under whatever
file name, is known by the hash of its number and content and left out. The last stamp of every key is a table in
buckets by key hash; a micro-batch joins the rows of its own keys. Store and both tables carry the batch number, so a batch that is
run again after a crash, wherever that was, adds nothing twice. ``changed_events`` is the same rule as a stateful
operator inside any stream, with state in Spark's own store.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens.operators.ordered import CHUNK_ROWS, previous_in_key
from roadlens.schemas import EVENT_COLUMNS, FEED, FEED_KINDS
from roadlens.sinks.batches import LastValues, append_batch
from roadlens.sources.feed import flatten_in_order

# The two Python functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLL_INTERVAL = "120 seconds"

# Files taken per micro-batch; bounds the rows a key can bring to its state at once.
MAX_FILES = 1000

ORDERED = ("poll bigint, pos int, tipo string, subtipo string, ubicacion string, "
           "ciudad string, hora string, lat double, lon double, clave string")
OUT = list(EVENT_COLUMNS)
EVENTS = ("tipo string, subtipo string, ubicacion string, ciudad string, "
          "hora string, lat double, lon double")


def feed_stream(spark: SparkSession, landing: str, multi_line: bool = False,
                max_files: int | None = MAX_FILES) -> DataFrame:
    """Payloads as they land, the oldest files first. A payload without ``poll`` takes its file's time.

    With ``landed`` and ``file``, when and where, and whether the payload is ``numbered`` itself.
    """
    reader = spark.readStream.schema(FEED).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived = F.unix_millis(F.col("_metadata.file_modification_time"))
    return (reader.json(landing).withColumns({"landed": arrived, "file": F.col("_metadata.file_path"), "numbered": F.col("poll").isNotNull()})
            .withColumn("poll", F.coalesce("poll", "landed")))


def _compact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compares the rows of a key inside one batch and leaves one open row per poll and key.

    A batch decides every row but the first of each (poll, key): those go on with
    the last ``hora`` of their run (``tail``) to be compared with the key's state.
    Decided rows leave their key for a ``route`` of the batch, so hot keys spread.
    """
    for rows in batches:
        if rows.empty:
            continue
        rows = rows.sort_values(["poll", "pos"], kind="stable")
        run = rows.groupby(["poll", "clave"], sort=False)["hora"]
        before = run.shift()
        head = run.cumcount() == 0
        rows["tail"] = run.transform("last")
        rows["route"] = ""
        rows.loc[~head, "route"] = f"{rows['poll'].iloc[0]}-{rows['pos'].iloc[0]}"
        rows.loc[~head, "clave"] = ""
        yield rows[head | (before != rows["hora"])]


def _emitter(ttl_ms: int | None):
    def emit(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Passes decided rows on; compares open rows with the last seen ``hora`` of the key."""
        if state.hasTimedOut:
            state.remove()
            return
        _, route = key
        if route:
            for part in batches:
                yield part[OUT]
            return
        rows = pd.concat(list(batches), ignore_index=True)
        if len(rows) > 1:
            rows = rows.sort_values(["poll", "pos"], kind="stable")
        seen = state.get[0] if state.exists else None
        last = rows["tail"].iloc[-1]
        if last != seen:
            state.update((last,))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        changed = rows["hora"] != rows["tail"].shift(fill_value=seen)
        if changed.any():
            yield rows.loc[changed, OUT]
    return emit


def changed_events(payloads: DataFrame, ttl_seconds: int | None = None) -> DataFrame:
    """New and changed event records of a payload stream.

    The open rows of a key in one micro-batch are at most one per poll and Arrow batch, whatever the
    key's share of the rows; the admission limit of the source bounds the polls. They are compared
    as columns. With ``ttl_seconds`` a key that was not seen for so long is forgotten, so the state
    stays as large as what is current; its next record then counts as new.
    """
    compact = (flatten_in_order(payloads)
               .mapInPandas(_compact, ORDERED + ", tail string, route string"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_seconds else GroupStateTimeout.NoTimeout
    return (compact.select("clave", "route", "poll", "pos", "tail", *EVENT_COLUMNS).groupBy("clave", "route")
            .applyInPandasWithState(_emitter(ttl_seconds and 1000 * ttl_seconds), EVENTS,
                                    "hora string", "append", timeout))


def start_store(events: DataFrame, store: str, checkpoint: str,
                available_now: bool = False, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Appends a stream of event records to the store."""
    return (events.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(available_now, interval)).start(store))


def _trigger(available_now: bool, interval: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def arrival(poll: Column, pos: Column) -> Column:
    """One whole number in the order of (poll, pos): polls to 2**42 (milliseconds until 2109), 2**21 alerts each."""
    fits = poll.between(0, (1 << 42) - 1) & (pos < (1 << 21))
    return F.when(fits, F.shiftleft(poll, 21) + pos).otherwise(F.raise_error(F.lit("a poll number or place is too large")))


class Ingest:
    """What happens to one micro-batch of payloads."""

    def __init__(self, store: str, checkpoint: str, changes_only: bool = True, ttl_seconds: int | None = None,
                 chunk_rows: int = CHUNK_ROWS):
        self.store, self.checkpoint, self.changes_only, self.chunk_rows = store, checkpoint, changes_only, chunk_rows
        self.ttl = ttl_seconds and 1000 * ttl_seconds
        self.polls = LastValues(f"{checkpoint}/polls", "digest", "poll bigint", buckets=1)  # a row a poll
        self.seen = LastValues(f"{checkpoint}/last-seen", "clave", "hora string")
        self._writer: str | None = None

    def writer(self, spark: SparkSession) -> str:
        """The identity of the checkpoint: batch numbers begin anew with another one."""
        if self._writer is None:
            self._writer = spark.read.schema("id string").json(f"{self.checkpoint}/metadata").first()["id"]
        return self._writer

    def fresh(self, payloads: DataFrame, number: int, since: int | None) -> DataFrame:
        """The payloads that no earlier batch has taken, one of equal ones. Without a poll number none are equal."""
        content = [F.hex(F.xxhash64(F.lit(i), *FEED_KINDS)) for i in range(2)]  # 128 bits, beside the number itself
        told = payloads.withColumn("digest", F.when(F.col("numbered"), F.concat_ws(":", "poll", *content)))
        own = F.coalesce("digest", F.concat_ws(":", "file", F.monotonically_increasing_id()))
        # Payloads are few and large: dealt out by number, so that small ones are not put together in one task.
        tasks = payloads.sparkSession.sparkContext.defaultParallelism
        first = told.withColumn("_own", own).repartition(tasks, "_own").dropDuplicates(["_own"]).drop("_own")
        known = self.polls.before(payloads.sparkSession, number, since).select("digest")
        return first.join(known, "digest", "left_anti")

    def __call__(self, payloads: DataFrame, number: int) -> None:
        spark = payloads.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")  # no operator keeps state by shuffle partition
        now = payloads.agg(F.max("landed")).first()[0] if self.ttl else None
        since = now - self.ttl if now is not None else None
        # Parsed once. A payload without alerts stays as a row without a place.
        rows = flatten_in_order(self.fresh(payloads, number, since), extra=("landed", "digest"), empty=True).persist()
        try:
            n = rows.count()
            there = rows.filter("pos IS NOT NULL")
            tasks = []
            if self.changes_only:
                there = there.withColumn("seq", arrival(F.col("poll"), F.col("pos")))
                found = self._changed(there, n, number, since)
                last = there.groupBy("clave").agg(F.max_by("hora", "seq").alias("hora"), F.max("landed").alias("stamp"))
                tasks.append(lambda: self.seen.put(last, number, since))
            else:
                found = there
            polls = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.first("poll").alias("poll"), F.max("landed").alias("stamp"))
            tasks.append(lambda: self.polls.put(polls, number, since))
            writer = self.writer(spark)
            tasks.append(lambda: append_batch(found.select(*EVENT_COLUMNS), self.store, writer, number))
            # Each write replaces itself and reads only what earlier batches wrote, so their order does not matter.
            with ThreadPoolExecutor(len(tasks)) as pool:
                for done in [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]:
                    done.result()
        finally:
            rows.unpersist()

    def _changed(self, rows: DataFrame, n: int, number: int, since: int | None) -> DataFrame:
        """The rows whose key is new or whose stamp differs from the key's preceding row, here or in the table."""
        keys = rows.select("clave", self.seen.bucket().alias("bucket")).distinct()
        before = (self.seen.before(rows.sparkSession, number, since).join(keys, ["bucket", "clave"], "left_semi")
                  .select("clave", "hora", F.lit(-1).cast("long").alias("seq")))
        both = rows.select("clave", "seq", *EVENT_COLUMNS).unionByName(before, allowMissingColumns=True)
        marked = previous_in_key(both, ["clave"], "seq", "hora", self.chunk_rows, rows=2 * n)
        return marked.filter((F.col("seq") >= 0) & (F.col("is_first") | ~F.col("previous").eqNullSafe(F.col("hora"))))


def start_ingest(spark: SparkSession, landing: str, store: str, checkpoint: str,
                 changes_only: bool = True, available_now: bool = False,
                 max_files: int | None = MAX_FILES, interval: str = POLL_INTERVAL,
                 ttl_seconds: int | None = None) -> StreamingQuery:
    """The whole loop: poll, leave out what was delivered before, flatten, keep changes, append.

    With ``ttl_seconds`` keys and polls that landed longer ago than that, seen from the newest file of a batch, are
    forgotten; then a key's next record counts as new. It is meant for a stream that keeps running.
    """
    if ttl_seconds and available_now:
        raise ValueError("a time-to-live needs a running stream, not one that stops when it has caught up")
    payloads = feed_stream(spark, landing, max_files=max_files)
    return (payloads.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(Ingest(store, checkpoint, changes_only, ttl_seconds))
            .trigger(**_trigger(available_now, interval)).start())
