"""Streaming jobs: ingest, recovery, minute metrics, deduplication, risk and throttling.

Every job keeps its read position and state in ``checkpoint`` and writes through
``foreachBatch`` into tables whose batches replace themselves on replay, so a
restart neither loses nor repeats anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas as S
from tillstream.functions import clock
from tillstream.operators import billing, ingest, risk, settlement
from tillstream.operators.ordered import latest_per_key, repeated_keys
from tillstream.operators.risk import Rule
from tillstream.session import stage
from tillstream.sources import tables
from tillstream.streaming import outbox

DETAIL_KEYS = ["event_date", "idempotency_key"]
EVENT_TS = "event_ts"

RECOVERY_TABLE = T.StructType([*S.RECOVERY_DETAIL, T.StructField("event_date", T.DateType())])

_GMV_KEYS = ["tenant_id", "app_id", "channel_id", "pay_method"]


def _minute_schema(metrics: list[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("stat_date", T.DateType()),
            T.StructField("stat_minute", T.TimestampNTZType()),
            *[T.StructField(n, T.StringType()) for n in _GMV_KEYS],
            *[T.StructField(m, T.LongType()) for m in metrics],
        ]
    )


_GMV_FIELDS = ["event_time", "amount_minor", *_GMV_KEYS]
GMV_METRICS = ["pay_count", "pay_amount", "net_amount"]


def gmv_table() -> T.StructType:
    return _minute_schema(GMV_METRICS)


def settlement_table() -> T.StructType:
    return _minute_schema(S.SETTLEMENT_METRICS)


@dataclass(frozen=True)
class Run:
    """How a query runs: checkpoint folder and trigger (``{"availableNow": True}``, ...)."""

    checkpoint: str
    trigger: dict = field(default_factory=lambda: {"processingTime": "60 seconds"})
    name: str | None = None


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
#: State with a row for every key: on the disk of the executors, in bounded memory beside the heap.
KEYED_STATE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",
}


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started in here keep their state as ``KEYED_STATE`` says, unless the session names a state store.

    A query takes the options of its session when it starts, and the store of its checkpoint if it has one.
    """
    own = spark.conf.get(_PROVIDER, None) is not None
    before = {} if own else {k: spark.conf.get(k, None) for k in KEYED_STATE}
    try:
        for k in before:
            spark.conf.set(k, KEYED_STATE[k])
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(
    df: DataFrame, write: Callable[[DataFrame, int], None], run: Run, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    writer = writer.option("checkpointLocation", run.checkpoint).trigger(**run.trigger)
    if run.name:
        writer = writer.queryName(run.name)
    return writer.start()


def _arrival_ms() -> Column:
    """Arrival time of a record in its topic: unlike the clock, equal on a replay."""
    return F.unix_millis("timestamp")


def _with_event_ts(df: DataFrame, delay: str) -> DataFrame:
    return df.withColumn(EVENT_TS, F.timestamp_millis("event_time")).withWatermark(EVENT_TS, delay)


# --- ingest --------------------------------------------------------------------------


def ingest_stream(
    records: DataFrame, detail_path: str, dirty_path: str, run: Run
) -> StreamingQuery:
    """Validated detail upsert plus dirty archive; stateless, without a watermark.

    Both tables and their batch number come from one pass over the micro-batch.
    """
    checked = ingest.validate_pay(ingest.parse_events(records.select("value", "timestamp")))
    # only the archive takes the raw text, so the rows that are kept for both tables leave it out where it is good
    checked = checked.withColumn("raw_payload", F.when(F.col("dirty_reason").isNotNull(), F.col("raw_payload")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = batch.where("dirty_reason is null")
            bad = batch.where("dirty_reason is not null")
            detail = ingest.to_detail(good, _arrival_ms())
            tables.upsert(
                detail, detail_path, DETAIL_KEYS, ["ingest_time", "trace_id"], "event_date",
                batch_id,
            )
            tables.append(
                ingest.dirty_rows(bad, _arrival_ms()), dirty_path, "event_date", batch_id
            )
        finally:
            batch.unpersist()

    return start(checked, write, run)


def read_detail(spark: SparkSession, path: str, days=None) -> DataFrame:
    return tables.read_latest(
        spark, path, S.DETAIL, DETAIL_KEYS, "event_date", ["ingest_time", "trace_id"], days
    )


def read_dirty(spark: SparkSession, path: str, days=None) -> DataFrame:
    return tables.load_table(spark, path, S.DIRTY, "event_date", days).drop(tables.BATCH)


def recovery_stream(records: DataFrame, path: str, run: Run) -> StreamingQuery:
    """Short detail keyed by event id; amounts of any sign are kept."""
    parsed = ingest.parse_events(records.select("value", "timestamp"), lenient=True)
    rows = ingest.to_recovery_detail(parsed, _arrival_ms()).withColumn(
        "event_date", F.col("event_time").cast("date")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.upsert(
            batch, path, ["event_date", "event_id"], ["ingest_time"], "event_date", batch_id
        )

    return start(rows, write, run)


def read_recovery(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_latest(
        spark, path, RECOVERY_TABLE, ["event_date", "event_id"], "event_date"
    )


# --- minute metrics --------------------------------------------------------------------

def _labelled(batch: DataFrame, metrics: list[str]) -> DataFrame:
    minute = F.unix_millis("window.start")
    return batch.select(
        clock.stat_date(minute).alias("stat_date"),
        clock.wall_clock(minute).alias("stat_minute"),
        *_GMV_KEYS,
        *metrics,
    )


def _write_minutes(path: str, metrics: list[str]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(_labelled(batch, metrics), path, "stat_date", batch_id)

    return write


def minute_gmv_stream(
    records: DataFrame, path: str, run: Run, delay: str = "5 seconds"
) -> StreamingQuery:
    """One row per closed minute; rows later than the watermark are dropped."""
    valid = ingest.valid_for_gmv(ingest.parse_events(records.select("value"), lenient=True, fields=_GMV_FIELDS))
    agg = (
        _with_event_ts(valid, delay)
        .groupBy(F.window(EVENT_TS, "1 minute"), *_GMV_KEYS)
        .agg(
            F.count("*").alias("pay_count"),
            F.sum("amount_minor").alias("pay_amount"),
            F.sum("amount_minor").alias("net_amount"),
        )
    )
    return start(agg, _write_minutes(path, GMV_METRICS), run, "append")


def minute_settlement_stream(
    records: DataFrame, path: str, run: Run, lateness: str = "6 hours"
) -> StreamingQuery:
    """Settlement metrics corrected for every late event within ``lateness``.

    Repeated deliveries go first, by idempotency key. Changed minutes are
    written again as a whole (update mode), so a late refund replaces the row
    of its minute and never adds to it. Merged topics share one watermark.
    """
    parsed = ingest.parse_events(records.select("value"), fields=STORE_FIELDS)
    valid = ingest.validate_events(parsed).where("dirty_reason is null")
    once = _with_event_ts(valid, lateness).dropDuplicatesWithinWatermark(["idempotency_key"])
    agg = settlement.to_increments(once, keep=[EVENT_TS]).groupBy(F.window(EVENT_TS, "1 minute"), *_GMV_KEYS).agg(
        *[F.sum(m).alias(m) for m in S.SETTLEMENT_METRICS]
    )
    return start(agg, _write_minutes(path, S.SETTLEMENT_METRICS), run, "update")


def read_minutes(spark: SparkSession, path: str, schema: T.StructType, days=None) -> DataFrame:
    return tables.read_latest(spark, path, schema, S.MINUTE_KEYS, "stat_date", (), days)


def minute_parts_stream(records: DataFrame, path: str, run: Run, salt: int = 16) -> StreamingQuery:
    """Minute GMV of each micro-batch in two salted stages, stored as parts.

    Parts of one minute from different batches add up on read
    (:func:`read_minute_parts`); a replayed batch replaces its own parts. No
    state is kept and nothing is dropped as late.
    """
    fields = [*_GMV_FIELDS, "payment_id"]  # by which the parts are salted
    valid = ingest.valid_for_gmv(ingest.parse_events(records.select("value"), lenient=True, fields=fields))

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = settlement.minute_gmv(batch, salt=salt)
        tables.write_batch(parts, path, "stat_date", batch_id)

    return start(valid, write, run)


def read_minute_parts(spark: SparkSession, path: str, days=None) -> DataFrame:
    parts = tables.load_table(spark, path, gmv_table(), "stat_date", days)
    return parts.groupBy(*S.MINUTE_KEYS).agg(*[F.sum(m).alias(m) for m in GMV_METRICS])


def repair_days(
    spark: SparkSession, events: DataFrame, minute_path: str, days: list[str], batch_id: int
) -> None:
    """Exact repair of whole days from deduplicated events, however late they came."""
    rebuilt = settlement.rebuild_minutes(events, days)
    tables.replace_days(spark, rebuilt, minute_path, "stat_date", days, batch_id)


# --- late rows and their repair --------------------------------------------------------

EVENT_STORE = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        *[T.StructField(n, T.StringType()) for n in (
            "event_type", "idempotency_key", "tenant_id", "app_id", "payment_id", "channel_id",
            "pay_method", "trace_id",
        )],
        *[T.StructField(n, T.LongType()) for n in (
            "amount_minor", "event_time", "ingest_time", "take_rate_amount", "settlement_amount",
        )],
    ]
)
#: What is read of a record to check and to store its event.
STORE_FIELDS = sorted({*ingest.CHECKED_FIELDS, *(f.name for f in EVENT_STORE if f.name != "event_date")})
_MARK = T.StructType([T.StructField("newest", T.LongType()), T.StructField("mark_date", T.DateType())])
_LATE = T.StructType([T.StructField("event_date", T.DateType()), T.StructField("late_rows", T.LongType())])


def event_store_stream(
    records: DataFrame, folder: str, run: Run, lateness_ms: int,
    valid: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Keep every valid event by day, and count for each day those a windowed job drops as late.

    Runs beside such a job, over the same records. A row is late when it is older than the newest
    event of all earlier micro-batches less ``lateness_ms``, which is the watermark of a job that
    reads in the same steps; a job that lags behind it drops less. Nothing is dropped here, so :func:`repair_late` can set the
    minute table right. ``valid`` gets the columns ``STORE_FIELDS``.
    """
    rows = valid(ingest.parse_events(records.select("value"), lenient=True, fields=STORE_FIELDS))
    rows = rows.withColumn("event_date", clock.stat_date(F.col("event_time")))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_STORE])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.write_batch(batch, f"{folder}/events", "event_date", batch_id)
        own = (
            tables.load_table(spark, f"{folder}/events", EVENT_STORE, "event_date")
            .where(F.col(tables.BATCH) == batch_id)
        )
        newest = own.agg(F.max("event_time").alias("newest"), F.max("event_date").alias("mark_date"))
        tables.write_batch(newest.where("newest is not null"), f"{folder}/marks", "mark_date", batch_id)
        before = newest_event(spark, folder, batch_id)
        late = own.where(F.col("event_time") < F.lit(before) - lateness_ms) if before is not None else own.limit(0)
        counts = late.groupBy("event_date").agg(F.count("*").alias("late_rows"))
        tables.write_batch(counts, f"{folder}/late", "event_date", batch_id)

    return start(rows, write, run)


def newest_event(spark: SparkSession, folder: str, before_batch: int | None = None) -> int | None:
    """Time of the newest event stored so far, or before a micro-batch."""
    marks = tables.load_table(spark, f"{folder}/marks", _MARK, "mark_date")
    if before_batch is not None:
        marks = marks.where(F.col(tables.BATCH) < before_batch)
    return marks.agg(F.max("newest")).first()[0]


def stored_events(spark: SparkSession, folder: str, days=None) -> DataFrame:
    return tables.load_table(spark, f"{folder}/events", EVENT_STORE, "event_date", days).drop(tables.BATCH)


def repair_late(
    spark: SparkSession, folder: str, minute_path: str, batch_id: int,
    rebuild: Callable[[DataFrame], DataFrame],
) -> list[str]:
    """Rebuild the minutes of all days that had late rows from the stored events of those days.

    ``rebuild`` turns events into minute rows. Returns the days.
    """
    late = tables.load_table(spark, f"{folder}/late", _LATE, "event_date")
    days = sorted(str(r[0]) for r in late.select("event_date").distinct().collect())
    if days:
        rebuilt = rebuild(stored_events(spark, folder, days))
        tables.replace_days(spark, rebuilt, minute_path, "stat_date", days, batch_id)
    return days


def rebuilt_settlement(events: DataFrame) -> DataFrame:
    """Settlement minutes of stored events: of repeated deliveries the last counts."""
    once, again = repeated_keys(events, ["idempotency_key"])
    last = latest_per_key(again, ["idempotency_key"], ["ingest_time", "trace_id"])
    return settlement.minute_settlement(once.unionByName(last))


def rebuilt_gmv(closed_before: int) -> Callable[[DataFrame], DataFrame]:
    """Minute GMV of stored events, of the minutes that end by ``closed_before``."""
    def rebuild(events: DataFrame) -> DataFrame:
        minute_end = clock.floor_ms(F.col("event_time"), clock.MINUTE_MS) + clock.MINUTE_MS
        return settlement.minute_gmv(events.where(minute_end <= closed_before))

    return rebuild


# --- deduplication -----------------------------------------------------------------------


def dedup_stream(
    records: DataFrame, path: str, run: Run, ttl: str = "3 days", clock_by: str = "event"
) -> StreamingQuery:
    """First delivery of each idempotency key, remembered for ``ttl`` and over restarts.

    ``clock_by="event"`` ages keys by event time; ``"arrival"`` by the time the
    record entered its topic.
    """
    fields = {*ingest.CHECKED_FIELDS, "ingest_time", *(f.name for f in S.DETAIL)}
    parsed = ingest.parse_events(records.select("value", "timestamp"), fields=fields)
    valid = ingest.validate_pay(parsed).where("dirty_reason is null")
    if clock_by == "arrival":
        marked = valid.withColumn(EVENT_TS, F.col("timestamp")).withWatermark(EVENT_TS, ttl)
    else:
        marked = _with_event_ts(valid, ttl)
    once = marked.dropDuplicatesWithinWatermark(["idempotency_key"])

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(
            ingest.to_detail(batch, _arrival_ms()), path, "event_date", batch_id
        )

    with _keyed_state(records.sparkSession):
        return start(once, write, run)


def read_deduplicated(spark: SparkSession, path: str) -> DataFrame:
    return tables.load_table(spark, path, S.DETAIL, "event_date").drop(tables.BATCH)


# --- risk and billing ----------------------------------------------------------------------

HIT_TABLE = {
    "hit_id": "string", "rule_id": "string", "rule_version": "int", "risk_type": "string",
    "entity_type": "string", "entity": "string", "tenant_id": "string",
    "window_start": "bigint", "value": "bigint", "threshold": "bigint", "evidence": "string",
    "hit_date": "date",
}


def hit_table() -> T.StructType:
    return S.columns(", ".join(f"{n} {t}" for n, t in HIT_TABLE.items()))


def _write_hits(
    path: str, shape: Callable[[DataFrame], DataFrame], publish: outbox.Publish | None = None
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        hits = shape(batch).withColumn("hit_date", clock.stat_date(F.col("window_start")))
        if publish:
            hits = stage(hits, "hits")
            outbox.send(hits, f"{path}-outbox", "hit_date", "hit_id", batch_id, publish)
        tables.write_batch(hits, path, "hit_date", batch_id)

    return write


def frequency_stream(
    usage: DataFrame, rule: Rule, path: str, run: Run, lateness: str = "6 hours",
    publish: outbox.Publish | None = None,
) -> StreamingQuery:
    """Hits of the frequency rule, kept current while their window is open.

    ``publish`` gets each hit once, as it was first found, by way of the outbox ``<path>-outbox``.
    """
    tries = usage.where(F.col("kind").isin("purchase", "error"))
    agg = risk.frequency_counts(
        _with_event_ts(tries, lateness), F.window(EVENT_TS, f"{rule.window_ms} milliseconds")
    )

    def shape(batch: DataFrame) -> DataFrame:
        rows = batch.withColumn("window_start", F.unix_millis("window.start")).drop("window")
        return risk.frequency_hits(rows, rule)

    return start(agg, _write_hits(path, shape, publish), run, "update")


def association_stream(
    usage: DataFrame, entity: str, other: str, path: str, run: Run,
    width: str = "1 hour", slide: str = "5 minutes", lateness: str = "10 minutes",
) -> StreamingQuery:
    """Sliding estimate of distinct ``other`` per ``entity``; the batch feature is exact."""
    agg = (
        _with_event_ts(usage, lateness)
        .groupBy(F.window(EVENT_TS, width, slide), entity)
        .agg(F.count("*").alias("events"), F.approx_count_distinct(other).alias("others"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        start_ms = F.unix_millis("window.start")
        rows = batch.select(
            entity, start_ms.alias("window_start"), "events", "others",
            clock.stat_date(start_ms).alias("stat_date"),
        )
        tables.write_batch(rows, path, "stat_date", batch_id)

    return start(agg, write, run, "update")


def read_hits(spark: SparkSession, path: str, days=None) -> DataFrame:
    return tables.read_latest(spark, path, hit_table(), ["hit_id"], "hit_date", (), days).drop(
        "hit_date"
    )


def logins_joined(
    pay: DataFrame, login: DataFrame, width: str = "10 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Stream-stream left outer interval join of payments with logins of the same user.

    ``degraded`` payments found no login before both watermarks passed.
    """
    p = pay.withColumn("pay_ts", F.timestamp_millis("event_time")).withWatermark("pay_ts", delay)
    lo = login.select(
        F.col("user_id").alias("login_user"),
        F.col("device_id").alias("login_device"),
        F.timestamp_millis("event_time").alias("login_ts"),
    ).withWatermark("login_ts", delay)
    near = F.expr(
        f"user_id = login_user and login_ts <= pay_ts and login_ts >= pay_ts - interval {width}"
    )
    return p.join(lo, near, "leftOuter").withColumn("degraded", F.col("login_ts").isNull())


THROTTLE_TABLE = {
    "event_id": "string", "event_type": "string", "tenant_id": "string",
    "window_start": "bigint", "used": "bigint", "quota_per_hour": "bigint",
    "quota_version": "int", "stat_date": "date",
}


def throttle_stream(
    usage: DataFrame,
    load_quota: Callable[[SparkSession], DataFrame],
    path: str,
    run: Run,
    lateness: str = "1 hour",
    publish: outbox.Publish | None = None,
) -> StreamingQuery:
    """Throttle commands as soon as usage passes the quota, published once per tenant and hour.

    The stored command follows the count as it grows; ``publish`` gets each command once, by way of the
    outbox ``<path>-outbox``. The quota table is read again for each micro-batch, so changes take effect.
    """
    agg = (
        _with_event_ts(usage, lateness)
        .groupBy(F.window(EVENT_TS, "1 hour"), "tenant_id")
        .agg(F.count("*").alias("used"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.select(
            "tenant_id", F.unix_millis("window.start").alias("window_start"), "used"
        )
        spark = batch.sparkSession
        commands = stage(
            billing.over_quota(counted, load_quota(spark)).withColumn(
                "stat_date", clock.stat_date(F.col("window_start"))
            ),
            "throttle",
        )
        if publish:
            outbox.send(commands, f"{path}-outbox", "stat_date", "event_id", batch_id, publish)
        tables.write_batch(commands, path, "stat_date", batch_id)

    return start(agg, write, run, "update")


def throttle_table() -> T.StructType:
    return S.columns(", ".join(f"{n} {t}" for n, t in THROTTLE_TABLE.items()))


def read_throttle(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_latest(spark, path, throttle_table(), ["event_id"], "stat_date").drop("stat_date")
