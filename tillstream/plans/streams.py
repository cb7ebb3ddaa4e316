"""Queries that run a stream over the given tables to its end and read the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock
from tillstream.operators import ingest, recon
from tillstream.plans.billing import THROTTLE_SQL
from tillstream.plans.checkviews import clock as at, counters, day, minute, ts
from tillstream.plans.registry import query
from tillstream.plans.risk import _FREQ, FREQUENCY
from tillstream.session import work_dir
from tillstream.sources import adapters as A
from tillstream.sources import topics
from tillstream.streaming import increments, jobs

ONCE = {"availableNow": True}


#: Micro-batches a topic is read in.
TOPIC_BATCHES = 6
#: Rows of one file of a topic. A file is written and read by one task, so a larger micro-batch has more files.
TOPIC_ROWS = 50_000
#: About so many rows of the given table decide where one micro-batch ends and the next begins.
CUT_ROWS = 100_000


def as_topic(
    df: DataFrame, order_col: str, label: str, rows: int, shape: Callable[[DataFrame], DataFrame] | None = None,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Rows, as ``shape`` makes them, as a stream that meets them in order of ``order_col``, over several micro-batches.

    ``rows`` says about how many there are; only the number of files follows from it. All are in the topic; ``sample``
    only decides where micro-batches end (:func:`~tillstream.sources.topics.write_in_order`).
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, label)}/topic"
    files = max(1, -(-rows // (TOPIC_BATCHES * TOPIC_ROWS)))
    topics.write_in_order(df, path, order_col, TOPIC_BATCHES, files, shape, sample)
    schema = (shape(df) if shape else df).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def event_records(spark: SparkSession, sf_dir: str, only_pay: bool = False) -> DataFrame:
    """Money events as a stream of JSON topic records, in the order of their arrival."""
    orders, customer = A.table(spark, sf_dir, "orders"), A.table(spark, sf_dir, "customer")
    count = orders.count()  # few have more than one event

    def timed(of: DataFrame) -> DataFrame:
        events = A.money_events(A.payments(of, customer))
        if only_pay:
            events = events.where(F.col("event_type") == S.PAY)
        return events.withColumn("timestamp", F.timestamp_millis("ingest_time"))

    return as_topic(
        timed(orders), "timestamp", "topic", count, lambda rows: ingest.to_wire(rows).select("value", "timestamp"),
        timed(_some(orders, count)),
    )


def _some(df: DataFrame, rows: int) -> DataFrame:
    """About ``CUT_ROWS`` of so many rows."""
    return df if rows <= CUT_ROWS else df.sample(CUT_ROWS / rows, seed=1)


def usage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage as it is metered, in event order."""
    events = A.table(spark, sf_dir, "events")
    count = events.count()
    return as_topic(A.usage(events), "event_time", "usage", count, sample=A.usage(_some(events, count)))


def _run(spark: SparkSession, label: str) -> tuple[str, jobs.Run]:
    folder = work_dir(spark, label)
    return folder, jobs.Run(f"{folder}/checkpoint", ONCE)


#: Batch number of a repair, above those of the streams.
REPAIR = 1 << 40


def valid_money(parsed: DataFrame) -> DataFrame:
    return ingest.validate_events(parsed).where("dirty_reason is null")


def _with_store(job, folder: str, records: DataFrame, lateness_ms: int, valid) -> None:
    """Run a started job and, beside it, the one that stores its events, to their ends."""
    run = jobs.Run(f"{folder}/store-checkpoint", ONCE)
    store = jobs.event_store_stream(records, f"{folder}/store", run, lateness_ms, valid)
    job.awaitTermination()
    store.awaitTermination()


@query(f"""
SELECT {day('event_time')} AS event_date, idempotency_key, tenant_id, app_id, amount_minor,
  coalesce(pay_method, '') AS pay_method, trace_id, {at('event_time')} AS event_time,
  {at('ingest_time')} AS ingest_time
FROM a_detail WHERE event_type = 'pay_success'""")
def streamed_detail(spark, sf_dir):
    """Ingest job: JSON records to the unique-key detail table."""
    folder, run = _run(spark, "ingest")
    jobs.ingest_stream(
        event_records(spark, sf_dir, True), f"{folder}/detail", f"{folder}/dirty", run
    ).awaitTermination()
    return jobs.read_detail(spark, f"{folder}/detail").select(
        "event_date", "idempotency_key", "tenant_id", "app_id", "amount_minor", "pay_method",
        "trace_id", "event_time", "ingest_time",
    )


@query(f"""
SELECT dirty_reason, event_type, tenant_id, {at('ingest_time')} AS receive_time
FROM a_checked WHERE dirty_reason IS NOT NULL AND event_type = 'pay_success'""")
def streamed_dirty(spark, sf_dir):
    folder, run = _run(spark, "ingest")
    jobs.ingest_stream(
        event_records(spark, sf_dir, True), f"{folder}/detail", f"{folder}/dirty", run
    ).awaitTermination()
    return jobs.read_dirty(spark, f"{folder}/dirty").select(
        "dirty_reason", "event_type", "tenant_id", "receive_time"
    )


@query(f"""
SELECT payment_id AS event_id, {at('event_time - event_time % 1000')} AS event_time, tenant_id,
  app_id, coalesce(channel_id, 'unknown') AS channel_id, pay_method, amount_minor
FROM a_pay""")
def streamed_recovery(spark, sf_dir):
    folder, run = _run(spark, "recovery")
    jobs.recovery_stream(
        event_records(spark, sf_dir, True), f"{folder}/detail", run
    ).awaitTermination()
    return jobs.read_recovery(spark, f"{folder}/detail").select(
        "event_id", "event_time", "tenant_id", "app_id", "channel_id", "pay_method",
        "amount_minor",
    )


@query(f"""
SELECT {day('event_time')} AS stat_date, {minute('event_time')} AS stat_minute, tenant_id, app_id,
  coalesce(channel_id, 'unknown_channel') AS channel_id, pay_method, count(*) AS pay_count,
  CAST(sum(amount_minor) AS BIGINT) AS pay_amount, CAST(sum(amount_minor) AS BIGINT) AS net_amount
FROM a_events
WHERE event_type = 'pay_success' AND amount_minor > 0
  AND event_time - event_time % 60000 + 60000 <= (SELECT max(event_time) - 5000 FROM a_events
    WHERE event_type = 'pay_success' AND amount_minor > 0)
GROUP BY ALL""")
def streamed_minute_gmv(spark, sf_dir):
    """Minutes closed by the watermark, late rows repaired; the newest stay open, as in the running job."""
    folder, run = _run(spark, "gmv")
    records = event_records(spark, sf_dir, True)
    job = jobs.minute_gmv_stream(records, f"{folder}/minutes", run)
    _with_store(job, folder, records, 5_000, ingest.valid_for_gmv)
    closed = (jobs.newest_event(spark, f"{folder}/store") or 0) - 5_000
    jobs.repair_late(spark, f"{folder}/store", f"{folder}/minutes", REPAIR, jobs.rebuilt_gmv(closed))
    return jobs.read_minutes(spark, f"{folder}/minutes", jobs.gmv_table())


@query(f"""
SELECT {day('event_time')} AS stat_date, {minute('event_time')} AS stat_minute, tenant_id, app_id,
  coalesce(channel_id, 'unknown_channel') AS channel_id, pay_method, count(*) AS pay_count,
  CAST(sum(amount_minor) AS BIGINT) AS pay_amount, CAST(sum(amount_minor) AS BIGINT) AS net_amount
FROM a_events WHERE event_type = 'pay_success' AND amount_minor > 0 GROUP BY ALL""")
def streamed_minute_parts(spark, sf_dir):
    """Two salted stages per micro-batch; parts add up on read."""
    folder, run = _run(spark, "parts")
    jobs.minute_parts_stream(
        event_records(spark, sf_dir, True), f"{folder}/minutes", run
    ).awaitTermination()
    return jobs.read_minute_parts(spark, f"{folder}/minutes")


_HOUR = f"""{day('event_time')} AS recon_date,
  CAST(date_part('hour', {ts('event_time')}) AS BIGINT) AS recon_hour, tenant_id"""


@query(f"""
SELECT recon_date, recon_hour, tenant_id, src_pay_count, dst_pay_count, src_pay_amount,
  dst_pay_amount, CAST(CASE WHEN src_event_count = dst_event_count AND src_pay_amount = dst_pay_amount
    THEN 1 ELSE 2 END AS BIGINT) AS recon_status
FROM (SELECT {_HOUR}, {counters('src')} FROM a_events WHERE event_type = 'pay_success' GROUP BY ALL)
JOIN (SELECT {_HOUR}, {counters('dst')} FROM a_detail WHERE event_type = 'pay_success' GROUP BY ALL)
  USING (recon_date, recon_hour, tenant_id)""")
def streamed_reconciliation(spark, sf_dir):
    """Hourly check of what the ingest stream stored against what it was sent."""
    folder, run = _run(spark, "ingest")
    records = event_records(spark, sf_dir, True)
    jobs.ingest_stream(records, f"{folder}/detail", f"{folder}/dirty", run).awaitTermination()
    sent = A.a_events(spark, sf_dir).where(F.col("event_type") == S.PAY)
    both = recon.reconcile(
        recon.source_counters(sent),
        recon.stored_counters(jobs.read_detail(spark, f"{folder}/detail")),
    )
    return both.select(
        *S.RECON_KEYS, "src_pay_count", "dst_pay_count", "src_pay_amount", "dst_pay_amount",
        "recon_status",
    )


_NO_FEE = "take_rate_total", "settlement_total"


@query("SELECT * EXCLUDE (take_rate_total, settlement_total) FROM c_minute")
def streamed_settlement(spark, sf_dir):
    """Deduplicated minute settlement over all event types: the stream, and the repair of late days."""
    folder, run = _run(spark, "settlement")
    records = event_records(spark, sf_dir)
    job = jobs.minute_settlement_stream(records, f"{folder}/minutes", run)
    _with_store(job, folder, records, 6 * clock.HOUR_MS, valid_money)
    jobs.repair_late(spark, f"{folder}/store", f"{folder}/minutes", REPAIR, jobs.rebuilt_settlement)
    minutes = jobs.read_minutes(spark, f"{folder}/minutes", jobs.settlement_table())
    return minutes.drop(*_NO_FEE)


@query("SELECT * FROM c_minute")
def streamed_settlement_fees(spark, sf_dir):
    """Minute settlement with all 11 metrics: signed increments, priced as events arrive and taken back when a price changes."""
    folder, run = _run(spark, "settlement-fees")
    increments.settlement_stream(
        event_records(spark, sf_dir), folder, run, valid_money, lambda session: A.a_rules(session, sf_dir), buckets=16
    ).awaitTermination()
    return increments.read_minutes(spark, folder)


@query("""
SELECT idempotency_key, tenant_id, amount_minor FROM a_detail WHERE event_type = 'pay_success'""")
def streamed_dedup(spark, sf_dir):
    folder, run = _run(spark, "dedup")
    jobs.dedup_stream(
        event_records(spark, sf_dir, True), f"{folder}/detail", run
    ).awaitTermination()
    return jobs.read_deduplicated(spark, f"{folder}/detail").select(
        "idempotency_key", "tenant_id", "amount_minor"
    )


@query(_FREQ)
def streamed_frequency_hits(spark, sf_dir):
    folder, run = _run(spark, "frequency")
    jobs.frequency_stream(
        usage_stream(spark, sf_dir), FREQUENCY, f"{folder}/hits", run
    ).awaitTermination()
    return jobs.read_hits(spark, f"{folder}/hits")


@query(f"""
SELECT hit_id, rule_id, rule_version, entity_type, entity, window_start, threshold
FROM ({_FREQ})""")
def published_hits(spark, sf_dir):
    """Every record the frequency job published, one for each hit however often its window grew."""
    folder, run = _run(spark, "frequency")
    jobs.frequency_stream(
        usage_stream(spark, sf_dir), FREQUENCY, f"{folder}/hits", run,
        publish=lambda df, batch_id: topics.publish(
            df, S.RISK_TOPIC, ["entity_type", "entity"], "files", f"{folder}/topics", batch_id
        ),
    ).awaitTermination()
    sent = spark.read.schema(S.TOPIC_RECORD).json(f"{folder}/topics/{S.RISK_TOPIC}/*")
    value = F.from_json("value", jobs.hit_table()).alias("v")
    return sent.select(value).select(
        "v.hit_id", "v.rule_id", "v.rule_version", "v.entity_type", "v.entity",
        "v.window_start", "v.threshold",
    )


@query(THROTTLE_SQL)
def streamed_throttle(spark, sf_dir):
    folder, run = _run(spark, "throttle")
    jobs.throttle_stream(
        usage_stream(spark, sf_dir),
        lambda session: A.a_quotas(session, sf_dir),
        f"{folder}/commands",
        run,
    ).awaitTermination()
    return jobs.read_throttle(spark, f"{folder}/commands")


@query(f"SELECT event_id, tenant_id, window_start FROM ({THROTTLE_SQL})")
def published_throttle(spark, sf_dir):
    """Every record the throttle job published, one for each tenant and hour over quota."""
    folder, run = _run(spark, "throttle")
    jobs.throttle_stream(
        usage_stream(spark, sf_dir),
        lambda session: A.a_quotas(session, sf_dir),
        f"{folder}/commands",
        run,
        publish=lambda df, batch_id: topics.publish(
            df, S.THROTTLE_TOPIC, ["tenant_id"], "files", f"{folder}/topics", batch_id
        ),
    ).awaitTermination()
    value = F.from_json("value", "event_id string, tenant_id string, window_start bigint")
    sent = spark.read.schema(S.TOPIC_RECORD).json(f"{folder}/topics/{S.THROTTLE_TOPIC}/*")
    return sent.select(value.alias("v")).select("v.*")
