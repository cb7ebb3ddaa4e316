"""Priced settlement as signed increments, with an index of payments and one of deliveries.

A micro-batch writes only what it changes. Three stored tables make that possible, each read by a few of its
partitions only:

* ``keys``: the delivery that counts of each idempotency key, in hash buckets of the key;
* ``payments``: the events of each payment with the rule that priced it, in hash buckets of the payment. A correction finds its
  payment there, whatever the payment's day, and a payment that comes late finds its corrections;
* ``increments``: signed minute rows by day. What an event or a new price takes back is negative; readers add up.

Work for a batch follows the batch and the buckets it touches, not the days it touches nor the history of
events. Every read leaves out the batch itself and later ones, so a replay computes and replaces the same rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas as S
from tillstream.functions import clock
from tillstream.operators import ingest, rules, settlement
from tillstream.operators.ordered import latest_per_key
from tillstream.session import stage
from tillstream.sources import tables
from tillstream.streaming import jobs

#: A batch reads the buckets of its keys: with more buckets a small batch reads less, a large one meets more files.
BUCKETS = 64
BUCKET = "bucket"

ORDER = ["ingest_time", "trace_id"]
_FEES = ["take_rate_amount", "settlement_amount"]
_EVENT = [f for f in jobs.EVENT_STORE if f.name not in _FEES]
_NAMES = [f.name for f in _EVENT]
_TERMS = S.columns(", ".join(f"{n} {t}" for n, t in rules.TERM_TYPES.items()))

KEY_TABLE = T.StructType([T.StructField(BUCKET, T.IntegerType()), *_EVENT])
#: ``link`` is the payment, or the key where there is none; ``alive`` is false where a delivery was replaced
#: by one with another payment.
PAYMENT_TABLE = T.StructType(
    [
        T.StructField(BUCKET, T.IntegerType()), T.StructField("link", T.StringType()), *_EVENT,
        T.StructField("rule", _TERMS), T.StructField("alive", T.BooleanType()),
    ]
)


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(name)), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[int], batch_id: int) -> DataFrame:
    """The rows of some buckets from earlier batches; both conditions are on folders."""
    rows = tables.load_table(spark, path, schema, BUCKET)
    return rows.where(F.col(BUCKET).isin(list(buckets)) & (F.col(tables.BATCH) < batch_id))


def _link(side: str | None = None) -> Column:
    """The payment of an event, or its key where it has none."""
    payment, key = (F.col(f"{side}.{n}" if side else n) for n in ("payment_id", "idempotency_key"))
    return F.coalesce(payment, F.concat(F.lit("\0"), key))


def _linked(side: str | None = None) -> Column:
    """Whether an event is kept by payment: all are but adjustments, and those without a type."""
    return F.coalesce(F.col(f"{side}.event_type" if side else "event_type") != S.ADJUST, F.lit(False))


def _touched(df: DataFrame) -> list[int]:
    """The buckets of a batch, at most as many as there are."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def _write(df: DataFrame, path: str, part: str, batch_id: int) -> None:
    tables.write_batch(df.hint("rebalance", part), path, part, batch_id)


def _matching(stored: DataFrame, wanted: DataFrame, key: str, label: str) -> DataFrame:
    """The stored rows whose ``key`` is among the distinct ones of ``wanted``.

    Most keys of a batch are new. So only the two key columns are dealt out to find those that are not; where they are
    few, the stored rows are read past them and never move.
    """
    hits = stage(stored.select(key).join(wanted.select(key), key, "left_semi").distinct(), label)
    return stored.join(hits, key, "left_semi")


def changes(spark: SparkSession, folder: str, batch: DataFrame, batch_id: int, buckets: int) -> DataFrame:
    """``new`` and ``old`` (or null) of each key whose delivery that counts is another one after this batch.

    The last delivery counts, as in :func:`~tillstream.operators.ordered.latest_per_key`; a repeated or
    older one changes nothing. The new deliveries are stored. What is returned joins two staged tables, of which
    the known deliveries are the small one as a rule, so reading it again costs little.
    """
    fresh = latest_per_key(batch.select(*_NAMES), ["idempotency_key"], ORDER)
    fresh = stage(fresh.withColumn(BUCKET, _bucket("idempotency_key", buckets)), "fresh")
    stored = _stored(spark, f"{folder}/keys", KEY_TABLE, _touched(fresh), batch_id)
    known = _matching(stored.select(*_NAMES), fresh, "idempotency_key", "known-keys")
    known = stage(latest_per_key(known, ["idempotency_key"], ORDER), "known")
    rest = [n for n in _NAMES if n not in ("idempotency_key", *ORDER)]

    def rank(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{n}") for n in (*ORDER, *rest)])

    new = fresh.select("idempotency_key", F.struct(*_NAMES).alias("new"))
    old = known.select("idempotency_key", F.struct(*_NAMES).alias("old"))
    both = new.join(old, "idempotency_key", "left")
    changed = both.where(F.col("old").isNull() | (rank("new") > rank("old"))).select("new", "old")
    _write(
        changed.select("new.*").withColumn(BUCKET, _bucket("idempotency_key", buckets)), f"{folder}/keys", BUCKET, batch_id
    )
    return changed


def contributions(events: DataFrame) -> DataFrame:
    """Events with fee and settlement: payments by their own ``rule``, corrections by that of their payment among the
    events of the same ``sign``."""
    kind, columns = F.col("event_type"), ["sign", *_NAMES, *_FEES]
    pay = events.where(kind == S.PAY)
    fixes = events.where(kind.isin(S.REFUND, S.CHARGEBACK)).drop("rule")
    paid = pay.select("payment_id", "sign", F.struct("event_time", "amount_minor", "rule").alias("paid"))
    fixed = rules.priced_corrections(fixes.join(paid, ["payment_id", "sign"], "left"))
    adjust = events.where(kind == S.ADJUST).select(
        "sign", *_NAMES, F.lit(0).cast("bigint").alias(_FEES[0]), F.col("amount_minor").alias(_FEES[1])
    )
    return rules.priced(pay).select(*columns).unionByName(fixed.select(*columns)).unionByName(adjust)


def signed_increments(events: DataFrame) -> DataFrame:
    """What events add (``sign`` 1) or take back (-1), by minute; rows that change nothing are left out."""
    made = settlement.to_increments(contributions(events), keep=["sign"])
    made = made.withColumns({m: F.col(m) * F.col("sign") for m in S.SETTLEMENT_METRICS})
    return settlement.add_increments(made).where(F.exists(F.array(*S.SETTLEMENT_METRICS), lambda m: m != 0))


def apply(
    spark: SparkSession, folder: str, batch: DataFrame, batch_id: int, fee_rules: DataFrame, buckets: int = BUCKETS
) -> None:
    """Store what one batch of valid events changes.

    Corrections without a payment, or whose payment has not come yet, count at their face value without a fee. A payment keeps
    the rule it was priced by until another delivery of it comes.
    """
    changed = changes(spark, folder, batch, batch_id, buckets)
    # of a delivery that went and one that came for the same payment, the one that came is left
    stays = _linked("old") & _linked("new") & _link("old").eqNullSafe(_link("new"))
    gone = changed.where("old is not null").select("old.*", stays.alias("again")).withColumn("alive", F.lit(False))
    come = changed.select("new.*", F.lit(False).alias("again"))
    priced = rules.with_rule(come.where(F.col("event_type") == S.PAY), fee_rules)
    none = F.lit(None).cast(PAYMENT_TABLE["rule"].dataType)
    come = priced.unionByName(come.where(~F.col("event_type").eqNullSafe(S.PAY)).withColumn("rule", none))
    moved = gone.withColumn("rule", none).unionByName(come.withColumn("alive", F.lit(True)))
    moved = stage(moved.withColumn("link", _link()).withColumn(BUCKET, _bucket("link", buckets)), "moved")

    own = moved.where(_linked() & ~F.col("again")).drop("again")
    index, key = f"{folder}/payments", ["link", "idempotency_key"]
    stored = _stored(spark, index, PAYMENT_TABLE, _touched(own), batch_id).drop(BUCKET)
    stored = _matching(stored, own, "link", "known-links")
    before = stage(latest_per_key(stored, key, [tables.BATCH]).drop(tables.BATCH), "before")
    replaced = own.select(*key).join(before.select(*key), key, "left_semi")
    after = before.join(replaced, key, "left_anti").unionByName(own.select(*before.columns))

    _write(own, index, BUCKET, batch_id)
    adjust = moved.where(F.col("event_type") == S.ADJUST).select(*before.columns)
    signed = [
        before.where("alive").withColumn("sign", F.lit(-1)),
        after.where("alive").withColumn("sign", F.lit(1)),
        adjust.withColumn("sign", F.when(F.col("alive"), 1).otherwise(-1)),
    ]
    made = signed_increments(functools.reduce(DataFrame.unionByName, signed))
    _write(made, f"{folder}/increments", "stat_date", batch_id)


def settlement_stream(
    records: DataFrame, folder: str, run: jobs.Run, valid: Callable[[DataFrame], DataFrame],
    fee_rules: Callable[[SparkSession], DataFrame], buckets: int = BUCKETS,
) -> StreamingQuery:
    """All settlement metrics with fees, exact after every micro-batch in whatever order events arrive.

    Rules are read again for each micro-batch. Nothing is dropped as late and no streaming state is kept. ``valid`` gets
    the columns ``jobs.STORE_FIELDS``.
    """
    rows = valid(ingest.parse_events(records.select("value"), lenient=True, fields=jobs.STORE_FIELDS))
    rows = rows.withColumn("event_date", clock.stat_date(F.col("event_time")))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in _EVENT])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        apply(spark, folder, batch, batch_id, fee_rules(spark), buckets)

    return jobs.start(rows, write, run)


def read_minutes(spark: SparkSession, folder: str, days=None) -> DataFrame:
    """The minute table: increments of the wanted days added up; a minute whose events all went is gone."""
    rows = tables.load_table(spark, f"{folder}/increments", jobs.settlement_table(), "stat_date", days)
    added = rows.groupBy(*S.MINUTE_KEYS).agg(*[F.sum(m).alias(m) for m in S.SETTLEMENT_METRICS])
    counts = [m for m in S.SETTLEMENT_METRICS if m.endswith("_count")]
    return added.where(F.exists(F.array(*counts), lambda c: c != 0))


def fold(spark: SparkSession, folder: str, buckets: Sequence[int]) -> None:
    """Fold the batches of some buckets of both indexes into their newest one, so that reading them stays cheap.

    Run it between micro-batches, not beside one.
    """
    tables.compact(spark, f"{folder}/keys", KEY_TABLE, ["idempotency_key"], BUCKET, buckets, ORDER)
    tables.compact(spark, f"{folder}/payments", PAYMENT_TABLE, ["link", "idempotency_key"], BUCKET, buckets)
