"""Fee rules: validity, as-of lookup, pricing, and the link of corrections to payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import schemas as S
from tillstream.functions import clock, money
from tillstream.operators.asof import asof_lookup, intervals, last_below
from tillstream.operators.ordered import running
from tillstream.operators.skew import lookup_join, salted_join
from tillstream.session import stage

TERMS = [
    "rule_version", "rate_type", "rate_pct", "fixed_fee", "floor_amount", "cap_amount",
]

# The rule of a tenant that never had one.
DEFAULT_RULE = {
    "rule_version": 0,
    "rate_type": "percent",
    "rate_pct": 0.03,
    "fixed_fee": 0,
    "floor_amount": 0,
    "cap_amount": 500_000,
}

TERM_TYPES = {
    "rule_version": "int", "rate_type": "string", "rate_pct": "double",
    "fixed_fee": "bigint", "floor_amount": "bigint", "cap_amount": "bigint",
}


def _terms(source: Column) -> Column:
    return F.struct(*[source[t].cast(TERM_TYPES[t]).alias(t) for t in TERMS])


def _default_terms() -> Column:
    return F.struct(
        *[F.lit(v).cast(TERM_TYPES[k]).alias(k) for k, v in DEFAULT_RULE.items()]
    )


def rule_intervals(rules: DataFrame) -> DataFrame:
    """Validity of each rule within its tenant, method and channel."""
    return intervals(
        rules, ["tenant_id", "pay_method", "channel_id"], "effective_time", "rule_version"
    )


def _lookup(
    pay: DataFrame, rules: DataFrame, keys: list[str], name: str, at: str, before_first: str
) -> DataFrame:
    dim = rules.select(*keys, "effective_time", *TERMS)
    return asof_lookup(
        pay, dim, keys, at, "effective_time", name, "rule_version", before_first
    )


def with_rule(
    pay: DataFrame,
    rules: DataFrame,
    by_dimension: bool = False,
    known_at: str | None = None,
    at: str = "event_time",
) -> DataFrame:
    """Add struct ``rule``: the terms in force for each payment.

    Before the first rule of a tenant its first rule applies; a tenant without
    rules gets the default. ``by_dimension`` lets rules for a method or channel
    win over ``*``: method and channel, then method, then channel, then neither.
    Each of the four groups is its own as-of lookup over the distinct cases, so payments are never
    multiplied or shuffled for the ranking. ``known_at`` names a column: only
    rules that had arrived by then count.
    """
    if known_at:
        return _with_known_rule(pay, rules, known_at, at)
    if not by_dimension:
        found = _lookup(pay, rules, ["tenant_id"], "_rule", at, "first")
        return found.select(
            *pay.columns, F.coalesce(_optional("_rule"), _default_terms()).alias("rule")
        )
    any_method, any_channel = F.col("pay_method") == "*", F.col("channel_id") == "*"
    groups = {
        "_both": (~any_method & ~any_channel, ["tenant_id", "pay_method", "channel_id"]),
        "_method": (~any_method & any_channel, ["tenant_id", "pay_method"]),
        "_channel": (any_method & ~any_channel, ["tenant_id", "channel_id"]),
        "_any": (any_method & any_channel, ["tenant_id"]),
    }
    # Each distinct case is looked up, so the payments themselves are joined once.
    dims = ["tenant_id", "pay_method", "channel_id", at]
    marks = {f"_{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in dims}
    found = stage(pay.select(*dims).distinct(), "cases")
    for name, (group, keys) in groups.items():
        first = "first" if name == "_any" else "null"
        found = _lookup(found, rules.where(group), keys, name, at, first)
    ruled = found.withColumns(marks).select(
        *marks, F.coalesce(*[_optional(n) for n in groups], _default_terms()).alias("rule")
    )
    return lookup_join(pay.withColumns(marks), ruled, list(marks), derived=True).select(*pay.columns, "rule")


def _optional(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), _terms(F.col(name)))


def _with_known_rule(pay: DataFrame, rules: DataFrame, known_at: str, at: str) -> DataFrame:
    def rank(time: str, name: str) -> DataFrame:
        counts = running(rules, ["tenant_id"], time, {"n": (F.lit(1), "sum")}, clock.DAY_MS)
        return counts.select("tenant_id", time, F.col("n_upto").alias(name))

    ranked = (
        rules.select("tenant_id", "effective_time", "ingest_time", *TERMS)
        .join(rank("effective_time", "eff_rank"), ["tenant_id", "effective_time"])
        .join(rank("ingest_time", "known_rank"), ["tenant_id", "ingest_time"])
    )
    ranked = stage(ranked, "rules")
    by_effect = ranked.select("tenant_id", "effective_time", *TERMS, "eff_rank", "known_rank")
    by_arrival = ranked.select("tenant_id", "ingest_time", "rule_version", "known_rank")
    found = asof_lookup(
        pay, by_effect, ["tenant_id"], at, "effective_time", "_rule", "rule_version", "first"
    )
    found = asof_lookup(
        found, by_arrival, ["tenant_id"], known_at, "ingest_time", "_known", "rule_version"
    )
    found = found.withColumns(
        {
            "_eff": F.col("_rule.eff_rank"),
            "_seen": F.coalesce("_known.known_rank", F.lit(0)),
            "_ok": F.col("_rule.known_rank") <= F.coalesce("_known.known_rank", F.lit(0)),
        }
    )
    # Payments that came before the rule in force did: settle each distinct
    # (tenant, rule, state of knowledge) once, then hand the answer back.
    open_cases = (
        found.where("not _ok")
        .withColumn("_now", F.col("_rule.effective_time") <= F.col(at))
        .where("_now")
        .select("tenant_id", "_eff", "_seen")
        .distinct()
    )
    cases = stage(
        open_cases.select(
            "tenant_id", F.col("_eff").alias("pos"), F.col("_seen").alias("bound")
        ),
        "cases",
    )
    points = ranked.select(
        "tenant_id", F.col("eff_rank").alias("rank"), F.col("known_rank").alias("low")
    )
    older = last_below(cases, points, "tenant_id").select(
        "tenant_id",
        F.col("pos").alias("_eff"),
        F.col("bound").alias("_seen"),
        F.col("rank").alias("eff_rank"),
    )
    terms = ranked.select("tenant_id", "eff_rank", "known_rank", F.struct(*TERMS).alias("_terms"))
    # Several versions of one effective time share a rank; the highest known one counts.
    settled = (
        lookup_join(older, terms, ["tenant_id", "eff_rank"], "inner")
        .where("known_rank <= _seen")
        .groupBy("tenant_id", "_eff", "_seen")
        .agg(F.max("_terms").alias("_older"))
    )
    found = lookup_join(found, settled, ["tenant_id", "_eff", "_seen"], derived=True)
    rule = F.when(F.col("_ok"), _optional("_rule")).otherwise(_optional("_older"))
    return found.select(*pay.columns, F.coalesce(rule, _default_terms()).alias("rule"))


def rule_backfill(pay: DataFrame, rules: DataFrame, known_at: str = "ingest_time") -> DataFrame:
    """Payments priced by another rule than the one in force, because it came late."""
    both = with_rule(pay, rules, known_at=known_at).withColumnRenamed("rule", "known_rule")
    both = with_rule(both, rules)
    return both.where(
        F.col("known_rule.rule_version") != F.col("rule.rule_version")
    )


def fee_of(amount: Column, rule: Column) -> Column:
    return money.fee(
        amount,
        rule["rate_type"],
        rule["rate_pct"],
        rule["fixed_fee"],
        rule["floor_amount"],
        rule["cap_amount"],
    )


def priced(pay: DataFrame) -> DataFrame:
    """Fee and settlement of payments that carry ``rule``."""
    rule = F.col("rule")
    made = {
        "take_rate_rule_version": rule["rule_version"],
        "take_rate_pct": rule["rate_pct"],
        "take_rate_fixed_fee": rule["fixed_fee"],
        "take_rate_amount": fee_of(F.col("amount_minor"), rule),
    }
    return pay.withColumns(made).withColumn(
        "settlement_amount",
        money.settlement(F.col("amount_minor"), F.col("take_rate_amount")),
    )


def attach_payment(corrections: DataFrame, pay: DataFrame) -> DataFrame:
    """Corrections with ``paid`` (time, amount, rule of the original payment) or null."""
    paid = pay.select(
        "payment_id",
        F.struct(
            F.col("event_time"),
            F.col("amount_minor"),
            *([F.col("rule")] if "rule" in pay.columns else []),
        ).alias("paid"),
    )
    return salted_join(corrections, paid, ["payment_id"], "left")


def orphans(corrections: DataFrame, pay: DataFrame) -> DataFrame:
    """Corrections whose payment does not exist."""
    return salted_join(corrections, pay.select("payment_id"), ["payment_id"], "left_anti")


def priced_corrections(attached: DataFrame) -> DataFrame:
    """Signed legs by the rule of the payment; an orphan moves its face value without a fee."""
    rule = F.col("paid.rule")
    amount_abs = F.abs("amount_minor")
    fee_abs = F.when(F.col("paid").isNotNull(), fee_of(amount_abs, rule)).otherwise(F.lit(0))
    legs = money.correction_legs(amount_abs, fee_abs)
    out = attached.withColumns(
        {
            "take_rate_rule_version": rule["rule_version"],
            "take_rate_pct": rule["rate_pct"],
            "take_rate_fixed_fee": F.lit(None).cast("bigint"),
            "_legs": legs,
        }
    )
    return out.withColumns(
        {
            "take_rate_amount": F.col("_legs.take_rate_amount"),
            "settlement_amount": F.col("_legs.settlement_amount"),
        }
    ).drop("_legs", "paid")


def settled_events(events: DataFrame, rules: DataFrame) -> DataFrame:
    """All money events, one row per key, with rule version, fee and settlement."""
    kind = F.col("event_type")
    pay = with_rule(events.where(kind == S.PAY), rules)
    fixes = events.where(kind.isin(S.REFUND, S.CHARGEBACK))
    adjust = events.where(kind == S.ADJUST).withColumns(
        {
            "take_rate_rule_version": F.lit(None).cast("int"),
            "take_rate_pct": F.lit(None).cast("double"),
            "take_rate_fixed_fee": F.lit(None).cast("bigint"),
            "take_rate_amount": F.lit(0).cast("bigint"),
            "settlement_amount": F.col("amount_minor"),
        }
    )
    fixed = priced_corrections(attach_payment(fixes, pay))
    return priced(pay).drop("rule").unionByName(fixed).unionByName(adjust)


def payment_chain(settled: DataFrame) -> DataFrame:
    """Per payment: rule, fee, settlement, and what its corrections did to it."""
    kind, amount = F.col("event_type"), F.col("amount_minor")
    pay, refund, back = kind == S.PAY, kind == S.REFUND, kind == S.CHARGEBACK
    fix_time = F.when(~pay, F.col("event_time"))
    return (
        settled.where(kind.isin(S.PAY, S.REFUND, S.CHARGEBACK) & F.col("payment_id").isNotNull())
        .groupBy("payment_id")
        .agg(
            F.max(F.when(pay, F.col("take_rate_rule_version"))).alias("rule_version"),
            F.sum(F.when(pay, amount)).alias("pay_amount"),
            F.sum(F.when(pay, F.col("take_rate_amount"))).alias("fee_amount"),
            F.sum(F.when(pay, F.col("settlement_amount"))).alias("settlement_amount"),
            F.count_if(refund).alias("refund_count"),
            F.coalesce(F.sum(F.when(refund, -amount)), F.lit(0)).alias("refund_amount"),
            F.count_if(back).alias("chargeback_count"),
            F.coalesce(F.sum(F.when(back, -amount)), F.lit(0)).alias("chargeback_amount"),
            F.sum("take_rate_amount").alias("fee_after"),
            F.sum("settlement_amount").alias("settlement_after"),
            F.min(fix_time).alias("first_fix_time"),
            F.max(fix_time).alias("last_fix_time"),
        )
    )


def payment_steps(settled: DataFrame) -> DataFrame:
    """The correction chain in time order: change and balance per payment and time."""
    money_rows = settled.where(
        F.col("event_type").isin(S.PAY, S.REFUND, S.CHARGEBACK) & F.col("payment_id").isNotNull()
    )
    steps = running(
        money_rows,
        ["payment_id"],
        "event_time",
        {
            "events": (F.lit(1), "sum"),
            "amount": (F.col("amount_minor"), "sum"),
            "settled": (F.col("settlement_amount"), "sum"),
        },
        block=clock.DAY_MS,
    )
    return steps.select(
        "payment_id",
        "event_time",
        "events",
        F.col("events_upto").alias("step"),
        F.col("amount").alias("change"),
        F.col("amount_upto").alias("balance"),
        F.col("settled_upto").alias("settlement_balance"),
    )
