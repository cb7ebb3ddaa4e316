"""Joins and aggregates that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import stage

# A side is broadcast only after its serialised size was measured below this.
BROADCAST_BYTES = 64 << 20
# More rows than this of one key (bucket) are spread over SALTS tasks in a shuffle join.
HOT_ROWS = 1_000_000
SALTS = 64
KEY_BUCKETS = 65_536


def measured_bytes(df: DataFrame, weight: Column | None = None) -> int:
    """Text size of all rows, each counted ``weight`` times; one small aggregate job."""
    size = F.octet_length(F.to_json(F.struct(*df.columns))).cast("long") + 16
    if weight is not None:
        size = size * weight
    return df.agg(F.sum(size)).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def content_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """Salt from the row content: the same on every retry of a task."""
    return F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more than ``hot_rows`` rows; there are fewer of them than rows / ``hot_rows``."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*keys, F.lit(True).alias("_hot"))
    )


def _key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")


def hot_buckets(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hash buckets of the key that hold far more rows than the average one.

    Counting buckets instead of keys merges almost everything before the
    shuffle, however many keys there are. There are at most ``KEY_BUCKETS / 4``.
    """
    counts = df.groupBy(_key_bucket(keys).alias("_bucket")).agg(F.count("*").alias("_rows"))
    average = counts.agg((F.sum("_rows") / KEY_BUCKETS).alias("a")).scalar()
    busy = counts.where(F.col("_rows") > F.greatest(F.lit(hot_rows), 4 * average))
    return busy.select("_bucket", F.lit(True).alias("_hot"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join of two large sides that spreads the hot keys of the left one.

    Left rows of a hot key bucket go to ``salts`` tasks and the right rows of
    that bucket are copied to each; all other rows move once, as in a plain
    join. Left rows with a null key never match and are spread as well.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    on = list(on)
    bucket = _key_bucket(on).alias("_bucket")
    keyed = left.dropna(subset=on)
    # Counted once for both sides; at most KEY_BUCKETS / 4 rows.
    hot = F.broadcast(stage(hot_buckets(keyed, on, hot_rows), "hot-buckets"))
    no_key = F.lit(False)
    for k in on:
        no_key = no_key | F.col(k).isNull()
    spread = F.coalesce(F.col("_hot"), no_key)
    left_salted = left.select("*", bucket).join(hot, "_bucket", "left").select(
        *left.columns,
        F.when(spread, content_salt(left, salts)).otherwise(F.lit(0)).alias("_salt"),
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right_salted = right.select("*", bucket).join(hot, "_bucket", "left").select(
        *right.columns, F.explode(copies).alias("_salt")
    )
    return left_salted.join(right_salted, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", derived: bool = False
) -> DataFrame:
    """Join to a table that is usually small: broadcast when measured small, else salted.

    ``derived`` marks a table computed from facts: it is written first, so that
    measuring it does not compute it a second time.
    """
    if derived:
        dim = stage(dim, "lookup")
    if fits_broadcast(dim):
        return left.join(F.broadcast(dim), list(on), how)
    return salted_join(left, dim, on, how)


def two_stage(
    df: DataFrame, keys: Sequence[str], sums: dict[str, Column], salts: int, salt_by: Column
) -> DataFrame:
    """Sums by ``keys`` over ``keys + salt`` first, merged in a second pass."""
    partial = df.groupBy(*keys, F.pmod(F.xxhash64(salt_by), F.lit(salts)).alias("_salt")).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    return partial.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums])


def isolate_hot(
    df: DataFrame, key: str, limit: int, sums: dict[str, Column], salts: int, salt_by: Column
) -> DataFrame:
    """Sums by ``key``: keys above ``limit`` rows on the salted path, the others direct."""
    hot = stage(hot_keys(df, [key], limit), "hot-keys")
    marked = df.join(F.broadcast(hot) if fits_broadcast(hot) else hot, key, "left")
    busy = two_stage(marked.where("_hot"), [key], sums, salts, salt_by)
    calm = marked.where("_hot is null").groupBy(key).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    return busy.withColumn("path", F.lit("salted")).unionByName(
        calm.withColumn("path", F.lit("direct"))
    )
