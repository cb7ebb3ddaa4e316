"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text's k-gram hashes are cut into windows of ``WINDOW - K + 1`` neighbours and the smallest hash
of each window is kept. Two texts that share ``WINDOW`` words in a row share all k-grams of one
such window and keep the same smallest one, so the join on kept hashes misses no shared window. A hit is
extended word by word to both sides, at most as far as a window can reach; what was extended to
``WINDOW`` words or more is hit. Longer spans are covered by their several windows.

Items shorter than ``WINDOW`` words are one window each and are looked up whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm import common

WINDOW = 13
#: Words of a k-gram; a power of two, because hashes are combined by doubling.
K = 8
REACH = WINDOW - K

#: Runs of digits, letters and everything beyond ASCII are words, after lower-casing A-Z.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Kept hashes of benchmark items up to this measured size are broadcast; a larger table is shuffled.
BROADCAST_ROWS = 200_000

_POSITION_BITS = 31
_HASH_MASK = (1 << 32) - 1


def words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, BETWEEN_WORDS), lambda w: w != "")


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _pairwise(a: Column, step: int, combine) -> Column:
    """combine(a[i], a[i + step]) for each i that has both."""
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, step + 1, n), combine)


def _with_grams(df: DataFrame, length: int, out: str) -> DataFrame:
    """Adds hashes of all runs of ``length`` words of ``words``, by doubling."""
    df = df.withColumn("_g1", F.transform("words", lambda w: F.xxhash64(w)))
    powers, size = [(1, "_g1")], 1
    while size * 2 <= length:
        name = f"_g{size * 2}"
        df = df.withColumn(name, _pairwise(F.col(f"_g{size}"), size, lambda a, b: F.xxhash64(a, b)))
        size *= 2
        powers.append((size, name))
    size, done = powers[-1]
    last = F.col(done)
    for more, name in reversed(powers[:-1]):
        if size + more <= length:
            step = size
            # the shorter run starts where the longer ends, so both have a value for each start kept
            n = F.greatest(F.size("words") - (size + more - 1), F.lit(0))
            last = F.zip_with(F.slice(last, 1, n), F.slice(F.col(name), step + 1, n), lambda a, b: F.xxhash64(a, b))
            size += more
    return df.withColumn(out, last).drop(*[name for _, name in powers])


def _kept(df: DataFrame) -> DataFrame:
    """Adds ``kept``: the smallest k-gram of each window as hash and position in one integer."""
    df = _with_grams(df, K, "_grams")
    df = df.withColumn(
        "_m1",
        F.transform(
            "_grams",
            lambda g, i: F.shiftleft(g.bitwiseAND(F.lit(_HASH_MASK)), _POSITION_BITS).bitwiseOR(i.cast("bigint")),
        ),
    )
    df = df.withColumn("_m2", _pairwise(F.col("_m1"), 1, _least))
    df = df.withColumn("_m4", _pairwise(F.col("_m2"), 2, _least))
    # windows of six: four neighbours and the two after them
    n = F.greatest(F.size("_m1") - REACH, F.lit(0))
    return df.withColumn(
        "kept", F.array_distinct(F.zip_with(F.slice("_m4", 1, n), F.slice("_m2", 5, n), _least))
    ).drop("_grams", "_m1", "_m2", "_m4")


def _around(at: Column) -> tuple[Column, Column]:
    """The first word (counted from 0) that a window over the k-gram can reach, and the context from there."""
    begin = F.greatest(at - REACH, F.lit(0))
    return begin, F.slice(F.col("words"), begin + 1, at - begin + K + REACH)


def _hits_of_windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``key, item_id, begin, end`` of matches of ``WINDOW`` words and more."""
    mask = F.lit((1 << _POSITION_BITS) - 1)

    def spread(df: DataFrame, *ids: str) -> DataFrame:
        # The outer form: a plain explode adds a filter on the array that is pushed below all these
        # projections and computes the hashes many times over.
        return df.select(*ids, "words", F.explode_outer("kept").alias("one")).filter("one is not null").select(
            *ids,
            "words",
            F.shiftrightunsigned("one", _POSITION_BITS).alias("hash"),
            F.col("one").bitwiseAND(mask).cast("int").alias("at"),
        )

    def with_context(df: DataFrame, prefix: str, *others: str) -> DataFrame:
        begin, context = _around(F.col("at"))
        return df.select(
            *others,
            F.col("at").alias(f"{prefix}_at"),
            begin.alias(f"{prefix}_begin"),
            context.alias(f"{prefix}_words"),
        )

    index = common.stage(with_context(spread(_kept(items), "item_id"), "i", "item_id", "hash"), "item-grams")
    prints = spread(_kept(docs), "key")
    if index.count() <= BROADCAST_ROWS:
        found = prints.join(F.broadcast(index), "hash")
        found = with_context(found, "d", "key", "item_id", "i_at", "i_begin", "i_words")
    else:
        found = with_context(prints, "d", "key", "hash").join(index, "hash")
    # Written before it is compared: else the comparison moves into the join, which then runs outside
    # generated code and copies all words of a document for each of its k-grams.
    found = common.stage(found, "gram-hits")
    # left and right of the k-gram, nearest word first
    left = F.zip_with(
        F.reverse(F.slice("d_words", 1, F.col("d_at") - F.col("d_begin"))),
        F.reverse(F.slice("i_words", 1, F.col("i_at") - F.col("i_begin"))),
        lambda a, b: F.coalesce(a == b, F.lit(False)),
    )
    middle = F.slice("d_words", F.col("d_at") - F.col("d_begin") + 1, K) == F.slice(
        "i_words", F.col("i_at") - F.col("i_begin") + 1, K
    )
    right = F.zip_with(
        F.slice("d_words", F.col("d_at") - F.col("d_begin") + 1 + K, REACH),
        F.slice("i_words", F.col("i_at") - F.col("i_begin") + 1 + K, REACH),
        lambda a, b: F.coalesce(a == b, F.lit(False)),
    )

    def run(flags: Column) -> Column:
        first_gap = F.array_position(flags, F.lit(False)).cast("int")
        return F.when(first_gap == 0, F.size(flags)).otherwise(first_gap - 1)

    return (
        found.filter(middle)
        .select("key", "item_id", "d_at", run(left).alias("l"), run(right).alias("r"))
        .filter(F.col("l") + K + F.col("r") >= WINDOW)
        .select("key", "item_id", (F.col("d_at") - F.col("l")).alias("begin"), (F.col("d_at") + K + F.col("r")).alias("end"))
    )


def _hits_of_short_items(docs: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """The same for items of exactly ``length`` words, fewer than a window."""
    whole = common.stage(
        _with_grams(items, length, "grams").select(
            "item_id", F.col("grams")[0].alias("hash"), F.col("words").alias("i_words")
        ),
        "short-items",
    )
    grams = (
        _with_grams(docs, length, "grams")
        .select("key", "words", F.posexplode_outer("grams").alias("at", "hash"))
        .filter("hash is not null")
    )
    if whole.count() <= BROADCAST_ROWS:
        found = grams.join(F.broadcast(whole), "hash").withColumn("d_words", F.slice("words", F.col("at") + 1, length))
    else:
        found = grams.select("key", "at", "hash", F.slice("words", F.col("at") + 1, length).alias("d_words")).join(
            whole, "hash"
        )
    return common.stage(found, "short-hits").filter("d_words = i_words").select(
        "key", "item_id", F.col("at").alias("begin"), (F.col("at") + length).alias("end")
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with one text and id give one result, so they share a key."""
    docs = common.id_text(docs, id_col, text_col)
    return docs.select("doc_id", F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("key"), "text")


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal matches ``key, item_id, begin, end`` (word positions, end excluded); spans may overlap."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), words(F.coalesce("text", F.lit(""))).alias("words")
    ).filter(F.size("words") > 0)
    items = common.stage(items, "items")
    rows = _keyed(docs, id_col, text_col).select("key", words(F.col("text")).alias("words"))
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    found = [
        _hits_of_short_items(rows, items.filter(F.size("words") == n), n)
        if n < WINDOW
        else _hits_of_windows(rows, items.filter(F.size("words") >= n))
        for n in sorted(lengths)
    ]
    if not found:
        return rows.select("key", F.lit("").alias("item_id"), F.lit(0).alias("begin"), F.lit(0).alias("end")).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _judged(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of :func:`overlaps` and the text's ``hash``."""
    found = common.stage(hits(docs, benchmark, id_col, text_col).distinct(), "hits")
    spans = found.select("key", "begin", "end").distinct()
    # hit words: what each span adds beyond the spans before it, within one document
    before = F.max("end").over(
        Window.partitionBy("key").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    )
    hit = (
        spans.withColumn("before", F.coalesce(before, F.lit(0)))
        .groupBy("key")
        .agg(F.sum(F.greatest(F.col("end") - F.greatest("begin", "before"), F.lit(0))).alias("n_hit"))
    )
    of_items = (
        found.select("key", "item_id")
        .distinct()
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sha2(F.array_join(F.array_sort(F.collect_list("item_id")), ",").cast("binary"), 256).alias("items"),
        )
    )
    by_key = hit.join(of_items, "key").select(
        F.col("key.doc_id").alias("h_id"), F.col("key.hash").alias("h_hash"), "n_hit", "n_items", "items"
    )
    rows = _keyed(docs, id_col, text_col).select(
        "doc_id", F.col("key.hash").alias("hash"), F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("bigint").alias("n_words")
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.join(by_key, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("hash") == F.col("h_hash")), "left").select(
        "doc_id",
        "hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A null or empty text has no words; an item without words has no window; items of any length
    below a window count whole. Repeated rows are returned as often as they come. A document is
    contaminated when something is hit and the hit words are at least a twentieth of all.
    """
    return _judged(docs, benchmark, id_col, text_col).drop("hash")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns; repeated rows stay repeated,
    null and empty texts stay, and an empty table gives no rows."""
    judged = _judged(docs, benchmark, id_col, text_col).filter("contaminated")
    # Written first, so that its measured size decides whether it is broadcast.
    gone = common.stage(judged.select("doc_id", "hash").distinct(), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    doc_id, text = F.col(f"doc.`{id_col}`").cast("bigint"), F.coalesce(F.col(f"doc.`{text_col}`"), F.lit(""))
    same = doc_id.eqNullSafe(gone["doc_id"]) & (F.xxhash64(text) == gone["hash"])
    return rows.join(gone, same, "left_anti").select("doc.*")
