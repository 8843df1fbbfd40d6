"""Duplicates and references: keep one row per key, mark repeats, find orphans.

One row per key is folded by an aggregate with partial results before the shuffle, so a key
that fills a third of the table costs one row per input partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import broadcast_limit, fits_broadcast, written

#: One key in so many tells about how many keys lack a parent. A file holds them in a quarter of their bytes at best.
SLICE_EVERY = 64
PACKED = 4


def _fold(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    folded = df.groupBy(*keys).agg(pick.alias("_row"))
    return folded.select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    rest = [name for name in df.columns if name not in keys]
    return _fold(df, keys, F.min_by(F.struct(*rest), F.struct(*order, *[r for r in rest if r not in order])))


def drop_repeats(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest one where a key repeats; a row without key is dropped.

    Keys that may occur more than once are found first, by a digest of the key column alone, and written.
    Rows of all other keys pass through unmoved where the repeated keys are few enough to be
    broadcast; only repeated rows are compared. Meant for a stored table, which it scans
    three times.
    """
    once, again = _by_repeats(df, key)
    return once.unionByName(keep_first(again, [key], []))


def keep_latest(df: DataFrame, keys: Sequence[str], updated: str) -> DataFrame:
    """The row with the largest ``updated`` per key; a missing time loses, equal times are settled
    by the remaining columns. Exact copies fold into one row on the way."""
    rest = [name for name in df.columns if name not in keys]
    return _fold(df, keys, F.max_by(F.struct(*rest), F.struct(updated, *[r for r in rest if r != updated])))


def spread_nulls(key: str, by: str) -> Column:
    """A join key that sends rows with a null key to many tasks, by another column of theirs.

    The substitute matches nothing.
    """
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\u0000"), F.xxhash64(by).cast("string")))


def mark_repeats(df: DataFrame, key: str, order: str, out: str) -> DataFrame:
    """True on rows that are not the first of their key. ``order`` must be unique per key.

    Only keys that occur more than once are joined back. They are few in most feeds, so they
    are written first: then their true size decides whether the wide rows have to be shuffled
    at all. A null key is never a repeat.
    """
    repeated = written(
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("_key"))
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "repeated",
    )
    joined = df.withColumn("_at", spread_nulls(key, order)).join(repeated, F.col("_at") == F.col("_key"), "left")
    late = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
    return joined.withColumn(out, late).drop("_at", "_key", "_first")


def mark_missing_parent(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, out: str, by: str
) -> DataFrame:
    """True on rows whose key is not found in ``parent``; a null key is missing too.

    Rows with a null key are spread over the tasks by the column ``by``.
    """
    known = parent.select(F.col(parent_key).cast("string").alias("_known")).filter("_known IS NOT NULL").distinct()
    joined = df.withColumn("_at", spread_nulls(key, by)).join(known, F.col("_at") == F.col("_known"), "left")
    return joined.withColumn(out, F.col("_known").isNull()).drop("_at", "_known")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent; rows with a null key are orphans as well, and stay out of the join."""
    known = parent.select(F.col(parent_key).alias("_known"))
    named = child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_known"), "left_anti")
    return child.filter(F.col(key).isNull()).unionByName(named)


def orphan_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``rows``: how many rows :func:`orphans` has. Children are folded to their keys before they meet the parents."""
    folded = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return orphans(folded, key, parent, parent_key).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"))


def _by_repeats(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is there once, and those whose key may repeat, every one that does among them; null keys are
    in neither.

    Digests of eight bytes are counted instead of the keys, so what moves of a long text key is a fraction of it. Digests
    that occur more than once are written; where two keys share one, an exact look at the second part tells.
    """
    held = df.filter(F.col(key).isNotNull()).withColumn("_digest", F.xxhash64(key))
    twice = held.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_digest")
    twice = written(twice, "repeated-digests")
    once, again = (held.join(twice, "_digest", how).drop("_digest") for how in ("left_anti", "left_semi"))
    return once, again


def suspects(df: DataFrame, key: str) -> DataFrame:
    """The rows whose key may repeat, every one that does among them; without the null keys."""
    return _by_repeats(df, key)[1]


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("times_repeated")).filter("times_repeated > 1")


def mark_rows(
    df: DataFrame,
    order: str,
    repeats: Sequence[tuple[str, str]],
    missing: Sequence[tuple[str, DataFrame, str, str]],
) -> DataFrame:
    """Rows with flags, where the rows themselves move once at most.

    ``repeats`` are (key, flag): true on rows that are not the first of their key by ``order``, never on a null key.
    ``missing`` are (key, parent, parent's key, flag): true on rows whose key the parent lacks, also on a null key.

    The keys alone meet each other and the parents, and the keys that fail are written. Their true sizes decide: where all
    of them but one are small enough to be broadcast, rows meet them directly and move for that one only, or not at
    all. Else the failing keys are folded to one small verdict for each combination of keys that has a flag, and rows
    meet the verdicts once, by a digest of their keys. Where a slice of the keys shows that too many lack a parent to be
    broadcast, they are not looked for beforehand: what meets the rows is the parent then.
    """
    names = list(dict.fromkeys([key for key, _ in repeats] + [key for key, *_ in missing]))
    keys = df.select(order, *names)
    failing: list[tuple[DataFrame, str, str, Callable[[Column], Column]]] = []
    for key, out in repeats:
        firsts = suspects(keys.select(order, key), key).groupBy(F.col(key).alias("_key")).agg(
            F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")
        )
        firsts = written(firsts.filter("_n > 1").drop("_n"), "repeated")
        failing.append((firsts, key, out, lambda _: F.coalesce(F.col(order) > F.col("_first"), F.lit(False))))
    for key, parent, parent_key, out in missing:
        held = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
        known = parent.select(F.col(parent_key).alias("_known"))
        if _many_lost(held, known):
            # Written, so that their true size decides which side of the join is hashed.
            found = written(known.filter(F.col("_known").isNotNull()).distinct().toDF("_key"), "parents")
            failing.append((found, key, out, lambda _: F.col("_key").isNull()))
            continue
        lost = written(held.join(known, F.col("_key") == F.col("_known"), "left_anti"), "missing-parents")
        failing.append((lost, key, out, lambda void: F.col("_key").isNotNull() | void))
    small = [fits_broadcast(found) for found, *_ in failing]
    # The one that may be large comes last, so that rows carry the other flags when they move.
    failing = [entry for _, entry in sorted(zip(small, failing), key=lambda pair: not pair[0])]
    flags = [out for *_, out in repeats] + [out for *_, out in missing]
    if small.count(False) <= 1:
        marked = df
        for (found, key, out, test), light in zip(failing, sorted(small, reverse=True)):
            if light:
                joined = marked.join(found, F.col(key) == F.col("_key"), "left")
            else:
                held = marked.withColumn("_at", spread_nulls(key, order))
                joined = held.join(found, F.col("_at") == F.col("_key").cast("string"), "left").drop("_at")
            marked = joined.withColumn(out, test(F.col(key).isNull())).drop(*found.columns)
        return marked.select(*df.columns, *flags)
    judged = keys
    for found, key, out, test in failing:
        joined = judged.join(found, F.col(key) == F.col("_key"), "left")
        judged = joined.withColumn(out, test(F.col(key).isNull())).drop(*found.columns)
    digest = {f"_d{k}": _key_digest([order, *names], k) for k in range(2)}
    any_flag = F.greatest(*[F.col(flag).cast("int") for flag in flags], F.lit(0)) == 1
    verdicts = judged.filter(any_flag).withColumns(digest).groupBy("_d0", "_d1").agg(*[F.max(f).alias(f) for f in flags])
    marked = df.withColumns(digest).join(written(verdicts, "verdicts"), ["_d0", "_d1"], "left").drop("_d0", "_d1")
    return marked.withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in flags})


def _many_lost(held: DataFrame, known: DataFrame) -> bool:
    """Whether the keys ``held`` that are not ``known`` look too many to be broadcast, by one key in SLICE_EVERY."""

    def cut(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.pmod(F.xxhash64(name), F.lit(SLICE_EVERY)) == 0)

    lost = cut(held, "_key").join(cut(known, "_known"), F.col("_key") == F.col("_known"), "left_anti")
    size = lost.agg(F.sum(F.octet_length(F.col("_key").cast("string")) + 4)).first()[0] or 0
    return size * SLICE_EVERY > PACKED * broadcast_limit(held)


def _key_digest(names: Sequence[str], seed: int) -> Column:
    """64 bits of some columns, where null differs from every value; two seeds together tell any keys apart."""
    parts = [part for name in names for part in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(F.lit(seed), *parts)
