"""Ordered numbering, ranks, running sums and previous values without one-task windows.

A window over the whole table, or over a key that holds a large part of it, would sort all of those rows in one task. A
sample of the sort columns shows which keys hold more than a fair share, and where to cut them into slices. Which slice a
row lies in is a function of the row, so rows are shuffled once, by key and slice; what the earlier slices of a key add up
to is counted for the cut keys alone, on the sort columns, and comes along with the row. Nothing of the input is written.

The input is read up to three times (sample, sums of cut keys, rows). Where that is dear, hand in a written table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lakeops.session import stable, written

SLICE = "_slice"
#: One row in so many is sampled, and a slice has at least so many sampled rows: about 30,000 rows. More than that, and
#: up to a fair share of the rows for each shuffle partition, are in a slice of a larger table.
SAMPLE_EVERY = 1024
SAMPLE_PER_SLICE = 30
#: Without keys all rows are one group, which would lie in one task as a whole: it is cut from about 1,000 rows on.
WHOLE_EVERY = 32


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``["-revenue", "customer_id"]`` -> revenue descending, customer_id ascending; nulls last."""
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    matched = F.lit(True)
    for a, b in zip(left, right):
        matched = matched & a.eqNullSafe(b)
    return matched


def _before(left: Mapping[str, Column], right: Mapping[str, Column], order: Sequence[str]) -> Column:
    """Whether ``left`` comes before ``right`` in ``order``, nulls last."""
    found = F.lit(False)
    for name in reversed(order):
        field = name.lstrip("-")
        a, b = left[field], right[field]
        ahead = (a > b) if name.startswith("-") else (a < b)
        found = (a.isNotNull() & b.isNull()) | F.coalesce(ahead, F.lit(False)) | (a.eqNullSafe(b) & found)
    return found


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``df`` written, and its rows, counted while they are."""
    seen = Observation()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return table, seen.get["rows"]


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], every: int | None = None) -> DataFrame | None:
    """``keys`` and ``cuts``: for each key with more than a fair share of the rows, the places where its slices end, each
    with the number of sampled cuts that fell on it. None where no key has.

    Which rows are sampled changes the cuts and never a result; the cuts are written. There are at most as many as
    shuffle partitions.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [name.lstrip("-") for name in order]
    narrow = df.select(*dict.fromkeys([*keys, *fields]))
    every = every or (SAMPLE_EVERY if keys else min(SAMPLE_EVERY, WHOLE_EVERY))
    sample, size = _counted(narrow.filter(F.rand(7) * every < 1), "window-sample")
    if size < SAMPLE_PER_SLICE:
        return None
    most = SAMPLE_PER_SLICE * partitions
    if size > most:
        sample = sample.filter(F.rand(11) * size < most)
    numbered = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    # At most SAMPLE_PER_SLICE rows for each partition are sorted here.
    ends = sample.withColumn("_n", F.row_number().over(numbered)).filter(F.col("_n") % SAMPLE_PER_SLICE == 0)
    placed = ends.withColumn("_place", F.struct(*[F.col(f) for f in fields]))
    # Cuts on the same place become one.
    places = placed.groupBy(*keys, "_place").agg(F.min("_n").alias("_n"), F.count(F.lit(1)).cast("int").alias("_times"))
    listed = F.array_sort(F.collect_list(F.struct("_n", "_place", "_times")))
    cuts, found = _counted(places.groupBy(*keys).agg(listed.alias("_cuts")), "window-cuts")
    return cuts if found else None


def _with_key(df: DataFrame, found: DataFrame, keys: Sequence[str], names: Sequence[str], how: str) -> DataFrame:
    """``df`` with the columns ``names`` that ``found`` has for its key; ``found`` is small, and the planner, which
    knows the size of its files, broadcasts it if it is."""
    if not keys:
        whole = found.select(F.struct(*names)).scalar()
        return df.withColumn("_found", whole).select("*", *[F.col("_found")[n].alias(n) for n in names]).drop("_found")
    renamed = found.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *names)
    matched = _same([F.col(k) for k in keys], [F.col(f"_k_{k}") for k in keys])
    return df.join(renamed, matched, how).drop(*[f"_k_{k}" for k in keys])


def _cut_below(order: Sequence[str], steps: int) -> Column:
    """The number of cuts before the row, by halving ``_cuts``."""
    row = {name.lstrip("-"): F.col(name.lstrip("-")) for name in order}

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        cut = F.get("_cuts", middle)["_place"]
        ahead = (state["low"] < state["high"]) & _before({f: cut[f] for f in row}, row, order)
        low = F.when(ahead, middle + 1).otherwise(state["low"])
        return F.struct(low.alias("low"), F.when(ahead, state["high"]).otherwise(F.least(state["high"], middle)).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size("_cuts").alias("high"))
    return F.aggregate(F.array(*[F.lit(0)] * steps), start, halved, lambda state: state["low"])


def _steps(df: DataFrame) -> int:
    """Halvings that find a place among as many cuts as there can be."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length() + 1


def ordered_window(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    row_number: str | None = None,
    running: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    sample_every: int | None = None,
) -> DataFrame:
    """Add ``row_number``, ``running`` sums ``{out: column}`` and ``previous`` values ``{out: column}``.

    ``order`` must be unique within ``keys`` for a repeatable result. ``previous`` takes an
    ascending order only. A smaller ``sample_every`` cuts smaller tables, for rows that are dear to handle.
    """
    running, previous = dict(running or {}), dict(previous or {})
    if previous and any(name.startswith("-") for name in order):
        raise ValueError("previous values need an ascending order")
    keys = list(keys)
    cuts = _cuts(df, keys, order, sample_every)
    sliced = df if cuts is None else _carried(df, order, keys, cuts, running, previous)
    within = Window.partitionBy(*keys, *([] if cuts is None else [SLICE])).orderBy(*sort_columns(order))
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def carried(name: str) -> Column:
        return F.lit(None) if cuts is None else F.col("_carry")[name]

    local = F.row_number().over(within).cast("bigint")
    values: dict[str, Column] = {}
    if row_number:
        values[row_number] = local + F.coalesce(carried("rows"), F.lit(0))
    for out, name in running.items():
        here, earlier = F.sum(name).over(so_far), carried(f"sum_{out}")
        # A group's earlier rows may all be null, and so may this slice's: keep SUM's null then.
        values[out] = F.when(here.isNull(), earlier).otherwise(here + F.coalesce(earlier, F.lit(0)))
    for out, name in previous.items():
        values[out] = F.when(local == 1, carried(f"last_{out}")).otherwise(F.lag(name).over(within))
    return sliced.select(*df.columns, *[value.alias(out) for out, value in values.items()])


def _carried(df: DataFrame, order, keys, cuts: DataFrame, running, previous) -> DataFrame:
    """``df`` with the slice of each row and ``_carry``: rows, sums and last values of its key's earlier slices."""
    slice_of = F.when(F.col("_cuts").isNull(), 0).otherwise(_cut_below(order, _steps(df)))
    fields = [name.lstrip("-") for name in order]
    needed = dict.fromkeys([*keys, *fields, *running.values(), *previous.values()])
    place = F.struct(*[_nulls_last(name) for name in order]) if previous else None
    sums = (
        _with_key(df.select(*needed), cuts, keys, ["_cuts"], "inner")
        .withColumn(SLICE, slice_of)
        .groupBy(*keys, SLICE)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(name).alias(f"_sum_{out}") for out, name in running.items()],
            *[F.struct(F.max_by(F.col(name), place).alias("v")).alias(f"_last_{out}") for out, name in previous.items()],
        )
    )
    by_slice = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = F.struct(
        F.sum("_rows").over(by_slice).alias("rows"),
        *[F.sum(f"_sum_{out}").over(by_slice).alias(f"sum_{out}") for out in running],
        *[F.last(f"_last_{out}", True).over(by_slice)["v"].alias(f"last_{out}") for out in previous],
    )
    found = _carry_lists(cuts, sums, keys, F.size("_cuts"), carry)
    joined = _with_key(df, found, keys, ["_cuts", "_carries"], "left").withColumn(SLICE, slice_of)
    return joined.withColumn("_carry", F.get("_carries", F.col(SLICE))).drop("_cuts", "_carries")


def _carry_lists(cuts: DataFrame, sums: DataFrame, keys, last_slice: Column, carry: Column) -> DataFrame:
    """``cuts`` with ``_carries``: for each slice of a key, empty ones too, ``carry`` over the slices before it. A row per
    cut key and a list entry per slice: both are bounded by the number of shuffle partitions."""
    names = [f"_c_{k}" for k in keys]
    every = cuts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.explode(F.sequence(F.lit(0), last_slice)).alias("_at"))
    matched = (F.col("_at") == F.col(SLICE)) & _same([F.col(n) for n in names], [F.col(k) for k in keys])
    filled = every.join(sums, matched, "left").drop(*keys, SLICE).withColumnsRenamed(dict(zip(names, keys)) | {"_at": SLICE})
    listed = F.array_sort(F.collect_list(F.struct(F.col(SLICE).alias("at"), F.col("_carry"))))
    lists = filled.withColumn("_carry", carry).groupBy(*keys).agg(F.transform(listed, lambda one: one["_carry"]).alias("_carries"))
    return written(_with_key(cuts, lists, keys, ["_carries"], "inner"), "window-carries")


def _nulls_last(name: str) -> Column:
    return F.struct(F.col(name).isNull().alias("n"), F.col(name).alias("v")).alias(name)


def ranked(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    rank: str | None = None,
    dense_rank: str | None = None,
) -> DataFrame:
    """RANK and DENSE_RANK in one shuffle of the rows, whatever their ties.

    Equal values lie in one slice. A value that holds so many rows that a cut falls on it has a slice of its own, where
    every row has the same rank, so its rows are dealt out over several tasks.
    """
    keys = list(keys)
    cuts = _cuts(df, keys, order)
    sliced = df if cuts is None else _carried_ranks(df, order, keys, cuts, dense_rank is not None)
    within = Window.partitionBy(*keys, *([] if cuts is None else [SLICE, "_part"])).orderBy(*sort_columns(order))

    def placed(local: Column, name: str) -> Column:
        earlier = F.lit(0) if cuts is None else F.coalesce(F.col("_carry")[name], F.lit(0))
        return local.over(within).cast("bigint") + earlier

    return sliced.select(
        *df.columns,
        *([placed(F.dense_rank(), "levels").alias(dense_rank)] if dense_rank else []),
        *([placed(F.rank(), "rows").alias(rank)] if rank else []),
    )


def _carried_ranks(df: DataFrame, order, keys, cuts: DataFrame, dense: bool) -> DataFrame:
    """``df`` with slice, part of the slice, and the rows and distinct values of its key's earlier slices.

    Of n cuts the even slices 0, 2 .. 2n lie between them and the odd ones on them.
    """
    fields = [name.lstrip("-") for name in order]
    next_cut = F.get("_cuts", F.col("_below"))
    on_cut = F.coalesce(_same([F.col(f) for f in fields], [next_cut["_place"][f] for f in fields]), F.lit(False))
    # Past the last cut there is none to lie on, also where the row's values are all null.
    on_cut = on_cut & next_cut.isNotNull()

    def cut(rows: DataFrame) -> DataFrame:
        below = F.when(F.col("_cuts").isNotNull(), _cut_below(order, _steps(df)))
        number = F.coalesce(2 * F.col("_below") + on_cut.cast("int"), F.lit(0))
        return rows.withColumn("_below", below).withColumn(SLICE, number)

    narrow = df.select(*dict.fromkeys([*keys, *fields]))
    levels = F.count_distinct(F.struct(*[_nulls_last(f) for f in fields])) if dense else F.lit(0)
    sums = (
        cut(_with_key(narrow, cuts, keys, ["_cuts"], "inner"))
        .groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_rows"), (levels if dense else F.max(levels)).alias("_levels"))
    )
    by_slice = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = F.struct(F.sum("_rows").over(by_slice).alias("rows"), F.sum("_levels").over(by_slice).alias("levels"))
    found = _carry_lists(cuts, sums, keys, 2 * F.size("_cuts"), carry)
    joined = cut(_with_key(df, found, keys, ["_cuts", "_carries"], "left"))
    part = F.when(on_cut, F.pmod(F.xxhash64(*df.columns), next_cut["_times"])).otherwise(F.lit(0))
    dealt = joined.withColumn("_part", part).withColumn("_carry", F.get("_carries", F.col(SLICE)))
    return dealt.drop("_cuts", "_carries", "_below")


def ntile(df: DataFrame, buckets: int, order: Sequence[str], out: str) -> DataFrame:
    """NTILE over the whole table: the first ``n mod buckets`` buckets hold one row more."""
    numbered = ordered_window(df, order, row_number="_r")
    size = df.agg(F.count(F.lit(1))).scalar()
    base, extra = F.floor(size / buckets), size % buckets
    long_part = extra * (base + 1)
    bucket = F.when(F.col("_r") <= long_part, F.ceil(F.col("_r") / (base + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("_r") - long_part, base))
    )
    return numbered.withColumn(out, bucket.cast("bigint")).drop("_r")


def top_by_rank(df: DataFrame, k: int, order: str, out: str) -> DataFrame:
    """Rows whose RANK by one column is at most ``k``, ties kept.

    The k-th largest value bounds the answer, so at most ``k`` distinct values are ranked.
    """
    name = order.lstrip("-")
    base = stable(df)
    first = base.orderBy(*sort_columns([order])).limit(k)
    bound = first.agg(F.min(name) if order.startswith("-") else F.max(name)).scalar()
    kept = base.filter(F.col(name) >= bound if order.startswith("-") else F.col(name) <= bound)
    levels = kept.groupBy(F.col(name).alias("_level")).agg(F.count(F.lit(1)).alias("_ties"))  # at most k rows
    by_level = Window.orderBy(F.col("_level").desc() if order.startswith("-") else F.col("_level"))
    before = F.sum("_ties").over(by_level.rowsBetween(Window.unboundedPreceding, -1))
    levels = levels.select("_level", (F.coalesce(before, F.lit(0)) + 1).alias(out))
    return kept.join(F.broadcast(levels), F.col(name) == F.col("_level")).drop("_level")


def surrogate_keys(df: DataFrame, order: Sequence[str], out: str, start: int | Column = 0) -> DataFrame:
    """Dense keys ``start + 1 ..`` in the given order."""
    first = start if isinstance(start, Column) else F.lit(start)
    return ordered_window(df, order, row_number="_r").withColumn(out, F.col("_r") + first).drop("_r")
