"""Ranking, running and moving calculations that hold when one group is most of the data.

Each function first looks for groups larger than ``max_rows`` (see ``slicing``). Without any, it
is one plain Spark window. With some, the same result is put together from bounded slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slicing import HOT, MAX_GROUP_ROWS, SLICE, Slices, attach, slice_groups


def _sorted(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _before(by: Window) -> Window:
    return by.rowsBetween(Window.unboundedPreceding, -1)


def _slice_offsets(totals: DataFrame, keys: list[str], sums: Sequence[str], descending: bool) -> DataFrame:
    """What the slices before hold, per key and slice of the cut keys.

    A window over slices, not over rows. The result is as small as the cut points are few, so it
    is broadcast and the rows stay where the windows put them.
    """
    ahead = _before(Window.partitionBy(*keys).orderBy(*_sorted([SLICE], descending)))
    return F.broadcast(
        totals.select(
            *keys,
            SLICE,
            *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"__ahead_{c}") for c in sums],
            *[F.sum(c).over(Window.partitionBy(*keys)).alias(f"__all_{c}") for c in sums],
        )
    )


def _ahead(column: str) -> Column:
    return F.coalesce(f"__ahead_{column}", F.lit(0))


RANKS = ("rank", "dense_rank", "percent_rank", "running_sum")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    wanted: dict[str, str],
    descending: bool = True,
    sum_of: str | None = None,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add tie-aware ranks of ``order`` within ``keys``.

    ``wanted`` maps any of ``rank``, ``dense_rank``, ``percent_rank`` and ``running_sum`` to the
    name of the new column. The running sum adds ``sum_of`` over all rows up to and including
    those tied with the current one (a RANGE frame).

    Where a group is too large for one task, ties are counted first: one row per (key, order
    value) is ranked, in slices, and joined back to the rows.
    """
    keys = list(keys)
    unknown = set(wanted) - set(RANKS)
    if unknown:
        raise ValueError(f"unknown rank: {sorted(unknown)}")
    sliced = slice_groups(df, keys, [order], max_rows)
    if not sliced.hot:
        by = Window.partitionBy(*keys).orderBy(*_sorted([order], descending))
        plain = {
            "rank": lambda: F.rank().over(by),
            "dense_rank": lambda: F.dense_rank().over(by),
            "percent_rank": lambda: F.percent_rank().over(by),
            "running_sum": lambda: F.sum(sum_of).over(
                by.rangeBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        }
        return df.select("*", *[plain[kind]().alias(name) for kind, name in wanted.items()])

    held = F.sum(sum_of) if sum_of else F.lit(None).cast("long")
    values = sliced.df.groupBy(*sliced.parts, HOT, order).agg(
        F.count("*").alias("__n"), held.alias("__s"), F.count(sum_of or "*").alias("__c")
    )
    totals = values.where(HOT).groupBy(*sliced.parts).agg(
        F.sum("__n").alias("__n"), F.count("*").alias("__d"), F.sum("__s").alias("__s"), F.sum("__c").alias("__c")
    )
    offsets = _slice_offsets(totals, keys, ["__n", "__d", "__s", "__c"], descending)
    part = Window.partitionBy(*sliced.parts)
    by = part.orderBy(*_sorted([order], descending))
    local = values.select(
        *sliced.parts,
        order,
        F.sum("__n").over(part).alias("__size"),
        F.coalesce(F.sum("__n").over(_before(by)), F.lit(0)).alias("__n0"),
        F.row_number().over(by).alias("__d0"),
        F.sum("__s").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__s0"),
        F.sum("__c").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__c0"),
    )
    placed = attach(local, offsets, sliced.parts, "left")
    rank = _ahead("__n") + F.col("__n0") + 1
    size = F.coalesce("__all___n", "__size")
    formula = {
        "rank": rank.cast("int"),
        "dense_rank": (_ahead("__d") + F.col("__d0")).cast("int"),
        "percent_rank": F.when(size > 1, (rank - 1) / (size - 1)).otherwise(0.0),
        # NULL, as in a window, until a value has been met
        "running_sum": F.when(_ahead("__c") + F.col("__c0") > 0, _ahead("__s") + F.coalesce(F.col("__s0"), F.lit(0))),
    }
    ranks = placed.select(
        *keys, order, *[formula[kind].alias(name) for kind, name in wanted.items()]
    )
    return attach(df, ranks, [*keys, order]).select(*df.columns, *wanted.values())


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_number",
    descending: bool = False,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add 1, 2, 3 ... within ``keys`` along ``order``, whose columns together must be unique.

    With no keys this numbers the whole table, still without one task seeing all rows.
    """
    return _numbered(slice_groups(df, keys, order, max_rows), df.columns, name, descending)


def _numbered(sliced: Slices, columns: list[str], name: str, descending: bool) -> DataFrame:
    by = Window.partitionBy(*sliced.parts).orderBy(*_sorted(sliced.order, descending))
    local = sliced.df.withColumn(name, F.row_number().over(by).cast("long"))
    if not sliced.hot:
        return local.select(*columns, name)
    totals = sliced.df.where(HOT).groupBy(*sliced.parts).agg(F.count("*").alias("__n"))
    offsets = _slice_offsets(totals, sliced.keys, ["__n"], descending)
    placed = attach(local, offsets, sliced.parts, "left")
    return placed.withColumn(name, F.col(name) + _ahead("__n")).select(*columns, name)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "row") -> DataFrame:
    """The first ``n`` rows per key. Spark keeps at most ``n`` per key and task before the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", F.row_number().over(by).alias(name)).where(F.col(name) <= n)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the sum of an integer ``value`` over all rows of the key up to this one."""
    sliced = slice_groups(df.withColumn("__v", value), keys, order, max_rows)
    by = Window.partitionBy(*sliced.parts).orderBy(*order)
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.df.withColumn(name, F.sum("__v").over(so_far)).withColumn("__c", F.count("__v").over(so_far))
    if not sliced.hot:
        return local.select(*df.columns, name)
    totals = sliced.df.where(HOT).groupBy(*sliced.parts).agg(F.sum("__v").alias("__v"), F.count("__v").alias("__c"))
    offsets = _slice_offsets(totals, sliced.keys, ["__v", "__c"], False)
    placed = attach(local, offsets, sliced.parts, "left")
    met = F.col("__c") + _ahead("__c") > 0
    return placed.withColumn(name, F.when(met, F.coalesce(name, F.lit(0)) + _ahead("__v"))).select(*df.columns, name)


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    before: int,
    after: int,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the average of ``value`` over ``before`` rows before to ``after`` rows after this one.

    The frame is shorter at both ends of a key. ``order`` must be unique within a key. A cut
    group gets copies of the few rows its frames need from the neighbouring slices.
    """
    sliced = slice_groups(df, keys, order, max_rows)
    by = Window.partitionBy(*sliced.parts).orderBy(*order).rowsBetween(-before, after)
    if not sliced.hot:
        return sliced.df.select(*df.columns, F.avg(value).over(by).alias(name))

    rows = sliced.df.withColumn("__own", F.lit(True))
    slim = sliced.df.where(HOT).select(*dict.fromkeys([*sliced.parts, *order, value]))
    cut_keys = slim.select(*sliced.parts).distinct()
    line = Window.partitionBy(*sliced.keys).orderBy(SLICE)
    halos = []
    for reach, ahead in ((before, True), (after, False)):
        if not reach:
            continue
        # the last rows of a slice are needed by the next ones, the first rows by the previous
        edge = first_rows(slim, sliced.parts, _sorted(order, ahead), reach, "__edge")
        step = F.lead if ahead else F.lag
        # a slice may hold fewer rows than the frame reaches, so look `reach` slices on
        targets = cut_keys.select(
            *sliced.parts, F.array(*[step(SLICE, i).over(line) for i in range(1, reach + 1)]).alias("__to")
        )
        copies = attach(edge, F.broadcast(targets), sliced.parts)  # one row per slice of a cut key
        copies = copies.withColumn(SLICE, F.explode(F.filter("__to", lambda t: t.isNotNull())))
        halos.append(copies.select(*slim.columns))
    extended = rows
    for halo in halos:
        extended = extended.unionByName(halo.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    averaged = extended.select("*", F.avg(value).over(by).alias(name))
    return averaged.where("__own").select(*df.columns, name)


def lists_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    name: str,
    chunk_rows: int,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Collect the rows of each key into ordered lists, ``chunk_rows`` to a list.

    One list per key would need a whole group in memory; the list is therefore cut into chunks
    numbered from 0. All rows are kept.
    """
    numbered = number_rows(df, keys, order, "__row", max_rows=max_rows)
    chunked = numbered.withColumn("chunk", F.floor((F.col("__row") - 1) / chunk_rows))
    item = F.struct("__row", *columns)
    lists = chunked.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(item)).alias("__items"))
    if len(columns) == 1:
        return lists.select(*keys, "chunk", F.col(f"__items.{columns[0]}").alias(name))
    kept = F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in columns]))
    return lists.select(*keys, "chunk", kept.alias(name))
