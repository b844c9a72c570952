"""Generic OLAP operators over DataFrames.

Each is a composition of built-in DataFrame operations, so Catalyst plans
and optimizes it with the rest of the query: per-group top-k becomes a
Window with a ``WindowGroupLimit`` below the shuffle, period growth shares
one Window node for all its LAGs, roll-ups are one ``Expand`` + aggregate.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.measures import exact_avg, growth_pct, safe_div


def _cols(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


# -- ranking ----------------------------------------------------------------

def top_n_per_group(df: DataFrame, partition_by, order_by, n: int,
                    rank_col: str = "rank", method: str = "rank") -> DataFrame:
    """Rows ranked within each group, keeping rank <= n.

    ``rank`` keeps ties (so a group can return more than n rows),
    ``dense_rank`` and ``row_number`` are the alternatives. Spark pushes a
    partial ``WindowGroupLimit`` below the shuffle, so a group with a large
    share of the rows is cut to its top rows inside each task first.
    """
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    return df.withColumn(rank_col, fn().over(w).cast("int")).filter(F.col(rank_col) <= n)


def top_n(df: DataFrame, order_by, n: int) -> DataFrame:
    """Global top-k (``TakeOrderedAndProject``: per-task top-k, then a merge)."""
    return df.orderBy(*_cols(order_by)).limit(n)


# -- period over period -----------------------------------------------------

def period_growth(df: DataFrame, entity, order, measure: str, prev_col: str, growth_col: str,
                  absolute: bool = False, digits: int = 2) -> DataFrame:
    """Previous present period's value and the growth in percent.

    The previous period is the previous row of the entity (a missing month
    is skipped, not taken as zero). Growth is null for the first period and
    when the previous value is 0; ``absolute`` gives volatility.
    """
    w = Window.partitionBy(*_cols(entity)).orderBy(*_cols(order))
    prev = F.lag(F.col(measure)).over(w)
    return (df.withColumn(prev_col, prev)
            .withColumn(growth_col, growth_pct(F.col(measure), F.col(prev_col), absolute, digits)))


# -- roll-up, splits, pivots --------------------------------------------------

def rollup_labelled(df: DataFrame, levels: Sequence[tuple[str, str | None]], aggs: Sequence[Column],
                    level_col: str = "grouping_level") -> DataFrame:
    """ROLLUP over ``levels`` (outermost first) with sub-total rows labelled.

    A level given with a label shows that label on rows where it is rolled
    up, decided by the ``grouping()`` bit (not by NULL), so a real null
    value is never mistaken for a total. ``level_col`` is ``grouping_id()``.
    """
    names = [c for c, _ in levels]
    out = df.rollup(*names).agg(*aggs, F.grouping_id().cast("int").alias(level_col),
                                *[F.grouping(c).alias(f"_g_{c}") for c in names])
    sel = []
    for c, label in levels:
        if label is None:
            sel.append(F.col(c))
        else:
            sel.append(F.when(F.col(f"_g_{c}") == 1, F.lit(label)).otherwise(F.col(c)).alias(c))
    rest = [c for c in out.columns if c not in names and not c.startswith("_g_")]
    return out.select(*sel, *rest)


def rollup_additive(df: DataFrame, levels: Sequence[tuple[str, str | None]], sums: dict[str, Column],
                    level_col: str = "grouping_level") -> DataFrame:
    """``rollup_labelled`` for sums, as a cascade: every level is summed from the next
    finer level's result, so the input is aggregated once, at the finest level, and no
    row is copied for each level (a ``ROLLUP`` expands every row ``len(levels) + 1``
    times). Decimal sums are decimal(38, s) at every level; an empty input gives no rows."""
    names = [c for c, _ in levels]
    level = df.groupBy(*names).agg(*[F.sum(m).alias(n) for n, m in sums.items()])
    scale = {f.name: getattr(f.dataType, "scale", None) for f in level.schema}
    wide = lambda n: F.col(n) if scale[n] is None else F.col(n).cast(f"decimal(38,{scale[n]})")
    out = None
    for kept in range(len(names), -1, -1):
        if kept < len(names):
            level = level.groupBy(*names[:kept]).agg(*[F.sum(n).alias(n) for n in sums], F.count("*").alias("_rows")).where("_rows > 0")
        level = level.select(*names[:kept], *[wide(n).alias(n) for n in sums])
        shown = [F.col(c) if i < kept else F.lit(label).cast(df.schema[c].dataType).alias(c) for i, (c, label) in enumerate(levels)]
        rows = level.select(*shown, *sums, F.lit(2 ** (len(names) - kept) - 1).alias(level_col))
        out = rows if out is None else out.unionByName(rows)
    return out


def conditional_split(df: DataFrame, group_by, condition: Column, measures: dict[str, Column],
                      labels: tuple[str, str] = ("H1", "H2"), totals: dict[str, str] | None = None) -> DataFrame:
    """Hand-written pivot: each measure summed where ``condition`` holds
    (``{labels[0]}_{name}``) and where it does not (``{labels[1]}_{name}``),
    plus optional totals ``{total_name: measure_name}``. One pass, one
    aggregate; zero, not null, when a half has no rows."""
    aggs = []
    for name, m in measures.items():
        zero = F.lit(0)
        aggs.append(F.sum(F.when(condition, m).otherwise(zero)).alias(f"{labels[0]}_{name}"))
        aggs.append(F.sum(F.when(~condition, m).otherwise(zero)).alias(f"{labels[1]}_{name}"))
    for total, name in (totals or {}).items():
        aggs.append(F.sum(measures[name]).alias(total))
    return df.groupBy(*_cols(group_by)).agg(*aggs)


def pivot(df: DataFrame, group_by, pivot_col: str, values: Sequence, measure: Column,
          prefix: str = "") -> DataFrame:
    """Pivot with an explicit value list (no extra job to find the values)."""
    out = df.groupBy(*_cols(group_by)).pivot(pivot_col, list(values)).agg(F.sum(measure))
    if prefix:
        for v in values:
            out = out.withColumnRenamed(str(v), f"{prefix}{v}")
    return out


# -- date slices and hierarchies -----------------------------------------------

def trailing_months(df: DataFrame, date_col: str, months: int, anchor: Column | None = None) -> DataFrame:
    """Rows with ``date_col`` >= (latest date - ``months`` months).

    The latest date defaults to the column's maximum, as a scalar subquery
    evaluated once; ``add_months`` clamps month ends (Aug 31 - 6 = Feb 29).
    """
    if anchor is None:
        anchor = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) >= F.add_months(anchor, -months))


HIERARCHY = ("year", "quarter", "month", "full_date")


def drill(df: DataFrame, level: str, aggs: Sequence[Column], by: Iterable[str] = (),
          hierarchy: Sequence[str] = HIERARCHY) -> DataFrame:
    """Aggregate at ``level`` of the date hierarchy (drill down = a longer
    prefix, roll up = a shorter one), optionally within ``by`` columns."""
    if level not in hierarchy:
        raise ValueError(f"level must be one of {hierarchy}")
    keys = list(by) + list(hierarchy[: hierarchy.index(level) + 1])
    return df.groupBy(*keys).agg(*aggs)


def slice_dice(df: DataFrame, predicates: dict) -> DataFrame:
    """Conjunctive filter: a scalar value slices, a list dices (``isin``)."""
    out = df
    for col, v in predicates.items():
        if isinstance(v, (list, tuple, set, frozenset)):
            out = out.filter(F.col(col).isin(*list(v)))
        else:
            out = out.filter(F.col(col) == v)
    return out


# -- outliers -------------------------------------------------------------------

def flag_spikes(daily: DataFrame, entity, measure: str, factor: float = 2.0,
                keep_normal: bool = False, avg_col: str = "avg_daily_sales",
                ratio_col: str = "sales_ratio", flag_col: str = "sales_flag",
                spike_label: str = "spike", normal_label: str = "normal") -> DataFrame:
    """Flag rows whose ``measure`` exceeds ``factor`` x the entity's average.

    The average is a window over the entity (exact decimal sum / count of
    the rows present), the same rows as joining a per-entity aggregate back,
    with one shuffle fewer. An entity's window holds one row per period, so
    its size is bounded by the number of periods, not by the raw data.
    """
    w = Window.partitionBy(*_cols(entity))
    avg = exact_avg(F.sum(measure).over(w), F.count(measure).over(w))
    spike = F.col(measure) > F.lit(factor) * F.col(avg_col)
    out = (daily.withColumn(avg_col, avg)
           .withColumn(ratio_col, F.round(safe_div(F.col(measure), F.col(avg_col)), 2))
           .withColumn(flag_col, F.when(spike, F.lit(spike_label)).otherwise(F.lit(normal_label))))
    return out if keep_normal else out.filter(spike)


# -- baskets ----------------------------------------------------------------------

def co_occurrence(df: DataFrame, basket: str, item: str, hot_basket_items: int = 2048,
                  salts: int = 1) -> DataFrame:
    """How often two different items share a basket: ``(item_1, item_2, n)``
    with item_1 < item_2, counting row pairs (a duplicated line multiplies).

    Lines are first reduced to ``(basket, item) -> count`` so duplicates
    are never paired row by row: the pair weight is count_1 x count_2.
    Every basket's items are hashed into buckets of about ``hot_basket_items``
    (``salts`` buckets at least). An ordinary basket has one bucket and is joined
    as the window that counts its items has dealt it, without another shuffle; of
    the others each pair of buckets is joined by itself, so a basket of any size is
    paired in pieces of bounded size, each line copied once per bucket.
    Partial aggregation sums pair weights inside each task before the
    shuffle on the pair. A null item pairs with nothing.
    """
    lines = df.filter(F.col(item).isNotNull()).groupBy(basket, item).agg(F.count(F.lit(1)).alias("_n"))
    lines = lines.withColumn("_g", F.greatest(F.lit(salts), F.ceil(
        F.count(F.lit(1)).over(Window.partitionBy(basket)) / hot_basket_items)).cast("int"))
    lines = lines.withColumn("_b", F.pmod(F.xxhash64(item), F.col("_g")).cast("int"))
    side = lambda df, i, *more: df.select(F.col(basket), F.col(item).alias(f"_i{i}"), F.col("_n").alias(f"_n{i}"), *more)
    one, hot = lines.filter("_g = 1"), lines.filter("_g > 1")
    # the window has dealt the lines by basket: ordinary baskets join where they are
    pairs = side(one, 1).join(side(one, 2), basket).filter(F.col("_i1") < F.col("_i2")).select("_i1", "_i2", "_n1", "_n2")
    left = side(hot, 1, F.col("_b").alias("_b1"), F.explode(F.sequence(F.col("_b"), F.col("_g") - 1)).alias("_b2"))
    right = side(hot, 2, F.col("_b").alias("_b2"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_b1"))
    pairs = pairs.unionByName(left.join(right, [basket, "_b1", "_b2"])
                              .filter((F.col("_b1") < F.col("_b2")) | (F.col("_i1") < F.col("_i2"))).select("_i1", "_i2", "_n1", "_n2"))
    return (pairs.groupBy(F.least("_i1", "_i2").alias(f"{item}_1"), F.greatest("_i1", "_i2").alias(f"{item}_2"))
            .agg(F.sum(F.col("_n1") * F.col("_n2")).alias("n")))
