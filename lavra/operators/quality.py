"""Column-level data quality profile: domain violations, exact order statistics and load-to-load shifts.

The values of all profiled columns are unpivoted, aggregated to (column, load, value, count), range-sorted
by (column, value) and turned into running counts: each range partition counts locally, the totals of the
partitions before it are added afterwards. One pass over these cumulative curves gives exact distinct
counts, quantiles and the Kolmogorov-Smirnov distance between a load and the one before it.

Nothing is gathered by column or by load: the largest unit of work is one range partition of distinct
values, so one load or one value may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.session import cut, shuffle_partitions


@dataclass(frozen=True)
class ColumnRule:
    """How one column is profiled.

    violates: true where a row's value is outside the domain (null counts as false).
    numeric: the values are ordered as numbers; only values inside the domain enter medians and quantiles.
    watch_values: compare the share of every single value between loads.
    """

    name: str
    violates: Callable[[], Column]
    numeric: bool = False
    watch_values: bool = False


@dataclass(frozen=True)
class ShiftLimits:
    share: float = 0.117
    median_ratio: float = 1.5


def _blank(c: Column) -> Column:
    return c.rlike(r"(?U)^\s*$")


EXTRACTION_RULES = (
    ColumnRule("status", lambda: F.col("status").isNotNull() & ~F.col("status").isin("EXTRACTED", "FAILED", "IN_PROGRESS"), watch_values=True),
    ColumnRule("page_count", lambda: F.col("page_count").isNotNull() & ~F.col("page_count").between(1, 5000), numeric=True),
    ColumnRule(
        "extraction_duration_in_seconds",
        # NaN compares above every number in Spark, so it fails the upper bound like infinity does.
        lambda: F.col("extraction_duration_in_seconds").isNotNull() & ~F.col("extraction_duration_in_seconds").between(0.0, 7200.0),
        numeric=True,
    ),
    ColumnRule(
        "error_log",
        lambda: ((F.col("status") == "FAILED") & (F.col("error_log").isNull() | _blank(F.col("error_log"))))
        | ((F.col("status") == "EXTRACTED") & F.col("error_log").isNotNull()),
    ),
)


def violations(df: DataFrame, rules: Sequence[ColumnRule], key: str) -> DataFrame:
    """(field_name, case_key): every key with a row outside a column's domain, each once. Null keys are left out."""
    bad = F.array(*[F.when(F.coalesce(r.violates(), F.lit(False)), F.lit(r.name)) for r in rules])
    hit = df.where(F.col(key).isNotNull()).select(F.col(key).alias("case_key"), F.explode(F.array_compact(bad)).alias("field_name"))
    return hit.distinct().select("field_name", "case_key")


def value_counts(df: DataFrame, rules: Sequence[ColumnRule], load: Column) -> DataFrame:
    """(field_name, load, num, txt, inside, n): counted distinct values of every column and load.

    ``num`` carries numeric columns, ``txt`` the others; both are null for a null value. Rows without a
    load are kept under a null load and take no part in shifts.
    """
    parts = []
    for r in rules:
        raw, ok = F.col(r.name), ~F.coalesce(r.violates(), F.lit(False))
        parts.append(
            F.struct(
                F.lit(r.name).alias("field_name"),
                (raw.cast("double") if r.numeric else F.lit(None).cast("double")).alias("num"),
                (F.lit(None).cast("string") if r.numeric else raw.cast("string")).alias("txt"),
                ok.alias("inside"),
            )
        )
    long = df.select(load.alias("load"), F.explode(F.array(*parts)).alias("v")).select("load", "v.*")
    return long.groupBy("field_name", "load", "num", "txt", "inside").agg(F.count("*").alias("n"))


def prefix_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Running sums of ``measures`` per ``keys`` in ``order``, for groups that need not fit into one task.

    Rows are range-partitioned on (keys, order), summed inside their partition, and shifted by the totals
    of the partitions before; ``order`` must be unique within ``keys``. Adds ``cum_<measure>``.
    """
    spark = df.sparkSession
    ranged = cut(df.repartitionByRange(shuffle_partitions(spark), *keys, *order).withColumn("_part", F.spark_partition_id()))
    local = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    starts = totals.select("_part", *keys, *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_start_{m}") for m in measures])
    same = [ranged[k].eqNullSafe(starts[k]) for k in ("_part", *keys)]
    joined = ranged.join(starts, reduce(lambda a, b: a & b, same)).select(ranged["*"], *[starts[f"_start_{m}"] for m in measures])
    return joined.select(*df.columns, *[(F.sum(m).over(local) + F.col(f"_start_{m}")).alias(f"cum_{m}") for m in measures])


def _neighbours(counts: DataFrame) -> DataFrame:
    """(load, following): each load and the next later one. One row per load: days, not data."""
    loads = counts.where(F.col("load").isNotNull()).select("load").distinct()
    return loads.select("load", F.lead("load").over(Window.orderBy("load")).alias("following"))


def paired_counts(counts: DataFrame) -> DataFrame:
    """(field_name, load, num, txt, inside, n_old, n_new): every load's counts beside those of the load before."""
    known = counts.where(F.col("load").isNotNull()).join(_neighbours(counts), "load")
    zero = F.lit(0).cast("bigint")
    both = F.array(
        F.struct(F.col("load").alias("load"), zero.alias("n_old"), F.col("n").alias("n_new")),
        F.when(F.col("following").isNotNull(), F.struct(F.col("following").alias("load"), F.col("n").alias("n_old"), zero.alias("n_new"))),
    )
    rows = known.select("field_name", "num", "txt", "inside", F.explode(F.array_compact(both)).alias("p")).select("field_name", "p.*", "num", "txt", "inside")
    return rows.groupBy("field_name", "load", "num", "txt", "inside").agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))


def curves(pairs: DataFrame) -> DataFrame:
    """Cumulative counts of the non-null values inside the domain, of a load (new) and the load before (old)."""
    live = pairs.where(F.col("inside") & (F.col("num").isNotNull() | F.col("txt").isNotNull())).drop("inside")
    return prefix_counts(live, ["field_name", "load"], ["num", "txt"], ["n_old", "n_new"])


def _at_rank(rank: Column, cum: str, n: str) -> Column:
    return F.max(F.when((F.col(cum) - F.col(n) < rank) & (rank <= F.col(cum)), F.col("num")))


def order_statistics(curve: DataFrame) -> DataFrame:
    """Per (field_name, load): exact median, quartiles and KS distance, from the cumulative curves."""
    size = curve.groupBy("field_name", "load").agg(F.sum("n_old").alias("old"), F.sum("n_new").alias("new"))
    rows = curve.join(size, ["field_name", "load"])
    lo, hi = (lambda s: F.expr(f"({s} + 1) div 2")), (lambda s: F.expr(f"{s} div 2 + 1"))
    quart = lambda k: F.expr(f"cast(greatest(1, ceil(new * {k} / 4.0)) as bigint)")
    out = rows.groupBy("field_name", "load").agg(
        ((_at_rank(lo("old"), "cum_n_old", "n_old") + _at_rank(hi("old"), "cum_n_old", "n_old")) / 2).alias("median_old"),
        ((_at_rank(lo("new"), "cum_n_new", "n_new") + _at_rank(hi("new"), "cum_n_new", "n_new")) / 2).alias("median"),
        _at_rank(quart(1), "cum_n_new", "n_new").alias("q1"),
        _at_rank(quart(3), "cum_n_new", "n_new").alias("q3"),
        F.max(F.when((F.col("old") > 0) & (F.col("new") > 0), F.abs(F.col("cum_n_old") / F.col("old") - F.col("cum_n_new") / F.col("new")))).alias("ks"),
    )
    return out


def shifts(df: DataFrame, rules: Sequence[ColumnRule], load: Column, limits: ShiftLimits = ShiftLimits()) -> DataFrame:
    """(field_name, load): loads in which a column behaves unlike in the closest earlier load.

    A load is a case when the null share differs by more than ``limits.share``, when the share of any one
    value of a watched column does, or when the medians inside the domain of a numeric column differ by
    more than the factor ``limits.median_ratio``. The first load is never a case; an empty table has none.
    """
    pairs = cut(paired_counts(value_counts(df, rules, load)))
    gap = lambda a, b: F.abs(F.col(a) / F.col("old") - F.col(b) / F.col("new")) > limits.share
    null = F.col("num").isNull() & F.col("txt").isNull()
    totals = pairs.groupBy("field_name", "load").agg(
        F.sum("n_old").alias("old"), F.sum("n_new").alias("new"), F.sum(F.when(null, F.col("n_old")).otherwise(0)).alias("null_old"), F.sum(F.when(null, F.col("n_new")).otherwise(0)).alias("null_new")
    ).where("old > 0 and new > 0")
    by_null = totals.where(gap("null_old", "null_new")).select("field_name", "load")
    found = [by_null]
    watched = [r.name for r in rules if r.watch_values]
    if watched:
        shares = pairs.where(F.col("field_name").isin(watched) & ~null).groupBy("field_name", "load", "num", "txt").agg(F.sum("n_old").alias("v_old"), F.sum("n_new").alias("v_new"))
        found.append(shares.join(totals, ["field_name", "load"]).where(gap("v_old", "v_new")).select("field_name", "load"))
    numeric = [r.name for r in rules if r.numeric]
    if numeric:
        stats = order_statistics(curves(pairs.where(F.col("field_name").isin(numeric))))
        apart = F.greatest("median_old", "median") > limits.median_ratio * F.least("median_old", "median")
        found.append(stats.where(F.col("median_old").isNotNull() & F.col("median").isNotNull() & apart).select("field_name", "load"))
    return reduce(DataFrame.union, found).distinct()


def profile(df: DataFrame, rules: Sequence[ColumnRule], load: Column) -> DataFrame:
    """One row per column and load: sizes, null rate, distinct values, range, quartiles, violations, KS distance.

    The range is ``lowest`` to ``highest`` inside the domain and ``lowest_any`` to ``highest_any`` over all values of a
    numeric column (NaN is the largest), and ``first_text`` to ``last_text`` over all values of a text column; the
    others are null. Quartiles are those inside the domain, null for text columns; ``ks`` is null for the first load. An empty table gives no rows.
    """
    pairs = cut(paired_counts(value_counts(df, rules, load)))
    null, is_new = F.col("num").isNull() & F.col("txt").isNull(), F.col("n_new") > 0
    # A value may be inside the domain in one row and outside in another (error_log), so values come first.
    values = pairs.groupBy("field_name", "load", "num", "txt").agg(F.sum("n_new").alias("n_new"), F.sum(F.when(~F.col("inside"), F.col("n_new")).otherwise(0)).alias("n_out"))
    base = values.groupBy("field_name", "load").agg(
        F.sum("n_new").alias("n_rows"),
        F.sum(F.when(null, F.col("n_new")).otherwise(0)).alias("n_null"),
        F.sum(F.when(is_new & ~null, 1).otherwise(0)).cast("bigint").alias("n_distinct"),
        F.sum("n_out").alias("n_outside"),
        F.min(F.when(F.col("n_new") > F.col("n_out"), F.col("num"))).alias("lowest"),
        F.max(F.when(F.col("n_new") > F.col("n_out"), F.col("num"))).alias("highest"),
        *[agg(F.when(is_new, F.col(c))).alias(name) for name, agg, c in (("lowest_any", F.min, "num"), ("highest_any", F.max, "num"), ("first_text", F.min, "txt"), ("last_text", F.max, "txt"))],
    )
    stats = order_statistics(curves(pairs)).drop("median_old")
    return base.join(stats, ["field_name", "load"], "left").select(
        "field_name", "load", "n_rows", "n_null", (F.col("n_null") / F.col("n_rows")).alias("null_share"), "n_distinct", "n_outside", "lowest", "q1", "median", "q3", "highest", "lowest_any", "highest_any", "first_text", "last_text", "ks"
    )
