"""Aggregations over whole tables and groups, with partial aggregation throughout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.functions.scalars import is_missing
from lakeweave.operators.dedupe import key_counts
from lakeweave.operators.shape import for_each_column, quoted
from lakeweave.session import stored


def group_totals(df: DataFrame, by: Sequence[str], amount: Column,
                 count_name: str = "totaltrips", sum_name: str = "totalrevenue") -> DataFrame:
    """Rows and exact decimal sum per group; the sum is rounded once, to double."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_name),
                               F.sum(amount).cast("double").alias(sum_name))


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows and a count (``.get["rows"]``) that the next action on them
    leaves behind, instead of a job of its own. For logs: a task that is run
    again after a lost executor may count its rows twice."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def null_profile(df: DataFrame, nan_is_null: bool = False) -> DataFrame:
    """One row: the number of nulls (and NaNs, on request) of every column."""
    kinds = dict(df.dtypes)
    return for_each_column(df, lambda c: F.count_if(is_missing(F.col(quoted(c)), kinds[c] if nan_is_null else "any")))


def count_matching(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows match each predicate, all in one pass."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    """Distinct days, first and last day. Days are made distinct before they are
    counted, so the final count sees one row per day."""
    return (df.select(F.to_date(column).alias("day")).distinct()
            .agg(F.count("day").alias("days"), F.min("day").alias("first_day"),
                 F.max("day").alias("last_day")))


def column_stats(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row of statistics. An approximate distinct count needs no shuffle of values."""
    c = F.col(column)
    distinct = F.approx_count_distinct(c) if approximate else F.count_distinct(c)
    return df.agg(F.count(F.lit(1)).alias("rows"), distinct.alias("distinct_values"),
                  F.sum(c).alias("total"), F.avg(c).alias("mean"),
                  F.min(c).alias("smallest"), F.max(c).alias("largest"))


def profile(df: DataFrame, predicates: Mapping[str, Column], day: str | None = None) -> DataFrame:
    """Row count, null count per column, anomaly counts and day bounds in one pass."""
    parts = [F.count(F.lit(1)).alias("rows")]
    parts += [F.count_if(F.col(quoted(c)).isNull()).alias(f"{c}_nulls") for c in df.columns]
    parts += [F.count_if(p).alias(name) for name, p in predicates.items()]
    if day:
        date = F.to_date(day)
        parts += [F.min(date).alias("first_day"), F.max(date).alias("last_day"),
                  F.count_distinct(date).alias("days")]
    return df.agg(*parts)


def value_ranges(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column and their counts, dealt out to ranges in order: stored rows ``(v, n, range)``.

    There are as many ranges as shuffle partitions (AQE merges small ones), so a range stays one task's work.
    """
    numbers = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    counted = numbers.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.repartitionByRange("v").withColumn("range", F.spark_partition_id()), "ranges")


def percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact percentiles with linear interpolation: rows ``(p, value)``.

    Values are counted and dealt out to ranges once. The totals of the ranges
    tell in which of them the wanted ranks lie, and how far in; only the ranges
    that hold one, at most two a percentile, are read again and sorted.
    """
    ranges = value_ranges(df, column)
    totals = ranges.groupBy("range").agg(F.sum("n").alias("held"))
    everything = W.partitionBy(F.lit(0))  # one row per range
    upto = F.sum("held").over(everything.orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow))
    located = totals.select("range", "held", (upto - F.col("held")).alias("before"), F.sum("held").over(everything).alias("total"))
    position = F.col("p") * (F.col("total") - 1)
    wanted = (located.select("range", "held", "before", "total", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
              .select("range", "held", "before", "p", position.alias("at"), F.explode(F.array(F.floor(position), F.ceil(position))).alias("rank"))
              .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held"))))
    # At most two ranks for each percentile.
    targets = wanted.agg(F.collect_set(F.struct("range", "before", "p", "at", "rank"))).scalar()

    chosen = (ranges.withColumn("every", targets).withColumn("targets", F.filter("every", lambda t: t["range"] == F.col("range")))
              .filter(F.size("targets") > 0))
    running = F.sum("n").over(W.partitionBy("range").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = (chosen.select("v", "n", "targets", running.alias("upto"))
              .select("v", "n", "upto", F.explode("targets").alias("t"))
              .withColumn("end", F.col("t.before") + F.col("upto"))
              .filter((F.col("t.rank") < F.col("end")) & (F.col("t.rank") >= F.col("end") - F.col("n"))))
    return (ranked.groupBy(F.col("t.p").alias("p"), F.col("t.at").alias("at"))
            .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
            .select("p", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))).alias("value")))


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, min, quartiles, mean and max as rows ``(statistic, value)``."""
    c = F.col(column)
    moments = df.agg(F.count(c).cast("double").alias("count"), F.min(c).cast("double").alias("min"),
                     F.avg(c).cast("double").alias("mean"), F.max(c).cast("double").alias("max"))
    rows = moments.unpivot([], ["count", "min", "mean", "max"], "statistic", "value")
    quartiles = percentiles(df, column, [0.25, 0.5, 0.75]).select(
        F.concat(F.round(F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"), "value")
    return rows.unionByName(quartiles)


#: So many groups are listed in a text, far more than a report line shows; ``group_values`` has any number in rows.
LISTED = 100_000


def one_text(rows: DataFrame, order: str, texts: Mapping[str, tuple[Column, str]], most: int = LISTED) -> DataFrame:
    """One row; each of ``texts`` is ``(entry, separator)`` joined over the first ``most`` rows, then ``...`` for others.

    For lists that a report prints, one entry per group. ``group_values`` has
    the same in rows, for any number of groups.
    """
    names = list(texts)
    chosen = rows.select(F.col(order).alias("__order"), *[texts[n][0].alias(n) for n in names])
    first = chosen.orderBy("__order", *names).limit(most + 1)
    entries = first.agg(F.sort_array(F.collect_list(F.struct("__order", *names))).alias("l"))
    more = F.when(F.size("l") > most, F.array(F.lit("..."))).otherwise(F.array().cast("array<string>"))
    return entries.select([F.concat_ws(texts[n][1], F.slice(F.col("l")[n], 1, most), more).alias(n) for n in names])


def group_values(df: DataFrame, group: str, values: Mapping[str, Column]) -> DataFrame:
    """Statistics in rows ``(name, group, value)``, one for each group; rows without a group do not count."""
    totals = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).cast("string").alias("group")).agg(
        *[c.cast("double").alias(n) for n, c in values.items()])
    return totals.unpivot(["group"], list(values), "name", "value").select("name", "group", "value")


def top_texts(tops: DataFrame, group: str, top: str, name: str) -> DataFrame:
    """One row with the largest value of each group, ``a: 1.00 | b: 2.00``; ``tops`` has a row per group."""
    shown = F.concat(F.col(quoted(group)).cast("string"), F.lit(": "), F.coalesce(F.format_number(quoted(top), 2), F.lit("nan")))
    return one_text(tops, quoted(group), {name: (shown, " | ")})


def group_texts(df: DataFrame, group: str, value: str, groups_name: str = "groups",
                tops_name: str = "tops") -> DataFrame:
    """One row with two texts from one grouping: the groups, ``a, b``, and the
    largest value of each, ``a: 1.00 | b: 2.00``."""
    tops = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.max(value).alias("__top"))
    top = F.concat(F.col(group), F.lit(": "), F.coalesce(F.format_number("__top", 2), F.lit("nan")))
    return one_text(tops, group, {groups_name: (F.col(group).cast("string"), ", "), tops_name: (top, " | ")})


def distinct_text(df: DataFrame, column: str, name: str = "text") -> DataFrame:
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return one_text(values, column, {name: (F.col(column).cast("string"), ", ")})


def group_spread(df: DataFrame, group: str) -> DataFrame:
    """Largest minus smallest group size; rows without a group do not count."""
    sizes = key_counts(df.filter(F.col(group).isNotNull()), [group], "__n")
    return sizes.agg((F.max("__n") - F.min("__n")).alias("spread"),
                     F.count(F.lit(1)).alias("groups"))
