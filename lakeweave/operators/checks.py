"""Data-quality suites that read a table a fixed number of times, whatever the number of row checks.

All row checks, row counts and statistics of a suite become one aggregate
without a shuffle of rows. Key checks, balance checks and lists of groups share
one grouping: each row stands once for each set of keys (grouping sets), the
copies are combined on the map side, and one shuffle serves all of them. The
groups are stored as rows, for any number of them; report texts list the first.
Nothing is pulled to the driver: the outcome is a DataFrame of rows
``(suite, kind, seq, name, success, unexpected_count, detail)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.functions.predicates import outside
from lakeweave.functions.scalars import is_missing, nan_to_null
from lakeweave.functions.text import percent, thousands, truncated
from lakeweave.operators import aggregates
from lakeweave.operators.shape import quoted
from lakeweave.session import stored

EXAMPLES = 5


@dataclass(frozen=True)
class RowCheck:
    """A check that counts violating rows. ``detail`` may use ``{n}`` and ``{examples}``."""

    name: str
    column: str
    violated: Callable[[Column, str], Column]
    detail: str
    counts_nulls: bool = False

    @property
    def with_examples(self) -> bool:
        return "{examples}" in self.detail


@dataclass(frozen=True)
class UniqueCheck:
    name: str
    keys: tuple[str, ...]
    detail: str


@dataclass(frozen=True)
class RowCountCheck:
    name: str
    minimum: int
    detail: str
    maximum: int | None = None


@dataclass(frozen=True)
class BalanceCheck:
    name: str
    group: str
    tolerance: int
    detail: str


@dataclass(frozen=True)
class Stat:
    """A statistic as text. ``aggregate`` is built only if all columns exist."""

    name: str
    columns: tuple[str, ...]
    aggregate: Callable[[], Column]
    otherwise: str = "N/A"


@dataclass(frozen=True)
class GroupStat:
    """A list of groups: ``a, b``, or with a ``value`` the largest of each, ``a: 1.00 | b: 2.00``."""

    name: str
    group: str
    value: str | None = None
    otherwise: str = "N/A"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.group,) if self.value is None else (self.group, self.value)


TOTAL_NULLS = "Total Null Values"


def not_null(column: str, detail: str) -> RowCheck:
    return RowCheck(f"No Nulls → {column}", column, is_missing, detail, counts_nulls=True)


def between(name: str, column: str, detail: str, low=None, high=None,
            strict_low: bool = False) -> RowCheck:
    """NaN counts as missing, and a missing value is never outside."""
    def violated(c: Column, kind: str) -> Column:
        return outside(nan_to_null(c) if kind in ("float", "double") else c, low, high, strict_low)

    return RowCheck(name, column, violated, detail)


def dates_between(name: str, column: str, first: str, last: str, detail: str) -> RowCheck:
    """The time of day does not matter."""
    return RowCheck(name, column, lambda c, _: outside(
        F.to_date(c), F.lit(first).cast("date"), F.lit(last).cast("date")), detail)


@dataclass(frozen=True)
class Suite:
    name: str
    checks: tuple = ()
    stats: tuple = ()
    null_detail: str | None = None
    """Detail of a not-null check put on every column, ahead of ``checks``."""
    total_nulls: str = TOTAL_NULLS
    nulls_place: int | None = None
    """How many statistics stand before the total of nulls; all of them by default."""

    def checks_for(self, df: DataFrame) -> list:
        """Checks whose columns exist; the others do not apply."""
        listed = [not_null(c, self.null_detail) for c in df.columns] if self.null_detail else []
        names = set(df.columns)

        def applies(check) -> bool:
            if isinstance(check, RowCheck):
                return check.column in names
            if isinstance(check, UniqueCheck):
                return set(check.keys) <= names
            if isinstance(check, BalanceCheck):
                return check.group in names
            return True

        return listed + [c for c in self.checks if applies(c)]

    def evaluate(self, df: DataFrame) -> DataFrame:
        checks = list(enumerate(self.checks_for(df)))
        place = len(self.stats) if self.nulls_place is None else self.nulls_place
        stats = [(len(checks) + i + (i >= place), stat) for i, stat in enumerate(self.stats)]
        branches = [self._single_pass(df, checks, stats, len(checks) + place)]
        groups = self.groups(df)
        branches += [self._unique(groups[c.keys], seq, c) for seq, c in checks if isinstance(c, UniqueCheck)]
        branches += [self._balance(groups[c.group,], seq, c) for seq, c in checks if isinstance(c, BalanceCheck)]
        branches += [self._listed(groups.get((s.group,)), df, seq, s) for seq, s in stats if isinstance(s, GroupStat)]
        rows = reduce(DataFrame.unionByName, branches)
        sampled = [(seq, c) for seq, c in checks if isinstance(c, RowCheck) and c.with_examples]
        if sampled:
            rows = self._with_examples(rows, df, sampled)
        return rows.select(F.lit(self.name).alias("suite"), "kind", "seq", "name", "success",
                           "unexpected_count", "detail")

    def _single_pass(self, df: DataFrame, checks: list, stats: list, nulls_seq: int) -> DataFrame:
        kinds = dict(df.dtypes)
        parts = [F.count(F.lit(1)).alias("__rows")]
        lines = []
        nulls = F.lit(0).cast("bigint")
        for seq, check in checks:
            if isinstance(check, RowCheck):
                failed = check.violated(F.col(quoted(check.column)), kinds[check.column])
                parts.append(F.count_if(failed).alias(f"__c{seq}"))
                count = F.col(f"__c{seq}")
                if check.counts_nulls:
                    nulls = nulls + count
                lines.append(_check_line(seq, check.name, count == 0, count,
                                         _filled(check.detail, n=count.cast("string"))))
            elif isinstance(check, RowCountCheck):
                rows = F.col("__rows")
                enough = rows >= check.minimum
                short = F.greatest(F.lit(check.minimum) - rows, F.lit(0))
                if check.maximum is not None:
                    enough = enough & (rows <= check.maximum)
                    short = F.greatest(short, rows - F.lit(check.maximum))
                lines.append(_check_line(seq, check.name, enough, short,
                                         _filled(check.detail, n=thousands(rows))))
        names = set(df.columns)
        for seq, stat in stats:
            if isinstance(stat, Stat):
                if set(stat.columns) <= names:
                    parts.append(stat.aggregate().alias(f"__s{seq}"))
                    lines.append(_stat_line(seq, stat.name, F.coalesce(F.col(f"__s{seq}"), F.lit(stat.otherwise))))
                else:
                    lines.append(_stat_line(seq, stat.name, F.lit(stat.otherwise)))
        lines.append(_stat_line(nulls_seq, self.total_nulls, thousands(nulls)))
        return df.agg(*parts).select(F.inline(F.array(*lines)))

    def groups(self, df: DataFrame) -> dict[tuple[str, ...], DataFrame]:
        """For each set of keys that a check or a list needs: its groups, in rows, with the count ``__n`` and, where a
        list shows the largest of a column, ``__top_<column>``. One job makes all of them; nulls are groups too."""
        names = set(df.columns)
        stats = [s for s in self.stats if isinstance(s, GroupStat) and set(s.columns) <= names]
        grouped = [c for c in self.checks_for(df) if isinstance(c, (UniqueCheck, BalanceCheck))]
        sets = list(dict.fromkeys([*[c.keys if isinstance(c, UniqueCheck) else (c.group,) for c in grouped], *[(s.group,) for s in stats]]))
        if not sets:
            return {}
        columns = list(dict.fromkeys(k for keys in sets for k in keys))
        values = list(dict.fromkeys(s.value for s in stats if s.value is not None))
        # Keys and values are copied to names of their own: a column may be both.
        narrow = df.select(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(columns)],
                           *[F.col(quoted(v)).alias(f"v{i}") for i, v in enumerate(values)])
        own = [f"k{i}" for i in range(len(columns))]
        counted = narrow.groupingSets([[own[columns.index(k)] for k in keys] for keys in sets], *own).agg(
            F.grouping_id().alias("set"), F.count(F.lit(1)).alias("__n"), *[F.max(f"v{i}").alias(f"top{i}") for i in range(len(values))])
        kept = stored(counted, "groups")
        # A bit for each key that a set lacks, the first key the highest.
        number = {keys: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for keys in sets}
        return {keys: kept.filter(F.col("set") == number[keys]).select(
            *[F.col(own[columns.index(k)]).alias(k) for k in keys], "__n",
            *[F.col(f"top{i}").alias(f"__top_{v}") for i, v in enumerate(values)]) for keys in sets}

    def _unique(self, groups: DataFrame, seq: int, check: UniqueCheck) -> DataFrame:
        count = F.col("duplicates")
        line = _check_line(seq, check.name, count == 0, count, _filled(check.detail, n=count.cast("string")))
        beyond = groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))
        return beyond.select(F.inline(F.array(line)))

    def _balance(self, groups: DataFrame, seq: int, check: BalanceCheck) -> DataFrame:
        sizes = groups.filter(F.col(quoted(check.group)).isNotNull()).select(F.col(quoted(check.group)).cast("string").alias("g"), "__n")
        entry = F.concat(F.lit("'"), F.col("g"), F.lit("': "), F.col("__n").cast("string"))
        listed = aggregates.one_text(sizes, "g", {"text": (entry, ", ")}).scalar()
        spread = sizes.agg(F.coalesce(F.max("__n") - F.min("__n"), F.lit(0)).alias("spread")).withColumn("l", listed)
        text = F.concat(F.lit("{"), F.col("l"), F.lit("}"))
        line = _check_line(seq, check.name, F.col("spread") <= check.tolerance, F.col("spread"),
                           _filled(check.detail, n=F.col("spread").cast("string"), counts=text))
        return spread.select(F.inline(F.array(line)))

    def _listed(self, groups: DataFrame | None, df: DataFrame, seq: int, stat: GroupStat) -> DataFrame:
        if groups is None or not set(stat.columns) <= set(df.columns):
            return df.limit(0).agg(F.count(F.lit(1))).select(F.inline(F.array(_stat_line(seq, stat.name, F.lit(stat.otherwise)))))
        group = F.col(quoted(stat.group))
        known = groups.filter(group.isNotNull())
        if stat.value is None:
            text = aggregates.one_text(known, quoted(stat.group), {"text": (group.cast("string"), ", ")})
        else:
            text = aggregates.top_texts(known, stat.group, f"__top_{stat.value}", "text")
        return text.select(F.inline(F.array(_stat_line(seq, stat.name, F.col("text")))))

    def _with_examples(self, rows: DataFrame, df: DataFrame, sampled: list) -> DataFrame:
        """Up to five distinct offending values per check, smallest first.

        Offending rows are filtered at the scan and made distinct; the window
        keeps six values per check in each task before it shuffles.
        """
        kinds = dict(df.dtypes)
        tests = {seq: c.violated(F.col(quoted(c.column)), kinds[c.column]) for seq, c in sampled}
        entries = [F.when(tests[seq], F.struct(
            F.lit(seq).alias("seq"), F.col(quoted(c.column)).cast("double").alias("v"),
            F.col(quoted(c.column)).cast("string").alias("t"))) for seq, c in sampled]
        values = (df.filter(reduce(lambda a, b: a | b, tests.values()))
                  .select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
                  .select("e.seq", "e.v", "e.t").distinct())
        ranked = F.row_number().over(W.partitionBy("seq").orderBy("v", "t"))
        few = (values.withColumn("rank", ranked).filter(F.col("rank") <= EXAMPLES + 1)
               .groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("rank", "t"))).alias("l")))
        text = F.concat(
            F.array_join(F.transform(F.slice("l", 1, EXAMPLES), lambda e: e["t"]), ", "),
            F.when(F.size("l") > EXAMPLES, F.lit("...")).otherwise(F.lit("")))
        joined = rows.join(few.select("seq", text.alias("__examples")), "seq", "left")
        return joined.withColumn("detail", F.replace(
            F.col("detail"), F.lit("{examples}"), F.coalesce(F.col("__examples"), F.lit("")))).drop("__examples")


def _check_line(seq: int, name: str, success: Column, count: Column, detail: Column) -> Column:
    return F.struct(F.lit("check").alias("kind"), F.lit(seq).alias("seq"), F.lit(name).alias("name"),
                    success.alias("success"), count.cast("bigint").alias("unexpected_count"),
                    F.when(~success, detail).alias("detail"))


def _stat_line(seq: int, name: str, value: Column) -> Column:
    return F.struct(F.lit("stat").alias("kind"), F.lit(seq).alias("seq"), F.lit(name).alias("name"),
                    F.lit(None).cast("boolean").alias("success"),
                    F.lit(None).cast("bigint").alias("unexpected_count"),
                    value.cast("string").alias("detail"))


def _filled(template: str, **values: Column) -> Column:
    text = F.lit(template)
    for key, value in values.items():
        text = F.replace(text, F.lit("{" + key + "}"), value)
    return text


def totals(rows: DataFrame) -> DataFrame:
    """Per suite: number of checks, passed, failed and the success rate as text."""
    checks = rows.filter(F.col("kind") == "check")
    return (checks.groupBy("suite")
            .agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("passed"),
                 F.count_if(~F.col("success")).alias("failed"))
            .withColumn("success_rate", percent(F.col("passed"), F.col("total"))))


def report(rows: DataFrame, max_failures: int = 15, max_len: int = 900) -> DataFrame:
    """Report lines ``(suite, section, position, name, value)``.

    Holds the totals, the first failures with shortened details, a line for the
    failures beyond them and the statistics. Totals and ranks are windows over
    the suite's rows, so the suite is evaluated once.
    """
    suite = W.partitionBy("suite")
    is_check, is_failed = F.col("kind") == "check", F.coalesce(~F.col("success"), F.lit(False))
    total = F.sum(is_check.cast("int")).over(suite)
    failed = F.sum(is_failed.cast("int")).over(suite)
    nth = F.sum(is_failed.cast("int")).over(suite.orderBy("seq", "name"))
    first = F.row_number().over(suite.orderBy("seq", "name")) == 1
    ranked = rows.select("suite", "kind", "seq", "name", "detail", is_failed.alias("is_failed"),
                         total.alias("total"), failed.alias("failed"), nth.alias("nth"), first.alias("first"))
    passed = F.col("total") - F.col("failed")

    def line(section: str, position: Column | int, name: Column | str, value: Column) -> Column:
        place = position if isinstance(position, Column) else F.lit(position)
        label = name if isinstance(name, Column) else F.lit(name)
        return F.struct(F.lit(section).alias("section"), place.cast("int").alias("position"),
                        label.alias("name"), value.cast("string").alias("value"))

    more = F.concat(F.lit("And "), (F.col("failed") - max_failures).cast("string"),
                    F.lit(" more column validation checks failed. Please check notebook console logs for details."))
    lines = F.array(
        F.when(F.col("first"), line("summary", 0, "Total Checks", F.col("total"))),
        F.when(F.col("first"), line("summary", 1, "Passed", passed)),
        F.when(F.col("first"), line("summary", 2, "Failed", F.col("failed"))),
        F.when(F.col("first"), line("summary", 3, "Success Rate", percent(passed, F.col("total")))),
        F.when(F.col("is_failed") & (F.col("nth") <= max_failures),
               line("failure", F.col("nth"), F.col("name"), truncated(F.col("detail"), max_len))),
        F.when(F.col("is_failed") & (F.col("nth") == max_failures + 1),
               line("failure", F.col("nth"), "Overflow Alert", more)),
        F.when(F.col("kind") == "stat", line("statistic", F.col("seq"), F.col("name"), F.col("detail"))),
    )
    return (ranked.select("suite", F.explode(F.array_compact(lines)).alias("l"))
            .select("suite", "l.section", "l.position", "l.name", "l.value"))
