"""Semantic model: tables, many-to-one relationships and measures over them.

A measure is a Spark aggregate on one fact table. ``evaluate`` adds only the
joins that the grouping, the filters and the measure need, so a dimension that
is not asked for is not read. Where a measure says how it splits, the fact is
grouped by its join keys first, and only these groups meet the dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.group import GroupedData

from lakeweave.functions import text
from lakeweave.operators import joins
from lakeweave.operators.shape import quoted


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``from_table.from_column`` refers to ``to_table.to_column``."""

    from_table: str
    from_column: str
    to_table: str
    to_column: str


@dataclass(frozen=True)
class Split:
    """A measure in two steps. ``partial`` names aggregates of columns of the fact
    alone; ``combine`` is an aggregate of these, by name, and of dimension columns
    over groups that share their dimension rows. It also gets the partial types."""

    partial: Mapping[str, Callable[[Callable[[str], Column]], Column]]
    combine: Callable[[Callable[[str], Column], Mapping[str, T.DataType]], Column]


@dataclass(frozen=True)
class Measure:
    """``aggregate`` gets a function from ``Table.Column`` to a Spark column and
    must skip nulls, as sums and means do.

    ``overrides`` maps ``Table.Column`` to the one value the measure looks at;
    it replaces whatever filter or group the query puts on that column. ``split``
    gives the same value in two steps.
    """

    name: str
    table: str
    uses: tuple[str, ...]
    aggregate: Callable[[Callable[[str], Column]], Column]
    overrides: Mapping[str, object] = field(default_factory=dict)
    split: Split | None = None


@dataclass(frozen=True)
class Model:
    tables: Mapping[str, DataFrame]
    relationships: Sequence[Relationship]
    measures: Mapping[str, Measure]
    sums: frozenset[str] = frozenset()
    """Columns (``Table.Column``) that are summed when used without a measure."""

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def create_views(self, prefix: str = "") -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(prefix + name)

    def path(self, start: str, target: str) -> list[Relationship]:
        """Relationships from ``start`` to ``target``, always many to one."""
        routes: list[tuple[str, list[Relationship]]] = [(start, [])]
        while routes:
            table, steps = routes.pop(0)
            if table == target:
                return steps
            routes += [(r.to_table, [*steps, r]) for r in self.relationships
                       if r.from_table == table and r not in steps]
        raise ValueError(f"{start} has no many-to-one path to {target}")

    def reaches(self, start: str, target: str) -> bool:
        try:
            self.path(start, target)
        except ValueError:
            return False
        return True

    def wide(self, base: str, columns: Sequence[str]) -> DataFrame:
        """The base table with the named columns, each called ``Table.Column``."""
        needed, steps = self._route(base, columns)
        return self._joined(self._columns(base, needed[base]), needed, steps)

    def _columns(self, table: str, names: set[str]) -> DataFrame:
        return self.tables[table].select([F.col(c).alias(f"{table}.{c}") for c in sorted(names)])

    def _route(self, base: str, columns: Sequence[str]) -> tuple[dict[str, set[str]], list[Relationship]]:
        """The columns needed of each table, and the joins in their order."""
        needed: dict[str, set[str]] = {base: set()}
        steps: list[Relationship] = []
        for qualified in columns:
            table, column = qualified.split(".", 1)
            for step in self.path(base, table):
                if step not in steps:
                    steps.append(step)
                needed.setdefault(step.from_table, set()).add(step.from_column)
                needed.setdefault(step.to_table, set())
            needed[table].add(column)
        return needed, steps

    def _joined(self, df: DataFrame, needed: dict[str, set[str]], steps: list[Relationship]) -> DataFrame:
        for step in steps:
            columns_of = {c: f"{step.to_table}.{c}" for c in sorted(needed[step.to_table])}
            df = _join(df, self.tables[step.to_table], step, columns_of)
        return df

    def evaluate(self, measures: str | Sequence[str], by: Sequence[str] = (),
                 filters: Mapping[str, Callable[[Column], Column]] | None = None,
                 keep_blank: bool = False) -> DataFrame:
        """Measures per group. Columns are ``Table.Column``; the result has the
        plain column names. Filters flow from the one side to the many side: a
        filter reaches a measure only if its table has a path to the filtered one.
        Groups in which every measure is null are left out unless ``keep_blank``.

        Measures of one table share a scan and a grouping, unless they override
        a column that is grouped or filtered.
        """
        names = [measures] if isinstance(measures, str) else list(measures)
        by, filters = list(by), dict(filters or {})
        shared: dict[str, list[Measure]] = {}
        parts = []
        for measure in (self.measures[n] for n in names):
            if set(measure.overrides) & {*by, *filters}:
                parts.append(self._overriding(measure, by, filters))
            else:
                shared.setdefault(measure.table, []).append(measure)
        parts += [self._shared(table, members, by, filters) for table, members in shared.items()]
        keys = [_plain(c) for c in by]
        result = parts[0] if len(parts) == 1 else joins.drill_across(parts, keys)
        if by and not keep_blank:
            filled = [F.col(quoted(n)).isNotNull() for n in names]
            result = result.filter(reduce(lambda a, b: a | b, filled))
        return result.select(*keys, *[F.col(quoted(n)) for n in names])

    def _reaching(self, table: str, filters: dict) -> dict:
        return {c: f for c, f in filters.items() if self.reaches(table, c.split(".")[0])}

    def _filtered(self, table: str, columns: Sequence[str], filters: dict) -> DataFrame:
        df = self.wide(table, list(dict.fromkeys([*columns, *filters])))
        for column, test in filters.items():
            df = df.filter(test(_named(column)))
        return df

    def _shared(self, table: str, measures: list[Measure], by: list[str], filters: dict) -> DataFrame:
        columns = [*by, *[c for m in measures for c in (*m.uses, *m.overrides)]]
        active = self._reaching(table, filters)
        joined = {c for c in [*columns, *active] if not c.startswith(f"{table}.")}
        if joined and all(m.split and not joined & set(m.overrides) for m in measures):
            return self._grouped_first(table, measures, by, active, columns)
        df = self._filtered(table, columns, active)
        return _grouped(df, by).agg(*[_aggregate(m) for m in measures])

    def _grouped_first(self, table: str, measures: list[Measure], by: list[str], filters: dict,
                       columns: list[str]) -> DataFrame:
        """``_shared`` with the partial aggregates below the joins."""
        def own(names):
            return [c for c in names if c.startswith(f"{table}.")]

        needed, steps = self._route(table, [c for c in [*columns, *filters] if c not in own([c])])
        keys = sorted({*[f"{table}.{c}" for c in needed[table]], *own(by)})
        df = self._columns(table, {_plain(c) for c in [*keys, *own(columns), *own(filters)]})
        for column in own(filters):
            df = df.filter(filters[column](_named(column)))
        groups = df.groupBy(*[_named(c) for c in keys]).agg(
            *[_overridden(m, part).alias(f"{m.name}.{name}") for m in measures for name, part in m.split.partial.items()])
        wide = self._joined(groups, needed, steps)
        for column in filters:
            if column not in own(filters):
                wide = wide.filter(filters[column](_named(column)))

        def combined(m: Measure) -> Column:
            kinds = {name: groups.schema[f"{m.name}.{name}"].dataType for name in m.split.partial}
            return m.split.combine(lambda c: _named(f"{m.name}.{c}" if c in kinds else c), kinds).alias(m.name)

        return _grouped(wide, by).agg(*[combined(m) for m in measures])

    def _overriding(self, measure: Measure, by: list[str], filters: dict) -> DataFrame:
        """A group on an overridden column shows the value of the override."""
        active = self._reaching(measure.table, filters)
        columns = [*by, *active, *measure.uses, *measure.overrides]
        free = {c: f for c, f in active.items() if c not in measure.overrides}
        df = self._filtered(measure.table, columns, free)
        kept = [c for c in by if c not in measure.overrides]
        result = _grouped(df, kept).agg(_aggregate(measure))
        if kept == by:
            return result
        for column in set(active) - set(free):
            df = df.filter(active[column](_named(column)))
        groups = df.select([_named(c).alias(_plain(c)) for c in by]).distinct()
        if not kept:
            return groups.withColumn(measure.name, result.scalar())
        match = reduce(lambda a, b: a & b, [groups[_plain(c)].eqNullSafe(result[_plain(c)]) for c in kept])
        return groups.join(result, match, "left").select(
            *[groups[_plain(c)] for c in by], result[quoted(measure.name)])

    def summarise(self, table: str, by: Sequence[str] = ()) -> DataFrame:
        """Default summarisation: every summed column of a table, per group."""
        sums = [c for c in self.tables[table].columns if f"{table}.{c}" in self.sums]
        if not sums:
            raise ValueError(f"{table} has no column that is summed by default")
        df = self.wide(table, [*by, *[f"{table}.{c}" for c in sums]])
        return _grouped(df, by).agg(*[F.sum(_named(f"{table}.{c}")).alias(c) for c in sums])


def _grouped(df: DataFrame, by: Sequence[str]) -> GroupedData:
    return df.groupBy(*[_named(c).alias(_plain(c)) for c in by])


def _aggregate(measure: Measure) -> Column:
    return _overridden(measure, measure.aggregate).alias(measure.name)


def _overridden(measure: Measure, aggregate: Callable[[Callable[[str], Column]], Column]) -> Column:
    """An aggregate of the measure; an override turns the values of other rows
    to null, which aggregates skip, like ``FILTER (WHERE ...)``."""
    tests = [_named(c) == F.lit(v) for c, v in measure.overrides.items()]
    if not tests:
        return aggregate(_named)
    wanted = reduce(lambda a, b: a & b, tests)
    return aggregate(lambda c: F.when(wanted, _named(c)))


def _named(qualified: str) -> Column:
    return F.col(f"`{qualified}`")


def _plain(qualified: str) -> str:
    return qualified.split(".", 1)[1]


def _join(df: DataFrame, dimension: DataFrame, step: Relationship, columns: dict[str, str]) -> DataFrame:
    renamed = dimension.select(
        F.col(step.to_column).alias("__dim"),
        *[F.col(c).alias(n.replace(".", "__")) for c, n in columns.items()])
    fact = df.withColumn("__ref", _named(f"{step.from_table}.{step.from_column}"))
    joined = joins.many_to_one(fact, renamed, "__ref", "__dim",
                               {n.replace(".", "__"): n.replace(".", "__") for n in columns.values()},
                               label=step.to_table).drop("__ref")
    return joined.withColumnsRenamed({n.replace(".", "__"): n for n in columns.values()})


# The relationships, measures and default sums of the model.

RELATIONSHIPS = (
    Relationship("FactTaxiDaily", "DateKey", "DimDate", "DateKey"),
    Relationship("FactTaxiDaily", "DateKey", "DimFX", "DateKey"),
    Relationship("FactTaxiDaily", "pickup_zone", "DimZone", "StandardZone"),
    Relationship("FactAirQualityDaily", "DateKey", "DimDate", "DateKey"),
    Relationship("FactAirQualityDaily", "locality", "DimZone", "StandardZone"),
    Relationship("DimDate", "YearKey", "DimGDP", "YearKey"),
)

TOTAL_REVENUE_EUR = Measure(
    "Total Revenue EUR", "FactTaxiDaily",
    ("FactTaxiDaily.TotalRevenue", "DimFX.ExchangeRate"),
    lambda c: F.sum(c("FactTaxiDaily.TotalRevenue") * c("DimFX.ExchangeRate")),
    split=Split({"revenue": lambda c: F.sum(c("FactTaxiDaily.TotalRevenue"))},
                lambda c, kinds: F.sum(c("revenue") * c("DimFX.ExchangeRate"))),
)


def mean(column: str) -> Split:
    """``avg`` of a fact's column. Of decimals the sum keeps the type of the first
    step, as in ``avg`` itself, so that the quotient has digits enough to be rounded once."""
    def combine(c: Callable[[str], Column], kinds: Mapping[str, T.DataType]) -> Column:
        kind = kinds["sum"]
        if not isinstance(kind, T.DecimalType):
            return F.try_divide(F.sum(c("sum")), F.sum(c("count")))
        result = T.DecimalType(min(kind.precision - 6, 38), min(kind.scale + 4, 38))
        return F.try_divide(F.sum(c("sum")).cast(kind), F.sum(c("count"))).cast(result)

    return Split({"sum": lambda c: F.sum(c(column)), "count": lambda c: F.count(c(column))}, combine)


def average_level(name: str, pollutant: str) -> Measure:
    """Mean of the daily means of one pollutant, not weighted by readings."""
    return Measure(name, "FactAirQualityDaily", ("FactAirQualityDaily.AvgValue",),
                   lambda c: F.avg(c("FactAirQualityDaily.AvgValue")),
                   {"FactAirQualityDaily.Pollutant": pollutant}, mean("FactAirQualityDaily.AvgValue"))


MEASURES = {m.name: m for m in (
    TOTAL_REVENUE_EUR,
    average_level("Avg NO2 Level", "no2"),
    average_level("Avg PM2.5 Level", "pm25"),
    average_level("Avg O3 Level", "o3"),
)}

SUMMED_COLUMNS = frozenset({
    "DimDate.MonthNumber", "DimDate.Quarter", "DimDate.IsWeekend",
    "FactAirQualityDaily.AvgValue", "FactAirQualityDaily.ReadingCount",
    "FactTaxiDaily.HourOfDay", "FactTaxiDaily.TotalTrips", "FactTaxiDaily.TotalRevenue",
    "FactTaxiDaily.AvgFare", "FactTaxiDaily.AvgTripDistance", "FactTaxiDaily.AvgTripDuration",
})


# How the model shows its columns and measures.
FORMATS: dict[str, Callable[[Column], Column]] = {
    "Total Revenue EUR": lambda c: text.currency(c, "€", 2, gap=" "),
    "ExchangeRate": lambda c: text.currency(c, "€", 4, gap=" "),
    "TotalRevenue": lambda c: text.currency(c, "$", 2, negative="parentheses"),
    "AvgFare": lambda c: text.currency(c, "$", 2, negative="parentheses"),
    "GDP_Value": lambda c: text.currency(c, "$", 2, negative="parentheses"),
    "AvgTripDistance": lambda c: text.with_unit(c, 2, " mi"),
    "AvgTripDuration": lambda c: text.with_unit(c, 2, " Mins"),
    "AvgValue": lambda c: text.thousands(c, 2),
    "Avg NO2 Level": lambda c: text.with_unit(c, 4, " ppm"),
    "Avg O3 Level": lambda c: text.with_unit(c, 4, " ppm"),
    "Avg PM2.5 Level": lambda c: text.with_unit(c, 2, " µg/m³"),
}


def formatted(df: DataFrame) -> DataFrame:
    """Columns and measures that have a format, as text; the others unchanged."""
    return df.select([
        (FORMATS[c](F.col(quoted(c))) if c in FORMATS else F.col(quoted(c))).alias(c) for c in df.columns
    ])


def star_model(tables: Mapping[str, DataFrame]) -> Model:
    """The model over gold tables named as in ``RELATIONSHIPS``."""
    present = set(tables)
    return Model(
        tables,
        [r for r in RELATIONSHIPS if {r.from_table, r.to_table} <= present],
        {n: m for n, m in MEASURES.items() if {m.table, *[u.split(".")[0] for u in m.uses]} <= present},
        SUMMED_COLUMNS,
    )
