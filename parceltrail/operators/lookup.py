"""Dimension lookups and decoding.

A lookup joins one row per key, so fact rows never multiply. A `Dimension` knows whether its keys repeat: it is declared, or
counted once, and then joined as it is by every lookup of a report. Other tables, and dimensions with repeated keys, are
reduced to one row per key first. Lookups carry no broadcast hint: Spark broadcasts a dimension when its measured size is
under the threshold, and otherwise shuffles, where AQE splits skewed partitions of the preserved left side.

Codes are decoded by `Labels`, which reads the option table once per report: the labels of a kind of code become a map
literal, so that a decode is an expression and adds neither a join nor a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.values import joined

# Labels are read into maps if the option table has no more rows than this, and a kind of code no more labels than that.
MAX_LABELS = 10_000
MAX_MAP = 200


@dataclass(frozen=True)
class Dimension:
    """A table and its key; `unique` says that the key doesn't repeat (NULL keys match nothing and may)."""

    rows: DataFrame
    keys: tuple[str, ...]
    unique: bool

    @classmethod
    def counted(cls, rows: DataFrame, keys: Sequence[str]) -> Dimension:
        """Looks once whether the key repeats. Runs a job that pre-aggregates the key columns."""
        known = rows.dropna(subset=list(keys))
        repeated = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return cls(rows, tuple(keys), repeated.isEmpty())

    def where(self, condition: Column) -> Dimension:
        return Dimension(self.rows.where(condition), self.keys, self.unique)

    def by(self, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
        """The keys and values, one row per key."""
        if self.unique and set(keys) == set(self.keys):
            return self.rows
        return one_row_per_key(self.rows, keys, values)


def one_row_per_key(dim: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Of rows that repeat a key, the one whose values are smallest, real values before NULLs."""
    values = [v for v in values if v not in keys]
    if not values:
        return dim.select(*keys).distinct()
    if len(values) == 1:  # numbers can then be aggregated by hash
        return dim.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
    order = [part for v in values for part in (F.col(v).isNull().alias(f"no_{v}"), F.col(v))]
    packed = dim.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__row"))
    return packed.select(*keys, *[F.col("__row")[v].alias(v) for v in values])


def lookup(
    df: DataFrame,
    dim: DataFrame | Dimension,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    bounded: bool = False,
) -> DataFrame:
    """Add columns of the dimension row with the same key; of rows that repeat a key, of the smallest.

    `on` maps columns of `df` to key columns of `dim`; `take` maps new column names to columns of `dim`. `bounded` says
    that the dimension's size has been checked and it may be broadcast.
    """
    by, values = list(on.values()), sorted(set(take.values()))
    dim = dim.by(by, values) if isinstance(dim, Dimension) else one_row_per_key(dim, by, values)
    keys = {f"__k{i}": dim_key for i, dim_key in enumerate(by)}
    taken = {f"__v{i}": column for i, column in enumerate(take.values())}
    right = dim.selectExpr(*[f"`{c}` AS {alias}" for alias, c in {**keys, **taken}.items()])
    right = F.broadcast(right) if bounded else right
    test = " AND ".join(f"`{fact}` = {alias}" for fact, alias in zip(on, keys))
    return df.join(right, F.expr(test), how).drop(*keys, *take).withColumnsRenamed(dict(zip(taken, take)))


def lookup_roles(
    df: DataFrame, dim: DataFrame | Dimension, roles: Sequence[tuple[Mapping[str, str], Mapping[str, str]]]
) -> DataFrame:
    """The same dimension in several roles: one (on, take) pair per role."""
    for on, take in roles:
        df = lookup(df, dim, on, take)
    return df


@dataclass(frozen=True)
class Labels:
    """The labels of all kinds of code, from the (type_option, option_value, option_name) dimension."""

    options: DataFrame
    maps: Mapping[str, Mapping[str, str | None]] | None = field(repr=False)

    @classmethod
    def read(cls, options: DataFrame) -> Labels:
        """Reads at most MAX_LABELS rows; of a larger table none are kept, and decodes are joins.

        Of options that repeat a code the smallest label counts, a real one before NULL.
        """
        known = options.select("type_option", "option_value", "option_name").dropna(subset=["type_option", "option_value"])
        rows = known.limit(MAX_LABELS + 1).collect()
        if len(rows) > MAX_LABELS:
            return cls(options, None)
        maps: dict[str, dict[str, str | None]] = {}
        for kind, code, label in sorted(rows, key=lambda r: (r[2] is None, r[2] or "")):
            maps.setdefault(kind, {}).setdefault(code, label)
        return cls(options, maps)

    def of(self, code: str, type_option: str) -> Column | None:
        """The label of a code column as an expression, or None if this kind of code has too many."""
        labels = None if self.maps is None else self.maps.get(type_option, {})
        if labels is None or len(labels) > MAX_MAP:
            return None
        if not labels:
            return F.lit(None).cast("string")
        pairs = F.create_map(*[F.lit(part).cast("string") for pair in sorted(labels.items()) for part in pair])
        return F.try_element_at(pairs, F.col(code).cast("string"))

    def table(self, type_option: str) -> DataFrame:
        return self.options.where(F.col("type_option") == type_option)


def decode(df: DataFrame, labels: Labels | DataFrame, code: str, type_option: str, out: str) -> DataFrame:
    """Label of a code, NULL if it has none. An option table instead of labels is joined."""
    return decode_all(df, labels, {out: (code, type_option)})


def decode_all(df: DataFrame, labels: Labels | DataFrame, codes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Several decodes: output name -> (code column, type_option). An output may replace its own code column."""
    if isinstance(labels, DataFrame):
        labels = Labels(labels, None)
    expressions = {out: labels.of(code, kind) for out, (code, kind) in codes.items()}
    beside = {out: f"__d_{out}" for out, expression in expressions.items() if expression is None}
    for out, name in beside.items():
        code, kind = codes[out]
        bounded = labels.maps is not None
        df = lookup(df, labels.table(kind), {code: "option_value"}, {name: "option_name"}, bounded=bounded)
    df = df.withColumns({out: F.col(beside[out]) if out in beside else expression for out, expression in expressions.items()})
    return df.drop(*beside.values())


def without_value(df: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with no match, or whose match has a NULL value. The right columns are kept."""
    return df.join(right, key, "left").where(F.col(value).isNull())


def with_value(df: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose match has a value. The right columns are kept."""
    return df.join(right, key, "left").where(F.col(value).isNotNull())


def having_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; rows with a NULL key are dropped.

    The list carries no hint: Spark broadcasts it by its measured size, and otherwise both sides are partitioned by the
    key, which AQE splits where a key is hot and a later grouping by the key uses again.
    """
    return df.join(keys.select(key), key, "left_semi")


def left_join_heavy_right(left: DataFrame, right: DataFrame, test_left: str, test_right: str) -> DataFrame:
    """Left join of a small side to a side where one key may hold most rows.

    A plain left join must not split the right side of a hot key. Matches come from an inner join, which AQE may
    split (or broadcast) on either side; left rows without a match come from an anti join against the distinct keys.
    """
    matched = left.join(right, left[test_left] == right[test_right], "inner")
    keys = right.select(F.col(test_right).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    missing = left.join(keys, left[test_left] == keys["__key"], "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def concat_key(*parts: Column | str, sep: str = " - ") -> Column:
    """Composite text key; NULL when a part is NULL, so such rows never match."""
    return joined(*parts, sep=sep)
