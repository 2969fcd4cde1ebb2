"""Read side: filters, aggregates, grouped aggregates and pages over any stored table."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    "equal_to": lambda c, v: c == v,
    "not_equal_to": lambda c, v: c != v,
    "distinct_from": lambda c, v: ~c.eqNullSafe(v),
    "not_distinct_from": lambda c, v: c.eqNullSafe(v),
    "less_than": lambda c, v: c < v,
    "less_than_or_equal_to": lambda c, v: c <= v,
    "greater_than": lambda c, v: c > v,
    "greater_than_or_equal_to": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not_in": lambda c, v: ~c.isin(list(v)),
    "is_null": lambda c, v: c.isNull() if v else c.isNotNull(),
    "like": lambda c, v: c.like(v),
    "not_like": lambda c, v: ~c.like(v),
    "like_insensitive": lambda c, v: c.ilike(v),
    "includes": lambda c, v: c.contains(v),
    "not_includes": lambda c, v: ~c.contains(v),
    "includes_insensitive": lambda c, v: F.lower(c).contains(v.lower()),
    "starts_with": lambda c, v: c.startswith(v),
    "ends_with": lambda c, v: c.endswith(v),
}


def predicate(condition: dict[str, Any]) -> Column:
    """Column condition of a nested filter.

    ``{"cu": {"greater_than": 5}, "or": [..], "not": {..}}``: fields and operators of one
    dictionary are joined by AND.
    """
    terms: list[Column] = []
    for name, value in condition.items():
        if name == "and":
            terms.append(reduce(lambda a, b: a & b, [predicate(c) for c in value]))
        elif name == "or":
            terms.append(reduce(lambda a, b: a | b, [predicate(c) for c in value]))
        elif name == "not":
            terms.append(~predicate(value))
        else:
            terms += [_COMPARE[op](F.col(name), v) for op, v in value.items()]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def filter_connection(df: DataFrame, condition: dict[str, Any]) -> DataFrame:
    """Rows matching a filter; plain column predicates, so they reach the Parquet scan."""
    return df.where(predicate(condition))


_AGGREGATES = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "average": F.avg,
    "distinct_count": F.count_distinct,
    "stddev_sample": F.stddev_samp,
    "stddev_population": F.stddev_pop,
    "variance_sample": F.var_samp,
    "variance_population": F.var_pop,
}


def _aggregate_columns(wanted: dict[str, list[str]]) -> list[Column]:
    return [_AGGREGATES[fn](c).alias(f"{fn}_{c}") for fn, cols in wanted.items() for c in cols]


def connection_aggregates(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """One row of aggregates, e.g. ``{"sum": ["cu"]}`` as ``sum_cu``."""
    return df.agg(*_aggregate_columns(wanted))


def grouped_aggregates(
    df: DataFrame,
    group_by: list[str],
    wanted: dict[str, list[str]],
    having: dict[str, Any] | None = None,
) -> DataFrame:
    """Aggregates per key; ``having`` filters on the aggregate names."""
    out = df.groupBy(*group_by).agg(*_aggregate_columns(wanted))
    return out if having is None else out.where(predicate(having))


def page_connection(
    df: DataFrame, order_by: list[tuple[str, str]], first: int | None = None, offset: int = 0
) -> DataFrame:
    """Ordered page of a table. ``order_by`` should end in a unique column."""
    order = [F.col(c).desc() if d.lower() == "desc" else F.col(c).asc() for c, d in order_by]
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if first is None else out.limit(first)
