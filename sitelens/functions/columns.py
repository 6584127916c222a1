"""Scalar expressions. Each returns a Column, so it stays inside generated code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS_PER_YEAR = 365.25


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; timestamps are cut to their date first."""
    return F.datediff(as_column(end).cast("date"), as_column(start).cast("date"))


def years_between(start: Column | str, end: Column | str) -> Column:
    return days_between(start, end).cast("double") / F.lit(DAYS_PER_YEAR)


def proportion(part: Column | str, whole: Column | str) -> Column:
    """part / whole, null when the denominator is null or zero."""
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def not_in(value: Column | str, values: Iterable, keep_null: bool = False) -> Column:
    """Negated membership. A null value is dropped, as SQL does, unless keep_null is set."""
    test = ~as_column(value).isin(list(values))
    return F.coalesce(test, F.lit(True)) if keep_null else test


def is_unmapped(value: Column | str, codes: Iterable, null_counts: bool) -> Column:
    """True for a listed code; null counts as unmapped only when null_counts is set."""
    column = as_column(value)
    codes = list(codes)
    listed = F.coalesce(column.isin(codes), F.lit(False)) if codes else F.lit(False)
    return column.isNull() | listed if null_counts else listed


def any_of(conditions: Iterable[Column]) -> Column:
    """Disjunction of one or more conditions."""
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    if result is None:
        raise ValueError("at least one condition is needed")
    return result


def all_present(*columns: str) -> Column:
    """True when every column holds a value."""
    result = F.lit(True)
    for name in columns:
        result = result & F.col(name).isNotNull()
    return result


def any_present(*columns: str) -> Column:
    """True when at least one column holds a value."""
    return any_of(F.col(name).isNotNull() for name in columns)


def pasted(*parts: Column | str) -> Column:
    """Concatenation that skips nulls."""
    return F.concat_ws("", *[as_column(part) for part in parts])


def without_letters(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "[A-Za-z]", "")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty and single-space strings become null in every string column."""
    return df.withColumns(
        {
            field.name: F.when(~F.col(field.name).isin("", " "), F.col(field.name))
            for field in df.schema.fields
            if isinstance(field.dataType, T.StringType)
        }
    )


def listed_in(value: Column | str, comma_list: Column | str) -> Column:
    """Membership in a comma separated text; spaces around the items are ignored."""
    items = F.transform(F.split(as_column(comma_list), ","), lambda item: F.trim(item))
    return F.coalesce(F.array_contains(items, as_column(value)), F.lit(False))


def month_start(value: Column | str) -> Column:
    return F.trunc(as_column(value).cast("date"), "month")
