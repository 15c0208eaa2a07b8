"""Row filters and simple column changes, with null rules spelled out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.text import city_name, state_code, zip_code


def keep_unless_in(df: DataFrame, column: str, unwanted: Iterable[str]) -> DataFrame:
    """Drop rows whose value is listed. A null value is not listed, so it stays."""
    return df.where(~F.coalesce(F.col(column).isin(*unwanted), F.lit(False)))


def keep_unless_equal(df: DataFrame, column: str, unwanted) -> DataFrame:
    """Drop rows with this value; null stays."""
    return df.where(~F.col(column).eqNullSafe(F.lit(unwanted)))


def keep_years(df: DataFrame, column: str, years: Iterable[int]) -> DataFrame:
    return df.where(F.year(column).isin(*years))


def inside_box(
    df: DataFrame,
    lat: str,
    lng: str,
    lat_range: tuple[float, float],
    lng_range: tuple[float, float],
) -> DataFrame:
    """Keep points inside the box, edges included; points without coordinates go."""
    return df.where(F.col(lat).between(*lat_range) & F.col(lng).between(*lng_range))


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def rows_with_nulls(df: DataFrame) -> DataFrame:
    """Rows that miss at least one value."""
    return df.where(any_null(df.columns))


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def true_only(condition: Column) -> Column:
    """A flag: a comparison with null counts as false."""
    return F.coalesce(condition, F.lit(False))


def standardize_location(df: DataFrame, zip_column: str, city: str, state: str) -> DataFrame:
    """Zip to padded text, city to plain lower case, state to upper case."""
    return df.withColumns(
        {
            zip_column: zip_code(F.col(zip_column)),
            city: city_name(F.col(city)),
            state: state_code(F.col(state)),
        }
    )
