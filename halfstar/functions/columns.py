"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEEK_SECONDS = 7 * 86400
# 1970-01-04 was the first Sunday of the epoch.
FIRST_SUNDAY = 3 * 86400


def star_class(rating: Column) -> Column:
    """'Whole Star' for 1..5, 'Half Star' for everything else."""
    return F.when(rating.isin(1.0, 2.0, 3.0, 4.0, 5.0), "Whole Star").otherwise("Half Star")


def release_year(title: Column) -> Column:
    """The first ``(YYYY)`` of a title as an int, NULL where there is none."""
    text = F.regexp_extract(title, r"\((\d{4})\)", 1)
    return F.nullif(text, F.lit("")).cast("int")


def strip_year(title: Column) -> Column:
    """Remove the first ``(YYYY)`` and the blanks before it; later ones stay."""
    return F.regexp_replace(title, r"^(.*?)\s*\(\d{4}\)", "$1")


def title_parts(df: DataFrame, title: str = "title") -> DataFrame:
    """Split ``title`` into a bare title and an int ``year``."""
    return df.withColumns({"year": release_year(F.col(title)), title: strip_year(F.col(title))})


def week_start(timestamp: Column) -> Column:
    """Nearest Sunday 00:00 UTC of an epoch second, as epoch seconds; ties go up.

    This rounds, unlike ``date_trunc('week', ..)`` which floors to Monday.
    Integer arithmetic keeps it independent of the session time zone.
    """
    shifted = timestamp.cast("long") - F.lit(FIRST_SUNDAY) + F.lit(WEEK_SECONDS // 2)
    return shifted - F.pmod(shifted, F.lit(WEEK_SECONDS)) + F.lit(FIRST_SUNDAY)


def genre_array(genres: Column) -> Column:
    return F.split(genres, r"\|")


def split_hash(*keys: Column) -> Column:
    """32-bit hash of a row key: the same split after any repartitioning."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def round_half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Epoch second of a timestamp column with or without time zone."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        days = F.unix_date(F.to_date(col)).cast("long")
        return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    return F.unix_seconds(col)
