"""Scalar functions on columns: lenient times, tags, names of files and partitions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_timestamp(c: Column) -> Column:
    """An ISO time with Z, an offset or none (then UTC), or null if it can't be read."""
    return F.try_to_timestamp(c)


def epoch_timestamp(c: Column) -> Column:
    """Epoch seconds as a timestamp; null for what is no number."""
    return F.timestamp_seconds(F.expr("try_cast({} AS bigint)".format(_sql(c)))) if isinstance(c, str) else F.timestamp_seconds(c.try_cast("bigint"))


def _sql(name: str) -> str:
    return f"`{name}`"


def http_timestamp(c: Column) -> Column:
    """The time of an HTTP date header; the weekday before the comma is not read."""
    return F.try_to_timestamp(F.substring(c, 6, 100), F.lit("dd MMM yyyy HH:mm:ss z"))


def bare_tag(c: Column) -> Column:
    """An entity tag without the weak mark and the quotes; an empty one is null."""
    return F.nullif(F.regexp_replace(F.trim(c), r'^(?:W/)?"?|"$', ""), F.lit(""))


def iso_day(c: Column) -> Column:
    """An ISO date or null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c))


def partition_name(column: str, day: Column) -> Column:
    return F.concat(F.lit(f"{column}="), day.cast("string"))


def partition_day(column: str, name: Column) -> Column:
    return iso_day(F.regexp_extract(name, rf"(?:^|/){column}=(\d{{4}}-\d{{2}}-\d{{2}})(?:/|$)", 1))


def whole_second(c: Column) -> Column:
    return F.date_trunc("SECOND", c)


def object_key(path: Column) -> Column:
    """year/stem of a path like root/2024/name-2024-01-02.tar.bz2."""
    return F.concat_ws("/", F.regexp_extract(path, r"(\d{4})/[^/]*$", 1), F.regexp_extract(path, r"([^/]+?)(?:\.(?:tar|csv|json|ndjson))?(?:\.(?:bz2|gz|zst|xz))?$", 1))
