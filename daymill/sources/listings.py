"""Listings, links, counts and pages of upstream files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTED = "array<struct<name:string,url:string,size:bigint,etag:string,last_modified:bigint>>"


def parse_listing(df: DataFrame, column: str = "body", base_url: str = "") -> DataFrame:
    """Rows of a listing that is an array, or an object with one in files; items without a name are dropped."""
    body = F.trim(F.col(column))
    array = F.when(body.startswith("["), body).otherwise(F.get_json_object(body, "$.files"))
    items = F.filter(F.from_json(array, "array<string>"), lambda x: F.ltrim(x).startswith("{"))
    item = "struct<name:string,url:string,size:bigint,etag:string,last_modified:bigint>"
    rows = df.withColumn("i", F.explode(items)).withColumn("i", F.from_json("i", item))
    rows = rows.filter(F.col("i.name").isNotNull() & (F.col("i.name") != ""))
    own = [c for c in df.columns if c != column]
    return rows.select(*own, "i.name", F.coalesce("i.url", F.concat(F.lit(base_url), F.col("i.name"))).alias("url"), "i.size", "i.etag", F.timestamp_millis("i.last_modified").alias("last_modified"))


def extract_links(df: DataFrame, column: str = "html") -> DataFrame:
    """(own columns, position, href, label) of each link of a page."""
    pattern = r'<a href="([^"]*)">([^<]*)</a>'
    hrefs, labels = (F.regexp_extract_all(column, F.lit(pattern), F.lit(i)) for i in (1, 2))
    own = [c for c in df.columns if c != column]
    each = df.select(*own, F.posexplode(F.arrays_zip(hrefs.alias("href"), labels.alias("label"))).alias("position", "l"))
    return each.select(*own, "position", "l.href", "l.label")


def listed_size(c: Column) -> Column:
    """A size with thousands separators as a long."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("bigint")


def parse_counts(df: DataFrame, column: str = "body", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """(day, expected) of a document {day: n}; what is no whole number or no day is dropped."""
    entries = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("k", "v"))
    n = F.when(F.col("v").rlike(r"^-?\d+$"), F.col("v").try_cast("bigint"))
    return entries.select(F.try_to_date("k", fmt).alias("day"), n.alias("expected")).filter("day IS NOT NULL AND expected IS NOT NULL")


def discover(listing: DataFrame, counts: DataFrame, pattern: str, fmt: str = "yyyy-MM-dd", previous: DataFrame | None = None) -> DataFrame:
    """Discovered objects: names that match the pattern, with their day, key and expected count.

    previous: (day, expected) of the listing before; a day with the same count as there is flagged unchanged.
    """
    day = F.try_to_date(F.regexp_extract("name", pattern, 1), fmt)
    found = listing.withColumn("logical_date", day).filter("logical_date IS NOT NULL")
    found = found.withColumn("object_key", F.concat(F.date_format("logical_date", "yyyy"), F.lit("/"), F.col("name")))
    found = found.join(counts.select(F.col("day").alias("logical_date"), F.col("expected").alias("expected_count")), "logical_date", "left")
    if previous is None:
        return found.withColumn("listing_unchanged", F.lit(False))
    before = previous.select(F.col("day").alias("logical_date"), F.col("expected").alias("before"))
    return found.join(before, "logical_date", "left").withColumn("listing_unchanged", F.coalesce(F.col("before") == F.col("expected_count"), F.lit(False))).drop("before")


def parse_pages(df: DataFrame, column: str = "body", field: str = "ids") -> DataFrame:
    """(own columns, id): the positive whole numbers in an array of a page."""
    own = [c for c in df.columns if c != column]
    each = df.select(*own, F.explode(F.from_json(F.get_json_object(column, f"$.{field}"), "array<string>")).alias("v"))
    return each.select(*own, F.when(F.col("v").rlike(r"^\d+$"), F.col("v").try_cast("bigint")).alias("id")).filter("id > 0")
