"""Consistency checks; each gives issues (dataset, object_key, kind, severity, detail).

objects: (dataset, object_key, logical_date, status, current_revision, etag, expected_count, observed_count).
revisions: (dataset, object_key, revision, sha256, raw_path, parser_version, observed_count). partitions: (table_name, logical_date,
n_rows, dataset, object_key, revision, unknown_keys). Bounds of days are inclusive and go into each input.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stores import listed, opened

OBJECT = ["dataset", "object_key"]
LIVE = ("imported", "provisional")
NOTES = ("provisional", "upstream_ahead", "source_lacks_day")


def in_range(df: DataFrame, date_from=None, date_to=None, day: str = "logical_date") -> DataFrame:
    if date_from is not None:
        df = df.filter(F.col(day) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col(day) <= F.lit(date_to).cast("date"))
    return df


def issues(df: DataFrame, kind: str, detail: Column, key: str | Column = "object_key", dataset: str | Column = "dataset") -> DataFrame:
    of = lambda x: F.col(x) if isinstance(x, str) else x
    severity = "note" if kind in NOTES else "issue"
    return df.select(of(dataset).alias("dataset"), of(key).alias("object_key"), F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), detail.cast("string").alias("detail"))


def live(objects: DataFrame) -> DataFrame:
    return objects.filter(F.col("status").isin(*LIVE))


def check_failed_object(objects: DataFrame) -> DataFrame:
    return issues(objects.filter("status = 'failed'"), "failed_object", F.lit("the last import failed"))


def check_missing_revision(objects: DataFrame, revisions: DataFrame) -> DataFrame:
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"))
    return issues(live(objects).join(r, [*OBJECT, "current_revision"], "left_anti"), "missing_revision", F.concat(F.lit("revision "), F.col("current_revision").cast("string")))


def check_missing_partition(objects: DataFrame, partitions: DataFrame, tables: dict[str, list[str]]) -> DataFrame:
    """tables: the tables of each dataset."""
    names = F.lit(None).cast("array<string>")
    for dataset, own in tables.items():
        names = F.when(F.col("dataset") == dataset, F.array(*map(F.lit, own))).otherwise(names)
    wanted = live(objects).withColumn("table_name", F.explode(names))
    lost = wanted.join(partitions.select("table_name", "logical_date"), ["table_name", "logical_date"], "left_anti")
    return issues(lost, "missing_partition", F.concat_ws(" ", "table_name", F.col("logical_date").cast("string")))


def check_row_count(objects: DataFrame, revisions: DataFrame, partitions: DataFrame, first_table: dict[str, str]) -> DataFrame:
    """Rows of the first table against the count of the revision that is live."""
    name = F.lit(None).cast("string")
    for dataset, table in first_table.items():
        name = F.when(F.col("dataset") == dataset, F.lit(table)).otherwise(name)
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "observed_count")
    own = live(objects).drop("observed_count").join(r, [*OBJECT, "current_revision"]).withColumn("table_name", name)
    j = own.join(partitions.select("table_name", "logical_date", "n_rows"), ["table_name", "logical_date"])
    return issues(j.filter(~F.col("n_rows").eqNullSafe(F.col("observed_count"))), "row_count", F.concat(F.col("n_rows").cast("string"), F.lit(" rows, "), F.coalesce(F.col("observed_count").cast("string"), F.lit("none")), F.lit(" registered")))


def check_unknown_keys(partitions: DataFrame) -> DataFrame:
    return issues(partitions.filter(F.size("unknown_keys") > 0), "unknown_keys", F.array_join("unknown_keys", ","))


def check_stale_partition(objects: DataFrame, partitions: DataFrame) -> DataFrame:
    j = partitions.join(objects.select(*OBJECT, "current_revision"), OBJECT).filter(F.col("revision") != F.col("current_revision"))
    return issues(j, "stale_partition", F.concat(F.col("table_name"), F.lit(" has "), F.col("revision").cast("string"), F.lit(", current is "), F.col("current_revision").cast("string")))


def check_missing_raw(objects: DataFrame, revisions: DataFrame, files: DataFrame) -> DataFrame:
    """files: (raw_path) that are there."""
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "raw_path")
    j = live(objects).join(r, [*OBJECT, "current_revision"]).filter("raw_path IS NOT NULL").join(files, "raw_path", "left_anti")
    return issues(j, "missing_raw", F.col("raw_path"))


def file_hashes(spark: SparkSession, paths: str | list[str], piece: int = 1 << 20) -> DataFrame:
    """(raw_path, sha256, unzipped_sha256) of raw files; the latter only of gzip files, null if one is damaged.

    Tasks stream the files by path, both digests at once, so no file is ever held as a whole.
    """

    def hash_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                store, inside = opened(path)
                plain, unzipped = hashlib.sha256(), hashlib.sha256() if path.endswith(".gz") else None
                unzip = zlib.decompressobj(31)
                with store.open_input_stream(inside, compression=None) as f:
                    while data := f.read(piece):
                        plain.update(data)
                        try:
                            while unzipped and data:
                                unzipped.update(unzip.decompress(data, piece))
                                data = unzip.unconsumed_tail
                                if unzip.eof:  # one gzip member after another
                                    data, unzip = unzip.unused_data, zlib.decompressobj(31)
                        except zlib.error:
                            unzipped = None
                if unzipped:
                    unzipped.update(unzip.flush())
                yield pd.DataFrame({"raw_path": [path], "sha256": [plain.hexdigest()], "unzipped_sha256": [unzipped.hexdigest() if unzipped else None]})

    return listed(spark, paths).select("path").mapInPandas(hash_, "raw_path string, sha256 string, unzipped_sha256 string")


def check_raw_hash(objects: DataFrame, revisions: DataFrame, hashes: DataFrame) -> DataFrame:
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "raw_path", F.col("sha256").alias("wanted"))
    j = live(objects).join(r, [*OBJECT, "current_revision"]).join(hashes, "raw_path")
    other = (F.col("wanted") != F.col("sha256")) & (F.col("wanted") != F.coalesce("unzipped_sha256", F.lit("")))
    return issues(j.filter(other), "raw_hash", F.col("raw_path"))


def check_provisional(objects: DataFrame) -> DataFrame:
    return issues(objects.filter("status = 'provisional'"), "provisional", F.lit("an older copy is live"))


def check_expected_count(objects: DataFrame, revisions: DataFrame) -> DataFrame:
    """expected_count, or the note upstream_ahead where upstream serves another copy already.

    Only imported objects: of a provisional one it is known that an older copy is live.
    """
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "upstream_etag", "observed_count")
    own = objects.filter("status = 'imported'").drop("observed_count")
    j = own.join(r, [*OBJECT, "current_revision"]).filter("expected_count IS NOT NULL").filter(~F.col("expected_count").eqNullSafe(F.col("observed_count")))
    ahead = ~F.col("etag").eqNullSafe(F.col("upstream_etag"))
    detail = F.concat(F.lit("expected "), F.col("expected_count").cast("string"), F.lit(", observed "), F.coalesce(F.col("observed_count").cast("string"), F.lit("none")))
    return issues(j.filter(~ahead), "expected_count", detail).unionByName(issues(j.filter(ahead), "upstream_ahead", detail))


def check_orphan_partition(objects: DataFrame, partitions: DataFrame) -> DataFrame:
    """Only for a check without a range."""
    return issues(partitions.join(live(objects), OBJECT, "left_anti"), "orphan_partition", F.concat_ws(" ", "table_name", F.col("logical_date").cast("string")))


def check_duplicate(merged: DataFrame, key: str, day: str, dataset: str) -> DataFrame:
    counts = day_counts(merged, key, day).filter("n_rows > n_ids")
    return issues(counts, "duplicate", (F.col("n_rows") - F.col("n_ids")).cast("string"), F.col("day").cast("string"), F.lit(dataset))


def check_merged_short(sources: DataFrame, merged: DataFrame, key: str, day: str, dataset: str) -> DataFrame:
    """Days on which a source has more ids than the merged layer."""
    own = sources.groupBy("source", F.to_date(day).alias("day")).agg(F.countDistinct(key).alias("n"))
    all_ = day_counts(merged, key, day).select("day", F.col("n_ids").alias("m"))
    j = own.join(all_, "day", "left").filter(F.col("n") > F.coalesce("m", F.lit(0)))
    return issues(j, "merged_short", F.concat(F.col("source"), F.lit(" "), F.col("n").cast("string"), F.lit(" > "), F.coalesce("m", F.lit(0)).cast("string")), F.col("day").cast("string"), F.lit(dataset))


def check_source_lacks_day(sources: DataFrame, day: str, daily: list[str], dataset: str) -> DataFrame:
    """Days that one daily source has and another hasn't."""
    have = sources.filter(F.col("source").isin(*daily)).select("source", F.col(day).alias("day")).distinct()
    names = F.array(*map(F.lit, daily))
    lack = have.groupBy("day").agg(F.collect_set("source").alias("s")).select("day", F.explode(F.array_except(names, "s")).alias("source"))
    return issues(lack, "source_lacks_day", F.col("source"), F.col("day").cast("string"), F.lit(dataset))


def day_counts(df: DataFrame, key: str, time: str) -> DataFrame:
    """(day, n_rows, n_ids) by UTC day."""
    return df.groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_ids"))


def verify(objects: DataFrame, revisions: DataFrame, partitions: DataFrame, files: DataFrame, hashes: DataFrame, tables: dict[str, list[str]], date_from=None, date_to=None) -> DataFrame:
    """The issues of all checks of datasets over a range of days; orphans only without a range.

    files: (raw_path) that are there; hashes: (raw_path, sha256, unzipped_sha256) of those to be compared. An object
    whose live revision is absent is reported as that and not held against its partitions.
    """
    o, p = in_range(objects, date_from, date_to), in_range(partitions, date_from, date_to)
    known = o.join(revisions.select(*OBJECT, F.col("revision").alias("current_revision")), [*OBJECT, "current_revision"], "left_semi")
    parts = [
        check_failed_object(o),
        check_missing_revision(o, revisions),
        check_missing_partition(known, p, tables),
        check_row_count(o, revisions, p, {d: own[0] for d, own in tables.items()}),
        check_unknown_keys(p),
        check_stale_partition(o, p),
        check_missing_raw(o, revisions, files),
        check_raw_hash(o, revisions, hashes),
        check_provisional(o),
        check_expected_count(o, revisions),
    ]
    if date_from is None and date_to is None:
        parts.append(check_orphan_partition(objects, partitions))
    return _union(parts)


def verify_merged(sources: DataFrame, merged: DataFrame, key: str, day: str, source_day: str, daily: list[str], dataset: str, date_from=None, date_to=None) -> DataFrame:
    """The issues of the merged layer over a range of days."""
    m = in_range(merged, date_from, date_to, day)
    return _union([
        check_duplicate(m, key, day, dataset),
        check_merged_short(in_range(sources, date_from, date_to, day), m, key, day, dataset),
        check_source_lacks_day(in_range(sources, date_from, date_to, source_day), source_day, daily, dataset),
    ])


def checked(objects: DataFrame, hashes: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """(n_objects, n_hashed): objects that are live in a range, and files hashed."""
    counted = live(in_range(objects, date_from, date_to)).agg(F.count("*").alias("n_objects"))
    both = counted.unionByName(hashes.agg(F.count("*").alias("n_hashed")), allowMissingColumns=True)
    return both.agg(F.max("n_objects").alias("n_objects"), F.max("n_hashed").alias("n_hashed"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(parts: list[DataFrame]) -> DataFrame:
    """(kind, severity, n) over several checks."""
    return _union(parts).groupBy("kind", "severity").agg(F.count("*").alias("n"))
