"""Per-source daily tables and the merged layer on top of them, kept on disk."""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import read_table
from .merge import children_of_chosen, merge_by_precedence, union_sources
from .sinks import files_for, write_days


@dataclasses.dataclass(frozen=True)
class Layers:
    """Daily tables of several sources under root/sources/<source>/<table>, merged ones under root/merged/<table>.

    order: the sources by precedence; schema: of the objects' table, children: schema and row order of each child table.
    A source's day is the event day of its rows. Sources and tables that were never written are empty.
    """

    root: str
    order: Sequence[str]
    key: str
    schema: T.StructType
    children: Mapping[str, tuple[T.StructType, list[str]]]
    day: str = "day"
    table: str = "objects"

    def source_path(self, source: str, table: str) -> str:
        return f"{self.root}/sources/{source}/{table}"

    def merged_path(self, table: str) -> str:
        return f"{self.root}/merged/{table}"

    def merged_schema(self, table: str) -> T.StructType:
        schema = self.schema if table == self.table else self.children[table][0]
        own = [f for f in schema.fields if f.name != self.day]
        more = [T.StructField("source", T.StringType())] + ([T.StructField("sources", T.ArrayType(T.StringType()))] if table == self.table else [])
        return T.StructType([*own, *more, schema[self.day]])

    def _sources(self, spark: SparkSession, table: str, schema: T.StructType, days: list[datetime.date]) -> DataFrame:
        parts = {s: read_table(spark, self.source_path(s, table), schema, self.day).filter(F.col(self.day).isin(days)) for s in self.order}
        return union_sources(parts, list(self.order)).drop("rank").withColumn("source_date", F.col(self.day))

    def rebuild(self, spark: SparkSession, days: Sequence[datetime.date]) -> None:
        """Merge some days anew in one job for each table; children first, so that a day with objects is whole. Days that
        no source has any more are emptied."""
        days = sorted(set(days))
        chosen = merge_by_precedence(self._sources(spark, self.table, self.schema, days), self.key, self.day, "source_date", list(self.order), 0).persist()
        try:
            files = files_for(chosen.count(), len(days))
            for name, (schema, order) in self.children.items():
                rows = self._sources(spark, name, schema, days).drop(self.day)
                write_days(children_of_chosen(rows, chosen, self.key, day=self.day), self.merged_path(name), self.merged_schema(name), self.day, order, days, files)
            write_days(chosen, self.merged_path(self.table), self.merged_schema(self.table), self.day, [self.key], days, files)
        finally:
            chosen.unpersist()

    def read_merged(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.merged_path(table), self.merged_schema(table), self.day)
