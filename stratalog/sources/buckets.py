"""Tables kept in buckets of their key, so that joins by key need no exchange."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


@dataclass(frozen=True)
class BucketedTables:
    """Parquet tables under ``root``, each in ``buckets`` buckets by ``key`` and sorted by it there.

    Tables with one number of buckets are joined bucket by bucket. A bucket is a task's share, so choose
    the number such that one holds 100 to 200 MB of the largest table. Names are those of the session's
    catalog, one database for all; a table is written once and never changed.
    """

    spark: SparkSession
    root: str
    buckets: int
    key: str = "item_key"

    def _path(self, name: str) -> str:
        if not _NAME.fullmatch(name):
            raise ValueError(f"no name of a table: {name!r}")
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, name: str, df: DataFrame, dealt: bool = False) -> DataFrame:
        """``df`` as the new table ``name``, read back.

        Rows are shuffled by key once, so that each bucket is one file. ``dealt`` says that they lie in
        the buckets already, as the result of a join of such tables does; then nothing is shuffled.
        """
        rows = df if dealt else df.repartition(self.buckets, self.key)
        (rows.write.format("parquet").mode("error").option("path", self._path(name))
         .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name))
        return self.spark.table(name)

    def attach(self, name: str, schema: T.StructType) -> DataFrame:
        """A table that another session wrote, with its buckets."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        path = self._path(name).replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) "
            f"SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)
