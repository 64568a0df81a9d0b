"""Versioned snapshots on a shared file system.

A snapshot is written to a directory of its own and then announced by one row in a log. Readers
follow the log, so they never see a half-written snapshot, a run that dies leaves the last good
state in place, and a plan can read version n while it writes version n+1.
"""

from __future__ import annotations

import ast
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.operators.joins import BROADCAST_ROWS

_LOG_SCHEMA = "name string, version int, dir string, tag string, metrics string"


class SnapshotStore:
    """Named tables under ``root``; one writer at a time.

    The log has one small row per snapshot. A store reads it once and adds what it writes itself.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._log = f"{self.root}/_log"
        spark.createDataFrame([], _LOG_SCHEMA).write.mode("ignore").json(self._log)
        self._rows = spark.read.schema(_LOG_SCHEMA).json(self._log).collect()
        self._held: list[Row] | None = None

    def log(self, name: str, tag: str | None = None) -> list[Row]:
        """All versions of a table, oldest first."""
        rows = [r for r in self._rows if r["name"] == name and tag in (None, r["tag"])]
        return sorted(rows, key=lambda r: r["version"])

    def version(self, name: str) -> int:
        rows = self.log(name)
        return rows[-1]["version"] if rows else 0

    def has_tag(self, name: str, tag: str) -> bool:
        return bool(self.log(name, tag))

    def metrics(self, name: str, tag: str) -> dict:
        """The metrics of the version written under ``tag``."""
        return ast.literal_eval(self.log(name, tag)[-1]["metrics"])

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """Latest version; an empty table if there is none."""
        rows = self.log(name)
        if not rows:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(rows[-1]["dir"])

    def write(
        self, name: str, df: DataFrame, metrics: list | None = None, tag: str | None = None
    ) -> dict:
        """Write the next version and return the metrics, gathered during the same pass.

        The metrics sit at the top of the plan, in the stage that writes. Lower down, a shuffle
        stage that is run again after a lost executor would be counted twice.
        """
        version = self.version(name) + 1
        path = f"{self.root}/{name}/v={version:06d}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        columns = [*(metrics or []), F.count(F.lit(1)).alias("rows_in")]
        df.observe(seen, *columns).drop("_action", "outcome", "failures").write.parquet(path)
        found = dict(seen.get)
        self._announce(name, version, path, tag, found)
        return found

    def _announce(self, name: str, version: int, path: str, tag: str | None, found: dict) -> None:
        entry = Row(name=name, version=version, dir=path, tag=tag, metrics=str(found))
        self._rows.append(entry)
        if self._held is None:
            self._append([entry])
        else:
            self._held.append(entry)

    def _append(self, entries: list[Row]) -> None:
        rows = F.array(*[
            F.struct(*[F.lit(v).cast("string").alias(k) for k, v in e.asDict().items()])
            for e in entries
        ])
        log = self.spark.range(1, numPartitions=1).select(F.inline(rows))
        log.withColumn("version", F.col("version").cast("int")).write.mode("append").json(self._log)

    @contextmanager
    def together(self):
        """Announce everything written inside as one: other readers see all of it or nothing."""
        self._held = []
        try:
            yield
            held, self._held = self._held, None
            if held:
                self._append(held)
        except BaseException:
            held = self._held or []
            self._rows = [r for r in self._rows if r not in held]
            raise
        finally:
            self._held = None

    def announce_export(self, name: str, path: str, found: dict, tag: str | None = None) -> None:
        """Log a version that was written elsewhere, such as an export."""
        self._announce(name, self.version(name) + 1, path, tag, found)

    # ---- append-only tables ----------------------------------------------------------------

    def read_all(self, name: str, schema: T.StructType, tag: str | None = None) -> DataFrame:
        """Rows of every version (or of those with ``tag``) with the version as ``_version``."""
        dirs = [r["dir"] for r in self.log(name, tag)]
        with_version = T.StructType([*schema.fields, T.StructField("_version", T.IntegerType())])
        if not dirs:
            return self.spark.createDataFrame([], with_version)
        base = F.element_at(F.split(F.col("_metadata.file_path"), "/v="), -1)
        return self.spark.read.schema(schema).parquet(*dirs).withColumn(
            "_version", F.regexp_extract(base, "^[0-9]+", 0).cast("int")
        )


def latest_rows(rows: DataFrame) -> DataFrame:
    """Newest row of every key of (item_key, ..., _version), one for each key.

    A NULL version is the oldest. Of rows with one key and version, the one with the smallest hash of
    all its columns stays, so the choice is the same in every run.
    """
    return _one_per_key(_newest_rows(rows.withColumn("_version", F.coalesce("_version", F.lit(-1)))))


def _one_per_key(rows: DataFrame) -> DataFrame:
    """Rows of keys that are there once as they are, and one row of each other key."""
    tied = rows.groupBy("item_key").count().filter("count > 1").select("item_key")
    if tied.isEmpty():
        return rows
    first = F.min_by(F.struct(*rows.columns), F.xxhash64(*rows.columns)).alias("row")
    picked = rows.join(tied, "item_key", "left_semi").groupBy("item_key").agg(first)
    return rows.join(tied, "item_key", "left_anti").unionByName(picked.select("row.*"))


def _newest_rows(rows: DataFrame) -> DataFrame:
    """Rows that have the newest version of their key.

    What is outdated is found on the two narrow columns, which a count per key reduces before the
    shuffle. Mostly nothing is, and the rows come back untouched. A small set (its size is known by
    then) is broadcast and taken out, and the long columns are not shuffled either. Only if much is
    outdated, as after a forced crawl of everything, are the rows joined with the newest version of
    each key, on key and version: the versions of one key spread over many tasks.
    """
    pairs = rows.select("item_key", "_version")
    per_key = pairs.groupBy("item_key").agg(
        F.max("_version").alias("_newest"), F.count(F.lit(1)).alias("_n")
    )
    contested = per_key.filter("_n > 1")
    surplus = contested.agg(F.sum(F.col("_n") - 1)).first()[0] or 0
    if surplus == 0:
        return rows.drop("_version")
    if surplus > BROADCAST_ROWS:
        newest = per_key.select("item_key", F.col("_newest").alias("_version"))
        return rows.join(newest, ["item_key", "_version"], "left_semi").drop("_version")
    outdated = (
        pairs.join(F.broadcast(contested), "item_key")
        .filter(F.col("_version") < F.col("_newest"))
        .select("item_key", "_version")
    )
    return rows.join(F.broadcast(outdated), ["item_key", "_version"], "left_anti").drop("_version")
