"""Export files: JSON lines, one object per item, most popular first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from stratalog.operators.publish import export_counts, export_rows, ranked, renamed
from stratalog.schema import export_schema


def export_name(label: str | None, stem: str = "models", default: str = "models") -> str:
    """Directory name for an export made with the model ``label``."""
    if not label:
        return default
    return f"{stem}_{label.replace(':', '-').replace('/', '-')}"


def write_export(catalog: DataFrame, path: str, names: Mapping[str, str] | None = None) -> dict:
    """Write the export and return its statistics, counted while writing.

    NULL fields are kept, text stays UTF-8. Part files are in rank order. The counts are taken
    after the sort: before it, the sort's own sampling pass would be counted as well.
    """
    seen = Observation()
    rows = ranked(export_rows(catalog)).observe(seen, *export_counts())
    renamed(rows, names).write.mode("overwrite").json(path, ignoreNullFields=False)
    return {**seen.get, "output_path": path}


def read_export(
    spark: SparkSession,
    path: str,
    names: Mapping[str, str] | None = None,
    array_file: bool = False,
) -> DataFrame | None:
    """Rows of an earlier export under their catalog names; None if there is none.

    ``array_file`` reads one JSON array, the form other tools write.
    """
    schema = export_schema(None if names is None else dict(names))
    try:
        rows = spark.read.schema(schema).json(path, multiLine=array_file)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    back = export_schema({})
    return rows.toDF(*back.names)
