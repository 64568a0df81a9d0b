"""What the operators of this subpackage share: tables in the shared folder and text expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what counts as white space between words.
WHITE = r"[\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Unset, a temporary folder is set for a local master; any other master must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master.startswith("local[") or master == "local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stratalog-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/stratalog/{application}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, so a lost executor costs at
    most the tasks that read from it. The folder holds until the application's is removed."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, none for NULL and for white space alone."""
    parts = F.split(F.coalesce(text, F.lit("")), WHITE)
    return F.filter(parts, lambda word: word != "")


def by_id(doc_id: Column) -> list[Column]:
    """Fields that order rows by id with NULL last."""
    return [doc_id.isNull().alias("_none"), doc_id.alias("_id")]
