"""What several operators need: reading one table, and tables written between steps."""

from __future__ import annotations

from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain.session import materialise

__all__ = ["discard", "fresh_name", "materialise", "read_table", "text_or_empty", "told_apart"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it a name that no column has (in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def told_apart(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``name`` that tells its rows apart and is the same whenever they are read.

    For a table of files it is a row's file and place there; anything else is written once, with a number.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and "_metadata" not in docs.columns:
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        with suppress(AnalysisException):  # files of a format that does not number rows
            return docs.withColumn(name, place)
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def discard(*written: DataFrame) -> None:
    """Remove tables from ``materialise`` that nothing will read again."""
    for df in written:
        files = df.inputFiles()
        if files:
            jvm, path = df.sparkSession._jvm, df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
