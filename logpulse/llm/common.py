"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.session import shared_dir
from logpulse.sources import read_table

__all__ = ["WORD", "documents", "document_columns", "made", "partitions", "read_table", "removed",
           "text_or_empty", "uniform64", "written"]

#: A word: a run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def document_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so extra columns of the input cannot clash."""
    return docs.select(*[docs[n].alias(n) for n in names])


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Folders of the tables written by this driver, the newest last.
made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: later jobs read files that survive a lost executor, and
    values that depend on the partitioning are fixed from here on.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the tables written after the first ``since``, but for the newest ``keep``: nothing reads them any more."""
    gone = made[since:len(made) - keep]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        made.remove(path)


def uniform64(seed: int, *cols: str | Column) -> Column:
    """A 64-bit pseudo-random key from the columns; the same on every rerun."""
    return F.xxhash64(F.lit(seed), *cols)
