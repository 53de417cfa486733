"""Tables that change by whole versions: readers see one version or the next, never a mix.

* :func:`publish` writes the tables of a version below one folder and then, last, the
  pointer to it. Versions take turns in ``SLOTS`` folders, so a publication never
  touches what the pointer shows, a failure before the pointer leaves the earlier
  version readable, and the number of files is bounded however often it is repeated.
* :class:`DatedTable` is a table of rows per date of which a writer replaces whole
  dates. A date has two generations in turn; a row names its generation and the
  writer's version. A writer reads generations of earlier versions only, so a
  version run again after a failure finds what it found before, and replaces
  what the failed run left.

Both need nothing but Spark's readers and writers, so they work on any store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 4

_POINTER = T.StructType([T.StructField("version", T.LongType())])


def read_folder(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows below ``path``; none if there is no such folder yet. Any other failure is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def published_version(spark: SparkSession, path: str) -> int:
    """The number of the latest publication, 0 if there is none."""
    return read_folder(spark, f"{path}/pointer", _POINTER).agg(F.max("version")).first()[0] or 0


def _slot(path: str, version: int) -> str:
    return f"{path}/slot={version % SLOTS}"


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame | Callable[[str], None]],
            fmt: str = "parquet") -> int:
    """Publish a new version of ``tables`` (by name: a frame, or a function that writes to a path) and return its number.

    A reader has until the ``SLOTS`` - 1 next publications to finish with the version it opened."""
    path = path.rstrip("/")
    version = published_version(spark, path) + 1
    for name, table in tables.items():
        where = f"{_slot(path, version)}/{name}"
        if isinstance(table, DataFrame):
            table.write.mode("overwrite").format(fmt).save(where)
        else:
            table(where)
    pointer = spark.createDataFrame([(version,)], _POINTER).coalesce(1)
    pointer.write.mode("overwrite").parquet(f"{path}/pointer/turn={version % SLOTS}")
    return version


def read_published(spark: SparkSession, path: str, name: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table of the latest publication; raises if there is none."""
    path = path.rstrip("/")
    version = published_version(spark, path)
    if not version:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.schema(schema).format(fmt).load(f"{_slot(path, version)}/{name}")


class DatedTable:
    """Rows per date, whole dates replaced by numbered versions."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        """``schema`` has the rows' own columns, ``date`` among them."""
        self.spark, self.path, self.own = spark, path, schema
        self.schema = T.StructType([f for f in schema.fields if f.name != "date"] + [
            T.StructField("generation", T.LongType()), T.StructField("version", T.LongType()),
            T.StructField("date", T.DateType()), T.StructField("turn", T.IntegerType())])

    def _latest(self, version: int | None, dates: Sequence | None) -> tuple[DataFrame, DataFrame]:
        rows = read_folder(self.spark, self.path, self.schema)
        if dates is not None:
            rows = rows.where(F.col("date").isin([F.lit(d) for d in dates]) if dates else F.lit(False))
        if version is not None:
            rows = rows.where(F.col("version") < version)
        last = rows.groupBy(F.col("date").alias("_date")).agg(F.max("generation").alias("_last"))
        return rows, last

    def read(self, before: int | None = None, dates: Sequence | None = None) -> DataFrame:
        """The rows of each date as of the last version (below ``before``); ``dates`` prunes folders."""
        rows, last = self._latest(before, dates)
        return (rows.join(last, (rows["date"] == last["_date"]) & (rows["generation"] == last["_last"]))
                .select(*[f.name for f in self.own.fields]))

    def next_version(self, day) -> int:
        """A version above all that wrote the date."""
        rows, _ = self._latest(None, [day])
        return (rows.agg(F.max("version")).first()[0] or 0) + 1

    def replace(self, rows: DataFrame, version: int, dates: Sequence) -> None:
        """Let ``rows`` be all rows of their dates, all of them in ``dates``, from ``version`` on."""
        _, last = self._latest(version, dates)
        numbers = {r["_date"]: r["_last"] for r in last.collect()}  # a number a date that the version touches
        generation = F.lit(1).cast("long")
        if numbers:
            known = F.create_map(*[x for d, n in numbers.items() for x in (F.lit(d), F.lit(n + 1).cast("long"))])
            generation = F.coalesce(F.try_element_at(known, F.col("date")), generation)
        out = rows.withColumns({"generation": generation, "version": F.lit(version).cast("long")})
        out = out.withColumn("turn", (F.col("generation") % 2).cast("int"))
        (out.select(*self.schema.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "turn").parquet(self.path))
