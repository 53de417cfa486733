"""Text log sources: directory scan, line parsing and the reject path.

A log directory is read with Spark's text source (splittable per file block,
so a 100 TB corpus is read by all executors in parallel); each line is parsed
with built-in regex functions. Parsing is a narrow, per-row projection: no
shuffle, no Python.

Regex dialect: patterns are run with Java's ``(?dU)`` flags (``.``/``$`` stop
only at ``\\n``; ``\\d``/``\\S`` are Unicode-aware), which is how Python's
``re`` reads the same patterns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logpulse.constants import APP_LINE_PATTERN, HADOOP_LINE_PATTERN
from logpulse.functions.columns import col_, duration_micros, normalise_level
from logpulse.functions.text import repaired

JAVA_FLAGS = "(?dU)"

ENTRY_COLUMNS = ("timestamp", "level", "logger", "message")


def read_log_lines(spark: SparkSession, path: str, glob: str = "*.log",
                   recursive: bool = True, with_position: bool = False) -> DataFrame:
    """All lines of the matching files under ``path``: (file_path, value).

    Files are read by Spark's text source; ``\\r``, ``\\n`` and ``\\r\\n`` all end
    a line, and bytes that are no UTF-8 become U+FFFD. Like any Spark file source, hidden and ``_``-prefixed files are
    skipped. ``with_position`` adds (file_block_start, line_seq): lines of one
    file block are read in order, so (file_path, file_block_start, line_seq)
    orders lines as in the file.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(path)
    cols = [F.col("_metadata.file_path").alias("file_path")]
    if with_position:
        cols += [F.col("_metadata.file_block_start").alias("file_block_start"),
                 F.monotonically_increasing_id().alias("line_seq")]
    return df.select(*cols, repaired("value").alias("value"))


_ORDER = ("timestamp", "level", "logger", "message")


def _split_line(line_col: str, pattern: str, groups: dict[str, int]):
    """Array of the (timestamp, level, logger, message) group texts.

    One regex evaluation per line: ``pattern`` gets a catch-all alternative
    and ``regexp_replace`` rewrites the whole value to its groups joined by
    ``\\n``. Both alternatives consume the value to its end, over newlines
    too, so nothing of it is left beside the groups, and no group can contain
    a newline (``\\S`` and ``.`` exclude it under ``(?d)``): the split is exact.
    A value that only matches the catch-all rewrites to empty parts (empty
    timestamp).
    """
    p = f"{JAVA_FLAGS}(?:{pattern})(?s:.*)|^(?s:.*)"
    rewrite = "\n".join(f"${groups[k]}" for k in _ORDER)
    return F.split(F.regexp_replace(col_(line_col), p, rewrite), "\n", len(_ORDER))


def _fields(parts, level_expr, logger_expr) -> dict:
    part = {k: F.try_element_at(parts, F.lit(i + 1)) for i, k in enumerate(_ORDER)}
    # try_cast('') is NULL, so "accepted" is exactly "timestamp IS NOT NULL"
    return {
        "timestamp": part["timestamp"].try_cast("timestamp_ntz"),
        "raw_level": part["level"],
        "level": level_expr(part["level"]),
        "logger": logger_expr(part["logger"]),
        "message": part["message"],
    }


def _tag(lines: DataFrame, line_col: str, pattern: str, groups: dict[str, int],
         level_expr, logger_expr) -> DataFrame:
    """All lines plus parsed columns and ``reject_reason`` (NULL for accepted
    lines; the parsed columns are only meaningful for those)."""
    staged = lines.withColumn("_parts", _split_line(line_col, pattern, groups))
    f = _fields(F.col("_parts"), level_expr, logger_expr)
    no_match = F.coalesce(F.try_element_at(F.col("_parts"), F.lit(1)) == F.lit(""), F.lit(True))
    reason = (F.when(f["timestamp"].isNotNull(), F.lit(None).cast("string"))
              .when(no_match, F.lit("no_match")).otherwise(F.lit("bad_timestamp")))
    return staged.withColumns({**f, "reject_reason": reason}).drop("_parts")


def _accept(lines: DataFrame, line_col: str, pattern: str, groups: dict[str, int],
            level_expr, logger_expr, keep_raw: bool) -> DataFrame:
    """Accepted lines only, parsed with one regex evaluation per line.

    The parsed row is emitted through a generator (``inline`` of a zero- or
    one-element array) instead of a filter: a filter would be pushed below
    the projection with the parse inlined, evaluating the regex twice.
    """
    others = [c for c in lines.columns if c != line_col]
    raw = [F.col(line_col).alias("raw")] if keep_raw else []
    staged = lines.select(*others, *raw, _split_line(line_col, pattern, groups).alias("_parts"))
    f = _fields(F.col("_parts"), level_expr, logger_expr)
    row = F.struct(*[f[k].alias(k) for k in _ORDER])
    kept = [*others, *(["raw"] if keep_raw else [])]
    return staged.select(*kept, F.inline(F.when(f["timestamp"].isNotNull(), F.array(row))))


_HADOOP = (HADOOP_LINE_PATTERN, {"timestamp": 1, "level": 2, "logger": 4, "message": 5},
           normalise_level, lambda c: F.substring_index(c, ".", -1))  # logger = last dotted segment
_APP = (APP_LINE_PATTERN, {"timestamp": 1, "level": 2, "logger": 3, "message": 4},
        lambda c: c, lambda c: c)


def tag_hadoop_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return _tag(lines, line_col, *_HADOOP)


def tag_app_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return _tag(lines, line_col, *_APP)


def parse_hadoop_lines(lines: DataFrame, line_col: str = "value",
                       keep_raw: bool = False) -> DataFrame:
    """Hadoop-format lines -> entries (timestamp, level, logger, message).

    Unmatched lines (DEBUG/TRACE, stack-trace continuations, components not
    ending in ':', ...) and impossible dates go to :func:`parse_rejects`.
    Other columns of ``lines`` pass through.
    """
    return _accept(lines, line_col, *_HADOOP, keep_raw)


def parse_app_lines(lines: DataFrame, line_col: str = "value", keep_raw: bool = False,
                    hours: int | None = None, as_of: datetime | str | None = None) -> DataFrame:
    """App-format lines (``ts — LEVEL — logger — message``) -> entries.

    With ``hours`` and ``as_of`` only entries with ``timestamp >= as_of - hours``
    are kept (the look-back window; later rows are kept too).
    """
    out = _accept(lines, line_col, *_APP, keep_raw)
    if hours is not None:
        out = recent(out, hours, as_of)
    return out


def recent(entries: DataFrame, hours: int, as_of: datetime | str) -> DataFrame:
    """Entries not before ``as_of - hours``; with a ``date`` column (landed entries) by folder too."""
    if as_of is None:
        raise ValueError("as_of is required with hours (results must be repeatable)")
    cutoff = F.timestamp_add("MICROSECOND", F.lit(-duration_micros(f"{hours} hours")),
                             F.lit(str(as_of)).cast("timestamp_ntz"))
    kept = entries.where(F.col("timestamp") >= cutoff)
    # landed entries lie in folders by date: the folders before the cutoff's date are not read
    return kept.where(F.col("date") >= F.to_date(cutoff)) if "date" in entries.columns else kept


def parse_rejects(lines: DataFrame, line_col: str = "value", fmt: str = "hadoop") -> DataFrame:
    """Lines the parser drops, with ``reject_reason`` in {no_match, bad_timestamp}."""
    tag = tag_hadoop_lines if fmt == "hadoop" else tag_app_lines
    return (tag(lines, line_col)
            .where(F.col("reject_reason").isNotNull())
            .drop(*ENTRY_COLUMNS, "raw_level"))


def reject_summary(lines: DataFrame, by: list[str] | tuple = ("file_path",),
                   line_col: str = "value", fmt: str = "hadoop") -> DataFrame:
    """Rejected-line counts per ``by`` columns and reason."""
    return (parse_rejects(lines, line_col, fmt)
            .groupBy(*by, "reject_reason").agg(F.count(F.lit(1)).alias("n_rejected")))


def load_hadoop_logs(spark: SparkSession, path: str, keep_raw: bool = False) -> DataFrame:
    """Scan a directory tree of ``*.log`` files and parse them (Hadoop format)."""
    return parse_hadoop_lines(read_log_lines(spark, path), keep_raw=keep_raw)


def load_app_logs(spark: SparkSession, path: str, glob: str = "*.log", hours: int | None = None,
                  as_of: datetime | str | None = None, keep_raw: bool = False) -> DataFrame:
    return parse_app_lines(read_log_lines(spark, path, glob), keep_raw=keep_raw,
                           hours=hours, as_of=as_of)


def union_sources(*frames: tuple[str, DataFrame]) -> DataFrame:
    """UNION ALL of parsed frames of the entry shape, tagged with ``source``."""
    out = None
    for name, df in frames:
        df = df.select(F.lit(name).alias("source"), *ENTRY_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out


def stream_log_lines(spark: SparkSession, path: str, glob: str = "*.log",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming counterpart of :func:`read_log_lines` (new files per micro-batch)."""
    reader = (spark.readStream.format("text").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file_path"), repaired("value").alias("value"))
