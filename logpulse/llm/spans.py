"""Regular-expression matches with their places, in SQL functions only.

``split`` gives the gaps between the matches that ``regexp_extract_all``
gives, in the same leftmost order; places are the running sums of both
lengths. Places count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,match:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def found(text: Column, pattern: str) -> Column:
    """The matched strings. Keep this in a column of its own: ``placed`` reads it twice."""
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def placed(text: Column, pattern: str, matches: str, keep) -> Column:
    """The matches (column ``matches``) that ``keep`` accepts, as an array of SPAN."""
    steps = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(matches)).alias("gap"),
                         F.col(matches).alias("match"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["gap"])
        end = start + F.length(s["match"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), s["match"].alias("match")))
        return F.struct(end.alias("at"),
                        F.when(keep(s["match"]), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.expr(NO_SPANS).alias("out"))
    walked = F.aggregate(steps, empty, step, lambda acc: acc["out"])
    return F.when(F.size(matches) == 0, F.expr(NO_SPANS)).otherwise(walked)


def listed(spans: Column) -> Column:
    """Sorted spans with a ``kind`` -> kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def replaced(text: Column, spans: Column, by) -> Column:
    """The text with each span replaced by ``by(span)``; spans come in order of start,
    and overlapping ones are replaced together, by the mark of the first."""
    def step(acc: Column, s: Column) -> Column:
        free = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(free, F.concat(acc["out"], gap, by(s))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
