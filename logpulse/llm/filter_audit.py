"""Interaction of filters: what each removes alone, in every order, and together.

Five filters: A few words, B few different words, C many capitals, D symbols, E a
copy of a text with a smaller doc_id. A to D come from the text alone. For E a
counting Bloom filter goes ahead of any shuffle of texts:

1. The texts' hashes set ``SLOTS`` counters each in a cell of 64 counters; cells grow
   with the number of documents (``COUNTERS`` counters a document). Tasks add up
   their own counters before the shuffle, which merges them, and of the merged
   sketch the counters of two or more stay, a 64-bit word a cell.
2. A text with a counter of one is guaranteed unique. The others are possible
   repeats: only their texts are shuffled, whole, for the smallest doc_id of each.
3. A hash stands for its text from there on if a single text has it, which the
   whole texts tell; documents whose hash has several texts are matched by text.

The five flags are a mask; documents are counted by (part, mask, labels), which
adds up over tasks. Every order, step and Shapley sum is then read off at most
128 counts a part: the documents kept after a set of filters are those whose mask
shares no filter with it.

Defined cases: a null text counts as empty, a null source as the part of the empty
string; a text without words passes B, an empty one C; a null doc_id is larger
than all others and equal to itself, so of equal texts without any id none is a copy;
of several labels of a doc_id one with quality 1, or toxic 1, is enough; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_columns, documents, read_table, text_or_empty, uniform64, written

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITAL_PCT = 2
SYMBOLS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Counters a document, and counters it sets.
COUNTERS = 32
SLOTS = 3
#: Hashes of possible repeats (8 bytes each) are broadcast up to here, and joined by a shuffle beyond.
BROADCAST_HASHES = 2_000_000

_BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def with_mask(rows: DataFrame) -> DataFrame:
    """``rows`` with ``mask``: the filters A to D that ``text`` fails."""
    text = F.col("text")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    counted = rows.withColumn("words", words).withColumns({
        "n_words": F.size("words").cast("long"), "n_distinct": F.size(F.array_distinct("words")).cast("long"),
        "n_capitals": (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("long")})
    fails = {"A": F.col("n_words") < MIN_WORDS,
             "B": F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT_PCT,
             "C": F.col("n_capitals") * 100 > F.length(text) * MAX_CAPITAL_PCT, "D": text.rlike(SYMBOLS)}
    mask = sum((F.when(c, _BIT[f]).otherwise(0) for f, c in fails.items()), F.lit(0))
    return counted.withColumn("mask", mask).drop("words", "n_words", "n_distinct", "n_capitals")


def _slots(h: Column, cells: int) -> tuple[Column, list[Column]]:
    """A hash's cell and its counters in the cell."""
    spread = uniform64(17, h)
    return (F.pmod(uniform64(11, h), F.lit(cells)),
            [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(SLOTS)])


def possible_repeats(hashes: DataFrame, n: int) -> DataFrame:
    """(h) a row a document -> (h), once, of all that the sketch cannot tell to be unique."""
    cells = max(1, -(-n * COUNTERS // 64))
    cell, slots = _slots(F.col("h"), cells)
    counters = (hashes.select(cell.alias("cell"), F.explode(F.array_distinct(F.array(*slots))).alias("slot"))
                .groupBy("cell", "slot").agg(F.count(F.lit(1)).alias("count")))
    twice = (counters.where(F.col("count") > 1).groupBy("cell")
             .agg(F.bit_or(F.expr("shiftleft(1L, slot)")).alias("twice")))
    own = F.lit(0).cast("long")
    for s in slots:
        own = own.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), s))
    tested = hashes.select("h", cell.alias("cell"), own.alias("own"))
    return (tested.join(twice, "cell").where(F.col("own").bitwiseAND(F.col("twice")) == F.col("own"))
            .select("h").distinct())


def copies(texts: DataFrame, flags: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """``flags`` (doc_id, h, ...) with ``copy``: whether a smaller doc_id has the same text.

    ``texts`` holds the text beside the columns of ``flags``, for the same documents."""
    suspects = written(possible_repeats(flags.select("h"), flags.count()), "audit_suspects")
    few = suspects.count() <= broadcast_hashes
    possible = texts.join(F.broadcast(suspects) if few else suspects, "h", "left_semi")
    least = F.min("doc_id").alias("least")
    by_text = possible.groupBy("h", "text").agg(least, F.count(F.lit(1)).alias("rows"))
    by_hash = written(by_text.groupBy("h").agg(F.count(F.lit(1)).alias("n_texts"), F.min("least").alias("least"),
                                               F.sum("rows").alias("rows")).where("rows > 1"), "audit_repeats")
    after = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("least") < F.col("doc_id")))
    told = by_hash.select("h", "least", (F.col("n_texts") > 1).alias("several"))
    found = flags.join(told, "h", "left").withColumn("copy", F.coalesce(after, F.lit(False)))
    mixed = by_hash.where("n_texts > 1").select("h")
    if not mixed.count():  # no two texts share a hash
        return found.drop("least", "several")
    own = texts.join(mixed, "h", "left_semi")
    by_text = own.groupBy("h", "text").agg(least)
    exact = own.join(by_text, ["h", "text"]).withColumn("copy", F.coalesce(after, F.lit(False)))
    return (found.where(~F.coalesce("several", F.lit(False))).drop("least", "several")
            .unionByName(exact.drop("least", "text")))


def labelled(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``flags`` with ``good`` and ``toxic`` of their doc_id's labels; rows without an id meet none."""
    marks = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("doc_id")).agg(
        F.coalesce(F.bool_or(labels["quality"] == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(labels["toxic"] == 1), F.lit(False)).alias("toxic"))
    with_id = flags.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")
    no = F.lit(False)
    without = flags.where(F.col("doc_id").isNull()).withColumns({"good": no, "toxic": no})
    return with_id.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}).unionByName(without)


def mask_counts(docs: DataFrame, labels: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """documents, labels -> (part, mask, n, good, toxic): documents by part and failed filters."""
    base = document_columns(docs, "doc_id", "source", "text").select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text_or_empty().alias("text"))
    rows = with_mask(base.withColumn("h", hash_of(F.col("text"))))
    flags = written(rows.drop("text"), "audit_flags")
    marked = labelled(copies(rows, flags), labels)
    mask = F.col("mask") + F.when(F.col("copy"), _BIT["E"]).otherwise(0)
    one = lambda c: F.count_if(c).alias(c)
    return marked.groupBy("part", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"), one("good"), one("toxic"))


def _steps() -> Column:
    """(filter_order, step, bit, before, after) of every step of every order: 600 of them."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for i, f in enumerate(order):
            rows.append((order, i + 1, _BIT[f], before, before | _BIT[f]))
            before |= _BIT[f]
    names = ("filter_order", "step", "bit", "before", "after")
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, r, strict=True)]) for r in rows])


def interactions(counts: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic), added up -> a row per part, order and step."""
    # at most 32 masks a part
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    zero = F.lit(0).cast("long")

    def total(of: Callable[[Column], Column]) -> Column:
        return F.aggregate("m", zero, lambda a, x: a + of(x))

    def passing(name: str) -> Column:
        """By set of filters: how many documents fail none of the set."""
        return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda s: total(
            lambda x: F.when(x["mask"].bitwiseAND(s) == 0, x[name]).otherwise(zero)))

    def by_filter(of: Callable[[Column, int], Column]) -> Column:
        return F.array(*[total(lambda x, b=b: F.when(x["mask"].bitwiseAND(F.lit(b)) != 0, of(x, b)).otherwise(zero))
                         for b in _BIT.values()])

    orders = 120
    share = lambda x, b: x["n"] * (F.lit(orders) / F.greatest(F.bit_count(x["mask"]), F.lit(1))).cast("long")  # noqa: E731, ARG005
    wide = parts.select(
        "part", passing("n").alias("n"), passing("good").alias("good"), passing("toxic").alias("toxic"),
        by_filter(lambda x, b: x["n"]).alias("fails"),
        by_filter(lambda x, b: F.when(x["mask"] == b, x["n"]).otherwise(zero)).alias("alone"),
        by_filter(share).alias("shapley"))
    s = wide.select("*", F.explode(_steps()).alias("s"))
    at = lambda of, i: F.get(F.col(of), F.col(f"s.{i}"))
    letter = F.bit_count(F.col("s.bit") - 1)  # the filter's number
    removed = lambda of: at(of, "before") - at(of, "after")
    return s.select(
        "part", "s.filter_order", "s.step", at("n", "after").alias("kept"), removed("n").alias("removed"),
        (F.get("fails", letter) - removed("n")).alias("redundant"), F.get("alone", letter).alias("unique_fails"),
        removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), F.get("shapley", letter).alias("shapley"))


def op11_counting_bloom_audit(spark, sf_dir: str) -> DataFrame:
    return interactions(mask_counts(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")))
