"""Secret scans: base patterns, and sliding-window Shannon entropy per character class.

Candidates are runs of characters that keys are written in. A candidate's class
(digits, hexadecimal, letters, base 64) sets its least length and threshold. The
entropy of a window of w characters, ``WINDOW`` or the candidate's length if that is
less, is log2(w) - S / w with S the sum of c * log2(c) over the window's counts.
Counts and S go along with the window: moving on by one character takes one from
the count of the character that leaves and adds one to that of the one that
enters, and S changes by their terms, so a step costs the same however long the
candidate is. Counts are five bits each, twelve to a 64-bit number. A
candidate whose best window reaches the threshold (scaled by log2(w) for short
ones) is a span, unless the allow-list suppresses it or a base span covers it.
The allow-list holds what is written like words: letters whose case changes only
at separators and that never have ``CONSONANTS`` consonants in a row, and rulers.

SQL functions only, no shuffle: a row's spans come from the row.

Defined cases: a null text counts as empty, without spans; whole texts are
scanned; very long candidates cost in proportion to their length; repeated rows give
repeated result rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_columns, documents, text_or_empty
from .spans import found, listed, placed, replaced

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs shorter than asked for fail wherever they start, so the length is part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex")

WINDOW = 20
#: The characters of candidates, in the order of base 64 and its variants.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}+"
#: class: (pattern, least entropy in bits a character of a whole window, least length), the first that matches
CLASSES = {"digits": (r"^[0-9]+$", 3.0, 20), "hexadecimal": (r"^[0-9a-fA-F]+$", 3.1, 16),
           "letters": (r"^[A-Za-z]+$", 3.6, 20), "base64": (r"", 3.7, 16)}
CONSONANTS = 5
_BITS, _PER_WORD = 5, 12


def written_like_words(c: Column) -> Column:
    """Letters and separators only, words of one case or with an initial capital, no long run of consonants."""
    return (c.rlike(r"^[A-Za-z+/_=-]+$") & ~c.rlike(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
            & ~c.rlike(rf"(?i)[b-df-hj-np-tv-xz]{{{CONSONANTS}}}"))


def window_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The largest entropy of any ``window`` consecutive characters, or of all if there are fewer;
    ``window`` is at most 31, and ``candidate`` has characters of ALPHABET only."""
    words = -(-len(ALPHABET) // _PER_WORD)
    xlog2 = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(window + 1)])
    codes = F.transform(F.split(candidate, ""), lambda ch: F.position(ch, F.lit(ALPHABET)) - 1)
    word = lambda code: F.floor(code / _PER_WORD).cast("int")
    shift = lambda code: (code % _PER_WORD * _BITS).cast("int")
    one = lambda code: F.call_function("shiftleft", F.lit(1).cast("long"), shift(code))

    def over(v: Column) -> Column:
        codes, width = v["codes"], v["width"]

        def step(acc: Column, i: Column) -> Column:
            moves = i >= width
            leaving, entering = F.get(codes, F.greatest(i - width, F.lit(0))), F.get(codes, i)
            count = lambda code: F.call_function(
                "shiftright", F.get(acc["counts"], word(code)), shift(code)).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
            out = count(leaving)
            into = count(entering) - F.when(moves & (leaving == entering), 1).otherwise(0)
            s = (acc["s"] + F.when(moves, F.get(xlog2, out - 1) - F.get(xlog2, out)).otherwise(0.0)
                 + F.get(xlog2, into + 1) - F.get(xlog2, into))
            counts = F.transform(acc["counts"], lambda c, k: (
                c + F.when(k == word(entering), one(entering)).otherwise(F.lit(0).cast("long"))
                - F.when(moves & (k == word(leaving)), one(leaving)).otherwise(F.lit(0).cast("long"))))
            return F.struct(counts.alias("counts"), s.alias("s"), F.when(
                i >= width - 1, F.least(acc["least"], s)).otherwise(acc["least"]).alias("least"))

        start = F.struct(F.array(*[F.lit(0).cast("long")] * words).alias("counts"), F.lit(0.0).alias("s"),
                         F.lit(1e9).alias("least"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step,
                           lambda a: F.log2(width.cast("double")) - a["least"] / width)

    width = F.least(F.lit(window), F.length(candidate))
    # in an array of one, so that the codes are made once
    return F.transform(F.array(F.struct(codes.alias("codes"), width.alias("width"))), over)[0]


def _secret_like(candidate: Column) -> Column:
    n = F.length(candidate)
    scale = F.least(F.log2(n.cast("double")) / math.log2(WINDOW), F.lit(1.0))
    limit = long_enough = None
    for pattern, bits, least in reversed(CLASSES.values()):
        ours = candidate.rlike(pattern) if pattern else F.lit(True)
        limit = F.when(ours, F.lit(bits)) if limit is None else F.when(ours, F.lit(bits)).otherwise(limit)
        long_enough = F.when(ours, n >= least) if long_enough is None else F.when(ours, n >= least).otherwise(long_enough)
    return F.when(written_like_words(candidate) | ~long_enough, F.lit(False)).otherwise(
        window_entropy(candidate) >= limit * scale)


def _named(col: str, kind: str, number: int) -> Column:
    return F.transform(col, lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["match"].alias("match")))


def secret_spans(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, text, base, spans): arrays of (start, number, end, kind, match),
    sorted; ``spans`` holds the base spans and those of kind entropy."""
    text = F.col("text")
    keyword = F.lit(r"(?i)(passw|secret|token|api_?key)")
    d = document_columns(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    none = F.expr("cast(array() as array<string>)")
    d = d.withColumns({
        # the cheap test skips texts that cannot match
        "assign": F.when(F.regexp_like(text, keyword), found(text, ASSIGN)).otherwise(none),
        "access": F.when(F.contains(text, F.lit("AKIA")), found(text, ACCESS)).otherwise(none),
        "hex": found(text, HEX), "candidate": found(text, CANDIDATE)})
    d = d.select(
        "doc_id", "text",
        placed(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 12).alias("assign"),
        placed(text, ACCESS, "access", lambda m: F.length(m) >= 18).alias("access"),
        placed(text, HEX, "hex", lambda m: F.length(m) >= 16).alias("hex"),
        placed(text, CANDIDATE, "candidate", _secret_like).alias("candidate"))
    d = d.select("doc_id", "text", "candidate", F.array_sort(F.concat(
        *[_named(k, k, i) for i, k in enumerate(KINDS)])).alias("base"))
    uncovered = F.filter("candidate", lambda c: ~F.exists(
        "base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"])))
    d = d.withColumn("entropy", uncovered)
    return d.select("doc_id", "text", "base", F.array_sort(F.concat(
        "base", _named("entropy", "entropy", len(KINDS)))).alias("spans"))


def masked_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every secret replaced by its kind in brackets."""
    return secret_spans(docs).select("doc_id", replaced(
        F.col("text"), F.col("spans"), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]"))).alias("text"))


def op9_window_entropy(spark, sf_dir: str) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return secret_spans(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
