"""Quality rules by robust multivariate outliers.

Base rules drop texts of fewer than 50 words or with most words in repeated
windows. The rest is judged by minimum-covariance-determinant estimates per
(lang, source): a statistic vector is rejected when its squared Mahalanobis
distance from the group's robust centre exceeds ``REJECT``.

The estimates use every row of a group, however large. A concentration step
is one aggregation: rows are counted, summed and multiplied per (group, start,
distance bin) before the shuffle, the bins of a group are added up in order
of distance until exactly ``COVERED`` of its rows are in, the last bin with the
share of its rows that is wanted, and their mean and covariance are the next
estimate; only one row per group, start and bin leaves a task. Steps go on until no
determinant falls any more, from two deterministic starts (the median and
interquartile range of each statistic, and with them the correlations of
the spatial signs), and the smaller determinant wins. Groups under ``MIN_ROWS`` rows
use the estimate of their language over all sources; a language under that many
rows rejects nothing beyond the base rules.

Transformed statistics: log of the word count, log of the mean word length,
square roots of the shares of symbols, of repeated lines and of words in
repeated windows. The last two are shares of a few lines or words in a short text, so
``PRIOR_LINES`` lines and ``PRIOR_WORDS`` words that do not repeat are added. A
spread below ``FLOOR`` is raised to it, so that a statistic that is constant in a group
does not reject on a rounding error; other spreads are left as they are, so each
statistic can reject alone.

Defined cases: a null or blank text has no words and fails the base rules; null
lang and source form groups of their own; whole texts are used; equal rows (ties in
distance) count alike; repeated rows give repeated result rows and count as often; an empty
table gives no rows; other columns are ignored (and kept by ``keep_good``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import document_columns, documents, written

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_ROWS = 50
COVERED = 0.6
#: At most so many concentration steps; they end when no determinant changes by more than one part in a hundred.
STEPS = 12
SETTLED = 0.01
PRIOR_LINES, PRIOR_WORDS = 8, 64
#: Squared distance: the chi-square quantile of the five statistics at 1 - 1e-5.
REJECT = 30.856
#: Smallest spread (standard deviation) of each transformed statistic; a larger one is left as it is.
FLOOR = (0.5, 0.1, 0.05, 0.1, 0.1)
#: Groups whose estimates may be broadcast (about 300 bytes each); more are joined.
BROADCAST_GROUPS = 20_000

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
P = len(FLOOR)
X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_stats(text: str | None) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of a whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # splits bytes on ASCII white space only
    n = len(words)
    if not n:
        return 0, 0, len(raw) - len(raw.translate(None, _SYMBOLS)), 0, 0, 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeat = 0
    if n > 3:
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
        if len(seen) < n:  # all words different: no window can come twice
            m = len(seen)
            windows = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]  # exact below two million different words
            if m >= 2_000_000:
                _, pairs = np.unique(ids[:-2] * m + ids[1:-1], return_inverse=True)
                windows = pairs.astype(np.int64) * m + ids[2:]
            _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
            twice = count[inverse] > 1
            hit = np.zeros(n, dtype=bool)
            for k in range(3):
                hit[k:n - 2 + k] |= twice
            repeat = int(hit.sum())
    return (n, len(text) - (len(raw) - len(raw.translate(None, _SPACE))),
            len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat, len(lines))


@F.pandas_udf(T.StructType([T.StructField(s, T.LongType()) for s in STATS]))
def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=STATS, dtype="int64")


def _with_vector(stats: DataFrame) -> DataFrame:
    """Adds base_failed and the transformed statistics x0..x4 (zero for a text without words)."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    share = lambda a, b, prior=0: F.sqrt(F.col(a) / F.greatest(F.col(b) + prior, F.lit(1)))
    vector = [F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
              share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines", PRIOR_LINES),
              share("n_repeat_words", "n_words", PRIOR_WORDS)]
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    # rounded: sums then do not depend on the last bits
    return stats.withColumns({"base_failed": failed, **{x: F.round(v, 9) for x, v in zip(X, vector, strict=True)}})


def _level(lang: Column, source: Column | None) -> Column:
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.concat_ws("\x00", part(lang), part(source) if source is not None else F.lit("*"))


def _start(min_rows: int, floor: tuple[float, ...]):
    def run(counts: pd.DataFrame) -> pd.DataFrame:
        """Binned counts of one group -> median centre and diagonal spread; none under MIN_ROWS rows."""
        if counts["n"].sum() < min_rows * P:  # a row counts once in each of the P dimensions
            return pd.DataFrame({"g": [], "start": [], "mean": [], "inv": [], "logdet": []}, dtype=object)
        mean, var = [], []
        for i in range(P):
            one = counts[counts["dim"] == i].sort_values("bin")
            at = one["n"].cumsum().to_numpy()
            q = [one["bin"].iloc[int(np.searchsorted(at, f * at[-1]))] / 64 for f in (0.25, 0.5, 0.75)]
            mean.append(q[1])
            var.append(((q[2] - q[0]) / 1.349) ** 2)
        return _estimate(counts["g"].iloc[0], 0, np.array(mean), _floored(np.diag(var), floor))

    return run


def _sign_start(floor: tuple[float, ...]):
    def run(sums: pd.DataFrame) -> pd.DataFrame:
        """Sums of products of a group's spatial signs, with its first estimate -> the same centre and spreads, correlated."""
        one = sums.iloc[0]
        spread = np.sqrt(1 / np.diag(np.array(one["inv"]).reshape(P, P)))
        signs = np.eye(P)
        for i, j in PAIRS:
            signs[i, j] = signs[j, i] = one[f"p{i}{j}"] + (i == j) * 1e-9
        scale = np.sqrt(np.diag(signs))
        return _estimate(one["g"], 1, np.array(one["mean"]), _floored(signs / np.outer(scale, scale) * np.outer(spread, spread), floor))

    return run


def _floored(cov: np.ndarray, floor: tuple[float, ...]) -> np.ndarray:
    """The spread of each direction raised to 1 in units of ``floor``; larger ones are left as they are."""
    unit = np.outer(floor, floor)
    value, vector = np.linalg.eigh(cov / unit)
    return (vector * np.maximum(value, 1.0)) @ vector.T * unit


def _estimate(group: str, start: int, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    inv = np.linalg.inv(cov)
    return pd.DataFrame({"g": [group], "start": [start], "mean": [np.round(mean, 9).tolist()],
                         "inv": [np.round(inv, 9).ravel().tolist()], "logdet": [round(float(np.linalg.slogdet(cov)[1]), 9)]})


def _concentrate(floor: tuple[float, ...]):
    def run(bins: pd.DataFrame) -> pd.DataFrame:
        """Sums per distance bin of one group and start -> estimate from the nearest COVERED of its rows."""
        bins = bins.sort_values("bin")
        n = bins["n"].to_numpy(dtype=float)
        before = np.cumsum(n) - n
        wanted = COVERED * n.sum()
        part = np.clip((wanted - before) / n, 0, 1)  # all of the near bins, of the last one what is missing
        mean = np.array([(bins[x] * part).sum() for x in X]) / wanted
        cov = np.zeros((P, P))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = (bins[f"p{i}{j}"] * part).sum() / wanted - mean[i] * mean[j]
        # the nearest share of a normal cloud is narrower than the cloud
        return _estimate(bins["g"].iloc[0], int(bins["start"].iloc[0]), mean, _floored(cov * CONSISTENCY, floor))

    return run


#: Fixed value: COVERED / P(chi-square with 7 degrees of freedom <= the 5-degree COVERED quantile).
CONSISTENCY = 1.6848

_ESTIMATE = "g string, start int, mean array<double>, inv array<double>, logdet double"


def _distance() -> Column:
    d = [F.col(x) - F.col("mean")[i] for i, x in enumerate(X)]
    total = F.lit(0.0)
    for i in range(P):
        row = F.lit(0.0)
        for j in range(P):
            row = row + F.col("inv")[i * P + j] * d[j]
        total = total + d[i] * row
    return F.greatest(total, F.lit(0.0))


def _join_estimates(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    small = estimates.count() <= BROADCAST_GROUPS  # checked size; beyond it a shuffled, skew-split join
    return rows.join(F.broadcast(estimates) if small else estimates, "g", how)


def fit(vectors: DataFrame, min_rows: int = MIN_ROWS, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """(lang, source, x0..x4) -> (g, mean, inv, logdet): one estimate per (lang, source) and per lang."""
    rows = vectors.select(F.explode(F.array(
        _level(F.col("lang"), F.col("source")), _level(F.col("lang"), None))).alias("g"), *X)
    counts = rows.select("g", F.posexplode(F.array(*[F.round(F.col(x) * 64).cast("long") for x in X]))
                         .alias("dim", "bin")).groupBy("g", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    # no join by g here: it would be pushed below the counts and deal the rows by group
    first = written(counts.groupBy("g").applyInPandas(_start(min_rows, floor), _ESTIMATE), "mcd")
    off = [(F.col(x) - F.col("mean")[i]) * F.sqrt(F.col("inv")[i * P + i]) for i, x in enumerate(X)]
    length = F.greatest(sum((z * z for z in off), F.lit(0.0)), F.lit(1e-12))
    signs = _join_estimates(rows, first).groupBy("g").agg(
        *[F.sum(off[i] * off[j] / length).alias(f"p{i}{j}") for i, j in PAIRS])
    second = signs.join(first, "g").groupBy("g").applyInPandas(_sign_start(floor), _ESTIMATE)
    estimates = written(first.unionByName(second), "mcd")
    for _ in range(STEPS):
        d = _join_estimates(rows, estimates).withColumn(
            "bin", F.floor(16 * F.log2(_distance() + 0.001)))
        sums = d.groupBy("g", "start", "bin").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in X],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i, j in PAIRS])
        before, estimates = estimates, written(sums.groupBy("g", "start").applyInPandas(_concentrate(floor), _ESTIMATE), "mcd")
        moved = estimates.join(before.select("g", "start", F.col("logdet").alias("was")), ["g", "start"]).agg(
            F.max(F.abs(F.col("was") - F.col("logdet")))).first()[0]
        if moved is None or moved <= SETTLED:
            break
    best = estimates.groupBy("g").agg(F.min_by(F.struct("mean", "inv", "logdet"), F.struct("logdet", "start")).alias("e"))
    return written(best.select("g", "e.*"), "mcd_best")


def judge(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds distance2 (null without an estimate) and kept."""
    own = estimates.select("g", F.struct("mean", "inv").alias("own"))
    lang = estimates.select(F.col("g"), F.struct("mean", "inv").alias("pooled"))
    out = _join_estimates(vectors.withColumn("g", _level(F.col("lang"), F.col("source"))), own, "left")
    out = _join_estimates(out.withColumn("g", _level(F.col("lang"), None)), lang, "left")
    out = out.withColumn("e", F.coalesce("own", "pooled")).withColumns(
        {"mean": F.col("e.mean"), "inv": F.col("e.inv")})
    out = out.withColumn("distance2", _distance()).drop("g", "own", "pooled", "e", "mean", "inv")
    return out.withColumn("kept", ~F.col("base_failed") & (
        F.coalesce(F.col("distance2"), F.lit(0.0)) <= REJECT))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, lang, source, statistics, base_failed, distance2, kept), a row per row."""
    base = document_columns(docs, "doc_id", "text", "lang", "source")
    vectors = written(_with_vector(base.select("doc_id", "lang", "source", _stats("text").alias("s"))
                                   .select("doc_id", "lang", "source", "s.*")), "quality_vectors")
    return judge(vectors, fit(vectors.where(~F.col("base_failed"))))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, all columns. They are written once with their statistics, and never shuffled."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       docs["lang"].alias("lang"), docs["source"].alias("source"),
                       _stats(docs["text"]).alias("s")).select("row", "lang", "source", "s.*")
    vectors = written(_with_vector(rows), "quality_rows")
    return judge(vectors, fit(vectors.where(~F.col("base_failed")))).where("kept").select("row.*")


def op1_robust_outliers(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("distance2", 6).alias("distance2"))
