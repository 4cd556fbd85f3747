"""Quality rules and robust multivariate outliers.

Per document a few counts; per language and source the minimum-covariance-determinant estimate of the
transformed counts; documents whose Mahalanobis distance is beyond a chi-square quantile are rejected.
The concentration steps run over all documents as aggregates: a group is summed up by distance bins (counts,
sums and cross products, merged map-side), so a source with a third of all rows costs no more than its share.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import row_ranges

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS = 50        # fewer fail the base rules
#: Counting noise of each feature in the shortest document that is judged: a count of n words has a relative error of
#: ``n ** -0.5``, a mean over them half of that (words spread by about half their length), the root of a rate over n
#: words, or five characters a word, ``n ** -0.5 / 2`` at any rate, and a repeated window counts three words at a time.
#: No direction is taken to be narrower: groups in which nearly all documents have no symbol or no repeated line
#: would reject the first with one.
FLOORS = tuple(c / LEAST_WORDS ** 0.5 for c in (1, 0.5, 0.5 / 5 ** 0.5, 0.5, 0.5 * 3 ** 0.5))
SUPPORT = 0.75          # share of a group that the estimate rests on
STEPS = 6               # concentration steps
MIN_GROUP = 200         # smaller groups are judged by the estimate of their language
QUANTILE = 0.999        # of the chi-square distribution of squared distances
_P = len(FLOORS)
_CROSS = [(i, j) for i in range(_P) for j in range(i, _P)]


def document_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; zeros for null."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen: dict = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        upto = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return (len(words), len(text) - len(raw) + len(raw.translate(None, b" \t\n\x0b\x0c\r")),
            len(raw) - len(raw.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated)


def counted(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` columns and the five counts of every row, in one narrow pass."""
    docs = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def rows(batches):
        for batch in batches:
            texts = batch.column(len(keep))
            for lo, hi in row_ranges(texts, 1 << 22):
                found = np.array([document_counts(t) for t in texts[lo:hi].to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[lo:hi] for i in range(len(keep))), *map(pa.array, found.T)],
                    [*keep, *COUNTS])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.mapInArrow(rows, ", ".join([*(f"`{k}` {types[k]}" for k in keep), *(f"{c} bigint" for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> list[Column]:
    words, chars = F.col("n_words") + 1, F.col("word_chars") + 1
    return [F.log(words), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars),
            F.sqrt(F.col("n_dup_lines") / words), F.sqrt(F.col("n_repeat_words") / words)]


# the estimate ---------------------------------------------------------------------------------------------------

def chi2_cdf(x: float, k: int) -> float:
    """P(k / 2, x / 2), the regularised lower incomplete gamma function, by its series."""
    a, z = k / 2, x / 2
    if z <= 0:
        return 0.0
    if z > 700:
        return 1.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return high


_CONSISTENCY = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, _P), _P + 2)
_PARAMS = "grp string, n bigint, " + ", ".join(f"m{i} double" for i in range(_P)) + ", " + ", ".join(
    f"v{i}{j} double" for i, j in _CROSS)


def _parameters(grp: str, n: int, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    """In units of the floors a variance below 1, in whatever direction, is taken as 1; wider ones stay as they are."""
    unit = np.outer(FLOORS, FLOORS)
    spread, axes = np.linalg.eigh(cov / unit)
    inverse = (axes / np.maximum(spread, 1.0)) @ axes.T / unit
    return pd.DataFrame([[grp, n, *mean, *(inverse[i, j] for i, j in _CROSS)]],
                        columns=[x.split()[0] for x in _PARAMS.split(", ")])


def _start(pdf: pd.DataFrame) -> pd.DataFrame:
    """Centre and spread of each feature by its median and quartiles, read off the histogram of one group."""
    mean, width, n = np.zeros(_P), np.ones(_P), 0
    for k, part in pdf.groupby("k"):
        part = part.sort_values("bin")
        upto, n = part["n"].cumsum().to_numpy(), int(part["n"].sum())
        low, mid, high = (part["bin"].to_numpy()[np.searchsorted(upto, q * n)] / 64 for q in (0.25, 0.5, 0.75))
        mean[k], width[k] = mid, (high - low) / 1.349
    return _parameters(pdf["grp"].iloc[0], n, mean, np.diag(width ** 2))


def _concentrate(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mean and covariance of the nearest bins that hold the supporting share of one group."""
    pdf = pdf.sort_values("bin")
    n = int(pdf["n"].sum())
    part = pdf.iloc[: int(np.searchsorted(pdf["n"].cumsum().to_numpy(), SUPPORT * n)) + 1]
    h = part["n"].sum()
    mean = np.array([part[f"s{i}"].sum() for i in range(_P)]) / h
    cov = np.zeros((_P, _P))
    for i, j in _CROSS:
        cov[i, j] = cov[j, i] = part[f"c{i}{j}"].sum() / h - mean[i] * mean[j]
    return _parameters(pdf["grp"].iloc[0], n, mean, cov * (_CONSISTENCY if h < n else 1.0))


def _with_distance(rows: DataFrame, params: DataFrame, how: str) -> DataFrame:
    gap = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(_P)]
    total = sum(((1 if i == j else 2) * gap[i] * gap[j] * F.col(f"v{i}{j}") for i, j in _CROSS), F.lit(0.0))
    return rows.join(params.drop("n"), "grp", how).withColumn("d2", F.greatest(total, F.lit(0.0)))


def estimates(rows: DataFrame) -> DataFrame:
    """MCD parameters per ``grp`` of ``rows(grp, x0..x4)``.

    Each concentration step writes them as a small table: documents meet it as a broadcast of measured size and are not dealt by
    group, and their sums merge by group and bin before any shuffle.
    """
    bins = rows.select("grp", F.posexplode(F.array(*[F.round(64 * F.col(f"x{i}")).cast("int") for i in range(_P)]))
                       .alias("k", "bin")).groupBy("grp", "k", "bin").agg(F.count("*").alias("n"))
    params = staged(bins.groupBy("grp").applyInPandas(_start, _PARAMS), "quality-start")
    for _ in range(STEPS):
        near = _with_distance(rows, params, "inner").withColumn("bin", F.floor(16 * F.log2(1 + F.col("d2"))))
        sums = near.groupBy("grp", "bin").agg(
            F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(_P)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i, j in _CROSS])
        params = staged(sums.groupBy("grp").applyInPandas(_concentrate, _PARAMS), "quality-step")
    return params


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           keep: tuple[str, ...] = ("doc_id",), min_group: int = MIN_GROUP, quantile: float = QUANTILE) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed``, ``d2`` (null where not judged) and ``kept`` per row.

    Documents that fail the base rules take no part in the estimates. Null languages and sources form groups
    of their own. A group of fewer than ``min_group`` documents is judged by its whole language, and not at all if
    that is as small: the base rules decide. Repeated rows count each; an empty table gives an empty one.
    """
    docs = docs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keep)], F.col(lang_col).alias("_l"),
                       F.col(source_col).alias("_s"), F.col(text_col).alias("_t"))
    ids = tuple(f"_k{i}" for i in range(len(keep)))
    stats = counted(docs, "_t", (*ids, "_l", "_s")).select(
        *ids, *COUNTS, base_failed().alias("base_failed"), F.to_json(F.struct("_l", "_s")).alias("_fine"),
        F.to_json(F.struct("_l")).alias("_wide"), *[x.alias(f"x{i}") for i, x in enumerate(_features())])
    stats = staged(stats, "quality")
    judgeable = stats.where(~F.col("base_failed"))
    fine = judgeable.groupBy("_fine", "_wide").agg(F.count("*").alias("n"))
    sized = fine.withColumn("grp", F.when(F.col("n") >= min_group, F.col("_fine")).otherwise(F.col("_wide")))
    groups = sized.select("_fine", "grp")
    params = estimates(staged(_rows(judgeable, groups), "quality-groups")).where(F.col("n") >= min_group)
    limit = chi2_quantile(quantile, _P)
    found = _with_distance(stats.join(groups, "_fine", "left"), params, "left")
    verdict = F.coalesce(F.col("d2") <= limit, F.lit(True))
    seen = F.when(~F.col("base_failed") & F.col("m0").isNotNull(), F.col("d2"))
    return found.select(*[F.col(i).alias(k) for i, k in zip(ids, keep)], *COUNTS, "base_failed", seen.alias("d2"),
                        (~F.col("base_failed") & (F.col("m0").isNull() | verdict)).alias("kept"))


def _rows(judgeable: DataFrame, groups: DataFrame) -> DataFrame:
    """Each document under its group, and once more under its language where small groups need that estimate."""
    xs = [f"x{i}" for i in range(_P)]
    own = judgeable.join(groups, "_fine").where(F.col("grp") == F.col("_fine")).select("grp", *xs)
    needed = groups.where(F.col("grp") != F.col("_fine")).select(F.col("grp").alias("_wide")).distinct()
    return own.unionByName(judgeable.join(needed, "_wide").select(F.col("_wide").alias("grp"), *xs))
