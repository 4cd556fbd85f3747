"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts 1- to 3-grams of lower-cased letters per language in a fixed number of hash buckets; the matrix
of log-probabilities (buckets x languages, at most ``MAX_LANGUAGES``) is broadcast. Scoring reads each text
once, gathers the matrix rows of its n-grams and adds them up in numpy.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import row_ranges

ORDERS = (1, 2, 3)
BUCKET_BITS = 15
#: Labelled documents per language that the fit reads, about: the bounded sample of a classifier.
SAMPLE = 4_000
MAX_LANGUAGES = 200        # a matrix of 26 MB to broadcast, 52 MB on the driver
SMOOTHING = 0.5
UNKNOWN = "und"
_PIECE = 1 << 20        # characters of one text that are scored at a time


class Model(NamedTuple):
    languages: list[str]
    log_prior: np.ndarray       # L
    log_prob: np.ndarray        # buckets x L, float32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a space for what is no letter."""
    return np.fromiter((ord(low) if (c := chr(i)).isalpha() and len(low := c.lower()) == 1 else i if c.isalpha()
                        else 32 for i in range(0x110000)), np.uint32, 0x110000)


def ngrams(texts: list[str | None], bits: int = BUCKET_BITS):
    """For each order: buckets of all n-grams, in text order, and the text each belongs to.

    Runs of other characters than letters are one space; every text has a space on both ends.
    """
    texts = [f" {t or ''} " for t in texts]
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts])
    of, cps = np.repeat(np.arange(len(texts)), size), _letters()[cps]
    first = np.zeros(len(cps), bool)
    first[np.cumsum(size) - size] = True
    gap = cps == 32
    keep = ~gap | first | ~np.r_[False, gap[:-1]]
    cps, of, gap = cps[keep], of[keep], gap[keep]
    for n in ORDERS:
        x = _buckets(cps, n, bits)
        whole = of[:len(x)] == of[n - 1:]
        if n == 1:
            whole &= ~gap
        yield x[whole], of[:len(x)][whole]


def _buckets(cps: np.ndarray, n: int, bits: int) -> np.ndarray:
    m = max(0, len(cps) - n + 1)
    x = np.full(m, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        x = (x ^ cps[k:k + m]) * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
    return (x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)


def piecewise(text: str, bits: int, piece: int = _PIECE):
    """The n-grams of one text, piece by piece: ``(n, buckets)``. The last code points and whether they end in a space go on to
    the next piece, so all pieces together give what ``ngrams`` gives."""
    carried, gap_before = np.zeros(0, np.uint32), False
    whole = f" {text} "
    for at in range(0, len(whole), piece):
        cps = _letters()[np.frombuffer(whole[at:at + piece].encode("utf-32-le", "surrogatepass"), np.uint32)]
        gap = cps == 32
        cps = cps[~gap | ~np.r_[gap_before, gap[:-1]]]
        gap_before = bool(gap[-1])
        joined = np.r_[carried, cps]
        for n in ORDERS:
            part = joined[max(0, len(carried) - n + 1):]
            yield n, _buckets(part[part != 32] if n == 1 else part, n, bits)
        carried = joined[1 - max(ORDERS):]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        sample: int = SAMPLE, bits: int = BUCKET_BITS) -> Model:
    """Fit on about ``sample`` documents per language, those with the smallest hash of ``key_col``.

    Rows without a language or without text teach nothing. No labelled rows: a model without languages, by
    which every document is ``und``.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(key_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the broadcast matrix would have no size bound")
    if not sizes:
        return Model([], np.zeros(0), np.zeros((1 << bits, 0), np.float32))
    cut = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(min(1, sample / r["count"]) * 10**9))])
    picked = rows.where(F.pmod(F.xxhash64("key", F.lit("langid")), F.lit(10**9)) < cut[F.col("lang")])
    counts = picked.repartition(16, "key").mapInArrow(
        lambda batches: _count(batches, bits), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    languages = sorted(r["lang"] for r in sizes)
    table = np.full((1 << bits, len(languages)), SMOOTHING)
    at = np.searchsorted(languages, counts.column("lang").to_pylist())
    table[counts.column("bucket").to_numpy(), at] += counts.column("n").to_numpy()
    docs = np.array([next(r["count"] for r in sizes if r["lang"] == x) for x in languages], float)
    return Model(languages, np.log(docs / docs.sum()), np.log(table / table.sum(axis=0)).astype(np.float32))


def _count(batches, bits):
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for lo, hi in row_ranges(batch.column(2)):
            names, code = np.unique(langs[lo:hi], return_inverse=True)
            total = np.zeros(len(names) << bits, np.int64)
            for bucket, of in ngrams(batch.column(2)[lo:hi].to_pylist(), bits):
                total += np.bincount((code[of] << bits) + bucket, minlength=len(total))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(names[used >> bits], pa.string()),
                                              pa.array((used & (1 << bits) - 1).astype(np.int32)),
                                              pa.array(total[used])], ["lang", "bucket", "n"])


def score(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text; ``und`` and 0 where there is no letter."""
    bits = len(model.log_prob).bit_length() - 1
    total, letters = np.tile(model.log_prior, (len(texts), 1)), np.zeros(len(texts), np.int64)
    for order, (bucket, of) in zip(ORDERS, ngrams(texts, bits)):
        if order == 1:
            letters = np.bincount(of, minlength=len(texts))
        if len(of) and model.languages:
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            total[of[starts]] += np.add.reduceat(model.log_prob[bucket], starts, axis=0, dtype=np.float64)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    return _decide(total, letters, model)


def _decide(total, letters, model):
    best = total.argmax(axis=1)         # the first of equals, in code point order of the names
    share = 1 / np.exp(total - total.max(axis=1)[:, None]).sum(axis=1)
    return ([model.languages[b] if n else UNKNOWN for b, n in zip(best, letters)], np.where(letters > 0, share, 0.0))


def _score_long(text: str, model: Model) -> tuple[str, float]:
    """A text of more than ``_PIECE`` characters: the same n-grams, with memory for one piece at a time."""
    total, letters = model.log_prior.copy(), 0
    for n, bucket in piecewise(text, len(model.log_prob).bit_length() - 1):
        letters += len(bucket) if n == 1 else 0
        total = total + model.log_prob[bucket].sum(axis=0, dtype=np.float64)
    if not model.languages:
        return UNKNOWN, 0.0
    names, share = _decide(total[None, :], np.array([letters]), model)
    return names[0], float(share[0])


def predict(docs: DataFrame, model: Model, text_col: str = "text", within: str | None = None) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``: one narrow pass, rows and their order unchanged.

    Null, empty and letterless texts are ``und`` with score 0. ``within``: a struct column that holds the texts. A column of ``docs`` that has one of the two
    names is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    at = [c.lower() for c in docs.schema[within].dataType.names].index(text_col) if within else None

    def rows(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(within or text_col))
            texts = texts.field(at) if within else texts
            for lo, hi in row_ranges(texts, 1 << 18):
                part = texts[lo:hi].to_pylist()
                if len(part) == 1 and part[0] and len(part[0]) > _PIECE:
                    name, share = _score_long(part[0], held.value)
                    names, shares = [name], np.array([share])
                else:
                    names, shares = score(part, held.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(names, pa.string()), pa.array(shares)],
                    [*batch.schema.names, "lang_pred", "score"])

    added = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(rows, added)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept away from training: crc32 of the id as text, modulo 4, is 2; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows whose language is told with at least ``min_score``; letterless and null texts go."""
    found = predict(docs.select(F.struct("*").alias("_row")), fit(docs), "text", within="_row")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("_row.*")
