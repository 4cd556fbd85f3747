"""Benchmark decontamination by winnowing.

Of every ``SPAN - GRAM + 1`` consecutive word k-grams the one with the smallest hash is a fingerprint, for documents
and benchmark items alike, so any ``SPAN`` words that both contain share a fingerprint at the same place. Joined
fingerprints are extended to both sides word by word. Items shorter than a span are one window of their own
length: their fingerprint is that window's hash, and documents are winnowed once more at each such length with a
window of one gram, which is exact too.

A Bloom filter of the benchmark's fingerprints (a bit set of fixed size) keeps documents' fingerprints
that cannot match from being shuffled; what passes is joined with the items by Spark, which broadcasts the items only
if they measure small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import row_key, row_ranges

SPAN = 10               # words of a window
GRAM = 7                # words of a fingerprint's k-gram; the selection window is SPAN - GRAM + 1 grams
BLOOM_BITS = 1 << 23    # 1 MB whatever the benchmark's size; more items only let more fingerprints through
SALTS = 8               # copies of an item's fingerprint, so that one common passage is not one task's work

# bytes of words once A-Z is lower case: digits, a-z and all of a non-ASCII character
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Words:
    """Words of some texts laid end to end: byte bounds, a hash of each, and the text each belongs to."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""]).lower()
        data = np.frombuffer(self.raw, np.uint8)
        inside = np.r_[False, _WORD[data], False]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = turns[::2], turns[1::2]
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.of = np.searchsorted(np.cumsum(size), self.start, "right")
        self.hash = self._hashes(data)
        self.count = np.bincount(self.of, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Eight bytes of every word at a time, long words in as many rounds as they need."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        padded = np.r_[data, np.zeros(8, np.uint8)]
        eight = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
        size = self.end - self.start
        out, at, todo = size.astype(np.uint64) * _FACTOR, self.start.copy(), np.arange(len(size))
        while len(todo):
            chunk = np.ascontiguousarray(eight[at]).view("<u8").ravel()
            left = self.end[todo] - at
            spare = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
            out[todo] = _mix((out[todo] ^ ((chunk << spare) >> spare)) * _FACTOR)
            more = left > 8
            todo, at = todo[more], at[more] + 8
        return out

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on, 0-length if there are fewer than k in all."""
        m = len(self.hash) - k + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(m, k, np.uint64)
        for i in range(k):
            out = _mix((out ^ self.hash[i:i + m]) * _FACTOR)
        return out

    def whole(self, k: int) -> np.ndarray:
        """Words from which on k words of one text stand."""
        m = max(0, len(self.of) - k + 1)
        return self.of[:m] == self.of[k - 1:]

    def slice(self, lo: int, hi: int) -> bytes:
        """Words lo .. hi-1 with single spaces between them."""
        return b" ".join(self.raw[a:b] for a, b in zip(self.start[lo:hi], self.end[lo:hi]))


def winnow(words: Words, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Words at which a fingerprint starts and its hash: the rightmost smallest gram of every window of grams."""
    hashes = words.grams(gram)
    if len(words.hash) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    window = span - gram + 1
    best, at = hashes[: len(hashes) - window + 1], np.arange(len(hashes) - window + 1)
    for i in range(1, window):
        nxt = hashes[i:len(hashes) - window + 1 + i]
        lower = nxt <= best
        best, at = np.where(lower, nxt, best), np.where(lower, np.arange(i, i + len(nxt)), at)
    at = at[words.whole(span)]
    at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
    return at, hashes[at]


def _context(words: Words, at: np.ndarray, gram: int, span: int):
    """For each fingerprint: words before it in the slice, and the slice with all windows that contain it."""
    first = words.first[words.of[at]]
    last = first + words.count[words.of[at]]
    lo, hi = np.maximum(first, at - (span - gram)), np.minimum(last, at + span)
    return at - first, at - lo, [words.slice(a, b) for a, b in zip(lo, hi)]


_FP = pa.struct([("h", pa.int64()), ("need", pa.int32()), ("pos", pa.int32()), ("before", pa.int32()),
                 ("words", pa.binary())])
_FP_SQL = "struct<h: bigint, need: int, pos: int, before: int, words: binary>"


def _fingerprints(words: Words, lengths: list[int], span: int, gram: int, passes) -> tuple[list, np.ndarray]:
    """Fingerprints that ``passes`` lets through, as rows, and the text of each.

    ``need`` is the length of a hit: ``span``, or that of a short item, at which every window is taken.
    """
    rows, of = [], []
    sorts = [(*winnow(words, span, gram), gram, span)]
    for n in lengths:
        at = np.flatnonzero(words.whole(n))
        sorts.append((at, words.grams(n)[at], n, n))
    for at, h, k, need in sorts:
        ok = passes(h)
        at, h = at[ok], h[ok]
        if len(at):
            pos, before, text = _context(words, at, k, need)
            rows += [dict(h=a, need=need, pos=b, before=c, words=d)
                     for a, b, c, d in zip(h.view(np.int64).tolist(), pos.tolist(), before.tolist(), text)]
            of.append(words.of[at])
    return rows, np.concatenate(of) if of else np.zeros(0, np.int64)


def _grouped(rows: list, of: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(of, kind="stable")
    offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=n))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([rows[i] for i in order], _FP))


def _encoded(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts.to_pylist()]


def item_fingerprints(items: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = SPAN,
                      gram: int = GRAM) -> DataFrame:
    """``(item, h, need, pos, before, words)``: fingerprints of the benchmark, one for a short item."""
    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(1)):
                words = Words(_encoded(batch.column(1)[lo:hi]))
                found, of = _fingerprints(words, [], span, gram, lambda h: np.ones(len(h), bool))
                for k in np.flatnonzero((words.count > 0) & (words.count < span)):
                    n, first = int(words.count[k]), words.first[k]
                    h = int(words.grams(n)[first:first + 1].view(np.int64)[0])
                    found.append(dict(h=h, need=n, pos=0, before=0, words=words.slice(first, first + n)))
                    of = np.r_[of, k]
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], _grouped(found, of, hi - lo)],
                                                 ["item", "fps"])

    made = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return made.mapInArrow(rows, f"item string, fps array<{_FP_SQL}>").select("item", F.inline("fps"))


class Bloom:
    """Bit set of a fixed size; never misses a hash that was added."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    @staticmethod
    def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
        return [((h.view(np.uint64) >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (0, 20, 41)]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for at in self.places(h, 8 * len(self.packed)):
            ok &= (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return ok


def bloom(hashes: DataFrame, bits: int = BLOOM_BITS) -> Bloom:
    """Filter of the first column of ``hashes``: set bits are merged in tasks, at most ``bits`` / 8 bytes and
    their part numbers reach the driver."""
    part = min(bits // 8, 4096)

    def local(batches):
        held = np.zeros(bits, bool)
        for batch in batches:
            for at in Bloom.places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                held[at] = True
        packed = np.packbits(held).reshape(-1, part)
        used = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([packed[i].tobytes() for i in used], pa.binary())], ["part", "bits"])

    def merged(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(packed, np.uint8)
                held[k] = held[k] | new if k in held else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
            ["part", "bits"])

    schema = "part bigint, bits binary"
    packed = np.zeros((bits // 8 // part, part), np.uint8)
    for r in hashes.mapInArrow(local, schema).repartition("part").mapInArrow(merged, schema).collect():
        packed[r["part"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return Bloom(packed.ravel())


def document_fingerprints(docs: DataFrame, passes: Bloom, lengths: list[int], id_col: str, text_col: str,
                          span: int, gram: int) -> DataFrame:
    """``(key, doc_id, n_words, fps)`` per row of ``docs``; one narrow pass."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(passes)

    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(2)):
                words = Words(_encoded(batch.column(2)[lo:hi]))
                found, of = _fingerprints(words, lengths, span, gram, held.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(words.count),
                     _grouped(found, of, hi - lo)], ["key", "doc_id", "n_words", "fps"])

    return docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows, f"key bigint, doc_id {kind}, n_words bigint, fps array<{_FP_SQL}>")


def _extended(gram: int, span: int):
    """Joined fingerprints -> ``first, last`` words of the document that the item shares, null if too few."""
    def rows(batches):
        for batch in batches:
            first, last = [], []
            for need, pos, before, mine, ahead, his in zip(*(batch.column(i).to_pylist() for i in range(4, 10))):
                lo = hi = None
                if his is not None:
                    a, b, k = mine.split(b" "), his.split(b" "), gram if need == span else need
                    left, right = 0, k
                    while left < min(before, ahead) and a[before - left - 1] == b[ahead - left - 1]:
                        left += 1
                    while (right < min(len(a) - before, len(b) - ahead)) and a[before + right] == b[ahead + right]:
                        right += 1
                    if left + right >= need and a[before:before + k] == b[ahead:ahead + k]:
                        lo, hi = pos - left, pos + right
                first.append(lo)
                last.append(hi)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                ["key", "doc_id", "n_words", "item", "first", "last"])
    return rows


def _contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``contamination`` with one row for all rows that are equal in id and text."""
    fps = staged(item_fingerprints(items, item_id, item_text, span, gram), "winnow-items")
    lengths = sorted(r["need"] for r in fps.where(F.col("need") < span).select("need").distinct().collect())
    made = document_fingerprints(docs, bloom(fps.select("h")), lengths, id_col, text_col, span, gram)
    mine = made.select("key", "doc_id", "n_words", F.explode_outer("fps").alias("fp")).select(
        "key", "doc_id", "n_words", F.coalesce("fp.h", "key").alias("h"), F.coalesce("fp.need", F.lit(0)).alias("need"),
        "fp.pos", "fp.before", "fp.words", F.pmod("key", F.lit(SALTS)).cast("int").alias("salt"))
    theirs = fps.select("item", "h", "need", F.col("before").alias("ahead"), F.col("words").alias("his"),
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    kind = made.schema["doc_id"].dataType.simpleString()
    met = mine.join(theirs, ["h", "need", "salt"], "left").select(
        "key", "doc_id", "n_words", "item", "need", "pos", "before", "words", "ahead", "his").mapInArrow(
        _extended(gram, span), f"key bigint, doc_id {kind}, n_words bigint, item string, first int, last int")
    hit = F.col("first").isNotNull()
    per = met.groupBy("key", "doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(F.when(hit, F.col("item")))).alias("items"),
        F.array_sort(F.collect_set(F.when(hit, F.struct("first", "last")))).alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["upto"], x["last"]).alias("upto"),
                                (acc["n"] + F.greatest(x["last"] - F.greatest(x["first"], acc["upto"]),
                                                       F.lit(0))).alias("n")), lambda acc: acc["n"])
    return per.select("key", "doc_id", "n_words", covered.alias("n_hit"), "items", "spans")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``(key, doc_id, n_words, n_hit, items, spans)`` per row of ``docs``: words inside windows of items, the items, merged hits.

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Rows equal in id and text are worked
    on once (``key`` is ``row_key`` of the two) and come back as often as they stand; a repeated or null id with another text
    is a document of its own. Null, empty and wordless texts have no hits. Items without words match nothing; rows of one
    item id count as one item; an item with a null id marks words but is not listed. Either table may be empty. A worker holds a
    very long text and about ten times its size in numbers.
    """
    times = staged(docs.groupBy(row_key(id_col, text_col).alias("key")).agg(F.count("*").alias("_n")).where("_n > 1"), "winnow-repeated")
    return _contamination(docs, items, id_col, text_col, **kw).join(times, "key", "left").withColumn(
        "_n", F.explode(F.sequence(F.lit(1), F.coalesce(F.col("_n"), F.lit(1)).cast("int")))).drop("_n")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs(doc_id, text, ..)`` that share no window with an item."""
    dirty = staged(_contamination(docs, items).where("n_hit > 0").select(F.col("key").alias("_key")).distinct(),
                   "winnow-dirty")
    return docs.select(F.struct("*").alias("_row"), row_key("doc_id", "text").alias("_key")).join(
        dirty, "_key", "left_anti").select("_row.*")
