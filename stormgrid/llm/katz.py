"""Katz backoff over word bigrams, learned from one part of a corpus and evaluated on all of it.

A word after a context has its Good-Turing discounted share of the context's count if the pair was learned, otherwise the
context's backoff weight times its unigram share, and a word never learned has the mass that the discounted unigrams leave.
Backoff weights are normalised exactly: for every context the shares of all words and of the unknown word sum to one.

The corpus goes through Spark as chunks of some megabytes of text, each with its own dictionary:

1. ``_chunks``: texts become numbers of the chunk's dictionary, stored once;
2. ``_vocabulary``: dictionaries meet by buckets of words, where every word gets its number and training count;
3. ``_pairs``: the answers go back to their chunks, and the word pairs on to buckets of contexts;
4. ``_contexts``: a bucket counts its pairs and values its tokens as far as the context alone tells: sums of log counts, how many
   pairs of each small count a document holds, and the contexts whose weight its unlearned pairs need;
5. ``scored``: count-of-counts are added up, discounts and weights follow, documents are summed chunk by chunk.

A word with more than 1 / ``_HOT`` of the training tokens is hot (so there are at most ``_HOT``, whatever the size): pairs after a hot
context go to the bucket of their second word and its weight is merged from all buckets; pairs of two hot words
(``_HOT`` squared kinds at most) are counted as rows of a plain aggregate. So no bucket rests on one common word or pair.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

SMALL = 5               # counts up to here are discounted
_CHUNK = 1 << 23        # bytes of text of a chunk
_BUCKET = 1 << 21       # tokens of a bucket
_HOT = 256              # a hot word has more than this fraction of the training tokens
_UNKNOWN, _START = -1, -2


# numbers on the way ------------------------------------------------------------------------------------------------

def pack(a: np.ndarray) -> bytes:
    """Compressed bytes of an array, equal byte places together."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(raw.T).tobytes()) if len(a) else b""


def unpack(b: bytes, kind=np.int64) -> np.ndarray:
    if not b:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return raw.reshape(size, -1).T.copy(order="C").view(kind).ravel()


class _Numbers(dict):
    """Numbers from 0 on for keys in the order in which they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def of(self, keys) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int32, len(keys))


def _grouped(batches, key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one key after the other; rows come in the order of the key."""
    held, at = [], None
    for batch in batches:
        for lo in range(batch.num_rows):
            row = batch.slice(lo, 1).to_pylist()[0]
            if held and row[key] != at:
                yield at, held
                held = []
            at = row[key]
            held.append(row)
    if held:
        yield at, held


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


# discounts ---------------------------------------------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """Katz's share that counts 1 .. ``SMALL`` keep, from the numbers ``n`` of kinds seen once, twice, .. ``SMALL`` + 1 times.

    Good-Turing on the numbers themselves; where these give no share between 0 and 1 (copies may leave more kinds
    seen four times than three times), on their log-linear fit; where that falls too slowly too, half a count goes.
    """
    r = np.arange(1, SMALL + 1)

    def turing(n):
        beyond = (SMALL + 1) * n[SMALL] / n[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            return ((r + 1) * n[1:] / (r * n[:-1]) - beyond) / (1 - beyond)

    def sound(d):
        return bool(np.isfinite(d).all() and (d > 0).all() and (d < 1).all())

    n = np.asarray(n, float)
    if (n > 0).all() and sound(d := turing(n)):
        return d
    some = np.flatnonzero(n)
    if len(some) > 1:
        slope, level = np.polyfit(np.log(some + 1), np.log(n[some]), 1)
        if sound(d := turing(np.exp(level + slope * np.log(np.arange(1, SMALL + 2))))):
            return d
    return 1 - 0.5 / r


class Unigrams:
    """Shares of single words by their count."""

    def __init__(self, total: int, kinds: int, small: list[int]):
        self.total, self.kinds = total, kinds
        self.keep = discounts(small)
        freed = float(sum(n * r * (1 - d) for r, n, d in zip(range(1, SMALL + 1), small, self.keep)))
        spare = 0 if freed else 1                   # no small counts: one count more in all is what is left
        self.bottom = total + spare
        self.unknown = (freed + spare) / self.bottom

    def share(self, c: np.ndarray) -> np.ndarray:
        scaled = c * np.concatenate([[0.0], self.keep, [1.0]])[np.minimum(c, SMALL + 1)]
        return np.where(c > 0, scaled / self.bottom, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.kinds + 1)))


def weights(count: np.ndarray, small: np.ndarray, covered: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and backoff weight of contexts with ``small[:, r - 1]`` followers of count r, whose followers' unigram shares
    add up to ``covered``. Without a small count nothing would be left for others: the denominator is one more."""
    bottom = count + (small.sum(1) == 0)
    left = bottom - count + (small * np.arange(1, SMALL + 1) * (1 - keep)).sum(1)
    return bottom, left / bottom / (1 - covered)


# 1: chunks ---------------------------------------------------------------------------------------------------------

def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows ``(_id, _text, _learn)`` as chunks; numbered by partition and place, which a stored table keeps for good."""
    kind = docs.schema["_id"].dataType.simpleString()

    def rows(batches):
        part, number = TaskContext.get().partitionId(), 0
        held = ([], [], [], _Numbers())
        size = 0
        for batch in batches:
            for lo in range(batch.num_rows):
                text = batch.column(1)[lo].as_py() or b""
                words = text.lower().split()
                words.append(b"")                   # the end
                held[0].append(batch.column(0)[lo])
                held[1].append(batch.column(2)[lo].as_py())
                held[2].append(held[3].of(words))
                size += len(text) + 1
                if size >= chunk_bytes:
                    yield chunk(part << 33 | number, batch.schema.field(0).type, *held)
                    held, size, number = ([], [], [], _Numbers()), 0, number + 1
            if held[0]:
                id_type = batch.schema.field(0).type
        if held[0]:
            yield chunk(part << 33 | number, id_type, *held)

    def chunk(number, id_type, ids, learn, texts, dictionary):
        sizes = np.array([len(t) for t in texts], np.int32)
        tokens, taken = np.concatenate(texts), np.array(learn, bool)
        counts = np.bincount(tokens[np.repeat(taken, sizes)], minlength=len(dictionary))
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([[x.as_py() for x in ids]], pa.list_(id_type)), pa.array([learn], pa.list_(pa.bool_())),
            pa.array([pack(sizes)], pa.binary()), pa.array([pack(tokens)], pa.binary()),
            pa.array([zstandard.ZstdCompressor(level=3).compress(b"\n".join(dictionary))], pa.binary()),
            pa.array([pack(counts)], pa.binary()), pa.array([len(tokens)]), pa.array([int(taken.sum())])],
            ["chunk", "ids", "learn", "sizes", "tokens", "words", "counts", "n_tokens", "n_learn"])

    return docs.mapInArrow(rows, f"chunk bigint, ids array<{kind}>, learn array<boolean>, sizes binary, tokens binary, "
                                 "words binary, counts binary, n_tokens bigint, n_learn bigint")


# 2: vocabulary -----------------------------------------------------------------------------------------------------

_ANSWER = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("pos", pa.binary()), ("number", pa.binary()),
                     ("count", pa.binary()), ("hist_c", pa.list_(pa.int64())), ("hist_n", pa.list_(pa.int64()))])


def _vocabulary(chunks: DataFrame, buckets: int) -> DataFrame:
    """Numbers (by falling count inside a bucket) and training counts of every chunk's words; per bucket a histogram of counts."""

    def asked(batches):
        for batch in batches:
            for lo in range(batch.num_rows):
                row = batch.slice(lo, 1).to_pylist()[0]
                words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b"\n")
                counts = unpack(row["counts"])
                of = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % buckets
                order = np.argsort(of, kind="stable").astype(np.int32)
                bounds = np.searchsorted(of[order], np.arange(buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(bounds)).tolist():
                    at = order[bounds[b]:bounds[b + 1]]
                    out.append({"bucket": b, "chunk": row["chunk"], "pos": pack(np.diff(at, prepend=np.int32(0))),
                                "words": zstandard.ZstdCompressor(level=3).compress(b"\n".join([words[i] for i in at])),
                                "counts": pack(counts[at])})
                yield _batch(out, schema)

    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("pos", pa.binary()), ("words", pa.binary()),
                        ("counts", pa.binary())])

    def answered(batches):
        for b, rows in _grouped(batches, "bucket"):
            seen = _Numbers()
            at = [seen.of(zstandard.ZstdDecompressor().decompress(r["words"]).split(b"\n")) for r in rows]
            total = np.zeros(len(seen), np.int64)
            for a, r in zip(at, rows):
                total[a] += unpack(r["counts"])         # the words of one chunk are distinct
            number = np.empty(len(seen), np.int32)
            number[np.argsort(-total, kind="stable")] = np.arange(len(seen), dtype=np.int32)
            hist = np.unique(total[total > 0], return_counts=True)
            for i, (a, r) in enumerate(zip(at, rows)):
                yield _batch([{"chunk": r["chunk"], "bucket": b, "pos": r["pos"], "number": pack(number[a]),
                               "count": pack(total[a]), "hist_c": None if i else hist[0].tolist(),
                               "hist_n": None if i else hist[1].tolist()}], _ANSWER)

    requests = chunks.select("chunk", "words", "counts").mapInArrow(
        asked, "bucket int, chunk bigint, pos binary, words binary, counts binary")
    return requests.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        answered, "chunk bigint, bucket int, pos binary, number binary, count binary, hist_c array<bigint>, hist_n array<bigint>")


def _unigrams(answers: DataFrame) -> Unigrams:
    """From the histogram: what comes to the driver are totals and the first few counts."""
    hist = answers.where("hist_c is not null").select(F.explode(F.arrays_zip("hist_c", "hist_n")).alias("h")).select("h.*")
    got = hist.agg(F.sum(F.col("hist_c") * F.col("hist_n")).alias("total"), F.sum("hist_n").alias("kinds"), *[
        F.sum(F.when(F.col("hist_c") == r, F.col("hist_n"))).alias(f"n{r}") for r in range(1, SMALL + 2)]).first()
    return Unigrams(got.total or 0, got.kinds or 0, [got[f"n{r}"] or 0 for r in range(1, SMALL + 2)])


# 3: pairs ----------------------------------------------------------------------------------------------------------

_PAIRS = ("bucket int, chunk bigint, ids array<{kind}>, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, "
          "base array<double>, direct array<double>, hot_u array<bigint>, hot_w array<bigint>, hot_cu array<bigint>, "
          "hot_cw array<bigint>, hot_c array<bigint>, hot_doc binary, hot_pair binary, u binary, cu binary, nu binary, "
          "w binary, cw binary, nw binary, doc binary")


def _spread(ids: np.ndarray, buckets: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(buckets)).astype(np.int64)


def _heads(a: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)


def _pairs(chunks: DataFrame, answers: DataFrame, buckets: int, uni: Unigrams, n_learn: int, hot: float, kind: str) -> DataFrame:
    """Per chunk one row on its documents (with its hot pairs) and one row of pairs for each bucket of contexts."""
    names = [f.split()[0] for f in _PAIRS.split(", ")]

    def rows(batches):
        for chunk, got in _grouped(batches, "chunk"):
            head, tokens = got[0], unpack(got[0]["tokens"], np.int32)
            sizes = unpack(head["sizes"], np.int32).astype(np.int64)
            kinds = int(tokens.max()) + 1
            number, count = np.full(kinds, _UNKNOWN, np.int64), np.zeros(kinds, np.int64)
            for r in got[1:]:
                at, c = np.cumsum(unpack(r["pos"], np.int32)), unpack(r["count"])
                number[at] = np.where(c > 0, (r["bucket"] << 32) + unpack(r["number"], np.int32).astype(np.int64), _UNKNOWN)
                count[at] = c
            del got
            n, first = len(sizes), np.cumsum(sizes) - sizes
            doc = np.repeat(np.arange(n), sizes)
            before = np.r_[0, tokens[:-1]].astype(np.int64)
            before[first] = kinds                       # a number of its own for the start of a text
            number, count = np.r_[number, _START], np.r_[count, n_learn]
            cu, cw = count[before], count[tokens]
            share = np.log10(uni.share(cw))
            alone = cu == 0                             # nothing learned after this context
            row = dict.fromkeys(names) | {
                "bucket": buckets + chunk % buckets, "chunk": chunk, "ids": head["ids"],
                "held_out": [not x for x in head["learn"]], "n_tokens": sizes.tolist(),
                "n_known": np.bincount(doc, cw > 0, n).astype(np.int64).tolist(),
                "base": np.bincount(doc, uni.base(cw), n).tolist(),
                "direct": np.bincount(doc[alone], share[alone], n).tolist()}
            learn = np.array(head["learn"], bool)
            both = (cu > hot) & (cw > hot)
            key, of = np.unique(before[both] * (kinds + 1) + tokens[both], return_inverse=True)
            u, w = key // (kinds + 1), key % (kinds + 1)
            row |= {"hot_u": number[u].tolist(), "hot_w": number[w].tolist(), "hot_cu": count[u].tolist(),
                    "hot_cw": count[w].tolist(),
                    "hot_c": np.bincount(of, learn[doc[both]], len(key)).astype(np.int64).tolist(),
                    "hot_doc": pack(doc[both].astype(np.int32)), "hot_pair": pack(of.astype(np.int32))}
            yield _batch([row], schema)
            rest = np.flatnonzero(~both & ~alone)
            # pairs after a hot context go by their second word; one never learned may be counted anywhere
            second = np.where(cw > 0, number[tokens], -3 - tokens)
            to = _spread(np.where(cu > hot, second, number[before])[rest], buckets)
            order = np.argsort((to * (kinds + 1) + before[rest]) * (kinds + 1) + tokens[rest], kind="stable")
            rest, to = rest[order], to[order]
            bounds = np.searchsorted(to, np.arange(buckets + 1))
            u, w = before[rest], tokens[rest].astype(np.int64)
            mark = (doc[rest] * 2 + learn[doc[rest]]).astype(np.int32)
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                part = slice(bounds[b], bounds[b + 1])
                pair = _heads(u[part] * (kinds + 1) + w[part])
                us = u[part][pair]
                ctx = _heads(us)
                ws = w[part][pair]
                yield _batch([dict.fromkeys(names) | {
                    "bucket": b, "chunk": chunk, "u": pack(number[us[ctx]]), "cu": pack(count[us[ctx]]),
                    "nu": pack(np.diff(np.r_[ctx, len(us)]).astype(np.int32)), "w": pack(number[ws]), "cw": pack(count[ws]),
                    "nw": pack(np.diff(np.r_[pair, len(u[part])]).astype(np.int32)), "doc": pack(mark[part])}], schema)

    head = chunks.select("chunk", F.lit(-1).alias("bucket"), "ids", "learn", "sizes", "tokens")
    both = head.unionByName(answers.drop("hist_c", "hist_n"), allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "bucket")
    text = _PAIRS.format(kind=kind)
    schema = _arrow(dealt.sparkSession, text)
    return dealt.mapInArrow(rows, text)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


# 4: contexts -------------------------------------------------------------------------------------------------------

_PARTS = _PAIRS.split(", u binary")[0] + (", n_r array<bigint>, part_u array<bigint>, part_small array<array<bigint>>, "
                                          "part_share array<double>, docs binary, value binary, small binary, late_doc binary, "
                                          "late_ctx binary, ctx_u binary, ctx_count binary, ctx_small binary, ctx_share binary")


def _contexts(pairs: DataFrame, buckets: int, uni: Unigrams, hot: float, kind: str) -> DataFrame:
    """Counts the pairs of a bucket. Rows on documents pass; every chunk's pairs come back as sums per document, with the
    contexts that are still to be weighed; one row per bucket has its count-of-counts and its part of the hot contexts."""
    names = [f.split()[0] for f in _PARTS.split(", ")]

    def rows(batches):
        for b, got in _grouped_big(batches, buckets):
            if b >= buckets:
                yield _batch([{k: r.get(k) for k in names} for r in got], schema)
                continue
            # numbers of contexts and of second words inside the bucket, one per pair of a chunk ("run"), as small as they come
            join = lambda f: np.concatenate([f(r) for r in got])                                    # noqa: E731
            name, first, ctx_of = np.unique(join(lambda r: unpack(r["u"])), return_index=True, return_inverse=True)
            total = join(lambda r: unpack(r["cu"]))[first]
            ctx_run = np.repeat(ctx_of.astype(np.int32), join(lambda r: unpack(r["nu"], np.int32)))
            second, first, word_run = np.unique(join(lambda r: unpack(r["w"])), return_index=True, return_inverse=True)
            share = uni.share(join(lambda r: unpack(r["cw"]))[first])
            word_run = word_run.astype(np.int32)
            size = [len(unpack(r["nw"], np.int32)) for r in got]
            learned = join(lambda r: np.add.reduceat(unpack(r["doc"], np.int32) & 1, np.cumsum(
                nw := unpack(r["nw"], np.int32)) - nw))
            key = ctx_run.astype(np.int64) * len(second) + word_run
            order = np.argsort(key)
            key = key[order]
            head = _heads(key)
            c = np.add.reduceat(learned[order], head, dtype=np.int64)
            ctx, word = (key[head] // len(second)).astype(np.int32), (key[head] % len(second)).astype(np.int32)
            of = np.empty(len(order), np.int32)
            of[order] = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.r_[head, len(order)]))
            del key, order, learned, head, ctx_of, second, first
            small = np.stack([np.bincount(ctx[c == r], minlength=len(name)) for r in range(1, SMALL + 1)], 1)
            covered = np.bincount(ctx[c > 0], share[word[c > 0]], len(name))
            is_hot = total > hot
            bottom = total + (small.sum(1) == 0)
            # the value of a pair: learned, or the second word's own share
            value = np.where(c > 0, np.log10(np.maximum(c, 1)) - np.where(is_hot, 0, np.log10(bottom))[ctx], np.log10(share)[word])
            late = (c == 0) | is_hot[ctx]
            yield _batch([dict.fromkeys(names) | {
                "n_r": [int((c == r).sum()) for r in range(1, SMALL + 2)], "part_u": name[is_hot].tolist(),
                "part_small": small[is_hot].tolist(), "part_share": covered[is_hot].tolist()}], schema)
            begin = 0
            for r, m in zip(got, size):
                part = slice(begin, begin + m)
                begin += m
                nw = unpack(r["nw"], np.int32)
                doc, place = np.unique(unpack(r["doc"], np.int32) >> 1, return_inverse=True)
                pair = np.repeat(of[part], nw)
                counts = c[pair]
                few = (counts > 0) & (counts <= SMALL)
                per = np.bincount(place[few] * SMALL + counts[few] - 1, minlength=len(doc) * SMALL)
                wait = late[pair]
                need, which = np.unique(ctx[pair[wait]], return_inverse=True)
                yield _batch([dict.fromkeys(names) | {
                    "chunk": r["chunk"], "docs": pack(doc.astype(np.int32)),
                    "value": pack(np.bincount(place, value[pair], len(doc))),
                    "small": pack(per.astype(np.int32)), "late_doc": pack(place[wait].astype(np.int32)),
                    "late_ctx": pack((which * 2 + (counts[wait] > 0)).astype(np.int32)), "ctx_u": pack(name[need]),
                    "ctx_count": pack(total[need]), "ctx_small": pack(small[need].ravel()),
                    "ctx_share": pack(covered[need])}], schema)

    text = _PARTS.format(kind=kind)
    schema = _arrow(pairs.sparkSession, text)
    return pairs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(rows, text)


def _grouped_big(batches, buckets: int):
    """Rows of a bucket together; rows on documents one by one, they need no company."""
    held, at = [], None
    for batch in batches:
        for lo in range(batch.num_rows):
            row = batch.slice(lo, 1).to_pylist()[0]
            if held and row["bucket"] != at:
                yield at, held
                held = []
            at = row["bucket"]
            if at >= buckets:
                yield at, [row]
            else:
                held.append(row)
    if held:
        yield at, held


# 5: scores ---------------------------------------------------------------------------------------------------------

class Bigrams:
    """Discounts of pairs and the weights of hot contexts, merged on the driver: ``_HOT`` + 1 contexts, their square of pairs."""

    def __init__(self, parts: DataFrame, uni: Unigrams):
        found = parts.where("n_r is not null").select(F.posexplode("n_r").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n"))
        n_r = np.zeros(SMALL + 1, np.int64)
        for r in found.collect():
            n_r[r.r] = r.n
        zipped = F.arrays_zip("hot_u", "hot_w", "hot_cu", "hot_cw", "hot_c")
        self.pairs = {(r.hot_u, r.hot_w): (r.c, r.cu, r.cw) for r in parts.where("size(hot_u) > 0").select(
            F.explode(zipped).alias("h")).select("h.*").groupBy("hot_u", "hot_w").agg(
            F.sum("hot_c").alias("c"), F.max("hot_cu").alias("cu"), F.max("hot_cw").alias("cw")).collect()}
        small: dict[int, np.ndarray] = {}
        covered: dict[int, float] = {}
        total: dict[int, int] = {}
        split = F.arrays_zip("part_u", "part_small", "part_share")
        for r in parts.where("size(part_u) > 0").select(F.explode(split).alias("p")).groupBy("p.part_u").agg(
                *[F.sum(F.element_at("p.part_small", i + 1)).alias(f"s{i}") for i in range(SMALL)],
                F.sum("p.part_share").alias("share")).collect():
            small[r.part_u] = np.array([r[f"s{i}"] for i in range(SMALL)])
            covered[r.part_u] = r.share
        for (u, _), (c, cu, cw) in self.pairs.items():
            total[u] = cu
            mine = small.setdefault(u, np.zeros(SMALL, np.int64))
            covered.setdefault(u, 0.0)
            if c:
                covered[u] += float(uni.share(np.array([cw]))[0])
                if c <= SMALL:
                    mine[c - 1] += 1
                if c <= SMALL + 1:
                    n_r[c - 1] += 1
        self.small, self.covered, self.total, self.uni = small, covered, total, uni
        self.keep = discounts(n_r.tolist())

    def hot(self, u: int, count: int) -> tuple[float, float]:
        """Denominator and weight of a hot context."""
        bottom, weight = weights(np.array([count]), self.small[u][None], np.array([self.covered[u]]), self.keep)
        return float(bottom[0]), float(weight[0])

    def value(self, u: int, w: int) -> float:
        """log10 of the share of a hot pair."""
        c, cu, cw = self.pairs[u, w]
        bottom, weight = self.hot(u, cu)
        if c:
            return math.log10(c * (self.keep[c - 1] if c <= SMALL else 1.0) / bottom)
        return math.log10(weight * float(self.uni.share(np.array([cw]))[0]))


def scored(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
           chunk_bytes: int = _CHUNK, bucket_tokens: int = _BUCKET, hot_words: int = _HOT) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    Rows where ``learn`` is true are learned from; the others, also those where it is null, are held out. Tokens are the words
    between ASCII blanks with A-Z in lower case, and one end per text; a null, empty or blank text is an end alone. ``base_score``
    adds 0.1 to every training count. With nothing to learn from every token has probability 1 in both. Repeated rows count and
    stay, null ids too; an empty table gives an empty one; other columns are not looked at. A very long text is a chunk of its
    own and needs about 100 bytes a token in a worker, a bucket of contexts about as much for its 4 million tokens.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text"),
                          F.coalesce(learn, F.lit(False)).alias("_learn"))
    chunks = staged(_chunks(rows_in, chunk_bytes), "katz-chunks")
    size = chunks.agg(F.sum("n_tokens").alias("n"), F.sum("n_learn").alias("learn")).first()
    buckets = max(1, math.ceil((size.n or 0) / bucket_tokens))
    answers = staged(_vocabulary(chunks, buckets), "katz-vocabulary")
    uni = _unigrams(answers)
    hot = uni.total / hot_words
    pairs = _pairs(chunks, answers, buckets, uni, size.learn or 0, hot, kind)
    parts = staged(_contexts(pairs, buckets, uni, hot, kind), "katz-contexts")
    model = Bigrams(parts, uni)
    total = uni.total
    # the driver keeps the frames, tasks only the numbers
    hot_value = {pair: model.value(*pair) for pair in model.pairs}
    keep, hot_ctx = model.keep, {u: (model.small[u], model.covered[u]) for u in model.small}

    def rows(batches):
        for _, got in _grouped(batches, "chunk"):
            head = got[0]
            score = np.array(head["direct"])
            if head["hot_u"]:
                value = np.array([hot_value[p] for p in zip(head["hot_u"], head["hot_w"])])
                np.add.at(score, unpack(head["hot_doc"], np.int32), value[unpack(head["hot_pair"], np.int32)])
            for r in got[1:]:
                doc = unpack(r["docs"], np.int32)
                score[doc] += unpack(r["value"], np.float64)
                score[doc] += unpack(r["small"], np.int32).reshape(-1, SMALL) @ np.log10(keep)
                late = unpack(r["late_ctx"], np.int32)
                if len(late):
                    small = unpack(r["ctx_small"]).reshape(-1, SMALL)
                    covered, name = unpack(r["ctx_share"], np.float64), unpack(r["ctx_u"])
                    for i in np.flatnonzero(np.isin(name, list(hot_ctx))).tolist():
                        small[i], covered[i] = hot_ctx[int(name[i])]
                    bottom, weight = weights(unpack(r["ctx_count"]), small, covered, keep)
                    # a learned pair waits for its denominator only where the context is hot
                    np.add.at(score, doc[unpack(r["late_doc"], np.int32)],
                              np.where(late & 1, -np.log10(bottom)[late >> 1], np.log10(weight)[late >> 1]))
            yield pa.RecordBatch.from_arrays([
                pa.array(head["ids"], id_type), pa.array(head["held_out"], pa.bool_()), pa.array(head["n_tokens"], pa.int64()),
                pa.array(head["n_known"], pa.int64()), pa.array([total] * len(score), pa.int64()),
                pa.array(head["base"], pa.float64()), pa.array(score)], columns)

    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    id_type = _arrow(docs.sparkSession, f"x {kind}").field(0).type
    sums = parts.where("chunk is not null").drop("n_r", "part_u", "part_small", "part_share", "hot_cu", "hot_cw", "hot_c")
    dealt = sums.repartition("chunk").sortWithinPartitions("chunk", F.col("ids").isNull())
    return dealt.mapInArrow(rows, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                  "base_score double, score double")
