"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming radius through BK-trees.

Distinct fingerprints are dealt to shards by blocks of bits: two fingerprints that differ in at most
``radius`` bits agree on one of ``radius + 1`` blocks, so every link is found in some shard. A task holds the
BK-trees of its shards (children keyed by their integer distance to the parent) and searches them for many
fingerprints at a time, following only edges within the radius of the distance at hand. The trees travel with
the shuffle, not as a broadcast: all fingerprints together have no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import durable, staged
from .common import row_keys, row_ranges

SHINGLE = 3
RADIUS = 3
_SEED = 42
_CHUNK = 1 << 16        # shingles hashed at a time
_FLUSH = 200_000        # fingerprints whose trees are built at a time
_FRONTIER = 1 << 20     # (query, node) pairs followed at a time


def shingle_hashes(text: str | None, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, in chunks. Fewer words than ``width`` make one shingle, no words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts, ends = (ends - size)[: max(1, len(words) - width + 1)], ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        pairs = zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())
        yield np.array([digest(joined[a:b], _SEED) for a, b in pairs], np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` for every row; a null or wordless text has fingerprint 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in row_ranges(texts):
                ones, total = np.zeros((hi - lo, 64), np.int64), np.zeros(hi - lo, np.int64)
                held, held_of, count = [], [], 0
                for k, text in enumerate(texts[lo:hi].to_pylist()):
                    for h in shingle_hashes(text):
                        held.append(h)
                        held_of.append(k)
                        count += len(h)
                        if count > _CHUNK:
                            _tally(ones, total, held, held_of)
                            held, held_of, count = [], [], 0
                _tally(ones, total, held, held_of)
                packed = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(packed.view(np.int64).ravel())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows, f"doc_id {kind}, fp bigint")


def _tally(ones, total, held, held_of):
    if held:
        sizes = np.array([len(h) for h in held])
        bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add.at(ones, held_of, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64))
        np.add.at(total, held_of, sizes)


# BK-trees ---------------------------------------------------------------------------------------------------

class BKForest:
    """One BK-tree per shard over distinct fingerprints; rows of a shard are adjacent.

    All trees grow together, a level at a time: every row not yet placed stands at some node, and of the rows
    at one distance from that node the first becomes its child, where the others go on.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp.view(np.uint64)
        first = np.r_[True, shard[1:] != shard[:-1]] if len(shard) else np.zeros(0, bool)
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1] if len(shard) else np.zeros(0, np.int64)
        rest = np.flatnonzero(~first)
        here, keys, kids = self.root[rest], [], []
        while len(rest):
            edge = here * 65 + self.distance(rest, here)
            order = np.argsort(edge, kind="stable")
            edge, rest = edge[order], rest[order]
            head = np.r_[True, edge[1:] != edge[:-1]]
            child = rest[head]
            keys.append(edge[head])
            kids.append(child)
            here, rest = child[np.cumsum(head) - 1][~head], rest[~head]
        keys, kids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, kids))
        order = np.argsort(keys)
        self.keys, self.kids = keys[order], kids[order]

    def distance(self, a, b) -> np.ndarray:
        return np.bitwise_count(self.fp[a] ^ self.fp[b]).astype(np.int64)

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs ``(query, node)``, node < query, at most ``radius`` bits apart, in bounded pieces."""
        todo = [(np.arange(len(self.fp)), self.root)]
        while todo:
            query, node = todo.pop()
            if len(query) > _FRONTIER:
                half = len(query) // 2
                todo += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            gap = self.distance(query, node)
            near = (gap <= radius) & (node < query)
            if near.any():
                yield query[near], node[near]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(gap - radius, 0))
            n = np.searchsorted(self.keys, node * 65 + np.minimum(gap + radius, 64), "right") - lo
            if n.any():
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                todo.append((np.repeat(query, n), self.kids[at]))


def spanning_links(shard: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what was apart: as good as all links for components, and fewer than the rows."""
    forest, up, kept = BKForest(shard, fp), np.arange(len(fp)), []

    def top(x):
        x = up[x]
        while (up[x] != x).any():
            x = up[x]
        return x

    for a, b in forest.within(radius):
        while len(a):
            ta, tb = top(a), top(b)
            up[a], up[b] = ta, tb
            apart = ta != tb
            a, b, ta, tb = a[apart], b[apart], ta[apart], tb[apart]
            high, pick = np.unique(np.maximum(ta, tb), return_index=True)
            up[high] = np.minimum(ta, tb)[pick]
            kept.append((a[pick], b[pick]))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*kept)) or [(), ()]))
    return fp[a], fp[b]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints of ``fps(fp)``, enough to span every component."""
    blocks = radius + 1
    width = 64 // blocks
    mask = (1 << width) - 1
    shard = [F.lit(i << 56) + F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit(mask)) for i in range(blocks)]
    dealt = fps.select("fp", F.explode(F.array(*shard)).alias("shard")).repartition("shard").sortWithinPartitions(
        "shard")

    def rows(batches):
        shards, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            held = np.r_[held, batch.column(0).to_numpy()]
            shards = np.r_[shards, batch.column(1).to_numpy()]
            if len(held) >= _FLUSH and (cut := int(np.searchsorted(shards, shards[-1]))):
                yield _links_batch(shards[:cut], held[:cut], radius)
                shards, held = shards[cut:], held[cut:]
        yield _links_batch(shards, held, radius)

    return dealt.mapInArrow(rows, "a bigint, b bigint")


def _links_batch(shards, held, radius):
    return pa.RecordBatch.from_arrays([pa.array(x) for x in spanning_links(shards, held, radius)], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id among the documents that links of at most ``radius`` bits reach.
    Equal fingerprints are merged before anything is searched. Null and wordless texts have fingerprint 0 and
    link like any other; null ids are passed over as component ids (null if there is no other); repeated rows
    stay repeated; an empty table gives an empty one. Other columns are not looked at.
    """
    fps = staged(fingerprints(docs, id_col, text_col), "simhash")
    classes = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = connected_components(links(classes.select("fp"), radius), [])
    rooted = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.join(named, "root").select("fp", "component_id"), "fp", "left").select(
        "doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, a null id only where there is no other.

    Rows are told apart by id and text together, so an id that is used twice loses only the text that is a copy, and
    of rows equal in both one stays. Null, empty and wordless texts share fingerprint 0 and are copies of each other.
    A very long text costs its worker a few times its own size. An empty table gives an empty one; other
    columns are carried along under any name.
    """
    k1, k2 = row_keys(id_col, text_col)
    who = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), k1, k2)
    found = near_duplicates(docs.select(who.alias("who"), F.col(text_col).alias("text")), "who", "text", radius)
    marks = staged(found.groupBy(F.col("doc_id._k1").alias("_k1"), F.col("doc_id._k2").alias("_k2")).agg(
        F.max(F.col("doc_id") != F.col("component_id")).alias("copy"), F.count("*").alias("n")).where("copy or n > 1"),
        "simhash-marks")
    rows = docs.select(F.struct("*").alias("row"), k1, k2)
    single = rows.join(marks, ["_k1", "_k2"], "left_anti")
    repeated = rows.join(marks.where("not copy"), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return single.unionByName(repeated).select("row.*")
