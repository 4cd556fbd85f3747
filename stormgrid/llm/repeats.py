"""Repeated byte strings of a minimum length, found on Burrows-Wheeler transforms.

Which texts can share a string of ``LENGTH`` bytes is settled by anchors: of every window of ``LENGTH`` bytes the
``GRAM``-byte string with the smallest hash. Equal windows have equal anchors at equal places, so a string that occurs
twice lies in the slices (all windows that have the anchor) of two occurrences of one anchor. Anchors that occur once
are dropped; equal slices of an anchor merge into one with a count; the slices of an anchor meet in one task. Where an
anchor has very many different slices, they are cut by the anchor's place in the window, and dealt by the longer string
that all windows of such a part have in common; again and again, until what meets is few.

There the slices are laid end to end and the threshold-bounded interval expansion runs on the transform of that text:
from the boundaries between intervals of suffixes that differ in their first ``l`` bytes, one step of backward extension
gives those at ``l + 1``, breadth-first, so common prefixes are found in the order of their length. After
``LENGTH`` steps the boundaries not reached are those between suffixes that share ``LENGTH`` bytes or more.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import row_key, row_ranges

LENGTH = 400
GRAM = 128
_PIECE = 1 << 20            # bytes of text hashed at a time
_SHARD = 1 << 17            # bytes of slices transformed at a time, so that the sorts stay in the cache
_HOT = 1024                # different slices of an anchor that meet in a task
_CUT = 17                  # parts of a slice of an anchor that has more
_PLACE_BITS = 24           # low bits of an anchor's value, for its place in a piece
_ODD = np.uint64(0x9E3779B97F4A7C15)


# anchors ----------------------------------------------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    return (np.cumprod(np.full(n, _ODD, np.uint64)), np.cumprod(np.full(n, inverse, np.uint64)))


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each byte on, by one prefix sum."""
    n = len(data)
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _CACHE:
        _CACHE[size] = _powers(size)
    up, down = _CACHE[size]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    x = (total[gram:] - total[:-gram]) * down[:n - gram + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Places of the anchors of all windows inside the texts that end at ``ends``, the first and the last window that
    has each, and their hashes. The windows of an anchor are consecutive."""
    if len(data) < length:
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))
    hashes = gram_hashes(data, gram)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    # the smallest hash, of equals the rightmost: the place counts down in the low bits
    best = (hashes & ~mask) | (mask - np.arange(len(hashes), dtype=np.uint64))
    width, have = length - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    starts = np.arange(len(best))
    inside = starts + length <= ends[np.searchsorted(ends, starts, "right")]
    at, starts = (mask - (best & mask)).astype(np.int64)[inside], starts[inside]
    turn = np.flatnonzero(at[1:] != at[:-1]) + 1
    first, last = (np.r_[0, turn], np.r_[turn, len(at)] - 1) if len(at) else (turn, turn)
    return at[first], starts[first], starts[last], hashes[at[first]]


def text_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """``(text, place in it, first window, last window, hash)`` of the anchors of some texts; a long text goes piece
    by piece, and an anchor with windows in two pieces is put together."""
    out = []
    if len(texts) == 1 and len(texts[0]) > 2 * _PIECE:
        data = np.frombuffer(texts[0], np.uint8)
        for lo in range(0, len(data) - length + 1, _PIECE):
            part = data[lo:lo + _PIECE + length - 1]
            at, first, last, h = anchors(part, np.array([len(part)]), length, gram)
            out.append((at + lo, first + lo, last + lo, h))
        at, first, last, h = (np.concatenate(x) for x in zip(*out))
        head = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return np.zeros(len(head), np.int64), at[head], first[head], last[np.r_[head[1:], len(at)] - 1], h[head]
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    at, first, last, h = anchors(np.frombuffer(b"".join(texts), np.uint8), ends, length, gram)
    of = np.searchsorted(ends, at, "right")
    begin = (ends - size)[of]
    return of, at - begin, first - begin, last - begin, h


# the transform ------------------------------------------------------------------------------------------------

def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Suffixes by their first ``length`` symbols at least. Only what is still tied is sorted again.

    ``text`` has symbols 0 .. 256, 0 for the ends of slices.
    """
    n = len(text)
    padded = np.r_[text, np.zeros(8, text.dtype)].astype(np.int64)
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k:k + n]
    order = np.argsort(key)
    head = np.r_[True, key[order[1:]] != key[order[:-1]]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    tied = np.flatnonzero(~(head & np.r_[head[1:], True]))      # places of order inside groups of equals
    have, bits = 7, (n + 1).bit_length()
    steps = 2 if 3 * bits < 63 else 1           # as many ranks as fit a key beside the group
    while have < length and len(tied):
        who = order[tied]
        key = group = rank[who]
        for k in range(1, steps + 1):
            key = (key << bits) | (rank[np.minimum(who + k * have, n)] + 1)
        by = np.argsort(key)
        order[tied], key = who[by], key[by]
        head = np.r_[True, key[1:] != key[:-1]]
        new = tied[np.flatnonzero(head)[np.cumsum(head) - 1]]
        rank[order[tied]] = new
        tied = tied[~(head & np.r_[head[1:], True])]
        have *= steps + 1
    return order


def unreached(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in ``order``: whether its suffix shares ``length`` symbols with the one before.

    The intervals of suffixes that begin with ``l`` given symbols are told by their boundaries. Backward extension by
    ``c`` maps a boundary ``b`` to ``C[c] + Occ(c, b)``. For the symbol that the transform has on both sides of ``b`` that
    is one new boundary. For any other symbol it is that of the next run of this symbol: such a run's head is reached
    when the first boundary falls between the run before and itself. So a step takes the new boundaries, and the heads
    not reached yet, whose number falls as prefixes grow.
    """
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    last_first = np.empty(n, np.int64)          # C[c] + Occ(c, i) for c = bwt[i]
    last_first[by_symbol] = np.arange(n)
    is_head = np.r_[True, bwt[1:] != bwt[:-1]]
    before = np.full(n, -1, np.int64)           # last place before i with the same symbol
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    heads = np.flatnonzero(is_head & (before >= 0))
    reached = np.zeros(n, bool)
    # length 1: boundaries between first symbols
    first = text[order]
    new = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
    reached[new] = True
    for _ in range(length - 1):
        inner = new[~is_head[new]]
        found = [last_first[inner]]
        if len(heads):
            hit = np.searchsorted(new, heads, "right") > np.searchsorted(new, before[heads], "right")
            found.append(last_first[heads[hit]])
            heads = heads[~hit]
        new = np.concatenate(found)
        new = np.sort(new[~reached[new]])
        reached[new] = True
        if not len(new):
            break
    return ~reached


def repeated_starts(slices: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each slice the places from which on ``length`` bytes stand that occur again: elsewhere in ``slices``, or
    because the slice was found ``counts`` times. (A window of a document is in one slice only.)"""
    size = np.array([len(s) + 1 for s in slices], np.int64)
    ends = np.cumsum(size)
    text = np.frombuffer(b"\0".join([*slices, b""]), np.uint8).astype(np.int16) + np.int16(1)
    text[ends - 1] = 0
    order = suffix_order(text, length)
    shared = unreached(text, order, length)
    at = np.sort(order[shared | np.r_[shared[1:], False]])      # with the suffix before, or the one after
    of = np.searchsorted(ends, at, "right")
    whole = at + length < ends[of]              # the window ends before the slice does
    at, of = at[whole], of[whole]
    each = np.arange(len(slices))
    found = zip(slices, counts, np.searchsorted(of, each), np.searchsorted(of, each, "right"), ends - size)
    return [np.arange(len(s) - length + 1) if c > 1 else at[a:b] - begin for s, c, a, b, begin in found]


# in Spark -------------------------------------------------------------------------------------------------------

def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.to_pylist()]


def _anchor_rows(length: int, gram: int):
    def rows(batches):
        for batch in batches:
            keys = batch.column(0)
            for lo, hi in row_ranges(batch.column(1), _PIECE):
                of, *places, h = text_anchors(_bytes(batch.column(1)[lo:hi]), length, gram)
                yield pa.RecordBatch.from_arrays(
                    [keys[lo:hi].take(pa.array(of)), *(pa.array(x.astype(np.int32)) for x in places),
                     pa.array(h.view(np.int64))], ["key", "pos", "first", "last", "h"])
    return rows


def _slice_rows(length: int):
    """Occurrences of repeated anchors, each with the slice of the windows that have it; a slice travels with its first occurrence in the task."""
    def rows(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys, texts, places = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            for i, key in enumerate(keys):
                text, out = texts[i].as_py() or b"", []
                for p in places[i].as_py():
                    part, h = text[p["first"]:p["last"] + length], p["h"]
                    sha = hashlib.blake2b(part, digest_size=16).digest()
                    out.append((h, sha, key, p["first"], None if sha in seen else part))
                    seen.add(sha)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.int64(), pa.int32(),
                                                                    pa.binary()))],
                        ["h", "slice_id", "key", "at", "slice"])
    return rows


_RUN = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])


def _runs(starts: np.ndarray, length: int) -> list[dict]:
    """Starts of repeated windows -> the byte runs they cover."""
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return [dict(lo=int(a), hi=int(b) + length)
            for a, b in zip(starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]])]


def part_widths(length: int, gram: int) -> list[int]:
    """Windows in a part of a slice, from one dealing to the next; one window at last."""
    out = [length - gram + 1]
    while out[-1] > 1:
        out.append(-(-out[-1] // _CUT))
    return out[1:]


def slice_parts(part: bytes, place: int, width: int, length: int) -> list[tuple[int, int, bytes, bytes]]:
    """``(class, first window, bytes, common string)`` of the parts of a slice with its anchor at ``place``.

    A class is ``width`` neighbouring places of the anchor in the window, so equal windows are of one class, and all
    of its windows hold the common string.
    """
    out = []
    for c in range((place - (len(part) - length)) // width, place // width + 1):
        lo, hi = max(place - (c + 1) * width + 1, 0), min(place - c * width, len(part) - length)
        begin = place - c * width
        out.append((c, lo, part[lo:hi + length], part[begin:begin + length - width + 1]))
    return out


def _part_rows(length: int, gram: int, width: int):
    """Slices of anchors that have too many -> their parts as occurrences, dealt by anchor, class and common string."""
    def rows(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for a, b in row_ranges(batch.column(3), _PIECE):
                hs, keys, counts, parts = (batch.column(i)[a:b].to_pylist() for i in range(4))
                of, place, *_ = text_anchors(parts, length, gram)     # as in the texts: one for all windows of a slice
                out = []
                for i, p in zip(of.tolist(), place.tolist()):
                    for c, lo, part, common in slice_parts(parts[i], p, width, length):
                        sha = hashlib.blake2b(part, digest_size=16).digest()
                        h = hashlib.blake2b(b"%d %d " % (hs[i], c) + common, digest_size=8).digest()
                        out.append((int.from_bytes(h, "little", signed=True), sha, keys[i], lo, counts[i],
                                    None if sha in seen else part))
                        seen.add(sha)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.int32(),
                                                                pa.int64(), pa.binary()))],
                    ["h", "slice_id", "key", "at", "n", "slice"])
    return rows


def _repeated_rows(length: int):
    """Distinct slices in the order of their anchors -> the runs of each that occur again."""
    def solve(held):
        ids, counts, slices = zip(*held)
        starts = repeated_starts(list(slices), np.array(counts), length)
        keep = [i for i, x in enumerate(starts) if len(x)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in keep], pa.binary()), pa.array([_runs(starts[i], length) for i in keep],
                                                                      pa.list_(_RUN))], ["slice_id", "runs"])

    def whole(held):
        return pa.RecordBatch.from_arrays(
            [pa.array([sid for sid, _, _ in held], pa.binary()),
             pa.array([[dict(lo=0, hi=len(part))] for _, _, part in held], pa.list_(_RUN))], ["slice_id", "runs"])

    def anchors_of(batches):
        """The distinct slices of one anchor after the other."""
        group, at = [], None
        for batch in batches:
            for h, sid, n, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if group and h != at:
                    yield group
                    group = []
                if not group or sid != group[-1][0]:        # else the same slice from another task
                    group.append((sid, n, part))
                at = h
        if group:
            yield group

    def rows(batches):
        held, size, alone = [], 0, []
        for group in anchors_of(batches):
            if len(group) == 1:     # nothing else to compare it with
                alone += [x for x in group if x[1] > 1]
                if len(alone) > 1000:
                    yield whole(alone)
                    alone = []
                continue
            held += group
            size += sum(len(part) for _, _, part in group)
            if size > _SHARD:
                yield solve(held)
                held, size = [], 0
        if held:
            yield solve(held)
        if alone:
            yield whole(alone)
    return rows


def dealt(occ: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = _HOT) -> list[tuple[DataFrame, DataFrame]]:
    """``occ(h, slice_id, key, at, n, slice)`` -> pairs of occurrences and the slices ``(h, slice_id, n, slice)`` to compare.

    Anchors of more than ``hot`` different slices are left out of a pair; the occurrences of the next are the parts of these
    slices, whose key is the id of the slice. In parts of one window nothing is left to compare, so the last pair leaves out none.
    """
    out = []
    for width in [*part_widths(length, gram), None]:
        # written, so that the occurrences are counted once
        counts = staged(occ.groupBy("h", "slice_id").agg(F.sum("n").alias("n")), "repeats-counts")
        # anchors whose only slice occurred once were equal by their gram alone
        slices = occ.where(F.col("slice").isNotNull()).select("h", "slice_id", "slice")
        many = staged(counts.groupBy("h").count().where(F.col("count") > hot).select("h"), "repeats-many") if width else None
        if many is None or many.isEmpty():
            return [*out, (occ, _counted(slices, counts))]
        out.append((occ, _counted(*(x.join(many, "h", "left_anti") for x in (slices, counts)))))
        # one row of a slice, whichever tasks it came from
        whole = staged(_counted(*(x.join(many, "h", "left_semi") for x in (slices, counts))).dropDuplicates(["h", "slice_id"]),
                       "repeats-hot")
        parts = whole.mapInArrow(_part_rows(length, gram, width),
                                 "h bigint, slice_id binary, key binary, at int, n bigint, slice binary")
        twice = staged(parts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "repeats-parts-twice")
        occ = staged(parts.join(twice, "h", "left_semi"), "repeats-parts")


def _counted(slices: DataFrame, counts: DataFrame) -> DataFrame:
    return slices.join(counts, ["h", "slice_id"]).select("h", "slice_id", "n", "slice")


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = _HOT) -> tuple[DataFrame, DataFrame]:
    """``docs(key, doc_id, text binary)`` -> those that share an anchor, and ``(key, runs)`` of the bytes to remove."""
    found = staged(docs.where(F.length("text") >= length).select("key", "text").mapInArrow(
        _anchor_rows(length, gram), "key bigint, pos int, first int, last int, h bigint"), "repeats-anchors")
    # written, so that the join has two exchanges of its own and its hot anchors can be split
    twice = staged(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeats-twice")
    hits = found.join(twice, "h").groupBy("key").agg(F.collect_set(F.struct("pos", "first", "last", "h")).alias("places"))
    texts = staged(docs.join(hits, "key"), "repeats-texts")
    occ = staged(texts.select("key", "text", "places").mapInArrow(
        _slice_rows(length), "h bigint, slice_id binary, key bigint, at int, slice binary"), "repeats-slices")
    again = None
    for where, slices in reversed(dealt(occ.withColumn("n", F.lit(1).cast("long")), length, gram, hot)):
        found = slices.repartition("h").sortWithinPartitions("h", "slice_id").mapInArrow(
            _repeated_rows(length), "slice_id binary, runs array<struct<lo: int, hi: int>>")
        placed = where.select("slice_id", "key", "at").join(found if again is None else found.unionByName(again), "slice_id")
        moved = F.transform("runs", lambda r: F.struct((r["lo"] + F.col("at")).alias("lo"), (r["hi"] + F.col("at")).alias("hi")))
        again = placed.select(F.col("key").alias("slice_id"), moved.alias("runs"))
    runs = again.select(F.col("slice_id").alias("key"), F.inline_outer("runs")).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs"))
    return texts.drop("places"), runs


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM, hot: int = _HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256)``, one row per row of ``docs``.

    Every byte that a ``length``-byte string covers which also starts anywhere else, in this document or another, is
    removed; ``kept`` are the bytes left, null where nothing was removed (they may not be whole characters). Texts
    shorter than ``length``, empty and null ones (no bytes) are left as they are. Rows equal in id and text are two
    documents and repeat each other; null ids are kept as they are. An empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    texts, runs = repeated_runs(docs, length, gram, hot)
    runs = staged(runs, "repeats-runs")

    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(1), 1 << 23):
                out = []
                for text, spans in zip(batch.column(1)[lo:hi].to_pylist(), batch.column(2)[lo:hi].to_pylist()):
                    parts, upto, n = [], 0, 0
                    for r in spans:
                        if r["lo"] > upto or not n:
                            n += 1
                            parts.append(text[upto:r["lo"]])
                        upto = max(upto, r["hi"])
                    parts.append(text[upto:])
                    kept = b"".join(parts)
                    out.append((len(text), len(text) - len(kept), n, kept, hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary()),
                     pa.array(cols[4], pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    cut = texts.join(runs, "key").select("doc_id", "text", "runs").mapInArrow(
        rows, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    whole = docs.select("key", "doc_id", F.length("text").cast("long").alias("n_bytes"),
                        F.sha2("text", 256).alias("kept_sha256")).join(runs.select("key"), "key", "left_anti")
    return cut.unionByName(whole.select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                        F.lit(0).cast("long").alias("n_spans"), F.lit(None).cast("binary").alias("kept"),
                                        "kept_sha256"))
