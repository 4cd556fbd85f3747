"""GeoJSON documents of any size and layout, read feature by feature from byte ranges.

A document of gigabytes is not one row. Its bytes are cut into blocks, and a block can only be read once it is known whether it
begins inside a string and how deep. Both follow from all bytes before it, but they combine: every block is scanned once
for either case (the second one being the first with inside and outside exchanged), the results are chained per file, which is
a few numbers a block, and only then are features read, each by the block in which it begins, which reads on past its end
for the last one. So the answer is that of parsing the whole document, in one line, pretty-printed, with one
feature a line, or as lines of features without a collection.

Bytes come through Arrow's file systems (local, HDFS, S3, GCS); files are listed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged

#: Names ending in .geojson or .json, whatever their letters' case.
NAMES = "*.{[gG][eE][oO][jJ][sS][oO][nN],[jJ][sS][oO][nN]}"
BLOCK = 16 << 20            # bytes of a block: a task holds one, and the feature that runs over its end
_ROWS = 4 << 20             # bytes of features of one batch
_FEATURES = b"features"     # fixed value: the member whose array holds the features

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def list_files(spark: SparkSession, folders: str | list[str], names: str = NAMES) -> DataFrame:
    """``(file_path, length)`` of the files under ``folders``, at any depth; their content is not read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
             .load(folders))
    return found.select(F.col("path").alias("file_path"), "length")


def open_file(path: str):
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _read(file, lo: int, hi: int) -> bytes:
    file.seek(lo)
    return file.read(hi - lo)


# marks of a block ----------------------------------------------------------------------------------------------------

def _before(file, at: int) -> bytes:
    """The run of backslashes that ends at ``at``."""
    width = 64
    while at:
        tail = _read(file, max(0, at - width), at)
        rest = tail.rstrip(b"\\")
        if rest or width >= at:
            return tail[len(rest):]
        width *= 4
    return b""


def marks(data: bytes, slashes: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the brackets, their steps (1 opens, -1 closes), and the number of unescaped quotes before each; the last number is
    that of the whole block. ``slashes`` backslashes stand just before it."""
    raw = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(raw == 34)
    if len(quotes):
        odd = np.zeros(len(quotes), bool)
        for i in np.flatnonzero((quotes == 0) | (raw[quotes - 1] == 92)).tolist():
            q = int(quotes[i])
            run = q - len(data[:q].rstrip(b"\\")) if q < 64 else _run(data, q)
            odd[i] = (run + (slashes if run == q else 0)) % 2 == 1
        quotes = quotes[~odd]
    at = np.flatnonzero(_STEP[raw])
    return at, _STEP[raw[at]], np.r_[np.searchsorted(quotes, at), len(quotes)]


def _run(data: bytes, end: int) -> int:
    width = 64
    while True:
        part = data[max(0, end - width):end]
        run = len(part) - len(part.rstrip(b"\\"))
        if run < len(part) or width >= end:
            return run
        width *= 4


def _structure(data: bytes, slashes: int, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool, int]:
    """Places, steps and depths before of the brackets outside of strings, and the state at the end of the block."""
    at, step, quotes = marks(data, slashes)
    outside = quotes[:-1] % 2 == int(inside)
    at, step = at[outside], step[outside].astype(np.int64)
    after = depth + np.cumsum(step)
    return at, step, after - step, bool((quotes[-1] + inside) % 2), int(after[-1]) if len(after) else depth


# 1: how blocks chain ---------------------------------------------------------------------------------------------------

def _pieces(files: DataFrame, block: int) -> DataFrame:
    """``(file_path, length, lo, hi)``: one row a block, dealt evenly (a plain shuffle of these would end in one task)."""
    cut = files.where("length > 0").withColumn("lo", F.explode(F.expr(f"sequence(0L, length - 1L, {block}L)"))).withColumn(
        "hi", F.least(F.col("lo") + block, F.col("length")))
    n = files.agg(F.sum(F.ceil(F.col("length") / block))).first()[0] or 1
    return cut.repartition(int(max(1, min(n, 100_000))))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["file_path"]) as file:
                at, step, quotes = marks(_read(file, r["lo"], r["hi"]), len(_before(file, r["lo"])))
            for inside in (0, 1):
                depth = np.cumsum(step[quotes[:-1] % 2 == inside].astype(np.int64))
                r[f"change{inside}"], r[f"low{inside}"] = (int(depth[-1]), int(depth.min())) if len(depth) else (0, 0)
            r["odd"] = bool(quotes[-1] % 2)
            yield pa.RecordBatch.from_pylist([r])


_SCANNED = "file_path string, length bigint, lo bigint, hi bigint, change0 bigint, low0 bigint, change1 bigint, low1 bigint, odd boolean"
_STATES = "file_path string, length bigint, lo bigint, hi bigint, inside boolean, depth bigint, low bigint, sound boolean"


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """State at the start of every block of one file; a file that ends inside a string or at a depth, or closes more than it
    opened, is not sound."""
    pdf = pdf.sort_values("lo")
    inside, depth, sound, out = False, 0, True, []
    for r in pdf.itertuples():
        change, low = (r.change1, r.low1) if inside else (r.change0, r.low0)
        out.append((inside, depth, depth + min(0, low)))
        sound &= depth + low >= 0
        depth, inside = depth + change, inside != r.odd
    pdf = pdf[["file_path", "length", "lo", "hi"]].copy()
    pdf["inside"], pdf["depth"], pdf["low"] = zip(*out)
    pdf["sound"] = bool(sound and depth == 0 and not inside)
    return pdf


# 2: where the feature arrays are ----------------------------------------------------------------------------------------

def _key_before(file, at: int) -> bytes | None:
    """The key of the member whose value begins at ``at``."""
    width = 256
    while True:
        tail = _read(file, max(0, at - width), at)
        found = re.search(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', tail, re.S)
        if found or width >= at:
            return found[1] if found else None
        width *= 4


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature arrays that open in a block, and the first place in it at which an array of a root member closes."""
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["file_path"]) as file:
                data, slashes = _read(file, r["lo"], r["hi"]), len(_before(file, r["lo"]))
                at, step, depth, _, _ = _structure(data, slashes, r["inside"], r["depth"])
                kind = np.frombuffer(data, np.uint8)[at]
                closes = at[(kind == ord("]")) & (depth == 2)]
                opens = at[(kind == ord("[")) & (depth == 1)]
                mine = [int(a) for a in opens if _key_before(file, r["lo"] + int(a)) == _FEATURES]
            ends = np.searchsorted(closes, mine)
            rows = [(r["lo"] + a, r["lo"] + int(closes[e]) if e < len(closes) else None) for a, e in zip(mine, ends.tolist())]
            first = r["lo"] + int(closes[0]) if len(closes) else None
            yield pa.RecordBatch.from_pylist([{"file_path": r["file_path"], "begin": a, "end": e, "first": None} for a, e in rows]
                                             + [{"file_path": r["file_path"], "begin": None, "end": None, "first": first}],
                                             schema=_ARRAYS)


_ARRAYS = pa.schema([("file_path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("first", pa.int64())])


def layout(spark: SparkSession, files: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of ``files(file_path, length)`` with their state and their file's feature arrays, as a stored table: a row of about 100
    bytes for ``block`` bytes of input. ``sound`` is false for files that are cut off or unbalanced."""
    blocks = staged(_pieces(files, block).mapInArrow(_scan, _SCANNED).groupBy("file_path").applyInPandas(_chain, _STATES),
                    "geojson-blocks")
    root = blocks.where("sound and low <= 1")
    found = root.repartition(int(max(1, min(root.count(), 100_000)))).mapInArrow(
        _arrays, "file_path string, begin bigint, end bigint, first bigint")
    # an array that does not close in its block closes where a later block first comes back to its depth
    arrays = found.groupBy("file_path").agg(
        F.sort_array(F.collect_list(F.when(F.col("begin").isNotNull(), F.struct("begin", "end")))).alias("a"),
        F.sort_array(F.collect_list("first")).alias("f")).select("file_path", F.expr(
            "transform(a, x -> struct(x.begin as begin, coalesce(x.end, array_min(filter(f, c -> c > x.begin))) as end))").alias("arrays"))
    return staged(blocks.join(arrays, "file_path", "left"), "geojson-layout")


# 3: features -------------------------------------------------------------------------------------------------------------

def _rest(file, at: int, size: int, length: int, inside: bool, depth: int, goal: int) -> bytes:
    """What follows ``at`` until the depth is ``goal`` again."""
    out = []
    while at < length:
        data = _read(file, at, min(length, at + size))
        place, step, before, inside, depth = _structure(data, len(_before(file, at)), inside, depth)
        done = np.flatnonzero(before + step == goal)
        if len(done):
            out.append(data[:int(place[done[0]]) + 1])
            break
        out.append(data)
        at += len(data)
    return b"".join(out)


def block_features(file, r: dict) -> Iterator[tuple[int, bytes]]:
    """``(place, body)`` of the features that begin in one block: members of the feature arrays, and objects at
    the root that hold no such array."""
    data = _read(file, r["lo"], r["hi"])
    at, step, depth, inside, last = _structure(data, len(_before(file, r["lo"])), r["inside"], r["depth"])
    kind = np.frombuffer(data, np.uint8)[at]
    begins = np.array([a["begin"] for a in r["arrays"] or []], np.int64)
    ends = np.array([a["end"] for a in r["arrays"] or []], np.int64)
    for level in (2, 0):
        start = at[(kind == ord("{")) & (depth == level)]
        stop = at[(step < 0) & (depth == level + 1)] + 1
        if level == 2:
            of = np.searchsorted(begins, start + r["lo"], "right") - 1
            start = start[(of >= 0) & (ends[of] > start + r["lo"])] if len(begins) else start[:0]
        place = np.searchsorted(stop, start, "right").tolist()
        for s, i in zip(start.tolist(), place):
            body = data[s:int(stop[i])] if i < len(stop) else None
            if level == 0 and len(begins):
                # where a root object ends matters only if an array comes after its start
                k = int(np.searchsorted(begins, r["lo"] + s))
                if k < len(begins) and (body is None or begins[k] < r["lo"] + s + len(body)):
                    if body is not None or begins[k] < r["hi"]:
                        continue
                    body = data[s:] + _rest(file, r["hi"], len(data), r["length"], inside, last, level)
                    if begins[k] < r["lo"] + s + len(body):
                        continue
            if body is None:
                body = data[s:] + _rest(file, r["hi"], len(data), r["length"], inside, last, level)
            yield r["lo"] + s, body


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["file_path"]) as file:
                held, size = [], 0
                for place, body in block_features(file, r):
                    held.append({"file_path": r["file_path"], "position": place, "body": body.decode("utf-8", "replace")})
                    size += len(body)
                    if size >= _ROWS:
                        yield pa.RecordBatch.from_pylist(held)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held)


def features(blocks: DataFrame) -> DataFrame:
    """``(file_path, position, body)``: the features of a ``layout``, each with its first byte's place in the file."""
    mine = blocks.where("sound and (low <= 0 or exists(arrays, a -> a.begin < hi and a.end > lo))")
    n = mine.count()
    return mine.repartition(int(max(1, min(n, 100_000)))).mapInArrow(_features, "file_path string, position bigint, body string")


def read_geojson(spark: SparkSession, folders: str | list[str], names: str = NAMES, block: int = BLOCK) -> DataFrame:
    """``(file_path, position, body)`` of every feature in the documents under ``folders``.

    A document is a FeatureCollection, a single feature, or features one after the other. A file whose brackets or
    strings do not end gives nothing, as do empty files; a feature's own text is not looked into. Invalid UTF-8 is replaced.
    """
    return features(layout(spark, list_files(spark, folders, names), block))
