"""Line dedup over overlapping windows of consecutive lines; DataFrame functions only.

A window is hashed to 128 bits, windows that occur again anywhere are found by one aggregation (merged map-side, so a
window in a third of all documents is one row per task), and every occurrence but the first, in the order of
document and line, is removed. Overlapping and touching windows of a document merge into runs before lines
are cut, so that a text is cut once per run and not once per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..session import staged
from .common import row_key

WINDOW = 3


def windows(docs: DataFrame, id_col: str, text_col: str, width: int = WINDOW) -> DataFrame:
    """``(doc_id, key, pos, h1, h2)``: every ``width`` consecutive lines that are not all blank."""
    lines = F.split(F.col(text_col), "\n", -1)
    at = [F.col("lines")[F.col("pos") + k] for k in range(width)]
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), lines.alias("lines"))
    rows = rows.where(F.size("lines") >= width).select(
        "*", F.explode(F.sequence(F.lit(0), F.size("lines") - width)).alias("pos"))
    blank = F.lit(True)
    for x in at:
        blank = blank & ~x.rlike("[^\\x20\\x09-\\x0D]")
    return rows.where(~blank).select("doc_id", "key", "pos", F.xxhash64(*at).alias("h1"),
                                     F.xxhash64(F.lit(1), *at).alias("h2"))


def later_windows(found: DataFrame) -> DataFrame:
    """``(doc_id, key, pos)`` of the windows that an earlier document, or an earlier line, has too."""
    place = F.struct(F.col("doc_id"), F.col("key"), F.col("pos"))
    firsts = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        "first <> last").select("h1", "h2", "first")
    return found.join(firsts, ["h1", "h2"]).where(place > F.col("first")).select("doc_id", "key", "pos")


def removed_runs(found: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(key, starts, ends)``: merged runs of lines that later windows cover, ends exclusive."""
    per = later_windows(found).groupBy("key").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    last = F.size("at") - 1
    return per.select(
        "key", F.filter("at", lambda x, i: (i == 0) | (x > F.get("at", i - 1) + width)).alias("starts"),
        F.transform(F.filter("at", lambda x, i: (i == last) | (F.get("at", i + 1) > x + width)),
                    lambda x: x + width).alias("ends"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` with ``text_col`` cut, plus ``n_lines``, ``n_removed`` and ``n_runs``.

    Lines end at ``\\n`` and are compared byte by byte; a text of fewer than ``width`` lines has no window. Rows that
    agree in id and text are one document: what repeats only between them stays. Null ids come first in the order. A
    null text stays null (0 lines), an empty one is one empty line; windows of blank lines only are not looked
    at. Columns of ``docs`` with the names of the added ones are replaced.
    """
    own = ("n_lines", "n_removed", "n_runs")
    found = staged(windows(docs, id_col, text_col, width), "lines")
    runs = removed_runs(found, width)
    met = docs.select(F.struct("*").alias("_row"), row_key(id_col, text_col).alias("key")).join(runs, "key", "left")
    text = F.col("_row")[text_col]
    cut = let(F.split(text, "\n", -1), lambda lines: F.array_join(F.transform(
        F.filter(F.arrays_zip(F.concat(F.array(F.lit(0)), "ends").alias("lo"),
                              F.concat("starts", F.array(F.size(lines))).alias("hi")), lambda r: r["hi"] > r["lo"]),
        lambda r: F.array_join(F.slice(lines, r["lo"] + 1, r["hi"] - r["lo"]), "\n")), "\n"))
    removed = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0), lambda n, r: n + r["ends"] - r["starts"])
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)
    return met.select(
        *[F.when(F.col("starts").isNull(), text).otherwise(cut).alias(c) if c == text_col else F.col("_row")[c].alias(c)
          for c in docs.columns if c not in own],
        n_lines.cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("starts").isNull(), 0).otherwise(F.size("starts")).cast("long").alias("n_runs"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, n_chars, ..)`` cut; a document goes if every line of it was removed."""
    out = deduplicated(docs.select(F.struct("*").alias("_row"), "doc_id", "text"))
    return out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))).select(
        *[F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars"
          else F.col("_row")[c].alias(c) for c in docs.columns])
