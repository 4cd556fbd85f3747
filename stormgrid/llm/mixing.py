"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target size. A document of a source is expected a number of times that is in proportion to its weight, at
most ``MOST`` times: the whole part is copied for certain, the rest is its inclusion probability in one more draw. For the draw documents are ranked by the odds of a uniform number divided by the odds of their
inclusion; the sample takes them in this order up to the size that the target leaves. Nothing is sorted
whole: the cut in the order is found by summing sizes over bins of the rank, and over the bins of the bin that the
target falls in, so a source with a third of all rows is a few thousand sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import ordered_index
from ..session import staged
from .common import row_key

WEIGHTS = (3, 1, 2)
SHARE = 1.5             # of all sizes that the mix is to have
MOST = 2                # times a source's size, and times a document
_BITS = 12              # of the rank that one round of bins tells apart
_ROUNDS = 4
_RANK_BITS = _BITS * _ROUNDS
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the row alone, so that reruns and lost executors change nothing."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit("pareto"), key), 12) + 0.5) / float(1 << 52)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` of ``sized(source, size)``.

    Sources by code point, null last, weigh ``weights`` in turn. A target stops at ``most`` times its source's size
    and the excess is shared again by weight: the level per weight at which all is given out rises from round to
    round, each a sum over the sources (only the sums reach the driver), until no further source is full.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordered_index(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")
    cap = most * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        taken = F.col("weight") * F.lit(level) >= cap
        r = ranked.agg(F.coalesce(F.sum(F.when(taken, cap)), F.lit(0)), F.sum(F.when(~taken, F.col("weight"))),
                       F.coalesce(F.sum(taken.cast("int")), F.lit(0))).first()
        if r[1] is None or r[2] == full:
            break
        level, full = (share * total - r[0]) / r[1], r[2]
    return ranked.select("source", "source_size",
                         F.least(cap.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def weight_of(size: Column) -> Column:
    """A document's weight where the caller gives none: 1 and one more for every doubling of its words, so that at most 64 differ."""
    return (1 + F.floor(F.log2(1 + size))).cast("double")


def levels(rows: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``sources`` plus ``level``: copies of ``least(most, level * weight)`` add up to the target's words.

    Documents that reach ``most`` give their excess to the others of their source: the level rises from round to round, each an
    aggregate over the sums per source and weight, until no further weight is full. It is infinite where the target takes
    ``most`` of all that weigh anything.
    """
    classes = staged(rows.where("weight > 0").groupBy(F.col("source").alias("_s"), "weight").agg(F.sum("size").alias("n")), "mix-weights")
    mine = F.col("source").eqNullSafe(F.col("_s"))
    at = sources.withColumn("level", F.lit(0.0))
    before = -1
    while True:
        is_full = F.col("weight") * F.col("level") >= most
        sums = classes.join(at, mine).groupBy("_s").agg(
            F.coalesce(F.sum(F.when(is_full, most * F.col("n"))), F.lit(0)).alias("full"),
            F.sum(F.when(~is_full, F.col("weight") * F.col("n"))).alias("open"), F.count_if(is_full).alias("k"))
        raised = sources.join(sums, mine, "left").withColumn("level", F.when(
            F.coalesce("open", F.lit(0.0)) > 0, (F.col("target") - F.col("full")) / F.col("open")).otherwise(F.lit(float("inf"))))
        at = staged(raised.select(*sources.columns, "level", F.coalesce("k", F.lit(0)).alias("k")), "mix-level")
        full = at.agg(F.sum("k")).first()[0] or 0
        at = at.drop("k")
        if full == before:
            break
        before = full
    # what only rounding keeps below the most is at the most
    return at.withColumn("level", F.when(F.col("target") >= most * F.col("source_size"), F.lit(float("inf"))).otherwise(F.col("level")))


def _with_copies(sized: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Whole copies, and the rank of the rest as an integer of ``_RANK_BITS`` bits (null: no further draw)."""
    copies = F.when(F.col("weight") > 0, F.least(F.lit(float(most)), F.col("level") * F.col("weight"))).otherwise(0.0)
    whole = F.floor(copies)
    rest, u = copies - whole, F.col("u")
    odds = (u / (1 - u)) / (rest / (1 - rest))
    rank = F.floor(odds / (1 + odds) * float(1 << _RANK_BITS)).cast("long")
    return sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop(
        "_source").withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long")).withColumn(
        "rank", F.when(rest > 0, F.least(rank, F.lit((1 << _RANK_BITS) - 1))))


def cuts(ranked: DataFrame) -> DataFrame:
    """``(source, cut)``: documents with a rank of at most ``cut`` come nearest to what the target leaves.

    ``ranked(source, size, whole, rank, target)``. Every round splits one bin per source in ``2 ** _BITS``; the
    window runs over those sums, not over documents.
    """
    drawn = ranked.where(F.col("rank").isNotNull() & (F.col("size") > 0)).select(
        F.to_json(F.struct("source")).alias("s"), "rank", "size")
    left = ranked.groupBy(F.to_json(F.struct("source")).alias("s")).agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("left"))
    at = staged(left.select("s", "left", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("below")), "mix-cut")
    for i in range(_ROUNDS):
        shift = _RANK_BITS - _BITS * (i + 1)
        sums = drawn.join(at, "s").where(F.shiftright("rank", shift + _BITS) == F.col("bin")).groupBy(
            "s", "left", "below", F.shiftright("rank", shift).alias("next")).agg(F.sum("size").alias("n"))
        upto = F.col("below") + F.sum("n").over(Window.partitionBy("s").orderBy("next"))
        steps = sums.select("s", "left", "next", (upto - F.col("n")).alias("before"), upto.alias("upto"))
        # the first bin that reaches the target; else the last one there is
        reached = F.when(F.col("upto") >= F.col("left"), F.col("next"))
        found = steps.groupBy("s", "left").agg(F.min(reached).alias("hit"), F.max(F.struct("next", "before")).alias("last"),
                                               F.min(F.struct(F.coalesce(reached, F.lit(1 << 62)), "before",
                                                              "upto")).alias("b"), F.max("upto").alias("all"))
        at = staged(found.select(
            "s", "left", F.coalesce("hit", "last.next").alias("bin"),
            F.when(F.col("hit").isNotNull(), F.col("b.before")).otherwise(F.col("last.before")).alias("below"),
            F.when(F.col("hit").isNotNull(), F.col("b.upto")).otherwise(F.col("all")).alias("upto")), "mix-cut")
        last = at
        at = at.select("s", "left", "bin", "below")
    near = F.abs(F.col("upto") - F.col("left")) < F.abs(F.col("below") - F.col("left"))
    return last.select(F.from_json("s", "source string")["source"].alias("source"),
                       F.when(near | (F.col("upto") == F.col("below")), F.col("bin")).otherwise(
                           F.col("bin") - 1).alias("cut"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weight_col: str | None = None) -> DataFrame:
    size = size_of(F.col(text_col))
    weight = weight_of(size) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size"), weight.alias("weight"),
                       uniform(row_key(id_col, text_col)).alias("u"))


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target, level, cut)``, a row per source, for the rows of ``sized``."""
    sources = staged(levels(rows, staged(targets(rows, weights, share, most), "mix-targets"), most), "mix-levels")
    cut = cuts(_with_copies(rows, sources, most)).withColumnRenamed("source", "_s")
    # written, so that the planner knows how small it is and need not deal documents by their source
    return staged(sources.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-plan")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weight_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
          most: int = MOST) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``.

    A document's chance grows with its weight (``weight_of`` its words unless ``weight_col`` names one): its expected copies are
    ``least(most, level * weight)``, whole copies are certain and Pareto order sampling draws the rest, random odds over
    inclusion odds, up to the words that the target leaves. Rows that agree in id and text get the same draw. Null texts have size 0 and are never drawn; a null source is
    a source, the last; a null or negative weight is 0. A table without words takes nothing; an empty one
    gives an empty one.
    """
    rows = staged(sized(docs, id_col, text_col, source_col, weight_col), "mix")
    placed = _with_copies(rows, plan(rows, weights, share, most), most)
    copies = F.col("whole") + F.coalesce((F.col("rank") <= F.col("cut")) & (F.col("size") > 0), F.lit(False)).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mix_rows(docs: DataFrame, **kw) -> DataFrame:
    """Rows of ``docs(doc_id, text, source, ..)`` that the mix takes, with ``copies``; the others go.

    The plan is a row per source; documents are met by it where they stand, their texts are not shuffled.
    """
    rows = staged(sized(docs), "mix")
    most = kw.get("most", MOST)
    per = plan(rows, **kw)
    keep = [c for c in docs.columns if c != "copies"]
    wide = docs.select(F.struct(*keep).alias("_row"), F.col("source").cast("string").alias("source"),
                       size_of(F.col("text")).alias("size"), weight_of(size_of(F.col("text"))).alias("weight"),
                       uniform(row_key("doc_id", "text")).alias("u"))
    placed = _with_copies(wide, per, most)
    copies = F.col("whole") + F.coalesce((F.col("rank") <= F.col("cut")) & (F.col("size") > 0), F.lit(False)).cast("long")
    return placed.withColumn("copies", copies).where("copies > 0").select("_row.*", "copies")
