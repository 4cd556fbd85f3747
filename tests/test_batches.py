"""Batches cut in place: numbering, borders of ranges, one exchange of the rows."""

import random

from pyspark.sql import functions as F

from stormgrid.operators import rows
from stormgrid.operators.numbering import ranges


def test_batches_over_borders(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None, "c"]), i) for i in range(2000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, id long").repartition(5)
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for size in (7, 50, 3000):
        got = {r.batch_id: (r.num_rows, list(r.entries)) for r in rows.batches(df, ["k", "id"], size, F.col("id")).collect()}
        assert got == {i // size: (len(part), [x for _, x in part]) for i in range(0, 2000, size) for part in [want[i:i + size]]}
    assert rows.batches(df.where("false"), ["k", "id"], 5, F.col("id")).collect() == []


def test_rows_are_dealt_once(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("id"))
    out = rows.batches(df, ["id"], 10, F.col("id"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("hashpartitioning(_part") == 1 or "ReusedExchange" in plan
    cut = ranges(df, ["id"], 8)
    sizes = [b - a for a, b in zip(cut.starts, cut.starts[1:])]
    assert sum(sizes) == 5000 and len(sizes) == 8 and max(sizes) < 1200
