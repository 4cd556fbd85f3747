import numpy as np
import pytest

from stormgrid.operators.dbscan import dbscan


def brute(rows, eps, m):
    """Reference labels by the definition: rows = [(id, x, y)]."""
    rows = sorted(rows)
    ids = np.array([r[0] for r in rows])
    xy = np.array([[r[1], r[2]] for r in rows])
    d2 = ((xy[:, None] - xy[None]) ** 2)
    near = d2[..., 0] + d2[..., 1] <= eps * eps
    core = near.sum(1) >= m
    label = np.full(len(ids), -1)
    k = 0
    for i in range(len(ids)):
        if core[i] and label[i] < 0:
            todo = [i]
            label[i] = k
            while todo:
                for b in np.where(near[todo.pop()] & core & (label < 0))[0]:
                    label[b] = k
                    todo.append(b)
            k += 1
    for i in np.where(~core)[0]:
        c = label[near[i] & core]
        label[i] = c.min() if len(c) else -1
    return dict(zip(ids.tolist(), label.tolist()))


def run(spark, rows, eps, m, **kw):
    df = spark.createDataFrame(rows, "id long, lon double, lat double")
    return {r.id: r.label for r in dbscan(df, eps, m, **kw).collect()}


@pytest.mark.parametrize("seed,n,eps,m,spread,hot", [
    (0, 600, 0.03, 6, 0.6, 200_000),     # thin and dense cells, noise
    (1, 400, 0.1, 4, 0.5, 200_000),      # mostly dense
    (2, 500, 0.02, 8, 1.0, 200_000),     # mostly thin
    (3, 600, 0.05, 5, 0.5, 10),          # hot-key branches taken
])
def test_matches_definition(spark, seed, n, eps, m, spread, hot):
    r = np.random.default_rng(seed)
    xy = np.vstack([r.random((n // 2, 2)) * spread, r.normal(0.3, 0.02, (n - n // 2, 2))])
    rows = [(int(i) * 3, float(a), float(b)) for i, (a, b) in zip(r.permutation(n), xy)]
    assert run(spark, rows, eps, m, hot_rows=hot) == brute(rows, eps, m)


def test_two_dense_groups_just_apart_or_touching(spark):
    # two rows of points whose closest pair is at eps (joined) or slightly beyond (apart)
    r = np.random.default_rng(5)
    a = r.random((120, 2)) * [0.2, 0.4]
    a[0] = [0.25, 0.2]
    for gap, k in ((1.0, 1), (1.0 + 1e-9, 2)):
        b = r.random((120, 2)) * [0.2, 0.4] + [1.3, 0]
        b[0] = [0.25 + gap, 0.2]
        rows = [(i, float(p[0]), float(p[1])) for i, p in enumerate(np.vstack([a, b]))]
        want = brute(rows, 1.0, 5)
        assert max(want.values()) + 1 == k
        assert run(spark, rows, 1.0, 5, hot_rows=20) == want


def test_hand_cases(spark):
    assert run(spark, [(1, 0.0, 0.0)], 0.5, 2) == {1: -1}
    assert run(spark, [(1, 0.0, 0.0)], 0.5, 1) == {1: 0}
    # copies of one coordinate
    assert run(spark, [(i, 1.0, 1.0) for i in range(9)], 0.1, 9) == {i: 0 for i in range(9)}
    # exactly eps apart counts
    assert run(spark, [(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 1.0, 0.0)], 0.5, 2) == {1: 0, 2: 0, 3: 0}
    # a border point between two clusters joins the lower label
    rows = [(i, -1.0, 0.01 * i) for i in range(5)] + [(10 + i, 1.0, 0.01 * i) for i in range(5)] + [(99, 0.0, 0.0)]
    got = run(spark, rows, 1.0, 4)
    assert got[99] == 0 and got[0] == 0 and got[10] == 1


def test_groups_are_independent(spark):
    r = np.random.default_rng(7)
    rows = [(g, i, float(a), float(b)) for g in range(3) for i, (a, b) in enumerate(r.random((150, 2)) * (0.3 + g / 3))]
    df = spark.createDataFrame(rows, "g long, id long, lon double, lat double")
    got = {(x.g, x.id): x.label for x in dbscan(df.repartition(5), 0.06, 5, by=["g"]).collect()}
    for g in range(3):
        want = brute([x[1:] for x in rows if x[0] == g], 0.06, 5)
        assert {k[1]: v for k, v in got.items() if k[0] == g} == want


def test_null_groups_and_missing_coordinates(spark):
    nan = float("nan")
    rows = [(i, None, 1.0, 1.0) for i in range(10)] + [(100 + i, "KY", 1.0, 1.0) for i in range(10)]
    rows += [(200, None, nan, 1.0), (201, "KY", None, 1.0), (202, "KY", nan, nan)]
    got = {r.id: r.label for r in dbscan(spark.createDataFrame(rows, "id long, state string, lon double, lat double"),
                                         0.03, 6, by=["state"]).collect()}
    assert {got[i] for i in range(10)} == {got[100 + i] for i in range(10)} == {0}
    assert [got[i] for i in (200, 201, 202)] == [-1, -1, -1]
    # a third of all points on one spot of one group
    many = [(i, "GA" if i % 3 else None, 2.0 if i % 3 == 0 else i * 0.5, 3.0) for i in range(3000)]
    got = dbscan(spark.createDataFrame(many, "id long, state string, lon double, lat double"), 0.03, 6, by=["state"])
    assert got.where("label = 0").count() == 1000 and got.where("label = -1").count() == 2000


def test_links_are_those_of_all_pairs():
    """Dense cells of a tile: components and open pairs as by comparing every pair, and few questions once cells are connected."""
    from stormgrid.operators import tiles

    rng, asked = np.random.default_rng(5), []
    plain, n = tiles._box_tests, 100
    place = rng.permutation(400)[:n]
    cell = np.repeat(np.arange(n), rng.integers(1, 9, n))
    x, y = (c[cell] + rng.random(len(cell)) for c in (place // 20, place % 20))
    bx = [x, x + rng.random(len(x)) / 9, y, y + rng.random(len(x)) / 9]
    tile = {"node": 7 * rng.permutation(n), "home": np.ones(n, bool), "_cx": place // 20, "_cy": place % 20, "boxes": {"cell": cell}}
    tiles._box_tests = lambda *a: asked.append(len(a[3])) or plain(*a)
    try:
        got = tiles._links(tile, bx, 1.2)
    finally:
        tiles._box_tests = plain
    group, unsure, pairs = {v: v for v in tile["node"].tolist()}, [], 0
    for i in range(n):
        for j in range(i):
            if abs(place[i] // 20 - place[j] // 20) > 2 or abs(place[i] % 20 - place[j] % 20) > 2:
                continue
            a, b = ([v[cell == k, None] if k == i else v[cell == k] for v in bx] for k in (i, j))
            near = tiles._gap(a[0], a[1], b[0], b[1]) ** 2 + tiles._gap(a[2], a[3], b[2], b[3]) ** 2
            far = tiles._span(a[0], a[1], b[0], b[1]) ** 2 + tiles._span(a[2], a[3], b[2], b[3]) ** 2
            pairs += 1
            u, v = int(tile["node"][i]), int(tile["node"][j])
            if far.min() <= 1.2:
                lo, hi = sorted((group[u], group[v]))
                group = {k: lo if r == hi else r for k, r in group.items()}
            elif near.min() <= 1.2:
                unsure.append((u, v))
    star = {(a, b) for a, b in group.items() if a != b}
    assert set(zip(got[0]["a"].tolist(), got[0]["b"].tolist())) == star
    assert {frozenset(p) for p in zip(got[1]["a"].tolist(), got[1]["b"].tolist())} == {frozenset(p) for p in unsure if group[p[0]] != group[p[1]]}
    assert 0 < sum(asked) < pairs


def test_group_of_small_ints_is_a_number(spark):
    rows = [(i, g, 0.01 * (i % 10), 0.0) for i, g in enumerate([None] * 10 + [0] * 10 + [-7] * 10 + [2**31 - 1] * 10)]
    df = spark.createDataFrame(rows, "id long, g int, lon double, lat double")
    plain = dbscan(df.withColumn("g", df["g"].cast("long")), 0.015, 3, by=["g"]).collect()
    assert sorted((r.id, r.label) for r in dbscan(df, 0.015, 3, by=["g"]).collect()) == sorted((r.id, r.label) for r in plain) \
        == [(i, 0) for i in range(40)]
    from stormgrid.operators.dbscan import _group
    assert df.select(_group(df, ["g"]).alias("k")).schema["k"].dataType.simpleString() == "bigint"
