"""Katz backoff, whitening, periodic runs, language model: against plain Python on small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.llm import katz, langid, mixing, quality, runs, warc, whitening, winnowing
from stormgrid.llm.queries import QUERIES

LONG = " ".join(f"w{i}" for i in range(3000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, u int, runs int, chunk int"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (4, "another text"), (None, "no id"), (None, "no id"), (5, "é É" * 300)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in ODD], SCHEMA)


# Katz ----------------------------------------------------------------------------------------------------------------

def katz_by_hand(rows, learn):
    """Scores of every row, and the check that every context's shares add up to one."""
    toks = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    uni = Counter(w for i in toks if learn(i) for w in toks[i])
    total, pairs = sum(uni.values()), defaultdict(Counter)
    for i, t in toks.items():
        if learn(i):
            for a, b in zip([0, *t], t):
                pairs[a][b] += 1

    def keep(counts):
        counts = list(counts)
        k = katz.discounts([counts.count(r) for r in range(1, katz.SMALL + 2)])
        return lambda c: c * (k[c - 1] if c <= katz.SMALL else 1.0)

    one, two = keep(uni.values()), keep(v for f in pairs.values() for v in f.values())
    bottom = total + (not any(c <= katz.SMALL for c in uni.values()))
    unknown = 1 - sum(map(one, uni.values())) / bottom
    p1 = lambda w: one(uni[w]) / bottom if w in uni else unknown                                    # noqa: E731
    ctx = {}
    for u, f in pairs.items():
        b = sum(f.values()) + (not any(c <= katz.SMALL for c in f.values()))
        ctx[u] = b, (1 - sum(map(two, f.values())) / b) / (1 - sum(map(p1, f)))
        assert sum(two(f[w]) / b if w in f else ctx[u][1] * p1(w) for w in uni) + ctx[u][1] * unknown == pytest.approx(1)
    out = {}
    for i, t in toks.items():
        share = [p1(b) if a not in pairs else two(pairs[a][b]) / ctx[a][0] if b in pairs[a] else ctx[a][1] * p1(b)
                 for a, b in zip([0, *t], t)]
        base = [(uni[w] + 0.1) / (total + 0.1 * (len(uni) + 1)) for w in t]
        out[i] = (not learn(i), len(t), sum(w in uni for w in t), total, sum(map(math.log10, base)), sum(map(math.log10, share)))
    return out


@pytest.mark.parametrize("hot", [4, 256])
def test_katz_by_brute_force(spark, hot):
    rng = random.Random(hot)
    vocab = [f"W{j}" for j in range(60)]
    texts = [rng.choice([None, "", " A b ", " ".join(rng.choices(vocab, [1 / (j + 1) ** 1.2 for j in range(60)], k=rng.randint(1, 150))),
                         " ".join(["w1", "w2"] * rng.randint(1, 40) + [f"n{rng.randrange(500)}"] * 2)]) for _ in range(90)]
    learn = lambda i: zlib.crc32(str(i).encode()) % 10 != 0                                         # noqa: E731
    want = katz_by_hand(enumerate(texts), learn)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = katz.scored(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, chunk_bytes=2000, bucket_tokens=700,
                      hot_words=hot).collect()
    assert len(got) == len(texts)
    for r in got:
        held, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert (r.base_score, r.score) == (pytest.approx(base), pytest.approx(score))


def test_katz_odd_rows(spark, odd):
    got = katz.scored(odd, F.col("doc_id") != 4).collect()
    assert len(got) == 9 and sum(r.held_out for r in got) == 5          # those of id 4 and without an id
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 3, 3, 3, 302, 3001, 3001]
    assert katz.scored(odd.where("false"), F.lit(True)).collect() == []
    assert {(r.base_score, r.score) for r in katz.scored(odd, F.lit(None).cast("boolean")).collect()} == {(0.0, 0.0)}


def test_discounts_are_shares():
    for n in ([100, 40, 20, 12, 8, 6], [5, 9, 1, 7, 0, 0], [0] * 6, [3, 0, 0, 0, 0, 0], [1, 2, 3, 4, 5, 6]):
        d = katz.discounts(n)
        assert len(d) == katz.SMALL and (d > 0).all() and (d < 1).all()
    n = [100, 40, 20, 12, 8, 6]
    beyond = 6 * 6 / 100
    assert katz.discounts(n)[0] == pytest.approx((2 * 40 / 100 - beyond) / (1 - beyond))
    for a in (np.arange(5, dtype=np.int32), np.zeros(0), np.array([-1, 1 << 40])):
        assert katz.unpack(katz.pack(a), a.dtype).tolist() == a.tolist()


# whitening -----------------------------------------------------------------------------------------------------------

def test_whitening_by_numpy(spark):
    rng = np.random.default_rng(3)
    vec = (rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vec)] + [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] * 12),
                                                           (903, [float("inf")] * 12), (904, [1.0]), (905, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    got = whitening.whitened(table).toPandas()
    x = np.floor(1024 * vec.astype(float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    dev = ((n * x - total) ** 2).sum(1)
    assert len(got) == n * 8 and set(got.n) == {n} and got.identity_error.max() < 1e-9
    for k in range(8):
        mine = got[got.component == k + 1].sort_values("vec_id")
        want = centred @ vector[:, -1 - k] / np.sqrt(value[-1 - k])
        assert min(np.abs(mine.whitened - want).max(), np.abs(mine.whitened + want).max()) < 1e-9
        assert mine.explained.tolist() == pytest.approx([value[-1 - k] / value.sum()] * n)
        assert mine.deviation.tolist() == dev.tolist()


def test_whitening_odd_rows(spark):
    table = spark.createDataFrame([(6, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [3.0, 2.5]), (7, [1.0])], "vec_id int, embedding array<float>")
    got = whitening.whitened(table.withColumn("n", F.lit(1)).withColumn("index", F.lit(2))).collect()
    assert sorted(str(r.vec_id) for r in got) == ["6"] * 4 + ["None"] * 2
    assert {r.whitened for r in got if r.component == 2} == {0.0} and max(r.identity_error for r in got) < 1e-9
    assert whitening.whitened(table.where("false")).collect() == []
    one = whitening.whitened(table.where("vec_id = 7")).collect()
    assert [(r.whitened, r.explained, r.deviation) for r in one] == [(0.0, 0.0, 0)]


# periodic runs ---------------------------------------------------------------------------------------------------------

def runs_by_hand(w):
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and j > i:
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted((r for r in found if not any(p < r[2] and s <= r[0] and s + n >= r[0] + r[1] for s, n, p in found)),
                  key=lambda r: (r[0], r[2]))


def periodic_texts(rng, n):
    out = []
    for _ in range(n):
        w, size = [], rng.choice([1, 2, 3, 5, 50])
        for _ in range(rng.randint(0, 6)):
            block = [f"w{rng.randrange(size)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 20, 33, 40]))]
            kind = rng.random()
            w += (block * rng.randint(1, 8))[:rng.randint(1, 300)] if kind < 0.6 else block if kind < 0.8 else w[-rng.randint(1, 60):]
        out.append(" ".join(w))
    return out


def test_runs_by_brute_force(spark):
    texts = periodic_texts(random.Random(1), 600)
    for t, (w, got) in zip(texts, runs.text_runs([t.encode() for t in texts])):
        assert got == runs_by_hand(t.split())
    docs = spark.createDataFrame(list(enumerate(texts[:60])), "doc_id bigint, text string")
    for r in runs.periodic_runs(docs).collect():
        w = texts[r.doc_id].split()
        want = runs_by_hand(w)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w)
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_odd_rows_and_long_texts(spark, odd):
    got = runs.periodic_runs(odd).collect()
    assert sorted(r.n_words for r in got) == [0, 0, 0, 2, 2, 2, 301, 3000, 3000]
    assert sorted(r.collapsed for r in got)[:3] == ["", "", ""]
    assert runs.periodic_runs(odd.where("false")).collect() == []
    assert runs.text_runs([b"a " * 200_000])[0][1] == [(0, 200_000, 1)]
    assert runs.text_runs([b" ".join([*(f"x{i}".encode() for i in range(20_000))] * 4)])[0][1] == [(0, 80_000, 20_000)]


def test_planted_runs_are_found(spark):
    got = QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len({r.doc_id for r in got}) and any(r.n_runs for r in got)


# language identification -------------------------------------------------------------------------------------------------

def test_naive_bayes_by_hand(spark):
    rows = [(1, "the cat, the hat", "en"), (2, "der Hund 42 und", "de"), (3, "the end", "en"), (4, None, "de"), (5, "x", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))

    def grams(text):
        flat = "".join(c.lower() if c.isalpha() else " " for c in f" {text} ")
        while "  " in flat:
            flat = flat.replace("  ", " ")
        return [flat[i:i + n] for n in langid.ORDERS for i in range(len(flat) - n + 1) if n > 1 or flat[i] != " "]

    def bucket(g):
        x = len(g) * 0x27D4EB2F & 0xFFFFFFFF
        for c in g:
            x = (x ^ ord(c)) * 0x9E3779B1 & 0xFFFFFFFF
            x ^= x >> 15
        return (x * 0x85EBCA6B & 0xFFFFFFFF) >> 32 - langid.BUCKET_BITS

    counts = {lang: Counter(bucket(g) for _, t, l in rows if l == lang and t for g in grams(t)) for lang in ("de", "en")}
    for text in ("the hat", "und der", "Hund! 7", "zzz"):
        log = {}
        for lang, prior in (("de", 1 / 3), ("en", 2 / 3)):
            bottom = sum(counts[lang].values()) + langid.SMOOTHING * (1 << langid.BUCKET_BITS)
            log[lang] = math.log(prior) + sum(math.log((counts[lang][bucket(g)] + langid.SMOOTHING) / bottom) for g in grams(text))
        best = max(log, key=log.get)
        names, share = langid.score([text], model)
        assert names == [best] and share[0] == pytest.approx(1 / sum(math.exp(v - log[best]) for v in log.values()), rel=1e-4)


def test_pieces_give_the_same_ngrams():
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choices("ab é1 \n", k=rng.randint(0, 60)))
        whole = {n: sorted(b.tolist()) for n, (b, _) in zip(langid.ORDERS, langid.ngrams([text]))}
        parts = defaultdict(list)
        for n, b in langid.piecewise(text, langid.BUCKET_BITS, piece=rng.randint(1, 9)):
            parts[n] += b.tolist()
        assert {n: sorted(parts[n]) for n in langid.ORDERS} == whole


# rows that stand twice, plans --------------------------------------------------------------------------------------------

def test_repeated_rows_come_back_as_often(spark, tmp_path):
    text = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (1, text), (2, "b"), (None, text), (None, text)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, text)], "item_id bigint, text string")
    got = winnowing.contamination(docs, items).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in got) == [("1", 30)] * 3 + [("2", 0)] + [("None", 30)] * 2
    assert winnowing.contamination(docs.where("false"), items).collect() == []
    body = bytearray(b"x" * 5000)
    pages = spark.createDataFrame([(1, "u", body), (1, "u", body), (2, "u", body), (3, "u", bytearray(b"s")), (3, "u", bytearray(b"s")),
                                   (None, None, bytearray(b"t")), (None, None, bytearray(b"t"))], "page_id bigint, uri string, payload binary")
    for i, part in enumerate((pages, pages.where("false"))):
        warc.write_archives(warc.with_revisits(part), str(tmp_path / str(i)), segment=2048)
        told = warc.stored_pages(warc.reassembled(warc.read_records(spark, str(tmp_path / str(i))))).collect()
        assert sorted((str(r.page_id), r.type, r.payload_bytes, str(r.refers_to), r.valid) for r in told) == ([] if i else [
            ("1", "revisit", 5000, "2", True)] * 2 + [("2", "response", 5000, "None", True)] + [("3", "response", 1, "None", True)] * 2
            + [("None", "response", 1, "None", True)] * 2)


def test_outlier_rows_are_not_dealt_by_group(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 2 as string) as grp", *[f"rand({i}) as x{i}" for i in range(5)])
    params = quality.estimates(rows.limit(2000))
    near = quality._with_distance(rows, params, "inner").groupBy("grp", F.floor("d2")).count()
    near.collect()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


# the mix -----------------------------------------------------------------------------------------------------------------

def mix_by_hand(rows, weights=(3, 1, 2), share=1.5, most=2):
    """Copies of every row of ``mixing.sized``: targets, levels, ranks and cuts written out."""
    size: Counter = Counter()
    for r in rows:
        size[r.source] += r.size
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        level = (share * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * size[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: float(most * size[s]) for s in full}
        open_ -= full
    out = []
    for s in names:
        mine, level, full = [r for r in rows if r.source == s], 0.0, set()
        while True:
            left = target[s] - most * sum(r.size for i, r in enumerate(mine) if i in full)
            spread = sum(r.size * r.weight for i, r in enumerate(mine) if i not in full)
            level = left / spread if spread > 0 else math.inf
            more = {i for i, r in enumerate(mine) if r.weight > 0 and r.weight * level >= most}
            if more <= full:
                break
            full |= more
        if target[s] >= most * size[s]:
            level = math.inf
        drawn, taken = [], 0
        for r in mine:
            copies = min(float(most), level * r.weight) if r.weight > 0 else 0.0
            whole, rest = math.floor(copies), copies - math.floor(copies)
            taken += whole * r.size
            rank = None
            if rest > 0:
                odds = (r.u / (1 - r.u)) / (rest / (1 - rest))
                rank = math.floor(odds / (1 + odds) * (1 << mixing._RANK_BITS))
            drawn.append([r, whole, rank])
        upto, best, cut = 0, abs(target[s] - taken), -1
        for rank in sorted({d[2] for d in drawn if d[2] is not None and d[0].size > 0}):
            upto += sum(d[0].size for d in drawn if d[2] == rank)
            if abs(target[s] - taken - upto) < best:
                best, cut = abs(target[s] - taken - upto), rank
        out += [(r.doc_id, whole + (rank is not None and rank <= cut and r.size > 0)) for r, whole, rank in drawn]
    return sorted(out, key=str), target


@pytest.mark.parametrize("case", ["own weights", "given weights"])
def test_draw_by_brute_force(spark, case):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, 300, 2000])), rng.choice(["a", "a", "a", "b", "c", None]),
                                   rng.choice([0.0, 1.0, 5.0, 40.0, None])) for i in range(500)],
                                 "doc_id bigint, text string, source string, importance double").repartition(3)
    kw = {} if case == "own weights" else {"weight_col": "importance"}
    want, target = mix_by_hand(mixing.sized(docs, **kw).collect())
    got = mixing.mixed(docs, **kw).collect()
    assert sorted(((r.doc_id, r.copies) for r in got), key=str) == want
    assert {r.source: pytest.approx(r.target) for r in got} == target
    by_size = defaultdict(list)
    for r in got:
        by_size[r.source, r.size].append(r.copies)
    if case == "own weights":           # unequal chances: the long ones come more often
        assert np.mean(by_size["a", 2000]) > np.mean(by_size["a", 3])
