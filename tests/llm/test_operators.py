"""Corpus operators on small tables: odd rows, planted cases, brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.llm import (langid, licenses, lines, mixing, quality, repeats, secrets, simhash, warc,
                           winnowing)

LONG = " ".join(f"w{i}" for i in range(3000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key int, u int, runs int"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (4, "another text under the same id"), (None, "no id here"),
       (None, "no id here"), (5, "é" * 900), (6, "\n" * 700), (7, "123 456 !!!")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, None, None, 0.5, 1, 2, 3) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts, source="s", lang="en"):
    return spark.createDataFrame([(i, t, lang, source) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string")


ITEMS = "item_id bigint, text string"
OPERATORS = {
    "winnow": (lambda s, d: winnowing.contamination(d, s.createDataFrame([(1, "no id here"), (2, None), (None, "w1 w2")], ITEMS)), 9),
    "secrets": (lambda s, d: secrets.credential_spans(d), 11),
    "mix": (lambda s, d: mixing.mixed(d), 11),
    "licenses": (lambda s, d: licenses.license_matches(d), 0),
    "simhash": (lambda s, d: simhash.near_duplicates(d), 11),
    "lines": (lambda s, d: lines.deduplicated(d), 11),
    "language": (lambda s, d: langid.predict(d, langid.fit(d)), 11),
    "repeats": (lambda s, d: repeats.without_repeats(d), 11),
    "quality": (lambda s, d: quality.judged(d), 11),
    "keep_identified": (lambda s, d: langid.keep_identified(d), 0),
    "line_stage": (lambda s, d: lines.without_repeats(d), 11),
    "keep_one": (lambda s, d: simhash.keep_one(d), None),
    "decontaminated": (lambda s, d: winnowing.decontaminated(d, s.createDataFrame([(1, "no id here")], ITEMS)), 9),
    "mix_rows": (lambda s, d: mixing.mix_rows(d), None),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, none, name):
    run, n = OPERATORS[name]
    got = run(spark, odd).collect()
    assert n is None or len(got) == n
    assert run(spark, none).collect() == []


def test_empty_benchmark(spark, odd):
    got = winnowing.contamination(odd, spark.createDataFrame([], ITEMS)).collect()
    assert len(got) == 9 and all(r.n_hit == 0 for r in got)


def test_winnow_against_all_windows(spark):
    rng = random.Random(3)
    vocab = [f"t{i}" for i in range(30)] + ["漢1", "averyveryverylongwordindeed" * 2]
    items = [" ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 7, 9, 10, 11, 40]))) for _ in range(60)]
    texts = []
    for _ in range(60):
        w = rng.choices(vocab, k=rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            src = rng.choice(items).split()
            at = rng.randint(0, len(w))
            w[at:at] = src[rng.randint(0, 3):]
        texts.append(rng.choice([" ", ", ", "-"]).join(w).title())
    got = {r.doc_id: r for r in winnowing.contamination(
        docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), ITEMS)).collect()}
    for d, t in enumerate(texts):
        w = t.lower().replace(",", " ").replace("-", " ").split()
        hit, found = set(), set()
        for k, item in enumerate(items):
            b = item.split()
            n = min(10, len(b))
            wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in wins]
            hit |= {i + j for i in at for j in range(n)}
            found |= {str(k)} if at else set()
        assert (got[d].n_words, got[d].n_hit, set(got[d]["items"])) == (len(w), len(hit), found)


def test_weak_parts_need_company():
    key, token = "AKIA" + "A1B2C3D4E5F6G7H8", "abcdEFGH0123/+xyzABCDEFGH0123456789abcde"
    kinds = lambda t: [s.kind for s in secrets.find(t)]                                             # noqa: E731
    assert kinds(f"x {token} y") == []
    assert kinds(f"{key} and {token}") == ["access", "secret"]
    assert kinds(f"{key}\n\n{token}") == ["access"]                         # another scope
    assert kinds(f"{key} {'x ' * 300}{token}") == ["access"]                # too far
    assert kinds("see https://host.example.org/a") == []
    assert kinds(f"{key} {token} at https://host.example.org/a") == ["access", "secret", "endpoint"]
    assert kinds("user = alice password: hunter22") == ["ident", "assign"]
    assert kinds("user = alice") == []
    assert secrets.find(f"é {key}")[0][:3] == ("access", 2, 2 + len(key))


def test_license_windows(spark):
    filler = " ".join(f"x{i}" for i in range(200))
    full = dict(licenses.TEMPLATES)["GPL-3.0"]
    texts = [f"{filler} {t} {filler}" for _, t in licenses.TEMPLATES] + [filler, full.replace("Free", "Gratis"), full[:120]]
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(docs_of(spark, texts)).collect()}
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        assert got[i, name] == 1.0
    n = len(licenses.TEMPLATES)
    assert 0.8 <= got[n + 1, "GPL-3.0"] < 1 and not {k for k in got if k[0] in (n, n + 2)}


def test_band_settings_guarantee():
    for m in range(1, 200):
        w = 2 << licenses.size_class(m)
        j = 0.8 * m / (w + 0.2 * m)
        assert 1 - (1 - j) ** licenses.BANDS > 0.999998
    needles, alone = licenses.meeting_words({s for _, t in licenses.TEMPLATES for s in licenses.template_shingles(t)})
    for _, t in licenses.TEMPLATES:
        assert all(s in alone or set(s.split()) & set(needles) for s in licenses.template_shingles(t))


def test_bk_trees_find_all_links():
    rng = np.random.default_rng(5)
    seeds = rng.integers(-2**62, 2**62, 40)
    flips = np.array([sum(1 << b for b in rng.choice(63, rng.integers(0, 4), False)) for _ in range(1500)])
    fp = np.unique(seeds[rng.integers(0, 40, 1500)] ^ flips)
    shard = np.sort(rng.integers(0, 5, len(fp)))
    got = {(a, b) for q, n in simhash.BKForest(shard, fp).within(3) for a, b in zip(q.tolist(), n.tolist())}
    want = {(i, j) for i in range(len(fp)) for j in range(i)
            if shard[i] == shard[j] and int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert got == want
    a, b = simhash.spanning_links(shard, fp, 3)
    up = {x: x for x in range(len(fp))}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in want:
        up[top(i)] = top(j)
    groups = len({top(x) for x in up})
    assert len(a) == len(fp) - groups


def test_one_of_each_group_stays(spark, odd, none):
    got = simhash.keep_one(odd).collect()
    assert sorted(str(r.text)[:20] for r in got) == sorted(
        str(t)[:20] for t in (None, "another text under the same id", "no id here", "é" * 900, LONG, "123 456 !!!"))
    assert {r.text: r.doc_id for r in got}[None] == 1 and got[0].__fields__ == odd.columns
    assert simhash.keep_one(none).collect() == []
    pair = spark.createDataFrame([(None, LONG), (None, LONG + " end"), (9, LONG + " fin"), (9, "not a copy")],
                                 "doc_id bigint, text string")
    assert sorted(r.text[:12] for r in simhash.keep_one(pair).collect()) == sorted([LONG[:12], "not a copy"])
    assert all(r.doc_id == 9 for r in simhash.keep_one(pair).collect())


def test_lines_keep_the_first(spark):
    block = "one\ntwo\nthree\nfour"
    texts = [f"a\n{block}\nz", f"{block}\nb", "c\ntwo\nthree", f"q\n{block}\n{block}", "\n\n\n\n\n"]
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in lines.deduplicated(docs_of(spark, texts)).collect()}
    assert got[0] == (texts[0], 0, 0) and got[1] == ("b", 4, 1) and got[2] == (texts[2], 0, 0)
    assert got[3] == ("q", 8, 1) and got[4] == (texts[4], 0, 0)


def test_language_fit_is_bounded(spark):
    texts = ["the cat and the hat " * 5, "der hund und die katze " * 5] * 40
    docs = spark.createDataFrame([(i, t, ("en", "de")[i % 2]) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string")
    model = langid.fit(docs, sample=10)
    names, shares = langid.score(["the hat", "und die", "", "42", None], model)
    assert names == ["en", "de", "und", "und", "und"] and shares[2:].tolist() == [0, 0, 0]
    assert model.log_prob.shape == (1 << langid.BUCKET_BITS, 2)
    long = "the cat " * 300_000
    assert langid._score_long(long, model)[0] == langid.score([long], model)[0][0] == "en"


def test_interval_expansion_gives_common_prefixes():
    rng = random.Random(9)
    for _ in range(200):
        length, letters = rng.choice([2, 3, 7, 15]), rng.sample(range(256), rng.choice([1, 2, 4]))
        parts = [bytes(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        parts += [parts[0][:20], parts[0][3:]]
        text = np.array([c + 1 for p in parts for c in [*p, -1]], np.int16)
        order = repeats.suffix_order(text, length)
        got = repeats.unreached(text, order, length)
        for i in range(1, len(text)):
            a, b = (text[k:k + length].tolist() for k in (order[i - 1], order[i]))
            if 0 not in a and 0 not in b:
                assert got[i] == (a == b and len(a) == length)


def test_equal_windows_share_an_anchor():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 300))) for _ in range(8)]
    texts += [texts[0][20:150], b"a" * 130, b"ab" * 80]
    of, at, first, last, h = repeats.text_anchors(texts, 40, 12)
    assert Counter((o, i) for o, a, b in zip(of.tolist(), first.tolist(), last.tolist()) for i in range(a, b + 1)) == Counter(
        (o, i) for o, t in enumerate(texts) for i in range(len(t) - 39))         # every window has one anchor
    known = dict(zip(zip(of.tolist(), at.tolist()), h.tolist()))
    places: dict = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - 39):
            places.setdefault(t[j:j + 40], []).append((i, j))
    for where in places.values():
        assert set.intersection(*[{(known[i, p], p - j) for p in range(j, j + 29) if (i, p) in known} for i, j in where])


def test_repeats_by_brute_force(spark):
    rng = random.Random(4)
    base = [bytes(rng.choices(b"abcd ", k=rng.randint(0, 900))).decode() for _ in range(25)]
    texts = base + [base[0], base[1] + base[2], base[3][5:300] + base[4][:200] + base[3][5:300], "xy" * 400, "e" * 60, None]
    length, raw = 50, [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    got = {r.doc_id: r for r in repeats.without_repeats(docs_of(spark, texts), length=length, gram=20).collect()}
    for d, b in enumerate(raw):
        gone = {i + k for i in range(len(b) - length + 1) if seen[b[i:i + length]] > 1 for k in range(length)}
        kept = bytes(c for i, c in enumerate(b) if i not in gone)
        assert (got[d].n_bytes, got[d].n_removed) == (len(b), len(gone))
        assert got[d].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert got[d].n_spans == sum(i in gone and i - 1 not in gone for i in range(len(b)))


def _surrounded(n):
    """One passage in many surroundings, some of which begin or end alike; copies of one; an unlike text."""
    rng = random.Random(5)
    make = lambda k: "".join(rng.choices("abcdefgh ", k=k))                                         # noqa: E731
    passage, ends = make(150), [make(30) for _ in range(5)]
    texts = [make(60) + rng.choice(ends)[rng.randint(0, 29):] + passage + rng.choice(ends)[:rng.randint(0, 30)] + make(60) for _ in range(n)]
    return texts + [texts[0], texts[0], texts[1][5:200], passage, passage[20:] + passage, make(300)]


def test_slices_of_hot_anchors_meet_in_parts(spark, monkeypatch):
    length, gram, hot = 60, 20, 8
    texts, kept = _surrounded(80), []
    monkeypatch.setattr(repeats, "dealt", lambda *a, _old=repeats.dealt: kept.extend(_old(*a)) or kept)
    got = {r.doc_id: r for r in repeats.without_repeats(docs_of(spark, texts), length=length, gram=gram, hot=hot).collect()}
    raw = [t.encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    for d, b in enumerate(raw):
        gone = {i + k for i in range(len(b) - length + 1) if seen[b[i:i + length]] > 1 for k in range(length)}
        assert (got[d].n_bytes, got[d].n_removed) == (len(b), len(gone))
        assert got[d].kept_sha256 == hashlib.sha256(bytes(c for i, c in enumerate(b) if i not in gone)).hexdigest()
        assert got[d].n_spans == sum(i in gone and i - 1 not in gone for i in range(len(b)))
    meet = lambda slices: max(r.n for r in slices.groupBy("h").agg(F.count_distinct("slice_id").alias("n")).collect())
    assert len(kept) > 1 and max(meet(slices) for _, slices in kept) <= hot
    assert meet(kept[0][0]) > 4 * hot


def test_parts_of_slices_hold_every_window_once():
    rng = random.Random(8)
    for length, gram in ((60, 20), (20, 19), (9, 9), (400, 128)):
        widths = repeats.part_widths(length, gram)
        assert widths == sorted(set(widths), reverse=True) and (widths[-1:] or [1]) == [1]
        for text in [bytes(rng.choices(b"ab", k=length + rng.randint(0, 300))), b"a" * (length + 40)]:
            for at, first, last in zip(*(x.tolist() for x in repeats.text_anchors([text], length, gram)[1:4])):
                part = text[first:last + length]
                assert repeats.text_anchors([part], length, gram)[1].tolist() == [at - first]
                for width in widths:
                    windows: list = []
                    for c, lo, sub, common in repeats.slice_parts(part, at - first, width, length):
                        places = range(lo, lo + len(sub) - length + 1)
                        windows += places
                        assert sub == part[lo:lo + len(sub)] and len(common) == length - width + 1
                        for w in places:
                            begin = (at - first) - c * width - w
                            assert (at - first - w) // width == c and part[w:w + length][begin:begin + len(common)] == common
                    assert sorted(windows) == list(range(last - first + 1))


def test_long_text_goes_by_pieces():
    data = bytes(random.Random(1).choices(range(256), k=300_000)) * 8
    pieces = repeats.text_anchors([data])
    assert len(data) > 2 * repeats._PIECE
    whole = repeats.anchors(np.frombuffer(data, np.uint8), np.array([len(data)]))
    assert [x.tolist() for x in pieces[1:]] == [x.tolist() for x in whole]


def test_outliers(spark):
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(4000)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(80, 400))) for _ in range(400)]
    bad = [" ".join(w + "$$$###" for w in rng.choices(vocab, k=200)) for _ in range(12)]
    got = {r.doc_id: r for r in quality.judged(docs_of(spark, texts + bad)).collect()}
    assert all(got[i].kept for i in range(400)) and not any(got[400 + i].kept for i in range(12))
    few = quality.judged(docs_of(spark, texts[:30] + bad[:1])).collect()      # too few to judge: base rules only
    assert all(r.kept and r.d2 is None for r in few)


def test_moderate_outliers_in_each_feature(spark):
    """A group without symbols, repeated lines or repeated windows rejects what is plainly apart in any one feature."""
    rng = random.Random(16)
    vocab = [f"{c}{i:05d}" for i in range(4000) for c in "ab"]
    words = lambda n: rng.sample(vocab, n)                                                          # noqa: E731
    texts = [" ".join(words(round(200 * 2 ** rng.uniform(-0.5, 0.5)))) for _ in range(300)]
    slight = [" ".join(words(200)) + " ###", " ".join(words(200)) + "\na b\na b", " ".join([*(w := words(200)), *w[:3]])]
    lines = [f"{a}\n{a}" for a in words(25)]
    apart = [" ".join(words(4000)), " ".join(w * 2 for w in words(200)),
             " ".join(w + "#" * (i % 2) for i, w in enumerate(words(200))),
             "\n".join([*lines, *words(150)]), " ".join([*(w := words(160)), *w[:40]])]
    got = {r.doc_id: r for r in quality.judged(docs_of(spark, texts + slight + apart)).collect()}
    assert all(got[i].kept for i in range(303))
    assert not any(got[i].base_failed for i in range(308))
    for i, feature in enumerate(("words", "word length", "symbols", "lines", "windows")):
        assert not got[303 + i].kept, (feature, got[303 + i])


def test_floor_is_no_addition():
    wide = np.diag(np.square([2 * f for f in quality.FLOORS]))
    row = quality._parameters("g", 1, np.zeros(5), wide).iloc[0]
    assert [row[f"v{i}{i}"] for i in range(5)] == pytest.approx([1 / wide[i, i] for i in range(5)])
    flat = quality._parameters("g", 1, np.zeros(5), np.zeros((5, 5))).iloc[0]
    assert [flat[f"v{i}{i}"] for i in range(5)] == pytest.approx([f ** -2 for f in quality.FLOORS])


def test_chi_square():
    assert quality.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi2_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)


def test_mix_weights(spark):
    docs = docs_of(spark, [" ".join(["w"] * (1 + i % 9)) for i in range(2000)]).withColumn(
        "weight", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    got = mixing.mixed(docs, weight_col="weight", share=0.5).collect()
    total, target = sum(r.taken for r in got), got[0].target
    assert abs(total - target) <= 9
    even, odd = (sum(r.copies for r in got if r.doc_id % 2 == k) for k in (0, 1))
    assert 2.6 < even / odd < 3.4


# archives --------------------------------------------------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(8)
    bodies = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 10, 999, 1000, 5000, 70_000)]
    bodies += [b"x" + warc._MARK + b"1\r\nContent-Length: 3\r\n\r\nabc" * 400, warc._MARK * 9]
    pages = [(i, f"http://h/{i}", bytearray(b)) for i, b in enumerate(bodies + [bodies[4], bodies[4], bodies[2]])]
    pages.append((None, None, bytearray(b"no id")))
    frame = spark.createDataFrame(pages, "page_id bigint, uri string, payload binary").repartition(3)
    warc.write_archives(warc.with_revisits(frame), str(tmp_path / "a"), segment=4096)
    records = warc.read_records(spark, str(tmp_path / "a"))
    assert records.where("origin is not null").count() > 10 and records.where("not complete").count() == 0
    whole = warc.reassembled(records)
    got = {r.page_id: r for r in warc.payloads(whole).collect()}
    assert all(r.valid for r in got.values())
    for i, uri, b in pages:
        r = got[None if i is None else str(i)]
        assert r.uri == uri and (r.type == "revisit" or bytes(r.payload) == bytes(b))
    assert {i for i, r in got.items() if r.type == "revisit"} == {"4", "8"}
    told = {r.page_id: r for r in warc.stored_pages(whole).collect()}
    assert (told["4"].refers_to, told["4"].payload_bytes, told["4"].valid) == ("9", 5000, True)
    assert told["4"].payload_digest == hashlib.sha1(bodies[4]).hexdigest()


def test_broken_segments_are_told(spark):
    row = ("response", "<a>", "u", None, None, None, "7", 1, None, True, bytearray(b"ab"))
    more = ("continuation", "<b>", None, None, None, "<a>", None, 2, 5, True, bytearray(b"cde"))
    lost = ("continuation", "<c>", None, None, None, "<gone>", None, 2, 9, True, bytearray(b"x"))
    schema = ("type string, record_id string, uri string, refers_to string, payload_digest string, origin string, "
              "page_id string, segment bigint, total bigint, complete boolean, block binary")

    def read(*rows):
        return {r.record_id: (bytes(r.block), r.complete)
                for r in warc.reassembled(spark.createDataFrame(rows, schema)).collect()}

    assert read(row, more) == {"<a>": (b"abcde", True)}
    assert read(more, row, lost) == {"<a>": (b"abcde", True), None: (b"x", False)}
    assert read(row)["<a>"][1] is False
    assert read(row, more[:8] + (6,) + more[9:])["<a>"][1] is False        # another total length
    assert read(row, more[:7] + (3, 5) + more[9:])["<a>"][1] is False      # a number is missing


def test_chunked_framing():
    body = bytes(range(256)) * 50
    assert warc.unchunked(warc.chunked(body, 100)) == body and warc.unchunked(warc.chunked(b"")) == b""
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    assert warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n") is None and warc.unchunked(b"zz\r\n") is None
    assert warc._bare(warc.digest(b"q")) == hashlib.sha1(b"q").hexdigest()


def test_versions_and_families_are_told_apart(spark):
    filler = " ".join(f"x{i}" for i in range(60))
    by_name = dict(licenses.TEMPLATES)
    families = [n for n in by_name if n.startswith(("GPL", "LGPL", "AGPL", "CC-", "MPL", "EPL", "Apache-2", "MIT", "ISC", "0BSD", "BSL"))]
    texts = [f"{filler} {by_name[n]} {filler}" for n in families] + [
        f"{filler} {by_name['GPL-2.0-notice']} {by_name['MIT-notice']} {filler}", f"{by_name['GPL-2.0']} {filler} {by_name['GPL-3.0']}"]
    got: dict = {}
    for r in licenses.license_matches(docs_of(spark, texts)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    contained = {"Apache-2.0": {"Apache-2.0", "Apache-2.0-notice"}}         # the long notice begins with the short one
    for i, n in enumerate(families):
        assert got[i] == contained.get(n, {n}), n
    assert got[len(families)] == {"GPL-2.0-notice", "MIT-notice"} and got[len(families) + 1] == {"GPL-2.0", "GPL-3.0"}


def test_language_stage_sends_each_text_once(spark):
    texts = ["the cat and the dog are here", "der Hund und die Katze sind hier", None, "123"]
    docs = spark.createDataFrame([(i, t, l, "s") for i, (t, l) in enumerate(zip(texts, ["en", "de", None, "en"]))],
                                 "doc_id bigint, Text string, lang string, source string")
    sent = langid.keep_identified(docs, 0.0)
    assert sorted(tuple(r) for r in sent.collect()) == [(0, texts[0], "en", "s"), (1, texts[1], "de", "s")]
    assert "_text" not in sent._jdf.queryExecution().optimizedPlan().toString()
