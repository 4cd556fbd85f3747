"""Documents read by byte ranges equal the whole parse, wherever the ranges are cut."""

import json
import random

import pytest

from stormgrid.sources import geojson


def _value(rng, depth=0):
    pick = rng.random()
    if pick < 0.4:
        return "".join(rng.choices('ab"\\\\{}[]:, \n\té漢"features":[', k=rng.randint(0, 12)))
    if pick < 0.6 or depth > 2:
        return rng.choice([1, -2.5e3, None, True])
    if pick < 0.8:
        return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["features", "type", 'a"b', "k\\"]): _value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def _document(rng, layout):
    feats = [{"type": "Feature", "properties": {"p": _value(rng), "features": [{"x": [1]}]}, "geometry": rng.choice(
        [None, {"type": "Point", "coordinates": [1, 2]}])} for _ in range(rng.randint(1, 9))]
    if layout == "lines":
        return feats, "\n".join(json.dumps(f) for f in feats)
    doc = {"meta": rng.choice([_value(rng), [{"a": 1}, {"b": [2]}]]), "type": "FeatureCollection", "features": feats,
           "bbox": rng.choice([[1, 2], [{"q": 1}]])}
    text = json.dumps(doc, indent=2 if layout == "pretty" else None, ensure_ascii=False)
    if layout == "feature a line":
        text = text.replace('}, {"type": "Feature"', '},\r\n{"type": "Feature"')
    return feats, ("\ufeff" if layout == "mark" else "") + text + "\n"


@pytest.mark.parametrize("block", [23, 400])
def test_any_layout_at_any_cut(spark, tmp_path, block):
    rng, want = random.Random(block), {}
    for i, layout in enumerate(["one line", "pretty", "feature a line", "lines", "mark"] * 2):
        feats, text = _document(rng, layout)
        (tmp_path / f"{i} %41.json").write_bytes(text.encode())
        want[f"{i} %41.json"] = feats
    (tmp_path / "cut.json").write_text('{"features":[{"a":1},{"b":')
    (tmp_path / "string.json").write_text('{"features":[{"a":"x]}')
    (tmp_path / "more.json").write_text('{"a":1}}')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n ")
    got: dict = {}
    for r in geojson.read_geojson(spark, str(tmp_path), block=block).sort("file_path", "position").collect():
        got.setdefault(r.file_path.rsplit("/", 1)[1], []).append(json.loads(r.body))
    assert got == want


def test_blocks_go_to_tasks_of_their_own(spark, tmp_path):
    feat = '{"type":"Feature","properties":{"n":%d},"geometry":null}'
    (tmp_path / "a.json").write_text('{"type":"FeatureCollection","features":[' + ",".join(feat % i for i in range(20_000)) + "]}")
    blocks = geojson.layout(spark, geojson.list_files(spark, str(tmp_path)), 1 << 16)
    found = geojson.features(blocks)
    assert found.rdd.getNumPartitions() == blocks.count() > 15
    assert found.selectExpr("count(*)", "count(distinct position)", "max(length(body))").first()[:] == (20_000, 20_000, 59)


def test_escapes_over_a_cut():
    for n in range(6):
        text = b'{"a":"x' + b"\\" * n + b'","b":[1]}'
        whole = geojson.marks(text)
        for cut in range(1, len(text)):
            slashes = len(text[:cut]) - len(text[:cut].rstrip(b"\\"))
            left, right = geojson.marks(text[:cut]), geojson.marks(text[cut:], slashes)
            assert [*left[0], *(right[0] + cut)] == whole[0].tolist()
            assert left[2][-1] + right[2][-1] == whole[2][-1]
