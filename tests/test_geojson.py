"""FeatureCollections read in ranges and written as one document."""

import io
import json
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmart.sources import files, geojson
from gridmart.sources.geojson import BrokenGeoJson

TRICKY = ['a "quoted" \\ name', "back\\\\slash\\", "{[,:]}", 'features":[{', "日本語 é", "tab\tline\n", "", "\\\"", 'type":"x']


def feature(r):
    kind = r.randrange(4)
    xy = [round(r.uniform(-180, 180), r.randrange(9)), r.randrange(-90, 90)]
    geometry = [{"type": "Point", "coordinates": xy}, {"type": "LineString", "coordinates": [xy] * r.randrange(5)}, None,
                {"type": "Polygon", "coordinates": [[xy, xy], [xy]], "features": [{"type": "x"}]}][kind]
    props = {r.choice(TRICKY) or "k": r.choice([None, 1, 2.5, True, r.choice(TRICKY), {"a": {"features": [{"b": [1, {"c": 2}]}]}}, [1, [2]]])
             for _ in range(r.randrange(5))}
    return {"type": "Feature", "properties": r.choice([None, props, props]), "geometry": geometry}


def document(seed, n=60):
    r = random.Random(seed)
    feats = [feature(r) for _ in range(n)]
    members = [("type", "FeatureCollection"), ("name", r.choice(TRICKY)), ("crs", {"type": "name", "properties": {"features": [{"x": 1}]}}),
               ("bbox", [1, 2, 3]), ("others", [{"type": "Feature", "no": 1}, {"type": "Feature", "no": 2}]), ("features", feats),
               ("after", [{"features": [{"no": 3}]}])]
    r.shuffle(members)
    text = json.dumps(dict(members), indent=r.choice([None, None, 2]), ensure_ascii=r.random() < 0.5,
                      separators=r.choice([(",", ":"), (" , ", " : ")]))
    return text, feats


def extracted(data: bytes, length: int):
    """The three passes without Spark."""
    file, size, rows = io.BytesIO(data), len(data), []
    for number in range(max(1, -(-size // length))):
        begin, end = geojson._bounds(file, number, length, size)
        block = geojson._read(file, begin, end)
        told = [json.dumps(geojson.summary(block, inside, geojson._quotes(block), begin == 0)) for inside in (False, True)]
        rows.append({"path": "p", "number": number, "begin": begin, "end": end, "size": size, "outside": told[0], "inside": told[1]})
    random.Random(1).shuffle(rows)
    return [t for begun in geojson.chain(rows) for t in geojson.features_of(file, *begun[1:])]


@pytest.mark.parametrize("length", [1, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("seed", range(6))
def test_ranges_of_any_length(seed, length, monkeypatch):
    monkeypatch.setattr(geojson, "READ_ON", 50)
    text, feats = document(seed)
    got = extracted(text.encode(), length)
    assert [json.loads(t) for _, t in got] == feats
    assert all(text.encode()[at: at + len(t)] == t for at, t in got)


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text(alphabet='a"\\{}[],:é\n', max_size=6),
                    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(alphabet='af"\\{},:', max_size=4), x, max_size=3), max_leaves=8),
       st.integers(1, 60))
def test_any_properties(value, length):
    feats = [{"type": "Feature", "properties": {"v": value}}] * 3
    got = extracted(json.dumps({"features": feats, "type": "FeatureCollection", "x": value}).encode(), length)
    assert [json.loads(t) for _, t in got] == feats


@pytest.mark.parametrize("length", [5, 40, 1 << 20])
def test_cut_documents_are_told(length):
    text = document(3, n=4)[0].encode().rstrip()
    for cut in range(0, len(text), 13):
        with pytest.raises(BrokenGeoJson):
            extracted(text[:cut], length)


@pytest.mark.parametrize("text", ['{"type":"Topology","features":[]}', '{"type":"FeatureCollection"}', "[]", "", "{}", '{"a":1}}',
                                  '{"type":"FeatureCollection","features":{"a":{"b":1}}}', '{"features":[],"x":{"type":"FeatureCollection"}}'])
def test_other_documents_are_told(text):
    with pytest.raises(BrokenGeoJson):
        extracted(text.encode(), 8)


def test_byte_order_mark_and_no_features():
    assert extracted(b"\xef\xbb\xbf" + b'{"type":"FeatureCollection","features":[{"a":1}]}', 10) == [(43, b'{"a":1}')]
    assert extracted(b' {"features" : [ ] ,\n"type" : "FeatureCollection"} \n', 4) == []


def test_escapes():
    block = np.frombuffer(b'"a\\"b" "\\\\" "\\\\\\""', np.uint8)
    assert geojson._quotes(block).tolist() == [0, 5, 7, 10, 12, 17]


def rows(df):
    """Line ends between a geometry's tokens are spaces when they come from a range."""
    flat = [((sorted(r["properties"].items()) if r["properties"] else None), r["geometry_type"], r["geometry_wkt"]) for r in df.collect()]
    return sorted((tuple(json.loads(json.dumps(x).replace("\\n", " ")) for x in f) for f in flat), key=repr)


def test_rows_equal_the_whole_document_reader(spark, tmpdir_path):
    for seed in range(3):
        path = os.path.join(tmpdir_path, f"{seed}.geojson")
        with open(path, "w") as out:
            out.write(document(seed, 200)[0])
        whole = files.explode_features(files._geojson_records(spark, path, False))
        df = files.read_geojson(spark, path, length=1000)
        assert rows(df) == rows(whole)
        assert geojson.read_features(spark, path, 1000).rdd.getNumPartitions() > 4   # many tasks read the one document


def test_several_documents_and_a_broken_one(spark, tmpdir_path):
    want = 0
    for seed in range(3):
        text, feats = document(seed, 20)
        want += len(feats)
        with open(os.path.join(tmpdir_path, f"{seed}.geojson"), "w") as out:
            out.write(text)
    assert files.read_geojson(spark, tmpdir_path, length=500).count() == want
    with open(os.path.join(tmpdir_path, "cut.geojson"), "w") as out:
        out.write(document(5)[0][:-30])
    with pytest.raises(BrokenGeoJson):
        files.read_geojson(spark, tmpdir_path, length=500)


def test_a_broken_feature_is_told(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "b.geojson")
    with open(path, "w") as out:
        out.write('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a" 1}},{"type":"Feature"}]}')
    with pytest.raises(BrokenGeoJson):
        files.read_geojson(spark, path)


def test_compressed_documents(spark, tmpdir_path):
    import gzip
    text, feats = document(2, 30)
    path = os.path.join(tmpdir_path, "c.geojson.gz")
    with gzip.open(path, "wt") as out:
        out.write(text)
    assert files.read_geojson(spark, path).count() == len(feats)


def test_a_large_document_in_bounded_blocks(spark, tmpdir_path):
    """60 MB, one feature of which is 3 MB: no block is longer than a range and a feature."""
    path, n = os.path.join(tmpdir_path, "large.geojson"), 200_000
    with open(path, "w") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for i in range(n):
            coordinates = [[i, i + 0.5]] * (150_000 if i == 77_777 else 8)
            out.write(("," if i else "") + json.dumps({"type": "Feature", "properties": {"i": i, "text": "x" * 150},
                                                       "geometry": {"type": "LineString", "coordinates": coordinates}}))
        out.write("]}")
    df = files.read_geojson(spark, path, length=2 << 20)
    assert geojson.list_ranges(spark, path, 2 << 20).rdd.getNumPartitions() >= 20
    got = df.selectExpr("count(*)", "sum(int(properties['i']))", "max(length(geometry_wkt))").first()
    assert got[0] == n and got[1] == n * (n - 1) // 2 and got[2] > 1_500_000


@pytest.mark.parametrize("n", [0, 1, 500])
def test_one_document_is_written(spark, tmpdir_path, n):
    path = os.path.join(tmpdir_path, "out.geojson")
    r = random.Random(7)
    feats = [json.dumps({**feature(r), "n": i}) for i in range(n)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(feats)], "i int, feature string").repartition(7)
    files.write_geojson(df, path, document=True, order=["i"])
    files.write_geojson(df, path, document=True, order=["i"])          # replaces it
    with open(path) as f:
        doc = json.load(f)
    assert doc["type"] == "FeatureCollection" and [json.dumps(x) for x in doc["features"]] == feats
    assert [f for f in os.listdir(tmpdir_path) if not f.startswith(".")] == ["out.geojson"]
    if n:
        assert files.read_geojson(spark, path, length=100).count() == n
