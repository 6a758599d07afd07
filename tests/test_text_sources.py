from __future__ import annotations

import json
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureframe import describe_layers, read_vector_files
from featureframe.functions.coordinates import geojson_wkb, gml_wkb
from featureframe.sources import geojson, gml, records
from tests import geometries


def feature(i: int, **properties) -> dict:
    geometry = {"type": "Point", "coordinates": [i, -i]} if i % 5 else None
    return {"type": "Feature", "properties": {"id": i, **properties}, "geometry": geometry}


def read(spark, folder, **arguments):
    return read_vector_files(str(folder), spark=spark, **arguments)


FEATURES = [feature(i, name=f'a "quoted" {{"type":"Feature", {i}', value=i / 4) for i in range(300)]


def document(features, indent=None, separators=None, **members) -> str:
    return json.dumps({"type": "FeatureCollection", **members, "features": features}, indent=indent, separators=separators)


LAYOUTS = {
    "compact": document(FEATURES, separators=(",", ":")),
    "spaced": document(FEATURES),
    "pretty": document(FEATURES, indent=2),
    "per line": '{"type": "FeatureCollection", "features": [\n' + ",\n".join(map(json.dumps, FEATURES)) + "\n]}",
    "sequence": "\n".join(map(json.dumps, FEATURES)) + "\n",
    "other order per line": "\n".join(json.dumps(dict(reversed(f.items()))) for f in FEATURES),
    "id before": document([{"id": f"{{{f['properties']['id']}", **f} for f in FEATURES]),
    "id before, compact": document([{"id": 7, "bbox": [1, 2], **f} for f in FEATURES], separators=(",", ":")),
    "sorted": json.dumps(json.loads(document(FEATURES)), sort_keys=True),
    "sorted, pretty": json.dumps(json.loads(document(FEATURES, name="a")), sort_keys=True, indent=1),
    "type in the middle": document([{"geometry": f["geometry"], "type": "Feature", "properties": f["properties"]} for f in FEATURES]),
    "other order": document([dict(reversed(f.items())) for f in FEATURES], indent=1),
    "members after": document(FEATURES)[:-1] + ', "crs": {"type": "name", "properties": {"name": "EPSG:27700"}}}',
}


LAYOUTS["record separators"] = "".join(f"\x1e{json.dumps(item)}\n" for item in FEATURES)
LAYOUTS["byte order mark"] = "\ufeff" + LAYOUTS["sequence"]
LAYOUTS["type first in properties"] = document(
    [{"type": "Feature", "properties": {"type": "Feature", **f["properties"]}, "geometry": f["geometry"]} for f in FEATURES]
)
LAYOUTS["differing order"] = document([dict(reversed(f.items())) if i % 2 else f for i, f in enumerate(FEATURES)])
LAYOUTS["mixed white space"] = document(FEATURES).replace('}, {"type": "Feature"', '}\t,\n\n {"type" :"Feature"', 7)
LAYOUTS["long first line"] = json.dumps({"id": "x" * (1 << 17), **FEATURES[0]}) + "\n" + "\n".join(map(json.dumps, FEATURES[1:]))
LAYOUTS["long head"] = document(FEATURES, crs={"note": "{[" + "x" * (1 << 17)}, n=1)
LAYOUTS["backslashes"] = document([{"note": "\\" * (i % 7) + '"', **f} for i, f in enumerate(FEATURES)])


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("split_bytes", [128 << 20, 1000])
@pytest.mark.parametrize("block_bytes", [8 << 20, 37])
def test_geojson_layouts_and_splits(spark, tmp_path, monkeypatch, layout, split_bytes, block_bytes):
    if block_bytes == 37:  # in this process, where blocks can be made small
        monkeypatch.setattr(records, "BLOCK_BYTES", block_bytes)
        path = str(tmp_path / "a.geojson")
        (tmp_path / "a.geojson").write_text(LAYOUTS[layout])
        key = geojson.locate(path, None).key
        ranges = records.plan(geojson, path, key, split_bytes)
        found = [json.loads(text) for start, stop in ranges for text in geojson.features(path, key, start, stop)]
        assert [(f["properties"]["id"], f["geometry"]) for f in found] == [
            (f["properties"]["id"], f["geometry"]) for f in FEATURES
        ]
        assert geojson.layers(path)[0][1] == 300
        return
    (tmp_path / "a.geojson").write_text(LAYOUTS[layout])
    df = read(spark, tmp_path, suffix="geojson", split_bytes=split_bytes)
    rows = sorted(map(tuple, df.select("id", "name", "value", "geometry").collect()))
    expected = []
    for i, item in enumerate(FEATURES):
        point = bytearray(struct.pack("<BIdd", 1, 1, i, -i)) if i % 5 else None
        expected.append((i, item["properties"]["name"], i / 4, point))
    assert rows == expected


def test_small_splits_really_split(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(LAYOUTS["compact"])
    assert read(spark, tmp_path, suffix="geojson", split_bytes=1000).rdd.getNumPartitions() > 10


@pytest.mark.parametrize(
    "text",
    [
        document(FEATURES[:3])[:-40],
        document(FEATURES[:3]).replace('"geometry"', '"geometry":', 1),
        "\n".join(map(json.dumps, FEATURES[:3])) + "\nnonsense",
    ],
)
def test_malformed_features_are_errors(spark, tmp_path, text):
    (tmp_path / "a.geojson").write_text(text)
    with pytest.raises(Exception, match="a.geojson"):
        read(spark, tmp_path, suffix="geojson", schema=StructType().add("id", "long")).collect()


def test_geojson_files_with_differing_properties_need_coercion(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(document([{"type": "Feature", "properties": {"id": 1}, "geometry": None}]))
    for other in ({"ident": 2}, {"id": "x"}):
        (tmp_path / "b.geojson").write_text(document([{"type": "Feature", "properties": other, "geometry": None}]))
        with pytest.raises(Exception, match="coerce_to_schema"):
            read(spark, tmp_path, suffix="geojson").collect()
        coerced = read(spark, tmp_path, suffix="geojson", coerce_to_schema=True)
        assert sorted(row["id"] or 0 for row in coerced.collect()) == [0, 1]


def test_json_that_is_no_geojson_is_passed_over(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(document(FEATURES[:3]))
    (tmp_path / "b.geojson").write_text('{"some": "json", "n": 1}')
    (tmp_path / "c.geojson").write_text("[1, 2]")
    assert read(spark, tmp_path, suffix="geojson").count() == 3
    with pytest.raises(Exception, match="geojson"):
        read(spark, tmp_path, suffix="geojson", mode="FAILFAST").count()


def test_empty_collection(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(document([]))
    assert read(spark, tmp_path, suffix="geojson").collect() == []
    assert describe_layers(str(tmp_path), suffix="geojson", spark=spark).first()["feature_count"] == 0


def test_geojson_types(spark, tmp_path):
    first = {"big": 2**40, "flag": True, "list": [1, 2], "texts": ["a"], "reals": [0.5], "sub": {"k": 1}, "void": None}
    second = {"big": 1, "late": "x", "mixed": 1}
    third = {"mixed": "text"}
    features = [{"type": "Feature", "properties": p, "geometry": None} for p in (first, second, third)]
    (tmp_path / "a.geojson").write_text(document(features))
    df = read(spark, tmp_path, suffix="geojson")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types == {
        "big": "bigint",
        "flag": "boolean",
        "list": "array<bigint>",
        "texts": "array<string>",
        "reals": "array<double>",
        "sub": "string",
        "void": "string",
        "late": "string",
        "mixed": "string",
        "geometry": "binary",
    }
    row = df.filter("flag").first().asDict()
    assert (row["big"], row["list"], row["texts"], row["reals"], row["sub"]) == (2**40, [1, 2], ["a"], [0.5], '{"k":1}')
    assert sorted(r["mixed"] for r in df.filter("mixed is not null").collect()) == ["1", "text"]


def test_geojson_layer_names(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(document(FEATURES[:3], name="roads"))
    (tmp_path / "b.geojson").write_text(document(FEATURES[3:7]))
    (tmp_path / "c.geojson").write_text("no json")
    catalog = describe_layers(str(tmp_path), suffix="geojson", spark=spark)
    found = {r["layer_name"]: r["feature_count"] for r in catalog.filter("error is null").collect()}
    assert found == {"roads": 3, "b": 4}
    assert catalog.filter("error is not null").count() == 1
    assert read(spark, tmp_path, suffix="geojson").count() == 7
    assert read(spark, tmp_path, suffix="geojson", layer_identifier="roads").count() == 3
    with pytest.raises(ValueError):
        read(spark, tmp_path, suffix="geojson", layer_identifier=1)


@pytest.mark.parametrize(
    ("geometry", "wkb"),
    [
        ({"type": "Point", "coordinates": [1, 2, 3]}, struct.pack("<BI3d", 1, 0x80000001, 1, 2, 3)),
        ({"type": "Point", "coordinates": []}, None),
        ({"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)),
        (
            {"type": "MultiPoint", "coordinates": [[0, 0], [1, 1]]},
            struct.pack("<BII", 1, 4, 2) + struct.pack("<BIdd", 1, 1, 0, 0) + struct.pack("<BIdd", 1, 1, 1, 1),
        ),
        (
            {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 0]]]]},
            struct.pack("<BII", 1, 6, 1) + struct.pack("<BIII6d", 1, 3, 1, 3, 0, 0, 1, 0, 0, 0),
        ),
        (
            {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}]},
            struct.pack("<BII", 1, 7, 1) + struct.pack("<BIdd", 1, 1, 1, 2),
        ),
        (None, None),
    ],
)
def test_geojson_geometries(spark, geometry, wkb):
    line = {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}
    texts = [None if geometry is None else json.dumps(geometry), json.dumps(line), None]
    assert converted(spark, texts, geojson_wkb)[::2] == [wkb, None]


def converted(spark, texts, function) -> list[bytes | None]:
    """Of all texts, in batches of other sizes than one."""
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)
    found = rows.select("n", function(F.col("text")).alias("wkb")).collect()
    return [row.wkb and bytes(row.wkb) for row in sorted(found)]


def test_random_geojson_geometries(spark):
    chance = random.Random(3)
    texts = [None, *(json.dumps(geometries.random_geojson(chance)) for _ in range(700))]
    assert converted(spark, texts, geojson_wkb) == list(map(geometries.geojson_to_wkb, texts))


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ('{"type": "point", "coordinates": [1, 2]}', "Unknown GeoJSON geometry type point"),
        ('{"type": "Point", "coordinates": "x"}', "cannot be read: x"),
        ('{"type": "Point"}', "without coordinates"),
        ('{"type": "LineString", "coordinates": [[1, "a"]]}', "something else than numbers"),
        ('{"type": "LineString", "coordinates": [[1, null], [1, 2]]}', "something else than numbers"),
        ('{"type": "GeometryCollection"}', "without geometries"),
        ("[1]", "Unknown GeoJSON geometry type null"),
    ],
)
def test_geometries_that_are_none(spark, text, message):
    with pytest.raises(Exception, match=message):
        converted(spark, [text], geojson_wkb)


def test_random_gml_geometries(spark):
    chance = random.Random(3)
    texts = [None, *(geometries.random_gml(chance) for _ in range(700))]
    assert converted(spark, texts, gml_wkb) == list(map(geometries.gml_to_wkb, texts))


def test_gml_numbers_that_are_none(spark):
    for text in ("<Point><pos>1 x</pos></Point>", "<LineString><posList>1 2 3</posList></LineString>"):
        with pytest.raises(Exception, match="x|whole positions"):
            converted(spark, [text], gml_wkb)


SQUARE = "0 0 1 0 1 1 0 0"
RING = struct.pack("<I8d", 4, 0, 0, 1, 0, 1, 1, 0, 0)


@pytest.mark.parametrize(
    ("gml", "wkb"),
    [
        ("<gml:Point><gml:coordinates>1,2</gml:coordinates></gml:Point>", struct.pack("<BIdd", 1, 1, 1, 2)),
        ("<gml:Point gml:id='p'><gml:pos>1 2</gml:pos></gml:Point>", struct.pack("<BIdd", 1, 1, 1, 2)),
        (
            '<gml:Point srsName="urn:ogc:def:crs:EPSG::4326"><gml:pos>51 -1</gml:pos></gml:Point>',
            struct.pack("<BIdd", 1, 1, -1, 51),
        ),
        (
            '<gml:Point srsName="EPSG:27700" gml:id="p"><gml:pos> -1.5e3 2 </gml:pos></gml:Point>',
            struct.pack("<BIdd", 1, 1, -1500, 2),
        ),
        ("<g:Point xlink:href='h' g:id='p'><g:pos>1 2</g:pos></g:Point>", struct.pack("<BIdd", 1, 1, 1, 2)),
        ("<Point><pos>1 2</pos></Point>", struct.pack("<BIdd", 1, 1, 1, 2)),
        ("<Point/>", None),
        (
            '<gml:Point srsDimension="3"><gml:pos>1 2 3</gml:pos></gml:Point>',
            struct.pack("<BI3d", 1, 0x80000001, 1, 2, 3),
        ),
        (
            "<gml:LineString><gml:coordinates>0,0 1,1</gml:coordinates></gml:LineString>",
            struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1),
        ),
        (
            "<gml:Curve><gml:segments><gml:LineStringSegment><gml:posList>0 0 1 1</gml:posList>"
            "</gml:LineStringSegment></gml:segments></gml:Curve>",
            struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1),
        ),
        (
            f"<gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{SQUARE}</gml:posList></gml:LinearRing></gml:exterior>"
            f"<gml:interior><gml:LinearRing><gml:posList>{SQUARE}</gml:posList></gml:LinearRing></gml:interior></gml:Polygon>",
            struct.pack("<BII", 1, 3, 2) + RING * 2,
        ),
        (
            f"<g:MultiSurface><g:surfaceMember><g:Polygon><g:exterior><g:LinearRing><g:posList>{SQUARE}</g:posList>"
            "</g:LinearRing></g:exterior></g:Polygon></g:surfaceMember></g:MultiSurface>",
            struct.pack("<BII", 1, 6, 1) + struct.pack("<BII", 1, 3, 1) + RING,
        ),
        (
            "<gml:MultiPoint><gml:pointMember><gml:Point><gml:pos>1 2</gml:pos></gml:Point></gml:pointMember></gml:MultiPoint>",
            struct.pack("<BII", 1, 4, 1) + struct.pack("<BIdd", 1, 1, 1, 2),
        ),
        (None, None),
    ],
)
def test_gml_geometries(spark, gml, wkb):
    line = "<LineString><posList>0 0 1 1</posList></LineString>"
    assert converted(spark, [gml, line, None], gml_wkb)[::2] == [wkb, None]


def gml_feature(layer: str, i: int, body: str) -> str:
    return f'<ogr:{layer} fid="{layer}.{i}">{body}</ogr:{layer}>'


def collection(*members: str, wrapper: str = "gml:featureMember", plural: bool = False) -> str:
    inner = "".join(members) if plural else "\n".join(f"<{wrapper}>\n{m}\n</{wrapper}>" for m in members)
    inner = f"<{wrapper}>{inner}</{wrapper}>" if plural else inner
    bounds = "<gml:boundedBy><gml:Box><gml:coord><gml:X>0</gml:X></gml:coord></gml:Box></gml:boundedBy>"
    return f'<?xml version="1.0"?>\n<ogr:FeatureCollection xmlns:gml="g">{bounds}{inner}</ogr:FeatureCollection>'


def shape(i: int) -> str:
    return f"<ogr:geometryProperty><gml:Point><gml:coordinates>{i},0</gml:coordinates></gml:Point></ogr:geometryProperty>"


ROADS = [gml_feature("road", i, shape(i) + f"<ogr:id>{i}</ogr:id><ogr:name>A &amp; &lt;{i}&gt;</ogr:name>") for i in range(200)]
TOWNS = [gml_feature("town", i, f"<ogr:id>{i}</ogr:id><ogr:size>{i}.5</ogr:size>") for i in range(50)]


@pytest.mark.parametrize(("wrapper", "plural"), [("gml:featureMember", False), ("wfs:member", False), ("gml:featureMembers", True)])
@pytest.mark.parametrize("split_bytes", [128 << 20, 1000])
def test_gml(spark, tmp_path, wrapper, plural, split_bytes):
    (tmp_path / "a.gml").write_text(collection(*ROADS, *TOWNS, wrapper=wrapper, plural=plural))
    roads = read(spark, tmp_path, suffix="gml", split_bytes=split_bytes)
    assert roads.schema.simpleString() == "struct<fid:string,id:int,name:string,geometry:binary>"
    assert sorted(map(tuple, roads.collect()), key=lambda r: r[1]) == [
        (f"road.{i}", i, f"A & <{i}>", bytearray(struct.pack("<BIdd", 1, 1, i, 0))) for i in range(200)
    ]
    for layer in ("town", 1):
        towns = read(spark, tmp_path, suffix="gml", layer_identifier=layer, split_bytes=split_bytes)
        assert sorted(r["size"] for r in towns.collect()) == [i + 0.5 for i in range(50)]
    catalog = describe_layers(str(tmp_path), suffix="gml", spark=spark).orderBy("layer_index")
    assert [(r["layer_name"], r["feature_count"]) for r in catalog.collect()] == [("road", 200), ("town", 50)]


def test_gml_ranges_of_every_size(tmp_path, monkeypatch):
    monkeypatch.setattr(gml, "_READ_BYTES", 50)
    (tmp_path / "a.gml").write_text(collection(*ROADS[:20], *TOWNS[:5]))
    path = str(tmp_path / "a.gml")
    key = gml.locate(path, None).key
    for step in (7, 100, 10_000):
        found = [text for start, stop in records.plan(gml, path, key, step) for text in gml.features(path, key, start, stop)]
        assert len(found) == 20 and all(text.startswith("<") and text.endswith(">") for text in found)


def test_gml_that_begins_late(spark, tmp_path):
    late = f"<!-- {'x' * (2 << 20)} -->"
    (tmp_path / "a.gml").write_text(collection(*ROADS).replace("<gml:featureMember>", f"{late}<gml:featureMember>", 1))
    (tmp_path / "b.gml").write_text(collection(*ROADS, *TOWNS))
    assert read(spark, tmp_path, suffix="gml").count() == 400
    towns = read(spark, tmp_path, suffix="gml", layer_identifier="town", schema=StructType().add("size", "double"))
    assert towns.count() == 50


def test_gml_in_its_declared_encoding(spark, tmp_path):
    text = collection(gml_feature("road", 1, "<ogr:id>1</ogr:id><ogr:name>Straße é</ogr:name>"))
    text = text.replace('<?xml version="1.0"?>', '<?xml version="1.0" encoding="ISO-8859-1"?>')
    (tmp_path / "a.gml").write_bytes(text.encode("iso-8859-1"))
    assert [row["name"] for row in read(spark, tmp_path, suffix="gml").collect()] == ["Straße é"]
    (tmp_path / "b.gml").write_bytes(text.encode("utf-16"))
    with pytest.raises(Exception, match="UTF-16"):
        read(spark, tmp_path, suffix="gml").collect()


def test_gml_files_with_differing_fields(spark, tmp_path):
    (tmp_path / "a.gml").write_text(collection(gml_feature("road", 1, "<ogr:id>1</ogr:id>")))
    (tmp_path / "b.gml").write_text(collection(gml_feature("road", 2, "<ogr:id>x</ogr:id><ogr:name>B</ogr:name>")))
    schema = StructType().add("id", "long").add("name", "string").add("geometry", "binary")
    df = read(spark, tmp_path, suffix="gml", schema=schema, coerce_to_schema=True)
    assert sorted(map(tuple, df.collect()), key=str) == [(1, None, None), (None, "B", None)]


MARKED = [
    gml_feature("road", 1, shape(1) + "<ogr:id>1</ogr:id>"),
    "<!-- " + gml_feature("road", 2, "<ogr:id>2</ogr:id>") + " <![CDATA[ -->",
    gml_feature("road", 3, "<ogr:id><!-- 9 -->3</ogr:id><ogr:name><![CDATA[ </ogr:road> <ogr:road> & --> <!-- ]]></ogr:name>"),
    "<![CDATA[ <ogr:road><ogr:id>4</ogr:id></ogr:road> ]]>",
    gml_feature("road", 5, "<!-- </ogr:road> -->" + shape(5).replace("5,0", "<!-- 1,1 -->5,0") + "<ogr:id>5</ogr:id>"),
]


@pytest.mark.parametrize("split_bytes", [128 << 20, 64])
def test_gml_comments_and_sections(spark, tmp_path, split_bytes):
    (tmp_path / "a.gml").write_text(collection(*MARKED, plural=True))
    rows = sorted(map(tuple, read(spark, tmp_path, suffix="gml", split_bytes=split_bytes).select("id", "name", "geometry").collect()))
    at = [bytearray(struct.pack("<BIdd", 1, 1, i, 0)) for i in (1, 5)]
    assert rows == [(1, None, at[0]), (3, "</ogr:road> <ogr:road> & --> <!--", None), (5, None, at[1])]
    assert describe_layers(str(tmp_path), suffix="gml", spark=spark).first()["feature_count"] == 3


def test_gml_comments_at_every_split(tmp_path, monkeypatch):
    path, text = str(tmp_path / "a.gml"), collection(*MARKED, plural=True)
    (tmp_path / "a.gml").write_text(text)
    key = gml.locate(path, None).key
    for read_bytes in (11, 1 << 20):
        monkeypatch.setattr(gml, "_READ_BYTES", read_bytes)
        whole = list(gml.features(path, key, None, None))
        assert [one.count("<ogr:id>") for one in whole] == [1, 1, 1] and not any("<!" in one for one in whole)
        for step in range(1, len(text) + 1, 1 if read_bytes > 11 else 13):
            assert whole == [one for start, stop in records.plan(gml, path, key, step) for one in gml.features(path, key, start, stop)]


@pytest.mark.parametrize("suffix", ["geojson", "gml"])
def test_text_in_another_encoding_is_an_error(spark, tmp_path, suffix):
    feature = [{"type": "Feature", "properties": {"name": "Müller"}, "geometry": None}]
    text = json.dumps({"type": "FeatureCollection", "features": feature}, ensure_ascii=False)
    if suffix == "gml":
        text = collection(gml_feature("road", 1, "<ogr:name>Müller</ogr:name>"))
        text = text.replace('<?xml version="1.0"?>', '<?xml version="1.0" encoding="US-ASCII"?>')
    (tmp_path / f"a.{suffix}").write_bytes(text.encode("latin-1"))
    with pytest.raises(Exception, match="codec can't decode|not well-formed|No file could be opened"):
        read(spark, tmp_path, suffix=suffix).collect()


@pytest.mark.parametrize(("suffix", "module"), [("geojson", geojson), ("gml", gml)])
def test_tasks_plan_what_one_process_does(spark, tmp_path, suffix, module):
    """Two files of differing length, each block of which may begin anywhere."""
    if suffix == "geojson":
        notes = [{**f, "note": "\\" * (i % 4) + '"}{[' + "]" * (i % 3)} for i, f in enumerate(FEATURES[:60])]
        texts = [document(notes, after={"features": [{}, {"a": [1]}]}), document(FEATURES[:5], indent=2)]
    else:
        texts = [collection(*MARKED * 5, plural=True), collection(*ROADS[:30])]
    paths = []
    for n, text in enumerate(texts):
        paths.append(str(tmp_path / f"{n}.{suffix}"))
        (tmp_path / f"{n}.{suffix}").write_text(text)
    files = spark.createDataFrame([(path,) for path in paths], "path string")
    found = {}
    for row in records.planned(files, module, None, 150, "FAILFAST").collect():
        found.setdefault(row.path, []).append((row.start, row.stop, row.key))
    for path in paths:
        key = module.locate(path, None).key
        expected = records.plan(module, path, key, 150)
        assert sorted(found[path]) == [(*ends, key) for ends in expected] and len(expected) >= 5
        whole = list(module.features(path, key, None, None))
        assert whole == [one for ends in expected for one in module.features(path, key, *ends)]
