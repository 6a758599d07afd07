"""GML feature collections.

A streaming parser finds the elements that stand for features. Features are then cut out
between an element's opening and closing tag; a feature belongs to the byte range its
opening tag begins in, so a large file is read by many tasks without a look at what is
before. Tags in comments and CDATA sections are none; ranges begin outside of both.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.parsers import expat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featureframe.functions.boxes import Box
from featureframe.functions.coordinates import gml_wkb
from featureframe.plans.catalog import LayerIdentifier
from featureframe.sources.layers import NotVectorData
from featureframe.sources.records import Located, blocks, chosen, decoded, fitted, near, opened, size_of

# Elements features are wrapped in
_WRAPPERS = ("member", "featureMember", "featureMembers")
_READ_BYTES = 1 << 20
_LOOK_BYTES = 4096
_SPACE = re.compile(rb"\s")
_ENCODING = re.compile(rb"""<\?xml[^>]*?\sencoding\s*=\s*["']([\w.:-]+)["']""")
# Marks of comments and of sections of plain text
_SECTION = re.compile(rb"<!--|<!\[CDATA\[")
_SECTION_ENDS = {b"<!--": re.compile(rb"-->"), b"<![CDATA[": re.compile(rb"\]\]>")}
_WHOLE_SECTION = re.compile(rb"<!--.*?-->|<!\[CDATA\[(.*?)\]\]>", re.DOTALL)
# GML geometry elements
_SHAPES = (
    "Point|LineString|Curve|Polygon|Surface|MultiPoint|MultiLineString|MultiCurve"
    "|MultiPolygon|MultiSurface|MultiGeometry"
)
_GEOMETRY = rf"(?s)<((?:[\w.-]+:)?(?:{_SHAPES}))[\s>].*?</\1\s*>"
_EMPTIED = r"<([\w.:-]+)(?:\s[^>]*)?>\s*<shape/>\s*</\1\s*>"
_BOUNDS = r"(?s)<((?:[\w.-]+:)?boundedBy)[\s>].*?</\1\s*>"
_LEAF = r"<(?:[\w.-]+:)?([\w.-]+)(?:\s[^>]*)?>([^<]*)</"
_FID = r'^<[^>]*?\s(?:[\w.-]+:id|fid)\s*=\s*"([^"]*)"'
# Names under which the feature's id attribute is shown
FID_FIELDS = ("fid", "gml_id")


def _local(element: str) -> str:
    return element.rsplit(":", 1)[-1]


def _encoding(path: str, head: bytes) -> str:
    """The encoding the file declares; tags must be readable as ASCII in it."""
    if head.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
        raise ValueError(f"{path} is UTF-16, which cannot be cut into features; store it as UTF-8.")
    declared = _ENCODING.search(head[:1024])
    return codecs.lookup(declared[1].decode("ascii")).name if declared else "utf-8"


def _elements(path: str, enough: Callable[[dict[str, int]], bool]) -> tuple[dict[str, int], str]:
    """How often each feature element occurs, in order of first appearance, and the encoding.

    Reads on until ``enough`` says so, and always to the first feature.
    """
    counts: dict[str, int] = {}
    names: list[str] = []

    def start(name: str, _: dict) -> None:
        # features are grandchildren of the root, below a wrapper
        if len(names) == 2 and _local(names[1]) in _WRAPPERS:
            counts[name] = counts.get(name, 0) + 1
        names.append(name)

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    parser.EndElementHandler = lambda _: names.pop()
    with opened(path) as file:
        head = block = file.read(_READ_BYTES)
        encoding = _encoding(path, head)
        try:
            while block and not (counts and enough(counts)):
                parser.Parse(block, False)
                block = file.read(_READ_BYTES)
            if not block:
                parser.Parse(b"", True)
        except expat.ExpatError as error:
            raise NotVectorData(f"{path} is not well-formed XML: {error}.") from None
    if not counts:
        raise NotVectorData(f"{path} is not GML.")
    return counts, encoding


def locate(path: str, layer: LayerIdentifier) -> Located:
    """The layer's feature element, read on for until it is found."""

    def enough(counts: dict[str, int]) -> bool:
        if isinstance(layer, str):
            return any(_local(element) == layer for element in counts)
        return len(counts) > (layer or 0)

    counts, encoding = _elements(path, enough)
    elements = list(counts)
    element = elements[chosen([_local(one) for one in elements], layer, path)]
    return Located(_local(element), json.dumps([element, encoding]))


def layers(path: str) -> list[tuple[str, int]]:
    """Layers in order of first appearance with the number of their features."""
    counts, _ = _elements(path, lambda _: False)
    return [(_local(element), count) for element, count in counts.items()]


#: State outside comments and CDATA sections; inside it is the mark that began the section.
BEGIN = ""


def block_starts(path: str, key: str, step: int) -> list[int]:
    """Where blocks of about ``step`` bytes begin: after white space, which no mark has."""
    with opened(path) as file:
        size, starts = size_of(file), [0]
        for start in range(step, size, step):
            file.seek(start)
            at = start
            while block := file.read(_LOOK_BYTES):
                if space := _SPACE.search(block):
                    starts.append(at + space.end())
                    break
                at += len(block)
    return [start for start in dict.fromkeys(starts) if start < max(size, 1)]


def summary(path: str, start: int, stop: int | None) -> list[list]:
    """The state after a block for each state it may begin in."""
    states = [BEGIN, *(mark.decode() for mark in _SECTION_ENDS)]
    with opened(path) as file:
        return [[state, _followed(file, start, stop, state)[0]] for state in states]


def after(state: str, of_block: list[list]) -> str | None:
    return dict(of_block)[state]


def cut(path: str, start: int, stop: int | None, state: str) -> int | None:
    """Where a block that begins in ``state`` is first outside of all sections."""
    if not state:
        return start
    with opened(path) as file:
        return _followed(file, start, stop, state, leave=True)[1]


def _followed(file: BinaryIO, start: int, stop: int | None, state: str, leave: bool = False) -> tuple[str, int | None]:
    """The state after some bytes; or, to ``leave``, where they are first outside of all sections, if they are."""
    mark, base, text = state.encode(), start, b""
    for block in blocks(file, start, stop, _READ_BYTES):
        text, at = text + block, 0
        while found := (_SECTION_ENDS[mark] if mark else _SECTION).search(text, at):
            at = found.end()
            mark = b"" if mark else found[0]
            if leave and not mark:
                return "", base + at
        # a mark may go on in the next block
        kept = max(at, len(text) - len("<![CDATA["))
        base, text = base + kept, text[kept:]
    return mark.decode(), None


def features(path: str, key: str, start: int | None, stop: int | None) -> Iterator[str]:
    """Texts of the feature elements whose opening tag begins in the range, without comments and CDATA marks."""
    element, encoding = json.loads(key)
    name = re.escape(element.encode(encoding))
    opening = re.compile(_SECTION.pattern + rb"|<" + name + rb"(?=[\s>/])")
    closing = re.compile(_SECTION.pattern + rb"|</" + name + rb"\s*>")
    with opened(path) as file:
        base = start or 0
        file.seek(base)
        text, at = b"", 0

        def more() -> bool:
            nonlocal text, at, base
            block = file.read(max(_READ_BYTES, len(text) - at))
            base, text, at = base + at, text[at:] + block, 0
            return bool(block)

        while True:
            found = opening.search(text, at)
            if found is None:
                # a tag or a mark may begin in the last bytes
                at = max(at, len(text) - max(len(element.encode(encoding)) + 2, len("<![CDATA[")))
                if (stop is not None and base + at >= stop) or not more():
                    return
                continue
            at = found.start()
            if stop is not None and base + at >= stop:
                return
            ends = _section_end if found[0] in _SECTION_ENDS else _end_of
            end = ends(text, at, closing)
            while end is None:
                if not more():
                    raise ValueError(f"{path} ends within a feature.")
                end = ends(text, at, closing)
            if ends is _end_of:
                yield decoded(path, _plain(text[at:end]), encoding)
            at = end


def _section_end(text: bytes, at: int, _: re.Pattern) -> int | None:
    mark = _SECTION.match(text, at)
    found = _SECTION_ENDS[mark[0]].search(text, mark.end())
    return found.end() if found else None


def _end_of(text: bytes, at: int, closing: re.Pattern) -> int | None:
    """Where the feature element that begins at ``at`` ends, if the text goes on that far."""
    tag = text.find(b">", at)
    if tag < 0:
        return None
    if text[tag - 1 : tag] == b"/":  # an element without content
        return tag + 1
    at = tag
    while found := closing.search(text, at):
        if found[0] not in _SECTION_ENDS:
            return found.end()
        at = _section_end(text, found.start(), closing)
        if at is None:
            return None
    return None


def _plain(feature: bytes) -> bytes:
    """The element without comments, and with CDATA sections as ordinary text."""
    return _WHOLE_SECTION.sub(_as_text, feature) if b"<!" in feature else feature


def _as_text(section: re.Match) -> bytes:
    inner = section[1]
    return b"" if inner is None else inner.replace(b"&", b"&amp;").replace(b"<", b"&lt;").replace(b">", b"&gt;")


def attributes(found: DataFrame) -> list[dict]:
    """The feature id, then names and OGR types of the leaf elements by first position."""
    without_bounds = F.regexp_replace("feature", _BOUNDS, "")
    plain = F.regexp_replace(F.regexp_replace(without_bounds, _GEOMETRY, "<shape/>"), _EMPTIED, "")
    names = F.regexp_extract_all(plain, F.lit(_LEAF), F.lit(1))
    values = F.regexp_extract_all(plain, F.lit(_LEAF), F.lit(2))
    pairs = found.select(F.posexplode(F.arrays_zip(names.alias("name"), values.alias("value"))).alias("pos", "pair"))
    text = F.trim(F.col("pair.value"))
    filled = F.when(text != "", text)
    rows = (
        pairs.groupBy(F.col("pair.name").alias("name"))
        .agg(
            F.min("pos").alias("pos"),
            F.bool_and(filled.rlike(r"^[+-]?\d{1,18}$")).alias("whole"),
            F.bool_and(filled.try_cast("double").isNotNull()).alias("real"),
            F.max(F.abs(filled.try_cast("double"))).alias("largest"),
        )
        .orderBy("pos", "name")
        .collect()  # one row per attribute name
    )
    ids = found.select(F.regexp_extract("feature", r"^<[^>]*?\s([\w.-]+:id|fid)\s*=", 1).alias("name")).limit(1).collect()
    id_names = ["gml_id" if row["name"] != "fid" else "fid" for row in ids if row["name"]]
    leading = [{"name": name, "ogr_type": 4, "ogr_subtype": 0} for name in id_names]
    return leading + [_attribute(row.asDict()) for row in rows]


def _attribute(row: dict) -> dict:
    kind = 4
    if row["whole"]:
        kind = 0 if row["largest"] <= 2**31 - 1 else 12
    elif row["real"]:
        kind = 2
    return {"name": row["name"], "ogr_type": kind, "ogr_subtype": 0}


def read(
    found: DataFrame, schema: StructType, geom_field_name: str, strict: bool = False, box: Box | None = None
) -> DataFrame:
    """Feature elements as rows of the schema; elements a feature lacks are null.

    With ``strict`` a value of another type is an error.
    """
    inner = [f for f in schema.fields if f.name != geom_field_name and f.name not in FID_FIELDS]
    texts = StructType([StructField(field.name, StringType()) for field in inner])
    fid = F.nullif(F.regexp_extract("feature", _FID, 1), F.lit(""))
    columns = ["path", fid.alias("fid")]
    if inner:
        with_corrupt = StructType([*texts.fields, StructField(_CORRUPT, StringType())])
        options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": _CORRUPT}
        columns += [F.from_xml("feature", with_corrupt, options).alias("f")]
    if geom_field_name in schema.names or box is not None:
        columns.append(F.nullif(F.regexp_extract("feature", _GEOMETRY, 0), F.lit("")).alias("shape"))
    parsed = found.select(*columns)
    if inner:
        message = F.concat(F.lit("A feature cannot be parsed in "), F.col("path"))
        broken = F.col(f"f.{_CORRUPT}").isNotNull()
        parsed = parsed.withColumn("f", F.when(broken, F.raise_error(message)).otherwise(F.col("f")))
    geometry = gml_wkb(F.col("shape")) if "shape" in parsed.columns else None
    if box is not None:
        parsed, geometry = near(parsed.withColumn("wkb", geometry), F.col("wkb"), box), F.col("wkb")

    def column(field: StructField) -> Column:
        if field.name == geom_field_name:
            return geometry.cast(field.dataType).alias(field.name)
        raw = F.col("fid") if field.name in FID_FIELDS else F.col("f").getField(field.name)
        return fitted(raw, field, F.col("path"), strict).alias(field.name)

    return parsed.select(*[column(field) for field in schema.fields])


_CORRUPT = "_corrupt"
