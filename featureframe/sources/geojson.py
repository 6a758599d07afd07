"""GeoJSON documents, and sequences of features with or without record separators.

Features are the objects right inside the ``features`` array, or all objects of a file
that is a sequence, told apart by how deep brackets nest outside strings. So neither the
order of members, nor white space, nor what properties hold can lose or add a feature.
Brackets and quotes of a block are found by numpy at once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from featureframe.functions.boxes import Box
from featureframe.functions.coordinates import geojson_wkb
from featureframe.plans.catalog import LayerIdentifier
from featureframe.sources.layers import NotVectorData
from featureframe.sources.records import Located, blocks, chosen, decoded, fitted, near, opened, size_of
from featureframe.types import OGR_TO_SPARK

_TOKEN = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|"|[{}\[\]:,]', re.DOTALL)
_SPACE = b" \t\r\n"
_BETWEEN = _SPACE + b",\x1e"
_BOM = b"\xef\xbb\xbf"
_HEAD_BYTES = 1 << 16
_INT_MAX = 2**31 - 1


def locate(path: str, layer: LayerIdentifier) -> Located:
    """The layer, and where its first feature can begin.

    Reads on until the ``features`` array opens or the first object ends.
    """
    with opened(path) as file:
        text = file.read(_HEAD_BYTES)
        base = first = len(_BOM) if text.startswith(_BOM) else 0
        text = text[base:]
        if not text.lstrip(_BETWEEN).startswith(b"{"):
            raise NotVectorData(f"{path} is not GeoJSON.")
        name = os.path.splitext(os.path.basename(path))[0]
        at = depth = 0
        begin = None
        key = string = None
        members = {}
        while begin is None:
            token = _TOKEN.search(text, at)
            if token is None or token[0] == b'"':  # a string may end further on
                more = file.read(max(_HEAD_BYTES, len(text)))
                if not more:
                    raise NotVectorData(f"{path} ends before its first feature does.")
                kept = token.start() if token else len(text)
                base, text, at = base + kept, text[kept:] + more, 0
                continue
            at, mark = token.end(), token[0]
            if mark == b":" and depth == 1:
                key, string = string, None
            elif mark == b",":
                key = None if depth == 1 else key
            elif mark[:1] == b'"' and depth == 1:
                string = mark
                if key is not None:
                    members[key], key = mark, None
            elif mark in (b"{", b"["):
                if mark == b"[" and depth == 1 and key == b'"features"':
                    begin = base + at
                depth, key = depth + 1, None
            elif mark in (b"}", b"]"):
                depth -= 1
                if depth == 0:
                    if members.get(b'"type"') != b'"Feature"':
                        raise NotVectorData(f"{path} holds no features.")
                    begin, members = first, {}
        named = members.get(b'"name"')
        name = json.loads(named) if named else name
    chosen([name], layer, path)
    return Located(name, str(begin))


class _Nesting:
    """Follows quotes and brackets from block to block."""

    def __init__(self, depth: int = 0, in_string: bool = False, escaped: bool = False) -> None:
        self.depth = depth
        self.closed = False
        self._in_string = in_string
        self._slashes = int(escaped)

    def state(self) -> tuple[int, bool, bool]:
        """What the constructor takes to go on from here."""
        return self.depth, self._in_string, self._slashes % 2 == 1

    def brackets(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where brackets outside strings are, which ones, and how deep it is after each."""
        letters = np.frombuffer(block, np.uint8)
        quotes = np.flatnonzero(letters == 0x22)
        if self._slashes or b"\\" in block:
            quotes = self._unescaped(letters, quotes)
        marks = np.flatnonzero((letters | 0x20 == 0x7B) | (letters | 0x20 == 0x7D))
        outside = (np.searchsorted(quotes, marks) + self._in_string) % 2 == 0
        marks = marks[outside]
        kinds = letters[marks]
        after = self.depth + np.cumsum(np.where(kinds | 0x20 == 0x7B, 1, -1))
        self._in_string = bool((len(quotes) + self._in_string) % 2)
        self.depth = int(after[-1]) if len(after) else self.depth
        return marks, kinds, after

    def feed(self, block: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where objects of the outermost level open and close in the block."""
        before = self.depth
        marks, kinds, after = self.brackets(block)
        past = np.flatnonzero(after < 0)  # the array of features closes
        if len(past):
            self.closed = True
            marks, kinds, after = (one[: past[0]] for one in (marks, kinds, after))
            self.depth = int(after[-1]) if len(after) else before
        opened = (kinds == 0x7B) & (after == 1)
        return marks[opened], marks[(kinds == 0x7D) & (after == 0)]

    def _unescaped(self, letters: np.ndarray, quotes: np.ndarray) -> np.ndarray:
        places = np.arange(len(letters))
        other = np.maximum.accumulate(np.where(letters == 0x5C, -1, places))
        # backslashes right before each place; a run may go on from the block before
        before = np.concatenate([[-1], other])
        runs = places - 1 - before[:-1] + np.where(before[:-1] < 0, self._slashes, 0)
        self._slashes = int(len(letters) - 1 - other[-1] + (self._slashes if other[-1] < 0 else 0))
        return quotes[runs[quotes] % 2 == 0]


def features(path: str, key: str, start: int | None, stop: int | None) -> Iterator[str]:
    """Texts of the features in a range that begins and ends between features."""
    nesting = _Nesting()
    held: list[bytes] = []  # what earlier blocks have of the feature that is open
    with opened(path) as file:
        for block in blocks(file, int(key) if start is None else start, stop):
            was_open = nesting.depth > 0
            opens, closes = (places.tolist() for places in nesting.feed(block))
            if was_open:
                opens.insert(0, 0)
            done = 0
            for first, last in zip(opens, closes):
                _check_gap(path, block[done:first])
                held.append(block[first : last + 1])
                yield decoded(path, b"".join(held), "utf-8")
                held, done = [], last + 1
            if len(opens) > len(closes):
                _check_gap(path, block[done : opens[-1]])
                held.append(block[opens[-1] :])
            elif not nesting.closed:
                _check_gap(path, block[done:])
            if nesting.closed:
                return
    if nesting.depth:
        raise ValueError(f"{path} ends within a feature.")


def _check_gap(path: str, gap: bytes) -> None:
    if gap.strip(_BETWEEN):
        raise ValueError(f"{path} has text between features: {gap.strip(_BETWEEN)[:40]!r}")


#: State at the first feature: depth, whether in a string, whether the next character is escaped.
BEGIN = (0, False, False)


def block_starts(path: str, key: str, step: int) -> list[int]:
    """Where blocks of ``step`` bytes begin from the first feature on."""
    with opened(path) as file:
        return list(range(int(key), max(size_of(file), int(key) + 1), step))


def summary(path: str, start: int, stop: int | None) -> list[list]:
    """What a block does to each state it may begin in, depth aside: the state after it, the depth
    it adds, and the lowest depth in between."""
    ways = [(quoted, escaped) for quoted in (False, True) for escaped in (False, True)]
    followed, lowest = {way: _Nesting(0, *way) for way in ways}, dict.fromkeys(ways, 0)
    with opened(path) as file:
        for block in blocks(file, start, stop):
            for way, nesting in followed.items():
                lowest[way] = min(lowest[way], int(nesting.brackets(block)[2].min(initial=lowest[way])))
    return [[*way, *followed[way].state(), lowest[way]] for way in ways]


def after(state: tuple, of_block: list[list]) -> tuple | None:
    """The state after a block with that summary; None where the array of features closes in it."""
    depth, *way = state
    change, quoted, escaped, lowest = next(row[2:] for row in of_block if row[:2] == way)
    return None if depth + lowest < 0 else (depth + change, quoted, escaped)


def cut(path: str, start: int, stop: int | None, state: tuple) -> int | None:
    """Where the first feature of a block that begins in ``state`` begins."""
    nesting, at = _Nesting(*state), start
    with opened(path) as file:
        for block in blocks(file, start, stop):
            opens = nesting.feed(block)[0]
            if len(opens):
                return at + int(opens[0])
            if nesting.closed:
                return None
            at += len(block)
    return None


def layers(path: str) -> list[tuple[str, int]]:
    """The file's layer and the number of its features."""
    found = locate(path, None)
    nesting, count = _Nesting(), 0
    with opened(path) as file:
        for block in blocks(file, int(found.key), None):
            count += len(nesting.feed(block)[0])
            if nesting.closed:
                break
    return [(found.layer_name, count)]


def attributes(found: DataFrame) -> list[dict]:
    """Names and OGR types of the properties in the given features, by first position."""
    properties = found.select(F.from_json("feature", "properties string")["properties"].alias("text"))
    keys = F.json_object_keys("text").alias("keys")
    parsed = properties.select(F.try_parse_json("text").alias("object"), keys).filter("object is not null")
    items = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("object").outer()))
    number = F.try_variant_get("value", "$", "double")
    rows = (
        items.filter("key is not null")
        .groupBy("key")
        .agg(
            F.min(F.array_position("keys", F.col("key"))).alias("pos"),
            F.schema_of_variant_agg("value").alias("kind"),
            F.max(F.abs(number)).alias("largest"),
        )
        .orderBy("pos", "key")
        .collect()  # one row per attribute name
    )
    return [_attribute(row["key"], row["kind"], row["largest"]) for row in rows]


def _attribute(name: str, kind: str, largest: float | None) -> dict:
    listed = kind.startswith("ARRAY<")
    item = kind.removeprefix("ARRAY<").removesuffix(">")
    if item == "BOOLEAN":
        pair = (1, 1) if listed else (0, 1)
    elif item == "BIGINT":
        # list elements are not measured, so they get the wide type
        pair = (13, 0) if listed else (0, 0) if largest is None or largest <= _INT_MAX else (12, 0)
    elif item.startswith("DECIMAL") or item in ("DOUBLE", "FLOAT"):
        pair = (3, 0) if listed else (2, 0)
    elif item == "STRING":
        pair = (5, 0) if listed else (4, 0)
    else:
        pair = (4, 4) if listed or item.startswith("OBJECT") else (4, 0)
    return {"name": name, "ogr_type": pair[0], "ogr_subtype": pair[1]}


def read(
    found: DataFrame, schema: StructType, geom_field_name: str, strict: bool = False, box: Box | None = None
) -> DataFrame:
    """Features as rows of the schema; properties a feature lacks are null.

    With ``strict`` a property the schema does not have, or a value of another type, is an error.
    """
    wanted = [field for field in schema.fields if field.name != geom_field_name]
    texts = StructType([StructField(field.name, _raw_type(field.dataType)) for field in wanted])
    members = [StructField("properties", texts)] if wanted else []
    if geom_field_name in schema.names or box is not None:
        members.append(StructField("geometry", StringType()))
    # values of other types make a record corrupt too, so those are parsed again to tell
    members.append(StructField(_CORRUPT, StringType()))
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = found.select(
        "path", "feature", F.from_json("feature", StructType(members), options).alias("f")
    )
    broken = F.col(f"f.{_CORRUPT}").isNotNull() & F.try_parse_json("feature").isNull()
    message = F.concat(F.lit("A feature cannot be parsed in "), F.col("path"))
    whole = F.when(broken, F.raise_error(message))
    if strict:
        names = F.json_object_keys(F.get_json_object("feature", "$.properties"))
        more = F.array_except(names, F.lit([field.name for field in wanted]).cast("array<string>"))
        hint = F.concat(
            F.col("path"), F.lit(" does not fit the schema (additional: "), F.array_join(more, ", "),
            F.lit("); set coerce_to_schema=True to fit it."),
        )
        whole = whole.when(F.size(more) > 0, F.raise_error(hint))
    parsed = parsed.select("path", whole.otherwise(F.col("f")).alias("f"))
    geometry = geojson_wkb(F.col("f.geometry"))
    if box is not None:
        parsed, geometry = near(parsed.withColumn("wkb", geometry), F.col("wkb"), box), F.col("wkb")

    def column(field: StructField) -> Column:
        if field.name == geom_field_name:
            return geometry.cast(field.dataType).alias(field.name)
        raw = F.col("f.properties").getField(field.name)
        if isinstance(field.dataType, ArrayType):
            return raw.alias(field.name)
        return fitted(raw, field, F.col("path"), strict).alias(field.name)

    return parsed.select(*[column(field) for field in schema.fields])


_CORRUPT = "_corrupt"


def _raw_type(data_type: DataType) -> DataType:
    return data_type if isinstance(data_type, ArrayType) else StringType()
