"""Personal data: patterns find entities, corpus co-occurrence finds the terms that give them away.

Entities are email and IP addresses, card and phone numbers. A term is a word of a document
that has an entity, wherever it stands there. Over the whole corpus, with N documents, of
which n_e have entity e, n_t have term t, and n_et have both,

    information of e        IC(e)      = log2(N / n_e)
    what t tells about e    PMI(e; t)  = log2(n_et * N / (n_e * n_t))

and t discloses e where PMI(e; t) >= ``threshold`` * IC(e), that is where t is rarely seen
without e. A pair counts from ``LEAST_CONTEXTS`` different contexts on, so words of one
text, or of its exact copies, are no evidence; the words about e's mentions in a document
are its context there; a term near two mentions in different words counts in one document
too. An entity that has fewer contexts is also disclosed by the words with a capital
letter that no document without it has. Every occurrence of a disclosing
term in a document that has its entity is a span of kind ``term``. ``sanitise`` puts the
kind's name in place of spans.

Counts of words cover all documents; only words that are a term somewhere are counted,
told by a bitmap of fixed size, where a wrong hit costs a row but changes no result. No
entity can be disclosed by a term of more than ``N ** (1 - threshold) * n_e ** threshold``
documents (n_et is at most n_e), nor one of a single context by a term of more documents
than hold the entity. So words are counted first, and only terms within the widest of these
bounds meet entities; a second bitmap tells them.

A null text counts as empty and has no spans. Spans are code points, ends exclusive, per
kind leftmost and without overlap; spans of different kinds may overlap. Rows that repeat
an id have the spans of their own text. Tables without rows give none.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from featureframe.llm.common import SLOT_BITS, ids_and_texts, in_slot_map, slot_map
from featureframe.session import new_shared_folder, settle, ship_package

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of a mention that tell its context from others; terms may stand anywhere.
REACH = 8
THRESHOLD = 0.8
LEAST_CONTEXTS = 2

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")

_SPAN = "struct<start:int,kind:int,end:int>"
_SPAN_TYPE = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_MENTION = "struct<entity:string,context:long,twice:array<string>>"
_MENTION_TYPE = pa.struct([("entity", pa.string()), ("context", pa.int64()), ("twice", pa.list_(pa.string()))])
#: A place is start * 2**32 + end, which takes a quarter of a struct's room in a shuffle.
_TERM = "struct<term:string,slot:int,capital:boolean,places:array<long>>"
_TERM_TYPE = pa.struct(
    [("term", pa.string()), ("slot", pa.int32()), ("capital", pa.bool_()), ("places", pa.list_(pa.int64()))]
)


def _emails(text: str):
    """Each match has one @: its whole run of local characters on the left, its domain on the right."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str):
    """Every four numbers in a row of a dotted chain, from its left."""
    for chain in _NUMBERS.finditer(text):
        start, parts = chain.start(), chain[0].split(".")
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in four):
                yield start, end
            start = end + 1


def _passes_luhn(digits: str) -> bool:
    doubled = (2 * int(digit) for digit in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(value - 9 * (value > 9) for value in doubled)) % 10 == 0


def _cards(text: str):
    for match in _CARD.finditer(text):
        digits = _OTHER.sub("", match[0])
        if 14 <= len(digits) <= 19 and _passes_luhn(digits):
            yield match.span()


def _phones(text: str):
    for match in _PHONE.finditer(text):
        if 10 <= len(_OTHER.sub("", match[0])) <= 15:
            yield match.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all entities, in that order."""
    found = [(start, 0, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        for kind, find in ((1, _addresses), (2, _cards), (3, _phones)):
            found += [(start, kind, end) for start, end in find(text)]
    return sorted(found)


def _slot(word: str) -> int:
    return xxhash.xxh32_intdigest(word) & ((1 << SLOT_BITS) - 1)


def _mentions(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[dict], list[dict]]:
    """Each entity with its context, and each term with its places; words inside an entity are none."""
    taken = bytearray(len(text))
    for start, _, end in spans:
        taken[start:end] = b"\1" * (end - start)
    words = [(*word.span(), word[0]) for word in _WORD.finditer(text) if 1 not in taken[word.start() : word.end()]]
    starts = [word[0] for word in words]
    about: dict[str, list[tuple[str, ...]]] = {}
    for start, kind, end in spans:
        value = text[start:end].lower() if kind < 2 else _OTHER.sub("", text[start:end])
        before, after = bisect_left(starts, start), bisect_left(starts, end)
        near = tuple(word[2].lower() for word in words[max(0, before - REACH) : after + REACH])
        about.setdefault(f"{KINDS[kind]}:{value}", []).append(near)
    terms: dict[str, dict] = {}
    for start, end, word in words:
        name = word.lower()
        term = terms.setdefault(name, {"term": name, "slot": _slot(name), "capital": False, "places": []})
        term["capital"] |= word[0].isupper()
        term["places"].append(start << 32 | end)
    mentions = []
    for entity, nears in about.items():
        context = xxhash.xxh3_64_intdigest("\n".join(map(" ".join, nears))) - (1 << 63)
        seen = Counter(name for near in set(nears) for name in set(near))
        twice = [name for name, count in seen.items() if count >= LEAST_CONTEXTS]
        mentions.append({"entity": entity, "context": context, "twice": twice})
    return mentions, list(terms.values())


def _entities(docs: DataFrame) -> DataFrame:
    """Every row's entities, and the terms of rows that have any."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = part.column("text").to_pylist()
                spans = [base_spans(text) for text in texts]
                found = [_mentions(text, own) if own else ([], []) for text, own in zip(texts, spans, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("content"),
                        pa.array([[dict(zip(("start", "kind", "end"), one, strict=True)) for one in own] for own in spans], pa.list_(_SPAN_TYPE)),
                        pa.array([mentions for mentions, _ in found], pa.list_(_MENTION_TYPE)),
                        pa.array([terms for _, terms in found], pa.list_(_TERM_TYPE)),
                    ],
                    ["doc_id", "content", "base", "mentions", "terms"],
                )

    return docs.mapInArrow(
        run, f"doc_id long, content long, base array<{_SPAN}>, mentions array<{_MENTION}>, terms array<{_TERM}>"
    )


def _with_content(docs: DataFrame) -> DataFrame:
    return ids_and_texts(docs).withColumn("content", F.xxhash64("text"))


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, slot, n_t``: in how many documents each of ``terms`` (their ``slot``) is, and maybe some others."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(slot_map(terms))

    def run(batches):
        wanted = shared.value
        counts: Counter[str] = Counter()
        known: dict[str, bool] = {}

        def is_wanted(word: str) -> bool:
            if (found := known.get(word)) is None:
                if len(known) > 400_000:
                    known.clear()
                slot = _slot(word)
                found = known[word] = bool(wanted[slot >> 3] >> (slot & 7) & 1)
            return found

        for batch in batches:
            for text in batch.column("text"):
                counts.update(filter(is_wanted, set(_WORD.findall(text.as_py().lower()))))
        if counts:
            columns = [pa.array(list(counts)), pa.array(map(_slot, counts), pa.int32()), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["term", "slot", "n"])

    found = docs.select("text").mapInArrow(run, "term string, slot int, n long")
    return found.groupBy("term", "slot").agg(F.sum("n").alias("n_t"))


def _with_terms_of(found: DataFrame, slots: DataFrame) -> DataFrame:
    """``found`` with those ``terms`` only whose slot is one of ``slots``, and maybe some others."""
    shared = found.sparkSession.sparkContext.broadcast(slot_map(slots))
    column = found.columns.index("terms")

    def run(batches):
        for batch in batches:
            terms = batch.column("terms")
            every = terms.flatten()
            kept = in_slot_map(shared.value, every.field("slot").to_numpy(zero_copy_only=False))
            before = np.concatenate([[0], np.cumsum(kept)])
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
            thinned = pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), every.filter(pa.array(kept)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:column], thinned, *batch.columns[column + 1 :]], batch.schema.names)

    return found.mapInArrow(run, found.schema)


def _same(one: DataFrame, other: DataFrame) -> DataFrame:
    """``one`` with what ``other`` (one row for each ``doc_id, content``) has on its document, if anything."""
    other = other.withColumnsRenamed({"doc_id": "own_id", "content": "own_content"})
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("content") == F.col("own_content"))
    return one.join(other, same, "left").drop("own_id", "own_content")


def _disclosing(found: DataFrame, mentions: DataFrame, having: DataFrame, counts: DataFrame, n: int, threshold: float) -> DataFrame:
    """``entity, term, slot``: the terms that tell of the entity; ``counts`` has those that may."""
    told = mentions.join(having, "entity").groupBy("doc_id", "content")
    told = told.agg(F.collect_list(F.struct("entity", "context", "twice", "n_e", "lone")).alias("told"))
    known = F.transform("terms", lambda term: F.struct(*(term[name].alias(name) for name in ("term", "slot", "capital"))))
    own = _of_documents(_with_terms_of(found, counts), F.first(known).alias("terms"))
    of_document = _same(own, told).select("rows", "terms", F.inline("told"))
    # an entity with one context needs no other words
    repeated = lambda term: F.array_contains("twice", term["term"])
    some = F.filter("terms", lambda term: ~F.col("lone") | term["capital"] | repeated(term))
    some = F.transform(
        some,
        lambda term: F.struct(
            term["term"].alias("term"), term["slot"].alias("slot"), term["capital"].alias("capital"), repeated(term).alias("repeated")
        ),
    )
    near = of_document.select("entity", "context", "n_e", "lone", "rows", F.inline(some))
    pairs = near.groupBy("entity", "n_e", "lone", "term", "slot").agg(
        F.count("*").alias("n_et"),
        F.sum("rows").alias("rows"),
        ((F.count_distinct("context") >= LEAST_CONTEXTS) | F.max("repeated")).alias("counts"),
        F.max("capital").alias("capital"),
    )
    name = F.col("lone") & F.col("capital")
    information = F.log2(F.lit(float(n)) / F.col("n_e"))
    tells = F.log2(F.col("n_et") * float(n) / (F.col("n_e") * F.col("n_t"))) >= threshold * information
    return (
        pairs.filter(F.col("counts") | name)
        .join(counts, ["term", "slot"])
        .filter((information > 0) & ((F.col("counts") & tells) | (name & (F.col("n_t") <= F.col("rows")))))
        .select("entity", "term", "slot")
    )


def _of_documents(found: DataFrame, *columns: Column) -> DataFrame:
    """One row, with their number ``rows``, of those that repeat an id and its text."""
    return found.filter(F.size("mentions") > 0).groupBy("doc_id", "content").agg(F.count("*").alias("rows"), *columns)


def _counts_of_terms(texts: DataFrame, found: DataFrame, having: DataFrame, n: int, threshold: float) -> DataFrame:
    """``term, slot, n_t`` of terms rare enough to disclose some entity."""
    widest = F.greatest(
        F.lit(float(n)) ** (1 - threshold) * F.col("n_e") ** threshold, F.when(F.col("lone"), F.col("copies")).otherwise(0)
    )
    # rounding must not decide
    most = 1.000001 * (having.agg(F.max(widest)).first()[0] or 0)
    terms = found.filter(F.size("mentions") > 0).select(F.explode("terms.slot").alias("slot"))
    return settle(_document_counts(texts, terms).filter(F.col("n_t") <= most))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(spans, lambda span: F.concat_ws(":", names[span["kind"]], span["start"], span["end"])), ","
    )


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, content, base, spans``: entities, and entities with disclosing terms, by start.

    ``content`` is xxhash64 of the text; spans are ``kind:start:end``, joined by commas.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = _with_content(docs)
    folder = new_shared_folder(spark, "entities")
    _entities(texts).write.parquet(folder)
    found = spark.read.parquet(folder)
    mentions = _of_documents(found, F.first("mentions").alias("mentions")).select("doc_id", "content", "rows", F.inline("mentions"))
    having = mentions.groupBy("entity").agg(
        F.count("*").alias("n_e"), F.sum("rows").alias("copies"), (F.count_distinct("context") < LEAST_CONTEXTS).alias("lone")
    )
    having, n = settle(having), texts.count()
    counts = _counts_of_terms(texts, found, having, n, threshold)
    told = settle(_disclosing(found, mentions.drop("rows"), having, counts, n, threshold))
    names = mentions.join(told.groupBy("entity").agg(F.collect_list("term").alias("names")), "entity").groupBy("doc_id", "content")
    names = names.agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))
    found = _with_terms_of(found, told)
    held = F.transform("terms", lambda term: F.struct(term["term"].alias("term"), term["places"].alias("places")))
    disclosing = F.filter("terms", lambda term: F.array_contains("names", term["term"]))
    places = F.flatten(F.transform(disclosing, lambda term: term["places"]))
    kind = F.lit(KINDS.index("term")).alias("kind")
    ends = lambda place: place.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("end")
    added = F.transform(places, lambda place: F.struct(F.shiftright(place, 32).cast("int").alias("start"), kind, ends(place)))
    every = F.when(F.col("names").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", added)))
    return _same(found.select("doc_id", "content", "base", held.alias("terms")), names).select("doc_id", "content", "base", every.alias("spans"))


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def described(found: DataFrame) -> DataFrame:
    """One row per document with its counts, and its spans as text."""
    counts = [_count(F.col("base"), kind).alias(f"n_{KINDS[kind]}") for kind in range(4)]
    return found.select("doc_id", *counts, _joined(F.col("base")).alias("base"), _joined(F.col("spans")).alias("spans"))


def _put_names(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans become one, named by the first."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def sanitise(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the names of kinds in place of personal data; all columns stay, null texts too."""
    found = find_personal_data(docs, threshold).filter(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("own_id"), F.col("content").alias("own_content"), "spans").distinct()

    @F.pandas_udf(StringType())
    def put_names(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                text if own is None else _put_names(text, [(one["start"], one["kind"], one["end"]) for one in own])
                for text, own in zip(texts, spans, strict=True)
            ],
            dtype=object,
        )

    row = F.struct(*(F.col(f"`{name.replace('`', '``')}`") for name in docs.columns)).alias("row")
    rows = docs.select(row).withColumn("content", F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("own_id")) & (F.col("content") == F.col("own_content"))
    text = put_names(F.col("row.text").cast("string"), F.col("spans")).alias("text")
    columns = [text if name == "text" else F.col("row")[name].alias(name) for name in docs.columns]
    return rows.join(found, same, "left").select(*columns)
