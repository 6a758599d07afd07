"""Exact, near and substring duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from featureframe.llm import exact_dedup, near_dedup, substring_dedup
from featureframe.llm.components import connected_components
from featureframe.llm.shingles import MinHash
from tests.llm.conftest import SCHEMA, TEXTS


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def least(ids):
    return min((id for id in ids if id is not None), default=None)


def test_exact_groups(docs):
    groups = defaultdict(list)
    for doc_id, text in TEXTS:
        groups["".join(words(text))].append((doc_id, text or ""))
    expected = Counter()
    for plain, rows in groups.items():
        longest = max(len(text) for _, text in rows)
        keep = least(doc_id for doc_id, text in rows if len(text) == longest)
        for doc_id, _ in rows:
            expected[doc_id, keep, len(rows), doc_id == keep, hashlib.sha256(plain.encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.find_duplicates(docs).collect())) == expected


def test_exact_copies_leave_one_row_with_all_columns(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({"".join(words(text)) for _, text in TEXTS})
    assert {row.doc_id for row in rows} >= {2, 5, 15} and all(row.block == 1 for row in rows)


def test_hash_collisions_stay_apart(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_hash", lambda text: F.lit(b"\0"))
    sizes = {row.keep_id: row.group_size for row in exact_dedup.find_duplicates(docs).collect()}
    assert sizes[2] == 3 and sizes[6] == 1


def test_no_exact_duplicates(no_docs):
    assert exact_dedup.find_duplicates(no_docs).count() == 0 == exact_dedup.keep_first(no_docs).count()


def brute_passages(texts, window):
    first = {}
    order = sorted(texts, key=lambda row: (row[0] is not None, row[0] or 0))
    rank = {doc_id: n for n, doc_id in enumerate(dict.fromkeys(doc_id for doc_id, _ in order))}
    for doc_id, text in order:
        own = words(text)
        for at in range(len(own) - window + 1):
            first.setdefault(tuple(own[at : at + window]), rank[doc_id])
    for doc_id, text in texts:
        own = words(text)
        removed = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at : at + window])] < rank[doc_id]:
                removed |= set(range(at, at + window))
        yield doc_id, len(own), len(removed), " ".join(word for at, word in enumerate(own) if at not in removed)


def passages_of(df):
    return Counter((row.doc_id, row.n_words, row.n_removed, row.kept) for row in df.collect())


def test_passages(docs):
    found = substring_dedup.remove_shared_passages(docs)
    assert passages_of(found) == Counter(brute_passages(TEXTS, 13))
    spans = {row.doc_id: row.factors for row in found.collect()}
    assert [tuple(span) for span in spans[8]] == [(0, 30)] and spans[-5] == []


def test_passages_at_random(make_docs):
    chance = random.Random(5)
    pool = [[f"w{chance.randint(0, 40)}" for _ in range(chance.randint(3, 30))] for _ in range(12)]
    texts = [(n, " ".join(word for _ in range(chance.randint(0, 6)) for word in chance.choice(pool))) for n in range(120)]
    found = substring_dedup.remove_shared_passages(make_docs(texts), window=5)
    assert passages_of(found) == Counter(brute_passages(texts, 5))


def test_work_of_a_block_does_not_grow_with_the_parts(make_docs):
    table = pa.table({"doc_id": [1], "text": [" ".join(f"w{n}" for n in range(60))], "block": pa.array([0], pa.int64())})
    rows = substring_dedup._index_entries(13, 10**9)(table)
    assert 0 < rows.num_rows <= 48 and sum(map(len, rows.column("phrases").to_pylist())) == 48 * 8


def test_no_passages(no_docs):
    assert substring_dedup.remove_shared_passages(no_docs).count() == 0


def shingles(text, width):
    own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[at : at + width]) for at in range(len(own) - width + 1)}


def brute_components(texts, width):
    sets = {doc_id: shingles(text, width) for doc_id, text in texts}
    name = {doc_id: doc_id for doc_id in sets}

    def root(doc_id):
        while name[doc_id] != doc_id:
            doc_id = name[doc_id]
        return doc_id

    ids = sorted(doc_id for doc_id in sets if sets[doc_id])
    for at, one in enumerate(ids):
        for other in ids[:at]:
            common = len(sets[one] & sets[other])
            if 100 * common >= 80 * (len(sets[one]) + len(sets[other]) - common):
                a, b = sorted((root(one), root(other)))
                name[b] = a
    return {doc_id: (len(own), root(doc_id)) for doc_id, own in sets.items()}


def test_near_copies_at_random(make_docs):
    """Chains and stars of edits, where many pairs lie about the threshold."""
    chance = random.Random(9)
    texts = []
    for group in range(8):
        base = [f"g{group}w{n}" for n in range(60)]
        for _ in range(25):
            own = list(base)
            for _ in range(chance.randint(0, 6)):
                own[chance.randrange(60)] = f"x{chance.randint(0, 10**6)}"
            texts.append((len(texts), " ".join(own)))
            if chance.random() < 0.3:
                base = own
    rows = near_dedup.find_near_duplicates(make_docs(texts), width=2).collect()
    expected = brute_components(texts, 2)
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == expected
    assert all(row.kept == (row.doc_id == row.component_id) for row in rows)


def test_chunks_of_a_centre_meet(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    chance = random.Random(2)
    base = [f"w{n}" for n in range(50)]
    texts = []
    for n in range(60):
        own = list(base)
        for _ in range(chance.randint(3, 7)):
            own[chance.randrange(50)] = f"x{chance.randint(0, 10**6)}"
        texts.append((n, " ".join(own)))
    rows = near_dedup.find_near_duplicates(make_docs(texts), width=2).collect()
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == brute_components(texts, 2)


def test_estimates_of_small_sets():
    chance = np.random.default_rng(5)
    hasher = MinHash(near_dedup.BANDS, near_dedup.ROWS, near_dedup.BITS)
    sets = [np.sort(chance.integers(0, 1 << 64, 5, dtype=np.uint64)) for _ in range(5_000)]
    one, other = (hasher.packed(hasher(some)) for some in (sets, [np.delete(own, 2) for own in sets]))
    differing = one ^ other
    merged = (differing | (differing >> 1)) & near_dedup._low_bits(2)
    agreeing = 1 - np.bitwise_count(merged.view(np.uint64)).sum(axis=1) / hasher.minima
    assert ((agreeing - 0.25) / 0.75 >= 0.8 - 0.155).all()


def test_near_copies_of_awkward_documents(docs):
    rows = near_dedup.find_near_duplicates(docs, width=2).collect()
    assert len(rows) == len(TEXTS)
    found = {(row.doc_id, row.n_shingles): (row.component_id, row.kept) for row in rows}
    assert found[3, 0] == (3, True) and found[5, 0] == (5, True)
    assert found[10, len(shingles(TEXTS[9][1], 2))] == (9, False)
    assert found[6, 1] == (6, True) and found[14, 1] == (14, True)
    assert found[None, 3] == (None, True)
    assert {row.component_id for row in rows if row.doc_id == 16} == {16}


def test_one_of_each_keeps_all_columns(docs):
    kept = near_dedup.keep_one_of_each(docs, width=2)
    assert kept.columns == docs.columns
    ids = Counter(row.doc_id for row in kept.collect())
    assert ids[9] == 1 and 10 not in ids and ids[None] == 1 and ids[3] == 1


def test_no_near_copies(spark, no_docs):
    assert near_dedup.find_near_duplicates(no_docs).count() == 0
    assert near_dedup.find_near_duplicates(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 1
    assert SCHEMA.startswith("doc_id long")


def test_components_of_long_paths(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, 103), (103, 101), (7, 7), (200, 200)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert Counter(tuple(row) for row in found) == Counter([(n, 0) for n in range(41)] + [(100, 100), (103, 100), (101, 100)])


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
