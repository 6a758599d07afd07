"""Line dedup, the manifest and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from featureframe.llm import line_dedup, merkle, spelling
from tests.llm.conftest import SCHEMA, TEXTS, documents

SHARED = "A line that many documents hold"
LINED = [
    *TEXTS,
    *((100 + n, f"own line number {n} of this text\n  {SHARED}\t\n{SHARED.upper()}\nshort\nshort") for n in range(7)),
    (107, f"{SHARED}\n\n{SHARED}"),
    (107, f"{SHARED}\nrows that repeat an id are one document"),
    (108, "rows that repeat an id are one document\nrows that repeat an id are one document"),
    (None, f"{SHARED}\n"),
    (None, f"{SHARED}\nelse"),
    (-(1 << 63), f"x\n{SHARED}\ny"),
    ((1 << 63) - 1, "x" * 19 + "\n" + "é" * 20 + "\n" + "\x1c" + "z" * 19),
    (201, "x" * 19 + "\n" + "é" * 20 + "\n" + "\x1c" + "z" * 19),
    (202, "x" * 19 + "\n" + "É" * 20 + "\n" + "\x1c" + "Z" * 19),
    (203, "x" * 19 + "\n" + "é" * 20 + "\nlast without end"),
    (204, "\n" * 5000 + SHARED),
]


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))


def brute_lines(texts):
    holders = defaultdict(set)
    for doc_id, text in texts:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders[key_of(line)].add(doc_id)
    last = {key: max(ids, key=lambda id: (id is not None, id or 0)) for key, ids in holders.items() if len(ids) >= 3}
    for doc_id, text in texts:
        every = (text or "").split("\n")
        kept = [line for line in every if last.get(key_of(line), doc_id) == doc_id]
        yield doc_id, len(every), len(every) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("least_large", [0, 10**9])
def test_lines(spark, make_docs, monkeypatch, least_large):
    """Both ways: every repeated key counts as frequent, and none does."""
    monkeypatch.setattr(line_dedup, "LEAST_LARGE", least_large)
    monkeypatch.setattr(line_dedup, "LARGE_SHARE", 0.01)
    docs = make_docs(LINED)
    kept = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs))
    assert Counter(map(tuple, kept.collect())) == Counter(brute_lines(LINED))


def test_lines_at_random(make_docs):
    chance = random.Random(4)
    pool = [f"{'line' * chance.randint(3, 7)} {n % 40}" for n in range(90)]
    texts = [(n, "\n".join(chance.choice(pool) for _ in range(chance.randint(0, 30)))) for n in range(80)]
    docs = make_docs(texts)
    kept = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs))
    assert Counter(map(tuple, kept.collect())) == Counter(brute_lines(texts))


def test_bitmaps_are_runs(make_docs):
    docs = make_docs([(n, f"{SHARED}\n{SHARED}\nown {n}\n{SHARED}") for n in range(3)])
    rows = {row.doc_id: row for row in line_dedup.keep_bitmaps(docs).collect()}
    assert set(rows) == {0, 1} and rows[0].n_dropped == 3
    assert [tuple(run) for run in rows[1].dropped] == [(0, 2), (3, 1)]


def test_line_dedup_runs_no_python_in_tasks(spark, docs):
    kept = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs))
    plan = kept._jdf.queryExecution().toString()
    assert not re.search("Python|InArrow|InPandas|ExternalRDD", plan)


def test_no_lines(no_docs):
    assert line_dedup.keep_bitmaps(no_docs).count() == 0
    assert line_dedup.kept_lines(no_docs, line_dedup.keep_bitmaps(no_docs)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    return sha("".join("-" if value is None else f"{len(str(value).encode())}:{value}" for value in row))


def brute_tree(leaves):
    """The root, and each leaf's pairs of (left, right) text, by levels."""
    paths, level, members = [[] for _ in leaves], list(leaves), [[n] for n in range(len(leaves))]
    while len(level) > 1:
        runs = [range(start, min(start + 3, len(level))) for start in range(0, len(level), 3)]
        for run in runs:
            for node in run:
                beside = ("".join(level[n] for n in run if n < node), "".join(level[n] for n in run if n > node))
                for leaf in members[node]:
                    paths[leaf].append(beside)
        level = [sha("".join(level[n] for n in run)) for run in runs]
        members = [sum((members[n] for n in run), []) for run in runs]
    return level[0], paths


def brute_manifest(rows):
    """``(doc_id, source, at, leaf, path, subroot, root)`` of rows of the five fields."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, brute_leaf(row)))
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    trees = [brute_tree([one[2] for one in sorted(sources[name])]) for name in names]
    root, tops = brute_tree([subroot for subroot, _ in trees])
    for name, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for at, ((there, doc_id, leaf), path) in enumerate(zip(sorted(sources[name]), paths, strict=True)):
            yield doc_id if there else None, name, at, leaf, tuple(path + top), subroot, root


def manifest_rows(df):
    found = merkle.manifest(df)
    rows = found.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert all(row.folded == row.root for row in rows)
    return Counter((row.doc_id, row.source, row["at"], row.leaf, tuple(map(tuple, row.path)), row.subroot, row.root) for row in rows)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, "b": 1}, {"a": 3, None: 10, "": 4}, {"a": 100, "é": 2, "z": 9, "Z": 28, "b": 27}])
@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest(spark, monkeypatch, sizes, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    chance = random.Random(2)
    rows = [
        (chance.choice([None, 5, *range(-500, 500)]), name, chance.choice([None, "de", ""]), chance.choice([None, 7, -1]), chance.choice([None, "", "é\n\n😀", "12:x"]))
        for name, size in sizes.items()
        for _ in range(size)
    ]
    assert manifest_rows(spark.createDataFrame(rows, FIELDS).repartition(3)) == Counter(brute_manifest(rows))


def test_manifest_of_awkward_documents(spark):
    """Columns with clashing names, and names of the operator's own."""
    docs = documents(spark, TEXTS).withColumns({"n_chars": F.lit(3), **{name: F.lit(1) for name in ("tree", "order", "digest", "held", "at", "path", "root", "number", "range", "of")}})
    rows = [(doc_id, "src0", "en", 3, text) for doc_id, text in TEXTS]
    assert manifest_rows(docs) == Counter(brute_manifest(rows))


def test_a_changed_row_is_found(spark):
    rows = [(n, "s", None, n, f"text {n}") for n in range(30)]
    docs = spark.createDataFrame(rows, FIELDS)
    found = merkle.manifest(docs, forged=merkle.leaf({"text": F.when(F.col("doc_id") % 3 == 0, "other").otherwise(F.col("text"))}))
    found = found.withColumn("good", merkle.folded(F.col("forged"), F.col("path")) == F.col("root"))
    assert {row.doc_id for row in found.collect() if not row.good} == set(range(0, 30, 3))


def seconds_of_paths(spark, monkeypatch, depth):
    """The paths of 2,000 rows of a full block of ``depth`` levels."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    size = merkle.FAN**depth
    nodes = spark.range(size).select(F.lit("s").alias("tree"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.struct("id").alias("held"))
    blocks = merkle._blocks(nodes).select("levels").localCheckpoint()
    paths = blocks.select(F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda n: merkle._siblings(F.col("levels"), (n * 7919 % size).cast("int"))))
    taken = []
    for _ in range(3):
        began = time.perf_counter()
        paths.write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - began)
    return min(taken)


def test_a_path_costs_levels_not_blocks(spark, monkeypatch):
    """81 times the leaves are four levels more; work that grows with the block takes several seconds."""
    narrow, wide = (seconds_of_paths(spark, monkeypatch, depth) for depth in (5, 9))
    assert wide < 5 * narrow + 1


def test_no_manifest(spark):
    assert merkle.manifest(spark.createDataFrame([], FIELDS)).count() == 0


def is_near(one, other):
    short, long = sorted((one, other), key=len)
    if len(short) == len(long):
        return sum(a != b for a, b in zip(short, long, strict=True)) == 1
    return len(long) == len(short) + 1 and any(long[:n] + long[n + 1 :] == short for n in range(len(long)))


def brute_words(texts, one_in):
    found = Counter()
    for doc_id, text in texts:
        for word in re.findall("[a-zÀ-ÿ]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            chance = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if one_in and chance % one_in == 0:
                word = word[: chance % len(word)] + word[chance % len(word) + 1 :]
            found[word] += 1
    return {word: n for word, n in found.items() if len(word) >= 6 and n >= 5}


def brute_variants(words):
    near = {word: [other for other in words if is_near(word, other)] for word in words}
    forms = {}
    for word, n in words.items():
        best = min(near[word], key=lambda other: (-words[other], other), default=None)
        forms[word] = best if best is not None and words[best] >= 5 * n else None
    for word, n in words.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        yield word, forms[word], root, n, len(near[word]), words.get(forms[word])


@pytest.mark.parametrize("one_in", [None, 3, 1])
def test_words(make_docs, one_in):
    chance = random.Random(1)
    stems = ["straße", "ÉCOLEécole", "thousand", "a" * 50, "naïveté×÷", "Letters"]
    texts = [*TEXTS, *((n, " ".join(chance.choice(stems) for _ in range(40)) + "_x1thousand") for n in range(30))]
    counted = spelling.count_words(make_docs(texts), alter_one_in=one_in)
    assert {row.word: row.n for row in counted.collect()} == brute_words(texts, one_in)


def test_variants_at_random(spark):
    """Every kind of change at every place, anagrams, repeated letters, chains of forms and ties."""
    chance = random.Random(8)
    letters = "abcéÿz"
    words = {"".join(chance.choice(letters[:3]) for _ in range(chance.randint(6, 8))) for _ in range(250)}
    for _ in range(500):
        word = chance.choice(sorted(words))
        at = chance.randint(0, len(word))
        words.add(chance.choice([word[:at] + chance.choice(letters) + word[at:], word[:at] + word[at + 1 :], word[:at] + chance.choice(letters) + word[at + 1 :]]))
    words = {word: 5 ** chance.randint(1, 6) for word in sorted(words) if len(word) >= 6}
    found = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3))
    expected = Counter(brute_variants(words))
    assert Counter(map(tuple, found.collect())) == expected
    assert max(one[4] for one in expected) > 5 and sum(one[1] is not None and one[2] != one[1] for one in expected) > 5


def test_a_longest_chain_of_forms(spark):
    words = {"a" * n: 5 ** (n - 5) for n in range(6, 20)}
    found = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {row.root for row in found.collect()} == {"a" * 19}


def test_near_words_share_a_signature():
    for one, other in (("letter", "lettex"), ("letter", "letters"), ("aaaaaa", "aaaaaaa"), ("xletter", "letter"), ("abcdef", "abcxdef")):
        keys = [dict(spelling.signatures(word, 3)) for word in (one, other)]
        assert set(keys[0]) & set(keys[1])


def test_no_words(no_docs, spark):
    assert spelling.count_words(no_docs).count() == 0
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_schema_of_extra_columns(spark, docs):
    assert set(SCHEMA.replace(",", "").split()) & {"position", "content"} == {"content"}
    more = docs.withColumns({name: F.lit("x") for name in ("position", "high", "low", "range", "word", "n", "line")})
    assert line_dedup.kept_lines(more, line_dedup.keep_bitmaps(more)).count() == len(TEXTS)
    assert spelling.count_words(more).count() == len(brute_words(TEXTS, None))
