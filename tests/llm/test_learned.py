"""Nearest vectors, toxicity, personal data, language."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureframe.llm import language, nearest, personal_data, toxicity
from featureframe.llm.common import id_remainder
from tests.llm.conftest import TEXTS


def brute_nearest(rows, k):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        if vec_id not in usable or vector < usable[vec_id]:
            usable[vec_id] = vector
    for query, vector in usable.items():
        if query % 5 == 0:
            scores = []
            for other, candidate in usable.items():
                if other != query and len(candidate) == len(vector):
                    total = 0.0
                    for a, b in zip(vector, candidate, strict=True):
                        total += a * b
                    scores.append((-total, other))
            for rank, (score, other) in enumerate(sorted(scores)[:k], 1):
                yield query, rank, other, -score


@pytest.mark.parametrize("block", [7, 4096])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", block)
    chance = np.random.default_rng(4)
    rows = [(n, [float(x) for x in chance.normal(size=8).astype(np.float32)]) for n in range(120)]
    rows += [(200 + n, rows[3][1]) for n in range(60)]  # one vector a third of all rows share
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [math.nan] * 8)]
    rows += [(305, [math.inf] + [0.0] * 7), (None, [1.0] * 8), (310, [1.0, 2.0]), (315, [2.0, 1.0]), (400, [5.0])]
    rows += [(20, [9.0] * 8), (21, [float(x) for x in rows[21][1]]), (330, [1e-320] + [0.0] * 7), (335, [1e150] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    found = nearest.nearest(frame, F.col("vec_id") % 5 == 0, k=20).collect()
    assert sorted(map(tuple, found)) == sorted(brute_nearest(rows, 20))


def test_nearest_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest.nearest(empty, F.col("vec_id") % 20 == 0, k=20).count() == 0


def sentence(chance, insult=None):
    words = [chance.choice("abcdefgh") + chance.choice(["one", "two", "ern", "ing", "ato"]) for _ in range(8)]
    if insult:
        words[3] = insult
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    chance = random.Random(8)
    texts, labels = [], []
    for n in range(1500):
        toxic = n % 4 == 0
        lines = [sentence(chance) for _ in range(chance.randint(2, 12))]
        if toxic:
            lines[chance.randrange(len(lines))] = sentence(chance, chance.choice(["zounds", "zoundest", "knave"]))
        texts.append((n, " ".join(lines)))
        labels.append((n, int(toxic) if n % 50 else None))
    labels += [(None, 1), (10**6, 1), (4, 1)]
    return make_docs(texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_held_out_documents(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels, learn=id_remainder(5) != 0)
    rows = toxicity.score(docs, model).withColumn("held_out", id_remainder(5) == 0).collect()
    held_out = [row for row in rows if row.held_out]
    right = sum((row.score >= 0.5) == (row.doc_id % 4 == 0) for row in held_out)
    assert len(held_out) > 200 and right / len(held_out) > 0.98
    assert all(0 <= row.score <= 1 for row in rows)
    texts = {row.doc_id: row.text for row in docs.collect()}
    spans = [texts[row.doc_id][one.start : one.end] for row in rows if row.doc_id % 4 == 0 for one in row.sentences]
    assert spans and sum(bool(re.search("zound|knave", one)) for one in spans) / len(spans) > 0.95
    clean = toxicity.drop_toxic(docs, model)
    assert clean.columns == docs.columns
    assert {row.doc_id for row in clean.collect()} == {row.doc_id for row in rows if row.score < 0.5}


def test_toxicity_of_long_clean_texts(labelled, make_docs):
    model = toxicity.train(*labelled, learn=F.lit(True))
    chance = random.Random(9)
    long = [" ".join(sentence(chance) for _ in range(10**5)), "Plain words here. " * 10**5]
    texts = [(1, sentence(chance)), (2, long[0]), (3, long[1]), (4, f"{long[0]} {sentence(chance, 'knave')}")]
    scores = {row.doc_id: row.score for row in toxicity.score(make_docs(texts), model).collect()}
    assert scores[1] < 0.05 and scores[2] < 0.05 and scores[3] < 0.05 and scores[4] > 0.5
    assert {row.doc_id for row in toxicity.drop_toxic(make_docs(texts), model).collect()} == {1, 2, 3}


def test_toxicity_of_awkward_documents(labelled, docs, no_docs):
    model = toxicity.train(*labelled, learn=F.lit(True))
    scores = toxicity.score(docs, model).collect()
    assert len(scores) == len(TEXTS) and {row.score for row in scores if row.doc_id in (3, 4, 5, 13)} >= {0.0}
    assert toxicity.score(no_docs, model).count() == 0 == toxicity.drop_toxic(no_docs, model).count()


def test_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    for labels, expected in ((none, 0.0), (one, 1.0)):
        model = toxicity.train(docs, labels, learn=F.lit(True))
        assert {row.score for row in toxicity.score(docs, model).collect()} == {expected}


# The base patterns as they are specified
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    values = [int(digit) * (1 + at % 2) for at, digit in enumerate(reversed(digits))]
    return sum(value - 9 * (value > 9) for value in values) % 10 == 0


def brute_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            kept = (
                True,
                kind == 1 and all(int(part) <= 255 for part in match[0].split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            )[kind]
            if kept:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def test_base_spans_at_random():
    chance = random.Random(3)
    letters = list("aZ9._%+-@@ .0123456789--()+  12é")
    for _ in range(20_000):
        text = "".join(chance.choice(letters) for _ in range(chance.randint(0, 40)))
        assert personal_data.base_spans(text) == brute_spans(text), text
    assert personal_data.base_spans("0" * 5000 + ".1.2.3") == [(0, 1, 5006)]


def test_long_texts_take_linear_time():
    for piece in ("a", "1", "1.", "+1", "1 ", "@", "a@", ".", "a.b@"):
        personal_data.base_spans(piece * 100_000)


def test_terms_that_only_stand_with_an_entity(make_docs):
    chance = random.Random(6)
    common = [f"{a}{b}" for a in "bcdfgh" for b in ("at", "et", "it", "ot")]

    def some(n):
        return " ".join(chance.choice(common) for _ in range(n))

    texts = [(n, f"{some(30)} write to jo@x.org or ask Quillfeather {some(30)}") for n in range(5)]
    texts += [(10 + n, f"{some(20)} reach lu@y.org or Once{'abcdefghij'[n]} {some(9)}") for n in range(5)]
    texts += [(20, f"copied only{some(3)} by ki@z.org zyzzyva {some(5)}")] * 3
    texts += [(30 + n, some(60)) for n in range(100)]
    rows = personal_data.described(personal_data.find_personal_data(make_docs(texts))).collect()
    terms = {}
    for row in rows:
        text = dict(texts)[row.doc_id]
        for span in filter(None, row.spans.split(",")):
            kind, start, end = span.split(":")
            if kind == "term":
                terms.setdefault(row.doc_id, set()).add(text[int(start) : int(end)])
    assert all("Quillfeather" in terms[n] for n in range(5))
    assert all(not any("Once" in term for term in terms.get(10 + n, ())) for n in range(5))
    assert 20 not in terms and not any(terms.get(30 + n) for n in range(100))
    assert not any(term in common for own in terms.values() for term in own)


def test_terms_far_from_an_entity_and_of_one_context(make_docs):
    chance = random.Random(7)

    def some(n):
        return " ".join(chance.choice("bcdfgh") + chance.choice(["at", "et", "it", "ot"]) for _ in range(n))

    texts = [(n, f"Quillfeather {some(40)} write to jo@x.org {some(40)} yours, quillfeather") for n in range(5)]
    once = f"{some(30)} call ed@w.org {some(30)}\n\nOssiander {some(9)} mumblecrust"
    texts += [(20, once), (20, once), (21, f"{some(20)} zu@v.org Elsewhere {some(20)} zu@v.org Elsewhere")]
    texts += [(30 + n, some(60) + " Elsewhere") for n in range(100)]
    texts.append((22, f"{some(20)} tersely um@t.org {some(20)} tersely um@t.org {some(20)}"))
    frame = make_docs(texts)
    clean = personal_data.sanitise(frame).collect()
    assert not any("quillfeather" in row.text.lower() for row in clean)
    assert sum(row.text.count("[TERM]") >= 2 for row in clean if row.doc_id < 5) == 5
    lone = [row.text for row in clean if row.doc_id == 20]
    assert len(lone) == 2 and all("Ossiander" not in text and "mumblecrust" in text for text in lone)
    assert all(("Elsewhere" in row.text) for row in clean if row.doc_id > 22)
    assert [row.text.count("tersely") for row in clean if row.doc_id == 22] == [0]


def test_sanitised_documents(docs):
    clean = personal_data.sanitise(docs)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == len(TEXTS)
    texts = [row.text for row in rows if row.doc_id == 15]
    assert len(texts) == 2 and all("[EMAIL]" in text and "[IP]" in text and "[PHONE]" in text for text in texts)
    assert [row.text for row in rows if row.doc_id == 3] == [None]
    assert sorted(row.text for row in rows if row.doc_id == 16) == ["the same id", "with another text"]


def test_no_personal_data(no_docs):
    assert personal_data.find_personal_data(no_docs).count() == 0 == personal_data.sanitise(no_docs).count()


def brute_terms(texts, threshold):
    """Spans of disclosing terms of each distinct (id, text), by the definitions alone."""
    word, reach = re.compile(r"[^\W\d_]+"), personal_data.REACH
    copies, docs = Counter(texts), {}
    for key in copies:
        text, spans = key[1] or "", personal_data.base_spans(key[1] or "")
        own = [m for m in word.finditer(text) if not any(m.start() < end and start < m.end() for start, _, end in spans)]
        about = defaultdict(list)
        for start, kind, end in spans:
            value = text[start:end].lower() if kind < 2 else re.sub("[^0-9]", "", text[start:end])
            before = [m[0].lower() for m in own if m.start() < start][-reach:]
            about[kind, value].append((*before, *[m[0].lower() for m in own if m.start() >= end][:reach]))
        docs[key] = own, about
    having, seen = defaultdict(list), Counter()
    for key, (own, about) in docs.items():
        seen.update({name: copies[key] for name in set(word.findall((key[1] or "").lower()))})
        for entity, nears in about.items():
            repeated = {name for near in set(nears) for name in near if sum(name in other for other in set(nears)) > 1}
            having[entity].append((key, tuple(nears), repeated))
    n, names = len(texts), defaultdict(set)
    for entity, found in having.items():
        lone = len({context for _, context, _ in found}) < personal_data.LEAST_CONTEXTS
        pairs = defaultdict(list)
        for key, context, repeated in found:
            for name in {m[0].lower() for m in docs[key][0]}:
                capital = any(m[0][0].isupper() for m in docs[key][0] if m[0].lower() == name)
                if not lone or capital or name in repeated:
                    pairs[name].append((copies[key], context, capital, name in repeated))
        for name, rows in pairs.items():
            enough = len({context for _, context, _, _ in rows}) >= personal_data.LEAST_CONTEXTS or any(row[3] for row in rows)
            information = math.log2(n / len(found))
            tells = math.log2(len(rows) * n / (len(found) * seen[name])) >= threshold * information
            own_name = lone and any(row[2] for row in rows) and seen[name] <= sum(row[0] for row in rows)
            if information > 0 and ((enough and tells) or own_name):
                for key, _, _ in found:
                    names[key].add(name)
    return {key: {(m.start(), m.end()) for m in own if m[0].lower() in names[key]} for key, (own, _) in docs.items()}


@pytest.mark.parametrize("threshold", [0.8, 0.3])
def test_terms_by_their_definition(make_docs, threshold):
    chance = random.Random(2)
    plain = [f"word{chr(97 + n)}" for n in range(20)]
    people = [(f"p{n}@mail.example.com", f"Name{chr(65 + n)}", f"town{chr(97 + n)}") for n in range(9)]
    texts = []
    for n in range(140):
        words = [chance.choice(plain) for _ in range(chance.randint(0, 40))]
        for address, *own in chance.sample(people, chance.choice([0, 0, 1, 2])):
            for one in [address] * chance.choice([1, 1, 2]) + [name for name in own if chance.random() < 0.7]:
                words.insert(chance.randint(0, len(words)), one)
        if chance.random() < 0.1:
            words.append(chance.choice(people)[2])
        texts.append((n, " ".join(words)))
    texts += [(200, "Only Here: z@one.example.org with Singular Wording"), (201, None), *texts[:6], (0, texts[5][1])]
    found = personal_data.find_personal_data(make_docs(texts), threshold)
    kind = personal_data.KINDS.index("term")
    rows = Counter((row.doc_id, tuple(sorted((s.start, s.end) for s in row.spans if s.kind == kind))) for row in found.collect())
    expected = brute_terms(texts, threshold)
    assert rows == Counter((key[0], tuple(sorted(expected[key]))) for key in texts)
    assert sum(len(spans) for spans in expected.values()) > 50


def brute_phrases(vocabulary, text):
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in vocabulary:
            size += 1
        at += size
        count += 1
    return count


def test_suffix_automaton_parses_greedily():
    chance = random.Random(12)
    for _ in range(300):
        vocabulary = "".join(chance.choice("abc ") for _ in range(chance.randint(0, 60)))
        automaton = language.SuffixAutomaton.of(vocabulary)
        text = "".join(chance.choice("abcd ") for _ in range(20))
        assert automaton.phrases(text) == brute_phrases(vocabulary, text)


def test_languages(spark, make_docs):
    chance = random.Random(1)
    parts = {"aa": ["kro", "nit", "pel", "sud"], "bb": ["éla", "mou", "tié", "ran"], "cc": ["zzo", "bha", "kiy", "wum"]}
    rows = []
    for n in range(300):
        lang = "abc"[n % 3] * 2
        words = ["".join(chance.choice(parts[lang]) for _ in range(chance.randint(1, 3))) for _ in range(15)]
        rows.append((n, " ".join(words), lang if n % 7 else None))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame, learn=id_remainder(4) != 2)
    assert model.languages == ["aa", "bb", "cc"]
    found = language.predict(frame, model).collect()
    assert all(row.lang_pred == "abc"[row.doc_id % 3] * 2 and 0.5 < row.score <= 1 for row in found)
    learned = defaultdict(list)
    for doc_id, text, lang in rows:
        if lang and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            learned[lang].append(language.plain(text))
    for row in found[::7]:
        words = rows[row.doc_id][1].split()
        costs = {}
        for lang, texts in learned.items():
            whole = "\n".join(sorted(texts))
            phrases = sum(brute_phrases(whole, f" {word} ") for word in words)
            costs[lang] = phrases * math.log2(max(len(whole), 1024)) / sum(len(word) + 2 for word in words)
        assert row.lang_pred == min(sorted(costs), key=costs.get)
        assert np.allclose(row.entropy, [costs[lang] for lang in sorted(costs)])
    awkward = {row.doc_id: row for row in language.predict(make_docs(TEXTS), model).collect()}
    assert all((awkward[n].lang_pred, awkward[n].score) == ("und", 0.0) for n in (3, 4, 5))


def test_packed_automata():
    automaton = language.SuffixAutomaton.of(" one two three ")
    assert automaton.phrases(" one two three ") == 1 and automaton.phrases(" two one ") == 2
    again = language.SuffixAutomaton.unpacked(automaton.packed())
    assert (again.letters, again.targets, again.ways) == (automaton.letters, automaton.targets, automaton.ways)


def test_texts_without_letters_teach_no_language(spark):
    rows = [(1, "12 34", "aa"), (2, None, "bb"), (3, "some words here", "cc"), (3, "another text", "cc")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame, learn=F.lit(True))
    assert model.languages == ["cc"] and model.sizes == [len(" another text ")]
    assert {row.lang_pred for row in language.predict(frame, model).collect()} == {"cc", "und"}


def test_nothing_to_learn_languages_from(docs, no_docs):
    model = language.train(no_docs, learn=F.lit(True))
    assert model.languages == []
    assert {row.lang_pred for row in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(no_docs, language.train(docs, learn=F.lit(True))).count() == 0
