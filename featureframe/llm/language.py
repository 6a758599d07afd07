"""Language by cross-parsing: how few phrases of a language's own text spell a document.

A suffix automaton per language accepts every substring of its labelled texts, which are
taken as words in lower case with a blank between them. A document is parsed from left to
right into the longest phrases the automaton accepts; a phrase never goes on into another
word, so the phrases of a word, with a blank on either side, are counted once for each
language while the word is remembered. (Phrases across words were tried: they take 2,100
CPU seconds a GB where 900 are allowed, and tell languages apart no better.) Its cross-parsing
entropy is the number of phrases times log2 of the length of the language's texts, per
character, so languages with fewer texts are not at a loss; the least wins. Ties go to the
language that comes first by name.

The texts are those of at most ``MOST_DOCUMENTS`` labelled documents per language, in the
order of a hash of their id, those of more than ``MOST_POINTS`` code points after all
others. They are whole texts, and no phrase goes on from one into another. Automata are
built in tasks, one per language, and kept as flat arrays: most states have one way on.
Prediction reads every whole text and nothing but the text.

A text that is null or has no letter is ``und`` with score 0, as is every text where there
is no labelled document. Rows without an id or a language are not learned from; of rows
that repeat an id and a language the smallest text is. Tables without rows give none. The
score is the winner's share against the runner-up, from 0.5 (a tie) towards 1; it is 1
where only one language was learned.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureframe.llm.common import ids_and_texts
from featureframe.session import settle, ship_package

MOST_DOCUMENTS = 128
MOST_POINTS = 20_000
#: Texts of a language count as this long at least, or the few phrases they could tell apart would be cheap.
LEAST_SIZE = 1024
#: Rows of ids that are brought to the documents without dealing these out.
MOST_BROADCAST = 100_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
# Java's letters, of which this module's words are made
_LETTER = r"\p{IsAlphabetic}"
_REMEMBERED = 300_000
_PLACES = 1 << 30
# no text has it
_NONE = "\0"


class SuffixAutomaton:
    """A state's only way on is a letter and a target; states with several have them by letter. State 0 is before any."""

    def __init__(self, letters: str, targets: array, ways: dict[int, dict[str, int]]):
        self.letters, self.targets, self.ways = letters, targets, ways

    @classmethod
    def of(cls, text: str) -> SuffixAutomaton:
        """Built online: one state per class of substrings that end at the same places."""
        step: list[dict[str, int]] = [{}]
        link, longest = [-1], [0]
        last = 0
        for letter in text:
            new = len(step)
            step.append({})
            longest.append(longest[last] + 1)
            link.append(0)
            at = last
            while at != -1 and letter not in step[at]:
                step[at][letter] = new
                at = link[at]
            if at != -1:
                target = step[at][letter]
                if longest[target] == longest[at] + 1:
                    link[new] = target
                else:
                    copy = len(step)
                    step.append(dict(step[target]))
                    longest.append(longest[at] + 1)
                    link.append(link[target])
                    while at != -1 and step[at].get(letter) == target:
                        step[at][letter] = copy
                        at = link[at]
                    link[target] = link[new] = copy
            last = new
        alone = [len(own) == 1 and state > 0 for state, own in enumerate(step)]
        letters = "".join(next(iter(own)) if one else _NONE for own, one in zip(step, alone, strict=True))
        targets = array("i", [next(iter(own.values())) if one else 0 for own, one in zip(step, alone, strict=True)])
        ways = {state: own for state, (own, one) in enumerate(zip(step, alone, strict=True)) if state == 0 or (own and not one)}
        return cls(letters, targets, ways)

    def packed(self) -> dict:
        """Flat arrays: the ways of states that have one, then those of the others with where they start and end."""
        states = [state for state, own in self.ways.items() for _ in own]
        return {
            "letters": self.letters,
            "targets": self.targets.tobytes(),
            "way_states": np.array(states, np.int32).tobytes(),
            "way_letters": "".join(letter for own in self.ways.values() for letter in own),
            "way_targets": np.array([target for own in self.ways.values() for target in own.values()], np.int32).tobytes(),
        }

    @classmethod
    def unpacked(cls, packed: dict) -> SuffixAutomaton:
        ways: dict[int, dict[str, int]] = {0: {}}
        states, targets = (np.frombuffer(packed[name], np.int32).tolist() for name in ("way_states", "way_targets"))
        for state, letter, target in zip(states, packed["way_letters"], targets, strict=True):
            ways.setdefault(state, {})[letter] = target
        return cls(packed["letters"], array("i", packed["targets"]), ways)

    def phrases(self, text: str) -> int:
        """Longest matches, one after another, that spell ``text``; an unknown character is one."""
        letters, targets, ways = self.letters, self.targets, self.ways
        begin, none = ways[0], {}
        state = count = 0
        for letter in text:
            if letters[state] == letter:
                state = targets[state]
                continue
            after = ways.get(state, none).get(letter)
            if after is None:
                # the phrase ends before the letter, and the next one begins with it
                count += state > 0
                after = begin.get(letter)
                if after is None:
                    count += 1
                    after = 0
            state = after
        return count + (state > 0)


@dataclass
class Model:
    languages: list[str]
    #: Each language's automaton as flat arrays.
    packed: list[dict]
    #: Length of each language's texts.
    sizes: list[int]
    #: Tells models apart where a worker keeps what it made of one.
    name: str


def plain(text: str) -> str:
    """The words of a text in lower case, a blank before and after each; empty without a letter."""
    words = _WORD.findall(text.lower())
    return f" {' '.join(words)} " if words else ""


def _chosen(docs: DataFrame, learn: Column) -> DataFrame:
    """``lang, text`` of the documents to learn from."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & learn)
    # ids whose hash is small enough for about twice as many as are wanted
    labelled = labelled.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES)))
    totals = labelled.groupBy("lang").agg(F.count("*").alias("total"))
    near = labelled.join(totals, "lang").filter(F.col("place") * F.col("total") < F.lit(2 * MOST_DOCUMENTS * _PLACES))
    near = settle(near.select("doc_id", "lang", "place").distinct())
    near = F.broadcast(near) if near.count() <= MOST_BROADCAST else near
    texts = ids_and_texts(docs).join(near, "doc_id").groupBy("doc_id", "lang", "place").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.length("text") > MOST_POINTS, "place", "doc_id")
    return texts.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= MOST_DOCUMENTS).select("lang", "text")


_PACKED = "letters string, targets binary, way_states binary, way_letters string, way_targets binary"


def train(docs: DataFrame, learn: Column) -> Model:
    """Learn from ``text`` and ``lang`` of the documents for whose ``doc_id`` the condition ``learn`` holds."""
    ship_package(docs.sparkSession)

    def automaton(texts: pa.Table) -> pa.Table:
        # no text to parse has a line break, so no phrase goes on into the next text
        text = "\n".join(sorted(map(plain, texts.column("text").to_pylist())))
        packed = {name: [value] for name, value in SuffixAutomaton.of(text).packed().items()}
        return pa.table({"lang": texts.column("lang").slice(0, 1), "size": [len(text)], **packed})

    texts = _chosen(docs, learn).filter(F.col("text").rlike(_LETTER))
    found = texts.groupBy("lang").applyInArrow(automaton, f"lang string, size long, {_PACKED}")
    # one row per language, of a size the sample bounds
    rows = sorted(found.toArrow().to_pylist(), key=lambda row: row["lang"])
    return Model([row["lang"] for row in rows], rows, [row["size"] for row in rows], uuid.uuid4().hex)


class _Costs(dict):
    """Phrases of a word in each language, counted when first asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.name = model.name
        self._automata = [SuffixAutomaton.unpacked(one) for one in model.packed]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        text = f" {word} "
        self[word] = found = np.array([one.phrases(text) for one in self._automata], np.uint32).tobytes()
        return found


_kept: list[_Costs] = []


def _costs(model: Model) -> _Costs:
    """What a Python worker knows of the model's words, kept from task to task."""
    if not _kept or _kept[0].name != model.name:
        _kept[:] = [_Costs(model)]
    return _kept[0]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` and ``entropy``, in bits per character, in each language."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        languages = shared.value.languages
        costs, weight = _costs(shared.value), np.array([math.log2(max(size, LEAST_SIZE)) for size in shared.value.sizes])
        for batch in batches:
            names, scores, rates = [], [], []
            for text in batch.column("text"):
                words = _WORD.findall(text.as_py().lower())
                if not words or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rates.append(None)
                    continue
                flat = np.frombuffer(b"".join(map(costs.__getitem__, words)), np.uint32)
                total = flat.reshape(-1, len(languages)).sum(axis=0, dtype=np.int64)
                rate = total * weight / (sum(map(len, words)) + 2 * len(words))
                best = int(np.argmin(rate))
                rest = np.delete(rate, best)
                names.append(languages[best])
                scores.append(float(rest.min() / (rest.min() + rate[best])) if len(rest) else 1.0)
                rates.append(rate.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.list_(pa.float64()))],
                ["doc_id", "lang_pred", "score", "entropy"],
            )

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, entropy array<double>")
