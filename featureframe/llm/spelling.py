"""Words grouped with the more frequent word they are one letter away from.

Two words are near if one inserted, deleted or replaced code point makes them equal. Near
words are found by PartEnum: the letters of a word, each with the number of its occurrence
so far (the second ``e`` is another element than the first), are a binary vector. A
replacement changes two of its elements, an insertion one. The elements are dealt into
``PARTS`` parts by a hash; whatever two elements differ, all but two parts are equal, so a
word's signatures for replacements are its parts with any two left out, and for insertions
with any one left out. Near words thus share a signature for certain. Signatures carry
two more things near words agree in for certain: the length (made equal for
insertions) and the letters of one end, the first or last ``least_points // 2``. Words
meet by an equi-join on signatures and are verified by their edit distance; equal
signatures of unlike words cost a comparison and change no result.

Words are counted in the tasks that read them, so a word that a third of all texts are made
of sends one row per task and batch of words. The number of words near another is bounded
by its length and alphabet, so no group of near words is hot.

Null texts have no words. Rows that repeat an id count each. A null id reads as an empty
one where words are altered. Ties between forms go to the smallest word in code-point order.
Tables without rows give none.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureframe.llm.common import ids_and_texts
from featureframe.session import new_shared_folder, ship_package

#: Fixed value: what words are made of, once A-Z are lower case.
_RUN = re.compile("[a-zÀ-ÿ]+")

#: Parts a word's letters are dealt into: six signatures for replacements, four for insertions.
PARTS = 4

#: Words counted by a task before it passes its counts on.
MOST_COUNTED = 500_000

_REPLACED, _SHORTER, _LONGER = range(3)


def _kept(df: DataFrame, label: str) -> DataFrame:
    folder = new_shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _altered(words: Counter[str], doc_id: int | None, one_in: int) -> Counter[str]:
    """One code point less in each word whose crc32 with the document's id ``one_in`` divides."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter[str] = Counter()
    for word, n in words.items():
        chance = zlib.crc32(word.encode(), start)
        if chance % one_in == 0:
            at = chance % len(word)
            word = word[:at] + word[at + 1 :]
        found[word] += n
    return found


def count_words(docs: DataFrame, least_points: int = 6, least_count: int = 5, alter_one_in: int | None = None) -> DataFrame:
    """``word, n`` of the lower-cased runs of Latin letters that are long and frequent enough.

    ``alter_one_in`` deletes a code point of one in so many words of a document, told by
    crc32 of the id and the word, which makes misspellings to look for.
    """

    def counts(batches):
        found: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # bytes change the case of A-Z alone
                words = Counter(_RUN.findall(text.encode().lower().decode()))
                found.update(_altered(words, doc_id, alter_one_in) if alter_one_in else words)
                if len(found) > MOST_COUNTED:
                    yield from batches_of(found)
                    found.clear()
        yield from batches_of(found)

    def batches_of(found: Counter[str]):
        rows = [(word, n) for word, n in found.items() if len(word) >= least_points]
        for first in range(0, len(rows), 50_000):
            words, numbers = zip(*rows[first : first + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])

    ship_package(docs.sparkSession)
    found = ids_and_texts(docs).mapInArrow(counts, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _parts(word: str) -> list[str]:
    """The elements of the word's vector, dealt into parts; one element always goes to the same part."""
    parts, seen = [""] * PARTS, Counter()
    for letter in sorted(word):
        seen[letter] += 1
        element = f"{letter}{seen[letter]}"
        parts[xxhash.xxh32_intdigest(element) % PARTS] += element
    return parts


def signatures(word: str, end: int) -> list[tuple[int, int]]:
    """``(key, role)``: near words have a key in common, both as replaced or one as shorter and one as longer."""
    parts, found = _parts(word), []
    ends = (word[:end], f"-{word[-end:]}")
    for length, role, missing in ((len(word), _REPLACED, 2), (len(word) + 1, _SHORTER, 1), (len(word), _LONGER, 1)):
        for kept in combinations(range(PARTS), PARTS - missing):
            vector = "|".join(parts[n] for n in kept)
            found += [(xxhash.xxh3_64_intdigest(f"{missing}:{kept}:{length}:{one}:{vector}") - (1 << 63), role) for one in ends]
    return found


def near_words(words: DataFrame, least_points: int = 6) -> DataFrame:
    """``word, near``: every two distinct words of ``words`` that are near, in both orders.

    ``least_points`` is the length of the shortest word, 2 at least.
    """
    end = least_points // 2

    def signed(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 2_000):
                part = batch.column("word").slice(first, 2_000)
                found = [signatures(word, end) for word in part.to_pylist()]
                keys = pa.array([key for own in found for key, _ in own], pa.int64())
                roles = pa.array([role for own in found for _, role in own], pa.int8())
                rows = pa.array([n for n, own in enumerate(found) for _ in own], pa.int32())
                yield pa.RecordBatch.from_arrays([keys, roles, part.take(rows)], ["key", "role", "word"])

    ship_package(words.sparkSession)
    keyed = words.select("word").mapInArrow(signed, "key long, role byte, word string")
    other = keyed.withColumnsRenamed({"role": "other_role", "word": "near"})
    replaced = (F.col("role") == _REPLACED) & (F.col("other_role") == _REPLACED) & (F.col("word") < F.col("near"))
    inserted = (F.col("role") == _SHORTER) & (F.col("other_role") == _LONGER)
    met = keyed.join(other, "key").filter(replaced | inserted)
    pairs = met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near").distinct()
    return pairs.select(F.inline(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))))


def _roots(forms: DataFrame, least_ratio: int) -> DataFrame:
    """``word, root`` of the words that have a form; each round doubles the steps taken."""
    # every step multiplies the count, so a path has few steps
    largest = forms.agg(F.max("form_n")).first()[0] or 1
    steps = math.ceil(math.log(largest, least_ratio)) + 1
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = _kept(roots, "roots")
    return roots


def group_variants(words: DataFrame, least_points: int = 6, least_ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``; words distinct).

    A word's form is its most frequent near word, if that is ``least_ratio`` times (2 at
    least) as frequent as the word; its root is where following forms ends.
    """
    words = _kept(words.select("word", F.col("n").cast("long").alias("n")), "words")
    count = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # the most frequent, and of these the smallest
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best")
    found = near_words(words, least_points).join(count, "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    best_n = -F.col("best.minus_n")
    is_form = best_n >= least_ratio * F.col("n")
    found = words.join(found, "word", "left").select(
        "word",
        F.when(is_form, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, best_n).alias("form_n"),
    )
    found = _kept(found, "forms")
    roots = _roots(found.filter("form is not null"), least_ratio)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
