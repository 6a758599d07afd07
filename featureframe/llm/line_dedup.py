"""Lines that many documents hold stay in one document.

Every line gets a key, the line without white space at its ends and with A-Z in lower
case. Keys are hashed to 128 bits and dealt by range of the hash, so that all places of a
key meet, sorted by document (largest id first) and position. The stream of a key then
tells its first document and whether there are enough of them. What comes back is no text
but which lines a document keeps: a bitmap, run-length coded, and only for documents that
lose a line. ``kept_lines`` applies it.

A key that holds far more than its share of all lines would fill one range. Such keys are
found by a sketch of frequent items, whose size is fixed; their documents are counted by
an aggregation on key and document, which combines on the map side, and their answer, one
row for each, is brought to the lines. Both ways give the same result, so what the sketch
misses costs balance only.

Rows that repeat an id are one document: their lines count once, and all of the largest id
stay. Null ids are one document, smaller than any other. A null or empty text is one empty
line. Equal 128-bit hashes count as equal keys. Tables without rows give none.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureframe.llm.common import ids_and_texts, shuffle_partitions
from featureframe.session import new_shared_folder

#: Fixed value: the white space that does not count at the ends of a line.
WHITE_SPACE = " \t\n\v\f\r"

#: Entries of the sketch of frequent keys, and the share of a range's lines that makes a key frequent.
SKETCH, LARGE_SHARE, LEAST_LARGE = 1 << 16, 0.25, 100

_KEY = ("high", "low")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _content(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(text)


def _keyed_lines(docs: DataFrame, least_points: int) -> DataFrame:
    """``doc_id, content, position, high, low`` of every line whose key is long enough."""
    rows = ids_and_texts(docs).select("doc_id", _content(F.col("text")).alias("content"), F.posexplode(_lines(F.col("text"))).alias("position", "line"))
    key = F.translate(F.btrim("line", F.lit(WHITE_SPACE)), string.ascii_uppercase, string.ascii_lowercase)
    return (
        rows.select("doc_id", "content", "position", key.alias("key"))
        .filter(F.length("key") >= least_points)
        .select("doc_id", "content", "position", F.xxhash64("key").alias("high"), F.xxhash64(F.lit("low"), "key").alias("low"))
    )


def _frequent(lines: DataFrame, total: int, ranges: int) -> DataFrame:
    """``high`` of keys with more than a quarter of a range's lines: at most four for each range."""
    most = min(SKETCH, max(1, int(ranges / LARGE_SHARE)))
    top = lines.agg(F.call_function("approx_top_k", F.col("high"), F.lit(most), F.lit(SKETCH)).alias("top")).select(F.inline("top"))
    least = max(LEAST_LARGE, LARGE_SHARE * total / ranges)
    return top.filter(F.col("count") > least).select(F.col("item").alias("high"))


def _dropped_of_frequent(lines: DataFrame, least_documents: int) -> DataFrame:
    """Lines of frequent keys that go; ``lines`` are theirs alone."""
    documents = lines.groupBy(*_KEY, "doc_id").agg(F.lit(1).alias("one"))
    keys = documents.groupBy(*_KEY).agg(F.count("*").alias("documents"), F.max("doc_id").alias("last"))
    keys = F.broadcast(keys.filter(F.col("documents") >= least_documents))
    return lines.join(keys, list(_KEY)).filter(~F.col("doc_id").eqNullSafe(F.col("last")))


def _dropped_of_others(lines: DataFrame, ranges: int, least_documents: int) -> DataFrame:
    # the hash is uniform, so ranges of equal width hold equal shares and need no sample
    of_range = F.shiftright(F.shiftrightunsigned("high", 32) * ranges, 32).cast("int")
    latest = F.desc_nulls_last("doc_id")
    dealt = lines.withColumn("range", of_range).repartitionById(ranges, F.col("range"))
    # the windows need no other sort
    stream = dealt.sortWithinPartitions("range", *_KEY, latest, "position")
    same = Window.partitionBy("range", *_KEY)
    counted = stream.withColumn("nth", F.dense_rank().over(same.orderBy(latest)))
    counted = counted.withColumn("documents", F.max("nth").over(same))
    return counted.filter((F.col("nth") > 1) & (F.col("documents") >= least_documents))


def keep_bitmaps(docs: DataFrame, least_points: int = 20, least_documents: int = 3) -> DataFrame:
    """``doc_id, content, n_dropped, dropped`` of documents that lose lines.

    ``dropped`` are the runs of zeros of the document's bitmap, ``start`` and ``length`` in
    lines, ascending; all other bits are ones. ``content`` is xxhash64 of the text.
    """
    spark = docs.sparkSession
    folder = new_shared_folder(spark, "lines")
    _keyed_lines(docs, least_points).write.parquet(folder)
    lines = spark.read.parquet(folder)
    ranges = shuffle_partitions(spark)
    frequent = F.broadcast(_frequent(lines, lines.count(), ranges))
    gone = _dropped_of_frequent(lines.join(frequent, "high"), least_documents)
    others = _dropped_of_others(lines.join(frequent, "high", "left_anti"), ranges, least_documents)
    place = ["doc_id", "content", "position"]
    # rows that repeat an id and its text name the same lines; a document's lines fit in its row
    found = gone.select(place).union(others.select(place)).groupBy("doc_id", "content")
    found = found.agg(F.array_sort(F.collect_set("position")).alias("at"))
    at, last = F.col("at"), F.size("at") - 1
    starts = F.filter("at", lambda line, n: F.when(n == 0, True).otherwise(at[n - 1] != line - 1))
    ends = F.filter("at", lambda line, n: F.when(n == last, True).otherwise(at[n + 1] != line + 1))
    runs = F.zip_with(starts, ends, lambda start, end: F.struct(start.alias("start"), (end - start + 1).alias("length")))
    return found.select("doc_id", "content", F.size("at").cast("long").alias("n_dropped"), runs.alias("dropped"))


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, text``, the text of the lines its bitmap keeps."""
    rows = ids_and_texts(docs).withColumn("content", _content(F.col("text")))
    own = bitmaps.withColumnsRenamed({"doc_id": "own_id", "content": "own_content"})
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("content") == F.col("own_content"))
    lines = _lines(F.col("text"))
    after = F.transform("dropped", lambda run: run["start"] + run["length"])
    starts = F.concat(F.array(F.lit(0)), after)
    ends = F.concat(F.col("dropped.start"), F.array(F.size(lines)))
    parts = lambda every: F.zip_with(starts, ends, lambda start, end: F.slice(every, start + 1, end - start))
    # inside a lambda of its own, so that the text is split once, not once for each run
    kept = F.transform(F.array(lines), lambda every: F.array_join(F.flatten(parts(every)), "\n"))[0]
    return rows.join(own, same, "left").select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
