"""Split layers into row ranges, as DataFrame algebra over layer metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featureframe.session import settle


def chunk_count(rows: Column, size: int) -> Column:
    """Chunks a layer of ``rows`` rows is cut into; an empty layer has none."""
    return F.ceil(rows / F.lit(size)).cast("bigint")


def _start_offsets(rows: Column, size: int) -> Column:
    # sequence(0, -1, size) is an error, so an empty layer gets an empty array
    offsets = F.sequence(F.lit(0).cast("bigint"), rows - 1, F.lit(size).cast("bigint"))
    return F.when(rows > 0, offsets).otherwise(F.array().cast("array<bigint>"))


def plan_chunks(layers: DataFrame, size: int, count: str = "feature_count") -> DataFrame:
    """One row per chunk: ``start`` every ``size`` rows, ``stop`` the next start.

    The last chunk stops at ``count + 1``, so it covers dense ids from 0 and from 1.
    """
    rows = F.col(count).cast("bigint")
    others = [name for name in layers.columns if name != count]
    return layers.withColumn("start", F.explode(_start_offsets(rows, size))).select(
        *others,
        "start",
        F.when(F.col("start") + size >= rows, rows + 1).otherwise(F.col("start") + size).alias("stop"),
    )


def total_chunks(layers: DataFrame, size: int, count: str = "feature_count") -> DataFrame:
    """One row with the number of chunks of all layers together."""
    total = F.coalesce(F.sum(chunk_count(F.col(count), size)), F.lit(0).cast("bigint"))
    return layers.agg(total.alias("total_chunks"))


def chunk_table(layers: DataFrame, size: int, keys: list[str], count: str = "feature_count") -> DataFrame:
    """``plan_chunks`` with a dense ``id`` from 0, ordered by the key columns, then ``start``."""
    planned = plan_chunks(layers.select(*keys, count), size, count).orderBy(*keys, "start")
    return with_dense_id(settle(planned), "id").select(*keys, "id", "start", "stop")


def with_dense_id(settled: DataFrame, name: str) -> DataFrame:
    """Number the rows of a DataFrame from 0, in the order they lie in.

    It must be settled, or come from a settled one by row-wise steps, so that rows
    keep their partitions and places. Every partition numbers its own rows; how many rows the partitions before it
    hold (one row per partition) is added.
    """
    # the lower 33 bits of this id are the row's place in its partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = settled.withColumns({"_part": F.spark_partition_id(), "_place": place})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("bigint")).alias("_before"))
    )
    # as many rows as the settled metadata has partitions
    numbered = rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_place") + F.col("_before"))
    return numbered.drop("_part", "_place", "_before")


def id_ranges(catalog: DataFrame, size: int) -> DataFrame:
    """Ranges ``[start, stop)`` over the ids a layer really has, so no row falls out.

    Layers whose ids cannot be ranged give one open range. Every range holds at
    most ``size`` rows.
    """
    first, last = F.col("first_id"), F.col("last_id")
    step = F.lit(size).cast("bigint")
    even = F.when(last >= first, F.sequence(first, last, step)).otherwise(F.array().cast("array<bigint>"))
    starts = F.when(first.isNotNull(), F.coalesce(F.col("range_starts"), even))
    ranged = catalog.withColumn("_starts", starts).select(
        "path", "source", "layer_name", "last_id", "_starts", F.posexplode_outer("_starts").alias("_at", "start")
    )
    stop = F.coalesce(F.get("_starts", F.col("_at") + 1), F.col("last_id") + 1)
    empty = F.col("_starts").isNotNull() & F.col("start").isNull()
    return ranged.filter(~empty).select("path", "source", "layer_name", "start", stop.alias("stop"))


def place_evenly(ranges: DataFrame) -> DataFrame:
    """One partition per range: hashing as many keys into as many partitions would
    leave some with several and many with none.

    The ranges must come from a settled catalog by row-wise steps.
    """
    return _deal(ranges, max(ranges.count(), 1))


def place_by_size(sources: DataFrame, total_bytes: int, count: int) -> DataFrame:
    """Pack whole sources into partitions of about the size Spark packs files into.

    Sources are dealt out from largest to smallest, so partitions come out alike.
    """
    conf = sources.sparkSession.conf
    largest, opening = (_bytes(conf.get(f"spark.sql.files.{name}")) for name in ("maxPartitionBytes", "openCostInBytes"))
    weight = total_bytes + count * opening
    cores = sources.sparkSession.sparkContext.defaultParallelism
    target = min(largest, max(opening, weight // cores))
    partitions = min(max(-(-weight // target), 1), max(count, 1))
    return _deal(settle(sources.orderBy(F.col("length").desc(), "path")), partitions)


def _deal(settled: DataFrame, partitions: int) -> DataFrame:
    numbered = with_dense_id(settled, "_id")
    return numbered.repartitionById(partitions, (F.col("_id") % partitions).cast("int")).drop("_id")


def _bytes(text: str) -> int:
    """``128MB`` or ``4194304`` as a number, in Spark's size notation."""
    digits = text.lower().rstrip("bkmgtp")
    unit = text.lower()[len(digits) :].rstrip("b")
    return int(digits) << (10 * "kmgtp".find(unit[0]) + 10 if unit else 0)
