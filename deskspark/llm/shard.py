"""Sharding by longest processing time: the largest group goes to the least loaded shard.

Groups are equal texts and stay together. Groups above a fixed share of all bytes are items of
their own; the others are hashed into bundles, which are items too. So the heap holds at most
2 * BUNDLES items however many documents there are, and what it decides is broadcast.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Groups larger than 1/BUNDLES of all bytes stand alone (fewer than BUNDLES can); the rest share BUNDLES bundles.
BUNDLES = 1 << 16
#: Rows numbered together in one task, about.
SLOT_ROWS = 20_000


def longest_first(sizes: list[tuple], shards: int) -> list[tuple]:
    """(item, shard) for (item, size): by falling size, ties by item, each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, s = heapq.heappop(heap)
        placed.append((item, s))
        heapq.heappush(heap, (load + size, s))
    return placed


def measured(docs: DataFrame) -> DataFrame:
    """Id, size and group of every document: the text is read here and nowhere later."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("grp"),
    )


def assign_shards(docs: DataFrame, shards: int = 8, bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, text_crc32 and shard of every row of `docs` (doc_id, text).

    Size is UTF-8 bytes plus 1; a NULL text counts as an empty one and shares its group. Repeated
    rows stay repeated, other columns are ignored, an empty table gives an empty result. Equal
    sizes are placed in the order of their hashes, so the result depends on the rows alone.
    """
    spark = docs.sparkSession
    rows = measured(docs)
    groups = rows.groupBy("grp").agg(F.sum("size").alias("size"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    large = groups.filter(F.col("size") * bundles > total)
    bundle = F.pmod("grp", F.lit(bundles))
    # Both lists are bounded: sizes of `large` add up to at most `total`, and there are `bundles` bundles.
    alone = [(r.grp, r.size) for r in large.collect()]
    shared = (groups.filter(F.col("size") * bundles <= total).groupBy(bundle.alias("item"))
              .agg(F.sum("size").alias("size")).collect())
    placed = longest_first([((0, g), n) for g, n in alone] + [((1, r["item"]), r["size"]) for r in shared], shards)
    of_group = spark.createDataFrame([(k[1], s) for k, s in placed if k[0] == 0], "grp long, shard_alone int")
    of_bundle = spark.createDataFrame([(k[1], s) for k, s in placed if k[0] == 1], "item long, shard_shared int")
    return (rows.join(F.broadcast(of_group), "grp", "left")
            .withColumn("item", bundle).join(F.broadcast(of_bundle), "item", "left")
            .select("doc_id", "size", "text_crc32", F.coalesce("shard_alone", "shard_shared").alias("shard")))


def number_slots(rows: DataFrame, total_rows: int) -> DataFrame:
    """Gapless numbers from 0 in every shard, without bringing a shard to one task.

    Rows are dealt by a hash of the id into parts of about SLOT_ROWS rows; a row's slot is the
    number of rows in the parts before its own plus its place there.
    """
    parts = max(1, -(-total_rows // SLOT_ROWS)) * 8
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)))
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return (dealt.withColumn("place", place.cast("long")).join(starts, ["shard", "part"])
            .withColumn("slot", F.col("start") + F.col("place") - 1).drop("part", "place", "start"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every document under the law of equal bytes; see `assign_shards`."""
    placed = number_slots(assign_shards(docs, shards), docs.count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
