"""Sharding by longest processing time.

Groups of equal texts stay together.  Groups are summed before anything is
dealt; those above ``total / BUNDLES`` bytes stand alone (at most ``BUNDLES``
of them, whatever the input), the others are hashed into ``BUNDLES`` bundles.
So the heap on the driver sees at most twice ``BUNDLES`` (name, size) rows at
any scale: largest first, each to the least-loaded shard.  The law is
``bytes``: sizes near equal.  A shard's slots are numbered by (shard, part),
parts being hashes of the identifier, so no task sees a whole shard.

Edge cases: a null text has no bytes and is a text of its own kind, equal to
the empty one; null identifiers and repeated rows get a slot each; an empty
table gives an empty result; a group larger than a fair share fills its shard
alone; extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import shuffle_partitions, staged

#: Bundles of small groups; also the most groups that stand alone.
BUNDLES = 16_384
#: Bytes that a row costs beside its text.
ROW_BYTES = 8


def longest_processing_time(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Item name -> shard.  Ties go by name and by the lower shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          bundles: int = BUNDLES) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``size``, ``text_crc32``,
    ``law``, ``shard``, ``slot`` and ``grown_shard`` (null under this law)."""
    spark = docs.sparkSession
    body = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = staged(docs.select(F.col(id_col).alias("id"), body.alias("body")).select(
        "id", (F.length("body") + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32("body").alias("text_crc32"), F.unhex(F.sha2("body", 256)).alias("digest")))

    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("group_bytes")))
    total = groups.agg(F.coalesce(F.sum("group_bytes"), F.lit(0)).alias("n")).first()["n"]
    alone = F.col("group_bytes") > F.lit(total / bundles)
    by_hash = F.pmod(F.xxhash64("digest"), F.lit(bundles)).cast("string")
    name = F.when(alone, F.lower(F.hex("digest"))).otherwise(by_hash)
    # at most 2 x bundles rows
    items = groups.groupBy(name.alias("name")).agg(F.sum("group_bytes").alias("n")).collect()
    placed = longest_processing_time([(r["name"], r["n"]) for r in items], shards)

    plan = spark.createDataFrame(sorted(placed.items()) or [("", 0)], "name string, shard int")
    large = groups.filter(alone).select("digest", F.lower(F.hex("digest")).alias("own_name"))
    named = (rows.join(F.broadcast(large), "digest", "left")  # at most `bundles` rows of 32 bytes
             .withColumn("name", F.coalesce("own_name", by_hash)))
    dealt = named.join(F.broadcast(plan), "name").select(  # at most 2 x bundles rows
        "id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64("id", "digest"), F.lit(shuffle_partitions(spark))).cast("int").alias("part"))
    parts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("shard", "part", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "size", "text_crc32"))
    return (dealt.withColumn("place", place).join(starts, ["shard", "part"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("place") - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
