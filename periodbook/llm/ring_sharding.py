"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of a ring; a row's key falls on the ring at its hash and
belongs to the owner of the next point clockwise. No shard takes more rows than its quota (all
quotas together are the number of rows, and differ by one at most): keys that find their shard full
continue clockwise to the next other shard, and so on. Rows move only by that overflow, so most
stay where plain consistent hashing would have put them, and counts are at most one apart.

Only counts per arc (one number for each virtual node) are needed to decide how many keys of an arc
stay and where the others go, so this is settled on ``shards * virtual_nodes`` rows with window
functions; the rows themselves are then numbered within their arc and looked up in those bounded
allotments. DataFrame functions only.

Cases: null doc_id hashes as a key of its own; null text has size 1 and the checksum of no bytes;
repeated rows are placed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodbook.llm.common import keep

RING = 1 << 32


def ring_arcs(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """One row per arc, clockwise: its number, its end point and ``route``, the shards met from there."""
    points = (
        spark.range(shards * virtual_nodes, numPartitions=1)
        .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
        .select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "v"), F.lit(RING)).alias("point"))
    )
    around = W.orderBy("point", "shard")
    numbered = points.select("*", (F.row_number().over(around) - 1).alias("arc"))
    n = shards * virtual_nodes
    # distance from every arc to the next point of each shard, clockwise
    ahead = W.orderBy("arc").rowsBetween(W.currentRow, W.unboundedFollowing)
    everywhere = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    near = numbered.select("arc", "point", *(
        F.coalesce(
            F.min(F.when(F.col("shard") == s, F.col("arc"))).over(ahead),
            F.min(F.when(F.col("shard") == s, F.col("arc"))).over(everywhere) + n,
        ).alias(f"d{s}")
        for s in range(shards)
    ))
    route = F.transform(
        F.array_sort(F.array(*(F.struct(F.col(f"d{s}").alias("d"), F.lit(s).alias("s")) for s in range(shards)))),
        lambda x: x["s"],
    )
    return near.select("arc", "point", route.alias("route"))


def allotments(arcs: DataFrame, counts: DataFrame, shards: int, rows: int) -> DataFrame:
    """Where the keys of each arc go: (arc, shard, first and last rank within the arc, slot of the first)."""
    quota = F.array(*(F.lit(rows // shards + (s < rows % shards)).cast("long") for s in range(shards)))
    state = arcs.join(F.broadcast(counts), "arc", "left").select(
        "arc", "route", F.coalesce("n", F.lit(0)).cast("long").alias("left"), quota.alias("room")
    )
    for t in range(shards):
        to = F.element_at("route", t + 1)
        before = W.partitionBy("to").orderBy("arc").rowsBetween(W.unboundedPreceding, -1)
        whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        state = (
            state.withColumn("to", to)
            .withColumn("before", F.coalesce(F.sum("left").over(before), F.lit(0)))
            .withColumn(f"t{t}", F.greatest(F.lit(0), F.least("left", F.element_at("room", F.col("to") + 1) - F.col("before"))))
            .withColumn("left", F.col("left") - F.col(f"t{t}"))
            .withColumn("room", F.array(*(
                F.element_at("room", s + 1) - F.coalesce(F.sum(F.when(F.col("to") == s, F.col(f"t{t}"))).over(whole), F.lit(0))
                for s in range(shards)
            )))
        )
    takes = state.select("arc", F.posexplode(F.arrays_zip(
        F.array(*(F.element_at("route", t + 1) for t in range(shards))).alias("shard"),
        F.array(*(F.col(f"t{t}") for t in range(shards))).alias("n"),
    )).alias("turn", "x")).select("arc", "turn", F.col("x.shard").alias("shard"), F.col("x.n").alias("n")).filter("n > 0")
    in_arc = W.partitionBy("arc").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    in_shard = W.partitionBy("shard").orderBy("arc", "turn").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(in_arc), F.lit(0))
    return takes.select(
        F.col("arc").alias("a"), "shard", first.alias("first"), (first + F.col("n") - 1).alias("last"),
        F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("base"),
    )


def ring_shards(docs: DataFrame, shards: int = 8, virtual_nodes: int = 128, per_block: int = 2_000) -> DataFrame:
    """Place every row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    arcs = ring_arcs(spark, shards, virtual_nodes)
    sized = docs.select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64("doc_id").alias("hash"),
    )
    sized = keep(sized.withColumn("pos", F.pmod("hash", F.lit(RING))), "ring-keys")
    rows = sized.count()
    # ring positions are uniform: equal slices of the ring hold about per_block rows each
    slices = max(1, rows // per_block)
    placed = sized.withColumn("slice", F.floor(F.col("pos") * slices / F.lit(RING)))
    placed = _on_arc(placed, arcs, shards * virtual_nodes)
    by_slice = placed.groupBy("arc", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("arc").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_slice.select(
        F.col("arc").alias("b_arc"), F.col("slice").alias("b_slice"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    takes = allotments(arcs, by_slice.groupBy("arc").agg(F.sum("n").alias("n")), shards, rows)
    within = W.partitionBy("arc", "slice").orderBy("pos", "hash", "doc_id", "size", "text_crc32")
    ranked = placed.withColumn("nth", F.row_number().over(within) - 1).join(
        offsets, (F.col("arc") == F.col("b_arc")) & (F.col("slice") == F.col("b_slice"))
    ).withColumn("rank", F.col("offset") + F.col("nth"))
    # bounded: at most shards rows for each of the shards * virtual_nodes arcs
    return ranked.join(
        F.broadcast(takes), (F.col("arc") == F.col("a")) & F.col("rank").between(F.col("first"), F.col("last"))
    ).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("base") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        (F.col("shard") == F.element_at("route", 1)).alias("at_home"),
    )


def _on_arc(placed: DataFrame, arcs: DataFrame, n: int) -> DataFrame:
    """Add arc and route: the first point at or after the position, the first of all beyond the last.

    The ring is cut into equal sectors; a sector knows the arcs that end in it or next after it, so that
    a row meets few arcs. Bounded: sectors and arcs are fixed numbers.
    """
    sectors = 1 << max(1, (n - 1).bit_length())
    width = RING // sectors
    prior = F.lag("point").over(W.orderBy("arc"))
    top = F.max("point").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    span = lambda after, upto: F.struct(after.cast("long").alias("after"), upto.cast("long").alias("upto"))
    ends = arcs.select("arc", "route", "point", prior.alias("prior"), top.alias("top"))
    spans = ends.select("arc", "route", F.explode(
        F.when(F.col("arc") > 0, F.array(span(F.col("prior"), F.col("point"))))
        .otherwise(F.array(span(F.lit(-1), F.col("point")), span(F.col("top"), F.lit(RING - 1))))
    ).alias("x")).select("arc", "route", "x.*").filter("upto > after").withColumn(
        "sector", F.explode(F.sequence(F.floor((F.col("after") + 1) / width), F.floor(F.col("upto") / width)))
    )
    return placed.withColumn("sector", F.floor(F.col("pos") / width)).join(
        F.broadcast(spans), "sector"
    ).filter((F.col("pos") > F.col("after")) & (F.col("pos") <= F.col("upto"))).drop("sector", "after", "upto")
