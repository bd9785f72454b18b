"""K-d tree partitioning of documents into shards of near-equal bytes.

Documents with equal texts form one unit, so copies share a shard; a group of copies with
more than ``part`` of a shard's bytes is dealt into several units by id, since no layout
keeps it whole with equal shards. Each unit is a point in the metadata space (size,
language, source). A node is split at the weighted median along the dimension with the
widest spread, measured in standard deviations of that dimension over all units. Ties
within a dimension are ordered by text hash.

Medians are found by refining histograms: each pass counts weights in ``BINS`` bins per
open node, and keeps the bin that the median falls in. What reaches the driver is two
numbers per node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.llm.common import staged, text_of

BINS = 1 << 16
#: A key is 24 bits of the dimension's value, then 24 bits of the text's hash.
LOW = 1 << 24
DIMENSIONS = ("k_size", "k_lang", "k_source")


def _scaled(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0)), F.lit(LOW - 1)).cast("long")


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, digest, lang, source): narrow rows for the tree."""
    raw = text_of().cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.struct(F.xxhash64(text_of()).alias("a"), F.crc32(raw).alias("b"), F.octet_length(text_of()).alias("c")).alias("digest"),
        F.col("lang").cast("string").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"),
        F.col("source").cast("string").alias("source") if "source" in docs.columns else F.lit(None).cast("string").alias("source"),
    )


def units(rows: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their unit (``digest``, ``chunk``), and the units with weight and place."""
    groups = rows.groupBy("digest").agg(
        F.sum("size").alias("weight"), F.min("lang").alias("u_lang"), F.min("source").alias("u_source")
    )
    groups = groups.withColumn("chunks", F.ceil(F.col("weight") / F.lit(cap)).cast("long"))
    # Both inputs come straight from an exchange, so a hot text's partition can be split.
    dealt = staged(
        rows.join(groups.drop("weight"), "digest").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).drop("lang", "source", "chunks"),
        "shard-rows",
    )
    tie = F.pmod(F.xxhash64("digest", "chunk"), F.lit(LOW))
    place = dealt.groupBy("digest", "chunk").agg(
        F.sum("size").alias("weight"), F.first("size").alias("one"), F.first("u_lang").alias("u_lang"), F.first("u_source").alias("u_source")
    )
    return dealt, place.select(
        "digest",
        "chunk",
        "weight",
        (_scaled(F.log2("one") * (LOW / 64)) * LOW + tie).alias("k_size"),
        (F.pmod(F.crc32(F.coalesce("u_lang", F.lit("")).cast("binary")), F.lit(LOW)) * LOW + tie).alias("k_lang"),
        (F.pmod(F.crc32(F.coalesce("u_source", F.lit("")).cast("binary")), F.lit(LOW)) * LOW + tie).alias("k_source"),
    )


def _by_node(values: dict[int, int | float]) -> Column:
    """The value of a row's node; NULL for nodes without one. A map of one entry per node."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("node"))


def split_nodes(points: DataFrame, open_nodes: dict[int, tuple[str, float]]) -> dict[int, int]:
    """The weighted cut of each open node: the largest key of its left side.

    ``points`` has ``node`` and the dimensions; ``open_nodes`` gives the dimension to split
    and the share of the weight that goes left.
    """
    dimension = _by_node({n: DIMENSIONS.index(d) + 1 for n, (d, _) in open_nodes.items()})
    base = points.select("node", "weight", F.element_at(F.array(*DIMENSIONS), dimension).alias("key"))
    whole = base.groupBy("node").agg(F.sum("weight").alias("w"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    # node -> (low, high, weight still to be placed left of the cut)
    state = {r["node"]: (r["low"], r["high"], float(r["w"] * open_nodes[r["node"]][1])) for r in whole}
    cuts: dict[int, int] = {}
    while state:
        wide = {n: max(1, -(-(high - low + 1) // BINS)) for n, (low, high, _) in state.items()}
        low, high = _by_node({n: x[0] for n, x in state.items()}), _by_node({n: x[1] for n, x in state.items()})
        counts = (
            base.select("node", "weight", "key", low.alias("low"), high.alias("high"), _by_node(wide).alias("wide"))
            .filter("key between low and high")
            .groupBy("node", F.expr("(key - low) div wide").alias("bin"))
            .agg(F.sum("weight").alias("w"))
        )
        order = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        passed = (
            counts.select("node", "bin", "w", F.sum("w").over(order).alias("upto"), _by_node({n: x[2] for n, x in state.items()}).alias("goal"))
            .filter("upto >= goal")
            .groupBy("node")
            .agg(F.min(F.struct("bin", "upto", "w")).alias("m"))
        )
        for r in passed.collect():
            node, found = r["node"], r["m"]
            first, last, rest = state.pop(node)
            start, before = first + found["bin"] * wide[node], found["upto"] - found["w"]
            if wide[node] == 1:
                # The unit at the cut goes to the side that leaves less to even out.
                cuts[node] = start if found["upto"] - rest <= rest - before else start - 1
            else:
                state[node] = (start, min(last, start + wide[node] - 1), rest - before)
    return cuts


def kd_tree(points: DataFrame, shards: int) -> DataFrame:
    """``points`` with the shard of their leaf. Each level is staged with its nodes."""
    sizes, first, level = {1: shards}, {1: 0}, [1]
    spread = points.agg(*[F.stddev_pop(F.col(d) / LOW).alias(d) for d in DIMENSIONS]).first()
    placed = points.withColumn("node", F.lit(1))
    while level := [n for n in level if sizes[n] > 1]:
        widths = placed.groupBy("node").agg(*[((F.max(d) - F.min(d)) / LOW).alias(d) for d in DIMENSIONS]).collect()
        todo = {
            r["node"]: (max(DIMENSIONS, key=lambda d: (r[d] or 0) / (spread[d] or 1)), (sizes[r["node"]] // 2) / sizes[r["node"]])
            for r in widths
            if sizes[r["node"]] > 1
        }
        if not todo:
            break
        cuts = split_nodes(placed.filter(F.col("node").isin(list(todo))), todo)
        dimension = _by_node({n: DIMENSIONS.index(d) + 1 for n, (d, _) in todo.items()})
        right = (F.element_at(F.array(*DIMENSIONS), dimension) > _by_node(cuts)).cast("int")
        placed = staged(placed.withColumn("node", F.coalesce(2 * F.col("node") + right, "node")), "shard-nodes")
        for n in level:
            sizes[2 * n], sizes[2 * n + 1] = sizes[n] // 2, sizes[n] - sizes[n] // 2
            first[2 * n], first[2 * n + 1] = first[n], first[n] + sizes[2 * n]
        level = [c for n in level for c in (2 * n, 2 * n + 1)]
    return placed.withColumn("shard", _by_node(first).cast("int"))


def kd_shards(docs: DataFrame, shards: int = 16, part: float = 0.04, slot_rows: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The law is ``bytes``: shards hold near-equal bytes, and copies of a text share a shard
    as long as they weigh no more than ``part`` of one (4 %). A null text has size 1, null metadata
    is a value of its own, repeated rows are rows of their own. An empty table gives no
    row. Fewer units than shards leave shards empty. Other columns are ignored. Runs jobs.
    """
    rows = staged(document_sizes(docs), "shard-sizes")
    total, n = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    cap = max(1, int((total or 0) / shards * part))
    dealt, place = units(rows, cap)
    points = staged(place, "shard-units")
    found = kd_tree(points, shards).select("digest", "chunk", "shard")
    put = staged(dealt.join(found, ["digest", "chunk"]).select("doc_id", "size", "text_crc32", "shard"), "shard-put")
    # Slots: rows are numbered within small ranges of a hash, after the rows of the ranges before.
    ranges = max(1, -(-n // (shards * slot_rows)))
    ranged = put.withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(ranges)).cast("int"))
    before = ranged.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("rows"))
    before = before.select(
        "shard", "range", (F.sum("rows").over(Window.partitionBy("shard").orderBy("range")) - F.col("rows")).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32")) - 1
    return (
        ranged.withColumn("inside", inside)
        .join(before, ["shard", "range"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
