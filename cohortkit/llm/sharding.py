"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import pick, staged

RING_SLOTS = 1 << 14
#: Rows of a rank bucket on average, and least buckets an arc (arcs differ in length, their buckets spread over tasks).
ROWS_PER_BUCKET, LEAST_BUCKETS = 20_000, 16


#: Copies of a row that are expanded together.
PIECE_ROWS = 100_000


def ring_nodes(shards: int, replicas: int, slots: int = RING_SLOTS) -> list[tuple[int, int]]:
    """(slot, shard) of the virtual nodes in clockwise order, one node a slot."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for r in range(replicas):
            digest = hashlib.blake2b(f"{shard}/{r}".encode(), digest_size=8).digest()
            taken.setdefault(int.from_bytes(digest, "big") % slots, shard)
    return sorted(taken.items())


def fill_ring(loads: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Place the keys of each arc: (arc, first rank, end rank, shard, first slot of the shard).

    Hop 0 offers every arc's keys to its own node. Keys that find the shard
    full go on clockwise, one node a hop, until a shard with room takes them.
    A shard that is full stays full, so there are at most arcs + shards pieces.
    """
    used, first, out = [0] * len(capacity), [0] * len(loads), []
    left = [i for i, n in enumerate(loads) if n]
    for hop in range(len(loads)):
        for arc in left:
            shard = owners[(arc + hop) % len(loads)]
            take = min(loads[arc] - first[arc], capacity[shard] - used[shard])
            if take:
                out.append((arc, first[arc], first[arc] + take, shard, used[shard]))
                first[arc] += take
                used[shard] += take
        left = [arc for arc in left if first[arc] < loads[arc]]
        if not left:
            break
    return out


def shard_rows(docs: DataFrame, shards: int = 8, replicas: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents to ``shards`` shards whose row counts differ by one at most.

    A row's place on the ring comes from its id; a shard's capacity is
    ceil(rows / shards) for the first ``rows % shards`` shards and the floor
    for the rest, so loads are bounded as tightly as whole rows allow. Rows
    overflowing a full shard continue clockwise. Only one count per virtual
    node (at most shards * replicas numbers) reaches the driver, where the
    overflow is worked out; rows get their rank within an arc from bucket
    totals plus a window inside a bucket of about 20,000 rows.

    Null ids share one place on the ring, null and empty texts have sizes 1
    (null: no bytes, plus 1) and 1, an empty table gives no rows. Rows equal in
    id, size and checksum are counted together before any window and expanded
    afterwards, at most 100,000 of them from one row of the plan, so no task
    expands all copies of a row; which of them gets which slot makes no
    difference. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    same = staged(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")), "shard-rows")
    total, most = same.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.max("copies"), F.lit(0))).first()
    nodes = ring_nodes(shards, replicas)
    ahead, arc_of = 0, []
    for slot in range(RING_SLOTS):
        while ahead < len(nodes) and nodes[ahead][0] < slot:
            ahead += 1
        arc_of.append(ahead % len(nodes))
    buckets = LEAST_BUCKETS + total // (ROWS_PER_BUCKET * len(nodes))
    placed = same.withColumns({
        "arc": F.element_at(F.from_json(F.lit(json.dumps(arc_of)), "array<int>"), (F.pmod(F.xxhash64("doc_id"), F.lit(RING_SLOTS)) + 1).cast("int")),
        "key": F.xxhash64("text_crc32", "size", "doc_id"),
    }).withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 16), F.lit(buckets)))
    parts = placed.groupBy("arc", "bucket").agg(F.sum("copies").alias("n"))
    loads = [0] * len(nodes)
    for r in parts.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one number a virtual node
        loads[r["arc"]] = r["n"]
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    pieces: dict[int, list[dict]] = {}
    for arc, lo, hi, shard, slot in fill_ring(loads, [s for _, s in nodes], capacity):
        pieces.setdefault(arc, []).append({"lo": lo, "hi": hi, "shard": shard, "slot": slot})
    dealt = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps([{"arc": a, "pieces": p} for a, p in pieces.items()])), "array<struct<arc:int,pieces:array<struct<lo:long,hi:long,shard:int,slot:long>>>>")))
    before = parts.select("arc", "bucket", (F.sum("n").over(Window.partitionBy("arc").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("arc", "bucket").orderBy("key", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("upto", F.sum("copies").over(inside)).join(before, ["arc", "bucket"])
    first, last = F.col("before") + F.col("upto") - F.col("copies"), F.col("before") + F.col("upto") - 1
    if most > PIECE_ROWS:  # a much repeated row is cut into ranges of ranks, dealt over tasks before they are expanded
        ranked = ranked.withColumn("last", last).withColumn("first", F.explode(F.sequence(first, last, F.lit(PIECE_ROWS).cast("long")))).repartition(1 + total // (10 * PIECE_ROWS), "arc", "first")
        first, last = F.col("first"), F.least("last", F.col("first") + PIECE_ROWS - 1)
    ranked = ranked.withColumn("rank", F.explode(F.sequence(first, last)))
    piece = F.filter("pieces", lambda p: (p["lo"] <= F.col("rank")) & (F.col("rank") < p["hi"]))[0]
    return (
        ranked.join(F.broadcast(dealt), "arc")  # at most shards * replicas rows
        .withColumn("piece", piece)
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("piece.shard").alias("shard"), (F.col("piece.slot") + F.col("rank") - F.col("piece.lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
