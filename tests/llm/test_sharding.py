"""Ring sharding: balance, slots and a replay of the ring."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import SCHEMA, frame, odd_texts
from pyspark.sql import functions as F
from pyspark.sql.functions import spark_partition_id

from cohortkit.llm import sharding
from cohortkit.llm.sharding import fill_ring, ring_nodes, shard_rows


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_counts_and_slots(spark, shards):
    texts = odd_texts() + [(i, f"text {i % 7}") for i in range(100, 400)] + [(77, "same")] * 150
    got = shard_rows(frame(spark, texts), shards=shards).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1


def test_empty_table(spark):
    assert shard_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_order_of_rows_does_not_matter(spark):
    texts = [(i, f"text {i}") for i in range(500)]
    one = {tuple(r) for r in shard_rows(frame(spark, texts)).collect()}
    random.Random(3).shuffle(texts)
    assert {tuple(r) for r in shard_rows(frame(spark, texts).repartition(5)).collect()} == one


def test_fill_against_key_by_key_replay():
    r = random.Random(9)
    for _ in range(200):
        shards = r.randrange(1, 6)
        owners = [r.randrange(shards) for _ in range(r.randrange(1, 12))] + list(range(shards))
        loads = [r.randrange(6) for _ in owners]
        total = sum(loads)
        capacity = [total // shards + (s < total % shards) for s in range(shards)]
        place = {(a, k): s for a, lo, hi, s, _ in fill_ring(loads, owners, capacity) for k in range(lo, hi)}
        used, waiting = Counter(), [(a, k) for a, n in enumerate(loads) for k in range(n)]
        for hop in range(len(owners)):
            rest = []
            for a, k in waiting:
                s = owners[(a + hop) % len(owners)]
                if used[s] < capacity[s]:
                    used[s] += 1
                    assert place[a, k] == s
                else:
                    rest.append((a, k))
            waiting = rest
        assert not waiting and len(place) == total


def test_limited_movement():
    """A new shard takes about its share of an unbounded ring; other keys stay."""
    before, after = ring_nodes(8, 64), ring_nodes(9, 64)
    home = lambda nodes, x: next((s for slot, s in nodes if slot >= x), nodes[0][1])
    moved = [(home(before, x), home(after, x)) for x in range(0, 1 << 14, 16)]
    changed = [b for a, b in moved if a != b]
    assert set(changed) <= {8, *range(8)} and sum(b == 8 for b in changed) >= 0.9 * len(changed) and len(changed) < 0.25 * len(moved)


def test_copies_are_expanded_in_pieces(spark, monkeypatch):
    """A row repeated very often spreads over tasks, and slots stay gapless."""
    monkeypatch.setattr(sharding, "PIECE_ROWS", 1000)
    docs = spark.range(60_000).selectExpr("CASE WHEN id < 40000 THEN 5 ELSE id END AS doc_id", "CASE WHEN id < 40000 THEN 'same' ELSE concat('t', id) END AS text")
    got = shard_rows(docs, shards=3)
    per_task = [r["count"] for r in got.where("doc_id = 5").groupBy(spark_partition_id()).count().collect()]
    assert len(per_task) > 1 and max(per_task) < 0.6 * 40_000
    slots = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert sorted(r["n"] for r in slots) == [20_000] * 3 and all(r["n"] == r["d"] == r["m"] + 1 for r in slots)
    assert got.where("doc_id = 5").count() == 40_000


def test_a_million_equal_rows(spark):
    docs = spark.range(1_000_000).selectExpr("cast(1 as bigint) AS doc_id", "'x' AS text")
    slots = shard_rows(docs).groupBy("shard").agg(F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert len(slots) == 8 and all(r["d"] == r["m"] + 1 == 125_000 for r in slots)
