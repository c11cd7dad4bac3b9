"""Embedding near-duplicates: spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import connected_components, hash_pair, pick, staged

LEAST_COSINE = 0.95
#: Vectors a cell holds on average, most cells, and sampled vectors a cell in the fit.
CELL_ROWS, MOST_CELLS, SAMPLED_PER_CELL = 400, 4096, 16
#: Bytes of sampled vectors on the driver.
SAMPLE_BYTES = 24 << 20
#: A vector is also compared in cells whose centre's cosine is at most this much below its best.
SLACK = 0.12
ROUNDS = 6
#: Vectors of a block; larger cells are compared block by block.
BLOCK_ROWS = 2048


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of unit vectors; an empty cell keeps its centre."""
    cells = max(1, min(cells, len(x)))
    centres = x[np.linspace(0, len(x) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        order = np.argsort(home, kind="stable")
        cell, first = np.unique(home[order], return_index=True)
        total = np.add.reduceat(x[order], first, axis=0)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres[cell] = np.where(size > 0, total / np.where(size > 0, size, 1), centres[cell])
    return centres


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles, scaled to length one (first by the largest entry, so that squares stay finite)."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assign(centres, slack: float):
    """Rows of (cell, own, node, vector, cells): each vector in its nearest cell and in those almost as near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for big in batches:
            for start in range(0, big.num_rows, 1024):
                batch = big.slice(start, 1024)
                x = _matrix(batch.column(1))
                cosine = x @ c.T
                home = cosine.argmax(axis=1)
                row, cell = np.nonzero(cosine >= cosine.max(axis=1, keepdims=True) - slack)
                ends = np.cumsum(np.bincount(row, minlength=len(x)))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(cell.astype(np.int32)))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(home[row] == cell), pa.array(home[row].astype(np.int32)), batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), lists.take(at)], ["cell", "own", "home", "node", "vec", "copies", "cells"])

    return run


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n indexes over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(least: float):
    """Links of one block pair of a cell: per vector its weight of links there, and a root that it is linked with."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        target = table.column("target").combine_chunks().to_numpy(zero_copy_only=False)
        x = _matrix(table.column("vec").combine_chunks())
        node = table.column("node").to_numpy()
        home, copies = table.column("home").to_numpy(), table.column("copies").to_numpy()
        cell = key[0].as_py()
        t, q = np.flatnonzero(target), np.flatnonzero(~target)
        reach = table.column("cells").combine_chunks()
        offsets, flat = reach.offsets.to_numpy(), reach.flatten().to_numpy()
        owner = np.repeat(np.arange(len(node)), np.diff(offsets))
        order = np.lexsort((flat, owner))
        code = owner[order].astype(np.int64) * (MOST_CELLS + 1) + flat[order]

        links = np.zeros(len(node), np.int64)
        pairs_a, pairs_b = [], []
        for i in range(0, len(q), 512):
            part = q[i : i + 512]
            a, b = np.nonzero(x[part] @ x[t].T >= least)
            a, b = part[a], t[b]
            keep = node[a] != node[b]
            a, b = a[keep], b[keep]
            other = home[a] != cell
            # a pair of two homes counts in the smaller one if both are there, else in the larger
            want = b.astype(np.int64) * (MOST_CELLS + 1) + home[a]
            at = np.minimum(np.searchsorted(code, want), len(code) - 1)
            seen_there = code[at] == want
            keep = ~other | (home[a] > cell) | ~seen_there
            a, b, other = a[keep], b[keep], other[keep]
            np.add.at(links, a, copies[b])
            np.add.at(links, b[other], copies[a[other]])
            # a forest over what is linked so far keeps the pairs few
            pairs_a.append(a)
            pairs_b.append(b)
        a, b = np.concatenate(pairs_a or [np.zeros(0, int)]), np.concatenate(pairs_b or [np.zeros(0, int)])
        root = _roots(a, b, len(node))
        some = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
        return pa.table({"node": pa.array(node[some]), "links": pa.array(links[some]), "root": pa.array(node[root[some]])})

    return run


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, slack: float = SLACK, id_col: str = "vec_id", vec_col: str = "embedding", cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per vector: n_links, component_id, kept (one representative a group).

    Equal vectors are counted once with their number of copies, so a hot vector
    is one row from then on. Centres come from spherical k-means on a bounded
    sample by hash; every vector lies in the cell of its nearest centre and is
    also compared in the cells whose centres are within ``slack`` of that
    cosine, so a pair is missed only if neither vector reaches the other's
    cell (recall against brute force is tested). Cells above ``block_rows`` are
    split by hash and compared block by block, all of them. A task gives back
    link counts and one root a vector, never pairs.

    Cosines are computed in double precision. Vectors that are null, empty,
    zero, or hold null or non-finite components link with nothing, and so do
    rows with a null id (component null, not kept). Vectors of different
    lengths link with nothing of another length. Rows that repeat an id and
    vector count as other vectors. An empty table gives no rows; other columns
    are ignored.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id_col, vec_col).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    usable = F.col("vec").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    h, g = hash_pair(F.col("vec"))
    keyed = rows.select("vec_id", F.when(usable, F.col("vec")).alias("vec")).withColumns({"h": F.when(F.col("vec").isNotNull(), h), "g": F.when(F.col("vec").isNotNull(), g)})
    same = keyed.where("vec IS NOT NULL").groupBy("h", "g").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    same = staged(same.select(F.monotonically_increasing_id().alias("node"), "*"), "vectors")
    sizes = {r["d"]: r["n"] for r in same.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    found = None
    for d, n in sorted(sizes.items()):
        one = same.where(F.size("vec") == d)
        cells = max(1, min(MOST_CELLS, n // cell_rows))
        take = min(n, cells * SAMPLED_PER_CELL + 1000, SAMPLE_BYTES // (4 * d))
        picked = one.where(F.pmod(F.col("h"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, take / n))).orderBy("h", "g").select(F.col("vec").cast("array<float>").alias("vec")).limit(take)
        sample = _matrix(pa.array([r["vec"] for r in picked.toLocalIterator()], pa.list_(pa.float32())))
        centres = spark.sparkContext.broadcast(spherical_kmeans(sample, cells).astype(np.float32))
        links = _links(one, centres, least, slack, block_rows)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = staged(found, "vector-links")
    low = same.select(F.col("node").alias("root"), F.col("low").alias("root_low"))
    edges = found.where("node <> root").distinct().join(same.select("node", "low"), "node").join(low, "root").select(F.col("low").alias("a"), F.col("root_low").alias("b"))
    group = connected_components(edges)
    per_node = same.select("node", "h", "g", "low", "copies").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    per_node = per_node.join(group, per_node["low"] == group["id"], "left").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "low").alias("component_id"))
    out = keyed.select("vec_id", "h", "g").join(per_node, ["h", "g"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))


def _links(one: DataFrame, centres, least: float, slack: float, block_rows: int) -> DataFrame:
    dealt = one.select("node", "vec", "copies").mapInArrow(_assign(centres, slack), "cell int, own boolean, home int, node long, vec array<double>, copies long, cells array<int>")
    sizes = dealt.groupBy("cell").agg(F.sum(F.col("own").cast("long")).alias("n_own"), F.count("*").alias("n_all")).collect()  # at most 4,096 rows
    spark = one.sparkSession
    blocks = spark.createDataFrame([(r["cell"], int(-(-r["n_own"] // block_rows)), int(-(-r["n_all"] // (4 * block_rows)))) for r in sizes], "cell int, targets int, queries int")
    place = F.xxhash64("node", F.lit("block"))
    dealt = dealt.join(F.broadcast(blocks.where("targets > 0")), "cell")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    target = dealt.where("own").withColumns({"t": F.pmod(place, F.col("targets")).cast("int"), "q": every("queries"), "target": F.lit(True)})
    query = dealt.withColumns({"q": F.pmod(place, F.col("queries")).cast("int"), "t": every("targets"), "target": F.lit(False)})
    cols = ["cell", "t", "q", "target", "home", "node", "vec", "copies", "cells"]
    both = target.select(*cols).unionByName(query.select(*cols))
    return both.groupBy("cell", "t", "q").applyInArrow(_compare(least), "node long, links long, root long")
