"""N-gram Jaccard join with set-relation skipping, down to connected components."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import _position, by_position, connected_components, pick, staged

#: Words of a segment; a longer text is hashed segment by segment.
SEGMENT_WORDS = 100_000
#: Cells of the frequency sketch, as a power of two: 1 MB of counts whatever the corpus.
SKETCH_BITS = 18
SKETCH_ROW = 4096
#: Elements that are counted into the sketch at a time.
SKETCH_ROUND = 1_000_000
#: Min-hashes of a set; every fourth proposes a group; how many must agree for a set to be tried in one.
MINHASHES, KEY_STEP, AGREE = 32, 4, 12
#: Rows of a group are dealt to so many places where they meet its one central set.
SALTS = 16
#: Bits, as a power of two, of the row filter: 1 MB whatever the corpus. A full filter only lets more rows through.
FILTER_BITS = 23
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_BOUNDS = np.arange(MINHASHES, dtype=_U) << _U(59)
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_POWERS[0]) < n:
        n = 1 << n.bit_length()
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for k, b in enumerate((_BASE, inverse)):
                _POWERS[k] = np.cumprod(np.r_[_U(1), np.full(n - 1, b, _U)], dtype=_U)
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray, seed: np.uint64 = _U(0)) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = x + seed + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams.

    Words are parted by ASCII white space and A-Z count as a-z. A shorter text
    is one n-gram of all its words; no words give an empty set. A hash is a
    polynomial over the n-gram's bytes with single spaces between words, taken
    from running sums, so its cost doesn't depend on n.
    """
    all_words = (text or b"").lower().split()
    if not all_words:
        return np.zeros(0, _U)
    words = min(words, len(all_words))
    out = []
    for start in range(0, len(all_words) - words + 1, SEGMENT_WORDS):
        part = all_words[start : start + SEGMENT_WORDS + words - 1]
        raw = np.frombuffer(b" ".join(part), np.uint8)
        up, down = _powers(len(raw) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(raw) + 1, _U)
            np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=_U, out=total[1:])
            gap = np.flatnonzero(raw == 32)
            first = np.r_[0, gap + 1][: len(part) - words + 1]
            last = np.r_[gap, len(raw)][words - 1 :]
            out.append(mixed((total[last] - total[first]) * down[first], _U(words)))
    found = np.sort(out[0] if len(out) == 1 else np.concatenate(out))
    return found[np.r_[True, found[1:] != found[:-1]]]


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Sum and exclusive or of a set's hashes: with its size the key of equal sets."""
    with np.errstate(over="ignore"):
        return int(s.sum(dtype=_U).view(np.int64)), int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0


def minhashes(s: np.ndarray) -> np.ndarray:
    """Smallest hash of each of 32 parts of the hash range; an empty part takes the next one's."""
    return s[np.searchsorted(s, _BOUNDS) % len(s)]


def prefix_size(n: int, num: int, den: int) -> int:
    """Smallest elements of a set of n of which a partner of similarity num/den shares one."""
    return n - -(-num * n // den) + 1


def least_overlap(a, b, num: int, den: int):
    """Common elements that two sets of these sizes need."""
    return -(-num * (a + b) // (num + den))


_INFO = "row_a long, row_b long, doc_id long, n int, f1 long, f2 long, m array<long>, cell int, counts binary"


def _info(words: int):
    schema = pa.schema([("row_a", pa.int64()), ("row_b", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("f1", pa.int64()), ("f2", pa.int64()), ("m", pa.list_(pa.int64())), ("cell", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            n, f1, f2, m, cells, held = [], [], [], [], [], 0
            for text in batch.column(3).to_pylist():
                s = shingles(text, words)
                a, b = fingerprint(s)
                n.append(len(s))
                f1.append(a)
                f2.append(b)
                m.append(minhashes(s).view(np.int64) if len(s) else [])
                cells.append((s >> _U(64 - SKETCH_BITS)).astype(np.int32))
                held += len(s)
                if held > SKETCH_ROUND:
                    counts += np.bincount(np.concatenate(cells), minlength=len(counts))
                    cells, held = [], 0
            if held:
                counts += np.bincount(np.concatenate(cells), minlength=len(counts))
            none = [None] * len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, t) for c, t in zip((n, f1, f2, m, none, none), schema.types[3:], strict=True))], schema=schema)
        rows = [{"cell": i, "counts": part.tobytes()} for i in range(0, len(counts), SKETCH_ROW) if (part := counts[i : i + SKETCH_ROW]).any()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the count rows by cell; a partition holds all rows of its cells, in order."""
    cell, total = None, None
    done = []
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i != cell:
                done.append((cell, total))
                cell, total = i, np.zeros(SKETCH_ROW, np.int64)
            total = total + np.frombuffer(raw, np.int64)
    done = [d for d in [*done, (cell, total)] if d[0] is not None]
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1].tobytes() for d in done], pa.binary())], ["cell", "counts"])


def frequency_levels(info: DataFrame) -> np.ndarray:
    """Binary logarithm of the corpus count of each sketch cell (262,144 bytes, whatever the corpus)."""
    rows = info.where("counts IS NOT NULL").select("cell", "counts")
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_add_up, "cell int, counts binary").toLocalIterator():
        levels[r["cell"] : r["cell"] + SKETCH_ROW] = np.frexp(np.frombuffer(r["counts"], np.int64))[1]
    return levels


def _prefixes(words: int, num: int, den: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            tokens, n, pos, f1 = [], [], [], []
            for text in batch.column(3).to_pylist():
                s = shingles(text, words)
                if not len(s):
                    continue
                key = (level[(s >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(_U) << _U(58)) | (s >> _U(6))
                p = prefix_size(len(s), num, den)
                key = np.sort(np.partition(key, p - 1)[:p] if p < len(key) else key)
                tokens.append(key.view(np.int64))
                n.append(np.full(p, len(s), np.int32))
                pos.append(np.arange(p, dtype=np.int32))
                f1.append(np.full(p, fingerprint(s)[0], np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, n, pos, f1)], ["token", "n", "pos", "f1"])

    return run


def _filter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's part of the row filter, as rows of 4,096 flags."""
    seen = np.zeros(1 << FILTER_BITS, np.bool_)
    for batch in batches:
        seen[batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)] = True
    cells = np.flatnonzero(seen.reshape(-1, SKETCH_ROW).any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array([np.packbits(seen[c * SKETCH_ROW : (c + 1) * SKETCH_ROW]).tobytes() for c in cells], pa.binary())], ["cell", "flags"])


def _join_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(raw, np.uint8)
            total[cell] = x if cell not in total else total[cell] | x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["cell", "flags"])


def row_filter(wanted: DataFrame) -> np.ndarray:
    """Flags of the wanted rows' keys, joined on the executors; 1 MB reaches the driver."""
    flags = np.zeros((1 << FILTER_BITS) // SKETCH_ROW * (SKETCH_ROW // 8), np.uint8).reshape(-1, SKETCH_ROW // 8)
    parts = wanted.select("row_a").mapInArrow(_filter_rows, "cell int, flags binary").repartition("cell").mapInArrow(_join_flags, "cell int, flags binary")
    for r in parts.toLocalIterator():
        flags[r["cell"]] |= np.frombuffer(r["flags"], np.uint8)
    return flags.ravel()


def flagged(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indexes of the keys that the filter lets through."""
    at = keys & ((1 << FILTER_BITS) - 1)
    return np.flatnonzero(flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)


def _packed(words: int, flags):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.take(pa.array(flagged(flags.value, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([shingles(t, words).tobytes() for t in rows.column(2).to_pylist()], pa.binary())], ["row_a", "row_b", "elements"])

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, x without y, y without x, common) of each row's two sets."""
    for batch in batches:
        found = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            here = y[at] == x
            found.append((x[~here], y, at[here]))
        yield batch, found


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, found in _pieces(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(at) for _, _, at in found], pa.int64())], ["a", "b", "common"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of a beyond b and of b missing in a, of pairs that have half of the larger set in common."""
    for batch, found in _pieces(batches):
        keep, out, miss = [], [], []
        for i, (beyond, y, at) in enumerate(found):
            if 2 * len(at) >= max(len(at) + len(beyond), len(y)):
                gone = np.ones(len(y), np.bool_)
                gone[at] = False
                keep.append(i)
                out.append(beyond.view(np.int64))
                miss.append(y[gone].view(np.int64))
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(out, pa.list_(pa.int64())), pa.array(miss, pa.list_(pa.int64()))], ["a", "b", "beyond", "missing"])


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reference sets: a set's elements without ``gone`` and with ``added``."""
    for batch in batches:
        made = []
        for raw, added, gone in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if added or gone:
                x = np.setdiff1d(np.frombuffer(raw, _U), np.array(gone or [], np.int64).view(_U), assume_unique=True)
                raw = np.union1d(x, np.array(added or [], np.int64).view(_U)).tobytes()
            made.append(raw)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["sid", "elements"])


def _side_by_side(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    one = packed.select(F.col("sid").alias("a"), F.col("elements").alias("x"))
    two = packed.select(F.col("sid").alias("b"), F.col("elements").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")


def overlaps(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """Exact number of common elements of each pair (a, b) of set ids."""
    return _side_by_side(pairs, packed).mapInArrow(_overlap, "a long, b long, common long")


def _prefixed(df: DataFrame, letter: str, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{letter}_{c}") for c in cols])


class Join:
    """The join's tables; see :func:`similar_documents`."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> None:
        self.words, self.num, self.den = words, num, den
        rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
        self.rows = keyed_rows(rows)
        self.info = staged(self.rows.mapInArrow(_info(words), _INFO), "shingle-sets")
        self.each = self.info.where("counts IS NULL").select("row_a", "row_b", "doc_id", "n", "f1", "f2")
        sets = self.info.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("low"), F.min(F.struct("row_a", "row_b")).alias("row"), F.first("m").alias("m"))
        self.sets = staged(sets.select(F.monotonically_increasing_id().alias("sid"), "*"), "distinct-sets")

    def similar(self, a, b, common):
        return F.lit(self.den).cast("long") * common >= F.lit(self.num).cast("long") * (a + b - common)

    def sizes_fit(self, a, b):
        return (F.lit(self.den).cast("long") * F.least(a, b) >= F.lit(self.num).cast("long") * F.greatest(a, b))

    def enough(self, a, b):
        """Least overlap of linked sets, as an expression."""
        return F.ceil(F.lit(self.num).cast("long") * (a + b) / F.lit(float(self.num + self.den)) - F.lit(1e-9))

    def packed(self, wanted: DataFrame) -> DataFrame:
        """(sid, elements) of the wanted (sid, row_a, row_b): whole sets, made anew from the texts.

        A filter of fixed size lets the wanted rows and few others through, so
        that of all the texts only theirs are shuffled.
        """
        wanted = staged(wanted.distinct(), "wanted-sets")
        flags = self.rows.sparkSession.sparkContext.broadcast(row_filter(wanted))
        made = self.rows.select("row_a", "row_b", "t").mapInArrow(_packed(self.words, flags), "row_a long, row_b long, elements binary")
        return staged(made.dropDuplicates(["row_a", "row_b"]).join(wanted, ["row_a", "row_b"]).select("sid", "elements"), "packed-sets")

    def links(self) -> DataFrame:
        """Links (a, b) between distinct sets, enough of them to connect whatever is linked."""
        spark = self.rows.sparkSession
        at = self.sets.select("sid", "n", F.col("row.row_a").alias("row_a"), F.col("row.row_b").alias("row_b"))
        group, votes = self._groups(at)
        near = [self._to_centre(group), *self._inside(group)]
        member = self.sets.select("sid", "n", "f1").join(group.select("sid", "gid", F.size("beyond").alias("beyond")), "sid", "left")
        member = staged(member.select("sid", "n", "f1", F.coalesce("gid", "sid").alias("gid"), F.coalesce("beyond", F.lit(0)).alias("beyond")), "set-groups")
        levels = spark.sparkContext.broadcast(frequency_levels(self.info))  # 256 KB
        index = self.rows.mapInArrow(_prefixes(self.words, self.num, self.den, levels), "token long, n int, pos int, f1 long")
        shared = index.groupBy("token").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).where("x <> y").select("token")
        hits = staged(index.join(shared, "token", "left_semi").distinct(), "shared-prefixes")
        pairs = staged(self._group_pairs(hits, member), "group-pairs")
        ids = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
        packed = self.packed(ids.join(at.select("sid", "row_a", "row_b"), "sid"))
        refs = packed.join(votes, packed["sid"] == votes["gid"], "left").select("sid", "elements", "added", "gone").mapInArrow(_corrected, "sid long, elements binary")
        bounds = member.groupBy("gid").agg(F.min("n").alias("least_n"), F.max("beyond").alias("beyond"), F.max(F.col("sid") != F.col("gid")).alias("others"))
        cols = ("gid", "least_n", "beyond", "others")
        got = overlaps(pairs, refs).join(_prefixed(bounds, "a", *cols), F.col("a") == F.col("a_gid")).join(_prefixed(bounds, "b", *cols), F.col("b") == F.col("b_gid"))
        # two sets share at most what their references do and what both have beyond them
        got = staged(got.where(F.col("common") + F.col("a_beyond") + F.col("b_beyond") >= self.enough(F.col("a_least_n"), F.col("b_least_n"))), "near-groups")
        lone = got.where("NOT a_others AND NOT b_others AND a_beyond = 0 AND b_beyond = 0").where(self.similar(F.col("a_least_n"), F.col("b_least_n"), F.col("common")))
        near.append(lone.select("a", "b"))
        cols = ("sid", "n", "gid", "beyond")
        open_ = got.where("a_others OR b_others OR a_beyond > 0 OR b_beyond > 0").select("a", "b", "common")
        more = open_.join(_prefixed(member, "a", *cols), F.col("a") == F.col("a_gid")).join(_prefixed(member, "b", *cols), (F.col("b") == F.col("b_gid")) & self.sizes_fit(F.col("a_n"), F.col("b_n")) & (F.col("common") + F.col("a_beyond") + F.col("b_beyond") >= self.enough(F.col("a_n"), F.col("b_n"))))
        more = staged(more.select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b"), "a_n", "b_n"), "member-pairs")
        ids = more.select(F.col("a").alias("sid")).unionAll(more.select(F.col("b").alias("sid"))).distinct()
        checked = overlaps(more, self.packed(ids.join(at.select("sid", "row_a", "row_b"), "sid"))).join(more, ["a", "b"])
        near.append(checked.where(self.similar(F.col("a_n"), F.col("b_n"), F.col("common"))).select("a", "b"))
        return functools.reduce(DataFrame.unionByName, near)

    def _groups(self, at: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Groups of similar sets, each set by its differences from the group's reference; the references' corrections.

        A set joins the smallest id of a shared min-hash with which it agrees
        best, and that one's own choice, twice over. It stays if the two have
        half of the larger set in common. The reference is the first set
        corrected by majority: with elements that more than half of the group
        have beyond it, without those that more than half lack. So a group's
        members differ from it by their own changes alone.
        """
        bins = F.transform(F.sequence(F.lit(0), F.lit(MINHASHES - 1), F.lit(KEY_STEP)), lambda i: F.col("m")[i])
        keys = self.sets.select("sid", F.posexplode(bins).alias("k", "key"))
        lead = keys.groupBy("k", "key").agg(F.min("sid").alias("to"), F.count("*").alias("size")).where("size > 1")
        pairs = keys.join(lead, ["k", "key"]).where("sid > to").select("sid", "to").distinct()
        one = self.sets.select("sid", "m")
        two = self.sets.select(F.col("sid").alias("to"), F.col("m").alias("to_m"))
        agree = F.aggregate(F.zip_with("m", "to_m", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
        pairs = pairs.join(one, "sid").join(two, "to").withColumn("agree", agree).where(F.col("agree") >= AGREE)
        best = F.min(F.struct((-F.col("agree")).alias("agree"), "to")).alias("best")
        choice = staged(pairs.groupBy("sid").agg(best).select("sid", "best.to"), "group-choices")
        for _ in range(2):
            onward = choice.select(F.col("sid").alias("to"), F.col("to").alias("next"))
            choice = staged(choice.join(onward, "to", "left").select("sid", F.coalesce("next", "to").alias("to")), "group-choices")
        ids = choice.select("sid").unionAll(choice.select(F.col("to").alias("sid"))).distinct()
        packed = self.packed(ids.join(at.select("sid", "row_a", "row_b"), "sid"))
        found = _side_by_side(choice.select(F.col("sid").alias("a"), F.col("to").alias("b")), packed).mapInArrow(_differences, "a long, b long, beyond array<long>, missing array<long>")
        none = F.array().cast("array<long>")
        found = staged(found, "differences")
        firsts = found.select(F.col("b").alias("a"), "b", none.alias("beyond"), none.alias("missing")).distinct()
        firsts = firsts.join(found.select("a"), "a", "left_anti")
        found = found.unionByName(firsts).withColumnsRenamed({"a": "sid", "b": "gid"})
        size = found.groupBy("gid").agg(F.count("*").alias("size"))

        def majority(col: str, name: str) -> DataFrame:
            count = found.select("gid", F.explode(col).alias("element")).groupBy("gid", "element").agg(F.count("*").alias("n"))
            return count.join(size, "gid").where("2 * n > size").groupBy("gid").agg(F.collect_set("element").alias(name))

        votes = size.join(majority("beyond", "added"), "gid", "left").join(majority("missing", "gone"), "gid", "left")
        votes = staged(votes.select("gid", F.coalesce("added", none).alias("added"), F.coalesce("gone", none).alias("gone")), "corrections")
        n = self.sets.select("sid", "n")
        ref = votes.join(n.withColumnsRenamed({"sid": "gid", "n": "first_n"}), "gid").withColumn("ref_n", F.col("first_n") + F.size("added") - F.size("gone"))
        group = self._met(found, ref, ["added", "gone", "ref_n"]).join(n, "sid").select(
            "sid", "gid", "n", "ref_n",
            F.array_union(F.array_except("beyond", "added"), F.array_except("gone", "missing")).alias("beyond"),
            F.array_union(F.array_except("missing", "gone"), F.array_except("added", "beyond")).alias("missing"),
        )
        group = staged(group, "groups")
        centre = group.groupBy("gid").agg(F.min(F.struct((F.size("beyond") + F.size("missing")).alias("far"), "sid", "n", "beyond", "missing")).alias("c"))
        centre = centre.select("gid", F.col("c.sid").alias("c_sid"), F.col("c.n").alias("c_n"), F.col("c.beyond").alias("c_beyond"), F.col("c.missing").alias("c_missing"))
        group = self._met(group, centre, ["c_sid", "c_n", "c_beyond", "c_missing"])
        common = F.col("ref_n") - F.size(F.array_union("missing", "c_missing")) + F.size(F.array_intersect("beyond", "c_beyond"))
        group = group.withColumn("linked", self.similar(F.col("n"), F.col("c_n"), common.cast("long")))
        return staged(group.drop("c_n", "c_beyond", "c_missing"), "group-members"), votes

    def _met(self, members: DataFrame, by_group: DataFrame, cols: list[str]) -> DataFrame:
        """Members with columns of their group's one row; a large group meets copies of that row in several places."""
        salted = members.withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(SALTS)).cast("int"))
        copies = by_group.select("gid", *cols, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        return salted.join(copies, ["gid", "salt"]).drop("salt")

    def _to_centre(self, group: DataFrame) -> DataFrame:
        return group.where("linked AND sid <> c_sid").select(F.col("sid").alias("a"), F.col("c_sid").alias("b"))

    def _inside(self, group: DataFrame) -> list[DataFrame]:
        """Links inside groups of sets that are not linked with the centre.

        Two members share the reference without what either lacks, and what
        both have beyond it. So unless the reference alone is enough for them,
        they must have elements beyond it in common, and counting those
        gives their exact overlap. First each such set is tried with the
        smallest id in the lists of its elements; sets linked with the same
        one are not compared again.
        """
        cols = ("sid", "gid", "n", "ref_n", "linked", "c_sid", "missing")
        lists = group.select("sid", "gid", "n", "ref_n", "linked", F.size("missing").alias("lacks"), F.explode("beyond").alias("element"))
        busy = lists.groupBy("gid", "element").agg(F.min(F.when(~F.col("linked"), F.col("sid"))).alias("first"), F.min("sid").alias("x"), F.max("sid").alias("y")).where("x <> y AND first IS NOT NULL").select("gid", "element", "first")
        lists = staged(lists.join(busy, ["gid", "element"]), "element-lists")
        tried = lists.where("NOT linked AND sid <> first").groupBy("sid", "first").agg(F.count("*").alias("both"))
        tried = tried.groupBy("sid").agg(F.max(F.struct("both", "first")).alias("t")).select("sid", "t.first", "t.both")
        one, two = _prefixed(group, "a", *cols), _prefixed(group, "b", *cols)
        exact = F.col("a_ref_n") - F.size(F.array_union("a_missing", "b_missing")) + F.col("both")
        similar = self.similar(F.col("a_n"), F.col("b_n"), exact.cast("long"))
        first = staged(tried.join(one, F.col("sid") == F.col("a_sid")).join(two, F.col("first") == F.col("b_sid")).where(similar).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")), "first-links")
        label = first.select(F.col("a").alias("sid"), F.col("b").alias("label"))
        labels = group.select("sid", "linked", "c_sid").join(label, "sid", "left").select("sid", F.when(F.col("linked"), F.col("c_sid")).otherwise(F.coalesce("label", "sid")).alias("label"))
        labels = staged(labels, "group-labels")
        a = _prefixed(lists.join(labels, "sid"), "a", "sid", "gid", "element", "n", "ref_n", "linked", "lacks", "label").where("NOT a_linked")
        b = _prefixed(lists.join(labels, "sid"), "b", "sid", "gid", "element", "n", "linked", "lacks", "label")
        new = (F.col("a_label") != F.col("b_label")) & (F.col("b_linked") | (F.col("a_sid") < F.col("b_sid")))
        met = a.join(b, (F.col("a_gid") == F.col("b_gid")) & (F.col("a_element") == F.col("b_element")) & new & self.sizes_fit(F.col("a_n"), F.col("b_n")))
        met = met.groupBy("a_sid", "b_sid").agg(F.count("*").alias("both"), F.first("a_n").alias("n"), F.first("b_n").alias("m"), F.first("a_ref_n").alias("ref_n"), F.first(F.greatest("a_lacks", "b_lacks")).alias("lacks"))
        met = met.where(F.col("ref_n") - F.col("lacks") + F.col("both") >= self.enough(F.col("n"), F.col("m"))).select(F.col("a_sid").alias("sid"), F.col("b_sid").alias("first"), "both")
        sharing = met.join(one, F.col("sid") == F.col("a_sid")).join(two, F.col("first") == F.col("b_sid")).where(similar).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b"))
        # the reference alone may be enough for sets that are shorter than the centre
        short = group.join(labels, "sid").withColumn("lacks", F.size("missing"))
        cols = ("sid", "gid", "n", "ref_n", "linked", "beyond", "missing", "lacks", "label")
        a = _prefixed(short.where(~F.col("linked") & ((F.col("ref_n") - F.col("lacks")) * self.den >= F.col("n") * self.num)), "a", *cols)
        b = _prefixed(short, "b", *cols)
        met = a.join(b, (F.col("a_gid") == F.col("b_gid")) & new & self.sizes_fit(F.col("a_n"), F.col("b_n")) & (F.col("a_ref_n") - F.greatest("a_lacks", "b_lacks") >= self.enough(F.col("a_n"), F.col("b_n"))))
        exact = F.col("a_ref_n") - F.size(F.array_union("a_missing", "b_missing")) + F.size(F.array_intersect("a_beyond", "b_beyond"))
        alone = met.where(self.similar(F.col("a_n"), F.col("b_n"), exact.cast("long"))).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b"))
        return [first, sharing, alone]

    def _group_pairs(self, hits: DataFrame, member: DataFrame) -> DataFrame:
        """Pairs (a, b) of groups that can hold linked sets.

        A list of the index is cut into blocks by set size (powers of the
        similarity) and a block holds a group once, with its smallest position.
        Blocks more than one size step apart are never met, and a pair is left
        out if the elements from its best positions on can't give the overlap.
        A pair's meetings are all elements that two prefixes share, so linked
        sets need as many as the rest of the larger one can't make up for.
        """
        step = math.log(self.den / self.num)
        block = F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + F.lit(1e-9)).cast("int")
        lists = hits.join(member.select("f1", "sid", "gid", F.col("n").alias("own_n")), "f1").where("n = own_n").groupBy("token", block.alias("block"), "gid").agg(F.min("n").alias("n"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"))
        lists = staged(lists, "index-lists")
        busy = lists.groupBy("token").agg(F.min("gid").alias("x"), F.max("gid").alias("y")).where("x <> y").select("token")
        lists = lists.join(busy, "token", "left_semi")
        one = lists.select("token", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), F.col("gid").alias("a"), F.col("n").alias("a_n"), F.col("most").alias("a_most"), F.col("rest").alias("a_rest"))
        two = lists.select("token", "block", F.col("gid").alias("b"), F.col("n").alias("b_n"), F.col("most").alias("b_most"), F.col("rest").alias("b_rest"))
        long = lambda x: F.lit(x).cast("long")
        fits = (long(self.den) * F.col("a_most") >= long(self.num) * F.col("b_n")) & (long(self.den) * F.col("b_most") >= long(self.num) * F.col("a_n"))
        reach = F.least("a_rest", "b_rest") >= self.enough(F.col("a_n"), F.col("b_n"))
        met = one.alias("o").join(two.alias("t"), (F.col("o.token") == F.col("t.token")) & (F.col("o.block") == F.col("t.block")) & (F.col("a") < F.col("b")) & fits)
        met = met.groupBy("a", "b").agg(F.max(reach).alias("reach"), F.count("*").alias("shared"), F.min("a_n").alias("a_n"), F.min("b_n").alias("b_n"), F.max(F.greatest("a_most", "b_most")).alias("most"))
        after = F.ceil(F.lit(self.num) * F.col("most") / F.lit(float(self.den)) - F.lit(1e-9)) - 1  # elements behind the prefix
        return met.where("reach").where(F.col("shared") + after >= self.enough(F.col("a_n"), F.col("b_n"))).select("a", "b")

    def components(self) -> DataFrame:
        """(row_a, row_b, doc_id, n, component) of every document row."""
        group = staged(connected_components(self.links()), "set-components")
        named = self.sets.select("sid", "n", "f1", "f2", "low").join(group, F.col("sid") == F.col("id"), "left").withColumn("root", F.coalesce("component", "sid"))
        low = named.groupBy("root").agg(F.min("low").alias("component_id"))
        named = named.select("n", "f1", "f2", "root").join(low, "root").select("n", "f1", "f2", "root", "component_id")
        return self.each.join(named, ["n", "f1", "f2"], "left").select("row_a", "row_b", "doc_id", "n", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keyed_rows(rows: DataFrame) -> DataFrame:
    """(row_a, row_b, doc_id, t): rows with a 128-bit key of id and text; the text as bytes."""
    return rows.select(F.xxhash64("doc_id", "t").alias("row_a"), F.xxhash64(F.lit("second"), "t", "doc_id").alias("row_b"), "doc_id", F.col("t").cast("binary").alias("t"))


def similar_documents(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_shingles and component_id under links of Jaccard similarity >= num/den.

    Equal sets are joined as one. Sets whose min-hashes agree form groups, and
    each is kept as its differences from a reference, the group's majority.
    Overlaps inside a group follow from the differences, first with the member
    closest to the reference, then only for sets that have elements beyond the
    reference in common (or are short), so no two of many near copies meet for
    what all of them share. Groups and lone sets meet in the index of prefix
    elements (rarest first by a corpus-wide count sketch), and only members
    which the references' overlap and their own elements leave a chance are
    compared. Whatever the order, the groups and the sketch say, each link
    between sets of different components is found and checked exactly; links
    inside a component are not all listed.

    Null and empty texts and texts without words have 0 shingles and stay
    alone. Rows that repeat an id or a text get a row each (equal texts are
    linked); a null id takes part and its row names the smallest id reachable,
    null if none has one. An empty table gives no rows; other columns are
    ignored.
    """
    found = Join(docs, words, num, den, id_col, text_col).components()
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id, all columns kept; documents without words stay.

    Of rows that share the smallest id the one whose hash of id and text is
    smallest stays, of rows equal in both any one. A null id comes last: it
    stays only where no row of the component has an id. Null, empty and blank
    texts are near nothing, so all their rows stay, repeated ones too. An empty
    table gives no rows. Column names match as in Spark, in any case, an exact
    one first; extra columns pass through, also of clashing names.
    """
    names, flat = docs.columns, by_position(docs)
    row_id, row_text = (f"_{_position(docs, n)}" for n in (id_col, text_col))
    join = Join(docs, words, num, den, id_col, text_col)
    found = join.components().where("n > 0")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_a", "row_b")).alias("best")).select(F.col("best.row_a").alias("best_a"), F.col("best.row_b").alias("best_b"))
    losers = staged(found.select("row_a", "row_b").distinct().join(best, (F.col("row_a") == F.col("best_a")) & (F.col("row_b") == F.col("best_b")), "left_anti"), "near-copies")
    plain = flat.withColumns({"doc_id": F.col(row_id).cast("long"), "t": F.col(row_text).cast("string")})
    keyed = plain.withColumns({"row_a": F.xxhash64("doc_id", "t"), "row_b": F.xxhash64(F.lit("second"), "t", "doc_id")}).drop("doc_id", "t")
    stay = keyed.join(losers, ["row_a", "row_b"], "left_anti")
    blank = F.coalesce(F.col(row_text).cast("string"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    once = stay.where(~blank).dropDuplicates(["row_a", "row_b"]).unionByName(stay.where(blank))
    return once.drop("row_a", "row_b").toDF(*names)
