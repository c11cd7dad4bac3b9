"""Repeated byte strings by bucket-pointer refinement over sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import hash_pair, pick, staged
from cohortkit.llm.jaccard_join import _BYTE, _powers, flagged, mixed, row_filter

#: Bytes of a repeat, and of the q-grams that make the initial buckets (a repeat is four of them).
LENGTH = 200
#: String starts handled at a time: short texts together, a longer text piece by piece (few enough for a core's cache).
SEGMENT = 1 << 15
#: A representative's starts are refined in so many parts before they are told apart one by one.
PARTS = 4
#: Bits of the two short distances packed below a start.
SHORT = 12
#: Bits of a position below a value whose minimum is sought.
POSITION = 20
_U = np.uint64


def grams(raw: np.ndarray, q: int) -> np.ndarray:
    """Initial bucket of each suffix: a 64-bit hash of its first q bytes."""
    return Ranges(raw).grams(q)


def refined(bucket: np.ndarray, offset: int) -> np.ndarray:
    """Buckets of twice the depth: a suffix's bucket with that of the suffix ``offset`` bytes on."""
    with np.errstate(over="ignore"):
        return mixed(bucket[:-offset] * _U(0xD6E8FEB86659FD93) + bucket[offset:], _U(offset))


def lowest(value: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of every window of ``width`` values, at most 2^20 values below 2^44."""
    low = value << _U(POSITION) | np.arange(len(value), dtype=_U)
    span = 1
    while span < width:  # minima of windows of ``span`` values, each time up to twice as wide
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return (low & _U((1 << POSITION) - 1)).view(np.int64)


class Ranges:
    """Hashes of any byte ranges of a text, from running sums."""

    def __init__(self, raw: np.ndarray) -> None:
        up, self.down = _powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=_U, out=self.total[1:])

    def grams(self, q: int) -> np.ndarray:
        """Buckets of all ranges of q bytes."""
        n = max(len(self.total) - q, 0)
        with np.errstate(over="ignore"):
            return mixed((self.total[q:] - self.total[:n]) * self.down[:n], _U(q))

    def of(self, start: np.ndarray, end: np.ndarray, *more: np.ndarray) -> np.ndarray:
        """Bucket identifiers of the ranges; ``more`` numbers count as part of them."""
        with np.errstate(over="ignore"):
            x = (self.total[end] - self.total[start]) * self.down[start]
            for m in (end - start, *more):
                x = mixed(x ^ m.astype(_U) * _U(0xD6E8FEB86659FD93))
            return x


def adjoined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(raw, ends) of a column of texts: their bytes side by side, text i from ends[i] to ends[i + 1]."""
    texts = [t or b"" for t in column.to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)], dtype=np.int64)


def listed(column: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Row of every listed struct, and the structs' named fields."""
    structs = column.flatten()
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
    return row, *(structs.field(n).to_numpy() for n in names)


def pieces(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the pieces of adjoining texts: short texts together, a longer one cut every ``SEGMENT`` bytes."""
    cut, bounds = 0, ends.tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - cut > SEGMENT:
            if cut < a:
                yield cut, a
            cut = a
            while b - cut > SEGMENT:
                yield cut, cut + SEGMENT
                cut += SEGMENT
    if cut < bounds[-1]:
        yield cut, bounds[-1]


def sampled(raw: np.ndarray, length: int, ends: np.ndarray) -> Iterator[tuple]:
    """(ranges, base, bucket, lo, hi, at) of the sampled suffixes, places counted from ``base``, piece by piece.

    No string reaches beyond its text's end.
    """
    q = length // 4
    for start, stop in pieces(ends):
        part = raw[start : stop + length - 1]
        if len(part) < length:
            continue
        ranges = Ranges(part)
        bucket = ranges.grams(q)
        at = lowest(bucket >> _U(POSITION), length - q + 1)
        inside = np.ones(len(at), np.bool_)
        for end in ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, start + len(part))].tolist():
            inside[max(end - length + 1 - start, 0) : end - start] = False
        first = np.flatnonzero(inside)
        at = at[first]
        new = np.flatnonzero(at[1:] != at[:-1])
        if len(at):
            some = np.r_[0, new + 1]
            yield ranges, start, bucket[at[some]], first[some], first[np.r_[new, len(at) - 1]], at[some]


def anchors(raw: np.ndarray, length: int = LENGTH, ends: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(bucket, context, lo, hi, at) of the sampled suffixes of a text, or of texts side by side that end at ``ends``.

    The string that starts at i is represented by the q-gram of lowest bucket
    inside it (the leftmost of those equal in the upper bits), so equal strings have equal
    representatives at equal offsets. A representative, the suffix at ``at``,
    stands for the starts lo..hi; its context is the bucket of all bytes of
    their strings.
    """
    for ranges, base, bucket, lo, hi, at in sampled(raw, length, np.array([0, len(raw)]) if ends is None else ends):
        yield bucket, ranges.of(lo, hi + length, at - lo), lo + base, hi + base, at + base


def by_piece(lo: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(base, indexes): the places in ``lo`` that lie within ``SEGMENT`` bytes from ``base``."""
    order = np.argsort(lo, kind="stable")
    piece = lo[order] // SEGMENT
    for some in np.split(order, np.flatnonzero(piece[1:] != piece[:-1]) + 1):
        if len(some):
            yield int(lo[some[0]]) // SEGMENT * SEGMENT, some


def parts(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(index, core, hull, lo, hi) of the parts of representatives' starts, by distance from the representative.

    The core is the bucket of the bytes that all strings of a part have in
    common, the hull that of all their bytes.
    """
    step = -(-(length - length // 4 + 1) // PARTS)
    for base, some in by_piece(lo):
        ranges = Ranges(raw[base : base + SEGMENT + 2 * length])
        for j in range(PARTS):
            last = at[some] - step * j  # of the part's starts
            a, b = np.maximum(lo[some], last - step + 1), np.minimum(hi[some], last)
            ok = np.flatnonzero(a <= b)
            last, a, b, index = last[ok] - base, a[ok] - base, b[ok] - base, some[ok]
            yield index, ranges.of(last, last - step + 1 + length, np.full(len(ok), j)), ranges.of(a, b + length, at[index] - base - a), a + base, b + base


def strings(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(index, string, start) of every start in the ranges lo..hi: its string's bucket, refined twice."""
    q = length // 4
    for base, some in by_piece(lo):
        bucket = refined(refined(grams(raw[base : base + SEGMENT + 2 * length], q), q), 2 * q)
        n = hi[some] - lo[some] + 1
        start = np.repeat(lo[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield np.repeat(some, n), bucket[start - base], start


def _table(names: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64, copy=False)) for x in columns], names.split())


def _count_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = adjoined(batch.column(2))
            found = [bucket for _, _, bucket, _, _, _ in sampled(raw, length, ends)]
            if found:
                yield _table("bucket", [np.concatenate(found).view(np.int64)])

    return run


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = adjoined(batch.column(2))
            found = list(anchors(raw, length, ends))
            if found:
                bucket, context, lo, hi, at = (np.concatenate(x) for x in zip(*found, strict=True))
                row = np.searchsorted(ends, lo, "right") - 1
                place = lo - ends[row] << 2 * SHORT | hi - lo << SHORT | at - lo
                yield _table("bucket context text_a text_b place", [bucket.view(np.int64), context.view(np.int64), batch.column(0).to_numpy()[row], batch.column(1).to_numpy()[row], place])

    return run


def unpacked(place):
    """(lo, hi, at) of packed places; columns or arrays."""
    low = (1 << SHORT) - 1
    if isinstance(place, np.ndarray):
        lo = place >> 2 * SHORT
        return lo, lo + (place >> SHORT & low), lo + (place & low)
    lo = F.shiftright(place, 2 * SHORT)
    return lo, lo + F.shiftright(place, SHORT).bitwiseAND(F.lit(low)), lo + place.bitwiseAND(F.lit(low))


def _part_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = adjoined(batch.column(2))
            row, place, weight = listed(batch.column(3), "place", "weight")
            lo, hi, at = (x + ends[row] for x in unpacked(place))
            found = list(parts(raw, lo, hi, at, length))
            if found:
                index, core, hull, lo, hi = (np.concatenate(x) for x in zip(*found, strict=True))
                row, weight = row[index], np.minimum(weight, 2)[index]
                yield _table("core hull text_a text_b lo hi weight", [core.view(np.int64), hull.view(np.int64), batch.column(0).to_numpy()[row], batch.column(1).to_numpy()[row], lo - ends[row], hi - ends[row], weight])

    return run


def _string_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = adjoined(batch.column(2))
            row, lo, hi, weight = listed(batch.column(3), "lo", "hi", "weight")
            for index, string, start in strings(raw, lo + ends[row], hi + ends[row], length):
                of = row[index]
                yield _table("string text_a text_b lo weight", [string.view(np.int64), batch.column(0).to_numpy()[of], batch.column(1).to_numpy()[of], start - ends[of], weight[index]])

    return run


def merged(row: np.ndarray, lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges lo..end of each row with those that overlap or touch made one, by row and start."""
    order = np.lexsort((lo, row))
    row, lo, end = row[order], lo[order], end[order]
    shift = row * (end.max(initial=0) + 1)  # rows one after the other
    reach = np.maximum.accumulate(end + shift)
    new = np.flatnonzero(lo[1:] + shift[1:] > reach[:-1])
    first, last = np.r_[0, new + 1][: len(lo)], np.r_[new, len(lo) - 1][: len(lo)]
    return row[first], lo[first], reach[last] - shift[last]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        row, lo, end = merged(*listed(batch.column(3), "lo", "end"))
        at = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        lo, end = lo.tolist(), end.tolist()
        for i, t in enumerate(batch.column(2).to_pylist()):
            runs = range(at[i], at[i + 1])
            bounds = zip([0, *(end[j] for j in runs)], [*(lo[j] for j in runs), len(t)], strict=True)
            kept = b"".join([t[a:b] for a, b in bounds])
            for c, x in zip(out, (len(t) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                c.append(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.binary())], ["text_a", "text_b", "n_removed", "n_spans", "kept_sha256", "kept"])


def _with_texts(texts: DataFrame, todo: DataFrame) -> DataFrame:
    """(text_a, text_b, t, todo): the texts that ``todo`` has rows for, once each.

    A filter of fixed size lets their rows and few others through, so that
    of all the texts only theirs are shuffled.
    """
    flags = texts.sparkSession.sparkContext.broadcast(row_filter(todo.select(F.col("text_a").alias("row_a"))))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(flagged(flags.value, batch.column(0).to_numpy())))

    few = texts.mapInArrow(some, texts.schema)
    return few.join(todo, ["text_a", "text_b"]).dropDuplicates(["text_a", "text_b"]).select("text_a", "text_b", "t", "todo")


def _by_text(rows: DataFrame, *cols: str) -> DataFrame:
    return staged(rows.groupBy("text_a", "text_b").agg(F.collect_set(F.struct(*cols)).alias("todo")), "todo")


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(text_a, text_b, todo) of the texts with repeats, todo the (lo, end) ranges.

    ``texts`` has (text_a, text_b, t), a 128-bit key and the bytes of every
    document. Buckets of suffixes are refined step by step, and a bucket of one
    is done at once. Initial buckets: suffixes with the same q-gram; of the
    suffixes only representatives are dealt out, about one in 76. Contexts:
    representatives of one bucket whose strings agree in all bytes are
    repeated with all their starts, however many they are. Parts: of a bucket
    with several contexts one representative each goes on, its starts in four
    parts, bucketed by the bytes that a part's strings have in common and
    again by all their bytes. Strings: what is left goes on start by start, in
    buckets of twice and four times the depth of the q-grams, made from
    the bucket identifiers q and 2q bytes later.
    """
    shared = texts.mapInArrow(_count_rows(length), "bucket long").groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    rows = texts.mapInArrow(_anchor_rows(length), "bucket long, context long, text_a long, text_b long, place long")
    hits = staged(rows.join(shared, "bucket", "left_semi"), "shared-buckets")
    contexts = staged(hits.groupBy("bucket", "context").agg(F.count("*").alias("weight"), F.min(F.struct("text_a", "text_b", "place")).alias("r")), "contexts")
    lo, hi, _ = unpacked(F.col("place"))
    full = hits.join(contexts.where("weight > 1").select("bucket", "context"), ["bucket", "context"], "left_semi").select("text_a", "text_b", lo.alias("lo"), (hi + length).alias("end"))
    open_ = contexts.groupBy("bucket").agg(F.min("context").alias("x"), F.max("context").alias("y"), F.min("weight").alias("least")).where("x <> y AND least = 1").select("bucket")
    todo = _by_text(contexts.join(open_, "bucket", "left_semi").select("r.*", "weight"), "place", "weight")
    schema = "core long, hull long, text_a long, text_b long, lo long, hi long, weight long"
    part = staged(_with_texts(texts, todo).mapInArrow(_part_rows(length), schema), "parts")
    hulls = part.groupBy("core", "hull").agg(F.sum("weight").alias("weight"), F.min(F.struct("text_a", "text_b", "lo", "hi")).alias("r"))
    hulls = staged(hulls, "hulls")
    same = part.where("weight = 1").join(hulls.where("weight > 1").select("core", "hull"), ["core", "hull"], "left_semi").select("text_a", "text_b", "lo", (F.col("hi") + length).alias("end"))
    open_ = hulls.groupBy("core").agg(F.min("hull").alias("x"), F.max("hull").alias("y"), F.min("weight").alias("least")).where("x <> y AND least = 1").select("core")
    todo = _by_text(hulls.join(open_, "core", "left_semi").select("r.*", F.least("weight", F.lit(2).cast("long")).alias("weight")), "lo", "hi", "weight")
    strings = staged(_with_texts(texts, todo).mapInArrow(_string_rows(length), "string long, text_a long, text_b long, lo long, weight long"), "strings")
    again = strings.groupBy("string").agg(F.sum("weight").alias("n")).where("n > 1").select("string")
    single = strings.where("weight = 1").join(again, "string", "left_semi").select("text_a", "text_b", "lo", (F.col("lo") + length).alias("end"))
    return _by_text(full.unionByName(same).unionByName(single), "lo", "end")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` the kept bytes.

    Every byte covered by a string of ``length`` bytes that starts anywhere
    else in the corpus, the same document included, is removed; overlapping
    occurrences count, and strings are judged on the input. Matches never cross
    documents. Strings are told apart by 64-bit hashes of all their bytes.

    Null and empty texts have no bytes and no spans (digest of the empty
    string); texts shorter than ``length`` stay whole; repeated documents get
    a row each and remove one another's strings; an empty table gives no
    rows; other columns are ignored. ``length`` must be a multiple of 4.
    """
    if length % 4 or not 8 <= length < 1 << SHORT:
        raise ValueError("length must be a multiple of 4 from 8 to 4,092")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    a, b = hash_pair(text)
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), a.alias("text_a"), b.alias("text_b"), text.cast("binary").alias("t"))
    texts = rows.select("text_a", "text_b", "t")
    done = staged(_with_texts(texts, repeated_spans(texts, length)).mapInArrow(_cut, "text_a long, text_b long, n_removed long, n_spans long, kept_sha256 string, kept binary").drop(*[] if keep_text else ["kept"]), "kept-texts")
    plain = rows.select("doc_id", "text_a", "text_b", F.octet_length("t").cast("long").alias("n_bytes"), F.sha2("t", 256).alias("whole"), *[F.col("t")] * keep_text)
    zero = F.lit(0).cast("long")
    out = plain.join(done, ["text_a", "text_b"], "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *[F.coalesce("kept", "t").alias("kept")] * keep_text)
    return out
