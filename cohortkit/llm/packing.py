"""Best-fit packing of tokenized documents by a linear grouping scheme over their length histogram."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.bpe import _RARE, byte_symbols
from cohortkit.llm.common import pick, staged

LIMIT = 2048
#: White-space separated strings whose ids a worker remembers, in each of two generations.
MEMO_STRINGS = 250_000
#: Schemes tried: a length above the limit divided by the first number is large, and large
#: lengths are rounded up in so many groups of equal cardinality as the second says.
SCHEMES = ((2, 40), (4, 160), (6, 80))
#: Bound of the column generation; what it leaves is placed by best fit.
MOST_COLUMNS = 3000
_ID = np.dtype("<u4")


class _Encoder:
    """Token ids of whole texts as the tokenizers library gives them.

    For files whose words never hold white space, a text is cut at spaces, each
    distinct string is encoded once and remembered; other files go through the
    library text by text.
    """

    def __init__(self, path: str) -> None:
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cut = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        self.by_space = steps == ["NFC", "Replace", "Lowercase"] and len(cut) == 1 and cut[0]["behavior"] == "Removed" and cut[0]["invert"]
        if self.by_space:
            self.find = regex.compile(cut[0]["pattern"]["Regex"] + r"|\n").findall
            special = [t["content"] for t in spec["added_tokens"]]
            self.odd = re.compile("|".join([_RARE.pattern, *map(re.escape, special)])).search
            self.visible = {b: ord(c) for b, c in enumerate(byte_symbols()) if b != 10}
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, _ID).tobytes()

    def _learn(self, strings: list[str]) -> None:
        """Ids of new strings: normalized and cut together, each distinct word given to the library's model once."""
        plain = []
        for s in strings:
            if self.odd(s):
                self.now[s] = self._whole(s)
            else:
                plain.append(s)
        if not plain:
            return
        words = self.find(unicodedata.normalize("NFC", "\n".join(plain)).replace("Σ", "σ").lower())
        distinct = list(set(words) - {"\n"})
        symbols = "\n".join(distinct).encode().decode("latin-1").translate(self.visible).split("\n")
        model = self.library.model.tokenize
        ids = {w: b"".join([t.id.to_bytes(4, "little") for t in model(s)]) for w, s in zip(distinct, symbols, strict=False)}
        at, part = 0, []
        for w in words:
            if w == "\n":
                self.now[plain[at]] = b"".join(part)
                at, part = at + 1, []
            else:
                part.append(ids[w])
        self.now[plain[at]] = b"".join(part)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids begin (and the last ones end)."""
        if not self.by_space:
            got = [self._whole(t or "") for t in texts.to_pylist()]
            ends = np.cumsum([0, *(len(g) // 4 for g in got)])
            return np.frombuffer(b"".join(got), _ID), ends
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        strings, new = coded.dictionary.to_pylist(), []
        for s in strings:
            if s not in self.now:
                known = self.before.get(s)
                if known is None:
                    new.append(s)
                else:
                    self.now[s] = known
        self._learn(new)
        got = list(map(self.now.__getitem__, strings))
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        each = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)]), pa.array(np.frombuffer(b"".join(got), _ID)))
        ids = each.take(coded.indices).flatten().to_numpy()
        ends = np.r_[0, np.cumsum(size[coded.indices.to_numpy()])]
        bounds = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]
        if len(self.now) > MEMO_STRINGS:
            self.before, self.now = self.now, {}
        return ids, ends[bounds]


_LOADED: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _LOADED:
        _LOADED[path] = _Encoder(path)
    return _LOADED[path]


_PIECES = "doc_id {0}, piece int, start long, length long, ids_crc32 long, part int, nth long"


def token_pieces(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most ``limit`` tokens: doc_id, piece, start, length, ids_crc32, part, nth.

    A document is the ids of its whole text and then ``end_id``; only longer
    ones are cut. ``part`` is the task that made the piece and ``nth`` counts
    the task's pieces of that length.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        made = np.zeros(limit + 1, np.int64)
        last = np.array([end_id], _ID).tobytes()
        for batch in batches:
            ids, ends = encoder.encode(batch.column(1))
            raw = memoryview(np.ascontiguousarray(ids, _ID)).cast("B")
            row, piece, crc = [], [], []
            total = np.diff(ends) + 1
            for i, (a, n) in enumerate(zip(ends[:-1].tolist(), total.tolist(), strict=True)):
                for k, at in enumerate(range(0, n, limit)):
                    end = min(at + limit, n)
                    c = zlib.crc32(raw[4 * (a + at) : 4 * (a + min(end, n - 1))])
                    crc.append(zlib.crc32(last, c) if end == n else c)
                    row.append(i)
                    piece.append(k)
            row, piece = np.array(row, np.int64), np.array(piece, np.int64)
            length = np.minimum(limit, total[row] - piece * limit) if len(row) else np.zeros(0, np.int64)
            order = np.argsort(length, kind="stable")
            kinds, first, count = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(row), np.int64)
            nth[order] = np.arange(len(row)) - np.repeat(first - made[kinds], count)
            made[kinds] += count
            cols = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * limit), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return rows.mapInArrow(run, _PIECES.format(dict(rows.dtypes)["doc_id"]))


@dataclass
class Bins:
    """So many sequences of equal contents: (length, how many of it) from the left."""

    count: int
    contents: tuple[tuple[int, int], ...]


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, limit: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the limit of greatest worth, item by item: at most limit // smallest of them."""
    use = np.flatnonzero(worth > 1e-12)
    best, picks = np.zeros(limit + 1), []
    for _ in range(limit // int(sizes.min())):
        better, pick_ = best.copy(), np.full(limit + 1, -1)
        for j in use:
            s = sizes[j]
            value = best[: limit + 1 - s] + worth[j]
            up = value > better[s:] + 1e-12
            better[s:][up] = value[up]
            pick_[s:][up] = j
        if (pick_ < 0).all():
            break
        picks.append(pick_)
        best = better
    pattern, at = np.zeros(len(sizes)), limit
    for pick_ in reversed(picks):
        if pick_[at] >= 0:
            pattern[pick_[at]] += 1
            at -= sizes[pick_[at]]
    return float(best[limit]), pattern


def fractional_patterns(sizes: np.ndarray, demand: np.ndarray, limit: int) -> list[tuple[np.ndarray, float]]:
    """Patterns of few sizes and how often to use each, from the linear relaxation by column generation."""
    k = len(sizes)
    columns = [np.eye(k)[j] * (limit // sizes[j]) for j in range(k)]
    inverse = np.linalg.inv(np.array(columns).T)
    for step in range(MOST_COLUMNS):
        worth = np.ones(k) @ inverse
        value, pattern = _best_pattern(sizes, worth, limit)
        if value <= 1 + 1e-7:
            break
        along, used = inverse @ pattern, inverse @ demand
        ratio = np.where(along > 1e-9, np.maximum(used, 0) / np.where(along > 1e-9, along, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[out] = pattern
        if step % 50 == 49:
            inverse = np.linalg.inv(np.array(columns).T)
        else:
            row = inverse[out] / along[out]
            inverse = inverse - np.outer(along, row)
            inverse[out] = row
    used = inverse @ demand
    return [(c, float(x)) for c, x in zip(columns, used, strict=True) if x > 1e-9]


def _substituted(counts: np.ndarray, smallest: int, groups: int, limit: int) -> list[Bins]:
    """Sequences of large documents by patterns over rounded lengths, holding their actual lengths; counts lose what they hold."""
    large = [(n, int(counts[n])) for n in range(limit, smallest - 1, -1) if counts[n]]
    total = sum(c for _, c in large)
    if not total:
        return []
    # groups of equal cardinality, longest first, as runs of (length, count)
    share, runs, room = -(-total // groups), [[]], -(-total // groups)
    for n, c in large:
        while c:
            if not room:
                runs.append([])
                room = share
            take = min(c, room)
            runs[-1].append([n, take])
            c, room = c - take, room - take
    merged: list[list[list[int]]] = []
    for run in runs:
        if merged and merged[-1][0][0] == run[0][0]:
            merged[-1] += run
        else:
            merged.append(run)
    sizes = np.array([run[0][0] for run in merged])
    demand = np.array([float(sum(c for _, c in run)) for run in merged])
    out = []
    for pattern, times in fractional_patterns(sizes, demand, limit):
        m = int(times + 1e-6)
        if not m:
            continue
        slots = [j for j in range(len(sizes)) for _ in range(int(round(pattern[j])))]
        held, cuts = [], {0, m}
        for j in slots:
            line, at = [], 0
            while at < m and merged[j]:
                n, c = merged[j][0]
                take = min(c, m - at)
                line.append((at, n))
                counts[n] -= take
                at += take
                cuts.add(at)
                merged[j][0][1] -= take
                if not merged[j][0][1]:
                    merged[j].pop(0)
            if at < m:
                line.append((at, 0))
            held.append(line)
        edges, place = sorted(cuts), [0] * len(held)
        for a, b in zip(edges, edges[1:], strict=False):
            inside: dict[int, int] = {}
            for s, line in enumerate(held):
                while place[s] + 1 < len(line) and line[place[s] + 1][0] <= a:
                    place[s] += 1
                n = line[place[s]][1]
                if n:
                    inside[n] = inside.get(n, 0) + 1
            if inside:
                out.append(Bins(b - a, tuple(sorted(inside.items(), reverse=True))))
    return out


def _best_fit(counts: np.ndarray, bins: list[Bins], limit: int) -> list[Bins]:
    """The remaining lengths, longest first, each where it leaves the least room, many equal ones at once."""
    free: list[list[Bins]] = [[] for _ in range(limit + 1)]
    some = np.zeros(limit + 1, np.bool_)

    def put(b: Bins) -> None:
        room = limit - sum(n * c for n, c in b.contents)
        free[room].append(b)
        some[room] = True

    for b in bins:
        put(b)
    for n in range(limit, 0, -1):
        left = int(counts[n])
        while left:
            rooms = np.flatnonzero(some[n:])
            if len(rooms):
                room = n + int(rooms[0])
                b = free[room].pop()
                some[room] = bool(free[room])
            else:
                room, b = limit, Bins(left, ())
            each = room // n
            full = min(b.count, left // each)
            if full:
                put(Bins(full, (*b.contents, (n, each))))
                left -= full * each
            rest = b.count - full
            if rest and left and left < each:
                put(Bins(1, (*b.contents, (n, left))))
                left, rest = 0, rest - 1
            if rest and b.contents:
                put(Bins(rest, b.contents))
    return [b for same in free for b in same if b.contents]


def plan_sequences(counts: np.ndarray, limit: int = LIMIT) -> list[Bins]:
    """How to fill sequences of ``limit`` tokens with counts[n] pieces of n tokens each.

    Large lengths are rounded up within groups of equal cardinality, patterns of
    the few rounded sizes are optimised by the configuration linear program and
    rounded down, actual lengths take the places, and all the rest goes in by
    best fit. The fewest sequences over the schemes are kept: many groups waste
    less in rounding, few large lengths leave more to fill gaps with. The work
    depends on the limit alone, not on how many pieces there are.
    """
    best: list[Bins] | None = None
    floor = -(-int((counts * np.arange(limit + 1)).sum()) // limit)
    for parts, groups in SCHEMES:
        left = counts.copy()
        bins = _best_fit(left, _substituted(left, limit // parts + 1, groups, limit), limit)
        if best is None or sum(b.count for b in bins) < sum(b.count for b in best):
            best = bins
        if sum(b.count for b in best) <= floor:
            break
    return best or []


@dataclass
class Places:
    """Where the pieces of a length go, by their rank: runs of ranks as arrays sorted by (length, first rank)."""

    key: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, bins: list[Bins], limit: int) -> Places:
        given, rows, sequence = np.zeros(limit + 1, np.int64), [], 0
        for b in bins:
            offset = 0
            for n, each in b.contents:
                rows.append(((n << 48) + int(given[n]), each, sequence, offset))
                given[n] += b.count * each
                offset += n * each
            sequence += b.count
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        nth = (length << 48) + rank - self.key[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def pack_documents(docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Tokenizing tasks count their pieces by length; the histogram (at most
    ``limit`` numbers) is all the driver plans with. A piece's rank among those
    of its length is its task's offset (a running sum by length over tasks) plus
    its number in the task, so a length that many documents share is never in
    one task; the rank gives its place. Null and empty texts are one piece of
    ``end_id`` alone; repeated rows are packed each; texts of any length are cut
    whole; ties go by task and order; an empty table gives no rows; other
    columns are ignored. Sequence ids are gapless from 0.
    """
    made = staged(token_pieces(docs, path, limit, end_id, id_col, text_col), "token-pieces")
    tally = made.groupBy("part", "length").agg(F.max("nth").alias("most")).select("part", "length", (F.col("most") + 1).alias("n"))
    tally = staged(tally, "piece-counts")
    counts = np.zeros(limit + 1, np.int64)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    places = made.sparkSession.sparkContext.broadcast(Places.of(plan_sequences(counts, limit), limit))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tally = tally.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = made.join(tally, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long"))
