"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import _position, by_position, hash_pair, map_rows, pick, staged

WINDOW_WORDS = 10
#: Benchmark text in one search table; a larger benchmark is searched block after block.
BLOCK_BYTES = 2 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text, A-Z lower-cased: runs of digits, ASCII letters and non-ASCII characters."""
    return _WORD.findall(text.lower()) if text else []


class _Search:
    """Wu-Manber tables for patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set]) -> None:
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets[pattern[-self.block :]][pattern[0]].append((pattern, items))
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) of each occurrence, from left to right."""
        get, far, m, b, end, n = self.shift.get, self.far, self.length, self.block, self.length, len(words)
        while end <= n:
            key = tuple(words[end - b : end])
            skip = get(key, far)
            if skip:
                end += skip
                continue
            start = end - m
            for pattern, items in self.buckets[key].get(words[start], ()):
                if pattern == tuple(words[start:end]):
                    yield start, items
            end += 1


class Patterns:
    """Search tables of one benchmark block, a table per window length."""

    def __init__(self, items: Iterable[tuple[object, bytes | None]], window: int = WINDOW_WORDS) -> None:
        found: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            m = min(window, len(words))
            for i in range(len(words) - m + 1 if m else 0):
                found[m][tuple(words[i : i + m])].add(item)
        self.searches = [_Search(m, dict(p)) for m, p in sorted(found.items())]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges and the items with an occurring window."""
        spans, items = [], set()
        for s in self.searches:
            for start, found in s.find(words):
                spans.append((start, start + s.length))
                items |= found
        return spans, items


def _covered(spans: list[tuple[int, int]]) -> int:
    total, last = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, last))
        last = max(last, end)
    return total


class Block:
    """Items of one benchmark block; the search tables are built in the tasks that use them, once a worker process."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.items, self.window, self._patterns = items, window, None

    def __getstate__(self) -> dict:
        return {"items": self.items, "window": self.window, "_patterns": None}

    @property
    def patterns(self) -> Patterns:
        if self._patterns is None:
            self._patterns = Patterns(self.items, self.window)
        return self._patterns


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW_WORDS, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator]:
    """How many blocks the benchmark's size asks for, and their broadcasts one after another.

    Distinct items with text are dealt to blocks by hash. The driver fetches and
    broadcasts a block only when it is asked for, so that it holds about
    ``block_bytes`` of text (or one longer item), however large the benchmark.
    """
    sc = benchmark.sparkSession.sparkContext
    items = pick(benchmark, item_col, text_col).select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).cast("binary").alias("t"))
    items = items.where(F.octet_length("t") > 0)
    n = 1 + (items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes
    if n > 1:  # equal items would fall to one block
        items = staged(items.distinct(), "benchmark")
    of = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return n, (sc.broadcast(Block([(r["i"], bytes(r["t"])) for r in items.where(of == k).toLocalIterator()], window)) for k in range(n))


_OUT = "doc_id long, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items (sorted list), items_sha256, contaminated.

    A window is ``window`` consecutive words of an item (all words of a shorter
    item); a document word inside an occurrence of any window is hit. Documents
    are scanned where they are read, without a shuffle. A benchmark larger than
    ``block_bytes`` is searched block after block: each scan writes the hits of
    the texts that have any and gives its block free before the next; then the
    hits of equal texts are put together and joined to the documents. Null and
    empty texts have no words; items without words match nothing; items of equal
    text are all reported; a null item_id is reported as ``null``; repeated
    documents get a row each; an empty table gives no rows. Other columns are
    ignored.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    n, blocks = benchmark_blocks(benchmark, window, block_bytes=block_bytes)
    if n == 1:
        return rows.mapInArrow(_judge(next(blocks)), _OUT)
    h, g = hash_pair(F.col("text"))
    keyed = rows.withColumns({"h": h, "g": g})
    hits = _hits(keyed, blocks)
    merged = hits.groupBy("h", "g").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = merged.mapInArrow(_merge, "h long, g long, n_hit long, items array<string>")
    items = F.coalesce("items", F.array().cast("array<string>"))
    found = keyed.mapInArrow(_word_counts, "doc_id long, h long, g long, n_words long").join(merged, ["h", "g"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _hits(keyed: DataFrame, blocks: Iterator) -> DataFrame:
    """(h, g, spans, items) of texts with hits, once a text and block; ``keyed`` has text, h and g."""
    found = None
    for block in blocks:
        hit = keyed.select("h", "g", "text").mapInArrow(_block_hits(block), "h long, g long, spans array<long>, items array<string>")
        # copies of a text have equal hits: one of them stays, reduced before the shuffle
        now = staged(hit.groupBy("h", "g").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "benchmark-hits")
        found = now if found is None else found.unionByName(now)
        block.destroy()
    return found


def _block_hits(block):
    schema = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = block.value.patterns
        for batch in batches:
            out = []
            for h, g, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans, items = patterns.scan(words_of(text))
                if spans:
                    out.append({"h": h, "g": g, "spans": [x for s in spans for x in s], "items": sorted(items)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [_covered(list(zip(flat[::2], flat[1::2], strict=True))) for flat in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hit, pa.int64()), batch.column(3)], ["h", "g", "n_hit", "items"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(words_of(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64())], ["doc_id", "h", "g", "n_words"])


def _judge(block):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items", pa.list_(pa.string())), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = block.value.patterns
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                spans, found = patterns.scan(words)
                items, hit = sorted(found), _covered(spans)
                out.append((doc_id, len(words), hit, len(items), items, hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)] if out else [pa.array([], t) for t in schema.types], schema=schema)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any benchmark window, all columns kept.

    A benchmark within ``block_bytes`` is searched where the documents are read;
    a larger one block after block, and texts with a hit in any block are
    taken out by one anti join on 128 bits of hash. Null and empty texts stay;
    repeated rows are judged one by one, so all stay or all go; an empty
    benchmark, or one without words, keeps every document; an empty table gives
    no rows.
    """
    n, blocks = benchmark_blocks(benchmark, window, block_bytes=block_bytes)
    if n == 1:
        return map_rows(docs, text_col, _keep_clean(next(blocks)))
    flat, names = by_position(docs), docs.columns
    text = F.col(f"_{_position(docs, text_col)}").cast("binary")
    h, g = hash_pair(text)
    hits = _hits(flat.select(text.alias("text"), h.alias("h"), g.alias("g")), blocks).select("h", "g").distinct()
    kept = flat.withColumns({"h": h, "g": g}).join(hits, ["h", "g"], "left_anti")
    return kept.select(*flat.columns).toDF(*names)


def _keep_clean(block):
    def each(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        patterns = block.value.patterns
        clean = [t is None or not patterns.scan(words_of(t.encode()))[0] for t in batch.column(at).to_pylist()]
        return batch.filter(pa.array(clean, pa.bool_()))

    return each
