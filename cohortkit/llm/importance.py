"""Target-distribution importance resampling over hashed word runs, found by an Aho-Corasick dictionary."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import _position, by_position, pick, staged

#: Words in the automaton: the corpus's most frequent ones. The bytes of any other word give its payload.
DICTIONARY_WORDS = 50_000
#: Bytes of a word in the automaton; longer ones are computed from their bytes.
WORD_BYTES = 32
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 200_000
#: Texts are scanned in segments of about so many bytes, cut between words.
SEGMENT_BYTES = 4 << 20
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of digits, ASCII letters (A-Z as a-z) and non-ASCII characters."""
    return text.translate(_TO_WORDS).split() if text else []


def _appended_zeros() -> np.ndarray:
    """Tables [k, byte, value]: what appending 2^k zero bytes makes of a CRC-32, by each of its four bytes."""
    bits = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        bits = np.where(bits & 1, (bits >> 1) ^ np.uint32(0xEDB88320), bits >> 1)
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([(v >> np.uint32(8)) ^ bits[v & np.uint32(255)] for v in (values << np.uint32(8 * b) for b in range(4))])
    tables = [one]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return np.stack(tables)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


_ZEROS = _appended_zeros()


def joined_crc(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of strings put together, from the CRCs of their parts and the byte lengths of the right ones."""
    out, k = left.astype(np.uint32), 0
    while (length >> k).any():
        out = np.where((length >> k) & 1, _through(_ZEROS[k], out), out)
        k += 1
    return out ^ right


class Dictionary:
    """Aho-Corasick automaton over delimiter-bounded words; a word's payload is its CRC-32 and byte length."""

    def __init__(self, words: list[bytes]) -> None:
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):
            self.automaton.add_word(f" {w.decode('latin-1')} ", i)
        self.automaton.make_automaton()
        self.any = bool(words)

    def payloads(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(crc, length) of the words in order: what the automaton emits over the
        delimited text, and for words between its matches their own."""
        crcs, lengths = [], []
        start = size = 0
        for i, w in enumerate(words):
            size += len(w) + 1
            if size >= SEGMENT_BYTES or i == len(words) - 1:
                crc, length = self._scan(words[start : i + 1])
                crcs.append(crc)
                lengths.append(length)
                start, size = i + 1, 0
        if not crcs:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(crcs), np.concatenate(lengths)

    def _scan(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b" " + b" ".join(words) + b" "
        seen = self.automaton.iter(text.decode("latin-1")) if self.any else ()
        found = np.fromiter(chain.from_iterable(seen), np.int64).reshape(-1, 2)
        end, crc, length = found[:, 0], self.crc[found[:, 1]], self.length[found[:, 1]]
        if len(found) == len(words):
            return crc, length
        before = np.r_[0, end]  # delimiter where a gap begins, and where it ends
        after = np.r_[end - length - 1, len(text) - 1]
        gaps = np.flatnonzero(after > before)
        at, more_crc, more_length = [], [], []
        for a, b in zip(before[gaps].tolist(), after[gaps].tolist(), strict=True):
            for w in text[a + 1 : b].split(b" "):
                at.append(a)
                more_crc.append(zlib.crc32(w))
                more_length.append(len(w))
                a += len(w) + 1
        order = np.argsort(np.r_[end - length - 1, np.array(at, np.int64)], kind="stable")
        return np.r_[crc, np.array(more_crc, np.uint32)][order], np.r_[length, np.array(more_length, np.int64)][order]

    def features(self, words: list[bytes], run_words: int, buckets: int) -> np.ndarray:
        """Buckets of all runs of 1 to ``run_words`` words joined by a space: payloads of neighbours composed one word at a time."""
        crc, length = self.payloads(words)
        out, run = [crc], crc
        spaced = joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, length) if run_words > 1 else crc
        for n in range(2, run_words + 1):
            if len(words) < n:
                break
            run = joined_crc(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1)
            out.append(run)
        return np.concatenate(out).astype(np.int64) % buckets


_BUILT: dict[int, Dictionary] = {}


def _dictionary(shared) -> Dictionary:
    """The automaton of a broadcast word list, built once a worker; only the last one is kept."""
    if shared.value["key"] not in _BUILT:
        _BUILT.clear()
        _BUILT[shared.value["key"]] = Dictionary(shared.value["words"])
    return _BUILT[shared.value["key"]]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of short words that a task's stretch of rows has more than once."""
    count: Counter = Counter()

    def rows() -> pa.RecordBatch:
        some = {w: n for w, n in count.items() if n > 1 and len(w) <= WORD_BYTES}
        count.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(some), pa.binary()), pa.array(list(some.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            count.update(words_of(text))
            if len(count) > COUNTED_WORDS:
                yield rows()
    yield rows()


def frequent_words(*texts: DataFrame, most: int = DICTIONARY_WORDS) -> list[bytes]:
    """At most ``most`` frequent words over frames of one binary column. Only speed depends on which they are.

    How many words each quarter of a binary order of counts holds (a few hundred
    numbers) tells which counts are high enough, so that no task sends more than
    it has of the chosen words.
    """
    counted = None
    for t in texts:
        one = t.mapInArrow(_frequent, "word binary, n long")
        counted = one if counted is None else counted.unionByName(one)
    order = F.floor(4 * F.log2("n")).cast("int")
    counted = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).select("word", order.alias("order")), "word-counts")
    sizes, room, least = sorted(counted.groupBy("order").count().collect(), reverse=True), most, None
    while sizes and sizes[0]["count"] <= room:
        least, n = sizes.pop(0)
        room -= n
    chosen = counted.where(F.col("order") >= least).collect() if least is not None else []
    if sizes and room:
        chosen += counted.where(F.col("order") == sizes[0]["order"]).limit(room).collect()
    return [bytes(r["word"]) for r in chosen]


def bucket_counts(texts: DataFrame, shared, run_words: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts: tasks add up their own, at most ``buckets`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, dictionary = np.zeros(buckets, np.int64), _dictionary(shared)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(dictionary.features(words_of(text), run_words, buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: 1000 times the logarithm of the ratio of smoothed frequencies, rounded down."""
    big_s, big_t, k = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + k) / ((s + 1) * (big_t + k)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def chance(seed: int, doc_id: str) -> int:
    """A document's Gumbel noise, 1000 times and rounded down, from the hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_NEW = ("n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, run_words: int = 1, buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The documents (all columns, or those named in ``carry``) with n_features, weight, score and rank.

    Features are runs of 1 to ``run_words`` words; a bucket's gain compares how
    often ``target`` and ``docs`` have it; weight is a document's sum of gains
    and score adds noise by id, so that the highest scores are a sample without
    replacement. rank counts 1, 2, ... over the drawn documents: the highest
    ``percent`` of those with ``least_words`` words. Scores are put in order by
    range partitions, and a rank is a partition's offset plus the place in it:
    nothing meets in one task.

    Null and empty texts have no features, weight 0 and are never drawn; a null
    id counts as the text ``null`` and comes last among equal scores; repeated
    rows are ranked one by one. Without target words the gains compare with a
    uniform target. Empty tables give no rows. A column that has one of the new
    names is replaced; others pass through, also of clashing names.
    """
    spark = docs.sparkSession
    id_at, text_at = _position(docs, id_col), _position(docs, text_col)
    wanted = range(len(docs.columns)) if carry is None else [_position(docs, c) for c in carry]
    keep = [i for i in wanted if docs.columns[i].lower() not in _NEW]
    flat = by_position(docs)
    raw = flat.select(F.col(f"_{text_at}").cast("binary").alias("t"))
    aim = pick(target, target_text_col).select(F.col(target_text_col).cast("binary").alias("t"))
    words = frequent_words(raw, aim)
    shared = spark.sparkContext.broadcast({"key": hash((tuple(words),)), "words": words})
    gain = spark.sparkContext.broadcast(gains(bucket_counts(raw, shared, run_words, buckets), bucket_counts(aim, shared, run_words, buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, worth = _dictionary(shared), gain.value
        for batch in batches:
            out = []
            for name, text in zip(batch.column(len(keep) + 1).to_pylist(), batch.column(len(keep) + 2).to_pylist(), strict=True):
                words = words_of(text)
                found = dictionary.features(words, run_words, buckets)
                weight = int(worth[found].sum())
                out.append((len(words) >= least_words, len(found), weight, weight + chance(seed, name)))
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, (pa.bool_(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep) + 1], *cols], [*batch.schema.names[: len(keep) + 1], "able", *_NEW[:3]])

    rows = flat.select(*[f"_{i}" for i in keep], F.col(f"_{id_at}").alias("by"), F.coalesce(F.col(f"_{id_at}").cast("string"), F.lit("null")).alias("name"), F.col(f"_{text_at}").cast("binary").alias("t"))
    schema = rows.drop("name", "t").schema.add("able", "boolean").add("n_features", "long").add("weight", "long").add("score", "long")
    scored = staged(rows.mapInArrow(run, schema), "scores")
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("by"), F.asc("row")]
    line = scored.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    line = staged(line.drop("row", "by").withColumn("at", F.monotonically_increasing_id()), "ranked-scores")
    part, earlier, able = F.shiftright("at", 33), {}, 0
    total = 0
    for r in line.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("able").alias("able")).orderBy("part").collect():  # two numbers a partition
        earlier[r["part"]] = total
        total, able = total + r["n"], able + r["able"]
    drawn = percent * able // 100
    offsets = F.broadcast(spark.createDataFrame(list(earlier.items()), "part long, earlier long"))
    rank = F.col("earlier") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = line.withColumn("part", part).join(offsets, "part")
    out = ranked.select(*[f"_{i}" for i in keep], *_NEW[:3], F.when(F.col("able") & (rank <= drawn), rank).alias("rank"))
    return out.toDF(*[docs.columns[i] for i in keep], *_NEW)
