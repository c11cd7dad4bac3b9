"""Secret scans: fixed patterns plus a randomness test battery with false-discovery control."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import map_rows, pick, staged

# The base patterns, their least lengths and their order.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Candidates of the battery: whole runs of this many characters of an encoding's alphabet; '=' ends a run
#: (as padding) or stands before one (name=run), so it is no part of the run's beginning.
LEAST_RUN = 20
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_RUN},}}(?:={{1,2}}+(?![A-Za-z0-9+/_-]))?")

# Symbols of each encoding in order, and the chance that two symbols of ordinary
# text in that alphabet agree (written words: 0.0667 as in English letters; numbers: 0.125).
# The smallest comes first.
ENCODINGS = {
    "hex": ("0123456789abcdef", 0.125),
    "upperhex": ("0123456789ABCDEF", 0.125),
    "mixedhex": ("0123456789ABCDEFabcdef", 0.125),
    "lower": ("abcdefghijklmnopqrstuvwxyz", 0.0667),
    "capitals": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.0667),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.0667),
    "lowerbase32": ("abcdefghijklmnopqrstuvwxyz234567", 0.0667),
    "upper": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.0667),
    "loweralnum": ("0123456789abcdefghijklmnopqrstuvwxyz", 0.0667),
    "letters": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.0667),
    "alnum": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.0667),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.0667),
    "base64url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 0.0667),
}
_RANK = {name: ({c: i for i, c in enumerate(symbols)}, frozenset(symbols), agree) for name, (symbols, agree) in ENCODINGS.items()}

#: A random string fails a test of the battery with this chance.
FAIL = 0.001
#: Share of false ones that is accepted among the added spans of a length stratum.
DISCOVERY_RATE = 0.01
#: Least lengths of the strata; p-values are binned by tenths of a power of ten down to 1e-60.
STRATA = (20, 24, 32, 48, 64, 128)
BINS = 600


def infer_encoding(s: str) -> str | None:
    """The smallest alphabet that holds every character."""
    chars = set(s)
    return next((name for name, (_, symbols, _) in _RANK.items() if chars <= symbols), None)


def _lower_tail(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(s: str) -> float:
    """Chance that ordinary text looks as uniform as ``s``; 1 if ``s`` fails a test that random strings pass.

    The chi-squared statistic over the inferred alphabet is set against two
    laws: the central one of a random string, which it must not exceed, and the
    non-central one of ordinary text, whose non-centrality grows with the
    length. Runs above and below the middle of the alphabet and the lag-one
    serial correlation must also stay in their random range. Hex digits of
    both cases are read as 22 symbols and, the case left out, as 16; the better
    of the two counts, at twice its chance.
    """
    body = s.rstrip("=")
    name = infer_encoding(body)
    if name is None:
        return 1.0
    if name == "mixedhex":
        return min(1.0, 2 * min(_judged(body, name), _judged(body.lower(), "hex")))
    return _judged(body, name)


def _judged(body: str, name: str) -> float:
    rank, symbols, agree = _RANK[name]
    n, size = len(body), len(symbols)
    x = np.fromiter(map(rank.__getitem__, body), np.float64, n)
    seen = np.bincount(x.astype(np.int64), minlength=size)
    chi = float((seen * seen).sum()) * size / n - n
    if 1 - _lower_tail((chi - size + 1) / math.sqrt(2 * (size - 1))) < FAIL:
        return 1.0
    high = x >= size / 2
    a = int(high.sum())
    b = n - a
    if min(a, b) == 0:
        return 1.0
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    if var > 0 and _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)) < FAIL:
        return 1.0
    centred = x - x.mean()
    power = float((centred * centred).sum())
    if power and _two_sided(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n)) < FAIL:
        return 1.0
    shift = n * (size * agree - 1)
    return _lower_tail((chi - (size - 1) - shift) / math.sqrt(2 * (size - 1 + 2 * shift)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, p-value bin) of the runs apart from base spans; a higher bin is a smaller p-value."""
    out = []
    for m in _RUN.finditer(text):
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        p = battery(m.group())
        if p < 1:
            level = BINS if p <= 0 else min(BINS, int(-10 * math.log10(p)))
            out.append((m.start(), m.end(), sum(m.end() - m.start() >= least for least in STRATA) - 1, level))
        else:
            out.append((m.start(), m.end(), sum(m.end() - m.start() >= least for least in STRATA) - 1, 0))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_CAND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.int32()), ("level", pa.int32())])
_FOUND = "doc_id long, base array<struct<start:int,kind:int,end:int>>, runs array<struct<start:int,end:int,stratum:int,level:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bases, runs = [], []
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
            runs.append([{"start": s, "end": e, "stratum": t, "level": v} for s, e, t, v in candidates(text or "", base)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, pa.list_(_SPAN)), pa.array(runs, pa.list_(_CAND))], ["doc_id", "base", "runs"])


def scan_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and battery runs of every document (one pass, no shuffle, no text in the result)."""
    return pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scan, _FOUND)


def thresholds(scanned: DataFrame, rate: float = DISCOVERY_RATE) -> list[int]:
    """Least bin that counts as a discovery, for each length stratum (Benjamini-Hochberg over all documents).

    Only the histogram of strata and bins reaches the driver, at most
    6 * 601 numbers whatever the size of the corpus.
    """
    seen = {(r["stratum"], r["level"]): r["n"] for r in scanned.select(F.explode("runs").alias("r")).groupBy("r.stratum", "r.level").agg(F.count("*").alias("n")).collect()}
    out = []
    for stratum in range(len(STRATA)):
        tested = sum(n for (s, _), n in seen.items() if s == stratum)
        least, found = BINS + 1, 0
        for level in range(BINS, 0, -1):
            found += seen.get((stratum, level), 0)
            if found and 10 ** (-level / 10) * tested <= rate * found:
                least = level
        out.append(least)
    return out


def scan_secrets(docs: DataFrame, rate: float = DISCOVERY_RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans (all), n_random.

    Base spans are always kept. The battery adds runs of 20 characters and more
    of an encoding alphabet which overlap no base span, look random, and pass
    the false-discovery control of their length stratum over the whole corpus.
    Null and empty texts have no spans (``spans`` is empty, the digest that of
    the empty string); repeated documents get a row each; an empty table gives
    no rows; other columns are ignored. Texts are scanned whole; the scan's
    spans are staged without texts, so texts are read once.
    """
    found = staged(scan_rows(docs, id_col, text_col), "secret-spans")
    least = F.array(*[F.lit(x) for x in thresholds(found, rate)])
    added = F.filter("runs", lambda r: r["level"] >= least[r["stratum"]])
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def said(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")

    everything = F.concat("base", F.transform(added, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(said(F.col("base")).cast("binary"), 256).alias("base_sha256"), said(everything).alias("spans"), F.size(added).cast("long").alias("n_random"))


#: What takes a secret's place.
MASK = "[SECRET]"


def redact_secrets(docs: DataFrame, rate: float = DISCOVERY_RATE, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span of :func:`scan_secrets` replaced by ``[SECRET]``, all columns kept.

    Overlapping spans become one mask. ``chars_col`` (if present) is set to the
    new length where a text changed. Null and empty texts stay as they are.
    """
    least = thresholds(scan_rows(pick(docs, text_col).withColumn("doc_id", F.lit(0)), "doc_id", text_col), rate)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def each(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        changed = [None] * len(texts)
        for i, text in enumerate(texts):
            if text:
                base = base_spans(text)
                spans = [(s, e) for s, _, e in base] + [(s, e) for s, e, t, v in candidates(text, base) if v >= least[t]]
                if spans:
                    changed[i] = masked(text, spans)
        cols = list(batch.columns)
        cols[at] = pa.array([t if c is None else c for t, c in zip(texts, changed, strict=True)], batch.schema.field(at).type)
        if chars_at is not None:
            cols[chars_at] = pa.array([n if c is None else len(c) for n, c in zip(batch.column(chars_at).to_pylist(), changed, strict=True)], batch.schema.field(chars_at).type)
        return pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return map_rows(docs, text_col, each)


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    out, last = [], 0
    for start, end in sorted(spans):
        if start >= last:
            out += [text[last:start], MASK]
        last = max(last, end)
    return "".join([*out, text[last:]])
