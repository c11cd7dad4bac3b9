"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import _position, by_position, pick

#: Words are merged side by side up to this many symbols, longer ones one at a time.
WIDE = 64
#: Symbols of one round of side-by-side merging.
ROUND_SYMBOLS = 1 << 19
#: Words that a worker remembers; beyond it forgets all and starts anew.
MEMO_WORDS = 150_000
#: Characters of texts encoded at a time.
ROUND_CHARS = 2_000_000
# Fixed value: how byte-level tokenizers cut text where their file names no pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class or lower case depends on the Unicode version, so that only the
# tokenizers library itself tells how its files cut them.
_RARE = re.compile("[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u1c89\u208f\u209d-\u209f\ua7cb-\ua7f1\uab6c\uab6d\U00010000-\U0001efff\U00020000-\U0010ffff]")
_NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else one from U+0100 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Tokenizer:
    """A BPE tokenizer file: how texts are cut, its merges by rank, and its token strings."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in (vocab | self.special).items()}
        self.steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        cut = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        self.find = regex.compile(cut[0] if cut else BYTE_LEVEL).findall
        self.path, self.library = path, None
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in symbols], np.int64)
        parts = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.base = 1 + max(self.strings)
        key = np.array([vocab[a] * self.base + vocab[b] for a, b in parts], np.int64)
        made = np.array([vocab[a + b] for a, b in parts], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], np.arange(len(key))[order], made
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))
        self.memo: dict[str, bytes] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def _merge_wide(self, words: list[bytes], width: int) -> list[bytes]:
        """Words of at most ``width`` bytes, a segment tree each, all trees worked side by side.

        A leaf holds rank * width + position of the pair that starts there, an
        inner node the minimum of its children: the root yields the leftmost
        pair of lowest rank. A merge rewrites three leaves and their paths.
        """
        n = np.array([len(w) for w in words])
        total, many = int(n.sum()), len(words)
        flat = np.frombuffer(b"".join(words), np.uint8)
        col = np.repeat(np.arange(many), n)
        row = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        sym = np.full((width, many), -1, np.int64)
        sym[row, col] = np.where(row == n[col] - 1, self.last[flat], self.inner[flat])
        after = np.where(np.arange(1, width + 1)[:, None] < n, np.arange(1, width + 1)[:, None], width)
        before = np.repeat(np.arange(-1, width - 1)[:, None], many, axis=1)
        tree = np.full((2 * width, many), _NONE, np.int32)
        if width > 1:
            r, c = np.nonzero(sym[1:] >= 0)
            rank = self._rank(sym[r, c], sym[r + 1, c])
            ok = rank >= 0
            tree[width + r[ok], c[ok]] = rank[ok] * width + r[ok]
            for node in range(width - 1, 0, -1):
                np.minimum(tree[2 * node], tree[2 * node + 1], out=tree[node])
        live = np.flatnonzero(tree[1] != _NONE)
        levels = width.bit_length() - 1
        while len(live):
            low = tree[1, live]
            i, rank = low % width, low // width
            j = after[i, live]
            k = after[j, live]
            p = before[i, live]
            sym[i, live] = self.made[rank]
            sym[j, live] = -1
            after[i, live] = k
            more = k < width
            before[k[more], live[more]] = i[more]
            tree[width + j, live] = _NONE
            right = np.full(len(live), _NONE, np.int64)
            if more.any():
                got = self._rank(sym[i[more], live[more]], sym[k[more], live[more]])
                right[more] = np.where(got >= 0, got * width + i[more], _NONE)
            tree[width + i, live] = right
            has = p >= 0
            if has.any():
                got = self._rank(sym[p[has], live[has]], sym[i[has], live[has]])
                tree[width + p[has], live[has]] = np.where(got >= 0, got * width + p[has], _NONE)
            p = np.where(has, p, i)
            for level in range(1, levels + 1):
                for leaf in (i, j, p):
                    node = (width + leaf) >> level
                    tree[node, live] = np.minimum(tree[2 * node, live], tree[2 * node + 1, live])
            live = live[tree[1, live] != _NONE]
        ids = sym.T
        kept = ids >= 0
        raw = ids[kept].astype("<u4").tobytes()
        ends = 4 * np.cumsum(kept.sum(axis=1))
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _merge_long(self, word: bytes) -> bytes:
        """One long word over one segment tree of plain lists."""
        sym = self.inner[np.frombuffer(word, np.uint8)].tolist()
        sym[-1] = int(self.last[word[-1]])
        n, width = len(sym), 1 << (len(sym) - 1).bit_length()
        none = (len(self.keys), 0)
        rank_of, base = self.rank_of, self.base

        def pair(i: int, k: int) -> tuple[int, int]:
            rank = rank_of.get(sym[i] * base + sym[k])
            return none if rank is None else (rank, i)

        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = pair(i, i + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = width + i
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != none:
            rank, i = tree[1]
            j = after[i]
            k = after[j]
            sym[i], sym[j], after[i] = int(self.made[rank]), -1, k
            put(j, none)
            put(i, pair(i, k) if k < n else none)
            if k < n:
                before[k] = i
            if before[i] >= 0:
                put(before[i], pair(before[i], i))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > WIDE:
                out[i] = self._merge_long(w)
            elif w:
                by_width.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        for width, at in by_width.items():
            step = max(1, ROUND_SYMBOLS // width)
            for a in range(0, len(at), step):
                part = at[a : a + step]
                for i, ids in zip(part, self._merge_wide([words[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def normal(self, text: str) -> str:
        for step in self.steps:
            if step == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif step == "Replace":
                text = regex.sub(r"\s+", " ", text)
            elif step == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # letter by letter, so no final sigma
            else:
                raise ValueError(f"unknown normalizer {step}")
        return text

    def pieces(self, text: str) -> list[str]:
        """Words of a text without special tokens, normalized, in order."""
        if text.isascii() or not _RARE.search(text):
            return self.find(self.normal(text))
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_file(self.path)
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [bytes(self.byte_of[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, text: str) -> list[str | int]:
        """Words of a text in order, and the ids of special tokens in it."""
        if self.split is None or not any(s in text for s in self.special):
            return self.pieces(text)
        out: list[str | int] = []
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                out.append(self.special[part])
            else:
                out += self.pieces(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each word merged once a round and remembered."""
        memo, words = self.memo, [self.cut(t) for t in texts]
        new = [w for w in {w for ws in words for w in ws} if w not in memo]
        for w in new:
            if isinstance(w, int):
                memo[w] = w.to_bytes(4, "little")
        new = [w for w in new if not isinstance(w, int)]
        for w, ids in zip(new, self.merge([w.encode() for w in new]), strict=True):
            memo[w] = ids
        out = [b"".join(map(memo.__getitem__, ws)) for ws in words]
        if len(memo) > MEMO_WORDS:
            memo.clear()
        return out

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens included: token strings joined by spaces, or their bytes in a byte-level file."""
        strings = list(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if not self.byte_level:
            return " ".join(strings)
        raw = bytearray()
        for s in strings:
            raw += s.encode() if s in self.special else bytes(self.byte_of[c] for c in s)
        return raw.decode("utf-8", "replace")


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once a process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def rounds(texts: list[str | None], chars: int = ROUND_CHARS) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_rows(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` ids and decoded.

    Whole texts are encoded where they are read, without a shuffle; the
    tokenizer file must be at ``path`` on every executor. Null and empty texts
    have no tokens; repeated documents get a row each; an empty table gives no
    rows; other columns are ignored. Words of any length are merged whole.
    """
    rows = pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            done = 0
            for part in rounds(batch.column(1).to_pylist()):
                ids = t.encode(part)
                said = [t.decode(i) for i in ids]
                cols = [batch.column(0).slice(done, len(part)), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()), pa.array([hashlib.sha256(s.encode()).hexdigest() for s in said], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i in ids], pa.list_(pa.int64())), pa.array(said, pa.string())]
                    names += ["ids", "decoded"]
                done += len(part)
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * keep_ids)


def with_tokens(docs: DataFrame, path: str, text_col: str = "text", names: tuple[str, str] = ("n_tokens", "token_ids")) -> DataFrame:
    """The documents, all columns kept, with their token count and ids in two new columns.

    A column of ``docs`` that already has one of the names is replaced. Null
    and empty texts have no tokens (0 and an empty list).
    """
    at = _position(docs, text_col)
    keep = [i for i, c in enumerate(docs.columns) if c.lower() not in names]
    flat = by_position(docs).select(*[f"_{i}" for i in keep], F.col(f"_{at}").alias("whole_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            ids = [i for part in rounds(batch.column(len(keep)).to_pylist()) for i in t.encode(part)]
            cols = [*batch.columns[:-1], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:-1], *names])

    schema = flat.drop("whole_text").schema.add(names[0], T.LongType()).add(names[1], T.ArrayType(T.IntegerType()))
    return flat.mapInArrow(run, schema).toDF(*[docs.columns[i] for i in keep], *names)
