"""BPE encoding and decoding with a contiguous rank array for each short word.

A word's symbols stand in one row of an array, the ranks of its adjacent pairs in another. While
any pair has a rank, the smallest (leftmost among equals) is found by a scan, its right boundary is
deleted by moving the rest of the row left, and the ranks of the two neighbouring pairs are looked
up again. Rows of many words are scanned together with numpy; words of more than LONG symbols take
the same merges from a heap over a linked list instead, as repeated scans would take square time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import append, one_thread, table

LONG = 48
CACHE = 400_000
NONE = np.int64(1) << 40
#: The byte-level split of the vocabulary's pre-tokenizer (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same split where re's classes agree with it, that is for texts within COMMON.
QUICK = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
COMMON = re.compile("[^\\x00-\\x1b\\x20-\\x7f\\xc0-\\xd6\\xd8-\\xf6\\xf8-ɏ‐-‧]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}


class RankedBpe:
    """A byte-level BPE vocabulary file of the tokenizers library, encoded and decoded here."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        bytes_of = {c: b for b, c in letters.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: bytes(bytes_of[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.tokens |= {i: s.encode() for s, i in self.special.items()}
        self.base = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.width = max(self.tokens) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.pair = dict(zip(keys.tolist(), range(len(pairs)), strict=True))
        self.split = regex.compile(SPLIT)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, str] = {}
        self.back: dict[str, bytes] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it has none (or an end, -1)."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def _short(self, words: list[bytes]) -> list[list[int]]:
        size = np.array([len(w) for w in words])
        width = int(size.max()) + 1
        parts = np.full((len(words), width), -1, dtype=np.int64)
        parts[np.arange(width) < size[:, None]] = self.base[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ranks = np.full((len(words), width), NONE)
        ranks[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        live, out = np.arange(len(words)), [None] * len(words)
        columns = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ranks)), at]
            done = best == NONE
            if done.any():
                for i, row in zip(live[done].tolist(), parts[done].tolist(), strict=True):
                    out[i] = row[: row.index(-1)]
                more = ~done
                if not more.any():
                    return out
                parts, ranks, live, at, best = parts[more], ranks[more], live[more], at[more], best[more]
            row = np.arange(len(parts))
            parts[row, at] = self.made[best]
            move = columns[1:-1] > at[:, None]
            parts[:, 1:-1] = np.where(move, parts[:, 2:], parts[:, 1:-1])
            ranks[:, 1:-1] = np.where(move, ranks[:, 2:], ranks[:, 1:-1])
            ranks[row, at] = self._rank(parts[row, at], parts[row, at + 1])
            before = np.maximum(at - 1, 0)
            again = self._rank(parts[row, before], parts[row, before + 1])
            ranks[row, before] = again

    def _long(self, word: bytes) -> list[int]:
        part = self.base[np.frombuffer(word, dtype=np.uint8)].tolist()
        n, pair, width, made = len(part), self.pair, self.width, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(part, part[1:])) if (r := pair.get(a * width + b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = int(made[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := pair.get(part[i] * width + part[k])) is not None:
                    heapq.heappush(heap, (x, i, part[i], part[k]))
            if (h := before[i]) >= 0 and (x := pair.get(part[h] * width + part[i])) is not None:
                heapq.heappush(heap, (x, h, part[h], part[i]))
        return [p for p in part if p >= 0]

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of each non-empty word, which no split crosses."""
        raw = [w.encode() for w in words]
        out: list = [None] * len(raw)
        short = sorted((i for i, w in enumerate(raw) if len(w) <= LONG), key=lambda i: len(raw[i]))
        for start in range(0, len(short), 4096):
            part = short[start : start + 4096]
            for i, ids in zip(part, self._short([raw[i] for i in part]), strict=True):
                out[i] = ids
        for i, w in enumerate(raw):
            if len(w) > LONG:
                out[i] = self._long(w)
        return out

    def pieces(self, text: str) -> list[str]:
        """The text cut at special tokens and by the split pattern; joined again it is the text."""
        cuts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        out: list[str] = []
        for k, part in enumerate(cuts):
            if k % 2:
                out.append(part)
            elif part:
                out += self.split.findall(part) if COMMON.search(part) else QUICK.findall(part)
        return out

    def encode_strings(self, texts: list[str | None]) -> list[list[str]]:
        """For each text its pieces' ids, as decimals joined by commas."""
        split = [self.pieces(t or "") for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
            self.back.clear()
        cache = self.cache
        missing = list({p for s in split for p in s if p not in cache})
        cache |= {s: str(i) for s, i in self.special.items()}
        missing = [p for p in missing if p not in self.special]
        for start in range(0, len(missing), 50_000):
            part = missing[start : start + 50_000]
            cache.update(zip(part, (",".join(map(str, ids)) for ids in self.words(part)), strict=True))
        return [[cache[p] for p in s] for s in split]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for s in self.encode_strings([text])[0] for i in s.split(",")]

    def decode(self, ids) -> str:
        """Ids that the vocabulary lacks are passed over; broken UTF-8 becomes replacement signs."""
        return b"".join(self.tokens.get(i, b"") for i in ids).decode("utf-8", "replace")

    def decode_strings(self, ids: list[str]) -> bytes:
        back, tokens = self.back, self.tokens
        for s in set(ids):
            if s not in back:
                back[s] = b"".join(tokens[int(i)] for i in s.split(","))
        return b"".join([back[s] for s in ids])


_LOADED: dict[str, RankedBpe] = {}


def load(path: str) -> RankedBpe:
    """One a process: its cache of words stays from task to task."""
    if path not in _LOADED:
        one_thread()
        _LOADED[path] = RankedBpe(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ids array<int>: the ids of each whole text; [] for a null or empty text.

    Rows stay as they are, repeated ones too; an empty table gives an empty one; an own column
    `ids` of the input is replaced.
    """

    def make():
        bpe = load(path)
        return lambda texts: [[[int(i) for s in strings for i in s.split(",")] for strings in bpe.encode_strings(texts)]]

    return append(df, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)], make)


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add decoded string: the text of each id list; "" for a null or empty list."""

    def make():
        bpe = load(path)
        return lambda rows: [[bpe.decode(ids or []) for ids in rows]]

    return append(df, ids_col, [T.StructField("decoded", T.StringType(), False)], make)


def digests(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256 of each whole text, encoded and decoded by this module."""
    fields = [T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_sha256", T.StringType(), False), T.StructField("decoded_sha256", T.StringType(), False)]

    def make():
        bpe = load(path)

        def score(texts):
            counts, ids, back = [], [], []
            for start in range(0, len(texts), 100):
                for strings in bpe.encode_strings(texts[start : start + 100]):
                    line = ",".join(strings)
                    counts.append(line.count(",") + 1 if line else 0)
                    ids.append(hashlib.sha256(line.encode()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode_strings(strings).decode("utf-8", "replace").encode()).hexdigest())
            return [counts, ids, back]

        return score

    return append(df, text_col, fields, make)


def op6_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Digests of all whole `documents` under the public byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
