"""Best-fit packing by sums of squares.

Documents become token ids by the tokenizers library, each ended by one id; only what is longer
than a sequence is cut. Pieces are then numbered among their equals and spread over shards by a hash of
all this, so that a hot key cannot fill one and the files' layout plays no part, and each shard of about
SHARD pieces is packed alone: a piece goes where the sum over gaps of squared counts of open sequences with
that gap becomes smallest. A shard wastes at most its last open sequences, whatever the number of shards.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import checkpoint, one_thread, reach, table

SHARD = 50_000
#: Characters of the pieces whose ids a worker keeps, and of the texts that are cut at once (or one text).
CACHE, STEP = 2_500_000, 500_000
#: Equal pieces that are written out in one place.
EQUALS = 1 << 16
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
KEYS = [c.split()[0] for c in PIECES.split(", ")]
#: Outside this, lower case, composition or character classes may differ between Python and the library.
ODD = re.compile("[^\\x00-\\x1b\\x20-\\x7f\\xc0-\\xd6\\xd8-\\xf6\\xf8-\u012f\u0131-\u017f\u2010-\u2027]")
#: The vocabulary's pre-tokenizer pattern (a fixed value) in re's classes, for lowered chunks.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Its pieces that are not words, for texts without an apostrophe.
SIGNS = [c for c in map(chr, range(33, 127)) if not c.isalpha()]
RUN = re.compile("[!-/:-@[-`{-~]{2}|[\u2010-\u2027]")
SIGN = re.compile(r"((?:[^\s\w]|_)+|\d)")


class WordIds:
    """Little-endian 32-bit ids of whole texts, kept by piece.

    Texts of usual characters are lowered and cut here as the vocabulary's normaliser and pattern
    do, and the library's model gives the ids of each new piece; texts with an ODD character or
    what may be a control string go to the library's whole tokenizer.
    """

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = byte_letters() | {32: " "}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, fresh: list[str]) -> None:
        for start in range(0, len(fresh), 2000):
            part = fresh[start : start + 2000]
            coded = self.model.encode(" ".join(part).encode().decode("latin-1").translate(self.letters), add_special_tokens=False)
            cuts = (4 * np.searchsorted(np.array(coded.word_ids), np.arange(len(part) + 1))).tolist()
            raw = np.array(coded.ids, dtype="<u4").tobytes()
            self.pieces.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:])], strict=True))
            self.held += sum(map(len, part))

    def cut(self, text: str) -> list[str] | None:
        if ODD.search(text) or "<|" in text:
            return None
        text = text.lower()
        if "'" in text:
            return PIECE.findall(text)
        if RUN.search(text):
            return SIGN.sub(r" \1 ", text).split()
        for sign in SIGNS:
            if sign in text:
                text = text.replace(sign, f" {sign} ")
        return text.split()

    def free(self) -> None:
        self.pieces, self.held = {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > CACHE:
            self.free()
        split = [self.cut(t) for t in texts]
        cache = self.pieces
        if missing := set().union(*[s for s in split if s]).difference(cache):
            self._learn(list(missing))
        return [self.whole(t) if s is None else b"".join([cache[p] for p in s]) for t, s in zip(texts, split, strict=True)]


_LOADED: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of each row's ids and end id.

    A null text is empty: one piece of the end id alone. Repeated rows give their pieces each.
    """

    def run(batches):
        words = load(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for at, texts in _steps(batch.column(1)):
                out = []
                for doc, raw in zip(docs[at : at + len(texts)], words.encode(texts), strict=True):
                    raw += end
                    for k, start in enumerate(range(0, len(raw), 4 * capacity)):
                        cut = raw[start : start + 4 * capacity]
                        out.append((doc, k, start // 4, len(cut) // 4, zlib.crc32(cut)))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=KEYS)

    return reach(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def _steps(column):
    """(place, texts) of about STEP characters, nulls as empty texts."""
    start, part, held = 0, [], 0
    for i, value in enumerate(column):
        part.append(value.as_py() or "")
        held += len(part[-1])
        if held >= STEP:
            yield start, part
            start, part, held = i + 1, [], 0
    if part:
        yield start, part


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, longest first: each goes where the sum of squares ends up smallest.

    counts[g]: open sequences with gap g. Moving one from gap g to gap h changes the sum by
    2 * (counts[h] - counts[g]) + 2, and full sequences (gap 0) don't count. Equal changes: the smaller gap.
    A new sequence opens only if no open one has room, as few sequences are wanted.
    """
    order = np.argsort(-lengths, kind="stable")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    made, widest = 0, 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        gap = 0
        if widest >= size:
            gaps = counts[size : widest + 1]
            have = gaps.nonzero()[0]
            if len(have):
                rest = counts[have]
                change = 2 * (rest - gaps[have]) + 2
                if have[0] == 0:
                    change[0] = 1 - 2 * gaps[0]
                gap = size + int(have[change.argmin()])
        if gap:
            k = open_[gap].pop()
            counts[gap] -= 1
        else:
            gap, k = capacity, made
            made += 1
        sequence[i], offset[i] = k, capacity - gap
        if rest := gap - size:
            open_[rest].append(k)
            counts[rest] += 1
            widest = max(widest, rest)
        while widest and not counts[widest]:
            widest -= 1
    return sequence, offset


def pack(cut: DataFrame, capacity: int = 2048, shard: int = SHARD, equals: int = EQUALS) -> DataFrame:
    """Add sequence_id and offset to pieces; an empty table gives an empty one.

    Ties are broken by all columns. Pieces equal in all of them (repeated rows) are packed like others and are
    interchangeable, so the result depends on the rows only, not on how they are stored.
    """
    shards = max(1, -(-cut.count() // shard))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*KEYS, "nth"], kind="stable").reset_index(drop=True)
        sequence, pdf["offset"] = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (np.int64(key[0]) << 32) + sequence
        return pdf[[*KEYS, "sequence_id", "offset"]]

    # equal pieces are counted, and written out again in blocks that lie apart
    groups = cut.groupBy(*KEYS).agg(F.count("*").alias("n")).withColumn("block", F.explode(F.expr(f"sequence(0, (n - 1) div {equals})")))
    rows = groups.repartition(*KEYS, "block").withColumn("nth", F.explode(F.expr(f"sequence(block * {equals}, least(n, (block + 1) * {equals}) - 1)")))
    # a row of a null id or with other nulls is hashed like any other
    dealt = rows.select(*KEYS, "nth", F.pmod(F.xxhash64(*KEYS, "nth"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(run, PIECES + ", sequence_id long, offset long")


def op8_packing(spark: SparkSession, sf_dir: str, path: str | None = None, capacity: int = 2048) -> DataFrame:
    """All `documents` in sequences of at most 2048 tokens."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    cut = checkpoint(pieces(table(spark, sf_dir, "documents"), path, capacity))
    return pack(cut, capacity)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that come in, packed: null and empty texts as one end id, repeated rows each; an empty table gives an empty one."""
    import public_tokenizers

    return pack(checkpoint(pieces(docs, public_tokenizers.path("word_bpe_49k.json"))))
