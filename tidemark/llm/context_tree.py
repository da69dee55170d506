"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each is predicted in the contexts of the 0 to DEPTH bytes before
it. Every node (context, decisions so far) has a Krichevsky-Trofimov estimate from its counts, and
the weighted probability of a node is half its own estimate and half the product of its children's.
Given the whole training corpus the nodes' posterior weights mix the estimates along a context path.

Texts are packed into blocks of about BLOCK bytes. Each block asks for its distinct (DEPTH + 1)-grams,
with their counts in its training texts. The asked grams are dealt by their last two context bytes,
summed, and the subtrees below those bytes are weighted where they lie; every node is kept. Each
distinct gram is looked up there once, in the deepest node seen of each decision, and the answers go
back to the blocks that asked. Only the nodes of depths 0 and 1, of which there are at most 256 * 255
whatever the input, are sent to all.

Beside it stands the base: an add-half unigram model of tokens, whose counts cover all training
texts. Tokens that make up a millionth of all or more (a million at most) are broadcast, the others
are joined.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, one_thread, reach, remainder, table

DEPTH = 5
#: Bytes of text in a block, and in each of its chunks.
BLOCK = 1 << 24
CHUNK = 1 << 22
#: Grams are dealt into as many buckets as there are blocks, within these bounds.
BUCKETS = (64, 4096)
#: Tokens with at least this share of all are broadcast: 1 / SHARE of them at most.
SHARE = 1e-6
FLUSH = 400_000
#: Below any UTF-8 byte of a text stand DEPTH of these, and one ends it; no UTF-8 holds it.
EDGE = 0xFF
HALF = math.log(0.5)
END = b"\n"


def tokens(text: bytes) -> list[bytes]:
    """Words of a lower-cased text and one end, which no word can equal."""
    out = text.split()
    out.append(END)
    return out


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()  # of bytes, so A-Z only


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(DEPTH + 1)-gram codes at every byte and end of the texts, and where each text's codes start."""
    edge = bytes([EDGE])
    raw = np.frombuffer(edge * DEPTH + (edge + edge * DEPTH).join(texts) + edge, dtype=np.uint8).astype(np.uint64)
    code = np.zeros(len(raw) - DEPTH, dtype=np.uint64)
    for k in range(DEPTH + 1):
        code = (code << np.uint64(8)) | raw[k : len(raw) - DEPTH + k]
    size = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(size + DEPTH) - size - DEPTH
    keep = np.ones(len(code), dtype=bool)
    for j in range(DEPTH):
        at = starts[1:] - DEPTH + j
        keep[at] = False
    return code[keep], np.cumsum(size) - size


def _count(batches):
    """Partial counts of tokens: (token, c)."""
    one_thread()
    words: Counter = Counter()

    def flush():
        rows = list(words.items())
        words.clear()
        for i in range(0, len(rows), 50_000):
            part = rows[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], type=pa.binary()), pa.array([c for _, c in part], type=pa.int64())], names=["token", "c"])

    for batch in batches:
        for value in batch.column(0):
            words.update(tokens(lowered(value.as_py())))
            if len(words) > FLUSH:
                yield from flush()
    yield from flush()


def _blocks(column, size: int = CHUNK):
    """Lower-cased texts in blocks of about `size` bytes."""
    block, held = [], 0
    for value in column:
        t = lowered(value.as_py())
        block.append(t)
        held += len(t)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def _sum(keys: np.ndarray, *columns: np.ndarray) -> tuple:
    """Columns summed by key, keys ascending."""
    if not len(keys):
        return (keys, *columns)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (keys[starts], *[np.add.reduceat(c[order], starts) for c in columns])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x >= 0.5, by Stirling's series eight steps on."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return series - np.log(product)


def block_probability(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    n0, n1 = n0.astype(np.float64), n1.astype(np.float64)
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)


def _one(n0, n1):
    return (n1 + 0.5) / (n0 + n1 + 1.0)


def _weigh(n0, n1, below):
    """(log weighted probability, posterior weight of the node's own estimate)."""
    own = HALF + block_probability(n0, n1)
    both = np.logaddexp(own, HALF + below)
    return both, np.exp(own - both)


def subtrees(codes: np.ndarray, n: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For depths DEPTH to 2: (depth, keys, n0, n1, mixture of depths 2 and on, log weighted probability)."""
    context, symbol = codes >> np.uint64(8), codes & np.uint64(255)
    keys, zeros, ones = [], [], []
    for k in range(8):
        keys.append((context << np.uint64(8)) | np.uint64(1 << k) | (symbol >> np.uint64(8 - k)))
        bit = ((symbol >> np.uint64(7 - k)) & np.uint64(1)).astype(np.int64)
        ones.append(n * bit)
        zeros.append(n * (1 - bit))
    key, n0, n1 = _sum(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))
    levels = [(DEPTH, key, n0, n1, block_probability(n0, n1), np.ones(len(key)))]
    for d in range(DEPTH - 1, 1, -1):
        _, key, n0, n1, weighted, _ = levels[-1]
        up = ((key >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)) << np.uint64(8) | (key & np.uint64(255))
        key, n0, n1, below = _sum(up, n0, n1, weighted)
        levels.append((d, key, n0, n1, *_weigh(n0, n1, below)))
    out, carry = [], None
    for d, key, n0, n1, weighted, own in reversed(levels):
        # carry: of the level above, its keys, what shallower depths add, and the share that is left
        if carry is None:
            add, left = np.zeros(len(key)), np.ones(len(key))
        else:
            up = ((key >> np.uint64(8)) & np.uint64((1 << (8 * (d - 1))) - 1)) << np.uint64(8) | (key & np.uint64(255))
            at = np.searchsorted(carry[0], up)
            add, left = carry[1][at], carry[2][at]
        p = _one(n0, n1)
        out.append((d, key, n0, n1, add + left * p, weighted))
        carry = (key, add + left * own * p, left * (1 - own))
    return out[::-1]


#: Rows that are dealt: to a block or bucket (place), in the order of kind there, from a block (origin).
DEALT = "place long, kind int, origin long, data binary"


def _row(place: int, kind: int, origin: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([place], type=pa.int64()), pa.array([kind], type=pa.int32()), pa.array([origin], type=pa.int64()), pa.array([data], type=pa.binary())], names=["place", "kind", "origin", "data"])


def _planes(codes: np.ndarray) -> bytes:
    """Ascending codes of DEPTH + 1 bytes as the planes of their steps' bytes, which compress well."""
    step = np.diff(codes, prepend=np.uint64(0)).astype(">u8")
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, 7 - DEPTH :].T).tobytes()


def _codes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, 7 - DEPTH :] = np.frombuffer(data, dtype=np.uint8, count=n * (DEPTH + 1)).reshape(DEPTH + 1, n).T
    return np.cumsum(out.view(">u8").ravel().astype(np.uint64), dtype=np.uint64)


def _with(codes: np.ndarray, values: np.ndarray) -> bytes:
    """Ascending codes, and one 4-byte value or row of values for each."""
    return _planes(codes) + values.tobytes()


def _read(data: bytes, kind, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // (DEPTH + 1 + 4 * width)
    values = np.frombuffer(data, dtype=kind, offset=n * (DEPTH + 1))
    return _codes(data, n), values if width == 1 else values.reshape(n, width)


def _pack(batches):
    """Chunks of rows (doc_id, held_out, known, text), texts in lower case, each to its block."""
    one_thread()
    task, block, size = TaskContext.get().partitionId() << 32, 0, 0
    option = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        at = 0
        for texts in _blocks(batch.column(3)):
            part = batch.slice(at, len(texts))
            at += len(texts)
            chunk = pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(texts, type=pa.large_binary())], names=["doc_id", "held_out", "known", "text"])
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, chunk.schema, options=option) as writer:
                writer.write_batch(chunk)
            size += sum(map(len, texts))
            yield _row(task + block, 1, 0, out.getvalue().to_pybytes())
            if size >= BLOCK:
                block, size = block + 1, 0


def _unpack(data: bytes) -> tuple[pa.RecordBatch, list[bytes]]:
    with pa.ipc.open_stream(data) as reader:
        batch = reader.read_next_batch()
    return batch, batch.column(3).to_pylist()


def _rows(batches):
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), (x.as_py() for x in batch.column(3)))


def _asked(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts, ascending, and their counts in the known ones."""
    codes, starts = grams(texts)
    size = np.diff(starts, append=len(codes))
    both = np.sort((codes << np.uint64(1)) | np.repeat(known, size).astype(np.uint64))
    codes = both >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat((both & np.uint64(1)).astype(np.int64), first)


def _pair(codes: np.ndarray) -> np.ndarray:
    return ((codes >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64)


def _ask(buckets: int):
    """Grams asked for by each block, with their counts in training, to the bucket of their last two context bytes."""

    def deal(block, parts):
        codes, n = _sum(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts]))
        bucket = ((_pair(codes) * 0x9E3779B1) & 0xFFFFFFFF) * buckets >> 32
        order = np.argsort(bucket, kind="stable")
        codes, n, bucket = codes[order], n[order].astype("<u4"), bucket[order]
        cuts = [*np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist(), len(codes)]
        for i, j in zip(cuts, cuts[1:]):
            yield _row(int(bucket[i]), 1, block, _with(codes[i:j], n[i:j]))

    def run(batches):
        one_thread()
        now, parts = None, []
        for block, _, _, data in _rows(batches):
            if parts and block != now:
                yield from deal(now, parts)
                parts = []
            batch, texts = _unpack(data)
            now = block
            parts.append(_asked(texts, np.array(batch.column(2).to_pylist(), dtype=bool)))
        if parts:
            yield from deal(now, parts)

    return run


def deepest(levels: list, codes: np.ndarray) -> np.ndarray:
    """For ascending codes, the probability of each of the eight decisions made in its deepest node seen, -1 without one of depth 2 or more."""
    context, symbol = codes >> np.uint64(8), codes & np.uint64(255)
    out = np.full((len(codes), 8), -1.0, dtype=np.float32)
    for k in range(8):
        prefix = np.uint64(1 << k) | (symbol >> np.uint64(8 - k))
        todo = np.arange(len(codes))
        p = np.full(len(codes), -1.0)
        for d, keys, _, _, q, _ in levels:
            if not len(keys) or not len(todo):
                continue
            key = ((context[todo] & np.uint64((1 << (8 * d)) - 1)) << np.uint64(8)) | prefix[todo]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            p[todo[hit]] = q[at[hit]]
            todo = todo[~hit]
        one = ((symbol >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        out[:, k] = np.where(p < 0, -1.0, np.where(one, p, 1 - p))
    return out


def _nodes(batches):
    """Rows dealt to buckets, sorted by place: every asked gram with its decisions' probabilities, and the nodes of depth 2 summed to depth 1 (key, n0, n1, weighted)."""
    one_thread()

    def out(place, data, key, n0, n1, weighted):
        none = data is None
        return pa.RecordBatch.from_arrays(
            [pa.array([place] * len(key), type=pa.int64()), pa.array([0] * len(key), type=pa.int32()), pa.nulls(len(key), pa.int64()), pa.nulls(len(key), pa.binary()) if none else pa.array([data], type=pa.binary()), pa.array(key, type=pa.int64()), pa.array(n0, type=pa.int64()), pa.array(n1, type=pa.int64()), pa.array(weighted, type=pa.float64())],
            names=["place", "kind", "origin", "data", "key", "n0", "n1", "weighted"],
        )

    def work(place, codes, n):
        pair = _pair(codes)
        order = np.argsort(pair, kind="stable")
        codes, n, pair = codes[order], n[order], pair[order]
        ends = np.flatnonzero(np.r_[pair[1:] != pair[:-1], True]) + 1
        i = 0
        while i < len(codes):  # whole pairs, about 200,000 grams at once
            j = int(ends[min(np.searchsorted(ends, i + 200_000), len(ends) - 1)])
            c = np.argsort(codes[i:j])
            c, m = codes[i:j][c], n[i:j][c]
            levels = subtrees(c[m > 0], m[m > 0])
            _, key, n0, n1, _, weighted = levels[-1]
            if len(key):
                up, n0, n1, weighted = _sum(key & np.uint64(0xFFFF), n0, n1, weighted)
                yield out(place, None, up.astype(np.int64), n0, n1, weighted)
            for a in range(0, len(c), 100_000):
                part = c[a : a + 100_000]
                yield out(place, _with(part, deepest(levels, part)), [None], [None], [None], [None])
            i = j

    now, parts, held = None, [], 0
    for place, _, _, data in _rows(batches):
        if parts and place != now:
            yield from work(now, *_sum(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts])))
            parts, held = [], 0
        now = place
        codes, n = _read(data, "<u4")
        parts.append((codes, n.astype(np.int64)))
        held += len(codes)
        if held > 2_000_000 and held > 2 * len(parts[0][0]):
            parts = [_sum(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts]))]
            held = len(parts[0][0])
    if parts:
        yield from work(now, *_sum(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts])))


def top(nodes: DataFrame) -> dict:
    """Depths 1 and 0 of the model: the share of the own estimate, and the estimate; 0: not seen."""
    # at most 256 * 255 rows
    one = nodes.where("key IS NOT NULL").groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below")).toArrow()
    key, n0, n1, below = (one.column(i).to_numpy() for i in range(4))
    own = _weigh(n0, n1, below)
    first, root = np.zeros((2, 256 * 256)), np.zeros((2, 256))
    first[:, key] = own[1], _one(n0, n1)
    # below the root stand the weighted probabilities of depth 1
    prefix, z, o, below = _sum((key & 255).astype(np.uint64), n0, n1, own[0])
    if len(prefix):
        root[:, prefix.astype(np.int64)] = _weigh(z, o, below)[1], _one(z, o)
    return {"first": first, "root": root}


def log2_byte(model: dict, codes: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """log2 probability of each gram's last byte in its context, from depths 1 and 0 and deepest(); -8 without any training text."""
    last, symbol = (codes >> np.uint64(8)) & np.uint64(255), codes & np.uint64(255)
    out = np.zeros(len(codes))
    for k in range(8):
        prefix = np.uint64(1 << k) | (symbol >> np.uint64(8 - k))
        one = ((symbol >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        p = deep[:, k].astype(np.float64)
        for own, est in (model["first"][:, ((last << np.uint64(8)) | prefix).astype(np.int64)], model["root"][:, prefix.astype(np.int64)]):
            made = np.where(one, est, 1 - est)
            p = np.where(est > 0, own * made + (1 - own) * np.where(p < 0, made, p), p)
        out += np.log2(np.where(p < 0, 0.5, p))
    return out


def _answer(shared):
    """Rows dealt to buckets, sorted by place and kind: each asked gram's log2 probability, to the block that asked."""

    def run(batches):
        one_thread()
        model, now, parts, codes, bits = shared.value, None, [], None, None
        for place, kind, origin, data in _rows(batches):
            if place != now:
                now, parts, codes = place, [], None
            if kind == 0:
                c, deep = _read(data, "<f4", 8)
                parts.append((c, log2_byte(model, c, deep).astype("<f4")))
                continue
            if codes is None:
                codes, bits = _table(parts)
            c, _ = _read(data, "<u4")
            yield _row(origin, 0, 0, _with(c, bits[_find(codes, c)]))

    return run


def _table(parts: list) -> tuple[np.ndarray, np.ndarray]:
    codes, bits = np.concatenate([c for c, _ in parts]), np.concatenate([b for _, b in parts])
    order = np.argsort(codes)
    return codes[order], bits[order]


def _find(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(codes, wanted)
    if len(wanted) and (at[-1] >= len(codes) or not np.array_equal(codes[at], wanted)):
        raise RuntimeError("a gram was not answered")
    return at


def log10_texts(table: tuple, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each text and its end, from the answers (codes, log2 probabilities) of its block."""
    codes, starts = grams(texts)
    kinds, at = np.unique(codes, return_inverse=True)
    return np.add.reduceat(table[1][_find(table[0], kinds)].astype(np.float64)[at], starts) * math.log10(2)


def score(df: DataFrame, known, id_col: str = "doc_id", text_col: str = "text", held=None) -> DataFrame:
    """One row per row of df: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    known: which rows are learned from (a null condition: not); held_out is its opposite unless `held` says else. Null
    and empty texts are one end. Without any row to learn from every decision has probability one half and the base
    log10(1) a token. Repeated rows get a row each; other columns are not carried.
    """
    spark = reach(df).sparkSession
    train = df.where(known).select(F.col(text_col).alias("text"))
    words = checkpoint(train.mapInArrow(_count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")))
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    below = math.log10(total + 0.5 * (kinds + 1))
    often = words.where(F.col("c") >= max(1.0, total * SHARE)).toArrow() if total else None
    often_tokens = dict(zip((x.as_py() for x in often.column(0)), often.column(1).to_pylist(), strict=True)) if often is not None else {}
    held = ~F.coalesce(known, F.lit(False)) if held is None else held
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(known, F.lit(False)).alias("known"), F.col(text_col).alias("text"))
    chunks = checkpoint(rows.mapInArrow(_pack, DEALT))
    buckets = min(max(chunks.select("place").distinct().count(), BUCKETS[0]), BUCKETS[1])
    asked = checkpoint(chunks.mapInArrow(_ask(buckets), DEALT))
    nodes = checkpoint(asked.repartition("place").sortWithinPartitions("place").mapInArrow(_nodes, DEALT + ", key long, n0 long, n1 long, weighted double"))
    shared = spark.sparkContext.broadcast(top(nodes))
    often_ = spark.sparkContext.broadcast(often_tokens)
    found = asked.union(nodes.where("data IS NOT NULL").select("place", "kind", "origin", "data"))
    answers = found.repartition("place").sortWithinPartitions("place", "kind").mapInArrow(_answer(shared), DEALT)

    def run(batches):
        one_thread()
        value = {w: math.log10(c + 0.5) - below for w, c in often_.value.items()}
        now, parts, table_ = None, [], None
        for place, kind, _, data in _rows(batches):
            if place != now:
                now, parts, table_ = place, [], None
            if kind == 0:
                parts.append(_read(data, "<f4"))
                continue
            if table_ is None:
                table_ = _table(parts)
                parts = []
            part, texts = _unpack(data)
            size, known_, base, rest = [], [], [], []
            for t in texts:
                w = tokens(t)
                here = [value.get(x) for x in w]
                other = [x for x, v in zip(w, here) if v is None]
                size.append(len(w))
                known_.append(len(w) - len(other))
                base.append(math.fsum(v for v in here if v is not None))
                rest.append(other)
            logs = log10_texts(table_, texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(size, type=pa.int64()), pa.array(known_, type=pa.int64()), pa.array(base, type=pa.float64()), pa.array(logs, type=pa.float64()), pa.array([-x * math.log2(10) / (len(t) + 1) for x, t in zip(logs.tolist(), texts)], type=pa.float64()), pa.array(rest, type=pa.list_(pa.binary()))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "bits_per_byte", "rest"],
            )

    back = answers.union(chunks).repartition("place").sortWithinPartitions("place", "kind")
    made = back.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, bits_per_byte double, rest array<binary>")
    made = checkpoint(made.withColumn("rid", F.monotonically_increasing_id()))
    rest = made.select("rid", F.explode("rest").alias("token")).join(words, "token", "left")
    rest = rest.groupBy("rid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5)) - F.lit(below)).alias("more"), F.count("c").alias("known"))
    out = made.drop("rest").join(rest, "rid", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", "bits_per_byte")


def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole `documents`, learned from those whose crc32(doc_id) mod 5 is not 1."""
    return score(table(spark, sf_dir, "documents"), remainder("doc_id", 5) != 1, held=F.coalesce(remainder("doc_id", 5) == 1, F.lit(False)))
