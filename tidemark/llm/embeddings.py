"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a structured code: after a random rotation a vector is cut into two blocks, and
a filter is a pair of random codewords, one for each block. A vector's list of filters, all whose
direction it exceeds by more than a cap height, is decoded from its two short lists of block
scores. Vectors meet on filters and are verified by cosine in double precision; a pair counts
at the first filter that it shares. The cap height follows from the number of vectors so that a pair
at the threshold shares `shared` filters on average, and buckets hold about `bucket` vectors at any
input size. Only counts of links and a spanning forest of each cell leave a task.
"""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.buckets import by_cell, cells, matrix, roots
from tidemark.llm.common import checkpoint, components, one_thread, reach, table

THRESHOLD = 0.9
SHARED = 12.0
BUCKET = 128
CELL = 1024
#: In fewer dimensions a block has too few directions for a product code; plain random ones take its place.
FLAT = 8
NO_ID = -(2**63)


def plan(count: int, threshold: float = THRESHOLD, shared: float = SHARED, bucket: int = BUCKET) -> tuple[int, float]:
    """(codewords a block, filters hit by a vector on average) for so many vectors."""
    normal = NormalDist()
    hits = 4 * shared
    for _ in range(30):
        filters = max(256.0, count * hits / bucket)
        z = normal.inv_cdf(1 - min(0.25, hits / filters))
        # chance that the partner of a vector just above the cap is above it too
        above = z + 1 / (z + 1)
        both = 1 - normal.cdf((z - threshold * above) / math.sqrt(1 - threshold**2))
        hits = shared / both
    return max(16, math.ceil(math.sqrt(max(256.0, count * hits / bucket)))), hits


@functools.lru_cache(maxsize=8)
def code(dim: int, words: int, hits: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Two codebooks in the rotated space (dim x words each) and the cap height that `hits` filters exceed on average."""
    one_thread()
    rng = np.random.default_rng([dim, words, 5])
    turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    half = (dim + 1) // 2
    books = []
    if dim < FLAT:
        c = rng.standard_normal((dim, min(words**2, 65_536)))
        books = [c / np.linalg.norm(c, axis=0), np.zeros((dim, 1))]
    else:
        for block in (turn[:, :half], turn[:, half:]):
            c = rng.standard_normal((block.shape[1], words))
            books.append(block @ (c / np.linalg.norm(c, axis=0)) / math.sqrt(2))
    probe = rng.standard_normal((100, dim))
    probe /= np.linalg.norm(probe, axis=1)[:, None]
    a, b = probe @ books[0], np.sort(probe @ books[1], axis=1)
    # the cap by halving: scores above it are counted in the sorted second lists, so memory grows with words alone
    wanted = min(0.25, hits / (a.shape[1] * b.shape[1])) * a.shape[1] * b.shape[1] * len(probe)
    low, high = -2.0, 2.0
    for _ in range(50):
        cap = (low + high) / 2
        above = sum(b.shape[1] * a.shape[1] - int(np.searchsorted(q, cap - p, side="right").sum()) for p, q in zip(a, b))
        low, high = (cap, high) if above > wanted else (low, cap)
    return books[0], books[1], (low + high) / 2


def decode(x: np.ndarray, first: np.ndarray, second: np.ndarray, cap: float) -> list[np.ndarray]:
    """For each unit vector all filters above the cap, ascending: only pairs of codewords that can reach it are looked at."""
    words = second.shape[1]
    a, b = x @ first, x @ second
    out = []
    for p, q in zip(a, b, strict=True):
        i = np.flatnonzero(p > cap - q.max())
        j = np.flatnonzero(q > cap - p.max())
        hit_i, hit_j = np.nonzero(p[i, None] + q[None, j] > cap)
        out.append(i[hit_i] * words + j[hit_j])
    return out


def _filters(words: int, hits: float, width: pa.DataType):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                lists = part.column(1)
                rows = lists.to_pylist()
                keys: list = [None] * len(rows)
                by: dict[int, list[int]] = {}
                units = {}
                for i, v in enumerate(rows):
                    if v is None or not v or any(e is None for e in v):
                        continue
                    v = np.array(v, dtype=np.float64)
                    if np.isfinite(v).all() and np.abs(v).max() > 0:
                        units[i] = _unit(v[None, :])[0]
                        by.setdefault(len(v), []).append(i)
                for dim, members in by.items():
                    first, second, cap = code(dim, words, hits)
                    for i, k in zip(members, decode(np.array([units[i] for i in members]), first, second, cap), strict=True):
                        keys[i] = k.tolist()
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array([len(units[i]) if i in units else None for i in range(len(rows))], type=pa.int32()), pa.array(keys, type=pa.list_(width))], names=["kid", "vector", "dim", "keys"])

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _verify(threshold: float):
    def work(c: dict):
        if (c["dim"] != c["dim"][0]).any() or (c["key"] != c["key"][0]).any() or (c["lo"] != c["lo"][0]).any() or (c["hi"] != c["hi"][0]).any():
            return _apart(c, work)  # cells of one hash
        x = _unit(matrix(c["vector"], np.float64))
        node, mine, key = c["node"], c["mine"], int(c["key"][0])
        n = len(node)
        keys = c["keys"]
        ends = keys.offsets.to_numpy()
        flat = keys.values.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(n), np.diff(ends))
        flat = flat[ends[0] : ends[-1]]
        early = flat < key
        before = np.zeros((n, 0), dtype=np.float32)
        if early.any():
            names, col = np.unique(flat[early], return_inverse=True)
            before = np.zeros((n, len(names)), dtype=np.float32)
            before[row[early], col] = 1
            before = before[:, before.sum(axis=0) > 1]
        across = c["lo"][0] != c["hi"][0]
        out_a, out_b = [], []
        for s in range(0, n, 512):
            i = slice(s, s + 512)
            ok = x[i] @ x.T >= threshold
            ok &= np.arange(n)[i, None] < np.arange(n)[None, :]
            if across:
                ok &= mine[i, None] != mine[None, :]
            if before.shape[1] and ok.any():
                ok &= before[i] @ before.T < 0.5
            a, b = ok.nonzero()
            out_a.append(a + s)
            out_b.append(b)
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if not len(a):
            return None
        links = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        has = links > 0
        return node[has], links[has], node[roots(n, a, b)][has]

    return work


def _apart(c: dict, work):
    """Results of cells that have one hash, each by itself."""
    rows = list(zip(*(c[x].tolist() for x in ("dim", "key", "lo", "hi"))))
    out = []
    for cell in sorted(set(rows)):
        at = np.array([i for i, r in enumerate(rows) if r == cell])
        got = work({x: v[at] if isinstance(v, np.ndarray) else v.take(pa.array(at)) for x, v in c.items()})
        if got is not None:
            out.append(got)
    return tuple(np.concatenate(x) for x in zip(*out)) if out else None


def near(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, shared: float = SHARED, bucket: int = BUCKET) -> DataFrame:
    """One row per row of df: vec_id, n_links, component_id, kept.

    Vectors of other lengths, and null, zero or non-finite ones, link with nothing. Repeated rows (also of one id) link
    with each other; null ids count as smaller than others; equal cosines are all links; an empty table gives an
    empty one; other columns are not carried.
    """
    count = df.count()
    words, hits = plan(count, threshold, shared, bucket)
    kind = df.select(vector_col).schema[0].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # single-precision components are kept as they are
    base = reach(df).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"), F.col(vector_col).cast(kind).alias("vector"))
    key = ("int", pa.int32()) if max(words**2, 65_536) < 2**31 else ("long", pa.int64())
    vectors = base.mapInArrow(_filters(words, hits, key[1]), f"kid long, vector {kind}, dim int, keys array<{key[0]}>")
    vectors = checkpoint(vectors.withColumn("node", F.monotonically_increasing_id()))
    keyed = cells(vectors.select("node", "dim", F.explode("keys").alias("key")), ["dim", "key"], "node", CELL)
    full = keyed.join(vectors.select("node", "vector", "keys"), "node").select("cell", "dim", "key", "lo", "hi", "mine", "node", "vector", "keys")
    i64 = pa.int64()
    found = checkpoint(by_cell(full, _verify(threshold), "node long, links long, root long", ("node", "links", "root"), [i64, i64, i64]))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = parts.join(vectors.select(F.col("node").alias("id"), F.struct("kid", "node").alias("m")), "id")
    first = named.groupBy("component").agg(F.min("m").alias("top"))
    named = named.join(first, "component").select(F.col("id").alias("node"), "top")
    out = vectors.select("kid", "node").join(links, "node", "left").join(named, "node", "left")
    named_id = lambda c: F.when(c != NO_ID, c)
    return out.select(named_id(F.col("kid")).alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), named_id(F.coalesce("top.kid", "kid")).alias("component_id"), (F.coalesce("top.kid", "kid") == F.col("kid")).alias("kept"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all `embeddings`."""
    return near(table(spark, sf_dir, "embeddings"))
