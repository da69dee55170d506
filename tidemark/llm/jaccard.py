"""N-gram Jaccard join by MinHash banding.

Texts become sets of hashed word 5-grams. Equal sets are one class. Rows and bands of the MinHash
signature are chosen for a target recall at the threshold; classes meet on band hashes, hot
buckets in cells of bounded size, and a pair is verified on its full n-gram sets in the first band
that it shares. Only counts of links and a spanning forest of each cell leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.buckets import by_cell, cells, matrix, roots
from tidemark.llm.common import checkpoint, components, one_thread, reach, table

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
HASHES = 100
CELL = 256
#: Rows from which a class of equal sets may be a large one.
LARGE = 1000
CACHE = 400_000
NO_ID = -(2**63)


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows as `hashes` allows if pairs at the threshold are to meet with probability `recall`."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1) if threshold < 1 else (1, 1)
    for r in range(1, 33):
        p = threshold**r
        b = 1 if p == 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if b * r <= hashes:
            best = (b, r)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Distinct hashed word n-grams of texts; the hash of each word is kept."""

    def __init__(self, n: int = NGRAM):
        one_thread()
        self.n = n
        self.factors = _mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        self.cache: dict[str, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted; a text of fewer than n words has one n-gram of them all, one without words has none."""
        split = [(t or "").lower().split() for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        for w in set().union(*split).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        out = []
        for words in split:
            if not words:
                out.append(np.empty(0, dtype=np.uint64))
                continue
            h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
            k = min(self.n, len(h))
            m = len(h) - k + 1
            s = h[:m] * self.factors[0]
            for j in range(1, k):
                s += _mix(h[j : j + m]) * self.factors[j]
            out.append(np.unique(_mix(s)))
        return out


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A hash for each band of each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    rng = np.random.default_rng(20_011)
    a = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**64, bands * rows, dtype=np.uint64)
    out = np.empty((len(sets), bands), dtype=np.uint64)
    work = np.empty_like(flat)
    for k in range(bands):
        h = np.full(len(sets), k + 1, dtype=np.uint64)
        for r in range(k * rows, (k + 1) * rows):
            np.multiply(flat, a[r], out=work)
            np.add(work, b[r], out=work)
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(work, starts))
        out[:, k] = h
    return out


def _read(n: int, bands: int, rows: int):
    def run(batches):
        make = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = make.sets(part.column(2).to_pylist())
                full = [s for s in sets if len(s)]
                made = iter(signatures(full, bands, rows).view(np.int64).tolist()) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], type=pa.binary()), pa.array([next(made) if len(s) else None for s in sets], type=pa.list_(pa.int64()))],
                    names=["kid", "th", "klass", "bands"],
                )

    return run


def _first(bands: np.ndarray, at: int, i: slice, j: slice) -> np.ndarray:
    """Pairs of rows that share band `at` and none before it."""
    return ~(bands[i, None, :at] == bands[None, j, :at]).any(axis=2)


def _pairs(c: dict) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of a cell (of distinct nodes) whose first shared band is the cell's."""
    order = np.argsort(c["node"], kind="stable")
    keep = order[np.r_[True, np.diff(c["node"][order]) != 0]]
    c["keep"] = keep
    mine, node = c["mine"][keep], c["node"][keep]
    bands = matrix(c["bands"].take(pa.array(keep)), np.int64)
    at = int(c["band"][0])
    across = c["lo"][0] != c["hi"][0]
    out_a, out_b = [], []
    for s in range(0, len(node), 256):
        i = slice(s, s + 256)
        j = slice(0, len(node))
        ok = _first(bands, at, i, j)
        ok &= bands[i, None, at] == bands[None, j, at]  # cells of one hash may meet
        ok &= np.arange(len(node))[i, None] < np.arange(len(node))[None, j]
        if across:
            ok &= mine[i, None] != mine[None, j]
        a, b = ok.nonzero()
        out_a.append(a + s)
        out_b.append(b)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return (a, b) if len(a) else None


def _wanted(c: dict):
    """Nodes with a pair to verify in this cell."""
    if (pairs := _pairs(c)) is None:
        return None
    keep = c["keep"][np.unique(np.concatenate(pairs))]
    return tuple(c[x][keep] for x in ("cell", "band", "lo", "hi", "mine", "node"))


def _verify(threshold: float):
    def work(c: dict):
        if (pairs := _pairs(c)) is None:
            return None
        keep = c["keep"]
        sets = c["grams"].take(pa.array(keep))
        ends = sets.offsets.to_numpy()
        flat = sets.values.to_numpy(zero_copy_only=False)
        size = np.diff(ends)
        a, b = pairs
        near = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b])
        a, b = a[near], b[near]
        if not len(a):
            return None
        n = len(keep)
        if len(a) > 4 * n:  # many pairs: shared n-grams of a block of rows with all, by counting matrices
            _, col = np.unique(flat[ends[0] : ends[-1]], return_inverse=True)
            width = int(col.max()) + 1
            row = np.repeat(np.arange(n), size)
            both = np.zeros((n, n), dtype=np.float32)
            for s in range(0, width, 4096):
                inside = (col >= s) & (col < s + 4096)
                m = np.zeros((n, min(4096, width - s)), dtype=np.float32)
                m[row[inside], col[inside] - s] = 1
                both += m @ m.T
            shared = both[a, b].astype(np.int64)
        else:
            part = [flat[ends[i] : ends[i + 1]] for i in range(n)]
            shared = np.array([len(np.intersect1d(part[i], part[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist(), strict=True)])
        ok = shared >= threshold * (size[a] + size[b] - shared) - 1e-9
        a, b = a[ok], b[ok]
        if not len(a):
            return None
        copies, node = c["copies"][keep], c["node"][keep]
        links = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
        has = links > 0
        return node[has], links[has].astype(np.int64), node[roots(n, a, b)][has]

    return work


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of df: doc_id, class_id, n_links, component_id, kept.

    class_id: smallest id with an equal n-gram set; n_links: other rows with a Jaccard similarity of at least
    `threshold`; component_id: smallest id reachable by links; kept: this row stands for its component (the first of
    its smallest id). Words are lower-cased and white-space delimited. A text without words (null, empty) links with
    nothing and stands for itself. Null ids count as smaller than others; repeated rows link with each other; an empty
    table gives an empty one; other columns are not carried.
    """
    bands, rows = banding(threshold, recall)
    base = reach(df).select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"), F.col(text_col).alias("text"))
    base = base.select("kid", F.xxhash64("text").alias("th"), "text")
    read = base.mapInArrow(_read(n, bands, rows), "kid long, th long, klass binary, bands array<long>")
    docs = checkpoint(read.withColumn("rid", F.monotonically_increasing_id()))
    groups = docs.where("klass IS NOT NULL").groupBy("klass").agg(F.min(F.struct("kid", "rid", "th")).alias("m"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    groups = checkpoint(groups.select("klass", F.col("m.rid").alias("node"), F.col("m.kid").alias("kid"), F.col("m.th").alias("th"), "copies", "bands"))

    keyed = groups.select("node", F.posexplode("bands").alias("band", "key"))
    keyed = cells(keyed, ["key"], "node", CELL).select("cell", "band", "lo", "hi", "mine", "node")
    narrow = keyed.join(groups.select("node", "bands"), "node").select("cell", "band", "lo", "hi", "mine", "node", "bands")
    i32, i64 = pa.int32(), pa.int64()
    wanted = by_cell(narrow, _wanted, "cell long, band int, lo int, hi int, mine int, node long", ("cell", "band", "lo", "hi", "mine", "node"), [i64, i32, i32, i32, i32, i64])
    wanted = checkpoint(wanted)

    def grams(batches):
        make = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = make.sets(part.column(1).to_pylist())
                offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))], names=["node", "grams"])

    used = wanted.select("node").distinct().join(groups, "node").select("node", "kid", "th")
    texts = base.join(used, ["kid", "th"]).select("node", "text").dropDuplicates(["node"])
    full = texts.mapInArrow(grams, "node long, grams array<long>").join(groups.select("node", "bands", "copies"), "node")
    full = wanted.join(full, "node").select("cell", "band", "lo", "hi", "mine", "node", "copies", "bands", "grams")
    found = checkpoint(by_cell(full, _verify(threshold), "node long, links long, root long", ("node", "links", "root"), [i64, i64, i64]))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = parts.join(groups.select(F.col("node").alias("id"), F.struct("kid", "node").alias("m")), "id")
    first = named.groupBy("component").agg(F.min("m").alias("m"))
    named = named.join(first.select("component", F.col("m").alias("top")), "component").select(F.col("id").alias("node"), "top")
    groups = groups.select("klass", "node", "kid", "copies").join(links, "node", "left").join(named, "node", "left")
    groups = groups.select("klass", "copies", F.col("kid").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("top", F.struct("kid", "node")).alias("top"))
    # large classes are sent to the rows, the others' rows to them; rows without words meet nothing
    large = F.col("copies") > max(LARGE, docs.count() // 1000)
    heavy = F.broadcast(groups.where(large))  # 1,000 classes at most, as each has over a thousandth of all rows
    rows = docs.select("klass", "kid", "rid", "th")
    some = rows.where("klass IS NOT NULL")
    light = some.join(F.broadcast(groups.where(large).select("klass")), "klass", "left_anti")
    out = light.join(groups.where(~large), "klass").unionByName(some.join(heavy, "klass")).unionByName(rows.where("klass IS NULL"), allowMissingColumns=True)
    named_id = lambda c: F.when(c != NO_ID, c)
    return out.select(
        named_id(F.col("kid")).alias("doc_id"),
        named_id(F.coalesce("class_id", "kid")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        named_id(F.coalesce("top.kid", "kid")).alias("component_id"),
        F.coalesce(F.col("rid") == F.col("top.node"), F.lit(True)).alias("kept"),
        F.col("th").alias("text_hash"),
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, classes and components of all whole `documents`."""
    return join(table(spark, sf_dir, "documents")).drop("text_hash")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; rows of equal id and text count as one. Columns stay as they are."""
    kid, th = (next(n for n in (base, *(f"{base}_{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns) for base in ("__kid", "__th"))
    kept = join(docs).where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(kid), F.col("text_hash").alias(th)).distinct()
    rows = docs.withColumn(kid, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(th, F.xxhash64("text"))
    return rows.join(kept, [kid, th], "left_semi").dropDuplicates([kid, th]).select(*docs.columns)
