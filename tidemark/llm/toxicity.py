"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart, one on windows of ordinary text, one on windows of toxic
text. A window of a text is compressed with each alone, and its distance is how many bytes the
toxic one saves. Most windows of a toxic text are as ordinary as any, so the toxic dictionary is trained
again on the windows whose distance toxic texts surpass RATIO times as often as ordinary ones. All of this
goes crosswise between two folds of the sample, so that no text is measured by what it was trained on, and
gives two pairs of dictionaries. Counts of a document's windows over each threshold, calibrated by a
logistic curve for each pair on the other fold, give two scores, whose mean in log odds is the document's.
"""

from __future__ import annotations

import random
import re

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import append, remainder, table

#: The sample learned from: whole texts of at most so many documents of label 1 and of label 0.
TOXIC, ORDINARY = 1500, 3000
#: A window: a run of at most 16 bytes without white space, and the white space after it.
WINDOW = re.compile(rb"\S{1,16}\s*|\s+")
#: What a dictionary is trained on: up to six runs of one sentence.
PASSAGE = re.compile(rb"[.!?\s]*(?:[^\s.!?]{1,16}\s*){1,6}|[.!?\s]+")
#: Behind every window, as zstandard finds no match in the last bytes of its input.
TAIL = bytes(32)
ORDINARY_BYTES, FIRST_BYTES, TOXIC_BYTES = 65536, 16384, 2048
#: Trainings of a toxic dictionary, of which that of the least loss is kept.
ROUNDS, RATIO = 8, 3
#: Bytes saved from which a window counts.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 7, 8)
#: Texts that share more than this of their passages go to one fold.
COPY = 0.2
KEPT = 200_000


def sample(docs: DataFrame, labels: DataFrame, known: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[str, int]]:
    """(text, label) of a bounded number of labelled documents, chosen by a hash of the id; known: which ids may be learned from.

    An id with several labels has the largest, one with several texts the smallest.
    """
    rows = labels.where(known & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias("y"))
    picked = None
    for y, most in ((1, TOXIC), (0, ORDINARY)):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(most)
        picked = part if picked is None else picked.union(part)
    # TOXIC + ORDINARY rows at most
    got = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("text")).dropna(subset=[id_col]).join(F.broadcast(picked), id_col)
    return sorted((r.text, int(r.y)) for r in got.groupBy(id_col).agg(F.min("text").alias("text"), F.first("y").alias("y")).collect())


def _lower(text: str | None) -> bytes:
    return (text or "").lower().encode()


def _train(passages: list[bytes], size: int) -> bytes:
    """A dictionary of distinct passages, whatever their order."""
    some = sorted(set(passages))
    random.Random(3).shuffle(some)
    try:
        return zstandard.train_dictionary(size, some, k=14, d=6).as_bytes()
    except zstandard.ZstdError:  # too few to train on: their plain text serves
        return b"".join(some)[-size:]


def _length(dictionary: bytes):
    """A function from a window to its compressed length."""
    tune = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=16, hash_log=12, chain_log=12, search_log=4, target_length=32, write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=tune).compress
    return lambda window: len(pack(window + TAIL))


def folds(passages: list[list[bytes]]) -> np.ndarray:
    """0 or 1 for each text; a text follows an earlier one with which it shares more than COPY of its distinct passages."""
    owner: dict[bytes, int] = {}
    out = np.zeros(len(passages), dtype=np.int64)
    groups = 0
    for i, p in enumerate(passages):
        own = set(p)
        shared = [owner[x] for x in own if x in owner]
        if len(shared) > COPY * len(own):
            out[i] = max(set(shared), key=lambda g: (shared.count(g), -g))
        else:
            out[i], groups = groups, groups + 1
        for x in own:
            owner.setdefault(x, int(out[i]))
    return out % 2


def _passing(toxic: np.ndarray, ordinary: np.ndarray) -> int:
    """The smallest distance that windows of toxic texts surpass RATIO times as often as those of ordinary ones."""
    return next((t for t in range(1, 16) if (toxic > t).mean() > RATIO * (ordinary > t).mean()), 4)


def _curve(x: np.ndarray, y: np.ndarray) -> dict:
    """A logistic curve over features, and its mean loss."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / sd]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, z.T @ (p - y) + 0.1 * w)
    return {"mean": mean, "sd": sd, "w": w, "loss": float(np.logaddexp(0, np.where(y == 1, -(z @ w), z @ w)).mean())}


def learn(pairs: list[tuple[str, int]]) -> list[dict]:
    """For each fold its two dictionaries and the curve that the other fold's texts give them; none if a fold lacks a label."""
    texts, y = [_lower(t) for t, _ in pairs], np.array([y for _, y in pairs])
    passages = [PASSAGE.findall(b) for b in texts]
    fold = folds(passages)
    if any(len(set(y[fold == h].tolist())) < 2 for h in (0, 1)):
        return []
    # distances are kept once a distinct window
    names: dict[bytes, int] = {}
    rows = [np.array([names.setdefault(w, len(names)) for w in WINDOW.findall(b) or [b""]]) for b in texts]
    windows = list(names)
    mine = [np.flatnonzero(fold == h).tolist() for h in (0, 1)]
    seen = [np.unique(np.concatenate([rows[i] for i in mine[h]])) for h in (0, 1)]
    plain = [_train([p for i in mine[h] if not y[i] for p in passages[i]], ORDINARY_BYTES) for h in (0, 1)]
    before = []
    for h in (0, 1):
        length, kept = _length(plain[h]), np.zeros(len(windows), dtype=np.int64)
        kept[seen[1 - h]] = [length(windows[i]) for i in seen[1 - h].tolist()]
        before.append(kept)
    picked = [p if v else [] for p, v in zip(passages, y)]
    best: list[dict] = [{"loss": np.inf}, {"loss": np.inf}]
    for turn in range(ROUNDS):
        trained = [_train([p for i in mine[h] for p in picked[i]], TOXIC_BYTES if turn else FIRST_BYTES) for h in (0, 1)]
        for h in (0, 1):
            other, length, saved = mine[1 - h], _length(trained[h]), before[h].copy()
            saved[seen[1 - h]] -= [length(windows[i]) for i in seen[1 - h].tolist()]
            distance = [saved[rows[i]] for i in other]
            curve = _curve(np.array([features(d) for d in distance]), y[other])
            if curve["loss"] < best[h]["loss"]:
                best[h] = curve | {"ordinary": plain[h], "toxic": trained[h]}
            least = _passing(np.concatenate([d for d, i in zip(distance, other) if y[i]]), np.concatenate([d for d, i in zip(distance, other) if not y[i]]))
            for d, i in zip(distance, other):
                if y[i]:
                    picked[i] = _around(texts[i], [windows[k] for k in rows[i].tolist()], d > least)
    return best


def _around(text: bytes, windows: list[bytes], hit: np.ndarray) -> list[bytes]:
    """The windows that are hit, with the 8 bytes before and after each."""
    ends = np.cumsum([len(w) for w in windows])
    return [text[max(0, e - len(windows[i]) - 8) : e + 8] for i, e in zip(np.flatnonzero(hit).tolist(), ends[hit].tolist())]


def features(saved: np.ndarray) -> np.ndarray:
    n, top = len(saved), THRESHOLDS[-1]
    over = n - np.cumsum(np.bincount(np.clip(saved, 0, top), minlength=top + 1))[np.array(THRESHOLDS) - 1]
    return np.concatenate([[saved.max(), saved.mean(), np.log(n)], np.log1p(over), np.sqrt(over / n)])


def measures(model: list[dict]):
    """A function from a text to what each of its windows saves, for each pair of dictionaries; an empty text has one empty window."""
    pairs = [(_length(side["ordinary"]), _length(side["toxic"])) for side in model]
    kept: dict[bytes, int] = {}  # both distances in one number

    def measure(b: bytes) -> list[np.ndarray]:
        windows = WINDOW.findall(b) or [b""]
        if len(kept) > KEPT:
            kept.clear()
        for w in set(windows).difference(kept):
            one, two = (ordinary(w) - toxic(w) for ordinary, toxic in pairs)
            kept[w] = (one + 2**30 << 31) + two + 2**30
        both = np.fromiter(map(kept.__getitem__, windows), dtype=np.int64, count=len(windows))
        return [(both >> 31) - 2**30, (both & 2**31 - 1) - 2**30]

    return measure


def _scorer(model: list[dict]):
    def make():
        measure = measures(model) if model else None

        def score(texts: list[str | None]) -> list[list]:
            if measure is None:
                return [[0.0] * len(texts), [0] * len(texts)]
            z = np.zeros(len(texts))
            for i, t in enumerate(texts):
                for side, saved in zip(model, measure(_lower(t))):
                    z[i] += side["w"][0] + ((features(saved) - side["mean"]) / side["sd"]) @ side["w"][1:]
            p = 1 / (1 + np.exp(-np.clip(z / 2, -30, 30)))
            return [p.tolist(), (p >= 0.5).astype(int).tolist()]

        return score

    return make


FIELDS = [T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]


def score(df: DataFrame, model: list[dict], text_col: str = "text") -> DataFrame:
    """Add score (0 to 1) and predicted (score >= 0.5) for each whole text; other columns stay.

    Null and empty texts get the score of a text of one empty window; with an empty model all get 0. Equal texts
    get equal scores, repeated rows stay; an empty table gives an empty one; own columns of these names are replaced.
    """
    return append(df, text_col, FIELDS, _scorer(model))


def fit(docs: DataFrame, labels: DataFrame) -> list[dict]:
    """A model from the labelled documents whose crc32(doc_id) mod 5 is not 0."""
    return learn(sample(docs, labels, remainder("doc_id", 5) != 0))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all whole `documents`."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return score(rows, model).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; columns stay as they are.

    Without labels of both kinds nothing goes. Null and empty texts are scored as one empty window; repeated
    rows stay or go together; an empty table gives an empty one; a null id learns nothing.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    return append(docs, "text", FIELDS, _scorer(model), keep=lambda c: [not p for p in c[1]])
