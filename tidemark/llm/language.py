"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on windows of a bounded sample of
labelled documents. It labels every byte of a text, read in windows that cover it whole; a document's
probabilities are the means over its bytes.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import append, one_thread, remainder, table

HIDDEN = 12
SPAN = 64
#: The sample that the network is trained on: at most so many documents a language, so many windows of each.
DOCUMENTS, WINDOWS = 400, 6
STEPS, BATCH, RATE = 320, 256, 0.02
#: Bytes of the texts that are read at once (or one text).
GROUP = 1 << 20
#: A document whose best language has no more than this probability is rejected by the pipeline.
LEAST = 0.3
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def sample(docs: DataFrame, known: Column, text_col: str, lang_col: str, documents: int = DOCUMENTS, windows: int = WINDOWS) -> list[tuple[str, bytes]]:
    """(language, window of at most SPAN bytes) pairs: at most documents * windows a language, spread over whole texts. Equal texts count once."""
    rows = docs.where(known & F.col(lang_col).isNotNull() & (F.char_length(text_col) > 0)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    # a share of each language's texts, some times what is wanted, so that no task ranks all of one
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.05).alias("n"))  # as many rows as languages
    rows = rows.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("h"), F.lit(1 << 40)) < F.lit(1 << 40) * 8.0 * documents / F.col("n"))
    place = lambda j: F.pmod(F.xxhash64("text", F.lit(j)), F.greatest(F.lit(1), F.char_length("text") - SPAN + 1)).cast("int") + 1
    rows = rows.groupBy("lang", "h").agg(F.first(F.array(*[F.substring("text", place(j), F.lit(SPAN)) for j in range(windows)])).alias("cuts"))
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= documents)
    return [(r.lang, c.encode()[:SPAN]) for r in sorted(rows.collect(), key=lambda r: (r.lang, r.r)) for c in r.cuts]


def _step(p: dict, d: str, x: np.ndarray, h: np.ndarray, n: int):
    a = p["E" + d].take(x, axis=0)
    gate = a[:, : 2 * n] + h @ p["U" + d]
    np.tanh(gate, out=gate)
    gate *= 0.5
    gate += 0.5
    z, r = gate[:, :n], gate[:, n:]
    rh = r * h
    c = a[:, 2 * n :] + rh @ p["C" + d]
    np.tanh(c, out=c)
    return z, r, rh, c, h + z * (c - h)


def train(pairs: list[tuple[str, bytes]], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 1) -> dict:
    """Parameters and languages; without pairs there are no languages."""
    one_thread()
    langs = sorted({k for k, _ in pairs})
    n, k = hidden, max(1, len(langs))
    rng = np.random.default_rng(seed)
    p = {"V": rng.normal(0, 0.3, (2 * n, k)), "b": np.zeros(k)}
    for d in "fb":
        p |= {"E" + d: rng.normal(0, 0.3, (256, 3 * n)), "U" + d: rng.normal(0, 0.3, (n, 2 * n)), "C" + d: rng.normal(0, 0.3, (n, n))}
    p = {x: v.astype(np.float32) for x, v in p.items()}
    if len(langs) > 1:
        size = np.array([len(c) for _, c in pairs])
        data = np.zeros((len(pairs), SPAN), dtype=np.uint8)
        for i, (_, c) in enumerate(pairs):
            data[i, : len(c)] = np.frombuffer(c, dtype=np.uint8)
        label = np.array([langs.index(x) for x, _ in pairs])
        even = 1.0 / np.bincount(label)[label]
        even /= even.sum()
        m1 = {x: np.zeros_like(v) for x, v in p.items()}
        m2 = {x: np.zeros_like(v) for x, v in p.items()}
        for t in range(1, steps + 1):
            pick = rng.choice(len(pairs), BATCH, p=even)
            grad = _gradient(p, data[pick].T.copy(), label[pick], (np.arange(SPAN)[:, None] < size[pick]).astype(np.float32), n)
            norm = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
            rate = RATE * min(1, 4 * (steps - t + 1) / steps) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
            for x, g in grad.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m1[x] += 0.1 * (g - m1[x])
                m2[x] += 0.01 * (g * g - m2[x])
                p[x] -= (rate * m1[x] / (np.sqrt(m2[x]) + 1e-6)).astype(np.float32)
    return {"p": p, "langs": langs, "n": n}


def _gradient(p: dict, x: np.ndarray, label: np.ndarray, mask: np.ndarray, n: int) -> dict:
    """Of the mean cross-entropy over positions, by backpropagation through time in both directions."""
    span, batch = x.shape
    kept, states = {}, {}
    for d in "fb":
        h, steps, hs = np.zeros((batch, n), dtype=np.float32), [], np.empty((span, batch, n), dtype=np.float32)
        for t in range(span) if d == "f" else range(span - 1, -1, -1):
            z, r, rh, c, new = _step(p, d, x[t], h, n)
            steps.append((t, h, z, r, rh, c))
            h = new * mask[t][:, None]
            hs[t] = h
        kept[d], states[d] = steps, hs
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logits = both @ p["V"] + p["b"]
    logits -= logits.max(axis=2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=2, keepdims=True)
    prob[:, np.arange(batch), label] -= 1
    prob *= mask[:, :, None] / mask.sum()
    grad = {"V": np.einsum("tbi,tbk->ik", both, prob, optimize=True), "b": prob.sum(axis=(0, 1))}
    back = prob @ p["V"].T
    for k, d in enumerate("fb"):
        u, c_ = p["U" + d], p["C" + d]
        gu, gc, ga = np.zeros_like(u), np.zeros_like(c_), np.empty((span, batch, 3 * n), dtype=np.float32)
        carry = np.zeros((batch, n), dtype=np.float32)
        for t, h, z, r, rh, c in reversed(kept[d]):
            g = (carry + back[t, :, k * n : (k + 1) * n]) * mask[t][:, None]
            ac = g * z * (1 - c * c)
            az = g * (c - h) * 2 * z * (1 - z)  # z = (1 + tanh a) / 2
            grh = ac @ c_.T
            ar = grh * h * 2 * r * (1 - r)
            gates = np.concatenate([az, ar], axis=1)
            carry = g * (1 - z) + grh * r + gates @ u.T
            gu += h.T @ gates
            gc += rh.T @ ac
            ga[t] = np.concatenate([gates, ac], axis=1)
        flat = x.reshape(-1)
        ge = np.stack([np.bincount(flat, weights=col, minlength=256) for col in ga.reshape(-1, 3 * n).T], axis=1)
        grad |= {"U" + d: gu, "C" + d: gc, "E" + d: ge.astype(np.float32)}
    return grad


def probabilities(model: dict, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each non-empty text over all its bytes."""
    p, n, k = model["p"], model["n"], len(model["langs"])
    size = np.array([len(t) for t in texts])
    windows = -(-size // SPAN)
    data = np.frombuffer(b"".join(t.ljust(w * SPAN, b"\0") for t, w in zip(texts, windows.tolist(), strict=True)), dtype=np.uint8).reshape(-1, SPAN)
    left = np.full(len(data), SPAN)
    left[np.cumsum(windows) - 1] = size - (windows - 1) * SPAN
    sums = np.empty((len(data), k))
    for s in range(0, len(data), 4096):
        x, m = data[s : s + 4096].T.copy(), left[s : s + 4096]
        h = np.zeros((x.shape[1], n), dtype=np.float32)
        ahead = np.empty((SPAN, x.shape[1], k), dtype=np.float32)
        for t in range(SPAN):
            h = _step(p, "f", x[t], h, n)[4]
            np.matmul(h, p["V"][:n], out=ahead[t])
        ahead += p["b"]
        h = np.zeros_like(h)
        total = np.zeros((x.shape[1], k), dtype=np.float32)
        for t in range(SPAN - 1, -1, -1):
            there = (m > t).astype(np.float32)[:, None]
            h = _step(p, "b", x[t], h, n)[4]
            h *= there
            logits = ahead[t] + h @ p["V"][n:]
            logits -= logits.max(axis=1, keepdims=True)
            np.exp(logits, out=logits)
            logits *= there / logits.sum(axis=1, keepdims=True)
            total += logits
        sums[s : s + 4096] = total
    return np.add.reduceat(sums, np.cumsum(windows) - windows, axis=0) / size[:, None]


def _scorer(model: dict):
    def make():
        one_thread()

        def score(texts: list[str | None]) -> list[list]:
            lang, best = [UNKNOWN] * len(texts), [0.0] * len(texts)
            group: list[tuple[int, bytes]] = []
            held = 0
            for i, t in enumerate([*texts, None]):
                if t and model["langs"] and LETTER.search(t):
                    group.append((i, t.encode()))
                    held += len(group[-1][1])
                if group and (i == len(texts) or held > GROUP):
                    for (j, _), q in zip(group, probabilities(model, [b for _, b in group]), strict=True):
                        lang[j], best[j] = model["langs"][int(q.argmax())], float(min(1.0, q.max()))
                    group, held = [], 0
            return [lang, best]

        return score

    return make


FIELDS = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]


def identify(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Add lang_pred and score (the pooled probability) for each whole text; other columns stay.

    A text that is null, empty or without a letter is `und` with score 0; so is every text under a model without
    languages. Equal texts get equal results, ties the first language by name, repeated rows stay; own columns of
    these names are replaced.
    """
    return append(df, text_col, FIELDS, _scorer(model))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """A model from the documents whose crc32(id) mod 3 is not 1."""
    return train(sample(docs, remainder(id_col, 3) != 1, text_col, lang_col))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages of all whole `documents`."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs)
    rows = docs.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language stay; `und` ones (null, empty, without a letter) and those of no clear language go.

    Columns stay as they are; equal texts, repeated rows too, stay or go together; an empty table gives an empty one;
    rows of a null id or language teach nothing and are judged like others.
    """
    model = learn(docs)
    return append(docs, "text", FIELDS, _scorer(model), keep=lambda c: [lang != UNKNOWN and p > LEAST for lang, p in zip(*c, strict=True)])
