"""The corpus operators against brute force, exact round trips and held-out accuracy, and on odd inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from tidemark.llm import bpe, chat, context_tree, embeddings, fingerprints, jaccard, language, licenses, packing, toxicity
from tidemark.llm.common import components

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kid string, ids int, score string"
ODD = [None, "", " ", "\n", "a", "½ ²³ 日本語 é ́x", "x <|endoftext|> y</s>[INST]", "\x1c\x1d \x85 don't we'll", "word " * 30_000, "q" * 5000, "😀🎉" * 50]


def prose(seed: int, n: int, stems: str = "the of and in to er on an re ed") -> str:
    rng = random.Random(seed)
    parts = stems.split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    out = [(i, prose(i, 40 + i), "en", "s") for i in range(40)]
    out += [(100 + i, prose(i, 60, "der die und ei ch sch ung zu"), "de", "s") for i in range(30)]
    base = prose(7, 120).split()
    for i in range(12):  # near copies, chained
        w = list(base)
        for j in range(i):
            w[3 * j] = f"new{j}"
        out.append((200 + i, " ".join(w), "en", "hot"))
    out += [(300 + i, prose(3, 43), "en", "hot") for i in range(5)]  # exact copies
    out += [(400 + i, t, None, None) for i, t in enumerate(ODD)]
    out += [(None, "a row without an id and some words", "en", None), (5, prose(5, 45), "en", "s"), (5, "another text of the same id here", "en", "s")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, s, len(t or ""), "clash", 1, "clash") for i, t, g, s in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(20)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe_equals_library(docs, rows, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = bpe.digests(docs, path).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(empty, path).count() == 0
    back = bpe.decode(bpe.encode(docs, path), path)
    assert dict(back.dtypes)["ids"] == "array<int>"
    assert all(r.decoded == (r.text or "") for r in back.collect())


def test_bpe_long_words_take_the_same_merges():
    coder = bpe.RankedBpe(public_tokenizers.path("byte_bpe_50k.json"))
    words = [prose(i, 3).replace(" ", "")[:40].encode() for i in range(50)]
    assert coder._short(words) == [coder._long(w) for w in words]


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = packing.pack(packing.pieces(docs, path)).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((i, k, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], dtype="<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b)) and sum(n for _, n in b) <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) + 1
    assert packing.pack(packing.pieces(empty, path)).count() == 0
    assert packing.stage(empty.sparkSession, empty, "").count() == 0
    assert Counter(r[:5] for r in packing.stage(docs.sparkSession, docs, "").collect()) == want


def test_packing_does_not_depend_on_the_layout(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select("doc_id", "text").union(docs.select("doc_id", "text").where("doc_id < 20"))
    ways = [rows.coalesce(1), rows.orderBy("doc_id").repartition(3), rows.repartition(7, "doc_id")]
    got = [Counter(map(tuple, packing.pack(packing.pieces(w, path), shard=30, equals=1).collect())) for w in ways]
    assert got[0] == got[1] == got[2]


def test_sum_of_squares_takes_the_smallest_sum():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 21, 300)
    got, offset = packing.sum_of_squares(lengths, 20)
    levels: dict[int, int] = {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = [b for b, v in levels.items() if v + size <= 20]
        gap = 20 - levels[got[i]] if got[i] in levels else 20
        assert offset[i] == 20 - gap

        def after(b):
            trial = levels | {b: levels[b] + size}
            return sum(c * c for g, c in Counter(20 - v for v in trial.values()).items() if g)

        assert (got[i] in levels) == bool(fits)
        if fits:
            assert after(got[i]) == min(map(after, fits))
        levels[got[i]] = levels.get(got[i], 0) + size


def test_jaccard_join(docs, rows, empty):
    def grams(t):
        w = (t or "").lower().split()
        k = min(5, len(w))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()

    sets = [grams(t) for _, t, *_ in rows]
    ids = [i if i is not None else -(2**63) for i, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    low = defaultdict(lambda: 2**63)
    for k, i in enumerate(ids):
        low[find(k)] = min(low[find(k)], i)
    want = Counter((rows[k][0], links[k], low[find(k)] if low[find(k)] != -(2**63) else None) for k in range(len(rows)))
    got = jaccard.join(docs).collect()
    assert Counter((r.doc_id, r.n_links, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == len({find(k) for k in range(len(rows))})
    assert jaccard.join(empty).count() == 0
    staged = jaccard.stage(docs.sparkSession, docs, "")
    assert staged.columns == docs.columns
    assert staged.count() == len({find(k) for k in range(len(rows))})


def test_jaccard_of_large_classes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGE", 3)
    rows = [(i, "one two three four five six" if i < 40 else None if i < 60 else "" if i < 70 else f"text {i} has words of its own here") for i in range(90)] + [(None, None)] * 5
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert all((r.n_links, r.component_id, r.kept) == ((39, 0, r.doc_id == 0) if r.doc_id is not None and r.doc_id < 40 else (0, r.doc_id, True)) for r in got)


def test_banding_meets_recall():
    for t in (0.5, 0.8, 0.9):
        b, r = jaccard.banding(t, 0.99, 300)
        assert 1 - (1 - t**r) ** b >= 0.99 and b * r <= 300


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))
    for i in range(60):  # close pairs, and a group whose members are all close
        x[100 + i] = x[i] + rng.standard_normal(16) * 0.1
    x[200:260] = x[0] + rng.standard_normal((60, 16)) * 0.05
    vectors: list = [v.tolist() for v in x] + [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in enumerate(vectors)] + [(None, vectors[0], 0, "clash")], "vec_id long, embedding array<double>, label int, node string")
    got = {r.vec_id: r for r in embeddings.near(df).collect()}
    u = np.array([*x, x[0]])
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    assert len(got) == len(vectors) + 1
    assert all(got[i].n_links <= s[i].sum() for i in range(300))
    assert sum(got[i].n_links for i in range(300)) >= 0.97 * s[:300].sum()
    component = {i: i for i in range(300)}
    for _ in range(300):
        for i, j in zip(*s[:300, :300].nonzero()):
            component[i] = component[j] = min(component[i], component[j])
    found = {i: got[i].n_links == s[i].sum() for i in range(300)}
    assert sum(found.values()) >= 295
    # the row without an id equals row 0 and is the smallest of its component
    near0 = {i for i in range(300) if component[i] == 0}
    assert all(got[i].component_id is None and not got[i].kept for i in near0)
    assert all(got[i].component_id == component[i] and got[i].kept == (component[i] == i) for i in range(300) if i not in near0)
    assert got[306].n_links == got[307].n_links == 1 and got[307].component_id == 306
    assert all(got[i].n_links == 0 and got[i].kept for i in range(300, 306))
    assert embeddings.near(df.where("false")).count() == 0


def test_embeddings_of_many_dimensions_and_hot_vectors(spark):
    rng = np.random.default_rng(6)
    vectors = [rng.standard_normal(d).tolist() for d in (8, 8, 4104, 4104, 9) for _ in range(3)] + [[1.0, 0.5] * 8] * 150
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embeddings.near(df, bucket=8).collect()}
    assert all(got[15 + i].n_links == 149 and got[15 + i].component_id == 15 for i in range(150))
    u = [np.array(v, dtype=np.float32).astype(float) for v in vectors[:15]]
    assert all(got[i].n_links == sum(len(a) == len(b) and a @ b >= 0.9 * np.linalg.norm(a) * np.linalg.norm(b) for j, b in enumerate(u) if j != i) for i, a in enumerate(u))


def test_cells_of_one_hash_are_told_apart():
    import pyarrow as pa

    x = [[1.0, 0.0], [1.0, 0.01], [1.0, 0.0, 0.0], [1.0, 0.02, 0.0]]
    c = {"dim": np.array([2, 2, 3, 3]), "key": np.zeros(4, dtype=np.int64), "lo": np.zeros(4, dtype=np.int32), "hi": np.zeros(4, dtype=np.int32), "mine": np.zeros(4, dtype=np.int32), "node": np.arange(4), "cell": np.zeros(4), "vector": pa.array(x), "keys": pa.array([[0]] * 4)}
    node, links, root = embeddings._verify(0.9)(c)
    assert node.tolist() == [0, 1, 2, 3] and links.tolist() == [1] * 4 and root.tolist() == [0, 0, 2, 2]


def test_chat(spark):
    bad = ["<|turn|>x<|says|>", "<\\|end|>", "<\\\\|turn|>\\", "[INST]<<SYS>>[\\/INST]", "", None, "a<", "|end|>", "</s>[INST] ok [/INST]", "long " * 5000]
    rows = [(c, i, ["user", "assistant", "<|says|>", None][(i + c) % 4], bad[(i * 3 + c) % 10], "clash") for c in range(12) for i in range(c % 7)] + [(None, None, None, None, "clash")]
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    by = defaultdict(list)
    for c, i, role, text, _ in rows:
        by[c].append((i, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0]))
        lost = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(lost)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()
    for r in made.collect():
        assert "<|" not in r.formatted[r.loss_start : r.loss_start + r.loss_length]
    assert chat.digests(chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_context_tree(spark, docs, rows, empty):
    known = context_tree.remainder("doc_id", 5) != 1
    got = context_tree.score(docs, known).collect()
    counts = Counter()
    for i, t, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*(t or "").encode().lower().split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, *_ in rows:
        w = [*(t or "").encode().lower().split(), b"\n"]
        want[(i, len(w), sum(counts[x] > 0 for x in w), n, round(sum(log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert np.mean([r.bits_per_byte for r in got if r.doc_id is not None and r.doc_id < 200]) < 3.5
    assert context_tree.score(empty, known).count() == 0


def test_context_tree_equals_definition():
    texts = [b"abracadabra", b"abcabcabc", b"", b"banana band"]
    codes, n = np.unique(context_tree.grams(texts)[0], return_counts=True)
    # weighted probability of the root of the first decision, by the recursive definition
    seen = defaultdict(lambda: [0, 0])
    for t in texts:
        u = b"\xff" * context_tree.DEPTH + t + b"\xff"
        for i in range(context_tree.DEPTH, len(u)):
            for d in range(context_tree.DEPTH + 1):
                for k in range(8):
                    seen[u[i - d : i], (1 << k) | (u[i] >> (8 - k))][u[i] >> (7 - k) & 1] += 1

    def kt(a, b):
        p = 1.0
        for j in range(a):
            p *= (j + 0.5) / (j + 1)
        for j in range(b):
            p *= (j + 0.5) / (a + j + 1)
        return p

    def weighted(context, prefix, depth):
        own = kt(*seen[context, prefix])
        if depth == context_tree.DEPTH:
            return own
        below = 1.0
        for c in range(256):
            if (bytes([c]) + context, prefix) in seen:
                below *= weighted(bytes([c]) + context, prefix, depth + 1)
        return 0.5 * own + 0.5 * below

    for depth, key, n0, n1, q, logs in context_tree.subtrees(codes, n):
        for i in range(0, len(key), 7):
            context = int(key[i] >> 8).to_bytes(depth, "big")
            assert [n0[i], n1[i]] == seen[context, int(key[i]) & 255]
            assert np.exp(logs[i]) == pytest.approx(weighted(context, int(key[i]) & 255, depth), rel=1e-9)


def mixture(texts: list[bytes], scored: bytes) -> float:
    """log10 probability of a text from every node of the training texts, each looked up in a plain dict."""
    codes, n = np.unique(context_tree.grams(texts)[0], return_counts=True)
    levels = context_tree.subtrees(codes, n)
    nodes = {(d, k): q for d, key, _, _, q, _ in levels for k, q in zip(key.tolist(), q.tolist())}
    _, key, n0, n1, _, below = levels[-1]
    shallow = []
    for mask in (0xFFFF, 0xFF):
        key, n0, n1, below = context_tree._sum(key & np.uint64(mask), n0, n1, below)
        both, own = context_tree._weigh(n0, n1, below)
        shallow.append(dict(zip(key.tolist(), zip(own.tolist(), context_tree._one(n0, n1).tolist()))))
        below = both
    total = 0.0
    for code in context_tree.grams([scored])[0].tolist():
        context, symbol = code >> 8, code & 255
        for k in range(8):
            prefix = (1 << k) | (symbol >> (8 - k))
            p = next((nodes[d, key] for d in range(context_tree.DEPTH, 1, -1) if (d, key := ((context & ((1 << (8 * d)) - 1)) << 8) | prefix) in nodes), None)
            for table, key in ((shallow[0], ((context & 255) << 8) | prefix), (shallow[1], prefix)):
                if key in table:
                    own, est = table[key]
                    p = est if p is None else own * est + (1 - own) * p
            p = 0.5 if p is None else p
            total += log10(p if symbol >> (7 - k) & 1 else 1 - p)
    return total


def test_context_tree_keeps_every_node(spark):
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(32, 127, 60_000)))  # over a million nodes, each seen twice at least
    df = spark.createDataFrame([(0, text, True), (1, text, True), (2, text[20_000:40_000], False)], "doc_id long, text string, known boolean")
    got = {r.doc_id: r.score for r in context_tree.score(df, df.known).collect()}
    low = [text.lower().encode()] * 2
    assert got[2] == pytest.approx(mixture(low, low[0][20_000:40_000]), rel=1e-5)


def test_context_tree_mixes_contexts_seen_once(spark):
    text = "A passage which stands only once: quick zephyrs blow, vexing daft Jim!"
    df = spark.createDataFrame([(0, text, True), (1, prose(4, 30), True), (2, text[10:60], False)], "doc_id long, text string, known boolean")
    got = {r.doc_id: r.score for r in context_tree.score(df, df.known).collect()}
    low = [text.lower().encode(), prose(4, 30).encode()]
    assert got[2] == pytest.approx(mixture(low, low[0][10:60]), rel=1e-5)


def test_fingerprints(docs, rows, empty):
    got = fingerprints.edited(docs).collect()
    assert len(got) == len(rows)
    order = sorted({(i if i is not None else -(2**63), t or "") for i, t, *_ in rows}, key=lambda x: -x[0])
    single = {k for k, c in Counter(i for i, _ in order).items() if c == 1}
    near = {r.doc_id: r for r in got}
    for k, (i, t) in enumerate(order):
        j, after = order[(k + 1) % len(order)]
        if i in single and j in single and i != -(2**63):
            q = len(t) // 3
            r = near[i]
            assert r.edited_sha256 == hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest() and r.n_chars == len(t)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert len({prints[300 + i] for i in range(5)}) == 1
    assert all(len(p) == 8 * fingerprints.BINS for p in prints.values())
    long = [r for r in got if r.n_chars > 150 and r.doc_id is not None and r.doc_id < 200]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.edited(empty).count() == 0
    assert fingerprints.edited(docs.where("doc_id = 3")).first().near_next == 1.0


def plain_fingerprint(text: str, place: int = fingerprints.PLACE) -> str:
    """By the definition, with plain loops; hashes as Spark's xxhash64 and hash give them."""
    import struct

    import xxhash

    def xx(*values):
        seed = 42
        for v in values:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i", v) if -(2**31) <= v < 2**31 and isinstance(v, np.int32) else struct.pack("<q", int(v))
            seed = xxhash.xxh64_intdigest(raw, seed=seed)
        return seed

    def murmur(values):
        rot = lambda x, r: ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF
        h = 42
        for v in values:
            for part in (v & 0xFFFFFFFF, v >> 32 & 0xFFFFFFFF):
                k = rot(part * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
                h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
            h ^= 8
            h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
            h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
            h ^= h >> 16
        return h

    white = " \t\n\x0b\f\r"
    cut, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] not in white:
            j += 1
        k = j
        while k < len(text) and text[k] in white:
            k += 1
        if j - i <= fingerprints.WORD:
            cut.append(text[i:k])
        else:
            cut += [text[x : x + fingerprints.GRAIN] if x + fingerprints.GRAIN < j else text[x:k] for x in range(i, j)]
        i = k
    step = 1 if len(cut) < 2**place else 1 + len(cut) // 2**place
    mask = (1 << 63 - place) - 1
    seen, bins = Counter(), defaultdict(list)
    order = sorted((xx(a, b) & mask, n // step) for n, (a, b) in enumerate(zip(cut, [*cut[1:], ""])))
    for h, at in order:
        seen[h] += 1
        bins[(x := xx(h, np.int32(seen[h])) & mask) >> (63 - place - fingerprints.BINS.bit_length() + 1)].append((x, at))
    out = []
    for b in range(fingerprints.BINS):
        taken = sorted(bins[b])[: fingerprints.TAKE]
        out.append("%08x" % murmur([x for x, _ in sorted(taken, key=lambda y: (y[1], y[0]))]) if taken else fingerprints.EMPTY)
    return "".join(out)


@pytest.mark.parametrize("place", [fingerprints.PLACE, 5])
def test_fingerprints_equal_the_definition(spark, place):
    rng = random.Random(9)
    texts = [prose(i, 20 + 30 * i) for i in range(8)] + ["a b " * 300, " lead", "x" * 25, "x" * 24 + "\n" + "y" * 60, "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(300)), "", "\t \n", "one"]
    df = fingerprints.fingerprint(spark.createDataFrame([(t,) for t in texts], "a string"), "a", "f", place)
    got = {r.a: r.f for r in df.collect()}
    assert [t[:20] for t in texts if got[t] != plain_fingerprint(t, place)] == []


def test_fingerprints_of_repeated_rows_and_many_ranges(spark):
    rows = [(i if i % 3 else None, f"text number {i % 50} of some") for i in range(400)] + [(7, "again and again")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.edited(df, equals=8).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert len({r for r in got if r.doc_id == 7}) == 2  # equal rows have equal results
    keys = spark.createDataFrame([(k, h) for k in (5, -3, 2**62, -(2**63)) for h in (-(2**63), -1, 0, 2**63 - 1)], "kid long, th long")
    order = sorted(((r.kid, r.th) for r in keys.collect()), key=lambda x: (-x[0], x[1]))
    for per in (1, 3, 100):
        near = {(r.kid, r.th): (r.next_kid, r.next_th) for r in fingerprints.neighbours(keys, per).collect()}
        assert near == dict(zip(order, order[1:] + order[:1]))


def test_fingerprints_follow_order(spark):
    words = prose(1, 400).split()
    half = len(words) // 2
    df = spark.createDataFrame([(" ".join(words), " ".join(words[half:] + words[:half]), " ".join(sorted(words)))], "a string, b string, c string")
    for c in "abc":
        df = fingerprints.fingerprint(df, c, f"f{c}")
    r = df.select(fingerprints.likeness("fa", "fa").alias("same"), fingerprints.likeness("fa", "fb").alias("moved"), fingerprints.likeness("fa", "fc").alias("mixed")).first()
    assert r.same == 1.0 and r.moved < 0.9 and r.mixed < r.moved


def test_fingerprints_of_unspaced_texts_outlive_an_insertion(spark):
    rng = random.Random(6)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(6000))
    df = spark.createDataFrame([(text, x) for x in ("x" + text, text[:3000] + "x" + text[3000:], text[::-1])], "a string, b string")
    for c in "ab":
        df = fingerprints.fingerprint(df, c, f"f{c}")
    start, middle, other = (r.x for r in df.select(fingerprints.likeness("fa", "fb").alias("x")).collect())
    assert start > 0.8 and middle > 0.8 and other < 0.2


def test_licenses(spark, docs, rows, empty):
    lines = ["Released under the MIT License.", "UNDER the mit\nlicense; under THE MIT License", "This work is licensed under the GNU General Public License, version 3.", "licensed under CC BY-NC 4.0", "cc, by: nc", "apache license version", prose(2, 50) + "\nApache License, Version 2.0\n" + prose(3, 40), "É" * 10]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(lines + ODD)], "doc_id long, text string, words string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    word = re.compile(licenses.WORD)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = [(label, set(word.findall(t.translate(lower)))) for label, t in licenses.TEMPLATES]
    for k, t in enumerate(lines + ODD):
        t = (t or "").translate(lower)
        w = word.findall(t)
        hits = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        base = sorted({x for _, x in hits})
        held = {label for line in t.split("\n") for label, s in sets if len(s & set(word.findall(line))) >= licenses.THRESHOLD * len(s)}
        r = got[k]
        assert (r.n_words, r.n_base, r.base_labels, r.labels) == (len(w), len(hits), ",".join(base), ",".join(sorted({*base, *held})))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
    assert licenses.scan(empty).count() == 0
    assert licenses.scan(docs).count() == len(rows)


def test_licenses_do_not_depend_on_line_breaks(spark):
    import textwrap

    texts, want = [], []
    for label, notice in licenses.TEMPLATES:
        for text in (notice, "\n".join("# " + x for x in textwrap.wrap(notice, 50, break_long_words=False)), "\n".join(notice.split()), prose(1, 3000) + " " + notice + " " + prose(2, 3000)):
            texts.append(text)
            want.append(label)
    # all words of a notice in one very long line, but nowhere together
    apart = (" " + prose(3, 60)[:-1] + " ").join(licenses.TEMPLATES[1][1].split())
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, apart])], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [(k, r.labels, r.score) for k, label in enumerate(want) if label not in (r := got[k]).labels.split(",") or r.score < 1] == []
    assert got[len(texts)].labels == "" and got[len(texts)].score == 0
    assert all(b.block >= 2900 for b in got[3].blocks) and got[3].blocks


def test_language(docs, rows, empty):
    model = language.learn(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    assert model["langs"] == ["de", "en"]
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if not r.text or not re.search(r"[^\W\d_]", r.text))
    clear = [r for r in got if r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and len(r.text) > 100]
    assert np.mean([r.lang == r.lang_pred for r in clear]) > 0.95
    assert language.identify(empty, language.learn(empty)).count() == 0
    assert language.identify(docs, language.learn(empty)).where("lang_pred <> 'und'").count() == 0
    assert language.stage(docs.sparkSession, docs, "").columns == docs.columns


def test_language_gradient():
    rng = np.random.default_rng(0)
    n = 2
    p = {"V": rng.normal(0, 0.5, (4, 2)), "b": rng.normal(0, 0.5, 2)}
    for d in "fb":
        p |= {"E" + d: rng.normal(0, 0.5, (256, 6)), "U" + d: rng.normal(0, 0.5, (2, 4)), "C" + d: rng.normal(0, 0.5, (2, 2))}
    x = rng.integers(0, 3, (language.SPAN, 3)).astype(np.uint8)
    label, mask = np.array([0, 1, 1]), (np.arange(language.SPAN)[:, None] < np.array([64, 20, 1])).astype(float)

    def loss(p):
        states = []
        for d in "fb":
            h, hs = np.zeros((3, n)), np.empty((language.SPAN, 3, n))
            for t in range(language.SPAN) if d == "f" else range(language.SPAN - 1, -1, -1):
                h = language._step(p, d, x[t], h, n)[4] * mask[t][:, None]
                hs[t] = h
            states.append(hs)
        z = np.concatenate(states, axis=2) @ p["V"] + p["b"]
        z -= np.log(np.exp(z).sum(axis=2, keepdims=True))
        return -(z[:, np.arange(3), label] * mask).sum() / mask.sum()

    grad = language._gradient(p, x, label, mask, n)
    for k, v in p.items():
        at = (1,) * v.ndim
        up, down = ({**p, k: v.copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert grad[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)


def test_toxicity(spark, docs, empty, tmp_path):
    bad = "trashy moronic pathetically worthlessly".split()
    rng = random.Random(5)
    out = []
    for i in range(240):
        w = prose(1000 + i, 80).split()
        if i % 3 == 0:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        out.append((i, " ".join(w)))
    texts = spark.createDataFrame(out, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(texts, labels)
    got = toxicity.score(texts, model).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.9
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    assert toxicity.score(empty, []).count() == 0
    assert toxicity.fit(empty, labels) == []
    assert {r.score for r in toxicity.score(docs, []).collect()} == {0.0}
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd_ids = {r.doc_id for r in got if r.predicted}
    left = toxicity.stage(spark, texts.union(texts), str(tmp_path))
    assert left.columns == texts.columns
    assert Counter(r.doc_id for r in left.collect()) == {i: 2 for i in range(240) if i not in odd_ids}
    assert toxicity.stage(spark, texts.where("false"), str(tmp_path)).count() == 0


def test_toxicity_distances_are_compressed_lengths():
    rng = random.Random(5)
    pairs = []
    for i in range(120):
        w = prose(1000 + i, 80).split()
        for _ in range(4 if i % 3 == 0 else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["trashy", "moronic", "pathetically"]))
        pairs.append((" ".join(w), int(i % 3 == 0)))
    model = toxicity.learn(pairs)
    text = toxicity._lower(pairs[0][0])
    got = toxicity.measures(model)(text)

    def plain(dictionary, window):
        import zstandard

        kind = zstandard.ZstdCompressionDict(dictionary)
        tune = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=16, hash_log=12, chain_log=12, search_log=4, target_length=32, write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        return len(zstandard.ZstdCompressor(dict_data=kind, compression_params=tune).compress(window + bytes(32)))

    windows = [w.encode() + b" " for w in text.decode().split(" ")]
    windows[-1] = windows[-1][:-1]
    assert max(map(len, windows)) <= 17
    for side, saved in zip(model, got):
        assert saved.tolist() == [plain(side["ordinary"], w) - plain(side["toxic"], w) for w in windows]
        over = [sum(x >= k for x in saved.tolist()) for k in toxicity.THRESHOLDS]
        assert toxicity.features(saved)[3 : 3 + len(over)] == pytest.approx(np.log1p(over))


def test_toxicity_folds_keep_copies_together():
    texts = [prose(i, 120).encode() for i in range(20)]
    near = [t.replace(b" ", b" x ", 2) for t in texts]
    got = toxicity.folds([toxicity.PASSAGE.findall(t) for t in texts + near])
    assert (got[:20] == got[20:]).all() and set(got.tolist()) == {0, 1}


def _pipeline_tables(spark, path, rows, labels):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    """Stage by stage against plain code: learned stages by their models applied text by text, others by brute force."""
    import corpus_pipeline

    rng = random.Random(5)
    rows = [(i, prose(i, 60), "en") for i in range(60)] + [(100 + i, prose(i, 60, "der die und ei ch sch ung zu"), "de") for i in range(30)]
    for i in range(60):  # toxic ones
        w = prose(2000 + i, 60).split()
        for _ in range(5):
            w.insert(rng.randrange(len(w)), rng.choice(["trashy", "moronic", "pathetically"]))
        rows.append((200 + i, " ".join(w), "en"))
    labels = [(i, 1, 0) for i in range(60)] + [(200 + i, 0, 1) for i in range(60)]
    rows += [(300, prose(0, 60), "en"), (301, prose(0, 60) + " x", "en"), (302, None, "en"), (303, "123", "en"), (304, "", None), (None, prose(77, 50), "en"), (5, prose(5, 60), "en")]
    _pipeline_tables(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard", "packing"]

    def check(name, got, want, key=lambda r: (r.doc_id, r.text)):
        assert Counter(map(key, got.collect())) == Counter(want), name

    model = language.learn(docs)
    score = language._scorer(model)()
    kept = [(i, t) for (i, t, _), lang, p in zip(rows, *score([t for _, t, _ in rows])) if lang != "und" and p > language.LEAST]
    assert not {302, 303, 304} & {i for i, _ in kept}
    docs = language.stage(spark, docs, str(tmp_path))
    check("language", docs, kept)
    bad = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = [(i, t) for (i, t), p in zip(kept, toxicity._scorer(bad)()([t for _, t in kept])[1]) if not p]
    assert sum(200 <= (i or 0) < 300 for i, _ in kept) < 12 and len(kept) > 70
    docs = toxicity.stage(spark, docs, str(tmp_path))
    check("toxicity", docs, kept)
    grams = lambda t: {tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    order = sorted(set(kept), key=lambda x: (x[0] is not None, x[0] or 0))
    group = {x: x for x in order}
    for a, b in itertools.combinations(order, 2):
        if len(grams(a[1]) & grams(b[1])) >= 0.8 * len(grams(a[1]) | grams(b[1])):
            low, high = sorted((group[a], group[b]), key=order.index)
            group = {x: low if g == high else g for x, g in group.items()}
    kept = [x for x in order if group[x] == x]
    assert not {300, 301} & {i for i, _ in kept}
    docs = jaccard.stage(spark, docs, str(tmp_path))
    check("jaccard", docs, kept)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [(i, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in kept]
    got = corpus_pipeline.run(spark, str(tmp_path))
    check("packing", got, want, key=lambda r: (r.doc_id, r.length))
    assert [f.name for f in got.schema][:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    _pipeline_tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
