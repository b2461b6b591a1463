"""Byte-level BPE, fill-in-middle and centroid clustering against plain versions."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.llm import bpe, centroids, queries
from harborlight.llm import fill_in_middle as fim

FOLDER = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def plain_encoding(vocabulary):
    return tiktoken.Encoding("plain", pat_str=tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def slow_merges(word, ranks):
    """The lowest rank first, leftmost first, one pair at a time."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def odd_texts(seed=5):
    rng = random.Random(seed)
    texts = ["", " ", "  ", "\n\n  \n", " a", "a ", "a  b   c", "a \n b", "don't I've it's", "aaa aaaa " * 40, "a" * 3001, " " * 999, "é" * 500, "\U0001f600" * 99, "<|endoftext|>", "0" * 301, "\x00\x1c ​ x"]
    texts += ["".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(400)) for _ in range(20)]
    return texts + ["".join(rng.choice("abcdeet  \n'1.é") for _ in range(rng.randrange(200))) for _ in range(400)]


@pytest.mark.parametrize("cut", [False, True])
def test_encoder_equals_tiktoken(vocabulary, plain_encoding, cut, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 2000)
    monkeypatch.setattr(bpe, "WORDS", 300)  # words are forgotten in between
    texts = odd_texts()
    flat, sizes = bpe.Encoder(vocabulary, tokenizers.PATTERN, cut).encode(texts)
    ends = np.cumsum(sizes)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [plain_encoding.encode_ordinary(t) for t in texts]


def test_replay_equals_single_merges():
    """On small random vocabularies, whose tokens come from merges of earlier ones."""
    rng = random.Random(3)
    for _ in range(40):
        ranks = {bytes([b]): b for b in range(256)}
        known = [b"a", b"b", b"c"]
        while len(ranks) < 256 + 25:
            new = rng.choice(known) + rng.choice(known)
            if new not in ranks and slow_merges(new, ranks) and len(slow_merges(new, ranks)) == 2:
                ranks[new] = len(ranks)
                known.append(new)
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 60))) for _ in range(50)] + [b"a" * 100]
        ids, counts = bpe.replay(words, bpe.Vocabulary.of(ranks))
        ends = np.cumsum(counts)
        by_token = {i: t for t, i in ranks.items()}
        for w, e, n in zip(words, ends, counts, strict=True):
            own = ids[e - n : e].tolist()
            assert b"".join(by_token[i] for i in own) == w
            if w not in ranks:
                assert own == slow_merges(w, ranks)


def test_vocabulary_without_all_bytes():
    with pytest.raises(ValueError, match="lacks 255 single bytes"):
        bpe.Vocabulary.of({b"a": 0})


def test_encode_and_decode_edge_rows(spark, vocabulary, plain_encoding):
    rows = [(1, None, "x"), (2, "", "y"), (3, "two words", None), (3, "two words", None), (None, "no id  here\n", "z"), (5, "long " * 30000 + "end", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Decoded string").withColumn("IDS", F.lit(7))
    out = bpe.decode(bpe.encode(docs, vocabulary, tokenizers.PATTERN, cut_at_spaces=True), vocabulary)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "text"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == plain_encoding.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    assert bpe.decode(bpe.encode(docs.limit(0), vocabulary, tokenizers.PATTERN), vocabulary).count() == 0


def test_decode_of_unknown_ids(spark, vocabulary):
    rows = spark.createDataFrame([(1, [1, None]), (2, [-1]), (3, [50256]), (4, None), (5, []), (6, [72, 105])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(rows, vocabulary).collect()}
    assert [got[k] for k in (1, 2, 3, 4)] == [None] * 4 and bytes(got[5]) == b"" and bytes(got[6]) == vocabulary_bytes(vocabulary, [72, 105])


def vocabulary_bytes(vocabulary, ids):
    spelled = {i: t for t, i in vocabulary.ranks.items()}
    return b"".join(spelled[i] for i in ids)


def test_bpe_query(spark, plain_encoding):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.queries()["op11_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = plain_encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 1000, 5000])
def test_skip_list_ranks(size):
    rng = random.Random(size)
    points = np.array([rng.randrange(1, 6) for _ in range(size)])
    units, before = fim.SkipList(points, fim.Towers()), np.concatenate(([0], np.cumsum(points)))
    for rank in {0, 1, size, *[rng.randrange(size + 1) for _ in range(200)]} & set(range(size + 1)):
        assert units.points_before(rank) == before[rank]
    if size >= 1000:
        assert len(units.lanes) >= 2 and all(step.sum() == size and width.sum() == before[-1] for step, width, _ in units.lanes)


def test_skip_list_beyond_kept_towers(monkeypatch):
    monkeypatch.setattr(fim.Towers, "KEPT", 1024)
    towers = fim.Towers()
    units = fim.SkipList(np.full(9000, 2), towers)
    assert towers.length == 0 and units.points_before(8999) == 17998


FIM_ROWS = [(i, t) for i, t in enumerate(["plain words here", "", None, "holds <S> itself", "ünïcode \U0001f600 text", "x", "<P", "a>b<", "line\nbreak " * 2000])] + [(None, "no id"), (3, "holds <S> itself")]


def expected(doc_id, text, seed="1"):
    text = text or ""
    h = [int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    p, m, s = text[:a], text[a:b], text[b:]
    return (len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_edge_rows(spark):
    rows = FIM_ROWS + [(100 + i, f"text number {i} with < and > and <M") for i in range(200)]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, Form string")
    out = fim.fill_in_middle(docs)
    assert sorted(out.columns) == sorted(["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"])
    got = out.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_by_words(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (i + 1) + "ende") for i in range(50)], "doc_id long, text string")
    got = fim.fill_in_middle(docs, unit=r"\S+\s*", plain=100).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    for r in got:
        assert r.n == r.doc_id + 2 and r.back == r.text and r.form != "plain"
        for cut in (r.prefix_chars, r.prefix_chars + r.middle_chars):
            assert cut in (0, len(r.text)) or r.text[cut - 1] == " "


def plain_clusters(rows, clusters, rounds, size, seed="3"):
    """Rows (id, vector) that take part, clustered with Python integers."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [q for _, q in named[:clusters]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, q in kept:
            members.setdefault(near(q)[1], []).append(q)
        centres = [[sum(x) // len(members[i]) for x in zip(*members[i], strict=True)] if i in members else c for i, c in enumerate(centres)]
    return sorted([(str(i), near(q)[1], near(q)[0]) for i, q in kept]), centres


@pytest.mark.parametrize(("rows", "block"), [(300, 16_384), (300, 37), (5, 16_384)])
def test_clusters_equal_plain_ones(spark, monkeypatch, rows, block):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", block)
    rng = random.Random(rows)
    vectors = [(i, [rng.gauss(i % 3, 0.4) for _ in range(4)]) for i in range(rows)]
    vectors += [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan")] * 4), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1.0] * 5), (906, [-0.0] * 4), (0, vectors[0][1]), (None, [0.5] * 4), (907, [2.0**20, -1.0, 0.0, 3.0])]
    table = spark.createDataFrame([(*v, 1, 2) for v in vectors], "vec_id long, embedding array<double>, Cluster int, q int").repartition(3)
    assigned, centres = centroids.cluster(table, clusters=6, rounds=4, size=4)
    want, final = plain_clusters([v for v in vectors if v[0] != 907], 6, 4, 4)  # 907 is beyond LARGEST
    assert sorted([(str(r.vec_id), r.cluster, r.distance) for r in assigned.collect()]) == want
    got = {r.cluster: r for r in centres.collect()}
    assert [got[i].centroid for i in range(6)] == final and {r.inertia for r in got.values()} == {sum(w[2] for w in want)}
    assert {i: r.cluster_inertia for i, r in got.items() if r.cluster_inertia is not None} == {i: sum(w[2] for w in want if w[1] == i) for i in {w[1] for w in want}}


def test_fewer_vectors_than_clusters(spark):
    assigned, centres = centroids.cluster(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [9.0, 1.0])], "vec_id int, embedding array<float>"), clusters=8, size=2)
    got = {r.vec_id: (r.cluster, r.distance) for r in assigned.collect()}
    assert centres.count() == 3 and got[1] == got[2] and all(d == 0 for _, d in got.values())


def test_largest_components_and_no_vectors(spark):
    big = float(centroids.LARGEST >> 10)
    rows = [(1, [big] * 64), (2, [-big] * 64), (3, [2 * big] * 64), (4, [-big] * 64)]
    assigned, centres = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), clusters=1, rounds=0)
    got = {r.vec_id: r.distance for r in assigned.collect()}
    assert set(got) == {1, 2, 4} and max(got.values()) == 64 * (2 * centroids.LARGEST) ** 2 and min(got.values()) == 0
    empty = spark.createDataFrame([], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]))
    assigned, centres = centroids.cluster(empty)
    assert assigned.count() == 0 and centres.count() == 0
    assert assigned.join(centres, "cluster").count() == 0
