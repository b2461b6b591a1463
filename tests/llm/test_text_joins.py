"""Decontamination, substring and Jaccard operators against brute force, and their edge cases."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from harborlight.llm import decontamination, jaccard, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def corpus(seed=1, docs=60):
    """Texts with near copies, shared passages, odd spaces, Unicode, nulls, repeated rows, empty and very long ones."""
    rng = random.Random(seed)
    vocabulary = [rng.choice(["the", "of", "Straße", "día", "x1", "Foo,", "bar.", "é"]) + str(rng.randrange(60)) for _ in range(200)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [words(60) for _ in range(3)]
    out = []
    for i in range(docs):
        w = words(rng.choice([0, 1, 3, 9, 34, 35, 36, 80, 150]))
        if i % 5 == 0:
            w = w + rng.choice(passages) + words(rng.randrange(40))
        if i % 7 == 0 and out:
            w = (rng.choice(out)[1] or "").split(" ")
            if i % 14 == 0 and len(w) > 40:
                w[rng.randrange(len(w))] = "changed"
        out.append((i, rng.choice([" ", " ", "\n", "\t "]).join(w), "en", "s", 0))
    out.append((1000, " ".join(words(9000) + passages[0]), None, None, None))
    out += [(1001, None, None, None, None), (1002, "", "en", "s", 0), (1003, " \n ", "en", "s", 0), out[5], out[5], (None, out[10][1], None, None, None), (None, None, None, None, None)]
    return out


def brute_windows(items, length=10):
    found = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        for k in range(max(1, len(w) - length + 1)) if w else []:
            found[tuple(w[k : k + length])].add("" if i is None else str(i))
    return found


def brute_hits(text, found):
    w, hit, items = ALNUM.findall(lower(text)), set(), set()
    for size in {len(x) for x in found}:
        for k in range(len(w) - size + 1):
            if (x := tuple(w[k : k + size])) in found:
                items |= found[x]
                hit.update(range(k, k + size))
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def brute_longest(text, items, length=10):
    """Words of the longest verbatim match that begins with a window, and where the first of them lies."""
    w, best = ALNUM.findall(lower(text)), (0, -1)
    for _, t in items:
        v = ALNUM.findall(lower(t))
        for k in range(max(1, len(v) - length + 1)) if v else []:
            least = min(length, len(v))
            for i in range(len(w) - least + 1):
                if w[i : i + least] == v[k : k + least]:
                    n = least
                    while i + n < len(w) and k + n < len(v) and w[i + n] == v[k + n]:
                        n += 1
                    best = max(best, (n, -i if n else -1), key=lambda x: (x[0], x[1])) if best[0] else (n, -i)
    return (best[0], -best[1]) if best[0] else (0, -1)


@pytest.mark.parametrize("block_bytes", [1 << 23, 300])
def test_decontamination(spark, block_bytes, monkeypatch):
    rows = corpus()
    long = SPACE.findall(rows[50][1] or "") + SPACE.findall(rows[20][1] or "")
    items = [(1, " ".join(long[:30])), (2, "straße1 UNKNOWN"), (3, "Foo"), (4, None), (5, "!!"), (None, " ".join(long[5:20])), (10, " ".join(long[:30])), (1, " ".join(long[:30]))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_hit", F.lit("clash"))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontamination.benchmark_blocks(benchmark, block_bytes=block_bytes)
    assert (len(blocks) > 1) == (block_bytes == 300)
    monkeypatch.setattr(decontamination, "benchmark_blocks", lambda b: blocks)
    got = decontamination.find_contamination(docs, benchmark).collect()
    found = brute_windows(items)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == brute_hits(r.text, found), r.doc_id
        assert r.contaminated == (r.n_hit > 0)
    assert any(r.longest_match > 10 for r in got)
    clean = decontamination.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and {r.n_hit for r in clean.collect()} == {"clash"} and clean.count() == sum(r.n_hit == 0 for r in got)
    for r in got:
        assert (r.longest_match, r.longest_at) == brute_longest(r.text, items)


def test_decontamination_of_nothing(spark):
    docs, items = spark.createDataFrame(corpus(docs=20), SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontamination.find_contamination(docs, items).collect()} == {0}
    assert decontamination.find_contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_suffix_array_order():
    import numpy as np

    rng = np.random.default_rng(0)
    for size, depth in ((300, 10), (300, 2), (1, 10), (257, 4)):
        for words in (rng.integers(1, 4, size), np.tile(rng.integers(1, 4, 40), 8)[:size], np.ones(size, int)):
            words = words.astype(np.uint64) << np.uint64(40)
            padded = np.concatenate([words, np.zeros(depth + 2, np.uint64)])
            order = decontamination.suffix_array(padded, size, depth)
            keys = [tuple(words[i:]) for i in order]
            assert keys == sorted(keys) and sorted(order) == list(range(size))


def brute_repeats(rows, length=35):
    texts = [SPACE.findall(t or "") for _, t, *_ in rows]
    count = collections.Counter(tuple(w[k : k + length]) for w in texts for k in range(len(w) - length + 1))
    out = []
    for (i, *_), w in zip(rows, texts, strict=True):
        gone = {j for k in range(len(w) - length + 1) if count[tuple(w[k : k + length])] > 1 for j in range(k, k + length)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_substring_dedup(spark, parts):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("n_removed", F.lit("clash"))
    got = substring_dedup.remove_repeats(docs, with_text=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == brute_repeats(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got if r.n_removed)


def test_substring_dedup_within_one_text_and_nothing(spark):
    w = [f"a{i}" for i in range(40)]
    rows = [(1, " ".join(w + ["x"] + w), None, None, None), (2, " ".join(w[:34]), None, None, None)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 80, 2: 0}
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_components(rows, k, percent):
    def shingles(t):
        w = SPACE.findall(lower(t))
        return frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min([m for m in ids if m is not None], default=None) for r, ids in members.items()}
    return sorted([(rows[i][0], len(sets[i]), rows[i][0] if not sets[i] else least[root(i)]) for i in range(len(rows))], key=str)


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("k", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 50, 3)])
def test_jaccard_components(spark, k, percent, seed):
    rng = random.Random(seed)
    rows = corpus(seed, 40)
    # a group of near copies around one text, at and about the threshold, and texts that share most of it
    base = [f"b{i}" for i in range(120)]
    rows += [(2000 + i, edited(rng, base, i % 7), None, None, None) for i in range(60)]
    rows += [(3000 + i, " ".join(base[:70] + [f"u{i}_{j}" for j in range(30)]), None, None, None) for i in range(15)]
    rows += [(4000 + i, " ".join(f"c{j}" for j in range(i, i + 25)), None, None, None) for i in range(30)]
    rows += [(5000 + i, " ".join(f"s{j}" for j in range(i)), None, None, None) for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("class", F.lit("clash"))
    got = jaccard.jaccard_components(docs, shingle=k, percent=percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_components(rows, k, percent)


#: Rows whose ids and texts could be taken for one another.
CONFUSED = [(None, "5", None, None, None), (5, None, None, None, None), (None, None, None, None, None), (None, "", None, None, None), (5, "", None, None, None), (5, "5", None, None, None), (5, "6 6", None, None, None), (55, None, None, None, None), (None, "55", None, None, None)]


def test_null_ids_and_texts_are_not_confused(spark):
    docs = spark.createDataFrame(CONFUSED + CONFUSED[:1], SCHEMA)
    rows = [(i, t) for i, t, *_ in CONFUSED + CONFUSED[:1]]
    got = jaccard.jaccard_components(docs, shingle=4, percent=85).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_components(rows, 4, 85)
    got = substring_dedup.remove_repeats(docs, with_text=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == brute_repeats(rows)
    kept = sorted([(r.doc_id, r.text) for r in jaccard.keep_one(docs).collect()], key=str)
    assert kept == sorted([(5, None), (None, None), (None, ""), (5, ""), (5, "5"), (5, "6 6"), (55, None), (None, "55")], key=str)


def test_keep_one_keeps_clashing_columns(spark):
    docs = spark.createDataFrame(corpus(4, 30), SCHEMA).withColumns({c: F.lit(f"own {c}") for c in ("_KEY", "_more", "n", "class")})
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and {(r["_KEY"], r["_more"], r["n"], r["class"]) for r in kept.collect()} == {("own _KEY", "own _more", "own n", "own class")}


def test_questions_to_a_large_group_are_dealt_out(spark, monkeypatch):
    """Two large groups of near copies that link only through single members, with few questions to a salt and few sets to a part."""
    monkeypatch.setattr(jaccard, "QUESTION_ROWS", 3)
    monkeypatch.setattr(jaccard, "TOKEN_ROWS", 2)
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 4)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(f"b{j}" for j in range(i, i + 60)), None, None, None) for i in range(80)]
    rows += [(1000 + i, edited(rng, base, i % 5), None, None, None) for i in range(80)]
    for keys in (50_000, 10):
        monkeypatch.setattr(jaccard, "HOT_KEYS", keys)
        got = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA), shingle=2, percent=80).collect()
        assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_components(rows, 2, 80)


def test_combined_occurrences():
    import numpy as np

    from harborlight.llm import _occurrences as occ

    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(0, 200))
        hashes, flags = rng.integers(0, 30, n).astype(np.uint64) << np.uint64(40), rng.random(n) < 0.2
        at = np.cumsum(rng.integers(1, 400, n))
        own, marks, first, rest = occ.combine(hashes, flags, at)
        assert len(np.unique(own)) == len(own) and (np.diff(first) > 0).all()
        for h, m, p in zip(own, marks, first, strict=True):
            mine = hashes == h
            assert p == at[mine][0] and m == int(flags[mine].any()) + 2 * int(mine.sum() > 1)
        for pick in (own[::2], own[:0], own):
            hits = np.sort(first[np.isin(own, pick)])
            assert occ.expand(memoryview(rest), hits).tolist() == at[np.isin(hashes, pick)].tolist()


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], SCHEMA)
    assert sorted(tuple(r) for r in jaccard.jaccard_components(alone).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_keep_one(spark):
    base = [f"b{i}" for i in range(100)]
    rows = [(7, " ".join(base), "en", "s", 1), (3, " ".join(base[:-1] + ["z"]), "en", "s", 2), (9, "other text that stays here", "en", "s", 3), (9, "other text that stays here", "en", "s", 3), (5, None, None, None, None), (6, "", None, None, None), (None, " ".join(base), None, None, None)]
    kept = jaccard.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 9]
