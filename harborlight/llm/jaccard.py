"""Similarity join of word-shingle sets by Jaccard, with a token-group matrix.

Texts become sets of shingle hashes; equal sets are one class. Then
1. Sieve. In hash order, two sets that link share many of their first tokens; how many is known from their sizes. A text
   that does not share as many of its first tokens with all other texts together (the matrix with one group per bucket)
   links with nothing and leaves. Only 4-byte hashes move. For the sets that stay, tokens are counted, and their prefixes
   hold the rarest tokens.
2. Groups. Each prefix token has a few leaders: of the sets that hold it the one with the fewest tokens of its own, and the
   least ones in random orders; every other holder is compared with them. Linked sets form groups of similar documents.
3. Token-group matrix. Each group's tokens are its union. Where a prefix token occurs in two groups, the members of the
   smaller group that hold it are its queries to the other; the number of query tokens in the other's union bounds the
   overlap with every member. Only groups that reach the bound are opened.
4. Opened groups: the query is compared exactly with the members that fit in size. Links merge groups.
The result has the connected components of all links, without pairs inside a group that is already connected.

Defined results: null and wordless texts have an empty set and are alone; with fewer words than a shingle the whole
sequence is the one shingle; equal rows are one class; rows without doc_id take part and a component of only such rows
has a null id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.llm import _occurrences as occ
from harborlight.llm import _text
from harborlight.llm._arrow import spare
from harborlight.llm._keys import KEY, keyed, row_key
from harborlight.session import release, ship, stored

SPREAD = 4
#: Leaders of each token.
LEADERS = 3
#: Members of a group in one row of the matrix; larger groups have several rows.
GROUP_ROWS = 64
#: Rows of a key that share a salt: sets with a token, and questions to a group.
TOKEN_ROWS, QUESTION_ROWS = 512, 64
#: Most keys with more rows than a salt holds; they are broadcast.
HOT_KEYS = 50_000


def shingle_sets(chunk: _text.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, with offsets."""
    found = _text.words(chunk, _text.NONSPACE, _text.CODES_LOWER)
    hashes, inside = _text.windows(found, k)
    doc = found.doc
    use = np.flatnonzero(inside)
    values, owner = hashes[use], doc[use]
    size = np.diff(found.first)
    for i in np.flatnonzero((size > 0) & (size < k)):
        whole = _text.Words(found.hash[found.first[i] : found.first[i + 1]], None, None, np.array([0, size[i]]))
        values = np.append(values, _text.windows(whole, int(size[i]))[0])
        owner = np.append(owner, i)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(size) + 1)).astype(np.int64)


def needed(n, percent: int):
    """Least overlap of a set of n with any set that it links with."""
    return -(-n * percent // 100)


def _set_keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; 0 for the empty one."""
    def total(x):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return c[first[1:]] - c[first[:-1]]

    a = _text.mix(total(_text.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))))
    b = _text.mix(total(_text.mix(values + np.uint64(0x3C6EF372FE94F82B))))
    return a.view(np.int64), b.view(np.int64)


def _sieve_map(k: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)]).astype(np.int64)
            for chunk in _text.chunks(batch.column(2)):
                values, first = shingle_sets(chunk, k)
                mine = keys[:, chunk.lo : chunk.hi]
                size = np.diff(first)
                a, b = _set_keys(values, first)
                name = struct.unpack("<q", hashlib.blake2b(mine.tobytes() + str(chunk.lo).encode(), digest_size=8).digest())[0]
                owner = np.repeat(np.arange(len(size)), size)
                # one text of each equal set of the chunk speaks for it
                speaks = np.zeros(len(size), bool)
                speaks[np.unique(np.stack([a, b], 1), axis=0, return_index=True)[1]] = True
                prefix = size - needed(size, percent) + _probes(size, percent)
                use = np.flatnonzero((np.arange(len(values)) - first[owner] < prefix[owner]) & speaks[owner])
                need = np.where(size > 0, _probes(needed(size, percent), percent), 1 << 30)
                *entries, rest = occ.combine(values[use], np.zeros(len(use), bool), use - first[owner[use]] + _slots(prefix)[owner[use]])
                table = np.uint32(len(size)).tobytes() + mine.tobytes() + a.tobytes() + b.tobytes() + size.astype(np.uint32).tobytes() + need.astype(np.uint32).tobytes() + rest
                rows = [(name % buckets, name, occ.TABLE, table)]
                rows += [(bucket, name, occ.OCCURRENCES, data) for bucket, data in occ.pack(*entries, buckets)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], ["bucket", "chunk", "kind", "data"])

    return run


def _probes(size: np.ndarray, percent: int) -> np.ndarray:
    """Tokens by which a sieve prefix is longer than the shortest prefix that two linking sets must share."""
    return np.where(size > 0, np.maximum(size * (100 - percent) // 100, 1), 0)


def _slots(prefix: np.ndarray) -> np.ndarray:
    """Positions of the first prefix token of each text when all prefixes lie one after another."""
    return np.concatenate([[0], np.cumsum(prefix)])[:-1]


SIEVED = "_key long, _more long, a long, b long, n long, stays boolean"


def _sieve_resolve(percent: int):
    def run(table: pa.Table) -> pa.Table:
        tables, reported = occ.positions(table)
        out = []
        for data in tables:
            n = int(np.frombuffer(data, np.uint32, 1)[0])
            keys, more, a, b = (np.frombuffer(data, np.int64, n, 4 + 8 * n * j) for j in range(4))
            size, need = (np.frombuffer(data, np.uint32, n, 4 + 32 * n + 4 * n * j).astype(np.int64) for j in range(2))
            hits = occ.expand(memoryview(data)[4 + 40 * n :], reported)
            prefix = size - needed(size, percent) + _probes(size, percent)
            edges = np.concatenate([[0], np.cumsum(prefix)])
            count = np.diff(np.searchsorted(hits, edges))
            out.append(pa.table({"_key": keys, "_more": more, "a": a, "b": b, "n": size, "stays": count >= need}))
        kinds = pa.schema([*[(c, pa.int64()) for c in (*KEY, "a", "b", "n")], ("stays", pa.bool_())])
        return pa.concat_tables(out) if out else kinds.empty_table()

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _text.chunks(batch.column(0)):
                values, first = shingle_sets(chunk, k)
                a, b = _set_keys(values, first)
                flat = pa.array(values.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), flat)], ["a", "b", "n", "tokens"])

    return run


def _linked(overlap: Column, n1: Column, n2: Column, percent: int) -> Column:
    return overlap * 100 >= (n1 + n2 - overlap) * percent


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """labels (node, label) merged along edges (u, v) between labels: the least label of each component.

    Each round, every label points to the least label next to it, pointers are followed further, and the edges are drawn
    between the new labels. Labels are hashes, so a few rounds do.
    """
    while not edges.isEmpty():
        back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        point = edges.union(back).groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v"))
        point = stored(point, "pointers")
        further = point.select(F.col("u").alias("w"), F.col("v").alias("x"))
        for _ in range(2):
            point = point.join(further, F.col("v") == F.col("w"), "left").select("u", F.coalesce("x", "v").alias("v"))
        point = stored(point, "pointers")
        labels = stored(labels.join(point, F.col("label") == F.col("u"), "left").select("node", F.coalesce("v", "label").alias("label")), "labels")
        moved = edges.join(point.select(F.col("u").alias("_u1"), F.col("v").alias("_v1")), F.col("u") == F.col("_u1"))
        moved = moved.join(point.select(F.col("u").alias("_u2"), F.col("v").alias("_v2")), F.col("v") == F.col("_u2"))
        edges = stored(moved.select(F.col("_v1").alias("u"), F.col("_v2").alias("v")).filter("u <> v").distinct(), "edges")
    return labels


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of set ids that link, by exact comparison."""
    left = sets.select(F.col("id").alias("u"), F.col("tokens").alias("_tu"))
    right = sets.select(F.col("id").alias("v"), F.col("tokens").alias("_tv"))
    joined = pairs.join(left, "u").join(right, "v")
    overlap = F.size(F.array_intersect("_tu", "_tv")).cast("long")
    return joined.filter(_linked(overlap, F.size("_tu").cast("long"), F.size("_tv").cast("long"), percent)).select("u", "v")


def _fits(n1: str, s1: str, n2: str, s2: str, percent: int) -> Column:
    """Whether two sets can link: the overlap is at most the lesser of their shared tokens, and that of their sizes."""
    return F.least(s1, s2) * (100 + percent) >= (F.col(n1) + F.col(n2)) * percent


def _count_map(buckets: int):
    """All tokens of the sets, packed; a chunk is a batch of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tokens = batch.column(1)
            first = tokens.offsets.to_numpy().astype(np.int64)
            values = tokens.values.to_numpy()[first[0] : first[-1]].view(np.uint64)
            name = struct.unpack("<q", hashlib.blake2b(ids.tobytes(), digest_size=8).digest())[0]
            rows = [(name % buckets, name, occ.TABLE, np.uint32(len(ids)).tobytes() + ids.tobytes() + (first - first[0]).astype(np.uint32).tobytes())]
            rows += [(bucket, name, occ.OCCURRENCES, data) for bucket, data in occ.pack(values, np.zeros(len(values), bool), np.arange(len(values)), buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], ["bucket", "chunk", "kind", "data"])

    return run


def _rare_first(percent: int):
    """Of each set the numbers of the tokens in its prefix that other sets have, where tokens are ordered by how many sets have them.

    Tokens of no other set come first; a set with enough of them has no prefix token in common with any and is left out. Also
    s, the number of tokens that other sets have (no overlap is larger), and rarity, which is least in the midst of a group.
    """

    def run(table: pa.Table) -> pa.Table:
        tables, at, count = occ.positions_with_counts(table)
        ids_out, numbers, shared, rarity = [], [], [], []
        for data in tables:
            n = int(np.frombuffer(data, np.uint32, 1)[0])
            ids = np.frombuffer(data, np.int64, n, 4)
            first = np.frombuffer(data, np.uint32, n + 1, 4 + 8 * n).astype(np.int64)
            edge = np.searchsorted(at, first)
            for i in np.flatnonzero(np.diff(edge)):
                size, own = int(first[i + 1] - first[i]), slice(edge[i], edge[i + 1])
                known = int(edge[i + 1] - edge[i])
                take = size - needed(size, percent) + 1 - (size - known)
                if take > 0:
                    ids_out.append(int(ids[i]))
                    shared.append(known)
                    rarity.append(size - known + float((1.0 / count[own]).sum()))
                    numbers.append(np.sort((at[own] - first[i])[np.argsort(count[own], kind="stable")[:take]]).astype(np.int32))
        return pa.table({"id": pa.array(ids_out, pa.int64()), "at": pa.array(numbers, pa.list_(pa.int32())), "s": pa.array(shared, pa.int64()), "rarity": pa.array(rarity, pa.float64())})

    return run


def group_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) for sets (id, n, tokens sorted by hash): steps 2 to 4 of the module."""
    spark = sets.sparkSession
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = sets.select("id", "tokens").mapInArrow(_count_map(buckets), occ.PACKED)
    chosen = packed.groupBy("bucket").applyInArrow(occ.counted, occ.REPORTED).groupBy("chunk").applyInArrow(_rare_first(percent), "id long, at array<int>, s long, rarity double")
    sets = stored(sets.join(chosen.dropDuplicates(["id"]), "id"), "prefixed-sets")
    release(spark)
    posts = sets.select("id", "n", "s", "rarity", F.explode(F.transform("at", lambda i: F.element_at("tokens", i + 1))).alias("token"))
    posts, sets = stored(posts, "posts"), sets.select("id", "n", "s", "tokens")
    labels = sets.select(F.col("id").alias("node"), F.col("id").alias("label"))
    orders = [F.col("rarity"), *[F.xxhash64("id", F.lit(r)).cast("double") for r in range(LEADERS - 1)]]
    ranks = [F.min(F.struct(o.alias("r"), F.col("id").alias("leader"), F.col("n").alias("leader_n"), F.col("s").alias("leader_s"))) for o in orders]
    lead = stored(posts.groupBy("token").agg(F.array(*ranks).alias("leaders"), F.count("*").alias("rows")).filter("rows > 1"), "leaders")
    dealt, lead = salted(posts, "token", lead, TOKEN_ROWS, posts.count())
    near = dealt.join(lead, ["token", "salt"]).select("id", "n", "s", F.inline("leaders")).filter(F.col("id") != F.col("leader")).filter(_fits("n", "s", "leader_n", "leader_s", percent))
    pairs = near.select(F.least("id", "leader").alias("u"), F.greatest("id", "leader").alias("v")).distinct()
    labels = components(stored(_compare(pairs, sets, percent), "edges"), stored(labels, "labels"))
    release(spark)
    return components(_open_groups(posts, sets, labels, percent), labels)


def _open_groups(posts: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between different groups, as edges between labels: the token-group matrix and the opened groups."""
    here = posts.join(labels, F.col("id") == F.col("node")).select("id", "n", "s", "token", "label")
    # tokens that lie in one group only can't connect two groups
    split = here.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("rows")).filter("lo <> hi").select("token", "rows")
    dealt, split = salted(here, "token", stored(split, "split-tokens"), TOKEN_ROWS, posts.count())
    open_ = stored(dealt.join(split, ["token", "salt"]), "open-posts")
    members = labels.groupBy("label").agg(F.count("*").alias("members"))
    cells = open_.groupBy("token", "label").agg(F.min("n").alias("least"), F.max("s").alias("most")).join(members, "label")
    other = cells.select("token", F.col("label").alias("group"), "least", "most", F.col("members").alias("group_members"))
    asks = open_.join(members, "label").join(other.join(split, "token"), ["token", "salt"])
    # of two groups the one with fewer members asks, and some size and shared tokens must fit
    asks = asks.filter((F.col("members") < F.col("group_members")) | ((F.col("members") == F.col("group_members")) & (F.col("label") < F.col("group"))))
    asks = asks.filter(_fits("n", "s", "least", "most", percent))
    asks = stored(asks.select("id", "n", "s", "label", "group").distinct(), "asks")
    asks, salts = salted(asks, "group", asks.groupBy("group").agg(F.count("*").alias("rows")), QUESTION_ROWS, asks.count())
    wanted = asks.select(F.col("group").alias("label")).distinct()
    united = sets.join(labels, F.col("id") == F.col("node")).join(wanted, "label")
    unions = united.join(members, "label").withColumn("part", _part("id"))
    unions = unions.select("label", "part", F.explode("tokens").alias("t")).distinct().groupBy("label", "part").agg(F.collect_list("t").alias("union"))
    queries = sets.select("id", "tokens")
    unions = unions.withColumnRenamed("label", "group").join(salts, "group")
    bounded = asks.join(unions, ["group", "salt"]).join(queries, "id")
    qualifies = F.size(F.array_intersect("tokens", "union")) >= F.ceil(F.col("n") * percent / 100)
    opened = stored(bounded.filter(qualifies).select("id", "n", "s", "label", "group", "salt", "part"), "opened")
    # one row per opened part with its sets; any link of the query to one of them joins the two groups
    parts = united.join(members, "label").withColumn("part", _part("id")).select(F.col("label").alias("group"), "part", F.struct("n", "s", "tokens").alias("m"))
    wanted = opened.groupBy("group", "part").agg(F.collect_set("salt").alias("salts"))
    parts = parts.join(wanted.drop("salts"), ["group", "part"]).groupBy("group", "part").agg(F.collect_list("m").alias("inside"))
    parts = parts.join(wanted, ["group", "part"]).select("group", "part", "inside", F.explode("salts").alias("salt"))

    def links(m: Column) -> Column:
        can = F.least("s", m["s"]) * (100 + percent) >= (F.col("n") + m["n"]) * percent
        return can & _linked(F.size(F.array_intersect("tokens", m["tokens"])).cast("long"), F.col("n"), m["n"], percent)

    found = opened.join(queries, "id").join(parts, ["group", "part", "salt"]).filter(F.exists("inside", links))
    return stored(found.select(F.col("label").alias("u"), F.col("group").alias("v")).distinct(), "edges")


def salted(rows: DataFrame, key: str, counts: DataFrame, size: int, total: int) -> tuple[DataFrame, DataFrame]:
    """rows with a salt, so that about `size` rows of a key share one, and counts (key, rows, ..) once for each salt.

    Of `total` rows at most HOT_KEYS keys have more than total / HOT_KEYS each, so with that as least size the keys with several
    salts are few enough to be broadcast.
    """
    size = max(size, math.ceil(total / HOT_KEYS))
    number = F.ceil(F.col("rows") / size)
    several = F.broadcast(counts.filter(F.col("rows") > size).select(key, number.alias("_salts")))
    salt = F.pmod(F.xxhash64("id", F.lit("salt")), F.coalesce("_salts", F.lit(1)))
    dealt = rows.join(several, key, "left").withColumn("salt", salt).drop("_salts")
    return dealt, counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), number - 1))).drop("rows")


def _part(id_: str) -> Column:
    """Number of the matrix row of a set in its group of `members` sets: one row for about GROUP_ROWS."""
    return (F.pmod(F.xxhash64(id_), F.lit(1 << 40)) % F.ceil(F.col("members") / GROUP_ROWS)).cast("long")


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """Per row of docs: doc_id, _key (of id and text), n, class (one id per component)."""
    spark = docs.sparkSession
    ship(spark)
    buckets = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(docs, doc_id, text)
    packed = rows.select(*KEY, "_text").mapInArrow(_sieve_map(shingle, percent, buckets), occ.PACKED)
    reported = packed.groupBy("bucket").applyInArrow(occ.shared(False), occ.REPORTED)
    sieved = reported.groupBy("chunk").applyInArrow(_sieve_resolve(percent), SIEVED)
    # equal rows of a chunk have one speaker
    sieved = stored(sieved.groupBy(*KEY).agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("n").alias("n"), F.max("stays").alias("stays")), "sieved")
    release(spark)
    # of each class of equal sets one text is read again
    chosen = sieved.filter("stays").groupBy("a", "b", "n").agg(F.min(F.struct(*KEY)).alias("k")).select("k.*")
    texts = rows.select(*KEY, "_text").join(chosen, KEY, "left_semi").select("_text")
    sets = texts.mapInArrow(_sets(shingle), "a long, b long, n long, tokens array<long>").withColumn("id", F.xxhash64("a", "b", "n"))
    sets = stored(sets.dropDuplicates(["id"]).select("id", "n", "tokens"), "sets")
    release(spark)
    labels = group_components(sets, percent)
    found = rows.select("doc_id", *KEY).join(sieved.select(*KEY, "a", "b", "n"), KEY, "left").withColumn("node", F.xxhash64("a", "b", "n"))
    return found.join(labels, "node", "left").select("doc_id", *KEY, "n", F.coalesce("label", "node").alias("class"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (least doc_id reachable by links of Jaccard >= percent / 100)."""
    rows = stored(_classes(docs, doc_id, text, shingle, percent).drop(*KEY), "classes")
    alone = F.col("n") == 0
    # written, so that the join with a class of very many rows can be split
    least = stored(rows.filter(~alone).groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"), "least-ids")
    joined = rows.join(least, "class", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component: that with the least doc_id (rows without one last). Texts without words all stay.

    The rows that stay are named by key, one per class, so rows of a class never meet in one task.
    """
    rows = _classes(docs, doc_id, text, shingle, percent)
    rows = stored(rows.select(F.col("doc_id").isNull().alias("x"), "doc_id", *KEY, "n", "class"), "classes")
    worded = rows.filter("n > 0")
    first = worded.groupBy("class").agg(F.min(F.struct("x", "doc_id", *KEY)).alias("first")).select("first._key", "first._more")
    gone = worded.select(*KEY).join(first, KEY, "left_anti").distinct()
    names = [spare(c, docs.columns) for c in KEY]
    named = docs.withColumns(dict(zip(names, row_key(F.col(doc_id), F.col(text)), strict=True)))

    def match(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.toDF("_other_key", "_other_more")
        return df.join(keys, (F.col(names[0]) == F.col("_other_key")) & (F.col(names[1]) == F.col("_other_more")), how)

    kept = match(named, gone, "left_anti")
    # of equal rows one stays; only they are brought together
    repeated = worded.groupBy(*KEY).count().filter("count > 1").select(*KEY)
    if repeated.isEmpty():
        return kept.select(docs.columns)
    single = match(kept, repeated, "left_semi").dropDuplicates(names)
    return match(kept, repeated, "left_anti").unionByName(single).select(docs.columns)
