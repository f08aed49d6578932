"""SimHash near-duplicates: fingerprints of word shingles, joined by a binary trie over the fingerprints.

Fingerprints that differ in few bits agree in a whole block of bits: of b + 1 blocks, b differing bits leave one alone. So
the fingerprints are rotated to put each block first in turn, and a trie over each rotation is joined with itself: pairs of
nodes descend together, bit by bit, add up differing bits and are left once they are over budget, which is zero within the
leading block. Each trie is cut into subtrees of a bounded number of rows, split as deep as it takes; a task has a subtree,
or two that agree in the leading block. A task returns a spanning forest of its links (never all pairs of a group), and the
components are joined over tasks with alternating large-star and small-star rounds.

For sets of shingles of a given Jaccard similarity the bits that may differ are too many for that. There, rows meet in the
buckets of their least shingle hashes; a bucket's trie is joined with a wide budget, and exact Jaccard confirms each link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import discard, if_small, join_keyed, materialize, only_rows, small_batches, text_digest, tidied

BITS = 64
#: Bits of the trie that the first histogram covers at most, and those of each node that is split further: its counters are
#: what the driver gets.
FIRST_BITS, STEP_BITS = 17, 8
#: The trie is cut at this depth at least, so that small inputs make enough tasks; rows of a subtree, and how many subtrees
#: there may be before they get larger.
LEAST_BITS, LEAF_ROWS, SUBTREES = 4, 1 << 17, 1 << 15
#: Pairs of fingerprints that are compared at once.
PAIRS = 1 << 20
#: Hashes whose bits are counted at once, and node pairs that descend at once.
CHUNK, FRONTIER = 1 << 15, 1 << 15
#: Least hashes of a set by which it is put into buckets, and those of which a pair must share two. The second names the buckets
#: into which a crowded one is split, so crowded or not, a bucket compares the same pairs. Of two sets of similarity 0.8, none of
#: KEYS is shared by 0.2**8 of all pairs, and but one of SECOND_KEYS by fewer yet.
KEYS, SECOND_KEYS = 8, 12
#: Bits of 64 that may differ in such a pair: 10 are expected at similarity 0.8, with a deviation of 3.
WIDE_BITS = 24
#: Rows and shingles that a bucket, or a part of one, may hold.
BUCKET_ROWS, BUCKET_SHINGLES = 1 << 13, 1 << 22


def fingerprint(text: str | None, k: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of each k-word shingle; fewer words make one shingle, none give zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return majority(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        ones += np.unpackbits(hashes[at : at + CHUNK].astype("<u8", copy=False).view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(id, digest, fp): one row for each row of docs; null and blank texts have fingerprint zero. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            fps = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, b.num_rows)
            digests = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), digests, pa.array(fps.view(np.int64))], names=["id", "digest", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"id {kind}, digest binary, fp bigint")


def cut_trie(counts: dict[int, int], leaf_rows: int, depth: int, least: int) -> list[tuple[int, int, int]]:
    """(depth, prefix, rows) of the subtrees: nodes with more than leaf_rows rows, and those above the depth least, are
    split, down to the given depth."""
    full = np.zeros(1 << depth, np.int64)
    for prefix, n in counts.items():
        full[prefix] = n
    levels = [full]
    while len(levels[0]) > 1:
        levels.insert(0, levels[0].reshape(-1, 2).sum(1))
    leaves, nodes = [], [(0, 0)]
    while nodes:
        d, p = nodes.pop()
        if levels[d][p] and d < depth and (d < least or levels[d][p] > leaf_rows):
            nodes += [(d + 1, 2 * p + 1), (d + 1, 2 * p)]
        elif levels[d][p]:
            leaves.append((d, p, int(levels[d][p])))
    return leaves


def products(al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs of the ranges al to ah with those of bl to bh, some PAIRS at a time."""
    n = ah - al
    i = np.repeat(al, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low, wide = np.repeat(bl, n), np.repeat(bh - bl, n)
    upto, at = np.cumsum(wide), 0
    while at < len(i):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        w = wide[at:end]
        yield np.repeat(i[at:end], w), np.repeat(low[at:end], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        at = end


def trie_join(a: np.ndarray, b: np.ndarray, budget: int, same: bool, free: int = 0, roots: tuple[np.ndarray, ...] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the fingerprints in a and b that differ in at most budget bits; same: a is b.

    A node is a range of a sorted array. Node pairs descend together in blocks, so memory is bounded; a node pair with
    few fingerprint pairs left is finished by comparing those. Within the first free bits no error is allowed. roots: ranges
    (from and to in a, from and to in b) that are joined each for itself, if the arrays hold several tries.
    """
    ones: dict[tuple[int, int], np.ndarray] = {}

    def split(side: int, x: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if (side, depth) not in ones:
            bit = (x >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[side, depth] = np.concatenate((np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)))
        c = ones[side, depth]
        return hi - (c[hi] - c[lo])

    start = roots or tuple(np.array([v], np.int64) for v in (0, len(a), 0, len(b)))
    stack = [(0, (*start, np.zeros(len(start[0]), np.int64)))]
    while stack:
        depth, (al, ah, bl, bh, err) = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack += [(depth, tuple(x[half:] for x in (al, ah, bl, bh, err))), (depth, tuple(x[:half] for x in (al, ah, bl, bh, err)))]
            continue
        work = (ah - al) * (bh - bl)
        few = (work <= 16) | (depth == BITS)
        for i, j in products(*(x[few] for x in (al, ah, bl, bh))):
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            yield i[near], j[near]
        al, ah, bl, bh, err = (x[~few] for x in (al, ah, bl, bh, err))
        if not len(al):
            continue
        am, bm, twin = split(0, a, depth, al, ah), split(int(not same), b, depth, bl, bh), (al == bl) if same else np.zeros(len(al), bool)
        parts = []
        for x in (0, 1):
            for y in (0, 1):
                l1, h1 = (am, ah) if x else (al, am)
                l2, h2 = (bm, bh) if y else (bl, bm)
                e = err + (x != y)
                ok = (h1 > l1) & (h2 > l2) & (e <= (budget if depth >= free else 0))
                if (x, y) == (1, 0):
                    ok &= ~twin
                parts.append(tuple(v[ok] for v in (l1, h1, l2, h2, e)))
        stack.append((depth + 1, tuple(np.concatenate(v) for v in zip(*parts))))


class Forest:
    """Union-find over row numbers; the smaller number is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        up = self.up
        other = up[i] != up[j]
        for x, y in zip(i[other].tolist(), j[other].tolist()):
            while up[x] != x:
                up[x] = x = up[up[x]]
            while up[y] != y:
                up[y] = y = up[up[y]]
            if x != y:
                up[max(x, y)] = min(x, y)
        while (up[up] != up).any():
            up[:] = up[up]


#: A subtree: depth, prefix, rows.
Leaf = tuple[int, int, int]


def turned(fp: Column, by: int) -> Column:
    """fp rotated to the left."""
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by)) if by else fp


def task_links(table: pa.Table, budget: int, width: int) -> pa.Table:
    """A spanning forest of the links between the one or two subtrees of a task, as (u, v) fingerprints."""
    leaf, by = table.column("leaf").to_numpy(), int(table.column("by")[0].as_py())
    fp = table.column("fp").to_numpy().view(np.uint64)
    key = (fp << np.uint64(by)) | (fp >> np.uint64(BITS - by)) if by else fp
    first = leaf == leaf.min()
    one, two = np.flatnonzero(first), np.flatnonzero(~first)
    one, two, same = one[np.argsort(key[one])], two[np.argsort(key[two])], not len(two)
    nodes, shift = fp[np.concatenate((one, two))], 0 if same else len(one)
    forest = Forest(len(nodes))
    for i, j in trie_join(key[one], key[one] if same else key[two], budget, same, width):
        forest.add(i, j + shift)
    child = np.flatnonzero(forest.up != np.arange(len(nodes)))
    return pa.table({"u": nodes[child].view(np.int64), "v": nodes[forest.up[child]].view(np.int64)})


def leaf_tasks(leaves: list[Leaf], width: int, budget: int) -> list[list[tuple[int, int]]]:
    """For each subtree (depth, prefix, rows) the tasks that it is in, as pairs of subtrees (a <= b): one of its own, and one
    with each that agrees in the first width bits and differs in at most budget of the other bits that both have."""
    tasks: list[list[tuple[int, int]]] = [[(x, x)] for x in range(len(leaves))]
    blocks: dict[int, list[int]] = {}
    for x, (d, p, _) in enumerate(leaves):
        if d > width:
            blocks.setdefault(p >> (d - width), []).append(x)
    for members in blocks.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                d = min(leaves[a][0], leaves[b][0])
                if ((leaves[a][1] >> (leaves[a][0] - d)) ^ (leaves[b][1] >> (leaves[b][0] - d))).bit_count() <= budget:
                    tasks[a].append((a, b))
                    tasks[b].append((a, b))
    return tasks


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def rotations(fps: DataFrame, width: int, bits: int) -> DataFrame:
    """(fp, by, p): the fingerprints with each rotation's leading bits."""
    each = [F.struct(F.lit(by).alias("by"), F.shiftrightunsigned(turned(F.col("fp"), by), BITS - bits).alias("p")) for by in range(0, BITS - width + 1, width)]
    return fps.select("fp", F.explode(F.array(*each)).alias("r")).select("fp", "r.by", "r.p")


def cut_leaves(fps: DataFrame, width: int, leaf_rows: int, first_bits: int) -> tuple[dict[int, list[Leaf]], list[tuple[int, int, int, int]]]:
    """The subtrees (depth, prefix, rows) of each rotation's trie, and (bits, rotation, prefix, subtree) of all prefixes that
    lead to one. Subtrees with too many rows are split further, as deep as it takes."""
    leaves: dict[int, list[Leaf]] = {by: [] for by in range(0, BITS - width + 1, width)}
    places = []
    depth, bits, nodes = 0, first_bits, [(by, 0) for by in leaves]
    while nodes:
        rows = rotations(fps, width, bits).withColumn("x", F.shiftrightunsigned("p", bits - depth) if depth else F.lit(0).cast("bigint"))
        if depth:
            rows = rows.join(F.broadcast(fps.sparkSession.createDataFrame(nodes, "by int, x bigint")), ["by", "x"])
        counts: dict[tuple[int, int], dict[int, int]] = {node: {} for node in nodes}
        for by, x, p, n in rows.groupBy("by", "x", "p").count().collect():
            counts[by, x][p % (1 << (bits - depth))] = n
        deeper = []
        for by, x in nodes:
            for d, p, n in cut_trie(counts[by, x], leaf_rows, bits - depth, 0 if depth else LEAST_BITS):
                if n > leaf_rows and depth + d == bits < BITS:
                    deeper.append((by, x << d | p))
                    continue
                rest = bits - depth - d
                places += [(bits, by, signed((x << d | p) << rest | q), len(leaves[by])) for q in range(1 << rest) if (p << rest | q) in counts[by, x]]
                leaves[by].append((depth + d, x << d | p, n))
        depth, bits, nodes = bits, min(bits + STEP_BITS, BITS), deeper
    return leaves, places


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def hamming_links(fps: DataFrame, max_bits: int = 3, leaf_rows: int | None = None) -> DataFrame:
    """Links (u, v) that connect just what pairs of the distinct fingerprints in fps(fp) within max_bits connect.

    fps is a written table. A fingerprint goes to max_bits + 1 tasks, and to more only from a block of bits that more than
    leaf_rows fingerprints share.
    """
    spark, width, n = fps.sparkSession, BITS // (max_bits + 1), fps.count()
    leaf_rows = leaf_rows or max(LEAF_ROWS, n // SUBTREES)
    first_bits = min(FIRST_BITS, LEAST_BITS + (n // leaf_rows).bit_length())
    leaves, places = cut_leaves(fps, width, leaf_rows, first_bits)
    tasks: dict[tuple[int, int], list[int]] = {}
    before = 0
    for by in leaves:
        mine = leaf_tasks(leaves[by], width, max_bits)
        number = {t: before + k for k, t in enumerate(sorted({t for x in mine for t in x}))}
        before += len(number)
        tasks |= {(by, x): [number[t] for t in ts] for x, ts in enumerate(mine)}
    dealt = []
    for bits in sorted({b for b, *_ in places}):
        # At most 2**FIRST_BITS rows a rotation, and 2**STEP_BITS more for each subtree that was split further.
        plan = spark.createDataFrame([(by, p, x, tasks[by, x]) for b, by, p, x in places if b == bits], "by int, p bigint, leaf int, tasks array<int>")
        dealt.append(rotations(fps, width, bits).join(F.broadcast(plan), ["by", "p"]).select(F.explode("tasks").alias("task"), "leaf", "by", "fp"))
    if not dealt:
        return spark.createDataFrame([], "u bigint, v bigint")
    return reduce(DataFrame.unionByName, dealt).groupBy("task").applyInArrow(lambda t: task_links(t, max_bits, width), "u bigint, v bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node and the smallest node that it reaches, by large-star and small-star rounds.

    Rounds go on until the links are stars: each node has one link, to a node that has none of its own.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    while not stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        last, edges = edges, materialize(small.where("u <> v").distinct(), "links")
        discard(last)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def stars(edges: DataFrame) -> bool:
    """Whether each u occurs once and is no v."""
    ends = edges.select("u", F.lit(1).alias("n")).union(edges.select("v", F.lit(0)).distinct())
    seen = ends.groupBy("u").agg(F.sum("n").alias("links"), F.min("n").alias("least"))
    return seen.where("links > 1 or (links = 1 and least = 0)").isEmpty()


def _with_least(rows: DataFrame, node: str, carried: tuple[str, ...], links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows(id, digest, node, ...) with first, the smallest (id, digest) of the row's component; null ids come last. links_of:
    the links between the nodes of a table (node, carried columns), which has one row for each."""
    who = F.struct(F.col("id").isNull().alias("unknown"), F.col("id").alias("id"), F.col("digest").alias("digest"))
    nodes = materialize(rows.groupBy(node).agg(F.min(who).alias("least"), F.count(F.lit(1)).alias("n_rows"), *(F.min(c).alias(c) for c in carried)), "nodes")
    roots = components(links_of(nodes.select(node, *carried))).withColumnRenamed("node", node)
    of = materialize(nodes.join(roots, node, "left").select(node, "least", "n_rows", F.coalesce("root", node).alias("root")), "roots")
    least = of.groupBy("root").agg(F.min("least").alias("first"))
    return join_keyed(rows.select("id", "digest", node), materialize(of.join(least, "root").select(node, "first", "n_rows"), "firsts"), node, "n_rows")


def near_groups(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int, leaf_rows: int | None) -> DataFrame:
    rows = materialize(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    return _with_least(rows, "fp", (), lambda fps: hamming_links(fps, max_bits, leaf_rows))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 3, leaf_rows: int | None = None) -> DataFrame:
    """One row for each row of docs: (id, fp, component_id).

    component_id is the smallest id that the row reaches over fingerprints differing in at most max_bits bits. Equal
    fingerprints form one node, so copies cost one row each. Null and blank texts share fingerprint zero. A null id keeps
    its row and takes part as a text, but is never a component_id unless its component has no other id. Texts of any length
    are read whole; an empty table gives an empty result; other columns are ignored.
    """
    groups = near_groups(docs, id_col, text_col, shingle_words, max_bits, leaf_rows)
    return groups.select(F.col("id").alias(id_col), "fp", F.col("first.id").alias("component_id"))


def _first_only(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))
    return only_rows(docs, groups.select("id", "digest", stays.alias("stays")), id_col, text_col, text_digest)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 3, leaf_rows: int | None = None) -> DataFrame:
    """Of each component of near_duplicates() the smallest id; of an id with several texts in it, the one of least digest.

    Rows are decided one by one: an id's texts in other components are not touched. Of rows that repeat the id and the text of
    the one that stays, one remains.
    """
    return _first_only(docs, near_groups(docs, id_col, text_col, shingle_words, max_bits, leaf_rows), id_col, text_col)


def shingle_set(text: str | None, k: int, seed: int = 42) -> np.ndarray:
    """The distinct XXH64 of a text's k-word shingles, sorted; fewer words make one shingle, none give an empty set."""
    words = (text or "").encode().lower().split()
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)] if words else []
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64))


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, digest, node, n, fp, keys, shingles) for each row of docs; node names the set of shingles, n is its size, keys are
    its SECOND_KEYS least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            sets = [shingle_set(t, shingle_words) for t in texts]
            blobs = [s.astype("<u8", copy=False).tobytes() for s in sets]
            node, fp = (np.fromiter(map(f, x), np.uint64, len(sets)) for f, x in ((xxhash.xxh64_intdigest, blobs), (majority, sets)))
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            keys = pa.array([s[:SECOND_KEYS].view(np.int64) for s in sets], pa.list_(pa.int64()))
            digests = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
            columns = [b.column(0), digests, *map(pa.array, (node.view(np.int64), n, fp.view(np.int64))), keys, pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "node", "n", "fp", "keys", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(lambda it: tidied(run(it)), f"id {kind}, digest binary, node bigint, n bigint, fp bigint, keys array<bigint>, shingles binary")


def bucketed(nodes: DataFrame, bucket_rows: int, bucket_shingles: int) -> DataFrame:
    """(task, part, level, last, node, n, fp, keys): nodes(node, n, fp, keys) in the buckets that they share with others.

    A node is in the bucket of each of its first KEYS keys, with all its keys. The rows of a bucket that is too large go to buckets
    of two keys instead, of which the second may be any larger one. If one of those is too large yet, its members share much: they are
    dealt to parts, and tasks are the pairs of parts. level: how many keys name the bucket; last: the largest of them. Of the
    keys of the second level, those up to the last stay.
    """

    too_large = (F.col("in_rows") > bucket_rows) | (F.col("in_shingles") > bucket_shingles)

    def sized(rows: DataFrame, name: str) -> tuple[DataFrame, bool]:
        sizes = rows.groupBy("task").agg(F.count(F.lit(1)).alias("in_rows"), F.sum("n").alias("in_shingles")).where("in_rows > 1")
        sizes = materialize(sizes.withColumn("n_rows", F.col("in_rows")), name)
        return join_keyed(rows, sizes, "task", "n_rows"), not sizes.where(too_large).isEmpty()

    info = ("node", "n", "fp", "keys")
    # Written, since it is counted and joined more than once.
    dealt = materialize(nodes.select(F.explode(F.slice("keys", 1, KEYS)).alias("task"), *info), "dealt")
    one, crowded = sized(dealt, "buckets")
    upto = F.filter("keys", lambda k: _unsigned(k) <= _unsigned(F.col("last"))).alias("keys")
    fits = one.where(~too_large).withColumn("last", F.col("task")).select("task", F.lit(0).alias("part"), F.lit(1).alias("level"), "last", *info)
    if not crowded:
        return fits
    second = F.explode(F.filter("keys", lambda k: _unsigned(k) > _unsigned(F.col("task")))).alias("last")
    over = materialize(one.where(too_large).select("task", second, *info).withColumn("keys", upto), "crowded")
    two, _ = sized(over.withColumn("task", F.xxhash64("task", "last")), "crowded-buckets")
    parts = F.greatest(F.ceil(F.col("in_rows") / bucket_rows), F.ceil(F.col("in_shingles") / bucket_shingles)).cast("int")
    two = two.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # Each part meets every other: a row goes to as many tasks as its bucket has parts.
    two = two.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = F.xxhash64("task", F.least("mine", "other"), F.greatest("mine", "other"))
    return fits.unionByName(two.select(task.alias("task"), F.col("mine").alias("part"), F.lit(2).alias("level"), "last", *info))


def _unsigned(x: Column) -> Column:
    """A number that orders 64-bit numbers as unsigned ones."""
    return x.bitwiseXOR(F.lit(-(2**63)).cast("bigint"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that come sorted by the key; several small groups go into one table."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        k = b.column(key).to_numpy()
        if not len(k):
            continue
        # The first row of the batch's last group: what comes before is whole.
        cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


class Buckets:
    """The rows of some whole tasks, and the pairs of rows that their sketches allow to be similar."""

    def __init__(self, table: pa.Table, similarity: float):
        column = {c: table.column(c).to_numpy() for c in ("task", "part", "level", "last", "node", "n")}
        fp = table.column("fp").to_numpy().view(np.uint64)
        self.order = order = np.lexsort((fp, column["part"], column["task"]))
        self.similarity, self.fp = similarity, fp[order]
        self.task, self.part, self.level, self.last, self.node, self.n = (v[order] for v in column.values())
        self.last = self.last.view(np.uint64)
        keys = table.column("keys").combine_chunks()
        keys = keys if isinstance(keys, pa.ListArray) else pa.concat_arrays(keys.chunks)
        offsets = keys.offsets.to_numpy()
        size = np.diff(offsets)
        held = np.arange(SECOND_KEYS) < size[:, None]
        self.keys = np.zeros((len(order), SECOND_KEYS), np.uint64)
        self.keys[held] = keys.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
        self.keys, self.held = self.keys[order], held[order]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs (in the sorted order) within the budget, of fitting sizes."""
        start = np.flatnonzero(np.concatenate(([True], (self.task[1:] != self.task[:-1]) | (self.part[1:] != self.part[:-1]))))
        end = np.append(start[1:], len(self.task))
        # A task of one part is joined with itself, one of two parts across them.
        next_same = np.append(self.task[start[1:]] == self.task[start[:-1]], False)
        before_same = np.append(False, next_same[:-1])
        own, two = ~next_same & ~before_same, np.flatnonzero(next_same)
        for same, roots in ((True, (start[own], end[own], start[own], end[own])), (False, (start[two], end[two], start[two + 1], end[two + 1]) if len(two) else None)):
            if roots is None or not len(roots[0]):
                continue
            for i, j in trie_join(self.fp, self.fp, WIDE_BITS, same, roots=roots):
                ok = np.minimum(self.n[i], self.n[j]) >= np.maximum(self.n[i], self.n[j]) * self.similarity - 1e-6
                yield i[ok], j[ok]

    def first_shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the pairs share two keys, and none up to their bucket's last but those that name it: a pair counts in one bucket
        only, and in a bucket of one key just as in those of two."""
        out = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            shared = ((self.keys[a][:, :, None] == self.keys[b][:, None, :]) & self.held[b][:, None, :]).any(2) & self.held[a]
            low = shared & (self.keys[a] <= self.last[a][:, None])
            out[at : at + (1 << 16)] = (low.sum(1) == self.level[a]) & (shared.sum(1) >= 2)
        return out


def with_candidates(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """The rows (task, part, level, last, node, n, fp, keys) of whole tasks that have a candidate in their task."""
    for table in whole_groups(batches, "task"):
        b = Buckets(table, similarity)
        seen = np.zeros(table.num_rows, bool)
        for i, j in b.pairs():
            new = ~(seen[i] & seen[j])
            i, j = i[new], j[new]
            ok = b.first_shared(i, j)
            seen[i[ok]] = seen[j[ok]] = True
        yield from table.filter(pa.array(seen[np.argsort(b.order)])).combine_chunks().to_batches()


def confirmed_links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest (u, v) of the candidate pairs of each task whose sets have the Jaccard similarity.

    Pairs that are linked already are not compared again.
    """
    for table in whole_groups(batches, "task"):
        b = Buckets(table, similarity)
        ends = np.concatenate(([0], np.cumsum(b.n)))
        blobs = table.column("shingles")
        every = np.frombuffer(b"".join(blobs[int(x)].as_py() for x in b.order), "<u8")
        forest = Forest(len(b.node))
        for us, vs in b.pairs():
            new = forest.up[us] != forest.up[vs]
            us, vs = us[new], vs[new]
            ok = b.first_shared(us, vs)
            us, vs = us[ok], vs[ok]
            for u in np.unique(us).tolist():
                v, own = vs[us == u], every[ends[u] : ends[u + 1]]
                # Some at a time, so that a link found spares the later comparisons.
                for at in range(0, len(v), 64):
                    w = v[at : at + 64]
                    w = w[forest.up[w] != forest.up[u]]
                    if not len(w):
                        continue
                    other = np.concatenate([every[ends[x] : ends[x + 1]] for x in w.tolist()])
                    place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    common = np.add.reduceat(own[place] == other, np.cumsum(b.n[w]) - b.n[w], dtype=np.int64)
                    w = w[common >= similarity * (b.n[u] + b.n[w] - common) - 1e-6]
                    if len(w):
                        forest.add(np.full(len(w), u), w)
        child = np.flatnonzero(forest.up != np.arange(len(b.node)))
        yield pa.RecordBatch.from_arrays([pa.array(b.node[child]), pa.array(b.node[forest.up[child]])], names=["u", "v"])


def similar_links(nodes: DataFrame, rows: DataFrame, similarity: float, bucket_rows: int = BUCKET_ROWS, bucket_shingles: int = BUCKET_SHINGLES) -> DataFrame:
    """Links (u, v) of nodes(node, n, fp, keys) that connect what the confirmed candidate pairs connect; rows: sketches().

    A first pass finds the rows that have candidates in a bucket, so only those take their shingles to the second.
    """
    dealt = bucketed(nodes, bucket_rows, bucket_shingles)
    dealt = small_batches(dealt.repartition("task").sortWithinPartitions("task"))
    found = materialize(dealt.mapInArrow(lambda it: tidied(with_candidates(it, similarity)), dealt.schema), "candidates")
    sets = rows.select("node", "shingles").join(if_small(found.select("node").distinct()), "node", "left_semi").dropDuplicates(["node"])
    pairs = found.join(sets, "node").repartition("task").sortWithinPartitions("task")
    return pairs.mapInArrow(lambda it: tidied(confirmed_links(it, similarity)), "u bigint, v bigint")


def similar(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, similarity: float, bucket_rows: int, bucket_shingles: int) -> DataFrame:
    rows = materialize(sketches(docs, id_col, text_col, shingle_words), "sketches")
    return _with_least(rows, "node", ("n", "fp", "keys"), lambda nodes: similar_links(nodes, rows, similarity, bucket_rows, bucket_shingles))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, bucket_rows: int = BUCKET_ROWS, bucket_shingles: int = BUCKET_SHINGLES) -> DataFrame:
    """(id, component_id) for each row of docs: the smallest id that it reaches over pairs of the Jaccard similarity or more.

    Similarity is that of the sets of shingles, and exact; a pair is compared if it shares one of its KEYS least hashes and a
    larger one of its SECOND_KEYS, and its sketches are within WIDE_BITS, however many rows share the hash. Texts with equal sets form one node, texts without words
    too. Null ids are treated as in near_duplicates().
    """
    return similar(docs, id_col, text_col, shingle_words, similarity, bucket_rows, bucket_shingles).select(F.col("id").alias(id_col), F.col("first.id").alias("component_id"))


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, bucket_rows: int = BUCKET_ROWS, bucket_shingles: int = BUCKET_SHINGLES) -> DataFrame:
    """Of each group of similar_groups() one text, chosen and kept as in keep_one()."""
    return _first_only(docs, similar(docs, id_col, text_col, shingle_words, similarity, bucket_rows, bucket_shingles), id_col, text_col)
