"""SimHash, exact dedup and top-k search against brute force, and their edge cases."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from chainloom.llm import exact_dedup, queries, simhash, topk

DOCS = "doc_id bigint, text string, lang string, fp string, id int, norm string"


def docs(spark, texts, start=0):
    return spark.createDataFrame([(i, t, None, "x", 1, None) for i, t in enumerate(texts, start)], DOCS)


def slow_fingerprint(text, k):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, budget=3):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= budget:
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: find(i) for i in ids}


def test_op2_against_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [r[0] for r in rows], [slow_fingerprint(r[1], 3) for r in rows]
    want = slow_components(ids, fps)
    got = {r.doc_id: r for r in queries.op2_simhash(spark, sf).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in zip(ids, fps)}
    assert {i: r.component_id for i, r in got.items()} == want


@pytest.mark.parametrize("leaf_rows", [8, 1 << 16])
def test_links_of_crowded_fingerprints(spark, leaf_rows):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 12, dtype=np.int64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.integers(0, 63, n)) for c in centres for n in range(7) for _ in range(6)]
    fps = sorted({*near, *map(int, rng.integers(-(2**63), 2**63, 200, dtype=np.int64))})
    links = simhash.hamming_links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 3, leaf_rows)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    want = slow_components(fps, [f % 2**64 for f in fps])
    assert {f: roots.get(f, f) for f in fps} == want


def test_long_chain_of_links(spark):
    links = spark.range(300).selectExpr("id + 1 as u", "id as v")
    assert {r.root for r in simhash.components(links).collect()} == {0}


def test_op2_edges(spark):
    texts = [None, "", " \t\n", "One", "one two", "ONE TWO", "a b c " * 30_000, "é É x", "a b c " * 30_000]
    got = simhash.near_duplicates(docs(spark, texts)).collect()
    by = {r.doc_id: r for r in got}
    assert [by[i].fp % 2**64 for i in range(9)] == [slow_fingerprint(t, 3) for t in texts]
    assert by[0].component_id == by[1].component_id == by[2].component_id == 0
    assert by[5].component_id == 4 and by[8].component_id == 6
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    twice = docs(spark, ["p q r s"]).union(docs(spark, ["p q r s"])).union(spark.createDataFrame([(None, "p q r s", None, None, None, None)], DOCS))
    assert [r.component_id for r in simhash.near_duplicates(twice).collect()] == [0, 0, 0]
    assert simhash.keep_one(docs(spark, ["p q r s", "p q r s", "z"])).columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in simhash.keep_one(docs(spark, ["p q r s", "p q r s", "z"])).collect()) == [0, 2]


def test_op7_against_sql(spark, sf, duck, same_rows):
    same_rows(queries.op7_exact_dedup(spark, sf).toPandas(), duck.execute(queries.ORACLE_SQL["op7_exact_dedup"]).df())


def test_op7_edges(spark):
    texts = [None, "", " \n", "a b", "ab ", "a\x0bb   ", " ab", "x" * 200_000, "x" * 200_000, "ab"]
    got = {r.doc_id: r for r in exact_dedup.duplicate_groups(docs(spark, texts), bucket_keys=2).collect()}
    assert [got[i].keep_id for i in range(10)] == [2, 2, 2, 5, 5, 5, 6, 7, 7, 5]
    assert [got[i].group_size for i in range(10)] == [3, 3, 3, 4, 4, 4, 1, 2, 2, 4]
    assert got[0].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert exact_dedup.duplicate_groups(docs(spark, [])).count() == 0
    twice = docs(spark, ["q", "q"]).union(docs(spark, ["q"])).union(spark.createDataFrame([(None, "q", None, None, None, None)], DOCS))
    assert sorted((r.doc_id is None, r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicate_groups(twice).collect()) == [(False, 0, 4, False), (False, 0, 4, True), (False, 0, 4, True), (True, 0, 4, False)]


def test_op7_compares_bytes_where_hashes_collide(spark):
    texts = ["ab", "a b", "cd", "xyz", "x yz", "zzz", None, "q" * 40, "w" * 40]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.duplicate_groups(docs(spark, texts), hash_of=lambda norm: F.length(norm) % 3).collect()}
    assert got == {0: (1, 2), 1: (1, 2), 2: (2, 1), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (6, 1), 7: (7, 1), 8: (8, 1)}


def test_ids_of_any_type(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "z")], "doc_id string, text string")
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.duplicate_groups(df).collect()) == [("a", "b", False), ("b", "b", True), ("c", "c", True)]
    assert sorted(r.doc_id for r in exact_dedup.drop_duplicates(df).collect()) == ["b", "c"]


def test_an_id_with_several_texts_loses_none_that_has_no_copy(spark):
    long = " ".join(f"w{i}" for i in range(200))
    near = long.replace("w77 ", "w77 more ")
    rows = [(1, "A B"), (5, "A B"), (5, "other text"), (5, "other text"), (None, "A B"), (None, "alone"), (7, long), (8, near), (8, "not near"), (7, near)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    want = sorted([(1, "A B"), (5, "other text"), (None, "alone"), (7, long), (8, "not near"), (7, near)], key=str)
    assert key(exact_dedup.drop_duplicates(df)) == want
    first = min(long, near, key=lambda t: hashlib.sha256(t.encode()).digest())
    for one in (simhash.keep_one(df, shingle_words=5, max_bits=15), simhash.keep_one_similar(df)):
        assert key(one) == sorted([x for x in want if x[1] not in (long, near)] + [(7, first)], key=str)


def test_directory_doubles_where_it_must():
    rng = np.random.default_rng(0)
    counts = {int(p): int(n) for p, n in zip(rng.choice(256, 90, False), rng.integers(1, 50, 90))} | {7: 5000}
    directory = exact_dedup.build_directory(counts, 200, max_depth=8)
    assert len(directory) == 256 and directory == sorted(directory)
    sizes = {}
    for slot, b in enumerate(directory):
        sizes[b] = sizes.get(b, 0) + counts.get(slot, 0)
    assert all(n <= 200 or b == 7 for b, n in sizes.items()) and len(sizes) > 4
    assert set(exact_dedup.build_directory({3: 5}, 10, max_depth=8)) == {0}


def test_op3_against_sql(spark, sf, duck, same_rows):
    same_rows(queries.op3_topk(spark, sf).toPandas(), duck.execute(queries.ORACLE_SQL["op3_topk"]).df())


@pytest.mark.parametrize("spread", [1.0, 1e6])
def test_op3_ties_bad_rows_and_blocks(spark, spread):
    rng = np.random.default_rng(3)
    base = np.round(rng.normal(size=(40, 16)), 1) * spread
    rows = [(i, [float(x) for x in base[i % 40]], "clash") for i in range(400)]
    rows += [(1000, None, ""), (1001, [None] * 16, ""), (1002, [float("nan")] * 16, ""), (1003, [float("inf")] * 16, ""), (1004, [1.0, 2.0], ""), (1005, [3.0, 4.0], "")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    q = df.where("vec_id % 50 = 0 or vec_id > 999")
    got = [tuple(r) for r in topk.top_k(df, q, k=7, query_rows=4, candidate_rows=90).orderBy("query_id", "rank").collect()]
    v = {i: [int(np.floor(64 * x)) for x in e] for i, e, _ in rows if e and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for i in sorted(k for k in v if k % 50 == 0 or k > 999):
        best = sorted((-sum(a * b for a, b in zip(v[i], w)), j) for j, w in v.items() if j != i and len(w) == len(v[i]))[:7]
        want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert got == want
    assert topk.top_k(df.limit(0), q.limit(0)).count() == 0
    again = [tuple(r) for r in topk.top_k(df, q.union(q), k=7).orderBy("query_id", "rank").collect()]
    assert again == want


def test_op3_own_rows_are_no_candidates_however_many(spark):
    rng = np.random.default_rng(4)
    own = [(7, [1.0] * 8)] * 2040
    rows = own + [(100 + i, [float(x) for x in rng.normal(size=8)]) for i in range(58)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert topk.top_k(df, df.where("vec_id = 7"), k=20).count() == 20
    twice = spark.createDataFrame([(1, [1.0, 2.0]), *[(2, [1.0, 1.0])] * 30, (3, [5.0, 5.0])], "vec_id bigint, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(twice, twice.where("vec_id = 1"), k=20).orderBy("rank").collect()] == [3] + [2] * 19


def test_op3_multiplies_only_what_its_bounds_leave(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    v, ids = np.floor(64 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64), np.array([r.vec_id for r in rows])
    q = ids % 20 == 0
    done = []
    real = topk.products
    # Bounds are doubles; exact products of these small numbers are single floats.
    monkeypatch.setattr(topk, "products", lambda a, b, i, j: (done.append(len(i) if a.dtype == np.float32 else 0), real(a, b, i, j))[1])
    who, what, score = topk.search_block(ids[q], v[q], np.full(q.sum(), -np.inf), ids, v, 20)
    pairs = q.sum() * (len(ids) - 1)
    assert sum(done) == pairs  # one batch: nothing is known before it
    done.clear()
    floor = np.array([np.sort(score[who == i])[0] for i in ids[q]], float)
    again = topk.search_block(ids[q], v[q], floor, ids, v, 20)
    assert {x for x in zip(*map(tuple, again))} == {x for x in zip(who, what, score)}
    assert 0 < sum(done) < 0.7 * pairs


def test_op3_cells_leave_out_what_cannot_reach_the_floor(spark):
    """Clustered vectors: queries are sent to few of the cells, and the results are those of all pairs."""
    rng = np.random.default_rng(6)
    centres = rng.choice([-4.0, 4.0], (6, 8)).repeat(4, axis=1)
    v = centres[np.arange(600) % 6] + rng.normal(size=(600, 32)) / 4
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k=5, query_rows=8, candidate_rows=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    w = np.floor(64 * v).astype(int)
    s = w @ w.T
    for i in range(0, 600, 20):
        best = sorted((-s[i, j], j) for j in range(600) if j != i)[:5]
        assert sorted(got[i]) == [(r, j, -x) for r, (x, j) in enumerate(best, 1)]


def test_op3_ships_candidates_to_the_blocks_that_need_them(spark, monkeypatch):
    rng = np.random.default_rng(4)
    corners = np.array([[(1 if (k >> b) & 1 else -1) * 4.0 for b in range(3)] for k in range(8)]).repeat(8, axis=1)
    x = corners[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 24)) * 0.1
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    seen, real = [], topk.in_blocks
    monkeypatch.setattr(topk, "in_blocks", lambda q, c, cells, n: seen.append(real(q, c, cells, n)) or seen[-1])
    got = topk.top_k(df, df.where("vec_id % 5 = 0"), k=5, query_rows=40, candidate_rows=250)
    v = np.floor(x * 64).astype(np.int64)
    want = {i: [int(j) for j in sorted((j for j in range(2000) if j != i), key=lambda j: (-(v[i] @ v[j]), j))[:5]] for i in range(0, 2000, 100)}
    rows = {}
    for r in got.orderBy("query_id", "rank").collect():
        rows.setdefault(r.query_id, []).append(r.vec_id)
    assert {i: rows[i] for i in want} == want and len(rows) == 400
    (q, c), blocks = seen[0], -(-400 // 40)
    assert c.count() < 0.25 * 2000 * blocks and q.select("cell", "part", "qb").distinct().count() == c.select("cell", "part", "qb").distinct().count()
