"""Near copies of a known similarity, against exact Jaccard of all pairs."""

import numpy as np
from test_pairs_and_copies import docs

import corpus_pipeline as cp


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def planted(rng, n_words, least):
    """A text and a copy of it, edited word by word until one more edit would take them under the similarity."""
    words = [f"w{x}" for x in rng.integers(0, 1 << 40, n_words)]
    text, copy = " ".join(words), words[:]
    while True:
        longer = copy[:]
        longer[int(rng.integers(n_words))] = f"e{rng.integers(1 << 40)}"
        if jaccard(text, " ".join(longer)) < least:
            return text, " ".join(copy)
        copy = longer


def test_pipeline_near_copies_of_known_similarity(spark, sf):
    rng = np.random.default_rng(8)
    texts, levels = [], (0.8, 0.85, 0.9, 0.95)
    for least in levels:
        for _ in range(50):
            texts += planted(rng, int(rng.integers(120, 400)), least)
    # Pairs under the rule's similarity: never links, however near their fingerprints are.
    for _ in range(50):
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 200)]
        texts += [" ".join(words), " ".join(words[:150] + [f"e{x}" for x in rng.integers(0, 1 << 40, 50)])]
    kept = {r.doc_id for r in cp.without_near_copies(spark, docs(spark, texts), sf).collect()}
    recall = {s: 1 - sum(2 * i + 1 in kept for i in range(50 * k, 50 * k + 50)) / 50 for k, s in enumerate(levels)}
    print(recall)
    assert min(recall.values()) >= 0.94 and recall[0.9] == recall[0.95] == 1
    assert all(2 * i in kept for i in range(250)) and all(2 * i + 1 in kept for i in range(200, 250))


def test_crowded_copies_and_leaves(spark):
    from chainloom.llm import simhash

    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 1 << 40, 150)]
    texts = [None, "", "one two", "ONE  two"]
    for _ in range(120):
        copy = base[:]
        for at in rng.integers(0, 150, 3):
            copy[int(at)] = f"e{rng.integers(1 << 40)}"
        texts.append(" ".join(copy))
    root = list(range(len(texts)))
    root[1], root[3] = 0, 2
    for a in range(4, len(texts)):
        for b in range(4, a):
            if jaccard(texts[a], texts[b]) >= 0.8:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    for how in ({"bucket_rows": 8}, {"bucket_shingles": 1000}, {}):
        got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs(spark, texts), **how).collect()}
        assert got == dict(enumerate(root))
    assert simhash.similar_groups(docs(spark, [])).count() == 0


def test_crowded_buckets_keep_pairs_that_share_one_key(spark):
    from chainloom.llm import simhash

    rng, texts = np.random.default_rng(10), []
    while len(texts) < 8:
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 57)]
        pair = " ".join(words), " ".join(words[:41])
        a, b = (simhash.shingle_set(t, 5) for t in pair)
        shared = [len(np.intersect1d(a[:k], b[:k])) for k in (simhash.KEYS, simhash.SECOND_KEYS)]
        if shared[0] == 1 < shared[1] and (simhash.majority(a) ^ simhash.majority(b)).bit_count() <= simhash.WIDE_BITS:
            texts += pair
    # Every bucket of two rows is crowded.
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(docs(spark, texts), similarity=0.65, bucket_rows=1).collect()}
    assert got == {i: i - i % 2 for i in range(8)}


def test_a_crowded_bucket_compares_what_a_small_one_does(spark):
    """Pairs that share one, two and more of their least hashes: links do not depend on how full the buckets are."""
    from chainloom.llm import simhash

    rng, texts, seen = np.random.default_rng(11), [], {1: 0, 2: 0, 3: 0}
    while min(seen.values()) < 3:
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 57)]
        pair = " ".join(words), " ".join(words[: int(rng.integers(12, 50))])
        a, b = (simhash.shingle_set(t, 5)[: simhash.SECOND_KEYS] for t in pair)
        n = min(3, len(np.intersect1d(a, b)))
        if n and seen[n] < 3:
            seen[n] += 1
            texts += pair
    how = ({}, {"bucket_rows": 1}, {"bucket_shingles": 60})
    small, *crowded = ({r.doc_id: r.component_id for r in simhash.similar_groups(docs(spark, texts), similarity=0.2, **h).collect()} for h in how)
    assert crowded == [small, small] and len(set(small.values())) < len(texts)


def test_one_of_identical_rows_stays(spark, sf):
    from chainloom.llm import exact_dedup, simhash

    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (3, None), (3, ""), (4, "other"), (4, "other"), (None, "x y"), (None, "x y"), (5, "a  b"), (5, "ab"), (6, "a b")]
    table = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, digest string, stays int")
    left = lambda df: sorted((r.doc_id or 0, r.text or "") for r in df.collect())
    exact = cp.without_copies(spark, table, sf)
    assert left(exact) == [(0, "x y"), (1, text), (3, ""), (4, "other"), (5, "a  b")] and exact.columns == table.columns
    near = cp.without_near_copies(spark, table, sf)
    assert left(near) == [(0, "x y"), (1, text), (3, ""), (4, "other"), (5, "a  b"), (5, "ab")]
    both = cp.without_near_copies(spark, materialized(exact), sf)
    assert left(both) == left(exact)
    assert exact_dedup.drop_duplicates(table.limit(0)).count() == simhash.keep_one_similar(table.limit(0)).count() == 0


def materialized(df):
    from chainloom.llm.shared import materialize

    return materialize(df, "test")
