"""Piecewise hashing: plain-loop fingerprints, neighbours, and what edits do to them."""

import hashlib

import numpy as np
import pytest

from chainloom.llm import fingerprints as fp
from chainloom.llm import queries

M = (1 << 32) - 1


def slow_fingerprint(text):
    raw = text.encode()
    h = []
    for i in range(len(raw)):
        x = 0
        for b in raw[max(0, i - fp.WINDOW + 1) : i + 1]:
            x = (x * 0x9E3779B1 + b + 1) & M
        x ^= x >> 15
        x = x * 0x85EBCA6B & M
        h.append(x ^ x >> 13)
    ends = lambda k: [i for i, x in enumerate(h) if k <= 32 and x & ((1 << k) - 1) == 0]

    def letters(k):
        out, at = "", 0
        for end in [*ends(k), len(h) - 1]:
            if end >= at:
                out += chr(fp.LETTERS[(sum(h[at : end + 1]) & M) * 0x9E3779B1 % (1 << 32) >> 26])
                at = end + 1
        return out

    k = (len(raw) // fp.PIECES).bit_length()
    while len(ends(k)) > fp.MOST:
        k += 1
    while len(ends(k)) < fp.LEAST and k and len(ends(k - 1)) <= fp.MOST:
        k -= 1
    return f"{1 << k}:{letters(k)}:{letters(k + 1)}"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def slow_likeness(a, b):
    if a == b:
        return 1.0
    (s, *x), (t, *y) = a.split(":"), b.split(":")
    alike = lambda p, q: 1 - distance(p, q) / max(len(p), len(q)) if p or q else 1.0
    s, t = int(s), int(t)
    return max(map(alike, x, y)) if s == t else alike(x[0], y[1]) if s == 2 * t else alike(x[1], y[0]) if t == 2 * s else 0.0


def slow_rows(docs):
    """docs: (id, text) in order."""
    out = []
    for k, (i, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        own, changed, following = map(slow_fingerprint, (text, new, after))
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), own, changed, round(slow_likeness(own, changed), 9), round(slow_likeness(own, following), 9)))
    return out


def rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("text", ["", "a", "ab", "é€\U0001f600", "a" * 5000, "one line again\n" * 300, "0123456789" * 7, "x" * 63, "y" * 64])
def test_fingerprint_of_odd_texts(text):
    assert fp.fingerprint(text.encode()) == slow_fingerprint(text)


def test_blocks_do_not_show(monkeypatch):
    text = " ".join(np.random.default_rng(1).choice(["alpha", "beta", "gamma", "delta"], 3000))
    whole = fp.fingerprint(text.encode())
    monkeypatch.setattr(fp, "BLOCK", 100)
    assert fp.fingerprint(text.encode()) == whole


def test_op12_against_loops(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    small = [d for d in docs if len(d[1] or "") < 4000]
    table = spark.createDataFrame(small, "doc_id bigint, text string").repartition(5)
    assert rows(fp.with_next(table)) == sorted(slow_rows(small))
    got = queries.op12_fingerprints(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == [d[0] for d in docs]
    after = {d[0]: docs[(k + 1) % len(docs)][1] or "" for k, d in enumerate(docs)}
    texts = dict(docs)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.edited_sha256 == hashlib.sha256(fp.edited(text, after[r.doc_id]).encode()).hexdigest() and r.n_chars == len(text)
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 400]
    # Half of a text is left in the edited one; the next document is mostly another.
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_edited > r.near_next for r in long]) > 0.9


def test_nulls_ties_repeats_and_extra_columns(spark):
    docs = [(2, "b" * 40, 1), (1, None, 2), (2, "a" * 30, 3), (2, "b" * 40, 4), (None, "no id", 5), (1, "", 6)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, part bigint")
    got = rows(fp.with_next(table.where("doc_id is not null")))
    rest = [(1, ""), (1, "")]
    from pyspark.sql import functions as F

    order = [tuple(r) for r in table.where("doc_id = 2").orderBy(F.xxhash64("text")).select("doc_id", "text").collect()]
    assert got == sorted(slow_rows(rest + order))
    assert [r.doc_id for r in fp.with_next(table).where("n_chars = 5").collect()] == [None]
    assert fp.with_next(table.limit(0)).count() == 0
    single = fp.with_next(table.where("doc_id is null")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"no no").hexdigest()


def test_an_inserted_sentence_moves_few_letters(spark):
    rng = np.random.default_rng(5)
    text = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(2000))
    changed = text[:5000] + " a sentence that was not there before " + text[5000:]
    a, b = fp.fingerprint(text.encode()), fp.fingerprint(changed.encode())
    assert slow_likeness(a, b) > 0.9
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert abs(df.select(fp.likeness(df.a, df.b)).first()[0] - slow_likeness(a, b)) < 1e-12
