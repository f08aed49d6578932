"""Language identification and quality on the held-out fold; BPE against its library; mixing against a plain loop."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from chainloom.llm import bpe, langid, mixing, quality, queries
from chainloom.llm.shared import held_out

BIG = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, score string, w int"
ODD = [None, "", " \n\t", "123 456 !?", "x", "The word that this is of the and with", "y" * 700_000, "ab " * 300_000, "<|endoftext|>", "a<|endoftext|>b", "İßŁ \U0001d51e 中文", "don't we'll  \n\n  x"]


def odd(spark):
    return spark.createDataFrame([(i, t, "en", None, "s", 1) for i, t in enumerate(ODD)] + [(None, "x", None, None, None, None), (5, ODD[5], "en", None, "s", 1)], DOCS)


def test_op4_held_out_accuracy(spark):
    got = queries.op4_langid(spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_op4_edges(spark):
    docs = odd(spark)
    learned = langid.prototypes(spark.read.parquet(f"{BIG}/documents.parquet"))
    got = langid.identify(docs, learned).toPandas()
    assert len(got) == len(ODD) + 2
    by = got[got.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert (by.lang_pred.loc[[0, 1, 2, 3]] == "und").all() and (by.score.loc[[0, 1, 2, 3]] == 0).all() and by.lang_pred.loc[5] == "en"
    assert (got[got.doc_id == 5].score.nunique()) == 1
    none = langid.identify(docs, langid.prototypes(docs.limit(0))).toPandas()
    assert (none.lang_pred == "und").all()


def test_vectors_bind_and_bundle():
    v = langid.bundles(["abab", "ab"], [0, 1], 2)
    letter = langid.letter_vector
    ab = letter(0, 2) * letter(97, 1) * letter(98, 0)
    end = letter(97, 2) * letter(98, 1) * letter(0, 0)
    assert (v[1] == ab.astype(int) + end).all()
    assert (langid.bundles(["abab", "ab"], [0, 0], 1)[0] == v.sum(0)).all()


def test_op5_held_out_accuracy(spark):
    got = queries.op5_quality(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.93
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_op5_edges(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None), (4, 7), (5, 1)], "doc_id bigint, quality int")
    w = quality.train(docs, labels)
    got = quality.score(docs, w).toPandas()
    assert len(got) == len(ODD) + 2 and got.score.between(0, 1).all()
    assert got[got.doc_id == 0].score.item() == got[got.doc_id == 1].score.item()
    assert not quality.train(docs.limit(0), labels).any() and not quality.train(docs, labels.limit(0)).any()
    kept = quality.keep_good(docs, np.append(np.zeros(quality.PLACES), 1.0))
    assert kept.schema == docs.schema and kept.count() == len(ODD) + 2


LONG = ["some Words, and MORE words!! " * 50, "a1!é中" * 40, "wörd\tand\u3000more" * 30, "x" * 200 + " " + "y" * 90]


def test_blocks_of_long_texts_do_not_change_features(monkeypatch):
    huge = "ab" * 1_500_000
    for text in (*LONG, huge, huge + " " + "Word " * 300_000):
        monkeypatch.setattr(quality, "BLOCK", 1 << 20)
        cut = quality.features(text)
        monkeypatch.setattr(quality, "BLOCK", 1 << 30)
        whole = quality.features(text)
        assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
        if len(text) < 10_000:
            monkeypatch.setattr(quality, "BLOCK", 37)
            cut = quality.features(text)
            assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_blocks_of_long_texts_do_not_change_bundles(monkeypatch):
    huge = "".join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x4E40, 1_500_000))) * 2
    for text in (*LONG, "  a   b!!c " * 60, "ΑΣ ΑΣΑ" * 50, "\t".join("some words with tabs alone".split() * 99), huge):
        monkeypatch.setattr(langid, "BLOCK", 1 << 19)
        cut = langid.bundles([text], [0], 1)
        monkeypatch.setattr(langid, "BLOCK", 1 << 30)
        whole = langid.bundles([text], [0], 1)
        assert (cut == whole).all() and whole.any()
        if len(text) < 10_000:
            monkeypatch.setattr(langid, "BLOCK", 7)
            assert (langid.bundles([text], [0], 1) == whole).all()


def slow_bundle(text):
    out, letters = np.zeros(langid.DIM, np.int64), [0]
    for c in f" {(text or '').lower()} ":
        code = ord(c) if c.isalpha() else 0
        if code or letters[-1]:
            letters.append(code)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            out += langid.letter_vector(a, 2).astype(np.int64) * langid.letter_vector(b, 1) * langid.letter_vector(c, 0)
    return out


def test_op4_predictions_against_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    vectors = {r.doc_id: slow_bundle(r.text) for r in docs}
    sums = {}
    for r in docs:
        if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            sums[r.lang] = sums.get(r.lang, 0) + vectors[r.doc_id]
    for r in queries.op4_langid(spark, sf).collect():
        v = vectors[r.doc_id]
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        cosines = {lang: float(v @ p / np.sqrt(float(v @ v) * float(p @ p))) for lang, p in sums.items()}
        assert abs(cosines[r.lang_pred] - max(cosines.values())) < 1e-9 and abs(r.score - max(0, cosines[r.lang_pred])) < 1e-9


def slow_features(text):
    """Counts of places by the rule as the module states it, word by word."""
    words = [4]
    shapes = [0]
    for w in re.findall(r"[^\W_]+|[^\w\s]+|_+", text or ""):
        case = 3 if not w[0].isalnum() else 2 if w.isupper() and len(w) > 1 else 1 if w[0].isupper() else 0
        h = xxhash.xxh64_intdigest(w.lower(), seed=7) >> 2
        shapes.append(5 if h == words[-1] >> 2 else case)
        words.append(h << 2)
    words.append(8)
    shapes.append(5 if words[-1] >> 2 == words[-2] >> 2 else 0)
    h, mix, mask = [w >> 2 for w in words], 0x9E3779B97F4A7C15, 2**64 - 1
    grams = h[1:-1] + [(a * 31 + b + 1000) & mask for a, b in zip(shapes[1:], shapes[2:])] + [((a * mix) & mask) ^ b for a, b in zip(h, h[1:])]
    counts = {}
    for g in grams:
        place = ((g * mix) & mask) >> 46
        counts[place] = counts.get(place, 0) + 1
    size = math.sqrt(sum(counts.values()))
    return {p: math.sqrt(n) / size for p, n in counts.items()}


def test_op5_weights_and_scores_against_plain_loops(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    hashed = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "xxhash64(doc_id)").collect()}
    features = {i: slow_features(t) for i, t in texts.items()}
    bias, mean = quality.PLACES, {}
    for learner in range(quality.LEARNERS):
        z, n = {}, {}
        weight = lambda p: 0.0 if abs(z.get(p, 0.0)) <= quality.L1 else -(z[p] - math.copysign(quality.L1, z[p])) / ((quality.BETA + math.sqrt(n[p])) / quality.ALPHA + quality.L2)  # noqa: E731, B023
        mine = sorted((hashed[i], labels[i], i) for i in labels if i in texts and texts[i] is not None and hashed[i] % quality.LEARNERS == learner)
        for _, y, i in mine * quality.PASSES:
            x = {**features[i], bias: 1.0}
            w = {p: weight(p) for p in x}
            g = 1 / (1 + math.exp(-sum(w[p] * v for p, v in x.items()))) - y
            for p, v in x.items():
                sigma = (math.sqrt(n.get(p, 0.0) + (g * v) ** 2) - math.sqrt(n.get(p, 0.0))) / quality.ALPHA
                z[p] = z.get(p, 0.0) + g * v - sigma * w[p]
                n[p] = n.get(p, 0.0) + (g * v) ** 2
        for p in n:
            mean[p] = mean.get(p, 0.0) + weight(p) / quality.LEARNERS
    docs, table = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.train(docs, table.where(~held_out(table.doc_id)))
    assert {p for p in range(len(got)) if abs(got[p]) > 1e-4} <= set(mean) and all(abs(got[p] - w) < 1e-4 for p, w in mean.items())
    for r in queries.op5_quality(spark, sf).collect():
        s = sum(mean.get(p, 0.0) * v for p, v in features[r.doc_id].items()) + mean[bias]
        assert abs(r.score - 1 / (1 + math.exp(-s))) < 1e-3


def test_op5_clashing_labels_and_repeated_rows_teach_once(spark):
    rows = [(i, f"text {i} " + ("good fine" if i % 2 else "BAD!!"), "en", "s", "", 0) for i in range(40)]
    labels = [(i, i % 2) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    table = lambda x: spark.createDataFrame(x, "doc_id bigint, quality int")
    want = quality.train(docs.where("doc_id not in (3, 4)"), table(labels))
    assert np.allclose(want, quality.train(docs, table(labels + [(3, 0), (4, 1), (4, 0)])))
    assert np.allclose(want, quality.train(docs.where("doc_id not in (3, 4)").union(docs.where("doc_id in (7, 8)")), table(labels + labels)))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def tokens(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_op8_whole_table(spark, sf, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op8_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = tokens(tokenizer, texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op8_edges(spark, tokenizer):
    path = queries.vocabulary()
    got = bpe.decode(bpe.encode(odd(spark), path), path).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = "x" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.ids == tokens(tokenizer, text) and r.decoded == text
    broken = spark.createDataFrame([(1, [220, 447]), (2, None), (3, []), (4, [241, 447])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(broken, path).collect()} == {i: tokenizer.decode(x, skip_special_tokens=False) for i, x in ((1, [220, 447]), (2, []), (3, []), (4, [241, 447]))}


def test_op8_random_pieces(tokenizer):
    c, rng = bpe.codec(queries.vocabulary()), np.random.default_rng(5)
    texts = ["".join(rng.choice(list("aabcdeeinst 'sA1.\né"), rng.integers(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, c.encode(texts)):
        assert ids.tolist() == tokens(tokenizer, text), text


def test_op9_against_sql(spark, sf, duck, same_rows):
    same_rows(queries.op9_mixing(spark, sf).toPandas(), duck.execute(queries.ORACLE_SQL["op9_mixing"]).df())


def test_op9_margins_hold(spark):
    rng = np.random.default_rng(2)
    rows = [(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(50, 5000))) for a in range(5) for b in range(3) for c in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens bigint")
    targets = {k: spark.createDataFrame(list(t.items()), f"{k} string, target double") for k, t in (("source", {f"s{i}": 1.0 + i for i in range(5)}), ("lang", {"l0": 1.0, "l1": 1.0, "l2": 2.0}), ("topic", {"t0": 3.0, "t1": 1.0}))}
    got = mixing.fit_cells(cells, targets, rounds=20).toPandas()
    total = got.weight.sum()
    assert np.allclose(got.groupby("source").weight.sum() / total, [i / 15 for i in range(1, 6)], rtol=1e-6)
    assert np.allclose(got.groupby("lang").weight.sum() / total, [0.25, 0.25, 0.5], rtol=1e-6)
    assert np.allclose(got.groupby("topic").weight.sum() / total, [0.75, 0.25], rtol=1e-6)


def test_op9_edges(spark):
    few = {"rounds": 2, "tolerance": None}
    got = mixing.mix(odd(spark), **few).toPandas()
    assert len(got) == len(ODD) + 2 and got.probability.between(0, 1).all()
    assert mixing.mix(odd(spark).limit(0)).count() == 0
    assert mixing.sample(odd(spark), **few).columns == odd(spark).columns
    assert mixing.mix(spark.createDataFrame([(1, " ", "en", "s", "", 0)], DOCS), **few).first().kept
