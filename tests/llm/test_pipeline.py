"""The pipeline stage by stage against brute force on its own input."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F
from test_text_models import slow_features, tokens

import corpus_pipeline as cp
from chainloom.llm import mixing, quality, queries
from chainloom.llm.shared import held_out, materialize, table


def slow_firsts(texts):
    """Smallest ids of the groups that pairs of a Jaccard similarity of 0.8 of five-word shingles connect."""
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and root[a] != root[b] and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i for i, r in root.items() if i == r}


def slow_mix(rows, seed=0):
    """How often each id is in the sample: raking by plain loops, then two draws by the hash of the id."""
    cell, tokens = {}, {}
    for r in rows:
        text = r.text or ""
        topic = "table" if " | " in text else "contact" if "@" in text else "licence" if "license" in text.lower() else "prose"
        cell[r.doc_id] = (r.source or "", r.lang or "", topic)
        tokens[cell[r.doc_id]] = tokens.get(cell[r.doc_id], 0) + len(re.findall("[^\x20\x09-\x0d]+", text))
    total = lambda w, m: {v: sum(x for c, x in w.items() if c[m] == v) for v in {c[m] for c in w}}
    targets = []
    for m in range(3):
        t = {v: n**mixing.FLATTEN for v, n in total(tokens, m).items()}
        targets.append({v: x / sum(t.values()) for v, x in t.items()})
    w, rounds = {c: float(n) for c, n in tokens.items()}, 0
    while rounds < mixing.ROUNDS or max(abs(x - targets[m][v]) for m in range(3) for v, x in total(w, m).items()) > mixing.TOLERANCE:
        for m in range(3):
            sums = total(w, m)
            w = {c: x * targets[m][c[m]] / sums[c[m]] if sums[c[m]] else 0.0 for c, x in w.items()}
        rounds += 1
    scale, last = 0.0, -1.0
    while scale != last:
        full = {c for c in w if tokens[c] == 0 or w[c] * scale >= tokens[c]}
        rest = sum(x for c, x in w.items() if c not in full)
        last, scale = scale, max(scale, (mixing.KEEP * sum(tokens.values()) - sum(tokens[c] for c in full)) / rest if rest else scale)
    draw = lambda i, s: int(hashlib.sha256(f"{i}:{s}".encode()).hexdigest()[:13], 16) / 2**52
    out = collections.Counter()
    for i, c in cell.items():
        ratio = w[c] * scale / tokens[c] if tokens[c] else 1.0
        if draw(i, seed) < round(min(ratio, 1.0), 9):
            times = round(max(ratio, 1.0), 6)
            out[i] = int(times) + (draw(i, seed + 1) < times - int(times))
    return out


@pytest.mark.filterwarnings("ignore:margins miss")
def test_nulls_clashes_and_empty_tables(spark, sf, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 2)
    monkeypatch.setattr(mixing, "ROUNDS", 2)
    docs = table(spark, sf, "documents")
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", None, None, None), (1, " ", "en", "s", 1), (2, "x" * 300_000, "en", "s", 1), (None, "y z", "en", None, 1), (None, "y z", "en", None, 1)]
    rows = spark.createDataFrame(odd, docs.schema).union(docs.limit(40)).withColumn("id", F.lit("clash")).withColumn("digest", F.lit(b"x")).withColumn("node", F.lit(1))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == rows.columns and stage(spark, rows.limit(0), sf).count() == 0
        assert out.subtract(rows).isEmpty()
    last = cp.STAGES[-1][1]
    assert last(spark, rows, sf).count() == 47 and last(spark, rows.limit(0), sf).count() == 0
    # A text without a copy stays, whatever other rows have its id.
    assert {r.text for r in cp.without_copies(spark, rows, sf).collect()} >= {"x" * 300_000, "y z"}


def test_stages(spark, sf):
    from tokenizers import Tokenizer

    docs = table(spark, sf, "documents")
    results, before = [], docs
    for name, stage in cp.STAGES:
        before = materialize(stage(spark, before, sf), "stage")
        results.append(before)
    rows = [{r.doc_id: r for r in df.collect()} for df in (docs, *results)]
    assert all(df.columns == docs.columns for df in results[:-1]) and results[-1].count() == results[-2].count() > 0
    labels = table(spark, sf, "labels")
    w = quality.train(docs, labels.where(~held_out(labels.doc_id)))
    score = {i: sum(w[p] * v for p, v in slow_features(r.text).items()) + w[-1] for i, r in rows[0].items()}
    assert set(rows[1]) == {i for i, x in score.items() if x >= 0}
    best = {}
    for i, r in rows[1].items():
        key = re.sub("[\x20\x09-\x0d]", "", r.text)
        best[key] = min(best.get(key, (0, 0)), (-len(r.text), i)) if key in best else (-len(r.text), i)
    assert set(rows[2]) == {i for _, i in best.values()}
    assert set(rows[3]) == slow_firsts({i: r.text for i, r in rows[2].items()})
    assert collections.Counter(r.doc_id for r in results[3].collect()) == slow_mix(rows[3].values())
    t = Tokenizer.from_file(queries.vocabulary())
    assert all(r.ids == tokens(t, rows[4][i].text) for i, r in rows[5].items())
    assert cp.run(spark, sf).count() == results[-1].count()
