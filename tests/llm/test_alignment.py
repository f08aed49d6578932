"""Token alignment against whole-text encoding by both libraries and plain loops."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from chainloom.llm import alignment, queries

A, B = queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "x \n y\t z", "tabs\t\tand\n\nlines \n", "<|endoftext|> and <s> </s> <unk> <0x41>", "under▁score", "▁", "naïve café 日本語 的 \U0001f600‍\U0001f680", "\x00 nul \x1c sep \x85 nel",
    "1234567890 12.50", "a" * 500, "ab " * 300, "don't we'll I'M 's", "x" * 70 + " " + "y" * 70, "trailing newline\n", "a b 　 c", "ﬁ ligature Å K", " lead", "!!!???...", "=" * 200,
]


def groups_of(text, tokens_a, tokens_b):
    """[(A ids, B ids)] of one text, from encodings of the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    t, s = tokens_a or Tokenizer.from_file(A), tokens_b or sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    to_byte = {c: b for b, c in enumerate(alignment.byte_chars())}
    if not text:
        return []
    a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    spell_a = [bytes(to_byte[c] for c in t.id_to_token(i)) for i in a]
    spell_b = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(spell_a) != (" " + text).encode() or b"".join(spell_b) != (" " + text).encode():
        return []
    ends = lambda parts: list(np.cumsum([len(p) for p in parts]))
    out, at = [], (0, 0)
    ea, eb = ends(spell_a), ends(spell_b)
    for end in sorted(set(ea) & set(eb)):
        to = (ea.index(end) + 1, eb.index(end) + 1)
        out.append((a[at[0] : to[0]], b[at[1] : to[1]]))
        at = to
    return out


def slow_align(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    t, s = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    every = [groups_of(x, t, s) for x in texts]
    links = [[(p, q) for x, y in g for p in x for q in y] for g in every]
    count = Counter(p for x in links for p in set(x))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for g, ps in zip(every, links):
        listed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        digest = hashlib.sha256(listed.encode()).hexdigest() if g else ""
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(ps), sum(count[p] == best[p[0]] for p in ps), sum(count[p] for p in ps), digest))
    return out


def rows(df):
    return {r.doc_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("chunk_docs", [3, alignment.CHUNK_DOCS])
def test_odd_texts(spark, chunk_docs):
    texts = ODD + ODD[3:20]
    docs = spark.createDataFrame([(i, x, "n_a", 7) for i, x in enumerate(texts)], "doc_id bigint, text string, bits string, chunk int").repartition(3)
    assert rows(alignment.align(docs, A, B, chunk_docs=chunk_docs)) == dict(enumerate(slow_align(texts)))


def test_op11_against_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], slow_align([r.text for r in docs])))
    assert rows(queries.op11_alignment(spark, sf)) == want


def test_long_text_in_blocks(spark, monkeypatch):
    text = " ".join(f"word{i % 97} says\nit {i}" for i in range(4000))
    monkeypatch.setattr(alignment, "BLOCK", 1000)
    of = alignment.Aligner(A, B)
    chunk = alignment.Chunk(0, of)
    chunk.add(pa.scalar(1), text)
    got = next(chunk.rows(pa.int64())).to_pylist()[0]
    assert tuple(got[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) == (want := slow_align([text])[0])[:4] + want[6:]


def test_repeats_empty_tables_and_other_id_types(spark):
    docs = spark.createDataFrame([("k", "one two"), ("k", "one two"), (None, "two")], "name string, body string")
    got = sorted(tuple(r) for r in alignment.align(docs, A, B, "name", "body").collect() if r.name)
    want = slow_align(["one two", "one two", "two"])
    assert got == [("k", *want[0])] * 2 and got[0][6] == want[0][5]
    assert alignment.align(docs.limit(0), A, B, "name", "body").count() == 0
    assert alignment.align(docs.where("name is null"), A, B, "name", "body").first().name is None


def test_bitmaps_read_back():
    """Lists of places and plain bitmaps give the sums of a plain loop, multiplicities included."""
    rng = np.random.default_rng(3)
    n = 6000
    holds = {code: np.sort(rng.choice(n, size, replace=False)) for code, size in ((5, 1), (6, 511), (7, 512), (8, 3000), (9, 6000))}
    links = {code: rng.integers(1, 40, len(p)) for code, p in holds.items()}
    code = np.repeat(list(holds), [len(p) for p in holds.values()])
    pos, times = np.concatenate(list(holds.values())), np.concatenate(list(links.values()))
    batches, kinds = [], {"chunk": pa.int64(), "plane": pa.int32(), "n": pa.int64(), "best": pa.bool_(), "bits": pa.binary()}
    for plane in range(1 + int((times - 1).max()).bit_length()):
        here = slice(None) if plane == 0 else ((times - 1) >> (plane - 1) & 1).astype(bool)
        for c, size, bits in alignment.bitmaps(code[here], pos[here]):
            if plane == 0:
                assert dict(zip(c, size)).items() <= {k: len(p) for k, p in holds.items()}.items()
            batches.append(pa.RecordBatch.from_arrays([pa.array(x, k) if name != "bits" else bits for (name, k), x in zip(kinds.items(), ([9] * len(c), [plane] * len(c), [10 * int(x) for x in c], [int(x) == 8 for x in c], None))], names=list(kinds)))
    (got,) = alignment.handed_out(iter(batches))
    count, best = np.zeros(n, int), np.zeros(n, int)
    np.add.at(count, pos, 10 * code * times)
    np.add.at(best, pos[code == 8], times[code == 8])
    assert got.column("count_sum").to_pylist() == count.tolist() and got.column("n_best").to_pylist() == best.tolist()


def test_counts_too_large_to_pack():
    code, pos, n = np.array([3, 1, 3], np.uint32), np.array([4, 5, 4]), np.array([1 << 20, 2, 5])
    keys, sums = alignment.sorted_counts(code, pos, n)
    assert keys.tolist() == [1 << 13 | 5, 3 << 13 | 4] and sums.tolist() == [2, (1 << 20) + 5]
