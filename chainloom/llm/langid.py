"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1. The vector of an n-gram binds the vectors of its letters, each rotated
by its place; a document bundles (adds) the vectors of its n-grams, and a language's prototype bundles its documents. The
language of a document is that of the prototype with the largest cosine. White space and other characters that are not
letters end words; a word's border takes part in its n-grams as one more letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import small_batches

#: Letters of an n-gram (an odd number), length of the vectors, and what they are drawn from.
N, DIM, SEED = 3, 1024, 20
#: Code points of text handled at once.
BLOCK = 1 << 19


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 16)
def letter_vector(code: int, place: int, dim: int = DIM) -> np.ndarray:
    """The letter's random vector of +1 and -1, rotated by its place in the n-gram; code 0 is the border of a word."""
    bits = np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, dim, np.int8)
    return np.roll(2 * bits - 1, place)


def codes_of(text: str) -> np.ndarray:
    """The text's code points, with 0 for each that is no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(letter_table()[codes], codes, 0)


def merged(codes: np.ndarray) -> np.ndarray:
    """Which code points to keep, so that between words there is one border."""
    return np.concatenate((np.ones(min(1, len(codes)), bool), (codes[1:] != 0) | (codes[:-1] != 0)))


def grams(codes: np.ndarray, group: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of letters and borders, added up by group number: the distinct n-grams' vectors, and (group, n-gram, count).

    An n-gram counts if its middle is a letter, so those that reach over a border into another text do not.
    """
    alphabet = np.flatnonzero(np.bincount(codes, minlength=1))
    a = len(alphabet) + (0 if len(alphabet) and alphabet[0] == 0 else 1)
    place = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int64)
    place[alphabet] = np.arange(a - len(alphabet), a)
    letter, n = place[codes], max(0, len(codes) - N + 1)
    key = group[N // 2 : n + N // 2].copy()  # texts share the border between them
    for k in range(N):
        key = key * a + letter[k : n + k]
    key = np.sort(key[letter[N // 2 : n + N // 2] != 0])
    first = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
    counts = np.diff(np.append(first, len(key)))
    who, gram = key[first] // a**N, key[first] % a**N
    kinds, at = np.unique(gram, return_inverse=True)
    vectors = np.ones((len(kinds), dim), np.int8)
    for k in range(N):
        of = np.stack([letter_vector(int(c), N - 1 - k, dim) for c in [0, *alphabet[alphabet > 0]]])
        vectors *= of[kinds // a ** (N - 1 - k) % a]
    return vectors, who, at, counts


def bundles(texts: list[str], groups: list[int], n: int, dim: int = DIM) -> np.ndarray:
    """The sum of the vectors of all n-grams of each of n groups of texts."""
    out = np.zeros((n, dim))
    for vectors, who, at, counts in blocks(texts, groups, dim):
        low, high = (int(who[0]), int(who[-1]) + 1) if len(who) else (0, 0)
        # Blocks of few groups keep this matrix small: all n-grams of a block are counted for the groups it has.
        for start in range(low, high, 64):
            mine = (who >= start) & (who < start + 64)
            here = np.zeros((min(64, high - start), len(vectors)), np.float32)
            here[who[mine] - start, at[mine]] = counts[mine]
            used = here.any(0)
            out[start : start + len(here)] += here[:, used] @ vectors[used].astype(np.float32)
    return out


def blocks(texts: list[str], groups: list[int], dim: int = DIM) -> Iterator[tuple]:
    """grams() of runs of texts of about BLOCK code points. A longer text goes in pieces; each takes over the last letters and
    borders of the piece before it, so every n-gram is found once, as in the uncut text."""
    some, of, size = [], [], 0

    def together() -> tuple:
        codes = codes_of("".join(some))
        keep = merged(codes)
        return grams(codes[keep], np.repeat(np.array(of, np.int64), list(map(len, some)))[keep], dim)

    for text, group in zip(texts, groups):
        lower = f" {text.lower()} "
        if len(lower) > BLOCK:
            held = np.zeros(0, np.uint32)
            for at in range(0, len(lower), BLOCK):
                codes = np.concatenate((held, codes_of(lower[at : at + BLOCK])))
                codes = codes[merged(codes)]
                yield grams(codes, np.full(len(codes), group, np.int64), dim)
                held = codes[-(N - 1) :]
            continue
        some.append(lower)
        of.append(group)
        size += len(lower)
        if size >= BLOCK:
            yield together()
            some, of, size = [], [], 0
    if some:
        yield together()


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> DataFrame:
    """(lang, i, v): the sum of the n-gram vectors of all documents of each language. Null languages and texts teach nothing;
    a repeated row counts each time, and texts of any length count whole.

    Each task adds its documents up and gives one vector a language. Sums are whole numbers, so the order of tasks is of no
    matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            names = sorted(set(langs))
            of = {lang: i for i, lang in enumerate(names)}
            order = sorted(range(len(langs)), key=langs.__getitem__)
            found = bundles([b.column(0)[i].as_py() for i in order], [of[langs[i]] for i in order], len(names), dim)
            for lang, v in zip(names, found):
                sums[lang] = sums.get(lang, 0) + v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.rint(v).astype(np.int64))], names=["lang", "i", "v"])

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, F.col(lang_col).cast("string").alias("lang"))
    return small_batches(known).mapInArrow(run, "lang string, i int, v bigint").groupBy("lang", "i").agg(F.sum("v").alias("v"))


def identify(docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row; `und` and 0 where the text is null or has no letter, or nothing was learned.

    score is the cosine with the chosen prototype, 0 if negative; of equal cosines the first language in order wins. Texts are
    read whole, and repeated rows get equal results. learned has as many numbers a language as its vectors have, and languages
    are as many as people name: that is sent to each task. Other columns of docs are not read.
    """
    rows = learned.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")).select("lang", "v.v").orderBy("lang").collect()
    langs = [r[0] for r in rows]
    table = np.array([r[1] for r in rows], np.float64)
    dim = table.shape[1] if rows else 1
    if rows:
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)
    sent = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = sent.value
        for b in batches:
            v = bundles([t.as_py() or "" for t in b.column(1)], list(range(b.num_rows)), b.num_rows, dim)
            size = np.linalg.norm(v, axis=1)
            names, scores = np.full(b.num_rows, "und", object), np.zeros(b.num_rows)
            if langs:
                cosines = np.round(v @ table.T / np.maximum(size, 1e-300)[:, None], 12)
                has, best = size > 0, cosines.argmax(1)
                names[has] = np.array(langs, object)[best[has]]
                scores[has] = np.clip(cosines[np.arange(len(v)), best], 0, 1)[has]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores)], names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
