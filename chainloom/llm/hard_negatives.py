"""Hard negatives of anchors by rotated one-bit codes with stored alignments.

A vector is rotated at random and coded by the signs of its components: a unit vector c, of which it has the part a.c (a: the
stored alignment) and a rest that is at a right angle to c. The rest is rotated and coded again, LEVELS times, so a vector is a
sum of aligned codes and a last rest of known length. Anchors keep rounded components, cut into bit planes, so that their
products with a code are popcounts. With the codes' part of a vector known, the anchor's product with the whole differs from it
by at most the product of two lengths, that of the last rest and that of the anchor (Cauchy-Schwarz); what the anchor's rounding
adds is bounded likewise. The interval is certain, not likely: a pair is left only if no score within it can count, and what is
left is scored in whole numbers.

There are two passes over blocks of anchors and rows. The first finds each anchor's positives, the best rows of its label; the
second, for each positive, the best rows of other labels whose scores lie in a window below the positive's.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.llm.shared import materialize
from chainloom.llm.topk import as_matrix, best_of, quantised

#: Codes of a vector, and bits of an anchor's rounded components besides the sign.
LEVELS, PLANES = 3, 6
#: Rows of blocks of anchors and of vectors, and how many of each a task compares at once.
ANCHOR_ROWS, VECTOR_ROWS, ANCHOR_BATCH, VECTOR_BATCH = 8192, 32768, 256, 4096
#: Pairs scored at once.
PAIRS = 1 << 16


@lru_cache(maxsize=8)
def rotations(d: int, levels: int) -> list[np.ndarray]:
    """Random rotations of d dimensions, alike in every task."""
    random = np.random.default_rng(20_011 + d)
    return [np.linalg.qr(random.standard_normal((d, d)))[0] for _ in range(levels)]


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    raw = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view(np.uint64)


class Codes:
    """Codes of vectors: for each level the signs, the alignment and the length of what is left then."""

    def __init__(self, x: np.ndarray, levels: int):
        n, d = x.shape
        rest, self.signs, self.aligned, self.left = x.astype(np.float64), [], [], []
        for turn in rotations(d, levels):
            turned = rest @ turn
            positive = turned >= 0
            code = np.where(positive, 1.0, -1.0) / np.sqrt(d)
            along = np.einsum("ij,ij->i", turned, code)
            rest = (turned - along[:, None] * code) @ turn.T
            self.signs.append(words(positive))
            self.aligned.append(along)
            self.left.append(np.sqrt(np.einsum("ij,ij->i", rest, rest)))


class Planes:
    """Anchors in the rotation of each level, with components rounded to steps and cut into bit planes."""

    def __init__(self, q: np.ndarray, levels: int):
        n, d = q.shape
        q = q.astype(np.float64)
        self.root, self.length = np.sqrt(d), np.sqrt(np.einsum("ij,ij->i", q, q))
        self.levels = []
        for turn in rotations(d, levels):
            turned = q @ turn
            step = np.maximum(np.abs(turned).max(axis=1, initial=0), 1e-300) / ((1 << PLANES) - 1)
            whole = np.rint(turned / step[:, None]).astype(np.int64)
            off = turned - whole * step[:, None]
            raised = whole + (1 << PLANES)  # from 1 up, so that all planes count upwards
            planes = [words((raised >> b & 1).astype(bool)) for b in range(PLANES + 1)]
            self.levels.append((planes, whole.sum(axis=1), step, np.sqrt(np.einsum("ij,ij->i", off, off))))

    def product(self, level: int, i: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """Of the rounded anchors i with the codes of a level, by popcounts: over all pairs if i is a column."""
        planes, total, step, _ = self.levels[level]
        dims = int(round(self.root**2))
        ones = np.zeros(np.broadcast_shapes(i.shape, signs.shape[:-1]), np.int64)
        for b, plane in enumerate(planes):
            ones += np.bitwise_count(plane[i] & signs).sum(axis=-1, dtype=np.int64) << b
        # The sum of raised components under ones of the code, less the raise; twice it less the sum of all is the signed sum.
        up = np.bitwise_count(signs).sum(axis=-1, dtype=np.int64)
        return (2 * (ones - (up << PLANES)) - total[i]) * step[i] / np.sqrt(dims)


class Bounds:
    """Intervals of the products of anchors and vectors, narrowed level by level."""

    def __init__(self, q: np.ndarray, c: np.ndarray, levels: int = LEVELS):
        self.levels, self.q, self.c = levels, Planes(q, levels), Codes(c, levels)
        self.slack = 1e-9 * float(self.q.length.max(initial=0)) * float(np.sqrt((c.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)) + 1e-6

    def step(self, level: int, i: np.ndarray, j: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sure, low, high) after one more level; sure: the middle of the interval so far, and the anchors' rounding in it."""
        middle, rounding = sure
        along = self.c.aligned[level][j]
        middle = middle + along * self.q.product(level, i, self.c.signs[level][j])
        rounding = rounding + np.abs(along) * self.q.levels[level][3][i]
        wide = rounding + self.q.length[i] * self.c.left[level][j] + self.slack
        return (middle, rounding), middle - wide, middle + wide

    def narrowed(self, rows: np.ndarray, columns: np.ndarray, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows and columns that are alive and whose interval at each level meets a range of the anchor's; low, high:
        the ranges, some a row."""
        i, j = rows[:, None], columns[None, :]
        sure, least, most = self.step(0, i, j, (0.0, 0.0))
        at = np.nonzero(alive & meets(least[..., None], most[..., None], low[:, None, :], high[:, None, :]))
        sure = sure[0][at], sure[1][at]
        for level in range(1, self.levels):
            sure, least, most = self.step(level, rows[at[0]], columns[at[1]], sure)
            may = meets(least[:, None], most[:, None], low[at[0]], high[at[0]])
            at, sure = (at[0][may], at[1][may]), (sure[0][may], sure[1][may])
        return at


def meets(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether an interval meets one of some ranges."""
    return ((most >= low) & (least <= high)).any(axis=-1)


def scores_of(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows."""
    return np.concatenate([np.einsum("ij,ij->i", q[i[at : at + PAIRS]], c[j[at : at + PAIRS]]) for at in range(0, len(i), PAIRS)] or [np.zeros(0, np.int64)])


def search(q: np.ndarray, c: np.ndarray, may: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's place, range's place, id, score): of each anchor and range the k best vectors within it, ties to smaller ids.

    may(rows, columns) says which pairs count; low and high have the same ranges a row, in whole scores. Once a range has k
    vectors, its lower end rises to the least of their scores.
    """
    bounds, low = Bounds(q, c, levels), low.copy()
    empty = np.zeros(0, np.int64)
    out = []
    for at_q in range(0, len(q), ANCHOR_BATCH):
        rows = np.arange(at_q, min(at_q + ANCHOR_BATCH, len(q)))
        best = (empty, empty, empty)  # (row * ranges + range, id, score)
        for at_c in range(0, len(c), VECTOR_BATCH):
            columns = np.arange(at_c, min(at_c + VECTOR_BATCH, len(c)))
            i, j = bounds.narrowed(rows, columns, may(rows, columns), low[rows], high[rows])
            i, j = rows[i], columns[j]
            score = scores_of(q, c, i, j)
            pair, of_range = np.nonzero((score[:, None] >= low[i]) & (score[:, None] <= high[i]))
            key = i[pair] * low.shape[1] + of_range
            best = tuple(np.concatenate(x) for x in zip(best, (key, ids[j[pair]], score[pair])))
            best = tuple(x[kept] for kept in [best_of(*best, k)] for x in best)
            full = np.flatnonzero(np.bincount(best[0] - at_q * low.shape[1], minlength=len(rows) * low.shape[1]) == k) + at_q * low.shape[1]
            last = np.searchsorted(best[0], full, side="right") - 1
            low.ravel()[full] = np.maximum(low.ravel()[full], best[2][last])
        out.append(best)
    key, found, score = (np.concatenate(x) for x in zip(*out)) if out else (empty, empty, empty)
    return *np.divmod(key, low.shape[1]), found, score


def _blocks(anchors: DataFrame, rows: DataFrame, anchor_rows: int, vector_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to the pairs of a block of anchors and one of vectors, by hashes of their ids and vectors."""
    n_a, n_c = (max(1, -(-t.count() // n)) for t, n in ((anchors, anchor_rows), (rows, vector_rows)))
    spread = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return anchors.withColumn("qb", spread(n_a)).withColumn("cb", every(n_c)), rows.withColumn("cb", spread(n_c)).withColumn("qb", every(n_a))


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _vectors(t: pa.Table) -> np.ndarray:
    return as_matrix(pa.concat_arrays(t.column("v").chunks))


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    factor: float = 256.0, levels: int = LEVELS, anchor_rows: int = ANCHOR_ROWS, vector_rows: int = VECTOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each of the anchors (rows of vectors) its
    first other rows of the same label, and for each of those the first rows of other labels whose scores are at most its own
    and at least share[0] / share[1] of it. Scores are inner products of components floor(factor * x); higher ones come first,
    ties by the smaller id. Positives without negatives have no row.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Only vectors of one length are
    compared, and vectors of length 0 take no part. Of rows that repeat an id the least by label, then vector counts, among
    anchors and among vectors. Fewer rows than asked for are all returned; an empty table gives an empty result. Other columns
    are ignored. Products beyond 64 bits wrap.
    """

    def clean(df: DataFrame) -> DataFrame:
        label = F.col(label_col).alias("label")
        rows = quantised(df.where(F.col(label_col).isNotNull()), id_col, vec_col, factor, label)
        one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("m")).select("id", "m.v", "m.label")
        return one.withColumn("d", F.size("v")).where("d > 0")

    rows, asked = materialize(clean(vectors), "negatives-rows"), materialize(clean(anchors), "negatives-anchors")
    most = np.iinfo(np.int64).max
    empty = pa.array([], pa.int64())
    keys = ("d", "cb", "qb")

    def same_label(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor_id", "positive_id", "positive_score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([empty] * 3, names=names)
        a, c, la, lc = _column(left, "id"), _column(right, "id"), _column(left, "label"), _column(right, "label")
        may = lambda i, j: (la[i][:, None] == lc[j]) & (a[i][:, None] != c[j])
        ends = np.full((len(a), 1), most)
        i, _, found, score = search(_vectors(left), _vectors(right), may, c, -ends, ends, positives, levels)
        return pa.table([a[i], found, score], names=names)

    left, right = _blocks(asked, rows, anchor_rows, vector_rows)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(same_label, "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    # At most `positives` for each anchor.
    listed = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))
    asked = materialize(asked.join(listed, F.col("id") == F.col("anchor_id")).select("id", "v", "label", "d", F.col("p.positive_id").alias("p_id"), F.col("p.positive_score").alias("p_score")), "negatives-positives")

    def other_labels(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([empty] * 5, names=names)
        a, c, la, lc = _column(left, "id"), _column(right, "id"), _column(left, "label"), _column(right, "label")
        may = lambda i, j: la[i][:, None] != lc[j]
        lists = left.column("p_score").to_pylist()
        high = np.full((len(a), positives), -most)  # a range that is not there ends before it starts
        low = np.full((len(a), positives), most)
        for k, scores in enumerate(lists):
            for r, p in enumerate(scores):
                high[k, r], low[k, r] = p, -(-share[0] * p // share[1])
        i, r, negative, score = search(_vectors(left), _vectors(right), may, c, low, high, negatives, levels)
        of = left.column("p_id").to_pylist()
        return pa.table([a[i], pa.array([of[x][y] for x, y in zip(i.tolist(), r.tolist())], pa.int64()), high[i, r], negative, score], names=names)

    left, right = _blocks(asked, rows, anchor_rows, vector_rows)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(other_labels, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
