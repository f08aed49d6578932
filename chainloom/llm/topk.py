"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into segments; with the mean and the deviation of each segment of the query and of a candidate, the inner
product of the two is at most the sum over segments of w (mean * mean + deviation * deviation) - which, by
|q - x|^2 = |q|^2 + |x|^2 - 2 q.x, is a lower bound of their distance. Bounds go from few segments to many; a pair whose bound
is under the query's k-th best score so far at any resolution is left, and only survivors get their exact product.

Every query starts with a threshold from a bounded sample of candidates, which all blocks share. Candidates are dealt to cells
by the signs of their segments' means; the range of a cell's statistics bounds the scores of all its members, so queries are
sent to those cells alone that may hold one of their best. A cell's candidates and the queries sent to it are cut into blocks; a
task has one block of candidates and one of queries, and returns what may be among the k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.llm.shared import materialize

#: Rows of a block of queries and of a block of candidates.
QUERY_ROWS, CANDIDATE_ROWS = 8192, 32768
#: Queries and candidates that are bounded together in a task, and pairs that are multiplied at once.
QUERY_BATCH, BATCH, PAIRS = 1024, 2048, 1 << 16
#: Candidates from which the first thresholds come, and segments by whose signs cells are made, at most.
SEEDS, SIGNS = 1024, 8


def quantised(vectors: DataFrame, id_col: str, vec_col: str, factor: float, *more: Column) -> DataFrame:
    """(id, v, more columns): floor(factor * component) as whole numbers; vectors with nulls, NaN or infinities, or null, take no part."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(v.isNotNull() & F.col(id_col).isNotNull()).where(finite)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("bigint")).alias("v"), *more)


def edges_of(d: int, segments: int) -> np.ndarray:
    return np.linspace(0, d, segments + 1).astype(int)


def segment_stats(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each of the segments, both times the root of its length."""
    edges = edges_of(x.shape[1], segments)
    w = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / w
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / w
    return mean * np.sqrt(w), np.sqrt(np.maximum(square - mean * mean, 0)) * np.sqrt(w)


def resolutions(d: int) -> list[int]:
    """Numbers of segments, coarse to fine: every second power of two, and half of the components."""
    return sorted({2**r for r in range(0, 16, 2) if 2**r <= d // 2} | ({d // 2} if d >= 2 else set()))


def largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max(initial=0))


def products(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs of rows."""
    return np.einsum("ij,ij->i", q[i], c[j])


def in_parts(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """products() of some pairs at a time."""
    return np.concatenate([products(q, c, i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS)] or [np.zeros(0, q.dtype)])


def best_of(who: np.ndarray, what: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each who, ties to the smaller what; by who, then rank."""
    order = np.lexsort((what, ~score, who))  # ~ turns the order of whole numbers around, and cannot overflow
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(who)), bool), np.diff(who[order]) != 0)))
    rank = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
    return order[rank < k]


def search_block(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of the candidates that may be among the k best of each query; qid has no repeats.

    floor: a score that k candidates of each query are known to reach, or -inf. Products that floats hold exactly are computed
    as floats, others as 64-bit whole numbers.
    """
    d = q.shape[1]
    big = max(largest(q) * largest(c) * max(d, 1), 1.0)
    exact = np.float32 if big < 2**24 else np.float64 if big < 2**53 else np.int64
    # Single floats bound the many pairs of a matrix product, doubles the few that are left; each with the slack of its rounding.
    slack, wide_slack = 1e-9 * big + 1e-6, 1e-5 * big + 1e-6
    fq, fc, qe, ce = q.astype(np.float64), c.astype(np.float64), q.astype(exact), c.astype(exact)
    stats = [(np.hstack(segment_stats(fq, s)), np.hstack(segment_stats(fc, s))) for s in resolutions(d)]
    kind = np.float32 if big < 1e30 else np.float64  # larger sums would overflow single floats
    single = [(qs.astype(kind), cs.astype(kind)) for qs, cs in stats]
    floor = floor.copy()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(qid), QUERY_BATCH):
        rows = np.arange(lo, min(lo + QUERY_BATCH, len(qid)))
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for at in range(0, len(cid), BATCH):
            columns = slice(at, min(at + BATCH, len(cid)))
            alive, pairs = qid[rows][:, None] != cid[columns], None  # a query's own rows are no candidates of it
            known = np.isfinite(floor[rows]).any()
            for (qs, cs), (q1, c1) in zip(stats, single) if known else ():
                if pairs is None and np.count_nonzero(alive) * 4 > alive.size:
                    alive &= q1[rows] @ c1[columns].T >= (floor[rows] - wide_slack).astype(kind)[:, None]
                    continue
                i, j = pairs or (x + y for x, y in zip(np.nonzero(alive), (lo, at)))
                may = in_parts(qs, cs, i, j) + slack >= floor[i]
                pairs = i[may], j[may]
            i, j = pairs or (x + y for x, y in zip(np.nonzero(alive), (lo, at)))
            score = in_parts(qe, ce, i, j).astype(np.int64)
            may = score >= floor[i]
            best = tuple(np.concatenate(x) for x in zip(best, (i[may], cid[j[may]], score[may])))
            kept = best_of(*best, k)
            best = tuple(x[kept] for x in best)
            full = np.flatnonzero(np.bincount(best[0] - lo, minlength=len(rows)) == k) + lo
            last = np.searchsorted(best[0], full, side="right") - 1
            floor[full] = np.maximum(floor[full], best[2][last])
        out.append(best)
    who, what, score = (np.concatenate(x) for x in zip(*out))
    return qid[who], what, score


def as_matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def with_floor(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """queries with floor: the k-th best score among at most SEEDS candidates, those of the smallest hash of their id; null
    where fewer than k of them can be compared."""
    rows = candidates.orderBy(F.xxhash64("id"), "id", "v").limit(SEEDS).select("id", "v", "d").collect()
    by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r.d for r in rows}:
        mine = [r for r in rows if r.d == d]
        by[d] = np.array([r.id for r in mine], np.int64), np.array([r.v for r in mine], np.int64).reshape(len(mine), d)
    sent = queries.sparkSession.sparkContext.broadcast(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes = b.column("id").to_numpy(), b.column("d").to_numpy()
            floors: list[float | None] = [None] * b.num_rows
            for d in set(sizes.tolist()) & set(sent.value):
                at = np.flatnonzero(sizes == d)
                who, _, score = search_block(ids[at], as_matrix(b.column("v").take(pa.array(at))), np.full(len(at), -np.inf), *sent.value[d], k)
                least: dict[int, list[int]] = {}
                for i, x in zip(who.tolist(), score.tolist()):
                    least.setdefault(i, []).append(x)
                for row in at:
                    if len(least.get(int(ids[row]), ())) == k:
                        floors[row] = float(min(least[int(ids[row])]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(floors, pa.float64())], names=[*b.schema.names, "floor"])

    return queries.mapInArrow(run, "id bigint, v array<bigint>, d int, floor double")


def segments_of(rows: DataFrame, signs: int) -> DataFrame:
    """rows(v, d) with stats, for each of some segments its mean and deviation, times the root of its length."""

    def one(s: Column) -> Column:
        start = F.floor(F.col("d") * s / signs).cast("int")
        n = F.floor(F.col("d") * (s + 1) / signs).cast("int") - start
        part = F.transform(F.slice("v", start + 1, n), lambda x: x.cast("double"))
        both = F.aggregate(part, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("xx")), lambda a, x: F.struct((a["x"] + x).alias("x"), (a["xx"] + x * x).alias("xx")))
        return F.struct(both["x"].alias("x"), both["xx"].alias("xx"), n.alias("n"))

    sums = F.transform(F.sequence(F.lit(0), F.lit(signs - 1)), one)
    mean = lambda t: F.coalesce(F.try_divide(t["x"], F.sqrt(t["n"].cast("double"))), F.lit(0.0))
    return rows.withColumn("stats", F.transform(sums, lambda t: F.struct(mean(t).alias("m"), F.sqrt(F.greatest(t["xx"] - mean(t) * mean(t), F.lit(0.0))).alias("s"))))


def may_hold(cell: Column, signs: int) -> Column:
    """Whether a cell's ranges of statistics allow a member that reaches the query's floor."""

    def term(s: Column) -> Column:
        q = F.get(F.col("stats"), s)
        t = F.greatest(q["m"] * F.get(cell["lo"], s), q["m"] * F.get(cell["hi"], s)) + q["s"] * F.get(cell["dev"], s)
        return t + F.abs(t) * 1e-9 + 1e-6

    bound = F.aggregate(F.sequence(F.lit(0), F.lit(signs - 1)), F.lit(0.0), lambda a, s: a + term(s))
    return F.col("floor").isNull() | (bound >= F.col("floor"))


def in_blocks(q: DataFrame, c: DataFrame, cells: DataFrame, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """q(id, v, d, floor, cell), a written table, and c(id, v, copies, d, cell) dealt to (d, cell, part, qb). A cell's queries are cut
    into blocks, and its candidates go to those alone; a cell that no query may need is left out. cells: (d, cell, parts)."""
    sizes = q.groupBy("d", "cell").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("blocks")).join(cells, ["d", "cell"])
    sizes = F.broadcast(materialize(sizes, "topk-blocks"))  # a row a cell, of which there are few for each length of vectors
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = q.join(sizes, ["d", "cell"]).withColumn("qb", spread("blocks")).select("id", "v", "d", "floor", "cell", "qb", every("parts").alias("part"))
    return queries, c.join(sizes, ["d", "cell"]).withColumn("part", spread("parts")).select("id", "v", "copies", "d", "cell", "part", every("blocks").alias("qb"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", factor: float = 64.0, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k highest inner products with other rows of vectors.

    A row is no candidate of a query with its id. Of query rows that share an id the one with the smallest vector counts;
    candidate rows count one by one. Null ids take no part. Only vectors of one length are compared, vectors of length 0 give
    no results. All candidates are returned where there are fewer than k. Products beyond 64 bits wrap.
    """
    # Of rows that repeat an id and a vector k are enough: they are dealt as one.
    c = quantised(vectors, id_col, vec_col, factor).groupBy("id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    c = c.withColumn("d", F.size("v")).where("d > 0")
    q = quantised(queries, id_col, vec_col, factor).groupBy("id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))
    c = materialize(c, "topk-candidates")
    n_c = c.count()
    signs = min(SIGNS, max(1, (n_c // candidate_rows).bit_length()))
    c = segments_of(c, signs)
    bits = F.transform("stats", lambda t, s: F.when(t["m"] >= 0, F.pow(F.lit(2), s)).otherwise(0).cast("int"))
    c = c.withColumn("cell", F.aggregate(bits, F.lit(0), lambda a, x: a + x))
    c = materialize(c, "topk-cells")
    q = segments_of(with_floor(q, c, k), signs)

    each = [F.get(F.col("stats"), F.lit(s)) for s in range(signs)]
    ranges = [F.array(*(f(t[x]) for t in each)).alias(name) for name, f, x in (("lo", F.min, "m"), ("hi", F.max, "m"), ("dev", F.max, "s"))]
    cells = c.groupBy("d", "cell").agg(F.ceil(F.count(F.lit(1)) / candidate_rows).cast("int").alias("parts"), *ranges)
    # At most 2**SIGNS cells for each length of vectors: one row a length.
    cells = materialize(cells.groupBy("d").agg(F.collect_list(F.struct("cell", "parts", "lo", "hi", "dev")).alias("cells")), "topk-ranges")
    q = q.join(cells, "d").withColumn("to", F.explode(F.filter("cells", lambda x: may_hold(x, signs)))).select("id", "v", "d", "floor", F.col("to.cell").alias("cell"))
    q = materialize(q, "topk-queries")
    q, c = in_blocks(q, c, cells.select("d", F.inline("cells")).select("d", "cell", "parts"), query_rows)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        matrix = lambda t: as_matrix(t.column("v").combine_chunks() if t.column("v").num_chunks == 1 else pa.concat_arrays(t.column("v").chunks))
        floor = np.nan_to_num(left.column("floor").to_numpy().astype(np.float64), nan=-np.inf)
        times = right.column("copies").to_numpy()
        ids, rows = np.repeat(right.column("id").to_numpy(), times), np.repeat(matrix(right), times, axis=0)
        return pa.table(list(search_block(left.column("id").to_numpy(), matrix(left), floor, ids, rows, k)), names=names)

    keys = ("d", "cell", "part", "qb")
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(block, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
