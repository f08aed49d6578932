"""Mixing sources to target weights by iterative proportional fitting.

Token counts are added up by cells (source, language, topic). The cells' weights are raked to each target marginal in turn,
again and again, until all hold to a tolerance. A document's probability is its cell's fitted tokens against its tokens, scaled so that a given share
of all tokens is expected to stay, with cells that would need more than all their documents kept whole; those carry a weight
above one instead, and sample() repeats their documents by it. A hash of the id against the probability decides, alike in
every run.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chainloom.llm.shared import discard, join_keyed, materialize

WORDS = "[^\\x20\\x09-\\x0D]+"
#: Least rounds of raking over all margins; the exponent that flattens the margins' own shares into default targets.
ROUNDS, FLATTEN = 16, 0.7
#: Share of all weight by which a margin may miss its target. Margins that contradict each other never hold: raking gives up, with
#: a warning, once so many rounds have not brought the worst of them nearer, or after so many in all.
TOLERANCE, STALLED, MOST_ROUNDS = 1e-6, 6, 200
#: Cells that one task rakes by itself, of some hundred bytes each; and cells of one value of a margin that may meet in one
#: task where there are more in all.
ONE_TASK_CELLS = 1 << 16
WINDOW_CELLS = 1 << 18
#: Share of all tokens that is to stay.
KEEP = 0.8
MARGINS = ("source", "lang", "topic")


def topic(text: Column) -> Column:
    """A coarse topic by the marks in a text: tables, contacts, licences, prose."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(" | "), "table").when(text.contains("@"), "contact").when(F.lower(text).contains("license"), "licence").otherwise("prose")


def uniform(key: Column, seed: int = 0) -> Column:
    """A number from 0 to below 1 by a hash of the key and a seed."""
    return F.conv(F.substring(F.sha2(F.concat(key, F.lit(f":{seed}")), 256), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def draw(id_col: Column, text: Column, seed: int = 0) -> Column:
    """The number that decides on a row: by its id, or by its text where the id is null."""
    return uniform(F.coalesce(id_col.cast("string"), F.sha2(F.coalesce(text, F.lit("")), 256)), seed)


def default_targets(cells: DataFrame, margin: str, flatten: float = FLATTEN) -> DataFrame:
    """(margin, target): the margin's own shares of tokens to the given power, scaled to one in fit_cells()."""
    return cells.groupBy(margin).agg(F.sum("tokens").alias("t")).select(margin, F.pow(F.col("t").cast("double"), F.lit(flatten)).alias("target"))


def residuals(fitted: DataFrame) -> DataFrame:
    """(margin, value, share, target, residual) of cells with weight and <margin>_share: what raking has left of each margin."""
    keys = [c[: -len("_share")] for c in fitted.columns if c.endswith("_share")]
    parts = [fitted.groupBy(F.lit(k).alias("margin"), F.col(k).cast("string").alias("value")).agg(F.sum("weight").alias("share"), F.max(f"{k}_share").alias("target")) for k in keys]
    return reduce(DataFrame.unionByName, parts).withColumn("residual", F.col("share") - F.col("target"))


def _in_margin(cells: DataFrame, margin: str, crowded: set[str]) -> DataFrame:
    """cells with in_margin, the weight of all cells that share the margin's value."""
    if margin in crowded:
        return cells.join(cells.groupBy(margin).agg(F.sum("weight").alias("in_margin")), margin)
    return cells.withColumn("in_margin", F.sum("weight").over(Window.partitionBy(margin)))


class _Progress:
    """Whether raking goes on, from how far the worst margin is from its target after each round."""

    def __init__(self, rounds: int, tolerance: float | None):
        self.rounds, self.tolerance, self.done, self.misses = rounds, tolerance, 0, []

    def asks(self) -> bool:
        """True if the next finished round is one whose worst miss counts."""
        return self.tolerance is not None and self.done + 1 >= self.rounds

    def ends(self, miss: float | None = None) -> bool:
        self.done += 1
        if miss is None:
            return self.done >= self.rounds
        self.misses.append(miss)
        stalled = len(self.misses) > STALLED and miss > 0.99 * self.misses[-1 - STALLED]
        return miss <= self.tolerance or stalled or self.done >= max(self.rounds, MOST_ROUNDS)


def _rake_here(cells: DataFrame, keys: list[str], rounds: int, tolerance: float | None) -> DataFrame:
    """The rounds of fit_cells() in one task; cells are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        weight, progress = t.column("weight").to_numpy().copy(), _Progress(rounds, tolerance)
        codes = {k: np.unique(t.column(k).to_numpy(zero_copy_only=False), return_inverse=True)[1] for k in keys}
        shares = {k: t.column(f"{k}_share").to_numpy() for k in keys}
        in_margin = lambda k: np.bincount(codes[k], weight)[codes[k]]
        missed = lambda: np.max([np.abs(in_margin(k) - shares[k]) for k in keys], axis=0)
        while rounds > 0 or tolerance is not None:
            for k in keys:
                total = in_margin(k)
                weight = np.divide(weight * shares[k], total, out=np.zeros_like(weight), where=total > 0)
            if progress.ends(float(missed().max()) if progress.asks() else None):
                break
        t = t.select([*keys, "tokens"]).append_column("weight", pa.array(weight)).append_column("miss", pa.array(missed()))
        yield from t.combine_chunks().to_batches()

    kinds = T.StructType([cells.schema[c] for c in (*keys, "tokens")]).add("weight", "double").add("miss", "double")
    return cells.coalesce(1).mapInArrow(run, kinds)


def _rake_apart(cells: DataFrame, keys: list[str], rounds: int, tolerance: float | None) -> DataFrame:
    """The rounds of fit_cells() as steps over all tasks, written every second round; cells is a written table."""
    crowded = {k for k in keys if not cells.groupBy(k).count().where(F.col("count") > WINDOW_CELLS).isEmpty()}
    shares = [f"{k}_share" for k in keys]
    out, written, progress = cells, None, _Progress(rounds, tolerance)
    while rounds > 0 or tolerance is not None:
        for k in keys:
            weight = F.when(F.col("in_margin") > 0, F.col("weight") * F.col(f"{k}_share") / F.col("in_margin")).otherwise(0.0)
            out = _in_margin(out, k, crowded).select(*keys, "tokens", weight.alias("weight"), *shares)
        if progress.done % 2 == 0 and not crowded and progress.done + 1 < rounds:
            progress.ends()
            continue
        last, written = written, materialize(out, "mix-cells")
        if last is not None:
            discard(last)
        out = written
        if progress.ends((residuals(out).agg(F.max(F.abs("residual"))).first()[0] or 0.0) if progress.asks() else None):
            break
    out = out.withColumn("miss", F.lit(0.0))
    for k in keys:
        out = _in_margin(out, k, crowded).withColumn("miss", F.greatest("miss", F.abs(F.col("in_margin") - F.col(f"{k}_share")))).drop("in_margin")
    return out.select(*keys, "tokens", "weight", "miss")


def fit_cells(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float | None = TOLERANCE) -> DataFrame:
    """cells(margins..., tokens) with weight, the raked tokens, and miss; targets: for each margin a table (margin, target).

    Each target is scaled to a sum of one over the values that occur; a value without a target gets none of the weight. Raking
    goes on after the given rounds until no margin misses its target by more than the tolerance (None: it stops there). miss is
    by how much, as a share of all weight, the worst of the cell's margins misses its target in the end: margins that cannot
    all hold leave it above the tolerance, and a warning names the worst.

    The fit is of cells, not of documents. Up to ONE_TASK_CELLS of them are raked in one task, and more, since sources may be
    many, in steps over all tasks that give the same weights: a step adds cells up by a margin, in a window where no value of it
    has over WINDOW_CELLS cells, else by partial sums that are joined back.
    """
    keys = list(targets)
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for k, t in targets.items():
        # At most one row for each value of the margin.
        present = materialize(cells.select(k).distinct().join(t, k, "left").select(k, F.coalesce("target", F.lit(0.0)).alias("target")), "mix-targets")
        total = present.agg(F.sum("target")).first()[0] or 0.0
        out = out.join(present.select(k, F.coalesce(F.try_divide("target", F.lit(float(total))), F.lit(0.0)).alias(f"{k}_share")), k)
    start = materialize(out.select(*keys, "tokens", "weight", *(f"{k}_share" for k in keys)), "mix-cells")
    rake = _rake_here if start.limit(ONE_TASK_CELLS + 1).count() <= ONE_TASK_CELLS else _rake_apart
    fitted = materialize(rake(start, keys, rounds, tolerance), "mix-raked")
    if tolerance is not None and not fitted.where(F.col("miss") > tolerance).isEmpty():
        shares = start.select(*keys, *(f"{k}_share" for k in keys))
        worst = residuals(fitted.join(shares, keys)).orderBy(F.abs("residual").desc()).limit(5).collect()
        warnings.warn("margins miss their targets: " + ", ".join(f"{w.margin} {w.value!r} by {w.residual:.2g}" for w in worst), stacklevel=2)
    return fitted


def scale_to(fitted: DataFrame, keep: float) -> float:
    """The factor of weight/tokens by which the cells keep the share keep of all tokens, none more than all of its own.

    Each step keeps those cells whole that the last factor would overdraw; the factor only grows, until no cell joins them.
    A step is one sum over the cells.
    """
    scale, last = 0.0, -1.0
    while scale != last:
        full = (F.col("tokens") == 0) | (F.col("weight") * scale >= F.col("tokens"))
        whole, rest, total = fitted.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum("tokens")).first()
        scale, last = max(scale, (keep * total - whole) / rest if rest else scale), scale
    return scale


def _cell(docs: DataFrame, text_col: str, topic_col: str | None) -> dict[str, Column]:
    kind = topic(F.col(text_col)) if topic_col is None else F.coalesce(F.col(topic_col).cast("string"), F.lit(""))
    return {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": kind}


def _fitted(rows: DataFrame, targets: dict[str, DataFrame] | None, keep: float, rounds: int, flatten: float, tolerance: float | None) -> DataFrame:
    """(cell, probability, weight, margin_miss, n_rows) from rows(cell, n_tokens)."""
    cells = rows.groupBy(*(F.col(f"cell.{k}").alias(k) for k in MARGINS)).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows"))
    cells, given = materialize(cells, "mix-cells"), targets or {}
    fitted = fit_cells(cells, {k: given[k] if k in given else default_targets(cells, k, flatten) for k in MARGINS}, rounds, tolerance)
    scale = scale_to(fitted, keep)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") * scale / F.col("tokens")).otherwise(1.0)
    p = fitted.join(cells.select(*MARGINS, "n_rows"), list(MARGINS))
    return materialize(p.select(F.struct(*MARGINS).alias("cell"), F.round(F.least(ratio, F.lit(1.0)), 9).alias("probability"), F.round(F.greatest(ratio, F.lit(1.0)), 6).alias("weight"), F.round("miss", 5).alias("margin_miss"), "n_rows"), "mix-fitted")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("bigint")


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None, seed: int = 0, rounds: int = ROUNDS, flatten: float = FLATTEN, tolerance: float | None = TOLERANCE) -> DataFrame:
    """One row for each row of docs: (id, source, lang, topic, n_tokens, probability, weight, margin_miss, kept).

    docs needs source and lang; the topic is topic_col, or topic()'s. Null values of a margin form a value of their own, "". A
    cell of documents without words has no tokens to rake: it gets probability 1, since keeping it costs none. weight is what a
    kept document counts for: over one where all of a cell is too little for its target. margin_miss is fit_cells()'s miss to five places: 0 if raking has met the targets. Each row is decided for itself, by its
    id, or by its text where the id is null: rows that repeat the id share a decision if they share a cell. An empty table gives
    an empty result; very long texts count whole.
    """
    cell = F.struct(*(c.alias(k) for k, c in _cell(docs, text_col, topic_col).items()))
    rows = docs.select(F.col(id_col).alias("id"), cell.alias("cell"), n_words(F.col(text_col)).alias("n_tokens"), draw(F.col(id_col), F.col(text_col), seed).alias("draw"))
    rows = materialize(rows, "mix-rows")
    p = _fitted(rows, targets, keep, rounds, flatten, tolerance)
    return join_keyed(rows, p, "cell", "n_rows").select(F.col("id").alias(id_col), "cell.*", "n_tokens", "probability", "weight", "margin_miss", (F.col("draw") < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None, seed: int = 0, rounds: int = ROUNDS, flatten: float = FLATTEN, tolerance: float | None = TOLERANCE) -> DataFrame:
    """docs without the rows that mix() does not keep, and with those of a weight above one repeated by it.

    A weight's whole part is the number of copies, and a second draw decides on one more by the fraction, so the expected
    tokens of each cell are in proportion to its raked weight. Each row is decided for itself, as in mix().
    """
    cell = F.struct(*(c.alias(k) for k, c in _cell(docs, text_col, topic_col).items()))
    p = _fitted(docs.select(cell.alias("cell"), n_words(F.col(text_col)).alias("n_tokens")), targets, keep, rounds, flatten, tolerance)
    p = p.select(F.col("cell").alias("__cell"), F.struct("probability", "weight").alias("__mix"), F.col("n_rows").alias("__rows"))
    out = join_keyed(docs.withColumn("__cell", cell), p, "__cell", "__rows")
    weight = F.col("__mix.weight")
    whole = F.floor(weight).cast("int")
    more = (draw(F.col(id_col), F.col(text_col), seed + 1) < weight - whole).cast("int")
    out = out.where(draw(F.col(id_col), F.col(text_col), seed) < F.col("__mix.probability")).withColumn("__times", F.explode(F.sequence(F.lit(1), whole + more)))
    return out.select(docs.columns)
