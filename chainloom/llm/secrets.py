"""Secret scans with an incremental blob ledger, by DataFrame and SQL functions only.

Each version of a file is addressed by the SHA-256 of its content. The ledger has a row for each blob and set of rule
versions that was scanned, with what was found. A run scans just the pairs of blob and rule version that the ledger lacks,
each blob once however many paths and versions have it, and joins the findings to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import if_small, join_keyed, materialize
from chainloom.llm.spans import matches

FINDING = "array<struct<rule:string,kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern; sub: a group that must have min_sub characters; hints: a text without any of them has no match."""

    kind: str
    pattern: str
    version: int = 1
    group: int | None = None
    min_chars: int = 1
    hints: tuple[str, ...] = ()
    hint_pattern: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: Column) -> Column:
        size = "sub" if self.group else "match"
        found = F.filter(matches(text, self.pattern, self.group), lambda m: F.length(m[size]) >= self.min_chars)
        may = F.lit(True)
        if self.hints:
            may = text.contains(self.hints[0])
            for h in self.hints[1:]:
                may = may | text.contains(h)
        if self.hint_pattern:
            may = may & text.rlike(self.hint_pattern)
        out = F.transform(found, lambda m: F.struct(F.lit(self.name).alias("rule"), F.lit(self.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(may, out).otherwise(F.array().cast(FINDING))


#: The kinds that every scan must have, in the order in which results list them, then this library's own.
RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, min_chars=6, hints=(":", "="), hint_pattern="(?i)(?:passw|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=20, hints=("AKIA",)),
    Rule("hex", r"[0-9a-f]+", min_chars=24, hint_pattern="[0-9a-f]{24}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("PRIVATE KEY-----",)),
    Rule("ghtoken", r"gh[pousr]_[A-Za-z0-9]{36}", hint_pattern="gh[pousr]_"),
)
BASE = ("assign", "access", "hex")


def addressed(versions: DataFrame, path_col: str, content_col: str) -> DataFrame:
    """versions with blob, the address of its content; null content counts as empty."""
    return versions.select(F.col(path_col).alias("path"), F.coalesce(content_col, F.lit("")).alias("content")).withColumn("blob", F.unhex(F.sha2("content", 256)))


def combined(versions: DataFrame, paths: DataFrame) -> DataFrame:
    """versions(path, content, blob) with rows that repeat path and blob made one, by each task first, before they are dealt."""
    repeated = materialize(paths.groupBy("path", "blob").count().where("count > 1").select(F.col("path").alias("p"), F.col("blob").alias("r")), "secret-repeated")
    if repeated.isEmpty():
        return versions
    keys = if_small(repeated)
    again = versions["path"].eqNullSafe(F.col("p")) & (versions["blob"] == F.col("r"))
    one = versions.join(keys, again, "left_semi").groupBy("path", "blob").agg(F.first("content").alias("content"))
    return versions.join(keys, again, "left_anti").unionByName(one)


def scan(versions: DataFrame, paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rules, found) for the blobs of addressed versions and the rule versions not in the ledger.

    paths has (path, blob) of the same versions, without content. One path stands for each blob, so contents are dealt by
    path and a blob that a third of all paths share is read by one task but once.
    """
    names = F.array(*(F.lit(r.name) for r in rules))
    wanted = paths.groupBy("blob").agg(F.min("path").alias("of"))
    if ledger is not None:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        wanted = wanted.join(seen, "blob", "left").select("blob", "of", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")).where(F.size("rules") > 0)
    else:
        wanted = wanted.withColumn("rules", names)
    wanted = wanted.withColumnRenamed("blob", "b")
    blobs = combined(versions, paths).join(wanted, F.col("path").eqNullSafe(F.col("of")) & (F.col("blob") == F.col("b")))
    none = F.array().cast(FINDING)
    found = F.concat(*(F.when(F.array_contains("rules", r.name), r.spans(F.col("content"))).otherwise(none) for r in rules))
    return blobs.select("blob", "rules", found.alias("found"))


def findings(versions: DataFrame, path_col: str = "doc_id", content_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows): for each version its path and `found`, the spans of all rules in order of rule and start.

    Versions with null paths, repeated rows and empty contents keep their rows; contents are scanned whole. Spans with one
    start are in the order of the rules. The new rows are to be added to the ledger;
    with the ledger of an earlier run, contents and rule versions that it has are not read again.
    """
    contents = addressed(versions, path_col, content_col)
    paths = materialize(contents.select("path", "blob"), "secret-paths")
    new = materialize(scan(contents, paths, ledger, rules), "secret-ledger")
    known = new if ledger is None else ledger.select("blob", "rules", "found").unionByName(new)
    if ledger is not None:
        known = known.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    current = F.array(*(F.lit(r.name) for r in rules))
    kept = known.select("blob", F.filter("found", lambda s: F.array_contains(current, s["rule"])).alias("found"))
    order = F.transform(F.col("found"), lambda s: F.struct(F.array_position(current, s["rule"]).alias("o"), s["start"].alias("start"), s.alias("s")))
    kept = kept.withColumn("found", F.transform(F.sort_array(order), lambda x: x["s"]))
    kept = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n_rows")).join(kept, "blob")
    joined = join_keyed(paths, materialize(kept, "secret-blobs"), "blob", "n_rows")
    return joined.select(F.col("path").alias(path_col), F.lower(F.hex("blob")).alias("blob"), "found"), new
