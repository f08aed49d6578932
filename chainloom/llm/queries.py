"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.llm import alignment, bpe, chat_format, exact_dedup, fingerprints, hard_negatives, langid, mixing, pii, quality, secrets, simhash, topk
from chainloom.llm.oracles import ORACLE_SQL
from chainloom.llm.shared import held_out, table
from chainloom.llm.spans import count_kind, listed

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A file of the installed public tokenizers: the byte-level BPE one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat_format.probe(spark))
    chats = chat_format.format_chats(turns.withColumn("parts", chat_format.parts_of(F.col("role"), F.col("turn"), F.col("text"))))
    read = chats.select("conv_id", "formatted", "attachments", "n_attach_tokens", chat_format.read_back(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("formatted"), F.col("loss")).alias("loss"))
    files = F.flatten(F.transform("turns", lambda t: F.filter(t["parts"], lambda x: x["kind"] != "text")))
    listed_files = F.array_join(F.transform(files, lambda f: F.concat_ws(":", f["kind"], f["ref"], f["tokens"])), ",")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "n_attach_tokens",
        listed_files.alias("attachments"),
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda a, f: a + f["at"]).alias("attachment_places"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.prototypes(docs.where(~held_out(F.col("doc_id"))))
    return langid.identify(docs, learned).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.train(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Two runs, as a ledger has them: the first meets half of the documents, the second all, and scans what is new to it.
    _, ledger = secrets.findings(docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0))
    found, _ = secrets.findings(docs, ledger=ledger)
    kinds = tuple(r.kind for r in secrets.RULES)
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE))
    counts = (count_kind(F.col("found"), k).alias(f"n_{k}") for k in secrets.BASE)
    return found.select("doc_id", *counts, F.sha2(listed(base, ("start,kind", *kinds)), 256).alias("base_sha256"), listed(F.col("found"), ("start,kind", *kinds)).alias("spans"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary()))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = tuple(d.kind for d in pii.DETECTORS)
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    counts = (count_kind(F.col("found"), k).alias(f"n_{k}") for k in pii.BASE)
    # The scores that nearby words adjusted, in hundredths, in the order of the spans.
    scores = F.array_join(F.transform("found", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(listed(base, ("kind,start", *kinds)), 256).alias("base_sha256"), listed(F.col("found"), ("kind,start", *kinds)).alias("spans"), scores.alias("scores"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


_ALL = (
    op1_chat_format, op2_simhash, op3_topk, op4_langid, op5_quality, op6_secrets, op7_exact_dedup, op8_bpe, op9_mixing, op10_pii, op11_alignment, op12_fingerprints, op13_hard_negatives,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}
