"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, conversations, decontamination, html_text, langid, lattice, licenses, negatives, pii, quality, sharding, simhash, wordpiece,
)
from .common import held_out, ship
from .oracle import ORACLE as ORACLE


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary_path() -> str:
    """The public byte-level vocabulary installed beside Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.fit(spark, docs, table(spark, sf, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op2_embedding_near_dedup(spark, sf):
    return lattice.near_duplicates(spark, table(spark, sf, "embeddings"))


def op3_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(spark, table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op4_html_extraction(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


def op5_pii(spark, sf):
    return pii.digests(pii.detect(table(spark, sf, "documents")))


def op6_bpe(spark, sf):
    return bpe.digests(bpe.encode(spark, table(spark, sf, "documents"), vocabulary_path(), decoded=True))


def op7_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_decontamination(spark, sf):
    return decontamination.matches(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_token_counts(spark, sf):
    entries = wordpiece.byte_entries(vocabulary_path())
    return wordpiece.token_counts(spark, table(spark, sf, "documents"), entries)


def op10_license_scans(spark, sf):
    return licenses.scan(spark, table(spark, sf, "documents"))


def op11_sharding(spark, sf):
    placed = sharding.near_equal(spark, table(spark, sf, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(spark, table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that a hash of conversation and turn chooses."""
    def space(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        "conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("fault"),
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.filter("fault != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op13_conversation_repair(spark, sf):
    whole = table(spark, sf, "conversations")
    rows = damaged(whole)
    audits = conversations.audits(spark, rows)
    digests = conversations.digests(conversations.repaired(rows, audits))
    faults = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = whole.select("conv_id").distinct().alias("i")
    found = ids.join(audits.alias("a"), F.col("i.conv_id").eqNullSafe(F.col("a.conv_id")), "left")
    found = found.join(digests.alias("d"), F.col("i.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return found.select(
        "i.conv_id",
        *(F.coalesce(F.col(f), F.lit(0)).cast("long").alias(f) for f in faults),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_embedding_near_dedup, op3_simhash_near_dedup, op4_html_extraction, op5_pii,
        op6_bpe, op7_language_id, op8_decontamination, op9_token_counts, op10_license_scans,
        op11_sharding, op12_hard_negatives, op13_conversation_repair,
    )
}
