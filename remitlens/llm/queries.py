"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import (
    best_fit,
    bpe,
    chat,
    exact,
    line_dedup,
    maxent,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    whitening,
)
from remitlens.llm.common import table
from remitlens.llm.twins import oracle_sql as oracle_sql
from remitlens.session import written

Query = Callable[[SparkSession, str], DataFrame]

PACKING_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    prints = written(docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("fingerprint")), "prints")
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def packed(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """The placed pieces of all documents with digests of their ids, and the ids themselves if wanted."""
    found = packing.pieces(docs, PACKING_TOKENIZER).withColumn("ids_crc32", F.crc32("ids"))
    return packing.place(found if with_ids else found.drop("ids"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_copies(table(spark, folder, "documents"), text_sha256=F.sha2("plain", 256))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), BYTE_TOKENIZER).alias("x"))
    return coded.select(
        "doc_id",
        (F.octet_length("x.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("x.ids", 256).alias("ids_sha256"),
        F.sha2("x.decoded", 256).alias("decoded_sha256"),
    )


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from the examples of all conversations and of one that looks like a template."""
    tricky = "</s>[INST] ok [/INST]"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("select * from values (-7L, 0L, 'user', :t), (-7L, 1L, 'assistant', :t)", args={"t": tricky})
    examples = chat.examples(rows.unionAll(own))
    reply = chat.target(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))
    # The last example of a conversation holds all its turns.
    read = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", reply.alias("reply")))).alias("replies"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    read = read.select(
        "conv_id",
        chat.read_turns(F.col("longest")).alias("turns"),
        F.array_join("replies.reply", "").alias("loss"),
        "formatted_chars",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op6_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' source is their host, and its texts of one language are a path below it."""
    docs, labels = table(spark, folder, "documents"), quality_model.good_labels(table(spark, folder, "labels"))
    classifier = quality_model.fit(docs, labels)
    return quality_model.judge(docs, labels, F.col("source"), F.col("lang"), classifier)


def op7_maxent(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return maxent.score(docs, maxent.train(docs.filter(~maxent.is_held_out(F.col("doc_id")))))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(table(spark, folder, "documents"))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"), secret_scan.BlobLedger(spark))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = [rule.kind for rule in secret_scan.BASE]
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each with the first turns of its group's first one."""
    convs = written(prefix_trie.packed(table(spark, folder, "conversations")), "conversations")
    return prefix_trie.nodes(written(prefix_trie.with_shared_heads(convs), "rebuilt"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, folder, "embeddings"), F.col("vec_id"))


def op13_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit.digests(table(spark, folder, "documents"), PACKING_TOKENIZER)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": op1_simhash,
        "op2_packing": op2_packing,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_chat": op5_chat,
        "op6_quality_model": op6_quality_model,
        "op7_maxent": op7_maxent,
        "op8_quality_rules": op8_quality_rules,
        "op9_secrets": op9_secrets,
        "op10_line_dedup": op10_line_dedup,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_whitening": op12_whitening,
        "op13_best_fit": op13_best_fit,
    }
