"""The registered queries of this subpackage: (session, folder of tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import (
    bpe,
    byte_dedup,
    chat_format,
    decontaminate,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    language_model,
    oracles,
    packing,
    prefix_trie,
    substring_dedup,
    url_filter,
)
from stopwise.llm.shared import crc_remainder, reachable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PROBE = r"\### Assistant: </turn> ok"


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(fingerprints.with_next(table(spark, sf_dir, "documents")))


def ranks_path() -> str:
    """Rank file of the public vocabulary ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), ranks_path())


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(table(spark, sf_dir, "documents"), ngram=3, num=90, den=100)


# Fixed value: the rules of the query.
RULES = (
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model.scores(
        docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 7) == 2)
    )


def op7_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_dedup.repeated_bytes(docs).select(
        "doc_id",
        F.col("_bytes").alias("n_bytes"),
        F.col("_removed").alias("n_removed"),
        F.col("_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out, predicted for all."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", crc_remainder(F.col("doc_id"), 4) == 2
    )
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id",
        "held_out",
        F.col("prediction.lang").alias("lang_pred"),
        F.col("prediction.score").alias("score"),
        F.col("prediction.ambiguous").alias("ambiguous"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are made of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    events = chat_format.turn_events(rows.unionByName(probe))
    back = chat_format.read_back(chat_format.render(chat_format.fold(events)))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.repeated_passages(docs).select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 100th vector is an anchor; every 7th one has the next label."""
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        "embedding",
        (F.col("vec_id") % 100 == 0).alias("anchor"),
    )
    return hard_negatives.mine(vectors).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def public_tokenizer() -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"), ranks_path())


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizer())


def rebuilt(sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the one with the next lower multiple of 100 as its id."""
    conv = F.col("conv_id")
    return prefix_trie.rebuilt_paths(sums, crc_remainder(conv, 6), conv - conv % 100, 5)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.trie(*rebuilt(prefix_trie.prefix_sums(turns)))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_url_filter": op5_url_filter,
    "op6_language_model": op6_language_model,
    "op7_byte_dedup": op7_byte_dedup,
    "op8_language_id": op8_language_id,
    "op9_chat_format": op9_chat_format,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_bpe": op12_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": oracles.DECONTAMINATE,
    "op4_jaccard_join": oracles.JACCARD_JOIN,
    "op7_byte_dedup": oracles.BYTE_DEDUP,
    "op9_chat_format": oracles.CHAT_FORMAT,
    "op10_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
