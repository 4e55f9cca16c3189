"""The numbered queries: each applies its operator, with production parameters, to its whole table."""
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import ann, byte_bpe, chat, conversation_repair, cost_packing, importance, packing, prob_minhash, qda, quality_bands, suffix_dedup, token_shards, toxicity
from panelkit.llm.common import held_out, prepare, table, written
from panelkit.llm.importance_sql import SQL as IMPORTANCE_SQL
from panelkit.llm.repair_sql import SQL as REPAIR_SQL
from panelkit.session import use_checkpoint_dir


def _labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows that a classifier may learn from."""
    return table(spark, sf_dir, "labels").where(~held_out("doc_id")).select("doc_id", F.col(name).alias("label"))


def op1_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return docs.select("doc_id", quality_bands.quality_bands(F.col("text")).alias("q")).select("doc_id", "q.*")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    r = suffix_dedup.suffix_dedup(docs, ["doc_id"])
    return r.select("doc_id", "removal.n_bytes", "removal.n_removed", "removal.n_spans", "removal.kept_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    model = toxicity.fit(docs, _labels(spark, sf_dir, "toxic"))
    scored = docs.select("doc_id", toxicity.toxicity(model, F.col("text")).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    path = f"{use_checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    facts = token_shards.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), path, key=20_24, end=49407)
    if facts.isEmpty():
        return facts.select("slot", "shard", "position", "n_tokens", F.lit(None).cast("long").alias("ids_crc32"), F.lit(None).cast("array<long>").alias("doc_ids"), "pieces")
    read = token_shards.read_shards(spark, path)
    return facts.drop("n_tokens").join(read, "slot").select("slot", "shard", "position", "n_tokens", "ids_crc32", F.col("pieces.doc_id").alias("doc_ids"), "pieces")


def op6_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(table(prepare(spark), sf_dir, "documents"))


def op7_qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    scored = qda.quality_scores(docs, _labels(spark, sf_dir, "quality"), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(prepare(spark), sf_dir, "embeddings"), every=20)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return docs.select("doc_id", byte_bpe.round_trip(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken")).alias("t")).select("doc_id", "t.*")


def op10_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    extra = prepare(spark).range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    blocks = chat.format_conversations(rows.union(extra), public_tokenizers.path("byte_bpe_50k.json"))
    return chat.read_back(blocks).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op11_lr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(prepare(spark), sf_dir, "conversations")
    facts, edited = conversation_repair.repair(conversation_repair.damage(rows))
    found = facts.join(conversation_repair.audits(edited).withColumnRenamed("conv_id", "__a"), F.col("conv_id").eqNullSafe(F.col("__a")))
    every = rows.select(F.col("conv_id").cast("long").alias("__c")).distinct()
    whole = every.join(found, F.col("__c").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(F.col("__c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return cost_packing.cost_balanced_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


_ESCAPED = r"regexp_replace(regexp_replace({0}, '\\', '\\\\', 'g'), '<(s>|/s>|\|endoftext\|>)|\[(INST\]|/INST\])', '<\\\1\2', 'g')"
ORACLE_SQL = {
    "op10_chat_masks": f"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(3 + sum(17 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id""",
    "op11_lr_repair": REPAIR_SQL,
    "op12_importance_resampling": IMPORTANCE_SQL,
}

QUERIES = {f.__name__: f for f in (
    op1_quality_bands, op2_best_fit_packing, op3_suffix_dedup, op4_toxicity, op5_token_shards, op6_prob_minhash, op7_qda_quality, op8_learned_partitions,
    op9_byte_bpe, op10_chat_masks, op11_lr_repair, op12_importance_resampling, op13_cost_packing)}
