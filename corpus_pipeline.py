"""The corpus pipeline: documents to packed training sequences.

STAGES lists (name, function) stages; each takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the docs of the next.
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from panelkit.llm import packing, prob_minhash, qda, quality_bands, suffix_dedup  # noqa: E402
from panelkit.llm.common import held_out, lean, prepare, table, written  # noqa: E402
from panelkit.session import alone  # noqa: E402

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3
#: Bytes from which a repeated passage goes: 50 words of this corpus take 270 and more, and a match needs the whole length.
PASSAGE = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and base rules keep."""
    prepare(spark)
    return docs.where(quality_bands.quality_bands(F.col("text")).kept)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a sufficient score; the classifier learns from the labels of documents that are still there."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id")).select("doc_id", F.col("quality").alias("label"))
    features = written(docs.select("doc_id", qda.document_statistics(F.col("text")).alias("features")))
    model = qda.fit(features.join(labels, "doc_id").select("features", "label"))
    return docs.where(qda.score(model, qda.document_statistics(F.col("text"))) >= LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the least id (ids before none), then the first in its input. Every row is a
    document of its own here, so unlike texts under one id both stay, and copies without an id meet."""
    prepare(spark)
    rows = docs.select(F.struct(*docs.columns).alias("document"), "doc_id", "text")
    clashes = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    # distinct ids number the rows themselves; others are numbered in a table, so that a row keeps its number
    rows = rows.withColumn("row", F.col("doc_id").cast("long")) if clashes.isEmpty() else written(rows.withColumn("row", F.monotonically_increasing_id()))
    classes = alone(lambda: prob_minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))).select(F.col("doc_id").alias("row"), "class_id")
    ids = rows.select("row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place"))
    first = classes.join(ids, "row").groupBy("class_id").agg(F.min("place").alias("place")).select("place.row")
    return rows.join(first, "row", "left_semi").select("document.*")


def _whole_characters(text: pa.Array, removal: pa.Array) -> pa.Array:
    """What is left of texts without the spans (of UTF-8 bytes); a character that loses a byte goes whole."""
    out = []
    for t, spans in zip(text.to_pylist(), removal.to_pylist(), strict=True):
        raw, kept, at = t.encode(), [], 0
        for span in spans:
            a, b = span["start"], span["end"]
            while raw[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(raw) and raw[b] & 0xC0 == 0x80:
                b += 1
            kept.append(raw[at:max(a, at)])
            at = b
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pa.array(out, pa.string())


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages of PASSAGE bytes or more that occur again; a character that loses a byte goes
    whole, n_chars follows the text."""
    prepare(spark)
    rows = docs.select(F.struct(*docs.columns).alias("document"), "doc_id", "text")
    done = suffix_dedup.suffix_dedup(rows, ["document"], length=PASSAGE, gram=PASSAGE // 4)
    cut = F.col("removal.n_removed") > 0
    left = done.withColumn("left", F.when(cut, F.arrow_udf(lean(_whole_characters), "string")(F.when(cut, F.col("document.text")).otherwise(""), F.when(cut, F.col("removal.spans")).otherwise(F.array()))))
    changed = {"text": F.coalesce("left", "document.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("document.n_chars"))
    return left.select(*[changed.get(c, F.col("document").getField(c)).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    prepare(spark)
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", packed),
]

#: Compression ratios, scores, signatures and tokens can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
