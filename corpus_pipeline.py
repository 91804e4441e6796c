"""A corpus from documents to token ids: quality, near duplicates, secrets, mixing, encoding.

Every stage reads what the one before it kept, as Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.common import read, stored, tokenizer_file
from transqa.llm.minhash import near_duplicates
from transqa.llm.mixing import mixed_documents
from transqa.llm.quality import joint_cutoffs, judged_quality
from transqa.llm.secrets import redacted
from transqa.llm.sentencepiece import Model, encoded
from transqa.session import ship_package

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base or the rules, certified jointly, reject.

    Verdicts hang on text and language, and are joined back by these: an id may be null or shared.
    """
    ship_package(spark)
    own = F.xxhash64("doc_id", "text", "lang")
    verdict = judged_quality(docs, read(spark, sf_dir, "labels"), certify=joint_cutoffs, own=own)
    good = verdict.where("kept").select("own").distinct()
    return docs.withColumn("own", own).join(good, "own", "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one of the smallest id.

    Texts are grouped by themselves, whatever their ids: of rows of one id and text one
    stays, rows of one id with different texts are different documents, and a document without an id stays if no
    other of its group has one.
    """
    ship_package(spark)
    own = docs.withColumn("own", F.xxhash64("doc_id", "text"))
    groups = near_duplicates(own, id_col="own").select("own", "component_id").distinct()
    ids = own.select("own", "doc_id").distinct()
    first = groups.join(ids, "own").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")).alias("first"))
    kept = stored(first.select("first.own"), "kept")
    return own.dropDuplicates(["own"]).join(kept, "own", "left_semi").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret; n_chars follows the text."""
    ship_package(spark)
    return redacted(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix's proportions and order; some come twice, some not at all."""
    ship_package(spark)
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts, with their number."""
    ship_package(spark)
    ids = encoded(docs, Model.load(tokenizer_file("piece_bpe_32k.model")))
    return ids.withColumn("n_ids", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
