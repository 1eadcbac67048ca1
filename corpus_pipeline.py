"""From raw documents to packed training sequences, in five stages.

Every stage takes what the one before it kept, written as a table and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.jaccard_join import near_duplicates_removed
from ledgerlake.llm.line_dedup import CORPUS_DEVIATIONS, CORPUS_RATIO, drop_boilerplate
from ledgerlake.llm.mixing import mixed_documents
from ledgerlake.llm.packing import pack_documents
from ledgerlake.llm.quality_rules import quality_rules, train_quality
from ledgerlake.llm.small_tables import word_count
from ledgerlake.llm.storage import few_rows, shared_folder, stored


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """The documents with all columns but the ``used`` ones under names that no operator
    gives to its own, whatever their case, and these names in order."""
    names = [c if c in used else f"_ll_column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the classifier keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with few_rows(spark):
        model = train_quality(docs.select("doc_id", "text"), labels)
    apart, names = _apart(docs, "text")
    kept = quality_rules(apart, model).where("kept").select(*names).toDF(*docs.columns)
    return stored(kept, texts=True)


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; ``n_chars`` follows.

    Copies of a text count as one page: the next stage decides about them.
    """
    apart, names = _apart(docs, "doc_id", "source", "text")
    cleaned = drop_boilerplate(
        apart, max_ratio=CORPUS_RATIO, different=True, deviations=CORPUS_DEVIATIONS
    )
    cleaned = cleaned.select(*names).toDF(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 80 % of their five-word shingles in common."""
    return near_duplicates_removed(docs, n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs, word_count(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in the sequences.

    ``doc_id`` repeats where the mix repeats a document.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rule_filter),
    ("line_dedup", boilerplate_lines),
    ("jaccard_join", near_duplicates),
    ("source_mixing", mixture),
    ("best_fit_packing", packing),
]

#: No SQL: the classifier, the permuted blocks and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table; each result is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = shared_folder(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
