"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame: the first four the columns of ``documents``, the last the
packed pieces. Between stages the rows are written as Parquet and read again.

What odd rows give, in every stage: a null text counts as empty and stays null where nothing is
cut; empty texts are kept by the near-duplicate and cutting stages (an empty set of
shingles is nobody's copy, and nothing can be cut); rows with a null id are kept as rows of their
own; repeated rows with one id are one document, whose rows stay together, to the
near-duplicate stage, and copies of equal rank, neither before the other, to the suffix stage; further columns pass
through the four filtering stages, whatever their names; an empty table gives an empty
table with the same columns. Bytes that are not valid UTF-8 become U+FFFD.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import cotraining, decontaminate, ngram_join, packing, suffix_dedup
from citypulse.llm.common import table, written


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotraining.good_documents(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (four fifths of all five-word shingles
    shared) the smallest id stays."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document with a smaller id has are cut out."""
    return _counted(suffix_dedup.without_repeats(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that consist of them go."""
    return _counted(decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens. Workers outlive a stage, so
    they remember less here than where packing is all they do."""
    return packing.pack(docs, remembered=150_000, added=True).select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: The classifier's fit and the vocabulary cannot be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
