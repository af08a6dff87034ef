"""A corpus for training, from raw documents to packed sequences, in five stages.

Each stage works on all that the one before kept, calls one operator and lets
its decisions take effect; its result is written and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import dart_minhash, decontaminate, line_dedup, packing, quality
from ledgerline.llm.queries import TOKENIZER
from ledgerline.llm.shared import table, text_or_empty, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier does not reject; rows of one doc_id are judged each by its own text, as are those without."""
    rejected = quality.score(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_or_empty()) == F.col("_row"))
    return docs.join(rejected.hint("merge"), same, "left_anti").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more of them hold, but for the last holder; a document whose every line goes is empty and goes too."""
    kept = line_dedup.dedup_lines(docs, carry=("lang", "source"))
    left = kept.where((F.col("n_dropped") == 0) | (F.length(F.trim("kept")) > 0))
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.deduplicated(docs).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: A trained network, signatures and a tokenizer are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
