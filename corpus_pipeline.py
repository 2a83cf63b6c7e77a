"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. quality: the byte-level network, learned from all labels; documents scored below ``quality.THRESHOLD`` go.
2. line_dedup: lines that a document with a smaller doc_id holds are dropped; documents that lose all their
   characters go, others keep their remaining lines.
3. near_duplicates: documents whose five-word shingles reach a Jaccard similarity of 0.8 form groups; of each group the
   smallest doc_id stays.
4. decontaminate: documents that hold ten consecutive words of a benchmark item (or a whole shorter item) go.
5. tokens: ids of the SentencePiece model, and whether decoding gives the text back.

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text. Rows with a null doc_id
pass through the stages that compare documents. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import decontaminate, jaccard, line_dedup, quality, sentencepiece_fst
from cartloom.llm.common import materialized, reach, table

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    network = quality.train(docs, table(spark, folder, "labels"), F.lit(True))
    scored = quality.score(docs, network)
    return scored.where(F.col(scored.columns[-1]) >= quality.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    index = line_dedup.LineIndex(spark)
    index.insert(docs)
    cleaned = index.clean(docs)
    dropped = F.col(cleaned.columns[-1])
    kept = cleaned.where((dropped == 0) | (F.length(F.trim("text")) > 0))
    columns = [F.when(dropped > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
               if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard.representatives(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    reach(spark)
    return sentencepiece_fst.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
