"""From raw documents to token ids: the stages of a training-data pipeline, each one an operator of ``devicelens.llm``.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelens.llm.bpe import encode_documents, read_ranks
from devicelens.llm.mixing import mixed_documents
from devicelens.llm.simhash import one_per_group
from devicelens.llm.suffixes import NO_ID, remove_repeats
from devicelens.llm.support import fold, table
from devicelens.llm.toxicity import fit_toxicity, score_toxicity
from devicelens.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; the model learns from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels")
    return score_toxicity(docs, fit_toxicity(docs, labels.where(fold(F.col("doc_id"), 5) != 0)), keep=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 100 bytes that an earlier document (or an earlier place) has; characters that lose a byte go."""
    found = remove_repeats(docs, with_text=True)
    found = found.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"), F.col("sha").alias("_sha"), F.col("kept_text").alias("_kept"))
    # Only the other columns of the documents cross the network here; the text comes from what was kept.
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    rest = [F.col(c) for c in docs.columns if c != "text"]
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"), sha.alias("_sha"), F.struct(*rest).alias("_row"))
    joined = rows.join(found.dropDuplicates(["_doc", "_sha"]), ["_doc", "_sha"])
    columns = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast(docs.schema["n_chars"].dataType)}
    return joined.select(*[columns.get(c, F.col("_row")[c] if c != "text" else None).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row per document and pass, with the words that the pass takes."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, and the digests of a round trip. Workers come from the earlier stages, so the memos are smaller here."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, memo=0.4)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("tokens", encode),
]

#: The classifier, the hashes and the tokenizer are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
