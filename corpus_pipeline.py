"""A corpus from raw documents to packed sequences; every stage works on all that its predecessor kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tubewave.llm.decontaminate import decontaminate
from tubewave.llm.jaccard import similar_documents
from tubewave.llm.packing import pack
from tubewave.llm.queries import TOXIC_SCORE, training_labels
from tubewave.llm.sanitise import sanitise
from tubewave.llm.toxicity import fit_lexicon, score_toxicity
from tubewave.session import scratch_path


def _documents(marked: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` under their names, with ``text`` in place of the text if given, and its length.

    Operators keep the columns of documents in front and in order, but rename those that have the name of a new one.
    """
    kept = {name: F.col(f"`{own}`") for name, own in zip(docs.columns, marked.columns)}
    if text is not None:
        kept["text"] = text
        if "n_chars" in kept:
            kept["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return marked.select(*[column.alias(name) for name, column in kept.items()])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; texts that are NULL or empty stay."""
    labels = training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(score_toxicity(docs, fit_lexicon(docs, labels)).where(F.col("score") < TOXIC_SCORE), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five words, similarity 0.8): the one with the smallest key; without a key all stay."""
    linked = similar_documents(docs, size=5, share=(80, 100))
    kept = linked.where("component_id = doc_id OR doc_id IS NULL").select(F.col("doc_id").alias("kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept"]), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows; a document of which nothing is left goes."""
    marked = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    before = F.col(f"`{marked.columns[docs.columns.index('text')]}`")
    return _documents(marked.where("n_hit = 0 OR n_hit < n_words"), docs, F.coalesce("clean_text", before))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which personal data is replaced by its kind, and telling terms are generalised or removed."""
    return _documents(sanitise(docs), docs, F.col("clean_text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: one row for each piece, with its ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), "dropped", end_id=1, keep=["doc_id"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: Trained weights, tokens and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
