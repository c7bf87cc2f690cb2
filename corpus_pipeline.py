"""The corpus pipeline: stages that each filter, cut or pack what the one before kept."""

import public_tokenizers
from pyspark.sql import functions as F

from creditloom.llm import decontaminate, forest, packing, quality, repeats
from creditloom.llm.scratch import Scratch

PASSAGE_WORDS = 50  # shortest passage that is cut where it repeats
READ = ("doc_id", "text")  # columns that operators read


def _apart(docs):
    """``docs`` with columns that operators do not read under names that clash with none of their results."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"own_{i}") for i, c in enumerate(docs.columns)])


def _back(result, docs):
    """The columns of ``docs`` from a result over ``_apart(docs)``."""
    return result.select(*[F.col(c if c in READ else f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules, weighed by their estimated accuracies, call good; those without words go.

    Repeated rows share a verdict. Columns pass unchanged, also those named like an operator's result.
    """
    return _back(quality.judge_quality(_apart(docs)).where("kept"), docs)


def near_dedup(spark, docs, sf_dir):
    """One document, that with the smallest id, of each group with similar five-word shingles.

    Documents without id or words stay, as do all rows of a kept id. Columns pass unchanged.
    """
    gone = forest.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark, docs, sf_dir):
    """All documents, with passages that also occur earlier cut out.

    Where there is a column ``n_chars`` it is counted anew; other columns pass unchanged.
    """
    cut = _back(repeats.dedup_substrings(_apart(docs), PASSAGE_WORDS), docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else cut


def decontamination(spark, docs, sf_dir):
    """Documents with under five percent of their words in benchmark passages; those without words stay.

    Repeated rows share a verdict. Columns pass unchanged, also those named like an operator's result.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _back(decontaminate.find_overlaps(_apart(docs), benchmark).where("NOT contaminated"), docs)


def best_fit_packing(spark, docs, sf_dir):
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Clustering by similarity, estimated accuracies and packing have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the documents of ``sf_dir``, each reading what the one before wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
