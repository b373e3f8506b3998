"""Training-data pipeline: five stages over ``documents``, each written and reread.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
the documents it keeps with their columns, the last one the packed pieces. Each
stage decides on all that its predecessor kept:

1. language_id: documents without a letter, or that no language claims, go;
2. line_dedup: later occurrences of repeated runs of lines are cut from texts,
   whatever their length from 3 lines on, and of one or two lines from 40 bytes on;
3. near_dedup: of each class of near-duplicates the smallest doc_id stays;
4. suffix_dedup: long byte strings that occur more than once are cut from texts;
5. packing: the texts left, as token ids, in sequences of 4096.

Texts that a cut changes get a new n_chars; a document that loses its whole text
stays with an empty one. Null texts and null ids are never near-duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.llm import language, line_dedup, near_duplicates, packing, suffix_dedup
from audix.llm.queries import word_vocabulary
from audix.llm.shared import join_decision, read_table, stored

# A language claims a text from this value of its regression on; clean texts of
# learned languages score well above it.
LEAST_SCORE = 0.1


def _packed(docs: DataFrame) -> DataFrame:
    """What operators read, and the whole row beside it."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def _with_text(found: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of documents, with a new text and its length."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return found.select(*[new.get(c, F.col(f"document.`{c}`")).alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    taught = docs.where(~language.held_out()).select("doc_id", "text", "lang")
    clear = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return language.identify(_packed(docs), taught).where(clear).select("document.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines."""
    return _with_text(line_dedup.line_dedup(_packed(docs), least=line_dedup.LEAST_BYTES), docs.columns, "text")


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five words, 0.8)."""
    found = near_duplicates.near_duplicates(docs.select("doc_id", "text"))
    return join_decision(docs, found.where("not kept").select("doc_id"), "left_anti")


def dedup_suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings of 200 that also start elsewhere."""
    return _with_text(suffix_dedup.suffix_dedup(_packed(docs), keep_text=True), docs.columns, "kept_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of 4096 tokens."""
    return packing.pack(docs, word_vocabulary())


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("suffix_dedup", dedup_suffixes), ("packing", pack)]

# Kernels, sketches and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
