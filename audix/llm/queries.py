"""Registered queries of the training-data operators: whole tables, whole texts."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.llm import near_duplicates as near
from audix.llm import (byte_bpe, graph_search, id_files, language, lexical, licences, line_dedup, merkle, packing,
                       suffix_dedup, top_k, toxicity, twins)
from audix.llm.shared import read_table


def word_vocabulary() -> str:
    """Place of the word tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written in context-mixed blocks and read back."""
    files = id_files.write_ids(read_table(spark, sf_dir, "documents").select("doc_id", "text"), word_vocabulary())
    return id_files.read_ids(files)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at 85 of 100."""
    return near.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), word_vocabulary())


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: a folder for each source, folders of 512
    ids in it, and folders of 32 ids in those."""
    return docs.select(F.col("doc_id").alias("file_id"), "text", F.concat_ws(
        "/", "source", F.expr("doc_id div 512").cast("string"), F.expr("doc_id div 32").cast("string"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, by its notices or its nearest ancestor folder."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return licences.scan(document_paths(docs)).withColumnRenamed("file_id", "doc_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their later repeated runs of lines; the text as a digest."""
    found = line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                        F.col("n_removed").cast("long").alias("n_removed"),
                        F.col("n_runs").cast("long").alias("n_runs"),
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    taught = docs.where(~language.held_out())
    return language.identify(docs.select("doc_id", "text", language.held_out().alias("held_out")), taught)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur more than once, cut from all documents."""
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest embeddings found for every row whose vec_id is divisible by 20."""
    return graph_search.nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                                F.col("vec_id") % 20 == 0)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 highest integer inner products for every row whose vec_id is divisible by 20."""
    return top_k.exact_top_k(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                             F.col("vec_id") % 20 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and the bytes they decode to, as digests."""
    import public_tokenizers
    return byte_bpe.encode_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels of those that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    found = toxicity.find_toxic(docs, toxicity.learn(docs, labels))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 highest-scoring documents of every benchmark item."""
    return lexical.rank_all(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                            read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the Merkle tree of all, checked on rows of which
    one in five shows its text in lower case."""
    docs = read_table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = docs.select("doc_id", "source", merkle.leaf([F.col(c) for c in merkle.FIELDS]).alias("leaf"), F.when(
        tampered, merkle.leaf([lower if c == "text" else F.col(c) for c in merkle.FIELDS])).alias("tampered"))
    found = merkle.manifest(rows, "source", "doc_id", "leaf", ["doc_id", "tampered"])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return (found.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


QUERIES = {
    "op1_licence_scan": op1_licence_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_graph_search": op5_graph_search,
    "op6_id_files": op6_id_files,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_packing": op8_packing,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_toxicity": op11_toxicity,
    "op12_lexical_search": op12_lexical_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE: dict[str, str] = {
    "op1_licence_scan": twins.licence_scan(licences.template_words(licences.TEMPLATES), licences.LINE_SHARE,
                                           licences.LEAST_COSINE, licences.LICENCE_SHARE),
    "op2_line_dedup": twins.LINE_DEDUP,
    "op7_near_duplicates": twins.NEAR_DUPLICATES,
    "op9_exact_top_k": twins.EXACT_TOP_K,
    "op12_lexical_search": twins.LEXICAL_SEARCH,
    "op13_merkle_manifest": twins.merkle_manifest(),
}
