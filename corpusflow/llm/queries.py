"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.curriculum import taken_words
from corpusflow.llm.decontaminate import contaminated_words
from corpusflow.llm.embeddings import near_duplicate_vectors
from corpusflow.llm.lexical import search_documents
from corpusflow.llm.licenses import scan_licenses
from corpusflow.llm.linedup import without_repeated_passages
from corpusflow.llm.merkle import proof_hash, prove_documents
from corpusflow.llm.packing import pack
from corpusflow.llm.pii import KINDS, personal_spans, span_list
from corpusflow.llm.quality import fit_quality, score_quality
from corpusflow.llm.sharding import histogram_sort
from corpusflow.llm.simhash import near_duplicate_groups
from corpusflow.llm.toxicity import fit_toxicity, score_toxicity

SHARDS = 40
#: Scores from which a text counts as good, and as toxic.
GOOD, TOXIC = 0.7, 0.3


def tokenizer_path() -> str:
    """The public vocabulary file; the operator takes any."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return histogram_sort(documents, SHARDS).select(
        "doc_id",
        "size",
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_vantage_point_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_quality(documents, fit_quality(documents, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op4_hyperplane_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op5_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score_toxicity(documents, fit_toxicity(documents, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a repository, its languages are directories."""
    documents = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", "doc_id")
    found = scan_licenses(documents.select(path.alias("path"), "doc_id", "text"))
    return found.select("doc_id", "path", "own_license", F.round("cosine", 6).alias("cosine"), "license_file", "license", "inherited_from")


def op7_patience_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they are after the deletions, as digests of their texts."""
    left = without_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.char_length("text").cast("bigint").alias("chars_left"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda span: span["base"])

    def number(kind: str):
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(kind) for kind in KINDS], F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )


def op11_octopus_multiproof(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = prove_documents(table(spark, sf_dir, "documents"))
    return proofs.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("siblings")).alias("proof_sha256"), "folded_root", "verified")


def op12_document_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_time_varying_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_histogram_sort": op1_histogram_sort,
    "op2_vantage_point_simhash": op2_vantage_point_simhash,
    "op3_compression_quality": op3_compression_quality,
    "op4_hyperplane_near_duplicates": op4_hyperplane_near_duplicates,
    "op5_weak_supervision_toxicity": op5_weak_supervision_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_patience_line_dedup": op7_patience_line_dedup,
    "op8_winnowing": op8_winnowing,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_candidate_boosting": op10_candidate_boosting,
    "op11_octopus_multiproof": op11_octopus_multiproof,
    "op12_document_fp_tree": op12_document_fp_tree,
    "op13_time_varying_curriculum": op13_time_varying_curriculum,
}
