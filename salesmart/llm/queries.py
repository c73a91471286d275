"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.alignment import alignments
from salesmart.llm.centroids import clusters, clusters_sql
from salesmart.llm.common import read_table, scratch_path
from salesmart.llm.embedding_join import near_duplicates, near_duplicates_sql
from salesmart.llm.language_model import scores
from salesmart.llm.licenses import scan, scan_sql
from salesmart.llm.mixing import mixture_counts, mixture_sql
from salesmart.llm.order_minhash import classes
from salesmart.llm.pii import personal_data, span_digests
from salesmart.llm.sp_sampling import encode
from salesmart.llm.token_counts import token_counts
from salesmart.llm.token_files import read_token_files, write_token_files
from salesmart.llm.toxicity import held_out, learn, scored
from salesmart.llm.weighted_fingerprint import edited_fingerprints

#: the tokenizer files' place on the driver; their contents go to the tasks
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
WORD_BPE_PATH = "/opt/tokenizers/word_bpe_49k.json"
BYTE_BPE_PATH = "/opt/tokenizers/byte_bpe_50k.json"


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with equal labels and cosine >= 0.93."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digests of their spans."""
    return span_digests(personal_data(read_table(spark, sf_dir, "documents")))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    mixed = mixture_counts(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                        (F.col("copies") * F.col("_size")).cast("long").alias("taken"))


def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document: number and digest of its pieces, and
    whether they decode to the text."""
    return encode(read_table(spark, sf_dir, "documents"), MODEL_PATH, keep=["doc_id"], digest=True)


def op5_lm_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned from those not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return scores(read_table(spark, sf_dir, "documents"), held_out=held_out)


def op6_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licenses that documents, or lines of them, equal in canonical form."""
    return scan(read_table(spark, sf_dir, "documents"))


def op7_token_count_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram tokenizer."""
    return token_counts(read_table(spark, sf_dir, "documents"), MODEL_PATH, keep=["doc_id"])


def op8_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and which one of a class stays."""
    return classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op10_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings: exact integer centroids after ten rounds."""
    return clusters(read_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as wavelet-matrix files and read back."""
    docs = read_table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, WORD_BPE_PATH, scratch_path(spark, "llm", "token_files", fresh=True), end_id=2)
    return read_token_files(manifest, docs.schema["doc_id"].dataType, ids=False)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the tokens of all documents by two tokenizers."""
    return alignments(read_table(spark, sf_dir, "documents"), BYTE_BPE_PATH, MODEL_PATH)


REGISTRY = {f.__name__: f for f in (op1_embedding_join, op2_pii_bootstrap, op3_pareto_mix, op4_sentencepiece_sampling,
                                op5_lm_deleted_interpolation, op6_license_digest, op7_token_count_viterbi,
                                op8_toxicity_automata,
                                op9_order_minhash, op10_weighted_fingerprint, op11_centroid_clusters,
                                op12_token_files, op13_token_alignment)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY["pipeline"] = pipeline
ORACLE: dict[str, str] = {"op1_embedding_join": near_duplicates_sql(), "op3_pareto_mix": mixture_sql(),
                          "op6_license_digest": scan_sql(), "op11_centroid_clusters": clusters_sql()}
