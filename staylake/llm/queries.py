"""One registered query for each operator, and their DuckDB SQL where SQL can express them.

Each runs its operator with production parameters over its whole table and
derives the columns of the contract from the operator's result.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm.bpe_count import token_counts
from staylake.llm.common import table
from staylake.llm.embed_dedup import near_duplicate_vectors
from staylake.llm.html_text import extract_text
from staylake.llm.lang_id import fit_languages, held_out, with_language
from staylake.llm.lm_score import fit_pair_models, with_loss_difference
from staylake.llm.packing import pack_documents
from staylake.llm.piece_codec import piece_digests
from staylake.llm.pii import base_spans, listed, with_pii
from staylake.llm.quality import quality_rules
from staylake.llm.resample import importance_sample
from staylake.llm.sharding import shard_documents
from staylake.llm.simhash import near_duplicates
from staylake.llm.whitening import whitened


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; ``STAYLAKE_TOKENIZERS`` names another folder."""
    folder = os.environ.get("STAYLAKE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of row counts at most one apart, equal texts together."""
    out = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word-shingle fingerprints link at 4 or fewer differing bits."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.select("doc_id", "text", "lang"))
    out = with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, log ratio and verdict of every document; documents labelled good are the trusted ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(docs, trusted).drop("text")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 512 to 8192 words."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the word-end byte-pair vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts(docs, tokenizer_file("word_bpe_49k.json"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the piece ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(docs, tokenizer_file("piece_bpe_32k.model")).drop("text")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link counts and components of all vectors at a cosine of 0.9 or more."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_loss_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; documents labelled good and not toxic are the target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return with_loss_difference(docs, fit_pair_models(docs, trusted)).drop("text")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document against the benchmark texts; 5 % of those with 20 words are drawn."""
    out = importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of all usable vectors."""
    return whitened(table(spark, sf_dir, "embeddings"), components=4)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and a digest of the base spans, and all spans."""
    out = with_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = base_spans(F.col("pii"))
    counts = [F.size(base_spans(F.col("pii"), k)).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return out.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_balanced_sharding": op1_balanced_sharding,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_html_text": op3_html_text,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_counts": op7_token_counts,
    "op8_piece_codec": op8_piece_codec,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_loss_difference": op10_loss_difference,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_personal_data": op13_personal_data,
}

#: The others need a hash, a trained model or a tokenizer that SQL does not have; tests hold them to brute force.
ORACLE: dict[str, str] = {
    "op9_embedding_near_dedup": """
        WITH RECURSIVE v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
        ok AS (
          SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v
          WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
        reach AS (
          SELECT vec_id AS node, vec_id AS other FROM embeddings
          UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
        low AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links, low.component_id,
               v.vec_id = low.component_id AS kept
        FROM v JOIN low ON low.node = v.vec_id""",
}
