"""The queries of the numbered operators: each applies its operator, with production parameters, to its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from tessella.llm import bpe, fill_in_middle, fingerprints, html_extract, language_id, lm_scoring, minhash, oracles, packing, personal_data, quality_rules, token_alignment, token_counts, toxicity
from tessella.session import prepare, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_OF_TEXT = 50256


def _fold(n: int):
    """crc32(doc_id as text) mod n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_html_extraction(spark, sf_dir):
    return html_extract.extract_pages(table(prepare(spark), sf_dir, "pages"))


def op2_language_id(spark, sf_dir):
    docs = table(prepare(spark), sf_dir, "documents")
    model = language_id.fit(docs.filter(_fold(5) != 0))
    held = F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out")
    return language_id.predict(docs.select("doc_id", "text", held), model, ["doc_id", "held_out"])


def op3_toxicity(spark, sf_dir):
    docs, labels = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(_fold(4) != 2))
    held = F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out")
    scored = toxicity.score(docs.select("doc_id", "text", held), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_token_counts(spark, sf_dir):
    return token_counts.count_documents(table(prepare(spark), sf_dir, "documents"), RANKS, END_OF_TEXT)


def op5_document_fingerprints(spark, sf_dir):
    return fingerprints.compare(table(prepare(spark), sf_dir, "documents"))


def op6_lm_scoring(spark, sf_dir):
    scored = lm_scoring.score(table(prepare(spark), sf_dir, "documents"), _fold(7) != 2)
    held = F.coalesce(_fold(7) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.encode(table(prepare(spark), sf_dir, "documents"), RANKS)


def op8_quality_rules(spark, sf_dir):
    out = quality_rules.judge(table(prepare(spark), sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_capitals", "n_lines")


def op9_best_fit_packing(spark, sf_dir):
    # the .json file holds the same vocabulary and merges as these ranks; its special token is packing's affair
    return packing.pack(table(prepare(spark), sf_dir, "documents"), RANKS)


def op10_minhash_near_dedup(spark, sf_dir):
    found = minhash.find(table(prepare(spark), sf_dir, "documents"), width=4, least=80)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.col("component").isNull())
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def op11_personal_data(spark, sf_dir):
    return personal_data.digest(personal_data.find(table(prepare(spark), sf_dir, "documents"), "doc_id"))


def op12_token_alignment(spark, sf_dir):
    # the .json file holds the same vocabulary and merges as these ranks, so the ids are the same
    out = token_alignment.align_documents(table(prepare(spark), sf_dir, "documents"), RANKS, PIECES)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle.transform(table(prepare(spark), sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_language_id, op3_toxicity, op4_token_counts, op5_document_fingerprints, op6_lm_scoring, op7_byte_bpe, op8_quality_rules, op9_best_fit_packing, op10_minhash_near_dedup, op11_personal_data, op12_token_alignment, op13_fill_in_middle)}
ORACLE_SQL = oracles.ORACLE_SQL
