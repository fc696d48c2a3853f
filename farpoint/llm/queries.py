"""The registered query of each operator: ``opN_<name> -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from farpoint.llm import (crf, debruijn, decontaminate, lexical, mixing, ngram_join, prefix_trie, quality, rotation,
                          secrets, suffix_dedup, token_counts, urls)
from farpoint.sources.tables import load_table


def _docs(spark, sf_dir):
    return load_table(spark, sf_dir, "documents")


def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_classes(_docs(spark, sf_dir))


def op2_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(_docs(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_perspective_rotation(spark, sf_dir):
    out = rotation.rotate_perspectives(load_table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda x: F.concat_ws(
        ":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.withColumn("mask", spans)


def op4_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(urls.RULES, urls.RULE_SCHEMA)
    return urls.url_verdicts(load_table(spark, sf_dir, "pages"), rules)


def _held_out():
    """The rows that language ID must not learn from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op5_language_id(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    model = crf.train(docs.filter(~_held_out()))
    return crf.predict(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "lang_pred", "score", "n_switches")


def op6_debruijn_dedup(spark, sf_dir):
    return debruijn.remove_repeats(_docs(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mix_sources(spark, sf_dir):
    return mixing.mix_sources(_docs(spark, sf_dir)).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op8_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(_docs(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))


def op9_secret_scans(spark, sf_dir):
    return secrets.secret_digest(_docs(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    return quality.quality_verdicts(_docs(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op11_token_counts(spark, sf_dir):
    import public_tokenizers
    return token_counts.count_tokens(_docs(spark, sf_dir), str(public_tokenizers.path("piece_bpe_32k.model")))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(load_table(spark, sf_dir, "conversations"), rebuild=True)


def op13_lexical_search(spark, sf_dir):
    return lexical.search(_docs(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_perspective_rotation": op3_perspective_rotation,
    "op4_url_filters": op4_url_filters,
    "op5_language_id": op5_language_id,
    "op6_debruijn_dedup": op6_debruijn_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_secret_scans": op9_secret_scans,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}
