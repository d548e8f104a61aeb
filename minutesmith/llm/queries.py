"""The queries of this subpackage: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

from . import ann, bpe, exact_dedup, html_extract, jaccard_join, license_scan, lm_score, merkle, packing, prefix_trie, secret_scan, suffix_dedup, toxicity
from .common import small_batches, table


def op1_bpe(spark, sf_dir):
    small_batches(spark)
    return bpe.bpe_roundtrip(table(spark, sf_dir, "documents"))


def op2_html(spark, sf_dir):
    small_batches(spark)
    return html_extract.html_text(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    small_batches(spark)
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    small_batches(spark)
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_license_scan(spark, sf_dir):
    small_batches(spark)
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    small_batches(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lm_score(spark, sf_dir):
    small_batches(spark)
    return lm_score.lm_score(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    small_batches(spark)
    return jaccard_join.shingle_join(table(spark, sf_dir, "documents"))


def op10_nearest(spark, sf_dir):
    small_batches(spark, 64)
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_trie(spark, sf_dir):
    small_batches(spark)
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_secrets(spark, sf_dir):
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op13_manifest(spark, sf_dir):
    small_batches(spark)
    return merkle.manifest(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (op1_bpe, op2_html, op3_exact_dedup, op4_suffix_dedup, op5_packing, op6_license_scan, op7_toxicity, op8_lm_score, op9_jaccard_join, op10_nearest, op11_trie, op12_secrets, op13_manifest, pipeline)}


def oracle_sql():
    return {"op3_exact_dedup": exact_dedup.SQL, "op4_suffix_dedup": suffix_dedup.SQL, "op9_jaccard_join": jaccard_join.SQL, "op11_trie": prefix_trie.SQL, "op13_manifest": merkle.SQL}
