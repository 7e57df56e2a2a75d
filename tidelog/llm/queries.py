"""The operators of this folder as queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table


def op1_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.url_filter import PRODUCTION_RULES, filter_urls
    return filter_urls(table(spark, sf_dir, "pages"), PRODUCTION_RULES)


def op3_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.secrets import candidates, reviewed, scan
    documents = table(spark, sf_dir, "documents")
    found = scan(documents, reviewed(candidates(documents)))
    return found.select("doc_id", "position", F.length("candidate").alias("size"), F.sha2("candidate", 256).alias("sha256"),
                        "probability", "secret")


def op4_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.topk import exact_top_k
    out = exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.sharding import interleave
    out = interleave(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.packing import pack, public_tokenizer
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())


def op7_pigeonhole_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.line_dedup import clean_lines
    out = clean_lines(table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "n_lines", "n_removed", F.md5(F.col("clean").cast("binary")).alias("clean_md5"),
                      (F.col("n_removed").cast("int") == 0).alias("unchanged"), "has_rest")


def op10_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.line_quality import quality
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.pieces import encode_decode, public_pieces
    out = encode_decode(table(spark, sf_dir, "documents"), public_pieces())
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.spill_align import align, public_pieces, public_tokenizer
    out = align(table(spark, sf_dir, "documents"), public_tokenizer(), public_pieces(), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


def op13_two_way_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.spelling import corpus_words, variant_groups
    return variant_groups(corpus_words(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_nnpu_toxicity, op2_redirect_filter, op3_forest_secrets, op4_cover_tree_topk, op5_stratified_shards,
    op6_bin_completion, op7_pigeonhole_matches, op8_minhash_dedup, op9_line_spread, op10_crf_quality,
    op11_prefix_pieces, op12_spill_alignment, op13_two_way_spelling)}
