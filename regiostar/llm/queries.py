"""One query per operator of this folder, over whole tables, with the operators' production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostar.llm import (
    block_naming,
    block_topk,
    chunk_fim,
    collection_bwt,
    html_consensus,
    pareto_mix,
    spaced_seeds,
    stripes,
    token_files,
    toxic_segments,
    unit_dedup,
    url_templates,
    weighted_minhash,
)
from regiostar.llm.common import table

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.verdicts(table(spark, folder, "pages"), RULES)


def op2_html_consensus(spark: SparkSession, folder: str) -> DataFrame:
    return html_consensus.extracted(table(spark, folder, "pages"))


def op3_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return pareto_mix.mix(table(spark, folder, "documents"))


def op5_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    found = toxic_segments.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumn("n_passages", F.size("passages").cast("long"))


def op6_collection_bwt(spark: SparkSession, folder: str) -> DataFrame:
    return collection_bwt.digested(collection_bwt.without_repeats(table(spark, folder, "documents")))


def op7_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = weighted_minhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size", (F.col("row") == F.col("keeper")).alias("kept"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = unit_dedup.dedup(table(spark, folder, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return found.withColumn("removed", F.array_join(spans, ","))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.encoded(table(spark, folder, "documents"), tokenizer_file())


def op10_block_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = block_topk.whole_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return block_topk.top_k(vectors, vectors.where(F.pmod("id", F.lit(50)) == 0))


def op11_chunk_fim(spark: SparkSession, folder: str) -> DataFrame:
    found = chunk_fim.transformed(table(spark, folder, "documents"))
    digests = (F.sha2("output", 256).alias("output_sha256"), F.sha2(chunk_fim.restored(), 256).alias("restored_sha256"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return block_naming.dedup(table(spark, folder, "documents"))


def op13_stripes(spark: SparkSession, folder: str) -> DataFrame:
    return stripes.collocations(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_templates, op2_html_consensus, op3_spaced_seeds, op4_pareto_mix, op5_toxic_segments, op6_collection_bwt,
        op7_weighted_minhash, op8_line_dedup, op9_token_files, op10_block_topk, op11_chunk_fim,
        op12_block_naming, op13_stripes,
    )
}
