"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.llm import chat, divergence, fingerprints, jaccard, language, mixing, packing, quality, ranked, repair, sharding, topk, toxicity
from sievework.llm.common import documents, id_text_crc

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _held_out(df, modulus: int, rest: int):
    return df.withColumn("held_out", F.coalesce(id_text_crc("doc_id") % modulus == rest, F.lit(False)))


def op1_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    crf = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _held_out(toxicity.score(docs, crf), 3, 1).select("doc_id", "held_out", "score", "predicted", "spans")


def op4_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    mil = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _held_out(quality.score(docs, mil), 3, 1).select("doc_id", "held_out", "score", "predicted")


def op5_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return _held_out(language.predict(docs, language.fit(docs)), 4, 2).select("doc_id", "held_out", "lang_pred", "score")


QUERIES |= {"op1_toxicity": op1_toxicity, "op4_quality": op4_quality, "op5_language": op5_language}


def op2_mixing(spark, sf_dir):
    return mixing.mix_report(documents(spark, sf_dir))


def op6_topk(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op7_fingerprints(spark, sf_dir):
    return fingerprints.neighbour_report(documents(spark, sf_dir))


def op9_chat(spark, sf_dir):
    return chat.rotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op10_sharding(spark, sf_dir):
    return sharding.report(documents(spark, sf_dir))


QUERIES |= {"op2_mixing": op2_mixing, "op6_topk": op6_topk, "op7_fingerprints": op7_fingerprints, "op9_chat": op9_chat, "op10_sharding": op10_sharding}
ORACLE_SQL |= {"op2_mixing": mixing.ORACLE, "op6_topk": topk.ORACLE, "op9_chat": chat.ORACLE, "op10_sharding": sharding.ORACLE}


def op3_jaccard(spark, sf_dir):
    return jaccard.join(documents(spark, sf_dir), 3, 90, 100)


def op8_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


QUERIES |= {"op3_jaccard": op3_jaccard, "op8_packing": op8_packing}
ORACLE_SQL |= {"op3_jaccard": jaccard.ORACLE}


def op12_divergence(spark, sf_dir):
    return divergence.report(documents(spark, sf_dir))


QUERIES |= {"op12_divergence": op12_divergence}
ORACLE_SQL |= {"op12_divergence": divergence.ORACLE}


def op13_repair(spark, sf_dir):
    return repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES |= {"op13_repair": op13_repair}
ORACLE_SQL |= {"op13_repair": repair.ORACLE}


def op11_ranked(spark, sf_dir):
    return ranked.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES |= {"op11_ranked": op11_ranked}
ORACLE_SQL |= {"op11_ranked": ranked.ORACLE}
