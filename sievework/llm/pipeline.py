"""The corpus pipeline: drop toxic documents, drop low quality, keep one of near copies, mix sources, pack into windows.

Each stage takes the documents that the stage before it kept and returns the columns of documents, the last returns
pieces of packed windows. ``run`` applies them in order.

For every stage: an empty table gives an empty one, extra columns pass through the first four whatever their names (but for
columns named as the documents' own), and texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import jaccard, mixing, packing, quality, toxicity
from sievework.llm.common import documents, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7.

    NULL and empty texts score as texts without toxic tokens; a NULL doc_id has no label but is scored; repeated rows are judged
    each, alike. Without labels of both classes nothing is dropped.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, _labels(spark, sf_dir)), 0.7)


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.5.

    NULL and empty texts score as a document without passages; a NULL doc_id has no label but is scored; repeated rows are judged
    each, alike. Without labels of both classes nothing is dropped.
    """
    return quality.keep_good(docs, quality.fit(docs, _labels(spark, sf_dir)), 0.5)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of at least 0.8 of five-word shingles: that of the smallest doc_id.

    NULL and empty texts are linked with nothing and stay. Of rows that agree in id and text one stays; texts that share an id are
    judged apart. A group whose ids are all NULL keeps one row.
    """
    return jaccard.one_of_each(docs, 5, 80, 100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target shares.

    NULL is a source. NULL and empty texts have no words; they are drawn like others. Repeated rows share their fate; rows without
    a doc_id are drawn by their text.
    """
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens.

    NULL and empty texts are their end id alone; NULL is a source; repeated rows and ids are documents of their own.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("quality", good_only),
    ("near_copies", one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The classifiers, the join and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
