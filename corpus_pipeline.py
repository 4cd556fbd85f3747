"""A corpus from raw documents: five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns what it keeps; the last one adds
``copies``, how often the mix takes a document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stormgrid.llm import langid, lines, mixing, simhash, winnowing
from stormgrid.llm.common import table
from stormgrid.session import checkpoint_root, for_session


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the classifier learns from the labelled documents at hand."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three lines in a row are cut; a document of which no line is left goes."""
    return lines.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints (shingles of three words) link at three bits or fewer one stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of ten words with a benchmark item go."""
    return winnowing.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies."""
    return mixing.mix_rows(docs)


STAGES = [("language ID", language), ("line dedup", line_dedup), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixture)]

#: The classifier, the fingerprints and the draw have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole ``documents`` table."""
    docs, base = table(spark, sf_dir, "documents"), f"{checkpoint_root(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        for_session(spark, path)
        docs = spark.read.parquet(path)
    return docs
