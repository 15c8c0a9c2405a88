"""From raw documents to packed sequences: five stages, each an operator of ``hindcast.llm``.

``STAGES`` names them in order. A stage gets the session, the documents its predecessor kept and
the folder of the other tables, and returns a DataFrame; all but the last return the columns of
``documents``. Each result is written as Parquet and read again, so a stage never repeats the work
before it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hindcast.llm import mixing, packing, quality, simhash, substring
from hindcast.llm.common import kept, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model, threshold=0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of SimHash near-duplicates."""
    return simhash.without_near_duplicates(docs, shingle=3, max_bits=2)


def without_repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without windows of 20 words that occur earlier."""
    return substring.without_repeats(docs, window=20)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixture(docs, weights=(5, 2, 1), share=1.5, limit=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens go, in sequences of 4096."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, tokenizer, capacity=4096, end=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("substring dedup", without_repeated_windows),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed),
]

#: Compression, hashes of 64 bits and tokens are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), "pipeline")
    return docs
