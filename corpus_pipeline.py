"""A corpus pipeline of the operators in ``encore.llm``; see STAGES."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from encore.llm.decontamination import drop_contaminated  # noqa: E402
from encore.llm.language import keep_identified  # noqa: E402
from encore.llm.mixing import mixed_documents  # noqa: E402
from encore.llm.ngram_join import one_per_component  # noqa: E402
from encore.llm.sharding import balanced_shards  # noqa: E402
from encore.llm.shared import stored, table  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised, unambiguous language; the model is trained on ``docs``."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8 or more."""
    return one_per_component(docs, n=5, similarity=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source weights 1, 2, 3 in turn; a row per document and epoch, with the words taken."""
    return mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, 16 shards of near equal bytes."""
    return balanced_shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontaminated),
    ("source_mix", mixed),
    ("sharding", sharded),
]
#: Learned classifiers and keyed permutations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
