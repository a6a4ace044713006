"""From raw documents to packed training rows, in five stages.

Each stage takes (spark, docs, sf_dir) and gives the next one its documents; all but the last keep the columns
of ``documents``. Every stage works on all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusgauge.llm import decontaminate, mixing, neardup, packing, toxicity
from corpusgauge.llm.common import table
from corpusgauge.session import cut


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    NULL and empty texts score the lowest and stay; repeated rows are scored alike and all stay or go; without labels nothing goes.
    An empty table stays empty. All columns are kept as they are; further ones do not clash."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the first by id, then by the hash of its text.

    NULL ids come after all others. Texts without words (NULL and empty ones) are no duplicates of one another and stay, but rows
    equal in id and text stay once. An empty table stays empty. All columns are kept; further ones do not clash."""
    return neardup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    NULL and empty texts have no window and stay; repeated rows all stay or go. Items that are NULL or empty match nothing. An empty
    table on either side is allowed. All columns are kept; further ones do not clash."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for, at most three times.

    A NULL source is one of its own, after all others. NULL and empty texts have size 0; they are taken as their source's other
    documents without a multiplier are, once. Rows equal in id, text and source share their copies. An empty table stays empty. All
    columns are kept; further ones do not clash."""
    return mixing.taken(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids of one length.

    NULL and empty texts give no tokens; repeated rows are packed as often as they come, and texts of any length are split without loss.
    An empty table gives no rows. Other columns than id and text are not read."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token packing", pack_tokens),
]

ORACLE_SQL = None
"""SQL has no form of the trained classifier, the sampled classes or the tokenizer; tests use brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage gives is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
