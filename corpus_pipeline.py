"""A corpus pipeline in five stages; each works on all that the stage before kept.

1. toxicity: documents that the compression-distance classifier rejects go.
2. near_dedup: of each group of near copies (Jaccard similarity of five-word shingles 0.8 or more) the document with the
   smallest id stays. Candidates are texts whose SimHash fingerprints differ in two bits at most, by Golay keys, and texts
   that share a key of their shingles' prefixes; all are verified by their whole sets.
3. secrets: secrets in the texts are replaced by the names of their kinds.
4. mixing: sources are mixed to temperature weights; documents of rare sources are repeated, none is dropped.
5. bpe: texts become token ids; the ids are decoded again, and the decoded bytes' digest stands beside them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import bpe, mixing, secrets, similar, toxicity
from daymill.llm._common import materialise, read_table
from daymill.llm.entry import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs, words=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents, each result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
