"""The training-data pipeline: five stages over `documents`.

    toxicity -> exact dedup -> SimHash near-dedup -> decontamination -> BPE

Each stage gets what its predecessor kept, written as Parquet and read back.
The filtering stages return the columns they were given; the last one returns
the tokens of each document that is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from towertrace.llm import bpe, decontaminate, exact, simhash, toxicity
from towertrace.llm.queries import vocabulary_path
from towertrace.llm.shared import read_table, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold.  The network learns
    from the labelled rows among the documents it is given."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest original with the smallest id."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (3-word shingles, 3 bits), the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), short_gaps=True)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, with digests of the ids and of the decoded text."""
    return bpe.with_digests(bpe.bpe_round_trip(docs, vocabulary_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", tokenise),
]

#: No SQL: the network, the connected components and the encoder are not
#: expressible; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what lies between two of them is a Parquet
    folder in the shared checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    top = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
