"""The corpus pipeline: documents -> packed sequences.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, written as Parquet and read again as the next
one's docs.  ``run`` applies them to the table documents.  All but the last
return the columns of ``docs``; rows are told apart by their place in the
files, so ids may be null or repeat.

* language_id: rows whose language is rejected (or that have no letter) go.
* exact_dedup: of equal texts one row stays.
* simhash_near_dedup: of each group of linked fingerprints the smallest id stays.
* decontamination: rows contaminated by an item of the table benchmark go.
* packing: the pieces of what is left, placed in sequences."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.llm.common import free_name, identified, placed, table, without
from costledger.llm.decontam import decontaminated
from costledger.llm.exactdup import exact_duplicates
from costledger.llm.langid import accepted
from costledger.llm.packing import packed_digests
from costledger.llm.simhash import near_duplicates
from costledger.session import settled


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = placed(docs)
    return without(docs, exact_duplicates(docs).where("not kept"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = placed(docs)
    # The key orders rows by id (null last), then by their place in the files.
    place, key = free_name(docs, "_place"), free_name(docs, "_key")
    keyed = identified(docs, place).withColumn(key, F.concat_ws(
        "/", F.coalesce(F.lpad((F.col("doc_id").cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")).cast("string"), 20, "0"), F.lit("~")), place))
    groups = near_duplicates(keyed, shingle=4, radius=4, id_col=key)
    return without(docs, groups.where(F.col("id") != F.col("component")).select(
        F.substring_index("id", "/", -1).alias("rid")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_digests(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can't express the models and the packing of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, lambda: stage(spark, docs, sf_dir))  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
