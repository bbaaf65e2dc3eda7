"""A corpus from raw documents to packed sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.llm.common import read, stored, text_key
from tranche.llm.jaccard_join import near_duplicates
from tranche.llm.mixing import mixed
from tranche.llm.packing import pack_documents
from tranche.llm.quality import THRESHOLD, train, with_scores
from tranche.llm.suffix_dedup import without_repeats
from tranche.session import Intermediates, run_intermediates

_HELD: list[Intermediates] = []


def stage(function):
    """A stage whose intermediate files go when the next stage begins: its
    rows have been written by then."""
    @wraps(function)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _HELD:
            _HELD.pop().release(spark)
        with run_intermediates() as own:
            _HELD.append(own)
            return function(spark, docs, sf_dir)

    return begin


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = train(docs, read(spark, sf_dir, "labels"))
    return with_scores(docs, model, "__score").where(F.col("__score") >= THRESHOLD).drop("__score")


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: five-word shingles, a
    similarity of 0.8 or more.  It is the row with the smallest id (null ids
    last, then the smaller text key); of rows that also share the text, one.
    Rows without words link with nothing; of equal rows among them, one stays.
    """
    found = near_duplicates(docs, 5, 80, 100)
    # a component without any id, and wordless rows, are named by their text
    group = F.when((F.col("n_shingles") > 0) & F.col("component_id").isNotNull(), F.concat(F.lit("c"), F.col("component_id").cast("string"))).otherwise(
        F.concat(F.lit("t"), F.hex("tkey"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    best = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tkey"))).alias("row"))
    named = lambda i, k: F.concat(F.hex(k), F.lit(":"), F.coalesce(i.cast("string"), F.lit("")))
    keep = best.select(named(F.col("row.doc_id"), F.col("row.tkey")).alias("__row")).distinct()
    keyed = docs.withColumn("__row", named(F.col("doc_id"), text_key()))
    return keyed.join(keep, "__row").dropDuplicates(["__row"]).select(*docs.columns)


@stage
def no_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur at another place too are cut out."""
    return without_repeats(docs)


#: Wished shares of the expected tokens.  The first stage rejects documents of
#: low quality, so nothing is asked of their domains: the few words that may
#: still be theirs are brought down, not a handful of documents repeated.
MIX = {"low_clean": 0.0, "low_toxic": 0.0, "high_clean": 0.98, "high_toxic": 0.02}


@stage
def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the rates that bring the domains'
    expected tokens to the target weights ``MIX``."""
    return mixed(docs, read(spark, sf_dir, "labels"), MIX)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of at most 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", one_of_each_group),
    ("suffix_dedup", no_repeated_strings),
    ("mixing", target_mix),
    ("packing", packed),
]

#: training and packing have no SQL form; tests hold each stage to brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stored(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
