"""From raw documents to packed training windows: each stage works on all that the one before it kept.

All stages take null, empty and very long texts, null and repeated ids, repeated rows, empty tables and further columns,
which are left behind. What becomes of them is said at each stage; none drops or joins rows beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import read, stored
from retort.llm.decontamination import phrase_matches
from retort.llm.language import UNKNOWN, identify, sample, train
from retort.llm.neardup import representatives
from retort.llm.packing import pack
from retort.llm.quality import grade, quality_model

#: What the stages take and return; other columns of a table are left behind.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document stays if its language has at least this pooled probability.
LEAST_LANGUAGE = 0.4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, selects.

    Null and empty texts are graded as an empty text, equal texts alike, very long ones whole. Without labels no
    document is told from another, and all stay. An empty table gives an empty result.
    """
    model = quality_model(docs, read(spark, sf_dir, "labels"))
    return grade(docs, model, *COLUMNS).filter("selected").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those with letters of which one language has the most, clearly enough.

    Null and empty texts, and those without letters, go; equal texts share a fate; very long texts are read whole. Without
    labelled languages nothing is rejected. An empty table gives an empty result.
    """
    net = train(*sample(docs.select("text", F.col("lang").alias("label"))))
    if net is None:  # no labels to learn from: nothing can be rejected
        return docs.select(*COLUMNS)
    found = identify(docs, net, *COLUMNS)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select(*COLUMNS)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of the least doc_id, of equal ones that of the least text hash.

    Null counts as empty, and empty texts are one class; rows alike in id and text are one document, of which one row
    stays; a class without ids keeps one row too. Very long texts are one set of shingles each. An empty table gives an
    empty result.
    """
    return representatives(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage.

    Null and empty texts have no words and stay, as do all without items in the benchmark; repeated rows are separate
    documents; very long texts are searched whole. An empty table gives an empty result.
    """
    found = phrase_matches(docs, read(spark, sf_dir, "benchmark", "item_id", "text"), *COLUMNS)
    return found.filter(F.coalesce(F.size("matches"), F.lit(0)) <= 0).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document left, by window.

    A null or empty text is one token; repeated rows and ids are separate documents; a very long text is cut into pieces,
    all of which are kept. An empty table gives an empty result.
    """
    return pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: The first two stages are trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
