"""The corpus pipeline: five stages over `documents`, each one of the operators of
``stayledger.llm``, each working on all that the one before it kept.

1. language_id: documents without a letter, or out of reach of every learned
   language, go.
2. line_dedup: of lines that are alike (Jaccard 0.8 of 8-character shingles), the
   first in the corpus stays; documents left without text go.
3. simhash: of documents linked at 4 differing bits or fewer, one stays.
4. decontaminate: documents one in 20 of whose words stand in a benchmark window
   go; the hit words of the others are cut out.
5. segment: two distinct sampled segmentations of each text, as piece ids.

All but the last return the columns of `documents`.

Defined results: a null or empty text goes at the first stage, as it has no letter; rows
that repeat doc_id and text are one document and get the same treatment (of a group of
near duplicates the smallest doc_id stays, a null one last; of alike lines the first by
doc_id and place); an empty table gives an empty one at every stage; extra columns
are carried along by all but the last stage, whatever their names; texts of any length
are taken whole, each held in the memory of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayledger.llm.decontaminate import remove_contaminated
from stayledger.llm.frames import spill, table, whole_texts
from stayledger.llm.langid import fit_on_documents, predict
from stayledger.llm.lines import dedup_lines
from stayledger.llm.simhash import keep_one
from stayledger.llm.subwords import encode_samples


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole_texts(spark)
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = predict(rows, fit_on_documents(docs))
    return found.where(~F.col("rejected")).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole_texts(spark)
    return dedup_lines(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole_texts(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole_texts(spark)
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole_texts(spark)
    return encode_samples(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontaminate", decontaminate),
    ("segment", segment),
]

#: SQL cannot state the centroids, the fuzzy lines or the sampled segmentations;
#: tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the stages before it are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
