"""Training-data pipeline: from raw documents to one mixed sequence.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's docs.

1. language ID: documents that the models reject (no letter, or a cross-entropy beyond
   the calibrated limits) go;
2. exact dedup: of equal texts (white space aside) the smallest doc_id stays;
3. SimHash near-dedup: of each group within 4 bits over 4-word shingles the smallest
   doc_id stays;
4. benchmark decontamination: documents with a window of a benchmark item go;
5. mixing: every document that is left gets its place by target weights.

The first four return the columns they were given; the last adds the schedule's.

Defined results: a null, empty or letterless text goes at the first stage. Of rows that
repeat id and text, or only the text, one stays after the second. A null doc_id is a
document like any other that sorts after all ids; a null lang teaches nothing, a null
source is mixed with the sources without a weight of their own. An empty table passes
as an empty table, and so does one that a stage empties. Texts of any length are taken
whole. Other columns pass through all stages whatever their names, but those that the
last stage adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import op1_simhash, op3_exact, op4_mix, op9_langid, op10_decontam
from ledgerlens.llm.frames import documents, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_exact.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_simhash.dedup(docs, shingle=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_mix.mix(docs, op4_mix.WEIGHTS, op4_mix.OTHER_WEIGHT, op4_mix.BLOCK)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near),
          ("decontaminate", decontaminate), ("mix", mix)]

#: Kneser-Ney models and SimHash components are beyond SQL; tests hold run() against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
