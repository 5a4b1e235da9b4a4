"""The corpus pipeline: each stage works on what its predecessor kept, written as Parquet and read again.

Stages: toxicity (rejected documents go), n-gram Jaccard join (one document of
each group stays), benchmark decontamination (documents with a benchmark passage
go), personal data (spans become tags), packing (documents become sequences).
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import stages
from tallyspark.llm.common import table, written

STAGES = [
    ("toxicity", stages.reject_toxic),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontaminated),
    ("personal_data", stages.personal_data),
    ("packing", stages.packed),
]

#: The stages hold trained scores, alignments and packing, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
