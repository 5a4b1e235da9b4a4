"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of ``docs``.  Null texts count as empty.  Every decision is
about a row and its text: rows without an id, and different texts under one id, are judged like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, packing, pii, toxicity
from .common import fold_of, ship, small_batches, table, unused, written

#: Word shingles and similarity of the near-duplicate stage.
WORDS, PERCENT = 5, 80
#: Words that a tokenising worker remembers: fewer than alone, as the other stages' workers live on.
REMEMBERED = 100_000


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold (the model learns from the training fold)."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold_of(F.col("doc_id"), 3) != 1))
    name = unused(docs, "toxicity")
    return (docs.withColumn(name, toxicity.score_column(spark, model, docs["text"]))
            .where(F.col(name) < toxicity.REJECT_AT).drop(name))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows: one with the smallest id (a null id last), the first stored of those.

    The rows get a key of the stage's own, stored with them; groups and joins go by it.
    """
    small_batches(spark)
    ship(spark)
    key = unused(docs, "row")
    rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = jaccard.jaccard_components(rows, size=WORDS, percent=PERCENT, id_col=key)
    found = written(found.select(F.col("doc_id").alias("own"), "component_id"), "components")
    ids = rows.select(F.col(key).alias("own"), rows["doc_id"].isNull().alias("nameless"), rows["doc_id"].alias("id"))
    best = (found.join(ids, "own").groupBy("component_id").agg(F.min(F.struct("nameless", "id", "own")).alias("m"))
            .select(F.col("m.own").alias("own")))
    gone = written(found.select("own").join(best, "own", "left_anti"), "gone")
    return rows.join(gone, rows[key] == gone["own"], "left_anti").drop(key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    ship(spark)
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by tags; ``n_chars`` follows the new text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    n = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    small_batches(spark)
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER), remembered=REMEMBERED)
