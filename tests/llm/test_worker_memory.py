"""What a Python worker holds at a time."""

import random
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyspark.llm import common, jaccard, stages
from tallyspark.llm.common import table

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def random_texts(n, words):
    r = random.Random(3)
    known = ["".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(3000)]
    return [" ".join(r.choices(known, k=words)).encode() for _ in range(n)]


def test_a_chunk_of_texts_takes_a_few_times_its_bytes():
    batch = random_texts(600, 500)
    size = sum(map(len, batch))
    assert 1_500_000 < size <= jaccard.CHUNK_BYTES
    tracemalloc.start()
    sets, counts = jaccard.shingle_sets(batch, 5)
    first = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    jaccard.part_signatures(sets, counts, 80)
    second = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first < 10 * size and second < 10 * size


def test_pieces_change_no_set_and_no_signature(monkeypatch):
    texts = [*random_texts(30, 40), b"", b" \n", b"one", b"x" * 900, *random_texts(3, 300)]
    whole = jaccard.shingle_sets(texts, 4)
    parts = jaccard.part_signatures(*whole, 85)
    for name, most in (("PIECE_BYTES", 500), ("HASHED_BYTES", 50), ("PIECE_SHINGLES", 60)):
        monkeypatch.setattr(jaccard, name, most)
    cut = jaccard.shingle_sets(texts, 4)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))
    again = jaccard.part_signatures(*cut, 85)
    assert sorted(zip(parts[1].tolist(), parts[0].tolist())) == sorted(zip(again[1].tolist(), again[0].tolist()))
    assert np.array_equal(parts[2], again[2])


def test_stages_send_few_bytes_at_a_time(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    before = spark.conf.get(KEY, None)
    try:
        for stage in (stages.reject_toxic, stages.near_duplicates, stages.decontaminated, stages.packed):
            spark.conf.unset(KEY)
            stage(spark, docs.limit(20), sf_small)
            rows = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("abcdefgh"), 400).alias("text"))

            def size(frames):
                yield pd.DataFrame({"n": [int(f["text"].str.len().sum()) for f in frames]})

            sizes = [r["n"] for r in rows.mapInPandas(size, "n long").collect()]
            assert sum(sizes) == 6000 * 3200 and max(sizes) <= common.BATCH_BYTES
        spark.conf.set(KEY, 1 << 30)
        common.small_batches(spark)
        assert int(spark.conf.get(KEY)) == 1 << 30  # a session's own choice stays
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)
