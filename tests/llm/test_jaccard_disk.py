"""Disk of the Jaccard join: what is sent for pairs of groups, and shuffle files that nothing needs any more."""

import os
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import jaccard
from tallyspark.llm.common import written


def test_a_group_is_sent_once_for_a_block(spark, monkeypatch):
    """All pairs of a family's groups, and one more group against each: not two groups for each pair."""
    monkeypatch.setattr(jaccard, "UNIT_WORK", 200_000)
    groups = list(range(40))
    rows = [(100 * g + k, 10, g, g // 10, g) for g in groups for k in range(20)] + [(9000, 10, 90, 9, 90)]
    members = spark.createDataFrame(rows, "doc long, n long, grp long, blk long, comp long")
    pairs = [(g, h) for g in groups for h in groups if g <= h] + [(90, g) for g in groups]
    units = jaccard.work_units(spark.createDataFrame(pairs, "g long, h long"), members).collect()
    assert Counter(tuple(sorted((u["own"], u["guest"]))) for u in units) == Counter(tuple(sorted(p)) for p in pairs)
    sent = {(u["unit"], g) for u in units for g in (u["own"], u["guest"])}
    assert len({u["unit"] for u in units}) >= 4
    assert len(sent) <= 40 * 4 + 4 + 40  # by pairs, 1680 groups were sent
    blocks = {u["unit"]: set() for u in units}
    for u in units:
        blocks[u["unit"]] |= {g // 10 for g in (u["own"], u["guest"])}
    work = Counter(u["unit"] for u in units)
    assert max(work.values()) * (20 * 20 + jaccard.PAIR_WORK) <= 2 * jaccard.UNIT_WORK


def test_blocks_and_units_lose_no_link(spark, monkeypatch):
    """Near copies of a few texts, in groups, blocks and units of a few members."""
    from test_minhash_dedup import shingles
    for name, most in (("GROUP", 3), ("BLOCK_MEMBERS", 6), ("UNIT_SHINGLES", 900), ("UNIT_WORK", 500),
                       ("ROUND", 1)):
        monkeypatch.setattr(jaccard, name, most)
    r = np.random.default_rng(5)
    texts = []
    for base in range(3):
        words = [f"w{base}x{k}" for k in range(60)]
        for _ in range(40):
            own = list(words)
            for _ in range(r.integers(0, 5)):
                own[r.integers(60)] = f"e{r.integers(4)}"
            texts.append(" ".join(own))
    sets = [shingles(t, 5) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names, kept = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: names.append((name, kept(df, name))) or names[-1][1])
    result = jaccard.jaccard_components(docs, 5, 80)
    found = dict(names)
    assert [name for name, _ in names].count("links") > 2  # the first links, and a round or more
    assert not any(os.path.exists(found[name]._stored_at.removeprefix("file:"))
                   for name in ("shingles", "lists", "matrix", "sets"))
    got = {g["doc_id"]: g["component_id"] for g in result.collect()}
    assert got == dict(enumerate(group)) and 6 < len(set(group)) < 100


def test_written_leaves_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = lambda: {b.name() for b in (blocks.getAllBlocks().apply(i) for i in range(blocks.getAllBlocks().size()))
                     if b.name().startswith("shuffle_")}
    before = found()
    rows = spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))
    kept = written(rows, "t-clean")
    for _ in range(50):
        left = found() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept.agg(F.sum("n")).first()[0] == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
