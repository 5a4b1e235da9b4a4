"""Sketches, candidate buckets and components against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import minhash_dedup as dedup
from tallyspark.llm.common import ship
from tallyspark.llm.jaccard import shingle_sets

UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, component_id long, kept string, lead int, n string"


def shingles(text, size):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [(d, shingles(t, size)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    return sorted((str(d), len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets)


def made(seed, families, loose=0.2):
    """Families of edited copies around the threshold, exact copies, and odd rows."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]
    rows, doc = [], 1
    for _ in range(families):
        base = r.choices(words, k=r.choice([3, 6, 12, 30, 80, 150]))
        for _ in range(r.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(int(len(text) * r.random() * loose / 3)):
                text[r.randrange(len(text))] = r.choice(words)
            rows += [(doc + k, " ".join(text)) for k in range(r.choice([1, 1, 3]))]
            doc += 3
    rows += [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One"), (9005, "oNE"), (None, rows[0][1]), (9006, rows[0][1].upper()),
             (9007, "x" * 60_000), (9008, "é漢🙂 " * 30), (9008, "é漢🙂 " * 30), (9009, " ".join(r.choices(words, k=6000)))]
    r.shuffle(rows)
    return rows


def run(spark, rows, size=4, percent=80):
    ship(spark)
    df = spark.createDataFrame([(*row, 5, "k", 1, "n") for row in rows], SCHEMA)
    got = dedup.minhash_components(df.repartition(7, F.rand(3)), size, percent).collect()
    return sorted((str(g["doc_id"]), g["n_shingles"], g["component_id"], g["kept"]) for g in got)


def test_matches_brute_force(spark):
    rows = made(3, 120)
    assert run(spark, rows) == brute(rows, 4, 80)


def test_blocks_of_large_families(spark, monkeypatch):
    """Families of many blocks, most of whose members link with few others, lose no link."""
    monkeypatch.setattr(dedup, "BLOCK", 4)
    r = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for d in range(150):
        text = list(base)
        for _ in range(r.choice([1, 3, 5])):
            text[r.randrange(len(text))] = f"x{r.randrange(500)}"
        rows.append((d, " ".join(text)))
    rows += [(1000 + k, t) for k, (_, t) in enumerate(rows[:30])]
    assert run(spark, rows) == brute(rows, 4, 80)


def test_sketches_estimate_similarity():
    """Coordinates agree as often as the sets are similar, for small and large sets; every one is filled."""
    r = np.random.default_rng(5)
    for n, same in ((5, 4), (40, 30), (400, 360), (3000, 1500)):
        estimates = []
        for _ in range(30):
            pool = r.integers(0, 1 << 63, 2 * n - same).astype("u8")
            a, b = pool[:n], np.concatenate((pool[:same], pool[n:]))
            rows = dedup.sketches(np.concatenate((a, b)), np.array([len(a), len(b)]))
            assert (rows != dedup._EMPTY).all()
            estimates.append((rows[0] == rows[1]).mean())
        true = same / (2 * n - same)
        assert abs(np.mean(estimates) - true) < 0.03, (n, np.mean(estimates), true)


def test_block_links_are_exact():
    r = random.Random(4)
    texts = [" ".join(r.choices("a b c d e f".split(), k=r.randint(1, 9))) for _ in range(60)]
    sets, counts = shingle_sets([t.encode() for t in texts], 2)
    ends = np.cumsum(counts)
    own = [sets[e - n:e] for e, n in zip(ends, counts)]
    block = list(range(60)), list(range(60)), own
    got = set(dedup.links_of_blocks(block, block, 80))
    rows = [(k, t) for k, t in enumerate(texts)]
    parent = {k: k for k in range(60)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    assert sorted((str(k), n, find(k), find(k) == k) for k, n in enumerate(counts.tolist())) == brute(rows, 2, 80)


def test_empty_table_and_rows_kept(spark):
    assert run(spark, []) == []
    ship(spark)
    df = spark.createDataFrame([(2, "a b c d e f", 1, "k", 1, "n"), (1, "A B C D E F", 1, "k", 1, "n"), (None, "a b c d e f", 1, "k", 1, "n")], SCHEMA)
    out = dedup.without_copies(df)
    assert out.columns == df.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "None"]
    with pytest.raises(ValueError):
        dedup.minhash_components(df, percent=50)
