"""Ranked search against scores computed document by document."""

import math
import random
import re

import numpy as np

from tallyspark.llm import lexical_search as search
from tallyspark.llm.common import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, most):
    held = [(d, TERM.findall((t or "").translate(UPPER))) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n, words = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in sorted(set(items), key=str):
        asked = TERM.findall((text or "").translate(UPPER))
        scored = []
        for d, t in held:
            m = 100 - 75 + (75 * len(t) * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                    * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in asked if x in df)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if u else d, -s) for k, (s, u, d) in enumerate(sorted(scored)[:most])]
    return sorted(out, key=str)


def run(spark, docs, items, most=10):
    ship(spark)
    d = spark.createDataFrame([(*x, "clash", 3) for x in docs], "doc_id long, text string, term string, rank int")
    i = spark.createDataFrame([(*x, 7) for x in items], "item_id long, text string, score long")
    got = search.ranked_search(d.repartition(5, "text"), i, most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def made(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of"] * 8 + [f"w{int(r.paretovariate(0.8))}" for _ in range(300)] + ["été", "漢字", "x_y", "a1", "É"]
    docs = [(k, " ".join(r.choices(words, k=r.choice([0, 1, 3, 20, 60])))) for k in range(n)]
    docs += [(None, docs[5][1]), (5, docs[5][1]), (5, "the of the"), (9000, None), (9001, " \n.,"),
             (9002, "w1 " * 5000), (9003, "z" * 70_000)]
    docs += [(10_000 + k, "w2 w3 the the of") for k in range(60)]
    items = [(k, " ".join(r.choices(words, k=r.choice([1, 2, 12, 40])))) for k in range(40)]
    return docs, items + [(1, items[1][1]), (1, "of w2"), (None, "The été"), (50, None), (51, ""), (52, "unknownterm")]


def test_matches_brute_force(spark):
    docs, items = made(4, 900)
    assert run(spark, docs, items) == brute(docs, items, 10)


def test_small_segments_and_query_blocks(spark, monkeypatch):
    """The same rows whatever the sizes of segments, spans and blocks of queries are."""
    docs, items = made(6, 300)
    monkeypatch.setattr(search, "QUERY_BYTES", 700)
    assert run(spark, docs, items, 3) == brute(docs, items, 3)


def test_answers_skip_nothing_that_counts():
    """Segments of many spans, floors carried from one to the next."""
    r = np.random.default_rng(3)
    for trial in range(30):
        n = int(r.integers(1, 3000))
        texts = [" ".join(f"t{x}" for x in r.zipf(1.4, r.integers(0, 30)) if x < 200).encode() for _ in range(n)]
        segment = search._Segment()
        segment.add([True] * n, list(range(n)), texts, np.ones(search.BITMAP_BITS, bool))
        names = [c.split()[0] for c in search._INDEX.replace("\n", " ").split(", ")]
        row = __import__("collections").namedtuple("Row", names)(*segment.row())
        vocabulary = np.unique(search.terms([" ".join(f"t{k}" for k in range(200)).encode()])[0])
        weights = r.integers(0, 9000, len(vocabulary))
        opened = search._Open(row, vocabulary, weights, segment.counted, max(1, segment.words))
        query = np.unique(r.integers(0, len(vocabulary), 12))
        times = r.integers(1, 3, len(query))
        full = np.zeros(n, "i8")
        for q, t in zip(query, times):
            at = opened.list_of[q]
            if at >= 0:
                s = slice(opened.begin[at], opened.begin[at] + opened.size[at])
                full[opened.doc[s]] += opened.impact[s] * t
        floor = int(np.sort(full)[-1 - int(r.integers(0, min(n, 40)))]) if trial % 2 else 0
        want = [(int(full[p]), int(p)) for p in np.lexsort((np.arange(n), -full))[:10] if full[p] >= max(floor, 1)]
        places, scores = search.answers(opened, query, times, floor)
        got = sorted(zip(scores.tolist(), places.tolist()), key=lambda x: (-x[0], x[1]))
        assert got[:len(want)] == want


def test_empty_tables(spark):
    docs, items = made(1, 8)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, [(1, "..."), (2, None)], items) == []
