"""The pipeline's stages against plain Python on a small table, row by row."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import decontaminate, packing, stages, toxicity
from tallyspark.llm.common import fold_of, table, written


def brute_pii(text):
    """Every match of a base kind that holds, as in the test of the operator."""
    from test_text_operators import brute_pii as found
    return found(text)


def linked_rows(texts, size, percent):
    """The group of each text: the place of the first one that it is linked with, over any number of links."""
    from test_minhash_dedup import shingles
    sets = [shingles(t, size) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and group[a] != group[b] and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return group


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def odd_documents(spark, sf_dir):
    """The table with rows without an id, ids with other texts, repeated rows, and extra columns of clashing names."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").orderBy("item_id").limit(3).collect()]
    texts = [r["text"] for r in docs.where("length(text) > 400").orderBy("doc_id").limit(4).collect()]
    more = [(None, "Some words first. " + items[0] + " and some after."), (None, texts[0]), (None, None), (7, ""),
            (7, "another text under the id seven, about a@b.cd and 10.0.0.1"), (7, None), (8, texts[1]), (8, texts[1]),
            (9, texts[2] + " one more"), (9000, "x " * 30_000), (9001, "Mail +1 (988) 555-2485 or 4111 1111 1111 1111."),
            (9002, items[1].upper()), (None, texts[3] + " a few words at its end")]
    extra = spark.createDataFrame([(d, t, "en", "made", None) for d, t in more], docs.schema)
    return docs.unionByName(extra).withColumn("component_id", F.lit(5)).withColumn("toxicity", F.lit("x")).withColumn(
        "__row", F.lit(1.5))


def test_stages_match_plain_python(spark, sf_small):
    docs = written(odd_documents(spark, sf_small), "odd")
    labels = table(spark, sf_small, "labels")

    kept = written(stages.reject_toxic(spark, docs, sf_small), "s1")
    scorer = toxicity.Scorer(toxicity.fit(docs, labels.where(fold_of(F.col("doc_id"), 3) != 1)))
    before = rows_of(docs)
    want = [x for x in before if scorer.score(x[1] or "") < toxicity.REJECT_AT]
    assert rows_of(kept) == want and kept.columns == docs.columns and len(want) < len(before)

    unique = written(stages.near_duplicates(spark, kept, sf_small), "s2")
    groups = linked_rows([t for _, t in want], stages.WORDS, stages.PERCENT)
    best = {}
    for k, g in enumerate(groups):
        rank = (want[k][0] is None, want[k][0] or 0)
        best[g] = min(best.get(g, (rank, k)), (rank, k))
    got = rows_of(unique)
    assert len(got) == len(best) and unique.columns == docs.columns
    assert sorted(str(d) for d, _ in got) == sorted(str(want[k][0]) for _, k in best.values())
    index = {}
    for k, row in enumerate(want):
        index.setdefault(row, groups[k])
    assert len({index[row] for row in got}) == len(got)  # one row of every group

    clean = written(stages.decontaminated(spark, unique, sf_small), "s3")
    items = ["".join(map(chr, decontaminate.folded(r["text"]))) for r in table(spark, sf_small, "benchmark").collect()]
    items = [i for i in items if len(i) >= decontaminate.LEAST_ITEM]
    left = [x for x in got if not any(i in "".join(map(chr, decontaminate.folded(x[1] or ""))) for i in items)]
    assert rows_of(clean) == left and len(left) < len(got)

    tidy = written(stages.personal_data(spark, clean, sf_small), "s4")
    assert tidy.columns == docs.columns and tidy.count() == len(left)
    by = {}
    for r in tidy.select("doc_id", "text", "n_chars").collect():
        assert not brute_pii(r["text"] or ""), r["text"]
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"] or "")
        by.setdefault(r["doc_id"], []).append(r["text"])
    for d, t in left:  # texts without a base kind's, an at sign or a digit are as they were
        if not re.search(r"[0-9@]", t or ""):
            assert t in by[d]

    pieces = stages.packed(spark, tidy, sf_small)
    sizes, used = {}, {}
    for p in pieces.collect():
        sizes.setdefault((p["doc_id"], p["piece"], p["start"], p["length"]), 0)
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert {k[0] for k in sizes} == set(by)


def test_stages_of_an_empty_table(spark, sf_small):
    docs = odd_documents(spark, sf_small).limit(0)
    for stage in (stages.reject_toxic, stages.near_duplicates, stages.decontaminated, stages.personal_data):
        docs = written(stage(spark, docs, sf_small), "empty")
        assert docs.count() == 0 and docs.columns[-1] == "__row"
    assert stages.packed(spark, docs, sf_small).count() == 0


def test_random_edits_of_items_are_found_and_others_are_not(spark):
    """Items with edits within and beyond their budget, against an exact alignment of the whole text."""
    r = random.Random(4)
    letters = "abcdefgh rstuv xyz"
    items = ["".join(r.choices(letters, k=n)) for n in (24, 40, 90, 200, 400)]
    rows = []
    for k, item in enumerate(items):
        for _ in range(14):
            own = list(item)
            for _ in range(r.randint(0, 2 * decontaminate.budget(len(item)) + 1)):
                at, kind = r.randrange(len(own)), r.randrange(3)
                own[at:at + 1] = [[], [r.choice(letters)], [own[at], r.choice(letters)]][kind]
            rows.append((len(rows), "".join(r.choices(letters, k=50)) + "".join(own) + "".join(r.choices(letters, k=50))))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.benchmark_hits(df, bench).collect()}

    def edits(item, text):  # least edits of the item anywhere in the text
        row = np.zeros(len(text) + 1, "i8")
        t = np.frombuffer(text.encode("utf-32-le"), "<u4")
        for i, c in enumerate(item, 1):
            diagonal = row[:-1] + (t != ord(c))
            new = np.concatenate(([i], np.minimum(diagonal, row[1:] + 1)))
            new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
            row = new
        return int(row.min())

    want = {(d, k) for d, t in rows for k, item in enumerate(items) if edits(item, t) <= decontaminate.budget(len(item))}
    assert got == want and 20 < len(want) < len(rows)
    kept = {x["doc_id"] for x in decontaminate.without_passages(df, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}
