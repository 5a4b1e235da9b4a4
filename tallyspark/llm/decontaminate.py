"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

An item of length L occurs in a text with at most k edits (``k = EDIT_RATE * L``)
only if the two share at least ``L - q + 1 - k * q`` q-grams whose diagonals (text
place minus item place) lie within 2k of each other.  Shared q-grams are
therefore counted in overlapping diagonal bands; bands that reach the bound are
verified by an alignment restricted to the band.

Texts and items are compared character by character after lower-casing A-Z and
writing every white-space character as a blank.  Items are cut into chunks of
about ``CHUNK_CHARS`` characters by a hash; the index of one chunk is small
enough for every task, and each chunk scans the documents once, so a benchmark
of any size is handled.

An occurrence is that of a whole item within its edit budget; a quote of a part of an item is none.

Defined cases: null and empty texts have no passages; items shorter than
``LEAST_ITEM`` characters or null are ignored, repeated item rows count once;
repeated document rows each give their rows; null ids are kept; an empty
benchmark gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, texts

Q = 8
EDIT_RATE = 0.08
LEAST_ITEM = 24
CHUNK_CHARS = 4_000_000
#: Characters of text that are scanned at a time (a longer text is scanned alone).
SCANNED = 500_000
#: (document, item) pairs that are counted in one array; more are counted by sorting.
MOST_PAIRS = 2_000_000
SCHEMA = "doc_id long, item_id long, start long, end long, edits int"

_FOLD = np.arange(0x100, dtype="u4")
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_STEP = 0xD6E8FEB86659FD93
_LAST = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    low = c < 0x100
    return np.where(low, _FOLD[np.where(low, c, 0)], c)


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` (8) characters at each place: three doublings of a polynomial."""
    h, r = c.astype("u8") + np.uint64(1), _STEP
    for width in (1, 2, 4):
        h = h[:-width] * np.uint64(r) + h[width:]
        r = r * r % (1 << 64)
    return h * _LAST


def budget(length: int) -> int:
    """Edits allowed for an item: the rate's, as far as the lemma's bound stays positive."""
    return min(int(EDIT_RATE * length), (length - Q) // Q)


class Index:
    """The q-grams of some items, with a bit table in front."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.items = [folded(t) for _, t in items]
        length = np.array([len(c) for c in self.items], "i8")
        self.length, self.k = length, np.array([budget(n) for n in length], "i8")
        self.bound = length - Q + 1 - self.k * Q
        grams = [gram_hashes(c) for c in self.items]
        h = np.concatenate(grams) if grams else np.zeros(0, "u8")
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, "i8")
        order = np.argsort(h, kind="stable")
        self.h, first, self.n = np.unique(h[order], return_index=True, return_counts=True)
        self.first, self.item, self.place = first, item[order], place[order]
        bits = max(16, int(len(h) * 32).bit_length())
        self.shift = np.uint64(64 - bits)
        slot = (self.h >> self.shift).astype("i8")
        self.table = np.full(1 << bits, -1, "i4")  # the first of the sorted hashes that begin with these bits
        self.table[slot[::-1]] = np.arange(len(slot))[::-1]
        self.run = int(np.bincount(slot).max(initial=0)) if len(slot) else 0

    def regions(self, c: np.ndarray, ends: np.ndarray):
        """(document, item, smallest diagonal, band width, shared q-grams) of bands that reach their bound.

        ``c`` holds documents end to end, ``ends`` where each stops.
        """
        if len(c) < Q or not len(self.h):
            return []
        g = gram_hashes(c)
        slot = self.table[g >> self.shift]
        maybe = np.flatnonzero(slot >= 0)
        slot, g = slot[maybe], g[maybe]
        found = np.full(len(maybe), -1, "i8")
        for step in range(self.run):
            tried = np.minimum(slot + step, len(self.h) - 1)
            np.copyto(found, tried, where=self.h[tried] == g)
        ok = found >= 0
        at, found = maybe[ok], found[ok]
        doc = np.searchsorted(ends, at, side="right")
        ok = at + Q <= ends[doc]
        at, found, doc = at[ok], found[ok], doc[ok]
        if not len(at):
            return []
        n = self.n[found]
        which = np.repeat(self.first[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.item[which]
        doc, at = np.repeat(doc, n), np.repeat(at, n)
        pair = doc.astype("i8") * len(self.items) + item
        if len(ends) * len(self.items) <= MOST_PAIRS:
            total = np.bincount(pair)[pair]
        else:
            _, back, total = np.unique(pair, return_inverse=True, return_counts=True)
            total = total[back]
        ok = total >= self.bound[item]  # before bands: enough shared q-grams at all
        pair, item, at, which = pair[ok], item[ok], at[ok], which[ok]
        if not len(pair):
            return []
        starts = np.concatenate(([0], ends[:-1]))
        diagonal = at - starts[pair // len(self.items)] - self.place[which] + self.length[item]
        width = 2 * self.k[item] + 1
        band = diagonal // width
        # a band reaches over two widths, so that any 2k + 1 diagonals lie in one
        twice = lambda x: np.concatenate((x, x))
        key = twice(pair), np.concatenate((band, band - 1)), twice(at), twice(self.place[which])
        order = np.lexsort((key[2], key[1], key[0]))
        p, b, a, place = (x[order] for x in key)
        fresh = np.concatenate(([True], (np.diff(p) != 0) | (np.diff(b) != 0)))
        new = fresh | np.concatenate(([True], np.diff(a) != 0))  # a text place counts once in a band
        group = np.cumsum(fresh) - 1
        count = np.bincount(group, weights=new)
        head = np.flatnonzero(fresh)
        items = p[head] % len(self.items)
        rest = (count >= self.bound[items])[group]
        own = np.unique(group[rest] * (1 << 32) + place[rest]) >> 32  # an item place counts once too
        count = np.minimum(count, np.bincount(own, minlength=len(count)))
        out = []
        for j in np.flatnonzero(count >= self.bound[items]):
            i = int(items[j])
            w = 2 * int(self.k[i]) + 1
            out.append((int(p[head[j]] // len(self.items)), i, int(b[head[j]]) * w - int(self.length[i]), 2 * w,
                        int(count[j])))
        return out


def align(item: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int]:
    """Fewest edits of ``item`` against a stretch of ``text``, and the stretch's end.

    Only places whose diagonal is in ``[low, low + width)`` are looked at.
    """
    steps = np.arange(width, dtype="i8")
    at = low + steps  # text characters used before item character 0
    far = 1 << 30
    row = np.where((at >= 0) & (at <= len(text)), 0, far)
    padded = np.concatenate((text, np.zeros(1, text.dtype)))
    for j, ch in enumerate(item):
        here = at + j  # the text character that a match would use
        inside = (here >= 0) & (here < len(text))
        same = inside & (padded[np.where(inside, here, len(text))] == ch)
        use = np.where(inside, row + ~same, far)
        skip = np.concatenate((row[1:], [far])) + 1  # an item character without a text character
        row = np.minimum(use, skip)
        row = np.where((here + 1 >= 0) & (here + 1 <= len(text)), row, far)
        row = np.minimum.accumulate(row - steps) + steps  # text characters without an item character
    end = int(row.argmin())
    return int(row[end]), int(low + end + len(item))


def occurrences(index: Index, doc: np.ndarray, regions: list[tuple[int, int, int, int]]):
    """(item, start, end, edits) of the verified regions of one document; of overlapping ones the best.

    Regions come with the most shared q-grams first; one whose diagonals hold an
    occurrence already found is not aligned again, and one without edits needs no alignment.
    """
    raw = doc.tobytes()
    found: dict[int, list] = {}
    for i, low, width, _ in sorted(regions, key=lambda r: -r[3]):
        item, k = index.items[i], int(index.k[i])
        hits = found.setdefault(i, [])
        if any(low <= start < low + width for _, start, _ in hits):
            continue
        whole = raw.find(item.tobytes(), 4 * max(0, low), 4 * max(0, low + width + len(item)))
        if whole >= 0 and whole % 4 == 0:
            hits.append((0, whole // 4, whole // 4 + len(item)))
            continue
        edits, end = align(item, doc, low, width)
        if edits > k:
            continue
        back, length = align(item[::-1], doc[max(0, end - len(item) - k):end][::-1], -k, 2 * k + 1)
        hits.append((edits, end - length if back <= edits else max(0, end - len(item)), end))
    for i, hits in found.items():
        kept: list = []
        for hit in sorted(hits):
            if all(hit[2] <= x[1] or hit[1] >= x[2] for x in kept):
                kept.append(hit)
        for edits, start, end in kept:
            yield i, start, end, edits


def scan(index: Index, ids, batch: list[str]):
    """Rows ``(doc id, item id, start, end, edits)`` of some documents."""
    at = 0
    while at < len(batch):
        stop, size, codes = at, 0, []
        while stop < len(batch) and (stop == at or size + len(batch[stop]) <= SCANNED):
            codes.append(folded(batch[stop]))
            size += len(batch[stop])
            stop += 1
        by_doc: dict[int, list] = {}
        for d, *region in index.regions(np.concatenate(codes), np.cumsum([len(c) for c in codes])):
            by_doc.setdefault(d, []).append(tuple(region))
        for d, regions in by_doc.items():
            for i, start, end, edits in occurrences(index, codes[d], regions):
                yield ids[at + d], index.ids[i], start, end, edits
        at = stop


def _held_items(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str) -> list:
    """The items that are searched for, as broadcasts of about ``CHUNK_CHARS`` characters each."""
    spark = docs.sparkSession
    items = (benchmark.select(benchmark[item_id].cast("long").alias("item_id"), benchmark[item_text].alias("item"))
             .where(F.length("item") >= LEAST_ITEM).distinct())
    size = items.agg(F.sum(F.length("item"))).first()[0] or 0
    chunks, out = -(-size // CHUNK_CHARS), []
    for chunk in range(chunks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(chunks)) == chunk).collect()
        out.append(spark.sparkContext.broadcast(sorted(
            ((r["item_id"], r["item"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))))
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Occurrences of benchmark items: ``doc_id, item_id, start, end, edits`` (code points, end exclusive)."""
    t = texts(docs, id_col, text_col)

    def hits_of(held) -> DataFrame:
        def find(frames):
            index = Index(held.value)
            for frame in frames:
                found = list(scan(index, frame["doc_id"].tolist(), frame["text"].tolist()))
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "start", "end", "edits"]).astype(
                    {"doc_id": "Int64", "item_id": "Int64"})
            give_back()

        return t.mapInPandas(find, SCHEMA)

    found = [hits_of(held) for held in _held_items(docs, benchmark, item_id, item_text)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], SCHEMA)


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                     item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has no occurrence of an item: told row by row, whatever their ids are."""
    def clean(held):
        @F.pandas_udf("boolean")
        def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            give_back()
            index = Index(held.value)
            for batch in batches:
                hit = {row for row, *_ in scan(index, list(range(len(batch))), batch.tolist())}
                yield pd.Series([k not in hit for k in range(len(batch))], dtype=bool)
            give_back()

        return free(F.coalesce(docs[text_col].cast("string"), F.lit("")))

    for held in _held_items(docs, benchmark, item_id, item_text):
        docs = docs.where(clean(held))
    return docs
