"""Ranked lexical search with summed accumulators of short lists beside skipped long lists.

Scores are whole numbers: a term's weight grows with its rarity, and its share in a
document with its count there, dampened by the document's length.

1. One pass over the documents builds the index: each task cuts what it reads into
   segments of about ``SEGMENT_BYTES`` and keeps, sorted by document, the lists of the terms that
   some query has (a fixed-size bitmap of hashed query terms tells which; a false hit
   costs a list that nobody reads).  Documents, words and documents per term are counted
   over all texts.
2. For a block of queries (``QUERY_BYTES`` of text) every segment answers each of them
   (``answers``).  Its short lists are taken term at a time and summed into accumulators.  These
   make one iterator with bounds of its own; beside it the long lists are gone through
   document at a time, ``SPAN`` documents a step: a step whose bounds don't reach the
   worst kept score is skipped, and in an opened one the lists are read by falling bound until no
   document can reach it any more.  A task keeps its worst kept score from segment to segment.
3. The best of all tasks are ranked once more for each query.

Only a block's queries and their terms' counts reach the driver.  Terms are told apart by
64-bit hashes of their bytes.

Defined cases: null texts have no terms; a query without terms, or that no document shares
a term with, gets no rows; equal scores go by ascending document id, a null id last;
repeated rows are documents of their own; queries equal in id and text are one query, those equal in id alone are
ranked one by one; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .jaccard import mixed

KEPT = 10
SEGMENT_BYTES = 16_000_000
CHUNK_BYTES = 1_000_000  # of text turned into terms at a time; a longer text is taken alone
QUERY_BYTES = 1_000_000
SPAN = 256
BITMAP_BITS = 1 << 20
#: Short lists of a query may hold as many entries together as this share of a segment's documents.
SHORT_SHARE = 0.5

# Fixed values of the score.
_WEIGHT, _SCALE, _TERM, _LENGTH, _B = 1000, 1_000_000_000, 1000, 8, 75

_U, _BASE = np.uint64, 0x9E3779B97F4A7C15
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_INDEX = """docs long, words long, term array<long>, df array<int>, ids binary, known binary, lengths binary,
entry binary, times binary"""
_FOUND = "query int, score long, known boolean, doc_id long"


def terms(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of the texts in order, and the text that it is in."""
    lengths = np.array([len(t) for t in batch], "i8")
    b = np.frombuffer(b"".join(batch).lower(), "u1")  # lower() of bytes changes A-Z only
    ends = np.cumsum(lengths)
    inside = _IN_TERM[b]
    first = np.ones(len(b), bool)
    first[1:] = ~inside[:-1]
    first[(ends - lengths)[lengths > 0]] = True
    first &= inside
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    at = np.flatnonzero(inside)
    place = at - np.repeat(begin, np.diff(np.searchsorted(at, np.append(begin, len(b)))))
    powers = np.cumprod(np.full(int(place.max()) + 2, _BASE, "u8"))
    h = np.add.reduceat((b[at].astype("u8") + _U(1)) * powers[place], np.searchsorted(at, begin))
    return mixed(h), np.searchsorted(ends, begin, side="right")


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(40)) % _U(BITMAP_BITS)


def query_bitmap(items: DataFrame, text_col: str) -> np.ndarray:
    """One bit for each hashed term of all queries; its size is fixed."""

    def buckets(frames):
        for frame in frames:
            found = np.unique(_bucket(terms([t.encode("utf-8", "replace") for t in frame[text_col]])[0]))
            yield pd.DataFrame({"bucket": found.astype("i8")})

    rows = items.select(text_col).where(F.col(text_col).isNotNull()).mapInPandas(buckets, "bucket long")
    bits = np.zeros(BITMAP_BITS, bool)
    bits[rows.distinct().toPandas()["bucket"].to_numpy("i8")] = True
    return bits


def _pack(column: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(column).tobytes())


def _unpack(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


class _Segment:
    """Documents and their entries (term, document, times), until there are enough of them."""

    def __init__(self):
        self.size = self.words = self.counted = self.docs = 0
        self.known, self.ids, self.lengths, self.entries = [], [], [], []

    def add(self, known, ids, batch, bits):
        h, doc = terms(batch)
        lengths = np.bincount(doc, minlength=len(batch))
        self.words += len(h)
        self.counted += int((lengths > 0).sum())
        wanted = bits[_bucket(h).astype("i8")]
        h, doc = h[wanted], doc[wanted]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        head = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))) if len(h) else \
            np.zeros(0, "i8")
        times = np.diff(np.append(head, len(h)))
        self.entries.append((h[head], doc[head] + self.docs, times))
        self.known.append(np.array(known, bool))
        self.ids.append(np.array(ids, "i8"))
        self.lengths.append(lengths)
        self.docs += len(batch)
        self.size += sum(map(len, batch))

    def row(self):
        known, ids, lengths = (np.concatenate(c) for c in (self.known, self.ids, self.lengths))
        term, doc, times = (np.concatenate(c) for c in zip(*self.entries))
        place = np.empty(len(ids), "i8")
        place[np.lexsort((ids, ~known))] = np.arange(len(ids))
        back = np.argsort(place)
        order = np.lexsort((place[doc], term))
        term, doc, times = term[order], place[doc][order], times[order]
        head = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, "i8")
        return (self.counted, self.words, term[head].view("i8").tolist(), np.diff(np.append(head, len(term))).tolist(),
                _pack(ids[back]), _pack(known[back]), _pack(lengths[back].astype("i8")), _pack(doc.astype("u4")),
                _pack(times.astype("u4")))


def build_index(docs: DataFrame, bits: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the documents' lists, stored once."""
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    rows = docs.select(docs[id_col].isNotNull().alias("known"), F.coalesce(docs[id_col].cast("long"), F.lit(0)).alias("id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    names = [c.split()[0] for c in _INDEX.replace("\n", " ").split(", ")]

    def segments(frames):
        wanted = np.unpackbits(held.value).astype(bool)
        segment, batch, size = _Segment(), ([], [], []), 0
        for frame in frames:
            for known, doc, text in zip(frame["known"].tolist(), frame["id"].tolist(), frame["text"]):
                raw = text.encode("utf-8", "replace")
                if size and size + len(raw) > CHUNK_BYTES:
                    segment.add(*batch, wanted)
                    batch, size = ([], [], []), 0
                    if segment.size >= SEGMENT_BYTES:
                        yield pd.DataFrame([segment.row()], columns=names)
                        segment = _Segment()
                for column, value in zip(batch, (known, doc, raw)):
                    column.append(value)
                size += len(raw)
        if batch[0]:
            segment.add(*batch, wanted)
        if segment.docs:
            yield pd.DataFrame([segment.row()], columns=names)

    return written(rows.mapInPandas(segments, _INDEX), "index")


class _Open:
    """A segment with the impacts of the terms that a block of queries has."""

    def __init__(self, row, vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int):
        self.ids, self.known = _unpack(row.ids, "i8"), _unpack(row.known, "?")
        m = 100 - _B + (_B * _unpack(row.lengths, "i8") * n_docs) // n_words
        df = np.asarray(row.df, "i8")
        ends = np.cumsum(df)
        term = np.asarray(row.term, "i8").view("u8")
        at = np.searchsorted(vocabulary, term)
        at[at == len(vocabulary)] = 0
        used = np.flatnonzero(vocabulary[at] == term) if len(vocabulary) else np.zeros(0, "i8")
        entries = np.concatenate([np.arange(e - n, e) for e, n in zip(ends[used], df[used])]) if len(used) else used
        self.doc = _unpack(row.entry, "u4")[entries].astype("i8")
        times = _unpack(row.times, "u4")[entries].astype("i8")
        self.impact = np.repeat(weights[at[used]], df[used]) * (
            (_SCALE * times) // (_TERM * times + _LENGTH * m[self.doc]))
        self.size = df[used]
        self.begin = np.cumsum(self.size) - self.size
        self.list_of = np.full(len(vocabulary), -1, "i8")
        self.list_of[at[used]] = np.arange(len(used))
        # bounds and entries of each list in each span of documents
        self.spans = -(-len(self.ids) // SPAN)
        cell = np.repeat(np.arange(len(used)), self.size) * self.spans + self.doc // SPAN
        self.cells = np.searchsorted(cell, np.arange(len(used) * self.spans + 1))
        self.most = np.zeros(len(used) * self.spans, "i8")
        if len(cell):
            head = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            self.most[cell[head]] = np.maximum.reduceat(self.impact, head)
        self.most = self.most.reshape(-1, self.spans)


def answers(segment: _Open, query: np.ndarray, times: np.ndarray, floor: int, most: int = KEPT):
    """The places and scores of the documents that may be among the ``most`` best; ``floor``: the worst kept so far."""
    lists = segment.list_of[query]
    times, lists = times[lists >= 0], lists[lists >= 0]
    bound = segment.most[lists] * times[:, None]
    if not len(lists) or bound.sum(axis=0).max() < max(floor, 1):
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    order = np.argsort(segment.size[lists], kind="stable")
    lists, times, bound = lists[order], times[order], bound[order]
    n = len(segment.ids)
    short = int(np.searchsorted(np.cumsum(segment.size[lists]), n * SHORT_SHARE, side="right"))
    # term at a time: the short lists summed
    summed = np.zeros(segment.spans * SPAN, "i8")
    for i in range(short):
        a = segment.begin[lists[i]]
        b = a + segment.size[lists[i]]
        summed[segment.doc[a:b]] += segment.impact[a:b] * times[i]
    own_bound = summed.reshape(-1, SPAN).max(axis=1)
    if n > most:  # that many documents reach this already
        floor = max(floor, int(np.partition(summed, len(summed) - most)[len(summed) - most]))
    # document at a time: the sums and the long lists, by spans
    lists, times, bound = lists[short:], times[short:], bound[short:]
    places, scores = np.zeros(0, "i8"), np.zeros(0, "i8")
    for span in np.flatnonzero(own_bound + bound.sum(axis=0) >= max(floor, 1)):
        rest = int(bound[:, span].sum())
        if own_bound[span] + rest < floor:
            continue
        own = summed[span * SPAN:(span + 1) * SPAN].copy()
        for i in np.argsort(-bound[:, span], kind="stable"):
            if own.max() + rest < floor:
                break
            rest -= int(bound[i, span])
            cell = lists[i] * segment.spans + span
            a, b = segment.cells[cell], segment.cells[cell + 1]
            own[segment.doc[a:b] - span * SPAN] += segment.impact[a:b] * times[i]
        else:
            good = np.flatnonzero(own >= max(floor, 1))
            if len(good):
                places = np.concatenate((places, good + span * SPAN))
                scores = np.concatenate((scores, own[good]))
                if len(places) > most:
                    best = np.lexsort((places, -scores))[:most]
                    places, scores = places[best], scores[best]
                if len(places) == most:
                    floor = max(floor, int(scores.min()))
    return places, scores


def _query(text: str):
    return np.unique(terms([text.encode("utf-8", "replace")])[0], return_counts=True)


def search(index: DataFrame, items: DataFrame, most: int = KEPT, item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each query's best documents in ``index``."""
    spark = index.sparkSession
    total = index.agg(F.sum("docs"), F.sum("words")).first()
    n_docs, n_words = total[0] or 0, total[1] or 0
    asked = (items.select(items[item_id].cast("long").alias("item_id"), items[item_text].alias("text"))
             .where("text is not null").distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // QUERY_BYTES)
    counts = index.select(F.explode(F.arrays_zip("term", "df")).alias("e")).groupBy("e.term").agg(
        F.sum("e.df").alias("df"))
    counts = written(counts, "terms") if blocks and n_docs else counts

    def block_of(block: int) -> DataFrame:
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        rows = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        queries = [_query(text) for _, text in rows]
        vocabulary = np.unique(np.concatenate([q for q, _ in queries]))
        wanted = spark.createDataFrame(pd.DataFrame({"term": vocabulary.view("i8")}), "term long")
        found = counts.join(wanted, "term", "left_semi").toPandas()
        df = np.zeros(len(vocabulary), "i8")
        df[np.searchsorted(vocabulary, found["term"].to_numpy("i8").view("u8"))] = found["df"].to_numpy("i8")
        weights = np.array([math.floor(_WEIGHT * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], "i8")
        held = spark.sparkContext.broadcast(
            (vocabulary, weights, [(np.searchsorted(vocabulary, q), t) for q, t in queries]))

        def answer(frames):
            vocabulary, weights, queries = held.value
            best = [[] for _ in queries]
            for frame in frames:
                for row in frame.itertuples():
                    segment = _Open(row, vocabulary, weights, n_docs, n_words)
                    for kept, (query, times) in zip(best, queries):
                        floor = -kept[-1][0] if len(kept) == most else 0
                        places, scores = answers(segment, query, times, floor, most)
                        if len(places):
                            kept += zip((-scores).tolist(), (~segment.known[places]).tolist(),
                                        segment.ids[places].tolist())
                            kept.sort()
                            del kept[most:]
            yield pd.DataFrame([(i, -s, not u, d) for i, kept in enumerate(best) for s, u, d in kept],
                               columns=["query", "score", "known", "doc_id"])

        order = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("known"), "doc_id")
        ranked = (index.select("term", "df", "ids", "known", "lengths", "entry", "times").mapInPandas(answer, _FOUND)
                  .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most))
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "query int, item_id long")
        return ranked.join(names, "query").select(
            "item_id", F.col("rank").cast("int").alias("rank"),
            F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "score")

    if not blocks or not n_words:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, [block_of(b) for b in range(blocks)])


def ranked_search(docs: DataFrame, items: DataFrame, most: int = KEPT, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Index all documents for the terms of all queries, and answer them."""
    return search(build_index(docs, query_bitmap(items, item_text), id_col, text_col), items, most, item_id, item_text)
