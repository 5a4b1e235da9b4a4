"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Large pieces (over a third of the capacity) fit at most twice into a sequence:
they are matched greedily, the longest with the longest partner that fits.
Smaller pieces, longest first, go where the remaining gap is smallest; a new
sequence opens only when no gap fits.

Lengths are whole numbers up to the capacity, so the matching runs on the counts
per length (at most ``capacity`` rows reach the driver, at any corpus size).  Its
result is a list of rank ranges: "pieces of length L ranked a to b go to
sequences s, s+1, ... at offset o".  Pieces get their rank within their length
from windows over (length, salt), so a length that holds most rows is spread
over many tasks, and each takes its place by looking its rank up.

Defined cases: a null or empty text is one piece that holds only the end id;
repeated rows are pieces of their own; null ids stay; an empty table gives an
empty result; other columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, written

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Words whose ids a Python worker remembers, at most.
REMEMBERED = 400_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Python's split() also splits at these, which are not white space to the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_MARKS = ".,;:!?"
# Words of these letters alone are split no further, are in composed form, and have one lower-case letter each.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# How byte-level vocabularies write a byte: printable ones as themselves, the others as U+0100 and on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - _PRINTED))}
TOGETHER = 50  # texts whose new words are learnt at a time
_workers: dict = {}


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes, word by word with a bounded memory.

    The tokenizer never joins characters across white space, nor one of ``_LETTERS`` with one
    of ``_MARKS``, so the ids of a text are those of its words and marks in order.  Any other word is
    given to the tokenizer with its marks: what a letter becomes in composed form or lower case
    may end in a sign that is joined with them.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        self.known: dict[str, bytes] = {}  # words as they are written
        self.parts: dict[str, bytes] = {}  # plain words without marks, in lower case; marks

    def _learn(self, words: set[str]) -> None:
        known, parts, tokenize = self.known, self.parts, self.model.tokenize
        if len(parts) > self.remembered:
            parts.clear()
        marked, others = [], []
        for word in words:
            core = word.rstrip(_MARKS)
            if not (core.isalpha() if core.isascii() else _LETTERS.fullmatch(core)):
                others.append(word)
                continue
            low = core.lower()
            ids = parts.get(low)
            if ids is None:  # one token string; the normaliser has nothing to do but lower case
                own = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTE_CHARS)
                ids = parts[low] = array("I", [t.id for t in tokenize(own)]).tobytes()
            if len(core) == len(word):
                known[word] = ids
            else:
                marked.append((word, ids, word[len(core):]))
        new = [*others, *{marks for _, _, marks in marked if marks not in parts}]
        if new:
            got = self.tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids, at = np.array(got.ids, "<u4"), np.array(got.word_ids, "i8")
            raw, ends = ids.tobytes(), (4 * np.searchsorted(at, np.arange(len(new) + 1))).tolist()
            for k, (word, a, b) in enumerate(zip(new, ends[:-1], ends[1:])):
                (known if k < len(others) else parts)[word] = raw[a:b]
        for word, ids, marks in marked:
            known[word] = ids + parts[marks]

    def of(self, text: str) -> bytes:
        return next(self.of_all([text]))

    def of_all(self, texts: list[str]):
        """The ids of each text in turn."""
        known = self.known
        for at in range(0, len(texts), TOGETHER):
            words = [[] if _SEPARATORS.search(t) else t.split() for t in texts[at:at + TOGETHER]]
            if len(known) > self.remembered:
                known.clear()
            new = set().union(*words).difference(known)
            if new:
                self._learn(new)
            for text, own in zip(texts[at:at + TOGETHER], words):
                if not own and _SEPARATORS.search(text):
                    yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                else:
                    yield b"".join(map(known.__getitem__, own))


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """The pieces of each document: its ids and ``end_id``, cut after every ``capacity`` ids."""

    own = (tokenizer_path, remembered)

    def cut(frames):
        ids_of = _workers.get(own) or _workers.setdefault(own, WordIds(*own))
        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for frame in frames:
            out = []
            for doc, ids in zip(frame["doc_id"], ids_of.of_all(frame["text"].tolist())):
                raw = ids + end
                for piece, at in enumerate(range(0, len(raw), step)):
                    part = raw[at:at + step]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            made = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield made.astype({"doc_id": "Int64"})

    return texts(docs, id_col, text_col).mapInPandas(cut, PIECE_SCHEMA)


def match(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces: (length, first rank, first sequence, pieces a sequence, offset)."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    out, sequences = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number of them)
    order: list[int] = []  # the gaps there are, ascending

    def put(length, first, n, each, offset):
        out.append((length, rank[length], first, each, offset))
        rank[length] += n * each
        left[length] -= n * each

    def leave(gap, first, n):
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect_left(large, capacity - length + 1) - 1
            while at >= 0 and not (left[large[at]] > (large[at] == length)):
                at -= 1
            partner = large[at] if at >= 0 else None
            if partner is None:
                n = left[length]
                put(length, sequences, n, 1, 0)
                leave(capacity - length, sequences, n)
            elif partner == length:
                n = left[length] // 2
                put(length, sequences, n, 2, 0)
                leave(capacity - 2 * length, sequences, n)
            else:
                n = min(left[length], left[partner])
                put(length, sequences, n, 1, 0)
                put(partner, sequences, n, 1, length)
                leave(capacity - length - partner, sequences, n)
            sequences += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, there = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, first, there = capacity, sequences, None
            each = min(gap // length, left[length])
            n = left[length] // each if there is None else min(there, left[length] // each)
            put(length, first, n, each, capacity - gap)
            leave(gap - each * length, first, n)
            if there is None:
                sequences += n
            else:
                leave(gap, first + n, there - n)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.  ``pieces`` should be a stored table: it is read twice."""
    salts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    groups = keyed.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = np.array(sorted(match(counts, capacity)), "i8").reshape(-1, 5)
    keys = places[:, 0] * (1 << 44) + places[:, 1]
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (keyed.withColumn("own", F.row_number().over(own)).join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("own") - 1))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy("i8"), rank.to_numpy("i8")
        at = np.searchsorted(keys, n * (1 << 44) + r, side="right") - 1
        _, first, sequence, each, offset = places[at].T
        j = r - first
        return pd.DataFrame({"sequence_id": sequence + j // each, "offset": offset + j % each * n})

    return (ranked.withColumn("at", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """Tokenise, cut and pack; the pieces (a few numbers each) are stored once in between."""
    return pack(written(tokenized(docs, tokenizer_path, end_id, capacity, id_col, text_col, remembered),
                        "pieces"), capacity)
