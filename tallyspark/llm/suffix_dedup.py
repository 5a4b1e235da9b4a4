"""Exact substring removal by a partitioned, deep-shallow sorted suffix array.

Every byte is removed that lies in a string of ``LENGTH`` bytes which also starts
in a document with a smaller id.

Two equal strings contain the same *anchor*: of the 8-byte strings inside, the one
that comes first in a fixed order (rarely used ones before heavily used ones, then
by hash).  A text is cut into segments, runs of string starts with the same anchor,
and segments are sent to buckets by their anchor; whatever is equal meets.  Equal
segments of a task are sent once, for the smallest document; the others' bytes are
known to go.  A bucket sorts segments by their anchors (two equal ones become one),
then all suffixes of segments whose anchor occurs again: multikey quicksort over
8-byte characters to a shallow depth, and a blind trie for each group that still
ties there.  Suffixes that agree over ``LENGTH`` bytes are neighbours; all but those
of the smallest document mark their bytes.

Which strings are heavily used is counted over all documents; it only spreads the
buckets evenly and never changes the result.

Defined cases: null and empty texts give empty results; texts shorter than
``LENGTH`` lose nothing; a match inside one document removes nothing; repeated rows
with one id count as one document and each lose the bytes marked for that id
(ids are expected to be unique); null ids are neither matched nor changed; other
columns are dropped.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, written

LENGTH = 50
ANCHOR = 8
SHALLOW = 32  # bytes ordered by the multikey quicksort, a multiple of 8
#: Bytes cut into segments at a time; a longer text is cut into slices that overlap.
CHUNK_BYTES = 1 << 21
#: Bytes whose segments are gathered before they are sent.
SEND_BYTES = 1 << 23
#: Bytes of segments whose suffixes are sorted at a time.
SORTED_BYTES = 1 << 21
SLOTS = 1 << 18
#: An 8-byte string is heavily used if its slot has this many times the mean count.
HEAVY = 16
LEVEL = 3

_U = np.uint64
_K1, _K2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_PLACE_BITS = 24
_PLACES = _U((1 << _PLACE_BITS) - 1)
_WIDTH = 96  # of a segment's row: at most 2 * LENGTH - ANCHOR bytes, rounded up
_SENT = "bucket int, kind int, n int, blob binary"
_SEGMENTS, _MARKS = 0, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _K1
    x = (x ^ (x >> _U(27))) * _K2
    return x ^ (x >> _U(31))


def words_at_each_byte(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one big-endian number (8 characters at a time)."""
    w = b.astype("u8")
    for step in (1, 2, 4):
        w = (w[:-step] << _U(8 * step)) | w[step:]
    return w


def slices(frames, most: int = CHUNK_BYTES):
    """``(ids, first byte of each slice in its text, bytes)`` of about ``most`` bytes."""
    ids, at, parts, size = [], [], [], 0
    for frame in frames:
        for doc, text in zip(frame["doc_id"], frame["text"]):
            if pd.isna(doc):
                continue
            raw = text.encode("utf-8", "surrogatepass")
            for a in range(0, max(len(raw) - LENGTH + 1, 0), most):
                part = raw[a:a + most + LENGTH - 1]
                if parts and size + len(part) > most + LENGTH:
                    yield np.array(ids, "i8"), np.array(at, "i8"), parts
                    ids, at, parts, size = [], [], [], 0
                ids.append(int(doc))
                at.append(a)
                parts.append(part)
                size += len(part)
    if parts:
        yield np.array(ids, "i8"), np.array(at, "i8"), parts


def heavy_slots(docs: DataFrame) -> np.ndarray:
    """Slots of 8-byte strings that are used heavily, counted over all documents."""

    def count(frames):
        total = np.zeros(SLOTS, "i8")
        for _, _, parts in slices(frames):
            w = words_at_each_byte(np.frombuffer(b"".join(parts), "u1"))
            total += np.bincount((_mixed(w) & _U(SLOTS - 1)).astype("i8"), minlength=SLOTS)
        at = np.flatnonzero(total > total.mean() * HEAVY / 4)
        yield pd.DataFrame({"slot": np.append(at, -1), "n": np.append(total[at], total.sum())})

    rows = docs.mapInPandas(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    all_ = sum(r["n"] for r in rows if r["slot"] < 0)
    heavy = np.zeros(SLOTS, bool)
    heavy[[r["slot"] for r in rows if r["slot"] >= 0 and r["n"] * SLOTS > all_ * HEAVY]] = True
    return heavy


def cut_segments(parts: list[bytes], heavy: np.ndarray):
    """Segments of some slices: (slice, first byte in the buffer, bytes, anchor's place in it), and the buffer."""
    b = np.frombuffer(b"".join(parts), "u1")
    w = words_at_each_byte(b)
    h = _mixed(w)
    v = (h >> _U(25) << _U(_PLACE_BITS)) | np.arange(len(h), dtype="u8")
    v |= heavy[(h & _U(SLOTS - 1)).astype("i8")].astype("u8") << _U(63)
    del h, w
    span = LENGTH - ANCHOR + 1
    have = 1
    while have < span:  # the first of ``span`` anchors from each place on
        step = min(have, span - have)
        v = np.minimum(v[:-step], v[step:])
        have += step
    anchor = (v & _PLACES).astype("i8")
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    first = np.repeat(ends - sizes, counts)
    start = first + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = np.repeat(np.arange(len(parts)), counts)
    anchor = anchor[start]
    head = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(owner) != 0))))
    runs = np.diff(np.append(head, len(start)))
    begin = start[head]
    return owner[head], begin, runs + LENGTH - 1, anchor[head] - begin, b


def rows_of(b: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The segments as rows of ``_WIDTH`` bytes, zeros after their end."""
    if len(begin) and begin.max() + _WIDTH > len(b):
        b = padded(b)
    out = np.lib.stride_tricks.sliding_window_view(b, _WIDTH)[begin] if len(begin) else np.zeros((0, _WIDTH), "u1")
    out *= np.arange(_WIDTH) < size[:, None]
    return out


def padded(b: np.ndarray) -> np.ndarray:
    """The bytes and a row's width of zeros, so that a row can be read at each place."""
    return np.concatenate((b, np.zeros(_WIDTH, "u1")))


def fingerprints(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    w = rows.view(">u8").astype("u8")
    out = _mixed(size.astype("u8"))
    for j in range(w.shape[1]):
        out = _mixed(out * _K1 + w[:, j])
    return out


def anchors(rows: np.ndarray, off: np.ndarray) -> np.ndarray:
    at = np.arange(len(rows))[:, None], off[:, None] + np.arange(ANCHOR)
    return np.ascontiguousarray(rows[at]).view(">u8").ravel().astype("u8")


class BlindTrie:
    """Orders byte strings of equal length, looking at one string only to insert another.

    An inner node is ``[place, {byte: child}]``: its strings agree before ``place``.  A
    leaf is the list of the numbers of equal strings.  The descent compares no skipped
    bytes; one comparison with the leaf reached then shows where the string branches off.
    """

    def __init__(self):
        self.root, self.strings = None, {}

    def insert(self, number: int, s: bytes) -> None:
        self.strings[number] = s
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while isinstance(node, tuple):
            place, below = node
            node = below.get(s[place]) or next(iter(below.values()))
        leaf = self.strings[node[0]]
        if leaf == s:
            node.append(number)
            return
        at = next(i for i, (x, y) in enumerate(zip(leaf, s)) if x != y)
        holder, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < at:
            holder, key, node = node, s[node[0]], node[1][s[node[0]]]
        if isinstance(node, tuple) and node[0] == at:
            node[1][s[at]] = [number]
            return
        made = (at, {leaf[at]: node, s[at]: [number]})
        if holder is None:
            self.root = made
        else:
            holder[1][key] = made

    def ordered(self) -> list[list[int]]:
        """Groups of equal strings, ascending."""
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def sort_suffixes(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that agree with another over ``LENGTH`` bytes: their numbers in order, and their class.

    Multikey quicksort with 8-byte characters; only groups that tie are refined.  What
    ties over ``SHALLOW`` bytes is ordered by a blind trie, but for groups that tie throughout.
    """
    words = words_at_each_byte(flat)
    ids, group = np.arange(len(starts)), np.zeros(len(starts), "i8")
    for depth in range(0, SHALLOW, 8):
        key = words[starts[ids] + depth]
        order = np.lexsort((key, group)) if depth else np.argsort(key)
        ids, key, group = ids[order], key[order], group[order]
        same = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        tied = np.zeros(len(ids), bool)
        tied[1:] |= same
        tied[:-1] |= same
        group = np.cumsum(np.concatenate(([True], ~same)))[tied] if len(ids) else group
        ids = ids[tied]
    if not len(ids):
        return ids, group
    agree = np.ones(len(ids) - 1, bool)
    for depth in [*range(SHALLOW, LENGTH - 8, 8), LENGTH - 8]:
        key = words[starts[ids] + depth]
        agree &= key[1:] == key[:-1]
    head = np.concatenate(([True], group[1:] != group[:-1]))
    split = np.concatenate(([False], ~agree)) & ~head
    number = np.cumsum(head) - 1
    mixed_groups = np.zeros(number[-1] + 1, bool)
    mixed_groups[number[split]] = True
    deep = mixed_groups[number]
    out_ids, out_class = [ids[~deep]], [number[~deep]]
    begins = np.flatnonzero(head)
    ends = np.append(begins[1:], len(ids))
    next_class = number[-1] + 1
    more_ids, more_class = [], []
    for g in np.flatnonzero(mixed_groups):
        trie = BlindTrie()
        for i in ids[begins[g]:ends[g]]:
            a = starts[i] + SHALLOW
            trie.insert(int(i), flat[a:a + LENGTH - SHALLOW].tobytes())
        for equal in trie.ordered():
            if len(equal) > 1:
                more_ids += equal
                more_class += [next_class] * len(equal)
                next_class += 1
    if more_ids:
        out_ids.append(np.array(more_ids))
        out_class.append(np.array(more_class))
    return np.concatenate(out_ids), np.concatenate(out_class)


def marked_starts(rows: np.ndarray, size: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, place in it) of the strings that a segment of a smaller document has too."""
    counts = size - LENGTH + 1
    owner = np.repeat(np.arange(len(size)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.append(rows.ravel(), np.zeros(8, "u1"))
    ids, classes = sort_suffixes(flat, owner * _WIDTH + place)
    if not len(ids):
        return ids, ids
    order = np.argsort(classes, kind="stable")
    ids, classes = ids[order], classes[order]
    head = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
    least = np.repeat(np.minimum.reduceat(doc[owner[ids]], head), np.diff(np.append(head, len(ids))))
    ids = np.sort(ids[doc[owner[ids]] > least])
    return owner[ids], place[ids]


def _steps(x: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
    """Differences to the value before, or (with ``doc``) the value itself where a document begins."""
    out = np.diff(x, prepend=np.int64(0))
    return out if doc is None else np.where(np.diff(doc, prepend=doc[0] - 1) != 0, x, out)


def _from_steps(steps: np.ndarray, doc: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    head = np.flatnonzero(np.diff(doc, prepend=doc[0] - 1) != 0)
    return total - np.repeat(total[head] - steps[head], np.diff(np.append(head, len(doc))))


def _pack(n: int, *columns: np.ndarray, tail: bytes = b"") -> tuple[int, bytes]:
    raw = b"".join(np.ascontiguousarray(c).tobytes() for c in columns) + tail
    return n, zstandard.ZstdCompressor(level=LEVEL).compress(raw)


def _by_doc(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """One row per document with its spans as pairs of 32-bit numbers."""
    order = np.lexsort((begin, doc))
    doc, spans = doc[order], np.stack((begin[order], end[order]), 1).astype("<u4")
    cut = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True]))) if len(doc) else np.zeros(1, "i8")
    return pd.DataFrame({"doc": doc[cut[:-1]] if len(doc) else [],
                         "spans": [spans[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]})


class _Outbox:
    """Segments waiting to be sent, and what is known to go already."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.size, self.out = buckets, [], 0, []

    def add(self, doc, begin, size, off, rows):
        """Send the smallest document's copies of each segment; mark the others."""
        h = fingerprints(rows, size)
        order = np.lexsort((begin, doc, h))
        h, doc, begin, size, off = (x[order] for x in (h, doc, begin, size, off))
        head = np.concatenate(([True], h[1:] != h[:-1]))
        least = doc[np.flatnonzero(head)][np.cumsum(head) - 1]
        gone = doc > least
        if gone.any():
            n, blob = _pack(int(gone.sum()), doc[gone], begin[gone], begin[gone] + size[gone])
            self.out.append((int(doc[gone][0] % self.buckets), _MARKS, n, blob))
        keep = ~gone
        rows = rows[order[keep]]
        bucket = (_mixed(anchors(rows, off[keep]) * _K2) % _U(self.buckets)).astype("i4")
        self.parts.append((bucket, doc[keep], begin[keep], size[keep], off[keep], rows))

    def flush(self):
        if self.parts:
            bucket, doc, begin, size, off, rows = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((begin, doc, bucket))
            bucket, doc, begin, size, off, rows = (x[order] for x in (bucket, doc, begin, size, off, rows))
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            inside = np.arange(_WIDTH) < size[:, None]
            for a, b in zip(cut[:-1], cut[1:]):
                own = rows[a:b]
                n, blob = _pack(b - a, _steps(doc[a:b]), _steps(begin[a:b], doc[a:b]).astype("<u4"),
                                size[a:b].astype("u1"), off[a:b].astype("u1"), tail=own[inside[a:b]].tobytes())
                self.out.append((int(bucket[a]), _SEGMENTS, n, blob))
        out, self.parts, self.size, self.out = self.out, [], 0, []
        return pd.DataFrame(out, columns=["bucket", "kind", "n", "blob"])


def marks(docs: DataFrame, buckets: int) -> DataFrame:
    """``(doc, spans)``: byte spans to be removed, several rows per document."""
    spark = docs.sparkSession
    heavy = spark.sparkContext.broadcast(heavy_slots(docs))

    def send(frames):
        box = _Outbox(buckets)
        for ids, at, parts in slices(frames):
            owner, begin, size, off, b = cut_segments(parts, heavy.value)
            offset = at - np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
            box.add(ids[owner], begin + offset[owner], size, off, rows_of(b, begin, size))
            box.size += len(b)
            if box.size >= SEND_BYTES:
                yield box.flush()
        yield box.flush()

    def meet(frame):
        found, doc, begin, size, off, texts_ = [], [], [], [], [], []
        for kind, n, blob in zip(frame["kind"], frame["n"], frame["blob"]):
            raw = zstandard.ZstdDecompressor().decompress(blob)
            if kind == _MARKS:
                found.append(tuple(np.frombuffer(raw, "i8").reshape(3, n)))
                continue
            doc.append(np.cumsum(np.frombuffer(raw, "i8", n)))
            begin.append(_from_steps(np.frombuffer(raw, "<u4", n, 8 * n).astype("i8"), doc[-1]))
            size.append(np.frombuffer(raw, "u1", n, 12 * n).astype("i8"))
            off.append(np.frombuffer(raw, "u1", n, 13 * n).astype("i8"))
            texts_.append(np.frombuffer(raw, "u1", -1, 14 * n))
        if doc:
            found += list(repeated(*map(np.concatenate, (doc, begin, size, off, texts_))))
        if not found:
            return pd.DataFrame({"doc": pd.array([], "i8"), "spans": []})
        return _by_doc(*map(np.concatenate, zip(*found)))

    return docs.mapInPandas(send, _SENT).groupBy("bucket").applyInPandas(meet, "doc long, spans binary")


def repeated(doc, begin, size, off, text):
    """Spans ``(doc, begin, end)`` of a bucket's segments that repeat a smaller document's bytes."""
    at = np.cumsum(size) - size
    anchor = np.zeros(len(doc), "u8")
    for j in range(ANCHOR):
        anchor = (anchor << _U(8)) | text[at + off + j]
    order = np.argsort(anchor, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(anchor[order]) != 0, [True])))
    total = np.concatenate(([0], np.cumsum(size[order])))
    text = padded(text)
    a = 0
    while a < len(cuts) - 1:  # whole anchor groups, about SORTED_BYTES at a time
        b = a + 1
        while b < len(cuts) - 1 and total[cuts[b + 1]] - total[cuts[a]] <= SORTED_BYTES:
            b += 1
        part = order[cuts[a]:cuts[b]]
        a = b
        yield from _repeated(doc[part], begin[part], size[part], anchor[part], at[part], text)


def _repeated(doc, begin, size, anchor, at, text):
    rows = rows_of(text, at, size)
    h = fingerprints(rows, size)
    order = np.lexsort((begin, doc, h, anchor))
    doc, begin, size, anchor, h = (x[order] for x in (doc, begin, size, anchor, h))
    new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    head = np.concatenate(([True], h[1:] != h[:-1])) | new_anchor
    number = np.cumsum(head) - 1
    first = np.flatnonzero(head)
    least = doc[first][number]
    gone = doc > least
    if gone.any():
        yield doc[gone], begin[gone], begin[gone] + size[gone]
    # distinct segments whose anchor another distinct segment has too
    per_anchor = np.bincount(np.cumsum(new_anchor)[first] - 1)
    use = np.flatnonzero(per_anchor[np.cumsum(new_anchor)[first] - 1] > 1)
    if not len(use):
        return
    which, place = marked_starts(rows[order][first[use]], size[first[use]], doc[first[use]])
    if not len(which):
        return
    # runs of neighbouring starts, for each copy of the segment in its smallest document
    head = np.concatenate(([True], (np.diff(which) != 0) | (np.diff(place) != 1)))
    a, b = np.flatnonzero(head), np.append(np.flatnonzero(head)[1:], len(which)) - 1
    run_of, low, high = use[which[a]], place[a], place[b] + LENGTH
    copies = np.bincount(number[~gone], minlength=len(first))
    n = copies[run_of]
    row = np.repeat(first[run_of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    yield doc[row], begin[row] + np.repeat(low, n), begin[row] + np.repeat(high, n)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, packed, spans)``: each row, its text's bytes compressed for the shuffle, and its removed
    byte spans (merged; pairs of 32-bit numbers)."""
    t = texts(docs, id_col, text_col)
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = written(marks(t, buckets), "marks").groupBy("doc").agg(F.collect_list("spans").alias("spans"))

    @F.pandas_udf("binary")
    def merged(spans: pd.Series) -> pd.Series:
        return pd.Series([_merged(x) for x in spans], dtype="object")

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        own = zstandard.ZstdCompressor(level=3)
        return pd.Series([own.compress(t.encode("utf-8", "surrogatepass")) for t in text], dtype="object")

    m = m.select("doc", merged("spans").alias("spans"))
    t = t.select("doc_id", packed("text").alias("packed"))
    return t.join(m, t["doc_id"] == m["doc"], "left").select("doc_id", "packed", "spans")


def _merged(blobs) -> bytes:
    pairs = np.concatenate([np.frombuffer(b, "<u4").reshape(-1, 2) for b in blobs]).astype("i8")
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    head = np.concatenate(([True], pairs[1:, 0] > reach[:-1]))
    last = np.append(np.flatnonzero(head)[1:], len(pairs)) - 1
    return np.stack((pairs[head, 0], reach[last]), 1).astype("<u4").tobytes()


def _kept(raw: bytes, spans) -> tuple[bytes, int, int]:
    pairs = np.frombuffer(spans, "<u4").reshape(-1, 2) if spans is not None else np.zeros((0, 2), "u4")
    out, at, gone, n = [], 0, 0, 0
    for a, b in pairs.tolist():
        b = min(b, len(raw))
        if a < b:
            out.append(raw[at:a])
            gone, n, at = gone + b - a, n + 1, b
    out.append(raw[at:])
    return b"".join(out), gone, n


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` of every row; ``kept`` holds the remaining bytes."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
        own = zstandard.ZstdDecompressor()
        raws = [own.decompress(p) for p in packed]
        parts = [_kept(r, s) for r, s in zip(raws, spans)]
        return pd.DataFrame({"n_bytes": [len(r) for r in raws], "n_removed": [p[1] for p in parts],
                             "n_spans": [p[2] for p in parts], "kept": [p[0] for p in parts]})

    f = removed(docs, id_col, text_col)
    return f.select("doc_id", cut("packed", "spans").alias("r")).select("doc_id", "r.*")


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``dedup`` with the SHA-256 of the remaining bytes in their place."""
    return dedup(docs, id_col, text_col).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                F.sha2("kept", 256).alias("kept_sha256"))
