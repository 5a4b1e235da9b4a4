"""N-gram Jaccard join with a token-group matrix.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of
word shingles.  The join is exact:

1. Each set is cut into parts by its shingles' hashes.  Linked sets differ in few
   shingles, so with one part more than that they agree on a whole part: sets that
   may link share a part's hash (``part_signatures`` says why none is missed).
   Equal sets of a task are represented by one of them before anything is shuffled.
2. Sets that share fewer parts than a link needs are done.  Similar documents are put
   together: a set joins the hub it shares most parts with, hubs join theirs, families
   join the one of a hub that is too far for a link, and such a family is cut into
   groups of about ``GROUP``.  Comparing each set with its hub gives the first links
   and components.
3. The token-group matrix holds each group's unions: of the tokens (part hashes) in a
   table, of the shingles in the task that opens the group.  Linked sets share at least
   ``need`` parts, so two groups whose unions share fewer stay closed, and so do groups
   that lie in one component already.  In an open pair of groups the shared parts of
   every two members are counted, a query's overlap with the other group's shingle
   union is bounded, and only members that pass are compared.  A task gets a block of
   groups once, with all that is opened against it, rather than two groups for each pair.
4. Links of both rounds make the components.

No list, hub or component is held in one task or on the driver as a whole: lists are
rows, groups have bounded size, and pairs of groups are spread over the tasks.

Defined cases: texts without words (null, empty, blank) have no shingles and link
with nothing; texts of fewer words than a shingle have one shingle, the whole
sequence; repeated rows each give their row; a null id has no component and links
with nothing; other columns are dropped.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, give_back, texts, written
from .components import components

GROUP = 64
#: Shingles and members of neighbouring groups that a task holds as a block.  Shingles of the groups that are compared
#: with it, and pairs of members (a pair of groups counts as some more).
BLOCK_SHINGLES, BLOCK_MEMBERS = 1 << 19, 16 * GROUP
UNIT_SHINGLES, UNIT_WORK, PAIR_WORK = 1 << 19, 1 << 20, 256
ROUND = 2
#: Cuts of a class of equal sets: its rows come to as many tasks.
CUTS = 256
#: Bytes of text that a task turns into shingles at a time (a longer text is taken alone).
CHUNK_BYTES = 2_000_000
#: Bytes of a chunk's texts, of words in them, and shingles in its sets, that are worked on at a time (a longer one
#: is taken alone): the arrays over a whole chunk would take fifty times its bytes.
PIECE_BYTES, HASHED_BYTES, PIECE_SHINGLES = 400_000, 200_000, 80_000
GROWTH = 1.5  # of the sizes that share a partition scheme; above 100 / percent

_U = np.uint64
_R, _K1, _K2, _K3 = 0x9E3779B97F4A7C15, _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _K1
    x = (x ^ (x >> _U(27))) * _K2
    return x ^ (x >> _U(31))


_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(b: np.ndarray, ink: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each word: words begin at ``begin`` and end with their ``ink`` or at the next one."""
    h, edges, w = np.empty(len(begin), "u8"), np.append(begin, len(b)), 0
    while w < len(begin):
        end = max(w + 1, int(np.searchsorted(edges, edges[w] + HASHED_BYTES, side="right")) - 1)
        inked = np.flatnonzero(ink[edges[w]:edges[end]])
        starts = begin[w:end] - edges[w]
        at = np.searchsorted(inked, starts)
        place = inked - np.repeat(starts, np.diff(np.append(at, len(inked))))
        powers = np.cumprod(np.full(int(place.max()) + 2, _R, "u8"))
        h[w:end] = np.add.reduceat((b[edges[w]:edges[end]][inked].astype("u8") + _U(1)) * powers[place], at)
        w = end
    return mixed(h)


def _pieces(sizes, most: int):
    """``(start, end)`` of neighbours of ``most`` in all; one that is larger is alone."""
    start, total = 0, 0
    for k, n in enumerate(sizes):
        if k > start and total + n > most:
            yield start, k
            start, total = k, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def shingle_sets(batch: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, ascending within each text, and their number."""
    found = [_shingle_sets(batch[a:b], size) for a, b in _pieces([len(t) for t in batch], PIECE_BYTES)]
    if not found:
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    return np.concatenate([s for s, _ in found]), np.concatenate([n for _, n in found])


def _shingle_sets(batch: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in batch])
    b = np.frombuffer(b"".join(batch).lower(), "u1")  # lower() of bytes changes A-Z only
    ends = np.cumsum(lengths)
    ink = ~_WHITE[b]
    first = np.ones(len(b), bool)
    first[1:] = ~ink[:-1]
    first[(ends - lengths)[lengths > 0]] = True
    begin = np.flatnonzero(ink & first)
    if not len(begin):
        return np.zeros(0, "u8"), np.zeros(len(batch), "i8")
    h = word_hashes(b, ink, begin)
    doc = np.searchsorted(ends, begin, side="right")
    words = np.bincount(doc, minlength=len(batch))
    # a shingle starts at each word with enough words after it; short texts have one from their first
    start_of = np.cumsum(words) - words
    rank = np.arange(len(begin)) - start_of[doc]
    starts = np.flatnonzero((rank + size <= words[doc]) | ((rank == 0) & (words[doc] < size)))
    span = np.minimum(size, words[doc[starts]])
    s = span.astype("u8") * _K3
    for j in range(size):
        inside = j < span
        s = np.where(inside, mixed(s * _K1 + h[np.minimum(starts + j, len(h) - 1)]), s)
    owner = doc[starts]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return s[new], np.bincount(owner[new], minlength=len(batch))


@lru_cache
def schemes(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each scheme: its smallest set size, the largest difference of a linked pair, its number of parts.

    Scheme i serves pairs whose larger set has between ``low[i]`` and ``low[i + 1] - 1`` shingles.
    """
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, int(low[-1] * GROWTH)))
    low = np.array(low, "i8")
    differ = (100 - percent) * 2 * (low[1:] - 1) // (100 + percent)
    return low, differ, differ + 3 + differ // 16


def part_signatures(sets: np.ndarray, counts: np.ndarray, percent: int):
    """Hashes of the parts of each set, the set that each belongs to, and how many a linked set shares at least.

    Linked sets of sizes a <= b differ in at most ``(100 - p) / (100 + p) * (a + b)``
    shingles, fewer than the parts of b's scheme; a is cut by that scheme too when
    b may be in the next one.  They thus agree on more parts than the slack
    ``parts - difference - 1``.  Parts without shingles are left out by sets that
    have no more of them than this slack: one of the agreeing parts then has some.
    Sets with more empty parts write those out as well.  Either way a linked set shares
    at least ``parts - difference - empty parts`` of what is written, and at least one.
    """
    ends, found = np.concatenate(([0], np.cumsum(counts))), []
    for a, b in _pieces(counts, PIECE_SHINGLES):
        sig, of, need = _part_signatures(sets[ends[a]:ends[b]], counts[a:b], percent)
        found.append((sig, of + a, need))
    if not found:
        return np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "i8")
    return tuple(np.concatenate(x) for x in zip(*found))


def _part_signatures(sets: np.ndarray, counts: np.ndarray, percent: int):
    low, differ, parts = schemes(percent)
    level = np.searchsorted(low, counts, side="right") - 1
    owner = np.repeat(np.arange(len(counts)), counts)
    value, spread = mixed(sets * _K3), mixed(sets + _K2) >> _U(16)
    out, of = [], []
    need = np.full(len(counts), 1 << 30, "i8")
    for up in (0, 1):
        used = counts > 0
        if up:
            used &= counts * 100 // percent >= low[np.maximum(level, 0) + 1]
        scheme = np.maximum(level + up, 0)
        m = np.where(used, parts[scheme], 0)
        base = np.cumsum(m) - m
        rows = np.flatnonzero(used[owner])
        if not len(rows):
            continue
        o = owner[rows]
        key = base[o] + (spread[rows] % m[o].astype("u8")).astype("i8")
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        total = np.add.reduceat(value[rows][order], head)
        doc = o[order][head]
        part = key[head] - base[doc]
        out.append(mixed(total + mixed(part.astype("u8") * _K1 + scheme[doc].astype("u8") * _K3 + _U(1))))
        of.append(doc)
        most = np.minimum(differ[scheme], (100 - percent) * (counts + counts * 100 // percent) // (100 + percent))
        empty = m - np.bincount(doc, minlength=len(counts))
        need = np.where(used, np.minimum(need, np.maximum(m - most - empty, 1)), need)
        for d in np.flatnonzero(used & (empty > m - 1 - most)):
            free = np.setdiff1d(np.arange(m[d]), part[doc == d])
            out.append(mixed(mixed(free.astype("u8") * _K1 + _U(scheme[d]) * _K3 + _U(1))))
            of.append(np.full(len(free), d))
    if not out:
        return np.zeros(0, "u8"), np.zeros(0, "i8"), need
    return np.concatenate(out), np.concatenate(of), need


def chunks(frames, most: int = CHUNK_BYTES):
    """``(ids, texts as bytes)`` of about ``most`` bytes from batches with ``doc_id, text``."""
    ids, batch, size = [], [], 0
    for frame in frames:
        for doc, text in zip(frame["doc_id"], frame["text"]):
            raw = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
            if batch and size + len(raw) > most:
                yield ids, batch
                ids, batch, size = [], [], 0
            ids.append(doc)
            batch.append(raw)
            size += len(raw)
    if batch:
        yield ids, batch


_DOC, _LIST = 0, 1
_SENT = "bucket int, kind int, blob binary"
_FOUND = "kind int, doc long, x long, y long, n long, need long"


def _blob(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _columns(blob: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "u8").reshape(n, -1)
    return list(raw)


def _delta(x: np.ndarray) -> np.ndarray:
    return np.diff(x.astype("i8"), prepend=np.int64(0)).astype("u8")


def signature_lists(docs: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Two kinds of rows from one pass over the texts.

    ``_DOC``: doc, fingerprint (x, y), number of shingles n, shared parts needed to link.  ``_LIST``: doc, part hash x
    that another document shares too, and the smallest document y known to share it.
    """

    def send(frames):
        for ids, batch in chunks(frames):
            sets, counts = shingle_sets(batch, size)
            known = np.array([not pd.isna(i) for i in ids])
            doc = np.array([0 if pd.isna(i) else int(i) for i in ids], "i8")
            at = np.cumsum(counts) - counts
            full = counts > 0
            x, y = np.zeros(len(doc), "u8"), np.zeros(len(doc), "u8")
            if full.any():
                x[full] = np.add.reduceat(mixed(sets + _K1), at[full])
                y[full] = np.add.reduceat(mixed(sets ^ _K2) * _K3, at[full])
            rows = np.flatnonzero(known)
            out = []
            # one representative (the smallest id) of each set in this chunk
            order = np.lexsort((doc, y, x))
            order = order[(full & known)[order]]
            new = np.ones(len(order), bool)
            new[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
            rep = np.zeros(len(doc), bool)
            rep[order[new]] = True
            sig, of, least = part_signatures(sets[np.repeat(rep, counts)], counts[rep], percent)
            need = np.zeros(len(doc), "i8")
            need[rep] = least
            if len(rows):
                blob = [c[rows].astype("u8") for c in (doc, x, y, counts, need)]
                out.append((int(doc[rows[0]] % buckets), _DOC, _blob(*blob)))
            owner = doc[np.flatnonzero(rep)[of]] if len(of) else np.zeros(0, "i8")
            order = np.lexsort((owner, sig))
            sig, owner = sig[order], owner[order]
            head = np.ones(len(sig), bool)
            head[1:] = sig[1:] != sig[:-1]
            hub = owner[np.flatnonzero(head)][np.cumsum(head) - 1] if len(sig) else owner
            shared = ~head
            shared[:-1] |= ~head[1:]
            if shared.any():  # known here already; they go on as they are
                out.append((int(sig[0] % _U(buckets)), _LIST, _blob(owner[shared].astype("u8"), sig[shared],
                                                                    hub[shared].astype("u8"))))
            sig, owner = sig[head], owner[head]
            bucket = (sig % _U(buckets)).astype("i4")
            order = np.lexsort((owner, bucket))
            sig, owner, bucket = sig[order], owner[order], bucket[order]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(sig) else []
            for a, b in zip(cut[:-1], cut[1:]):
                out.append((int(bucket[a]), 2, _blob(_delta(owner[a:b]), sig[a:b])))
            yield pd.DataFrame(out, columns=["bucket", "kind", "blob"])
        give_back()

    def meet(frame):
        out = []

        def put(kind, *columns):
            made = {name: c.astype("i8") for name, c in zip(("doc", "x", "y", "n", "need"), columns)}
            out.append(pd.DataFrame({"kind": np.full(len(columns[0]), kind, "i4")} | made))

        owners, sigs = [], []
        for kind, blob in zip(frame["kind"], frame["blob"]):
            if kind == _DOC:
                put(_DOC, *_columns(blob, 5))
            elif kind == _LIST:
                doc, sig, hub = _columns(blob, 3)
                put(_LIST, doc, sig, hub, np.zeros(len(doc)), np.zeros(len(doc)))
            else:
                owner, sig = _columns(blob, 2)
                owners.append(np.cumsum(owner.astype("i8")))
                sigs.append(sig)
        if sigs:
            owner, sig = np.concatenate(owners), np.concatenate(sigs)
            order = np.lexsort((owner, sig))
            owner, sig = owner[order], sig[order]
            head = np.ones(len(sig), bool)
            head[1:] = sig[1:] != sig[:-1]
            shared = ~head
            shared[:-1] |= ~head[1:]
            hub = owner[np.flatnonzero(head)][np.cumsum(head) - 1]
            none = np.zeros(int(shared.sum()))
            put(_LIST, owner[shared], sig[shared], hub[shared], none, none)
        give_back()
        return pd.concat(out) if out else pd.DataFrame(columns=["kind", "doc", "x", "y", "n", "need"])

    return docs.mapInPandas(send, _SENT).groupBy("bucket").applyInPandas(meet, _FOUND)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link."""

    @F.pandas_udf("boolean")
    def linked(own: pd.Series, held: pd.Series) -> pd.Series:
        return pd.Series([_linked(np.frombuffer(x, "u8"), np.frombuffer(y, "u8"), percent)
                          for x, y in zip(own, held)], dtype=bool)

    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("own"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("held"))
    return pairs.join(left, "a").join(right, "b").where(linked("own", "held")).select("a", "b")


class _Group:
    """A group's members, sorted part hashes and shingle union, made once for all pairs of a task."""

    def __init__(self, docs, comps, blobs, percent: int):
        self.docs, self.comps = [int(d) for d in docs], [int(c) for c in comps]
        self.sets = [np.frombuffer(raw, "u8") for raw in blobs]
        self.sizes, whole = np.array([len(s) for s in self.sets]), np.concatenate(self.sets)
        sig, of, self.need = part_signatures(whole, self.sizes, percent)
        order = np.argsort(sig)
        self.sig, self.of = sig[order], of[order]
        self.starts, self.least = np.cumsum(self.sizes) - self.sizes, int(self.sizes.min())
        self.union, place = np.unique(whole, return_inverse=True)
        self.place = place.astype("i4")


def _open_pair(a: _Group, b: _Group, percent: int, joined: dict):
    """Links between two groups, one for any two components; ``joined`` has what earlier pairs of the task linked."""

    def find(c):
        while joined.get(c, c) != c:
            joined[c] = c = joined.get(joined[c], joined[c])
        return c

    low = np.searchsorted(b.sig, a.sig, "left")
    n = np.searchsorted(b.sig, a.sig, "right") - low
    which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    shared = np.bincount(np.repeat(a.of, n) * len(b.sets) + b.of[which],
                         minlength=len(a.sets) * len(b.sets)).reshape(len(a.sets), len(b.sets))
    fits = shared >= np.maximum(a.need[:, None], b.need)
    fits &= 100 * np.minimum(a.sizes[:, None], b.sizes) >= percent * np.maximum(a.sizes[:, None], b.sizes)
    for i in np.flatnonzero(fits.any(axis=1)):
        doc, comp, own = a.docs[i], a.comps[i], a.sets[i]
        able = np.flatnonzero(fits[i])
        able = [j for j in able[np.argsort(-shared[i][able])] if find(b.comps[j]) != find(comp)]
        if not able:
            continue
        at = np.minimum(np.searchsorted(b.union, own), len(b.union) - 1)
        at = at[b.union[at] == own]
        if 100 * len(at) < percent * max(len(own), b.least):
            continue  # no member can link
        marked = np.zeros(len(b.union), "u1")
        marked[at] = 1
        both = np.add.reduceat(marked[b.place], b.starts, dtype="i8")
        linked = 100 * both >= percent * (len(own) + b.sizes - both)
        for j in able:
            if linked[j] and find(b.comps[j]) != find(comp):
                joined[find(b.comps[j])] = find(comp)
                yield doc, b.docs[j]


def work_units(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``(unit, own, guest)`` of pairs of groups ``(g, h)``: the unit of work in which both groups are.

    A pair is opened where the larger of its groups' blocks is; the group of the other block comes there.  So a
    group is sent once for a block, not once for each group in it.  A block with more guests or pairs than a
    unit's is sent to several, each with some of them.
    """
    size = members.groupBy("blk", "grp").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    size = size.withColumn("held", F.sum("n").over(Window.partitionBy("blk")))

    def side(name):
        return size.select(F.col("grp").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("blk", "n", "k", "held")])

    both = pairs.join(side("g"), "g").join(side("h"), "h")
    at_g = F.struct("held_g", "blk_g") >= F.struct("held_h", "blk_h")
    dealt = written(both.select(F.when(at_g, F.col("blk_g")).otherwise(F.col("blk_h")).alias("home"),
                                F.when(at_g, F.col("g")).otherwise(F.col("h")).alias("own"),
                                F.when(at_g, F.col("h")).otherwise(F.col("g")).alias("guest"),
                                F.when(F.expr("blk_g = blk_h"), 0).when(at_g, F.col("n_h")).otherwise(F.col("n_g"))
                                .alias("n"), (F.expr("k_g * k_h") + PAIR_WORK).alias("work")), "dealt")
    room = (dealt.groupBy("home", "guest").agg(F.max("n").alias("n"), F.sum("work").alias("work")).groupBy("home")
            .agg(F.ceil(F.greatest(F.sum("n") / UNIT_SHINGLES, F.sum("work") / UNIT_WORK)).alias("slices")))
    cut = F.pmod(F.xxhash64("guest"), F.col("slices"))
    return dealt.join(room, "home").select(F.xxhash64("home", cut).alias("unit"), "own", "guest")


def open_groups(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Links ``(a, b)`` between the members ``(doc, grp, blk, n, comp)`` of pairs of groups ``(g, h)``.

    The units are worked on in rounds, each sending about ``ROUND`` times the sets of all members.
    """
    units = written(work_units(pairs, members), "units")
    sides = units.select("unit", F.explode(F.array("own", "guest")).alias("grp")).distinct()
    sides = written(sides.join(members.select("grp", "doc", "comp", "n"), "grp"), "sides")
    # the pairs of a unit come as rows without shingles
    told = units.select("unit", F.col("own").alias("grp"), F.col("guest").alias("doc"), F.lit(0).cast("long").alias("comp"),
                        F.lit(None).cast("binary").alias("shingles"))

    def compare(frame):
        out = []
        for _, unit in frame.groupby("unit", sort=False):
            told = unit["shingles"].isna()
            held = {grp: _Group(m["doc"], m["comp"], m["shingles"], percent)
                    for grp, m in unit[~told].groupby("grp", sort=False)}
            joined: dict = {}
            for own, guest in zip(unit["grp"][told], unit["doc"][told]):
                if own in held and guest in held:
                    out += _open_pair(held[own], held[guest], percent, joined)
        give_back()
        return pd.DataFrame(out, columns=["a", "b"])

    n = sides.agg(F.sum("n")).first()[0] or 0
    rounds = max(1, -(-n // (ROUND * max(1, members.agg(F.sum("n")).first()[0] or 0))))
    found = None
    for k in range(rounds):
        here = F.pmod(F.xxhash64("unit"), F.lit(rounds)) == k
        sent = sides.where(here).join(sets, "doc").select("unit", "grp", "doc", "comp", "shingles")
        rows = sent.unionByName(told.where(here)).withColumn("bucket", F.pmod("unit", F.lit(buckets)).cast("int"))
        links = written(rows.groupBy("bucket").applyInPandas(compare, "a long, b long"), "links")
        found = links if found is None else found.union(links)
    return found


def classes(rows: DataFrame) -> DataFrame:
    """``(doc, n, need, rep)``: ``rep`` is the smallest document with the same shingles.

    Equal sets are first met within ``CUTS`` cuts by their documents' hashes, so a class with a third of all
    rows comes to many tasks; only one row for each cut of a class meets the others.
    """
    cut = rows.withColumn("cut", F.pmod(F.xxhash64("doc"), F.lit(CUTS)))
    whole = Window.partitionBy("x", "y", "n")
    reps = (cut.where("n > 0").groupBy("x", "y", "n", "cut").agg(F.min("doc").alias("own"), F.count("*").alias("held"))
            .select("x", "y", "n", "cut", F.min("own").over(whole).alias("rep"),
                    F.sum("held").over(whole).alias("members"))
            .where("members > 1").drop("members"))
    return (cut.join(reps, ["x", "y", "n", "cut"], "left")
            .select("doc", "n", "need", F.coalesce("rep", "doc").alias("rep")))


def open_parts(matrix: DataFrame, group: DataFrame) -> DataFrame:
    """``(part, grp, need)`` of the parts whose groups reach into more than one component.

    Any other part opens no pair of groups, so those of a finished family are not paired by the parts they share.
    """
    same = Window.partitionBy("part")
    return (matrix.join(group, "grp").select("part", "grp", "need", F.min("lo").over(same).alias("low"),
                                             F.max("hi").over(same).alias("high"))
            .where("low < high").select("part", "grp", "need"))


def in_families(members: DataFrame, family: DataFrame, loose: DataFrame) -> DataFrame:
    """``members`` with the ``hub`` that names their family.

    A family's smallest document has no hub to link with; where it has a looser one the
    family joins that one's, and the same once more (hubs of a task have hubs themselves).
    This only decides who is compared in a group, so no links are lost or made by it.
    """
    above = (loose.join(family, loose["hub"] == family["node"], "left")
             .select(F.col("doc").alias("root"), F.coalesce("component", "hub").alias("to")))
    above = written(above, "above")
    again = above.select(F.col("root").alias("own"), F.col("to").alias("further"))
    above = (above.join(again, above["to"] == again["own"], "left")
             .select("root", F.coalesce("further", "to").alias("to")))
    named = (members.join(family, members["doc"] == family["node"], "left")
             .select("doc", "need", "n", F.coalesce("component", "doc").alias("name")))
    return (named.join(above, named["name"] == above["root"], "left")
            .select("doc", "need", "n", F.coalesce("to", "name").alias("hub")))


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``."""
    if not 100 / GROWTH < percent <= 100:
        raise ValueError(f"percent must be above {100 / GROWTH:.0f} and at most 100")
    spark = docs.sparkSession
    t = texts(docs, id_col, text_col)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(signature_lists(t, size, percent, buckets), "shingles")
    rows = found.where(F.col("kind") == _DOC).select("doc", "x", "y", "n", "need")
    named = written(classes(rows), "classes")
    # the smallest document of a class stands for it in its chunk too, so its ``need`` is there
    reps = named.where("n > 0 and doc = rep").groupBy("doc").agg(F.max("need").alias("need"))
    to_rep = named.where("n > 0").select(F.col("doc").alias("hub"), "rep").distinct()
    lists = found.where(F.col("kind") == _LIST).select("doc", F.col("x").alias("part"), F.col("y").alias("hub"))
    # a set that shares fewer parts than it needs, with all others together, links with none;
    # all of this is grouped by document, one exchange serves it
    lists = (lists.join(reps, "doc").groupBy("doc", "part").agg(F.min("hub").alias("hub"), F.max("need").alias("need"))
             .withColumn("own", F.count("*").over(Window.partitionBy("doc")))
             .where("own >= need").select("doc", "part", "hub", "need"))
    lists = written(lists, "lists")
    dropped(found)
    # the hub that a set shares most parts with, as its class's representative
    hubs = (lists.groupBy("doc", "hub").agg(F.count("*").alias("shared"), F.max("need").alias("need"))
            .join(to_rep, "hub").where("rep <> doc"))
    best = (hubs.groupBy("doc", "rep").agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
            .groupBy("doc").agg(F.max(F.struct("shared", (-F.col("rep")).alias("r"), "need")).alias("m"))
            .select("doc", (-F.col("m.r")).alias("hub"), F.expr("m.shared >= m.need").alias("may_link")))
    found_hubs = written(best, "hubs")
    best, loose = found_hubs.where("may_link").select("doc", "hub"), found_hubs.where("not may_link")
    wanted = lists.select("doc").union(best.select("hub")).distinct()

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        own = zstandard.ZstdCompressor(level=3)
        return pd.Series([own.compress(x.encode("utf-8", "replace")) for x in text], dtype="object")

    small = t.where("doc_id is not null").select("doc_id", packed("text").alias("packed"))
    owned = small.join(wanted, small["doc_id"] == wanted["doc"]).select("doc_id", "packed")

    def encode(frames):
        own = zstandard.ZstdDecompressor()
        plain = (pd.DataFrame({"doc_id": f["doc_id"], "text": [own.decompress(p) for p in f["packed"]]})
                 for f in frames)
        for ids, batch in chunks(plain):
            sets, counts = shingle_sets(batch, size)
            ends, need = np.cumsum(counts), part_signatures(sets, counts, percent)[2]
            yield pd.DataFrame({"doc": [int(i) for i in ids], "need": need, "n": counts,
                                "shingles": [sets[e - n:e].tobytes() for e, n in zip(ends, counts)]})
        give_back()

    found_sets = written(owned.mapInPandas(encode, "doc long, need long, n long, shingles binary"), "sets")
    sets = found_sets.select("doc", "shingles")
    first = written(verified(best.select(F.col("doc").alias("a"), F.col("hub").alias("b")), sets, percent), "links")
    near = components(first)
    members = found_sets.select("doc", "need", "n")
    members = in_families(members, components(best, "doc", "hub"), loose)
    blocks = F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_MEMBERS))
    members = members.join(members.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).alias("cuts"),
                                                      blocks.alias("blocks")), "hub")
    cut = F.pmod(F.xxhash64("doc"), F.col("cuts"))
    block = F.floor(cut * F.least("blocks", "cuts") / F.col("cuts"))
    members = members.join(near, members["doc"] == near["node"], "left").select(
        "doc", "need", "n", F.xxhash64("hub", cut).alias("grp"), F.xxhash64(block, "hub").alias("blk"),
        F.coalesce("component", "doc").alias("comp"))
    members = written(members, "groups")
    group = members.groupBy("grp").agg(F.min("need").alias("need"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    # the matrix: which parts the union of a group has; two groups' shared parts are counted
    matrix = (lists.select("doc", "part").join(members.select("doc", "grp"), "doc")
              .groupBy("part", "grp").agg(F.min("doc").alias("one"), F.max("doc").alias("other")))
    matrix = written(matrix, "matrix")
    dropped(lists)
    needed = open_parts(matrix, group)
    g = needed.select("part", F.col("grp").alias("g"), F.col("need").alias("own"))
    h = needed.select("part", F.col("grp").alias("h"), F.col("need").alias("its"))
    shared = (g.join(h, "part").where("g < h")
              .groupBy("g", "h").agg(F.count("*").alias("shared"), F.max(F.greatest("own", "its")).alias("least"))
              .where("shared >= least").select("g", "h", "shared"))
    within = (matrix.where("one <> other").groupBy("grp").agg(F.count("*").alias("shared"))
              .select(F.col("grp").alias("g"), F.col("grp").alias("h"), "shared"))
    left = group.select(F.col("grp").alias("g"), F.col("need").alias("need_g"), F.col("lo").alias("lo_g"),
                        F.col("hi").alias("hi_g"))
    right = group.select(F.col("grp").alias("h"), F.col("need").alias("need_h"), F.col("lo").alias("lo_h"),
                         F.col("hi").alias("hi_h"))
    opened = (shared.unionByName(within).join(left, "g").join(right, "h")
              .where("shared >= greatest(need_g, need_h)")
              .where("least(lo_g, lo_h) < greatest(hi_g, hi_h)").select("g", "h"))
    opened = written(opened, "opened")
    dropped(matrix)
    second = open_groups(opened, members.drop("need"), sets, percent, 8 * buckets)
    dropped(found_sets)
    final = components(first.union(second))
    known = (named.join(final, named["rep"] == final["node"], "left")
             .select("doc", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
    nameless = (t.where("doc_id is null")
                .mapInPandas(_counted(size), "doc long, n_shingles long, component_id long"))
    return known.unionByName(nameless).withColumnRenamed("doc", "doc_id")


def _counted(size: int):
    def count(frames):
        for ids, batch in chunks(frames):
            n = shingle_sets(batch, size)[1]
            yield pd.DataFrame({"doc": pd.array([None] * len(n), "Int64"), "n_shingles": n,
                                "component_id": pd.array([None] * len(n), "Int64")})

    return count
