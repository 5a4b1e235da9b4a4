"""Near-duplicate removal by fast similarity sketching, banding and exact verification.

Documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of word shingles;
of each component of links the smallest id is kept.

1. A sketch has one coordinate per bin.  In round i every shingle is hashed to a bin and a
   value in [i, i + 1); each bin keeps its least value.  A set is done when all its bins are filled,
   which takes large sets a round or two; after as many rounds as bins, round ``bins + j`` sends every shingle to
   bin j, so each coordinate is filled at last.  Coordinates of two sets agree as often as the sets are similar,
   with bounds as for independent ones.  ``BANDS`` bands of ``ROWS`` coordinates make a pair at the
   threshold a candidate with probability 1 - 5e-7, a closer one with more.
2. Equal sets are represented by one document: first within a task's chunk, then over all.
3. Documents that share a band form a bucket.  Every member is compared with the bucket's smallest
   document, on full sets.  Links make components.
4. Buckets whose other members still lie in several components are cut into blocks, and each block's members are
   compared with one another, all at once by a product of their shingle matrices.  Buckets of more than one block
   that are still apart then have their members put together by component, and any two blocks that do not
   lie in one component are compared.  So every two members of a bucket are compared or
   in one component already; large families of copies cost little more than their number.

Buckets, lists and components are rows; a block has bounded numbers of documents and shingles, and only blocks meet
in one task.  Equal buckets of several bands are compared once.

Defined cases: texts without words (null, empty, blank) have no shingles and link with
nothing; texts of fewer words than a shingle have one shingle, the whole sequence; repeated rows
each give their row; rows of one id with different texts have their own sets, but their links meet in one node; a null id has no
component, links with nothing and is kept; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, written
from .components import components
from .jaccard import mixed, shingle_sets

BANDS, ROWS = 48, 6
#: A task sketches at most so many bytes and texts at a time (a longer text is taken alone).
CHUNK_BYTES, CHUNK_TEXTS = 2_000_000, 2_000
#: Documents and shingles of a block.
BLOCK, BLOCK_SHINGLES = 256, 1_000_000
COLUMNS = 4096  # of shingle matrices that are multiplied at a time

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
_ROUND, _BAND = _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
_SKETCHED = "doc long, lead long, n long, x long, y long, keys array<long>"


def sketches(sets: np.ndarray, counts: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """The sketch of each set (all with at least one shingle): a row of ``bins`` values."""
    out = np.full((len(counts), bins), _EMPTY)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    active, live = sets, owner
    for turn in range(bins):
        h = mixed(active ^ (mixed(np.full(1, turn, "u8") + _ROUND)))
        at = live * bins + ((h >> _U(32)) * _U(bins) >> _U(32)).astype("i8")
        free = flat[at] == _EMPTY
        at, value = at[free], (h[free] & _U(0xFFFFFFFF)) | _U(turn << 32)
        order = np.lexsort((value, at))
        at, value = at[order], value[order]
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1]
        flat[at[first]] = value[first]
        if turn < 4 or turn % 8 == 0:  # finished sets leave; one that stays a few rounds more changes nothing
            rest = (out[live[np.flatnonzero(np.diff(live, prepend=-1))]] == _EMPTY).any(axis=1) if len(live) else []
            keep = np.repeat(rest, np.diff(np.append(np.flatnonzero(np.diff(live, prepend=-1)), len(live)))) if len(
                live) else np.zeros(0, bool)
            active, live = active[keep], live[keep]
        if not len(live):
            return out
    head = np.flatnonzero(np.diff(live, prepend=-1))
    docs = live[head]
    for j in range(bins):
        need = out[docs, j] == _EMPTY
        if need.any():
            h = mixed(active ^ (mixed(np.full(1, bins + j, "u8") + _ROUND)))
            least = np.minimum.reduceat(h & _U(0xFFFFFFFF), head)
            out[docs[need], j] = least[need] | _U((bins + j) << 32)
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One hash for each band of each sketch."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype="u8") * _BAND, parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * _ROUND + parts[:, :, k])
    return key


def _chunks(frames):
    ids, batch, size = [], [], 0
    for frame in frames:
        for doc, text in zip(frame["doc_id"].tolist(), frame["text"]):
            raw = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
            if batch and (size + len(raw) > CHUNK_BYTES or len(batch) >= CHUNK_TEXTS):
                yield ids, batch
                ids, batch, size = [], [], 0
            ids.append(doc)
            batch.append(raw)
            size += len(raw)
    if batch:
        yield ids, batch


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """Each document with the first of its chunk that has the same set (``lead``); leads have fingerprint and bands."""

    def run(frames):
        for ids, batch in _chunks(frames):
            sets, counts = shingle_sets(batch, size)
            doc = np.array(ids, "i8")
            full = np.flatnonzero(counts)
            x, y = np.zeros(len(doc), "u8"), np.zeros(len(doc), "u8")
            if len(full):
                at = (np.cumsum(counts) - counts)[full]
                x[full] = np.add.reduceat(mixed(sets + _BAND), at)
                y[full] = np.add.reduceat(mixed(sets ^ _ROUND) * _BAND, at)
            order = full[np.lexsort((doc[full], counts[full], y[full], x[full]))]
            new = np.ones(len(order), bool)
            a, b = order[1:], order[:-1]
            new[1:] = (x[a] != x[b]) | (y[a] != y[b]) | (counts[a] != counts[b])
            lead = doc.copy()
            lead[order] = doc[order[new]][np.cumsum(new) - 1] if len(order) else 0
            leads = np.sort(order[new])
            keys = [None] * len(doc)
            if len(leads):
                own = np.zeros(len(doc), bool)
                own[leads] = True
                made = band_keys(sketches(sets[np.repeat(own, counts)], counts[leads])).view("i8")
                for k, row in zip(leads, made):
                    keys[k] = row
            yield pd.DataFrame({"doc": doc, "lead": lead, "n": counts, "x": x.view("i8"), "y": y.view("i8"),
                                "keys": keys})

    return docs.mapInPandas(run, _SKETCHED)


def shingle_rows(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(doc, shingles)`` of the wanted documents; only compressed texts are shuffled."""

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        own = zstandard.ZstdCompressor(level=3)
        return pd.Series([own.compress(x.encode("utf-8", "replace")) for x in text], dtype="object")

    def encode(frames):
        own = zstandard.ZstdDecompressor()
        plain = (pd.DataFrame({"doc_id": f["doc_id"], "text": [own.decompress(p) for p in f["packed"]]})
                 for f in frames)
        for ids, batch in _chunks(plain):
            sets, counts = shingle_sets(batch, size)
            ends = np.cumsum(counts)
            yield pd.DataFrame({"doc": ids, "shingles": [sets[e - n:e].tobytes() for e, n in zip(ends, counts)]})

    small = docs.select("doc_id", packed("text").alias("packed"))
    owned = small.join(wanted, small["doc_id"] == wanted["doc"], "left_semi")
    return written(owned.mapInPandas(encode, "doc long, shingles binary").where(F.octet_length("shingles") > 0), "sets")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` that link."""

    @F.pandas_udf("boolean")
    def linked(own: pd.Series, held: pd.Series) -> pd.Series:
        return pd.Series([_linked(np.frombuffer(x, "u8"), np.frombuffer(y, "u8"), percent)
                          for x, y in zip(own, held)], dtype=bool)

    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("own"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("held"))
    return pairs.join(left, "a").join(right, "b").where(linked("own", "held")).select("a", "b")


def links_of_blocks(a: tuple, b: tuple, percent: int):
    """Links between the documents of two blocks ``(docs, components, sets)``, one for any two components.

    All shared shingles are counted at once, as the product of two matrices with a column for each
    shingle that both blocks have.
    """
    joined: dict = {}

    def find(c):
        while joined.get(c, c) != c:
            c = joined[c]
        return c

    (docs, comps, sets), (others, theirs, held) = a, b
    n, m = np.array([len(s) for s in sets]), np.array([len(s) for s in held])
    own, had = np.concatenate(sets), np.concatenate(held)
    both = np.intersect1d(own, had)
    row, line = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)
    p, q = np.searchsorted(both, own), np.searchsorted(both, had)
    keep = both[np.minimum(p, len(both) - 1)] == own if len(both) else np.zeros(len(own), bool)
    p, row = p[keep], row[keep]
    keep = both[np.minimum(q, len(both) - 1)] == had if len(both) else np.zeros(len(had), bool)
    q, line = q[keep], line[keep]
    by_p, by_q = np.argsort(p, kind="stable"), np.argsort(q, kind="stable")
    p, row, q, line = p[by_p], row[by_p], q[by_q], line[by_q]
    shared = np.zeros((len(n), len(m)), "f8")
    for low in range(0, len(both), COLUMNS):
        left, right = np.zeros((len(n), COLUMNS), "f4"), np.zeros((len(m), COLUMNS), "f4")
        i, j = np.searchsorted(p, (low, low + COLUMNS))
        left[row[i:j], p[i:j] - low] = 1
        i, j = np.searchsorted(q, (low, low + COLUMNS))
        right[line[i:j], q[i:j] - low] = 1
        shared += left @ right.T
    good = 100 * shared >= percent * (n[:, None] + m[None, :] - shared)
    good &= np.asarray(comps)[:, None] != np.asarray(theirs)[None, :]
    for i, j in zip(*np.nonzero(good)):
        x, y = find(comps[i]), find(theirs[j])
        if x != y:
            joined[x] = y
            yield docs[i], others[j]


def _block(frame: pd.DataFrame) -> tuple:
    return frame["doc"].tolist(), frame["comp"].tolist(), [np.frombuffer(s, "u8") for s in frame["shingles"]]


def links_within(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside each block ``(key, cut)`` of the members ``(key, cut, doc, comp)``."""

    def compare(frame):
        block = _block(frame)
        return pd.DataFrame(list(links_of_blocks(block, block, percent)), columns=["a", "b"])

    return members.join(sets, "doc").groupBy("key", "cut").applyInPandas(compare, "a long, b long")


def links_between(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the blocks ``g`` and ``h`` of a bucket, for each pair ``(key, g, h)``."""
    sides = pairs.select("key", "g", "h", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("g").alias("cut")),
        F.struct(F.lit(1).alias("side"), F.col("h").alias("cut")))).alias("s")).select("key", "g", "h", "s.*")

    def compare(frame):
        left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
        found = links_of_blocks(_block(left), _block(right), percent) if len(left) and len(right) else ()
        return pd.DataFrame(list(found), columns=["a", "b"])

    rows = sides.join(members.join(sets, "doc"), ["key", "cut"])
    return rows.groupBy("key", "g", "h").applyInPandas(compare, "a long, b long")


def _cuts(documents, shingles):
    return F.greatest(F.ceil(documents / BLOCK), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1))


def _with_components(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps, members["doc"] == comps["node"], "left").select(
        "key", "doc", "n", F.coalesce("component", "doc").alias("comp"))


def _apart(members: DataFrame) -> DataFrame:
    """Members of buckets that lie in several components; of buckets with equal members one is left."""
    buckets = members.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("n").alias("shingles"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.expr("bit_xor(xxhash64(doc))").alias("mark"), F.expr("bit_xor(xxhash64(doc, 1))").alias("other")).where("low < high")
    once = buckets.groupBy("size", "shingles", "mark", "other").agg(F.min("key").alias("key"))
    return members.join(once.select("key", "size", "shingles"), "key")


def buckets_links(lists: DataFrame, first: DataFrame, sets: DataFrame, percent: int) -> list[DataFrame]:
    """Links between members of buckets ``(key, doc, n, hub)`` that ``first``, those with the hubs, leave apart."""
    rest = _apart(_with_components(lists.where("doc <> hub"), components(first)))
    rest = written(rest.withColumn("cuts", _cuts(F.col("size"), F.col("shingles"))).withColumn(
        "cut", F.pmod(F.xxhash64("doc"), F.col("cuts"))), "apart")
    if rest.isEmpty():
        return []
    second = written(links_within(rest.select("key", "cut", "doc", "comp"), sets, percent), "links")
    large = rest.where("cuts > 1").select("key", "doc", "n")
    if large.isEmpty():
        return [second]
    named = written(_apart(_with_components(large, components(first.union(second)))).drop("size", "shingles"), "apart")
    # a component with enough members has blocks of its own, the others share some
    own = named.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    own = own.withColumn("alone", (F.col("c") > BLOCK // 2) | (F.col("s") > BLOCK_SHINGLES // 2))
    few = own.where("not alone").groupBy("key").agg(_cuts(F.sum("c"), F.sum("s")).alias("shared_cuts"))
    placed = own.join(few, "key", "left").select(
        "key", "comp", "alone", F.when(F.col("alone"), _cuts(F.col("c"), F.col("s"))).otherwise(
            F.col("shared_cuts")).alias("cuts"))
    home = F.when(F.col("alone"), F.xxhash64("comp", F.pmod(F.xxhash64("doc"), F.col("cuts")))).otherwise(
        F.xxhash64(F.lit(-1), F.pmod(F.xxhash64("comp"), F.col("cuts"))))
    members = written(named.join(placed, ["key", "comp"]).select("key", home.alias("cut"), "doc", "comp"), "blocks")
    blocks = members.groupBy("key", "cut").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    g = blocks.select("key", F.col("cut").alias("g"), F.col("low").alias("low_g"), F.col("high").alias("high_g"))
    h = blocks.select("key", F.col("cut").alias("h"), F.col("low").alias("low_h"), F.col("high").alias("high_h"))
    pairs = g.join(h, "key").where("g <= h and least(low_g, low_h) < greatest(high_g, high_h)").select("key", "g", "h")
    return [second, written(links_between(pairs, members, sets, percent), "links")]


def minhash_components(docs: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs``."""
    if not 70 <= percent <= 100:
        raise ValueError("percent must be between 70 and 100: the bands are cut for close copies")
    t = texts(docs, id_col, text_col)
    known = t.where("doc_id is not null")
    found = written(sketched(known, size), "sketches")
    leads = found.where("keys is not null")
    class_of = leads.groupBy("x", "y", "n").agg(F.min("doc").alias("rep"))
    named = written(leads.select("doc", "x", "y", "n").distinct().join(class_of, ["x", "y", "n"])
                    .select(F.col("doc").alias("lead"), "x", "y", "n", "rep"), "classes")
    reps = leads.join(class_of, ["x", "y", "n"]).where("doc = rep").dropDuplicates(["x", "y", "n", "doc"])
    bands = reps.select("doc", "n", F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("hub"), F.count("*").alias("c")).where("c > 1")
    lists = written(bands.join(buckets, "key").select("key", "doc", "n", F.col("hub.doc").alias("hub"),
                                                      F.col("hub.n").alias("hub_n")), "buckets")
    sets = shingle_rows(known, lists.select("doc").distinct(), size)
    pairs = (lists.where((F.col("doc") != F.col("hub"))
                         & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")))
             .select(F.col("doc").alias("a"), F.col("hub").alias("b")).distinct())
    first = written(linked_pairs(pairs, sets, percent), "links")
    links = first
    for more in buckets_links(lists, first, sets, percent):
        links = links.union(more)
    final = components(links)
    # a lead's class, and its component; a chunk's documents follow their lead
    led = named.join(final, named["rep"] == final["node"], "left").select(
        "lead", "x", "y", "n", F.coalesce("component", "rep").alias("component_id"))
    out = found.drop("keys").join(led, ["lead", "x", "y", "n"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
    nameless = t.where("doc_id is null").mapInPandas(
        _counted(size), "doc_id long, n_shingles long, component_id long")
    return out.unionByName(nameless).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _counted(size: int):
    def count(frames):
        for ids, batch in _chunks(frames):
            none = pd.array([None] * len(ids), "Int64")
            yield pd.DataFrame({"doc_id": none, "n_shingles": shingle_sets(batch, size)[1], "component_id": none})

    return count


def without_copies(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept: the smallest id of each component, and those without an id."""
    gone = (minhash_components(docs, size, percent, id_col, text_col).where("not kept")
            .select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
