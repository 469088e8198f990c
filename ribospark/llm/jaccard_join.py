"""N-gram Jaccard join: an exact self-join of documents' shingle sets in the metric space of Jaccard distance.

Two documents link when their sets of distinct 5-word shingles have a similarity of 0.75 or more.

1. *Boundary test.* A document that links with any other shares at least 3/4 of its shingles with other
   documents. Tasks send blocks of documents as sorted, delta-coded shingle hashes to ranges; a range answers
   each block with one packed array: how many of its documents' shingles any other text also holds. Shortened
   hashes can only overcount. Each text is judged by its own numbers; texts below the bound link with nothing
   and end here.
2. *Copies.* Documents with equal sets form a class; its least doc_id stands for it from here on.
3. *Voronoi regions.* The pivots are the singletons {s} of shared shingles, ordered from the rarest.
   d(A, {s}) is ``1 - 1/|A|`` if A holds s and 1 otherwise, so A's nearest pivots are its own shingles, and
   ties go to the rarest. The triangle-inequality window of radius 1/4 around a region reaches A exactly
   for the ``|A| - ceil(3|A|/4) + 1`` first pivots of A: a linked pair meets in the region of the first
   shingle that both hold, and its place in both orders bounds what can follow it, so pairs without room
   for enough common shingles are left out. Regions with the same documents are one: the first in order.
4. *Recursion.* A region of at most SMALL documents is compared in full. A larger one takes document
   pivots (first the member with the fewest shingles of its own, most often the text that others were
   copied from): every member is compared with them, members that link join their component, and only members of
   different components remain to be compared. After SPLITS rounds the rest is compared in full, but for
   pairs that the triangle inequality rules out: ``|d(x,p) - d(y,p)| > 1/4`` for the region's pivot p.

Any pair that is left out is either not similar or already connected through links that were found, so
components are exact, and a spanning subset of the links of large regions is known.

5. *All links.* Unless only components are asked for (``all_links=False``, as in the query and the pipeline,
   which read nothing else), the members of each large region are then compared in blocks of BLOCK by BLOCK,
   each pair in the largest region that both are in; documents whose pairs all belong to larger regions
   don't travel. So the links returned are whole.

Edge cases: a null or wordless text has an empty set and links with nothing; with fewer than 5 words the
whole sequence is the only shingle; rows with the same doc_id are one document with all their texts' links
and the greatest n_shingles (n_links is the greatest of its texts' numbers, and the texts of one least doc_id
count as one class); a null doc_id is one row with null component; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, input_bytes, materialize, mix64, pack_arrays, partitions, remove, table, tidied, tidied_group, unpack_arrays
from .tokens import slices

NGRAM = 5
SMALL = 8
#: Bytes of the input for a hash range of the boundary test, at most; the session's partitions are the least number.
RANGE_BYTES = 128 << 20
#: Members of a large region that are compared with as many others in one task.
BLOCK = 256
SPLITS = 2
PIVOTS = 4
#: doc_ids that are broadcast to filter texts (8 bytes each); more are joined by a shuffle.
MAX_BROADCAST_IDS = 2_000_000
CACHE_WORDS = 250_000
BLOCK_CHARS = 8_000_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHash()


def shingles(text: str | None, n: int = NGRAM) -> np.ndarray:
    """Distinct hashes of the n-word shingles of a text, ascending; words are compared with A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i]
    return np.unique(mix64(h))


SENT = "rng int, block long, blob binary"
KINDS = (pa.int32(), pa.int64(), pa.binary())


def _send(n: int, ranges: int, keep: int):
    """Blocks of documents: a blob of their shingles for each range, and one of the sets' sizes under a negative range."""

    def blobs(block, ids, sets):
        sizes = np.array([len(x) for x in sets], np.int64)
        yield -1 - block % ranges, (np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), sizes)
        h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        d = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        order = np.argsort(h, kind="stable")
        h, d = h[order], d[order]
        rng = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        edges = np.searchsorted(rng, np.arange(ranges + 1))
        for r in range(ranges):
            a, b = edges[r], edges[r + 1]
            if a < b:
                part = h[a:b] & np.uint64((1 << keep) - 1)
                o = np.argsort(part, kind="stable")
                docs, at = np.unique(d[a:b][o], return_inverse=True)
                yield r, (np.diff(part[o], prepend=np.uint64(0)), at.astype(np.uint16 if len(docs) < 65536 else np.uint32), np.diff(docs, prepend=np.uint32(0)))

    def run(it):
        part, made = TaskContext.get().partitionId(), 0
        ids, sets, held = [], [], 0
        for b in (x for whole in it for x in slices(whole)):
            for k, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids.append(k)
                sets.append(shingles(t, n))
                held += len(t or "")
                if held >= BLOCK_CHARS or len(ids) >= 60_000:
                    yield from out((part << 24) + made, ids, sets)
                    ids, sets, held, made = [], [], 0, made + 1
        if ids:
            yield from out((part << 24) + made, ids, sets)
        _hashes.clear()  # an idle worker keeps no words

    def out(block, ids, sets):
        for r, arrays in blobs(block, ids, sets):
            row = r, block, pack_arrays(*arrays)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, KINDS, strict=True)], ["rng", "block", "blob"])

    return tidied(run)


def _shared(t: pa.Table) -> pa.Table:
    """For one range, an answer to each block: how many of its documents' shingles another text also holds."""
    if t.column("rng")[0].as_py() < 0:
        return t.select(["rng", "block", "blob"])
    hs, ds, sizes, docs = [], [], [], []
    for b in t.column("blob").to_pylist():
        h, d, k = unpack_arrays(b)
        hs.append(np.cumsum(h, dtype=np.uint64).astype(np.uint32))
        ds.append(d.astype(np.int64) + sum(sizes))
        docs.append(np.cumsum(k, dtype=np.uint32))
        sizes.append(len(k))
    h, d = np.concatenate(hs), np.concatenate(ds)
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    same = h[1:] == h[:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    count = np.split(np.bincount(d[twice], minlength=sum(sizes)).astype(np.uint32), np.cumsum(sizes)[:-1])
    blobs = [pack_arrays(np.diff(k[c > 0], prepend=np.uint32(0)), c[c > 0]) for k, c in zip(docs, count, strict=True)]
    return pa.Table.from_arrays([t.column("rng"), t.column("block"), pa.chunked_array([pa.array(blobs, pa.binary())])], ["rng", "block", "blob"])


def _judge(t: pa.Table) -> pa.Table:
    """For one block: its texts' sizes, and whether enough of their shingles are shared."""
    rows = sorted(zip(t.column("rng").to_pylist(), t.column("blob").to_pylist(), strict=True))
    ids, null, n = unpack_arrays(rows[0][1])
    shared = np.zeros(len(n), np.int64)
    for _, blob in rows[1:]:
        d, c = unpack_arrays(blob)
        shared[np.cumsum(d, dtype=np.uint32)] += c
    cols = [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(n, pa.int64()), pa.array((n > 0) & (4 * shared >= 3 * n))]
    return pa.Table.from_arrays(cols, ["doc_id", "n", "linkable"])


def _sets(n: int):
    def run(it):
        import xxhash

        names = ("doc_id", "n", "f1", "f2", "sh")
        for b in it:
            keys = b.column("doc_id").to_pylist()
            texts = b.column("text").to_pylist()
            for at in range(0, len(keys), 500):
                found = [shingles(t, n) for t in texts[at : at + 500]]
                prints = [xxhash.xxh3_128_intdigest(x.tobytes()) for x in found]
                f1 = np.array([p >> 64 for p in prints], np.uint64).view(np.int64)
                f2 = np.array([p & (1 << 64) - 1 for p in prints], np.uint64).view(np.int64)
                flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                cols = [pa.array(keys[at : at + 500], pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array(f1), pa.array(f2), lists]
                yield pa.RecordBatch.from_arrays(cols, names)
        _hashes.clear()

    return tidied(run)


def _near(na: Column, nb: Column) -> Column:
    """Sizes that allow a similarity of 0.75."""
    return 4 * F.least(na, nb) >= 3 * F.greatest(na, nb)


def _meet(n: str, at: str, on: str, oat: str) -> Column:
    """Sizes and places of the first common shingle that leave room for a similarity of 0.75."""
    n, at, on, oat = F.col(n), F.col(at), F.col(on), F.col(oat)
    return _near(n, on) & (7 * F.least(n - at, on - oat) >= 3 * (n + on))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with inter, na, nb: sizes of the intersection and of both sets."""
    x = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("sh").alias("sa")), "a")
    x = x.join(sets.select(F.col("doc_id").alias("b"), F.col("sh").alias("sb")), "b")
    size = F.size(F.array_intersect("sa", "sb")).cast("long")
    return x.select("a", "b", size.alias("inter"), F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"))


LINKED = "100 * inter >= 75 * (na + nb - inter)"


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _lists(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of a list column's values, and the ends of its rows after a 0."""
    lists = t.column(name).combine_chunks()
    flat = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return flat, np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64)


def _common(flat: np.ndarray, ends: np.ndarray, row: int, size: int) -> np.ndarray:
    """How many values of one row each row holds; size is above all values."""
    own = np.zeros(size, bool)
    own[flat[ends[row] : ends[row + 1]]] = True
    return np.diff(np.concatenate(([0], np.cumsum(own[flat])))[ends])


def _first_here(t: pa.Table):
    """(row, rows that it meets in no larger region) of a block's table."""
    ids, part = t.column("doc_id").to_numpy(), t.column("part").to_numpy()
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    flat, ends = _lists(t, "before")
    for a in np.flatnonzero(part == i):
        on = (part == j) & ((ids > ids[a]) if i == j else True)
        yield a, on & (_common(flat, ends, a, len(flat) + 1) == 0)


def _needed(t: pa.Table) -> pa.Table:
    """The rows of a block that have a pair to compare."""
    need = np.zeros(len(t), bool)
    for a, on in _first_here(t):
        need |= on
        need[a] |= on.any()
    return t.filter(pa.array(need))


def _block_links(t: pa.Table) -> pa.Table:
    """The links of a block."""
    ids = t.column("doc_id").to_numpy()
    flat, ends = _lists(t, "sh")
    n = np.diff(ends)
    out = [np.empty((0, 5), np.int64)]
    for a, on in _first_here(t):
        if not on.any():
            continue
        inter = _common(flat, ends, a, len(flat) + 1)
        b = np.flatnonzero(on & (100 * inter >= 75 * (n[a] + n - inter)))
        lo = ids[b] > ids[a]
        cols = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), inter[b], np.where(lo, n[a], n[b]), np.where(lo, n[b], n[a])
        out.append(np.stack(cols, 1))
    return pa.Table.from_arrays([pa.array(c) for c in np.concatenate(out).T], ["a", "b", "inter", "na", "nb"])


def _links_of_large(large: DataFrame, sets: DataFrame) -> DataFrame:
    """All links (a, b, inter, na, nb) between members of large regions (s, doc_id, m)."""
    of = large.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("m")).alias("m"), "s"))).alias("rs"))
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    x = large.select("s", "doc_id", parts.alias("parts"), F.pmod(F.xxhash64("doc_id", F.lit(9)), parts).cast("int").alias("part")).join(of, "doc_id")
    x = x.withColumn("before", F.expr("slice(rs.s, 1, cast(array_position(rs.s, s) as int) - 1)"))
    other = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    x = x.withColumn("p", F.explode(other)).select("s", "p.i", "p.j", "part", "doc_id", "before")
    x, _ = materialize(x.groupBy("s", "i", "j").applyInArrow(_needed, x.schema), "blocks")
    x = x.join(sets.select("doc_id", "sh"), "doc_id")
    return x.groupBy("s", "i", "j").applyInArrow(_block_links, "a long, b long, inter long, na long, nb long")


def jaccard_join(docs: DataFrame, n: int = NGRAM, all_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """(members, links) of docs (doc_id, text).

    members: doc_id, n_shingles, rep (least doc_id with the same set; null if it can't link), component_id, and
    with all_links n_links (other documents that link with it; those of equal sets too).
    links: a, b, inter, na, nb between class representatives; without all_links, in large regions only enough
    to connect whatever links.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    r = max(partitions(spark), input_bytes(docs) // RANGE_BYTES)
    sent = docs.mapInArrow(_send(n, r, 32), SENT).repartition(r, "rng")
    replies = sent.groupBy("rng").applyInArrow(tidied_group(_shared), SENT)
    judged = replies.groupBy("block").applyInArrow(tidied_group(_judge), "doc_id long, n long, linkable boolean")
    sized, _ = materialize(judged.groupBy("doc_id").agg(F.max("n").alias("n"), F.max("linkable").alias("linkable")), "sizes")
    cand = sized.where("linkable AND doc_id IS NOT NULL").select("doc_id")
    side = F.broadcast(cand) if cand.count() <= MAX_BROADCAST_IDS else cand
    sets, _ = materialize(docs.join(side, "doc_id", "left_semi").mapInArrow(_sets(n), "doc_id long, n long, f1 long, f2 long, sh array<long>"), "sets")
    classes = sets.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    members, _ = materialize(sets.select("doc_id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("doc_id", "rep", "n", "f1", "f2").distinct(), "members")
    # A doc_id's different sets of one size are told apart by v.
    reps = members.where("doc_id = rep").groupBy("doc_id", "n").agg(F.sort_array(F.collect_set(F.struct("f1", "f2"))).alias("fs"))
    reps = reps.select("doc_id", "n", F.posexplode("fs").alias("v", "f")).select("doc_id", "n", "v", "f.f1", "f.f2")
    sets, _ = materialize(sets.join(reps, ["doc_id", "n", "f1", "f2"]).select("doc_id", "n", "v", "sh").dropDuplicates(["doc_id", "n", "v"]), "sets")

    # Regions: pivots from the rarest, and the window's first ones of each document.
    each = sets.select("doc_id", "n", "v", F.explode("sh").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    own = each.join(held, "s").groupBy("doc_id", "n", "v").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("ps"))
    reach = F.expr("n - ceil(3 * n / 4) + 1 - (n - size(ps))").cast("int")
    rare = F.col("n") - F.size("ps")
    first = F.transform(F.slice("ps", 1, F.greatest(reach, F.lit(1))), lambda p, i: F.struct(p["df"].alias("df"), p["s"].alias("s"), (rare + i).alias("at")))
    near = own.where(reach > 0).select("doc_id", "n", rare.alias("u"), F.explode(first).alias("p")).select("p.*", "doc_id", "n", "u")
    near, near_path = materialize(near, "windows")
    pivot = F.min(F.struct("u", F.xxhash64("doc_id").alias("x"), "doc_id", "n", "at")).alias("p")
    sig = near.groupBy("s").agg(F.count("*").alias("m"), F.min("df").alias("df"), F.expr("bit_xor(xxhash64(doc_id))").alias("x"), F.expr("bit_xor(xxhash64(doc_id, 1))").alias("y"), pivot)
    regions = sig.where("m > 1").groupBy("m", "x", "y").agg(F.min(F.struct("df", "s", "p")).alias("r"))
    regions = regions.select("m", "r.s", F.col("r.p.doc_id").alias("p"), F.col("r.p.n").alias("pn"), F.col("r.p.at").alias("pat"))
    cells, _ = materialize(near.select("s", "doc_id", "n", "u", "at").join(regions, "s"), "regions")
    remove(spark, near_path)

    small = cells.where(F.col("m") <= SMALL).groupBy("s").agg(F.sort_array(F.collect_list(F.struct("doc_id", "n", "at"))).alias("ms"))
    each2 = small.select(F.explode(F.expr("flatten(transform(ms, (x, i) -> transform(slice(ms, i + 2, size(ms)), y -> struct(x, y))))")).alias("q"))
    pairs = each2.where(_meet("q.x.n", "q.x.at", "q.y.n", "q.y.at")).select(F.col("q.x.doc_id").alias("a"), F.col("q.y.doc_id").alias("b"))
    large = cells.where(F.col("m") > SMALL)
    stars = large.where((F.col("doc_id") != F.col("p")) & _near(F.col("n"), F.col("pn"))).select(*_pair("doc_id", "p"))
    known, _ = materialize(_verify(pairs.unionAll(stars).where("a <> b").distinct(), sets), "links")
    for split in range(SPLITS + 1):
        label, _ = materialize(connected_components(known.where(LINKED).select("a", "b")), "labels")
        x = large.join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id"))
        open_ = x.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("s")
        x, _ = materialize(x.join(open_, "s").select("s", "doc_id", "n", "u", "at", "c", "p"), "open")
        if x.isEmpty():
            break
        if split < SPLITS:
            # Pivots: the most central members (fewest shingles of their own) of some of the region's components.
            picks = [F.min(F.struct(F.xxhash64("c", F.lit(PIVOTS * split + i)).alias("x"), "u", "doc_id", "n", "c", "at")).alias(f"p{i}") for i in range(PIVOTS)]
            x = x.join(x.groupBy("s").agg(*picks), "s")
            x = x.withColumn("q", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))))
            more = x.where((F.col("q.c") != F.col("c")) & _meet("n", "at", "q.n", "q.at")).select("doc_id", F.col("q.doc_id").alias("o"))
        else:
            far = known.select("a", "b", (1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("d"))
            far = far.unionAll(far.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
            x = x.join(far.select(F.col("a").alias("doc_id"), F.col("b").alias("p"), "d"), ["doc_id", "p"], "left")
            y = x.select("s", F.col("doc_id").alias("o"), F.col("n").alias("on"), F.col("at").alias("oat"), F.col("c").alias("oc"), F.col("d").alias("od"))
            meet = (F.col("doc_id") < F.col("o")) & (F.col("c") != F.col("oc")) & _meet("n", "at", "on", "oat")
            meet &= F.coalesce(F.abs(F.col("d") - F.col("od")) <= 0.25 + 1e-9, F.lit(True))
            more = x.join(y, "s").where(meet).select("doc_id", "o")
        more = more.select(*_pair("doc_id", "o")).distinct().join(known.select("a", "b"), ["a", "b"], "left_anti")
        known, _ = materialize(known.unionAll(_verify(more, sets)), "links")
    links = known.where(LINKED)
    # A doc_id with several texts connects their classes.
    bridges = members.groupBy("doc_id").agg(F.collect_set("rep").alias("r")).where(F.size("r") > 1).select(F.array_min("r").alias("a"), F.explode("r").alias("b"))
    label, _ = materialize(connected_components(links.select("a", "b").unionAll(bridges)), "labels")
    of = members.join(label.withColumnRenamed("id", "rep"), "rep", "left").groupBy("doc_id").agg(F.min("rep").alias("rep"), F.min(F.coalesce("component", "rep")).alias("c"))
    out = sized.join(of, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), "rep", F.coalesce("c", "doc_id").alias("component_id"))
    if not all_links:
        return out, links
    links, _ = materialize(links.unionAll(_links_of_large(large, sets)).distinct(), "links")
    copies = members.groupBy("rep").agg(F.countDistinct("doc_id").alias("copies"))
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.distinct().join(copies.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("near"))
    count = copies.join(near, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("k"))
    count = members.join(count, "rep").groupBy("doc_id").agg(F.max("k").alias("k"))
    return out.join(count, "doc_id", "left").withColumn("n_links", F.coalesce("k", F.lit(0)).cast("long")).drop("k"), links


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    members, _ = jaccard_join(table(spark, sf_dir, "documents"), all_links=False)
    return members.select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)
"""
