"""Suffix-array dedup: remove bytes that repeat, for 50 bytes or more, what an earlier document holds.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller doc_id; strings are
judged on the input. Equivalently: of every maximal repeat of at least 50 bytes, all occurrences but those
in the least document that has it.

1. Copies: of equal texts only the one with the least doc_id goes on; the others repeat it whole.
2. Anchors: every 50-byte string has an anchor, the 16-byte gram of least hash in it, so equal strings have
   equal anchors wherever they stand, and 17 equal bytes before the anchor or 17 after it. Tasks send blocks
   of sorted, delta-coded anchors with prints of both sides to hash ranges, which answer each block with the
   places whose anchor and a side of it another document also has. A text without any is untouched.
3. Windows: around each such place, the bytes in which every 50-byte string with this anchor lies (at most
   84). Equal windows are one, with the least and greatest doc_id of all their occurrences.
4. Suffix arrays: windows are dealt by anchor, so equal strings meet. Each bucket sorts its suffixes,
   finds common prefixes, and scans them with a stack: an interval of the common-prefix tree whose members
   have different bytes to their left is a maximal repeat, output with all its occurrences. An anchor with
   more than HOT windows is not gathered in a task: its 50-byte strings are counted by a plain aggregate,
   which combines before it shuffles.
5. Spans go back to every occurrence of their window whose doc_id is above the repeat's least one.

Edge cases: a null text is empty and keeps nothing of nothing; texts under 50 bytes are untouched; a null
doc_id is never an earlier document and loses nothing; rows of one doc_id (repeated, or with other texts)
don't remove each other's bytes; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, pack_arrays, partitions, remove, table, tidied, unpack_arrays
from .tokens import slices

LENGTH = 50
GRAM = 16
#: A 50-byte string has at least so many bytes before its anchor, or after it.
SIDE = (LENGTH - GRAM) // 2
#: Windows of one anchor that are gathered in a task.
HOT = 50_000
#: Windows in a bucket, about: bounds a task's suffix array.
BUCKET = 12_000
BLOCK_BYTES = 8_000_000
MAX_BROADCAST_IDS = 2_000_000
MAX_BROADCAST_SPANS = 1_000_000


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of data (uint8) on as numbers."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view("<u8").reshape(-1)


def _gram_hash(words: np.ndarray, at, on) -> np.ndarray:
    """Hashes of the grams at places at; on: the same places, 8 further."""
    with np.errstate(over="ignore"):
        return mix64(words[at] * np.uint64(0x9E3779B97F4A7C15) + mix64(words[on]))


def anchors(words: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams of least hash, leftmost first, in any length bytes of a text of _words words."""
    n = len(words) + 7 - gram + 1
    width = length - gram + 1
    if n < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _gram_hash(words, slice(0, n), slice(8, n + 8))
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if rest := width - step:
        m = np.minimum(m[:-rest], m[rest:])
    m = m & np.uint64(0xFFFFFFFF)
    first = np.ones(len(m), bool)
    np.not_equal(m[1:], m[:-1], out=first[1:])
    at = m[first].astype(np.int64)
    return at, h[at]


def sides(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prints (uint16) of the SIDE bytes before and after each anchor; 0 where the text has not that many."""
    out = []
    for start in (at - SIDE, at + GRAM):
        real = (start >= 0) & (start + SIDE <= len(words) + 7)
        x = np.where(real, start, 0)
        with np.errstate(over="ignore"):
            h = words[x] * np.uint64(0x9E3779B97F4A7C15) + words[x + 8] * np.uint64(0xD6E8FEB86659FD93) + words[x + SIDE - 8] * np.uint64(0xA24BAED4963EE407)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(np.where(real, (h >> np.uint64(48)) | np.uint64(1), np.uint64(0)).astype(np.uint16))
    return out[0], out[1]


def maximal_repeats(windows: list[bytes], least: int = LENGTH):
    """Maximal repeats of at least that many bytes: (length, [(window, place), ...]) with all occurrences.

    Only suffixes of at least ``least`` bytes are sorted. The scan visits runs of the suffix array whose
    common prefixes reach ``least``, and of these only runs whose members differ to their left: inside
    any other run no interval can be left-diverse. A suffix at the start of its window has no left byte and
    differs from all others.
    """
    n, longest = len(windows), max(map(len, windows), default=0)
    places = longest - least + 1
    if places <= 0:
        return
    width = -(-longest // 8) * 8
    data = np.zeros((n, places + width), np.uint8)
    sizes = np.fromiter(map(len, windows), np.int64, n)
    flat = np.frombuffer(b"".join(windows), np.uint8)
    data[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    real = np.arange(places)[None, :] + least <= sizes[:, None]
    win, at = np.nonzero(real)
    words = np.lib.stride_tricks.as_strided(data, (n, places + width - 7, 8), (data.strides[0], 1, 1)).copy().view(">u8")[..., 0].astype(np.uint64)
    # A suffix whose first ``least`` bytes are no other's is in no repeat: it isn't sorted.
    h = np.zeros(len(win), np.uint64)
    for i in range(0, least, 8):
        cut = np.uint64(8 * max(0, i + 8 - least))
        h = mix64(h + (words[win, at + i] >> cut) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    order = np.sort(order[np.concatenate((same, [False])) | np.concatenate(([False], same))])
    if not len(order):
        return
    win, at = win[order], at[order]
    keys = words[win[:, None], at[:, None] + 8 * np.arange(width // 8)]
    left = np.where(at > 0, data[win, at - 1].astype(np.int64), 256 + np.arange(len(at)))
    room = sizes[win] - at
    order = np.lexsort(keys.T[::-1])
    keys, win, at, left, room = keys[order], win[order], at[order], left[order], room[order]
    diff = keys[1:] ^ keys[:-1]
    word = (diff != 0).argmax(1)
    some = diff[np.arange(len(diff)), word]
    byte = (some.astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(1)
    same = np.where(some == 0, width, 8 * word + byte)
    lcp = np.minimum(same, np.minimum(room[1:], room[:-1]))
    # Runs [a, b] of suffixes with common prefixes of at least ``least``.
    deep = np.concatenate(([False], lcp >= least, [False]))
    a = np.flatnonzero(~deep[:-1] & deep[1:])
    b = np.flatnonzero(deep[:-1] & ~deep[1:])
    if not len(a):
        return
    lo, hi = _run_extremes(left, a, b)
    lcps = lcp.tolist()
    for s, e in zip(a[lo != hi].tolist(), b[lo != hi].tolist(), strict=True):
        # Stack of open intervals: [depth, first member, left byte shared by all members so far or None].
        stack: list[list] = []
        lefts = left[s : e + 1].tolist()
        for i in range(s, e + 1):
            depth = lcps[i] if i < e else 0
            start, seen = i, lefts[i - s]
            while stack and stack[-1][0] > depth:
                d, start, mark = stack.pop()
                seen = mark if mark == seen else None
                if seen is None:
                    yield d, win[start : i + 1], at[start : i + 1]
            if depth:
                if stack and stack[-1][0] == depth:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else None
                else:
                    stack.append([depth, start, seen])


def _run_extremes(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of x[a..b] for each run."""
    edges = np.stack((a, b + 1), 1).reshape(-1)
    edges = edges[:-1] if edges[-1] == len(x) else edges
    return np.minimum.reduceat(x, edges)[::2], np.maximum.reduceat(x, edges)[::2]


def _send_anchors(ranges: int):
    def blobs(ids, prints, found):
        sizes = np.array([len(x[0]) for x in found], np.int64)
        at, h, before, after = (np.concatenate([x[i] for x in found]) for i in range(4))
        h = mix64(h)  # least hashes crowd in the low ranges
        d = np.repeat(np.arange(len(found), dtype=np.uint32), sizes)
        part = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        order = np.lexsort((h & np.uint64(0xFFFFFFFF), part))
        h, at, d, part = h[order] & np.uint64(0xFFFFFFFF), at[order].astype(np.uint32), d[order], part[order]
        before, after = before[order], after[order]
        edges = np.searchsorted(part, np.arange(ranges + 1))
        # The same block gets the same name when its task runs anew.
        name = hashlib.blake2b(np.array([ids[0], prints[0], ids[-1], prints[-1], len(ids)], np.int64).tobytes(), digest_size=8).digest()
        block = int.from_bytes(name, "big", signed=True)
        for r in range(ranges):
            a, b = edges[r], edges[r + 1]
            if a < b:
                docs, ix = np.unique(d[a:b], return_inverse=True)
                cols = np.diff(h[a:b], prepend=np.uint64(0)), ix.astype(np.uint32), at[a:b], before[a:b], after[a:b], np.diff(ids[docs], prepend=0), prints[docs]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([block], pa.int64()), pa.array([pack_arrays(*cols)], pa.binary())], ["rng", "block", "blob"])

    def run(it):
        ids, prints, found, held = [], [], [], 0

        def out():
            return blobs(np.array(ids, np.int64), np.array(prints, np.int64), found)

        for b in (x for whole in it for x in slices(whole)):
            for k, f, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "fp", "text")), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                if len(raw) >= LENGTH:
                    ids.append(k)
                    prints.append(f)
                    words = _words(np.frombuffer(raw, np.uint8))
                    at, h = anchors(words)
                    found.append((at, h, *sides(words, at)))
                    held += len(raw)
                    if held >= BLOCK_BYTES:
                        yield from out()
                        ids, prints, found, held = [], [], [], 0
        if ids:
            yield from out()

    return tidied(run)


def _by_many(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where rows of another id have the same key."""
    if not len(key):
        return np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    k, x = key[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    many = np.minimum.reduceat(x, starts) != np.maximum.reduceat(x, starts)
    on = np.empty(len(key), bool)
    on[order] = np.repeat(many, np.diff(np.concatenate((starts, [len(k)]))))
    return on


def _common_anchors(t: pa.Table) -> pa.Table:
    """For one range and each block: the places whose anchor, with the bytes before or after it, another doc_id also has."""
    parts, base = [], 0
    for blob in t.column("blob").to_pylist():
        h, d, p, before, after, k, f = unpack_arrays(blob)
        parts.append((np.cumsum(h, dtype=np.uint64), d.astype(np.int64) + base, p, before, after, np.cumsum(k), f))
        base += len(k)
    ends = np.cumsum([0, *(len(x[5]) for x in parts)])
    h, d, p, before, after, keys, prints = (np.concatenate(x) for x in zip(*parts, strict=True))
    on = np.flatnonzero(_by_many(h, keys[d]))
    h, d, p, before, after = h[on] << np.uint64(16), d[on], p[on], before[on], after[on]
    ids = keys[d]
    on = (before > 0) & _by_many(h | before, ids) | (after > 0) & _by_many(h | after, ids)
    d, p = d[on], p[on]
    order = np.argsort(d, kind="stable")
    d, p = d[order], p[order]
    edges = np.searchsorted(d, ends)
    rows = []
    for block, a, b in zip(t.column("block").to_pylist(), edges, edges[1:]):
        if a < b:
            docs, ix = np.unique(d[a:b], return_inverse=True)
            rows.append((block, pack_arrays(keys[docs], prints[docs], ix.astype(np.uint32), p[a:b])))
    return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["block", "blob"])


def _places(t: pa.Table) -> pa.Table:
    """For one block: the places of each document."""
    cols = []
    for blob in t.column("blob").to_pylist():
        keys, prints, ix, p = unpack_arrays(blob)
        cols.append((keys[ix], prints[ix], p))
    k, f, p = (np.concatenate(x) for x in zip(*cols, strict=True))
    order = np.lexsort((p, f, k))
    k, f, p = k[order], f[order], p[order]
    first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (f[1:] != f[:-1]))))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate((first, [len(k)])).astype(np.int32)), pa.array(p.astype(np.int32)))
    return pa.Table.from_arrays([pa.array(k[first]), pa.array(f[first]), lists], ["doc_id", "fp", "at"])


def _windows(it):
    """The window of every common anchor: h, w, and where w starts in the document."""
    names = ("doc_id", "fp", "h", "w", "start")
    for b in (x for whole in it for x in slices(whole)):
        for k, f, t, ats in zip(*(b.column(c).to_pylist() for c in ("doc_id", "fp", "text", "ats")), strict=True):
            data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
            words = _words(data)
            all_at = np.unique(np.concatenate([np.asarray(x, np.int64) for x in ats]))
            for i in range(0, len(all_at), 50_000):
                at = all_at[i : i + 50_000]
                start = np.maximum(at - (LENGTH - GRAM), 0)
                sizes = np.minimum(at + LENGTH, len(data)) - start
                ends = np.concatenate(([0], np.cumsum(sizes)))
                flat = data[np.repeat(start - ends[:-1], sizes) + np.arange(ends[-1])]
                w = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
                n = len(at)
                cols = [pa.array(np.full(n, k, np.int64)), pa.array(np.full(n, f, np.int64)), pa.array(_gram_hash(words, at, at + 8).view(np.int64)), w, pa.array(start.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names)


def _bucket_spans(t: pa.Table) -> pa.Table:
    """For one bucket of distinct windows: the spans of their repeats, with the repeats' least doc_id."""
    w, lo, hi = t.column("w").to_pylist(), t.column("lo").to_numpy(), t.column("hi").to_numpy()
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    whole = np.flatnonzero((lo < hi) & (sizes >= LENGTH))
    found = [(whole, np.zeros(len(whole), np.int64), sizes[whole], lo[whole])]
    for n, win, at in maximal_repeats(w):
        least = lo[win].min()
        on = hi[win] > least
        if on.any():
            x, p = win[on], at[on]
            found.append((x, p, p + n, np.full(len(x), least)))
    x, a, b, m = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((m, x))
    x, a, b, m = x[order], a[order], b[order], m[order]
    # Two spans of one window have 50 of its at most 84 bytes each, so they overlap: their union is one span.
    base = x * 256
    a = np.minimum.accumulate((a - base)) + base
    b = np.maximum.accumulate(b + base) - base
    last = np.concatenate((x[1:] != x[:-1], [True]))[: len(x)]
    step = last | np.concatenate((m[1:] != m[:-1], [True]))[: len(x)]
    x, a, b, m, last = x[step], a[step], b[step], m[step], last[step]
    upto = np.where(last, np.iinfo(np.int64).max, np.concatenate((m[1:], m[:1])))
    names = ("w", "a", "b", "lo", "upto")
    return pa.Table.from_arrays([pa.array([w[i] for i in x.tolist()], pa.binary()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(m.astype(np.int64)), pa.array(upto.astype(np.int64))], names)


def _merge_spans(it):
    """Rows (doc_id, fp, a, b) in this order to one row per document with its spans, merged."""
    held = None

    def out(t):
        k, f, a, b = (t.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "fp", "a", "b"))
        first = np.concatenate(([True], (k[1:] != k[:-1]) | (f[1:] != f[:-1])))
        base = np.cumsum(first) << 32
        most = np.maximum.accumulate(b + base)
        new = first | np.concatenate(([True], a[1:] + base[1:] > most[:-1]))
        starts = np.flatnonzero(new)
        ends = np.concatenate((starts[1:], [len(a)])) - 1
        spans = pa.StructArray.from_arrays([pa.array(a[starts].astype(np.int32)), pa.array((most - base)[ends].astype(np.int32))], ["a", "b"])
        docs = np.flatnonzero(first)
        edges = np.concatenate((np.searchsorted(starts, docs), [len(starts)])).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(k[docs]), pa.array(f[docs]), pa.ListArray.from_arrays(pa.array(edges), spans)], ["doc_id", "fp", "spans"])

    for batch in it:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        k, f = held.column("doc_id").to_numpy(), held.column("fp").to_numpy()
        other = np.flatnonzero((k != k[-1]) | (f != f[-1])) if len(k) else []
        if len(other):
            yield out(held.slice(0, int(other[-1]) + 1))
            held = held.slice(int(other[-1]) + 1)
    if held is not None and len(held):
        yield out(held)


SPANS = "w binary, a int, b int, lo long, upto long"


def window_spans(distinct: DataFrame) -> DataFrame:
    """Spans (w, a, b, lo, upto) of the distinct windows (h, w, lo, hi), from suffix arrays or, for hot anchors, by counting.

    A document above lo, and not above upto, loses the bytes from a to b of its window.
    """
    sizes = distinct.groupBy("h").agg(F.count("*").alias("m")).where(F.col("m") > HOT)
    # At most one row for every HOT windows: a table of a few rows, broadcast to both sides below.
    hot_h, _ = materialize(sizes.select("h"), "hot")
    buckets = max(partitions(distinct.sparkSession), -(-distinct.count() // BUCKET))
    few = hot_h.count() <= MAX_BROADCAST_IDS
    side = F.broadcast(hot_h) if few else hot_h
    some = distinct.join(side, "h", "left_anti").select(F.pmod(F.col("h"), F.lit(buckets)).alias("bucket"), "w", "lo", "hi")
    found = some.groupBy("bucket").applyInArrow(_bucket_spans, SPANS)
    hot = distinct.join(side, "h", "left_semi").where(F.length("w") >= LENGTH)
    grams = hot.select("w", "lo", "hi", F.posexplode(F.transform(F.sequence(F.lit(1), F.length("w") - (LENGTH - 1)), lambda i: F.substring(F.col("w"), i, F.lit(LENGTH)))).alias("a", "g"))
    least = grams.groupBy("g").agg(F.min("lo").alias("least"))
    each = grams.join(least, "g").where("hi > least").groupBy("w", F.col("least").alias("lo")).agg(F.min("a").alias("a"), (F.max("a") + LENGTH).alias("b"))
    rest = each.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("lo", "a", "b"))).alias("s"))
    upto = F.coalesce(F.get("s", F.col("i") + 1)["lo"], F.lit(2**63 - 1))
    rest = rest.select("w", "s", F.posexplode("s").alias("i", "x")).withColumn("s2", F.slice("s", F.lit(1), F.col("i") + 1))
    rest = rest.select("w", F.array_min(F.transform("s2", lambda y: y["a"])).alias("a"), F.array_max(F.transform("s2", lambda y: y["b"])).alias("b"), "x.lo", upto.alias("upto"))
    return found.unionByName(rest)


#: What dedup_bytes adds.
ADDED = (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary"))


def _cut(raw: bytes, spans) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left) of a text without the spans."""
    removed = runs = last = 0
    parts = []
    for a, e in sorted((x["a"], x["b"]) for x in spans):
        if a > last or not runs:
            parts.append(raw[last:a])
            runs += 1
            removed += e - a
            last = e
        elif e > last:
            removed += e - last
            last = e
    parts.append(raw[last:])
    return removed, runs, b"".join(parts)


def _apply(names: list[str]):
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(it):
        for b in (x for whole in it for x in slices(whole)):
            rows = []
            for t, copy, spans in zip(*(b.column(len(names) + i).to_pylist() for i in range(3)), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                whole = copy and len(raw) >= LENGTH
                rows.append((len(raw), *((len(raw), 1, b"") if whole else _cut(raw, spans or ()))))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *cols], [*names, *(n for n, _ in ADDED)])

    return run


def removed_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, spans) of docs (doc_id, text, fp): fp of a text and its least doc_id; and per document the bytes to remove.

    spans: doc_id, fp, spans (array of a, b; unordered, may overlap).
    """
    spark = docs.sparkSession
    r = partitions(spark)
    known = docs.where("doc_id IS NOT NULL")
    prints = known.select("doc_id", "fp", F.xxhash64("text", F.lit(1)).alias("fp2"))
    classes, _ = materialize(prints.groupBy("fp", "fp2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"), "copies")
    copies, _ = materialize(prints.join(classes, ["fp", "fp2"]).where("doc_id > first").select("doc_id", "fp").distinct(), "copies")
    side = F.broadcast(copies) if copies.count() <= MAX_BROADCAST_IDS else copies
    firsts = known.join(side, ["doc_id", "fp"], "left_anti")
    sent = firsts.select("doc_id", "fp", "text").mapInArrow(_send_anchors(r), "rng int, block long, blob binary")
    replies = sent.groupBy("rng").applyInArrow(_common_anchors, "block long, blob binary")
    places = replies.groupBy("block").applyInArrow(_places, "doc_id long, fp long, at array<int>")
    places, places_path = materialize(places.groupBy("doc_id", "fp").agg(F.collect_list("at").alias("ats")), "places")
    occ, occ_path = materialize(firsts.join(places, ["doc_id", "fp"]).select("doc_id", "fp", "text", "ats").mapInArrow(tidied(_windows), "doc_id long, fp long, h long, w binary, start int"), "windows")
    remove(spark, places_path)
    distinct, distinct_path = materialize(occ.groupBy("h", "w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "distinct")
    keys = [F.xxhash64("w").alias("k1"), F.xxhash64("w", F.lit(1)).alias("k2")]
    found, found_path = materialize(window_spans(distinct).select(*keys, "a", "b", "lo", "upto"), "spans")
    remove(spark, distinct_path)
    cut = occ.select("doc_id", "fp", "start", *keys).join(found, ["k1", "k2"]).where("lo < doc_id AND doc_id <= upto")
    cut = cut.select("doc_id", "fp", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    cut = cut.repartition(r, "doc_id", "fp").sortWithinPartitions("doc_id", "fp", "a")
    spans, _ = materialize(cut.mapInArrow(tidied(_merge_spans), "doc_id long, fp long, spans array<struct<a:int,b:int>>"), "cuts")
    remove(spark, occ_path, found_path)
    return copies, spans


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with n_bytes, n_removed, n_spans and kept (the remaining bytes); columns of these names are replaced."""
    from pyspark.sql.types import StructType

    docs = docs.drop(*(n for n, _ in ADDED))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("fp", F.xxhash64("text"))
    copies, spans = removed_spans(plain)
    marks = copies.withColumn("copy", F.lit(True)).join(spans, ["doc_id", "fp"], "full")
    marks = marks.select(F.col("doc_id").alias("__d"), F.col("fp").alias("__f"), F.col("copy").alias("__copy"), F.col("spans").alias("__spans"))
    marks, _ = materialize(marks, "marks")
    held = marks.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("__spans")), F.lit(0)).alias("s")).first()
    if held["n"] <= MAX_BROADCAST_IDS and held["s"] <= MAX_BROADCAST_SPANS:
        marks = F.broadcast(marks)
    rows = docs.withColumn("__t", text)
    out = rows.join(marks, (rows["doc_id"] == marks["__d"]) & (F.xxhash64("__t") == marks["__f"]), "left")
    out = out.select(*[docs[c] for c in docs.columns], "__t", "__copy", "__spans")
    schema = StructType(list(docs.schema.fields))
    for n, t in ADDED:
        schema = schema.add(n, t)
    return out.mapInArrow(tidied(_apply(docs.columns)), schema)


def dedup_texts(docs: DataFrame) -> DataFrame:
    """docs whose texts are what is left of them; a character that lost part of its bytes goes whole."""

    def run(it):
        for b in it:
            names = b.schema.names
            texts = [k.decode("utf-8", "ignore") for k in b.column("kept").to_pylist()]
            cols = [pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names]
            keep = [i for i, n in enumerate(names) if n not in dict(ADDED)]
            yield pa.RecordBatch.from_arrays([cols[i] for i in keep], [names[i] for i in keep])

    docs = docs.drop(*(n for n, _ in ADDED))
    return dedup_bytes(docs).mapInArrow(run, docs.schema)


def op10_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
