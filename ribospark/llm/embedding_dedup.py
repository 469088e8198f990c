"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact reranking.

1. *Codes.* From a sample of at most about SAMPLE vectors, unit vectors are centred and an orthogonal
   rotation is learned by iterative quantisation (Gong and Lazebnik 2011): signs and the rotation that fits
   them best take turns, which balances the bits. Rotations from different starts give as many codes of
   ``dim`` bits.
2. *Tables.* A code is cut into bands; vectors that agree on a band are candidates (multi-index hashing:
   codes within a distance below the number of bands agree on one of them). Band widths grow with log2 of
   the rows, so a bucket's expected size does not grow with the input. Wider bands are shared less often, so
   rotations (ROTATIONS at least) are added until partners made at the least cosine, in random directions and
   in those of the data, share a band with the sampled vectors in RECALL of the cases. Where learned rotations
   don't get there, random ones about the origin are added, whose chance to share a band depends on the angle
   alone. Keys per vector grow with about the 0.22th power of the rows at cosine 0.9.
3. *Large buckets.* A bucket above BUCKET rows is cut by the vectors themselves: it is sorted along its
   first principal direction, and by the Cauchy-Schwarz bound only neighbours within sqrt(2 - 2 * least)
   there can link; blocks of that sorted list meet blocks in reach. No row is dropped.
4. *Rerank.* Candidates are compared by cosine in double precision; equal vectors are one class from the
   start, so copies never meet pair by pair.

Recall rests on the codes; it is measured against brute force in the tests (at least 0.9, with the bands of
small tables and of 10 million rows; 0.99 and more on the given tables), and no pair below the threshold is
ever linked.

Edge cases: vectors that are null, zero, of another length than most, or hold nulls or non-finite
components have no links and are their own component; repeated vec_ids are one vector each of which links
count; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, table

LEAST = 0.9
SAMPLE = 20_000
#: Rotations, at least.
ROTATIONS = 4
#: Expected share of the pairs at the least cosine that share a band.
RECALL = 0.95
PROBES = 2000
BUCKET = 500
BUNDLE = 20_000


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """The rotation whose signs fit the centred sample x best, from a random start."""
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1],) * 2))[0]
    for _ in range(rounds):
        b = np.where(x @ r >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(x.T @ b)
        r = u @ vt
    return r


def band_widths(rows: int, dim: int) -> list[tuple[int, int]]:
    """(from, to) bits of the bands: as wide as log2 of the rows, at least 8 bits."""
    width = int(min(max(8, np.ceil(np.log2(max(rows, 2))) - 2), max(1, dim)))
    return [(a, min(a + width, dim)) for a in range(0, dim - width // 2, width)]


def band_codes(x: np.ndarray, turns: list[tuple[np.ndarray, np.ndarray]], bands: list[tuple[int, int]]) -> np.ndarray:
    """One 64-bit key per vector, rotation (with the point it turns about) and band."""
    out = []
    for i, (r, centre) in enumerate(turns):
        bits = (x - centre) @ r >= 0
        for j, (a, b) in enumerate(bands):
            word = bits[:, a:b] @ (1 << np.arange(b - a, dtype=np.int64))
            out.append(word | np.int64((i * len(bands) + j) << 48))
    return np.stack(out, 1)


def partners(u: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, their partners at cosine least) of unit vectors u: in random directions, and towards others of u."""
    rng = np.random.default_rng(11)
    out = []
    for to in (rng.normal(size=u.shape), u[rng.permutation(len(u))]):
        off = to - (to * u).sum(1, keepdims=True) * u
        size = np.linalg.norm(off, axis=1, keepdims=True)
        on = size[:, 0] > 1e-6
        out.append((u[on], least * u[on] + np.sqrt(1 - least * least) * off[on] / size[on]))
    return [p for p in out if len(p[0])]


def learn_turns(u: np.ndarray, bands: list[tuple[int, int]], least: float, rotations: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rotations, each with the point it turns about, under which RECALL of the pairs at cosine least share a band."""
    mean = u.mean(0)
    pairs = partners(np.random.default_rng(10).permutation(u)[:PROBES], least)
    met = [np.zeros(len(x), bool) for x, _ in pairs]
    share = (1 - np.arccos(min(max(least, -1.0), 1.0)) / np.pi) ** max(b - a for a, b in bands)
    need = int(np.ceil(np.log(1 - RECALL) / np.log1p(-min(share, 0.999)) / len(bands)))
    turns = []
    while len(turns) < rotations or (any(m.mean() < RECALL for m in met) and len(turns) < 2 * need):
        turns.append((learn_rotation(u - mean, len(turns)), mean))
        for m, (x, y) in zip(met, pairs, strict=True):
            m |= (band_codes(x, turns[-1:], bands) == band_codes(y, turns[-1:], bands)).any(1)
    if any(m.mean() < RECALL for m in met):
        turns += [(learn_rotation(u, seed, 0), np.zeros(u.shape[1])) for seed in range(len(turns), len(turns) + need)]
    return turns


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _in_reach(ids: np.ndarray, x: np.ndarray, least: float, block: int = 512):
    """(a, b) of all pairs of a bucket with cosine >= least, block by block along its first direction."""
    u = unit(x)
    if len(u) > block:
        centred = u - u.mean(0)
        v = np.random.default_rng(0).normal(size=u.shape[1])
        for _ in range(8):
            v = centred.T @ (centred @ v)
            v /= np.linalg.norm(v) or 1
        key = u @ v
        order = np.argsort(key, kind="stable")
        ids, x, u, key = ids[order], x[order], u[order], key[order]
    else:
        key = np.zeros(len(u))
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    for s in range(0, len(u), block):
        e = min(s + block, len(u))
        end = int(np.searchsorted(key, key[e - 1] + reach, side="right"))
        for t in range(s, end, block):
            sim = u[s:e] @ u[t : min(t + block, end)].T
            i, j = np.nonzero(sim >= least - 1e-9)
            i, j = i + s, j + t
            on = i < j
            i, j = i[on], j[on]
            yield np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), cosine(x[i], x[j])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    dot = (a * b).sum(1)
    return dot / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _near_offsets(k: np.ndarray, ids: np.ndarray, x: np.ndarray, least: float):
    """(a, b) of the pairs within each bucket of many small ones, rows apart by 1, 2, ... at a time."""
    order = np.argsort(k, kind="stable")
    k, ids, x = k[order], ids[order], x[order]
    i = np.arange(len(k))
    off = 1
    while len(i := i[i + off < len(k)]) and len(i := i[k[i] == k[i + off]]):
        j = i + off
        on = cosine(x[i], x[j]) >= least
        yield np.minimum(ids[i[on]], ids[j[on]]), np.maximum(ids[i[on]], ids[j[on]])
        off += 1


def _table(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = t.column("x").combine_chunks()
    return t.column("id").to_numpy(), lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.float64)


def _found(parts) -> pa.Table:
    parts = list(parts)
    a, b = (np.concatenate([np.empty(0, np.int64), *(p[i] for p in parts)]) for i in (0, 1))
    both = np.unique(np.stack((a, b), 1), axis=0)
    return pa.Table.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _small(least: float):
    def run(t: pa.Table) -> pa.Table:
        ids, x = _table(t)
        return _found(_near_offsets(t.column("k").to_numpy(), ids, x, least))

    return run


def _pairs(least: float):
    def run(t: pa.Table) -> pa.Table:
        ids, x = _table(t)
        return _found((p[c >= least], q[c >= least]) for p, q, c in _in_reach(ids, x, least))

    return run


def near_pairs(vectors: DataFrame, least: float = LEAST, rotations: int = ROTATIONS, sample: int = SAMPLE) -> DataFrame:
    """(a, b), a < b, of distinct valid vectors (id, x array<double>) with cosine >= least."""
    rows = vectors.count()
    if rows < 2:
        return vectors.sparkSession.createDataFrame([], "a long, b long")
    share = min(1.0, sample / rows)
    part = vectors.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < int(np.ceil(1_000_000 * share)))
    got = np.array([r["x"] for r in part.orderBy("id").select("x").limit(2 * sample).collect()] or [vectors.first()["x"]])
    u = unit(got)
    bands = band_widths(rows, u.shape[1])
    turns = learn_turns(u, bands, least, rotations)

    def keys(it):
        for b in it:
            lists = b.column("x")
            x = unit(lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.float64))
            k = band_codes(x, turns, bands)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(k) + 1, dtype=np.int32) * k.shape[1]), pa.array(k.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists], ["id", "ks"])

    coded = vectors.mapInArrow(keys, "id long, ks array<bigint>").select("id", F.explode("ks").alias("k"))
    coded, _ = materialize(coded, "codes")
    # Buckets with the same members are compared once.
    sizes = coded.groupBy("k").agg(F.count("*").alias("m"), F.expr("bit_xor(xxhash64(id))").alias("s1"), F.expr("bit_xor(xxhash64(id, 1))").alias("s2"))
    once = sizes.where("m > 1").groupBy("m", "s1", "s2").agg(F.min("k").alias("k"))
    cells = coded.join(once, "k")
    # Small buckets go to tasks in bundles of about BUNDLE rows.
    bundles = max(1, -(-(rows * len(bands) * len(turns)) // BUNDLE))
    few = cells.where(F.col("m") <= BUCKET).withColumn("g", F.pmod(F.xxhash64("k"), F.lit(bundles)))
    near = few.select("id", "k", "g").join(vectors, "id").groupBy("g").applyInArrow(_small(least), "a long, b long")
    # A bucket above BUCKET rows is compared as pairs of its parts, each in its own task.
    cells = cells.where(F.col("m") > BUCKET)
    parts = F.ceil(F.col("m") / BUCKET).cast("int")
    cells = cells.withColumns({"parts": parts, "part": F.pmod(F.xxhash64("id", F.lit(9)), parts).cast("int")})
    other = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    cells = cells.select("id", "k", F.explode(other).alias("p"))
    large = cells.join(vectors, "id").groupBy("k", "p").applyInArrow(_pairs(least), "a long, b long")
    grouped = near.unionAll(large)
    return grouped.distinct()


def embedding_links(emb: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """(members, links) of emb (vec_id, embedding): members has vec_id, n_links, component_id, kept."""
    spark = emb.sparkSession
    rows = emb.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("x"))
    if rows.schema["x"].dataType.elementType.typeName() != "float":  # single precision travels as it is
        rows = rows.withColumn("x", F.col("x").cast("array<double>"))
    dim = rows.where("x IS NOT NULL").groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = dim[0]["d"] if dim else 0
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    ok = (F.size("x") == dim) & F.coalesce(F.forall("x", fine), F.lit(False)) & F.exists("x", lambda v: v != 0) & F.col("vec_id").isNotNull()
    kind = rows.schema["x"].dataType.elementType
    valid = rows.where(ok).select("vec_id", "x").withColumn("x", F.transform("x", lambda v: F.when(v == 0, F.lit(0.0).cast(kind)).otherwise(v)))
    classes = valid.groupBy("x").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("copies"))
    classes, _ = materialize(classes, "classes")
    links, _ = materialize(near_pairs(classes.select(F.col("rep").alias("id"), "x"), least), "pairs")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(classes.select(F.col("rep").alias("b"), "copies"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("near"))
    label = connected_components(links).withColumnRenamed("id", "rep")
    info = classes.join(near, "rep", "left").join(label, "rep", "left")
    info = info.select("x", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    of = valid.join(info, "x").groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    out = rows.select("vec_id").join(of, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), links


def op3_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))[0]


#: Exact, and so equal to the query wherever its recall is whole, as on tables of this kind.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda y: y IS NOT NULL AND isfinite(y)))
    AND list_bool_or(list_transform(embedding, lambda y: y <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN (SELECT a AS vec_id, min(b) AS c FROM r GROUP BY a) c USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) n USING (vec_id)
"""
