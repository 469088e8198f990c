"""SentencePiece encoding and decoding as a relational lattice.

1. A text's blanks become the piece set's word mark, one more mark stands in front, and the text is cut into
   words wherever two characters meet that no piece holds side by side: before runs of marks (checked when the
   piece table is read), and mostly between letters and signs. No piece goes on past such a cut, so words are
   independent and each distinct one is encoded once.
2. Tasks number the words of blocks of documents and send every block's distinct words, packed, to hash
   ranges; no occurrence is shuffled, and the commonest word travels once per block.
3. Each range's distinct words are exploded into their substrings of bounded length and equi-joined to the
   piece table (broadcast: its size is that of the model file, and checked).
4. The edges found are grouped by word and folded to the word's pieces. A unigram model takes the path of
   greatest total score: ``viterbi`` folds the edges, by the place where they end, with Spark's higher-order
   ``aggregate``; its state holds the best scores of the last places only, so it is linear in the edges. A
   byte-pair model's result is not that path: ``merge`` joins, among the lattice's edges, the best-scored
   neighbours first (ties: the leftmost), with a heap. Characters without a piece become byte pieces.
5. Ranges answer each block with the ids of its words, and blocks put their documents together.

Decoding looks ids up in the piece table, joins bytes and drops the first mark.

Edge cases: null and empty texts give no ids and decode to the empty text; repeated rows are encoded one by
one; null doc_ids stay null; an empty table gives an empty result; extra columns are ignored; a word may be
as long as its text (a text without blanks), the cost grows with its length times the longest piece.
"""

from __future__ import annotations

import heapq
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pack_arrays, partitions, remove, table, tidied, unpack_arrays
from .tokens import slices, tokenizer_path

MARK = "▁"
#: Rows of a piece table that may be broadcast.
MAX_PIECES = 2_000_000
#: Bytes of text whose words are numbered together.
BLOCK_BYTES = 32_000_000
BLOCK_ROWS = 60_000
#: Compression of packed words and numbers, which are written once and shuffled.
LEVEL = 9
#: Words of a dictionary that are packed together.
PACK_WORDS = 50_000
#: Characters of a word from which one row's substrings start.
STRIDE = 256


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _fields(raw: bytes):
    """(number, value) of a serialised message's fields."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        if key & 7 == 0:
            value, at = _varint(raw, at)
        elif key & 7 == 2:
            n, at = _varint(raw, at)
            value, at = raw[at : at + n], at + n
        else:
            n = 8 if key & 7 == 1 else 4
            value, at = raw[at : at + n], at + n
        yield key >> 3, value


def is_byte_pair(path: str) -> bool:
    """Whether a model file names byte-pair merges (2) as its kind, not a unigram model (1, or unset)."""
    with open(path, "rb") as f:
        raw = f.read()
    return any(k == 3 and v == 2 for n, spec in _fields(raw) if n == 2 for k, v in _fields(spec))


def piece_table(spark: SparkSession, path: str) -> tuple[DataFrame, int, int]:
    """(pieces: piece, id, score; longest piece; id of byte 0) of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in ids]
    if any(MARK in p.lstrip(MARK) for p, _, _ in rows):
        raise ValueError("a piece goes on past a word mark")
    if len(rows) > MAX_PIECES:
        raise ValueError(f"{len(rows)} pieces are too many to broadcast")
    return spark.createDataFrame(rows, "piece string, id int, score double"), max(len(p) for p, _, _ in rows), sp.piece_to_id("<0x00>")


def piece_pairs(pieces: DataFrame) -> list[str]:
    """The pairs of characters that stand side by side in a piece."""
    return sorted({r.piece[i : i + 2] for r in pieces.select("piece").collect() for i in range(len(r.piece) - 1)})


class Cutter:
    """Cuts marked texts between characters that no piece holds side by side."""

    def __init__(self, pairs: list[str]):
        letters = sorted({c for p in pairs for c in p})
        self.size = len(letters) + 1  # class 0: in no pair
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in letters]] = np.arange(1, self.size)
        self.joins = np.zeros(self.size * self.size, bool)
        self.joins[[int(self.kind[ord(a)]) * self.size + int(self.kind[ord(b)]) for a, b in pairs]] = True

    def words(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """The words of the texts, one after another, and how many each text has."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))))
        whole = "".join(marked)
        x = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
        kind, cut = self.kind[x], np.ones(len(x) + 1, bool)
        np.logical_not(self.joins[kind[:-1] * self.size + kind[1:]], out=cut[1:-1]) if len(x) else None
        cut[ends] = True
        at = np.flatnonzero(cut)
        width = (x >= 0x80).view(np.uint8) + (x >= 0x800) + (x >= 0x10000) + 1
        byte = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))[at]
        data = pa.py_buffer(whole.encode("utf-8", "surrogatepass"))
        words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(byte), data])
        return words, np.diff(np.searchsorted(at, ends))


def number(codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, order): words renumbered by how often they come, the commonest first, in order; one that comes once has code 0."""
    times = np.bincount(codes, minlength=words)
    order = np.argsort(-times, kind="stable")  # words that come once stay as they first came
    rank = np.empty(words, np.uint32)
    rank[order] = np.where(times[order] > 1, np.arange(1, words + 1), 0)
    return rank[codes], order


def numbers(codes: np.ndarray, words: int) -> np.ndarray:
    """Places in order of the words that number() gave those codes."""
    once = codes == 0
    n = int(np.count_nonzero(once))
    out = codes.astype(np.int64) - 1
    out[once] = np.arange(words - n, words)
    return out


def _send_blocks(ranges: int, pairs: list[str]):
    """Per block of documents: their words as numbers (rng -1), and the distinct words of each hash range."""
    import xxhash

    def blobs(ids, counts, parts):
        block = int.from_bytes(uuid.uuid4().bytes[:8], "big", signed=True)
        parts = pa.chunked_array(parts).unify_dictionaries()
        known = parts.chunk(0).dictionary
        codes, order = number(np.concatenate([c.indices.to_numpy() for c in parts.chunks]), len(known))
        words = known.take(pa.array(order)).to_pylist()
        rng = np.fromiter((xxhash.xxh3_64_intdigest(w) % ranges for w in words), np.uint32, len(words))
        null = np.array([i is None for i in ids], np.uint8)
        yield -1, block, (np.array([i or 0 for i in ids], np.int64), null, np.concatenate(counts).astype(np.uint32), codes, rng)
        order = np.argsort(rng, kind="stable")
        edges = np.searchsorted(rng[order], np.arange(ranges + 1))
        for r in range(ranges):
            mine = [words[i] for i in order[edges[r] : edges[r + 1]].tolist()]
            if mine:
                yield r, block, (np.fromiter(map(len, mine), np.uint32, len(mine)), np.frombuffer(b"".join(mine), np.uint8))

    def out(*held):
        for r, block, arrays in blobs(*held):
            cols = [pa.array([r], pa.int32()), pa.array([block], pa.int64()), pa.array([pack_arrays(*arrays, level=LEVEL)], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["rng", "block", "blob"])

    def run(it):
        cutter = Cutter(pairs)
        ids, counts, parts, held = [], [], [], 0
        for b in (x for whole in it for x in slices(whole)):
            words, n = cutter.words(b.column("text").to_pylist())
            ids.extend(b.column("doc_id").to_pylist())
            counts.append(n)
            parts.append(words.dictionary_encode())
            held += len(words.buffers()[2])
            if held >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                yield from out(ids, counts, parts)
                ids, counts, parts, held = [], [], [], 0
        if ids:
            yield from out(ids, counts, parts)

    return tidied(run)


def _binary(sizes: np.ndarray, flat: np.ndarray) -> pa.Array:
    """A binary array of values of the given sizes."""
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _words_of_range(t: pa.Table) -> pa.Table:
    """The distinct words of one range, sorted: like words side by side take less room."""
    words = pc.unique(pa.concat_arrays([_binary(*unpack_arrays(b)) for b in t.column("blob").to_pylist()]))
    words = words.take(pc.array_sort_indices(words))
    return pa.Table.from_arrays([pa.array([t.column("rng")[0].as_py()] * len(words), pa.int32()), words.cast(pa.large_string()).cast(pa.string())], ["rng", "word"])


def lattice(words: DataFrame, pieces: DataFrame, longest: int, singles: bool = True) -> DataFrame:
    """Edges of words (wid, word, ...): from character a, l of them, with the piece's id and score.

    Every character has its row, with null id and score where it is no piece; without singles only a word's first
    one has. head is the word, on that first row alone. All columns of words but word are kept. A word's rows
    follow one another.
    """
    keep = [c for c in words.columns if c != "word"]
    spots = F.sequence(F.lit(0), F.length("word") - 1, F.lit(STRIDE))
    parts = F.transform(spots, lambda i: F.struct(i.alias("base"), F.substring(F.col("word"), i + 1, F.lit(STRIDE + longest - 1)).alias("part")))
    x = words.where(F.length("word") > 0).select(*keep, "word", F.explode(parts).alias("p"))
    x = x.select(*keep, "p.base", "p.part", F.when(F.col("p.base") == 0, F.col("word")).alias("head"))
    x = x.select(*keep, "base", "part", "head", F.explode(F.sequence(F.lit(0), F.least(F.length("part"), F.lit(STRIDE)) - 1)).alias("i"))
    a = F.col("base") + F.col("i")
    x = x.select(*keep, a.alias("a"), F.substring(F.col("part"), F.col("i") + 1, F.lit(longest)).alias("sub"), F.when(a == 0, F.col("head")).alias("head"))
    first = F.lit(1) if singles else F.when(F.col("a") == 0, 1).otherwise(2)
    x = x.where(first <= F.length("sub")).select(*keep, "a", "sub", "head", F.explode(F.sequence(first, F.length("sub"))).alias("l"))
    x = x.withColumn("piece", F.substring(F.col("sub"), F.lit(1), F.col("l"))).drop("sub")
    x = x.join(F.broadcast(pieces), "piece", "left").where((F.col("l") == 1) | F.col("id").isNotNull())
    return x.select(*keep, "a", "l", "id", "score", F.when(F.col("l") == 1, F.col("head")).alias("head"))


def viterbi(edges: DataFrame, longest: int, unknown: float | None = None) -> DataFrame:
    """(wid, path) of a lattice's words: the (a, l) of the path of greatest total score, in order.

    A character without a piece is an edge of the score unknown (by default 10 below the least of all). Ties go
    to the path whose last differing edge is longer.
    """
    low = F.lit(unknown) if unknown is not None else F.coalesce(F.get("low", 0), F.lit(0.0)) - 10.0
    if unknown is None:
        least = edges.agg(F.array(F.min("score")).alias("low"))
        edges = edges.crossJoin(F.broadcast(least))  # one row
    e = edges.select("wid", (F.col("a") + F.col("l")).alias("b"), "l", F.coalesce("score", low).alias("score"))
    ends = e.groupBy("wid", "b").agg(F.collect_list(F.struct("l", "score")).alias("es"))
    each = ends.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("b", "es"))).alias("at"))
    zero = F.struct(F.array(F.lit(0.0)).alias("best"), F.array().cast("array<int>").alias("back"))

    def step(s: Column, x: Column) -> Column:
        # best: scores of the last places, nearest last; an edge of l characters starts l places back
        reach = F.transform(x["es"], lambda g: F.struct((F.try_element_at(s["best"], -g["l"]) + g["score"]).alias("score"), g["l"].alias("l")))
        pick = F.array_max(reach)
        best = F.concat(F.slice(s["best"], F.greatest(F.size(s["best"]) - (longest - 2), F.lit(1)), F.lit(longest)), F.array(pick["score"]))
        return F.struct(best.alias("best"), F.concat(s["back"], F.array(pick["l"])).alias("back"))

    folded = each.select("wid", F.aggregate("at", zero, step)["back"].alias("back"))

    def walk(s: Column, _: Column) -> Column:
        l = F.get(F.col("back"), s["b"] - 1)  # noqa: E741
        on = F.struct((s["b"] - l).alias("b"), F.concat(s["path"], F.array(F.struct((s["b"] - l).alias("a"), l.alias("l")))).alias("path"))
        return F.when(s["b"] > 0, on).otherwise(s)

    start = F.struct(F.size("back").alias("b"), F.array().cast("array<struct<a:int,l:int>>").alias("path"))
    return folded.select("wid", F.reverse(F.aggregate("back", start, walk)["path"]).alias("path"))


def merge(n: int, edges: dict[int, float], width: int) -> list[int]:
    """Starts of the pieces of a word of n characters: neighbours whose union is an edge join, best score first.

    edges: score by a * width + l.
    """
    end, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []
    for a in range(n - 1):
        score = edges.get(a * width + 2)
        if score is not None:
            heap.append((-score, a, a + 1, a + 2))
    heapq.heapify(heap)
    while heap:
        _, a, m, b = heapq.heappop(heap)
        if not (live[a] and end[a] == m and live[m] and end[m] == b):
            continue
        end[a], live[m] = b, False
        if b < n:
            before[b] = a
            c = end[b]
            score = edges.get(a * width + c - a) if c - a < width else None
            if score is not None:
                heapq.heappush(heap, (-score, a, b, c))
        p = before[a]
        if p >= 0:
            score = edges.get(p * width + b - p) if b - p < width else None
            if score is not None:
                heapq.heappush(heap, (-score, p, a, b))
    return [a for a in range(n) if live[a]]


def _packed(rng: np.ndarray, words: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
    """(rng, blob): words and their ids, those of one range together."""
    order = np.argsort(rng, kind="stable")
    names, first = np.unique(rng[order], return_index=True)
    blobs = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
        w, i = [words[x] for x in order[a:b]], [ids[x] for x in order[a:b]]
        sizes = (np.fromiter(map(len, x), np.uint32, len(x)) for x in (w, i))
        blobs.append(pack_arrays(*sizes, np.frombuffer(b"".join(w), np.uint8), np.frombuffer(b"".join(i), "<u4"), level=LEVEL))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["rng", "blob"])


def unpack_words(blobs: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Words and ids of a dictionary's blobs."""
    parts = [unpack_arrays(b) for b in blobs]
    if not parts:
        return pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
    return pa.concat_arrays([_binary(w, f) for w, _, f, _ in parts]), pa.concat_arrays([_binary(i, g.view(np.uint8)) for _, i, _, g in parts])


def _pack_rows(it):
    for b in it:
        if len(b):
            yield _packed(b.column("rng").to_numpy(), b.column("word").to_pylist(), b.column("ids").to_pylist())


def _merged(longest: int, byte0: int, singles: dict[str, int], skip: int):
    """Fold a byte-pair lattice's rows (without singles), word after word, to packed words without their first skip characters and ids."""
    width = longest + 1

    def fold(word, keys, scores, ids):
        n, found, out = len(word), dict(zip(keys, ids, strict=True)), []
        cuts = merge(n, dict(zip(keys, scores, strict=True)), width) if len(keys) > 1 else list(range(n))
        cuts.append(n)
        for x, y in zip(cuts, cuts[1:]):
            i = found[x * width + y - x] if y - x > 1 else singles.get(word[x])
            if i is None:
                out.extend([byte0 + c for c in word[x].encode("utf-8", "surrogatepass")])
            else:
                out.append(i)
        return np.array(out, "<i4").tobytes()

    def run(it):
        held = None
        for b in it:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            heads = np.flatnonzero(held.column("head").is_valid().to_numpy())
            if len(heads) < 2:
                continue  # the word may go on
            yield out(held.slice(0, int(heads[-1])), heads[:-1])
            held = held.slice(int(heads[-1]))
        if held is not None and len(held):
            yield out(held, np.flatnonzero(held.column("head").is_valid().to_numpy()))

    def out(t, heads):
        edges = [*heads.tolist(), len(t)]
        keys = (t.column("a").to_numpy().astype(np.int64) * width + t.column("l").to_numpy()).tolist()
        ids = pc.fill_null(t.column("id"), -1).to_numpy().tolist()
        scores = pc.fill_null(t.column("score"), 0.0).to_numpy().tolist()
        words = t.column("head").drop_null().to_pylist()
        found = [fold(w, keys[x:y], scores[x:y], ids[x:y]) for w, x, y in zip(words, edges, edges[1:])]
        return [t.column("rng").to_numpy()[heads], [w[skip:].encode("utf-8", "surrogatepass") for w in words], found]

    def packed(it):
        rng, words, ids = [], [], []
        for r, w, i in run(it):
            rng.append(r)
            words.extend(w)
            ids.extend(i)
            if len(words) >= PACK_WORDS:
                yield _packed(np.concatenate(rng), words, ids)
                rng, words, ids = [], [], []
        if words:
            yield _packed(np.concatenate(rng), words, ids)

    return tidied(packed)


def dictionary(words: DataFrame, pieces: DataFrame, longest: int, byte0: int, byte_pair: bool, skip: int = 1) -> DataFrame:
    """(rng, blob) of distinct words (rng, wid, word): packed words and ids, for unpack_words.

    The packed words go without their first skip characters: one where all of them begin with a mark.
    """
    if byte_pair:
        singles = {r.piece: r.id for r in pieces.where(F.length("piece") == 1).collect()}  # of the model's pieces
        edges = lattice(words.select("rng", "word"), pieces, longest, singles=False)
        return edges.mapInArrow(_merged(longest, byte0, singles, skip), "rng int, blob binary")
    edges = lattice(words, pieces, longest)
    marked = words.join(viterbi(edges, longest), "wid")
    at = F.explode(F.transform("path", lambda p, k: F.struct(k.alias("k"), F.substring(F.col("word"), p["a"] + 1, p["l"]).alias("piece"))))
    each = marked.select("rng", "wid", "word", at.alias("p")).select("rng", "wid", "word", "p.*").join(F.broadcast(pieces), "piece", "left")
    hex4 = lambda n: F.concat(*[F.lpad(F.hex(F.pmod(F.shiftright(n, 8 * i), F.lit(256))), 2, "0") for i in range(4)])
    raw = F.hex(F.encode("piece", "utf-8"))
    as_bytes = F.array_join(F.transform(F.sequence(F.lit(0), (F.length(raw) / 2 - 1).cast("int")), lambda i: hex4(F.conv(F.substring(raw, 2 * i + 1, F.lit(2)), 16, 10).cast("int") + byte0)), "")
    each = each.withColumn("h", F.when(F.col("id").isNotNull(), hex4(F.col("id"))).otherwise(as_bytes))
    whole = each.groupBy("rng", "wid", "word").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("hs"))
    whole = whole.select("rng", F.encode(F.substr("word", F.lit(skip + 1)), "utf-8").alias("word"), F.unhex(F.array_join(F.transform("hs", lambda x: x["h"]), "")).alias("ids"))
    return whole.mapInArrow(_pack_rows, "rng int, blob binary")


def _take(values: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and joined bytes of a binary array's values at the given places."""
    got = values.take(pa.array(at))
    sizes = pc.binary_length(got).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, np.frombuffer(b"".join(got.to_pylist()), np.uint8)


def _answer(asks: pa.Table, known: pa.Table) -> pa.Table:
    """Per block that asked one range: the ids of its words, in the order of asking."""
    out = []
    words, ids = unpack_words(known.column("blob").to_pylist())
    for blob in asks.column("blob").to_pylist():
        at = pc.index_in(_binary(*unpack_arrays(blob)), value_set=words).to_numpy()
        sizes, flat = _take(ids, at)
        out.append(pack_arrays((sizes // 4).astype(np.uint32), flat.view("<u4"), level=LEVEL))
    return pa.Table.from_arrays([asks.column("rng"), asks.column("block"), pa.array(out, pa.binary())], ["rng", "block", "blob"])


def _assemble(sent: pa.Table, replies: pa.Table) -> pa.Table:
    """The documents of one block with their ids."""
    ids, null, counts, codes, rng = unpack_arrays(sent.column("blob")[0].as_py())
    order = np.argsort(replies.column("rng").to_numpy(), kind="stable").tolist()
    found = [unpack_arrays(replies.column("blob")[i].as_py()) for i in order]
    sizes = np.concatenate([s for s, _ in found] or [np.empty(0, np.uint32)]).astype(np.int64)
    flat = np.concatenate([f for _, f in found] or [np.empty(0, np.uint32)])
    place = np.empty(len(rng), np.int64)
    place[np.argsort(rng, kind="stable")] = np.arange(len(rng))
    starts, code = np.cumsum(sizes) - sizes, place[numbers(codes, len(rng))]
    n = sizes[code]
    at = np.concatenate(([0], np.cumsum(n)))
    where = np.repeat(starts[code] - at[:-1], n)
    where += np.arange(at[-1])
    ends = at[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[where].view(np.int32)))
    return pa.Table.from_arrays([pa.array(ids, pa.int64(), mask=null.astype(bool)), lists], ["doc_id", "ids"])


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of docs (doc_id, text), one row for each of theirs."""
    spark = docs.sparkSession
    pieces, longest, byte0 = piece_table(spark, model)
    ranges = partitions(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent, _ = materialize(plain.mapInArrow(_send_blocks(ranges, piece_pairs(pieces)), "rng int, block long, blob binary"), "blocks")
    asks = sent.where("rng >= 0")
    words = asks.groupBy("rng").applyInArrow(_words_of_range, "rng int, word string")
    words, words_path = materialize(words.withColumn("wid", F.monotonically_increasing_id()), "words")
    known, _ = materialize(dictionary(words, pieces, longest, byte0, is_byte_pair(model), skip=0), "dictionary")
    remove(spark, words_path)
    replies = asks.groupBy("rng").cogroup(known.groupBy("rng")).applyInArrow(_answer, "rng int, block long, blob binary")
    blocks = sent.where("rng < 0").select("block", "blob")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_assemble, "doc_id long, ids array<int>")


def _piece_bytes(model: str) -> list[bytes]:
    """Bytes of each id; none for control pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    kind = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).encode()
    return [kind(i) for i in range(sp.get_piece_size())]


def _texts(ids: pa.ListArray, pieces: pa.Array) -> list[str]:
    lists = pa.ListArray.from_arrays(ids.offsets, pieces.take(ids.values))
    return [(x or b"").decode("utf-8", "replace").replace(MARK, " ")[1:] for x in pc.binary_join(lists, b"").to_pylist()]


def _decode(table_: list[bytes]):
    def run(it):
        pieces = pa.array(table_, pa.binary())
        for b in it:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_texts(b.column("ids"), pieces), pa.string())], [*b.schema.names, "text"])

    return run


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """encoded (doc_id, ids) with text."""
    schema = encoded.select("doc_id", "ids").schema.add("text", "string")
    return encoded.select("doc_id", "ids").mapInArrow(_decode(_piece_bytes(model)), schema)


def _digest(table_: list[bytes]):
    def run(it):
        for b in _decode(table_)(it):
            lists = b.column("ids")
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64()), b.column("text")], ["doc_id", "n_ids", "ids_crc32", "text"])

    return tidied(run)


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 and the decoded text's length and sha256 of every document."""
    model = tokenizer_path("piece_bpe_32k.model")
    encoded = encode_documents(table(spark, sf_dir, "documents"), model)
    out = encoded.mapInArrow(_digest(_piece_bytes(model)), "doc_id long, n_ids long, ids_crc32 long, text string")
    return out.select("doc_id", "n_ids", "ids_crc32", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
