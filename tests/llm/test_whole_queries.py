"""Whole queries of the training-data operators and the pipeline against their SQL or plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ribospark.llm import embedding_dedup, jaccard_join, packing, pitman_yor, quality_classifier, quality_rules, suffix_dedup, url_filters
from ribospark.llm.queries import ORACLES, QUERIES
from ribospark.llm.tokens import tokenizer_path


def rows_of(spark, sf, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in cur.fetchall())
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == want


def words(text):
    return (text or "").encode().lower().split()


def test_shared_ids_of_different_texts(spark):
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    a, b, c = text("a", 60), text("b", 60), text("c", 1000)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, a), (4, c), (5, ""), (6, c), (7, b + " z"), (7, c), (8, text("d", 30)), (9, c), (9, text("e", 9)), (None, a)]
    members, _ = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()}
    assert got == {1: (56, 1), 2: (57, 1), 3: (57, 1), 4: (996, 1), 5: (0, 5), 6: (996, 1), 7: (996, 1), 8: (26, 8), 9: (996, 1), None: (56, None)}


def check_pieces(rows, texts):
    """Pieces hold all ids of all texts, and fill sequences without gaps; returns the number of sequences."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {k: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for k, t in texts}
    of, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    assert of.keys() == ids.keys()
    for k, x in ids.items():
        parts = sorted(of[k], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert sum(r.length for r in parts) == len(x) and all(r.length == 1024 for r in parts[1:])
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(x[r.start : r.start + r.length].tobytes()) for r in parts]
    for parts in seqs.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    return len(seqs)


def best_fit_decreasing(lengths):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, c in enumerate(room) if c >= n]
        if fits:
            room[min(fits, key=room.__getitem__)] -= n
        else:
            room.append(1024 - n)
    return len(room)


def test_packing_query(spark, sf):
    got = QUERIES["op8_best_fit_packing"](spark, sf).collect()
    assert check_pieces(got, rows_of(spark, sf, "documents", "doc_id", "text")) == best_fit_decreasing([r.length for r in got])


def test_language_model_query(spark, sf):
    texts = rows_of(spark, sf, "documents", "doc_id", "text")
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in texts}
    count = Counter(w for k, t in texts if not held[k] for w in [*words(t), None])
    total, distinct = sum(count.values()), len(count)
    out = QUERIES["op6_lm_scoring"](spark, sf)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(texts)
    for k, t in texts:
        ws, r = [*words(t), None], got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(ws), sum(w in count for w in ws), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws))
    per = {r.held_out: r for r in pitman_yor.perplexity(out).collect()}
    assert all(r.perplexity < r.base_perplexity for r in per.values()) and per[False].perplexity < per[True].perplexity


def test_language_model_is_a_distribution():
    """After every sweep the probabilities of all training words and one other add up to 1 in each context."""
    rng = np.random.default_rng(6)
    contexts = np.array([0, 97, 256 + 97, 512 + 98])
    key2 = np.unique(rng.integers(0, 40, 120) * pitman_yor.CONTEXTS + rng.choice(contexts, 120))
    wh = np.arange(1, 41, dtype=np.uint64)
    have, w = np.unique(key2 // pitman_yor.CONTEXTS, return_inverse=True)
    s = pitman_yor.Seating.new(wh[have], w * pitman_yor.CONTEXTS + key2 % pitman_yor.CONTEXTS, rng.integers(1, 60, len(key2)))
    for sweep in range(4):
        total = pitman_yor.Totals(dict(zip(*s.totals(), strict=True)))
        assert (s.t2 >= 1).all() and (s.t2 <= s.c2).all() and (s.t1 <= s.c1).all() and (s.t0 <= s.c0).all()
        for u in contexts:
            at = lambda keys, want, x: np.where(np.isin(want, keys), np.append(x, 0)[np.searchsorted(keys, want)], 0)
            words = np.arange(len(have) + 1)
            q = total.root(np.append(s.c0, 0), np.append(s.t0, 0))
            k1, k2 = words * 256 + u % 256, words * pitman_yor.CONTEXTS + u
            q = total.byte(u % 256, at(s.key1, k1, s.c1), at(s.key1, k1, s.t1), q)
            assert total.context(u, at(s.key2, k2, s.c2), at(s.key2, k2, s.t2), q).sum() == pytest.approx(1)
        table = next(iter(pitman_yor._sweep(total, sweep)(pitman_yor._state(0, s).to_batches())))
        s = pitman_yor.Seating.load(table.column("state")[0].as_py())


def test_classifier_query(spark, sf, tmp_path):
    """Held-out rows are told apart, and their labels are never read."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.select("doc_id", "quality").collect()}
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for k, r in got.items())
    good = np.array([r.score for k, r in got.items() if r.held_out and quality.get(k) == 1])
    bad = np.array([r.score for k, r in got.items() if r.held_out and quality.get(k) == 0])
    assert len(good) and len(bad) and np.mean([(x > bad).mean() for x in good]) > 0.9
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: r.score for r in QUERIES["op5_quality_classifier"](spark, str(tmp_path)).collect()}
    assert again == pytest.approx({k: r.score for k, r in got.items()})


def components(texts):
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for k, w in ((k, words(t)) for k, t in texts)}
    comp = {k: k for k in sets}
    while True:
        old = dict(comp)
        for a in sets:
            for b in sets:
                if comp[b] < comp[a] and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b]
        if old == comp:
            return comp


def left_over(texts):
    """Bytes of each text that no 50-byte string of an earlier document covers, whole characters only."""
    least = {}
    raw = {k: (t or "").encode() for k, t in texts}
    for k, r in raw.items():
        for i in range(len(r) - 49):
            least[r[i : i + 50]] = min(k, least.get(r[i : i + 50], k))
    out = {}
    for k, r in raw.items():
        end, keep = 0, bytearray()
        for i in range(len(r)):
            if i + 50 <= len(r) and least[r[i : i + 50]] < k:
                end = i + 50
            if i >= end:
                keep.append(r[i])
        out[k] = bytes(keep).decode("utf-8", "ignore")
    return out


def test_pipeline_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = stages["quality_rules"](spark, docs, sf)
    kept = {r.doc_id for r in quality_rules.quality_ledger(docs).collect() if r.kept}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < len(texts)

    scored = stages["quality_classifier"](spark, good, sf)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    passed = {r.doc_id for r in scored.collect()}
    assert scored.columns == docs.columns and passed <= kept
    assert np.mean([k in passed for k in kept if quality.get(k) == 1]) > 0.95

    single = stages["ngram_jaccard_join"](spark, docs, sf)
    comp = components(texts.items())
    least = {k for k, c in comp.items() if k == c}
    assert single.columns == docs.columns and {r.doc_id: r.text for r in single.collect()} == {k: texts[k] for k in least}

    cut = stages["suffix_array_dedup"](spark, docs, sf)
    rows = cut.collect()
    want = left_over(texts.items())
    assert cut.schema == docs.schema and {r.doc_id: r.text or "" for r in rows} == want
    assert "n_chars" not in docs.columns or all(r.n_chars == len(r.text or "") for r in rows)

    check_pieces(stages["best_fit_packing"](spark, docs, sf).collect(), list(texts.items()))


def test_pipeline_run(spark, sf):
    """run() packs what plain Python leaves of the documents that rules and classifier pass."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    passed = corpus_pipeline.quality_classifier_stage(spark, corpus_pipeline.quality_rules_stage(spark, docs, sf), sf)
    texts = {r.doc_id: r.text for r in passed.collect()}
    comp = components(texts.items())
    texts = left_over([(k, t) for k, t in texts.items() if comp[k] == k])
    got = corpus_pipeline.run(spark, sf).collect()
    assert check_pieces(got, list(texts.items())) == best_fit_decreasing([r.length for r in got])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert jaccard_join.jaccard_join(none)[0].count() == 0
    assert pitman_yor.score_documents(none).count() == 0
    assert suffix_dedup.dedup_texts(none).count() == 0
    assert packing.pack_documents(none, tokenizer_path("byte_bpe_50k.json")).count() == 0
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0
    assert embedding_dedup.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<double>"))[0].count() == 0
    model = quality_classifier.fit_documents(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert quality_classifier.score_documents(none, model).count() == 0


def test_pipeline_of_nulls_and_repeated_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "one two", None), (3, "one two", None), (None, "no id", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name, stage in corpus_pipeline.STAGES[2:]:
        got = stage(spark, docs, "").collect()
        assert {r.doc_id for r in got} == {1, 2, 3, None}, name
