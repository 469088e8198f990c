"""Small fixtures: edge cases and brute force for the training-data operators."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ribospark.llm import embedding_dedup, jaccard_join, packing, pitman_yor, quality_classifier, quality_rules, suffix_dedup, token_store, url_filters, wavelet
from ribospark.llm.common import connected_components
from ribospark.llm.tokens import CachedEncoder, tokenizer_path

WORDS = [f"w{i}" for i in range(60)]
NEAR = " ".join(WORDS)
DOCS = [
    (0, NEAR, "a"), (1, NEAR.upper(), "b"), (2, NEAR + " end", None), (3, None, None), (4, "", "x"), (5, "one two", None), (6, "one two", None),
    (7, " ".join(reversed(WORDS)), None), (8, NEAR.replace("w5 ", "q "), None), (9, "<|endoftext|>  two\n\nlines \t é中", None), (9, "<|endoftext|>  two\n\nlines \t é中", None), (None, "no id", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, kept string")


def test_urls(spark):
    rows = [(1, "http://A.Example.COM/en/7?x"), (2, "http://x.net/de/8"), (3, None), (4, "nothing"), (5, "ftp://spam.org/x#y"), (6, "http://b.example.net/de/81"), (7, "http://badexample.com/en/7")]
    df = spark.createDataFrame(rows, "page_id int, url string").withColumn("rule", F.lit("old"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(df).collect()}
    assert got[1] == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[2] == ("x.net", "/de/8", "net/de/", "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("spam.org", "/x", None, "block")
    assert got[6][2:] == ("example.net/de/8", "block") and got[7][2:] == ("com/en/", "block")


def repeat_words(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({i + o for at in seen.values() if len(at) > 1 for i in at for o in range(8)})


def test_ledger(docs, spark):
    led = {(r.doc_id, r.text): r for r in quality_rules.quality_ledger(docs).collect()}
    assert led[3, None].n_words == 0 and led[3, None].base_failed and not led[3, None].kept
    texts = ["a b c d e f g h " * 3, "x " * 30, NEAR + "\n" + NEAR, "a\n \na\nb b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.ledger(df).collect():
        assert (r.n_words, r.n_repeat_words) == (len(r.text.split()), repeat_words(r.text.split()))
    led = quality_rules.ledger(df)
    rows = {r.rule: (r.failed, r.failed_alone, r.kept_without) for r in quality_rules.ablations(led, quality_rules.POLICIES["v1"]).collect()}
    bits = [r.fail_bits for r in led.collect()]
    want = {r.name: (sum(b >> r.bit & 1 for b in bits), sum(b == 1 << r.bit for b in bits), sum(b & ~(1 << r.bit) == 0 for b in bits)) for r in quality_rules.RULES}
    assert rows == want


def test_distinct_words_of_whole_texts(spark):
    rng = np.random.default_rng(5)
    fine = lambda n: [f"word{i}" for i in rng.integers(0, 5000, n)]
    poor = lambda n: [f"poor{i}" for i in rng.integers(0, 12, n)]
    words = [fine(200) + poor(4000), poor(200) + fine(4000), fine(150), poor(150), fine(4000), poor(4000)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    distinct = [len(set(w)) for w in words]
    led = quality_rules.quality_ledger(df).orderBy("doc_id").collect()
    assert [r.n_distinct_words for r in led] == distinct
    least = [0.22 * len(w) if len(w) <= 200 else 44 * (len(w) / 200) ** (2 / 3) for w in words]
    assert [bool(r.fail_bits & 128) for r in led] == [d < m for d, m in zip(distinct, least)]
    assert [r.doc_id for r in corpus_pipeline.quality_rules_stage(spark, df, "").orderBy("doc_id").collect()] == [1, 2, 4]


def test_ablation_of_empty_table(docs):
    assert quality_rules.quality_ledger(docs.limit(0)).count() == 0


def test_jaccard_against_brute_force(docs):
    members, _ = jaccard_join.jaccard_join(docs)
    sets = {}
    for i, t, _ in DOCS:
        w = (t or "").encode().lower().split()
        if i is not None:
            sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect() if r.doc_id is not None}
    assert got == {i: (len(sets[i]), comp[i]) for i in sets}


@pytest.mark.parametrize("block", [256, 7])
def test_jaccard_links_of_large_groups_are_whole(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(4)
    texts = []
    for g in range(2):
        base = [f"g{g}w{i}" for i in range(150)]
        for i in range(25):
            w = list(base)
            for at in rng.integers(0, 150, rng.integers(1, 5)):
                w[at] = f"own{g}x{i}x{at}"
            texts.append(" ".join(w))
    texts += texts[:2] + ["nothing like the others at all here"]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    want = {(a, b): len(sets[a] & sets[b]) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    members, links = jaccard_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = links.collect()
    assert len(got) == len({(r.a, r.b) for r in got}) and all((r.na, r.nb) == (len(sets[r.a]), len(sets[r.b])) for r in got)
    assert {(r.a, r.b): r.inter for r in got} == {k: v for k, v in want.items() if k[1] < 50}
    assert {r.doc_id: r.n_links for r in members.collect()} == {i: sum(i in k for k in want) for i in range(len(texts))}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 60)], "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 40: 40, 50: 40, 60: 40}


def brute_bytes(rows):
    least = {}
    for d, t in rows:
        r = (t or "").encode()
        for i in range(len(r) - 49):
            least[r[i : i + 50]] = min(d, least.get(r[i : i + 50], d))
    out = {}
    for d, t in rows:
        r, gone, end = (t or "").encode(), [], 0
        for i in range(len(r)):
            if i + 50 <= len(r) and least[r[i : i + 50]] < d:
                end = i + 50
            gone.append(i < end)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(r), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = ["ab" * 60, "ba" * 50 + "q", "x" * 200, "x" * 60, "hello " * 20 + "abc", "zzz" + "hello " * 15, None, "", "x" * 49, NEAR, "é" + NEAR, NEAR]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_spans", F.lit("old"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.dedup_bytes(df).collect()}
    assert got == brute_bytes(rows)


def test_suffix_dedup_of_whole_texts(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.dedup_bytes(df).collect()}
    assert got == brute_bytes(rows)


def test_wavelet_matrix():
    x = np.random.default_rng(1).integers(0, 300, 5000).astype("<u4")
    w = wavelet.WaveletMatrix(wavelet.build(x, [None, 5], [2000, 3000]))
    assert (w.tokens() == x).all() and all(w.access(i) == x[i] for i in range(0, 5000, 97))
    assert w.occurrences(7) == np.flatnonzero(x == 7).tolist() and w.count(9, 100, 900) == (x[100:900] == 9).sum()
    assert w.rank(7, 100) == (x[:100] == 7).sum() and w.count(1000) == 0
    assert len(wavelet.WaveletMatrix(wavelet.build(x[:0], [], [])).tokens()) == 0


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "lead")])
def test_cached_ids_are_the_tokenizers(name, spaces):
    e = CachedEncoder(tokenizer_path(name), spaces)
    texts = [t or "" for _, t, _ in DOCS] + [" a  b", "It's\ta\x1c b　 c", "a \n b"]
    want = [x.ids for x in e.tok.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == want


def test_token_store_round_trip(docs, spark, tmp_path):
    path = token_store.write_tokens(docs, str(tmp_path / "t"), tokenizer_path("word_bpe_49k.json"), "drop", shard_tokens=50)
    got = token_store.read_digests(spark, path).orderBy("start").collect()
    tok = CachedEncoder(tokenizer_path("word_bpe_49k.json"), "drop").tok
    rows = sorted(DOCS, key=lambda r: -1 if r[0] is None else r[0])
    ids = [np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for _, t, _ in rows]
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in got] == [(sum(map(len, ids[:i])), len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]


def test_packing_plan_is_best_fit_decreasing():
    lengths = np.random.default_rng(2).integers(1, 101, 500).tolist()
    hist = {n: lengths.count(n) for n in set(lengths)}
    places, bins = packing.plan(hist, 100)
    open_bins, want = [], 0
    for n in sorted(lengths, reverse=True):
        fits = [c for c in open_bins if c >= n]
        if fits:
            open_bins.remove(min(fits))
            open_bins.append(min(fits) - n)
        else:
            want += 1
            open_bins.append(100 - n)
    assert bins == want
    fill = {}
    for n, ps in places.items():
        ends = [p[0] for p in ps[1:]] + [hist[n]]
        for (first, b, per, off), end in zip(ps, ends):
            for r in range(first, end):
                fill.setdefault(b + (r - first) // per, []).append((off + (r - first) % per * n, n))
    for parts in fill.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 100


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    x[100:150] = x[:50] + rng.normal(size=(50, 16)) * 0.05
    x[150:160] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0])]
    out, _ = embedding_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {r.vec_id: r.n_links for r in out.collect()}
    u = embedding_dedup.unit(x)
    want = (u @ u.T >= 0.9).sum(1) - 1
    assert sum(got[i] for i in range(300)) >= 0.9 * want.sum() and all(got[i] <= want[i] for i in range(300))
    assert [got[i] for i in (900, 901, 902, 903)] == [0, 0, 0, 0]


def test_embedding_recall_with_the_bands_of_a_large_table(spark, monkeypatch):
    wide = embedding_dedup.band_widths(10_000_000, 64)
    monkeypatch.setattr(embedding_dedup, "band_widths", lambda rows, dim: wide)
    rng = np.random.default_rng(7)
    x = embedding_dedup.unit(rng.normal(size=(400, 64)))
    off = rng.normal(size=x.shape)
    off = embedding_dedup.unit(off - (off * x).sum(1, keepdims=True) * x)
    c = np.linspace(0.9001, 0.92, len(x))[:, None]
    both = np.concatenate((x, c * x + np.sqrt(1 - c * c) * off))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "id long, x array<double>")
    got = {(r.a, r.b) for r in embedding_dedup.near_pairs(df).collect()}
    assert got <= {(i, i + 400) for i in range(400)} and len(got) >= 0.9 * 400


def test_classifier_separates_held_out_texts(spark, sf):
    s = quality_classifier.op5_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    p, n = s[s.quality == 1].score.to_numpy(), s[s.quality == 0].score.to_numpy()
    assert np.mean([(a > n).mean() for a in p]) > 0.8
    assert quality_classifier.fit(np.empty((0, 3)), np.ones((2, 3))) is None


def test_language_model(docs):
    got = pitman_yor.score_documents(docs).collect()
    assert len(got) == len(DOCS) and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4)} == {1}
