import itertools
import time

import numpy as np
import sentencepiece

from ribospark.llm import sentencepiece_lattice as sl
from ribospark.llm.tokens import tokenizer_path


def test_ids_and_texts_are_the_models(spark, sf):
    model = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rng = np.random.default_rng(3)
    run = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé中文"), 20_000))
    texts += ["Hello  world\n\té 中文 \U0001f600x ", "", None, "aaaaaaa  ", " lead", "▁mark", "a" * 700, run, texts[0], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    enc = sl.encode_documents(df.selectExpr("doc_id", "text", "'x' AS ids", "1 AS rng"), model).cache()
    got = {r.doc_id: list(r.ids) for r in enc.collect()}
    assert time.monotonic() - began < 60  # the text without blanks too
    assert got == {i: sp.encode(t or "", num_threads=1) for i, t in enumerate(texts)}
    back = {r.doc_id: r.text for r in sl.decode_documents(enc, model).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}


def test_empty_table_and_null_ids(spark):
    model = tokenizer_path("piece_bpe_32k.model")
    assert sl.encode_documents(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []
    rows = spark.createDataFrame([(None, "one"), (None, "one"), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, len(r.ids)) for r in sl.encode_documents(rows, model).collect())
    assert got[2] == (3, 0) and got[0] == got[1] and got[0][1] > 0


def best_paths(word, scores, unknown):
    """All segmentations of a word with the greatest total score."""
    found = {}
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in scores or len(p) == 1 for p in parts):
            found.setdefault(round(sum(scores.get(p, unknown) for p in parts), 9), []).append(parts)
    return found[max(found)]


def test_viterbi_against_all_paths(spark):
    rng = np.random.default_rng(11)
    pieces = sorted({"".join(rng.choice(list("abc▁"), int(n))) for n in rng.integers(1, 5, 60)} - {"b"})
    scores = {p: -float(s) for p, s in zip(pieces, rng.uniform(1, 9, len(pieces)))}
    words = ["▁" + "".join(rng.choice(list("abc"), int(n))) for n in rng.integers(0, 11, 60)]
    table = spark.createDataFrame([(p, i, scores[p]) for i, p in enumerate(pieces)], "piece string, id int, score double")
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "wid long, word string")
    longest = max(map(len, pieces))
    got = {r.wid: [(p.a, p.l) for p in r.path] for r in sl.viterbi(sl.lattice(df, table, longest), longest, -20.0).collect()}
    for i, w in enumerate(words):
        assert [w[a : a + n] for a, n in got[i]] in best_paths(w, scores, -20.0)


def test_unigram_dictionary(spark):
    pieces = spark.createDataFrame([("▁", 1, -2.0), ("▁ab", 2, -1.0), ("a", 3, -3.0), ("b", 4, -3.0), ("ba", 5, -1.5)], "piece string, id int, score double")
    words = spark.createDataFrame([(0, 0, "▁abba"), (0, 1, "▁é"), (0, 2, "▁")], "rng int, wid long, word string")
    found, ids = sl.unpack_words([bytes(r.blob) for r in sl.dictionary(words, pieces, 3, 100, False).collect()])
    got = {w.decode(): np.frombuffer(i, "<i4").tolist() for w, i in zip(found.to_pylist(), ids.to_pylist())}
    assert got == {"abba": [2, 5], "é": [1, 100 + 0xC3, 100 + 0xA9], "": [1]}
