"""Words of op9's blocks: cut wherever no piece goes on, and numbered so that words that come once cost nothing."""

import numpy as np

from ribospark.llm import sentencepiece_lattice as sl
from ribospark.llm.tokens import tokenizer_path


def test_words_end_where_no_piece_goes_on(spark):
    pieces, _, _ = sl.piece_table(spark, tokenizer_path("piece_bpe_32k.model"))
    cutter = sl.Cutter(sl.piece_pairs(pieces))
    texts = ["river.\nStone, river! river", None, "", "中\U0001f600é  x", "\nriver."]
    words, n = cutter.words(texts)
    found = [w.decode() for w in words.to_pylist()]
    assert n.tolist() == [sum(1 for _ in found[:n[0]]), 0, 0, n[3], n[4]] and n.sum() == len(found)
    assert "".join(found) == "".join("▁" + t.replace(" ", "▁") for t in texts if t)
    assert found[:4] == ["▁river", ".", "\n", "Stone"]
    assert found.count("▁river") == 3  # not "river.\nStone,", "river!" and "river"
    assert cutter.words([None])[1].tolist() == [0] and len(cutter.words([])[0]) == 0


def test_numbers_come_back():
    rng = np.random.default_rng(4)
    for size in (0, 1, 50, 3000):
        first = np.unique(rng.zipf(1.3, size) % 5000, return_inverse=True)[1].astype(np.int32)
        seen = dict.fromkeys(first.tolist())
        place = {k: i for i, k in enumerate(seen)}
        codes = np.array([place[c] for c in first.tolist()], np.int32)
        packed, order = sl.number(codes, len(seen))
        assert np.array_equal(order[sl.numbers(packed, len(seen))], codes)
