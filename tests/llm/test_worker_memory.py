"""What an idle Python worker keeps: no hashes of words, a bounded cache of encoded ones."""

import numpy as np
import pyarrow as pa

from ribospark.llm import jaccard_join, tokens


def test_no_hashes_stay_after_a_partition():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b c d e f", None]})
    out = list(jaccard_join._sets(5)(iter([batch])))
    assert out[0].column("n").to_pylist() == [2, 0]
    assert not jaccard_join._hashes


def test_cache_of_an_idle_encoder_is_bounded():
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    enc = tokens.CachedEncoder(path, "lead")
    texts = [" ".join(f"{a}w{i}" for i in range(60_000)) for a in "xy"] + ["xĠ Ġy z", "x1 é \U00020000 's", "xw1 yw2. new"]
    whole = [np.array(e.ids, "<u4").tobytes() for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == whole
    assert len(enc.cache) > tokens.IDLE_WORDS
    enc.encode(texts[:1])
    enc.shrink()
    assert 59_000 < len(enc.cache) <= tokens.IDLE_WORDS
    assert enc.encode(texts) == whole
