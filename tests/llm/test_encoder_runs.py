"""The cached encoder cuts words to runs of letters and of signs and still gives the tokenizer's own ids."""

import random

import numpy as np
import pytest

from ribospark.llm import tokens

KINDS = [("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "lead")]


@pytest.mark.parametrize(("name", "spaces"), KINDS)
def test_words_of_the_same_runs_are_encoded_once(name, spaces):
    enc = tokens.CachedEncoder(tokens.tokenizer_path(name), spaces)
    runs = ["stone", "Été", "niño", "river", "ß"]
    texts = [" ".join(f"{a}{s}{b}" for a in runs for b in runs) for s in (".", "...", "!?", "»", "&&&", "-")]
    assert enc.encode(texts) == [np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert len(enc.cache) <= 2 * len(runs) + 6  # 150 words


@pytest.mark.parametrize(("name", "spaces"), KINDS)
def test_odd_texts_have_the_tokenizers_ids(name, spaces):
    enc, rng = tokens.CachedEncoder(tokens.tokenizer_path(name), spaces), random.Random(3)
    signs = [*"ab Z.,'!-éÈ\n 12ß¡«»_^`~<|>[]{}\\/&#µª²\0", "'s", "́", " ", "Ġ", "中", "İ", "ǅ", "\U00020000", "<|endoftext|>"]
    texts = ["", "a", ".", "1", "a b", "a .", "a\nb", "a b\n\nc", "a b\n\n\nc", "a 1", "a 'b", "a b\n. c"]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(2000)]
    whole = [np.array(e.ids, "<u4").tobytes() for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert [x for t in texts[:300] for x in enc.encode([t])] == whole[:300]
    assert enc.encode(texts) == whole
