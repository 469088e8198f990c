"""Token ids of whole texts from tokenizer files of the tokenizers library, with a cache of words.

Byte-pair encoders split a text before they merge, and never merge across such a split. Where a text can
be cut without changing the result, its pieces are looked up in a bounded cache and only unseen pieces
are encoded; every other text goes to the tokenizer whole. Both ways give the tokenizer's own ids.

A text is cut to words, and a batch's distinct words of plain letters and signs to runs of one kind: both
tokenizers split between those, and far fewer runs than words are distinct. Other words stay whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from bisect import bisect_left
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in a worker's cache; when full, it loses those that came in one call only.
CACHE_WORDS = 600_000
#: Words that an idle worker's cache keeps.
IDLE_WORDS = 100_000
#: Unseen words that are encoded in one run.
RUN_WORDS = 2_000


#: White space by Unicode, and the separators that some engines count as such; a cut next to any is left out.
RARE_SPACE = tuple("\t\v\f\r\x1c\x1d\x1e\x1f")
WIDE_SPACE = tuple("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_NEXT_TO_BLANK = re.compile(r" \s|\s ")

#: Letters and signs that Unicode's versions, its normal form C and the tokenizers' patterns treat alike, one by one. No
#: apostrophe, as patterns take 's for a run of its own, and no digits, as they differ on runs of those.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = r"!-&(-/:-@\[-`{-~¡¿«»"
_LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = {"drop": rf"\A[{_LETTERS}{_SIGNS}]+\z", "lead": rf"\A(?:[{_LETTERS}{_SIGNS}]+\n?)*[{_LETTERS}{_SIGNS}]\z"}
_SIGN_RUN = {"drop": rf"([{_SIGNS}]+)", "lead": rf"( ?[{_SIGNS}]+|\n)"}


def _odd_blanks(text: str) -> bool:
    """Whether a blank stands at an end of the text or next to other white space."""
    if text[:1].isspace() or text[-1:].isspace() or "  " in text or "\n " in text or " \n" in text:
        return True
    rare = any(c in text for c in RARE_SPACE) or not text.isascii() and any(c in text for c in WIDE_SPACE)
    return rare and _NEXT_TO_BLANK.search(text) is not None


def _splits_runs(spec: dict, spaces: str) -> bool:
    """Whether a tokenizer file splits texts by the patterns that _PLAIN and _SIGN_RUN are made for."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    if spaces == "lead":
        return not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    kinds, parts = [n["type"] for n in norm.get("normalizers", [])], pre.get("pretokenizers", [])
    whole = kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in parts] == ["Split", "ByteLevel"]
    marked = bool(spec["model"].get("end_of_word_suffix"))
    return whole and marked and parts[0]["pattern"] == {"Regex": _LETTER_RUNS} and not parts[1]["add_prefix_space"]


class CachedEncoder:
    """ids of texts, as little-endian unsigned 32-bit integers.

    spaces="drop": the tokenizer discards white space, so a text is cut at every blank and line end.
    spaces="lead": a blank belongs to the word after it, so a text is cut before each blank that stands
    between two characters that are no white space; a text with any other use of blanks is not cut.
    """

    def __init__(self, path: str, spaces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.spaces, self.cuts_runs = spaces, _splits_runs(spec, spaces)
        self.batch = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)  # without offsets, where offered
        vocab = self.tok.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=-1) + 1, bool)  # tokens that begin with a blank, in byte-level letters
        self.opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.closes = np.zeros(len(self.opens), bool)  # tokens that end a run, where the model marks those
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        self.closes[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.line = np.array(self.tok.encode("\n", add_special_tokens=False).ids, "<u4")
        self.by_run = self._by_run(Tokenizer.from_file(path)) if self.cuts_runs else None
        self.cache: dict[str, bytes] = {}  # of words and runs: no run is a word that stays whole
        self.again: set[str] = set()  # those of the cache that a later call asked for

    def _by_run(self, tok):
        """tok's model behind a plain split: runs need no normal form and no pattern any more."""
        from tokenizers import normalizers, pre_tokenizers

        tok.normalizer = normalizers.Sequence([])
        split = pre_tokenizers.CharDelimiterSplit(" " if self.spaces == "drop" else "\n")
        tok.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return getattr(tok, "encode_batch_fast", tok.encode_batch)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _cuttable(self, text: str) -> bool:
        """Whether the ids of the text's words, one after another, are its ids."""
        return not any(s in text for s in self.special) and (self.spaces == "drop" or not _odd_blanks(text))

    def _words(self, words: list[str]) -> list[bytes]:
        """ids of unseen words (in "lead" each after a blank), encoded many at a time and dealt by their ends."""
        out = []
        for i in range(0, len(words), RUN_WORDS):
            part = words[i : i + RUN_WORDS]
            run, cuts = " " + " ".join(part), None
            if self.spaces == "lead":  # where the blanks alone open a token, those tokens are the words' first ones
                ids = np.array(self.batch([run], add_special_tokens=False)[0].ids, "<u4")
                first = np.flatnonzero(self.opens[ids])
                if len(first) == len(part) and first[0] == 0:
                    cuts = np.append(first[1:], len(ids)) * 4
            if cuts is None:
                e = self.tok.encode(run, add_special_tokens=False)
                ids = np.array(e.ids, "<u4")
                ends = np.fromiter((x for _, x in e.offsets), np.int64, len(ids))
                edges = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
                cuts = np.searchsorted(ends, edges, side="right") * 4
            raw, last = ids.tobytes(), 0
            for c in cuts.tolist():
                out.append(raw[last:c])
                last = c
        return out

    def _runs(self, runs: list[str]) -> list[bytes]:
        """ids of unseen runs of plain letters or signs (in "lead" with the blank before them, if any)."""
        if self.spaces == "drop":
            return self._dealt(runs, self.by_run, " ", lambda ids: np.flatnonzero(self.closes[ids]) + 1)
        ids = {"\n": self.line.tobytes()}
        first, inner = [r for r in runs if r[0] == " "], [r for r in runs if r[0] not in " \n"]
        starts = lambda ids: np.append(np.flatnonzero(self.opens[ids])[1:], len(ids))
        lines = lambda ids: np.append(np.flatnonzero(ids == self.line[0]), len(ids))
        ids.update(zip(first, self._dealt(first, self.by_run, "\n", starts), strict=True))
        ids.update(zip(inner, self._dealt(inner, self.batch, "\n", lines, 1), strict=True))
        return [ids[r] for r in runs]

    def _dealt(self, runs: list[str], batch, sep: str, ends, skip: int = 0) -> list[bytes]:
        """ids of runs, encoded many at a time and dealt where ends(ids) says; skip ids after each end are no run's."""
        out = []
        for i in range(0, len(runs), RUN_WORDS):
            part = runs[i : i + RUN_WORDS]
            ids = np.array(batch([sep.join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = ends(ids)
            if len(cuts) != len(part) or cuts[-1] != len(ids):  # not told apart: one by one
                out.extend(self._whole(part))
                continue
            raw, last = ids.tobytes(), 0
            for c in (cuts * 4).tolist():
                out.append(raw[last:c])
                last = c + 4 * skip
        return out

    def shrink(self) -> None:
        """Keep IDLE_WORDS words at most, of those that came again: a worker lives on between tasks."""
        if len(self.cache) > IDLE_WORDS:
            self.cache = {w: self.cache[w] for w in islice(filter(self.cache.__contains__, self.again), IDLE_WORDS)}
            self.again = set(self.cache)

    def encode(self, texts: list[str]) -> list[bytes]:
        lead, out = self.spaces == "lead", [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self._cuttable(t)]
        if whole:
            for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
                out[i] = ids
        skip = set(whole)
        cut = [i for i in range(len(texts)) if i not in skip]
        if not cut:
            return out
        if lead:  # the first word has no blank before it
            heads = self._whole([texts[i].split(" ", 1)[0] for i in cut])
            tails = [texts[i].partition(" ")[2] for i in cut]
        else:
            tails = [texts[i].replace("\n", " ") for i in cut]
        lists = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        coded = pc.dictionary_encode(lists.flatten())
        words = coded.dictionary
        plain = pc.match_substring_regex(words, _PLAIN[self.spaces] if self.cuts_runs else r"[^\x00-\x{10FFFF}]")
        runs = words.filter(plain)
        blank, no = pa.scalar(" ", runs.type), pa.scalar("", runs.type)
        runs = pc.binary_join_element_wise(blank, runs, no) if lead else pc.utf8_lower(runs)
        runs = pc.split_pattern(pc.replace_substring_regex(runs, _SIGN_RUN[self.spaces], "\0\\1\0"), "\0")
        parts = pc.dictionary_encode(runs.flatten())
        keys, other = _strings(parts.dictionary, "\0"), _strings(words.filter(pc.invert(plain)), " ")
        found = self._cached(keys + other, len(keys))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        # the plain words by their runs, then the others, each as it is
        flat, at = _spread(flat, starts, sizes, np.concatenate((parts.indices.to_numpy(), np.arange(len(keys), len(found)))))
        last = len(parts)
        at = at[np.concatenate((runs.offsets.to_numpy(), np.arange(last + 1, last + len(other) + 1)))]
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(is_plain, np.cumsum(is_plain) - 1, len(runs) + np.cumsum(~is_plain) - 1)
        ends = lists.offsets.to_numpy()
        flat, at = _spread(flat, at[:-1], np.diff(at), place[coded.indices.to_numpy()])
        raw = flat.tobytes()
        edges = (at[ends] * 4).tolist()
        for j, i in enumerate(cut):
            body = raw[edges[j] : edges[j + 1]]
            out[i] = heads[j] + body if lead else body
        return out

    def _cached(self, used: list[str], runs: int) -> list[bytes]:
        """ids of distinct runs (the first ones of used) and words, those not in the cache encoded."""
        found = list(map(self.cache.get, used))
        at = [i for i, (w, x) in enumerate(zip(used, found)) if x is None and w]
        self.again.update(compress(used, found))
        if at:
            cut = bisect_left(at, runs)
            new = [used[i] for i in at]
            if len(self.cache) + len(new) > CACHE_WORDS:  # words that came again stay, or those of these texts alone
                if len(self.again) + len(new) > CACHE_WORDS * 3 // 4:
                    self.again = set(compress(used, found))
                self.cache = {w: self.cache[w] for w in self.again if w in self.cache}
            ids = self._runs(new[:cut]) + self._words(new[cut:])
            self.cache.update(zip(new, ids, strict=True))
            for i, x in zip(at, ids, strict=True):
                found[i] = x
        return [x or b"" for x in found]


def _strings(values: pa.Array, sep: str) -> list[str]:
    """The strings of an array, none of which holds sep."""
    if not len(values):
        return []
    whole = pa.ListArray.from_arrays([0, len(values)], values)
    return pc.binary_join(whole, pa.scalar(sep, values.type))[0].as_py().split(sep)


def _spread(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values named by code, one after another, where each is a stretch of flat; and their ends, from 0."""
    n = sizes[code]
    at = np.concatenate(([0], np.cumsum(n)))
    where = np.repeat(starts[code] - at[:-1], n)
    where += np.arange(at[-1])
    return flat.take(where), at


@functools.cache
def encoder(path: str, spaces: str) -> CachedEncoder:
    """One per Python worker, kept across tasks."""
    return CachedEncoder(path, spaces)


def slices(batch, size: int = 3_000_000):
    """(start, batch) parts of an Arrow batch with a text column, of about size bytes of text each."""
    n = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)).astype(np.int64)
    part = np.cumsum(n) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(n)] if len(n) else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def gathered(it, size: int = 7_000_000):
    """Tables of an iterator's Arrow batches with a text column, joined or cut to at most about size bytes of text each.

    A word's look-up is paid once for each table that holds it.
    """
    held, n = [], 0
    for b in (x for whole in it for x in slices(whole, size)):
        more = pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
        if held and n + more > size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        held.append(b)
        n += more
    if held:
        yield pa.Table.from_batches(held)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file called name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
