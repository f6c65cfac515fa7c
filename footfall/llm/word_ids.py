"""Token ids of whole texts by the tokenizers library, called once for each distinct word."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 4 << 20  # bytes of text encoded at once, about
KNOWN_WORDS = 1 << 18  # words whose ids a worker remembers from one slice to the next, at most
KNOWN_BYTES = 64  # of such a word at most

_LETTERS = "a-zß-öø-ÿ"  # each its own lower case and composed form
_CAPITALS = "À-ÖØ-Þ"

_PLAIN = np.arange(256, dtype=np.uint8)  # A-Z in lower case, tabs and line ends as blanks
_PLAIN[65:91] += 32
_PLAIN[[9, 10, 13]] = 32
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_WORDY = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
_LAST = np.isin(np.arange(256), [x.encode()[1] for x in map(chr, range(0xC0, 0x100)) if x not in "×÷"])  # behind 0xC3: a letter


class Encoder:
    """The tokenizers library, called once for each distinct word.

    Words are cut at blanks, tabs and line ends, which the tokenizer drops and lets no token
    cross, and between a letter or digit and one of ``.,;:!?``, where it always cuts; A-Z are
    lower-cased, as it does first. So a text's ids are those of its words. Words go to the
    library in two texts. Those of Latin letters alone have one end-of-word token each and need
    no more normalising, so they are kept apart by blanks and go to the same model behind a
    split at blanks. The others are kept apart by the end-of-text token, whose id marks the
    cuts. Ids of the KNOWN_WORDS words met first are kept for the next slices.
    """

    BETWEEN = "<|endoftext|>"

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.between = self.tokenizer.token_to_id(self.BETWEEN)
        plain = json.loads(tokenizer)
        plain["normalizer"] = None
        to_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        plain["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, to_bytes]}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = pa.array([], pa.large_string())
        self.known_ids, self.known_sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.int32)

    def _library(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        plain = pc.match_substring_regex(words, f"^[{_LETTERS}{_CAPITALS}]+$").to_numpy(zero_copy_only=False)
        parts, sizes = [], np.zeros(len(words), np.int64)
        if plain.any():
            ids = self._ids(self.plain, " ".join(pc.utf8_lower(words.filter(pa.array(plain))).to_pylist()))
            sizes[plain] = np.diff(np.append(-1, np.flatnonzero(self.closes[ids])))
            parts.append(ids)
        rest = words.filter(pa.array(~plain)).to_pylist()
        if rest:
            # A word may hold the text that marks the cuts.
            odd = {i: self._ids(self.tokenizer, w) for i, w in enumerate(rest) if "<|" in w}
            ids = self._ids(self.tokenizer, self.BETWEEN.join("" if i in odd else w for i, w in enumerate(rest)))
            cuts = np.flatnonzero(ids == self.between)
            size = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            ids = np.delete(ids, cuts)
            if odd:
                ids = np.concatenate([x for i, x in enumerate(np.split(ids, np.cumsum(size)[:-1])) for x in (odd.get(i, x),)])
                size[list(odd)] = [len(x) for x in odd.values()]
            sizes[~plain] = size
            parts.append(ids)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        packed = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return packed[spread(starts, sizes)], sizes

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each word where its ids start and how many they are."""
        at = pc.index_in(words, value_set=self.known)
        fresh = words.filter(at.is_null())
        ids, sizes = self._library(fresh)
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(fresh))
        every, size = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_sizes, sizes])
        start = np.cumsum(size) - size
        room = KNOWN_WORDS - len(self.known)
        if room > 0:
            new = np.flatnonzero(np.asarray(pc.binary_length(fresh)) <= KNOWN_BYTES)[:room]
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(new))])
            new = np.concatenate([np.arange(len(self.known_sizes)), len(self.known_sizes) + new])
            self.known_ids, self.known_sizes = every[spread(start[new], size[new])], size[new]
        return every, start[at], size[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has. A null is empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = _PLAIN[np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]] if data is not None else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        words, each = cut_words(data, bounds)
        coded = words.dictionary_encode()
        ids, starts, sizes = self._words(coded.dictionary)
        row = np.asarray(coded.indices, np.int64)
        count = sizes[row]
        bounds = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(each)])]
        return ids[spread(starts[row], count)], np.diff(bounds)


def cut_words(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts in lower case, given as bytes, and how many each text has: cut at blanks,
    and between a letter or digit and a mark."""
    solid = data != 32
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    marks = np.flatnonzero(_MARK[data])
    before, two = data[np.maximum(marks - 1, 0)], data[np.maximum(marks - 2, 0)]
    first[marks[_WORDY[before] | _LAST[before] & (two == 0xC3)]] = True
    inside = bounds[:-1][bounds[:-1] < len(data)]
    first[inside] = solid[inside]
    starts = np.flatnonzero(first)
    ends = np.append(np.cumsum(solid)[starts] - 1, solid.sum())
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[solid]))
    return words, np.diff(np.searchsorted(starts, bounds))


_ENCODERS: dict[int, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    """One encoder a worker process, whatever the number of its tasks."""
    key = hash(tokenizer)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer)
    return _ENCODERS[key]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
