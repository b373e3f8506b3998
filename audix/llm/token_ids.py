"""Token ids of whole text columns, shared by the id-file and packing operators.

Texts are cut where a tokenizer can't join anything, the distinct cuts of a
slice are found in compiled code, and only cuts this worker has not met are
encoded: those of ASCII and Latin-1 letters alone, which the normalizer at most
turns into small ones and the split pattern leaves as one piece, by the
tokenizer's model, all others by the whole tokenizer. The result equals encoding
each whole text.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from audix.llm.batches import CACHES

# Words a worker remembers; later words are encoded each time they occur.
CACHE_WORDS = 400_000

# ASCII white space: dropped by the word tokenizer, and never inside one of its
# tokens, special tokens or composed characters.
_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
# Kinds of bytes: a mask of what a byte is.
_INSIDE, _ALNUM, _SIGN, _QUOTE, _LEAD, _NO_LETTER, _FOLLOWS = (np.uint8(1 << k) for k in range(7))
_KINDS = np.zeros(256, np.uint8)
_KINDS[[b for b in range(256) if b not in _SPACE]] |= _INSIDE
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123)]] |= _ALNUM
_KINDS[33:127] |= np.where(_KINDS[33:127] & _ALNUM, 0, _SIGN).astype(np.uint8)
_KINDS[0x27] |= _QUOTE
_KINDS[0xC3] |= _LEAD
_KINDS[[0x97, 0xB7]] |= _NO_LETTER
_KINDS[0x80:] |= _FOLLOWS
_KINDS = _KINDS.tobytes()

# UTF-8 of letters with a small form of one code point, and the sign that the
# byte-level step of the tokenizer writes for each byte.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SIGNS = [chr(b if b in _PRINTED else 256 + b - sum(c < b for c in _PRINTED)) for b in range(256)]


class WordEncoder:
    """ids of texts by a tokenizer file, add_special_tokens=False."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.seen: dict[bytes, bytes] = {}

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Cuts of the texts (never across texts) and their number per text: runs
        without white space, with ASCII letters in lower case as the tokenizer
        has them, and cut again where letters and ASCII signs meet, as the split
        pattern does. A slice that may hold a special token is only cut at
        white space and keeps its case."""
        raw = data.tobytes()
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        inside = (kinds & _INSIDE).view(bool)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        if b"<|" not in raw:
            data = np.frombuffer(raw.translate(_LOWER), np.uint8)
            before, after = kinds[:-1], kinds[1:]
            letter = (kinds & _ALNUM).astype(bool)
            letter[1:] |= ((before & _LEAD) != 0) & ((after & (_FOLLOWS | _NO_LETTER)) == _FOLLOWS)
            first[1:] |= ((after & _SIGN) != 0) & letter[:-1]
            first[1:] |= ((after & _ALNUM) != 0) & ((before & (_SIGN | _QUOTE)) == _SIGN)
        heads = offsets[:-1][offsets[:-1] < len(data)]
        first[heads] = inside[heads]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        tails = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        last[tails] = inside[tails]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        size = end - start
        packed = data[inside]           # the cuts hold all that is not white space
        bound = np.zeros(len(start) + 1, np.int64)
        np.cumsum(size, out=bound[1:])
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(bound), pa.py_buffer(packed)])
        return column, np.diff(np.searchsorted(start, offsets))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids back to back, ids per text) of the texts of a slice."""
        column, per_text = self.words(data, offsets)
        if len(column) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        coded = column.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.seen.get, words))
        new = [i for i, k in enumerate(known) if k is None]
        rest = []
        for i in new:
            word = words[i]
            if word.isalpha():
                signs = word.decode().lower()
            elif _LETTERS.fullmatch(word):
                signs = "".join([_SIGNS[b] for b in word.decode().lower().encode()])
            else:
                rest.append(i)
                continue
            known[i] = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        for at in range(0, len(rest), 20_000):
            part = rest[at:at + 20_000]
            found = self.tokenizer.encode_batch_fast([words[i].decode() for i in part], add_special_tokens=False)
            for i, e in zip(part, found):
                known[i] = array("I", e.ids).tobytes()
        for i in new[:CACHE_WORDS - len(self.seen)]:
            if len(words[i]) <= 64:
                self.seen[words[i]] = known[i]
        met = pa.array(known, pa.large_binary()).take(coded.indices)
        _, bound, ids = met.buffers()
        total = np.frombuffer(bound, np.int64)[:len(met) + 1] >> 2
        ids = np.frombuffer(ids, np.uint32)[:total[-1]] if total[-1] else np.zeros(0, np.uint32)
        return ids, np.diff(total[np.concatenate(([0], np.cumsum(per_text)))])


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    return WordEncoder(path)


CACHES.append(word_encoder)


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after every text's ids."""
    out = np.full(len(ids) + len(sizes), end, np.uint32)
    after = np.cumsum(sizes + 1)
    mask = np.ones(len(out), bool)
    mask[after - 1] = False
    out[mask] = ids
    return out, sizes + 1
