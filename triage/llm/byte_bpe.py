"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

A text is cut where the tokenizer's own split has a boundary whatever stands
around it: after an ASCII letter before another ASCII character, before a run
of white space after a printable ASCII character, and before the last space of
a run if a printable ASCII character follows. The ids of a chunk between cuts
are kept under its 64-bit hash, so that a frequent chunk is a lookup in a
sorted array; new ones go to the library. A worker process keeps one encoder
for each file. Only files without normalizer whose pre-tokenizer is the
byte-level split are accepted, as only there the cuts hold.

Defined results: null and empty texts have no ids; strings of special tokens
in a text are ordinary text.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from triage.llm import words as W
from triage.llm.token_orc import CACHE_CHARS, Known

#: distinct chunks whose ids a worker keeps
CACHE = 600_000

#: a chunk that the split leaves whole: Latin letters, a space before them or not
WHOLE = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_ASCII_OTHER = ~_LETTER
_ASCII_OTHER[0x80:] = False
_SPACE = ~W.NOT_SPACE
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ascending byte positions at which chunks begin."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n:
        before, here = data[:-1], data[1:]
        cut[1:n] = (_LETTER[before] & _ASCII_OTHER[here]) | (_PRINTED[before] & _SPACE[here])
        last = np.flatnonzero(data[:-1] == 0x20)
        last = last[_PRINTED[data[last + 1]]]
        # the character after the space must be of the same text
        cut[last[~np.isin(last + 1, off)]] = True
    cut[off] = True
    return np.flatnonzero(cut[:n])


class ByteEncoder:
    """Ids of texts by a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path) as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        if made.get("normalizer") or (split.get("type"), split.get("use_regex", True), split.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError(f"{path} is no byte-level tokenizer without normalizer and prefix space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # the library's character for each byte, read from characters that have it in UTF-8
        self.byte_level = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(0x20, 0x7F)}
        for c in range(0xC0, 0x250):
            for b, x in zip(chr(c).encode(), level.pre_tokenize_str(chr(c))[0][0]):
                self.byte_level[b] = x
        self.old, self.new = Known(), Known()

    def chunks(self, texts: list[str]) -> list[list[int]]:
        """The ids of each chunk: by the library's BPE model where its split
        would leave the chunk whole, else by the whole library."""
        out: list = [None] * len(texts)
        rest, model, level = [], self.tokenizer.model, self.byte_level
        for i, x in enumerate(texts):
            if WHOLE(x):
                out[i] = [t.id for t in model.tokenize((x if x.isascii() else x.encode().decode("latin-1")).translate(level))]
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _turn(self) -> None:
        """Few large merges of the new chunks into the kept ones."""
        if len(self.new.keys) * 4 > len(self.old.keys) + 100_000:
            if len(self.old.keys) + len(self.new.keys) > CACHE:
                self.old = Known()
            n, at = self.new.n, self.new.at
            self.old.add(self.new.keys, n, self.new.ids[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            self.new = Known()

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, and their number for each text."""
        data, off = W.texts(col)
        starts = cuts(data, off)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        keys, first, inverse = np.unique(W.hashes(data, starts, ends), return_index=True, return_inverse=True)
        at, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        self._turn()
        base, held, there = [], 0, np.zeros(len(keys), bool)
        for known in (self.old, self.new):
            i, found = known.find(keys)
            at[found], n[found] = known.at[i[found]] + held, known.n[i[found]]
            base.append(known.ids)
            held += len(known.ids)
            there |= found
        todo = np.flatnonzero(~there)
        if len(todo):
            body = data.tobytes()
            spans = zip(starts[first[todo]].tolist(), ends[first[todo]].tolist())
            got = self.chunks([body[s:e].decode() for s, e in spans])
            n[todo] = [len(x) for x in got]
            ids = np.fromiter(chain.from_iterable(got), np.int32, int(n[todo].sum()))
            at[todo] = held + np.cumsum(n[todo]) - n[todo]
            base.append(ids)
            keep = ends[first[todo]] - starts[first[todo]] <= CACHE_CHARS
            self.new.add(keys[todo[keep]], n[todo[keep]], ids[np.repeat(keep, n[todo])])
        chunk_n = n[inverse]
        total = int(chunk_n.sum())
        ids = np.concatenate(base)[np.repeat(at[inverse] - (np.cumsum(chunk_n) - chunk_n), chunk_n) + np.arange(total)]
        return ids, W.per_text(chunk_n, np.searchsorted(starts, off))


@lru_cache(maxsize=4)
def encoder(path: str) -> ByteEncoder:
    """The worker process's encoder of a file."""
    return ByteEncoder(path)
