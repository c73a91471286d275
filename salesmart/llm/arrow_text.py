"""Texts in Arrow batches: bounded slices, words coded as indexes of distinct words, and what
is remembered of words lately met."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text a task works on at a time; the smaller number is for steps whose arrays
#: take many times the text, since a worker keeps that memory for the stages after them
SLICE_BYTES = 4_000_000
SMALL_SLICE_BYTES = 1_000_000


def split_words(texts: pa.Array):
    """Words of texts cut at blanks: dictionary of distinct words, index of every word,
    number of words of each text."""
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``size`` bytes of text; a longer text is a part of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // size
    cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(sizes)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(lo, hi - lo)


def n_bytes(p: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of code points."""
    return 1 + (p >= 0x80) + (p >= 0x800) + (p >= 0x10000)


class Recent:
    """Values of keys lately asked for, in two dicts: when the newer one holds ``size`` keys
    it becomes the older one, whose keys are dropped unless asked for again."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict = {}
        self.old: dict = {}

    def missing(self, keys: list) -> list:
        """Those of the distinct keys that have no value yet; until the next call ``new``
        holds the others, and takes the values of these."""
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    out.append(k)
        return out
