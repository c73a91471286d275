"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton of the vocabulary lists every piece that occurs in the distinct
words of a slice of texts in one pass; dynamic programming over the places of each word
then carries the best score and the number of pieces of the best path, and nothing else.
The tokenizer's rules are kept exactly: scores are summed in 64-bit floats from the left,
a later path replaces an earlier one only if it is strictly better (so of equal paths the
one whose last piece begins first stays), a character without a piece of its own costs the
lowest score less UNKNOWN_PENALTY, and such characters count one token for each byte.
Words begin at blanks; the blank belongs to the word, and a text that begins without one
gets one.  A literal U+2581 is a blank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from salesmart.llm.arrow_text import n_bytes, slices, split_words
from salesmart.llm.common import free_name, schema_with, text_of
from salesmart.llm.vocabulary import SPACE, unigram

UNKNOWN_PENALTY = 10.0
#: words whose counts a task remembers (longer than a slice's words only if one slice has more)
CACHED_WORDS = 400_000


def counter(vocabulary: tuple[tuple[str, float], ...]) -> Callable[[pa.Array], np.ndarray]:
    """A function of texts to their numbers of tokens."""
    import ahocorasick
    entries = [(p, s) for p, s in vocabulary if p and SPACE not in p[1:]]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, (piece, _) in enumerate(entries):
        automaton.add_word(piece, i)
    automaton.make_automaton()
    size = np.array([len(p) for p, _ in entries])
    score = np.array([s for _, s in entries])
    unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
    known: dict[str, int] = {}

    def per_word(words: list[str]) -> np.ndarray:
        """Tokens of each word (which begins with the blank's sign).  No piece holds that
        sign later than at its start, so no match crosses the words of the joined text."""
        joined = "".join(words)
        n = len(joined)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        found = np.fromiter(chain.from_iterable(automaton.iter(joined)), dtype=np.int64).reshape(-1, 2)
        end, item = found[:, 0], found[:, 1]
        single = np.zeros(n, dtype=bool)
        single[end[size[item] == 1]] = True
        rest = np.flatnonzero(~single)
        begin = np.concatenate([end - size[item] + 1, rest])
        cost = np.concatenate([score[item], np.full(len(rest), unknown)])
        tokens = np.concatenate([np.ones(len(item), dtype=np.int64), n_bytes(points[rest])])
        end = np.concatenate([end, rest])
        # all words advance together: places are ranked by their offset in the word
        offset = np.arange(n) - np.repeat(starts, lengths)
        rank = np.empty(n, dtype=np.int64)
        rank[np.argsort(offset, kind="stable")] = np.arange(n)
        # stable: matches come by end, longest first, so edges of a place by begin
        order = np.argsort(rank[end], kind="stable")
        begin, cost, tokens, at = begin[order], cost[order], tokens[order], rank[end[order]]
        degree = np.bincount(at, minlength=n)
        first = np.cumsum(degree) - degree
        bound = np.append(first, len(at))
        best, count = np.zeros(n), np.zeros(n, dtype=np.int64)
        step = np.r_[0, np.cumsum(np.bincount(offset))]
        for k, (lo, hi) in enumerate(zip(step[:-1], step[1:])):
            a, b = bound[lo], bound[hi]
            total, number = cost[a:b].copy(), tokens[a:b].copy()
            if k:
                inner = np.flatnonzero(offset[begin[a:b]] > 0)
                before = rank[begin[a:b][inner] - 1]
                total[inner] += best[before]
                number[inner] += count[before]
            f = first[lo:hi] - a
            top = np.maximum.reduceat(total, f)
            is_top = np.flatnonzero(total == np.repeat(top, degree[lo:hi]))
            pick = is_top[np.searchsorted(is_top, f)]    # the first best edge of each place
            best[lo:hi], count[lo:hi] = top, number[pick]
        return count[rank[starts + lengths - 1]]

    def count(texts: pa.Array) -> np.ndarray:
        texts = pc.replace_substring(texts, SPACE, " ")
        dictionary, index, numbers = split_words(texts)
        words = dictionary.to_pylist()
        new = [w for w in words if w not in known]
        if new:
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
                new = words
            known.update(zip(new, per_word([SPACE + w for w in new]).tolist()))
        of_word = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))[index]
        first = np.cumsum(numbers) - numbers
        # a text that begins with a blank gets no further one; an empty text has no token
        of_word[first[pc.starts_with(texts, " ").to_numpy(zero_copy_only=False)]] = 0
        of_word[first[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)]] = 0
        return np.add.reduceat(np.append(of_word, 0), first) if len(first) else first
    return count


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None,
                 out_col: str = "n_tokens") -> DataFrame:
    """``keep`` columns (all but the text, unless given) with the number of tokens of each
    text.  A null text counts as empty and has 0 tokens; rows are counted one by one, so
    repeated ones get equal counts.  An input column named as the output is left out.  An
    empty table gives an empty result."""
    vocabulary = unigram(model_path)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text_col, out_col)]
    text_name = free_name(keep, "_text")
    rows = docs.select(*keep, text_of(text_col).alias(text_name))
    schema = schema_with(rows.select(*keep), f"`{out_col}` long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, text_name):
                numbers = pa.array(count(part.column(text_name)), pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], numbers], names=schema.names)
    return rows.mapInArrow(run, schema)
