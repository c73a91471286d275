"""A SentencePiece vocabulary as arrays that tasks can share.

The driver reads the model file (its path is a parameter) and ships pieces and scores in
the task closures: about 1 MB, bounded by the vocabulary.  The models at hand are merge
lists whose scores are ranks, so unigram log-probabilities follow Zipf's law of the rank:
log p = -log(rank + 1) up to a constant that the sum over all pieces sets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE = "▁"        # stands for a blank at the start of a word


@dataclass(frozen=True)
class Vocabulary:
    """ids, texts and log-probabilities of the pieces words are made of, the ids of the
    256 byte pieces and the bytes that every id decodes to.  No piece holds the blank's
    sign but at its start, so pieces never cross a word."""
    pieces: tuple[str, ...]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    n_ids: int

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids, pieces, ids = np.full(256, -1, dtype=np.int32), [], []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and SPACE not in piece[1:]:
            pieces.append(piece)
            ids.append(i)
    if (byte_ids < 0).any():
        raise ValueError(f"{path}: the vocabulary has no byte pieces, so it cannot encode every text")
    weight = 1.0 / (np.arange(len(pieces)) + 1.0)
    return Vocabulary(tuple(pieces), np.array(ids, dtype=np.int32), np.log(weight / weight.sum()), byte_ids,
                      model.vocab_size())


@lru_cache(maxsize=4)
def unigram(path: str) -> tuple[tuple[str, float], ...]:
    """All entries of the vocabulary in id order with unigram scores: Zipf's law for the
    pieces, and the lowest of those scores for bytes and control entries."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
              for i in range(model.vocab_size())]
    scores = -np.log(np.maximum(np.cumsum(normal), 1))
    lowest = float(scores.min())
    return tuple((model.id_to_piece(i), float(s) if n else lowest) for i, (s, n) in enumerate(zip(scores, normal)))
