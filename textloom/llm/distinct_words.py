"""The distinct space-separated words of a batch of texts, for encoders that work by word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class BatchWords:
    """Words of a batch: ``words[index[offsets[i]:offsets[i + 1]]]`` are those of text ``i``."""

    offsets: np.ndarray
    index: np.ndarray
    words: list[str]


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets, indices and distinct words, as in :class:`BatchWords`, the words as an Arrow array."""
    pieces = pc.split_pattern(pc.fill_null(texts, ""), " ")
    coded = pieces.flatten().dictionary_encode()
    offsets = pieces.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy(), coded.dictionary


def batch_words(texts: pa.Array) -> BatchWords:
    """Cut texts at every single space; the spaces are not part of the words. Nulls are empty texts."""
    offsets, index, words = coded_words(texts)
    return BatchWords(offsets, index, words.to_pylist())


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[k]:starts[k] + sizes[k]]`` for each ``k`` of ``index``."""
    wanted = sizes[index]
    total = int(wanted.sum())
    begin = np.cumsum(wanted) - wanted
    place = np.arange(total) + np.repeat(starts[index] - begin, wanted)
    return values[place]
