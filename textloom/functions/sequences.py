"""Expressions on arrays of token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.config import EOS_ID, PAD_ID


def pad_truncate(ids: Column, length: int, pad_id: int = PAD_ID) -> Column:
    """Exactly ``length`` ids: cut on the right, or filled up with ``pad_id``."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad_id), length)), 1, length)


def inputs(ids: Column) -> Column:
    """All ids but the last."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def targets(ids: Column) -> Column:
    """All ids but the first: what follows each input."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def valid_mask(ids: Column, pad_id: int = PAD_ID) -> Column:
    """True at each position that is not padding."""
    return F.transform(ids, lambda i: i != pad_id)


def valid_length(ids: Column, pad_id: int = PAD_ID) -> Column:
    """Number of positions that are not padding."""
    return F.size(F.array_remove(ids, pad_id))


def finish_sequence(prompt: Column, generated: Column, length: int,
                    eos_id: int = EOS_ID, pad_id: int = PAD_ID) -> Column:
    """Prompt and generated ids as one row of ``length``.

    The first end marker and all that follows it become padding. At most
    ``length - size(prompt) - 1`` generated ids count. The prompt is not changed,
    also when it is longer than ``length``.
    """
    room = F.greatest(F.lit(length) - F.size(prompt), F.lit(0))
    end = F.array_position(generated, F.lit(eos_id)).cast("int")
    kept = F.when(end > 0, F.slice(generated, F.lit(1), F.greatest(end - 1, F.lit(0)))).otherwise(generated)
    kept = F.slice(kept, F.lit(1), F.greatest(room - 1, F.lit(0)))
    filled = F.concat(kept, F.array_repeat(F.lit(pad_id), length))
    return F.concat(prompt, F.slice(filled, F.lit(1), room))
