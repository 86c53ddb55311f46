"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass

# The marker tokens, in id order (0, 1, 2, 3).
UNK_TOKEN = "[UNK]"
PAD_TOKEN = "[PAD]"
SOS_TOKEN = "[SOS]"
EOS_TOKEN = "[EOS]"
SPECIAL_TOKENS = (UNK_TOKEN, PAD_TOKEN, SOS_TOKEN, EOS_TOKEN)
UNK_ID, PAD_ID, SOS_ID, EOS_ID = range(4)


@dataclass(frozen=True)
class CorpusConfig:
    """Corpus preparation.

    The length range leaves room for two markers inside ``max_length`` ids.
    """

    min_chars: int = 62
    max_chars: int = 126
    max_length: int = 128
    histogram_bins: int = 20
    batch_rows: int = 10_000
    shard_rows: int = 1_000_000
    seed: int = 42
    train_ratio: float = 0.8
    test_ratio: float = 0.2


@dataclass(frozen=True)
class VocabularyConfig:
    """Vocabulary learning.

    ``ranked_pairs`` bounds the pair ranking held by the driver, and ``merges_per_index`` the
    merges that wait until the index of words is written anew; any values give the same merges.
    """

    vocab_size: int = 32_000
    min_frequency: int = 0
    ranked_pairs: int = 1_024
    merges_per_index: int = 1_000


@dataclass(frozen=True)
class FeedConfig:
    """Training-data feeding."""

    batch_size: int = 28
    epochs: int = 50
