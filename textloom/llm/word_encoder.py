"""Ids of whole texts by a byte-level BPE tokenizer, from the ids of their words.

A single space between two other characters that are not white space always begins
a word of the tokenizer's own, so words are encoded once and their ids put
together. Texts with other white space around a space, or with the name of a special
token, go to the tokenizer whole.

Most words are made of runs of letters, digits and signs. Where the tokenizer cuts texts by the usual
byte-level pattern, each such run is one of its own words: it goes to the tokenizer's
model without another pass of the pattern. Other words go through the whole tokenizer.
"""

from __future__ import annotations

import itertools
import json
import operator
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textloom.llm.distinct_words import coded_words, gather

#: Memory for the ids a worker keeps, as estimated for each entry; a longer word is encoded each time.
KEPT_BYTES = 64_000_000
ENTRY_BYTES = 240
LONGEST_KEPT = 100
# What the tokenizer's pattern takes for white space.
WHITE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WHITE_RE2 = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"     # the same

# Letters, digits and signs of which all versions of Unicode say the same; no apostrophe, which may begin a suffix.
_KINDS = (r"[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+", "[0-9]+", r"[!-&(-/:-@\[-`{-~]+")
_RUN = "|".join([*(f" ?{kind}" for kind in _KINDS), "\n"])
_ID = operator.attrgetter("id")
_MARK = "\x1f"             # between the runs of a word; texts that hold it are odd


def byte_characters() -> str:
    """The character that stands for each byte in the entries of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


def vocabulary_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer file; none for ids of special tokens."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    out = [b""] * (max(model["vocab"].values()) + 1)
    for entry, k in model["vocab"].items():
        if all(c in byte_of for c in entry):
            out[k] = bytes(byte_of[c] for c in entry)
    return out


class WordEncoder:
    """Keeps the ids of runs and words met before, bounded in bytes. ``names_are_text``: names of special tokens are ordinary text."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES, names_are_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_are_text
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join(["^$", f"^[{WHITE_RE2}]", f"[{WHITE_RE2}]$", _MARK, *([] if names_are_text else names)])
        self.merge = self.tokenizer.model.tokenize if self._cuts_by_runs(path) else None
        self.characters = byte_characters()
        self.kept_bytes = kept_bytes
        self._forget()

    @staticmethod
    def _cuts_by_runs(path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        return (cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
                and spec.get("normalizer") is None and model.get("type", "BPE") == "BPE" and not model.get("ignore_merges")
                and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout")))

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.values = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.again = np.zeros(0, dtype=bool)

    def _forget_rare(self) -> None:
        """Runs met in one call only go; all go if the others are more than half."""
        met = np.flatnonzero(self.again)
        if 2 * len(met) > len(self.number):
            return self._forget()
        kept = list(itertools.compress(self.number, self.again.tolist()))      # in the order of their numbers
        self.number = dict(zip(kept, range(len(kept))))
        self.values = gather(self.values, self.starts, self.sizes, met)
        self.sizes = self.sizes[met]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.again = np.zeros(len(kept), dtype=bool)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of texts, by the tokenizer."""
        sizes, ids = [], []
        for at in range(0, len(texts), 20_000):
            for e in self.tokenizer.encode_batch_fast(texts[at:at + 20_000], add_special_tokens=False):
                own = e.ids
                sizes.append(len(own))
                ids += own
        return np.array(ids, dtype=np.uint32), np.array(sizes, dtype=np.int64)

    def _fresh(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of runs and words, with the space before them if there is one."""
        if self.merge is None or not runs:
            return self.whole(runs)
        single = pc.match_substring_regex(pa.array(runs, pa.string()), f"^(?:{_RUN})$").to_numpy(zero_copy_only=False)
        merge, space, characters = self.merge, self.characters[32], self.characters
        plain = [(space + r[1:] if r[0] == " " else r) if r.isascii() and r != "\n" else r.encode().decode("latin-1").translate(characters)
                 for r in itertools.compress(runs, single)]
        parts, counts = [], []
        for at in range(0, len(plain), 20_000):
            found = list(map(merge, plain[at:at + 20_000]))
            counts += map(len, found)
            parts.append(np.fromiter(map(_ID, itertools.chain.from_iterable(found)), np.uint32, sum(counts[at:])))
        values = np.concatenate([np.zeros(0, dtype=np.uint32), *parts])
        sizes = np.zeros(len(runs), dtype=np.int64)
        sizes[single] = counts
        if single.all():
            return values, sizes
        more, sizes[~single] = self.whole(list(itertools.compress(runs, ~single)))
        out = np.zeros(len(values) + len(more), dtype=np.uint32)
        of_single = np.repeat(single, sizes)
        out[of_single], out[~of_single] = values, more
        return out, sizes

    def word_ids(self, words: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, with ``before`` (a space, or nothing) in front of each, and their numbers."""
        if not len(words):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        marked = pc.binary_join_element_wise(before, words, "")
        if self.merge is not None:
            single = pc.match_substring_regex(marked, f"^(?:{_RUN})$")
            several = pc.if_else(single, None, marked)       # one run is as it is; cutting costs more than telling
            plain = pc.and_(pc.match_substring_regex(several, f"^(?:{_RUN})+$"), pc.invert(pc.match_substring(several, "\n\n\n")))
            several = pc.if_else(plain, several, None)
            cut = pc.utf8_rtrim(pc.replace_substring_regex(several, f"({_RUN})", rf"\1{_MARK}"), _MARK)
            marked = pc.coalesce(cut, marked)
        lists = pc.split_pattern(marked, _MARK)
        coded = lists.flatten().dictionary_encode()
        runs = coded.dictionary.to_numpy(zero_copy_only=False).tolist()      # several times as fast as to_pylist
        if len(self.number) * ENTRY_BYTES > self.kept_bytes:
            self._forget_rare()
        get = self.number.get
        numbers = np.fromiter((get(r, -1) for r in runs), np.int64, len(runs))
        self.again[numbers[numbers >= 0]] = True
        missing = np.flatnonzero(numbers < 0).tolist()
        missing.sort(key=lambda k: len(runs[k]) > LONGEST_KEPT)      # the long ones last: they are not kept
        new = [runs[k] for k in missing]
        ids, sizes = self._fresh(new)
        first, n_kept = len(self.number), sum(len(r) <= LONGEST_KEPT for r in new)
        numbers[missing] = np.arange(first, first + len(new))
        starts = np.concatenate([self.starts, len(self.values) + np.cumsum(sizes) - sizes])
        sizes = np.concatenate([self.sizes, sizes])
        values = np.concatenate([self.values, ids])
        self.number.update(zip(new[:n_kept], range(first, first + n_kept)))
        self.starts, self.sizes = starts[:first + n_kept], sizes[:first + n_kept]
        self.values = values[:int(self.sizes.sum())]
        self.again = np.concatenate([self.again, np.zeros(n_kept, dtype=bool)])

        of_runs = numbers[coded.indices.to_numpy()]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        return gather(values, starts, sizes, of_runs), np.add.reduceat(sizes[of_runs], offsets[:-1] - offsets[0])

    def odd_words(self, words: pa.Array) -> np.ndarray:
        """Which words make their text one for the whole tokenizer."""
        return pc.match_substring_regex(words, self.odd).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text. Nulls are empty texts."""
        n = len(texts)
        if not n:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        offsets, index, words = coded_words(texts)
        at = offsets[:-1]
        ids, sizes = self.word_ids(words, " ")
        # The first word of a text has no space before it.
        firsts = words.take(pa.array(index[at])).dictionary_encode()
        first_ids, first_sizes = self.word_ids(firsts.dictionary, "")
        values, sizes = np.concatenate([ids, first_ids]), np.concatenate([sizes, first_sizes])
        starts = np.cumsum(sizes) - sizes
        odd = self.odd_words(words)[index]
        index = index.copy()
        index[at] = len(words) + firsts.indices.to_numpy()

        per_text = np.add.reduceat(sizes[index], at)
        irregular = np.logical_or.reduceat(odd, at)
        if not irregular.any():
            return gather(values, starts, sizes, index), per_text
        of_text = np.repeat(np.arange(n), np.diff(offsets))
        ids = gather(values, starts, sizes, index[~irregular[of_text]])
        regular = iter(np.split(ids, np.cumsum(per_text[~irregular])[:-1]))
        rows = np.flatnonzero(irregular).tolist()
        whole_ids, whole_sizes = self.whole([texts[k].as_py() or "" for k in rows])
        whole = iter(np.split(whole_ids, np.cumsum(whole_sizes)[:-1]))
        parts = [next(whole) if odd else next(regular) for odd in irregular.tolist()]
        return np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=n)
