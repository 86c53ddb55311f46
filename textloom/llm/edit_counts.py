"""Token counts that follow edits, with a segment tree of pre-token counts per document.

The leaves of a tree are runs of pre-tokens (a word with the space before it, or a run of
white space); inner nodes hold the sums of tokens below. An edit re-encodes the leaves
it touches and as much around them as the tokenizer's cut of pre-tokens can see, and
updates the sums above them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.distinct_words import batch_words
from textloom.llm.tables import for_this_task, text_slices
from textloom.llm.word_encoder import WHITE

LEAF_WORDS = 32
#: Pre-tokens whose counts a worker keeps.
KEPT_WORDS = 400_000
#: Characters behind a boundary that decide whether it is one.
LOOKAHEAD = 2
#: Personal data that the query takes out: mail addresses and long numbers.
PERSONAL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+[A-Za-z0-9]|\+?[0-9][0-9() -]{7,}[0-9]"
MASK = "[removed]"
EDITS = "array<struct<start:int,end:int,text:string>>"
TREES = "doc_id long, text string, leaf_chars array<int>, sums array<int>"


class WordCounter:
    """Tokens of pre-tokens, each distinct one encoded once. Names of special tokens are ordinary text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cut = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.edge = re.compile(f"^[{WHITE}]|[{WHITE}]$")
        self.kept: dict[str, int] = {}

    def sizes(self, pre_tokens: Sequence[str]) -> list[int]:
        kept = self.kept
        missing = list({p for p in pre_tokens if p not in kept})
        if len(kept) + len(missing) > KEPT_WORDS:
            kept.clear()
            missing = list(set(pre_tokens))
        for at in range(0, len(missing), 20_000):
            part = missing[at:at + 20_000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                kept[p] = len(e.ids)
        return [kept[p] for p in pre_tokens]

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each leaf of a text."""
        pre_tokens = self.cut.findall(text)
        return in_leaves(np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens)),
                         np.array(self.sizes(pre_tokens), dtype=np.int64))

    def batch_leaves(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """:meth:`leaves` of many texts; words of texts with single spaces only are looked up in bulk."""
        cut = batch_words(texts)
        spaced = np.array([bool(w) and not self.edge.search(w) for w in cut.words], dtype=bool)
        tokens = np.array(self.sizes([" " + w if w else "" for w in cut.words]), dtype=np.int64)
        chars = np.fromiter(map(len, cut.words), np.int64, len(cut.words)) + 1
        simple = ~np.logical_or.reduceat(~spaced[cut.index], cut.offsets[:-1])
        found = []
        for k in range(len(texts)):
            if not simple[k]:
                found.append(self.leaves(texts[k].as_py() or ""))
                continue
            index = cut.index[cut.offsets[k]:cut.offsets[k + 1]]
            own_chars, own_tokens = chars[index], tokens[index]
            own_chars[0] -= 1
            own_tokens[0] = self.sizes([cut.words[index[0]]])[0]
            found.append(in_leaves(own_chars, own_tokens))
        return found


def in_leaves(chars: np.ndarray, tokens: np.ndarray, leaf_words: int = LEAF_WORDS) -> tuple[np.ndarray, np.ndarray]:
    if not len(chars):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    at = np.arange(0, len(chars), leaf_words)
    return np.add.reduceat(chars, at), np.add.reduceat(tokens, at)


def tree_of(leaf_tokens: np.ndarray) -> np.ndarray:
    """Sums in heap order: node 1 is the root, node ``k`` has children ``2k`` and ``2k + 1``; node 0 is unused."""
    width = 1 << int(len(leaf_tokens) - 1).bit_length()
    sums = np.zeros(2 * width, dtype=np.int64)
    sums[width:width + len(leaf_tokens)] = leaf_tokens
    level = width
    while level > 1:
        sums[level // 2:level] = sums[level:2 * level:2] + sums[level + 1:2 * level:2]
        level //= 2
    return sums


def set_leaf(sums: np.ndarray, leaf: int, tokens: int) -> None:
    node = len(sums) // 2 + leaf
    change = tokens - sums[node]
    while node:
        sums[node] += change
        node //= 2


def edit(counter: WordCounter, text: str, leaf_chars: np.ndarray, sums: np.ndarray,
         edits: Sequence[tuple[int, int, str]]) -> tuple[str, int]:
    """Apply edits ``(start, end, new text)`` of the old text; returns the new text and the pre-tokens re-encoded.

    ``leaf_chars`` and ``sums`` are changed in place. Edits must be in order and not
    overlap. Leaves keep their number: the leaves of a changed region share its new
    pre-tokens, and may be empty.
    """
    encoded = 0
    limit = len(text)
    for start, end, new in reversed(edits):                     # from the back: places before stay as they are
        if not 0 <= start <= end <= limit:
            raise ValueError("edits must be in order, apart, and inside of the text")
        limit = start
        begins = np.concatenate(([0], np.cumsum(leaf_chars)))
        changed = text[:start] + new + text[end:]
        grown = len(new) - (end - start)
        first = max(0, int(np.searchsorted(begins[:-1], start - LOOKAHEAD, side="right")) - 1)
        last = min(len(leaf_chars) - 1, max(first, int(np.searchsorted(begins[1:], end, side="left"))))
        low = int(begins[first])
        while True:
            high = int(begins[last + 1]) + grown
            seen = changed[low:min(high + LOOKAHEAD, len(changed))]
            pre_tokens, at = [], low
            for p in counter.cut.findall(seen):
                if at >= high:
                    break
                pre_tokens.append(p)
                at += len(p)
            if at == high or last == len(leaf_chars) - 1:
                break
            last += 1
        if last == len(leaf_chars) - 1:
            pre_tokens = counter.cut.findall(changed[low:])
        encoded += len(pre_tokens)
        tokens = np.array(counter.sizes(pre_tokens), dtype=np.int64)
        chars = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        shares = np.linspace(0, len(pre_tokens), last - first + 2).astype(int)
        for leaf, (a, b) in enumerate(zip(shares[:-1], shares[1:]), start=first):
            leaf_chars[leaf] = chars[a:b].sum()
            set_leaf(sums, leaf, int(tokens[a:b].sum()))
        text = changed
    return text, encoded


def build_trees(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, text, leaf_chars, sums)`` of each row of ``docs (doc_id, text)``: the state to keep.

    ``sums[1]`` is the number of tokens of the text. Null and empty texts have one empty
    leaf; a null stays null. Repeated rows have a tree each; other columns are ignored; an
    empty table gives no rows. The job is narrow.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", pa.list_(pa.int32())),
                        ("sums", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: WordCounter(tokenizer_path)) as counter:
            for part in (part for batch in batches for part in text_slices(batch)):
                found = counter.batch_leaves(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text").cast(pa.string()),
                     pa.array([c.astype(np.int32) for c, _ in found], pa.list_(pa.int32())),
                     pa.array([tree_of(t).astype(np.int32) for _, t in found], pa.list_(pa.int32()))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, TREES)


def apply_edits(trees: DataFrame, tokenizer_path: str) -> DataFrame:
    """Trees after their ``edits``; adds the tokens before and after, and the pre-tokens encoded for it.

    ``trees`` has the columns of :func:`build_trees` and ``edits``, an array of ``(start, end,
    text)``; a null or empty array changes nothing. A null text counts as empty.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", pa.list_(pa.int32())),
                        ("sums", pa.list_(pa.int32())), ("n_before", pa.int64()), ("n_edits", pa.int64()),
                        ("n_tokens", pa.int64()), ("n_encoded", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: WordCounter(tokenizer_path)) as counter:
            for batch in batches:
                columns = {name: batch.column(name) for name in batch.schema.names}
                out = {name: [] for name in schema.names}
                for k in range(batch.num_rows):
                    text = columns["text"][k].as_py()
                    chars = np.array(columns["leaf_chars"][k].values, dtype=np.int64)
                    sums = np.array(columns["sums"][k].values, dtype=np.int64)
                    edits = [(e["start"], e["end"], e["text"] or "") for e in columns["edits"][k].as_py() or ()]
                    before, n_encoded = int(sums[1]), 0
                    if edits:
                        text, n_encoded = edit(counter, text or "", chars, sums, edits)
                    for name, value in zip(schema.names, (columns["doc_id"][k].as_py(), text, chars.astype(np.int32),
                                                          sums.astype(np.int32), before, len(edits), int(sums[1]),
                                                          n_encoded)):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return trees.select("doc_id", "text", "leaf_chars", "sums", "edits").mapInArrow(
        run, TREES + ", n_before long, n_edits long, n_tokens long, n_encoded long")


def masking_edits(text: Column, pattern: str = PERSONAL, mask: str = MASK) -> Column:
    """Edits that put ``mask`` for each match of ``pattern``, left to right; a null has none."""
    @F.pandas_udf(EDITS)
    def find(texts: pd.Series) -> pd.Series:
        compiled = re.compile(pattern)
        return pd.Series([[{"start": m.start(), "end": m.end(), "text": mask} for m in compiled.finditer(t or "")]
                          for t in texts])

    return find(text)


def count_after_edits(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, n_edits, n_tokens_after, n_encoded)`` for each row: personal data masked.

    The counts before and after are the roots of the trees; the state of a document goes
    from one to the other by the edits alone.
    """
    trees = build_trees(docs, tokenizer_path).withColumn("edits", masking_edits(F.col("text")))
    after = apply_edits(trees, tokenizer_path)
    return after.select("doc_id", F.col("n_before").alias("n_tokens"), "n_edits",
                        F.col("n_tokens").alias("n_tokens_after"), "n_encoded")
