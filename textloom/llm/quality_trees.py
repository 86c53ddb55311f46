"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted from whole texts inside tasks. The trees are fitted on a sample of
labelled rows with a bound (``sample_rows``), on 64-bin histograms of each statistic, and
flattened into arrays. Scoring walks all trees for a batch of rows at once with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows fitted on at most, those of the least id hashes.
SAMPLE_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0
LEAST_WEIGHT = 4.0

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "beyond_ascii", "stops", "commas", "shouts",
    "bars", "symbols", "quotes", "brackets", "at_signs", "marks", "lines_per_word", "repeated_lines", "distinct_words",
    "commonest_word", "marked_words", "short_words", "adjacent_same", "stopped_lines",
)


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; a null is an empty text."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n_bytes, n_words = len(data), len(words)
    if not n_words:
        return [float(np.log1p(n_bytes))] + [0.0] * (len(STATISTICS) - 1)
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)

    def share(characters: bytes) -> float:
        return float(sum(seen[c] for c in characters)) / n_bytes

    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    marks = seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()
    return [
        float(np.log1p(n_bytes)), float(np.log1p(n_words)), sum(map(len, words)) / n_words,
        float(seen[65:91].sum()) / n_bytes, float(seen[48:58].sum()) / n_bytes, share(b" \t\n\r\x0b\x0c"),
        float(seen[128:].sum()) / n_bytes, share(b".?"), share(b",;:"), share(b"!"), share(b"|"), share(b"#*$%&<>"),
        share(b"\"'`"), share(b"()[]{}"), share(b"@"), float(marks) / n_bytes, len(lines) / n_words,
        1.0 - len(set(lines)) / len(lines), len(counts) / n_words, max(counts.values()) / n_words,
        sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128) / n_words,
        sum(1 for w in words if len(w) < 3) / n_words,
        sum(1 for a, b in zip(words, words[1:]) if a == b) / n_words,
        sum(1 for line in lines if line.rstrip()[-1:] in (b".", b"!", b"?")) / len(lines),
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees in arrays: inner node ``k`` of a tree has children ``2k + 1`` and ``2k + 2``."""

    start: float
    statistic: np.ndarray       # trees x inner nodes
    cut: np.ndarray             # go right if the statistic is above
    value: np.ndarray           # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(rows), self.start)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        at_row = np.arange(len(rows))
        for statistic, cut, value in zip(self.statistic, self.cut, self.value):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[at_row, statistic[node]] > cut[node])
            total += value[node - (value.size - 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost logistic loss on histograms. No rows: score 0.5; one label only: near that label."""
    n, width = rows.shape if rows.size else (0, len(STATISTICS))
    mean = (labels.sum() + 0.5) / (n + 1.0) if n else 0.5
    start = float(np.log(mean / (1 - mean)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if n == 0 or labels.min() == labels.max():
        return Trees(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))

    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * BINS
    margin = np.full(n, start)
    statistics_, cuts, values = [], [], []
    for _ in range(trees):
        chance = 1.0 / (1.0 + np.exp(-margin))
        slope, weight = chance - labels, chance * (1 - chance)
        node = np.zeros(n, dtype=np.int64)
        statistic, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            place = ((node - first) * (width * BINS))[:, None] + flat
            shape = (many, width, BINS)
            size = many * width * BINS
            g = np.bincount(place.ravel(), np.repeat(slope, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(place.ravel(), np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = (g ** 2 / (h + SHRINK) + (all_g - g) ** 2 / (all_h - h + SHRINK)
                    - all_g ** 2 / (all_h + SHRINK))
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    statistic[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), statistic[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, weight, leaves)
        value = -RATE * g / (h + SHRINK)
        margin += value[leaf]
        statistics_.append(statistic)
        cuts.append(cut)
        values.append(value)
    return Trees(start, np.array(statistics_), np.array(cuts), np.array(values))


def held_out(doc_id: Column) -> Column:
    """Rows that are never fitted on: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(h, text, quality)`` of the documents of at most ``sample_rows`` labelled ids that are not held out.

    The ids with the least hashes; the labels alone decide which. They are broadcast, at most ``sample_rows`` of
    them, so the documents are read where they are. ``h`` is a hash of id and text. An id with several labels has
    their rounded mean.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (usable.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.select(F.xxhash64("doc_id", "text").alias("h"), "text", "quality")


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(text, quality)`` of at most ``sample_rows`` rows to fit on: of all texts of the chosen ids, those of the least hashes.

    Rows of one id and text are one. An id may have any number of texts: first the hashes are read, then the
    texts of those that stay.
    """
    rows = labelled_texts(docs, labels, sample_rows)
    least = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(sample_rows).collect()]
    if not least:
        return rows.select("text", "quality").limit(0)
    return rows.where(F.col("h") <= least[-1]).groupBy("h").agg(
        F.first("text").alias("text"), F.first("quality").alias("quality")).select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on the statistics of the sample: at most ``sample_rows`` rows of numbers come to the driver."""
    measure = F.pandas_udf(lambda texts: pd.Series([statistics(t) for t in texts]), "array<double>")
    sample = training_sample(docs, labels, sample_rows)
    fitted = (sample.select(measure("text").alias("x"), "quality").toPandas()
              .sort_values("quality", kind="stable"))
    rows = np.array(fitted["x"].tolist(), dtype=np.float64).reshape(len(fitted), len(STATISTICS))
    order = np.lexsort(rows.T) if rows.size else np.zeros(0, dtype=int)
    return fit_trees(rows[order], fitted["quality"].to_numpy(dtype=np.float64)[order])


def score_column(text: Column, trees: Trees) -> Column:
    """Probability of label 1 for each whole text."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(STATISTICS))
        return pd.Series(trees.score(rows))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs (doc_id, text)``.

    Null and empty texts have a score too, that of a text of no bytes. Repeated rows are
    scored alike, one row each; rows without label, of an id the labels do not know, or
    with a null id are scored, not fitted on. Without any label all scores are 0.5.
    Other columns are ignored; an empty table gives no rows.
    """
    trees = fit(docs, labels, sample_rows)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(F.col("text"), trees).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` predicted to have label 1; all columns stay."""
    return docs.where(score_column(F.col("text"), fit(docs, labels, sample_rows)) >= 0.5)
