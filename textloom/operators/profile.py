"""Length profiles of a corpus.

Texts are read once: they shrink to a table ``(length, cnt)`` by partial
aggregation, and ranges, bins and shares come from that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.formatting import fixed, grouped


def length_counts(df: DataFrame, column: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Number of rows of each text length."""
    return (df.filter(F.col(column).isNotNull())
            .groupBy(*by, F.length(column).alias("length")).agg(F.count("*").alias("cnt")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def _ranges(lengths: DataFrame, by: Sequence[str]) -> DataFrame:
    return lengths.groupBy(*by).agg(F.min("length").alias("min_length"),
                                    F.max("length").alias("max_length"),
                                    F.sum("cnt").alias("total"))


def length_range(lengths: DataFrame) -> DataFrame:
    """Smallest and largest length; no row if there is no text."""
    return _ranges(lengths, ()).filter(F.col("total").isNotNull())


def bin_edges(low: Column, high: Column, bins: int) -> Column:
    """``bins + 1`` edges of equal width, cut to whole numbers; the last is ``high``."""
    lo, hi = low.cast("double"), high.cast("double")
    step = (hi - lo) / F.lit(float(bins))
    return F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda k: F.when(k == bins, high.cast("bigint")).otherwise((k.cast("double") * step + lo).cast("bigint")))


def length_bin_edges(lengths: DataFrame, bins: int) -> DataFrame:
    """The edges of the histogram, one row for each."""
    return length_range(lengths).select(
        F.posexplode(bin_edges(F.col("min_length"), F.col("max_length"), bins)).alias("edge_idx", "edge"))


def length_histogram(lengths: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows per bin ``[lo, hi)``, the last bin ``[lo, hi]``; empty bins are listed too.

    Of bins with the same lower edge only the last can hold rows. With ``by`` there
    is one histogram per group.
    """
    edges = _ranges(lengths, by).filter(F.col("total").isNotNull()).select(
        *by, "total", bin_edges(F.col("min_length"), F.col("max_length"), bins).alias("edges"))

    if by:
        placed = lengths.join(edges.select(*by, "edges"), list(by))
    else:
        placed = lengths.withColumn("edges", edges.select("edges").scalar())
    lower_edges = F.slice("edges", 1, bins)
    bin_idx = F.size(F.filter(lower_edges, lambda edge: edge <= F.col("length"))) - 1
    counts = placed.groupBy(*by, bin_idx.alias("bin_idx")).agg(F.sum("cnt").alias("cnt"))

    listed = edges.select(*by, "total", "edges", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin_idx"))
    return (
        listed.join(counts, [*by, "bin_idx"], "left")
        .withColumn("cnt", F.coalesce("cnt", F.lit(0)).cast("bigint"))
        .select(*by, "bin_idx",
                F.col("edges")[F.col("bin_idx")].alias("lo"),
                F.col("edges")[F.col("bin_idx") + 1].alias("hi"),
                "cnt", (F.col("cnt") / F.col("total") * F.lit(100.0)).alias("pct"))
    )


def length_report(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Printable lines: a headline with the number of texts (``bin_idx`` -1), then one per bin."""
    headline = (histogram.groupBy(*by).agg(F.sum("cnt").alias("total")) if by
                else histogram.agg(F.sum("cnt").alias("total")).where("total is not null"))
    # The wording of the report.
    title = F.concat(F.lit("Length distribution (total count: "), F.col("total").cast("string"), F.lit("):"))
    line = F.concat(
        F.lit("Length: "), grouped(F.col("lo")), F.lit(" - "), grouped(F.col("hi")),
        F.lit(", Counts: "), grouped(F.col("cnt")),
        F.lit(", Percentage: "), fixed(F.col("pct"), 6), F.lit("%"))
    return (headline.select(*by, F.lit(-1).alias("bin_idx"), title.alias("line"))
            .unionByName(histogram.select(*by, "bin_idx", line.alias("line"))))


def null_texts(df: DataFrame, column: str = "text") -> DataFrame:
    """Rows in all, and rows without a text, which the chunker drops."""
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.col(column).isNull()).alias("null_texts"))


def corpus_summary(df: DataFrame) -> DataFrame:
    """Column names and number of rows."""
    names = F.array(*[F.lit(name) for name in df.columns])
    return df.agg(F.count("*").alias("num_rows")).select(
        F.array_join(names, ", ").alias("features"), "num_rows")
