"""Summaries of training traces.

Losses: ``(epoch int, split string, rank int, batch_idx bigint, loss double)``.
Samples: ``(prompt_id, prompt string, epoch int, generated string)``, one row for
each prompt and epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.formatting import fixed, left_aligned, zero_padded

EPOCHS_PER_LIST = 1_000


def epoch_loss(trace: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the batch losses of all ranks, per epoch and split."""
    return (trace.groupBy(*by, "epoch", "split")
            .agg((F.sum("loss") / F.count("loss")).alias("loss")))


def with_perplexity(losses: DataFrame) -> DataFrame:
    return losses.withColumn("perplexity", F.exp("loss"))


def best_epochs(losses: DataFrame, by: Sequence[str] = (), split: str = "valid") -> DataFrame:
    """Epochs whose validation loss is below that of all earlier epochs of the run.

    The loss to beat is infinite at first, so an epoch of NaN or infinite loss is never a best
    one, nor does it count for later ones. Works on the table of epoch losses, which has one row per
    run and epoch.
    """
    run = list(by) or [F.lit(0)]
    earlier = Window.partitionBy(*run).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    finite = losses.filter((F.col("split") == split) & ~F.isnan("loss") & (F.col("loss") < float("inf")))
    return (finite.withColumn("best_before", F.min("loss").over(earlier))
            .filter(F.col("best_before").isNull() | (F.col("loss") < F.col("best_before")))
            .select(*by, "epoch", "loss"))


def _spent_parts(spent):
    """Whole minutes and remaining whole seconds of an interval."""
    def part(unit: str):
        return F.extract(F.lit(unit), spent).cast("bigint")

    minutes = part("DAY") * 1440 + part("HOUR") * 60 + part("MINUTE")
    return minutes.alias("minutes"), part("SECOND").alias("seconds")


def epoch_duration(timed: DataFrame, ts: str = "ts") -> DataFrame:
    """Whole minutes and remaining whole seconds from the first to the last row of an epoch."""
    spent = timed.groupBy("epoch").agg((F.max(ts) - F.min(ts)).alias("spent"))
    return spent.select("epoch", *_spent_parts(F.col("spent")))


def loss_history(losses: DataFrame, by: Sequence[str] = (), epochs_per_list: int = EPOCHS_PER_LIST) -> DataFrame:
    """Losses of each split in epoch order, in lists of at most ``epochs_per_list`` epochs.

    ``page`` numbers the lists of a split; a run of fewer epochs has page 0 only. The table of epoch
    losses has one row per run, epoch and split, so this bounds a list.
    """
    listed = F.sort_array(F.collect_list(F.struct("epoch", "loss")))
    page = F.floor(F.col("epoch") / epochs_per_list)
    return (losses.groupBy(*by, "split", page.alias("page")).agg(listed.alias("_rows"))
            .select(*by, "split", "page", F.transform("_rows", lambda r: r["loss"]).alias("losses")))


def sample_trace(samples: DataFrame, samples_per_list: int = EPOCHS_PER_LIST) -> DataFrame:
    """Generated texts of each prompt in epoch order, in lists of at most ``samples_per_list`` texts.

    Texts are numbered within their prompt (ties of an epoch by text), and the number cuts
    the pages: a prompt may have any number of samples in an epoch, from several ranks
    for instance. Spark's window sorts and spills; only a page is ever one list.
    """
    place = F.row_number().over(Window.partitionBy("prompt_id", "prompt").orderBy("epoch", "generated")) - 1
    numbered = samples.withColumn("_at", place)
    listed = F.sort_array(F.collect_list(F.struct("_at", "generated")))
    return (numbered.groupBy("prompt_id", "prompt", F.floor(F.col("_at") / samples_per_list).alias("page"))
            .agg(listed.alias("_rows"))
            .select("prompt_id", "prompt", "page",
                    F.transform("_rows", lambda r: r["generated"]).alias("generated")))


def _epoch_number(epoch, epochs: int):
    return zero_padded(epoch.cast("string"), len(str(epochs)))


def epoch_report(batches: DataFrame, epochs: int, ts: str = "ts", prefix: str = "") -> DataFrame:
    """One printable line per epoch, and the name of the checkpoint it would write.

    One aggregation over the batch losses ``(epoch, split, loss, ts)``. An epoch with one
    batch lasts 0 seconds; one without times shows 0 too, and one without losses ``nan``.
    """
    def loss_of(split: str):
        own = F.when(F.col("split") == split, F.col("loss"))
        return F.sum(own) / F.count(own)

    def figure(value):
        return left_aligned(F.coalesce(fixed(value, 4), F.lit("nan")), 8)

    spent = F.max(ts) - F.min(ts)
    wide = (batches.groupBy("epoch").agg(loss_of("train").alias("train_loss"), loss_of("valid").alias("valid_loss"),
                                         spent.alias("spent"))
            .select("epoch", "train_loss", "valid_loss", *_spent_parts(F.col("spent")))
            .fillna(0, ["minutes", "seconds"]))
    train, valid = F.col("train_loss"), F.col("valid_loss")
    line = F.concat(
        F.lit(prefix + "Epoch: "), _epoch_number(F.col("epoch") + 1, epochs), F.lit(f"/{epochs}, "),
        F.col("minutes").cast("string"), F.lit("m "), F.col("seconds").cast("string"), F.lit("s ::"),
        F.lit("Train Loss: "), figure(train), F.lit(", Train PPL: "), figure(F.exp(train)),
        F.lit(" | Valid Loss: "), figure(valid), F.lit(", Valid PPL: "), figure(F.exp(valid)))
    checkpoint = F.concat(F.lit("epoch-"), _epoch_number(F.col("epoch"), epochs), F.lit("-valid_loss-"),
                          zero_padded(F.coalesce(fixed(valid, 4), F.lit("nan")), 7), F.lit(".pt"))
    return wide.select("epoch", line.alias("line"), checkpoint.alias("checkpoint"))
