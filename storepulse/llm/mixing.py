"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from storepulse.llm.common import WORD, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
# Hexadecimal digits of the draw that name a bin: a source is laid out over 16**3 bins,
# so that no task orders more than about 1/4096 of one source.
BIN_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words of a text; NULL and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``source, source_size`` plus ``target``: each source's part of the mixture.

    Sources in order of code point, NULL last, take the weights in turn. A source is
    clamped at ``most_epochs`` times its size and the excess goes to the others by
    weight. Sources fill up in order of cap per weight, so the fixed point of that
    redistribution is one running sum: a source is full if the level that the sources
    before it leave reaches its cap. One row per source: the windows here see sources,
    never documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("turn")).rowsBetween(
        W.unboundedPreceding, -1
    )
    everything = W.partitionBy()
    zero = F.lit(0)
    clamped = (
        totals.withColumn("turn", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
        .withColumn("cap", F.col("source_size") * most_epochs)
        .withColumns({
            "wanted": F.lit(float(share)) * F.sum("source_size").over(everything),
            "weights": F.sum("weight").over(everything),
            "caps_before": F.coalesce(F.sum("cap").over(fill), zero),
            "weights_before": F.coalesce(F.sum("weight").over(fill), zero),
        })
        .withColumn(
            "full",
            (F.col("wanted") - F.col("caps_before")) * F.col("weight")
            >= F.col("cap") * (F.col("weights") - F.col("weights_before")),
        )
    )
    full_caps = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)
    full_weights = F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything)
    level = (F.col("wanted") - full_caps) / F.nullif(F.col("weights") - full_weights, zero)
    return clamped.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(level * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    most_epochs: int = MOST_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """How often the mixture takes each document.

    Reads ``doc_id, text, source``; other columns are ignored, whatever their names.
    Returns ``doc_id, source, size, source_size, target, copies, taken``. Every document
    of a source is taken ``floor(target / source_size)`` times; the rest of the target is
    a seeded draw: documents in the order of an md5 of seed and doc_id are taken once more
    as long as the middle of their words lies within the rest, so a source misses its
    target by half a document at most.

    NULL and empty texts have size 0 and are taken as often as their draw says, which
    adds no words. NULL sources are one source, NULL doc_ids draw as the empty text;
    repeated rows are rows of their own, told apart by size only, so equal ones are
    interchangeable. No rows give no rows.

    The sizes are computed once and written; a hot source is dealt over the bins of its
    draw, and bins are summed before anything is shuffled.
    """
    draw = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                 .cast("binary"))
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                    draw.alias("draw")),
        "mix-sizes",
    ).withColumn("bin", F.conv(F.substring("draw", 1, BIN_DIGITS), 16, 10).cast("int"))

    bins = sized.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    per_source = targets(
        bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")),
        weights, share, most_epochs,
    ).withColumnRenamed("source", "name")
    before = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    laid = (
        bins.withColumn("bin_start", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
        .join(per_source, F.col("source").eqNullSafe(F.col("name")))
        .select(F.col("name"), F.col("bin").alias("at"), "bin_start", "source_size", "target")
    )
    inside = W.partitionBy("source", "bin").orderBy("draw", "doc_id", "size").rowsBetween(
        W.unboundedPreceding, -1
    )
    start = F.col("bin_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))),
                       F.lit(0))
    return (
        sized.join(laid, F.col("source").eqNullSafe(F.col("name")) & (F.col("bin") == F.col("at")))
        .withColumns({"whole": whole, "start": start})
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn(
            "copies",
            F.col("whole")
            + F.when(2 * F.col("start") + F.col("size") <= 2 * F.col("rest"), 1).otherwise(0),
        )
        # A document at the end of a fully used source must not go over its epochs.
        .withColumn("copies", F.least(F.col("copies"), F.lit(most_epochs)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents themselves, each row ``copies`` times, with the columns of ``docs``.

    ``mixed`` has one row per row of ``docs``; rows sharing a doc_id share their copies
    evenly, the first ones by source, size and text taking what is over.
    """
    # Merged at every size: the texts move once.
    counts = mixed.groupBy(F.col("doc_id").alias("mixed_id")).agg(
        F.sum("copies").alias("mixed_copies"), F.count(F.lit(1)).alias("mixed_rows")
    ).hint("merge")
    columns = [docs[c] for c in docs.columns]
    held = F.struct(*columns).alias("held")
    rows = docs.select(held, docs["doc_id"].alias("held_id"),
                       F.xxhash64(*[c.cast("string") for c in columns]).alias("held_hash"))
    place = F.row_number().over(W.partitionBy("held_id").orderBy("held_hash"))
    joined = rows.join(counts, F.col("held_id").eqNullSafe(F.col("mixed_id")))
    n = F.floor(F.col("mixed_copies") / F.col("mixed_rows")).cast("int") + F.when(
        place <= F.col("mixed_copies") % F.col("mixed_rows"), 1).otherwise(0)
    return (
        joined.withColumn("times", n).filter("times > 0")
        .select("held", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
        .select("held.*")
    )
