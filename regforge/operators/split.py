"""Train / validation / test splits: by hash, with exact sizes, and stratified.

Rows are ordered by the md5 of ``seed:key`` (then by the key). That order depends on
nothing but the key, so the split is equal for every partitioning, and a retried task
cannot change it. Rows with equal keys stay together: split by entity to keep all
rows of an entity on one side, or pass a unique key to get exact row counts.

Exact sizes need the row at a given global rank, not the rank of every row. The key
space is cut into 65,536 ranges by the first 16 hash bits; a count per range shows
which range holds the wanted rank, and only that range (1/65,536 of the rows) is
ordered. The data itself is never sorted and, for the unstratified split, never
shuffled.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column
from regforge.operators.joins import splittable_join
from regforge.plans.stages import staged

_BUCKET_DIGITS = 4  # hex digits: 65,536 ranges
#: The bounds of so many labels travel as one small map.
MAX_LABELS = 1000


def _text(key: str | Column) -> Column:
    return F.coalesce(as_column(key).cast("string"), F.lit(""))


def split_hash_value(key: str | Column, seed: int = C.SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), _text(key)))


def _place(key: str | Column, seed: int) -> Column:
    """Position of a row in the split order, as a comparable struct."""
    return F.struct(split_hash_value(key, seed).alias("hash"), _text(key).alias("key"))


def _hash_limit(share: float) -> str:
    """First 8-digit hash prefix beyond ``share`` of the hash space. Equal-length
    lower-case hex compares like the number it stands for."""
    limit = math.ceil(share * 2**32)
    return f"{limit:08x}" if limit < 2**32 else "g"  # beyond every digit


def split_by_hash(
    df: DataFrame,
    key: str | Column,
    train: float = C.TRAIN_RATIO,
    validation: float = (1 - C.TRAIN_RATIO) / 2,
    seed: int = C.SPLIT_SEED,
    name: str = "split",
) -> DataFrame:
    """Independent per row; sizes are right on average. Narrow: no shuffle, and a row
    keeps its side when other rows come or go."""
    prefix = F.substring(split_hash_value(key, seed), 1, 8)
    first, second = _hash_limit(train), _hash_limit(train + validation)
    side = F.when(prefix < first, "train").when(prefix < second, "val").otherwise("test")
    return df.withColumn(name, side)


def held_out_size(total: Column, train: float) -> Column:
    return F.ceil(F.lit(1.0 - train) * total.cast("double")).cast("long")


def _places(df: DataFrame, strata: Sequence[str], key: str, seed: int) -> DataFrame:
    places = df.select(*strata, _place(key, seed).alias("_place"))
    return places.withColumn("_bucket", F.substring("_place.hash", 1, _BUCKET_DIGITS))


def _ranges(places: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows per hash range and stratum with the rank interval (``_before``, ``_last``]."""
    counts = places.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy(*strata).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_last", F.sum("rows").over(upto)).withColumn(
        "_before", F.col("_last") - F.col("rows")
    )


def _within(ranges: DataFrame, strata: Sequence[str]) -> DataFrame:
    """From ranges with a wanted ``rank`` called ``which``: the range that holds it and
    the rank inside that range."""
    inside = (F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_last"))
    return ranges.filter(inside).select(
        *strata, "_bucket", "which", (F.col("rank") - F.col("_before")).alias("_inner")
    )


def _rows_at(places: DataFrame, strata: Sequence[str], wanted: DataFrame) -> DataFrame:
    """``_place`` of each wanted row, as columns ``train`` and ``val`` per stratum."""
    by = [*strata, "_bucket"]
    order = Window.partitionBy(*by, "which").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    if strata:
        # 65,536 short names at most, hence the broadcast: rows of other ranges, nearly
        # all, are gone before anything is shuffled.
        ranges = F.broadcast(wanted.select("_bucket").distinct())
        near = places.join(ranges, "_bucket", "left_semi")
    else:
        # Two rows by construction.
        near, wanted = places, F.broadcast(wanted)
    # One row per key of the range, so a key that holds a third of all rows is one row here.
    keys = near.groupBy(*by, "_place").agg(F.count(F.lit(1)).alias("_rows")).join(wanted, by)
    keys = keys.withColumn("_upto", F.sum("_rows").over(order))
    ends = [F.max(F.when(F.col("which") == w, F.col("_place"))).alias(w) for w in ("train", "val")]
    holds = (F.col("_upto") >= F.col("_inner")) & (F.col("_upto") - F.col("_rows") < F.col("_inner"))
    return keys.filter(holds).groupBy(*strata).agg(*ends)


def _wanted(train_end: Column, validation_end: Column) -> Column:
    """The two wanted ranks of a stratum, as rows."""
    return F.inline(
        F.array(
            F.struct(F.lit("train").alias("which"), train_end.alias("rank")),
            F.struct(F.lit("val").alias("which"), validation_end.alias("rank")),
        )
    )


def _side(place: Column, train_end: Column, validation_end: Column) -> Column:
    """A missing end means that side is empty."""
    return (
        F.when(place <= train_end, "train").when(place <= validation_end, "val").otherwise("test")
    )


def split_exact(
    df: DataFrame,
    key: str,
    train: float = C.TRAIN_RATIO,
    seed: int = C.SPLIT_SEED,
    name: str = "split",
) -> DataFrame:
    """Sizes exactly ``n - ceil((1 - train) n)``, then the rest halved, the odd row to
    test. Two key-only passes for the two boundary rows, then a narrow pass."""
    places = _places(df, [], key, seed)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per hash range, 65,536 at most, so an unpartitioned window is safe here.
    ranges = _ranges(places, []).withColumn("_total", F.sum("rows").over(whole))
    held = held_out_size(F.col("_total"), train)
    test = F.ceil(held * F.lit(0.5)).cast("long")
    wanted = _within(
        ranges.select("*", _wanted(F.col("_total") - held, F.col("_total") - test)), []
    )
    ends = _rows_at(places, [], wanted).select(F.struct("train", "val")).scalar()
    place = _place(key, seed)
    marked = df.withColumn("_ends", ends)
    return marked.withColumn(name, _side(place, F.col("_ends.train"), F.col("_ends.val"))).drop(
        "_ends"
    )


def _largest_remainder(share: Column, draws: Column, label: str, out: str, df: DataFrame) -> DataFrame:
    """Whole-number allocation of ``draws`` over the label rows proportional to
    ``share``; leftovers by remainder, ties by label. ``df`` has one row per label."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exact = share * draws / F.sum(share).over(whole)
    floored = df.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    order = Window.orderBy((F.col("_exact") - F.col("_floor")).desc(), label)
    extra = (F.row_number().over(order) <= draws - F.sum("_floor").over(whole)).cast("long")
    return floored.withColumn(out, F.col("_floor") + extra).drop("_exact", "_floor")


def strata_plan(
    counts: DataFrame,
    label: str,
    train: float = C.TRAIN_RATIO,
    min_rows: int = C.MIN_ROWS_TO_SPLIT,
    min_stratify: int = C.MIN_ROWS_TO_STRATIFY,
    min_held_stratify: int = C.MIN_HELD_OUT_TO_STRATIFY,
) -> DataFrame:
    """Rows per side and label, from ``(label, rows)``: one row per label.

    ``whole`` is true where nothing may be split: fewer than ``min_rows`` rows, or a
    class too small for the two stratified stages (a class needs two members in each
    stratified stage, and every side needs room for every class).
    """
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def overall(value: Column) -> Column:
        return value.over(every)

    table = counts.withColumn("_n", overall(F.sum("rows"))).withColumn("_held", held_out_size(F.col("_n"), train))
    table = table.withColumn("_classes", overall(F.count(F.lit(1))))
    table = table.withColumn("_test", F.ceil(F.col("_held") * F.lit(0.5)).cast("long"))
    table = _largest_remainder(F.col("rows"), F.col("_n") - F.col("_held"), label, "train_rows", table)
    table = table.withColumn("_held_rows", F.col("rows") - F.col("train_rows"))
    table = _largest_remainder(
        F.col("_held_rows"), F.col("_held") - F.col("_test"), label, "val_rows", table
    )
    held_rows = F.when(F.col("_held_rows") > 0, F.col("_held_rows"))
    held_classes = overall(F.count(held_rows))
    n, held, test, classes = (F.col(c) for c in ("_n", "_held", "_test", "_classes"))
    first_fails = (n >= min_stratify) & (
        (overall(F.min("rows")) < 2) | (n - held < classes) | (held < classes)
    )
    second_fails = (held >= min_held_stratify) & (
        (overall(F.min(held_rows)) < 2) | (held - test < held_classes) | (test < held_classes)
    )
    return table.select(
        label,
        "rows",
        "train_rows",
        "val_rows",
        (F.col("_held_rows") - F.col("val_rows")).alias("test_rows"),
        ((n < min_rows) | first_fails | second_fails).alias("whole"),
    )


def split_stratified(
    df: DataFrame,
    key: str,
    label: str,
    train: float = C.TRAIN_RATIO,
    seed: int = C.SPLIT_SEED,
    name: str = "split",
) -> DataFrame:
    """Exact sizes per label, or ``all`` for every row where ``strata_plan`` says so.

    Counts per label and range, and the plan with one row per label, are staged: this runs
    jobs. The boundary rows of up to ``MAX_LABELS`` labels come to the data as one map, so
    the rows themselves are not shuffled; beyond, they are joined by label, and a label with
    a large share of the rows can be split.
    """
    labelled = df.filter(F.col(label).isNotNull())
    places = _places(labelled, [label], key, seed)
    ranges = staged(_ranges(places, [label]))
    plan = staged(strata_plan(ranges.groupBy(label).agg(F.sum("rows").alias("rows")), label, train))
    ranks = plan.select(label, _wanted(F.col("train_rows"), F.col("train_rows") + F.col("val_rows")))
    ends = _rows_at(places, [label], _within(ranges.join(ranks, label), [label]))
    per_label = staged(plan.select(label, "whole").join(ends, label, "left"))
    end = F.struct("whole", "train", "val")
    if per_label.count() <= MAX_LABELS:
        # An array from at most MAX_LABELS rows.
        bounds = per_label.agg(F.map_from_entries(F.collect_list(F.struct(F.col(label), end))).alias("map")).scalar()
        marked = df.withColumn("_bounds", bounds).withColumn("_end", F.element_at("_bounds", F.col(label)))
    else:
        marked = splittable_join(df, per_label.select(F.col(label).alias("_label"), end.alias("_end")), label, "_label", "left")
    side = F.when(F.col("_end.whole"), "all").when(
        F.col("_end.whole").isNotNull(), _side(_place(key, seed), F.col("_end.train"), F.col("_end.val"))
    )
    return marked.withColumn(name, side).select(*df.columns, name)


def split_counts(df: DataFrame, dataset: str, split: str = "split") -> DataFrame:
    """Rows per split value of one data set."""
    return (
        df.groupBy(split)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(dataset).alias("dataset"), split, "rows")
    )
