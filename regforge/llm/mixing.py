"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations.

Targets: sources share ``share`` of all words by weight; a source's target stops at ``most``
times its words, and what it cannot take is shared among the others.

Within a source each document has a preference that falls gently with its length, in
eighths. The expected number of copies is preference times a factor of the source, at most
``most``; the factor makes the expected words equal the target. The whole part of it is
taken for certain. For the fraction p a document draws a uniform number u from its id and text and
is ranked by its odds over the odds of inclusion, u / (1 - u) / (p / (1 - p)); documents are
taken by rank until the words that are left of the target are reached, the last one in part. The
size of the sample is fixed, its inclusion probabilities are the fractions.

The rank at which a source stops is found by two histograms of the ranking value and an
ordering of one cell of the second; no window holds a source. What the mix takes is then a
comparison with that rank, a narrow projection over any table of the documents.

A null or empty text has no words, is taken 0 times and changes nothing. A null source is
a source of its own, the last. Different texts under one id, or without one, are documents of their own; rows that
repeat id, source and text are taken alike. An empty table gives no row. Runs jobs; draws
depend on ids and texts only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.llm.common import staged, text_of, word_count

WEIGHTS = (3, 1, 2)
BINS = 4096
SEED = 17
KEY = ("absent", "origin")


def _rows(docs: DataFrame) -> DataFrame:
    """The narrow rows that targets and ranks are found from."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_key(docs), *_measures())


def _measures() -> list[Column]:
    """Words, and a hash that tells texts with one id apart."""
    return [word_count(text_of()).alias("size"), F.xxhash64(text_of()).alias("mark")]


def _key(docs: DataFrame) -> list[Column]:
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return [source.isNull().alias(KEY[0]), F.coalesce(source, F.lit("")).alias(KEY[1])]


def preference(size: Column) -> Column:
    """Between 4 and 16 eighths: short documents count for more than long ones."""
    return F.round(F.least(F.greatest(F.sqrt(400 / F.greatest(size, F.lit(1))), F.lit(0.5)), F.lit(2.0)) * 8) / 8


def filled(classes: DataFrame, by: list[str], total: str, weight: str, cap: str) -> Column:
    """The level to which a total fills classes in proportion to weight, up to their caps.

    In the order of cap over weight, full classes come first, and the level that the rest
    would get rises up to the first class that is not full; the level is the maximum.
    """
    order = Window.partitionBy(*by).orderBy(F.col(cap) / F.col(weight), *[c for c in classes.columns if c not in (weight, cap, total)])
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    return (F.col(total) - before) / rest


def targets(rows: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """(absent, origin, source_size, target), one row per source."""
    sources = rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    # One row per source, whatever the number of documents.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*KEY)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    sources = sources.withColumn("total", F.sum("source_size").over(Window.partitionBy(F.lit(0))) * share).withColumn("all", F.lit(0))
    level = filled(sources, ["all"], "total", "weight", "cap")
    sources = sources.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy("all")))
    return sources.select(*KEY, "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def _ranked(rows: DataFrame, most: float) -> DataFrame:
    """``rows`` with ``factor``: whole copies, fraction, and the ranking value in [0, 1)."""
    copies = F.least(F.lit(most), preference(F.col("size")) * F.coalesce("factor", F.lit(0.0)))
    draw = (F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "mark", *KEY), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = rows.withColumn("copies", copies).withColumn("whole", F.floor("copies")).withColumn("part", F.col("copies") - F.col("whole"))
    odds = draw / (1 - draw) * (1 - F.col("part")) / F.col("part")
    return rows.withColumn("rank", F.when(F.col("part") > 0, odds / (1 + odds)))


def _place(ident: str, mark: str) -> list[Column]:
    """What orders rows of equal rank."""
    return [F.coalesce(ident, F.lit(-(1 << 63))).alias("id"), F.col(mark).alias("mark")]


def _cut(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(absent, origin, last, cell): the last row that the sample takes of each source, with
    the number of words it still has room for, and the open cell it lies in."""
    sampled = rows.filter("rank is not null and size > 0").join(goals, list(KEY))
    sampled = sampled.select(*KEY, "doc_id", "mark", "size", "rank", "goal", F.lit(0).alias("cell"), F.lit(0.0).alias("before"))
    for depth in (1, 2):
        # Words by bin of the open cell, to find the bin in which the goal is reached.
        cell = F.floor(F.col("rank") * float(BINS**depth)).cast("long")
        counts = sampled.groupBy(*KEY, cell.alias("cell")).agg(F.sum("size").alias("words"), F.first("goal").alias("goal"), F.first("before").alias("base"))
        order = Window.partitionBy(*KEY).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("upto", F.col("base") + F.sum("words").over(order))
        found = counts.filter("upto >= goal").groupBy(*KEY).agg(F.min(F.struct("cell", (F.col("upto") - F.col("words")).alias("before"))).alias("open"))
        open_ = found.select(*KEY, F.col("open.cell").alias("cell"), F.col("open.before").alias("before"))
        sampled = staged(sampled.drop("cell", "before").withColumn("cell", cell).join(open_, [*KEY, "cell"]), "mix-cell")
    order = Window.partitionBy(*KEY).orderBy("rank", *_place("doc_id", "mark")).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("size").over(order)
    sampled = sampled.withColumn("room", F.round(F.col("goal") - (upto - F.col("size"))).cast("long")).filter("room > 0")
    last = F.struct("rank", *_place("doc_id", "mark"), F.least("room", "size").alias("words"))
    return sampled.groupBy(*KEY).agg(F.max(last).alias("last"), F.max("cell").alias("cell"))


def mixing_plan(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """The narrow rows of ``docs``, and one row per source that says what the mix takes."""
    rows = staged(_rows(docs), "mix-rows")
    goal = staged(targets(rows, share, most, weights), "mix-targets")
    levels = rows.groupBy(*KEY, preference(F.col("size")).alias("liking")).agg(F.sum("size").alias("words")).filter("words > 0")
    levels = levels.join(goal, list(KEY)).select(
        *KEY, "liking", "target", (F.col("liking") * F.col("words")).alias("weight"), (F.col("words") * most).alias("cap")
    )
    factor = levels.withColumn("level", filled(levels, list(KEY), "target", "weight", "cap")).groupBy(*KEY).agg(F.max("level").alias("factor"))
    goal = staged(goal.join(factor, list(KEY), "left"), "mix-factors")
    ranked = _ranked(rows.join(goal, list(KEY)), most)
    left = ranked.groupBy(*KEY).agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("goal"))
    plan = goal.join(_cut(ranked, left), list(KEY), "left")
    # Cells end at multiples of one width: a row before the open cell is taken, one of it is compared.
    width = 1.0 / BINS**2
    plan = plan.select(*KEY, "source_size", "target", "factor", (F.col("cell") * width).alias("floor"), F.col("last.rank").alias("cut"), F.col("last.id").alias("cut_id"), F.col("last.mark").alias("cut_mark"), F.col("last.words").alias("cut_words"))
    return rows, staged(plan, "mix-plan")


def taken_copies(rows: DataFrame, plan: DataFrame, most: float = 2.0) -> DataFrame:
    """``rows`` (doc_id, absent, origin, size, ...) with ``whole`` copies and sampled ``words``."""
    ranked = _ranked(rows.join(plan, list(KEY)), most)
    place, cut = F.struct("rank", *_place("doc_id", "mark")), F.struct(F.col("cut").alias("rank"), *_place("cut_id", "cut_mark"))
    before = F.col("floor").isNull() | (F.col("rank") < F.col("floor")) | (F.col("cut").isNotNull() & (place < cut))
    words = F.when(F.col("rank").isNull() | (F.col("size") == 0), 0).when(before, F.col("size")).when(place == cut, F.col("cut_words")).otherwise(0)
    return ranked.withColumn("words", words.cast("long"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) per row."""
    rows, plan = mixing_plan(docs, share, most)
    return taken_copies(rows, plan, most).select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("words")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents of the mix with their columns; a document taken twice comes twice."""
    _, plan = mixing_plan(docs, share, most)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *_key(docs), *_measures()
    )
    # The one document that is sampled in part comes whole if at least half of it fits.
    times = F.when(F.col("size") > 0, F.col("whole") + (F.col("words") * 2 >= F.col("size")).cast("long")).otherwise(0).cast("long")
    took = taken_copies(keyed, plan, most).withColumn("times", times).filter("times > 0")
    return took.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")
