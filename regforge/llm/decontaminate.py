"""Benchmark decontamination by template windows, in DataFrame operations.

Windows are ``WINDOW`` words in a row, lower-cased; a shorter item is one window, and
documents have windows of the lengths of such items too, from ``LEAST_INSIDE`` words on. An
item of fewer words is only found as a whole text. Each text is read in three ways: as it
stands; with numbers, units after numbers, and names (capitalised words after a lower-case
word or a comma) as typed slots; with all capitalised words as names. Documents and
benchmark items meet in a hash join on windows of any reading. A match of windows with
slots counts only if the slots are consistent (two slots of the window have equal values in
the document just where they have in the item) and fill no more than half of the words. So
a question whose numbers or names were exchanged is found, also with names that begin
sentences, and an exact copy in any case or layout; a text that merely has the same shape
with other repetitions is not.

A document is contaminated by an item if at least ``COVER`` of the item's windows (those
of the second reading, equal ones counted once) match.
Null and empty texts match nothing, repeated rows count alike, an empty table gives no
row, an empty benchmark contaminates nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.functions.columns import bind, explode_rows
from regforge.llm.common import staged, text_of

WINDOW = 8
#: Words of the shortest item that is looked for inside longer texts.
LEAST_INSIDE = 3
COVER = 0.25
#: Beyond this many rows windows of the benchmark and ids of matched documents are joined by
#: shuffle, not broadcast.
BROADCAST_ROWS = 500_000
#: The marks of slots; ``CAPITAL`` marks a capitalised word that may only begin a sentence.
NAME, NUMBER, UNIT, CAPITAL = "\x01", "\x02", "\x03", "\x04"
UNITS = (
    "mm cm m km in ft yd mi miles mile meters metres g kg mg lb lbs oz pounds tons l ml liters litres "
    "s sec seconds min minutes h hours hour days day weeks months years percent dollars euros cents"
).split()


def canonical_words(text: Column) -> Column:
    """The words of a text without punctuation, with a mark before slots and other capitalised words."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    # Every pattern begins with the character it looks for, what precedes it is checked after.
    # Any run of blanks is one blank; single ones are left alone.
    out = F.regexp_replace(text, "[\x01-\x04\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", " ")
    out = F.regexp_replace(out, " {2,}", " ")
    out = F.regexp_replace(out, rf"(\d(?<![\p{{L}}\p{{N}}.,]\d)(?:[\d.,]*\d)?)(?=(?i:{units})(?![\p{{L}}\p{{N}}]))", "$1 ")
    out = F.regexp_replace(out, r"\d(?<![\p{L}\p{N}.,]\d)(?:[\d.,]*\d)?(?!\p{L})", NUMBER + "$0")
    out = F.regexp_replace(out, rf"(\d )((?i:{units})(?![\p{{L}}\p{{N}}]))", "$1" + UNIT + "$2")
    out = F.regexp_replace(out, r"\p{Lu}(?<=[\p{Ll},;] \p{Lu})[\p{L}\p{N}]*", NAME + "$0")
    out = F.regexp_replace(out, r"\p{Lu}(?<![\p{L}\p{N}\x01\x03]\p{Lu})", CAPITAL + "$0")
    # Decimal signs are part of a number; other signs separate.
    out = F.regexp_replace(out, r"[.,](?:(?<!\d[.,])|(?!\d))|[^\p{L}\p{N}\x01-\x04., ]+", " ")
    return F.array_remove(F.split(F.lower(out), " +"), "")


def read_in(words: Column, way: int) -> Column:
    """The words in reading 0 (as they stand), 1 (names inside sentences) or 2 (all capitalised words)."""
    rest = lambda w: F.substring(w, 2, 1 << 30)
    if way == 0:
        return F.transform(words, lambda w: F.when(w < "\x05", rest(w)).otherwise(w))
    capital = lambda w: (w >= CAPITAL) & (w < "\x05")
    return F.transform(words, lambda w: F.when(capital(w), rest(w) if way == 1 else F.concat(F.lit(NAME), rest(w))).otherwise(w))


def readings(words: Column) -> Column:
    """Array of the three readings."""
    return bind(words, lambda w: F.array(*[read_in(w, way) for way in range(3)]))


def _is_slot(word: Column) -> Column:
    return (word < "\x04") & (word != "")


def template_hashes(words: Column) -> Column:
    """A hash per word; all slots of a type have the same."""
    return F.transform(words, lambda w: F.xxhash64(F.when(_is_slot(w), F.substring(w, 1, 1)).otherwise(w)))


def reading_hashes(words: Column) -> Column:
    """``template_hashes`` of the three readings, without making these."""
    rest = lambda w: F.substring(w, 2, 1 << 30)
    slot = lambda w: F.when(w < "\x04", F.substring(w, 1, 1))
    ways = (
        lambda w: F.when(w < "\x05", rest(w)).otherwise(w),
        lambda w: slot(w).when(w < "\x05", rest(w)).otherwise(w),
        lambda w: slot(w).when(w < "\x05", F.lit(NAME)).otherwise(w),
    )

    def hashed(all_: Column, word: Callable[[Column], Column]) -> Column:
        return F.transform(all_, lambda w: F.xxhash64(word(w)))

    return bind(words, lambda all_: F.array(*[hashed(all_, word) for word in ways]))


def windows(hashes: Column, size: int = WINDOW) -> Column:
    """One hash per window of ``size`` words, in order; one for all words if there are fewer."""
    def full_windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - size, F.lit(0)))
        full = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) > 0, full).otherwise(F.array().cast("array<bigint>"))

    return bind(hashes, full_windows)


def shape(slots: Column) -> Column:
    """Where each slot's value comes first: equal for two windows with consistent slots."""
    return bind(slots, lambda all_: F.transform(all_, lambda s: F.array_position(all_, s)))


def all_windows(texts: DataFrame, words: Column, lengths: list[int], keep: list[str]) -> DataFrame:
    """The windows of ``WINDOW`` words and those of ``lengths`` words in each reading: window, way, at and len."""
    sizes = [WINDOW, *lengths]

    def by_size(h: Column) -> list[Column]:
        return [F.when((F.size(h) >= n) | F.lit(n == WINDOW), windows(h, n)) for n in sizes]

    ways = bind(
        reading_hashes(words),
        lambda r: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: bind(F.get(r, i), lambda h: F.array(*by_size(h))))),
    )
    rows = explode_rows(texts, ways, "all_of", keep=keep, position="which")
    rows = rows.select(*keep, "all_of", F.floor(F.col("which") / len(sizes)).cast("int").alias("way"), F.get(F.array(*map(F.lit, sizes)), F.col("which") % len(sizes)).alias("len"))
    return explode_rows(rows, "all_of", "window", keep=[*keep, "way", "len"], position="at")


def _parts(words: Column, at: Column, size: Column | int = WINDOW) -> dict[str, Column]:
    part = F.slice(words, at + 1, size)
    slots = F.filter(part, _is_slot)
    return {"slots": slots, "shape": shape(slots), "plain": F.size(part) - F.size(slots), "all": F.size(part)}


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """doc_id, item_id, matched and windows (of the item) for each contaminated pair."""
    items = benchmark.select(F.col("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # The window in reading 1 stands for its place, whatever reading matches.
    ways = explode_rows(items, readings(canonical_words(F.col("text"))), "words", keep=["item_id"], position="way")
    places = explode_rows(ways, windows(template_hashes(F.col("words"))), "window", keep=["item_id", "way", "words"], position="item_at")
    part = _parts(F.col("words"), F.col("item_at"))
    places = staged(places.select("item_id", "way", "item_at", "window", *[v.alias(f"item_{k}") for k, v in part.items()]), "item-windows")
    units = places.filter("way = 1").select("item_id", "item_at", F.col("window").alias("unit"))
    total = units.groupBy("item_id").agg(F.countDistinct("unit").alias("windows"))
    wanted = staged(places.join(units, ["item_id", "item_at"]).drop("item_at", "way").distinct(), "item-units")
    # At most five numbers.
    sizes = wanted.filter((F.col("item_all") >= LEAST_INSIDE) & (F.col("item_all") < WINDOW)).select("item_all").distinct()
    lengths = sorted(r["item_all"] for r in sizes.collect())
    keys = wanted.select("window").distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("copy"))
    found = all_windows(texts, canonical_words(F.col("text")), lengths, ["doc_id", "copy"])
    found = staged(found.join(keys, "window"), "doc-windows")
    # Only the texts with a match are read again, for the values of their slots.
    matched = staged(found.select("doc_id", "copy").distinct(), "matched-docs")
    if matched.count() <= BROADCAST_ROWS:
        matched = F.broadcast(matched)
    again = texts.join(matched, texts.doc_id.eqNullSafe(matched.doc_id) & (texts.copy == matched.copy), "left_semi").dropDuplicates(["doc_id", "copy"])
    words = staged(again.select(F.col("doc_id").alias("id"), F.col("copy").alias("id_copy"), readings(canonical_words(F.col("text"))).alias("words")), "doc-words")
    part = _parts(F.get("words", "way"), F.col("at"), F.col("len"))
    seen = found.join(words, found.doc_id.eqNullSafe(words.id) & (found.copy == words.id_copy)).select("doc_id", "copy", "window", *[v.alias(k) for k, v in part.items()])
    seen = seen.groupBy("doc_id", "copy", "window", "slots", "shape", "plain", "all").agg(F.count(F.lit(1)).alias("times"))
    fits = (F.col("shape") == F.col("item_shape")) & (F.col("plain") * 2 >= F.col("all"))
    pairs = seen.join(wanted, "window").filter(fits)
    hits = pairs.groupBy("doc_id", "copy", "item_id").agg(F.countDistinct("unit").alias("matched"))
    hits = hits.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))
    return hits.join(total, "item_id").filter(F.col("matched") >= cover * F.col("windows")).select("doc_id", "item_id", "matched", "windows")
