"""Exact dedup through a minimal perfect hash over historical distinct digests.

``build_index`` turns the winners of a history into one index row per shard: level bit
maps of a minimal perfect hash, and slots that hold the full digest and the locator of
the winner. ``look_up`` evaluates the hash for arriving distinct digests and compares
all 32 bytes of the slot, so a digest that only shares a slot is never taken for a
repeat. ``dedup`` joins both: members go to their historical group, the others form
groups of their own, and the better of the historical and the arriving row wins.

Rows are aggregated by digest before anything is dealt to shards, so a text that makes up
a third of all rows is one row there. A shard holds ``SHARD_ROWS`` digests at any input
size; their number grows with the data.

A null text counts as empty. Rows with the same id count as copies of one document; a null
id loses against any other. Empty inputs give empty results. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import BLANK, shards_for, staged, text_of

SHARD_ROWS = 200_000
LEVEL_LOAD = 1.5
MAX_LEVELS = 80
INDEX = "shard long, sizes binary, bits binary, digests binary, locators binary"
LOCATOR = np.dtype([("length", "<i8"), ("absent", "?"), ("id", "<i8"), ("n", "<i8")])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, length): SHA-256 of the text without blanks, code points of the text."""
    return docs.select(
        F.col(key).cast("long").alias("id"),
        F.unhex(F.sha2(F.regexp_replace(text_of(text), f"{BLANK}+", "").cast("binary"), 256)).alias("digest"),
        F.char_length(text_of(text)).cast("long").alias("length"),
    )


def winners(rows: DataFrame) -> DataFrame:
    """Per digest: the longest row, then the smallest id, and the number of rows."""
    best = F.min(F.struct((-F.col("length")).alias("rank"), F.col("id").isNull().alias("absent"), "id"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
        .select("digest", (-F.col("best.rank")).alias("length"), "best.absent", "best.id", "n")
    )


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


def _keys(digest_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = digest_bytes.view("<u8").reshape(-1, 4)
    return words[:, 0], words[:, 1] | np.uint64(1)


def _place(keys: tuple[np.ndarray, np.ndarray], level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys[0] + keys[1] * np.uint64(level * 2 + 1)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def perfect_hash(digest_bytes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bit map, and the slot of each distinct digest."""
    rest = np.arange(len(digest_bytes) // 32)
    slots = np.empty(len(rest), "<i8")
    h0, h1 = _keys(digest_bytes)
    sizes, maps, taken = [], [], 0
    while len(rest):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("repeated digests in a shard of the index")
        size = int(len(rest) * LEVEL_LOAD) + 64
        place = _place((h0[rest], h1[rest]), len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        fits = alone[place]
        rank = np.cumsum(alone) - 1
        slots[rest[fits]] = taken + rank[place[fits]]
        taken += int(alone.sum())
        sizes.append(size)
        maps.append(alone)
        rest = rest[~fits]
    return sizes, np.concatenate(maps) if maps else np.empty(0, bool), slots


def find_slots(digest_bytes: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot the hash gives for each digest; -1 where no level takes it."""
    slots = np.full(len(digest_bytes) // 32, -1, "<i8")
    rest, offset = np.arange(len(slots)), 0
    rank = np.cumsum(bits) - 1
    h0, h1 = _keys(digest_bytes)
    for level, size in enumerate(sizes):
        place = _place((h0[rest], h1[rest]), level, int(size)).astype("<i8") + offset
        hit = bits[place]
        slots[rest[hit]] = rank[place[hit]]
        rest = rest[~hit]
        offset += int(size)
    return slots


def _joined(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    raw = _joined(rows["digest"])
    sizes, bits, slots = perfect_hash(raw)
    ordered, locators = np.empty((len(rows), 32), np.uint8), np.empty(len(rows), LOCATOR)
    ordered[slots] = raw.reshape(-1, 32)
    for name, values in (("length", rows["length"]), ("absent", rows["absent"]), ("id", rows["id"].fillna(0)), ("n", rows["n"])):
        locators[name][slots] = values
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "sizes": [np.array(sizes, "<i8").tobytes()],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [ordered.tobytes()],
            "locators": [locators.tobytes()],
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard from the ``winners`` of a history."""
    rows = history.withColumn("id", F.coalesce("id", F.lit(0))).withColumn("shard", _shard(shards))
    return rows.groupBy("shard").applyInPandas(_build_shard, INDEX)


def _look_up_shard(found: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame({"digest": found["digest"], "member": False, "length": 0, "absent": False, "id": 0, "n": 0})
    if len(index) and len(found):
        row = index.iloc[0]
        sizes = np.frombuffer(row["sizes"], "<i8")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        raw = _joined(found["digest"])
        slots = find_slots(raw, sizes, bits)
        member = (slots >= 0) & (stored[slots] == raw.reshape(-1, 32)).all(axis=1)
        hit = np.frombuffer(row["locators"], LOCATOR)[np.where(member, slots, 0)]
        out["member"] = member
        for name in ("length", "absent", "id", "n"):
            out[name] = np.where(member, hit[name], 0)
        out["absent"] = out["absent"].astype(bool)
    return out


def look_up(found: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(digest, member, and for members the length, id and count of the historical winner).

    ``found`` has distinct digests.
    """
    rows = found.select("digest", _shard(shards).alias("shard"))
    out = "digest binary, member boolean, length long, absent boolean, id long, n long"
    return rows.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up_shard, out)


def dedup(history: DataFrame, arrived: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per digest of both inputs (as ``digests`` gives them): id of the row that stays, rows.

    Runs jobs: the winners of both sides, the index and the answers are staged.
    """
    old = staged(winners(history), "digest-history")
    new = staged(winners(arrived), "digest-arrived")
    shards = shards_for(max(old.count(), new.count()), shard_rows)
    index = staged(build_index(old, shards), "digest-index")
    answers = look_up(new, index, shards).withColumn("id", F.when(~F.col("absent"), F.col("id")))
    # A member brings its historical winner along; others stand for themselves.
    past = F.struct((-F.col("a.length")).alias("rank"), F.col("a.absent").alias("absent"), F.col("a.id").alias("id"))
    here = F.struct((-F.col("b.length")).alias("rank"), F.col("b.absent").alias("absent"), F.col("b.id").alias("id"))
    met = staged(
        answers.alias("a")
        .join(new.alias("b"), "digest")
        .select(
            "digest",
            "member",
            F.when(F.col("member"), F.least(past, here)).otherwise(here).getField("id").alias("keep_id"),
            (F.col("a.n") + F.col("b.n")).alias("group_size"),
        ),
        "digest-met",
    )
    silent = old.join(met.filter("member"), "digest", "left_anti")
    return silent.select("digest", F.col("id").alias("keep_id"), F.col("n").alias("group_size")).unionByName(met.drop("member"))


def mark(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with the row of its group that stays. ``rows`` as ``digests`` gives them."""
    return rows.join(groups, "digest").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Marks all ``docs``; those of the lower half of the id range are the history."""
    rows = staged(digests(docs, key, text), "digests")
    middle = rows.agg(((F.min("id") / 2 + F.max("id") / 2)).cast("long")).first()[0]
    old = F.coalesce(F.col("id") <= F.lit(middle).cast("long"), F.lit(False))
    return mark(rows, dedup(rows.filter(old), rows.filter(~old)))
