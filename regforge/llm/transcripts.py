"""Transcript parsing by a hidden Markov model, and canonical rendering of the turns.

A transcript is a table of lines. The hidden state of a line is a role, and whether the
line begins a turn. What is observed is a symbol: the kind of speaker marker the line
starts with, its length, and whether it ends in a question mark. Start, transition and
emission probabilities are counted in Spark over lines whose turns are known.

Roles are recovered by Viterbi. The lines are dealt into ranges of their order and cut into
blocks of at most ``BLOCK`` lines, whatever their places are, so a transcript whose lines
have no place, or all the same, is cut like any other. For a transcript of several blocks,
the block's best scores between any two states form a matrix, the matrices of a transcript
(one row per block) give the states at the cuts, and the blocks are then decoded apart
with those ends. The result is that of one pass over the whole transcript, and no task
holds more than one block of it. Turns are rendered with their marker removed.

A null text is one empty line; null ids form one transcript, null places come first.
Lines of equal place and number come in the order of a hash of the line. Repeated rows are
lines of their own. An empty table gives no row; without examples all
states are equally likely. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regforge.functions.columns import explode_rows
from regforge.llm.common import fold, staged

ROLES = ("user", "assistant", "system")
#: States 0 to 2 begin a turn of the role, 3 to 5 go on with it.
STATES = 2 * len(ROLES)
BLOCK = 512
#: Transcripts whose crc32 of the id leaves ``HELD_OUT`` are not learned from.
FOLDS, HELD_OUT = 4, 2
LENGTHS = (0, 20, 60, 140, 280)
MARKERS = (
    r"^\s*(?:\*\*|\[|<\|?|#+ )?\s*(?:user|human|customer|question|q|me)\s*(?:\*\*|\]|\|?>)?\s*[:>]\s*",
    r"^\s*(?:\*\*|\[|<\|?|#+ )?\s*(?:assistant|ai|bot|model|answer|a|agent)\s*(?:\*\*|\]|\|?>)?\s*[:>]\s*",
    r"^\s*(?:\*\*|\[|<\|?|#+ )?\s*(?:system|instructions?|context)\s*(?:\*\*|\]|\|?>)?\s*[:>]\s*",
    r"^\s*[\p{L}][\p{L} ]{0,20}:\s*",
)
SYMBOLS = (len(MARKERS) + 1) * (len(LENGTHS) + 1) * 2
#: How raw transcripts name a role, for transcripts made of turns with known roles.
SPELLINGS = {
    "user": ("User: ", "Human: ", "**User:** ", "Q: ", "> ", "\n"),
    "assistant": ("Assistant: ", "AI: ", "[assistant]: ", "A: ", "\n", "\n"),
    "system": ("System: ", "### Instructions: ", "[system]: ", "\n"),
}


def symbol(line: Column) -> Column:
    kind = F.lit(0)
    for i, marker in reversed(list(enumerate(MARKERS, 1))):
        kind = F.when(F.regexp_like(line, F.lit("(?i)" + marker)), i).otherwise(kind)
    length = sum((F.length(line) > n).cast("int") for n in LENGTHS)
    return (kind * (len(LENGTHS) + 1) + length) * 2 + F.rtrim(line).endswith("?").cast("int")


def unmarked(line: Column) -> Column:
    """The line without a known speaker marker."""
    for marker in MARKERS[:3]:
        line = F.regexp_replace(line, "(?i)" + marker, "")
    return line


def transcript_lines(turns: DataFrame) -> DataFrame:
    """Lines of transcripts made of turns (conv_id, turn, role, text).

    A role is spelled in one of several ways, or only set apart by an empty line, by a hash
    of the turn. The role and whether the line begins a turn stay along as ``role`` and ``begins``.
    """
    role = F.when(F.col("role").isin(*ROLES), F.col("role"))
    mark = F.lit("")
    for name, ways in SPELLINGS.items():
        pick = F.element_at(F.array(*[F.lit(w) for w in ways]), (F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(len(ways))) + 1).cast("int"))
        mark = F.when(F.col("role") == name, pick).otherwise(mark)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.split(F.concat(mark, F.coalesce("text", F.lit(""))), "\n").alias("lines"),
    )
    return explode_rows(rows, "lines", "line", keep=["conv_id", "turn", "role"], position="line_no").withColumn("begins", F.col("line_no") == 0)


@dataclass
class MarkovModel:
    """Log-probabilities: of the first state, from state to state, of a symbol by state."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def _state(role: Column, begins: Column) -> Column:
    index = F.lit(None).cast("int")
    for i, name in enumerate(ROLES):
        index = F.when(role == name, i).otherwise(index)
    return index + F.when(begins, 0).otherwise(len(ROLES))


def train(lines: DataFrame) -> MarkovModel:
    """Counts the model over lines with ``role`` and ``begins``. Runs jobs."""
    known = lines.withColumn("state", _state(F.col("role"), F.col("begins"))).filter("state is not null")
    emit, step, start = np.full((STATES, SYMBOLS), 0.1), np.full((STATES, STATES), 0.05), np.full(STATES, 0.05)
    for r in known.groupBy("state", symbol(F.col("line")).alias("symbol")).count().collect():
        emit[r["state"], r["symbol"]] += r["count"]
    # Inside a turn and from a turn to the next one, which has the next place: joins of narrow rows, no window.
    turns = known.groupBy("conv_id", "turn").agg(F.max("line_no").alias("last"), F.min("role").alias("role")).filter("turn is not null")
    turns = staged(turns.withColumn("first", _state(F.col("role"), F.lit(True))), "turns")
    for r in turns.groupBy("first").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("last") > 0).cast("long")).alias("longer"), F.sum(F.greatest(F.col("last") - 1, F.lit(0))).alias("more")).collect():
        go_on = r["first"] + len(ROLES)
        step[r["first"], go_on] += r["longer"]
        step[go_on, go_on] += r["more"]
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("first").alias("second"))
    moves = turns.join(after, ["conv_id", "turn"]).groupBy("first", (F.col("last") > 0).alias("long"), "second").count()
    for r in moves.collect():
        step[r["first"] + len(ROLES) * r["long"], r["second"]] += r["count"]
    lowest = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "first")).alias("m"))
    for r in lowest.groupBy(F.col("m.first").alias("first")).count().collect():
        start[r["first"]] += r["count"]
    scaled = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return MarkovModel(scaled(start), scaled(step), scaled(emit))


def block_matrix(model: MarkovModel, symbols: np.ndarray) -> np.ndarray:
    """Best score from the state before the block (row; the last row is the start) to its end."""
    best = np.concatenate([model.step, model.start[None]]) + model.emit[:, symbols[0]]
    for s in symbols[1:]:
        best = (best[:, :, None] + model.step[None]).max(1) + model.emit[:, s]
    return best


def decode(model: MarkovModel, symbols: np.ndarray, before: int = -1, last: int = -1) -> np.ndarray:
    """The best states of a block, given the state before it (-1: none) and its last state."""
    score = (model.start if before < 0 else model.step[before]) + model.emit[:, symbols[0]]
    back = np.zeros((len(symbols), STATES), np.int8)
    for i, s in enumerate(symbols[1:], 1):
        move = score[:, None] + model.step
        back[i] = move.argmax(0)
        score = move.max(0) + model.emit[:, s]
    out = np.empty(len(symbols), np.int64)
    out[-1] = score.argmax() if last < 0 else last
    for i in range(len(symbols) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one block after another, from sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[["conv_id", "block"]]
        changed = (keys != keys.shift()).to_numpy() & ~(keys.isna() & keys.shift().isna()).to_numpy()
        cuts = np.flatnonzero(changed.any(axis=1))
        cuts = np.unique(np.concatenate([[0], cuts, [len(batch)]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.iloc[a:b]
            if held:
                x, y = held[-1].iloc[-1], part.iloc[0]
                same = x["block"] == y["block"] and (x["conv_id"] == y["conv_id"] or (pd.isna(x["conv_id"]) and pd.isna(y["conv_id"])))
                if not same:
                    yield pd.concat(held)
                    held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _matrices(model: MarkovModel, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _blocks(batches):
        best = block_matrix(model, rows["symbol"].to_numpy())
        yield pd.DataFrame({"conv_id": rows["conv_id"].iloc[:1], "block": rows["block"].iloc[:1], "matrix": [best.reshape(-1).tolist()]})


def _ends(rows: pd.DataFrame) -> pd.DataFrame:
    """The states at the cuts of one transcript, by Viterbi over its blocks."""
    rows = rows.sort_values("block")
    matrices = [np.array(m).reshape(STATES + 1, STATES) for m in rows["matrix"]]
    score, back = matrices[0][STATES], [np.zeros(STATES, int)]
    for m in matrices[1:]:
        move = score[:, None] + m[:STATES]
        back.append(move.argmax(0))
        score = move.max(0)
    last = [int(score.argmax())]
    for b in back[:0:-1]:
        last.append(int(b[last[-1]]))
    last.reverse()
    return pd.DataFrame({"conv_id": rows["conv_id"], "block": rows["block"], "before": [-1, *last[:-1]], "last": last})


TURNS = "conv_id long, block long, part long, role string, text string, n_lines long, turn long, starts boolean"


def _parse(model: MarkovModel, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _blocks(batches):
        states = decode(model, rows["symbol"].to_numpy(), int(rows["before"].iloc[0]), int(rows["last"].iloc[0]))
        starts = states < len(ROLES)
        starts[1:] |= states[1:] % len(ROLES) != states[:-1] % len(ROLES)
        first = starts.copy()
        first[0] = True
        cuts = np.append(np.flatnonzero(first), len(rows))
        lines, bare, turn = rows["line"].tolist(), rows["bare"].tolist(), rows["turn"]
        yield pd.DataFrame(
            {
                "conv_id": [rows["conv_id"].iloc[0]] * (len(cuts) - 1),
                "block": rows["block"].iloc[0],
                "part": np.arange(len(cuts) - 1),
                "role": [ROLES[states[a] % len(ROLES)] for a in cuts[:-1]],
                "text": ["\n".join([bare[a] if starts[a] else lines[a], *lines[a + 1 : b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                "n_lines": np.diff(cuts),
                "turn": turn.iloc[cuts[:-1]].tolist(),
                "starts": [bool(starts[a]) or int(rows["before"].iloc[0]) < 0 for a in cuts[:-1]],
            }
        )


def _in_blocks(lines: DataFrame) -> DataFrame:
    """The lines with ``tie`` and ``block``: ids that rise with the order of the lines."""
    # Equal rows may be any number, so their number decides too where a range ends.
    rows = lines.withColumn("tie", F.xxhash64("line")).withColumn("number", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "line_no", "tie", "number"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.withColumn("block", F.floor(F.monotonically_increasing_id() / F.lit(BLOCK)).cast("long")).drop("number")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "line_no", "tie")


def parse(lines: DataFrame, model: MarkovModel) -> DataFrame:
    """conv_id, position, role, text, rendered, n_lines, turn (of the first line), continued.

    ``lines`` has conv_id, turn, line_no and line. Positions of a transcript count from 0.
    A turn that goes on over a cut between blocks comes in parts, the later ones continued.
    """
    rows = _in_blocks(lines.select("conv_id", "turn", "line_no", "line"))
    rows = staged(rows.select("*", symbol(F.col("line")).alias("symbol"), unmarked(F.col("line")).alias("bare")), "lines")
    several = rows.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high").select(F.col("conv_id").alias("id"))
    long_ = rows.join(several, rows.conv_id.eqNullSafe(several.id), "left_semi")
    matrices = _dealt(long_).mapInPandas(functools.partial(_matrices, model), "conv_id long, block long, matrix array<double>")
    ends = matrices.groupBy("conv_id").applyInPandas(_ends, "conv_id long, block long, before int, last int")
    ends = staged(ends.select(F.col("conv_id").alias("id"), F.col("block").alias("id_block"), "before", "last"), "ends")
    cut = rows.join(ends, rows.conv_id.eqNullSafe(ends.id) & (rows.block == ends.id_block), "left")
    cut = cut.select(*rows.columns, F.coalesce("before", F.lit(-1)).alias("before"), F.coalesce("last", F.lit(-1)).alias("last"))
    parts = staged(_dealt(cut).mapInPandas(functools.partial(_parse, model), TURNS), "parts")
    sizes = parts.groupBy(F.col("conv_id").alias("id"), F.col("block").alias("id_block")).agg(F.count(F.lit(1)).alias("n"))
    # One row per block of a transcript.
    order = Window.partitionBy("id").orderBy("id_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("id", "id_block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("earlier"))
    found = parts.join(sizes, parts.conv_id.eqNullSafe(sizes.id) & (parts.block == sizes.id_block))
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), F.trim("text"), F.lit("\n<|end|>"))
    return found.select(
        "conv_id", (F.col("earlier") + F.col("part")).alias("position"), "role", "text", rendered.alias("rendered"), "n_lines", "turn", (~F.col("starts")).alias("continued")
    )


def held_out() -> Column:
    """Transcripts whose lines the model is not trained on."""
    return fold(F.col("conv_id"), FOLDS) == HELD_OUT


def parse_conversations(turns: DataFrame) -> DataFrame:
    """Turns to raw transcripts, and back by a model trained on those not held out."""
    lines = staged(transcript_lines(turns), "transcripts")
    return parse(lines, train(lines.filter(~held_out())))
