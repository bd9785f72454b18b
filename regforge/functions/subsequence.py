"""Longest common subsequence scores, the one thing built-ins cannot express well.

An Arrow batch function over whole texts, no token cap: one table row is a single
Python integer used as a bit set, so a pair costs ``len(a) * len(b) / 64`` word
operations (Hyyrö's bit-parallel recurrence). Helpers are nested so that executors
need nothing but pandas to run it.
"""

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from regforge.functions.columns import as_column

RESULT = "lcs long, line_hits long, prediction_tokens long, reference_tokens long"


def _alphanumeric_lines(text: Column) -> Column:
    """Lower-cased alphanumeric tokens separated by blanks, line ends kept."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9\n]+", " ")


def subsequence_counts(prediction: str | Column, reference: str | Column) -> Column:
    """Struct of ``lcs`` (whole text), ``line_hits`` (union of per-line subsequences,
    counts clipped) and both token counts."""
    import pandas as pd

    def table_rows(ref: list, pred: list) -> Iterator[int]:
        """Bit rows of the table: in row i, bit j is 0 where the value grows at j."""
        where: dict = {}
        for j, token in enumerate(pred):
            where[token] = where.get(token, 0) | (1 << j)
        full = (1 << len(pred)) - 1
        state = full
        yield state
        for token in ref:
            hit = state & where.get(token, 0)
            state = ((state + hit) | (state - hit)) & full
            yield state

    def length(ref: list, pred: list) -> int:
        state = 0
        for state in table_rows(ref, pred):  # only the last row is kept
            pass
        return len(pred) - state.bit_count()

    def positions(ref: list, pred: list) -> list:
        """Reference positions of one longest common subsequence; where the table
        allows both steps the reference position is skipped first."""
        rows = list(table_rows(ref, pred))
        i, j, found = len(ref), len(pred), []

        def value(i: int, j: int) -> int:
            return j - (rows[i] & ((1 << j) - 1)).bit_count()

        while i and j:
            if ref[i - 1] == pred[j - 1]:
                found.append(i - 1)
                i, j = i - 1, j - 1
            elif value(i, j - 1) > value(i - 1, j):
                j -= 1
            else:
                i -= 1
        return found

    def line_hits(ref_lines: list, pred_lines: list) -> int:
        left_ref: dict = {}
        left_pred: dict = {}
        for lines, left in ((ref_lines, left_ref), (pred_lines, left_pred)):
            for line in lines:
                for token in line:
                    left[token] = left.get(token, 0) + 1
        # Equal candidate lines hit the same positions.
        candidates = [(line, set(line)) for line in dict.fromkeys(map(tuple, pred_lines))]
        hits = 0
        for line in ref_lines:
            words = set(line)
            union: set = set()
            for candidate, candidate_words in candidates:
                if not words.isdisjoint(candidate_words):
                    union.update(positions(line, candidate))
            for i in sorted(union):
                token = line[i]
                if left_ref.get(token, 0) and left_pred.get(token, 0):
                    hits += 1
                    left_ref[token] -= 1
                    left_pred[token] -= 1
        return hits

    @F.pandas_udf(RESULT)
    def score(predictions: pd.Series, references: pd.Series) -> pd.DataFrame:
        out = []
        for pred_text, ref_text in zip(predictions, references):
            pred_lines = [line.split() for line in pred_text.split("\n")]
            ref_lines = [line.split() for line in ref_text.split("\n")]
            pred = [token for line in pred_lines for token in line]
            ref = [token for line in ref_lines for token in line]
            out.append((length(ref, pred), line_hits(ref_lines, pred_lines), len(pred), len(ref)))
        return pd.DataFrame(
            out, columns=["lcs", "line_hits", "prediction_tokens", "reference_tokens"]
        )

    return score(
        _alphanumeric_lines(as_column(prediction)), _alphanumeric_lines(as_column(reference))
    )
