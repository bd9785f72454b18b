"""N-grams and multiset overlap inside one row.

Overlap counts ``min(count in a, count in b)`` over all items. The usual form, explode
both sides and group by (row, item), ships every n-gram of every text through a
shuffle: about eight times the text volume for n = 1..4. Both arrays of a pair are
already in the same row, so here the k-th copy of an item is tagged with k and the
overlap is a set intersection: no exchange at all, linear after one sort.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from regforge.functions.columns import bind

_MARK = "\u0001"


def ngrams(tokens: Column, n: int) -> Column:
    """Consecutive ``n`` tokens joined by a blank, in order."""
    if n == 1:
        return tokens

    def grams(words: Column) -> Column:
        starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
        return F.transform(
            starts, lambda word, i: F.concat_ws(" ", word, *[F.get(words, i + k) for k in range(1, n)])
        )

    return bind(tokens, grams)


def ngram_count(tokens: Column, n: int) -> Column:
    return F.greatest(F.size(tokens) - (n - 1), F.lit(0)).cast("long")


def numbered_copies(items: Column) -> Column:
    """Every item with its copy number, so that equal items become distinct."""

    def tag(ordered: Column) -> Column:
        # Index of the first copy of each distinct item.
        firsts = F.array_compact(
            F.transform(ordered, lambda item, i: F.when((i == 0) | (item != F.get(ordered, i - 1)), i))
        )
        return bind(
            firsts,
            lambda first: F.flatten(
                F.transform(
                    first,
                    lambda start, j: F.transform(
                        F.slice(
                            ordered,
                            start + 1,
                            F.coalesce(F.get(first, j + 1), F.size(ordered)) - start,
                        ),
                        lambda item, copy: F.concat_ws(_MARK, copy.cast("string"), item),
                    ),
                )
            ),
        )

    return bind(F.sort_array(items), tag)


def _further_copies(items: Column) -> Column:
    """Every copy of an item but its first."""
    return bind(
        F.sort_array(items),
        lambda ordered: F.filter(ordered, lambda item, i: (i > 0) & (item == F.get(ordered, i - 1))),
    )


def _repeats(items: Column) -> Column:
    return F.size(F.array_distinct(items)) < F.size(items)


def multiset_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection.

    First copies meet in a set intersection. Only if both sides repeat something, which
    is rare for n > 1, the further copies are numbered and compared too.
    """

    def overlap(both: Column) -> Column:
        a, b = both["a"], both["b"]
        further = F.size(
            F.array_intersect(
                numbered_copies(_further_copies(a)), numbered_copies(_further_copies(b))
            )
        )
        return F.size(F.array_intersect(a, b)) + F.when(_repeats(a) & _repeats(b), further).otherwise(0)

    return bind(F.struct(left.alias("a"), right.alias("b")), overlap).cast("long")
