"""Text functions. Whitespace and word characters follow Unicode, not ASCII."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import as_column, bind, fill

# The Unicode property is several times faster than a class of listed code points.
WHITESPACE = r"[\p{IsWhite_Space}\x1C-\x1F]"
NON_WHITESPACE = r"[^\p{IsWhite_Space}\x1C-\x1F]"
NON_WORD = r"[^\p{L}\p{N}_]+"
#: The characters of ``WHITESPACE`` one by one, for trimming without a regular expression.
BLANK_CHARACTERS = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def normalized(text: str | Column) -> Column:
    """Lower case, every run of non-word characters one blank, no blanks at the ends."""
    return F.trim(F.regexp_replace(F.lower(as_column(text)), NON_WORD, " "))


def stripped(value: str | Column) -> Column:
    """Text without whitespace (any) at its ends."""
    return F.trim(as_column(value).cast("string"), F.lit(BLANK_CHARACTERS))


def clean_name(value: str | Column) -> Column:
    """A name without whitespace (any) at its ends; NULL if nothing is left.

    Every side of a join by name goes through it, once: where the name enters.
    """
    return F.nullif(stripped(value), F.lit(""))


def folded(text: str | Column) -> Column:
    """Trim (any whitespace) and lower case."""
    return F.lower(stripped(text))


def tokens(text: str | Column) -> Column:
    """Whitespace tokens; [] for blank or NULL text."""
    text = F.coalesce(as_column(text), F.lit(""))
    return F.array_remove(F.split(text, WHITESPACE + "+"), "")


def word_tokens(text: str | Column) -> Column:
    """Tokens of the normalised text."""
    return F.array_remove(F.split(F.lower(F.coalesce(as_column(text), F.lit(""))), NON_WORD), "")


def alphanumeric_tokens(text: str | Column) -> Column:
    """Lower-cased ASCII letter and digit runs, the tokenisation ROUGE is defined on."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)
    )


def structure_candidates(
    text: str | Column,
    pattern: str = C.STRUCTURE_PATTERN,
    longer_than: int = C.MIN_CANDIDATE_LENGTH,
) -> Column:
    """Substrings that look like a structure and are longer than ``longer_than``."""
    found = F.regexp_extract_all(as_column(text), F.lit(pattern), F.lit(0))
    return F.filter(found, lambda item: F.length(item) > longer_than)


def keyword_hits(text: str | Column, keywords: Column) -> Column:
    """Number of keywords that occur in the text, ignoring case. The text is lower-cased
    once, not once per keyword."""
    lowered = F.lower(F.coalesce(as_column(text), F.lit("")))
    listed = F.coalesce(keywords, F.array().cast("array<string>"))
    hits = bind(lowered, lambda low: F.size(F.filter(listed, lambda word: F.contains(low, F.lower(word)))))
    return hits.cast("long")


def shared_words(text: Column, other: Column, words: Iterable[str]) -> Column:
    """True if one of ``words`` occurs in both texts. Written out per word, so it is
    plain code-generated string search without array lambdas."""
    both = F.lit(False)
    for word in words:
        both = both | (F.contains(text, F.lit(word)) & F.contains(other, F.lit(word)))
    return both


def prompt(
    instruction: str | Column, input_text: str | Column, output: str | Column | None = None,
    blank_input: bool = False,
) -> Column:
    """Rendered prompt, with the answer if ``output`` is given. The comparison of models
    keeps the input section also where the input is blank: ``blank_input``."""
    values = {
        "instruction": F.coalesce(as_column(instruction), F.lit("")),
        "input": F.coalesce(as_column(input_text), F.lit("")),
        "output": F.lit("") if output is None else F.coalesce(as_column(output), F.lit("")),
    }
    if blank_input:
        return fill(C.PROMPT_WITH_INPUT, **values)
    return F.when(values["input"] != "", fill(C.PROMPT_WITH_INPUT, **values)).otherwise(
        fill(C.PROMPT_WITHOUT_INPUT, **values)
    )


def response_part(text: str | Column, marker: str = C.RESPONSE_MARKER) -> Column:
    """Text after the last marker, trimmed; the text itself if there is no marker."""
    text = as_column(text)
    tail = stripped(F.substring_index(text, marker, -1))
    return F.when(F.contains(text, F.lit(marker)), tail).otherwise(text)


def excerpt(text: str | Column, characters: int = C.SAMPLE_CHARACTERS) -> Column:
    """Report form of a text: cut, with dots, if longer than ``characters``."""
    text = as_column(text)
    cut = F.concat(F.substring(text, 1, characters), F.lit("..."))
    return F.when(F.length(text) > characters, cut).otherwise(text)
