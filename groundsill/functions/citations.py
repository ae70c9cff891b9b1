"""Citation anchors, answer units, factual statements, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundsill import fixed
from groundsill.functions.text import WORD_END, WORD_START, any_of, strip

ANCHOR = r"\[C(\d+)\]"


def cited_numbers(text: Column) -> Column:
    """Distinct anchor numbers in ascending order, kept as strings without a leading zero."""
    digits = F.regexp_extract_all(text, F.lit(ANCHOR), 1)
    plain = F.transform(digits, lambda d: F.regexp_replace(d, r"^0+(?=\d)", ""))
    # Length first, then digits, is numeric order for any number of digits.
    keyed = F.transform(plain, lambda d: F.struct(F.length(d).alias("n"), d.alias("d")))
    return F.transform(F.array_sort(F.array_distinct(keyed)), lambda k: k["d"])


def cited_markers(text: Column) -> Column:
    """Distinct markers as written; ``[C1]`` and ``[C01]`` count as two."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(ANCHOR), 0))


def cited_anchors(text: Column) -> Column:
    return F.transform(cited_numbers(text), lambda d: F.concat(F.lit("C"), d))


def has_fact(text: Column) -> Column:
    """A date, a past-tense work verb as a whole word, or an asset identifier."""
    low = F.lower(text)
    date = text.rlike(rf"{WORD_START}\d{{4}}-\d{{2}}-\d{{2}}{WORD_END}")
    verb = low.rlike(rf"(?<![a-z_])(?:{any_of(fixed.FACT_VERBS)})(?![a-z_])")
    asset = low.rlike(any_of(fixed.FACT_FRAGMENTS))
    return date | verb | asset


def answer_units(text: Column, sentences: bool = False) -> Column:
    """Statements to check one by one.

    By default a unit is a numbered list item or a paragraph; with ``sentences`` the text is
    cut after ``.``, ``?`` and ``!`` instead.
    """
    if sentences:
        pieces = F.split(text, r"(?<=[.?!])")
    else:
        items = F.split(strip(text), r"\n(?=\s*\d+\.)")
        pieces = F.flatten(F.transform(items, lambda item: F.split(strip(item), r"\n\s*\n")))
    return F.filter(F.transform(pieces, strip), lambda unit: unit != "")


def after_last_citation(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)^.*\[C\d+\]", "")


def uncited_part(unit: Column) -> Column:
    """The offending part of a factual unit, or null when the unit is well supported."""
    tail = after_last_citation(unit)
    return F.when(
        has_fact(unit),
        F.when(~unit.rlike(ANCHOR), unit).when(has_fact(tail), tail),
    )


def uncited_parts(text: Column, sentences: bool = False) -> Column:
    return F.filter(
        F.transform(answer_units(text, sentences), uncited_part), lambda part: part.isNotNull()
    )


def id_tokens(text: Column, min_chars: int = 7) -> Column:
    """Whole words of ASCII letters, digits and underscores of at least ``min_chars``."""
    pattern = rf"{WORD_START}[A-Za-z0-9_]{{{min_chars},}}{WORD_END}"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))


def suspicious_ids(text: Column, min_chars: int = 7) -> Column:
    """Identifier-like words that carry one of the asset prefixes, sorted."""
    return F.array_sort(
        F.filter(id_tokens(text, min_chars), lambda t: t.rlike(any_of(fixed.ID_PREFIXES)))
    )
