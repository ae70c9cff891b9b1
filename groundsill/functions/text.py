"""Text columns: cleaning, gates, token estimates, shingles."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundsill import fixed
from groundsill.functions import bind

# White space as Unicode defines it; the regex engine's own \s is ASCII only.
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(code) for code in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
CONTROL_CHARS = "".join(chr(c) for c in range(32) if chr(c) not in SPACE_CHARS) + "\x7f"


def blank(text: Column, chars: str) -> Column:
    """Each of ``chars`` replaced by a blank. Far cheaper than a regex over many characters."""
    return F.translate(text, chars, " " * len(chars))


def any_of(words: list[str]) -> str:
    """A regex alternation of literal words."""
    return "|".join(re.escape(word).replace(r"\ ", " ") for word in words)


def contains_any(text: Column, words: list[str]) -> Column:
    """True when the lower-cased text contains one of the words."""
    return F.lower(text).rlike(any_of(words))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def sanitize(text: Column) -> Column:
    """Control characters to blanks, white space collapsed, ends trimmed. Wording is kept."""
    return F.trim(F.regexp_replace(blank(text, CONTROL_CHARS + SPACE_CHARS), " {2,}", " "))


def is_noise(text: Column, min_chars: int = 200, min_letter_share: float = 0.10,
             repeat: int = 30) -> Column:
    """Empty, or long with hardly any letters, or one character repeated past ``repeat``."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    mostly_symbols = (F.length(text) >= min_chars) & (
        letters / F.greatest(F.length(text), F.lit(1)) < min_letter_share
    )
    return (text == "") | mostly_symbols | has_repeat(text, repeat)


def has_repeat(text: Column, repeat: int) -> Column:
    """One character followed by itself at least ``repeat`` times."""
    return text.rlike(rf"([^\n])\1{{{repeat},}}")


def has_injection(text: Column) -> Column:
    """Text that tries to give instructions to a model."""
    return contains_any(text, fixed.INJECTION_PHRASES)


def tokens_chars4(text: Column) -> Column:
    """Characters after collapsing white space, divided by four, cut to an integer."""
    # A single blank of any kind counts one either way, so only longer runs are replaced.
    collapsed = F.regexp_replace(text, r"\s\s+", " ")
    return (F.length(collapsed) / fixed.CHARS_PER_TOKEN).cast("int")


def words(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(blank(text, SPACE_CHARS), " "), lambda word: word != "")


def tokens_words(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text))


def tokens_words13(text: Column) -> Column:
    """Words times 1.3, cut to an integer: a deliberate over-estimate."""
    return F.floor(F.size(words(text)) * F.lit(1.3)).cast("int")


def shingles(text: Column, width: int = 5) -> Column:
    """Distinct runs of ``width`` words; a shorter text is one shingle, an empty one has none."""
    return word_shingles(words(text), width)


def word_shingles(tokens: Column, width: int = 5) -> Column:
    """The same for a text that is already an array of words."""

    def windows(tokens: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens) - (width - 1))
        runs = F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + (j - 1)) for j in range(width)])
        )
        return (
            F.when(F.size(tokens) == 0, F.expr("cast(array() as array<string>)"))
            .when(F.size(tokens) < width, F.array(F.array_join(tokens, " ")))
            .otherwise(F.array_distinct(runs))
        )

    return bind(tokens, windows)


def jaccard(left: Column, right: Column) -> Column:
    """Shared share of two sets of shingles; two empty sets are equal."""
    def share(shared: Column) -> Column:
        union = F.size(left) + F.size(right) - shared
        return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)

    return bind(F.size(F.array_intersect(left, right)), share)


def overlap_key(ordered: Column, threshold: float) -> Column:
    """The leading part of a sorted set that any set with ``jaccard >= threshold`` must meet.

    Two such sets share at least ``threshold`` of either one, so they cannot both have all
    shared members past this many leading ones. Rounding the share down errs on the long side.
    """
    size = F.size(ordered)
    return F.slice(ordered, 1, F.greatest(size - F.floor(size * threshold).cast("int") + 1,
                                          F.lit(1)))


def overlaps(left: Column, right: Column, left_key: Column, right_key: Column,
             threshold: float) -> Column:
    """``jaccard >= threshold`` of two sets with their keys; most pairs end at a cheap test."""
    smaller = F.least(F.size(left), F.size(right))
    larger = F.greatest(F.size(left), F.size(right))
    # The share can never exceed smaller / larger.
    possible = (larger == 0) | (
        (smaller / F.greatest(larger, F.lit(1)) >= threshold)
        & F.arrays_overlap(left_key, right_key)
    )
    return F.when(possible, jaccard(left, right) >= threshold).otherwise(False)


# A digest keeps the number of its members in these low bits.
_COUNT_BITS = 12
_COUNT = (1 << _COUNT_BITS) - 1
_HALF = 32


def _digest(members: Column, count: Column) -> Column:
    return F.shiftleft(members, _COUNT_BITS).bitwiseOR(count)


def set_digests(ordered: Column) -> Column:
    """A sorted set of 64-bit hashes in short: cut into ranges of equal width, one number per range.

    Hashes are spread evenly, so a range holds 16 at most on average; there are 64 ranges at least and
    their number is a power of two. A range's digest is the exclusive or of its members (52 bits of it)
    and their number, 0 for none. A large set takes about a number for twelve members.
    """

    def digests(sized: Column) -> Column:
        ranges = F.call_function("shiftleft", F.lit(1), sized["bits"])
        low = F.lit(64) - sized["bits"]

        def closed(state: Column, until: Column) -> Column:
            """What is there and the open range, then empty ones up to ``until``."""
            return F.concat(state["out"], F.array(_digest(state["members"], state["count"])),
                            F.array_repeat(F.lit(0).cast("bigint"), until - F.size(state["out"]) - 1))

        def step(state: Column, hashed: Column) -> Column:
            # The open range is the one after those that are closed.
            place = F.call_function("shiftright", hashed, low).cast("int") + F.shiftright(ranges, 1)
            return F.when(place == F.size(state["out"]), F.struct(
                state["members"].bitwiseXOR(hashed).alias("members"),
                (state["count"] + 1).alias("count"), state["out"].alias("out"))
            ).otherwise(F.struct(
                hashed.alias("members"), F.lit(1).cast("bigint").alias("count"),
                closed(state, place).alias("out")))

        start = F.struct(
            F.lit(0).cast("bigint").alias("members"), F.lit(0).cast("bigint").alias("count"),
            F.expr("cast(array() as array<bigint>)").alias("out"))
        return F.aggregate(ordered, start, step, lambda state: closed(state, ranges))

    sixteenth = F.shiftright(F.greatest(F.size(ordered) - 1, F.lit(0)), 4)
    bits = F.greatest(F.lit(6), F.length(F.bin(sixteenth)))
    return F.when(ordered.isNotNull(), bind(F.struct(bits.alias("bits")), digests))


def _halved(digests: Column) -> Column:
    """The digests of ranges twice as wide."""

    def both(a: Column, b: Column) -> Column:
        members = F.shiftright(a, _COUNT_BITS).bitwiseXOR(F.shiftright(b, _COUNT_BITS))
        return _digest(members, a.bitwiseAND(_COUNT) + b.bitwiseAND(_COUNT))

    places = F.sequence(F.lit(0), F.shiftright(F.size(digests), 1) - 1)
    return F.transform(places, lambda i: both(F.get(digests, i * 2), F.get(digests, i * 2 + 1)))


def surely_overlaps(left: Column, right: Column, left_size: Column, right_size: Column,
                    threshold: float) -> Column:
    """What ``set_digests`` of two sets tell of ``jaccard >= threshold``; null where they do not decide it.

    Ranges with one digest have the same members, all of them shared. Of other ranges at most the smaller
    number is shared, or one less where the numbers are equal.
    """
    total = left_size + right_size
    smaller, larger = F.least(left_size, right_size), F.greatest(left_size, right_size)

    def bounds(a: Column, b: Column) -> Column:
        """At most and, in the upper half of the number, at least so many members are shared."""
        m, n = a.bitwiseAND(_COUNT), b.bitwiseAND(_COUNT)
        return F.when(a == b, m * F.lit((1 << _HALF) + 1)).otherwise(F.least(m, n) - (m == n).cast("int"))

    def decided(shared: Column) -> Column:
        least, most = F.shiftright(shared, _HALF), shared.bitwiseAND((1 << _HALF) - 1)
        return F.when(least / (total - least) >= threshold, True).when(
            most / (total - most) < threshold, False)

    def summed(pair: Column) -> Column:
        return F.aggregate(F.zip_with(pair["l"], pair["r"], bounds), F.lit(0).cast("bigint"),
                           lambda a, b: a + b)

    of_left, of_right = F.size(left), F.size(right)
    pair = (
        F.when(of_left == of_right, F.struct(left.alias("l"), right.alias("r")))
        .when(of_left == of_right * 2, F.struct(_halved(left).alias("l"), right.alias("r")))
        .when(of_left * 2 == of_right, F.struct(left.alias("l"), _halved(right).alias("r")))
    )
    return F.when(larger == 0, threshold <= 1).when(smaller / larger < threshold, False).otherwise(
        bind(bind(pair, summed), decided))


def is_placeholder(text: Column) -> Column:
    """Missing, blank, or nothing but a placeholder word."""
    bare = F.trim(text)
    # Lengths first, so that only short texts are matched. Lower-casing may change them a little.
    longest = 2 * max(map(len, fixed.PLACEHOLDERS))
    return text.isNull() | (bare == "") | (F.length(bare) <= longest) & F.lower(bare).rlike(
        f"^(?:{any_of(fixed.PLACEHOLDERS)})$"
    )


def has_action_signal(text: Column) -> Column:
    return contains_any(text, fixed.ACTION_SIGNALS)


def has_measure_signal(text: Column) -> Column:
    return F.lower(text).rlike(rf"\d+(\.\d+)?\s*({any_of(fixed.MEASURE_UNITS)})")


def has_outcome_signal(text: Column) -> Column:
    return contains_any(text, fixed.OUTCOME_SIGNALS)


def is_short_low_signal(text: Column, knowledge_type: Column) -> Column:
    """Short text without any signal, for types that are not exempt."""
    return (
        (F.length(text) < fixed.SHORT_TEXT_CHARS)
        & ~has_action_signal(text)
        & ~has_measure_signal(text)
        & ~has_outcome_signal(text)
        & ~knowledge_type.isin(fixed.SHORT_TEXT_EXEMPT_TYPES)
    )


def query_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), 0)


def is_good_query(text: Column, gate) -> Column:
    """Lexical gate against junk: length, words, share of words with letters, repeats."""
    tokens = query_tokens(text)
    alpha = F.size(F.filter(tokens, lambda t: t.rlike("[A-Za-z]")))
    return (
        (F.length(text) >= gate.min_query_chars)
        & (F.size(tokens) >= gate.min_query_tokens)
        & (alpha / F.greatest(F.size(tokens), F.lit(1)) >= gate.min_alpha_token_ratio)
        & ~has_repeat(text, 5)
    )


def iso_date(text: Column) -> Column:
    """The first ``yyyy-mm-dd`` standing as a word of its own, or null."""
    found = F.regexp_extract(text, rf"{WORD_START}(\d{{4}}-\d{{2}}-\d{{2}}){WORD_END}", 1)
    return F.nullif(found, F.lit(""))


# A word boundary that treats letters and digits of every script as word characters.
WORD_START = r"(?<![\p{L}\p{N}_])"
WORD_END = r"(?![\p{L}\p{N}_])"
