"""Phrase collocation mining by marginalising the longest windows.

Every word of every piece of text opens one window of ``longest`` columns: the word and its leads, padded
where the piece ends. Only these windows are counted. A phrase occurs once at the head of each window
that begins with it, so Spark's ROLLUP over the columns sums the windows to the counts of all shorter
phrases, of the words and of the language; no n-gram is counted by itself.

Most windows of a large corpus are unlike any other, and moving them would cost more than the text. A
phrase that reaches ``least`` occurrences holds no adjacent pair that does not, so the pairs are counted
first, by hash, and a window is padded from the first rare pair on. Frequent pairs reach the tasks as a
filter of bounded size: what it lets through by mistake only makes windows longer than need be, and
nothing frequent is ever cut off. Counts, scores and comparisons are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.llm.tables import in_small_batches
from groundsill.llm.words import MULTIPLIERS, hash_words, mix, text_bytes
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

NO_LANGUAGE = "und"
BLOCK_BYTES = 4 << 20
MAX_FILTER_WORDS = 1 << 22
"""At most 32 MB of filter, whatever the number of frequent pairs."""

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; per language the ``top`` best.
    A phrase goes if a longer one around it has ``inside`` hundredths of its count."""

    longest: int = 5
    least: int = 100
    top: int = 2000
    inside: int = 100


@dataclass
class Block:
    """Words of a stretch of text in order. ``code`` points into ``known``, ``opens`` says that a word
    begins a piece, ``row`` is its text; words from ``own`` on are there to be looked at only."""

    known: pa.Array
    code: np.ndarray
    opens: np.ndarray
    row: np.ndarray
    own: int


def _split(data: np.ndarray, offsets: np.ndarray, first_row: int, own: int) -> Block:
    kind = _KIND[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    separators = np.cumsum(kind == 2)[starts]
    begins = np.ones(len(starts), bool)
    begins[1:] = (separators[1:] != separators[:-1]) | (row[1:] != row[:-1])
    body = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=body[1:])
    found = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(body), pa.py_buffer(np.ascontiguousarray(_LOWER[data[inside]]))
    ).dictionary_encode()
    return Block(found.dictionary, found.indices.to_numpy(), begins, row + first_row,
                 int(np.searchsorted(starts, own)))


def _long_text(data: np.ndarray, row: int, most: int, ahead: int) -> Iterator[Block]:
    """One text in blocks that end between words, each with ``ahead`` words more to look at."""
    start, n = 0, len(data)
    while start < n:
        end = min(start + most, n)
        while end < n and _KIND[data[end]] == 0:
            step = np.flatnonzero(_KIND[data[end : end + most]])
            end = end + int(step[0]) if len(step) else min(end + most, n)
        reach, size = end, 256
        while reach < n:
            reach = min(end + size, n)
            tail = _KIND[data[end:reach]] == 0
            closed = np.flatnonzero(tail[:-1] & ~tail[1:])
            if len(closed) >= ahead:
                reach = end + int(closed[ahead - 1]) + 1
                break
            size *= 4
        piece = data[start:reach]
        yield _split(piece, np.array([0, len(piece)]), row, end - start)
        start = end


def blocks(texts: pa.Array, ahead: int, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """All words of a column of texts, in blocks of about ``most`` bytes."""
    data, offsets = text_bytes(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        if offsets[row + 1] - offsets[row] > 2 * most:
            yield from _long_text(data[offsets[row] : offsets[row + 1]], row, most, ahead)
            row += 1
            continue
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        part = data[offsets[row] : offsets[end]]
        if len(part):
            yield _split(part, offsets[row : end + 1] - offsets[row], row, len(part))
        row = end


def _languages(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The languages of a batch, each row's place among them, and a hash of each."""
    found = column.cast(pa.string()).fill_null(NO_LANGUAGE).dictionary_encode()
    hashes = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
              for x in found.dictionary.to_pylist()]
    return found.dictionary, found.indices.to_numpy(), np.array(hashes, np.uint64)


def _pairs(block: Block, lang: np.ndarray, lang_hash: np.ndarray) -> np.ndarray:
    """Per word a hash of its language, itself and its lead; zero where the piece ends."""
    out = np.zeros(len(block.code), np.uint64)
    if len(out) > 1:
        word = hash_words(*text_bytes(block.known), False).hashes[block.code]
        said = word[:-1] * MULTIPLIERS[0] + word[1:] * MULTIPLIERS[1]
        said += lang_hash[lang[block.row[:-1]]] * MULTIPLIERS[2]
        out[:-1] = np.where(block.opens[1:], np.uint64(0), mix(said) | np.uint64(1))
    return out


def _probe(pair: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's word of a pair, and its four bits there."""
    place = (pair >> np.uint64(32)) & np.uint64(size - 1)
    bits = np.zeros(len(pair), np.uint64)
    for shift in (1, 7, 13, 19):
        bits |= np.uint64(1) << ((pair >> np.uint64(shift)) & np.uint64(63))
    return place.astype(np.int64), bits


def frequent_pairs(documents: DataFrame, how: Phrases, text_col: str, lang_col: str) -> np.ndarray:
    """A filter of the hashes of all pairs that reach ``how.least`` in a language, as 64-bit words.

    It has 16 bits a pair until it has ``MAX_FILTER_WORDS`` words; then it lets more through.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, lang, lang_hash = _languages(batch.column(lang_col))
            for block in blocks(batch.column(text_col), 1):
                pair = _pairs(block, lang, lang_hash)[: block.own]
                pair, n = np.unique(pair[pair != 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair.view(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    frequent = materialize(
        documents.mapInArrow(count, "pair bigint, n bigint").groupBy("pair")
        .agg(F.sum("n").alias("n")).where(F.col("n") >= how.least).select("pair"))
    size = 1 << min(max(frequent.count() // 4, 1).bit_length(), MAX_FILTER_WORDS.bit_length() - 1)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, bit = _probe(batch.column("pair").to_numpy().view(np.uint64), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(bit.view(np.int64))], ["place", "bits"])

    rows = frequent.mapInArrow(bits, "place bigint, bits bigint").groupBy("place").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size, np.uint64)
    out[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _windows(block: Block, lang: np.ndarray, languages: pa.Array, follows: np.ndarray,
             columns: int) -> Iterator[list[pa.Array]]:
    """Distinct windows of a block with their counts, one group per number of words before padding.
    ``follows`` says that a window may run on over a word and its lead."""
    n = len(block.code)
    length = np.ones(n, np.int64)
    for _ in range(columns - 1):
        length[:-1] = 1 + np.where(follows[:-1], length[1:], 0)
    length = np.minimum(length, columns)[: block.own]
    known, size = block.known, len(block.known)
    word_lang = lang[block.row].astype(np.int64)
    for words in range(1, columns + 1):
        at = np.flatnonzero(length == words)
        if not len(at):
            continue
        said = word_lang[at] * size + block.code[at]
        for k in range(1, words):
            said = np.unique(said, return_inverse=True)[1] * size + block.code[at + k]
        _, first, counts = np.unique(said, return_index=True, return_counts=True)
        chosen = at[first]
        leads = [known.take(pa.array(block.code[chosen + k])).cast(pa.string()) for k in range(words)]
        padding = [pa.array([""]).take(pa.array(np.zeros(len(chosen), np.int32)))] * (columns - words)
        yield [languages.take(pa.array(word_lang[chosen])), *leads, *padding,
               pa.array(counts.astype(np.int64))]


def phrase_counts(documents: DataFrame, how: Phrases = Phrases(), text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``lang, words, phrase, f``: exact counts of all phrases of 1 to ``how.longest`` words that occur
    ``how.least`` times in a language, and of no word at all: how many words the language has.

    Null texts are empty; a null language is ``und``. Columns besides the two are not looked at.
    """
    if how.longest < 2:
        raise ValueError("phrases have two words at least")
    texts = in_small_batches(documents.select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")))
    frequent = frequent_pairs(texts, how, "text", "lang")
    names = [f"w{k}" for k in range(1, how.longest + 1)]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, lang, lang_hash = _languages(batch.column("lang"))
            for block in blocks(batch.column("text"), how.longest):
                pair = _pairs(block, lang, lang_hash)
                place, bits = _probe(pair, len(frequent))
                follows = (pair != 0) & ((frequent[place] & bits) == bits)
                for columns in _windows(block, lang, languages, follows, how.longest):
                    yield pa.RecordBatch.from_arrays(columns, ["lang", *names, "n"])

    windows = texts.mapInArrow(
        lead, ", ".join(f"{c} string" for c in ["lang", *names]) + ", n bigint")
    counted = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # ROLLUP leaves out columns from the right: grouping_id is 2^j - 1 if it left out j.
    depth = (how.longest - F.log2(F.col("left_out") + 1)).cast("int")
    kept = summed.withColumn("words", F.slice(F.array(*names), 1, depth)).where(
        (depth == 0) | (depth > 0) & (F.col("f") >= how.least)
        & (F.try_element_at(F.array(*names), depth) != ""))
    return materialize(kept.select(
        "lang", "words", F.array_join("words", " ").alias("phrase"), "f"))


def _inner(words: Column) -> Column:
    """All phrases of two words and more that lie inside a longer one."""
    size = F.size(words)
    return F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda k: F.transform(F.sequence(F.lit(1), size - k + 1),
                              lambda at: F.array_join(F.slice(words, at, k), " "))))


def collocations(documents: DataFrame, how: Phrases = Phrases(), text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``how.top`` best phrases.

    ``score`` is ``floor(1000 * a * n / (l * r))`` for the cut that makes it least; of equal ones the
    first. Products are decimals of 38 digits. Ranks go by score, count and the phrase's bytes.
    """
    known = phrase_counts(documents, how, text_col, lang_col)
    # Stored, so that Spark knows how few languages there are and moves them instead of the phrases.
    total = materialize(known.where(F.size("words") == 0).select("lang", F.col("f").alias("n")))
    found = known.where(F.size("words") > 1).select("lang", "words", "phrase", F.col("f").alias("a"))
    sides = known.where(F.size("words") > 0).select("lang", "phrase", "f")
    cuts = found.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")
    ).select("lang", "phrase", "a", "cut",
             F.array_join(F.slice("words", 1, F.col("cut")), " ").alias("head"),
             F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("rest"))

    def side(part: str, count: str) -> DataFrame:
        return sides.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))

    whole = "decimal(15,0)"
    scored = cuts.join(side("head", "l"), ["lang", "head"]).join(side("rest", "r"), ["lang", "rest"])
    scored = scored.join(total, "lang").withColumn("score", F.expr(
        f"(cast(1000 as decimal(4,0)) * (cast(a as {whole}) * cast(n as {whole})))"
        f" div (cast(l as {whole}) * cast(r as {whole}))"))
    least = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("best")).select(
            "lang", "phrase", *[f"best.{c}" for c in ("a", "l", "r", "n", "score")])
    around = found.where(F.size("words") > 2).select(
        "lang", F.explode(_inner(F.col("words"))).alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = least.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < how.inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return free.withColumn("rank", F.row_number().over(order).cast("bigint")).where(
        F.col("rank") <= how.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(how: Phrases = Phrases()) -> str:
    """The same phrases as SQL, each length counted by itself."""
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase, {k} AS k"
        f" FROM pieces, unnest(range(1, len(ws) - {k - 2})) AS t(i)"
        for k in range(1, how.longest + 1))
    return f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
    SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS ({grams}),
counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {how.least}),
total AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
found AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counted WHERE k > 1),
cuts AS (
  SELECT *, array_to_string(ws[1:c], ' ') AS head, array_to_string(ws[c + 1:], ' ') AS rest
  FROM found, unnest(range(1, k)) AS t(c)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, l.f AS l, r.f AS r, n,
    (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts JOIN counted l ON l.lang = cuts.lang AND l.phrase = head
    JOIN counted r ON r.lang = cuts.lang AND r.phrase = rest
    JOIN total ON total.lang = cuts.lang
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, c) = 1),
around AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM found, unnest(range(2, k)) AS t(m), unnest(range(1, k - m + 2)) AS u(i) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
  s.phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM scored s LEFT JOIN around USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < {how.inside} * a
QUALIFY rank <= {how.top}"""
