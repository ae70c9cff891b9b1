"""Fill-in-the-middle transformation with memoized content-defined chunks.

A text is cut where a rolling hash over its last 16 bytes says so, so that equal passages fall into
equal chunks wherever they stand. What a chunk adds to a count of units does not depend on its
neighbours but for its two edges; that boundary summary (characters, units that end inside, whether
the first and the last byte belong to a word) is kept in a content cache, looked up by the chunk's
bytes themselves. Running sums over the chunks' summaries give the number of units of the whole text
and name the chunk that holds a cut; only that chunk is looked into.

A unit is a word with the white space before it; white space at the end of a text is one more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill.llm.tables import in_small_batches
from groundsill.llm.words import text_bytes
from groundsill.session import ship_with_tasks

ship_with_tasks(__name__)

ADDED = ["n", "form", "prefix_chars", "middle_chars", "fim_text"]
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

LEAST, MASK, MOST = 256, 0x3FF, 8192
"""Chunks are 256 to 8192 bytes long, about 1280 on average; a character is never split."""
WINDOW = 16
BLOCK_BYTES = 1 << 20
CACHE_BYTES = 32 << 20
_GEAR = np.random.default_rng(1211).integers(0, 2**32, 256, dtype=np.uint32)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


class Summary(NamedTuple):
    """What a chunk adds to sums over its text: ``ends`` counts words that end inside of it."""

    chars: int
    ends: int
    first: bool
    last: bool


def summary(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    word = _IS_WORD[data]
    return Summary(
        int(np.count_nonzero((data & 0xC0) != 0x80)),
        int(np.count_nonzero(word[:-1] & ~word[1:])), bool(word[0]), bool(word[-1]))


class Cache:
    """Summaries by content, in two generations of at most ``most`` bytes of keys together: when the
    young one is full it becomes the old one, and what was not met since then is forgotten."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.size = most // 2, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.asked = self.known = 0

    def get(self, chunk: bytes) -> Summary:
        self.asked += 1
        found = self.young.get(chunk)
        if found is not None:
            self.known += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            found = summary(chunk)
        else:
            self.known += 1
        if self.size + len(chunk) > self.most:
            self.young, self.old, self.size = {}, self.young, 0
        self.young[chunk] = found
        self.size += len(chunk) + 100
        return found


def _rolled(data: np.ndarray) -> np.ndarray:
    """Hash of the last 16 bytes at each place; doubling the window in four steps."""
    rolled = _GEAR[data]
    for step in (1, 2, 4, 8):
        rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
    return rolled


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end; the last end is the text's.

    As no chunk is shorter than the hash's window, a chunk's end depends on bytes of the chunk only,
    and a text meets an earlier one's chunks again after the first common end.
    """
    n, ends, start = len(data), [], 0

    def forced(until: int) -> None:
        nonlocal start
        while until - start > MOST:
            cut = start + MOST
            while cut < n and data[cut] & 0xC0 == 0x80:
                cut += 1
            ends.append(cut)
            start = cut

    for at in range(0, n, BLOCK_BYTES):
        low = max(at - WINDOW + 1, 0)
        block = data[low : at + BLOCK_BYTES + 1]
        hit = np.flatnonzero((_rolled(block[:-1] if len(block) > 1 else block) & MASK) == 0) + 1
        hit = hit[(hit > at - low) & (hit < len(block))]
        hit = hit[(block[hit] & 0xC0) != 0x80] + low
        for cut in hit.tolist():
            forced(cut)
            if cut - start >= LEAST:
                ends.append(cut)
                start = cut
    forced(n)
    if start < n:
        ends.append(n)
    return ends


class Counted:
    """A text's units as running sums over its chunks."""

    def __init__(self, text: bytes, cache: Cache):
        self.text = text
        self.ends = chunk_ends(np.frombuffer(text, np.uint8))
        parts, start = [], 0
        for end in self.ends:
            parts.append(cache.get(text[start:end]))
            start = end
        # A word also ends at a chunk's edge if the next chunk, or nothing, goes on without it.
        after = [p.first for p in parts[1:]] + [False]
        self.words = np.cumsum([p.ends + (p.last and not go) for p, go in zip(parts, after)])
        self.chars = np.cumsum([p.chars for p in parts])
        self.trailing = bool(parts) and not parts[-1].last
        self.n = int(self.words[-1]) + self.trailing if parts else 0

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and characters of the first ``units`` units."""
        if units <= 0:
            return 0, 0
        if units >= self.n:
            return len(self.text), int(self.chars[-1]) if self.n else 0
        chunk = int(np.searchsorted(self.words, units))
        start, end = self.ends[chunk - 1] if chunk else 0, self.ends[chunk]
        before = int(self.words[chunk - 1]) if chunk else 0
        data = np.frombuffer(self.text[start:end], np.uint8)
        word = _IS_WORD[data]
        inside = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        wanted = units - before - 1
        size = int(inside[wanted]) if wanted < len(inside) else end - start
        chars = int(np.count_nonzero((data[:size] & 0xC0) != 0x80))
        return start + size, chars + (int(self.chars[chunk - 1]) if chunk else 0)


@dataclass(frozen=True)
class Mix:
    """Of 100 documents ``percent`` are transformed, and of 100 of those ``spm`` begin with the
    suffix, the others with the prefix. ``seed`` and a document's id draw everything."""

    percent: int = 50
    spm: int = 80
    seed: int = 42


def draws(doc_id: int | None, seed: int) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transform_one(text: bytes, doc_id: int | None, how: Mix, cache: Cache
                  ) -> tuple[int, str, int | None, int | None, bytes]:
    """The number of units, the form, characters of prefix and middle, and the new text."""
    counted = Counted(text, cache)
    n = counted.n
    h1, h2, h3, h4 = draws(doc_id, how.seed)
    if not text or h3 % 100 >= how.percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, prefix_chars), (b, both_chars) = counted.cut(first), counted.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < how.spm:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return n, form, prefix_chars, both_chars - prefix_chars, b"".join(parts)


def transform(documents: DataFrame, how: Mix = Mix(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``documents`` with ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (null if plain) and ``fim_text``, the text a model is trained on.

    A null text counts as empty; empty texts and texts that hold a marker stay plain. A null id draws
    like an empty one; rows that repeat an id draw the same numbers. Columns of the added
    names are replaced, all others kept. No row meets another but in a task's cache.
    """
    base = in_small_batches(documents).drop(*ADDED)
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    schema = ", ".join([f"`{c}` {t}" for c, t in types.items()] + [
        "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint", "fim_text string"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache()
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_col))
            ids = batch.column(id_col).to_pylist()
            out = [transform_one(data[a:b].tobytes(), i, how, cache)
                   for a, b, i in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ids, strict=True)]
            n, form, prefix, middle, text = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(text, pa.binary()).cast(pa.string())],
                [*batch.schema.names, *ADDED])

    return base.mapInArrow(rows, schema)


def restored(form: Column, text: Column) -> Column:
    """The text as it was, told from a transformed one and its form alone."""
    def between(start: Column, end: Column | None = None) -> Column:
        stop = F.length(text) + 1 if end is None else end
        return F.substr(text, start, stop - start)

    def place(mark: bytes) -> Column:
        return F.instr(text, mark.decode())

    p, s, m = place(PREFIX), place(SUFFIX), place(MIDDLE)
    size = len(PREFIX)
    return (
        F.when(form == "psm", F.concat(between(p + size, s), between(m + size), between(s + size, m)))
        .when(form == "spm", F.concat(between(p + size, m), between(m + size), between(s + size, p)))
        .otherwise(text))


def sql(how: Mix = Mix()) -> str:
    """Counts, forms and digests per row of ``documents`` as SQL."""
    def draw(k: int) -> str:
        return f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"

    return f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256('{how.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''),
      '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS us
  FROM documents),
drawn AS (
  SELECT *, len(us) AS n, {draw(0)} % (len(us) + 1) AS c1, {draw(1)} % (len(us) + 1) AS c2,
    {draw(2)} % 100 AS c3, {draw(3)} % 100 AS c4 FROM units),
cut AS (
  SELECT *,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR c3 >= {how.percent} THEN 'plain' WHEN c4 < {how.spm} THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(us[1:least(c1, c2)], '') AS pre,
    array_to_string(us[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
    array_to_string(us[greatest(c1, c2) + 1:], '') AS suf
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut"""
