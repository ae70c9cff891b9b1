"""Benchmark decontamination by pigeonhole edit matching.

A document leaks an item if some stretch of its text is within the item's error budget e of edits
(insertions, deletions, substitutions of characters). Cut into e + 1 pieces, an item cannot take e
edits without leaving one piece untouched; so exact hits of pieces, found for all items in one
pass by an Aho-Corasick automaton, give every place where a leak can be. Each such place is
then decided by Myers' bit-parallel distance.

Texts and items are compared in lower case with white space runs as single spaces. Items travel in
blocks of bounded size, one scan of the documents per block. The scans are chained in one stage: the
plan holds all blocks, and a task runs a Python worker and an automaton for each at the same time,
so memory grows with the number of blocks. No step shuffles documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsill.llm.tables import free_name, in_small_batches
from groundsill.session import ship_with_tasks

ship_with_tasks(__name__)

BLOCK_CHARS = 4 << 20
LEAK_TYPE = "array<struct<item_id:bigint,distance:int>>"


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item prepared for Myers' algorithm: one bit per character, in one whole number."""

    def __init__(self, item: str):
        self.item, self.top, self.mask = item, 1 << (len(item) - 1), (1 << len(item)) - 1
        self.places: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.places[c] |= 1 << i

    def distance(self, text: str) -> int:
        """Least number of edits between the item and any stretch of ``text``."""
        if self.item in text:
            return 0
        mask, top = self.mask, self.top
        up, down = mask, 0
        score = least = len(self.item)
        places = self.places
        for c in text:
            equal = places.get(c, 0)
            vertical = equal | down
            equal |= (((equal & up) + up) ^ up)
            right = down | (mask & ~(equal | up))
            left = up & equal
            if right & top:
                score += 1
            elif left & top:
                score -= 1
                if score < least:
                    least = score
            right = (right << 1) & mask  # a match may begin anywhere, so the top row stays 0
            left = (left << 1) & mask
            up = left | (mask & ~(vertical | right))
            down = right & vertical
        return least


class Matcher:
    """All items of a block: their pieces in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = []
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            item = plain(text)
            if not item:
                continue
            budget = min(int(len(item) * rate), len(item) - 1)
            for offset, piece in pieces(item, budget):
                owners[piece].append((len(self.items), offset))
            self.items.append((item_id, budget, Pattern(item)))
        self.automaton = ahocorasick.Automaton()
        for piece, whose in owners.items():
            self.automaton.add_word(piece, (len(piece), whose))
        if owners:
            self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[dict]:
        """Items found in ``text``, each with its least distance."""
        body = plain(text)
        if not body or not self.items:
            return []
        spots: dict[int, list[list[int]]] = {}
        for last, (length, whose) in self.automaton.iter(body):
            for which, offset in whose:
                _, budget, pattern = self.items[which]
                begin = last + 1 - length - offset - budget
                end = begin + len(pattern.item) + 2 * budget
                known = spots.setdefault(which, [])
                if known and known[-1][0] - budget <= begin <= known[-1][1]:
                    known[-1][0] = min(begin, known[-1][0])
                    known[-1][1] = max(end, known[-1][1])
                else:
                    known.append([begin, end])
        found = []
        for which, places in spots.items():
            item_id, budget, pattern = self.items[which]
            least = budget + 1
            for begin, end in places:
                least = min(least, pattern.distance(body[max(begin, 0) : end]))
                if not least:
                    break
            if least <= budget:
                found.append({"item_id": item_id, "distance": least})
        return sorted(found, key=lambda leak: leak["item_id"])


def _blocks(items: DataFrame, id_col: str, text_col: str, chars: int) -> Iterator[list]:
    """The items in id order, cut into blocks of about ``chars`` characters; an item that is longer
    is a block of its own. Only one block is collected at a time; ``mark_leaks`` keeps them all in its plan."""
    block, held = [], 0
    ordered = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(
        "i is not null and t is not null").orderBy("i", "t")
    for row in ordered.toLocalIterator():
        if block and held + len(row.t) > chars:
            yield block
            block, held = [], 0
        block.append((row.i, row.t))
        held += len(row.t)
    if block:
        yield block


def mark_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = 0.05,
               text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``documents`` with a column ``leaks``: the items each text holds and their least distance.

    ``rate`` is the error budget per character of an item, rounded down. Null and empty texts and
    items leak nothing, items with a null id are left out; items that repeat an id count as
    one with several texts. A clashing column named ``leaks`` is replaced.
    """
    if not 0 <= rate < 1:
        raise ValueError("rate must be at least 0 and below 1")
    base = in_small_batches(documents).drop("leaks")
    out = base.withColumn("leaks", F.expr(f"cast(array() as {LEAK_TYPE})"))
    schema = out.schema
    for block in _blocks(benchmark, item_id_col, item_text_col, block_chars):

        def scan(batches: Iterator[pa.RecordBatch], block: list = block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, rate)
            for batch in batches:
                place = batch.schema.get_field_index("leaks")
                kind = batch.schema.field(place).type
                now = []
                for text, before in zip(
                        batch.column(text_col), batch.column("leaks"), strict=True):
                    leaks = matcher.leaks(text.as_py())
                    now.append(_joined((before.as_py() or []) + leaks))
                yield batch.set_column(place, batch.schema.field(place), pa.array(now, kind))

        out = out.mapInArrow(scan, schema)
    return out


def _joined(leaks: list[dict]) -> list[dict]:
    least: dict[int, int] = {}
    for leak in leaks:
        known = least.get(leak["item_id"], leak["distance"])
        least[leak["item_id"]] = min(known, leak["distance"])
    return [{"item_id": i, "distance": d} for i, d in least.items()]


def clean(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that leak no item, unchanged."""
    return mark_leaks(documents, benchmark, **settings).where(F.size("leaks") == 0).drop("leaks")


def leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", **settings) -> DataFrame:
    """One row per leaking document and item: ``doc_id, item_id, distance``."""
    name = free_name(documents, "leak")
    marked = mark_leaks(documents.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark,
        text_col="text", **settings)
    return marked.select("doc_id", F.explode("leaks").alias(name)).select(
        "doc_id", f"{name}.item_id", f"{name}.distance")
