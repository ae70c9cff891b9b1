"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A byte-pair tokenizer first splits a text into pre-tokens by a pattern and then encodes each for
itself, so a document's count is a sum over its pre-tokens. The tree's leaves are blocks of a few dozen
pre-tokens; every node holds the characters and tokens below it. An edit goes down the tree to
where it begins, splits the text again from a little before (the pattern looks a few characters ahead)
until its splits meet old ones behind the edit, encodes what is new, and updates the sums above.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsill.llm.tables import free_name, in_small_batches
from groundsill.session import ship_with_tasks

ship_with_tasks(__name__)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EDITS_TYPE = "array<struct<start:bigint,length:bigint,replacement:string>>"
LEAF = 48
LOOK_AHEAD = 4
KNOWN = 1 << 18

# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Tokenizer:
    """Splits into pre-tokens and counts a pre-token's tokens; counts are remembered, up to a bound."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "counting", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        out = []
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = len(self.encoding.encode_ordinary(piece))
                if len(piece) <= 64:
                    known[piece] = n
            out.append(n)
        return out

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


class Tree:
    """A document's pre-tokens with sums of characters and tokens.

    ``sizes`` and ``costs`` are per leaf the pre-tokens' lengths and token counts. ``chars`` and
    ``tokens`` are heap-ordered sums: node i has children 2i and 2i + 1, leaf k is node width + k.
    """

    def __init__(self, text: str, with_: Tokenizer):
        self.text, self.with_, self.encoded = text, with_, 0
        pieces = with_.pattern.findall(text)
        self._build(list(map(len, pieces)), with_.counts(pieces))

    def _build(self, sizes: list[int], costs: list[int]) -> None:
        self.sizes = [sizes[i : i + LEAF] for i in range(0, len(sizes), LEAF)] or [[]]
        self.costs = [costs[i : i + LEAF] for i in range(0, len(costs), LEAF)] or [[]]
        self.width = 1 << (len(self.sizes) - 1).bit_length()
        spare = [0] * (self.width - len(self.sizes))
        self.chars = [0] * self.width + list(map(sum, self.sizes)) + spare
        self.tokens = [0] * self.width + list(map(sum, self.costs)) + spare
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return self.tokens[1]

    def pieces(self) -> int:
        return sum(map(len, self.sizes))

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf holding character ``place`` and where that leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if begin + self.chars[node] <= place:
                begin += self.chars[node]
                node += 1
        leaf = node - self.width
        while leaf >= len(self.sizes) or (leaf and not self.sizes[leaf]):
            leaf -= 1  # past the end: the last leaf that holds anything
            begin = begin - sum(self.sizes[leaf]) if leaf < len(self.sizes) else begin
        return leaf, begin

    def _update(self, leaf: int) -> None:
        node = self.width + leaf
        self.chars[node], self.tokens[node] = sum(self.sizes[leaf]), sum(self.costs[leaf])
        while node := node // 2:
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replaces ``length`` characters from ``start`` on; what lies outside the text is cut off."""
        old = self.text
        start = min(max(start, 0), len(old))
        end = min(start + max(length, 0), len(old))
        text = self.text = old[:start] + replacement + old[end:]
        shift = len(replacement) - (end - start)

        first, begin = self._find(max(start - LOOK_AHEAD, 0))
        sizes, costs = self.sizes[first], self.costs[first]
        kept = 0
        while kept < len(sizes) and begin + sizes[kept] + LOOK_AHEAD <= start:
            begin += sizes[kept]
            kept += 1
        # Old splits from here on, read leaf by leaf, until new ones meet them behind the edit.
        leaf, at, old_place = first, kept, begin
        place, new_pieces = begin, []
        met = False
        for found in self.with_.pattern.finditer(text, begin):
            while old_place < place - shift or (leaf < len(self.sizes) and at >= len(self.sizes[leaf])):
                if leaf >= len(self.sizes):
                    break
                if at >= len(self.sizes[leaf]):
                    leaf, at = leaf + 1, 0
                    continue
                old_place += self.sizes[leaf][at]
                at += 1
            if place >= start + len(replacement) and old_place == place - shift and old_place >= end:
                met = True
                break
            new_pieces.append(found[0])
            place = found.end()
        if not met:  # split again to the end: nothing old is left behind
            leaf, at = len(self.sizes), 0
        self.encoded += len(new_pieces)
        tail_sizes = self.sizes[leaf][at:] if leaf < len(self.sizes) else []
        tail_costs = self.costs[leaf][at:] if leaf < len(self.sizes) else []
        self.sizes[first] = sizes[:kept] + list(map(len, new_pieces)) + tail_sizes
        self.costs[first] = costs[:kept] + self.with_.counts(new_pieces) + tail_costs
        self._update(first)
        for emptied in range(first + 1, min(leaf + 1, len(self.sizes))):
            self.sizes[emptied], self.costs[emptied] = [], []
            self._update(emptied)
        if len(self.sizes[first]) > 8 * LEAF:  # a leaf grown long: deal the pre-tokens out again
            self._build([x for s in self.sizes for x in s], [x for c in self.costs for x in c])


def count_edited(documents: DataFrame, edits: Column, text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents`` without the text, with token counts before and after a list of edits.

    ``edits`` is an array of ``(start, length, replacement)`` per document, applied in order, each to the
    text that the one before left; starts count characters from 0. Adds ``tokens_before``,
    ``tokens_after``, ``n_edits``, ``n_pretokens`` (after all edits) and ``n_reencoded`` (pre-tokens
    that edits had encoded). A null text is empty, null edits are none; an edit with a null start or
    length, or outside the text, is cut to the text; a null replacement deletes. Columns of the
    added names are replaced.
    """
    added = ["tokens_before", "tokens_after", "n_edits", "n_pretokens", "n_reencoded"]
    listed = free_name(documents, "edits")
    base = in_small_batches(documents).withColumn(listed, edits.cast(EDITS_TYPE)).drop(*added)
    kept = [c for c in base.columns if c not in (text_col, listed)]
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ = tokenizer(vocabulary)
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column(text_col), batch.column(listed), strict=True):
                tree = Tree(text.as_py() or "", with_)
                before = tree.total()
                changes = [e for e in wanted.as_py() or [] if e is not None]
                for e in changes:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                rows.append((before, tree.total(), len(changes), tree.pieces(), tree.encoded))
            columns = list(zip(*rows, strict=True)) or [()] * len(added)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(c, pa.int64()) for c in columns],
                kept + added)

    return base.mapInArrow(count, ", ".join(
        [f"`{c}` {types[c]}" for c in kept] + [f"{c} bigint" for c in added]))
