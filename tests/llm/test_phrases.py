from __future__ import annotations

import random
import re
from collections import Counter

import helpers
import numpy as np
import pyarrow as pa
import pytest

from groundsill.llm import phrases, queries


def split(text: str | None) -> list[list[str]]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counts(rows, longest: int) -> tuple[Counter, Counter]:
    f, n = Counter(), Counter()
    for text, lang in rows:
        for ws in split(text):
            n[lang or "und"] += len(ws)
            for k in range(1, longest + 1):
                f.update((lang or "und", *ws[i : i + k]) for i in range(len(ws) - k + 1))
    return f, n


def brute(rows, how: phrases.Phrases) -> list[tuple]:
    f, total = counts(rows, how.longest)
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= how.least}
    longer = Counter()
    for (lang, *ws), a in found.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                key = (lang, *ws[i : i + k])
                longer[key] = max(longer[key], a)
    by_lang: dict[str, list] = {}
    for p, a in found.items():
        lang, *ws = p
        if p in longer and 100 * longer[p] >= how.inside * a:
            continue
        cuts = []
        for c in range(1, len(ws)):
            left, right = f[(lang, *ws[:c])], f[(lang, *ws[c:])]
            cuts.append((1000 * a * total[lang] // (left * right), c, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append(
            (-score, -a, " ".join(ws).encode(), left, right))
    out = []
    for lang, kept in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[: how.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def prose(chance: random.Random, size: int) -> str:
    words = ["the", "The", "of", "new", "york", "city", "é", "中文", "a-b", "x"]
    gaps = [" "] * 20 + ["  ", "\t", ", ", ". ", "\n", "; ", ":", "!", "?", "\x0b", "\r\n"]
    return "".join(chance.choice(words) + chance.choice(gaps) for _ in range(size))


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    chance = random.Random(3)
    out = [(prose(chance, chance.choice([0, 1, 3, 60, 300])), chance.choice(["en", "en", "de", None]))
           for _ in range(150)]
    out += [("A text that is copied many times over.", "en")] * 40
    return out + [(None, "en"), ("", None), ("alone", "xx"), (" .,;", "und"), ("same same " * 50, "zz"),
                  ("new york " * 30, "und")]


def frame(spark, rows):
    return spark.createDataFrame(
        [(t, lang, "x", 1, "y") for t, lang in rows],
        "text string, lang string, w1 string, n int, Phrase string").repartition(4)


@pytest.mark.parametrize("how", [
    phrases.Phrases(least=20), phrases.Phrases(least=5, longest=3, top=7, inside=60),
    phrases.Phrases(least=1, longest=4, inside=101)])
def test_collocations_against_all_ngrams(spark, rows, how):
    found = phrases.collocations(frame(spark, rows), how)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, how)


def test_every_count_is_exact(spark, rows):
    how = phrases.Phrases(least=10)
    f, n = counts(rows, how.longest)
    found = {(r.lang, *r.words): r.f for r in phrases.phrase_counts(frame(spark, rows), how).collect()}
    assert found == {p: a for p, a in f.items() if a >= 10} | {
        (lang,): a for lang, a in n.items()}


def test_a_full_filter_loses_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_FILTER_WORDS", 1)
    how = phrases.Phrases(least=20)
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows), how).collect())) == brute(rows, how)


def test_long_texts_in_blocks():
    chance = random.Random(4)
    text = prose(chance, 4000) + "z" * 3000 + " " * 2000 + prose(chance, 500) + "tail" * 400
    f, _ = counts([(text, "en")], 5)
    for most in (7, 100, 1000, 1 << 20):
        met = Counter()
        for block in phrases.blocks(pa.array([None, text, ""]), 5, most):
            follows = np.append(~block.opens[1:], False) if len(block.code) else block.opens
            lang = np.zeros(3, np.int64)
            for columns in phrases._windows(block, lang, pa.array(["en"]), follows, 5):
                for *ws, n in zip(*(c.to_pylist() for c in columns[1:]), strict=True):
                    for k in range(1, 6):
                        if ws[k - 1]:
                            met[("en", *ws[:k])] += n
        assert met == f


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([("new york " * 60_000, "en")] * 40, "text string, lang string")
    (row,) = phrases.collocations(df, phrases.Phrases(longest=2, top=1)).collect()
    assert (row.phrase, row.a, row.n) == ("new york", 2_400_000, 4_800_000)
    assert 1000 * row.a * row.n > 2**53 and row.score == 1000 * row.a * row.n // (row.l * row.r)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(df).collect() == []


def test_given_table(spark):
    rows = helpers.rows("documents", "text, lang", "doc_id")
    found = queries.op12_phrase_collocations(spark, helpers.SF_DIR)
    assert sorted(map(tuple, found.collect())) == brute(rows, phrases.Phrases())
