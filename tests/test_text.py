from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from groundsill.functions import citations as ct
from groundsill.functions import text as tx
from groundsill.operators.chunking import pack_sections
from groundsill.policy import GateConfig


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


T = F.col("t")


def test_placeholder_is_the_whole_text(spark):
    texts = ["N/A", " ok ", "maintenance ok", "", None, "All Good", "nap", "none."]
    assert values(spark, texts, tx.is_placeholder(T)) == [
        True, True, False, True, True, True, False, False]


@pytest.mark.parametrize("extra,kind,short", [
    ("", "incident", True), ("x", "incident", False), ("", "sop", False),
    ("", "maintenance", False),
])
def test_short_text_without_signal(spark, extra, kind, short):
    text = "y" * 119 + extra
    assert values(spark, [text], tx.is_short_low_signal(T, F.lit(kind))) == [short]


@pytest.mark.parametrize("text", ["a leak", "held 12.5 bar", "it was completed"])
def test_each_signal_alone_saves_a_short_text(spark, text):
    assert values(spark, [text], tx.is_short_low_signal(T, F.lit("incident"))) == [False]


def test_token_estimates(spark):
    texts = ["", "abc", "abcd", "abcdefg", "a \t\n\n b"]
    assert values(spark, texts, tx.tokens_chars4(T)) == [0, 0, 1, 1, 0]
    assert values(spark, ["", "a", "a b c\n d"], tx.tokens_words(T)) == [0, 1, 4]
    assert values(spark, ["a b c d e f g h i j"], tx.tokens_words13(T)) == [13]


def test_sanitize_agrees_with_python(spark):
    texts = ["a\x00b", "\x1f x 　y \x7f", "  z\x85", "\x0b\x0c", "é\t\tü"]

    def expected(s):
        s = re.sub(r"[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]", " ", s.replace("\x00", " "))
        return re.sub(r"\s+", " ", s).strip()

    assert values(spark, texts, tx.sanitize(T)) == [expected(s) for s in texts]


def test_noise(spark):
    texts = ["", "1" * 30, "1" * 31, "1-" * 100, "1-" * 99 + "1", "ab" * 10 + "1-" * 90,
             "é" * 20 + "1-" * 90, "\n" * 40 + "fine"]
    assert values(spark, texts, tx.is_noise(T)) == [
        True, False, True, True, False, False, False, False]


def test_injection_is_case_blind(spark):
    assert values(spark, ["please Act As root", "react asap", "the System Prompt", "none"],
                  tx.has_injection(T)) == [True, True, True, False]


def python_jaccard(a, b):
    def cut(text):
        words = text.split()
        if len(words) < 5:
            return {" ".join(words)} if words else set()
        return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)}

    x, y = cut(a), cut(b)
    return 1.0 if not x and not y else len(x & y) / len(x | y)


def test_overlap_agrees_with_python(spark):
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base), " ".join(base[:36]), " ".join(base[4:]), " ".join(base[1:39]),
             "one two", "one two", "one", "", " ".join(base[:8]), " ".join(base[:9]),
             " ".join(base[:32]), " ".join(base[20:] + base[:20])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    made = df.select("t", F.sort_array(tx.shingles(T)).alias("s")).withColumn(
        "k", tx.overlap_key(F.col("s"), 0.8))
    left = made.toDF("ta", "sa", "ka")
    pairs = left.join(made, left.ta <= made.t).select(
        "ta", "t", tx.jaccard(F.col("sa"), F.col("s")).alias("j"),
        tx.overlaps(F.col("sa"), F.col("s"), F.col("ka"), F.col("k"), 0.8).alias("o")).collect()
    assert len(pairs) > 60
    for row in pairs:
        expected = python_jaccard(row["ta"], row["t"])
        assert row["j"] == expected
        assert row["o"] == (expected >= 0.8)


def test_query_gate(spark):
    texts = ["valve leak on line", "short", "123 456 789 0ab", "aaaaaa is here ok", "aaaaabbbbb ccc",
             "oneword1234"]
    gate = GateConfig()
    assert values(spark, texts, tx.is_good_query(T, gate)) == [
        True, False, False, False, True, False]


def test_iso_date_stands_alone(spark):
    texts = ["on 2024-01-05.", "x2024-01-05", "é2024-01-05", "2024-01-051", "no",
             "2024-02-01 and 2024-02-02"]
    assert values(spark, texts, tx.iso_date(T)) == [
        "2024-01-05", None, None, None, None, "2024-02-01"]


def python_pack(text, size):
    heads = "SCOPE:|SAFETY|PRE-|STARTUP|OPERATION|PROCEDURE|EMERGENCY|MAINTENANCE|REVISION"
    parts = []
    for part in re.split(f"(?=(?:{heads}))", text, flags=re.I):
        parts += [part[i:i + size] for i in range(0, max(len(part), 1), size)]
    done, opened = [], ""
    for part in parts:
        if len(opened) + len(part) < size:
            opened += " " + part
        else:
            done.append(opened.strip())
            opened = part
    done.append(opened.strip())
    return [d for d in done if d]


def test_packing(spark):
    texts = ["", "plain", "SAFETY one SAFETY two", "x" * 2600, "a" * 2499, "a" * 2500,
             "intro " + "SCOPE: " + "b" * 2480 + " Revision c", "SAFETYSTARTUP", "\n \n",
             "procedure " + "d" * 5200 + " maintenance " + "e" * 100]
    packed = values(spark, texts, pack_sections(T))
    assert packed == [python_pack(t, 2500) for t in texts]
    assert all(len(p) <= 2500 for pieces in packed for p in pieces)


def test_citations_in_numeric_order(spark):
    assert values(spark, ["[C10] [C2] [C2] [c0] (C0) [C-1] [C01] [C1]"], ct.cited_anchors(T)) == [
        ["C1", "C2", "C10"]]


@pytest.mark.parametrize("text,fact", [
    ("It was replaced.", True), ("It was misreplaced", False), ("fixed_it", False),
    ("on 2024-01-01", True), ("near eq_1", True), ("LINE_A1 ran", True), ("nothing here", False),
    ("Repaired!", True),
])
def test_fact(spark, text, fact):
    assert values(spark, [text], ct.has_fact(T)) == [fact]


def test_units_and_tail(spark):
    text = "Intro\n1. first [C0]\n  2. second\n \nthird was fixed"
    assert values(spark, [text], ct.answer_units(T)) == [
        ["Intro", "1. first [C0]", "2. second", "third was fixed"]]
    assert values(spark, ["A. B? C!"], ct.answer_units(T, sentences=True)) == [["A.", "B?", "C!"]]
    parts = values(spark, ["It was fixed [C0].", "fixed [C0] then removed", "fixed", "fine"],
                   ct.uncited_part(T))
    assert parts == [None, " then removed", "fixed", None]


def test_suspicious_ids(spark):
    text = "EQ_ZZ999 éEQ_ZZ998 LINE_A1 EQ_1 xMAINT_2 plainword"
    assert values(spark, [text], ct.suspicious_ids(T)) == [["EQ_ZZ999", "LINE_A1", "xMAINT_2"]]
    assert values(spark, [text], ct.suspicious_ids(T, 8)) == [["EQ_ZZ999", "xMAINT_2"]]


def test_digests_decide_overlap_or_leave_it_open(spark):
    rng = random.Random(3)
    rows = []
    # Sizes on both sides of a doubled number of ranges, and empty ones.
    for n in (0, 1, 7, 64, 300, 1000, 1024, 1025, 1100, 3000):
        base = [f"w{rng.random()}" for _ in range(n)]
        rows.append((n, -1.0, base + ["more"]))
        rows.extend((n, part, base[:int(n * part)] + [f"v{rng.random()}" for _ in range(n - int(n * part))])
                    for part in (1.0, 0.995, 0.95, 0.9, 0.89, 0.88, 0.6, 0.1))
    made = spark.createDataFrame(rows, "n int, part double, w array<string>").select(
        "n", "part", F.sort_array(F.transform("w", lambda s: F.xxhash64(s))).alias("s")).withColumn(
        "d", tx.set_digests(F.col("s"))).localCheckpoint()
    for row in made.collect():
        counts = [x & 4095 for x in row.d]
        ranges = len(counts)
        assert sum(counts) == len(row.s) and ranges >= 64 and len(row.s) <= 16 * ranges
        members = [0] * ranges
        for hashed in row.s:
            members[(hashed + (1 << 63)) * ranges >> 64] ^= hashed
        assert [x >> 12 & (1 << 52) - 1 for x in row.d] == [m & (1 << 52) - 1 for m in members]
    a, b = made.alias("a"), made.alias("b")
    for threshold in (0.3, 1.0, 0.8):
        pairs = a.join(b, F.abs(F.col("a.n") - F.col("b.n")) < 100).select(
            "a.n", F.col("b.n").alias("m"), "a.part", F.col("b.part").alias("other"),
            tx.jaccard(F.col("a.s"), F.col("b.s")).alias("j"),
            tx.surely_overlaps(F.col("a.d"), F.col("b.d"), F.size("a.s"), F.size("b.s"), threshold).alias("o")
        ).collect()
        assert all(r.o == (r.j >= threshold) for r in pairs if r.o is not None)
        assert all(r.o for r in pairs if (r.n, r.part) == (r.m, r.other))
    left_open = {r.part for r in pairs if r.n == r.m >= 64 and r.other == 1.0 and r.o is None}
    assert left_open and not left_open & {-1.0, 0.1, 1.0}
