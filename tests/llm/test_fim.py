from __future__ import annotations

import hashlib
import random
import re

import helpers
import numpy as np

from groundsill.llm import fim, queries

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, how=fim.Mix()):
    text = text or ""
    digits = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= how.percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < how.spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def noise(chance: random.Random, size: int) -> str:
    return "".join(chance.choice("ab é中\U0001f600 \n\t\x0b<>PSM.") for _ in range(size))


def texts() -> list[tuple[int | None, str | None]]:
    chance = random.Random(5)
    passage = "shared words of a licence, again and again\n" * 80
    out = [(i, noise(chance, chance.choice([0, 1, 2, 30, 400, 3000, 20_000]))) for i in range(120)]
    out += [(200 + i, noise(chance, 50) + passage + noise(chance, 500) + passage) for i in range(30)]
    out += [(300, None), (301, ""), (302, " "), (303, " \n"), (304, "x"), (305, "x "), (306, "<M> held"),
            (None, "no id at all"), (None, "no id at all"), (7, "an id again"), (-3, "a negative id"),
            (308, "z" * 300_000), (309, " " * 300_000), (310, ("word " * 400_000)),
            (311, "中" * 90_000 + " end"), (312, "a" * 8191 + "é" * 3 + " b")]
    return out


def test_chunks_do_not_depend_on_what_stands_before():
    chance = random.Random(2)
    body = noise(chance, 60_000).encode()
    whole = fim.chunk_ends(np.frombuffer(body, np.uint8))
    assert whole[-1] == len(body) and max(np.diff([0, *whole])) <= fim.MOST + 3
    for before in (b"x", b"some words " * 90, b"\xc3\xa9" * 3000):
        shifted = fim.chunk_ends(np.frombuffer(before + body, np.uint8))
        common = {e - len(before) for e in shifted} & set(whole)
        assert len(common) > 0.8 * len(whole)


def test_counts_and_cuts_at_every_unit():
    for _, text in texts()[:60]:
        body, cache = (text or "").encode(), fim.Cache()
        counted = fim.Counted(body, cache)
        units = UNITS.findall(text or "")
        assert counted.n == len(units)
        for k in sorted({*range(min(40, len(units) + 1)), len(units) // 2, len(units)}):
            head = "".join(units[:k])
            assert counted.cut(k) == (len(head.encode()), len(head))


def test_cache_is_bounded_and_remembers():
    cache = fim.Cache(most=40_000)
    for k in range(200):
        cache.get(b"%04d" % k * 100)
        assert sum(map(len, [*cache.young, *cache.old])) <= 40_000
    known = cache.known
    cache.get(b"0199" * 100)
    assert cache.known == known + 1
    passage = noise(random.Random(8), 50_000)
    fim.Counted(passage.encode(), fresh := fim.Cache())
    fim.Counted(("x" + passage).encode(), fresh)
    assert fresh.known > 0.4 * fresh.asked


def test_transform_odd_rows(spark):
    rows = texts()
    df = spark.createDataFrame(
        [(i, t, "kept", f"c{k}", 1) for k, (i, t) in enumerate(rows)],
        "doc_id bigint, text string, extra string, FORM string, n int").repartition(3)
    found = fim.transform(df)
    assert found.columns == ["doc_id", "text", "extra", *fim.ADDED]
    got = sorted(map(repr, ((r.doc_id, r.text, r.extra, r.n, r.form, r.prefix_chars, r.middle_chars,
                             r.fim_text) for r in found.collect())))
    assert got == sorted(repr((i, t, "kept", *brute(i, t))) for i, t in rows)
    back = found.select("text", fim.restored(found["form"], found["fim_text"]).alias("again"))
    assert all((r.text or "") == r.again for r in back.collect())
    assert fim.transform(df.limit(0)).collect() == []
    always = fim.Mix(percent=100, spm=0, seed=9)
    made = fim.transform(df.select("doc_id", "text"), always)
    assert sorted(repr((r.doc_id, r.fim_text)) for r in made.collect()) == sorted(
        repr((i, brute(i, t, always)[4])) for i, t in rows)


def test_forms_of_the_given_table(spark):
    rows = helpers.rows("documents", "doc_id, text", "doc_id")
    found = {r.doc_id: r for r in queries.op11_fill_in_middle(spark, helpers.SF_DIR).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        n, form, prefix, middle, out = brute(i, text)
        r = found[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
