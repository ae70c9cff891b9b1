from __future__ import annotations

import random
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from groundsill.llm import decontaminate, langid, mixing, queries, urls


@pytest.fixture(scope="module")
def con():
    return connect(helpers.SF_DIR)


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, key):
    df = queries.QUERIES[key](spark, helpers.SF_DIR)
    assert difference(df, con, queries.ORACLE_SQL[key]) is None


def native(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_native_operators_run_no_python(spark):
    assert native(queries.op1_url_filter(spark, helpers.SF_DIR))
    assert native(queries.op7_poisson_mix(spark, helpers.SF_DIR))


def test_url_rules(spark):
    pages = [
        (1, "http://A.Example.COM/en/x", "example.com/en/", "block"),
        (2, "http://www.example.com/en/x", "www.example.com/en/", "allow"),
        (3, "http://www.example.com/en", "com/", "allow"),
        (4, "http://example.com", None, "allow"),
        (5, "http://example.com?x=/en/", None, "allow"),
        (6, "https://x.net/es/", "net/es/", "block"),
        (7, "https://xnet/es/", None, "allow"),
        (8, "https://x.net/ES/", None, "allow"),
        (9, None, None, "allow"), (10, "", None, "allow"), (11, "x.net/es/", None, "allow"),
        (12, "http://bad.org/p/?utm_x=1&b=2&a=1#f", None, "block"),
        (13, "https://www.bad.org/p?a=1&b=2", None, "block"),
        (14, "https://bad.org/p?a=1", None, "allow"),
        (15, "http://x.net/es/" + "y" * 100_000, "net/es/", "block"),
        (None, "https://x.net/fr/#q", "net/fr/", "block"), (6, "https://x.net/es/", "net/es/", "block"),
    ]
    df = spark.createDataFrame(
        [(i, u, "h", "r", "k") for i, u, _, _ in pages],
        "page_id bigint, url string, Host string, rule string, key string")
    rules = spark.createDataFrame(urls.RULES + [("net/es/", "allow")], "rule string, verdict string")
    listed = spark.createDataFrame([("http://bad.org/p?b=2&a=1",), (None,), ("nothing",)], "url string")
    found = urls.judge(df, rules, listed, blocks=16)
    assert Counter((r.page_id, r.rule, r.verdict, r.key) for r in found.collect()) == Counter(
        (i, rule, verdict, "k") for i, _, rule, verdict in pages)
    parts = {r.page_id: (r["host"], r.path) for r in found.collect()}
    assert parts[1] == ("a.example.com", "/en/x") and parts[5] == ("example.com", "")
    assert parts[9] == parts[10] == parts[11] == ("", "")
    none = urls.judge(df, rules.limit(0), listed.limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert urls.judge(df.limit(0), rules, listed).collect() == []


def test_myers_distance_against_the_whole_table():
    chance = random.Random(7)
    for _ in range(300):
        item = "".join(chance.choice("abc ") for _ in range(chance.randint(1, 90)))
        text = "".join(chance.choice("abc ") for _ in range(chance.randint(0, 60)))
        if chance.random() < 0.5:
            cut = chance.randint(0, len(item))
            text += item[:cut] + chance.choice(["", "x", "yy"]) + item[cut + chance.randint(0, 3) :]
        assert decontaminate.Pattern(item).distance(text) == helpers.edit_distance_within(item, text)


def test_pigeonhole_finds_what_brute_force_finds(spark):
    chance = random.Random(8)
    word = lambda: "".join(chance.choice("abcde") for _ in range(chance.randint(1, 6)))
    items = [(i, " ".join(word() for _ in range(chance.randint(8, 30)))) for i in range(12)]
    items += [(3, "a second text of item three, of some length"), (90, None), (91, ""), (None, "zz zz zz")]
    docs = []
    for d in range(60):
        text = " ".join(word() for _ in range(40))
        for _, item in chance.sample(items[:13], 2):
            item = list(item)
            for _ in range(chance.randint(0, 8)):
                place = chance.randrange(len(item))
                item[place : place + chance.randint(0, 1)] = [chance.choice(["", "q", "Q"])]
            text += " \n" + "".join(item).upper() + "\t " + word()
        docs.append((d, text))
    docs += [(100, None), (101, ""), (None, items[0][1]), (0, docs[0][1])]
    df = spark.createDataFrame([(*d, "old") for d in docs], "doc_id bigint, text string, leaks string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.leaks(df, bench, rate=0.1, block_chars=200).collect()
    expected = Counter()
    for d, text in docs:
        least = {}
        for i, item in items:
            item = decontaminate.plain(item)
            if i is None or not item:
                continue
            away = helpers.edit_distance_within(item, decontaminate.plain(text))
            if away <= int(len(item) * 0.1):
                least[i] = min(away, least.get(i, away))
        expected.update((d, i, n) for i, n in least.items())
    assert Counter((r.doc_id, r.item_id, r.distance) for r in found) == expected
    assert len(expected) > 60
    left = decontaminate.clean(df, bench, rate=0.1)
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        d for d, _ in docs if d is not None and not any(d == e for e, _, _ in expected))
    assert decontaminate.leaks(df, bench.limit(0)).collect() == []
    assert decontaminate.leaks(df.limit(0), bench).collect() == []


def test_benchmark_passages_of_the_given_table(spark):
    found = {(r.doc_id, r.item_id) for r in queries.op6_decontaminate(spark, helpers.SF_DIR).collect()}
    docs = helpers.rows("documents", "doc_id, text", "doc_id")
    items = helpers.rows("benchmark", "item_id, text", "item_id")
    for d, text in docs:
        for i, item in items:
            if decontaminate.plain(item) in decontaminate.plain(text):
                assert (d, i) in found


def test_mix_reaches_target_weights(spark):
    df = spark.range(40_000).selectExpr(
        "id as doc_id", "'t' as text", "case when id % 3 = 0 then 'hot' when id % 100 = 1 then 'rare'"
        " when id % 7 = 0 then null else 'rest' end as source", "'old' as copy")
    weights = spark.createDataFrame(
        [("hot", 1.0), ("rare", 2.0), (None, 1.0), ("absent", 0.0), ("rest", -4.0)],
        "source string, weight double")
    mixed = mixing.mix(df, weights, rows=20_000)
    got = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(got) == {"hot", "rare", None}
    for source, wanted in (("hot", 5000), ("rare", 10_000), (None, 5000)):
        assert abs(got[source] - wanted) < 6 * (wanted * 40) ** 0.5
    rows = mixed.select("doc_id", "copy", "n_copies").collect()
    assert len(set((r.doc_id, r.copy) for r in rows)) == len(rows)
    assert all(1 <= r.copy <= r.n_copies for r in rows)
    again = mixing.mix(df.repartition(3), weights, rows=20_000).select("doc_id", "copy", "n_copies")
    assert Counter(again.collect()) == Counter(rows)


def test_mix_draws_are_poisson(spark):
    df = spark.range(30_000).selectExpr("id as doc_id", "'t' as text", "'s' as source")
    for rate in (0.7, 20.5):
        drawn = mixing.mix(df, rows=int(30_000 * rate)).where("copy = 1").select("n_copies").collect()
        numbers = [r.n_copies for r in drawn] + [0] * (30_000 - len(drawn))
        mean = sum(numbers) / len(numbers)
        spread = sum((x - mean) ** 2 for x in numbers) / len(numbers)
        assert abs(mean - rate) < 5 * (rate / 30_000) ** 0.5
        assert abs(spread / rate - 1) < 0.06


def test_mix_odd_rows(spark):
    rows = [(None, "a", "s"), (None, None, "s"), (1, "x", None), (1, "x", None), (2, "", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix(df, rows=500).collect()
    assert {(r.doc_id, r.text, r.source) for r in mixed} == set(rows)
    assert len({r.n_copies for r in mixed if r.doc_id == 1}) == 1
    assert mixing.mix(df.limit(0)).collect() == []
    named = df.withColumns({c: F.lit(5) for c in ("_mix_parts", "mix_source", "MIX_SUMS", "Parts", "have", "rate")})
    again = mixing.mix(named, rows=500)
    assert again.columns == [*named.columns, "n_copies", "copy", "mix_key"]
    assert sorted(r.mix_key for r in again.collect()) == sorted(r.mix_key for r in mixed)


def test_language_id_held_out_accuracy(spark):
    found = {r.doc_id: r for r in queries.op9_language_id(spark, helpers.SF_DIR).collect()}
    docs = helpers.rows("documents", "doc_id, lang", "doc_id")
    held = [d for d, _ in docs if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(found) == len(docs)
    assert {d for d, r in found.items() if r.held_out} == set(held)
    right = sum(found[d].lang_pred == lang for d, lang in docs if d in set(held))
    assert right / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_id_odd_rows(spark):
    rows = [(1, "the cat and the dog are in the house", "en"), (2, "der hund und die katze im haus", "de"),
            (3, None, "en"), (4, "", None), (5, "123 !?", "en"), (6, "…", "de"), (7, "ж", None),
            (None, "und die der", "de"), (8, "the " * 100_000, None), (1, "the cat", "en")]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows],
                               "doc_id bigint, text string, lang string, lang_pred string, SCORE double")
    found = langid.identify(df).collect()
    assert len(found) == len(rows) and len(found[0]) == 6
    for r in found:
        none = r.text is None or not any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == none and r.lang_pred in ("und", "en", "de")
        assert (r.score == 0) == none
    assert {r.lang_pred for r in langid.identify(df.where("doc_id = 4")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).collect() == []


def test_network_gradients():
    net = langid.train(["abab", "cdcd"], ["x", "y"], langid.Training(epochs=0, hidden=3, window=6))
    chance = np.random.default_rng(0)
    cut = chance.integers(97, 101, (6, 4)).astype(np.uint8)
    filled, target = np.array([6, 3, 6, 1]), np.array([0, 1, 1, 0])
    inside = np.arange(6)[:, None] < filled

    def loss() -> float:
        chances = langid.position_probabilities(net, cut)
        return -float(np.log(chances[:, target, np.arange(4)])[inside].mean())

    for p, g in zip(net.parameters(), langid._gradients(net, cut, filled, target), strict=True):
        flat = np.argsort(-np.abs(g.ravel()))[:3]
        for k in flat:
            at = np.unravel_index(k, g.shape)
            kept = p[at]
            p[at] = kept + 1e-2
            above = loss()
            p[at] = kept - 1e-2
            below = loss()
            p[at] = kept
            assert abs((above - below) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])
