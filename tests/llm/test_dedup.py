from __future__ import annotations

import hashlib
import random

import helpers
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from groundsill.llm import bloom, minhash, queries, substring
from groundsill.llm.components import components
from groundsill.llm.tables import in_small_batches, without

DOCS = "doc_id bigint, text string"


def words(chance: random.Random, n: int, of: int = 5000) -> list[str]:
    return [f"w{chance.randrange(of)}" for _ in range(n)]


def test_near_dedup_on_given_table(spark):
    found = {r.doc_id: r for r in queries.op3_minhash_near_dedup(spark, helpers.SF_DIR).collect()}
    docs = helpers.rows("documents", "doc_id, text", "doc_id")
    expected = helpers.components(docs, 4)
    assert len(found) == len(docs)
    for d, text in docs:
        assert found[d].component_id == expected[d]
        assert found[d].n_shingles == len(helpers.shingles(text, 4))
        assert found[d].kept == (d == expected[d])


def test_near_dedup_hub_with_large_id(spark):
    """Copies that are near a hub but not near each other: the smallest id is no hub."""
    chance = random.Random(1)
    hub = words(chance, 300)
    docs = []
    for i in range(30):
        copy = list(hub)
        for place in chance.sample(range(300), 5):
            copy[place] = f"x{i}-{place}"
        docs.append((i, " ".join(copy)))
    docs += [(1000, " ".join(hub)), (1001, " ".join(hub)), (2000, " ".join(words(chance, 200)))]
    expected = helpers.components(docs, 4)
    assert len(set(expected.values())) == 2
    found = minhash.near_duplicates(spark.createDataFrame(docs, DOCS), minhash.MinHash(shingle=4))
    assert {r.doc_id: r.component_id for r in found.collect()} == expected


def test_near_dedup_odd_rows(spark):
    long = " ".join(words(random.Random(2), 200_000, 10**6))
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "A b"), (5, "a  B"), (5, "a  B"), (6, "a"), (7, "a"),
            (None, "a"), (8, "ÄB c d e"), (9, "äb c d e"), (10, long), (11, long + " z"), (-3, "a b")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS + ", K1 string, component_id int")
    found = minhash.near_duplicates(df, minhash.MinHash(shingle=4)).collect()
    assert len(found) == len(docs)
    by = {r.doc_id: r for r in found}
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, -3)] == [
        1, 2, 3, -3, -3, 6, 6, 8, 9, 10, 10, -3]
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[None].component_id is None and by[None].kept
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_estimate_is_near_the_truth(spark):
    chance = random.Random(3)
    base = words(chance, 2000)
    how = minhash.MinHash(shingle=1)
    docs = [(0, " ".join(base))] + [
        (k, " ".join(base[: 2000 - 100 * k] + words(chance, 100 * k, 10**7))) for k in range(1, 8)]
    marked = minhash.marks(spark.createDataFrame(docs, DOCS), how)
    pairs = marked.where("doc = 0").alias("x").join(marked.where("doc > 0").alias("y"))
    sets = {d: helpers.shingles(t, 1) for d, t in docs}
    for r in pairs.select("y.doc", minhash.estimate(how, "x", "y").alias("e")).collect():
        truth = len(sets[0] & sets[r.doc]) / len(sets[0] | sets[r.doc])
        assert abs(r.e - truth) < 0.17
    assert 0.5 < how.least_estimate < 0.7


def test_components(spark):
    chance = random.Random(4)
    links = [(a, b) for a, b in (sorted(chance.sample(range(400), 2)) for _ in range(300))]
    links += [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in parent}
    assert len(found) == len(parent)


def test_bloom_never_loses_a_key(spark):
    keys = spark.range(0, 4000, 2)
    built = bloom.build(keys, F.xxhash64("id"), 512)
    asked = spark.range(4000)
    passed = {r.id for r in bloom.maybe_in(asked, F.xxhash64("id"), built, 512).collect()}
    assert passed >= set(range(0, 4000, 2)) and len(passed) < 2300
    assert {r.id for r in bloom.not_in(asked, F.xxhash64("id"), built, 512).collect()} == set(
        range(4000)) - passed
    assert built.count() <= 512
    with pytest.raises(ValueError):
        bloom.build(keys, F.xxhash64("id"), bloom.MAX_BLOCKS + 1)


def test_without(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id bigint, block string")
    left = without(df, "doc_id", spark.createDataFrame([(2,), (2,), (None,), (9,)], "x bigint"))
    assert sorted(r.block for r in left.collect()) == ["a", "c"]


def test_substring_on_given_table(spark):
    found = queries.op10_substring_dedup(spark, helpers.SF_DIR).collect()
    expected = helpers.cut_repeats(helpers.rows("documents", "doc_id, text", "doc_id"), 20)
    assert len(found) == len(expected)
    for r in found:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, n - len(kept))
        assert r.kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("window", [1, 3, 20])
def test_substring_hot_passages(spark, window):
    """A third of the rows share one passage; tiny groups and a coarse count force long prefixes."""
    chance = random.Random(5)
    shared = " ".join(words(chance, 60, 30))
    docs = [(i, " ".join(words(chance, 40, 12)) + " " + (shared if i % 3 == 0 else "") + "\n end")
            for i in range(300)]
    docs += [(400, shared + " " + shared), (401, " ".join(["x"] * 100)), (402, None), (403, "")]
    expected = helpers.cut_repeats(docs, window)
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    found = substring.remove_repeats(df, window, group_suffixes=500, resolution=64).collect()
    assert len(found) == len(docs)
    for r in found:
        n, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (n, n - len(kept)), r.doc_id
        assert (r.text or "").split() == kept
        assert sum(b - a for a, b in r.removed_spans) == r.n_removed


def test_substring_odd_rows(spark):
    long = " ".join(words(random.Random(6), 150_000, 10**6))
    docs = [(7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (8, "A b c d"), (9, "x y a b c"),
            (10, long), (11, "q " + long)]
    df = spark.createDataFrame([(*d, "o", b"r") for d in docs], DOCS + ", doc string, runs binary")
    found = substring.remove_repeats(df.withColumn("N_words", F.lit("old")), 3)
    assert found.columns.count("n_words") == 1 and "N_words" not in found.columns
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, []).append(r)
        assert r.doc == "o" and bytes(r.runs) == b"r"
    assert [r.n_removed for r in by[None]] == [0] and by[None][0].text == "a b c d"
    assert len(by[7]) == 2 and by[8][0].text == "A b c d".replace(" b c d", "")
    assert by[9][0].n_removed == 3 and by[9][0].text == "x y"
    assert by[10][0].n_removed == 0 and by[11][0].text == "q"
    assert by[10][0].text == long
    empty = substring.remove_repeats(df.limit(0), 3)
    assert empty.collect() == []


@pytest.mark.parametrize("window", [4, 20])
def test_substring_told_apart_under_one_id(spark, window):
    """Different texts under one id are documents of their own; equal rows are one document."""
    chance = random.Random(window)
    passage = " ".join(f"p{i}" for i in range(window + 5))
    rows = [(1, f"{passage} end"), (7, f"q1 {passage}"), (7, "u1 " + " ".join(f"u{i}" for i in range(60))),
            (7, "u1 " + " ".join(f"u{i}" for i in range(60))), (None, passage), (None, f"n {passage}"),
            (9, " ".join(f"w{i}" for i in range(50))), (9, " ".join(f"w{i}" for i in range(50)))]
    for i in range(20, 60):
        words = [chance.choice("abc") for _ in range(chance.randint(0, 40))]
        rows.append((i // 3, " ".join(words)))
    df = spark.createDataFrame([(i, t, 5, "c") for i, t in rows],
                               "doc_id bigint, text string, copy int, RUNS string").repartition(5)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    several = {i for i, _ in rows if i is not None and len({t for j, t in rows if j == i}) > 1}
    # Documents in order, each once, then cut by brute force under numbers of their own.
    documents = sorted({(i, hashes[t] if i in several else 0, t) for i, t in rows if i is not None})
    expected = helpers.cut_repeats([(n, t) for n, (_, _, t) in enumerate(documents)], window)
    kept = {(i, t): expected[n][1] for n, (i, _, t) in enumerate(documents)}
    found = substring.remove_repeats(df.withColumn("again", F.col("text")), window=window)
    assert found.columns == ["doc_id", "text", "copy", "RUNS", "again", "n_words", "n_removed",
                             "removed_spans", "kept_sha256"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        words = kept[r.doc_id, r.again] if r.doc_id is not None else r.again.split()
        assert r.kept_sha256 == hashlib.sha256(" ".join(words).encode()).hexdigest(), (r.doc_id, r.again)
        assert r.n_words - r.n_removed == len(words) and r["copy"] == 5


def test_suffix_blocks_hold_a_megabyte_of_text_at_most():
    text = " ".join(f"w{i:04d}" for i in range(16_000))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40), pa.int64()), pa.array([0] * 40, pa.int64()), pa.array([text] * 40)],
        ["doc", "copy", "text"])
    blocks = [len(b.at) for b in substring._blocks(batch, 20)]
    assert sum(blocks) == 40 * (16_000 - 19) and max(blocks) <= (1 << 20) // 6


def test_suffix_blocks_of_a_batch_are_equally_large():
    text = " ".join(f"w{i:04d}" for i in range(1_000))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(400), pa.int64()), pa.array([0] * 400, pa.int64()), pa.array([text] * 400)],
        ["doc", "copy", "text"])
    blocks = [len(b.at) for b in substring._blocks(batch, 20)]
    assert sum(blocks) == 400 * (1_000 - 19)
    assert len(blocks) == 3 and max(blocks) - min(blocks) <= 2 * (1_000 - 19)
    assert not list(substring._blocks(batch.slice(0, 0), 20))
    empty = batch.slice(0, 2).set_column(2, "text", pa.array([None, ""]))
    assert [len(b.at) for b in substring._blocks(empty, 20)] == [0]


def test_python_tasks_get_batches_of_two_megabytes(spark):
    session = spark.newSession()
    texts = session.range(0, 600, 1, 1).select(F.repeat(F.lit("word "), 2_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.nbytes]), pa.array([len(batch)])], ["bytes", "rows"])

    found = in_small_batches(texts).mapInArrow(sizes, "bytes bigint, rows bigint").collect()
    assert sum(r.rows for r in found) == 600
    assert len(found) > 1 and max(r.bytes for r in found) <= (2 << 20) + 20_000
