from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsill.operators import chunking, drift, embedding, index, knowledge, ledgers, quarantine
from groundsill.operators.numbering import dense_numbers
from groundsill.plans.catalog import ON_STAGES
from groundsill.policy import EmbeddingPin, RunLimits
from groundsill.schemas import CHUNK, EMBEDDING, KNOWLEDGE, enforce
from groundsill.operators.chunking import all_chunks
from groundsill.sources import gold, index_sink, index_store, ledger, paths, tables
from groundsill.streaming import ingest
from groundsill.streaming.ingest import ingest_stream

NOW = F.lit("2024-03-01 00:00:00").cast("timestamp")


def test_corrupt_rows_are_set_aside(spark, tmp_path):
    names = gold.GOLD_COLUMNS["maintenance"]
    good = [f"v{i}" for i in range(len(names))]
    lines = [",".join(names), ",".join(good), ",".join(good + ["x", "y"]), ",".join(good[:-3])]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    rows = gold.read_gold(spark, "maintenance", str(tmp_path))
    fine, bad = gold.split_corrupt(rows)
    assert [r.maintenance_id for r in fine.collect()] == ["v0"]
    assert sorted(r.raw_line for r in bad.collect()) == sorted(lines[2:])
    assert knowledge.from_maintenance(fine).count() == 1


def test_null_fields_are_skipped_not_the_sentence(spark):
    row = {name: f"<{name}>" for name in gold.GOLD_COLUMNS["incident"]}
    row.update(incident_date="2024-01-15", root_cause=None)
    schema = ", ".join(f"{n} string" for n in row)
    out = knowledge.from_incidents(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert out.content_text.startswith("Incident report of 2024-01-15: line <line_id>, machine")
    assert "class: <failure_category>. Production stood still" in out.content_text
    assert out.event_date == dt.date(2024, 1, 15)
    assert len(out.metadata) == 10


def test_empty_contract_and_strict_append(spark, tmp_path):
    path = str(tmp_path / "k")
    tables.create_empty(spark, KNOWLEDGE, path)
    assert spark.read.parquet(path).count() == 0
    row = spark.createDataFrame(
        [("k", "sop", "d", "t", "r", None, None, None, None)], KNOWLEDGE)
    tables.append(row, KNOWLEDGE, path)
    assert tables.read_table(spark, path, ["knowledge_id"]).collect()[0][0] == "k"
    broken = row.withColumn("content_text", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="content_text"):
        enforce(broken, KNOWLEDGE).collect()


@pytest.mark.parametrize("text,date,kind,tokens,reason", [
    ("On 125 , x", None, "incident", 1, "MALFORMED_EVENT_DATE_IN_TEXT"),
    ("On 2.0 , x", None, "quality", 1, "MALFORMED_EVENT_DATE_IN_TEXT"),
    ("On 2.0 , x", dt.date(2024, 1, 1), "incident", 1, None),
    ("x", None, "production", 1, "MISSING_EVENT_DATE"), ("x", None, "quality", 1, None),
    ("x", None, "sop", 500, None), ("x", None, "sop", 501, "SOP_TOKEN_OVERFLOW"),
])
def test_corruption_reason(spark, text, date, kind, tokens, reason):
    df = spark.createDataFrame(
        [(text, date, kind, tokens)],
        "chunk_text string, event_date date, knowledge_type_effective string,"
        " chunk_token_count int")
    assert df.select(quarantine.corruption_reason(500)).first()[0] == reason


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_numbers_follow_the_key(spark, parts):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    rows = dense_numbers(df.repartition(parts), "key", "n", 5).collect()
    keys = sorted(r.key for r in rows)
    assert [r.n for r in sorted(rows, key=lambda r: r.key)] == list(range(1000))
    assert len(set(keys)) == 1000


def test_batches_respect_the_cap(spark):
    df = spark.range(230).select(F.format_string("%05d", "id").alias("knowledge_chunk_id"),
                                 F.lit(1).alias("chunk_token_count"))
    sizes = embedding.batches(df, RunLimits(batch_size=500)).groupBy("batch_id").count()
    assert sorted((r[0], r[1]) for r in sizes.collect()) == [(0, 100), (1, 100), (2, 30)]


def embeddings(spark, rows):
    filled = [(c, k, "sop", "ref", "p", "m", v, dim, vec, "h", status, None, None, run, at)
              for c, k, v, dim, vec, status, run, at in rows]
    return spark.createDataFrame(filled, EMBEDDING)


DAY = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]


def test_backlog_retries_failures_only(spark):
    done = embeddings(spark, [("a", "k", "v", 2, [1.0, 0.0], "SUCCESS", "r", DAY[0]),
                              ("b", "k", "v", 2, None, "FAILED", "r", DAY[0])])
    chunks = spark.createDataFrame([("a",), ("b",), ("c",)], "knowledge_chunk_id string")
    left = embedding.backlog(chunks, done, "m").collect()
    assert sorted(r[0] for r in left) == ["b", "c"]
    assert embedding.backlog(chunks, done, "other").count() == 3


def test_upsert_keeps_one_row_per_key(spark):
    old = embeddings(spark, [("a", "k", "v", 2, [1.0, 0.0], "SUCCESS", "r1", DAY[0]),
                             ("b", "k", "v", 2, [1.0, 0.0], "SUCCESS", "r1", DAY[0])])
    new = embeddings(spark, [("b", "k", "v", 2, [0.0, 1.0], "SUCCESS", "r2", DAY[1]),
                             ("b", "k", "v", 2, [0.5, 1.0], "SUCCESS", "r3", DAY[2]),
                             ("c", "k", "v", 2, [0.0, 1.0], "SUCCESS", "r2", DAY[1])])
    merged = embedding.merge_embeddings(old, new).collect()
    assert sorted((r.knowledge_chunk_id, r.pipeline_run_id) for r in merged) == [
        ("a", "r1"), ("b", "r3"), ("c", "r2")]


def test_embed_calls_the_model_in_batches(spark):
    df = spark.createDataFrame([(str(i), "x" * i) for i in range(25)], "id string, t string")
    out = embedding.embed(df, "t", lambda texts: [[float(len(t)), len(texts)] for t in texts],
                          batch_rows=10)
    rows = out.collect()
    assert all(r.embedding_vector[0] == int(r.id) and r.embedding_vector[1] <= 10 for r in rows)


INDEX = ("chunk_id string, knowledge_id string, embedding_vector array<float>, embedding_dim int,"
         " embedding_model_name string, embedding_model_version string, knowledge_type string,"
         " knowledge_id_mismatch boolean")
ROW = ("c", "k", [1.0, 0.0], 2, "m", "v", "sop", False)


@pytest.mark.parametrize("rows,errors", [
    ([ROW], []),
    ([], ["NO_ROWS_IN_INDEX_INPUT"]),
    ([ROW, ROW], ["DUPLICATE_CHUNK_ID_MODEL_VERSION"]),
    ([("c", None, *ROW[2:])], ["NULLS_IN_KNOWLEDGE_ID"]),
    ([("c", "k", [1.0, 0.0, 0.0], 3, *ROW[4:])], ["EMBEDDING_DIMENSION_MISMATCH"]),
    ([("c", "k", [1.0], 2, *ROW[4:])], ["VECTOR_LENGTH_MISMATCH"]),
    ([(*ROW[:7], True)], ["KNOWLEDGE_ID_MISMATCH"]),
])
def test_index_rules_one_by_one(spark, rows, errors):
    verdict = index.validate_index_input(spark.createDataFrame(rows, INDEX), 2)
    row = verdict.first()
    assert row.errors == errors
    assert row.verdict == ("FAILED" if errors else "PASSED")
    if errors:
        with pytest.raises(Exception, match=errors[0]):
            index.require_valid(verdict).collect()


def test_publish_is_immutable_and_checked(spark, tmp_path):
    export = spark.createDataFrame(
        [(0, "a", [1.0, 0.0], "k"), (1, "b", [0.0, 1.0], "k")],
        "vector_id bigint, chunk_id string, unit_vector array<double>, knowledge_id string")
    root, pin = str(tmp_path), EmbeddingPin("m", "v", 2)
    index_store.publish(export, root, "idx", "v1", pin, "run", "2024-01-01")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        index_store.publish(export, root, "idx", "v1", pin, "run", "2024-01-01")
    manifests = index_store.read_manifests(spark, root)
    assert manifests.first().vector_count == 2
    loaded = index_store.load_index(spark, root, "idx", "v1")
    assert index.manifest_checks(manifests, loaded).first().error_code is None
    short = index.manifest_checks(manifests, loaded.where("vector_id = 1")).first()
    assert short.error_code == "MANIFEST_MISMATCH"
    named = loaded.withColumns({"index_name": F.lit("idx"), "index_version": F.lit("v1")})
    asked = spark.createDataFrame(
        [("r1", "idx", "v1"), ("r2", "idx", "v2")],
        "request_id string, index_name string, index_version string")
    checked = index_store.check_versions(asked, index_store.catalog(manifests, named))
    assert {r.request_id: r.index_error for r in checked.collect()} == {
        "r1": None, "r2": "INDEX_NOT_FOUND"}


LOOSE = T.StructType([T.StructField(f.name, f.dataType) for f in KNOWLEDGE.fields])


def incidents(first, n):
    return [(f"k{i}", "incident", "operations", f"pump {i} failure, seal replaced", "r",
             dt.date(2024, 1, 1), {"a": "b"}, None, None) for i in range(first, first + n)]


@pytest.fixture
def stream(spark, tmp_path):
    """Feeds files to a source folder and runs a stream over it by the name of its checkpoint."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def feed(rows):
        spark.createDataFrame(rows, LOOSE).coalesce(1).write.mode("append").parquet(source)

    def run(name, **options):
        ingest_stream(spark, source, target, str(tmp_path / name), NOW, **options).awaitTermination()
        rows = ingest.read_ingested(spark, target).collect()
        assert len({r.knowledge_chunk_id for r in rows}) == len(rows)
        return len(rows)

    return feed, run, target


@pytest.mark.parametrize("options", [{}, {"remember": "30 days"}, {"max_files": 1}])
def test_stream_can_be_replayed(spark, stream, options):
    feed, run, target = stream
    feed(incidents(0, 20))
    assert run("a", **options) == 20
    assert run("a", **options) == 20
    feed(incidents(10, 15) + [(None, *incidents(0, 1)[0][1:])])
    assert run("a", **options) == 25
    assert spark.read.parquet(f"{target}_rejected").count() == 1
    # A new checkpoint has no state; it takes over what the table held, and goes on from there.
    feed(incidents(0, 30))
    assert run("b", **options) == 30
    feed(incidents(25, 10))
    assert run("b", **options) == 35
    assert ingest.new_chunks(spark.createDataFrame([], CHUNK), ingest.read_ingested(spark, target)).isEmpty()


def test_stream_reads_nothing_of_its_own_table(spark, stream, monkeypatch):
    feed, run, _ = stream
    feed(incidents(0, 5))
    assert run("a") == 5
    monkeypatch.setattr(ingest, "read_ingested", None)
    feed(incidents(3, 5))
    with pytest.raises(TypeError):  # by the test's own look at the table, after the stream
        run("a")
    monkeypatch.undo()
    assert run("a") == 8


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_stream_killed_between_its_writes(spark, stream, monkeypatch, dies_at):
    """Before the first write, before the second one, and before the marker."""
    feed, run, target = stream
    feed(incidents(0, 6) + [(None, *incidents(0, 1)[0][1:])])
    assert run("a") == 6
    feed(incidents(4, 6) + [(None, *incidents(1, 1)[0][1:])])
    real, calls = ingest._write, []

    def dying(df, path, fmt):
        calls.append(path)
        if len(calls) == dies_at:
            raise RuntimeError("killed")
        real(df, path, fmt)

    def dying_touch(spark, path):
        if dies_at == 3 and ingest.COMMITS in path:
            raise RuntimeError("killed")
        touch(spark, path)

    touch = paths.touch
    monkeypatch.setattr(ingest, "_write", dying)
    monkeypatch.setattr(paths, "touch", dying_touch)
    with pytest.raises(Exception, match="killed"):
        run("a")
    assert ingest.read_ingested(spark, target).count() == 6
    monkeypatch.undo()
    assert run("a") == 10
    assert spark.read.parquet(f"{target}_rejected").count() == 2
    assert run("a") == 10


def test_stream_adds_to_a_table_of_plain_files(spark, stream):
    feed, run, target = stream
    old = all_chunks(spark.createDataFrame(incidents(0, 4), KNOWLEDGE), NOW)
    tables.append(old, CHUNK, target)
    feed(incidents(2, 4))
    assert run("a") == 6


# --- tables in buckets -------------------------------------------------------------------
KEYED = "id string, model string, value int, at int"


def test_bucketed_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["id", "model"]
    rows = [(f"c{i}", "m", i, 0) for i in range(200)] + [(None, "m", 7, 0)]
    tables.create_bucketed(spark.createDataFrame(rows, KEYED), path, keys, 16)

    def listing():
        return {d: paths.files(spark, f"{path}/{d}") for d in paths.children(spark, path) if "=" in d}

    before = listing()
    assert len(before) == 16
    changes = [("c3", "m", -3, 1), ("c3", "m", -33, 2), ("c5", "other", 55, 1), (None, "m", 8, 1)]
    changed = spark.createDataFrame(changes, KEYED)
    touched = tables.upsert_buckets(changed, path, keys, ["at"])
    after = listing()
    assert 0 < len(touched) <= 3
    for folder, found in before.items():
        same = int(folder.split("=")[1]) not in touched
        assert (after[folder] == found) == same
    expected = {(i, m): v for i, m, v, _ in rows} | {("c3", "m"): -33, ("c5", "other"): 55, (None, "m"): 8}
    table = tables.read_bucketed(spark, path)
    assert table.columns == ["id", "model", "value", "at"]
    assert {(r.id, r.model): r.value for r in table.collect()} == expected
    assert table.count() == len(expected)
    # Again: the same rows; and a merge of nothing touches nothing.
    assert tables.upsert_buckets(changed, path, keys, ["at"]) == touched
    assert {(r.id, r.model): r.value for r in tables.read_bucketed(spark, path).collect()} == expected
    last = listing()
    assert tables.upsert_buckets(changed.limit(0), path, keys, ["at"]) == [] and listing() == last
    with pytest.raises(ValueError, match="not a bucketed table"):
        tables.upsert_buckets(changed, str(tmp_path), keys, ["at"])


# --- ledgers -----------------------------------------------------------------------------
LEDGER = T.StructType([T.StructField("request_id", T.StringType(), False),
                       T.StructField("status", T.StringType())])


def test_a_run_is_added_to_a_ledger_once(spark, tmp_path):
    path = str(tmp_path / "ledger")

    def run(run_id, rows):
        return ledger.append_run(
            spark.createDataFrame(rows, "request_id string, status string"), LEDGER, path, run_id,
            ["request_id"])

    assert ledger.read_ledger(spark, LEDGER, path).collect() == []
    assert run("r1", [("a", "OK"), ("b", None)]) is True
    assert run("r1", [("a", "OK"), ("b", None)]) is False
    assert run("r2", []) is True
    with pytest.raises(ledger.DuplicateKeys):
        run("r3", [("a", "OK"), ("a", "OTHER")])
    with pytest.raises(Exception, match="null in required column"):
        run("r4", [(None, "OK")])
    assert run("r3", [("a", "LATE")]) is True
    rows = ledger.read_ledger(spark, LEDGER, path)
    assert sorted((r.ledger_run, r.request_id, r.status) for r in rows.collect()) == [
        ("r1", "a", "OK"), ("r1", "b", None), ("r3", "a", "LATE")]
    assert ledger.read_ledger(spark, LEDGER, path, ["r3"]).count() == 1
    assert paths.children(spark, f"{path}/{ledger.STAGING}") == []
    for bad in ("", "a/b", "a=b", "_x"):
        with pytest.raises(ValueError):
            run(bad, [])


# --- published versions ------------------------------------------------------------------
EXPORT = "vector_id bigint, chunk_id string, unit_vector array<double>, knowledge_id string"


def numbered(spark, n, dimension=2):
    return spark.createDataFrame(
        [(i, f"c{i}", [1.0] * dimension, "k") for i in range(n)], EXPORT).repartition(5)


def test_published_by_the_sink(spark, tmp_path):
    root, pin = str(tmp_path), EmbeddingPin("m", "v", 2)
    for version, n in (("v1", 40), ("v0", 0)):
        index_sink.publish(numbered(spark, n), root, "idx", version, pin, "run", "2024-01-01")
        loaded = index_sink.load_published(spark, root, "idx", version)
        assert sorted(r.vector_id for r in loaded.collect()) == list(range(n))
    manifests = index_store.read_manifests(spark, root)
    assert {r.index_version: (r.vector_count, r.embedding_dim, r.embedding_model_name)
            for r in manifests.collect()} == {"v1": (40, 2, "m"), "v0": (0, 2, "m")}
    one = manifests.where("index_version = 'v1'")
    assert index.manifest_checks(one, index_sink.load_published(
        spark, root, "idx", "v1")).first().error_code is None
    with pytest.raises(Exception, match="already exists"):
        index_sink.publish(numbered(spark, 3), root, "idx", "v1", pin, "run", "2024-01-01")
    assert index_sink.load_published(spark, root, "idx", "v1").count() == 40
    assert [c for c in paths.children(spark, f"{root}/index_name=idx/index_version=v1")] == [
        "manifest", "vectors"]


@pytest.mark.parametrize("broken", ["task", "ids", "dimensions"])
def test_a_failed_publish_leaves_no_version(spark, tmp_path, broken):
    root, pin = str(tmp_path), EmbeddingPin("m", "v", 2)
    export = numbered(spark, 50)
    if broken == "task":
        export = export.withColumn("chunk_id", F.when(
            F.col("vector_id") == 33, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("chunk_id")))
    elif broken == "ids":
        export = export.withColumn("vector_id", F.col("vector_id") * 2)
    else:
        export = export.withColumn("unit_vector", F.when(
            F.col("vector_id") == 3, F.array(F.lit(1.0))).otherwise(F.col("unit_vector")))
    with pytest.raises(Exception):
        index_sink.publish(export, root, "idx", "v1", pin, "run", "2024-01-01")
    left = paths.children(spark, f"{root}/index_name=idx/index_version=v1")
    assert all(name.startswith("_staging-") for name in left) and (broken == "task" or left == [])
    with pytest.raises(ValueError, match="no such index version"):
        index_sink.load_published(spark, root, "idx", "v1")
    # What a killed driver leaves behind is in nobody's way.
    (tmp_path / "index_name=idx/index_version=v1/_staging-dead").mkdir(parents=True)
    index_sink.publish(numbered(spark, 3), root, "idx", "v1", pin, "run", "2024-01-01")
    assert index_sink.load_published(spark, root, "idx", "v1").count() == 3


def test_retention_drops_old_rows(spark, tmp_path):
    log = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(100)], "id int, ts timestamp")
    ledgers.rewrite_retained(log, "ts", F.lit("2024-04-09").cast("date"), str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert sorted(r.id for r in kept.collect()) == list(range(9, 100))
    assert kept.select("log_day").distinct().count() == 91


def test_csv_lines_keep_columns_in_place(spark):
    names = gold.GOLD_COLUMNS["sop"]
    full = ",".join(f'"v{i}"' for i in range(len(names)))
    lines = [
        (1, full), (2, full.replace('"v1"', '"a, ""b"" c"').replace('"v2"', "")), (3, full + ",x"),
        (4, "a,b"), (5, full + ',"open'), (6, ",".join(names)), (7, "   "), (8, None), (9, ""),
        (10, full.replace('"v3"', '"two, commas, in quotes"')), (10, full), (11, "x" * 50_000)]
    df = spark.createDataFrame([(i, t, "old") for i, t in lines], "id int, line string, sop_id string")
    parsed = gold.parse_lines(df, "sop")
    rows = {(r.id, r.line): r for r in parsed.collect()}
    assert len(rows) == len(lines)
    reasons = {i: r.reject_reason for (i, _), r in rows.items()}
    assert reasons == {1: None, 2: None, 3: "TOO_MANY_FIELDS", 4: "TOO_FEW_FIELDS", 5: "OPEN_QUOTE",
                       6: "HEADER_LINE", 7: "BLANK_LINE", 8: "BLANK_LINE", 9: "BLANK_LINE", 10: None,
                       11: "TOO_FEW_FIELDS"}
    by_id = {i: r for (i, _), r in rows.items()}
    assert by_id[2].document_title == 'a, "b" c' and by_id[2].document_type is None
    assert all(by_id[3][n] is None for n in names) and by_id[3].n_fields == len(names) + 1
    assert by_id[1].sop_id == "v0" and by_id[7].n_fields is None
    assert gold.good_rows(parsed, "sop").columns == names
    assert gold.good_rows(parsed, "sop").count() == 4 and gold.rejected_lines(parsed).count() == 8
    assert gold.parse_lines(df.limit(0), "sop").collect() == []


# --- sketches and digests ----------------------------------------------------------------
def test_merged_sketches_stay_within_their_rank_error(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "sop").otherwise("incident").alias("knowledge_type_effective"),
        F.expr("date_add(date'2024-01-01', cast(id % 40 as int))").alias("event_date"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("int").alias("chunk_token_count"))
    stored = chunking.token_sketches(rows)
    assert stored.count() == 80 and stored.agg(F.max(F.length("sketch"))).first()[0] < 200_000
    merged = {r.knowledge_type_effective: r for r in chunking.merge_token_sketches(stored).collect()}
    whole = {r.knowledge_type_effective: r for r in rows.groupBy("knowledge_type_effective").agg(
        F.count("*").alias("rows"), F.min("chunk_token_count").alias("low"),
        F.max("chunk_token_count").alias("high")).collect()}
    for kind, found in merged.items():
        assert (found.rows, found.min_tokens, found.max_tokens) == tuple(whole[kind])[1:]
        for share, value in ((0.5, found.p50_tokens), (0.95, found.p95_tokens)):
            of = rows.where(F.col("knowledge_type_effective") == kind)
            below = of.where(F.col("chunk_token_count") <= value).count() / found.rows
            assert abs(below - share) < 0.002
    # A new day is merged without the rows of the others; few rows are told exactly.
    few = spark.createDataFrame([("sop", dt.date(2024, 1, d), n) for d, n in ((1, 5), (1, 7), (2, 9))],
                                "knowledge_type_effective string, event_date date, chunk_token_count int")
    parts = [chunking.token_sketches(few.where(F.dayofmonth("event_date") == d)) for d in (1, 2)]
    (row,) = chunking.merge_token_sketches(parts[0].unionByName(parts[1])).collect()
    assert tuple(row) == ("sop", 3, 5, 7, 9, 9)


def test_token_stats_rollup_is_exact_past_the_size_of_a_sketch(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "sop").otherwise("incident").alias("knowledge_type_effective"),
        F.expr("date_add(date'2024-01-01', cast(id % 4 as int))").alias("event_date"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("int").alias("chunk_token_count"))
    stages = type("Stages", (), {"chunks": rows})
    found = {r.knowledge_type_effective: r for r in ON_STAGES["token_stats_rollup"](stages).collect()}
    said = {}
    for r in rows.collect():
        said.setdefault(r.knowledge_type_effective, []).append(r.chunk_token_count)
    for kind, counts in said.items():
        counts.sort()
        n = len(counts)
        assert tuple(found[kind])[1:] == (
            n, counts[0], counts[-(-n // 2) - 1], counts[-(-n * 95 // 100) - 1], counts[-1])


DRIFT = "id string, part int, said array<string>, n double"


def test_digests_find_where_tables_differ(spark):
    rows = [(f"k{i}", i % 3, ["a", None] if i % 2 else None, i / 7) for i in range(500)]
    rows += [(None, 1, [], None), ("twice", 1, [], 1.0), ("twice", 1, [], 1.0)]
    first = spark.createDataFrame(rows, DRIFT)
    keys = ["id", "part"]

    def digest(df):
        return drift.whole(drift.fingerprint(df, keys, ranges=64)).first()

    again = spark.createDataFrame(rows[::-1], DRIFT).repartition(7)
    assert digest(first) == digest(again) and digest(first).rows == len(rows)
    halves = [drift.fingerprint(first.where(c), keys, ranges=64) for c in ("part = 1", "part <> 1")]
    assert drift.whole(halves[0].unionByName(halves[1])).first() == digest(first)
    assert drift.changes(first, again, keys).collect() == []
    other = dict(enumerate(rows))
    other[3] = ("k3", 0, ["a", ""], 3 / 7)  # a null became an empty string
    other[500] = (None, 1, [], 0.0)
    del other[501], other[10]
    other[600] = ("fresh", 2, None, None)
    second = spark.createDataFrame(list(other.values()), DRIFT)
    found = drift.changes(first, second, keys, ranges=64).collect()
    assert sorted((r.id or "", r.part, r.change) for r in found) == [
        ("", 1, "CHANGED"), ("fresh", 2, "ADDED"), ("k10", 1, "REMOVED"), ("k3", 0, "CHANGED"),
        ("twice", 1, "CHANGED")]
    apart = drift.differing(drift.fingerprint(first, keys), drift.fingerprint(second, keys))
    assert 1 <= apart.count() <= 5
    assert drift.changes(first.limit(0), first.limit(0), keys).collect() == []
    assert {r.change for r in drift.changes(first.limit(0), first, keys).collect()} == {"ADDED"}
    assert drift.whole(drift.fingerprint(first.limit(0), keys)).first().rows == 0
