"""Which candidates become evidence, and a reason for each one that does not.

One shuffle by request serves every step: later windows and the fold use the same
distribution. Texts are looked at once each, not once per request, and stay out of that shuffle. A request has at most as many candidates as the search width allows, so the
arrays that the fold works on are bounded. Digests of shingle sets travel in their place: they decide which texts overlap and
which do not, and only where they leave it open do the sets of those texts follow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill import fixed
from groundsill.functions import bind
from groundsill.functions import text as tx
from groundsill.policy import SelectionPolicy
from groundsill.session import materialize

CANDIDATE = [
    "rank", "chunk_id", "similarity", "knowledge_id", "knowledge_type", "equipment_id",
    "event_date", "source_reference", "chunk_text",
]
CONSTRAINTS = ["allowed_types", "required_equipment", "date_from", "date_to"]
COMPARED = ["tokens", "shingles", "digests"]


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def bundle_checks(candidates: DataFrame, requests: DataFrame,
                  allowed_types: list[str] = fixed.KNOWLEDGE_TYPES) -> DataFrame:
    """Contract of a request's results before selection; ``errors`` is empty when it holds.

    Similarity may lie in [-1, 1] with a little slack for rounding.
    """
    sim = F.col("similarity")
    per_rank = candidates.groupBy("request_id", "rank").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("chunk_id").isNull() | F.col("rank").isNull()).alias("no_field"),
        F.count_if(~_finite(sim) | (F.abs(sim) > 1 + 1e-6)).alias("bad_similarity"),
        F.count_if(F.coalesce(tx.sanitize(F.col("chunk_text")), F.lit("")) == "").alias(
            "no_text"
        ),
        F.count_if(
            ~F.coalesce(F.col("knowledge_type").isin(allowed_types), F.lit(False))
        ).alias("bad_type"),
    )
    totals = per_rank.groupBy("request_id").agg(
        F.sum("n").alias("results"), F.count("rank").alias("ranks"),
        F.min("rank").alias("first_rank"), F.sum("no_field").alias("no_field"),
        F.sum("bad_similarity").alias("bad_similarity"), F.sum("no_text").alias("no_text"),
        F.sum("bad_type").alias("bad_type"),
    )
    joined = requests.select("request_id").join(totals, "request_id", "left")
    codes = F.array_compact(F.array(
        F.when(F.col("results").isNull(), F.lit("RESULTS_EMPTY")),
        F.when(F.col("no_field") > 0, F.lit("REQUIRED_FIELD_MISSING")),
        F.when((F.col("first_rank") != 0) | (F.col("ranks") != F.col("results")),
               F.lit("RANK_NOT_STRICT")),
        F.when(F.col("bad_similarity") > 0, F.lit("SIMILARITY_INVALID")),
        F.when(F.col("no_text") > 0, F.lit("TEXT_EMPTY")),
        F.when(F.col("bad_type") > 0, F.lit("TYPE_NOT_ALLOWED")),
    ))
    return joined.select(
        "request_id", F.coalesce("results", F.lit(0)).alias("results"), codes.alias("errors")
    ).withColumn(
        "check_status", F.when(F.size("errors") == 0, fixed.PASSED).otherwise(fixed.FAILED)
    )


def _filter_reason(policy: SelectionPolicy) -> Column:
    """First reason among the checks that look at one candidate alone."""
    sim, kind = F.col("similarity"), F.col("knowledge_type")
    low_top = ~_finite(F.col("top_similarity")) | (
        F.col("top_similarity") < policy.min_top_similarity
    )
    dated = F.col("date_from").isNotNull() | F.col("date_to").isNotNull()
    asks_equipment = F.col("required_equipment").isNotNull()
    typed = F.coalesce(F.array_contains("allowed_types", kind), F.lit(False))
    return (
        F.when(low_top, fixed.DROP_LOW_TOP)
        .when(~_finite(sim) | (sim < policy.min_chunk_similarity), fixed.DROP_FLOOR)
        .when(~F.coalesce("usable", F.lit(False)), fixed.DROP_EMPTY)
        .when(F.col("noise"), fixed.DROP_NOISE)
        .when(F.col("allowed_types").isNotNull() & ~typed, fixed.DROP_TYPE)
        .when(asks_equipment & F.col("equipment_id").isNull(), fixed.DROP_EQUIPMENT_NULL)
        .when(asks_equipment & (F.col("equipment_id") != F.col("required_equipment")),
              fixed.DROP_EQUIPMENT_MISMATCH)
        .when(dated & F.col("event_date").isNull(), fixed.DROP_DATE_NULL)
        .when((F.col("event_date") < F.col("date_from"))
              | (F.col("event_date") > F.col("date_to")), fixed.DROP_DATE_MISMATCH)
    )


def _hashed_shingles(clean: Column) -> Column:
    """The shingles of a cleaned text, which has single blanks only, as a sorted set of 64-bit hashes."""
    return F.sort_array(F.transform(tx.word_shingles(F.split(clean, " ")), lambda s: F.xxhash64(s)))


def text_facts(texts: DataFrame, compared: bool = True) -> DataFrame:
    """What selection asks of a text, found once however many requests met it.

    ``texts`` has distinct ``text_key, chunk_text``. What the fold asks is there if texts are ``compared``:
    the number of words, and the number and the digests of the shingles.
    """
    clean = F.col("_clean")
    usable = F.coalesce(clean != "", F.lit(False))
    cleaned = texts.withColumn("_clean", tx.sanitize(F.col("chunk_text")))
    facts = ["text_key", "chunk_text", usable.alias("usable"), tx.is_noise(clean).alias("noise"),
             tx.has_injection(clean).alias("injected")]
    if not compared:
        return cleaned.select(facts)
    return cleaned.withColumn("_all", F.when(usable, _hashed_shingles(clean))).select(
        *facts, F.when(usable, F.size(F.split(clean, " "))).alias("tokens"),
        F.size("_all").alias("shingles"), tx.set_digests(F.col("_all")).alias("digests"))


def _keyed(candidates: DataFrame, compared: bool) -> tuple[DataFrame, DataFrame]:
    """Candidates by text key without their texts, and the facts of the texts. Facts are written once:
    the checks, the fold and the result read columns of their own from them."""
    rows = candidates.select("request_id", *CANDIDATE).withColumn(
        "text_key", F.unhex(F.sha2("chunk_text", 256)))
    texts = rows.where(F.col("text_key").isNotNull()).select("text_key", "chunk_text").distinct()
    return rows.drop("chunk_text"), materialize(text_facts(texts, compared), dense=True)


def _checked(rows: DataFrame, facts: DataFrame, policy: SelectionPolicy,
             constraints: DataFrame | None) -> DataFrame:
    """Narrow candidates with the best score of their request and ``drop_reason`` of the checks, the
    duplicate rule and the per-knowledge cap. Those without a reason have what the fold asks of their texts,
    if the facts do."""
    # The fold's columns, for rows whose texts and scores can pass.
    compared = [c for c in COMPARED if c in facts.columns]
    rows = rows.join(facts.select("text_key", "usable", "noise", "injected", *compared), "text_key", "left")
    may_pass = (
        _finite(F.col("similarity")) & (F.col("similarity") >= policy.min_chunk_similarity)
        & F.col("usable") & ~F.col("noise")
    )
    rows = rows.withColumns({c: F.when(may_pass, F.col(c)) for c in compared})
    # Before the constraints join: their shuffle is the one that the windows and the fold stay in.
    if constraints is None:
        rows = rows.withColumns({
            "allowed_types": F.lit(None).cast("array<string>"),
            "required_equipment": F.lit(None).cast("string"),
            "date_from": F.lit(None).cast("date"), "date_to": F.lit(None).cast("date"),
        })
    else:
        rows = rows.join(constraints.select("request_id", *CONSTRAINTS), "request_id", "left")
    whole = Window.partitionBy("request_id")
    scored = F.when(~F.isnan("similarity"), F.col("similarity"))
    checked = rows.withColumn("top_similarity", F.max(scored).over(whole)).withColumn(
        "drop_reason", _filter_reason(policy))
    alive = F.col("drop_reason").isNull()

    def nth(*keys: str) -> Column:
        window = Window.partitionBy("request_id", *keys, alive).orderBy("rank", "chunk_id")
        return F.row_number().over(window)

    deduped = checked.withColumn("_nth", nth("chunk_id")).withColumn(
        "drop_reason",
        F.when(alive & (F.col("_nth") > 1), fixed.DROP_DUPLICATE).otherwise(
            F.col("drop_reason")
        ),
    )
    capped = deduped.withColumn("_nth", nth("knowledge_id")).withColumn(
        "drop_reason",
        F.when(
            alive & (F.col("_nth") > policy.max_chunks_per_knowledge_id),
            fixed.DROP_KNOWLEDGE_CAP,
        ).otherwise(F.col("drop_reason")),
    )
    return capped.withColumns({c: F.when(alive, F.col(c)) for c in compared}).drop(
        "_nth", "usable", "noise", *CONSTRAINTS)


def _with_texts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    texts = facts.select("text_key", "chunk_text", tx.sanitize(F.col("chunk_text")).alias("clean_text"))
    return rows.join(texts, "text_key", "left").drop("text_key")


def filter_candidates(candidates: DataFrame, policy: SelectionPolicy,
                      constraints: DataFrame | None = None) -> DataFrame:
    """Adds cleaned text, best score of the request, and ``drop_reason`` of the checks, the
    duplicate rule and the per-knowledge cap. Best ranked copies are kept."""
    rows, facts = _keyed(candidates, compared=False)
    return _with_texts(_checked(rows, facts, policy, constraints), facts)


def _fold(rows: Column, policy: SelectionPolicy, near: Callable[[Column, Column], Column]) -> Column:
    """Overlap rule, hard cap and token budget in rank order: ``out`` has one decision per row.

    A candidate is compared with every one kept so far, kept ones past the hard cap included.
    One that does not fit the budget is skipped and the next is tried. ``near`` says of a kept row's position
    and another one whether their texts overlap; ``open`` is true once it had no answer that counts.
    """
    cap, budget = policy.per_chunk_tokens, policy.max_evidence_tokens

    # The state names kept rows by position and looks them up, so that it stays small.
    def step(state: Column, position: Column) -> Column:
        row = F.get(rows, position)
        reason = row["drop_reason"]
        repeated = reason.isNull() & F.exists(state["kept"], lambda kept: near(kept, position))
        trimmed = F.least(row["tokens"], F.lit(cap))
        no_room = (F.size(state["kept"]) >= policy.max_chunks) | (
            state["used"] + trimmed > budget
        )

        def decide(answer: Column) -> Column:
            is_repeat = F.coalesce(answer, F.lit(False))
            distinct = reason.isNull() & ~is_repeat
            taken = distinct & ~no_room
            decision = F.struct(
                F.when(reason.isNotNull(), reason).when(is_repeat, F.lit(fixed.DROP_OVERLAP))
                .when(no_room, F.lit(fixed.DROP_BUDGET)).alias("reason"),
                F.when(taken, row["tokens"] > cap).alias("needs_trim"),
                F.when(taken, trimmed).alias("reserved_tokens"),
            )
            return F.struct(
                F.when(distinct, F.concat(state["kept"], F.array(position)))
                .otherwise(state["kept"]).alias("kept"),
                (state["used"] + F.when(taken, trimmed).otherwise(F.lit(0))).alias("used"),
                F.concat(state["out"], F.array(decision)).alias("out"),
                (state["open"] | answer.isNull()).alias("open"),
            )

        return bind(repeated, decide)

    start = F.struct(
        F.expr("cast(array() as array<int>)").alias("kept"), F.lit(0).alias("used"),
        F.expr(
            "cast(array() as array<struct<reason:string,needs_trim:boolean,"
            "reserved_tokens:int>>)"
        ).alias("out"),
        F.lit(False).alias("open"),
    )
    return F.aggregate(
        _positions(rows), start, step, lambda state: F.struct(state["out"], state["open"]))


def _positions(rows: Column) -> Column:
    return F.sequence(F.lit(0), F.size(rows) - 1)


def _answers(rows: Column, near: Callable[[Column, Column], Column]) -> Column:
    """Per row that was not dropped what ``near`` says of it and each row before it; false of a dropped one."""
    def passed(position: Column) -> Column:
        return F.get(rows, position)["drop_reason"].isNull()

    def asked(position: Column) -> Column:
        return F.transform(
            F.slice(_positions(rows), F.lit(1), position),
            lambda earlier: F.when(passed(earlier), near(earlier, position)).otherwise(False))

    return F.transform(_positions(rows), lambda position: F.when(passed(position), asked(position)).otherwise(
        F.expr("cast(array() as array<boolean>)")))


def _in_doubt(answers: Column) -> Column:
    """Per row whether an answer about it is missing."""
    def missing(later: Column, position: Column) -> Column:
        return (F.size(later) > position) & F.get(later, position).isNull()

    return F.transform(answers, lambda own, position: F.exists(own, lambda a: a.isNull()) | F.exists(
        answers, lambda later: missing(later, position)))


DECIDED = ["drop_reason", "needs_trim", "reserved_tokens"]
_OPEN = ["open", "place", "tokens", "answers", "in_doubt"]


def _by_digests(checked: DataFrame, policy: SelectionPolicy) -> DataFrame:
    """The fold as far as digests lead. Where they leave something ``open``, all rows of the request keep the
    reason they came with, and bring their ``place`` in rank order, what the digests said, and whether
    an answer about them is missing."""
    names = [*[c for c in CANDIDATE if c != "chunk_text"], "text_key", "top_similarity", "injected",
             "drop_reason"]
    rows = F.col("rows")

    def near(kept: Column, position: Column) -> Column:
        one, other = F.get(rows, kept), F.get(rows, position)
        return tx.surely_overlaps(one["digests"], other["digests"], one["shingles"], other["shingles"],
                                  policy.overlap_ratio_threshold)

    grouped = checked.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct(*names, *COMPARED))).alias("rows"))
    folded = grouped.withColumn("d", _fold(rows, policy, near))
    # Arrays that end early are filled up with nulls when they are zipped.
    answered = folded.withColumn("answers", F.when(F.col("d.open"), _answers(rows, near)).otherwise(
        F.expr("cast(array() as array<array<boolean>>)")))
    # Without digests from here on.
    narrow = F.transform(rows, lambda row: F.struct(*[row[n].alias(n) for n in [*names, "tokens"]]))
    placed = answered.select(
        "request_id", F.col("d.open").alias("open"),
        F.posexplode(F.arrays_zip(
            narrow.alias("row"), F.col("d.out").alias("out"), F.col("answers"),
            _in_doubt(F.col("answers")).alias("in_doubt"))).alias("place", "z"))
    row, out = F.col("z.row"), F.col("z.out")
    settled = ~F.col("open")
    return placed.select(
        "request_id", *[row[n].alias(n) for n in names if n != "drop_reason"],
        F.when(settled, out["reason"]).otherwise(row["drop_reason"]).alias("drop_reason"),
        *[F.when(settled, out[n]).alias(n) for n in DECIDED[1:]],
        "open", "place", row["tokens"].alias("tokens"), F.col("z.answers").alias("answers"),
        F.col("z.in_doubt").alias("in_doubt"))


def _by_shingles(opened: DataFrame, facts: DataFrame, policy: SelectionPolicy) -> DataFrame:
    """The fold of the requests that digests left open. Shingles come along for rows in doubt only."""
    names = [c for c in opened.columns if c not in ("request_id", "open", "place", "in_doubt")]
    doubted = opened.where("in_doubt")
    # Written once, so that its size is known: few keys are sent to the texts, not texts to the keys.
    wanted = materialize(doubted.select("text_key").distinct())
    texts = facts.select("text_key", "chunk_text").join(wanted, "text_key", "left_semi")
    threshold = policy.overlap_ratio_threshold
    hashed = texts.select("text_key", _hashed_shingles(tx.sanitize(F.col("chunk_text"))).alias("all"))
    known = doubted.select("request_id", "place", "text_key").join(hashed, "text_key").select(
        "request_id", F.struct("place", F.struct(
            "all", tx.overlap_key(F.col("all"), threshold).alias("key"))).alias("known"))
    both = opened.select("request_id", F.struct("place", *names).alias("row")).unionByName(
        known, allowMissingColumns=True)
    rows, sets = F.col("rows"), F.col("sets")

    def near(kept: Column, position: Column) -> Column:
        one, other = sets[kept], sets[position]
        return F.coalesce(
            F.get(F.get(rows, position)["answers"], kept),
            tx.overlaps(one["all"], other["all"], one["key"], other["key"], threshold))

    grouped = both.groupBy("request_id").agg(
        F.sort_array(F.collect_list("row")).alias("rows"),
        F.map_from_entries(F.collect_list("known")).alias("sets"))
    decided = grouped.withColumn("d", _fold(rows, policy, near)["out"]).select(
        "request_id", F.explode(F.arrays_zip("rows", "d")).alias("z"))
    return decided.select(
        "request_id", *[F.col(f"z.rows.{n}").alias(n) for n in names if n not in (*DECIDED, *_OPEN)],
        F.col("z.d.reason").alias("drop_reason"),
        *[F.col(f"z.d.{n}").alias(n) for n in DECIDED[1:]])


def select_evidence(candidates: DataFrame, policy: SelectionPolicy,
                    constraints: DataFrame | None = None, unselected_texts: bool = True) -> DataFrame:
    """Every candidate exactly once, with ``drop_reason`` (null = selected), ``needs_trim``,
    ``reserved_tokens``, and whether its text gives instructions (``injected``).

    Texts do not travel with the candidates: what the checks ask of them are flags, what the fold
    compares are digests of the hashed shingles of candidates that can pass, and the texts join the result.
    Decisions are written once; requests that need shingles themselves are told from them. Rows that were not
    selected have no texts if ``unselected_texts`` is false.
    """
    rows, facts = _keyed(candidates, compared=True)
    judged = materialize(
        _by_digests(_checked(rows, facts, policy, constraints), policy), dense=True)
    decided, opened = judged.where(~F.col("open")).drop(*_OPEN), judged.where("open")
    if not opened.isEmpty():
        decided = decided.unionByName(materialize(
            _by_shingles(opened, facts, policy), dense=True))
    if unselected_texts:
        return _with_texts(decided, facts)
    picked = F.col("drop_reason").isNull()
    return _with_texts(decided.where(picked), facts).unionByName(
        decided.where(~picked).drop("text_key"), allowMissingColumns=True)


def selected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("drop_reason").isNull()).drop("drop_reason", "clean_text", "injected")


def drop_events(judged: DataFrame) -> DataFrame:
    """One row per dropped candidate. A request whose best score is too low counts once, and
    that event names no candidate."""
    gated = F.col("drop_reason") == fixed.DROP_LOW_TOP
    dropped = judged.where(F.col("drop_reason").isNotNull())
    single = dropped.where(gated).groupBy("request_id").agg(
        F.first("drop_reason").alias("drop_reason")
    ).select(
        "request_id", F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("string").alias("chunk_id"), "drop_reason",
    )
    return single.unionByName(
        dropped.where(~gated).select(
            "request_id", F.col("rank").cast("int").alias("rank"), "chunk_id", "drop_reason"
        )
    )


def drop_rollup(judged: DataFrame) -> DataFrame:
    return drop_events(judged).groupBy("request_id", "drop_reason").agg(
        F.count("*").alias("events")
    )


def _numbers(text: Column) -> Column:
    pattern = rf"{tx.WORD_START}\d+(?:\.\d+)?{tx.WORD_END}"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))


def conflict_counts(judged: DataFrame) -> DataFrame:
    """Distinct numbers per request and knowledge id in the selected evidence, and the flag.

    A request has at most ``max_chunks`` selected rows, which bounds the collected arrays.
    """
    numbers = F.array_distinct(F.flatten(F.collect_list(_numbers(F.col("chunk_text")))))
    return (
        judged.where(F.col("drop_reason").isNull())
        .groupBy("request_id", "knowledge_id")
        .agg(F.size(numbers).alias("distinct_numbers"))
        .withColumn("possible_conflict", F.col("distinct_numbers") > fixed.CONFLICT_NUMBERS)
    )


def selection_metrics(judged: DataFrame, requests: DataFrame,
                      policy: SelectionPolicy) -> DataFrame:
    """Status, counts, flags and tokens per request; requests without candidates included."""
    reason = F.col("drop_reason")
    gated = F.coalesce(reason == fixed.DROP_LOW_TOP, F.lit(False))
    picked = reason.isNull()
    after_filters = picked | reason.isin(
        fixed.DROP_DUPLICATE, fixed.DROP_KNOWLEDGE_CAP, fixed.DROP_OVERLAP, fixed.DROP_BUDGET
    )
    after_cap = picked | reason.isin(fixed.DROP_OVERLAP, fixed.DROP_BUDGET)
    readable = ~gated & ~F.coalesce(
        reason.isin(fixed.DROP_FLOOR, fixed.DROP_EMPTY, fixed.DROP_NOISE), F.lit(False)
    )
    numbers = F.array_distinct(F.flatten(F.collect_list(
        F.when(picked, _numbers(F.col("chunk_text")))
    )))
    per_knowledge = judged.groupBy("request_id", "knowledge_id").agg(
        F.count("*").alias("n"),
        F.count_if(gated).alias("gated"),
        F.count_if(picked).alias("picked"),
        F.count_if(after_filters).alias("after_filters"),
        F.count_if(after_cap).alias("after_cap"),
        F.sum("reserved_tokens").alias("tokens"),
        F.count_if(readable & F.coalesce("injected", F.lit(False))).alias("injected"),
        F.size(numbers).alias("numbers"),
        F.max("top_similarity").alias("top_similarity"),
    )
    share = F.struct(F.coalesce("knowledge_id", F.lit("")).alias("k"), F.col("after_cap").alias("v"))
    totals = per_knowledge.groupBy("request_id").agg(
        F.sum("n").alias("n"), F.sum("gated").alias("gated"), F.sum("picked").alias("picked"),
        F.sum("after_filters").alias("after_filters"), F.sum("after_cap").alias("after_cap"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.sum("injected").alias("injected"), F.max("numbers").alias("numbers"),
        F.max("top_similarity").alias("top_similarity"),
        F.sort_array(F.collect_list(F.when(F.col("after_cap") > 0, share))).alias("shares"),
    )
    joined = requests.select("request_id").join(totals, "request_id", "left")
    why = (
        F.when(F.col("n").isNull(), fixed.EMPTY_RETRIEVAL)
        .when(F.col("gated") > 0, fixed.DROP_LOW_TOP)
        .when(F.col("after_filters") == 0, fixed.EMPTY_AFTER_FILTERS)
        .when(F.col("after_cap") == 0, fixed.EMPTY_AFTER_CAP)
        .when(F.col("picked") == 0, fixed.EMPTY_AFTER_BUDGETS)
    )
    flags = F.array_compact(F.array(
        F.when(F.col("injected") > 0, F.lit(fixed.FLAG_INJECTION)),
        F.when(F.col("numbers") > fixed.CONFLICT_NUMBERS, F.lit(fixed.FLAG_CONFLICT)),
    ))
    dropped = F.when(F.col("gated") > 0, 1).otherwise(F.col("n") - F.col("picked"))
    return joined.select(
        "request_id",
        F.when(why.isNull(), fixed.OK).otherwise(fixed.NO_EVIDENCE).alias("selection_status"),
        why.alias("empty_reason"),
        F.col("top_similarity"),
        F.coalesce("picked", F.lit(0)).alias("selected_count"),
        F.coalesce(dropped, F.lit(0)).alias("dropped_count"),
        F.coalesce("tokens", F.lit(0)).alias("used_evidence_tokens"),
        F.lit(policy.max_evidence_tokens).alias("evidence_budget"),
        F.lit(policy.per_chunk_tokens).alias("per_chunk_cap_tokens"),
        F.map_from_entries(F.coalesce(
            "shares", F.expr("cast(array() as array<struct<k:string,v:bigint>>)")
        )).alias("knowledge_id_distribution"),
        flags.alias("flags"),
        F.lit(policy.policy_version).alias("policy_version"),
    )
