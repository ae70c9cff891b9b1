from __future__ import annotations

import base64
import hashlib
import html as html_module
import random
import re
import zlib

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from groundsill.llm import decontaminate, extract, langid, neighbours, queries, tokens, warc
from groundsill.llm.tables import table
from groundsill.session import materialize, shared_dir


def page(host: str, n: int, body: str, extra: str = "") -> tuple:
    return (n, f"https://{host}/{n}", (
        f"<html><head><title>t {n}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
        f"<header>Site name</header><nav><ul><li><a href='/'>Home</a></li><li>About {n}</li></ul></nav>"
        f"<div class='ad'>Buy {n}</div>{body}<aside>See also {n}</aside>"
        f"<form><label>Mail</label><button>Send</button></form>{extra}"
        f"<footer>&copy; {host} {n}</footer></body></html>"))


def test_extraction_on_given_table(spark):
    found = {r.page_id: r for r in queries.op2_html_extraction(spark, helpers.SF_DIR).collect()}
    pages = helpers.rows("pages", "page_id, url, html", "page_id")
    assert len(found) == len(pages)
    for n, url, source in pages:
        article = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
        article = re.sub(r"</?(b|i|a)\b[^>]*>", "", article)
        text = " ".join(html_module.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert (found[n].url, found[n].text, found[n].n_chars) == (url, text, len(text))


def test_extraction_leaves_out_what_is_no_article(spark):
    rows = [page("a.org", n, (
        f"<article><h1>Title &amp; {n}</h1><p>One<b>two</b>  {n}\n three<p class='notice'>Mind {n}"
        f"<p>Four<br>five &lt;6&gt;</p><div class='share'>Share {n}</div>"
        f"<div id='comments'><p>Nice! {n}</p></div><section><p>Same everywhere</p></section></article>"),
        f"<div class='cookie-notice'>Cookies {n}</div>") for n in range(6)]
    rows += [page("b.org", n, f"<div class='x'><p>Long main text number {n} of a page</p><p>More {n}</p></div>"
                  f"<div class='y'>Tick</div>") for n in range(10, 16)]
    rows += [page("f.org", n, f"<div class='w'><div class='c'><h1>Head {n}</h1><div class='b'><p>Body of the"
                  f" page number {n}, long enough to matter</p></div></div><div class='z'>{n}"
                  "</div></div>") for n in range(30, 36)]
    rows += [page("c.org", 20, "<main><p>Alone</p></main>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in extract.extract(df).collect()}
    for n in range(6):
        assert found[n] == f"Title & {n} Onetwo {n} three Four five <6>"
    for n in range(10, 16):
        assert found[n] == f"Long main text number {n} of a page More {n}"
    for n in range(30, 36):
        assert found[n].startswith(f"Head {n} Body of the page number {n}, long enough to matter")
    assert found[20] == "Alone"
    said = {r.host: r.wrapper for r in extract.wrappers(df).collect()}
    assert "(<li>" in said["a.org"] or "<li>" in said["a.org"]
    assert "#TEXT" in said["a.org"] and "Site name" in said["a.org"]


def test_copies_on_one_host_keep_their_text(spark):
    rows = [(n, *page("d.org", 1, "<article><section><p>Copied words</p></section></article>")[1:])
            for n in range(20)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in extract.extract(df).collect()} == {"Copied words"}


def test_template_is_counted_over_all_pages(spark):
    def row(n: int, body: str, rest: str = "") -> tuple:
        return n, f"https://g.org/{n}", f"<html><body><article>{body}</article>{rest}</body></html>"

    rows = [row(n, f"<p>Words of page number {n}</p><section>"
                   f"{'Terms apply' if n >= 15 else f'Real text {n}'}</section>") for n in range(400)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in extract.extract(df).collect()}
    for n in range(400):
        assert found[n] == f"Words of page number {n}" + (f" Real text {n}" if n < 15 else "")
    # Copies of one article, also under other menus or titles, keep it.
    body = "<div class='body'><p>The one article that all pages hold</p></div>"
    rows = [row(n, body, f"<nav>Menu {n}</nav><div class='x'>Other {n}</div>") for n in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in extract.extract(df).collect()} == {"The one article that all pages hold"}
    rows = [row(n, f"<h1>T {n}</h1>{body}") for n in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in extract.extract(df).collect()} == {
        f"T {n} The one article that all pages hold" for n in range(40)}


def test_wrapper_decides_what_is_template(spark):
    # The sections have one path; only their place in the wrapper tells them apart.
    rows = [(n, f"https://w.org/{n}", (
        f"<html><body><article><h1>Title {n}</h1><p>Words of page {n}</p><section><p>Terms apply</p>"
        f"</section><hr>{f'<section><p>Real text {n}</p></section>' if n % 2 else ''}"
        f"{'<section><p>Terms apply</p></section>' if n == 8 else ''}"
        f"</article></body></html>")) for n in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in extract.extract(df).collect()}
    for n in range(40):
        assert found[n] == f"Title {n} Words of page {n}" + (f" Real text {n}" if n % 2 else "") + (
            " Terms apply" if n == 8 else "")


def test_pages_are_matched_against_the_wrapper():
    pages = [f"<article><section>A</section>{'<ul><li>x</li></ul>' * k}<section>{k}</section></article>"
             for k in (1, 2, 3)]
    plan = extract.Plan(extract.encoded(extract.infer(pages)))

    def cells(page: str) -> list[int | None]:
        _, found, tokens = extract.pieces(page)
        met = plan.match(tokens)
        return [met.get(x.token) for x in found if x.container is not None]

    known = [cells(p) for p in pages]
    assert [len(x) for x in known] == [3, 4, 5] and all(None not in x for x in known)
    assert len({(x[0], x[1], x[-1]) for x in known}) == 1 and len(set(known[2])) == 3
    odd = cells(pages[0].replace("<ul>", "<blockquote>new</blockquote><ul>"))
    assert odd == [known[0][0], None, known[0][1], known[0][2]]


@pytest.mark.parametrize("around", [
    "div class='layout has-sidebar'", "div class='no-sidebar'", "div class='with-comments x'", "form action='/'",
    "div id='sticky-footer'", "div class='sidebar'", "div role='search' class='newsletter'"])
def test_names_leave_out_no_article(around):
    close = around.split()[0]
    article = "<article><p>All of the text</p><div class='share'>Share</div></article>"
    for body in (article, article.replace("article", "main"), f"<main>{article}</main>"):
        page = f"<body><nav>Menu</nav><{around}>{body}<div class='related'>More</div></{close}></body>"
        assert extract.main_text(page, None) == "All of the text"
    page = f"<body><main><{around}>{article}</{close}</main></body>"
    assert extract.main_text(page, None) == "All of the text"
    plain = f"<body><nav>Menu</nav><{around}><p>All of the text</p><div class='ad'>Buy</div></{close}></body>"
    assert extract.main_text(plain, None) == "All of the text"


def test_names_still_leave_out_what_is_beside():
    article = "<article><p>All of the text, at some length</p></article>"
    for name in ("related-posts", "comments-area", "sidebar", "share-buttons", "cookie-notice", "page-footer"):
        beside = f"<div class='{name}'><article>A teaser</article></div>"
        assert extract.main_text(article + beside, None) == "All of the text, at some length"
        assert extract.main_text(f"<p>All of the text</p><div class='{name}'>Beside</div>", None) == (
            "All of the text")


def test_extraction_odd_rows(spark):
    long = "<article>" + "<p>word &eacute; </p>" * 50_000 + "</article>"
    rows = [(1, None, None), (2, "http://e.org/", ""), (3, "http://e.org/", "plain &amp; words"),
            (4, "nonsense", "<p>a<p>b"), (5, "http://e.org/x", "<article><p>cut off <b>here"),
            (5, "http://e.org/x", "<article><p>cut off <b>here"), (None, "http://e.org/", "<div"),
            (6, "http://e.org/", "</div></p>x<!-- <p>no</p>"), (7, "http://e.org/", long)]
    df = spark.createDataFrame([(*r, "h", 3) for r in rows],
                               "page_id bigint, url string, html string, host string, TEXT int")
    found = extract.extract(df).collect()
    assert sorted((r.page_id or 0, r.text) for r in found) == [
        (0, ""), (1, ""), (2, ""), (3, "plain & words"), (4, "a b"), (5, "cut off here"),
        (5, "cut off here"), (6, "x"), (7, " ".join(["word é"] * 50_000))]
    assert all(r.n_chars == len(r.text) and r["host"] == "h" for r in found)
    assert extract.extract(df.limit(0)).collect() == []


def test_alignment_makes_groups_and_slots():
    pages = [f"<ul>{'<li>x</li>' * n}</ul><p>text {n}</p>{'<hr>' if n == 2 else ''}<b>end</b>"
             for n in (1, 2, 4)]
    said = " ".join(map(str, extract.infer(pages)))
    assert "(<li> #TEXT </li>)+" in said and "#TEXT" in said and "(<hr>)?" in said and "end" in said


def test_tree_follows_random_edits():
    with_, chance = tokens.tokenizer(tokens.VOCABULARY), random.Random(9)
    parts = [" ", "  ", "\n", "\n\n ", "a", "don't", "'ll", "'", "123", " word", "é", "...", "", "x y z", "😀"]
    for _ in range(400):
        text = "".join(chance.choice(parts) for _ in range(chance.choice([0, 3, 40, 900])))
        tree = tokens.Tree(text, with_)
        assert tree.total() == with_.whole(text)
        for _ in range(6):
            start, length = chance.randint(0, len(text) + 2), chance.choice([0, 0, 1, 3, 60])
            new = "".join(chance.choice(parts) for _ in range(chance.randint(0, 4)))
            start = min(start, len(text))
            text = text[:start] + new + text[start + length :]
            tree.edit(start, length, new)
            assert tree.text == text and tree.chars[1] == len(text)
            assert tree.total() == tree.tokens[1] == with_.whole(text)


def test_edits_touch_few_pretokens():
    with_ = tokens.tokenizer(tokens.VOCABULARY)
    tree = tokens.Tree("some words in a row " * 20_000, with_)
    for k in range(50):
        tree.edit(k * 7919 % 400_000, 3, "new")
    assert tree.encoded < 50 * 12 and tree.total() == with_.whole(tree.text)


def test_token_counts_on_given_table(spark):
    found = {r.doc_id: r for r in queries.op4_token_counts(spark, helpers.SF_DIR).collect()}
    with_ = tokens.tokenizer(tokens.VOCABULARY)
    docs = helpers.rows("documents", "doc_id, text, source", "doc_id")
    assert len(found) == len(docs)
    for d, text, source in docs:
        line, size = text.find("\n") + 1, len(text)
        after = text[line:]
        for start, length, new in (
                ((size - line) // 2, 0, " [edited] "), ((size - line) // 3, 12, source),
                (size - line + 20, 0, "\nSource: edited by hand.")):
            start = min(start, len(after))
            after = after[:start] + new + after[start + length :]
        assert found[d].tokens_before == with_.whole(text)
        assert found[d].tokens_after == with_.whole(after)


def test_token_counts_odd_rows(spark):
    rows = [(1, None, [(0, 0, "a b")]), (2, "", None), (3, "abc", [(-5, 2, None), (99, 9, " z"), None]),
            (4, "abc", [(None, None, "x")]), (4, "abc", []), (None, "q", [(0, 1, "")])]
    df = spark.createDataFrame(
        rows, f"doc_id bigint, text string, changes {tokens.EDITS_TYPE}").withColumn("N_edits", F.lit("o"))
    found = tokens.count_edited(df, F.col("changes"))
    got = sorted(((r.doc_id or 0), r.n_edits, r.tokens_before, r.tokens_after) for r in found.collect())
    whole = tokens.tokenizer(tokens.VOCABULARY).whole
    assert got == [
        (0, 1, whole("q"), 0), (1, 1, 0, whole("a b")), (2, 0, 0, 0), (3, 2, whole("abc"), whole("c z")),
        (4, 0, whole("abc"), whole("abc")), (4, 1, whole("abc"), whole("xabc"))]
    assert tokens.count_edited(df.limit(0), F.col("changes")).collect() == []
    named = df.withColumn("_edits", F.lit(1)).withColumnRenamed("changes", "Edits")
    again = tokens.count_edited(named, F.col("Edits"))
    assert again.columns[:4] == ["doc_id", "Edits", "_edits", "tokens_before"]
    assert sorted(r.tokens_after for r in again.collect()) == sorted(r[3] for r in got)


def brute(vectors: np.ndarray, ids: np.ndarray, query: int, k: int) -> list[int]:
    scores = vectors @ vectors[np.flatnonzero(ids == query)[0]]
    scores[ids == query] = -np.inf
    return ids[np.lexsort((ids, -scores))][: min(k, len(ids) - 1)].tolist()


def test_neighbour_recall(spark):
    chance = np.random.default_rng(1)
    ids = np.arange(6000)
    vectors = chance.normal(size=(6000, 32)).astype(np.float32)
    vectors[3000:] = vectors[:3000] * chance.uniform(0.2, 3, (3000, 1)).astype(np.float32)
    df = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id bigint, embedding array<float>")
    found = neighbours.search(df, df.where("vec_id % 100 = 0")).collect()
    exact = vectors.astype(np.float64)
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    shares = []
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and q not in {r.vec_id for r in rows}
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert np.allclose([r.score for r in rows], exact[[r.vec_id for r in rows]] @ exact[q])
        shares.append(len({r.vec_id for r in rows} & set(brute(exact, ids, q, 20))) / 20)
    assert len(by) == 60 and np.mean(shares) >= 0.9


def test_neighbour_recall_on_given_table(spark):
    rows = helpers.rows("embeddings", "vec_id, embedding", "vec_id")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    by = {}
    for r in queries.op5_neighbours(spark, helpers.SF_DIR).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(by) == set(ids[ids % 20 == 0].tolist())
    shares = [len(by[q] & set(brute(vectors, ids, q, 20))) / min(20, len(ids) - 1) for q in by]
    assert np.mean(shares) >= 0.9


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(100)] + [
        (200, None), (220, [0.0, 0.0]), (240, [1.0, None]), (260, [nan, 1.0]), (280, [inf, 1.0]),
        (300, [1.0]), (320, []), (None, [1.0, 0.0]), (340, [0.5, 0.5]), (340, [0.5, 0.5]), (-20, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, SCORE int")
    found = neighbours.search(df, df.where("vec_id % 20 = 0")).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {0, 20, 40, 60, 80, 340, -20}
    assert by[0] == [-20, *range(1, 20)] and by[20] == [-20, *range(19)] and by[340] == [-20, *range(19)]
    few = neighbours.search(df.where("vec_id in (0, 340, -20)"), df.where("vec_id = 0")).collect()
    assert [r.vec_id for r in few] == [-20, 340]
    assert neighbours.search(df.limit(0), df).collect() == []
    assert neighbours.search(df.where("vec_id = 0"), df.where("vec_id = 0")).collect() == []


def test_warc_round_trip(spark):
    texts = [None, "", "", "é" * 3, "é" * 3, "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", "y" * 300_000, "z"]
    rows = [(i, f"http://h/{i}\r\nX: 1 ", t) for i, t in enumerate(texts)]
    rows += [(7, None, "z"), (None, "http://n/", "z"), (20, "http://h/", "é" * 3)]
    df = spark.createDataFrame([(*r, "q", 0) for r in rows],
                               "page_id bigint, url string, html string, payload string, KEPT int")
    folder = warc.archive(df.repartition(3))
    found = warc.read_records(spark, folder, with_payload=True).collect()
    assert len(found) == len(rows)
    kept = {}
    for n, _, text in rows:
        if n is not None:
            kept[text or ""] = min(n, kept.get(text or "", n))
    for n, _, text in rows:
        body = (text or "").encode()
        first = kept[text or ""]
        want = (n, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                "response" if n == first else "revisit", None if n == first else first,
                body.decode() if n == first else None)
        assert tuple(next(r for r in found if tuple(r) == want)) == want
    small = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id bigint, url string, html string")
    read = warc.read_records(spark, warc.archive(small, least_bytes=3)).collect()
    assert [r.record_type for r in read] == ["response", "response"]
    assert warc.read_records(spark, warc.archive(df.limit(0))).collect() == []


def test_every_member_stands_alone(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(40)], "page_id bigint, url string, html string")
    folder = warc.archive(pages.repartition(2))
    index = warc.read_index(spark, folder).collect()
    assert len(index) == 40
    for archive in {r.archive for r in index}:
        data = open(f"{folder.removeprefix('file://').removeprefix('file:')}/{archive}", "rb").read()
        mine = sorted((r.offset, r.length, r.record_id) for r in index if r.archive == archive)
        assert sum(length for _, length, _ in mine) == len(data)
        for offset, length, record_id in mine:
            record = zlib.decompress(data[offset : offset + length], 31)
            assert record.startswith(b"WARC/1.1\r\n") and record_id.encode() in record
        assert len(list(warc.split_records(data))) == len(mine)
    with pytest.raises(ValueError):
        list(warc.split_records(_gzip(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort")))


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def test_language_sample_takes_different_texts(spark):
    how = langid.Training(texts=15)
    few = spark.range(6000).selectExpr("id doc_id", "concat('copied text ', id % 20) text", "'aa' lang")
    # A text that comes first in the order, and very often, takes one place only.
    first = spark.range(300).selectExpr("id doc_id", "concat('own text ', id) text").where(
        ~langid.held_out()).orderBy(F.xxhash64(F.lit(how.seed), "text")).first().text
    often = spark.range(300).selectExpr("id doc_id", "concat('own text ', id) text", "'bb' lang")
    copies = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(first).alias("text"), F.lit("bb").alias("lang"))
    alone = spark.range(40).selectExpr("id doc_id", "concat('only ', id % 3) text", "'cc' lang")
    rows = langid.training_sample(few.union(often).union(copies).union(alone), how)
    seen = {lang: [t for t, x in rows if x == lang] for lang in ("aa", "bb", "cc")}
    assert {x: len(set(t)) for x, t in seen.items()} == {"aa": 15, "bb": 15, "cc": 3}
    assert {x: len(t) for x, t in seen.items()} == {
        "aa": 15 * how.pieces, "bb": 15 * how.pieces, "cc": 3 * how.pieces}


def test_pipeline_stages(spark):
    assert shared_dir(spark)
    docs = table(spark, helpers.SF_DIR, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_near_dedup", "substring_dedup", "decontaminate", "poisson_mix"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, helpers.SF_DIR))
        after = kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "poisson_mix":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "language_id":
            assert set(after) == {d for d, r in before.items() if any(map(str.isalpha, r.text))}
        if name == "minhash_near_dedup":
            groups = helpers.components([(d, r.text) for d, r in before.items()], 5)
            assert set(after) == {d for d, c in groups.items() if d == c}
        if name == "substring_dedup":
            left = helpers.cut_repeats([(d, r.text) for d, r in before.items()], 20)
            assert {d: r.text.split() for d, r in after.items()} == {
                d: words for d, (n, words) in left.items() if words or not n}
        if name == "decontaminate":
            items = [t for _, t in helpers.rows("benchmark", "item_id, text", "item_id")]
            leaking = {d for d, r in before.items() if any(
                decontaminate.plain(t) in decontaminate.plain(r.text) for t in items)}
            assert not leaking & set(after) and len(after) >= len(before) - len(leaking) - 2
        assert set(after) <= set(before)
    assert len(kept["poisson_mix"]) > 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_pipeline_stage_on_odd_rows(spark, name, stage):
    rows = [
        (1, "the same words again and again here", "en", "s", 5, "x"), (2, None, None, None, None, "x"),
        (3, "", "en", "s", 0, "x"), (None, "the same words again and again here", "en", None, 3, "x"),
        (4, "the same words again and again here", "en", "s", 5, "x"), (5, "1 2 3 !", "de", "t", 7, "x"),
        (4, "the same words again and again here", "en", "s", 5, "x"),
        (6, "ein ganz anderer kurzer Satz", "de", "t", 28, "x"), (7, "long " * 60_000, "en", "t", 1, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string,"
                                     " n_chars bigint, component string")
    found = [r.doc_id for r in stage(spark, df, helpers.SF_DIR).collect()]
    expected = {
        "language_id": [1, 4, 4, 6, 7, None],
        "minhash_near_dedup": [1, 2, 3, 5, 6, 7, None],
        "substring_dedup": [1, 2, 3, 4, 4, 5, 6, 7, None],
        "decontaminate": [1, 2, 3, 4, 4, 5, 6, 7, None],
    }
    if name in expected:
        assert sorted(found, key=lambda d: (d is None, d)) == expected[name]
    assert stage(spark, df.limit(0), helpers.SF_DIR).collect() == []


@pytest.mark.parametrize(("attributes", "stays"), [
    ('style="overflow:hidden"', True), ('aria-hidden="false"', True), ('data-state="not hidden"', True),
    ('class="a1 b c d e f g h" hidden', False), ('class="u v w x y z k m sidebar"', False),
    ('aria-hidden="true"', False), ("aria-hidden=true", False), ('style="color:red; display: none"', False),
    ('style="visibility:hidden"', False), ("hidden", False), ('hidden=""', False),
    ('style="backface-visibility:hidden"', True), ('title="hidden" data-hidden="1"', True),
    ('class="reader-comments"', False), ('class="gdpr-notice"', False), ('id="gdpr"', False),
    ('class="disclaimer"', False), ('class="popular-posts-widget"', False), ('class="feedback"', False),
    ('class="b1 b2 b3 b4 b5 b6 b7 b8 b9"', True), ("class='x' style='overflow-x:hidden' id=k", True),
])
def test_attributes_that_hide_a_container(attributes, stays):
    page = f"<body><article><p>One.</p><div {attributes}><p>Two.</p></div><p>Three.</p></article></body>"
    assert extract.main_text(page, None) == ("One. Two. Three." if stays else "One. Three.")
