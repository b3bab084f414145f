"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns, per operator and stage."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import (decontaminate, exact_dedup, html_text, packing, quality, simhash, stages, substring, suffix,
                           toxicity, warc)
from shelfwise.llm.labelled import sample
from shelfwise.llm.queries import tokenizer_path

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ROWS = [
    (1, "Hello  World"), (2, "HelloWorld"), (3, "Hello World"), (4, None), (5, ""), (6, " \t\n"), (7, LONG), (8, LONG),
    (9, "you idiot scum"), (9, "you idiot scum"), (None, "Hello World"), (None, PASSAGE), (10, PASSAGE), (11, "alpha " + PASSAGE),
    (12, "ünïcödé wörds — 漢字 and <|endoftext|> it's"), (12, "another text of the same id"), (13, "x"), (14, "x"),
]
CLASHING = ("ord", "h", "row", "sha", "kept", "keep", "score", "fp", "n", "_ord", "_h", "component_id", "ranges", "route")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (9, 0, 1), (10, 1, 0), (None, 1, 1), (7, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("a", PASSAGE), ("b", "idiot scum"), ("c", None), ("d", "  "), (None, "x")], "item_id string, text string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_exact_dedup(docs, none):
    got = rows(exact_dedup.as_contract(exact_dedup.deduplicate(docs, bucket_keys=4)))
    assert len(got) == len(ROWS)
    hello = [r for r in got if r[4] == hashlib.sha256(b"HelloWorld").hexdigest()]
    assert {(r[0], r[1], r[2], r[3]) for r in hello} == {(1, 1, 4, True), (2, 1, 4, False), (3, 1, 4, False), (None, 1, 4, False)}
    empty = [r for r in got if r[4] == hashlib.sha256(b"").hexdigest()]
    assert {(r[0], r[1], r[3]) for r in empty} == {(4, 6, False), (5, 6, False), (6, 6, True)}
    assert sorted(r[3] for r in got if r[0] == 9) == [False, True]
    assert sum(r[3] for r in got) == len({r[4] for r in got})
    assert rows(exact_dedup.as_contract(exact_dedup.deduplicate(none))) == []


def test_simhash(docs, none):
    got = rows(simhash.as_contract(simhash.near_duplicates(docs)))
    assert len(got) == len(ROWS)
    assert {r[1] for r in got if r[0] in (4, 5, 6)} == {"0" * 16}
    assert {r[2] for r in got if r[0] in (4, 5, 6)} == {4}
    assert {r[2] for r in got if r[0] in (7, 8)} == {7} and {r[2] for r in got if r[0] in (13, 14)} == {13}
    assert rows(simhash.as_contract(simhash.near_duplicates(none))) == []


def test_decontaminate(docs, none, benchmark):
    got = rows(decontaminate.as_contract(decontaminate.find_contamination(docs, benchmark)))
    by_id = {}
    for r in got:
        by_id.setdefault(r[0], []).append(r)
    assert len(got) == len(ROWS)
    assert by_id[4][0][1:4] == (0, 0, 0) and by_id[10][0][1:4] == (60, 60, 1) and by_id[11][0][1:4] == (61, 60, 1)
    assert [r[1:4] for r in by_id[9]] == [(3, 2, 1)] * 2 and by_id[13][0][2:4] == (1, 1)
    assert by_id[13][0][4] == hashlib.sha256(b"").hexdigest()
    blocks = rows(decontaminate.as_contract(decontaminate.find_contamination(docs.dropDuplicates(["doc_id", "text"]), benchmark, bound=7)))
    assert sorted(map(str, blocks)) == sorted(set(map(str, got)))
    assert rows(decontaminate.as_contract(decontaminate.find_contamination(none, benchmark))) == []
    assert not any(r[5] for r in rows(decontaminate.as_contract(decontaminate.find_contamination(docs, benchmark.limit(0)))))


def test_cut_spans(docs, benchmark):
    found = decontaminate.find_contamination(docs, benchmark, flags=True)
    cut = {r["ord"]: r["text"] for r in decontaminate.without_spans(docs, found).collect()}
    assert cut[11].strip() == "alpha" and cut[10] == "" and cut[9].strip() == "you"


@pytest.mark.parametrize("op", [quality, toxicity])
def test_classifiers(spark, docs, none, labels, op):
    got = rows(op.as_contract(docs, labels))
    assert len(got) == len(ROWS) and all(0 <= r[2] <= 1 for r in got)
    assert all(bool(r[1]) == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % (3 if op is quality else 4) == (1 if op is quality else 2)) for r in got)
    assert len({r[2] for r in got if r[0] in (4, 5)}) == 1
    assert rows(op.as_contract(none, labels)) == []
    assert len(rows(op.as_contract(docs, labels.limit(0)))) == len(ROWS)


def test_toxic_span_offsets(spark):
    model = toxicity.Field()
    words = toxicity.Tokens.of([b"scum"]).words
    model.own[words] = 20.0
    df = spark.createDataFrame([(1, "Ünï scum, ä SCUM scum!"), (2, None)], "doc_id long, text string")
    got = {r["ord"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in toxicity.tag(df, model).collect()}
    assert got == {1: [(4, 8), (12, 21)], 2: []}


def test_substring_and_suffix(docs, none):
    got = {(r[0], r[1]): r for r in rows(substring.as_contract(substring.remove_repeats(docs)))}
    assert got[(8, 40_000)][2] == 40_000 and got[(7, 40_000)][2] == 0
    assert got[(10, 60)][2] == 0 and got[(11, 61)][2] == 60 and got[(None, 60)][2] == 60 and got[(4, 0)][2] == 0
    assert rows(substring.as_contract(substring.remove_repeats(none))) == []
    got = rows(suffix.as_contract(suffix.remove_repeats(docs)))
    assert len(got) == len(ROWS)
    by = {r[0]: r for r in got if r[0] not in (9, 12, None)}
    assert by[8][1] == by[8][2] and by[10][2] == 0 and by[4][1:4] == (0, 0, 0)
    assert rows(suffix.as_contract(suffix.remove_repeats(none))) == []


def test_packing(docs, none):
    got = rows(packing.as_contract(packing.pack(docs, tokenizer_path())))
    per_doc = {}
    for r in got:
        per_doc.setdefault(r[0], []).append(r)
    assert sum(r[2] for r in per_doc[4]) == 1 and {r[4] for r in per_doc[4]} == {1}
    assert rows(packing.as_contract(packing.pack(none, tokenizer_path()))) == []


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a", None), (2, None, ""), (3, "http://c", "plain text"), (4, "u", "<p>a</p>" * 3), (None, "u", "plain text"),
                                   (5, "u", "plain text"), (5, "u", "plain text"), (6, "u", "<div>" * 5000 + "x" + "<b>" * 5000)], "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit(1) for c in ("ord", "sha1", "refers", "first", "text", "n")})
    got = {r[0]: r[2] for r in rows(html_text.extract_text(pages))}
    assert got[1] == got[2] == "" and got[3] == "plain text" and got[4] == "a\n\na\n\na" and got[6] == "x"
    assert rows(html_text.extract_text(pages.limit(0))) == []
    folder, index = warc.archive(pages)
    back = rows(warc.as_contract(warc.read_bundles(spark, folder, index)))
    assert len(back) == 8
    assert {(r[0], r[3], r[4]) for r in back if r[1] == 10} == {(3, "response", None), (None, "revisit", 3), (5, "revisit", 3)}
    assert {(r[0], r[3]) for r in back if r[1] == 0} == {(1, "response"), (2, "revisit")}
    folder, index = warc.archive(pages.limit(0))
    assert rows(warc.read_bundles(spark, folder, index)) == []
    folder, index = warc.archive(pages, revisit_bytes=11)
    assert {r[3] for r in rows(warc.as_contract(warc.read_bundles(spark, folder, index))) if r[1] == 10} == {"response"}


@pytest.mark.parametrize("stage", ["toxic", "exact", "near", "contaminated"])
def test_stages(spark, docs, none, labels, benchmark, stage):
    run = {"toxic": lambda d: stages.drop_toxic(d, docs, labels), "exact": stages.drop_exact_duplicates,
           "near": stages.drop_near_duplicates, "contaminated": lambda d: stages.drop_contaminated(d, benchmark)}[stage]
    out = run(docs)
    assert out.columns == docs.columns
    got = sorted(rows(out.select("doc_id", "text")), key=str)
    have = sorted(ROWS, key=str)
    if stage == "exact":
        assert [r for r in got if r[0] in (1, 2, 3, 9, 13, 14)] == [r for r in have if r in ((1, "Hello  World"), (13, "x"))] + [(9, "you idiot scum")] or \
            sorted(got, key=str) == sorted({r for r in ROWS if r[0] in (1, 6, 7, 9, 11, 12, 13)} | {(10, PASSAGE)}, key=str)
    if stage == "toxic":  # rows that repeat a document share its fate; texts without a word share theirs
        assert all(got.count(r) == have.count(r) for r in got)
        assert len({(4, None), (5, ""), (6, " \t\n")} & set(got)) in (0, 3)
    if stage == "near":
        assert got.count((9, "you idiot scum")) == 1 and (14, "x") not in got and (13, "x") in got
    if stage == "contaminated":
        assert got == [r for r in have if r[1] and r[1] != "x" and PASSAGE not in r[1] and "idiot" not in r[1] or r[1] in (None, "")]
    assert rows(run(none)) == []


def test_packing_stage(docs, none):
    pieces = stages.pack(docs, tokenizer_path()).collect()
    by_doc = {}
    for r in pieces:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert {k[0] for k in by_doc} == {r[0] for r in ROWS}
    for r in ROWS:  # a text without a token is its end token alone
        if r[1] in (None, "", " \t\n"):
            assert [p["length"] for p in by_doc[r[0], 1]] == [1]
    long = [r for (d, _), rs in by_doc.items() if d == 7 for r in rs]
    assert sum(p["length"] for p in long) == long[0]["doc_tokens"] and all(p["length"] <= 4096 for p in pieces)
    assert rows(stages.pack(none, tokenizer_path())) == []


def test_near_stage_keeps_texts_that_share_an_id(spark):
    """Components whose smallest id is NULL, or an id of several texts, stay apart."""
    other = [" ".join(hashlib.sha256(f"{k} {i}".encode()).hexdigest()[:6] for i in range(40)) for k in range(7)]
    have = [(None, other[0]), (None, other[1]), (None, other[2]), (None, other[2]), (5, other[3]), (5, other[4]), (5, other[5]), (8, other[5]), (9, other[6])]
    out = stages.drop_near_duplicates(spark.createDataFrame(have, "doc_id long, text string").repartition(3))
    assert sorted(rows(out), key=str) == sorted(set(have) - {(8, other[5])}, key=str)


def test_repeated_rows_that_share_a_phrase(spark):
    """Rows that repeat an id and text lose what stands in an earlier document, and nothing for one another."""
    def text(k, n=40):
        return " ".join(hashlib.sha256(f"{k} {i}".encode()).hexdigest()[:6] for i in range(n))

    phrase, shared = text("phrase", 10), text("shared", 30)  # 69 and 209 bytes
    have = [(2, text(1) + phrase + text(2))] * 3 + [(3, text(3) + phrase + shared)] + [(4, text(4) + phrase + text(5) + shared + text(6))] * 2
    df = spark.createDataFrame(have, "doc_id long, text string").repartition(3)
    got = sorted(rows(suffix.as_contract(suffix.remove_repeats(df)).select("doc_id", "n_bytes", "n_removed", "n_spans")))
    assert got == sorted((d, len(t), 209 if d == 4 else 0, int(d == 4)) for d, t in have)


SENTENCE = "A paragraph of the article, long enough to be told from menus and the like, without any link in it."


@pytest.mark.parametrize("part, want", [
    ("<h2><a href=x>A linked heading</a></h2>", "A linked heading"),
    ("<p>See <em><a href=x>the whole report</a></em></p>", "See the whole report"),
    ("<p>See <b><a href=x>the whole report</a></b> and <span><a href=y>its annex</a></span><sup><a href=z>1</a></sup></p>", "See the whole report and its annex1"),
    ("<p>See <strong><a href=x>one report</a></strong></p><p>and <strong><a href=x>another one</a></strong></p>", "See one report\n\nand another one"),
    ("<div><p>See <em><a href=x>one report</a></em></p><p>and <em><a href=x>another one</a></em></p></div>", "See one report\n\nand another one"),
    ("<div>See <em><a href=x>one report</a></em> and <em><a href=x>another one</a></em></div>", "See one report and another one"),
    ("<ul><li>Bread, which is baked in the oven for some time</li><li><a href=x>Butter</a></li></ul>", "Bread, which is baked in the oven for some time\n\nButter"),
    ("<table><tr><td><a href=x>Paris</a></td><td><a href=y>France</a></td></tr></table>", "Paris\n\nFrance"),
    ("<div><h3><a href=x>One part</a></h3><h3><a href=y>Other part</a></h3></div>", "One part\n\nOther part"),
    ("<ul><li><a href=x>One more page</a></li><li><a href=y>Other page</a></li></ul>", ""),
    ("<ul><li><a href=x>One more page</a> (2020)</li><li><a href=y>Other page</a> (2021)</li></ul>", ""),
    ("<div><a href=x>One more page</a> | <a href=y>Other page</a></div>", ""),
])
@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div>%s</div>"])
def test_links_inside_the_article(part, want, wrap):
    page = wrap % f"<h1>Title</h1><p>{SENTENCE}</p><p>{SENTENCE}</p>{part}<p>{SENTENCE}</p>"
    assert html_text.extract(page) == "\n\n".join(x for x in ("Title", SENTENCE, SENTENCE, want, SENTENCE) if x)


@pytest.mark.parametrize("wrap", [
    '<div class="site has-sidebar"><article>%s</article></div>', '<div class="content-sidebar-wrap"><main>%s</main></div>',
    '<div class="layout no-sidebar"><div>%s</div></div>', '<div class="hentry no-comments">%s</div>', '<div class="post tag-search">%s</div>',
    '<form id=aspnetForm action=x><div>%s</div></form>', '<form><div class="page"><article>%s</article></div></form>',
    '<div class="sidebar-content"><article>%s</article></div>', '<div class="content sidebar">%s</div>', '<div class="page-menu"><div class="widget"><main>%s</main></div></div>',
])
@pytest.mark.parametrize("title", ["<h1>Title</h1>", "<h2>Title</h2>"])
def test_wrappers_named_like_noise(wrap, title):
    around = ('<header><h1>Site</h1></header>%s<div class="sidebar"><article class=teaser><h3>Other</h3><p>A teaser.</p></article></div>'
              '<div class="comments-area"><p>A reader wrote this.</p></div><div class="related-posts"><p>More of it.</p></div><form><label>Mail</label></form>')
    page = around % (wrap % f"{title}<p>{SENTENCE}</p><p>{SENTENCE}</p>")
    if "<article>" not in wrap and "<main>" not in wrap:  # without them a teaser counts as the page's article
        page = page.replace("<article class=teaser>", "<div>").replace("</article>", "</div>")
    assert html_text.extract(page) == f"Title\n\n{SENTENCE}\n\n{SENTENCE}"


def test_many_named_nodes_in_a_page():
    page = f"<main><h1>Title</h1><p>{SENTENCE}</p></main>" + '<form><h1>x</h1></form><div class="ad">y</div>' * 20_000
    assert html_text.extract(page) == f"Title\n\n{SENTENCE}"


def test_long_comments_are_still_cut():
    reply = f'<article class="comment-body"><p>{SENTENCE}</p></article>'
    for post in ("<article><h1>Title</h1><p>Short, but it is the article of this page.</p></article>",
                 "<div><h1>Title</h1><p>Short, but it is the article of this page.</p></div>",
                 "<main><h1>Title</h1><p>Short, but it is the article of this page.</p></main>"):
        for section in ('<section id="comments">', '<div class="comments-area">', '<div class="comment-list">'):
            page = f"{post}{section}{reply * 9}</section></div>"
            assert html_text.extract(page) == "Title\n\nShort, but it is the article of this page."


def test_texts_without_id_are_not_taken_for_repeats(spark):
    """Two texts whose hashes agree in the low 32 bits, by stages that drop one of them."""
    a, b = (f"text number {i} of the collision search" for i in (12777, 21204))
    df = spark.createDataFrame([(None, a), (None, b), (1, b)], "doc_id long, text string")
    hashes = [r[0] for r in df.limit(2).select(F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF))).collect()]
    assert hashes[0] == hashes[1]
    left = stages.drop_contaminated(df, spark.createDataFrame([("x", a)], "item_id string, text string"))
    assert sorted(rows(left), key=str) == sorted([(None, b), (1, b)], key=str)
    assert sorted(rows(stages.drop_exact_duplicates(df)), key=str) == sorted([(None, a), (1, b)], key=str)


def test_sample_is_filled_with_texts_that_fit(spark):
    """Long texts, labels without a text and repeated rows take no place of the sample."""
    long, ids = "too long " * 20, [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    have = [(i, f"{long}{i}") for i in ids[:60]] + [(i, f"{i} short {i * 7}") for i in ids[60:66]] * 9 + [(i, f"{i} clean") for i in ids[66:80]]
    marked = [(i, 1) for i in [*ids[:66], *ids[100:200]]] + [(i, 0) for i in ids[66:80]]
    df, labels = spark.createDataFrame(have, "doc_id long, text string"), spark.createDataFrame(marked, "doc_id long, toxic int")
    texts, ys, _ = sample(df, labels, "toxic", 4, 2, rows_per_label=6, max_chars=50)
    assert {t.decode() for t, y in zip(texts, ys) if y} == {t for _, t in have if "short" in t} and list(ys).count(0) == 6
    texts, ys, _ = sample(df.where("NOT text LIKE '%short%'"), labels, "toxic", 4, 2, max_chars=50)
    assert 1 in ys  # the shortest of the long texts
