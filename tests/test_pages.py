"""Paragraphs, main text, cleaning and links on small pages."""

import html
import random
import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions.arrow import html_unescape, nfkd
from linkloom.functions.strings import strip, word_count
from linkloom.operators import pages as P


def page(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_id int, html string")


def paragraphs(spark, body, **options):
    return [r.text for r in P.extract_paragraphs(page(spark, body), **options).orderBy("pos").collect()]


@pytest.mark.parametrize(
    "body, want",
    [
        ("<p>one two three four</p>", ["one two three four"]),
        ("<p>one two three</p>", []),
        ("<p>one  two three</p>", ["one  two three"]),  # an empty piece counts
        ("<p>one\ntwo\nthree four</p>", []),  # newlines do not split
        ("<p> one two three</p>", ["one two three"]),  # counted before the strip
        ("<p>mixed <b>inline</b> content drops out</p>", []),
        ("<p><b>a single nested tag stays</b></p>", ["a single nested tag stays"]),
        ("<p><a href='x'><i>two nested tags stay too</i></a></p>", ["two nested tags stay too"]),
        ("<p><b>tail after the tag</b> drops it all</p>", []),
        ("<p>never closed one here<p>never closed two here", ["never closed one here", "never closed two here"]),
        ("<p>ends at a block here<div>x</div>", ["ends at a block here"]),
        ("<script>var t='<p>not a real paragraph</p>';</script><p>but this is real</p>", ["but this is real"]),
        ("<p>comment behind the text<!-- c --></p>", []),
        ("<!-- <p>not in a comment ever</p> --><P CLASS='x'>upper case tag works</P>", ["upper case tag works"]),
        ("<pre>one two three four</pre><param x><p>one two three four</p>", ["one two three four"]),
        ("<p>caf&eacute; &amp; tea for two</p>", [unicodedata.normalize("NFKD", "café & tea for two")]),
        ("<p>no-break&nbsp;space counts twice</p>", ["no-break space counts twice"]),
        ("<p>line<br>break is a tag</p>", []),
        ("<script>never closed <p>one two three four</p>", []),
        ("<p title='a>b' data-x=\"<i>\">quotes may hold brackets here</p>", ["quotes may hold brackets here"]),
        ("<p class=it's>a stray quote ends nothing</p>", ["a stray quote ends nothing"]),
        ("no paragraph at all", []),
    ],
)
def test_paragraph_rules(spark, body, want):
    assert paragraphs(spark, body) == want


def test_positions_and_options(spark):
    df = page(spark, "<p>a b c d</p><p>short</p><p>é f g h</p>", None)
    assert [(r.pos, r.text) for r in P.extract_paragraphs(df, normalize=False).collect()] == [(0, "a b c d"), (2, "é f g h")]
    assert P.extract_paragraphs(df, min_words=1).count() == 3
    rows = P.paragraph_text(df).orderBy("page_id").collect()
    assert rows[0].word_count == 8 and rows[0].text.startswith("a b c d ")


def test_arrays_of_texts_keep_their_places(spark):
    rng = random.Random(3)
    words = ["plain", "café", "&copy; x", "Ǆ", "&bogus;", ""]
    rows = [(i, [rng.choice(words) for _ in range(rng.randint(0, 5))]) for i in range(300)] + [(300, None)]
    from linkloom.functions.arrow import plain_texts

    df = spark.createDataFrame(rows, "i int, t array<string>").select("i", plain_texts(F.col("t")).alias("t"))
    for row in df.collect():
        given = rows[row.i][1]
        want = None if given is None else [unicodedata.normalize("NFKD", html.unescape(x)) for x in given]
        assert row.t == want


def test_unescape_and_nfkd_match_the_standard_library(spark):
    rng = random.Random(5)
    bits = ["&", "amp", "amp;", "lt;", "#39;", "#x41;", "#65", "copy", "copy;", "section=2", "nbsp;", "eacute", "bogus;",
            " ", "x", "é", "ﬁ", "quot;", "#", "notin;", "not", ";", "&amp;lt;", "hellip;"]
    values = ["".join(rng.choices(bits, k=rng.randint(1, 8))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    for row in df.select("i", html_unescape(F.col("v")).alias("u"), nfkd(F.col("v")).alias("n")).collect():
        v = values[row.i]
        assert row.u == (None if v is None else html.unescape(v)), v
        assert row.n == (None if v is None else unicodedata.normalize("NFKD", v)), v


def test_white_space_is_pythons(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert len(spaces) == 29
    values = [f"{s}a{s}b{s}{s}" for s in spaces] + ["", " ", "a​b"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for row in df.select("v", word_count(F.col("v")).alias("n"), strip(F.col("v")).alias("s")).collect():
        assert (row.n, row.s) == (len(row.v.split()), row.v.strip()), repr(row.v)
    kept = P.nonempty_text(df, "v").collect()
    assert {r.v for r in kept} == {v for v in values if v.strip()}
    assert P.nonempty_text(df, "v", strip=False).count() == len(values) - 1


def test_main_text(spark):
    body = ("<head><title>T</title></head><nav>menu</nav><h1>Head&nbsp; line</h1>\n\n<p>a <b>b</b>\tc</p>"
            "<footer>f</footer><ul><li>x<li>y</ul><!-- z --><style>p{}</style>&lt;p&gt;")
    row = P.main_text(page(spark, body)).first()
    assert row.text == "Head line\n\na b c\n\nx\n\ny\n\n<p>"
    assert row.word_count == 8


def test_clean_html(spark):
    body = ("<!DOCTYPE html><html><head><meta a><script>s</script><link b></head><body class='k'>"
            "<!-- c --><p onclick=\"go()\" id=x onload='y'>one on one=1</p>\n\n <iframe>i</iframe><input x>two</body></html>")
    rows = P.clean_html(page(spark, body, "<p> </p>", "<p>&nbsp;</p>", "<p>&copy;</p>", "", None)).orderBy("page_id").collect()
    assert [r.page_id for r in rows] == [0, 3]
    assert rows[0].text == "<body class='k'><p id=x>one on one=1</p> two</body>"
    assert rows[0].word_count is None


def test_links(spark):
    body = ('<a href="./one">x</a> <a href="./two">y</a>\n<a href="./three">has space</a>\n'
            "<a class='c' href='./four' id=z>w</a>\n<a  href=\"./five\"></a>")
    df = page(spark, body)
    assert [r.link for r in P.page_links(df).collect()] == ["./two", "./four", "./five"]
    assert [r.link for r in P.page_links(df, H.EACH_LINK).collect()] == ["./one", "./two", "./three", "./four", "./five"]


def test_greedy_links_equal_the_plain_pattern(spark):
    rng = random.Random(7)
    bits = ["<a ", "<a\n", "<a", "href=", 'href="', "href='", '"', "'", ">", "</a>", "x", "./y", " ", "\n", "<b>", "\t"]
    bodies = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    bodies += ['<a href="x">y</a>' * 3, '<a q <a\nhref="x">y</a>', '<a href="x"\n>y</a> <a href="z">w</a>']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, html string")
    got = {}
    for r in P.page_links(df).collect():
        got.setdefault(r.i, []).append(r.link)
    for i, body in enumerate(bodies):
        assert got.get(i, []) == re.findall(H.GREEDY_LINK, body), body


def test_links_of_a_minified_page_take_one_pass(spark):
    for bit in ('<a href="/some/page" class=x><b>with text</b></a> ', "<a href='/p'>a b</a>", "<a class=q>z</a> "):
        df = page(spark, bit * (1_000_000 // len(bit)))
        start = time.time()
        P.page_links(df).collect()
        assert time.time() - start < 5


def test_modes(spark):
    df = page(spark, "<p>one two three four</p>").withColumn("url", F.lit("u"))
    for mode in P.SCRAPERS:
        row = P.with_meta(P.extract(df, mode), mode).first()
        assert row.meta.scraper == mode and row.meta.url == "u"
        assert row.meta.word_count == (None if mode == "raw" else 4)
    with pytest.raises(ValueError):
        P.extract(df, "other")
    for alias, mode in P.ALIASES.items():
        assert P.with_meta(P.extract(df, alias), alias).first().meta.scraper == mode


@pytest.mark.parametrize(
    "bits",
    ["<p class=", "<a ", "<p a=\"", "<p a='\"", "&", " \n", "<!--", "<script>", "<b>", "<p>", "</p ", "= ", "<p =\"\">"],
)
def test_hostile_pages_take_one_pass(spark, bits):
    df = page(spark, bits * 40_000 + "<p>" + "x " * 1000)
    start = time.time()
    for run in (P.main_text, P.paragraph_text, P.clean_html):
        run(df).collect()
    P.page_links(df, H.EACH_LINK).collect()
    assert time.time() - start < 30


NESTED = [
    ("a<nav>b<nav>c</nav>d</nav>e", "a\n\ne"),
    ("a<NAV x='<nav>'>b<nav>c</nav >d</Nav>e<nav>f</nav>g", "a\n\ne\n\ng"),
    ("a<aside>b<nav>c<aside>d</aside></nav>e</aside>f", "a\n\nf"),
    ("a<nav>b<script>'</nav>'</script>c</nav>d", "a\n\nd"),
    ("a<nav>b<!-- </nav> -->c</nav>d&eacute;<b>x</b><br>y", "a\n\ndéx\n\ny"),
    ("a<header>b<head>c</header>d</head>e", "a\n\nde"),
    ("a<nav>b</nav>c</nav>d", "a\n\nc\n\nd"),
    ("a</nav>b<nav>c<nav>d</nav>e", "a\n\nb"),
    ("a<!-- <nav> -->b</nav><navy>c</navy>", "a\n\nb\n\nc"),
    ("<nav><nav>a</nav></nav>", ""),
    ("a<div>b<div>c</div>d</div>e", "a\n\nb\n\nc\n\nd\n\ne"),
]


def test_nested_blocks_go_whole(spark):
    rows = [(i, html) for i, (html, _) in enumerate(NESTED)] + [(-1, None)]
    df = spark.createDataFrame(rows, "i int, html string").repartition(3)
    got = {r.i: r.text for r in P.main_text(df).collect()}
    assert [got[i] for i in range(len(NESTED))] == [text for _, text in NESTED]
    assert got[-1] is None
    # A page of nothing but nested blocks has no main text, so the raw mode drops it.
    assert {r.i for r in P.clean_html(df).collect()} == {i for i, t in got.items() if t}


@pytest.mark.parametrize("bits", [("<nav>", "</nav>"), ("<nav>", ""), ("", "</nav>"), ("<nav><aside>", "</aside></nav>")])
def test_deep_blocks_take_one_pass(spark, bits):
    n = 100_000
    html = f"a{bits[0] * n}b{bits[1] * n}c</nav>"
    start = time.time()
    df = spark.createDataFrame([(html,)], "html string")
    (row,) = P.main_text(df).collect()
    assert time.time() - start < 20
    want = {"<nav></nav>": "a\n\nc", "<nav>": "a", "</nav>": "ab\n\nc", "<nav><aside></aside></nav>": "a\n\nc"}
    assert row.text == want["".join(bits)]
