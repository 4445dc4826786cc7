"""Page operators: round trips, brute force and messy pages."""

import base64
import hashlib
import html
import re

import time

import pytest

from fleetgrid.llm import html_extraction, url_filters, warc

PAGE_SCHEMA = "page_id long, url string, html string"
LONG = "<article><p>" + "äb<c> & " * 60_000 + "</p></article>"
PAGES = [
    (1, "https://A.Example.NET/en/x?q=1", "<p>same</p>"), (2, "http://b.org/fr/", "<p>same</p>"), (2, "http://b.org/fr/", "<p>same</p>"), (3, None, None),
    (4, "no scheme", ""), (None, "ftp://x.net", "<p>same</p>"), (None, None, "<p>alone</p>"), (5, "http://h.net/a\nb", LONG), (6, "http://h.net/", LONG + "."),
    (7, "https://example.net", "x"), (8, "https://notexample.net/en/", "\x00\r\n\r\nWARC/1.1"), (9, "a://b://c.example.com/de/?x", "y"), (-3, "http://net/", "z")]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, PAGE_SCHEMA)
    for name in ("host", "path", "token", "data", "digest", "row_id", "ranked", "_host", "text", "rule", "first"):
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df.repartition(3).cache()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_archive_round_trip(spark, pages, tmp_path):
    for at_least, segment in ((0, warc.SEGMENT_BYTES), (8, 50_000), (10**9, 7)):
        small = pages if segment > 7 else pages.filter("page_id IS NULL OR page_id NOT IN (5, 6)")
        data = [r for r in PAGES if segment > 7 or r[0] not in (5, 6)]
        path = str(tmp_path / f"archive-{segment}")
        warc.write_archive(small, path, at_least, segment)
        held = {}
        for i, _, h in data:
            b = (h or "").encode()
            held.setdefault(b, []).append(i)
        want = []
        for i, _, h in data:
            b = (h or "").encode()
            first = min((x for x in held[b] if x is not None), default=None)
            revisit = len(b) >= at_least and first != i
            want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first if revisit else None, None if revisit else b))
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_archive(spark, path).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_ordinary_pages_are_segmented(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    warc.write_archive(rows, str(tmp_path / "pages"))
    kinds = [f["WARC-Type"] for r in spark.read.parquet(str(tmp_path / "pages")).collect() for f, _ in warc.parse_records(bytes(r.data))]
    assert kinds.count("continuation") > 0
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archive(spark, str(tmp_path / "pages")).filter("payload IS NOT NULL").collect()}
    assert all(got.get(r.page_id, r.html) == r.html for r in rows.collect()) and max(map(len, got.values())) > warc.SEGMENT_BYTES


def test_damaged_archives_fail(spark):
    records = warc.records_of(1, 1, "http://a/", b"x" * 500, warc.payload_digest(b"x" * 500), None, 200)
    assert len(records) > 2 and all(next(warc.parse_records(r)) for r in records)
    fields = [next(warc.parse_records(r)) for r in records]
    numbers = [int(f["WARC-Segment-Number"]) for f, _ in fields]
    header = "\r\n".join(f"{k}: {v}" for k, v in fields[0][0].items())
    totals = [None] * (len(fields) - 1) + [sum(len(b) for _, b in fields)]
    parts = [b for _, b in fields]
    order = [2, 0, 1, *range(3, len(fields))]
    pick = lambda x: [x[i] for i in order]
    row = warc.joined_segments("o", pick(numbers), pick([header] + [None] * (len(fields) - 1)), pick(parts), pick(totals))
    assert row[2] == 500 and row[6] == b"x" * 500
    with pytest.raises(ValueError, match="missing"):
        warc.joined_segments("o", numbers[:-1], [header], parts[:-1], totals[:-1])
    with pytest.raises(ValueError, match="wrong length"):
        warc.joined_segments("o", numbers, [header] + [None] * 9, parts, [None] * (len(fields) - 1) + [3])
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse_records(records[0][:-9]))
    with pytest.raises(ValueError, match="cut short"):
        warc.unchunked(b"5\r\nabcdeX\r\n0\r\n\r\n")
    assert warc.unchunked(warc.chunked(b"q" * 70_000)) == b"q" * 70_000 and warc.unchunked(b"2;x=1\r\nab\r\n0\r\n\r\n") == b"ab"


def judged(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules(spark, pages):
    extra = [*url_filters.RULES, ("c.example.com", "/de/", "allow"), ("example.net", "", "block"), ("bücher.de", "/a.b", "block"), ("h.net", "/a", "allow")]
    urls = [u for _, u, _ in PAGES] + ["http://x.bücher.de/a.b/c", "http://x.bücher.de/axb", "http://h.net/abc", "http://deep.C.example.com/de/f"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    for rules in (url_filters.RULES, extra):
        out = url_filters.judge_urls(df, spark.createDataFrame(rules, url_filters.RULE_SCHEMA))
        assert rows_of(out) == sorted([(i, *judged(u, rules)) for i, u in enumerate(urls)], key=repr)
    assert url_filters.judge_urls(pages, spark.createDataFrame(extra, url_filters.RULE_SCHEMA)).count() == len(PAGES)
    none = url_filters.judge_urls(df, spark.createDataFrame([], url_filters.RULE_SCHEMA), default="block")
    assert {r.verdict for r in none.collect()} == {"block"}


def test_a_rule_is_keyed_by_its_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://a.common.net/rare{i}/x",) for i in range(5)], "url string")
    index = url_filters.rule_index(spark.createDataFrame([("common.net", "/rare3/", "block"), ("", "/x", "block")], url_filters.RULE_SCHEMA), urls)
    assert {r.rule: r.token for r in index.collect()} == {"common.net/rare3/": "rare3", "/x": ""}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no</p>";</script><style>p{}</style></head><body>
<header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, really.</p></div>
<div class="ad"><p>Buy, buy, buy this long advert now.</p></div><aside><p>Side story.</p></aside>
<div class="post-%d" id="main"><header><h1>A &amp; B</h1></header><p>First   line<br>goes&nbsp;on, and <b>bold<i>er</b> text.<p>Second &lt;b&gt; line, &copy 2024, &am.
<ul><li>One<li>Two, two</ul><pre>x
 y</pre><form><p>Name</p><input></form><blockquote>Quoted, said.</blockquote>loose <!-- no --> tail</div>
<section class="comments"><p>Reader says, hello, a very long comment, with commas, many, many.</p></section><footer><p>&copy; F</p></footer>"""
TEXT = "A & B\nFirst line goes on, and bolder text.\nSecond <b> line, © 2024, &am.\nOne\nTwo, two\nx y\nQuoted, said.\nloose tail"


def test_main_text(spark, pages):
    rows = [(i, "http://h.org/" + str(i), PAGE % i) for i in range(4)] + [(9, "http://h.org/odd", "<div><p>Only, this.</p></div>"), (10, None, None), (11, "http://e/", "")]
    rows += [(12, "http://p/", "plain text &amp; no tags"), (13, "http://p/", "<body><script>if (a<b) {</body>"), (14, "http://q/", "<article><p>a<p>b</p><div>c</article>")]
    out = {r.page_id: r for r in html_extraction.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert all(out[i].text.replace("<h1>", "") in (TEXT, TEXT.removeprefix("A & B\n")) for i in range(4))
    assert [out[i].text for i in (9, 10, 11, 12, 13, 14)] == ["Only, this.", "", "", "plain text & no tags", "", "a\nb\nc"]
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert html_extraction.extract(pages).count() == len(PAGES)


LINES = "long, text, here and so on, " * 8
ARTICLES = {
    "<article><h1>T</h1><div class=lead>Lead.</div><div class=content><p>%s</p></div></article>": "T\nLead.\n%s",
    "<article><h1>T</h1><p>Intro.</p><ul><li>%s<li>b, c</ul><p>End.</p></article>": "T\nIntro.\n%s\nb, c\nEnd.",
    "<article><p>Intro.</p><table><tr><td>%s</td><td>x</td></tr></table><blockquote>Q.</blockquote></article>": "Intro.\n%s\nx\nQ.",
    "<main><h1>T</h1><section class=a><p>%s</p></section><section class=b><p>B.</p></section></main>": "T\n%s\nB.",
    "<div class=post><h1><a href=/>T</a></h1><ul><li><a>Home</a></ul><div class=lead>Lead.</div><div class=content><p>%s</p></div></div>": "T\nLead.\n%s"}
WRAPPERS = ["<div id=page class='has-sidebar'>%s</div>", "<div class='no-comments'>%s</div>", "<div class='content-widget'>%s</div>", "<div class=modal-open>%s</div>", "<form>%s</form>",
            "<div aria-hidden=true>%s</div>", "<div id=login class=related>%s</div>"]


@pytest.mark.parametrize("host", [False, True])
def test_all_of_an_article_is_kept(spark, host):
    rows = [(i, f"http://h{i if host else 0}/", f"<body><nav>No</nav>{a % LINES}<footer>No</footer></body>") for i, a in enumerate(ARTICLES)]
    out = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert [out[i] for i in range(len(rows))] == [want % LINES.strip() for want in ARTICLES.values()]


def test_names_of_layout_drop_no_article():
    inner = f"<article><p>A.</p><p>{LINES}</p></article><div class=comments><article class=comment>{LINES * 9}</article></div>"
    for wrapper in WRAPPERS:
        assert html_extraction.main_text(f"<body><nav>x</nav>{wrapper % inner}</body>", []) == f"A.\n{LINES.strip()}"
        assert html_extraction.main_text(f"<body><nav>x</nav>{wrapper % f'<div class=c><p>{LINES}</p></div>'}</body>", []) == LINES.strip()
    noise = f"<section class=comments><p>{LINES * 9}</p></section><div class='cookie-notice'>{LINES * 2}</div><div class=related><article>r</article></div>"
    assert html_extraction.main_text(f"<body><div class=post><p>Short.</p></div>{noise.replace('article', 'b')}</body>", []) == "Short."
    assert html_extraction.main_text(f"<body><article>Short.</article>{noise}</body>", []) == "Short."
    assert html_extraction.main_text("<body><div class=cookie-notice><p>only this</p></div></body>", []) == "only this"


def test_names_inside_an_article_need_links_or_the_host(spark):
    body = f"<p>Start {{0}}.</p><p>{LINES}</p>"
    named = "<div class=related-work><p>Work of others, {0}.</p></div><p class=share-price>Price {0}.</p><ul class=widgets><li>One {0}<li>Two</ul>"
    aside = "<aside>Aside.</aside><div class=social-share><p>Tell others.</p></div><div class='related posts'><a href=/a>Next one</a> and <a href=/b>another one</a></div>"
    page = "<body><nav>No</nav><article>" + body + "%s" + aside + "</article></body>"
    rest = "Start {0}.\n" + LINES.strip()
    all_of_it = rest + "\nWork of others, {0}.\nPrice {0}.\nOne {0}\nTwo"
    # one page alone; a host where one of six pages has these names; a host where five of six have them; a host of two pages
    rows = [(0, "http://one/", (page % named).format(0))]
    rows += [(10 + i, "http://few/", (page % (named if i == 0 else "")).format(i)) for i in range(6)]
    rows += [(20 + i, "http://most/", (page % (named if i else "<p>Own.</p>")).format(i)) for i in range(6)]
    rows += [(30 + i, "http://two/", (page % named).format(i)) for i in range(2)]
    out = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert out[0] == all_of_it.format(0) and out[10] == all_of_it.format(0)
    assert [out[i] for i in range(11, 16)] == [rest.format(i) for i in range(1, 6)]
    assert out[20] == rest.format(0) + "\nOwn." and [out[20 + i] for i in range(1, 6)] == [rest.format(i) for i in range(1, 6)]
    assert [out[30 + i] for i in range(2)] == [all_of_it.format(i) for i in range(2)]


def test_a_host_outvotes_a_single_page(spark):
    usual = '<div class="story"><p>{0}, one, two, three, four.</p><p>{0}, five.</p></div><div class="more"><p>{0}.</p></div>'
    odd = '<div class="story"><p>Short.</p></div><div class="more"><p>' + "long, long, long, " * 20 + "</p><p>and more, more</p></div>"
    rows = [(i, "http://v.org/", usual.format(f"Page {i}")) for i in range(6)] + [(6, "http://v.org/", odd)]
    out = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert out[6] == "Short." and out[0] == "Page 0, one, two, three, four.\nPage 0, five."


def test_empty_tables(spark, pages, tmp_path):
    none = pages.limit(0)
    warc.write_archive(none, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0 == html_extraction.extract(none).count()
    assert url_filters.judge_urls(none, spark.createDataFrame(url_filters.RULES, url_filters.RULE_SCHEMA)).count() == 0


def test_unescaped_text_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_cut_off_and_endless_pages():
    began = time.perf_counter()
    cut = "<p>kept</p><a " + 'x="1" ' * 200
    assert html_extraction.main_text(cut, []).startswith("kept\n")
    assert len(html_extraction.main_text("<div>x" * 50_000, []).split("\n")) == 50_000
    assert html_extraction.main_text("<p>one</p><!-- never closed <p>two</p>", []) == "one"
    assert html_extraction.main_text("<p>one</p><script>a > b", []) == "one"
    assert html_extraction.main_text("<article><p title='a>b' class=\"x\">in</p><p x=\"odd>out</p></article>", []) == "in\nout"
    assert len(html_extraction.main_text("<a " * 50_000, [])) > 100_000
    assert html_extraction.main_text("<ul>" + "<li>x" * 20_000, []).count("x") == 20_000
    assert time.perf_counter() - began < 30
