import base64
import gzip
import hashlib
import html
import os
import re
import zlib

import pytest

from feedmart.llm import html_extract, queries, warc
from feedmart.llm.common import scratch_path, table


def _article(page):
    body = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", b))).strip() for b in re.split("</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_extraction_query(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    got = queries.op2_html_extract(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.text == _article(pages[r.page_id].html) and r.n_chars == len(r.text)


LONG = "A long paragraph, with commas and full stops. It says a lot, and then it says some more of it. "


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text only", "plain text only"), ("<p>a<script>x</p>", "a"), ("<!-- never closed <p>x", ""),
    ("<p>a &lt; b < c &amp; d\n\t e</p>", "a < b < c & d e"),
    (f"<body><div class='main-menu'><a href=x>Home</a></div><div><h2>Title</h2><p>{LONG}<br>{LONG}<p>{LONG}</div>"
     f"<section id=comments><p>{LONG}</p></section><aside>{LONG}</aside><form><label>Mail</label><input></form></body>",
     f"Title\n{LONG}{LONG.strip()}\n{LONG.strip()}"),
    (f"<main><p>{LONG}</p></main><ul><li><a href=1>one</a><li><a href=2>two</a></ul>", LONG.strip()),
    (f"<div class=cookie-notice>We use cookies, yes.</div><article><p>{LONG}</p></article><div style='display:none'>{LONG}</div>", LONG.strip()),
])
def test_extraction_of_small_pages(page, want):
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize("attrs", ["style='overflow:hidden'", "class=overflow-hidden", "aria-hidden='false'", "data-hidden='false'", "title='display:none, hidden'",
                                   "style='display:none;display:block'", "data-id=sidebar"])
def test_look_alikes_of_hidden_are_read(attrs):
    assert html_extract.main_text(f"<body><div {attrs}><article><p>{LONG}</p></article></div></body>") == LONG.strip()


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN=''", "class=x hidden", "aria-hidden=true", "aria-hidden = 'TRUE'", "style='color:red; Display : NONE !important'",
                                   'style="visibility:hidden"', "style='display:none!important;display:block'"])
def test_hidden_elements_are_left_out(attrs):
    assert html_extract.main_text(f"<body><p>{LONG}</p><div {attrs}><p>{LONG}{LONG}</p></div></body>") == LONG.strip()


ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}{LONG}</p></article>"
PLAIN = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}{LONG}</p>"
TEXT = f"Title\n{LONG.strip()}\n{(LONG * 2).strip()}"


@pytest.mark.parametrize("body", [ARTICLE, PLAIN, f"<main>{PLAIN}</main>"])
@pytest.mark.parametrize("start, end", [
    ("<div class='content has-sidebar'>", "</div>"), ("<div class=elementor-widget-container>", "</div>"), ("<div class='post no-comments'>", "</div>"),
    ("<section id=legal-news>", "</section>"), ("<form action=x method=post>", "</form>"), ("<div id=page class='right-sidebar'>", "</div>"),
    ("<div class=widget>", "</div>"), ("<header>", "</header>"), ("<aside>", ""), ("<nav><a href=x>Home</a>", ""), ("<div class='ad'>", "")])
def test_elements_that_hold_the_article_are_read(body, start, end):
    assert html_extract.main_text(f"<body><nav><a href=y>Home</a></nav>{start}{body}{end}<footer>Imprint, and more.</footer></body>") == TEXT


@pytest.mark.parametrize("name", ["class=sidebar", "id='comments'", "class='x ad-slot'", "class=related-posts", "class=site_footer", "class=cookie-banner", "class='post-comments'",
                                  "role=navigation", "class=share-buttons", "class=newsletter-form", "class=breadcrumbs", "class='side-bar'", "class=main-menu"])
def test_named_boilerplate_is_left_out(name):
    assert html_extract.main_text(f"<body>{ARTICLE}<div {name}><p>{LONG}</p></div></body>") == TEXT
    assert html_extract.main_text(f"<body>{ARTICLE.replace('</article>', '')}<div {name}><p>{LONG}</p></div></article></body>") == TEXT


def test_comments_and_teasers_are_not_the_article():
    for name in ("<section id=comments>", "<aside>", "<div class=related>"):
        end = f"</{name[1:].split()[0].strip('>')}>"
        assert html_extract.main_text(f"<body>{ARTICLE}{name}{f'<article><p>{LONG * 4}</p></article>' * 5}{end}</body>") == TEXT
    assert html_extract.main_text(f"<main>{PLAIN}<section class=comments>{f'<article><p>{LONG}</p></article>' * 9}</section></main>") == TEXT
    for part in ("<h2 id=cookies>", "<h2 id='how-to-delete-cookies'>", "<h2 class=tag-social>", "<section id=the-sidebar-of-the-page><h2>"):
        assert html_extract.main_text(f"<body><article><p>{LONG}</p>{part}Next</h2><p>{LONG}</p></article>") == f"{LONG.strip()}\nNext\n{LONG.strip()}"
    assert html_extract.main_text(f"<article><header class=entry-header><h1>Title</h1></header>{PLAIN[14:]}</article>") == TEXT


@pytest.mark.parametrize("page, want", [
    (f"<head><title>x</title><body><p>{LONG}</p>", LONG.strip()),
    (f"<!DOCTYPE html><title>x</title><head><meta charset=utf-8><link rel=x><style>a</style><p>{LONG}</p>", LONG.strip()),
    (f"<html><head><noscript><link rel=x></noscript><script>a</script>\n{LONG}", LONG.strip()),
    (f"<head><noscript>No scripts.<body><p>{LONG}</p>", LONG.strip()),
    (f"<div><p class=share>Share<p>{LONG}<p>{LONG}</div>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<div><p hidden>Share<p>{LONG}<h2>Next</h2><p>{LONG}</div>", f"{LONG.strip()}\nNext\n{LONG.strip()}"),
    (f"<div><p style='display:none'>Share <b>it<ul><li>{LONG}</ul></div>", LONG.strip()),
    (f"<ul><li hidden>Share<li>{LONG}</ul>", LONG.strip()),
    (f"<ul><li>{LONG}<div hidden><ul><li>a<li>b</ul>c</div><li>{LONG}</ul>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<table><tr><td>{LONG}<div hidden><table><tr><td>a<td>b</table>c</div><tr><td>{LONG}</table>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<p>{LONG}<button><div>Buy</div> now</button></p><p>{LONG}</p>", f"{LONG.strip()}\n{LONG.strip()}")])
def test_optional_end_tags_of_what_is_left_out(page, want):
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize("start, end", [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<div><div class=post>", "</div><div>Imprint</div></div>"), ("<main><article>", "</article></main>"), ("<article><div><article>", "</article></div></article>")])
@pytest.mark.parametrize("part, lines", [
    ("<ul>" + "<li>forty characters without any marks in it" * 30 + "</ul>", ["forty characters without any marks in it"] * 30),
    ("<table>" + "<tr><td>a<td>12" * 20 + "</table>", ["a", "12"] * 20), ("<blockquote>So be it</blockquote>", ["So be it"]),
    ("<pre>x = 1</pre>", ["x = 1"]), ("<ul><li><a href=x>A source</a></ul>", ["A source"]), ("<h3>Last words</h3>", ["Last words"])])
def test_short_blocks_of_an_article_with_long_paragraphs(start, end, part, lines):
    para = LONG * 21
    page = f"<body><nav><li><a href=x>Home</a></nav>{start}{f'<p>{para}</p>' * 10}<h2>Next</h2>{part}{end}<ul><li><a href=1>one</a><li><a href=2>two</a></ul></body>"
    if "post" in start and ("href" in part or "<h3>" in part):
        return  # outside an article, links and last headings may be the page's
    assert html_extract.main_text(page) == "\n".join([para.strip()] * 10 + ["Next"] + lines)


def test_articles_that_have_most_of_the_text_together():
    para = f"<p>{LONG}</p>"
    one = f"<article><p>{LONG * 20}</p><ul><li>short</ul></article>"
    assert html_extract.main_text(f"{para * 9}<ul><li>short</ul>") == "\n".join([LONG.strip()] * 9 + ["short"])
    assert html_extract.main_text(f"<body>{one * 3}<div><a href=x>more</a></div>") == "\n".join([(LONG * 20).strip(), "short"] * 3)


def test_captions_and_maps_are_read():
    figure = f"<figure><img src=x><figcaption>A caption, of {LONG}</figcaption></figure><p><map name=m><area href=x>{LONG}</map></p>"
    want = f"{LONG.strip()}\nA caption, of {LONG.strip()}\n{LONG.strip()}"
    assert html_extract.main_text(f"<article><p>{LONG}</p>{figure}</article>") == want == html_extract.main_text(f"<p>{LONG}</p>{figure}")
    assert html_extract.main_text(f"<p>{LONG}</p><label>Mail</label><dialog>Sure?</dialog><noscript>No scripts.</noscript>") == LONG.strip()


@pytest.fixture
def no_names(monkeypatch):
    """Every list of names that mark boilerplate is empty."""
    for name in ("HEADS", "ROLE", "COMMENTS", "UNLIKELY", "SECONDARY"):
        monkeypatch.setattr(html_extract, name, frozenset())
    html_extract._names_boilerplate.cache_clear()
    yield
    html_extract._names_boilerplate.cache_clear()


def _pages(sf):
    import pyarrow.parquet as pq
    return pq.read_table(f"{sf}/pages.parquet")["html"].to_pylist()


def test_ratios_find_the_article_without_any_names(no_names):
    """Without the lists the pages come out right, with the article element or without it, but for those whose whole article is no more than a footer."""
    pages = _pages("/root/testdata/sf0.1")
    want = [_article(p) for p in pages]
    for change, share in ((lambda p: p, 0.96), (lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>"), 0.93)):
        right = [html_extract.main_text(change(p)) == w for p, w in zip(pages, want)]
        assert sum(right) > share * len(pages)
        assert all(ok for ok, w in zip(right, want) if len(w) > 1500)


def test_without_ratios_the_article_is_not_found(no_names, monkeypatch):
    """A list of names that is longer than the article, neither marked by any name or element: only the ratios tell them apart."""
    names = "".join(f"<div>Some Name And Another Name {'abcdefghij'[i % 10]}</div>" for i in range(120))
    page = f"<body><div>{names}</div><div>{PLAIN}</div></body>"
    assert html_extract.main_text(page) == TEXT
    monkeypatch.setattr(html_extract, "_scores", lambda found, named: [1.0] * len(found))
    assert html_extract.main_text(page) != TEXT


@pytest.mark.parametrize("body", [ARTICLE, PLAIN, f"<main>{PLAIN}</main>"])
@pytest.mark.parametrize("part", [
    "<div class=gdpr-bar>We use cookies, as all do. Accept them all.</div>", "<ins class=adsbygoogle>Buy this thing now, it is cheap.</ins>",
    "<div class=dfp-ad-mpu><p>Buy this thing now, it is cheap.</p></div>", "<div class=outbrain-widget><p>You won't believe this, and that.</p></div>",
    "<div id=discussion><h3>What readers say</h3><p>I liked it, very much.</p><p>So did I.</p></div>",
    "<section><h3>What readers say</h3><p>Nice.</p><p>So it is.</p></section>", "<div class=right-rail><ul><li>First tip<li>Second tip</ul></div>",
    "<div>\xa9 2024 Some House. All rights reserved.</div>", f"<div class='{'x' * 100}-sidebar'><p>{LONG}</p></div>",
    "<ul><li><a href=a>One</a><li><a href=b>Two</a></ul>"])
def test_what_surrounds_the_article(body, part):
    assert html_extract.main_text(f"<body><div>{body}</div>{part}</body>") == TEXT
    assert html_extract.main_text(f"<body>{part}<div>{body}</div></body>") == TEXT


def test_labels_and_open_inline_elements():
    assert html_extract.main_text(f"<article><p>{LONG}</p><p>Choose <label>x</label> real text</article>") == f"{LONG.strip()}\nChoose x real text"
    for n in (1, 13, 300):
        page = f"<div><p class=share>Share {'<b>' * n}this<p>{LONG}<p>{LONG}</div>"
        assert html_extract.main_text(page) == f"{LONG.strip()}\n{LONG.strip()}"
    deep = f"{'<div>' * 300}<p>{LONG}</p><nav><a href=x>Home</a></nav>{'</div>' * 300}"
    assert html_extract.main_text(deep) == LONG.strip()


def test_extraction_edges(spark):
    deep, long = "<div>" * 20_000 + "deep", "<p>" + LONG * 5000
    pages = spark.createDataFrame([(1, None, None, "t"), (2, "u", "", "t"), (2, "u", "", "t"), (None, "v", deep, "t"), (4, "w", long, "t")],
                                  "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_extract.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (2, "u", "", 0), (None, "v", "deep", 4), (4, "w", (LONG * 5000).strip(), len((LONG * 5000).strip()))], key=str)
    assert html_extract.extract(pages.limit(0)).count() == 0


def _brute(rows):
    digests = {}
    for r in rows:
        data = (r.html or "").encode()
        digests.setdefault(data, []).append(r.page_id)
    out = []
    for data, ids in digests.items():
        top = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out += [(i, len(data), digest, "response" if i == top else "revisit", None if i == top else top) for i in ids]
    return sorted(out, key=str)


def test_warc_query(spark, sf_dir):
    got = sorted(map(tuple, queries.op3_warc(spark, sf_dir).collect()), key=str)
    assert got == _brute(table(spark, sf_dir, "pages").collect())


def test_warc_edges(spark):
    rows = [(1, "http://a/ b\r\nc", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n日本🎉"), (5, "u", "other"),
            (6, "u", "x"), (6, "u", "x"), (7, "u", "y" * 300_000), (None, "u", "x")] + [(100 + i, "u", "hot") for i in range(3000)]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, original int, digest string")
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path)
    records = warc.read(spark, path, payloads=True)
    got = warc.resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == _brute(pages.collect())
    payloads = {r.page_id: r.payload for r in records.filter("record_type = 'response'").collect()}
    assert payloads[7] == bytearray(b"y" * 300_000) and payloads[4] == b"" and payloads[3099] == b"hot" and 3 not in payloads
    empty = scratch_path(spark, "warc-empty")
    warc.write(pages.limit(0), empty)
    assert warc.resolve(warc.read(spark, empty)).count() == 0


def test_archives_are_bounded_by_bytes(spark):
    sizes = {i: 1_000_000 + i for i in range(90)} | {100 + i: 20_000 + i for i in range(50)} | {1000 + i: i for i in range(50)} | {2000: 70_000_000}
    pages = spark.createDataFrame([(i, n) for i, n in sizes.items()], "page_id long, n int").coalesce(1).selectExpr("page_id", "'u' AS url", "repeat('x', n) AS html")
    path = scratch_path(spark, "warc-bytes")
    warc.write(pages.union(pages.filter("page_id = 1").selectExpr("page_id - 2", "url", "html")), path)
    inflated = []
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        heads = list(warc.parse(warc.inflate(bytes(r.content))))
        inflated.append((sum(len(b) for _, b in heads), len(heads)))
    assert all(n <= warc.ARCHIVE_BYTES + 200 * k or k == 1 for n, k in inflated) and sum(k for _, k in inflated) == len(sizes) + 1
    got = {r.page_id: r for r in warc.read(spark, path, payloads=True).selectExpr("*", "length(payload) AS n").drop("payload").collect()}
    assert {i: r.n for i, r in got.items() if r.record_type == "response"} == sizes and got[-1].refers_to == 1
    assert os.path.exists(path.removeprefix("file:") + "/_SUCCESS")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        warc.write(pages.limit(1), path)


def test_archives_are_parsed_in_pieces(monkeypatch):
    blocks = [b"", b"abc", b"\r\n\r\n" * 9, bytes(range(256)) * 40]
    records = [b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(b), b) for b in blocks]
    for n in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "PIECE_BYTES", n)
        for data in (b"".join(records), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records)), gzip.compress(b"") + gzip.compress(b"".join(records))):
            assert [b for _, b in warc.parse(warc.inflate(data))] == blocks
            for cut in (len(data) - 1, len(data) - 9):
                with pytest.raises((ValueError, zlib.error)):
                    list(warc.parse(warc.inflate(data[:cut])))
    assert list(warc.parse(warc.inflate(b""))) == []


def test_damaged_payload_is_refused():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(record * 3)] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.parse(record.replace(b"Length: 3", b"Length: 2")))


def test_payloads_without_copies_are_not_shuffled(spark):
    """With broadcasts switched off, an exchange stands above the payloads of digests with copies only."""
    pages = spark.createDataFrame([(i, f"u{i}", "same" if i % 10 == 0 else f"payload {i}") for i in range(200)], "page_id long, url string, html string")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = warc.with_revisits(warc.records(pages))
        alone = rows.filter("copies IS NULL")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        got = rows.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    branches = plan.split("Union")[1]
    alone_branch = branches[:branches.index("Join")]  # the payloads that have no copy come first; what stands above a join follows them
    assert "ArrowEvalPython" in alone_branch and plan.count("Exchange hashpartitioning") == 2  # the two sides of the join of the others
    assert alone_branch.count("ArrowEvalPython") == 1 and "Exchange" not in alone_branch[:alone_branch.index("ArrowEvalPython")]
    assert {r.page_id: r.original for r in got} == {i: 190 if i % 10 == 0 else None for i in range(200)} and alone.columns == rows.columns
