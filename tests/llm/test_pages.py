"""Main text of pages and the URL filter."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from encore.llm import extraction, url_filter

PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header>"
     "<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad'>Buy</div><article>"
     "<header><h1>A &amp; B</h1></header><p>One<br>two <i>th</i>ree&nbsp;&copy;<p>x<a>link</a></p>"
     "<aside>side</aside><div class='cookie-notice'>ok</div><form>f<input></form><p>end</p>"
     "<section id='comments'><p>first!</p></section><footer>by</footer></article>"
     "<footer>&copy; Site</footer></body></html>", "A & B One two three © xlink end"),
    ("<main><p>only main</p></main><p>out</p>", "only main"),
    ("<article>a<script>var t='</p>';</script>b<!-- c --><style>x</style>c</article>", "abc"),
    ("<article><p class=\"share\">s<p>kept</article>", "kept"),
    ("<article><div hidden>h</div><div style='display: none'>n</div>ok</article>", "ok"),
    ("<article>1 < 2 & 3 <b>bold", "1 < 2 & 3 bold"),
    ("<article>a<!-- never closed <p>b</article>", "a"),
    ("plain text only, no markup", "plain text only, no markup"),
    ("<article><table><tr><td>c1<td>c2</table></article>", "c1 c2"),
    ("<div class='menu'>m</div><div><p>" + "word " * 40 + "</p><p>short</p></div>",
     ("word " * 40 + "short").strip()),
    (None, ""), ("", ""), ("<p></p>", ""), ("<nav>menu</nav>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert extraction.main_text(page) == text


STORY = "<p>" + "A long sentence of the story that goes on. " * 6 + "</p>"
STORY_TEXT = ("A long sentence of the story that goes on. " * 6).strip()


@pytest.mark.parametrize("page, text", [
    # an apostrophe in an unquoted value does not open a quote
    ("<article><p title=it's>First one here.</p><p title=it's>Second one.</p></article>",
     "First one here. Second one."),
    ("<article><p title = 'a>b' data-x=\"c'>\" y=z/>One.</p><p a='>Two.</p></article>", "One. Two."),
    # the story in a div, a teaser in an article
    (f"<article class=teaser><p>Read our offer.</p></article><div>{STORY * 3}</div>",
     " ".join([STORY_TEXT] * 3)),
    (f"<div><p>Read our offer of this week.</p></div><article>{STORY}<p>End.</p></article>",
     f"{STORY_TEXT} End."),
    # words of a sentence, and parts of an article, whatever they are called
    ("<article><p>The <span class='social'>social</span> life of <b id=search>search</b>.</p>"
     "<section id='search'><h2 id=menu>Search</h2><p>How it works.</p></section>"
     "<div class=related>Other stories</div><span class='share'>Share this</span></article>",
     "The social life of search. Search How it works."),
])
def test_text_is_not_lost(page, text):
    assert extraction.main_text(page) == text


def brute_surging(weights):
    sums = [sum(weights[max(0, i - extraction.WINDOW + 1) : i + 1])
            for i in range(len(weights) + extraction.WINDOW - 1)]
    return sums, sum(s for s in sums if s > extraction.SURGE_CHARS)


def test_window_sums_equal_brute_force():
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 50]:
        weights = [rng.choice([0, 0, 5, 40, 200]) for _ in range(n)]
        sums, surging = brute_surging(weights)
        assert extraction._window_sums(weights) == sums
        assert extraction._surging(weights) == surging


def test_unclosed_quotes_are_read_fast():
    page = "<article>" + "<p title='x=y z=" * 2000 + "<p>" + "word " * 1000
    start = time.perf_counter()
    extraction.main_text(page)
    assert time.perf_counter() - start < 5


def test_long_page_is_linear():
    page = "<article>" + "<p>word &amp; word</p>" * 50_000 + "</article>"
    assert extraction.main_text(page) == " ".join(["word & word"] * 50_000)


def test_extract(spark):
    rows = [(i, f"http://x/{i}", page, "z") for i, (page, _) in enumerate(PAGES)]
    rows += [(None, None, "<p>hi there</p>", "z"), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extraction.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "hi there" if r.page_id is None else PAGES[r.page_id][1]
        assert r.text == want and r.n_chars == len(want)
    assert extraction.extract(df.limit(0)).count() == 0


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = path = ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    path = rest[:cut]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def best_rule(host, path):
    fits = [r for r in url_filter.RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


def brute_templates(pages, bad):
    """The tree in plain Python: {row: template}."""
    found = [""] * len(pages)
    segments = [[s for s in path.split("/") if s] for _, path in pages]
    for level in range(url_filter.LEVELS):
        tree = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        for i, (host, _) in enumerate(pages):
            if level < len(segments[i]):
                c = tree[host, found[i]][segments[i][level]]
                c[0] += 1
                c[1] += bad[i] is not None
                c[2] += bool(bad[i])
        after = list(found)
        for i, (host, _) in enumerate(pages):
            if level >= len(segments[i]):
                continue
            branches = tree[host, found[i]]
            n, l, b = branches[segments[i][level]]
            pn, pl, pb = (sum(x[k] for x in branches.values()) for k in range(3))
            own = n >= url_filter.LEAST_PAGES and l and pl > l
            if own:
                m = pb / pl
                error = (m * (1 - m) * (1 / l + 1 / (pl - l))) ** 0.5
                own = abs(b / l - (pb - b) / (pl - l)) > url_filter.DIFFERENT * error
            after[i] = f"{found[i]}/{segments[i][level] if own else '*'}"
        found = after
    return [t + "/**" if len(s) > url_filter.LEVELS else t for t, s in zip(found, segments)]


def test_url_filter(spark):
    urls, labels = [], []
    for i in range(400):
        kind = ("spam", "news", "shop")[i % 3]
        urls.append(f"https://WWW.Site.net/{kind}/{i}/x?q=/org/#f")
        if i % 5:
            labels.append((i, 0 if kind == "spam" else 1, 0))
    odd = ["http://a.org/x", "http://example.org/es/1", "http://sub.example.org/en/12", "x.org/y",
           "http://b.example.org/en/2", "http://q.com/fr/1", "http://q.com/de/", "http://com/de/1",
           "http://q.com/de", None, "", "://", "http://org", "http://notorg/", "http://h?x=1/",
           "http://p.net//a///b/c/d/e/f", "a://b://c/d", "http://ÄÖ.Net/Ä"]
    urls += odd
    labels += [(0, None, 1), (399, 1, None), (None, 0, 1)]
    pages = spark.createDataFrame(
        [(i, u, "x") for i, u in enumerate(urls)] + [(None, "http://z.net/", "x"), (0, urls[0], "x")],
        "page_id long, url string, template string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    own_id = F.col("page_id")
    got = url_filter.judge(pages, table, document=own_id).collect()
    assert len(got) == len(urls) + 2
    bad = {}
    for i, q, t in labels:
        if i is not None:
            bad[i] = bad.get(i, False) or q == 0 or t == 1
    ids = [*range(len(urls)), None, 0]
    parts = [split_url(u) for u in [*urls, "http://z.net/", urls[0]]]
    want = brute_templates(parts, [bad.get(i) for i in ids])
    by = sorted(((str(i), *p, t) for i, p, t in zip(ids, parts, want)))
    assert sorted((str(r.page_id), r.host, r.path, r.template) for r in got) == by
    for r in got:
        rule = best_rule(r.host, r.path)
        assert r.rule == (rule.text if rule else None)
        if rule:
            assert r.verdict == rule.verdict
        elif r.host == "www.site.net":
            assert r.verdict == ("block" if r.path.startswith("/spam") else "allow")
    groups = defaultdict(lambda: [0, 0])
    for i, (host, _), template in zip(ids, parts, want):
        for name in ((host, template), host, None):
            groups[name][0] += i in bad
            groups[name][1] += bool(bad.get(i))
    for r in got:  # the smoothed shares, and the verdicts that follow
        share = groups[None][1] / groups[None][0]
        for name in (r.host, (r.host, r.template)):
            share = (groups[name][1] + url_filter.SMOOTHING * share) / (
                groups[name][0] + url_filter.SMOOTHING)
        assert r.bad_share == pytest.approx(share, abs=1e-12)
        if not r.rule:
            assert r.verdict == ("block" if share >= url_filter.REJECT else "allow")
    assert url_filter.judge(pages.limit(0), table).count() == 0
    assert url_filter.judge(pages, table.limit(0)).where("rule is null and verdict = 'block'").count() == 0


def test_small_and_deep_sections_are_judged(spark):
    urls = [f"http://big.net/s{i % 60}/{i}" for i in range(1800)]  # 60 equal sections
    urls += [f"http://deep.net/a/b/c/d/e/{'spam' if i % 4 == 0 else 'news'}/{i}" for i in range(400)]
    bad = [(i < 1800 and i % 60 == 7) or "/spam/" in u for i, u in enumerate(urls)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not b), 0) for i, b in enumerate(bad)],
                                   "doc_id long, quality int, toxic int")
    for r in url_filter.judge(pages, labels, document=F.col("page_id")).collect():
        assert (r.verdict == "block") == bad[r.page_id]


def test_a_page_has_the_labels_of_the_document_in_its_path(spark):
    """Urls as in the given pages; ids of pages and documents differ, and one section is bad."""
    urls, labels = [], []
    for i in range(300):
        document = 10_000 - 7 * i
        kind = ("spam", "en", "pt")[i % 3]
        tail = ("", ".html", "?utm_source=feed", "#top", ".html?page=2&ref=x")[i % 5]
        urls.append(f"https://www.site.net/{kind}/{document}{tail}")
        labels += [(document, int(kind != "spam"), 0), (i, int(i % 2), 0)]  # misleading ids
    urls += ["https://www.site.net/en/about", "https://www.site.net/en/12x", "http://h.net/1" + "0" * 30]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = [row for row in dict((r[0], r) for r in reversed(labels)).values()]
    got = url_filter.judge(pages, spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")).collect()
    assert {r.template for r in got if r.path.startswith("/spam")} == {"/spam/*"}
    for r in got:
        if r.host == "www.site.net":
            assert r.verdict == ("block" if r.path.startswith("/spam") else "allow")
    host, path = url_filter.host_and_path(F.col("url"))
    found = [r[0] for r in pages.orderBy("page_id").select(url_filter.document_number(path)).collect()]
    assert found[:300] == [10_000 - 7 * i for i in range(300)] and found[300:] == [None] * 3


@pytest.mark.parametrize("depth", [5, 40])
def test_tables_written_do_not_grow_with_depth(spark, monkeypatch, depth):
    written = []
    keep = url_filter.stored
    monkeypatch.setattr(url_filter, "stored", lambda df, name: written.append(name) or keep(df, name))
    same = "/".join("abcdefgh"[i % 8] for i in range(depth))
    pages = spark.createDataFrame(
        [(i, f"http://a.net/{same}") for i in range(40)]
        + [(i, f"http://b.net/{same}/{i}") for i in range(40, 80)]
        + [(i, "http://c.net/s{}/x/y/z/{}/{}".format(i % 2, i % 2, i)) for i in range(80, 160)],
        "page_id long, url string")
    labels = spark.createDataFrame(
        [(i, int(i < 80 or i % 2), 0) for i in range(10, 160)], "doc_id long, quality int, toxic int")
    got = url_filter.judge(pages, labels, document=F.col("page_id")).collect()
    assert len(got) == 160 and len(written) <= 9
    assert {r.template for r in got if r.host == "c.net"} == {"/s0/*/*/*/**", "/s1/*/*/*/**"}
    assert {r.verdict for r in got if "/s0/" in r.path} == {"block"}
    assert {r.verdict for r in got if "/s0/" not in r.path} == {"allow"}
