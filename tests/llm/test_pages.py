import re

import pytest

from aerocorr.llm.page_text import extract, main_text
from aerocorr.llm.urls import RULES, judge_urls

LINE = "The quick brown fox jumps over the lazy dog, and then it sleeps."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<nav>a b</nav>", ""), ("<!-- x", ""),
    (f"just text &lt;b&gt; {LINE}", f"just text <b> {LINE}"),
    (f"<article><h1>Title</h1><p><b>{LINE}<br><p>Be.</article><footer>&copy; x</footer>", f"Title\n{LINE}\nBe."),
    (f"<BODY><HEADER><H1>Site</H1></HEADER><ARTICLE><P>{LINE}<P>{LINE}</ARTICLE>", f"{LINE}\n{LINE}"),
    (f"<article><p>{LINE}</p><div class='ad'>Buy {LINE}</div><p>a\n\t b&nbsp;c &amp; d&#x41;</p>"
     f"<div id=user-comments><p>{LINE}</p></div></article>", f"{LINE}\na b c & dA"),
    (f"<div><ul><li><a href=1>one two</a></li><li><a href=2>three</a></li></ul></div><div><p>{LINE}</p>"
     f"<p>{LINE} <a href=3>link</a> on</p></div>", f"{LINE}\n{LINE} link on"),
    (f"<div id=content><p>{LINE}</p><form><label>Mail</label><button>Go</button></form><h2>Sub</h2>"
     f"<blockquote>{LINE}</blockquote></div><aside>{LINE}</aside><div class=cookie-notice>{LINE}</div>",
     f"{LINE}\nSub\n{LINE}"),
    (f"<article><h1 class=header>T</h1><div class=entry-header>By Ann</div><p>{LINE}</p><section id=discussion>"
     f"<p>{LINE}</p></section><ol class=commentlist><li>{LINE}</li></ol><div class=header>{LINE}</div></article>",
     f"T\nBy Ann\n{LINE}\n{LINE}"),
    (f"<script>var t='<p>{LINE}</p>';</script><style>p{{}}</style><p>{LINE}</p>", LINE),
])
def test_main_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("inner", ["ul><li", "blockquote><p", "div><p", "section><p"])
def test_mixed_blocks_without_article(inner):
    """Lead paragraphs beside a container that holds most of the text."""
    close = "".join(f"</{t.strip('<')}>" for t in reversed(inner.split(">")))
    page = (f"<body><div><h2>Head</h2><p>{LINE} a.</p><p>{LINE} b.</p>"
            + "".join(f"<{inner}>{LINE} {i}.{close}" for i in range(4)) + f"<p>{LINE} c.</p></div></body>")
    assert main_text(page).split("\n") == [
        "Head", f"{LINE} a.", f"{LINE} b.", *[f"{LINE} {i}." for i in range(4)], f"{LINE} c."]


def test_links_of_an_article_stay():
    page = f"<article><p>{LINE}</p><p>{LINE}</p><ol><li><a href=1>A reference</a></li></ol></article>"
    assert main_text(page) == f"{LINE}\n{LINE}\nA reference"


def test_long_page_is_whole():
    paragraphs = [f"{LINE} {i}." for i in range(3000)]
    page = "<body><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body>"
    assert main_text(page).split("\n") == paragraphs


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LINE}é</p>", 1), (None, None, None, 1), (1, "u", f"<p>{LINE}é</p>", 1)],
                                  "page_id long, url string, html string, text int")
    got = extract(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [
        (0, "", 0), (1, LINE + "é", len(LINE) + 1), (1, LINE + "é", len(LINE) + 1)]
    assert extract(pages.limit(0)).count() == 0


URLS = [
    "http://A.Example.ORG/es/1", "https://example.org/en/12?x=/de/", "https://example.org/en/2", "https://x.com/fr/1",
    "https://x.com/de/1", "https://x.com/de", "https://com/de/9", "https://notcom/de/9", "https://examples.org/es/1",
    "http://h.net", "http://h.net?x#y", "http://h.net#/a", "no scheme", "", None, "a://b://c/d", "http:///p/q",
    "http://b.example.org/en/1/" + "/".join(f"s{i}" for i in range(50)), "HTTP://É.org/É?",
]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, host int")
    got = {r.page_id: r for r in judge_urls(spark, pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        fit = [(len(h + p), h + p, v) for v, h, p in RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == (max(fit)[1] if fit else None)
        assert got[i].verdict == max(fit)[2] if fit else got[i].verdict in ("allow", "block")


def test_templates_generalise_blocked_branches(spark):
    """A host where rules block nearly every labelled URL of one branch: its
    unlabelled URLs are rejected, those of the clean branch are not."""
    rules = (("block", "h.net", "/spam/1"), ("allow", "h.net", "/news/1"))
    urls = [f"http://h.net/{b}/{d}{i}" for b in ("spam", "news") for d in (1, 2) for i in range(40)]
    got = judge_urls(spark, spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    for r in got:
        assert r.verdict == ("block" if "/spam/" in r.path else "allow") and r.template.endswith("/#")
    words = [f"http://k.net/user/{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(200)]
    got = judge_urls(spark, spark.createDataFrame(list(enumerate(words)), "page_id long, url string")).collect()
    assert {r.template for r in got} == {"/user/*"} and {r.verdict for r in got} == {"allow"}


@pytest.mark.parametrize("one, others", [("block", "allow"), ("allow", "block")])
def test_one_of_ten_sections_keeps_its_rate(spark, one, others):
    """Ten even sections of a host, one of them labelled unlike the others: its
    unlabelled URLs follow it, those of the others do not."""
    names = ["spam", *(f"{chr(97 + i)}news" for i in range(9))]
    rules = [(one if n == "spam" else others, "h.net", f"/{n}/1") for n in names]
    urls = [f"http://h.net/{n}/{d}{i}" for n in names for d in (1, 2) for i in range(40)]
    got = judge_urls(spark, spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    for r in got:
        assert r.verdict == (one if "/spam/" in r.path else others), r


def test_no_urls(spark):
    assert judge_urls(spark, spark.createDataFrame([], "page_id long, url string")).count() == 0
