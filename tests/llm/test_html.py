"""Main-text extraction on pages of known content."""

from __future__ import annotations

import html
import random

import pytest

from sigflow.llm.html import extract_text, main_text

BOILER = [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>',
    '<header><h1>Site name</h1><p>A slogan, long enough to look like text, with commas.</p></header>',
    '<div class="ad">Buy this now, it is really cheap, and it is good.</div>',
    '<aside><p>Related reading, which is long, and has punctuation. Yes, it has.</p></aside>',
    '<div id="cookie-notice"><p>We use cookies, as everyone does, to improve your experience.</p></div>',
    '<form><label>Mail</label><input type="text"><button>Send it, please</button></form>',
    '<script>var t="</p><p>not text, at all.</p>";</script><style>p{margin:0}</style>',
    '<!-- a comment, with <p>markup</p> --><noscript><p>Turn on scripts, please.</p></noscript>',
    '<footer>&copy; someone &middot; All rights, and so on.</footer>',
]
COMMENTS = '<section class="comments"><p>First, I say! Great article, really, and thank you.</p></section>'


def article(rng):
    words = ["alpha", "beta &", "gamma<b", "déjà", "naïve", "delta", "“quoted”", "x > y", "tab\there", "two\n lines"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 60))) + rng.choice([".", "", "?"]) for _ in range(rng.randint(1, 12))]


def norm(blocks):
    out = [" ".join(b.split()) for b in blocks]
    return "\n".join(b for b in out if b)


@pytest.mark.parametrize("shape", ["article", "main", "unclosed", "article-comments"])
def test_article_is_found_whole(shape):
    rng = random.Random(shape)
    for _ in range(40):
        blocks = article(rng)
        inner = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
        if shape == "unclosed":
            inner = "".join(f"<p><b>{html.escape(b)}<br>" for b in blocks)
        head = "<h1>A title</h1>"
        body = {
            "article": f"<article>{head}{inner}</article>",
            "main": f"<main><div class='wrap'>{head}<section>{inner}</section></div></main>",
            "unclosed": f"<article>{head}{inner}</article>",
            "article-comments": f"<article>{head}{inner}{COMMENTS}</article>",
        }[shape]
        around = rng.sample(BOILER, k=rng.randint(2, len(BOILER)))
        at = rng.randint(0, len(around))
        page = "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(around[:at]) + body + "".join(around[at:]) + "</body></html>"
        assert main_text(page) == norm(["A title", *blocks]), page


def test_without_a_semantic_container():
    rng = random.Random(2)
    for _ in range(30):
        blocks = [" ".join(["word,"] * rng.randint(25, 60)) + "." for _ in range(rng.randint(3, 8))] + ["Short one."]
        inner = "".join(f"<p>{b}</p>" for b in blocks)
        page = f"<html><body>{BOILER[0]}{BOILER[2]}<div class='content'>{inner}</div><div class='links'>" + (
            "".join(f"<a href='/{i}'>Go to {i}</a> " for i in range(8)) + f"</div>{BOILER[8]}</body></html>"
        )
        assert main_text(page) == "\n".join(blocks)


def test_references_white_space_and_cut_off_markup():
    assert main_text("<article><p>a&nbsp;&amp;&nbsp;b &eacute;&#233;&#xe9; &lt;p&gt;</p><p>\n c\t d</p>") == "a & b ééé <p>\nc d"
    assert main_text("<article><p>one <a href='x'>link</a>, <i>two</i><br>three</p><p>cut off &am") == "one link, two three\ncut off &am"
    assert main_text("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert main_text("<body><article class='post comments-open'><p>kept</p></article></body>") == "kept"


def test_null_empty_and_odd(spark):
    for h in (None, "", "   ", "<", "<p", "<p class='", "</p></p>", "<script>x", "<!-- open", "<nav>menu</nav>"):
        assert main_text(h) == ""
    assert main_text("<article><p>whole</p><p>cut <a hre") == "whole\ncut"
    assert main_text("<article><p>1 < 2 and 3 > 2</p></article>") == "1 < 2 and 3 > 2"
    assert main_text("plain text only") == "plain text only"
    deep = "<div>" * 3000 + "<p>deep text, here.</p>"
    assert main_text(deep) == "deep text, here."
    assert len(main_text("<article>" + "<p>word and word.</p>" * 20000)) == 15 * 20000 - 1
    df = spark.createDataFrame(
        [(1, "u", "<article><p>a</p></article>", "t")] * 2 + [(None, None, None, None)],
        "page_id long, url string, html string, text string",
    )
    rows = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract_text(df).collect()), key=str)
    assert rows == sorted([(1, "u", "a", 1)] * 2 + [(None, None, "", 0)], key=str)
    assert extract_text(df.limit(0)).count() == 0


def test_given_pages(spark):
    """On the given pages the article is all that is kept, and all of it."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert got[r.page_id] == norm(blocks)


BODY = [f"The main text goes on, and on, in part {i}; it has commas, stops and words enough to be read." for i in range(6)]
PARAGRAPHS = "".join(f"<p>{b}</p>" for b in BODY)


def test_body_outside_of_article_cards():
    cards = "".join(f"<article class='card'><p>Teaser {i}, short.</p></article>" for i in range(3))
    page = f"<body><div class='content'>{PARAGRAPHS}<p>Short end</p></div><div class='more'>{cards}</div></body>"
    assert main_text(page) == "\n".join([*BODY, "Short end"])


def test_an_article_keeps_its_lists_of_links():
    """Sources at its end stay, with their heading; a menu or a marked list of links in it goes."""
    links = "".join(f"<li><a href='/{i}'>Source {i}</a></li>" for i in range(5))
    listed = [f"Source {i}" for i in range(5)]
    page = "<body><article><h1>Title</h1>{0}<h2>Sources</h2><div><span>note</span></div>{1}</article></body>"
    assert main_text(page.format(PARAGRAPHS, f"<ul>{links}</ul>")) == "\n".join(["Title", *BODY, "Sources", "note", *listed])
    for marked in (f"<ul class='related'>{links}</ul>", f"<nav><ul>{links}</ul></nav>", f"<aside><ul>{links}</ul></aside>"):
        assert main_text(page.format(PARAGRAPHS, marked)) == "\n".join(["Title", *BODY, "Sources", "note"])


def test_a_head_without_its_end():
    for start in ("<html><head><title>T</title><meta charset='utf-8'>", "<head><style>p{}</style><script>x</script>"):
        assert main_text(f"{start}<article>{PARAGRAPHS}</article>") == "\n".join(BODY)
        assert main_text(f"{start}<body><div>{PARAGRAPHS}</div>") == "\n".join(BODY)
    assert main_text("<head><title>T</title>Text of a page without tags") == "Text of a page without tags"


def test_a_form_around_the_page_and_a_menu_without_its_end():
    form = "<form action='/'><input type='hidden'><select><option>en</option></select>{}<button>Go</button></form>"
    assert main_text(f"<body>{form.format('<article>' + PARAGRAPHS + '</article>')}</body>") == "\n".join(BODY)
    assert main_text(f"<body>{form.format('<div>' + PARAGRAPHS + '</div>')}{BOILER[8]}</body>") == "\n".join(BODY)
    menu = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About</a></li></ul>"
    for body in (f"<main>{PARAGRAPHS}</main>", f"<article>{PARAGRAPHS}</article>"):
        assert main_text(f"<body>{menu}{body}</body>") == "\n".join(BODY)
    # a form that is no wrapper goes, as does an aside with sentences
    assert main_text(f"<body><div>{PARAGRAPHS}</div>{BOILER[5]}{BOILER[3]}</body>") == "\n".join(BODY)


COMMENT = "I read this twice, and I think that it is right. Thank you, and do go on like this, please; it helps."


@pytest.mark.parametrize("name", ["comments", "post-comments", "comment-list", "comments-area", "article-comments-section"])
@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("item", ["<div class='comment'><p>{}</p></div>", "<article class='comment-body'><p>{}</p></article>", "<p>{}</p>"])
def test_comments_go_however_long(name, inside, item):
    comments = f"<section class='{name}'>" + "".join(item.format(COMMENT) for _ in range(60)) + "</section>"
    article = "".join(f"<p>{b}</p>" for b in BODY[:2])
    page = f"<article>{article}{comments}</article>" if inside else f"<article>{article}</article>{comments}"
    assert main_text(f"<body>{page}</body>") == "\n".join(BODY[:2])


def test_comments_by_name_and_structure():
    """A wrapper may speak of comments; with a name that says more, several like blocks make them comments."""
    for wrapper in ("site has-comments", "comments-open", "no-comments single"):
        assert main_text(f"<body><div class='{wrapper}'>{PARAGRAPHS}</div></body>") == "\n".join(BODY)
        assert main_text(f"<body><div class='{wrapper}'><article>{PARAGRAPHS}</article></div></body>") == "\n".join(BODY)
    thread = "".join(f"<div class='c'><p>{COMMENT}</p></div>" for _ in range(30))
    assert main_text(f"<body><article>{PARAGRAPHS}<div class='fancy comments v2'>{thread}</div></article></body>") == "\n".join(BODY)


def test_selected_text_outside_of_the_home_stays():
    far = "The last word on it stands elsewhere, far from the rest; it is long, it has commas, and it is text."
    page = f"<body><div class='content'>{PARAGRAPHS * 3}</div><div class='foot'><p>{far}</p></div></body>"
    assert main_text(page) == "\n".join([*BODY * 3, far])


def plain_scores(nodes):
    """Score of every path, written out: nodes are (path, text, characters in links, in an article, marked)."""
    import math

    paths = {p for p, *_ in nodes}
    length = {p: sum(len(t) for q, t, *_ in nodes if q == p) for p in paths}
    number = {p: sum(q == p for q, *_ in nodes) for p in paths}
    dots = {p: sum(sum(c in ".,;:!?…。，、；：！？" for c in t) for q, t, *_ in nodes if q == p) for p in paths}
    linked = {p: sum(min(n, len(t)) for q, t, n, *_ in nodes if q == p) for p in paths}
    ratio = [length[p] / number[p] * (1 - linked[p] / length[p]) for p, *_ in nodes]
    marks = [1 + dots[p] / number[p] for p, *_ in nodes]
    bell = {k: math.exp(-k * k / 2) for k in range(-2, 3)}

    def smooth(x, i):
        near = [k for k in bell if 0 <= i + k < len(x)]
        return sum(bell[k] * x[i + k] for k in near) / sum(bell[k] for k in near)

    out = {}
    for p in paths:
        own = [i for i, node in enumerate(nodes) if node[0] == p]
        out[p] = sum(
            smooth(ratio, i) * smooth(marks, i) * (2.0 if nodes[i][3] else 1.0) * (0.1 if nodes[i][4] else 1.0) for i in own
        ) / len(own)
    return out


def test_path_scores_match_a_plain_version(spark):
    from sigflow.llm.html import Page, path_scores, whole_markup

    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect() if r.html]
    pages += [f"<body><div class='a'>{PARAGRAPHS}</div><ul class='menu'><li><a>x y</a><li>z, z</ul><article><p>a</p></article></body>"]
    for markup in pages:
        page = Page()
        page.feed(whole_markup(markup))
        page.finish()
        nodes = [(e.path, t, n, e.container is not None, e.marked) for e, t, n in page.blocks]
        want = plain_scores(nodes)
        assert path_scores(page.blocks) == {p: pytest.approx(v) for p, v in want.items()}


@pytest.mark.parametrize(
    "name", ["site right-sidebar", "has-sidebar", "no-sidebar", "with-nav", "social-science", "sidebar", "header", "widget"]
)
@pytest.mark.parametrize("shape", ["article", "div", "div-outside"])
def test_names_of_wrappers(name, shape):
    inner = f"<article>{PARAGRAPHS}</article>" if shape == "article" else PARAGRAPHS
    aside = "<div class='sidebar'><p>Not this, ever.</p></div><p class='credit'>By us</p>"
    page = {"div-outside": f"<div class='{name}'>{inner}</div>{aside}"}.get(shape, f"<div class='{name}'>{inner}{aside}</div>")
    text = main_text(f"<html><body>{page}{BOILER[8]}</body></html>")
    assert all(b in text.split("\n") for b in BODY) and "Not this" not in text


def test_minor_marked_elements_go():
    extra = "<div class='box right-sidebar'><p>Elsewhere, too, there is text. It is long, it is not content.</p></div>"
    assert main_text(f"<body><div class='content'>{PARAGRAPHS}</div>{extra}</body>") == "\n".join(BODY)
    related = f"<div class='related'><article><p>{BODY[0]}</p></article></div>"
    assert main_text(f"<body><article>{PARAGRAPHS}</article>{related}</body>") == "\n".join(BODY)
