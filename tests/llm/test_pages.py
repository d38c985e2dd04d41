import html
import re

import pytest

from brightwash.llm import pages
from brightwash.llm.common import table
from llm_fixtures import prose, rng  # noqa: F401

SF001 = "/root/testdata/sf0.001"


def test_articles_of_the_table(spark):
    """Every page's article against a reading of its markup by patterns."""
    source = table(spark, SF001, "pages")
    want = {}
    for r in source.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        want[r.page_id] = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
    rows = pages.extract(source).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def page(rng, body):
    menu = "".join(f'<li><a href="/{i}">{prose(rng, 2)}</a></li>' for i in range(8))
    return (
        f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><ul id=menu>{menu}</ul>"
        f"<div class='cookie-notice'><p>{prose(rng, 40)}</p></div>{body}"
        f"<div class='comments'><article><p>{prose(rng, 60)}</p></article></div><form><p>{prose(rng, 20)}</p></form>"
        f"<footer><p>{prose(rng, 30)}</p></footer></body></html>"
    )


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class=story>%s</div>", "<article>%s"])
def test_regions(rng, wrap):
    blocks = [prose(rng, n) for n in (4, 60, 3, 80, 45, 2)]
    inner = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}" for b in blocks[1:4]) + f"<ul><li>{blocks[4]}<li>{blocks[5]}</ul>"
    inner += f"<aside>{prose(rng, 50)}</aside><!-- {prose(rng, 5)} -->"
    got = pages.main_text(page(rng, wrap % inner))
    assert got.split("\n\n")[: len(blocks)] == blocks
    if "</" in wrap:
        assert got.split("\n\n") == blocks


def test_character_references_and_white_space():
    got = pages.main_text("<article><p>a &amp;&lt;b&gt;\n\t c&#233;<br>d&nbsp;e</p><p>  </p><p>f<b>g</b></p></article>")
    assert got == "a &<b> cé d e\n\nfg"


def test_odd_pages():
    assert [pages.main_text(x) for x in (None, "", "   ", "<p>", "<script>x</script>", "<!-- -->")] == [""] * 6
    assert pages.main_text("just words") == "just words"
    assert pages.main_text("</div></p><p>a<p>b</i>") == "a\n\nb"
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert pages.main_text(long) == "\n\n".join(["word word"] * 20_000)
    assert len(pages.main_text("<div>" * 3000 + "deep words here")) == 15


def test_threshold_parts_two_clusters():
    values = [1.0, 2.0, 1.5, 40.0, 50.0, 45.0]
    assert 2 < pages._threshold(values) < 40
    assert pages._threshold([3.0, 3.0]) == 3.0
    smooth = pages._smoothed([0.0, 0.0, 10.0, 0.0, 0.0])
    assert smooth[2] == max(smooth) and smooth[1] == smooth[3] > smooth[0] > 0


def test_rows_nulls_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "u", "<p>a b</p>", "old"), (None, None, None, None), (1, "u", "<p>a b</p>", "old")], "page_id long, url string, html string, text string")
    rows = pages.extract(frame).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "", 0), (1, "a b", 3), (1, "a b", 3)]
    assert pages.extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "around",
    [
        "<article class='post comments-open'>%s</article>",
        "<div class='content no-sidebar'><article>%s</article></div>",
        "<div class='with-sidebar'><div class=story>%s</div></div>",
        "<div class='left-sidebar'>%s</div>",
        "<div id=comments>%s</div>",
        "<article><div class='entry no-sidebar'>%s</div></article>",
        "<form id=aspnet><div class=story>%s</div></form>",
    ],
)
def test_hints_do_not_take_the_text_out(rng, around):
    blocks = [prose(rng, n) for n in (4, 60, 30, 80)]
    inner = f"<div class='post-header'><h1>{blocks[0]}</h1></div>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    menu = "".join(f"<li><a href='/'>{prose(rng, 2)}</a></li>" for _ in range(6))
    got = pages.main_text(f"<body><ul class='site-menu'>{menu}</ul>{around % inner}<div class='page-sidebar'><p>{prose(rng, 20)}</p></div></body>")
    assert got.split("\n\n") == blocks


def test_hints_take_out_what_is_beside_the_text(rng):
    blocks, other = [prose(rng, n) for n in (60, 40)], prose(rng, 200)
    story = "".join(f"<p>{b}</p>" for b in blocks)
    for beside in ("comments", "comments-area", "post-comments", "replies"):
        for around in ("<article>%s</article>", "<div class=story>%s</div>"):
            got = pages.main_text(f"<body>{around % story}<div class='{beside}'><p>{other}</p></div></body>")
            assert got.split("\n\n") == blocks
    got = pages.main_text(f"<article>{story}<div class='share-box'><p>{prose(rng, 9)}</p></div></article>")
    assert got.split("\n\n") == blocks


def test_text_over_sibling_elements(rng):
    """Without an article all content lines are kept, wherever they are."""
    for name in ("div", "section"):
        blocks = [prose(rng, n) for n in (70, 60, 80, 50, 40)]
        first = "".join(f"<p>{b}</p>" for b in blocks[:4])
        body = f"<{name}>{first}</{name}><{name}><p>{blocks[4]}</p></{name}>"
        assert pages.main_text(page(rng, body)).split("\n\n") == blocks
        assert pages.main_text(f"<body>{body}</body>").split("\n\n") == blocks
        assert pages.main_text(page(rng, f"<main>{body}</main>")).split("\n\n") == blocks


def test_linked_lines_of_the_text_stay(rng):
    blocks = [prose(rng, n) for n in (70, 8, 60)]
    menu = "".join(f"<li><a href='/'>{prose(rng, 2)}</a></li>" for _ in range(6))
    story = f"<div><p>{blocks[0]}</p><p>see <a href='/'>{blocks[1]}</a></p><p>{blocks[2]}</p></div>"
    got = pages.main_text(f"<body><ul>{menu}</ul><div><ul>{menu}</ul></div>{story}</body>")
    assert got.split("\n\n") == [blocks[0], "see " + blocks[1], blocks[2]]


def test_an_article_tag_decides_only_if_it_holds_the_text(rng):
    blocks, teaser = [prose(rng, n) for n in (4, 70, 60, 80)], prose(rng, 45)
    story = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    got = pages.main_text(page(rng, f"<div class=story>{story}</div><article><p>{teaser}</p></article>")).split("\n\n")
    assert got == [*blocks, teaser]
    got = pages.main_text(page(rng, f"<article>{story}</article><div><p>{prose(rng, 20)}</p></div>")).split("\n\n")
    assert got == blocks


def test_head_without_end_tag():
    for head in ("<head><title>x</title>", "<head><meta charset=utf-8><title>x</title><style>p{}</style>"):
        for body in ("<body>", ""):
            assert pages.main_text(f"<html>{head}{body}<article><h1>a</h1><p>b c</p></article></html>") == "a\n\nb c"
            assert pages.main_text(f"<html>{head}{body}<p>b c") == "b c"
    assert pages.main_text("<head><title>x</title>b c") == "b c"


@pytest.mark.parametrize("name", ["button", "select", "object", "svg", "noscript", "template"])
def test_hidden_element_without_end_tag(name):
    assert pages.main_text(f"<article><p>a</p><{name}>x<p>b</p><div>c</div>d</article>") == "a\n\nb\n\nc\n\nd"
    assert pages.main_text(f"<article><p>a <{name}>x</p><p>b</p></article>") == "a\n\nb"
    assert pages.main_text(f"<article><p>a <{name}>x</{name}> b</p><{name}><p>x</p>x</{name}><p>c</p></article>") == "a b\n\nc"
    assert pages.main_text(f"<p>a <{name}><div>x</div>x</{name}> b</p>") == "a\n\nb"


def test_button_ends_an_open_button():
    assert pages.main_text("<article><button>x<p>b</p><button>x</button><p>c</p></article>") == "b\n\nc"
