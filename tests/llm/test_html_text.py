from __future__ import annotations

from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.html_text import extract_text, render


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain  text\n more", "plain text more"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("a<br>b<b>c</b> d", "a\nbc d"),
        ("<ul><li>a<li>b<ol><li>c<li>d</ol></ul>e", "- a\n- b\n  1. c\n  2. d\n\ne"),
        ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>x", "a     bbb\ncccc  d\n\nx"),
        ("<table><td colspan=2>wide<tr><td>a<td>b</table>", "wide\na  b"),
        ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
        ("<head><title>t</title></head><body>b", "b"),
        ("<script>var t='</p>';</script>x<!-- no -->y", "xy"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("1 < 2 &amp; 3 &gt; 2", "1 < 2 & 3 > 2"),
        ("</p></div>x<b>y</i></b>", "xy"),
        ("<a title='>'>q</a>", "q"),
    ],
)
def test_layout(html, text):
    assert render(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="a"">text</div><p>more', "text\n\nmore"),
        ("<p title=it's>one</p><p>two it's</p>three", "one\n\ntwo it's\n\nthree"),
        ('<p a"b>one</p>two "three"', 'one\n\ntwo "three"'),
        ("<p a='x'y' b>one</p>two", "one\n\ntwo"),
        ("<p a = '>' b=\">\"c>one", "one"),
        ("<p =\"a>one", "one"),
        ("<p a= >one</p \">two", "one\n\ntwo"),
        ('x<p a="one>two', "x"),
    ],
)
def test_a_quote_opens_a_value_only_after_an_equals_sign(html, text):
    assert render(html) == text


@pytest.mark.parametrize("attributes", [
    'class="btn hidden lg:flex"', 'title="the hidden valley"', 'aria-label="a hidden gem"', 'data-hidden="hidden"',
    "alt='style=display:none'", 'title="style = visibility:hidden"', "data-style='display:none'", "title=hidden",
    'style="backface-visibility: hidden"', "style='overflow:hidden'", 'style="display:none;display:block"', "style",
    "aria-hidden=false", 'a="" b=\' hidden \'', "style='color:red' style='display:none'",
])
def test_shown_elements(attributes):
    assert render(f"<p {attributes}>one</p>two") == "one\n\ntwo"


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN", 'hidden=""', "hidden=until-found", "class='a'hidden", "a/hidden", "style=display:none", "hidden/",
    "title='a' hidden", 'STYLE = "color: red; Display : none !important; display: block"', "style='visibility:hidden'",
    "style='display:/* a */none'", "style='display&#58;none'", "x='hidden' style=';display:none;'",
])
def test_elements_that_are_not_shown(attributes):
    assert render(f"<p {attributes}>one</p>two") == "two"


def test_a_cell_spans_only_by_its_own_attribute():
    assert render("<table><td title='colspan=2'>wide<td>x<tr><td>a<td>b</table>") == "wide  x\na     b"


def end_of_tag(html):
    """Brute force: the tokenizer's states, character by character, from the tag name's end; None if the tag stays open."""
    state = "before"
    for at, c in enumerate(html):
        space = c in " \t\n\r\f"
        if state in "\"'":
            state = "before" if c == state else state
        elif c == ">":
            return at
        elif state == "value" and c in "\"'":
            state = c
        elif state in ("value", "unquoted"):
            state = state if state == "value" and space else "before" if space else "unquoted"
        elif c == "=" and state in ("name", "after"):
            state = "value"
        elif space:
            state = "after" if state in ("name", "after") else "before"
        else:
            state = "before" if c == "/" else "name"
    return None


@settings(max_examples=1000, deadline=None)
@given(st.text("ab \n/='\">", max_size=25))
def test_tags_end_where_the_tokenizer_ends_them(html):
    end = end_of_tag(" " + html)
    assert render(f"x<b {html}") == ("x" if end is None else render("x" + html[end:]))


class Words(HTMLParser):
    """Brute force: all words outside elements that are not shown."""

    def __init__(self):
        super().__init__()
        self.unseen, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.unseen += tag in ("head", "script", "style", "title")
        self.words.append(" ")

    def handle_endtag(self, tag):
        self.unseen -= tag in ("head", "script", "style", "title")
        self.words.append(" ")

    def handle_data(self, data):
        if not self.unseen:
            self.words.append(data)


def test_every_visible_character_of_the_pages_is_kept():
    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        words = Words()
        words.feed(html)
        words.close()
        strip = lambda s: "".join(s.split()).replace("-", "")
        assert strip(render(html)) == strip("".join(words.words))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <table> </table> <tr> <td> <th> </td> <ul> <ol> <li> </li> </ul> <pre> </pre> <div hidden> </div> <b> "
    "</b> <head> </head> <br> text <select> <option> <dl> <dt> <dd> < &amp; <textarea> </textarea> <caption>".split()
), max_size=40))
def test_any_soup_is_rendered(parts):
    assert isinstance(render(" ".join(parts)), str)


def test_deep_and_long_pages_take_linear_work():
    assert render("<div>" * 50_000 + "x") == "x"
    assert len(render("<p>word " * 50_000).split()) == 50_000
    assert render("y" + "<a b='" * 20_000 + "x>") == "y"


def test_table(spark, rows):
    pages = spark.createDataFrame([(1, "<p>a", 5), (2, None, 6), (None, "b", 7), (1, "<p>a", 5)], "page_id long, html string, text long")
    assert rows(extract_text(pages)) == sorted([(1, "a"), (2, ""), (None, "b"), (1, "a")], key=repr)
    assert extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f</table>", "a  b  c\nd     e\nf"),
        ("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "ab    c\n      d\ne  f  g"),
        ("<table><tr><td colspan=2>a long one<td>x<tr><td>1<td>2<td>3</table>", "a long one  x\n1  2        3"),
        ('<p style="visibility:hidden">a<span style="visibility:visible">b</span>c</p>d', "b\n\nd"),
        ('<div style="visibility:hidden">a<p>b</p></div><p style="visibility:collapse">c</p>d', "d"),
        ('<table><tr style="visibility:collapse"><td>a<tr><td>b</table>', "b"),
        ('<div style="display:none"><p style="display:block;visibility:visible">a</p></div>b', "b"),
        ('<p hidden>a</p><p hidden style="display:block">b</p><dialog>c</dialog><dialog open>d</dialog>', "b\n\nd"),
        ("<style>.x{display:none} #y{visibility:hidden}</style><p class='w x'>a</p><p id=y>b<i style='visibility:visible'>c</i></p>d", "c\n\nd"),
        ("<p class=x>a</p>b<style>.x{display:none}</style>", "b"),
        ("<style>p{display:none} p.show{display:block}</style><p>a<p class=show>b", "b"),
        ("<style>.x{display:none !important}</style><p class=x style='display:block'>a</p>b", "b"),
        ("<style>.x{display:none}</style><p class=x style='display:block'>a</p>b", "a\n\nb"),
        ("<style media=print>p{display:none}</style><style>@media print{p{display:none}} div p{display:none} /* p{display:none} */</style><p>a", "a"),
        ("<!-- <style>p{display:none}</style> --><p>a", "a"),
        ("<details>x<summary>s</summary>y<p>z</p></details>w", "s\nw"),
        ("<details open><summary>s</summary><p>z</p></details>w", "s\n\nz\n\nw"),
        ("<details><summary>s</summary><details open>n</details></details>w", "s\nw"),
    ],
)
def test_what_is_shown_and_where(html, text):
    assert render(html) == text


def test_wide_cells_are_wrapped_and_stay_aligned():
    words = " ".join(f"word{n}" for n in range(60))
    lines = render(f"<table><tr><td>{words}<td>right<td>{words}<tr><td>a<td>b<td>c</table>").split("\n")
    assert " ".join(lines).split().count("word59") == 2 and all(len(line) <= 80 + 2 + 5 + 2 + len(words) for line in lines)
    column = lines[0].index("right")
    assert lines[-1].startswith("a") and lines[-1].index("b") == column and lines[-1].index("c") == column + 7
    assert sorted(" ".join(line[:column] for line in lines[:-1]).split()) == sorted(words.split())
