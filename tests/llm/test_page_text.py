import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duebook.llm.page_text import extracted, visible_text

CASES = {
    "a  b\n c": "a b c",
    "<p>one<p>two": "one\n\ntwo",
    "<div>one</div><div>two</div>": "one\ntwo",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<p><b>x<p>y": "x\n\ny",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=9><li>a<li>b<li value=3>c</ol>": "9. a\n10. b\n3. c",
    "<ol type=a><li>x</ol>": "a. x",
    "<table><tr><th>Name<th>N<tr><td>apple<td>5<tr><td>fig<td>10</table>": "Name   N\napple  5\nfig    10",
    "<table><td>a<td rowspan=2>b<tr><td>c</table>": "a  b\nc",
    "<table><tr><td>a<br>bb<td>x<tr><td colspan=2>wide</table>": "a     x\nbb\nwide",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<pre>\n a  b\n\n c</pre>": " a  b\n\n c",
    "<head><title>no</title></head><body>yes": "yes",
    "<script>if (a<b) '</p>'</script>x<style>p{}</style>": "x",
    "<p hidden>no</p><p style='Display : none'>no</p>yes": "yes",
    "<style>.a, b.c{display:none}</style><p class='z a'>no<b class=c>no</b><i class=c>yes</i>": "",
    "<style>@media print{nav{display:none} p{display:none}} b{display:none}</style><nav>x</nav><b>no</b>": "x",
    "<style>@media print,screen{b{display:none}}</style><b>no</b>x": "x",
    "<style>@media (max-width:600px){b{display:none}}@media (min-width:40em){i{display:none}}</style><b>x</b><i>no</i>": "x",
    "<style>@import 'a.css';@media not print{b{display:none}}@page{i{display:none}}</style><b>no</b><i>x</i>": "x",
    "<style>@media print{b{display:none}</style><b>x</b>": "x",
    "<style>@layer a{@supports (x:y){b{display:none}} i{display:none}}</style><b>no</b><i>no</i>x": "x",
    "<style>#k{display:inline}b.c{display:none}</style><b id=k class=c>x</b>": "x",
    "<style>.c{display:none ! important}</style><b class=c style='display:inline'>no</b>x": "x",
    "<style>b{display:none}</style><style>b{display:inline}</style><b>x</b>": "x",
    "<style>.a{visibility:hidden}</style><p class=a>no<b style='visibility:visible'>yes</b>": "yes",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>u</details>": "s\nt\nu",
    "<!-- no -->x<!-- cut": "x",
    "x <a href=\"a>b\" title='>'>link</a>": "x link",
    "3 < 4 &amp; 5 &gt; 2 &copy;&nbsp;&#233; &unknown;": "3 < 4 & 5 > 2 ©\xa0é &unknown;",
    "cut <a href='x": "cut",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
    "<textarea>a<b></textarea><input type=hidden value=no><input value=v>": "a<b> v",
    "</p>stray</div>": "stray",
    "": "",
}


@pytest.mark.parametrize("page", list(CASES))
def test_layout(page):
    assert visible_text(page) == CASES[page]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<pre>", "</pre>", "<b", ">", "x", " y ", "\n", "<!--", "-->", "<details>", "<dd>", "'", '"', "="]), max_size=40))
def test_never_fails(parts):
    text = visible_text("".join(parts))
    assert text == "\n".join(line for line in text.split("\n"))
    assert all(line == line.rstrip(" ") for line in text.split("\n"))


def test_depth_and_length_are_no_limit():
    assert visible_text("<div>" * 50_000 + "deep") == "deep"
    assert visible_text("<table><tr><td>" * 300 + "deep").strip() == "deep"
    assert visible_text("word " * 300_000).count("word") == 300_000
    assert visible_text("<" * 50_000) == "<" * 50_000


def test_edges(spark):
    rows = [(1, "u", "<p>a", "t"), (1, "u", "<p>a", "t"), (2, None, None, None), (None, "", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(((r.page_id, r.text, r.n_chars, r.n_lines) for r in extracted(df).collect()), key=str)
    assert found == sorted([(1, "a", 1, 1), (1, "a", 1, 1), (2, "", 0, 0), (None, "", 0, 0)], key=str)
    assert extracted(df.limit(0)).isEmpty()
