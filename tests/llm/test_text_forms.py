import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from edflux.llm import chat
from edflux.llm.html_text import html_text, page_text

ANY = st.text(st.characters(codec="utf-8"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ANY, ANY | st.sampled_from(["\\### Assistant: </turn> ok", "</turn>\n### user: ", "\\", "#<"])), max_size=5))
def test_turns_read_back(turns):
    text = "".join(s for role, t in turns for s, _ in chat.segments(role, t))
    assert list(chat.parse(text)) == turns


def test_broken_output_is_refused():
    with pytest.raises(ValueError):
        list(chat.parse("### user: a<b</turn>\n"))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b#"), (1, 0, "user", "a"), (2, 0, "assistant", "x"), (3, 0, "user", None), (3, 1, "assistant", "y"), (3, 1, "assistant", "y"),
        (4, None, None, "z"), (None, 0, "user", "n"), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "😀"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, loss int").repartition(4)
    got = {r.conv_id: r for r in chat.digest(chat.format_chat(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb#\n") and got[1].loss_sha256 == sha("b#") and got[1].loss_chars == 2
    assert got[1].formatted_chars == len("### user: a</turn>\n### assistant: b\\#</turn>\n")
    assert {c: got[c].valid_order for c in got} == {1: True, 2: False, 3: False, 4: False, 5: True, None: False}
    assert (got[3].n_turns, got[3].loss_sha256) == (3, sha("yy")) and got[5].loss_chars == 1
    assert got[4].turns_sha256 == sha("\nz\n")
    assert chat.digest(chat.format_chat(df.limit(0))).collect() == []
    flags = chat.format_chat(df).where("conv_id = 1").orderBy("seq").collect()
    assert [(r.segment, r.loss) for r in flags][3:] == [("### assistant: ", False), ("b\\#", True), ("</turn>\n", False)]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<p>b</p>c", "a\n\nb\n\nc"),
        ("<div>a<div>b</div></div>c<br>d", "a\nb\nc\nd"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
        ("<table><tr><th>n<th>long name<tr><td>row<td>1<tr><td colspan=2>all</table>x", "n    long name\nrow  1\nall\n\nx"),
        ("<p>a<span hidden>b</span><i style='DISPLAY : none'>c</i> d", "a d"),
        ("<head><title>t</title><style>p{}</style></head><script>if(a<b)</script>x<!-- y --><noscript>z</noscript>", "x"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("a &lt;b&gt; &amp;amp; &#233;", "a <b> &amp; é"),
        ("<details><summary>s</summary>no</details><details open>yes</details>", "s\nyes"),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
        ("x</b></p><p>y<!-- open", "x\n\ny"),
        ("<p title='a>b'>q</p><a href=", "q"),
        ("1 < 2 & 3", "1 < 2 & 3"),
        ("<a href=x\">stray</a> quotes <b it's>in</b> <i title = \"a>b\">tags</i> \"kept\"", "stray quotes in tags \"kept\""),
        ("a<dialog>b</dialog><dialog open>c</dialog>", "a\nc"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ],
)
def test_pages(page, text):
    assert page_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("a<p style='backface-visibility:hidden; -webkit-backface-visibility: hidden'>b", "a\n\nb"),
        ("a<p style='visibility:hidden'>b <b style='Visibility: Visible'>c</b> d</p>e", "a\n\nc\n\ne"),
        ("<p style='display:none;display:block'>a<p style='display:none!important;display:block'>b", "a"),
        ("<p style='display:none'>a<b style='display:inline;visibility:visible'>b</b></p>c", "c"),
        ("<p style='x:\"display:none\";/* visibility:hidden */'>a<p style='visibility:hidden;'>b<p style='visibility:nonsense'>c", "a\n\nc"),
    ],
)
def test_styles(page, text):
    assert page_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("a <textarea>\nb  &lt;i>\n c</textarea> d", "a b  <i>\n c d"),
        ("a <select><option>b<option selected>c</select> d <select><option disabled>e<optgroup><option label=f>g</select>", "a c d f"),
        ("<select multiple><option>a<option>b</select>", "a\nb"),
        ("<svg><title>t</title><desc>d</desc><defs/><rect x='1'/><text>a</text><text>b</text></svg>c", "a\nb\nc"),
        ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math>", "so x= 1 2"),
    ],
)
def test_forms_figures_and_formulas(page, text):
    assert page_text(page) == text


def test_deep_and_long_pages():
    assert page_text("<div>" * 50_000 + "x" + "</p></i>" * 5_000).strip() == "x"
    assert len(page_text("<li>word " * 50_000).split("\n")) == 50_000


def test_pages_table(spark):
    df = spark.createDataFrame([(1, "<p>a", 5), (1, "<p>a", 5), (2, None, 6)], "page_id long, html string, text int")
    out = html_text(df)
    assert out.columns == ["page_id", "html", "text"]
    assert sorted((r.page_id, r.text) for r in out.collect()) == [(1, "a"), (1, "a"), (2, "")]
    assert html_text(df.limit(0)).collect() == []


TABLES = [
    ("<table><tr><td>x<td rowspan=2>R<td>z1<tr><td>y<td>z2</table>", "x  R  z1\ny     z2"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "ab    c\n      d\ne  f  g"),
    ("<table><tr><td rowspan=2>a<td><table><tr><td rowspan=2>i<td>j<tr><td>k</table><tr><td>l</table>", "a  i  j k\n   l"),
    ("<table><tr><td colspan=3>long title<tr><td>a<td>b<td>c</table>", "long title\na  b  c"),
    (f"<table><tr><td>{'w' * 101}<td>x<tr><td>a<td>b</table>", f"{'w' * 101}  x\na  b"),
]
LISTS = [
    ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<ol type=a start=26><li>a<li>b</ol>", "z. a\naa. b"),
    ("<ol type=I start=8><li>a<li>b<li value=1994>c<li value=4000>d<li value=-1>e</ol>", "VIII. a\nIX. b\nMCMXCIV. c\n4000. d\n-1. e"),
    ("<ul><li>a<ol><li type=i value=4>b</ol><li>c</ul>", "- a\n  iv. b\n- c"),
]
FORMS = [
    ("<input type=submit value=Go><input type=hidden value=no><input type=password value=no>", "Go"),
    ("Name<input value=Bo><input type=submit>", "Name Bo Submit"),
    ("<input type=search placeholder='Find it'>", "Find it"),
    ("<ruby>k<rp>(</rp><rt>r</rt><rp>)</rp></ruby>", "kr"),
]
SHEETS = [
    ("<style>.off{display:none}</style>a<p class='on off'>b</p>c", "ac"),  # no box, no break
    ("<style>p.off, #x{visibility:hidden}</style><p class=off>a</p><p id=x>b</p><div class=off>c</div>", "c"),
    ("<style>@media print{p{display:none}} @import 'x'; .a{display:none}</style><p>a<p class=a>b", "a"),
    ("<style>.a{display:none} #i{display:block}</style><p class=a id=i>a<p class=a style='display:block'>b", "a\n\nb"),
    ("<style>.a{display:none !important}</style><p class=a style='display:block'>a<p class=a style='display:block!important'>b", "b"),
    ("<style>div p{display:none} p:hover{display:none} /* p{display:none} */</style><div><p>a</div>", "a"),
    ("<template><style>p{display:none}</style></template><style media=print>p{display:none}</style><p>a", "a"),
    ("<style>p{display:none", ""),
]


@pytest.mark.parametrize("page, text", TABLES + LISTS + FORMS + SHEETS)
def test_grids_numbers_forms_and_sheets(page, text):
    assert page_text(page) == text


def test_wide_tables_stay_linear():
    rows = "<tr><td>y" * 20_000
    assert len(page_text(f"<table><tr>{'<td rowspan=60000>x' * 20_000}{rows}</table>")) < 100_000_000
    assert page_text(f"<table><tr>{'<td colspan=1000>x' * 20_000}</table>") == "x  " * 19_999 + "x"
    assert len(page_text(f"<table><tr><td>{'w ' * 100_000}<td>x{'<tr><td>a<td>b' * 20_000}</table>")) < 1_000_000
