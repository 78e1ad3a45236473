"""Elements, selectors and paths: any depth, omitted end tags, unbalanced pages."""
import pytest
from quotemill.functions.dom import Page, Selector, compiled
from quotemill.operators.select import Each, select_fields


def texts(html, *chain):
    return Page(html).values(compiled(chain))


def test_nesting_of_any_depth():
    for depth in (1, 33, 200, 5000):
        html = "<div class='deep'>" + "<div>" * depth + "<a href='/x'>in</a>" + "</div>" * depth + "<a>after</a></div><a>out</a>"
        assert texts(html, "div.deep a::text") == ["in", "after"]
        assert texts(html, "div.deep > a") == ["after"]
    nav = "<nav>" * 40 + "<a>1</a>" + "</nav>" * 39 + "<a>2</a></nav><a>3</a>"
    assert texts(nav, "nav a") == ["1", "2"]


def test_child_position_and_attribute_steps():
    html = ('<table class="t x"><tr class=tabrow><td><span>k</span> <i></i><span title="a>b">v<br>w</span></td>'
            '<td><b><span>deep</span></b></td></tr></table><font><b><span style="color: #f00;">no</span></b></font>'
            '<font size="1"><span style="top;color: #f00;">yes</span></font>')
    cells = compiled("table.t tr.tabrow td")
    page = Page(html)
    first, last = compiled("span:first-child"), compiled("span:last-child")
    assert [page.values(first, i) for i in page.select(cells)] == [["k"], ["deep"]]
    assert [page.values(last, i) for i in page.select(cells)] == [["v", "w"], ["deep"]]
    assert texts(html, 'font > span[style*="color: #f00;"]') == ["yes"]
    assert texts(html, 'font[size="1"] span::attr(style)') == ["top;color: #f00;"]
    assert texts(html, "span::attr(title)") == [None, "a>b", None, None, None]
    assert texts(html, "table", "td", "*.none") == []


def test_omitted_and_missing_end_tags():
    assert texts("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "ul > li") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>1<td>2<table><tr><td>in</table><tr><td>3</table>", "td") == ["1", "2", "in", "3"]
    assert texts("<div><p>a<p>b<div>c</div>d</div>", "div p") == ["a", "b"]
    assert texts("<p>one <b>two <i>three</i></p><p>four</p>", "p") == ["one ", "two ", "four"]
    assert texts("<div>a</span>b</div></div><p>c", "div") == ["a", "b"]
    assert texts("<td>x</td></tr></p>1 < 2<p>y<!-- <p>no</p> --><script>'<p>no</p>'</script>z", "p") == ["y", "z"]
    assert texts(None, "p") == texts("", "p") == []


def test_absolute_path_counts_siblings_of_one_name():
    html = ("<!DOCTYPE html><html><head></head><body><p>x</p><div><div>decoy</div></div><div id='q'><span>s</span><div>first</div>"
            "<div><font size='1'>As of now</font></div></div></body></html><font size='1'>later</font>")
    assert texts(html, "/html/body/div[2]/div[2]", 'font[size="1"]') == ["As of now"]
    assert texts(html, "/html/body/div/div") == ["decoy", "first"]
    assert texts(html, "/html/body/div[3]", "font") == texts(html, "/body") == []


@pytest.mark.parametrize("bad", ["", "> a", "a::nothing", "a[href]", "/html//div", "a b:nth-child(2)", "a, b"])
def test_selectors_that_cannot_be_read_are_refused(bad):
    with pytest.raises(ValueError):
        Selector(bad)


def test_select_fields_over_pages(spark):
    pages = spark.createDataFrame(
        [(1, "<div class='m'><ul><li><a href='/1'>A &amp; B</a><li><a>C</a></ul></div>", 7), (2, None, 8), (2**60, "", None)],
        "page_id long, body string, extra int")
    out = select_fields(pages, {"labels": "div.m ul li a", "links": Each("div.m a", {"label": "a", "href": "a::attr(href)"})},
                        ("page_id", "extra"), "body").orderBy("page_id").collect()
    assert [(r.page_id, r.extra, r.labels) for r in out] == [(1, 7, ["A &amp; B", "C"]), (2, 8, []), (2**60, None, [])]
    assert [(x.label, x.href) for x in out[0].links] == [(["A &amp; B"], ["/1"]), (["C"], [None])]
    assert select_fields(pages.limit(0), {"t": "p"}, ("page_id",), "body").count() == 0
    with pytest.raises(ValueError):
        select_fields(pages, {"extra": "p"}, ("extra",), "body")
