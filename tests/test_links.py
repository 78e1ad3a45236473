"""Links and URL rules: FIXTURES.md §3.4, B1-B8."""
from conftest import one_col
from quotemill.operators import links as L

H = "https://h.example"


def test_index_and_company_rules(spark):
    hrefs = ["/en/stock-markets/nse", "/fr/bourse/brvm", "/x", "/fr/xen/y", ""]
    idx = one_col(spark, hrefs, lambda c: L.index_page_url(c, H))
    assert idx == [H + "/en/stock-markets/nse", H + "/fr/bourse/brvm", H + "/en//x", H + "/fr/xen/y", H + "/en/"]
    com = one_col(spark, hrefs[:4], lambda c: L.company_page_url(c, H))
    assert com == [H + "/en/stock-markets/nse/listed-companies", H + "/fr/fr/bourse/brvm/listed-companies",
                   H + "/fr/x/listed-companies", H + "/fr/xen/y/listed-companies"]


def test_missing_href_policies(spark):
    links = spark.createDataFrame([(1, 0, "a", None), (1, 1, "b", ""), (1, 2, "c", "/x")],
                                  "page_id long, pos int, label string, href string")
    kept_i, rej_i = L.drop_missing_href(links, "index")
    kept_c, rej_c = L.drop_missing_href(links, "company")
    assert (kept_i.count(), rej_i.count(), kept_c.count(), rej_c.count()) == (2, 1, 1, 2)


def test_extract_links_scope_class_order(spark):
    html = ('<nav><a class="menu-market-link" href="/out">Out</a></nav><div class="mega-inner"><ul>'
            '<li><a class="menu-market-link" href="/en/a">A (X)</a></li>'
            '<li><a href="/en/plain">Plain</a></li>'
            '<li><a class="big menu-market-link">No href</a></li>'
            '<li><a class="menu-market-link" href="/fr/b?x=1&amp;y=2"><b>bold</b> B &amp; C</a></li></ul></div>')
    pages = spark.createDataFrame([(7, "u", html)], "page_id long, url string, html string")
    rows = L.extract_links(pages, "div", "mega-inner", "menu-market-link").orderBy("pos").collect()
    assert [(r.pos, r.label, r.href) for r in rows] == [
        (0, "A (X)", "/en/a"), (1, "No href", None), (2, " B & C", "/fr/b?x=1&y=2")]


def test_domains_and_canonical(spark):
    urls = ["https://www.m.example/a", "https://x.www.m.example/a", "https://evilwww.m.example/", "nonsense",
            "https://user@WWW.M.example:8443/a b/é"]
    assert one_col(spark, urls, lambda c: L.within_domains(c, ["www.m.example"])) == [True, True, False, False, True]
    assert one_col(spark, urls[-1:], L.url_host) == ["www.m.example"]
    assert one_col(spark, ["http://a/b?z=1&a=2#frag", "http://a/b"], L.canonical_url) == \
        ["http://a/b?a=2&z=1", "http://a/b"]


def test_canonical_forms(spark):
    same = [
        ["http://h/a", "HTTP://H/a", "http://h:/a#x", "http://h/%61"],
        ["http://h/", "http://h", "http://H#top", "http://h/?", "http://h?&"],
        ["https://h:8443/%C3%A9~%20b", "https://H:8443/\u00e9%7E b", "https://h:8443/%c3%a9~%20%62"],
        ["http://h/p?a=&b=1&c=p+q", "http://h/p?c=p%20q&a&b=%31", "http://h/p?b=1&&a=&c=p+q&"],
        ["http://h/x%2Fy%3Fz", "http://h/x%2fy%3fz"], ["http://h/x/y?z="],
        ["http://h/p?a=%26&b=%3D", "http://h/p?b==&a=%26"], ["http://h/p?a=%C3%A9", "http://h/p?a=\u00e9"],
        ["http://h/a:b@c;d=e,f'(g)*!$&+|[i]"], ["http://h/50%", "http://h/50%25"], ["nonsense"], ["/only/path?b=1", "/only/path?b=1#f"]]
    for group in same:
        assert one_col(spark, group, L.canonical_url) == [group[0]] * len(group)
    assert one_col(spark, [None, ""], L.canonical_url) == [None, ""]


def test_absolute_url(spark):
    df = spark.createDataFrame([("https://a.b/x/y?q=1", "/z"), ("https://a.b/x/y", "z"), ("https://a.b", "z"),
                                ("http://a.b/x", "//c.d/e"), ("http://a.b/x", "https://e.f/")], "b string, h string")
    assert [r[0] for r in df.select(L.absolute_url("b", "h")).collect()] == [
        "https://a.b/z", "https://a.b/x/z", "https://a.b/z", "http://c.d/e", "https://e.f/"]


def test_dedupe_first_label_wins_and_resolve(spark):
    links = spark.createDataFrame(
        [(2, 0, "late", "u1"), (1, 5, "first", "u1#top"), (1, 6, "other", "u2"), (3, 0, "gone", "u9")],
        "page_id long, pos int, label string, target_url string")
    d = L.dedupe_links(links).orderBy("canonical_url").collect()
    assert [(r.canonical_url, r.label) for r in d] == [("u1", "first"), ("u2", "other"), ("u9", "gone")]
    pages = spark.createDataFrame([(10, "u1", "<p>1</p>"), (11, "u2", "<p>2</p>")], "page_id long, url string, html string")
    dd = L.dedupe_links(links).drop("target_url").withColumnRenamed("canonical_url", "target_url")
    joined, unresolved = L.resolve_links(dd, pages)
    assert sorted((r.page_id, r.market) for r in joined.collect()) == [(10, "first"), (11, "other")]
    assert [r.target_url for r in unresolved.collect()] == ["u9"]


def test_links_only_inside_list_items(spark):
    html = ("<div class='mega-inner'><div><a class='m' href='/en/out'>Out</a></div><ul><div>"
            "<li><div><a class=m href=/en/a>A</a></div><ul><li><a class='m' href='/en/b'>B</a></ul></div></ul></div>")
    pages = spark.createDataFrame([(7, "u", html)], "page_id long, url string, html string")
    rows = L.extract_links(pages, "div", "mega-inner", "m", inside=("ul", "li")).orderBy("pos").collect()
    assert [(r.label, r.href) for r in rows] == [("A", "/en/a"), ("B", "/en/b")]


def test_resolve_on_canonical_url(spark):
    links = spark.createDataFrame([(1, 0, "A", "http://h/a#top"), (1, 1, "B", "http://h/b?y=2&x=1"),
                                   (1, 2, "C", "http://h/c")], "page_id long, pos int, label string, target_url string")
    pages = spark.createDataFrame([(10, "http://h/a", ""), (11, "http://h/b?x=1&y=2", "")],
                                  "page_id long, url string, html string")
    joined, unresolved = L.resolve_links(L.dedupe_links(links), pages)
    assert sorted((r.page_id, r.market) for r in joined.collect()) == [(10, "A"), (11, "B")]
    assert [r.label for r in unresolved.collect()] == ["C"]
