"""Character references."""
from conftest import one_col
from quotemill.functions import html as H


def test_single_pass(spark):
    assert one_col(spark, ["A &amp;lt; B &#233;&#x1F600; &copy;&unknown;", None, "plain"], H.decode_entities) == [
        "A &lt; B \u00e9\U0001F600 \u00a9&unknown;", None, "plain"]
    assert one_col(spark, [["a&amp;b", "c"], []], H.decoded, "array<string>") == [["a&b", "c"], []]
    assert one_col(spark, [["a&amp;b", "c"], []], H.first_text, "array<string>") == ["a&b", None]


def test_character_references_out_of_range(spark):
    got = one_col(spark, ["&#1114112;", "&#9999999999;", "&#xD800;", "&#0;", "&#x000041;", "&#xFFFFFFFFF;"],
                  lambda c: H.decode_entities(c))
    assert got == ["�", "�", "�", "�", "A", "�"]


def test_entities_of_html_4(spark):
    got = one_col(spark, ["&Eacute;t&eacute; &euro;&nbsp;1", "&#233 &#xe9;", "&eacute x", "&apos;&nosuch;"],
                  H.decode_entities)
    assert got == ["\u00c9t\u00e9 \u20ac\u00a01", "\u00e9 \u00e9", "&eacute x", "'&nosuch;"]
