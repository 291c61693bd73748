import pytest
from pyspark.sql import functions as F

from noticeloom.functions import text as T


def apply(spark, fn, value):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("<p>a b</p><p>c</p>", "ab\nc\n"),
        ("<td>x\ty</td><td>z</td>", "x\ny\nz\n"),
        ('<script>var t="</p>";</script><p>k</p>', "k\n"),
        ("<noscript>n</noscript><style>p{}</style>v<!-- <p>c</p> -->w", "vw"),
        ("a\r\n\r\nb\fc", "a\nb\nc"),
        ("a😀b", "ab"),
        ("&lt;b&gt; &amp;lt; &#20013;&#x6807; &copy;&nope;", "<b>&lt;中标©&nope;"),
        ('<a href="x>y">t</a><b title=\'">\'>u</b>', "tu"),
        ('<p>x</p><input value="&lt;p&gt;Hello&lt;/p&gt;">', 'Hello">x\n'),
        ('<input value="plain">x', "x"),
        ("1 < 2 and 3 > 2", "1<2and3>2"),
        ("&apos;x &copy 2020 &#150; &#0;&#xD800;&#x110000;&#99999999999;&#1;&#x80", "'x©2020–\ufffd\ufffd\ufffd\ufffd€"),
        ("&notit; &notin; &ampx &CounterClockwiseContourIntegral; &amp &;&", "¬it;∉&x∳&&;&"),
        ("<p>a</p><div class='x>b", "a\nb"),
        ('<a href="x>y', "y"),
        ("<a title='x\">y</a>z", "yz"),
        ("a<b", "a<b"),
    ],
)
def test_clean_html(spark, html, want):
    assert apply(spark, T.clean_html, html) == want


def test_clean_html_short_drops_tabs(spark):
    assert apply(spark, T.clean_html_short, "<td>x\ty</td>") == "xy\n"


@pytest.mark.parametrize(
    "text, want",
    [
        ("&amp;lt;", "<"),
        ("&amp;amp;gt;", ">"),
        ("&#38;quot;", '"'),
        ("a&nbsp;b&#160;c", "a b c"),
        ("x&foo;y&#9999;z", "xyz"),
        ("AT&T; a & b", "AT a & b"),
        ("&am&x;p;", "&"),
        ("&a&a&a;;;", ""),
        ("&a" * 30 + ";" * 30, ""),
        ("&a" * 9 + ";" * 5 + "&x", "&a&a&a&a&x"),
    ],
)
def test_replace_entities(spark, text, want):
    assert apply(spark, T.replace_entities, text) == want


def test_strip_tags_plain(spark):
    html = "a&lt;br&gt;b<br/>c</td>d<p class='x'>e</p><!-- f -->&amp;nbsp;g"
    assert apply(spark, T.strip_tags_plain, html) == "a\nb\nc de g"


@pytest.mark.parametrize("html, want", [("<p>中 标_1!</p>😀", "'中标_1'"), ("<p> !</p>", ""), ("", ""), (None, "")])
def test_word_content(spark, html, want):
    assert apply(spark, T.word_content, html) == want


def test_general_value_trims_and_caps(spark):
    assert apply(spark, T.general_value, " 　a b\tc\r\nd  ") == "abcd"
    assert len(apply(spark, T.general_value, "x" * 500)) == 500
    assert len(apply(spark, lambda c: T.general_value(c, T.VALUE_LIMIT), "x" * 500)) == 300
    assert apply(spark, T.general_value, None) is None


def test_bracket_fields_last_key_wins(spark):
    assert apply(spark, T.bracket_fields, "头【名 称】甲【金额　】1【名称】乙") == {"名称": "乙", "金额": "1"}


def test_post_fields(spark):
    got = apply(spark, T.post_fields, "发信人: ann (A), 信区 站内 hi there --end")
    assert (got["sender"], got["content"]) == ("ann (A)", "hi there")
    none = apply(spark, T.post_fields, "nothing")
    assert none["sender"] is None and none["content"] is None


def test_md5_mark_round_trip(spark):
    assert apply(spark, lambda c: T.drop_md5_mark(T.add_md5_mark(c, F.md5(c))), "t") == "t"


def test_references_match_the_standard_rules(spark):
    import html
    import random
    from html.entities import html5

    rng = random.Random(3)
    names = list(html5)
    made = ["&" + rng.choice(names) + rng.choice(["", "x", ";", " ", "1", "&"]) for _ in range(300)]
    made += [f"&#{rng.choice(['', 'x'])}{n};" for n in [0, 9, 13, 31, 80, 91, 127, 128, 129, 150, 159, 160, 255, 1114111, 1114112, 55296, 64976, 65534]]
    df = spark.createDataFrame([(t,) for t in made], "v string")
    for row in df.select("v", T.decode_entities(F.col("v")).alias("r")).collect():
        assert row["r"] == html.unescape(row["v"]), row["v"]


def test_very_long_tags(spark):
    many = "".join(f' a{i}="x>{i}"' for i in range(20000))
    page = f"<p>k</p><div{many}>t</div><input value={'q' * 200000}>e"
    got = apply(spark, T.clean_html, page)
    assert got.endswith("k\nte")
    assert apply(spark, T.strip_tags_plain, "<b" + many + ">u")[-1] == "u"
    assert apply(spark, T.word_content, page) == "'kte'"
    assert apply(spark, T.clean_html, "<div " + "x='" * 50001 + ">v") != ""
