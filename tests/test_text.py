from datetime import datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from replylane.functions import text


def test_clean_text(column):
    cases = {
        None: "",
        "  hello\n\tworld  ": "hello world",
        "@someone": "",
        "https://t.co/abc": "",
        "see https://t.co/a?b=1 now": "see now",
        "a &amp;lt; b": "a &lt; b",
        "x &ampfoo": "x &foo",
        "it&#39;s": "it's",
        "hi @josé there": "hi there",
        "mail me@home.org": "mail me.org",
        "a b\u001cc": "a b c",
        "ok \U0001F621 #worst!!": "ok \U0001F621 #worst!!",
        "http://x": "",
    }
    assert column(list(cases), text.clean_text) == list(cases.values())


def test_entities_are_decoded_once(column):
    got = column(["&amp;amp;", "&copy;&eacute;", "&notit;", "plain", None], text.decode_entities)
    assert got == ["&amp;", "©é", "¬it;", "plain", None]


def test_null_tokens(column):
    values = ["", "NA", "null", "None", "nan", "n/a", "N.A.", "text", None]
    assert column(values, text.null_if_token) == [None] * 6 + ["N.A.", "text", None]


def test_message_time(column):
    values = [
        "Tue Oct 31 22:10:47 +0000 2017", "Wed Oct 11 06:55:44 +0200 2017",
        "Xyz Oct 31 22:10:47 +0000 2017", "2017-10-31", "Tue Oct 41 22:10:47 +0000 2017", None,
    ]
    got = column(values, lambda c: F.date_format(text.parse_message_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2017-10-31 22:10:47", "2017-10-11 04:55:44", None, None, None, None]


def test_month_edge_is_utc(column):
    values = ["Tue Oct 31 23:30:00 -0100 2017"]
    month = column(values, lambda c: text.month_of(text.parse_message_time(c)))
    assert month == [datetime(2017, 11, 1)]


def test_blank_and_strip(column):
    values = ["", " \n \u001f", None, " a ", "\n{}\n"]
    assert column(values, text.is_blank) == [True, True, True, False, False]
    assert column(values, text.strip) == ["", "", None, "a", "{}"]


def test_terms(spark):
    rows = [(1, "The QUICK, a quick fox_1 é"), (2, ""), (3, None), (4, "one"), (5, "Élan vital")]
    df = text.with_terms(spark.createDataFrame(rows, "id int, t string"), "t")
    got = {r["id"]: r["terms"] for r in df.collect()}
    assert got[1] == ["the", "quick", "quick", "fox_1", "the quick", "quick quick", "quick fox_1"]
    assert got[2] == [] and got[3] == [] and got[4] == ["one"]
    assert got[5] == ["élan", "vital", "élan vital"]
    only_three = text.with_terms(
        spark.createDataFrame([("aa bb cc dd",)], "t string"), "t", ngrams=(3, 3)
    )
    assert only_three.first()["terms"] == ["aa bb cc", "bb cc dd"]


def test_display(column):
    assert column(["info_question"], text.display_label) == ["Info Question"]
    assert column([0.125, 0.126, 1.0], text.display_percent, "double") == ["12%", "13%", "100%"]


words = st.text(alphabet="ab_é1 -\n@", max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(words, min_size=1, max_size=20))
def test_terms_match_a_plain_loop(spark, texts):
    import re

    df = text.with_terms(
        spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "t"
    )
    for row in df.collect():
        tokens = [w for w in re.findall(r"\w+", row["t"].lower()) if len(w) > 1]
        assert row["terms"] == tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
