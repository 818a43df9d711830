import pytest
from pyspark.sql import functions as F

from replylane.operators import shape
from replylane.operators.pairs import build_pairs, reply_pairs
from replylane.sources.messages import cast_messages, read_message_csv
from replylane.schemas import PAIR, RAW_CSV

AT = "Tue Oct 31 22:10:{:02d} +0000 2017"
SCHEMA = "ordinal long, message_id string, author_id string, inbound boolean, created_at string, text string, reply_to_id string"

ROWS = [
    (1, "c1", "u1", True, AT.format(30), "@brand where is my plane", None),
    (2, "a1", "brand", False, AT.format(40), "on its way @u1", "c1"),
    (3, "a2", "brand", False, AT.format(41), "second answer to it", "c1"),
    (4, "a3", "brand", False, AT.format(42), "no parent", None),
    (5, "a4", "brand", False, AT.format(43), "dangling parent", "nowhere"),
    (6, "a5", "brand", False, AT.format(44), "self reply", "a1"),
    (7, "s1", "system", False, AT.format(45), "a system line of text", None),
    (8, "a6", "brand", False, AT.format(46), "to the system", "s1"),
    (9, "d1", "u2", True, AT.format(10), "the first copy stands", None),
    (10, "d1", "u2", True, AT.format(11), "the second copy is dropped", None),
    (11, "a7", "brand", False, AT.format(47), "to the copies", "d1"),
    (12, "d2", "u3", False, AT.format(12), "first copy is outbound", None),
    (13, "d2", "u3", True, AT.format(13), "second copy is inbound", None),
    (14, "a8", "brand", False, AT.format(48), "hidden by the first copy", "d2"),
    (15, "e1", "u4", True, "no time at all", "1234567 8", None),
    (16, "a9", "brand", False, AT.format(49), None, "e1"),
    (17, "f1", "u5", True, AT.format(1), "1234567", None),
    (18, "a10", "brand", False, AT.format(50), "too short a question", "f1"),
    (19, "c2", "u1", True, AT.format(51), "a follow-up in the thread", "a1"),
    (20, "a11", "brand", False, AT.format(52), "follow-up answer", "c2"),
    (21, "x1", "other", False, AT.format(53), "other brand", "c1"),
]


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_build_pairs(messages):
    built = build_pairs(messages, "brand", "PX", F.col("ordinal"))
    assert built.schema.names == PAIR.names
    rows = [
        (r["pair_id"], r["customer_message_id"], r["agent_message_id"], r["agent_clean"])
        for r in built.orderBy("pair_id").collect()
    ]
    assert rows == [
        ("PX-000000", "d1", "a7", "to the copies"),
        ("PX-000001", "c1", "a1", "on its way"),
        ("PX-000002", "c1", "a2", "second answer to it"),
        ("PX-000003", "c2", "a11", "follow-up answer"),
        ("PX-000004", "e1", "a9", ""),
    ]
    first = built.where("pair_id = 'PX-000000'").first()
    assert first["customer_clean"] == "the first copy stands"
    assert first["customer_time"] is not None
    assert built.where("pair_id = 'PX-000004'").first()["customer_time"] is None


def test_first_turn_only(messages):
    pairs = reply_pairs(messages, "brand", F.col("ordinal"), first_turn_only=True)
    got = {(r["customer_message_id"], r["agent_message_id"]) for r in pairs.collect()}
    assert got == {("c1", "a1"), ("d1", "a7"), ("e1", "a9"), ("f1", "a10")}


def test_hot_parent_takes_the_other_branch_and_keeps_all_rows(spark, messages):
    cold = reply_pairs(messages, "brand", F.col("ordinal"))
    hot = reply_pairs(messages, "brand", F.col("ordinal"), hot_rows=2)
    assert hot.exceptAll(cold).count() == 0 and cold.exceptAll(hot).count() == 0


def test_join_small_salted_equals_broadcast(spark, monkeypatch):
    left = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    for how in ("inner", "left"):
        plain = shape.join_small(left, small, ["k"], how)
        monkeypatch.setattr(shape, "SMALL_ROWS", 1)
        salted = shape.join_small(left, small, ["k"], how)
        monkeypatch.undo()
        assert salted.select("k", "id", "v").exceptAll(plain.select("k", "id", "v")).count() == 0
        assert salted.count() == plain.count() == (500 if how == "left" else 334)


def test_dense_index_over_equal_keys(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    got = shape.dense_index(df, [F.col("k"), F.col("id").desc()], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1000))
    assert [(r["k"], r["id"]) for r in got[:2]] == [(0, 998), (0, 996)]


def test_csv_scan(spark, tmp_path):
    (tmp_path / "dump.csv").write_text(
        'tweet_no,author_id,inbound,created_at,text,extra,parent_no\n'
        '1,u1,True,t1,"two\nlines and ""quotes""",zzz,\n'
        '2,brand,False,t2,NA,zzz,1\n'
        '3,u2,true,t3,null,zzz,NA\n'
        '4,u3,,t4,"a, b",zzz,None\n',
        encoding="utf-8",
    )
    renames = {"tweet_no": "message_id", "parent_no": "reply_to_id"}
    rows = read_message_csv(spark, str(tmp_path / "dump.csv"), renames).orderBy("message_id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "u1", True, "t1", 'two\nlines and "quotes"', None),
        ("2", "brand", False, "t2", None, "1"),
        ("3", "u2", False, "t3", None, None),
        ("4", "u3", False, "t4", "a, b", None),
    ]


def test_cast_keeps_the_schema(spark):
    raw = spark.createDataFrame([("1", "a", "True", "t", "x", "NA")], RAW_CSV)
    assert tuple(cast_messages(raw).first()) == ("1", "a", True, "t", "x", None)


def test_texts_are_not_sorted_to_find_parents(spark):
    messages = spark.createDataFrame([], SCHEMA)
    plan = reply_pairs(messages, "brand", F.col("ordinal"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
