from revlens.llm import quote_threads
from tests import oracle_harness as oh
from tests.llm.helpers import MIDDLE, table

SCHEMA = "conv_id long, turn long, role string, text string, depth string, parent_turn int"
ROWS = [
    (1, 0, "user", "Hello there.\nHow are you?", "x", 1),
    (1, 1, "assistant", "> how ARE  you?\nFine, thanks.", None, None),
    (1, 2, "user", "On Monday Ann wrote:\n>> How are you?\n> Fine, thanks.\nGood.\n> unknown line\nEnd.", "y", 2),
    (1, 3, "user", "Unrelated.", "z", None),
    (1, 4, "assistant", " > > > How are you?\n>> Fine, thanks.\n> Good.\nDeep.", None, None),
    (1, 5, "user", "> Hello there.\r\n> Unrelated.\r\nBoth", None, None),
    (2, 0, "user", "> Hello there.\nOther conversation", None, None),
    (2, 1, None, None, None, None),
    (2, 2, "user", "", None, None),
    (None, 3, "user", "> Hello there.", None, None),
    (3, None, "user", "Hi", None, None),
    (4, 0, "user", "same", None, None),
    (4, 0, "user", "same", None, None),
    (4, 1, "user", "> same\nyes", None, None),
    *[(5, 1_600_000_000_000 + i, "user", f"> stamp {i - 1}\nstamp {i}", None, None) for i in range(4)],
    (6, -(2 ** 63), "user", "least", None, None),
    (6, -3, "user", "> least\nminus three", None, None),
    (6, 2, "user", "> minus three\ntwo", None, None),
    (6, 2 ** 63 - 1, "user", "> two\nmost", None, None),
    (6, -2, "user", "minus two", None, None),
]


def test_nested_quotes(spark):
    got = quote_threads.threads(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(got) == len(ROWS)
    by = {(r.conv_id, r.turn): r for r in got}
    parents = {k: r.parent_turn for k, r in by.items() if r.parent_turn is not None}
    assert parents == {(1, 1): 0, (1, 2): 1, (1, 4): 2, (1, 5): 3, (4, 1): 0, **{(5, 1_600_000_000_000 + i): 1_600_000_000_000 + i - 1 for i in (1, 2, 3)},
                       (6, -3): -(2 ** 63), (6, 2): -3, (6, 2 ** 63 - 1): 2}
    assert [by[1, t].text for t in range(6)] == ["Hello there.\nHow are you?", "Fine, thanks.", "Good.\nEnd.",
                                                 "Unrelated.", "Deep.", "Both"]
    assert [by[1, t].depth for t in range(6)] == [0, 1, 2, 0, 3, 1]
    assert by[1, 4].reply_path == "/".join(f"{t:020d}" for t in (0, 1, 2, 4))
    order = [r.turn for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.reply_path)]
    assert order == [0, 1, 2, 4, 3, 5]
    paths = {r.reply_path for r in got if r.conv_id == 5}
    assert len(paths) == 4 and max(paths) == "/".join(f"{1_600_000_000_000 + i:020d}" for i in range(4))
    order = [r.turn for r in sorted((r for r in got if r.conv_id == 6), key=lambda r: r.reply_path)]
    assert order == [-(2 ** 63), -3, 2, 2 ** 63 - 1, -2]
    assert (by[1, 2].quoted_lines, by[1, 2].linked_lines) == (3, 2)
    assert by[2, 0].parent_turn is None and by[2, 0].quoted_lines == 1
    assert by[2, 1].text == by[2, 2].text == "" and by[None, 3].parent_turn is None
    assert sum(r.conv_id == 4 and r.turn == 0 for r in got) == 2


def test_long_reply_chain(spark):
    rows = [(1, i, "u", (f"> line {i - 1}\n" if i else "") + f"line {i}", None, None) for i in range(70)]
    got = {r.turn: r for r in quote_threads.threads(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].depth == i for i in range(70))
    assert got[69].reply_path == "/".join(f"{t:020d}" for t in range(70))


def test_sql_twin_on_quotes_and_table(spark, tmp_dir):
    plain = spark.createDataFrame([r[:4] for r in ROWS], "conv_id long, turn long, role string, text string")
    plain.coalesce(1).write.parquet(f"{tmp_dir}/c")
    con = oh.duck(MIDDLE)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_dir}/c/*.parquet')")
    res = oh.compare(spark, con, "t", lambda s, d: quote_threads.threads(plain), quote_threads.THREADS_SQL, "")
    assert res["status"] == "match", res
    res = oh.compare(spark, oh.duck(MIDDLE), "t", lambda s, d: quote_threads.threads(table(s, "conversations", d)),
                     quote_threads.THREADS_SQL, MIDDLE)
    assert res["status"] == "match", res


def test_no_rows_and_no_python(spark):
    assert quote_threads.threads(spark.createDataFrame([], SCHEMA)).collect() == []
    plan = quote_threads.threads(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan
