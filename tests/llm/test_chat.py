import json

import pytest

from acadlake.llm import chat
from tools.oracle_check import compare, duck_con

HARD = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[\\INST]", "<<SYS>><</SYS>>", "a\nb", "", "\\", "<", "<\\", "é\U0001f600", "[", "</s"]


def back(spark, records):
    df = spark.createDataFrame([(r,) for r in records], "record string")
    return chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()


def test_hard_texts_round_trip(spark):
    turns = [{"role": r, "content": t + u} for t in HARD for u in HARD[:9] for r in ("user", "assistant")]
    turns += [{"role": r, "content": "x"} for r in HARD]
    row, = back(spark, [json.dumps({"conv_id": 1, "messages": turns})])
    assert row.roles == [t["role"] for t in turns]
    assert row.texts == [t["content"] for t in turns]
    assert row.loss_text == "".join(t["content"] for t in turns if t["role"] == "assistant")
    assert row.formatted.count("<s>") == row.formatted.count("</s>") == len(turns)
    for span in row.loss_spans:
        assert row.formatted[span.start - 1] == "\n" and row.formatted[span.end:span.end + 4] == "</s>"


@pytest.mark.parametrize("record,turns", [
    ({"conv_id": 3, "prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"conv_id": 3, "completion": "r", "prompt": None}, [("user", ""), ("assistant", "r")]),
    ({"conv_id": 3, "instruction": "i", "input": "n", "output": "o"}, [("user", "i\nn"), ("assistant", "o")]),
    ({"conv_id": 3, "instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"conv_id": 3, "instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"conv_id": 3, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
     [("user", "h"), ("assistant", "g")]),
    ({"conv_id": 3, "messages": [{"content": "c", "role": "system"}]}, [("system", "c")]),
    ({"conv_id": 3, "messages": []}, []),
    ({"conv_id": None, "messages": None}, []),
])
def test_layouts(spark, record, turns):
    row, = back(spark, [json.dumps(record)])
    assert list(zip(row.roles, row.texts)) == turns and row.conv_id == record["conv_id"] and row.n_turns == len(turns)


def test_unknown_records_are_reported(spark):
    df = spark.createDataFrame([('{"a":1}',), ("broken",), (None,), ('{"conv_id":1,"messages":[]}',)], "record string")
    assert chat.unmapped(df).count() == 3 and chat.canonical_turns(df).count() == 1


def test_strict_jobs_fail_on_unknown_records(spark):
    df = spark.createDataFrame([('{"conv_id":1,"messages":[]}',), ('{"a":1}',)], "record string")
    with pytest.raises(Exception, match="no mapping for record"):
        chat.canonical_turns(df, strict=True).count()
    assert chat.canonical_turns(df.limit(1), strict=True).count() == 1
    with pytest.raises(ValueError, match="no mapping"):
        chat.table_turns(spark.createDataFrame([(1, "x")], "conv_id long, body string"))


def test_very_long_turns_stay(spark, folder):
    long = "abcdefghi " * 2_100_000                            # more than Spark's JSON parser takes
    got = {r.conv_id: r for r in chat.op10_chat_formatting(
        spark, folder(conversations=[(1, 0, "user", "hello"), (1, 1, "assistant", long)])).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (2, len(long)) and len(got) == 2


def test_rows_nulls_ties_and_repeats(spark, folder):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, None, "last"), (2, 0, "user", "same"),
            (2, 0, "user", "same"), (None, 0, "assistant", "x" * 200_000)]
    sf = folder(conversations=rows)
    assert compare("op10", chat.op10_chat_formatting(spark, sf), chat.ORACLE.replace(
        "FROM conversations", f"FROM read_parquet('{sf}/conversations.parquet/*.parquet')"), __import__("duckdb").connect())


def test_query_against_sql_and_native(spark, small, folder):
    df = chat.op10_chat_formatting(spark, small)
    assert compare("op10", df, chat.ORACLE, duck_con(small))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert [r.conv_id for r in chat.op10_chat_formatting(spark, folder()).collect()] == [-7]
