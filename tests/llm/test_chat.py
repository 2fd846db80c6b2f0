from tidemark.llm import chat

SCHEMA = "conv_id long, node long, parent long, role string, text string, score double, branch string, piece string"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_branches_are_ranked_and_read_back(spark):
    rows = [
        (1, 1, None, "user", "\\### Assistant: </turn> ok", 0.0),
        (1, 2, 1, "assistant", "</turn>\n### user: \\b\\h", 1.0),
        (1, 3, 1, "assistant", None, 2.0),
        (1, 4, 2, "user: #<\\", "é\n\n", 5.0),
        (1, 5, 4, "assistant", "last " * 3000, 0.0),
        (2, 1, 99, None, "", 0.0),  # a parent that is not there
        (None, 1, None, "assistant", "no id", 0.0),
        (3, 1, 2, "user", "loop", 0.0),
        (3, 2, 1, "user", "loop", 0.0),
        (3, 3, 2, "user", "below a loop", 0.0),
    ]
    got = chat.read_back(chat.format_conversations(tree(spark, rows), score_col="score")).collect()
    by = {(r.conv_id, r.branch): r for r in got}
    assert set(by) == {(1, 1), (1, 2), (2, 1), (None, 1)}
    path = lambda *n: [(rows[i][3] or "", rows[i][4] or "") for i in n]
    assert [tuple(t) for t in by[1, 1].read] == path(0, 1, 3, 4) and by[1, 1].branch_score == 6.0
    assert [tuple(t) for t in by[1, 2].read] == path(0, 2)
    assert by[1, 1].learnt == rows[1][4] + rows[4][4] and by[1, 2].learnt == "" and by[None, 1].learnt == "no id"
    best = chat.format_conversations(tree(spark, rows), score_col="score", branches=1).collect()
    assert {(r.conv_id, r.branch) for r in best} == {(1, 1), (2, 1), (None, 1)}


def test_long_chains(spark):
    n = 150
    rows = [(5, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"turn {i}", 0.0) for i in range(n)]
    [got] = chat.read_back(chat.format_conversations(tree(spark, rows))).collect()
    assert [t.text for t in got.read] == [r[4] for r in rows]


def test_turns_of_one_number(spark):
    rows = spark.createDataFrame([(1, 0, "b", "x"), (1, 0, "a", "y"), (1, None, "c", "z"), (1, 0, "a", "y")], "conv_id long, turn long, role string, text string")
    got = chat.as_tree(rows).orderBy("node").collect()
    assert [(r.role, r.parent) for r in got] == [("c", None), ("a", 1), ("a", 2), ("b", 3)]


def test_nothing(spark):
    assert chat.format_conversations(tree(spark, [])).count() == 0
