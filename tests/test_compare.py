from docloom.operators import compare

SCHEMA = "question_id long, model string, question string, answer string"
EXPECTED = {(1, "q1", "r1", "t1", "none"), (2, "q2", "r2", None, "tuned"), (3, "q3", None, "t3", "base")}


def answers(spark):
    rows = [
        (1, "reference", "q1", "r1"), (1, "tuned", "q1", "t1"), (2, "reference", "q2", "r2"),
        (3, "tuned", "q3", "t3"), (9, "third", "q9", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_side_by_side(spark):
    assert {tuple(r) for r in compare.side_by_side(answers(spark)).collect()} == EXPECTED


def test_join_answers(spark):
    table = answers(spark)
    joined = compare.join_answers(table.where("model = 'reference'"), table.where("model = 'tuned'"))
    assert {tuple(r) for r in joined.collect()} == EXPECTED
