"""Benchmark decontamination and quotation links."""

from tests_llm_data import prose
from voltlake.llm import decontamination, quotation

QUESTION = "A farmer has 12 sheep and Tom buys 5 km of fence for the 12 sheep near the river"


def found(spark, docs, items):
    return {
        (r.doc_id, r.item_id): r
        for r in decontamination.contaminated(
            spark.createDataFrame(docs, "doc_id long, text string, item_id int, window string"),
            spark.createDataFrame(items, "item_id long, text string"),
        ).collect()
    }


def test_contaminated(spark):
    passage = prose(3, 40)
    other = QUESTION.replace("12", "40").replace("Tom", "Ann").replace("5 km", "9 miles")
    torn = QUESTION.replace("12", "40", 1)  # the two 12 now differ
    docs = [
        (1, f"Intro words here. {QUESTION} more words", 0, ""),
        (2, f"Intro. {other}. The end", 0, ""),
        (3, f"Intro. {torn}. The end", 0, ""),
        (4, f"{prose(5, 30)}\n{passage}\n{prose(6, 30)}", 0, ""),
        (4, f"{prose(5, 30)}\n{passage}\n{prose(6, 30)}", 0, ""),
        (5, " ".join(passage.split()[:15]), 0, ""),  # less than half
        (6, None, 0, ""), (7, "", 0, ""), (None, passage, 0, ""), (8, prose(7, 3000), 0, ""),
        (9, "tiny item", 0, ""),
    ]
    items = [(10, QUESTION), (11, passage), (12, None), (13, ""), (14, "Tiny item"), (15, "1 2 3 4 5 6 7 8 9 10"), (None, passage)]
    matches = found(spark, docs, items)
    assert set(matches) == {(1, 10), (2, 10), (4, 11), (9, 14)}
    assert matches[1, 10].verbatim and not matches[2, 10].verbatim
    assert matches[2, 10].slots == 5 - 1  # 12 stands twice
    assert matches[4, 11].matched == matches[4, 11].windows == 40 - decontamination.WINDOW + 1


def test_contaminated_by_nothing(spark):
    assert found(spark, [(1, QUESTION, 0, "")], []) == {}
    assert found(spark, [], [(1, QUESTION)]) == {}


def test_a_passage_in_very_many_documents(spark):
    passage = prose(3, 30)
    docs = [(k, f"{prose(k, 5)}. {passage}", 0, "") for k in range(400)]
    assert len(found(spark, docs, [(1, passage), (2, passage)])) == 800


MESSAGES = [
    (1, 0, "a", "Hello there.\nShall we meet at noon?"),
    (1, 1, "b", "> Shall we  MEET at noon?\nYes"),
    (1, 2, "c", "> Hello there.\n> Shall we meet at noon?\nNo, at one"),
    (1, 3, "a", "On Monday b wrote:\n> > Shall we meet at noon?\n> Yes\n\nGood"),
    (1, 4, "b", None),
    (1, 4, "b", None),
    (1, 5, "c", "> never said\nok"),
    (2, 0, "a", "x"),
    (2, 7, "a", "> Hello there.\nanother conversation"),
    (None, 1, "z", "> q\nz"),
    (3, None, "z", "no turn"),
    (4, 1, "u", "tie"), (4, 1, "v", "tie"), (4, 2, "w", "> tie\nboth"), (4, 2002, "w", "late"),
]


def ordered(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 AS body", "2 AS quotes", "3 AS said")
    return [tuple(r) for r in quotation.reply_order(frame).collect()]


def test_reply_order(spark):
    found = {r[:3]: r[3:] for r in ordered(spark, MESSAGES)}
    assert found == {
        (1, 0, "a"): (None, 0, 0, 0, "Hello there.\nShall we meet at noon?", 1),
        (1, 1, "b"): (0, 0, 1, 1, "Yes", 1),
        (1, 2, "c"): (0, 2, 3, 3, "No, at one", 1),
        (1, 3, "a"): (1, 0, 2, 2, "Good", 1),
        (1, 4, "b"): (3, 0, 0, 0, "", 2),
        (1, 5, "c"): (4, 0, 1, 0, "ok", 1),
        (2, 0, "a"): (None, 0, 0, 0, "x", 1),
        (2, 7, "a"): (0, 0, 1, 0, "another conversation", 1),
        (None, 1, "z"): (None, None, 1, 0, "z", 1),
        (3, None, "z"): (None, None, 0, 0, "no turn", 1),
        (4, 1, "u"): (None, 1, 0, 0, "tie", 1),
        (4, 1, "v"): (None, 1, 0, 0, "tie", 1),
        (4, 2, "w"): (1, 1, 1, 1, "both", 1),
        (4, 2002, "w"): (2, 1, 0, 0, "late", 1),
    }


def test_a_long_line_of_replies(spark):
    rows = [(1, 0, "a", "line 0")] + [(1, k, "ab"[k % 2], f"> line {k - 1}\nline {k}") for k in range(1, 60)]
    rows.append((1, 60, "z", "> line 10\nback to ten"))
    found = {r[1]: r for r in ordered(spark, rows)}
    assert all(found[k][3:5] == (k - 1, 0) for k in range(1, 60))
    assert found[60][3:5] == (10, 60)


def test_reply_order_of_nothing_and_of_long_texts(spark):
    assert ordered(spark, []) == []
    long = "\n".join(f"line {k}" for k in range(20_000))
    (first, second) = sorted(ordered(spark, [(1, 0, "a", long), (1, 1, "b", f"> line 77\n{long}")]))
    assert first[7] == second[7] == long and second[3] == 0


def test_reply_order_runs_no_python(spark):
    frame = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    plan = quotation.reply_order(frame)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
