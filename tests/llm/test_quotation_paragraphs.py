"""Quotes of some paragraphs, wrapped anew, below an announcement and a blank line."""

from voltlake.llm import quotation

FIRST = "The harbour is closed\nuntil the storm is over."
SECOND = "Boats may wait\nat the northern pier."
ROWS = [
    (1, 0, "a", f"{FIRST}\n\n{SECOND}\n\nThe third paragraph."),
    (1, 1, "b", "Something else"),
    (1, 2, "c", "On Monday a wrote:\n\n> The harbour is closed until\n> the storm is over.\n>\n> Boats may wait at\n> the northern pier.\n\nThanks"),
    (1, 3, "d", "> On Monday a wrote:\n>\n> > Boats may wait at\n> > the northern pier.\n> Thanks\nOn Sunday we wrote:\nFine"),
]


def test_quoted_paragraphs_are_linked(spark):
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    found = {r.turn: r for r in quotation.reply_order(frame).collect()}
    assert (found[2].parent_turn, found[2].branch, found[2].linked) == (0, 2, 2)
    assert found[2].quotes == 1 + 2 + 4  # the passage, its paragraphs, their lines
    assert found[2].body == "Thanks"
    assert (found[3].parent_turn, found[3].linked) == (2, 2)  # a paragraph of 0 and what 2 says
    assert found[3].quotes == 4 and found[3].body == "On Sunday we wrote:\nFine"
