"""Reply order of generated threads against a plain reading of them, and of one very long reply."""

import random
import re
import time

from voltlake.llm import quotation

SENTENCES = [f"{a} {b}" for a in ("boats", "wind", "the rain", "a storm") for b in ("comes", "goes", "waits late", "turns")]


def squeezed(text):
    return re.sub(r"\s+", " ", text).strip(" ").lower()


def units(text):
    return [text, *re.split(r"\n\s*\n", text), *text.split("\n")]


def taken_apart(said):
    """The body, and the (level, unit) of the quotes of one message, line by line."""
    lines = []
    for raw in said.split("\n"):
        marks = re.match(quotation.QUOTE, raw)
        lines.append((marks[0].count(">") if marks else 0, re.sub(quotation.QUOTE, "", raw).strip(" "), raw))
    kept = []
    for k, (level, content, raw) in enumerate(lines):
        below = [one for one in lines[k + 1 :] if squeezed(one[1])][:1] + lines[k + 1 : k + 2]
        announces = re.search(quotation.ATTRIBUTION, content) and max([one[0] for one in below], default=0) > level
        if not announces:
            kept.append((level, content, raw))
    blocks = []
    for level, content, _ in kept:
        if blocks and blocks[-1][0] == level:
            blocks[-1][1].append(content)
        else:
            blocks.append((level, [content]))
    quotes = {(level, squeezed(u)) for level, block in blocks if level for u in units("\n".join(block)) if squeezed(u)}
    return re.sub(r"^\s+|\s+$", "", "\n".join(raw for level, _, raw in kept if not level)), quotes


def plainly(rows):
    parts = {row: taken_apart(row[3]) if re.search(quotation.HAS_QUOTE, row[3]) else (row[3], set()) for row in set(rows)}
    found = {}
    for row, (body, quotes) in parts.items():
        conv, turn, role, _ = row
        earlier = {(t, squeezed(u)) for (c, t, *_), (b, _) in parts.items() if c == conv and t < turn for u in units(b)}
        source = {q: max((t for t, u in earlier if u == q[1]), default=None) for q in quotes}
        votes = {}
        for (level, unit), told in source.items():
            if level == 1 and told is not None:
                votes[told] = votes.get(told, 0) + len(unit)
        before = max((t for c, t, *_ in parts if c == conv and t < turn), default=None)
        parent = max(votes, key=lambda t: (votes[t], t)) if votes else before
        linked = sum(told is not None for told in source.values())
        found[row] = (parent, len(quotes), linked, body, rows.count(row))
    return found


def threads(seed):
    chance = random.Random(seed)
    rows = []
    for conv in range(6):
        texts = []
        for turn in sorted(chance.sample(range(0, 5000, 7), 8)):
            text = "\n".join(chance.choice(SENTENCES) + chance.choice(["", "\n"]) for _ in range(chance.randint(0, 4)))
            for _ in range(chance.randint(0, 2) if texts else 0):
                told = chance.choice(texts).split("\n")
                told = told[chance.randrange(len(told)) :] if chance.random() < 0.5 else told
                announced = chance.choice(["", "On Monday a wrote:\n", "On Monday a wrote:\n\n", "am Montag schrieb b:\n"])
                quote = "\n".join(chance.choice(["> ", ">", " > "]) + line for line in told)
                text = announced + quote + chance.choice(["\n", "\n\n"]) + text
            texts.append(text)
            rows.append((conv, turn, chance.choice("ab"), text))
            if chance.random() < 0.2:
                rows.append(rows[-1])
            if chance.random() < 0.2:
                rows.append((conv, turn, "z", chance.choice(texts)))
    return rows


def test_threads(spark):
    rows = threads(1) + [(c + 10, *rest) for c, *rest in threads(2)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = quotation.reply_order(frame).collect()
    expected = sorted((k[:3], v) for k, v in plainly(rows).items())
    assert sorted(((r.conv_id, r.turn, r.role), (r.parent_turn, r.quotes, r.linked, r.body, r.copies)) for r in found) == expected
    assert sum(r.linked for r in found) > 100


def test_a_line_that_every_turn_says_and_quotes(spark):
    rows = [(1, k, "a", f"> ok\nok\n\nturn {k}") for k in range(0, 6000, 3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.turn: r for r in quotation.reply_order(frame).collect()}
    assert all(found[k].parent_turn == k - 3 and found[k].linked == 1 for k in range(3, 6000, 3))
    assert found[0].parent_turn is None and found[0].linked == 0


def test_a_reply_that_quotes_a_very_long_message(spark):
    def spent(lines):
        text = "\n".join(f"line {k} of a long message, as long as lines are in mail" for k in range(lines))
        quoted = "\n".join(f"> {line}" for line in text.split("\n"))
        rows = [(1, 0, "a", text), (1, 1, "b", "no"), (1, 2, "c", f"{quoted}\nyes")]
        start = time.monotonic()
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        found = {r.turn: r for r in quotation.reply_order(frame).collect()}
        assert (found[2].parent_turn, found[2].body, found[2].linked) == (0, "yes", lines + 1)
        return time.monotonic() - start

    spent(10)
    short, long = spent(10), spent(40_000)  # 2 MB
    assert long < 5 * short + 5, (short, long)
