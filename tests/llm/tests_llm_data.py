"""Small documents with every oddity the operators have to define a result for."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " run int, digest string, n_tokens string, part string, label string, role string, score string"
)
LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(20_000)) + "z" * 6_000


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("th", "an", "er", "ou", "st", "qu") for b in ("a", "e", "ing", "ed", "ly", "on", "ux")]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


TEXTS = [
    (1, prose(1, 60)),
    (2, prose(1, 60)),  # a copy
    (3, prose(1, 60).replace("ing", "ING")),  # equal but for case
    (4, prose(1, 58) + " one two"),  # a near copy
    (5, None),
    (6, ""),
    (7, "   \t\n "),
    (8, "Three short words"),
    (8, "Three short words"),  # a repeated row
    (9, LONG),
    (10, "Ünïcödé 日本語 🙂🙂 it's we'll  two  blanks\r\n\ttab <|endoftext|> end"),
    (11, prose(11, 200)),
    (None, prose(11, 200)),  # no id, equal text
    (12, "!!!??? 123 456"),
]
