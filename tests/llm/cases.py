"""Small frames with the awkward rows that every operator has to define."""

import random

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rule string, score double, shard int, size long"


def awkward(spark, rows=None):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and
    extra columns whose names clash with those that operators use."""
    texts = [(0, "The cat sat on the mat today"), (1, None), (2, ""), (3, "   \t\n "), (4, LONG),
             (5, "the CAT sat on the mat today"), (5, "the CAT sat on the mat today"), (6, "é\u00a0ü don't  stop ### now.\nNew\n\nline "),
             (7, "one two"), (8, "ONE two"), (None, "lost id and some words to go"), (9, LONG + " end"), (12, "日本語 テキスト <|endoftext|> # 2")]
    sources = ["b", "a", None, "b", "a", "c", "c", "é", "b", None, "a", "a", "z"]
    out = [(i, t, None if k % 3 == 0 else "en", s, None, None if k % 2 else "x", 0.5, 7, None)
           for k, ((i, t), s) in enumerate(zip(texts, sources))]
    return spark.createDataFrame(out if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, words):
    rng = random.Random(seed)
    syllables = ["an", "re", "th", "or", "in", "es", "ti", "ou", "ble", "sh", "ed", "wh"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))
