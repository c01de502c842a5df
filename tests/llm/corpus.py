"""Small corpora with every odd row the corpus operators must cope with."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, words):
    """Invented words, the same for the same seed."""
    rng = random.Random(seed)
    syllables = ["ba", "do", "fe", "gi", "lu", "mo", "na", "pe", "ri", "su", "ta", "ve"]
    return [
        "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)
    ]


def text(seed, words):
    return " ".join(prose(seed, words))


def edited(seed, words, change, places):
    """A text of which some words are others."""
    out = prose(seed, words)
    rng = random.Random(change)
    for i in rng.sample(range(words), places):
        out[i] = f"x{change}y{i}"
    return " ".join(out)


def documents(spark, rows, schema=SCHEMA):
    """Rows of an id and a text, or of all columns; over a few partitions."""
    rows = [r if len(r) > 2 else (*r, "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(rows, schema).repartition(3)


ODD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \t\n ", "en", None, 4),
    (4, text(4, 3), "en", "s", None),
    (5, text(5, 60), "en", "s", 1),
    (5, text(5, 60), "en", "s", 1),
    (6, text(5, 60).replace(" ", "\n\n"), "de", "t", 1),
    (None, text(5, 60), "en", "t", 1),
    (None, text(7, 50), None, "s", 1),
    (8, text(8, 30_000), "en", "t", 1),
    (-9, text(5, 60), "en", "s", 1),
]


def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash in name."""
    extra = "label string, score int, kept int, hash string, node string, text_sha256 string"
    rows = [(*r, "l", 1, 2, "h", "n", "z") for r in ODD]
    return documents(spark, rows, f"{SCHEMA}, {extra}")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
