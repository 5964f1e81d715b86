"""Small tables of own making for the training-data operators."""

import random

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
STEMS = ["ka", "lo", "mi", "ru", "ten", "vor", "sul", "pra", "esh", "und", "ol", "bri"]


def word(rng):
    return "".join(rng.choice(STEMS) for _ in range(rng.randint(1, 3)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def doc(i, text, source="s1", lang="xx"):
    return (i, text, lang, source, None if text is None else len(text))


def odd_documents(seed=1):
    """Nulls in every column, empty and blank texts, one very long text, repeated rows, ids and texts."""
    rng = random.Random(seed)
    long_text = prose(rng, 30_000)
    rows = [doc(i, prose(rng, rng.randint(5, 60)), rng.choice(["a", "b", "Ä", None])) for i in range(40)]
    rows += [doc(100, None), doc(101, ""), doc(102, " \t\n"), doc(103, long_text), doc(None, prose(rng, 9)), doc(None, None, None, None),
             doc(7, rows[7][1]), rows[8], rows[8], doc(104, rows[9][1]), doc(105, "ÄÖ \U0001f600 café ẞ x"), doc(106, "solo")]
    return rows


def frame(spark, rows, ddl=DOC_DDL):
    return spark.createDataFrame(rows, ddl)
