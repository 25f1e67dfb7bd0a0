"""Small tables for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = ["alpha", "beta", "gamma", "delta", "Straße", "été", "The", "of", "and", "12", "x-y", "naïve", "日本", "end."]


def documents(seed=0, n=40, words=(0, 60)):
    """Random texts with copies, near copies, shared lines and passages; ids are not in order."""
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(VOCAB) + str(rng.randrange(30)) for _ in range(k))
    passage, line = say(25), "  A line that MANY documents share "
    texts = []
    for i in range(n):
        t = say(rng.randint(*words))
        if i % 5 == 0:
            t = t + "\n" + line.upper() if i % 2 else line + "\n" + t
        if i % 7 == 0:
            t = t + " " + passage + "\n\n" + say(5)
        if i % 6 == 0 and texts:
            t = rng.choice(texts)
        elif i % 4 == 0 and texts:
            ws = rng.choice(texts).split(" ")
            ws[rng.randrange(len(ws))] = "changed"
            t = " ".join(ws)
        texts.append(t)
    ids = list(range(n))
    rng.shuffle(ids)
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "b", None]), len(t)) for i, t in zip(ids, texts)]


EDGES = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r", "xx", "b", 6), (None, "a null id", "en", "a", 9),
    (4, "Same text of two rows\nwith a second line of some length\n" * 2, "en", "a", 1),
    (4, "Same text of two rows\nwith a second line of some length\n" * 2, "en", "a", 1),
    (5, "word", "en", "c", 4), (6, "two words", "en", "c", 9), (7, "9" * 3000 + " " + "a" * 3000 + "  \x1c\x85x", "de", "c", 1),
    (8, "long line of words " * 3000, "en", "c", 1), (None, None, None, None, None),
]


def table(spark, rows, extra=()):
    """Documents, with extra columns of the given names, which clash with columns of the operators."""
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    for c in extra:
        df = df.withColumn(c, F.lit("mine"))
    return df
