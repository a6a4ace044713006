import random

import pytest

# names that the operators use inside
CLASH = ("n_words", "size", "key", "_id", "_tag", "_row", "node", "score", "copies", "ids", "spans", "weight", "start", "all")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def rows(pairs, source="s"):
    return [(i, t, "en", source if isinstance(source, str) or source is None else source(i), len(t or ""), *("x",) * len(CLASH)) for i, t in pairs]


@pytest.fixture
def docs(spark):
    return lambda pairs, source="s": spark.createDataFrame(rows(pairs, source), SCHEMA).repartition(3)


def prose(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{r.choice(['', '', ',', '.'])}" for _ in range(n))


ODD = [
    (None, "no id but some words in this text"), (None, None), (901, None), (902, ""), (903, " \t\n "), (904, "!!! ###"),
    (905, "one"), (906, "Ünï cödé wörds — ½   x"), (907, "same row here"), (907, "same row here"), (907, "same id, other text"),
    (908, "a\n\na\nb\n"), (909, "x" * 5000), (910, prose(5, 30_000)), (911, "\x00\x1f\x85\xa0 z"),
]


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def empty(docs):
    return docs([]).limit(0)
