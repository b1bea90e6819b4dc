import random

import pytest

BASE = "The quick brown fox jumps over the lazy dog while seven wizards quietly boil jugs of molten gold near Oslo"


def some_texts() -> list[str | None]:
    """Small texts with every kind of oddity, the same in each run."""
    r = random.Random(5)
    words = BASE.split() + ["É", "naïve", "ſ", "中文", "|", "%%%", "deadbeef" * 4, "AKIA" + "Z9" * 9]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    out = [None, "", " \t\n", "one", BASE, BASE, BASE + " end", BASE.upper(), "a" * 3000, "a b " * 900]
    out += [f"{line(30)}\n{line(4)}\n\n{BASE}\n{BASE}\x0b{line(9)}" for _ in range(12)]
    out += [line(r.randrange(1, 200)) for _ in range(20)]
    out += ["  two  spaces <|endoftext|> and more \r\n", "x" * 200 + "é" * 200]
    return out


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with null and repeated ids and columns whose names clash."""
    texts = some_texts()
    rows = [
        (None if i == 7 else i, t, ["en", "de", None][i % 3], ["s0", None][i % 5 == 0], i, "x", [1])
        for i, t in enumerate(texts)
    ]
    rows += [rows[4], rows[12], (12, "other text of a repeated id", "en", "s0", 1, "y", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_words int, kept string, spans array<int>"
    return spark.createDataFrame(rows, schema).repartition(3)


def pairs(df):
    """(id, text) of all rows."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def as_rows(df, *columns):
    """Rows as a sorted list of tuples of text."""
    return sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
