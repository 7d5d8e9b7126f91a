import random

import pytest

from saletrace.llm.common import ship

#: names that operators use inside, as extra columns of the input
CLASHES = ("id", "row", "fp", "s", "stratum", "kept", "spans", "ids", "x", "u", "h", "number",
           "removed", "root", "component_id", "item_id", "_cut", "digest", "n", "start")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """``rows``: (doc_id, text) or (doc_id, text, lang) tuples."""
    def build(rows, clash=False):
        extra = CLASHES if clash else ()
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        schema += "".join(f", `{c}` string" for c in extra)
        data = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""))
                + tuple("clash" for _ in extra) for r in rows]
        return spark.createDataFrame(data, schema)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(400)]
    long = " ".join(r.choices(words, k=60_000))
    return [(None, None), (None, "a row without an id"), (1, None), (2, ""), (3, " \n\t "),
            (4, "one two"), (4, "one two"), (5, "x" * 300_000), (6, long), (7, long),
            (8, "ñandú 日本語 😀   naïve"), (9, "one two"), (-3, "negative id here"),
            (10, "same line of text\n" * 40)]


@pytest.fixture(scope="session")
def prose():
    """A maker of random prose from a fixed vocabulary."""
    r = random.Random(9)
    words = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 8))) for _ in range(3000)]
    return lambda n, seed: " ".join(random.Random(seed).choices(words, k=n))
