"""Tables with everything that is odd, for all operators."""

import random

import pytest

WORDS = "the of and to in river stone light over under green walk quiet house paper seven cloud mint orbit lamp".split()


def prose(seed, count, upper=False):
    r = random.Random(seed)
    words = [r.choice(WORDS) + (str(r.randrange(1, 30)) if r.random() < 0.3 else "") for _ in range(count)]
    words = [w + "." if r.random() < 0.12 else w for w in words]
    text = " ".join(words)
    return text.upper() if upper else text


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, blanks, one very long text, repeated rows, and
    columns named like those that operators add."""
    long = prose(1, 60_000)
    rows = [
        (1, "alpha beta gamma delta epsilon zeta. Mail a.b@c.org or +1 (724) 555-7058!", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \t\n\x0b ", "en", None),
        (5, "one two", "fr", "b"),
        (6, "ONE  two", "fr", "b"),
        (7, long, "en", "a"),
        (7, long, "en", "a"),
        (None, "one two", "en", "b"),
        (None, None, None, None),
        (8, "x" * 300_000, "en", "b"),
        (9, "ünï çödé 4539 1488 0343 6467 10.0.0.1 <|endoftext|> 😀", "de", "c"),
    ]
    rows = [(*row, 1, 2.0, "x", [1], 5, "k") for row in rows]
    schema = (
        "doc_id bigint, text string, lang string, source string, n int, score double, token string, "
        "copies array<int>, size int, label string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
