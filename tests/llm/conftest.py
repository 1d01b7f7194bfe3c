import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Text string, row long, keep_id string, sid long, s1 long, part int, component long, uid long"


@pytest.fixture
def documents(spark):
    """A documents frame from (doc_id, text[, lang, source]) rows; extra columns clash with internal names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "noise", 1, "k", 2, 3, 4, 5, 6) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def messy():
    """Rows with nulls, empty, blank and long texts, ties, copies, repeated rows and odd characters."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [say(40) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10 + i, base[0] + " \n" * i) for i in range(4)]  # equal without white space
    rows += [(20 + i, " ".join([*base[1].split()[: 40 - i], *say(i).split()])) for i in range(8)]  # near copies
    rows += [(30, None), (31, None), (32, ""), (33, " \t\n"), (34, "a"), (35, "A b"), (36, "a B"), (37, "a\x00b <|endoftext|> x")]
    rows += [(40, say(3000)), (41, say(3) + " " + base[2]), (42, "ab " * 300), (43, "  two  spaces  "), (44, "x" * 900)]
    rows += [(2, base[2]), (2, base[2]), (50, "Ünïcode   space"), (None, base[3]), (None, None), (None, "only here")]
    return rows
