import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, size string, kept string, score string, ids string, print string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(n))


def nasty_rows(seed=1, n=60):
    """Documents with nulls in every column, empty, blank, long, tied and repeated ones, and columns with clashing names."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 160)) for _ in range(n)]
    base = prose(rng, 120).split()
    for i in range(25):  # near copies of one text
        copy = list(base)
        for _ in range(i % 5):
            copy[rng.randrange(len(copy))] = "changed" + str(i)
        texts.append(" ".join(copy))
    texts += [texts[0]] * 6 + [texts[1].replace(" ", "\n\t "), texts[1].upper(), " " + texts[2]]
    texts += [None, None, "", "   ", "\t\n", "123 456", "...", "word", "two words", "spam " * 300, "a b c d e " * 60, "x" * 5000, prose(rng, 6000), "é ñ ü <|endoftext|> 's   \x1c ok", "日本語 テキスト"]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), len(t or ""), "r", "i", "s", "k", "c", "d", "p") for i, t in enumerate(texts)]
    rows.append((None, texts[3], None, None, None, None, None, None, None, None, None, None))
    rows.append((None, "no id at all", *[None] * 10))
    rows += [rows[5], rows[5], (7, "another text under the same id", *rows[7][2:])]
    return rows


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(nasty_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
