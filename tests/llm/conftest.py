import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, _row int, bits string, n int"


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows."""
    draw = random.Random(5)
    words = "the of and thion ering under café überall niño idiot clown ### 10".split()

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))

    passage, long = text(120), text(9000)
    texts = [None, "", " \n\t", "word", "two words", passage, passage, f"{text(9)} {passage} {text(5)}", long, long + " end"]
    texts += ["round and " * 300, "É" * 500, "x" * 1000, "Tie one two", "Tie one two", "line\nline\nother\nline"]
    texts += [text(draw.randint(1, 60)) for _ in range(20)]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", "é", None][i % 4], None, "x", i, "y", 1) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "no id", None, None, None, None, None, None, None)] + [(None,) * 9] * 2


@pytest.fixture
def odd(spark, odd_rows):
    """Rows as a table whose extra columns have names that the operators use themselves."""
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
