import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _wf_row string, "
    "_doc string, spans string, length string, ids string"
)
ALNUM = "Qw3rT9zX1cV5bN7mK2pL"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, equal rows and columns with awkward names."""
    prose = "The quick brown fox jumps over the lazy dog while seven wizards watch. "
    rows = [
        (1, prose * 2 + "one two three"),
        (2, None),
        (None, "no id here at all"),
        (3, ""),
        (3, ""),
        (4, " \t\n "),
        (5, "word" * 30_000),
        (6, " ".join(f"w{n % 977}x{n}" for n in range(20_000))),
        (7, "naïve Ünïcödé 漢字 😀 text with\x1cbreaks\r\n<|endoftext|> end"),
        (8, f'token = "{ALNUM}" mail a.b@c.de and 10.0.0.256 then 10.0.0.25'),
        (9, f'token = "{ALNUM}" mail a.b@c.de and 10.0.0.256 then 10.0.0.25'),
        (None, None),
        (-4, "a b c"),
    ]
    return spark.createDataFrame(
        [(i, t, None, None if k % 3 else f"s{k}", None, "x", "y", "z", "l", "i")
         for k, (i, t) in enumerate(rows)],
        SCHEMA,
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
