import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Further columns with the names that operators use inside.
CLASHES = "row string, score string, copies string, held_out string, kept string, label string, rate string, cdf string, path string, size string, _id string, _key string"

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "A plain text with some words in it. And one more sentence.", "en", "a", 10),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, LONG, "en", "b", 1),
    (5, "A plain text with some words in it. And one more sentence.", "en", "b", 10),
    (5, "A plain text with some words in it. And one more sentence.", "en", "b", 10),
    (None, "No id here, but a text of its own.", None, "b", 3),
    (6, " \t\n\n ", "de", "a", 5),
    (7, "ünïcødé 漢字 😀  tail", "xx", "a", 5),
    (8, "one", "en", "a", 3),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns that clash with inner names."""
    rows = [(*r, *["x"] * (CLASHES.count(",") + 1)) for r in ROWS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHES}")


@pytest.fixture
def none(odd):
    return odd.where("false")


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)
