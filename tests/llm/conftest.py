import pytest

WORDS = "alpha beta gamma delta the of and to house river stone light der und le la".split()


def sentence(seed: int, n: int) -> str:
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + str((state >> 16) % 50))
    return " ".join(out)


def awkward_rows():
    """Nulls, empty and blank texts, very long texts, repeated rows, ties, shared ids, copies and near copies."""
    base = sentence(1, 300)
    near = base.split()
    near[150] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(near), "en", "b", 2), (4, None, None, None, None),
        (5, "", "en", "", 0), (6, " \t\n", None, "b", 3), (7, "word", "en", "b", 4), (8, "Word", "de", "é", 4),
        (9, "the of and to", "en", "z", 1), (9, "the of and to", "en", "z", 1), (10, sentence(2, 90), "fr", None, 5),
        (10, sentence(3, 90), "fr", None, 5), (None, sentence(4, 50), "de", "a", 5), (11, sentence(5, 20_000), "de", "a", 5),
        (12, "x" * 300_000, "de", "a", 5), (13, base.replace(" ", "\n\t"), "en", "a", 1), (14, "a b \x1c <|endoftext|> İ", "en", "a", 1),
    ]
    rows += [(100 + k, sentence(1000 + k, 40 + k) + " " + sentence(77, 60), "en", f"s{k % 5}", k) for k in range(40)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents over several partitions, with extra columns whose names clash with working columns."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(awkward_rows(), SCHEMA)
    extra = {name: F.lit("x") for name in ("size", "digest", "set", "id", "rank", "share", "group", "_text", "places")}
    return frame.withColumns(extra).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()
