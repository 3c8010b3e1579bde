import pytest

SCHEMA = "doc_id long, text string, lang string, source string, score string, size int, _key int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()
PROSE = " ".join(WORDS[i % 15] + str(i % 7) for i in range(60))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use too."""

    def build(pairs):
        rows = [
            (i, t, None if n % 3 else "en", None if n % 4 else f"s{n % 3}", "x", None, n)
            for n, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text): NULLs, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i * i % 9973}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (None, None), (None, PROSE), (7, PROSE), (5, PROSE),
        (5, PROSE), (8, PROSE.replace(" ", " \n ")), (9, PROSE + " omega"), (10, long),
        (11, long + " end"), (12, "été ça ñ ü 中文 " * 30), (13, "one two"), (14, "ONE two"),
        (15, "a" * 5000), (16, "a" * 5000 + "b"), (17, "\x00\x01 \x85\xa0 x"), (5, "other text here now"),
        (18, PROSE[:150] + " filler " + PROSE[:150]),
    ]
