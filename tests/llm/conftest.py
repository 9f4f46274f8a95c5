import pytest

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest int, bucket string, "
          "rank int, slot int, part int, kind int, n int, token string, score int, rules int, low int, "
          "words int, seed int, comp int, rep int, place int, url int, template int")


def passage(n, tag="w"):
    return " ".join(f"{tag}{(i * i * 7 + i) % 9973}" for i in range(n))


def rows():
    """Documents with nulls, empty and very long texts, copies, near copies,
    repeated rows and null ids; the extra columns carry clashing names."""
    base = passage(80)
    words = base.split()
    near = " ".join(words[:40] + ["changed"] + words[41:])
    out = [(1, base, "en", "a"), (2, base, "en", "a"), (3, near, "de", None), (4, None, None, "b"),
           (5, "", "en", "b"), (6, "  \t\n ", "en", "b"), (7, "two words", "en", "a"),
           (8, "TWO words", "en", "a"), (9, passage(20_000, "l"), "fr", "a"), (None, "no id", "en", "c"),
           (None, base, None, None), (10, "é漢\U0001f600 token = 'abcdef123'", "en", "a"),
           (10, "é漢\U0001f600 token = 'abcdef123'", "en", "a"),
           (11, passage(30, "x") + " " + passage(60, "z"), "en", "a"),
           (12, passage(60, "z") + " " + passage(30, "y"), "en", "d")]
    return [(i, t, la, s, None if t is None else len(t)) + (7,) + ("q",) + (1,) * 5 + ("t",) + (1,) * 10
            for i, t, la, s in out]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 1), (7, 0, 0), (None, 1, 1), (9, None, None)],
                                 "doc_id long, quality int, toxic int")
