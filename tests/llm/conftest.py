import random
import re

import pytest

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns
    named like those that operators add."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))

    base, shared = prose(60), prose(60)
    rows = [(i, prose(rng.randint(1, 90)), f"s{i % 3}") for i in range(40)]
    rows += [(100, base, "s0"), (101, base, "s1"), (102, base + " x", "s1"), (103, base.upper(), None)]
    rows += [(110 + i, prose(20) + " " + shared + " " + prose(20), "s0") for i in range(4)]
    rows += [(120, None, "s0"), (121, "", None), (122, " \n\t ", "s2"), (123, "word", "s2"), (124, "word", "s2")]
    rows += [(130, prose(9000), "s1"), (131, "ab" * 4000, "s1"), (132, "z" * 900 + "é" * 300, "s2")]
    rows += [rows[3], rows[3], (None, base, "s0"), (None, None, None), (7, "another text with the same id", "s1")]
    full = [(i, t, None if n % 5 == 0 else "en", s, None if n % 7 == 0 else len(t or ""), n, "id", 1.5)
            for n, (i, t, s) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, bucket string, score double"
    return spark.createDataFrame(full, schema).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None), (3, 1, 0), (999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def words_of():
    return lambda text: re.findall(WORD, text or "")
