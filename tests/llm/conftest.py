"""Small documents with the cases every operator must stand: nulls, empty and long texts, ties, repeats, clashing names."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, slot int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = " ".join(f"word{i % 997} and then, some{i % 89}." for i in range(9000))
    run = "abcdefghij" * 5000
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog, and so on it goes.\nSecond line of it all, with eight words here."),
        (2, "The quick brown fox jumps over the lazy dog, and so on it goes.\nSecond line of it all, with eight words here."),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, long),
        (7, run),
        (8, "one"),
        (9, "one"),
        (10, f"before it\n{passage}\nafter it"),
        (11, f"other words stand here\n{passage}\nand there"),
        (12, "Édition spéciale <|endoftext|> it's   spaced\n\nout\tand ÉDITION"),
        (12, "Édition spéciale <|endoftext|> it's   spaced\n\nout\tand ÉDITION"),
        (12, "another text of a repeated id"),
        (None, "a row without an id"),
        (None, None),
        (13, long.replace("word5 ", "edited5 ")),
        (14, "漢字" * 40_000),
        (15, "same line of several words repeats here\n" * 30),
    ]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 0.5, 3) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
