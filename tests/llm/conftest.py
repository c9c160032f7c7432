"""Rows that every operator of the package has to take."""

import pytest


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: empty, blank, one word, odd white space, accents, symbols, a long one, copies."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    prose = "the cat sat on the mat and looked at the dog that slept by the warm stove all day long".split()
    return [
        None, "", " \n\t ", "one", "One two", "  lead and trail  ", "tab\tfeed\x0bform\x0c\rend", "é è ü ñ ça",
        "— … 中文 字", " non breaking", "a a a a a a a a", "it's 'll a's\n\nnew  line",
        "<|endoftext|> </s>[INST] ok [/INST]", " ".join(prose * 7), " ".join(prose * 7), "x " + " ".join(prose * 5), long,
        long + " tail", "\U0001f600 smile", "same", "same", "a" * 5000,
    ]


@pytest.fixture(scope="session")
def awkward(spark, texts):
    """One row per awkward text, with nulls in every column, a repeated row and an extra column."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, len(t or ""), i) for i, t in enumerate(texts)]
    rows += [rows[-3], (None, "no id here at all", "de", "src1", 5, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra int").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
