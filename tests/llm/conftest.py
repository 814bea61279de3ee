import pytest

from prefmill.llm.util import shared_dir

#: Texts for the edge cases: nulls, empty, white space only, long, copies, odd characters.
TEXTS = [
    (1, "The quick brown fox, it's over  there."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c "),
    (5, "word " * 4000),
    (6, "The quick brown fox, it's over  there."),
    (6, "The quick brown fox, it's over  there."),
    (7, "日本語 テスト ́ İstanbul ΑΣ \x1c x <|endoftext|> y\n \n z   "),
    (8, "#*$%&|<> a\na\nb\na\n\n"),
    (None, "no id"),
    (9, "x" * 70_000),
]


@pytest.fixture(scope="session")
def docs(spark):
    shared_dir(spark)
    rows = [(i, t, "en" if i and i % 2 else None, "s", None, "extra") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    shared_dir(spark)
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))
