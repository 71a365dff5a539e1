import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def edge_texts() -> list[str | None]:
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge while rain falls on green hills"
    return [
        None,
        "",
        " \n\t ",
        "one two",
        "One TWO",
        base,
        base,
        base.replace("lazy", "tired"),
        base + " again",
        "### $$$ %%%",
        "a " * 3000,
        "x" * 5000,
        "ñandú corre rápido por el campo. " * 20,
        "line one\nline two\nline one\n\nline one",
        "end <|endoftext|> of text",
    ]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, and extra columns with clashing names."""
    texts = edge_texts()
    rows = [(k, t, "en" if k % 2 else None, ("b", None, "a")[k % 3], 0) for k, t in enumerate(texts)]
    rows += [rows[5], (None, texts[5], "en", "a", 1), (None, None, None, None, None), (3, "another text of this id", "en", "a", 1)]
    names = "size long, shard int, slot long, epochs long, token long, node long, file int, n_words long, _toxic boolean"
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in (n.split()[0] for n in names.split(", ")):
        frame = frame.selectExpr("*", f"CAST(7 AS BIGINT) AS {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
