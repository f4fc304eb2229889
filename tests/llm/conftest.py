from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not Path(SF).exists():
        pytest.skip("no tables here")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, equal ids, and columns with names that operators use themselves."""
    long = " ".join(f"w{i % 977}x{i % 31}. token" + ("\n" if i % 9 == 0 else "") for i in range(30_000))
    line = "One line that is here again and again. And another one behind it, in each text. "
    rows = [(1, "A plain text of a few words. Nothing else."), (2, None), (None, "no id here but some words"), (3, ""), (4, " \n\t "), (5, long), (5, long), (6, line * 3), (6, "same id, another text of its own"), (7, "Été 한국어 \U0001f600 ß"), (8, "x"), (9, line * 3)]
    schema = "doc_id long, text string, lang string, score string, hash int, block string, n int, start string, bucket string, held_out string, comp string, _id string, gone string"
    return spark.createDataFrame([(i, t, None if k == 0 else "en" if k % 2 else "fr", "s", 1, "b", 2, "t", "u", "v", "c", "d", "e") for k, (i, t) in enumerate(rows)], schema).coalesce(2)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
