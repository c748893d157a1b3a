import pytest

from .plain import odd_rows

SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Columns that the operators name themselves.
EXTRA = ["size", "target", "taken", "mix", "starts", "contamination", "stats", "component", "hub", "key", "owner", "n_words", "plan", "gone"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns whose names clash with the operators' own."""
    rows = [(*r, *[f"{c}{i}" for c in EXTRA]) for i, r in enumerate(odd_rows())]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in EXTRA)).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + "".join(f", {c} string" for c in EXTRA))
