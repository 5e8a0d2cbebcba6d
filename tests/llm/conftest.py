import os
import re

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture
def documents(spark):
    def build(*texts, first=1):
        """Documents of the texts, numbered from `first`, with a column that clashes."""
        rows = [(first + i, t, "en", "s", 1, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string")

    return build


@pytest.fixture
def joins():
    def found(df):
        """(join, kind, side sent to the driver) of a plan, the last join first, as chosen from the sizes that the planner takes tables to have."""
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return [(m[1], m[2], m[3]) for m in re.finditer(r"(\w+Join) .*?(Inner|LeftOuter)(?:, (Build\w+))?", plan)]

    return found
