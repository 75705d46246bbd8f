from __future__ import annotations

import pytest

from tallyloom.llm.queries import prepare

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(spark):
    return prepare(spark)


@pytest.fixture
def docs(spark):
    """Documents with a column whose name clashes with what operators make."""

    def make(rows, clash="kept"):
        return spark.createDataFrame([(i, t, "en", 7) for i, t in rows], f"doc_id long, text string, lang string, {clash} int")

    return make


@pytest.fixture(scope="session")
def small(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "pages", "benchmark", "labels")}
