"""Fixtures of the pipeline operators' tests."""

from __future__ import annotations

import pytest
from cases import ODD, SF

@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """A shared folder for the session, as a cluster would name one."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def odd(shared):
    """The odd rows with the columns of documents and further ones whose names clash with results."""
    rows = [(i, t, None, None, None, 1, "y", 2.0) for i, t in ODD]
    return shared.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size int, law string, hash double"
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(shared):
    return shared.read.parquet(f"{SF}/documents.parquet")
