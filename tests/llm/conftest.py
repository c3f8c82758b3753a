from __future__ import annotations

import re

import pytest

from tributary.llm.common import ship

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text), with columns whose names operators use themselves."""

    def make(rows, **columns):
        rows = [(i, t, "en", "s", "x", 1, 2, "y", "z") for i, t in rows]
        schema = (
            "doc_id BIGINT, text STRING, lang STRING, source STRING, node STRING, bucket INT, "
            "epochs INT, hash STRING, row STRING"
        )
        return spark.createDataFrame(rows, schema)

    return make
