from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_test_helpers import frame, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd():
    return odd_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    return frame(spark, odd)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
