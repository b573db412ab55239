from __future__ import annotations

import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_frames import EDGE, SF, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE)


@pytest.fixture(scope="session")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")
