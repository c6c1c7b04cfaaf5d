from __future__ import annotations

import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumagrid.session import tune  # noqa: E402

IMAGES = "image_id bigint, width int, height int, gray binary"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture()
def rng():
    return np.random.default_rng(11)


@pytest.fixture()
def pack(spark):
    """Packed images from {id: 2-d array}."""

    def build(arrays: dict, key: str = "image_id"):
        rows = [
            (i, int(a.shape[1]), int(a.shape[0]), bytearray(np.asarray(a, np.uint8).tobytes()))
            for i, a in arrays.items()
        ]
        return spark.createDataFrame(rows, IMAGES.replace("image_id", key))

    return build


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
