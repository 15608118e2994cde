import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("corpusflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("workspace")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text", "source")


#: Texts that are hard to cut: white space of all kinds, digits, contractions, joined emoji, literal <eos>.
EDGE_TEXTS = [
    " ",
    "a",
    "<eos> is text",
    "it's 'LL we'Ve 'd",
    "12345١٢٣ ½",
    "l\r\n\r\n  n \t\n",
    "a  b　　c",
    "x y z",
    "n\u0085m",
    "'ſ 'S",
    "👨‍👩‍👧‍👦 family",
    "﻿bom",
    "   trailing   ",
    "z" * 500,
    "é" * 100 + " " * 100 + "\n" * 10,
    "Once upon a time, there was a little girl.",
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, text) for i, text in enumerate([*EDGE_TEXTS, "", None])]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
