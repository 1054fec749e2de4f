import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rankweave.session import build_session

    session = build_session(
        "tests", "local[4]", 4,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """Three documents and two queries. Two-letter words stand for themselves, so nothing is a stop word."""
    docs = spark.createDataFrame([
        ("d1", "http://a.b/c", "solar panel", "solar panel cost panel"),
        ("d2", "http://a.b/c/d", "energy", "solar energy"),
        ("d3", "http://x.y", "", "panel discussion over energy policy energy"),
    ], "docid string, url string, title string, body string")
    queries = spark.createDataFrame([("q1", "solar panel"), ("q2", "energy")], "qid string, text string")
    return docs, queries
