import pytest

from stayledger.session import ship_package
from tests_llm_data import SMALL, framed, prose


@pytest.fixture(scope="session", autouse=True)
def code_on_workers(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge_rows():
    long = "\n".join(prose(500 + i, 25) for i in range(800))
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n \r\n", None, None),
        (4, prose(1, 80), "en", "a"),
        (4, prose(1, 80), "en", "a"),
        (None, prose(2, 60), "en", "b"),
        (None, None, None, None),
        (5, long, "fr", "b"),
        (6, "1234 5678 !!", "en", "a"),
        (7, "é" * 50 + " ▁ 中文 \U0001f600", "fr", "b"),
        (8, prose(1, 80), "en", "c"),
        (-9, prose(1, 79) + " changed", "en", "c"),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return framed(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return framed(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
