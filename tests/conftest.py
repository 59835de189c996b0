import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lexmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def news(spark):
    """Two news items small enough to index by hand."""
    return spark.createDataFrame(
        [
            (2, "Oil prices", "Oil up", "Oil rises. The oil, market"),
            (10, "Gold", "Gold flat", "Gold and oil - steady"),
        ],
        "doc_id long, title string, headline string, text string",
    )


@pytest.fixture(scope="session")
def news_index(spark, news, tmp_path_factory):
    import lexmill as lx

    path = str(tmp_path_factory.mktemp("news") / "index")
    kinds = ("positional", "uniword", "biword")
    return lx.build_index(news, path, ["the", "and"], kinds, include_id_token=True, shards=4)
