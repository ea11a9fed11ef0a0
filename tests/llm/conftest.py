import pytest


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cardamom.llm._common import ship
    from cardamom.session import session

    more = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    made = session("tests", **more)
    made.sparkContext.setLogLevel("ERROR")
    if not made.conf.get("spark.checkpoint.dir", None):
        made.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    ship(made)
    yield made


def make(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)
