import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a table, sorted, as plain tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


DICTIONARIES = {
    "variables": [("Prod|Steel", "Production|Steel"), ("Prod|Alu", "Production|Aluminium")],
    "regions": [("AT", "Austria"), ("DE", "Germany"), ("FR", "France"), ("ES", "Spain")],
    "models": [("M9", "Model Nine")],
    "scenarios": [("base", "Base")],
}


@pytest.fixture
def dictionaries(spark):
    from scenweave.operators import load_dictionary

    def build(regions=(), models=None):
        tables = dict(DICTIONARIES, regions=DICTIONARIES["regions"] + list(regions))
        if models is not None:
            tables["models"] = models
        loaded = {
            name: load_dictionary(
                spark.createDataFrame([(*e, i) for i, e in enumerate(entries)], "s string, t string, seq int"),
                "s", "t", seq=["seq"],
            )
            for name, entries in tables.items()
        }
        units = spark.createDataFrame([("kt", "Mt", 0.001, 0), ("t", "t", 1.0, 1)], "s string, t string, f double, seq int")
        loaded["units"] = load_dictionary(units, "s", "t", "f", ["seq"])
        return loaded

    return build
