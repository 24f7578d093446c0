import duckdb
import pytest

from hoodcast.llm import registry
from samples import ODD, ODD_SCHEMA



@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    registry.ship(spark)
    registry.load_all()


@pytest.fixture(scope="session")
def against_oracle(spark):
    """Compare a query with its DuckDB SQL, as multisets of rows."""
    def run(name, sf_dir):
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        df = registry.QUERIES[name](spark, sf_dir)
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        cur = con.execute(registry.ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()), key=repr)
        assert got == want
        return got
    return run


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
