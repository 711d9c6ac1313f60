import duckdb
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    """The smallest tables as lists of dicts."""
    def load(name):
        cursor = duckdb.sql(f"SELECT * FROM '{DATA}/{name}.parquet'")
        names = cursor.columns
        return [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]

    return load
