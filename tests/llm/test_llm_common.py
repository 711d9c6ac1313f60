from types import SimpleNamespace

import pyarrow as pa
import pytest

from tripmart.llm import common


def session(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, other: folder or other))


def test_shared_folder_comes_from_the_session():
    assert common.shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        common.shared_folder(session("yarn"))
    local = session("local[2]")
    assert common.shared_folder(local) == common.shared_folder(local)


def test_slices_keep_every_row_in_order():
    texts = ["abc", None, "", "x" * 50, "y", "z" * 3, None]
    batch = pa.RecordBatch.from_pydict({"k": list(range(7)), "text": texts})
    for most in (1, 4, 1000):
        runs = list(common.slices(batch, 1, most))
        assert [t for r in runs for t in r.column(1).to_pylist()] == texts
    assert not list(common.slices(batch.slice(0, 0), 1, 4))


def test_settled_tables_are_read_back(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s")
    assert sorted(r["id"] for r in common.settle(df, "t").collect()) == [0, 1, 2, 3, 4]
