"""Weight files as a data source."""

import numpy as np
import pytest
from test_evals import safetensors

from millrace.sources import weights

KIND = "name string, values array<float>, shape array<long>, dtype string"


@pytest.fixture()
def source(spark):
    weights.register(spark)
    return lambda path, **options: spark.read.format("weights").options(**options).load(str(path))


def whole(df):
    """name -> values, put together from chunks."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["file"], r["name"], r["first"])):
        assert len(out.setdefault(r["name"], [])) == r["first"]
        out[r["name"]] += r["values"]
    return out


def test_round_trip_over_a_uri(spark, source, tmp_path):
    rows = [(f"t{i}", [float(x) for x in range(i)], None, None) for i in range(20)] + [("m", [1.0, 2.0, 3.0, 4.0], [2, 2], "F64"), ("none", None, None, None), ("odd", [float("nan"), float("-inf")], None, None)]
    spark.createDataFrame(rows, KIND).repartition(3).write.format("weights").mode("append").option("file_bytes", 64).save(f"file://{tmp_path}/w")
    files = list((tmp_path / "w").iterdir())
    assert len(files) > 5 and all(f.name.startswith("part-") and f.suffix == ".safetensors" for f in files)
    df = source(f"file://{tmp_path}/w", chunk_values=7, task_values=20)
    assert df.schema.simpleString().startswith("struct<file:string,name:string,dtype:string,shape:array<bigint>,first:bigint,values:array<double>")
    got = whole(df)
    assert set(got) == {r[0] for r in rows} and all(got[n] == (v or []) for n, v, *_ in rows if n != "odd")
    assert np.isnan(got["odd"][0]) and got["odd"][1] == -np.inf
    assert {(tuple(r["shape"]), r["dtype"]) for r in df.where("name = 'm'").collect()} == {((2, 2), "F64")}


def test_other_tensors_are_not_planned(spark, source, tmp_path):
    safetensors(tmp_path / "a.safetensors", {"w": ("F32", [100], np.arange(100, dtype=np.float32).tobytes()), "b": ("I16", [3], np.array([1, -2, 3], np.int16).tobytes())})
    safetensors(tmp_path / "_b.safetensors", {"hidden": ("F32", [1], np.zeros(1, np.float32).tobytes())})
    assert source(tmp_path, chunk_values=9, task_values=1).rdd.getNumPartitions() == 13
    assert source(tmp_path, chunk_values=9, task_values=1, names="b").rdd.getNumPartitions() == 1
    assert whole(source(tmp_path / "a.safetensors", names="b,x")) == {"b": [1.0, -2.0, 3.0]}
    df = source(tmp_path, chunk_values=9, task_values=1).where("name in ('b', 'c') and first = 0")
    assert whole(df) == {"b": [1.0, -2.0, 3.0]} and df.rdd.getNumPartitions() == 1
    assert source(tmp_path, names="none").count() == 0


def test_odd_rows_are_errors(spark, source, tmp_path):
    for rows in ([(None, [1.0], None, None)], [("a", [1.0], None, None), ("a", [2.0], None, None)]):
        with pytest.raises(Exception, match="name"):
            spark.createDataFrame(rows, KIND).coalesce(1).write.format("weights").mode("append").save(f"file://{tmp_path}/x")
    assert not list((tmp_path / "x").glob("part-*"))
    (tmp_path / "bad.safetensors").write_bytes(b"1")
    with pytest.raises(Exception, match="."):
        source(tmp_path / "bad.safetensors").count()
