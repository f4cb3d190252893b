import hashlib
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import evals, gates, vectors
from millrace.plans.recipe import RecipeError
from millrace.sources import results, tensors
from millrace.streaming import ingest


def test_matrix_scores_and_choice(spark, tmp_path):
    models = spark.createDataFrame([("m0", "/m0"), ("m1", "/m1"), ("m2", "/m2")], "model_id string, model_path string")
    tasks = spark.createDataFrame([("t0", "math", 4, 16), ("t1", "code", 0, 1)], "task string, capability string, num_fewshot int, max_gen_toks int")
    matrix = evals.matrix(models, tasks)
    assert matrix.count() == 6 and evals.matrix(models, tasks, ["m1"], ["t0"]).count() == 1
    with pytest.raises(RecipeError):
        evals.matrix(models, tasks, ["nope"])
    results.write_matrix(matrix, str(tmp_path / "matrix"))
    back = results.read_matrix(spark, str(tmp_path / "matrix"))
    assert back.exceptAll(matrix).isEmpty() and results.matrix_row(back, 2, "model_id", "task")["model_id"] == "m1"
    with pytest.raises(IndexError):
        results.matrix_row(back, 9, "model_id")
    values = {("m0", "t0"): 0.5, ("m0", "t1"): 0.1, ("m1", "t0"): 0.6, ("m1", "t1"): 0.2, ("m2", "t0"): 0.7, ("m2", "t1"): 0.1}
    for (m, t), v in values.items():
        folder = tmp_path / "eval" / m / t / "sub"
        folder.mkdir(parents=True)
        doc = {"results": {t: {"acc,none": v, "acc_stderr,none": 0.01, "alias": t, "f1,x": v, "other,x": 77.0}}, "n-shot": {t: 4}}
        (folder / "results_1.json").write_text(json.dumps(doc))
    primary = {"t0": ["acc,none", "f1,x"], "t1": ["acc,none", "f1,x"]}
    rows = results.read_results(spark, tmp_path / "eval", ["m0", "m1", "m2"], primary)
    assert rows.count() == 12 and rows.where("metric = 'acc,none' and stderr = 0.01").count() == 6 and rows.where("metric = 'f1,x' and stderr is null").count() == 6
    assert evals.required_rows(matrix.select("model_id", "task"), rows).isEmpty()
    assert evals.required_rows(matrix.select("model_id", "task"), rows.where("model_id <> 'm1'")).count() == 2
    scores = evals.task_scores(rows)
    macros = evals.macro(scores).withColumn("macro", F.round("macro", 9))
    order = spark.createDataFrame([("m1", 0), ("m2", 1)], "model_id string, position int")
    assert evals.chosen(macros, order).first().model_id == "m1"  # a tie: the earlier one
    assert evals.geometric_macro(scores, spark.createDataFrame([("t1", 0.15)], "task string, least double")).first().model_id == "m1"
    table = evals.report(scores, macros, ["t0", "t1"], "m0").orderBy("model_id")
    assert tuple(table.collect()[1]) == ("m1", "60.00", "20.00", "40.00", "+10.00")
    doc = evals.summary(table, "m1", "highest macro", [("x", "it is slow")])
    assert json.loads(json.dumps(doc))["choice"] == {"model": "m1", "rule": "highest macro"} and doc["models"]["m1"]["delta"] == "+10.00"
    text = evals.markdown(doc, "Scores").splitlines()
    assert "m1 was chosen (highest macro)." in text and "  x, because it is slow" in text and any(x.startswith("m1 ") and x.endswith("+10.00") for x in text)
    assert len({len(x) for x in text if " | " in x}) == 1
    (tmp_path / "eval" / "m0" / "t0" / "results_2.json").write_text("{}")
    with pytest.raises(RecipeError, match="m0/t0: 2 result documents, not 1"):
        results.read_results(spark, tmp_path / "eval", ["m0"], {"t0": ["acc,none"]})
    for wrong in ("missing,none", "alias"):  # a primary metric must be there, as a number
        with pytest.raises(RecipeError, match=f"m1/t0: no number for {wrong}$"):
            results.read_results(spark, tmp_path / "eval", ["m1"], {"t0": ["acc,none", wrong]})


def test_result_documents_of_any_shape(spark):
    """Whatever stands in a document, each wanted metric has a value or a problem; nothing is opened on the driver."""
    good = {"results": {"t": {"acc,none": 1, "acc_stderr,none": "N/A", "b": True, "s": "0.5", "big": 10**30, "nested": {"x": 1}}, "u": 3}, "n-shot": {"t": 5}, "more": [1, {"a": None}]}
    docs = [("m", "t", "p1", json.dumps(good)), ("m", "u", "p2", json.dumps(good)), ("m", "v", "p3", "not json"), ("m", "w", "p4", "[1]"), ("n", "t", "p5", "{}"), ("n", "t", "p6", "{}"), ("m", "x", "p7", None)]
    documents = spark.createDataFrame([(*d[:3], None if d[3] is None else d[3].encode()) for d in docs], "model_id string, task string, path string, content binary")
    asked = results.wanted(spark, ["m"], {"t": ["acc,none", "b", "s", "big", "nested", "none"], "u": ["acc"], "v": ["a"], "w": ["a"], "x": ["a"], "y": ["a"]}).unionByName(results.wanted(spark, ["n"], {"t": ["acc,none"]}))
    got = {(r["model_id"], r["task"], r["metric"]): r for r in results.results_of(documents, asked).collect()}
    assert len(got) == 12
    one = got["m", "t", "acc,none"]
    assert (one["value"], one["stderr"], one["num_fewshot"], one["problem"]) == (1.0, None, 5, None) and one["result_sha256"] == hashlib.sha256(json.dumps(good).encode()).hexdigest()
    assert got["m", "t", "big"]["value"] == 1e30
    for metric in ("b", "s", "nested", "none"):
        assert got["m", "t", metric]["problem"] == f"no number for {metric}" and got["m", "t", metric]["value"] is None
    assert {t: got["m", t, "a"]["problem"] for t in "vwxy"} == {"v": "no result of v", "w": "no result of w", "x": "no result of x", "y": "0 result documents, not 1"}
    assert got["m", "u", "acc"]["problem"].startswith("no ") and got["n", "t", "acc,none"]["problem"] == "2 result documents, not 1"


def test_stderr_name(spark):
    df = spark.createDataFrame([("a,b,c",), ("a",)], "m string")
    assert [r[0] for r in df.select(evals.stderr_name(F.col("m"))).collect()] == ["a_stderr,b,c", "a"]


def test_last_attempt(spark):
    df = spark.createDataFrame([("j", 1, "a"), ("j", 2, "b"), ("k", 1, "c")], "job string, ts int, status string")
    assert {tuple(r) for r in evals.last_attempt(df, "job", "ts").collect()} == {("j", 2, "b"), ("k", 1, "c")}


def test_gates(spark):
    rows = spark.createDataFrame([("a", [("user", "x")], 70), ("b", [("assistant", "x")], 10), ("c", [("assistant", "x")], 70), ("c", None, 70)], "h string, messages array<struct<role:string,content:string>>, token_count int")
    assert sorted(r.h for r in gates.row_violations(rows, 64, 100).collect()) == ["a", "b", "c"]
    assert [tuple(r) for r in gates.repeated(rows, "h").collect()] == [("c", 2)]
    assert gates.missing_columns(rows) == ["language", "prompt_hash", "source_id", "task"]
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    two = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, n int")
    assert {tuple(r) for r in gates.mismatches(one, two, ["k"], "n").collect()} == {("b", 2, 3), ("c", None, 4)}


def safetensors(path, tensors_):
    head, data = {}, b""
    for name, (dtype, shape, raw) in tensors_.items():
        head[name] = {"dtype": dtype, "shape": shape, "data_offsets": [len(data), len(data) + len(raw)]}
        data += raw
    text = json.dumps(head).encode()
    path.write_bytes(struct.pack("<Q", len(text)) + text + data)


def test_tensor_files(spark, tmp_path):
    v = np.arange(100, dtype=np.float32)
    bad = np.array([1.0, np.nan, -np.inf, -7.0], dtype=np.float32)
    safetensors(tmp_path / "a.safetensors", {"w": ("F32", [10, 10], v.tobytes()), "b": ("BF16", [4], (bad.view(np.uint32) >> 16).astype(np.uint16).tobytes())})
    got = tensors.measured(tensors.inventory(spark, [str(tmp_path / "a.safetensors")], chunk_values=7))
    by = {r.name: r for r in got.collect()}
    assert (by["w"]["values"], by["w"].nan, by["w"].absmax) == (100, 0, 99.0)
    assert (by["b"].nan, by["b"].inf, by["b"].absmax) == (1, 1, 7.0)
    out = tensors.verdict(got, required=("w", "x"), expected_tensors=3, expected_values=104)
    assert out["nonfinite"] == 2 and len(out["wrong"]) == 3


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, float("nan"), -3.0],), ([float("inf")],), ([],)], "v array<float>")
    got = vectors.audit(df, "v").first()
    assert (got.tensors, got["values"], got.nan, got.inf, got.nonfinite, got.absmax) == (3, 4, 1, 1, 2, 3.0)


def test_streaming_ingest(spark, tmp_path):
    spark.createDataFrame([("de", "A b"), ("de", "a  B"), ("en", "a b")], "lang string, t string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("lang string, t string").parquet(str(tmp_path / "in"))
    q = ingest.append_to(ingest.first_prompts(stream, "lang", "t"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_head_and_listing(spark, tmp_path):
    from millrace.sources import scan

    df = spark.range(50).repartition(7)
    assert scan.head(df, 5, "id").exceptAll(scan.head_by_rank(df, 5, "id")).isEmpty()
    (tmp_path / "x.json").write_text("{}")
    assert results.files_with_size(spark, str(tmp_path), "*.json").first().bytes == 2
