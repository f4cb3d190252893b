import hashlib
import json
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.functions.tokens import PatternCounter
from millrace.operators import pack
from millrace.plans import artifact, mix
from millrace.plans.lint import RULES, Plan, broken, lint, model_facts
from millrace.plans.recipe import ALL_ONCE, Input, Recipe, RecipeError, Source, load
from millrace.sources import scan as S

MODEL_RULES = {"the model has the facts that the recipe expects", "the chat template marks turns"}
SCHEMA = "messages array<struct<role:string,content:string>>, language string, id string"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(path))
    return path


@pytest.fixture()
def recipe(spark, tmp_path):
    say = lambda q, n: [("user", q), ("assistant", "word " * n)]
    a = write(spark, tmp_path / "a.parquet", [(say(f"q{i}", 70 + i), "de", str(i)) for i in range(10)] + [(say("Q0", 90), "de", "again"), (say("x", 3), "de", "short"), (None, "de", "bad")])
    b = write(spark, tmp_path / "b.parquet", [(say(f"q{i}", 80), "de", f"b{i}") for i in range(40)])
    c = write(spark, tmp_path / "c.parquet", [(say(f"c{i}", 80), "en", f"c{i}") for i in range(40)])
    sources = (
        Source("a", "cover", selection=ALL_ONCE, input=Input(path=str(a), expected_rows=13), expected_selected_rows=10, expected_languages=1, expected_filter_reasons={"ok": 11, "too_short": 1, "messages_not_list": 1}),
        Source("b", "broad", token_share=0.5, input=Input(path=str(b))),
        Source("c", "broad", token_share=0.5, language="en", input=Input(path=str(c)), max_raw_rows=35),
    )
    return Recipe(sources, 4000, version="v", min_tokens_per_example=64, max_tokens_per_example=300, token_share_tolerance=0.05, selection_order=("a", "c", "b"))


def test_build_validate_promote(spark, recipe, tmp_path):
    out = tmp_path / "out"
    doc = mix.build(spark, recipe, tmp_path, out, git_sha="a" * 40)
    by = {x["id"]: x for x in doc["sources"]}
    assert by["a"]["selected_rows"] == 10 and by["a"]["duplicates_skipped"] == 1 and by["a"]["valid_rows"] == 11
    assert by["c"]["raw_rows"] == 35 and by["c"]["input_rows"] == 40
    assert by["b"]["selected_tokens"] >= by["b"]["token_quota"] and doc["selected_tokens"] >= 4000
    assert doc["token_counter"] == PatternCounter().name
    table = spark.read.parquet(str(out / artifact.TABLE))
    assert table.count() == doc["selected_rows"] == table.select("prompt_hash").distinct().count()
    assert table.where((F.col("source_id") == "b") & F.col("prompt_hash").isin([r[0] for r in table.where("source_id = 'a'").select("prompt_hash").collect()])).isEmpty()
    assert mix.validate(spark, recipe, out)["selected_rows"] == doc["selected_rows"]
    with pytest.raises(FileExistsError):
        mix.build(spark, recipe, tmp_path, out)
    again = mix.build(spark, recipe, tmp_path, out, git_sha="a" * 40, force=True)
    strip = lambda d: {k: v for k, v in d.items() if k not in ("built_at", "output")}
    assert strip(again) == strip(doc)
    with pytest.raises(RecipeError):
        artifact.promote(spark, out, tmp_path / "live", "b" * 40)
    artifact.promote(spark, out, tmp_path / "live", "a" * 40)
    assert (tmp_path / "live").resolve() == out.resolve()
    trained = mix.training_rows(spark, tmp_path / "live")
    assert trained.columns == ["messages"] and trained.collect() == spark.read.parquet(str(out / artifact.TABLE)).select("messages").collect()
    bins = mix.training_bins(spark, tmp_path / "live", capacity=300)
    facts = pack.filled(bins, "token_count", 300).first()
    assert (facts["rows"], facts["tokens"], facts["overfull"], facts["overlapping"]) == (doc["selected_rows"], doc["selected_tokens"], 0, 0)
    with pytest.raises(RecipeError, match="no manifest"):
        mix.training_rows(spark, tmp_path / "a.parquet")
    with pytest.raises(FileExistsError):
        artifact.promote(spark, out, tmp_path / "live", "a" * 40)
    with pytest.raises(RecipeError):
        mix.validate(spark, replace(recipe, version="w"), out)


def test_expectations_fail_closed(spark, recipe, tmp_path):
    wrong = replace(recipe.sources[0], expected_filter_reasons={"ok": 12})
    with pytest.raises(RecipeError):
        mix.build(spark, replace(recipe, sources=(wrong, *recipe.sources[1:])), tmp_path, tmp_path / "o1")
    late = replace(recipe, selection_order=("b", "a", "c"))
    with pytest.raises(RecipeError):
        mix.build(spark, late, tmp_path, tmp_path / "o2")
    with pytest.raises(RecipeError):
        mix.build(spark, replace(recipe, target_tokens=10**9), tmp_path, tmp_path / "o3")


def test_audit(spark, recipe, tmp_path):
    seeded = replace(recipe.sources[0], expected_selected_tokens=0)
    plan = replace(recipe, sources=(seeded, *recipe.sources[1:]))
    lines = mix.audit(spark, plan, tmp_path, ["b", "c"])
    assert [(x["source_id"], x["unique_rows_after_seed"], x["duplicates_after_seed"]) for x in lines] == [("b", 40, 0), ("c", 40, 0)]
    assert lines[0]["headroom_tokens"] == lines[0]["eligible_tokens_after_seed"] - lines[0]["requested_quota"]
    claims = mix.normalized(spark.read.parquet(recipe.sources[0].input.path), seeded, 64, 300).where("_valid").select("prompt_hash")
    assert mix.audit(spark, plan, tmp_path, ["b"], claims)[0]["duplicates_after_seed"] == 10
    with pytest.raises(RecipeError):
        mix.audit(spark, plan, tmp_path, ["z"])


def test_resolve_snapshot(spark, tmp_path):
    root = tmp_path / "raw" / "datasets" / "org--set"
    (root / "data").mkdir(parents=True)
    for i in (1, 0):
        spark.range(3).coalesce(1).write.parquet(str(root / "data" / f"p{i}.parquet"))
    source = Source("s", input=Input(kind="huggingface_snapshot", repo_id="org/set", revision="r" * 40, files="data/p*.parquet"))
    with pytest.raises(FileNotFoundError):
        S.resolve(spark, source, tmp_path)
    assert Recipe((source, Source("l")), 1).of_kind("huggingface_snapshot") == [source]
    doc = S.write_snapshot(spark, root, "org/set", "r" * 40, ["data/*"])
    assert json.loads((root / "snapshot.json").read_text())["manifest_sha256"] == doc["manifest_sha256"]
    assert [p.path.split("/")[-1] for p in S.resolve(spark, source, tmp_path)] == ["p0.parquet", "p1.parquet"]
    with pytest.raises(RecipeError):
        S.resolve(spark, replace(source, input=replace(source.input, revision="x" * 40)), tmp_path)
    rows, figures = S.scan(spark, replace(source, max_input_files=1, max_raw_rows=2), tmp_path)
    assert rows.count() == 2 and figures["available_input_files"] == 2 and len(figures["resolved_files"]) == 1
    for bad in ({"max_input_files": 0}, {"max_raw_rows": -1}, {"input": replace(source.input, expected_rows=5)}, {"input": Input(kind="ftp")}):
        with pytest.raises(RecipeError):
            S.scan(spark, replace(source, **bad), tmp_path)


def test_lint(tmp_path):
    pinned = Input(kind="huggingface_snapshot", repo_id="o/r", revision="a" * 40, files="*")
    good = Recipe(
        (Source("p", selection=ALL_ONCE, input=pinned, expected_selected_rows=1, expected_selected_tokens=1, expected_languages=1, expected_filter_reasons={}), Source("w", token_share=1.0, input=pinned)),
        64, selection_order=("p", "w"), max_tokens_per_example=16,
    )
    training = {"max_length": 16, "max_steps": 2, "ranks": 2, "save_steps": 1, "save_total_limit": 2}
    twin = replace(good, sources=tuple(replace(s, selection="token_weighted", token_share=0.5, max_raw_rows=5000, max_input_files=1) for s in good.sources))
    assert lint(good, twin, training, first="p") == []
    bad = replace(good, sources=(good.sources[1], replace(good.sources[0], token_share=0.2, expected_languages=None)), selection_order=("w",), model={"revision": "z"})
    found = {name for name, _ in broken(Plan(bad, twin, {**training, "max_steps": 3}, first="p"))}
    assert found == {
        "selection_order names every source once", "the fixed source comes first in selection_order", "a consume-once source has no share", "a consume-once source states what it expects",
        "consume-once sources come before weighted ones", "the model is pinned to a commit", "the packed budget is the token target", "retention keeps every checkpoint",
        "sanity sources are the recipe's, in order", "the sanity model is the recipe's",
    }
    s, t = good.sources[1], twin.sources[1]
    one = lambda **k: replace(good, sources=(good.sources[0], replace(s, **k)))
    two = lambda **k: replace(twin, sources=(twin.sources[0], replace(t, **k)))
    run = {**training, "use_liger_kernel": True, "liger_kernel_config": {"rope": False, "cross_entropy": False, "fused_linear_cross_entropy": True, "rms_norm": False, "swiglu": False}}
    cases = {
        "source ids differ": Plan(one(id="p")), "weighted shares sum to one": Plan(one(token_share=0.9)), "a weighted source has a positive share": Plan(one(token_share=-1.0)),
        "a selection is all_once or token_weighted": Plan(one(selection="some")), "a snapshot is pinned to a commit": Plan(one(input=replace(pinned, revision="main"))),
        "a replay demands no reasoning": Plan(one(role="capability_replay", require_reasoning_trace=True)), "every source has a card": Plan(good, cards=tmp_path),
        "the model has the expected architecture": Plan(replace(good, model={"revision": "a" * 40, "expected": {"x": 1}}), architecture={"x": 2}),
        "a sanity source is weighted": Plan(good, two(selection="all_once")), "a sanity source has a positive row cap": Plan(good, two(max_raw_rows=0)),
        "a sanity source has the reviewed row cap": Plan(good, two(max_raw_rows=9)), "a sanity source has the reviewed file cap": Plan(good, two(max_input_files=2)),
        "sanity inputs are the recipe's": Plan(good, two(input=Input(path="/y"))), "sanity shares sum to one": Plan(good, two(token_share=0.4)),
        "the sanity run's length is its longest example's": Plan(good, twin, trials={"sanity": {**training, "max_length": 8}}),
        "the sanity target covers its packed budget": Plan(good, twin, trials={"sanity": {**training, "max_steps": 99}}),
        "training length is the longest example's": Plan(good, settings={**training, "max_length": 8}), "checkpoints hold the optimizer": Plan(good, settings={**training, "save_only_model": True}),
        "steps and save interval are the reviewed ones": Plan(good, settings=training, steps=5), "packing has the attention it needs": Plan(good, settings={**training, "packing": False}),
        "a reduced run differs in size alone": Plan(good, settings=training, trials={"sanity": {**training, "learning_rate": 1}}),
        "the loss is fused": Plan(good, settings=run, trials={"smoke": {**run, "use_liger_kernel": False}}), "the loss is on the assistant only": Plan(good, trials={"smoke": {"assistant_only_loss": False}}),
        "job scripts have their lines": Plan(good, wrappers={"train": ("#SBATCH --nodes=8", ("#SBATCH --nodes=9",))}), "the mask template is there": Plan(good, template=tmp_path / "none"),
    }
    for name, plan in cases.items():
        assert name in {n for n, _ in broken(plan)}, name
    assert set(cases) | found | MODEL_RULES == set(RULES)
    (tmp_path / "r.yaml").write_text("version: v\ntarget_tokens: 5\nsources:\n- id: a\n  token_share: 1.0\n  input: {kind: local_parquet, path: /x}\n  extra: 1\n")
    assert load(tmp_path / "r.yaml").sources[0].input.path == "/x"


def test_run_record(tmp_path):
    path = tmp_path / "run.yaml"
    artifact.record_run(path, "1", "started")
    artifact.record_run(path, "1", "failed", exit_code=3)
    got = artifact.record_run(path, "2", "completed", {"container": "c"})
    assert [(a["job_id"], a["status"]) for a in got["attempts"]] == [("1", "failed"), ("2", "completed")]
    assert got["attempts"][0]["exit_code"] == 3 and got["container"] == "c"


def test_promotion_of_a_real_build(spark, recipe, tmp_path):
    """Every change to what was built stops promotion, by the rule that it breaks and no other."""
    out = tmp_path / "built"
    doc = mix.build(spark, recipe, tmp_path, out, git_sha="5" * 40)
    store = S.Store(spark, out)
    state = lambda d: artifact.unmet(artifact.Built(store, d, "5" * 40))
    assert state(doc) == []
    changed = {
        "it was built by the expected revision": {"repository_git_sha": None},
        "its tokens reach the target": {"target_tokens": doc["selected_tokens"] + 1},
        "its manifest names this table": {"output": {**doc["output"], "path": doc["output"]["path"] + "2"}},
        "its table has the manifest's size": {"output": {**doc["output"], "bytes": 0}},
        "its table has the digest's form in the manifest": {"output": {**doc["output"], "sha256": doc["output"]["sha256"].upper() + "0"}},
    }
    for rule, change in changed.items():
        assert state(doc | change) == [rule]
    for p in (out / artifact.CLAIMS).glob("*part-*"):
        p.unlink()
    assert state(doc) == ["every part of it is there and not empty"] and {*changed, *state(doc)} == set(artifact.PRECONDITIONS)
    with pytest.raises(RecipeError, match="every part"):
        artifact.promote(spark, out, tmp_path / "there", "5" * 40)
    with pytest.raises(RecipeError, match="no manifest"):
        artifact.promote(spark, tmp_path / "nothing", tmp_path / "there", "5" * 40)


def test_build_and_promotion_by_uri(spark, recipe, tmp_path, monkeypatch):
    """A store without links gets a file that names the artifact; a build that breaks off is never seen."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shelf.link./a", f"file://{tmp_path}")
    out, live = "viewfs://shelf/a/far/out", "viewfs://shelf/a/far/live"
    with monkeypatch.context() as m:
        m.setattr(mix.gates, "check_written", lambda *a: (_ for _ in ()).throw(RecipeError("lost")))
        with pytest.raises(RecipeError, match="lost"):
            mix.build(spark, recipe, tmp_path, out, git_sha="e" * 40)
    with pytest.raises(RecipeError, match="no manifest"):
        artifact.read_manifest(spark, out)
    doc = mix.build(spark, recipe, tmp_path, out, git_sha="e" * 40)
    assert mix.validate(spark, recipe, out) == doc and doc["output"]["path"] == f"{out}/{artifact.TABLE}"
    artifact.promote(spark, out, live, "e" * 40)
    assert artifact.promoted(spark, live) == out
    with pytest.raises(FileExistsError):
        artifact.promote(spark, out, live, "e" * 40)


def reads_of(spark, column):
    """For each finished execution, how often its plan scans a column of that name from files."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [re.findall(rf"ReadSchema: struct<[^\n]*\b{column}:", runs.apply(i).physicalPlanDescription()) for i in range(runs.size())]


def test_messages_are_written_once_and_never_read_back(spark, recipe, tmp_path):
    before = len(reads_of(spark, "messages"))
    mix.build(spark, recipe, tmp_path, tmp_path / "out")
    # each source to select, then all three to write; a plan is described twice, as first made and as run
    assert [len(x) for x in reads_of(spark, "messages")[before:] if x] == [2, 2, 2, 6]


def test_global_order_is_not_sampled(spark):
    rows = spark.range(5000).select(F.lit("s").alias("source_id"), F.col("id").alias("_row_id"))
    out = mix.shuffled(rows, 7, "source_id", "_row_id", total=5000, file_rows=700)
    got = [r["_row_id"] for r in out.collect()]
    key = F.md5(F.concat_ws(":", F.lit("7"), F.concat_ws(":", "source_id", "_row_id")).cast("binary"))
    assert got == [r["_row_id"] for r in rows.orderBy(key).collect()]
    assert "rangepartitioning" not in out._jdf.queryExecution().toString()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 800


def test_run_description(spark, tmp_path):
    (tmp_path / "settings.yaml").write_text("a: 1\n")
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "rows"))
    doc = artifact.describe_run(spark, {"settings": tmp_path / "settings.yaml", "data": tmp_path / "rows", "template": tmp_path / "none"}, {"steps": 3})
    by = {x["role"]: x for x in doc["inputs"]}
    assert doc["facts"] == {"steps": 3} and doc["missing"] == ["template"]
    assert by["settings"]["sha256"] == hashlib.sha256(b"a: 1\n").hexdigest() and by["settings"]["bytes"] == 5
    assert by["data"]["sha256"] == S.table_digest(spark, tmp_path / "rows") and by["data"]["bytes"] > 100 and by["template"]["bytes"] is None


def test_model_facts_and_their_rules():
    marks = "a <start_of_turn> b <end_of_turn>"
    files = {"config.json": '{"architectures": ["Net"], "text": {"vocab_size": 9, "rope": {"theta": 1e4}}, "pad": 1}', "tokenizer_config.json": '{"pad": 2, "eos_token": "<e>"}', "chat.jinja": marks}
    facts = model_facts(files)
    assert facts["architecture"] == "Net" and facts["vocab_size"] == 9 and facts["config.text.rope.theta"] == facts["theta"] == 1e4 and facts["eos_token"] == "<e>"
    assert "pad" not in facts and (facts["config.pad"], facts["tokenizer_config.pad"]) == (1, 2)
    pinned = Recipe((Source("w", token_share=1.0),), 64)
    found = lambda facts, **want: {(n, w) for n, w in broken(Plan(pinned, facts=facts, invariants=want)) if n in MODEL_RULES}
    assert found(facts, architecture="Net", vocab_size=9) == found(None, vocab_size=1) == set()
    assert found(facts, vocab_size=8, bos="<b>") == {("the model has the facts that the recipe expects", "vocab_size: 9 for 8"), ("the model has the facts that the recipe expects", "bos: None for '<b>'")}
    assert found(model_facts({"chat.jinja": "<start_of_turn>"})) == {("the chat template marks turns", "<end_of_turn>")} and len(found({})) == 2
