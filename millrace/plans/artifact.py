"""Built artifacts: manifest, digests, overwrite guard, promotion, run records.

An artifact is a folder with a table, the claimed prompts and a manifest, in any store that Spark reads. A build works in
a folder of its own inside, moves its parts into place once all checks hold, and writes the manifest last: without a manifest
there is no artifact, so an interrupted build is never seen. Tables are digested by the executors.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path
from typing import Any
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.recipe import RecipeError
from millrace.sources.scan import Store, table_digest

TABLE, MANIFEST, CLAIMS = "train.parquet", "manifest.json", "claims.parquet"
#: What names the promoted artifact where a store has no links.
POINTER = ".promoted.json"
SHA256 = re.compile(r"[0-9a-f]{64}")


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def make_room(spark: SparkSession, folder: str | Path, force: bool) -> str:
    """Refuse to overwrite an artifact; the name of a new working folder inside."""
    store = Store(spark, folder)
    old = [store.uri(n) for n in (TABLE, MANIFEST, CLAIMS) if store.exists(n)]
    if old and not force:
        raise FileExistsError(f"refusing to overwrite {', '.join(old)}")
    return f"_building-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, folder: str | Path, working: str, doc: dict[str, Any]) -> dict[str, Any]:
    """Put a finished build into place: an older manifest goes first, the new one comes last."""
    store = Store(spark, folder)
    output = {"path": store.uri(TABLE), "bytes": store.size(f"{working}/{TABLE}"), "sha256": table_digest(spark, store.uri(f"{working}/{TABLE}"))}
    store.delete(MANIFEST)
    for name in (TABLE, CLAIMS):
        store.delete(name)
        store.move(f"{working}/{name}", name)
    store.delete(working)
    store.put(MANIFEST, json.dumps({**doc, "output": output}, indent=2, sort_keys=True) + "\n")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str | Path) -> dict[str, Any]:
    store = Store(spark, folder)
    if not store.exists(MANIFEST):
        raise RecipeError(f"{store.uri()} has no manifest")
    return json.loads(store.text(MANIFEST))


@dataclass(frozen=True)
class Built:
    """What promotion looks at: a folder, its manifest, and the revision that should have built it."""

    store: Store
    manifest: dict[str, Any]
    revision: str

    @property
    def output(self) -> dict[str, Any]:
        return self.manifest.get("output") or {}


def _at_least(value: Any, least: Any) -> bool:
    return isinstance(value, int) and isinstance(least, int) and value >= least


def _place(uri: str) -> str:
    """A uri in one form: links of a mounted disk are followed."""
    where = urlparse(uri)
    return os.path.realpath(where.path) if where.scheme in ("", "file") else uri


#: What must hold of an artifact before readers see it; a digest is only looked at for its form.
PRECONDITIONS: dict[str, Callable[[Built], bool]] = {
    "every part of it is there and not empty": lambda b: all(b.store.size(n) for n in (CLAIMS, MANIFEST, TABLE)),
    "its tokens reach the target": lambda b: _at_least(b.manifest.get("selected_tokens", 0), b.manifest.get("target_tokens", 0)),
    "it was built by the expected revision": lambda b: b.manifest.get("repository_git_sha") == b.revision,
    "its table has the digest's form in the manifest": lambda b: bool(SHA256.fullmatch(str(b.output.get("sha256")))),
    "its table has the manifest's size": lambda b: b.output.get("bytes") == b.store.size(TABLE),
    "its manifest names this table": lambda b: _place(str(b.output.get("path"))) == _place(b.store.uri(TABLE)),
}


def unmet(built: Built) -> list[str]:
    return [rule for rule, holds in PRECONDITIONS.items() if not holds(built)]


def promote(spark: SparkSession, source: str | Path, destination: str | Path, expected_git_sha: str) -> dict[str, Any]:
    """Name a built artifact at the place that readers use, once: an existing place is never replaced. On a mounted disk that
    is a link, elsewhere a small file beside the place."""
    built = Built(Store(spark, _place(str(source))), read_manifest(spark, source), expected_git_sha)
    if broken := unmet(built):
        raise RecipeError("can't promote, as it doesn't hold that " + "; ".join(broken))
    if urlparse(str(destination)).scheme in ("", "file"):
        link = Path(urlparse(str(destination)).path)
        link.parent.mkdir(parents=True, exist_ok=True)
        link.symlink_to(_place(built.store.uri()), target_is_directory=True)  # fails, in one step, if anything is there
    else:
        Store(spark, str(destination) + POINTER).put("", json.dumps({"artifact": built.store.uri()}) + "\n", replace=False)
    return built.manifest


def promoted(spark: SparkSession, destination: str | Path) -> str:
    """The folder of the artifact that is promoted to a place."""
    if urlparse(str(destination)).scheme in ("", "file"):
        return _place(str(destination))
    return json.loads(Store(spark, str(destination) + POINTER).text(""))["artifact"]


def digested_inputs(spark: SparkSession, inputs: Mapping[str, str | Path]) -> DataFrame:
    """role, uri, bytes, sha256 of every input of a run: files, or tables as one. The executors read them; what isn't
    there has neither bytes nor digest."""
    out = spark.createDataFrame([(role, Store(spark, uri).uri()) for role, uri in inputs.items()], "role string, uri string")
    there = sorted({str(u) for u in inputs.values() if Store(spark, u).exists("")})
    if not there:
        return out.select("*", F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
    name = F.element_at(F.split("path", "/"), -1)
    parts = files.where(~name.rlike(r"^[_.]")).select("path", "length", F.sha2("content", 256).alias("digest"))
    held = out.join(parts, (F.col("path") == F.col("uri")) | F.startswith("path", F.concat("uri", F.lit("/"))), "left")
    own = F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), F.struct("path", "length", "digest"))))
    lines = F.array_join(F.transform(F.col("own"), lambda x, i: F.concat_ws(":", i, x["length"], x["digest"])), "\n")
    whole = F.when(F.size("own") == 1, F.col("own")[0]["digest"]).when(F.size("own") > 1, F.sha2(F.concat(lines, F.lit("\n")).cast("binary"), 256))
    return held.groupBy("role", "uri").agg(F.sum("length").alias("bytes"), own.alias("own")).select("role", "uri", "bytes", whole.alias("sha256"))


def describe_run(spark: SparkSession, inputs: Mapping[str, str | Path], facts: Mapping[str, Any]) -> dict[str, Any]:
    """What a run is made of: its inputs by role, digested, and what else is to be said of it."""
    found = digested_inputs(spark, inputs).orderBy("role").collect()  # a row an input
    return {"facts": dict(facts), "inputs": [r.asDict() for r in found], "missing": [r["role"] for r in found if r["sha256"] is None]}


def run_state(events: list[dict[str, Any]]) -> dict[str, Any]:
    """The state of a run after its events: the latest details, and an attempt for every stretch of
    events of one job."""
    details: dict[str, Any] = {}
    attempts: list[dict[str, Any]] = []
    stamp = {"completed": "completed_at", "failed": "failed_at"}
    for e in events:
        details |= e["details"]
        if not attempts or attempts[-1]["job_id"] != e["job_id"]:
            attempts.append({"job_id": e["job_id"], "started_at": e["at"]})
        attempts[-1]["status"] = e["status"]
        if e["status"] in stamp:
            attempts[-1][stamp[e["status"]]] = e["at"]
        if e["status"] == "failed":
            attempts[-1]["exit_code"] = e["exit_code"]
    last = events[-1] if events else {"job_id": None, "status": None}
    return {**details, "run_id": last["job_id"], "status": last["status"], "attempts": attempts}


def record_run(path: Path, job_id: str | None, status: str, details: dict[str, Any] | None = None, exit_code: int | None = None) -> dict[str, Any]:
    """Append an event to the run's log (JSON lines beside ``path``) and derive the record from all of them."""
    import yaml

    path.parent.mkdir(parents=True, exist_ok=True)
    log = path.with_suffix(".events.jsonl")
    with log.open("a", encoding="utf-8") as f:
        f.write(json.dumps({"at": now(), "job_id": job_id, "status": status, "exit_code": exit_code, "details": details or {}}) + "\n")
    state = run_state([json.loads(line) for line in log.read_text(encoding="utf-8").splitlines()])
    path.write_text(yaml.safe_dump(state, sort_keys=False), encoding="utf-8")
    return state
