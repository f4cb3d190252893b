"""Build a mixture from a recipe: scan, normalize, select, gate, shuffle, write, describe."""

from __future__ import annotations

import hashlib
import json
import math
from collections import defaultdict
from dataclasses import asdict
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.messages import REASONS
from millrace.functions.tokens import PatternCounter, TokenCounter
from millrace.operators import gates, pack
from millrace.operators.claims import ClaimStore
from millrace.operators.normalize import CANONICAL, normalized
from millrace.operators.select import Part, cell_of, claims, order_key, priority_select
from millrace.plans import artifact
from millrace.plans.recipe import ALL_ONCE, WEIGHTED, Recipe, RecipeError, Source
from millrace.sources.scan import Store, file_rows, scan, table_digest, with_row_id
from millrace.sources.storage import written


#: Rows in a file of a built table, about.
FILE_ROWS = 250_000


def shuffled(rows: DataFrame, seed: int, *keys: str, total: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """A seeded global order. Its key is uniform, so equal ranges of it are known beforehand: rows go straight to the range
    that is theirs, without a pass to sample keys, and are sorted there. Files follow each other in the order."""
    parts = max(1, math.ceil(total / file_rows))
    keyed = rows.withColumn("_key", order_key(seed, F.concat_ws(":", *keys)))
    return keyed.repartitionById(parts, cell_of(F.col("_key"), parts).cast("int")).sortWithinPartitions("_key", *keys).drop("_key")


NARROW = ("source_id", "prompt_hash", "token_count", "language", "has_think_tags", "_valid", "_reason")


def _normalized(raw: DataFrame, source: Source, recipe: Recipe, counter: TokenCounter) -> DataFrame:
    return normalized(raw, source, recipe.min_tokens_per_example, recipe.max_tokens_per_example, counter, keep=("_row_id",))


def normalize_source(spark: SparkSession, source: Source, index: int, recipe: Recipe, root: str | Path, counter: TokenCounter) -> tuple[DataFrame, DataFrame, dict, dict[str, int]]:
    """The raw rows; what selection needs of the canonical ones, without messages (written once); scan figures; reject
    reasons, counted while that is written."""
    raw, figures = scan(spark, source, root)
    seen = Observation()
    rows = _normalized(raw, source, recipe, counter).select("_row_id", *NARROW, order_key(recipe.seed + index, F.col("_row_id")).alias("_key"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("_reason") == r).alias(r) for r in REASONS])
    rows = written(rows, f"rows-{index}")
    counts = seen.get
    if counts["rows"] != sum(counts[r] for r in REASONS):
        raise RecipeError(f"{source.id}: rows were rejected for reasons that aren't known")
    return raw, rows, figures, {r: counts[r] for r in REASONS if counts[r]}


def build(spark: SparkSession, recipe: Recipe, root: str | Path, output: str | Path, counter: TokenCounter | None = None, git_sha: str = "", force: bool = False, ledger: ClaimStore | None = None) -> dict:
    """Write the selected rows, the claimed prompts and the manifest to ``output``, a folder in any store.

    Prompts that other batches of ``ledger`` hold are not selected again, and the build's own become its batch there, named by
    the recipe's version.

    Messages are read to normalize them and read again for the selected rows alone, and written once.
    """
    working = artifact.make_room(spark, output, force)
    place = Store(spark, output)
    counter = counter or PatternCounter()
    order = recipe.ordered()
    kinds = [s.selection for s in order]
    if any(k not in (ALL_ONCE, WEIGHTED) for k in kinds):
        raise RecipeError("unknown selection")
    if WEIGHTED in kinds and ALL_ONCE in kinds[kinds.index(WEIGHTED) :]:
        raise RecipeError("consume-once sources must be selected before weighted ones")
    raws: dict[str, DataFrame] = {}
    tables: dict[str, DataFrame] = {}
    figures: dict[str, dict] = {}
    reasons: dict[str, dict[str, int]] = {}
    for i, source in enumerate(order):
        raws[source.id], tables[source.id], figures[source.id], reasons[source.id] = normalize_source(spark, source, i, recipe, root, counter)
        for reason, n in (source.expected_filter_reasons or {}).items():
            if reasons[source.id].get(reason, 0) != n:
                raise RecipeError(f"{source.id}: {reasons[source.id].get(reason, 0)} rows are {reason}, not {n}")
    every = None
    for t in tables.values():
        narrow = t.where("_valid").select("source_id", F.col("_row_id").alias("row_id"), "prompt_hash", F.col("token_count").alias("tokens"), F.col("_key").alias("key"))
        every = narrow if every is None else every.unionByName(narrow)
    if ledger is not None:
        every = ledger.unclaimed(every, but=recipe.version)
    once = [Part(s.id, None) for s in order if s.selection == ALL_ONCE]
    picked, stats, fixed = [], {}, 0
    claimed = None
    if once:
        chosen, st = priority_select(every, once)
        picked.append(written(chosen, "once"))
        stats |= {r["source_id"]: r.asDict() for r in st.collect()}
        fixed = sum(x["selected_tokens"] for x in stats.values())
        claimed = picked[0]
    quotas = recipe.quotas(fixed) if WEIGHTED in kinds else {}
    if quotas:
        chosen, st = priority_select(every, [Part(s.id, quotas[s.id]) for s in order if s.selection == WEIGHTED], claimed)
        picked.append(written(chosen, "weighted"))
        stats |= {r["source_id"]: r.asDict() for r in st.collect()}
    selected = written(picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1]), "selection", by="source_id")
    combined = None
    for source in order:  # the messages of the selected rows, by row id, from the source itself; a source's ids are files of their own
        ids = selected.where(F.col("source_id") == source.id).select(F.col("row_id").alias("_row_id"))
        part = _normalized(raws[source.id].join(ids, "_row_id", "left_semi"), source, recipe, counter).select("_row_id", *CANONICAL)
        combined = part if combined is None else combined.unionByName(part)
    expected = {s.id: (stats[s.id]["selected_rows"], stats[s.id]["selected_tokens"]) for s in order}
    ordered = shuffled(combined, recipe.seed, "source_id", "_row_id", total=sum(r for r, _ in expected.values())).drop("_row_id")
    watched, seen = gates.observed(ordered, list(expected), recipe.min_tokens_per_example, recipe.max_tokens_per_example)
    watched.write.parquet(place.uri(f"{working}/{artifact.TABLE}"))
    gates.check_written(seen.get, expected)
    claims(selected).write.parquet(place.uri(f"{working}/{artifact.CLAIMS}"))
    languages: dict[str, dict[str, int]] = defaultdict(dict)
    for r in gates.language_counts(spark.read.parquet(place.uri(f"{working}/{artifact.TABLE}"))).collect():  # two columns
        languages[r["source_id"]][r["language"]] = r["rows"]
    total = sum(x["selected_tokens"] for x in stats.values())
    described = []
    for i, source in enumerate(order):
        st = stats[source.id]
        gates.check_source(source, reasons[source.id], st["selected_rows"], st["selected_tokens"], len(languages[source.id]))
        described.append(
            {
                "id": source.id, "role": source.role, "language": source.language, "license": source.license, "selection": source.selection,
                "requested_token_share": source.token_share, "token_quota": quotas.get(source.id), "input": asdict(source.input),
                "valid_rows": reasons[source.id].get("ok", 0), "filter_reasons": dict(sorted(reasons[source.id].items())),
                "think_tag_rows": seen.get[f"tagged_{i}"], "language_counts": dict(sorted(languages[source.id].items())),
                "actual_token_share": st["selected_tokens"] / total if total else 0.0, **figures[source.id], **{k: v for k, v in st.items() if k != "source_id"},
            }
        )
    doc = {
        "recipe": recipe.version,
        "recipe_sha256": hashlib.sha256(json.dumps(asdict(recipe), sort_keys=True, default=str).encode()).hexdigest(),
        "repository_git_sha": git_sha, "built_at": artifact.now(), "seed": recipe.seed, "token_counter": counter.name, "model": recipe.model,
        "target_tokens": recipe.target_tokens, "consume_once_tokens": fixed, "selected_tokens": total, "selected_rows": seen.get["rows"],
        "min_tokens_per_example": recipe.min_tokens_per_example, "max_tokens_per_example": recipe.max_tokens_per_example, "sources": described,
    }
    built = artifact.publish(spark, output, working, doc)
    if ledger is not None:
        ledger.append(spark.read.parquet(place.uri(artifact.CLAIMS)), recipe.version)
    return built


def training_rows(spark: SparkSession, place: str | Path, columns: tuple[str, ...] = ("messages",)) -> DataFrame:
    """The rows of a built or promoted artifact in their global order, of which training reads the messages alone."""
    folder = artifact.promoted(spark, place)
    artifact.read_manifest(spark, folder)  # without one there is no artifact
    table = spark.read.parquet(Store(spark, folder).uri(artifact.TABLE))
    return table.select(*columns)


def training_bins(spark: SparkSession, place: str | Path, capacity: int = pack.CAPACITY, seed: int = 0) -> DataFrame:
    """_row_id, token_count, bin, offset of every row of a built or promoted artifact: the packing that training would use.
    Only token counts are read."""
    table = training_rows(spark, place, ("token_count",))
    return pack.packed(with_row_id(table, file_rows(table)), "token_count", "_row_id", capacity, seed)


def validate(spark: SparkSession, recipe: Recipe, output: str | Path, full: bool = True) -> dict:
    """Hold a built artifact against its recipe and manifest; raises at the first break."""
    doc = artifact.read_manifest(spark, output)
    path = Store(spark, output).uri(artifact.TABLE)
    if doc.get("recipe") != recipe.version or doc.get("target_tokens") != recipe.target_tokens:
        raise RecipeError("the manifest is of another recipe")
    if table_digest(spark, path) != doc["output"]["sha256"]:
        raise RecipeError("the table's digest differs from the manifest")
    table = spark.read.parquet(path)
    if table.count() != doc["selected_rows"]:
        raise RecipeError("the table's rows differ from the manifest")
    by_id = {x["id"]: x for x in doc["sources"]}
    gates.check_totals(recipe, {k: x["selected_tokens"] for k, x in by_id.items()})
    for s in recipe.sources:
        x = by_id[s.id]
        if s.selection == ALL_ONCE:
            gates.check_source(s, x["filter_reasons"], x["selected_rows"], x["selected_tokens"], len(x["language_counts"]))
    if missing := gates.missing_columns(table):
        raise RecipeError(f"the table lacks {', '.join(missing)}")
    if not gates.row_violations(table, recipe.min_tokens_per_example, recipe.max_tokens_per_example).isEmpty():
        raise RecipeError("a row doesn't end on the assistant or is out of bounds")
    if full and not gates.repeated(table.select("prompt_hash"), "prompt_hash").isEmpty():
        raise RecipeError("a prompt occurs twice")
    return doc


def audit(spark: SparkSession, recipe: Recipe, root: str | Path, source_ids: list[str], seed_claims: DataFrame | ClaimStore | None = None, counter: TokenCounter | None = None) -> list[dict]:
    """What sources could give beyond claimed prompts, against their quotas; caps are ignored and
    consume-once tokens are the expected ones."""
    unknown = sorted(set(source_ids) - {s.id for s in recipe.sources})
    if unknown:
        raise RecipeError(f"unknown sources {', '.join(unknown)}")
    fixed = sum(s.expected_selected_tokens or 0 for s in recipe.sources if s.selection == ALL_ONCE)
    quotas = recipe.quotas(fixed)
    ledger = seed_claims if isinstance(seed_claims, ClaimStore) else None
    seen = None if seed_claims is None or ledger else seed_claims.select("prompt_hash").distinct()
    out = []
    for source_id in source_ids:
        source = recipe.source(source_id)
        open_source = Source(**{**source.__dict__, "max_input_files": None, "max_raw_rows": None})
        raw, figures = scan(spark, open_source, root)
        rows = written(normalized(raw, source, recipe.min_tokens_per_example, recipe.max_tokens_per_example, counter, keep=("_row_id",)), "audit")
        valid = rows.where("_valid").select("prompt_hash", F.col("_row_id").alias("row_id"), F.col("token_count").alias("tokens"))
        line, seen = capacity(valid, quotas[source_id], seen, ledger)
        reasons = {r["_reason"]: r["n"] for r in rows.groupBy("_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        out.append({"source_id": source_id, "input_rows": figures["input_rows"], **line, "filter_reasons": dict(sorted(reasons.items()))})
    return out


def capacity(rows: DataFrame, quota: int, seen: DataFrame | None, ledger: ClaimStore | None = None) -> tuple[dict, DataFrame]:
    """(figures of one source, prompts seen by now). The first row of a prompt, in row order, counts."""
    firsts = rows.groupBy("prompt_hash").agg(F.min(F.struct("row_id", "tokens"))["tokens"].alias("tokens"))
    firsts = firsts if ledger is None else ledger.unclaimed(written(firsts, "firsts"))
    fresh = written(firsts if seen is None else firsts.join(seen, "prompt_hash", "left_anti"), "fresh")
    total, got = rows.count(), fresh.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()
    line = {
        "valid_rows": total, "unique_rows_after_seed": got["n"], "duplicates_after_seed": total - got["n"], "eligible_tokens_after_seed": int(got["t"]),
        "requested_quota": quota, "headroom_tokens": int(got["t"]) - quota, "sufficient": int(got["t"]) >= quota,
    }
    now = fresh.select("prompt_hash")
    return line, now if seen is None else seen.unionByName(now)
