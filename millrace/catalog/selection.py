"""Queries of the mixture: orders, quotas, priority selection, statistics, shares, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.catalog.common import SEED, document_rows, sources_of, sql_document_rows
from millrace.operators import gates, pack
from millrace.operators.rank import ranked, until_quota
from millrace.operators.select import Part, order_key, priority_select
from millrace.plans.recipe import ALL_ONCE, WEIGHTED, Recipe, Source
from millrace.sources.storage import written

#: The sources of the test tables, over which the SQL of the walk is written out; the queries take theirs from the data.
SOURCES = tuple(f"src{i}" for i in range(20))
SHARE = 1 / len(SOURCES)
#: Shares of the target that the first sources get.
QUOTA_SHARES = (0.27, 0.205, 0.325, 0.035, 0.02, 0.07, 0.075)


def recipe(target: int, found: Sequence[str] = SOURCES, order: Sequence[str] | None = None, once: Sequence[str] = ()) -> Recipe:
    """Equal shares of all weighted sources."""
    weighted = [s for s in found if s not in once]
    sources = tuple(Source(s, selection=ALL_ONCE) if s in once else Source(s, selection=WEIGHTED, token_share=1 / len(weighted)) for s in found)
    return Recipe(sources, target, selection_order=tuple(order or found))


def _target(rows: DataFrame) -> int:
    """Half of the tokens there are."""
    return (rows.agg(F.sum("tokens").alias("t")).first()["t"] or 0) // 2


def _mix(spark: SparkSession, sf_dir: str, back: bool = False) -> tuple[DataFrame, DataFrame, Recipe]:
    rows = written(document_rows(spark, sf_dir), "mix-rows")
    found = sources_of(rows)
    plan = recipe(_target(rows), found, found[::-1] if back else None)
    quotas = plan.quotas(0)
    selected, stats = priority_select(rows, [Part(s.id, quotas[s.id]) for s in plan.ordered()], strict=False)
    return selected, stats, plan


def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_rows(spark, sf_dir, banded=False).select("source_id", "row_id", "key")
    return ranked(rows, ["source_id"], "key", ["row_id"]).drop("key")


def running_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(document_rows(spark, sf_dir), "quota-rows")  # read several times
    return until_quota(rows, "source_id", "key", "row_id", "tokens", 10_000).select("source_id", "row_id", "tokens")


def mix_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def mix_select_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir, back=True)[0]


def mix_fixed_then_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source is consumed whole, the others share what the target leaves."""
    rows = written(document_rows(spark, sf_dir), "mix-rows")
    found = sources_of(rows)
    plan = recipe(_target(rows), found, once=found[:1])
    once, stats = priority_select(rows, [Part(found[0], None)])
    fixed = stats.first()["selected_tokens"]
    quotas = plan.quotas(fixed)
    once = written(once, "mix-once")
    rest, _ = priority_select(rows, [Part(s, quotas[s]) for s in found[1:]], claimed=once, strict=False)
    return once.unionByName(rest)


def selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def weighted_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats, plan = _mix(spark, sf_dir)
    shares = gates.token_shares(stats.withColumn("selection", F.lit(WEIGHTED)))
    ok = gates.within(F.col("weighted_share"), F.lit(1 / len(plan.sources)), plan.token_share_tolerance)
    return shares.select("source_id", F.round("actual_share", 6).alias("actual_share"), F.round("weighted_share", 6).alias("weighted_share"), ok.alias("within"))


def quota_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas of the first sources, by uneven shares of half of all tokens; the last one takes the remainder."""
    rows = document_rows(spark, sf_dir).select("source_id", "tokens")
    plan = Recipe(tuple(Source(s, token_share=share) for s, share in zip(sources_of(rows), QUOTA_SHARES, strict=False)), _target(rows))
    return spark.createDataFrame(list(plan.quotas(0).items()), "source_id string, quota long")


def capacity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source after the first one, in selection order, against what the first one and those before it hold.

    A prompt counts for the first source that holds it, by its first row there, so one aggregate serves all sources.
    """
    rows = written(document_rows(spark, sf_dir), "audit-rows")
    plan = recipe(_target(rows), sources_of(rows))
    quotas, order = plan.quotas(0), [s.id for s in plan.ordered()]
    turn = F.array_position(F.array(*map(F.lit, order)), F.col("source_id")).alias("turn")
    audited = rows.select(turn, "prompt_hash", "row_id", "tokens").where("turn > 0")
    valid = {r["turn"]: r["n"] for r in audited.groupBy("turn").agg(F.count(F.lit(1)).alias("n")).collect()}
    firsts = audited.groupBy("prompt_hash").agg(F.min(F.struct("turn", "row_id", "tokens")).alias("f"))
    fresh = {r["turn"]: r for r in firsts.groupBy("f.turn").agg(F.count(F.lit(1)).alias("n"), F.sum("f.tokens").alias("t")).collect()}
    out = []
    for i, s in enumerate(order[1:], 2):
        total, unique, tokens = valid.get(i, 0), fresh[i]["n"] if i in fresh else 0, int(fresh[i]["t"]) if i in fresh else 0
        out.append((s, total, unique, total - unique, tokens, quotas[s], tokens - quotas[s], tokens >= quotas[s]))
    kinds = "valid_rows long, unique_rows long, duplicates long, eligible_tokens long, quota long, headroom long, sufficient boolean"
    return spark.createDataFrame(out, f"source_id string, {kinds}")


def union_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected rows with their place in the global order."""
    rows = _mix(spark, sf_dir)[0].withColumn("key", order_key(SEED, F.concat_ws(":", "source_id", "row_id")))
    return ranked(rows, [], "key", ["source_id", "row_id"]).select("source_id", "row_id", "pos")


def share_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each source before selection, as shares of all. The window runs over sources."""
    per = document_rows(spark, sf_dir).groupBy("source_id").agg(F.sum("tokens").alias("tokens"))
    return per.withColumn("share", F.round(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), 6))


def packing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands in bins of the training length."""
    rows = written(document_rows(spark, sf_dir, banded=False).where(F.col("tokens").between(1, pack.CAPACITY)).select("row_id", "tokens"), "pack-rows")
    return pack.packed(rows, seed=SEED)


def packing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the plan: all rows and tokens are in it, no bin is overfull, no rows overlap, and the bins are at most 11 for
    each 9 that there must be at least, by the tokens and by the rows of over half a bin."""
    plan = written(packing_plan(spark, sf_dir), "pack-plan")
    large = plan.where(F.col("tokens") * 2 > pack.CAPACITY).count()
    bound = F.greatest(F.ceil(F.col("tokens") / pack.CAPACITY), F.lit(large))
    return pack.filled(plan).select("rows", "tokens", "overfull", "overlapping", bound.alias("least_bins"), (F.col("bins") >= bound).alias("enough"), (F.col("bins") * 9 <= bound * 11 + 9).alias("tight"))


QUERIES = {
    f.__name__: f
    for f in (
        packing_plan, packing_totals, seeded_order, running_quota, mix_select, mix_select_priority, mix_fixed_then_weighted, selection_stats, weighted_shares, quota_table, capacity_audit,
        union_shuffle, share_check,
    )
}

_D = sql_document_rows()


def _walk(order: Sequence[str], once: Sequence[str] = ()) -> str:
    """Common table expressions that repeat the walk over sources, ending in one named picked."""
    weighted = [s for s in SOURCES if s not in once]
    share = 1 / len(weighted) if once else SHARE
    ctes = ["d as materialized (select * from raw)", "goal as (select sum(tokens)::bigint // 2 as t from d)"]
    done: list[str] = []
    quota = {s: f"(select round_even(t * {share!r}::double, 0)::bigint from left_over)" for s in weighted[:-1]}
    last = " - ".join(["(select t from left_over)", *[quota[s] for s in weighted[:-1]]])
    quota[weighted[-1]] = f"({last})"
    fixed_done = not once
    if fixed_done:
        ctes.append("left_over as (select t from goal)")
    for i, s in enumerate(order):
        taken = " union all ".join(f"select prompt_hash from s{j}" for j in range(i)) or "select ''"
        if s not in once and not fixed_done:
            ctes.append("left_over as (select t - (select sum(tokens) from s0)::bigint as t from goal)")
            fixed_done = True
        ctes.append(
            f"""c{i} as (select *, sum(tokens) over (order by key, row_id rows between unbounded preceding and 1 preceding) as before, row_number() over (order by key, row_id) as n
              from (select *, row_number() over (partition by prompt_hash order by key, row_id) as copy, row_number() over (order by key, row_id) as pos
                    from d where source_id = '{s}') where copy = 1 and prompt_hash not in ({taken}))"""
        )
        keep = "true" if s in once else f"coalesce(before, 0) < {quota[s]} or n = 1"
        ctes.append(f"s{i} as materialized (select source_id, row_id, prompt_hash, tokens, pos from c{i} where {keep})")
        done.append(f"select * from s{i}")
    ctes.append(f"picked as materialized ({' union all '.join(done)})")
    raw = _D.replace("d as (", "raw as materialized (", 1)
    return f"with {raw}, " + ", ".join(ctes)


_PICK = " select source_id, row_id, prompt_hash, tokens from picked"
_STATS = """stats as (select source_id, count(*) as selected_rows, sum(tokens)::bigint as selected_tokens,
    max(pos) as last_pos from picked group by source_id)"""
_MIX = _walk(SOURCES)

ORACLES = {
    "seeded_order": f"with {sql_document_rows(banded=False)} select source_id, row_id, row_number() over (partition by source_id order by key, row_id) as pos from d",
    "running_quota": f"""with {_D}, x as (select *, sum(tokens) over (partition by source_id order by key, row_id rows between unbounded preceding and 1 preceding) as before from d)
        select source_id, row_id, tokens from x where coalesce(before, 0) < 10000""",
    "mix_select": _MIX + _PICK,
    "mix_select_priority": _walk(SOURCES[::-1]) + _PICK,
    "mix_fixed_then_weighted": _walk(SOURCES, once=SOURCES[:1]) + _PICK,
    "selection_stats": f"{_MIX}, {_STATS} select source_id, selected_rows, selected_tokens, last_pos - selected_rows as duplicates_skipped from stats",
    "weighted_shares": f"""{_MIX}, {_STATS}, x as (select source_id, selected_tokens / sum(selected_tokens) over () as share from stats)
        select source_id, round(share, 6) as actual_share, round(share, 6) as weighted_share, abs(share - 0.05::double) <= 0.0025::double as "within" from x""",
    "quota_table": f"""with {_D}, goal as (select sum(tokens)::bigint // 2 as t from d),
        q as (select unnest(range({len(QUOTA_SHARES)})) as i, unnest([{", ".join(f"{s}::double" for s in QUOTA_SHARES)}]) as share),
        n as (select source_id, row_number() over (order by substr(source_id, 4)::int, source_id) - 1 as i from (select distinct source_id from d)),
        r as (select i, source_id, round_even(t * share, 0)::bigint as quota from q join n using (i) cross join goal),
        z as (select max(i) as i from r)
        select source_id, case when r.i < z.i then quota else (t - (select sum(quota) from r, z where r.i < z.i))::bigint end as quota from r cross join z cross join goal""",
    "capacity_audit": f"""with {_D}, f as (select *, row_number() over (partition by source_id, prompt_hash order by row_id) as copy,
            dense_rank() over (order by substr(source_id, 4)::int, source_id) - 1 as s from d),
        m as (select max(s) as last, count(distinct s) as n, sum(tokens)::bigint // 2 as t from f),
        e as (select *, round_even(t * (1 / n)::double, 0)::bigint as share from m),
        u as (select s, tokens from f x where copy = 1 and s > 0 and not exists (select 1 from f y where y.s < x.s and y.prompt_hash = x.prompt_hash)),
        v as (select s, source_id, count(*) as valid_rows from f where s > 0 group by 1, 2),
        a as (select s, count(*) as n, sum(tokens)::bigint as t from u group by s),
        q as (select v.s, source_id, valid_rows, coalesce(a.n, 0) as unique_rows, coalesce(a.t, 0)::bigint as eligible_tokens,
            case when v.s = e.last then e.t - share * e.last else share end::bigint as quota from v left join a on a.s = v.s cross join e)
        select source_id, valid_rows, unique_rows, valid_rows - unique_rows as duplicates, eligible_tokens, quota, eligible_tokens - quota as headroom, eligible_tokens >= quota as sufficient
        from q""",
    "packing_totals": f"""with {sql_document_rows(banded=False)}, x as (select count(*) as n, sum(tokens)::bigint as t, count(*) filter (where tokens * 2 > {pack.CAPACITY}) as large from d where tokens between 1 and {pack.CAPACITY})
        select n as rows, t as tokens, 0::bigint as overfull, 0::bigint as overlapping, greatest(ceil(t / {pack.CAPACITY})::bigint, large) as least_bins, true as enough, true as tight from x""",
    "union_shuffle": f"""{_MIX} select source_id, row_id, row_number() over (order by md5(concat('{SEED}:', source_id, ':', row_id::varchar)), source_id, row_id) as pos from picked""",
    "share_check": f"""with {_D}, x as (select source_id, sum(tokens)::bigint as tokens from d group by 1) select *, round(tokens / sum(tokens) over (), 6) as share from x""",
}
