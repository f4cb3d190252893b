"""Queries over documents and the plain tables: hashes, languages, bands, counts, duplicates, lint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.common import COUNTER, document_rows, sql_document_rows, sql_norm, sql_tokens, table
from millrace.functions import text as X
from millrace.operators import gates, vectors
from millrace.operators.claims import ClaimStore
from millrace.operators.normalize import TRACE, length_reason
from millrace.sources import weights
from millrace.sources.scan import file_rows, head_rows, row_counts
from millrace.sources.storage import scratch, written

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def prompt_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.prompt_hash(F.col("lang"), F.col("text")).alias("prompt_hash"))


def trace_too_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.where(F.char_length(X.strip(F.col("text"))) < TRACE).select("doc_id", F.char_length(X.strip(F.col("text"))).alias("chars"))


def length_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = length_reason(COUNTER.count(F.col("text")), 64, 1024)
    return table(spark, sf_dir, "documents").select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def row_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows get a blank or a null language, so that every branch occurs."""
    d = table(spark, sf_dir, "documents")
    value = F.when(F.col("doc_id") % 7 == 0, F.lit("  ")).when(F.col("doc_id") % 7 == 1, F.lit(None)).otherwise(F.concat(F.lit(" "), "lang"))
    return d.select(X.row_language(value).alias("language")).groupBy("language").agg(F.count(F.lit(1)).alias("rows"))


def accepted_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    accepted = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return d.select("doc_id", F.when(accepted, "ok").otherwise("quality_not_accepted").alias("reason"))


def scan_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row cap by file and place in it, as a source's scan applies it."""
    docs = table(spark, sf_dir, "documents")
    return head_rows(docs, file_rows(docs), 500).select("doc_id", "source", "lang")


def row_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})


def intra_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.select import heads

    return heads(document_rows(spark, sf_dir, banded=False)).select("source_id", "prompt_hash", "row_id", "tokens")


def dup_hash_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.repeated(document_rows(spark, sf_dir, banded=False), "prompt_hash")


def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("lang").alias("language"))
    return gates.language_counts(d)


def language_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy(F.col("source").alias("source_id")).agg(F.count_distinct("lang").alias("languages"))


def cross_claim_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the later sources whose prompt no earlier source holds."""
    rows = document_rows(spark, sf_dir, banded=False)
    early = F.substring("source_id", 4, 9).cast("int") < 10
    claimed = rows.where(early).select("prompt_hash").distinct()
    return rows.where(~early).join(claimed, "prompt_hash", "left_anti").select("source_id", "row_id", "prompt_hash")


def repo_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"))


def expected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of sources held against the same in one fewer source, so that breaks occur."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("lang").alias("language"))
    actual = gates.language_counts(d)
    expected = actual.where(F.col("source_id") != "src0").withColumn("rows", F.when(F.col("language") == "es", F.col("rows") + 1).otherwise(F.col("rows")))
    return gates.mismatches(expected, actual, ["source_id", "language"], "rows")


def sha_commit_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.concat_ws("/", "source", "lang").alias("repo"))
    cut = F.when(F.col("doc_id") % 3 == 0, F.upper(F.substring("sha", 1, 40))).otherwise(F.substring("sha", 1, 40))
    return d.select("doc_id", X.is_commit(cut).alias("is_commit"), X.looks_like_sha256(F.col("sha")).alias("is_sha256"), X.repo_folder(F.col("repo")).alias("folder"))


def tensor_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.audit(table(spark, sf_dir, "embeddings"), "embedding").withColumn("absmax", F.round("absmax", 6))


def tensor_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.audit(table(spark, sf_dir, "embeddings"), "embedding", "label").withColumn("absmax", F.round("absmax", 6))


def weights_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding written as a tensor of weight files and read back by chunks: its values, how many aren't finite, the largest."""
    weights.register(spark)
    where = scratch(spark, "weights")
    vectors_ = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull())
    vectors_.select(F.concat(F.lit("v"), "vec_id").alias("name"), F.col("embedding").alias("values")).write.format("weights").mode("append").save(where)
    each = spark.read.format("weights").option("chunk_values", 48).load(where).select("name", "dtype", F.posexplode_outer("values").alias("at", "x"))
    bad = F.isnan("x") | (F.abs("x") == float("inf"))
    return each.groupBy("name", "dtype").agg(F.count("x").alias("n_values"), F.count_if(bad).alias("nonfinite"), F.round(F.max(F.when(~bad, F.abs("x"))), 6).alias("absmax"))


def claim_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of the persistent claims: the earlier sources claim in two batches, each row of the later ones asks."""
    rows = written(document_rows(spark, sf_dir, banded=False), "ledger-rows")
    number = F.substring("source_id", 4, 9).try_cast("int")
    ledger = ClaimStore(spark, scratch(spark, "ledger"), buckets=32)
    for batch in (0, 1):
        ledger.append(rows.where((number < 10) & (number % 2 == batch)), f"batch-{batch}")
    return ledger.unclaimed(rows.where(F.coalesce(number >= 10, F.lit(True)))).select("source_id", "row_id", "prompt_hash")


QUERIES = {
    f.__name__: f
    for f in (
        prompt_hash, trace_too_short, length_band, row_language, accepted_gate, scan_caps, row_count_gate, intra_dedup, dup_hash_scan, language_counts,
        language_coverage, cross_claim_anti, claim_ledger, repo_patterns, expected_vs_actual, sha_commit_lint, tensor_audit, tensor_inventory, weights_round_trip,
    )
}

_D = sql_document_rows(banded=False)
_AUDIT = """count(*) as tensors, sum(len(embedding))::bigint as "values", sum(len(list_filter(embedding, lambda x: isnan(x))))::bigint as nan,
    sum(len(list_filter(embedding, lambda x: isinf(x))))::bigint as inf, sum(len(list_filter(embedding, lambda x: not isfinite(x))))::bigint as nonfinite,
    round(max(list_max(list_transform(embedding, lambda x: abs(x::double)))), 6) as absmax"""

_CLAIMED = f"""with {_D}, x as (select *, substr(source_id, 4)::int < 10 as early from d)
        select source_id, row_id, prompt_hash from x where not early and prompt_hash not in (select prompt_hash from x where early)"""

ORACLES = {
    "prompt_hash": f"select doc_id, sha256(concat(lang, chr(0), {sql_norm('text')})) as prompt_hash from documents",
    "trace_too_short": f"select doc_id, length(trim(text))::int as chars from documents where length(trim(text)) < {TRACE}",
    "length_band": f"""select case when {sql_tokens("text")} < 64 then 'too_short' when {sql_tokens("text")} > 1024 then 'too_long' else 'ok' end as reason,
        count(*) as rows from documents group by 1""",
    "row_language": "select case doc_id % 7 when 0 then 'unknown' when 1 then 'None' else lang end as language, count(*) as rows from documents group by 1",
    "accepted_gate": """select doc_id, case when coalesce(quality = 1 and toxic = 0, false) then 'ok' else 'quality_not_accepted' end as reason
        from documents left join labels using (doc_id)""",
    "scan_caps": "select doc_id, source, lang from documents order by doc_id limit 500",
    "row_count_gate": " union all ".join(f"select '{t}' as name, count(*) as rows from {t}" for t in TABLES),
    "intra_dedup": f"""with {_D}, x as (select *, row_number() over (partition by source_id, prompt_hash order by key, row_id) as n from d)
        select source_id, prompt_hash, row_id, tokens from x where n = 1""",
    "dup_hash_scan": f"with {_D} select prompt_hash, count(*) as copies from d group by 1 having count(*) > 1",
    "language_counts": "select source as source_id, lang as language, count(*) as rows from documents group by 1, 2",
    "language_coverage": "select source as source_id, count(distinct lang) as languages from documents group by 1",
    "claim_ledger": _CLAIMED,
    "cross_claim_anti": _CLAIMED,
    "repo_patterns": "select lang, string_agg(source, ',' order by source) as sources from (select distinct lang, source from documents) group by lang",
    "expected_vs_actual": """with a as (select source as source_id, lang as language, count(*) as n from documents group by 1, 2),
        e as (select source_id, language, n + case when language = 'es' then 1 else 0 end as n from a where source_id <> 'src0')
        select source_id, language, e.n as expected, a.n as actual from e full join a using (source_id, language) where e.n is distinct from a.n""",
    "sha_commit_lint": """select doc_id, regexp_full_match(case when doc_id % 3 = 0 then upper(substr(sha256(text), 1, 40)) else substr(sha256(text), 1, 40) end, '[0-9a-f]{40}') as is_commit,
        length(sha256(text)) = 64 as is_sha256, replace(source || '/' || lang, '/', '--') as folder from documents""",
    "weights_round_trip": """select 'v' || vec_id as name, 'F32' as dtype, coalesce(len(embedding), 0)::bigint as n_values, coalesce(len(list_filter(embedding, lambda x: not isfinite(x))), 0)::bigint as nonfinite,
        round(list_max(list_transform(list_filter(embedding, lambda x: isfinite(x)), lambda x: abs(x)::double)), 6) as absmax from embeddings where vec_id is not null""",
    "tensor_audit": f"select {_AUDIT} from embeddings",
    "tensor_inventory": f"select label, {_AUDIT} from embeddings group by label",
}
