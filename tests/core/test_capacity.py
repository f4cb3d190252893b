from pyspark.sql import functions as F

from millrace.catalog.common import document_rows
from millrace.catalog.common import sources_of
from millrace.catalog.selection import SOURCES, capacity_audit, mix_select, recipe

DATA = "/root/testdata/sf0.001"


def test_every_source_is_audited(spark):
    """Against a plain walk over all sources with one set of seen prompts."""
    rows = sorted(document_rows(spark, DATA).collect(), key=lambda r: r["row_id"])
    quotas = recipe(sum(r["tokens"] for r in rows) // 2).quotas(0)
    seen = {r["prompt_hash"] for r in rows if r["source_id"] == SOURCES[0]}
    want = []
    for s in SOURCES[1:]:
        own, tokens, unique = [r for r in rows if r["source_id"] == s], 0, 0
        for r in own:
            if r["prompt_hash"] not in seen:
                seen.add(r["prompt_hash"])
                tokens, unique = tokens + r["tokens"], unique + 1
        want.append((s, len(own), unique, len(own) - unique, tokens, quotas[s], tokens - quotas[s], tokens >= quotas[s]))
    assert [tuple(r) for r in capacity_audit(spark, DATA).collect()] == want


def test_sources_come_from_the_data(spark, tmp_path):
    """A source of another name takes part."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = docs.where("source = 'src1'").withColumns({"source": F.lit("other"), "text": F.concat("text", F.lit(" and more")), "doc_id": F.col("doc_id") + 10**6})
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    rows = document_rows(spark, str(tmp_path))
    assert sources_of(rows) == (*SOURCES, "other")
    audit = {r["source_id"]: r for r in capacity_audit(spark, str(tmp_path)).collect()}
    assert set(audit) == {*SOURCES[1:], "other"} and audit["other"]["valid_rows"] > 0
    assert "other" in {r["source_id"] for r in mix_select(spark, str(tmp_path)).collect()}
