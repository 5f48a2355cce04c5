"""The folder of a finished run: one writer a table, long files compressed, a manifest of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.ranking import METRICS
from tallyloom.sources import files

LABELS = ("topic", "intent", "sentiment", "severity", "evidence_quote", "needs_review", "label_config", "cache_source_id")


def exported(records: DataFrame, label_config: str) -> DataFrame:
    """Records in their export form: completed ones carry their labels, quarantined ones nothing but a reason.

    A null field is left out of the JSON, so a quarantined copy has no pointer.
    """
    completed = F.col("status") == "completed"
    labelled = records.withColumn("label_config", F.lit(label_config))
    reason = F.when(~completed, F.col("reason")).alias("reason")
    return labelled.select("review_id", "text_key", F.when(completed, "completed").otherwise("quarantined").alias("status"), reason, *(F.when(completed, F.col(c)).alias(c) for c in LABELS))


def export_run(spark: SparkSession, folder: str, tables: dict[str, DataFrame], *, label_config: str = "m/p/s/cut-0.70", gzip_over: int = 50_000_000) -> list[str]:
    """Writes the tables of a finished run to ``folder`` and returns the names of the files, each a folder of parts.

    JSON lines of over ``gzip_over`` bytes are compressed and their plain form is
    removed. Pending records or calls without a reason to be so are an error: the run is
    not finished. Only names, sizes and the manifest's few counts come to the driver.
    """
    records, calls = tables["records"], tables["calls"]
    if not records.filter("status IS NULL OR status = 'pending'").isEmpty():
        raise ValueError("records are still pending")
    settled = calls.filter("outcome IN ('succeeded', 'failed')")
    written = []
    lines = {"records.jsonl": exported(records, label_config), "calls.jsonl": settled.select("request_id", "role", "review_ids", "outcome", "input_tokens", "output_tokens")}
    for name, rows in lines.items():
        written.append(files.write_sized(spark, rows, folder, name, gzip_over))
    sheets = {"membership.csv": (tables["membership"], ("issue_id", "review_id")), "ranking.csv": (tables["ranking"], ("rank", "issue_id", *METRICS)), "claims.csv": (tables["claims"], ("claim_id", "issue_id", "metric", "value"))}
    for name, (rows, fields) in sheets.items():
        files.write_csv(rows, f"{folder}/{name}", fields)
        written.append(name)
    for name in ("before", "after"):
        files.write_jsonl(tables[name].select("review_id"), f"{folder}/checkpoint_{name}.json")
        written.append(f"checkpoint_{name}.json")
    files.write_document(records.agg(F.count("*").alias("analysis_count"), F.lit(label_config).alias("label_config"), F.lit(False).alias("allow_multi_issue")), f"{folder}/run.json")
    return [*written, "run.json"]
