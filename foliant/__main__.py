"""python -m foliant SF_DIR QUERY|STAGE [OUT]: run a registered query, or all queries of a stage; show them or write
each as Parquet below OUT. A query that fails is logged, the others run, and the exit code tells."""
from __future__ import annotations

import logging
import sys

from pyspark.sql import SparkSession

from foliant.plans import registry

log = logging.getLogger("foliant")

#: The stages of the archive's processing, in order, and the queries that each of them is.
STAGES = {
    "inventory": ("library_scan", "health_probe", "inventory_records", "readable_items"),
    "extract": ("page_reader", "page_text_records", "page_feature_records", "document_rollup", "extraction_report"),
    "classify": ("part_classifier", "part_labels", "piece_rollup", "classification_report"),
    "expected": ("slot_normalization", "slot_greedy_match", "completeness", "expected_report"),
    "quality": ("page_rules", "doc_quality_score", "quality_metrics", "quality_report"),
    "pieces": ("detected_documents", "piece_records", "piece_report", "report_index"),
    "collection": ("collection_totals", "pieces_index", "collection_dashboard"),
    "review": ("priority_queue", "review_entries", "review_pack"),
    "site": ("site_pieces", "site_documents", "manifest", "data_module"),
    "export": ("csv_round_trip", "workbook", "metric_rows", "glossary"),
}


def run(spark: SparkSession, sf_dir: str, name: str, out: str | None) -> bool:
    """Whether a query ran."""
    try:
        df = registry.queries()[name](spark, sf_dir)
        if out:
            df.write.mode("overwrite").parquet(out)
            log.info("%s: wrote %s", name, out)
        else:
            df.show(50, truncate=60)
        return True
    except Exception:
        log.exception("%s failed", name)
        return False


def main(args: list[str]) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    queries = registry.queries()
    if len(args) < 2 or args[1] not in {*queries, *STAGES}:
        print(__doc__, "\nStages:", *STAGES, "\nQueries:", *sorted(queries), sep="\n  ")
        return 2
    spark = SparkSession.builder.appName(f"foliant {args[1]}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = args[2] if len(args) > 2 else None
    if args[1] in queries:
        return 0 if run(spark, args[0], args[1], out) else 1
    done = [run(spark, args[0], q, f"{out}/{q}" if out else None) for q in STAGES[args[1]]]
    return 0 if all(done) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
