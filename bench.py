"""Headline queries at one scale; prints one JSON line.

Each query runs twice into the noop sink (every row is computed, none is
collected) and the faster run counts, plan building included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "mask_customer_analyst", "mask_levels_all_on_email", "masked_views_by_role", "effective_levels",
    "rate_breaches", "rate_breaches_hourly", "time_window_breaches",
    "classify_documents", "classify_leaf_targets", "detect_entities", "profile_columns",
    "resolve_status", "findings_rollup", "propose_tags", "job_summary",
    "vault_tokenize", "detokenize", "tokenize_roundtrip_count", "delete_and_retokenize", "fpe_encrypt",
    "fpe_encrypt_distinct", "fpe_roundtrip",
    "search_audits_top", "search_audits_columns", "audit_summary_cube", "explode_audit_columns",
    "read_audit_events", "ingest_postgres_log",
    "report_filters", "report_window", "expand_cron_january", "throttle_triggers", "throttle_triggers_dense",
    "grants_expand", "expand_oltp_grants", "compliance_diff", "unauthorised_accesses", "request_state",
    "latest_instances", "patch_rows", "latest_version", "apply_tombstones",
    "stream_rate_breaches", "stream_throttle",
)


def main() -> None:
    from wardlake.plans import QUERIES
    from wardlake.session import build_session

    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false", "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in wanted:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name].run(spark, base).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(base.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
