"""Summarise the physical plan of every registered query into PLANS.md.

For each query: shuffles (hash / range / single-partition), broadcasts,
join strategies, aggregate kinds, windows, Python stages, and whether the
scans carry pushed filters.  Run: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.config import build_session  # noqa: E402
from cartwheel.plans.queries import ORACLE_SQL, QUERIES  # noqa: E402

COUNTERS = {
    "hash shuffle": r"Exchange hashpartitioning",
    "range shuffle": r"Exchange rangepartitioning",
    "to one partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "broadcast join": r"BroadcastHashJoin",
    "sort-merge join": r"SortMergeJoin",
    "hash agg": r"\bHashAggregate",
    "sort agg": r"\bSortAggregate",
    "object agg": r"ObjectHashAggregate",
    "window": r"\bWindow \[",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


# How each plan behaves with 1000x the data: what is shuffled, how big it
# is, and what happens to a key that holds a third of all rows.
SCALE_NOTES = {
    "revenue_by_category": "items summed per product map-side, one shuffle of partial sums; catalog join sees one row per product on each side (broadcast only if the measured side is small); final group has one row per category",
    "revenue_by_city": "orders summed per customer map-side before the place join; customer join is a sort-merge join of one row per customer; nation/region have a fixed size",
    "abandonment": "one shuffle by session of partial flags (a hot session is one partial row per task); the global count takes one row per task",
    "delivery_status": "partial counts per status, one tiny shuffle",
    "derived_catalog": "min_by partial aggregation per product (sort-based, spills), shuffle of one row per task and product",
    "dedup_stats": "distinct ids are partially aggregated per task before the shuffle by id; repeated ids collapse map-side",
    "dedup_events": "dropDuplicates is a first() aggregation by id: the one event-sized shuffle, unavoidable for a global dedup; repeats collapse map-side",
    "dedup_events_preferred": "min_by over a struct per key, partial per task",
    "order_total": "two partial sums per order map-side; join of one row per order on each side (sort-merge at scale)",
    "item_subtotals": "map-only projection, no shuffle",
    "cart_state": "max_by partial per (user, product)",
    "trending": "each event expands to size/slide windows, counted map-side; the shuffle carries one row per task, window and product",
    "alerts": "as trending, filter on the aggregated counts",
    "trending_lines": "as trending, formatting after the aggregation",
    "id_multiplicity": "one aggregation by id over the union of both sides (partial per task)",
    "reconcile_ids": "as id_multiplicity plus a global sum of partials",
    "missing_rows_except_all": "EXCEPT ALL: union with +1/-1 and one aggregation by id, then replicate the surplus",
    "foreign_ids_anti_join": "two partial distincts, anti join of unique keys",
    "growth": "per-day partial counts; the ordered window runs over one row per day only",
    "growth_ok": "as growth",
    "growth_stalled": "as growth",
    "delivery_report_ok": "as delivery_report",
    "line_counts": "text scan, partial count per file; the names come from the file index",
    "stream_lines_two_runs": "as stream_lines, each stream in its own folder",
    "stream_late_rows": "as stream_lines, one file per micro-batch",
    "csv_original_names": "as revenue_by_category, one small file",
    "parquet_original_names": "as revenue_by_city, one small file",
    "etl_odd_numbers": "as etl_revenue_by_category",
    "etl_odd_numbers_stats": "as etl_dedup_stats",
    "revenue_edge_amounts": "two partial sums per place map-side, one tiny shuffle",
    "kv_upsert": "max_by partial per (row key, column)",
    "kv_store": "each put writes only its cells; a read is one max_by aggregation over the puts, partial per task",
    "kv_row_count": "count of distinct row keys, partial per task",
    "event_type_counts": "text scan, one Arrow-batched Python JSON test per line, partial count by type",
    "delivery_report": "each side's lines go through the JSON test once and are staged as Parquet; one aggregation by file counts lines and bad lines and carries whether the last line is good",
    "delivery_report_totals": "as delivery_report",
    "landed_event_counts": "landing stream copies files (no shuffle), then as event_type_counts",
    "stream_trending": "partial counts per micro-batch, RocksDB state of one number per (window, product); closed windows leave the state",
    "stream_lines": "as stream_trending; lines written per batch id",
    "stream_alert_cells": "as stream_trending; alert cells appended as a key-value delta per batch",
    "alert_cells": "as alerts, exploded into four cells per alert",
    "alert_payloads": "as alerts, one JSON body per alert row",
    "insight_table_category": "the insight result (one row per category) written as one file",
    "csv_revenue_by_city": "the insight result written as one CSV file",
    "kv_category_cells": "insight-sized put",
    "kv_city_cells": "insight-sized put",
    "abandonment_join": "distinct cart sessions and a semi join with the buyers; abandonment does it in one shuffle",
    "dedup_stats_one_pass": "dedup with copy counts: one aggregation by id gives survivors and statistics",
    "etl_revenue_by_category": "JSON parsed once, deduplicated once, staged as Parquet by kind of event (five folders, file sizes by AQE); this insight reads only purchases (and the catalog columns)",
    "etl_revenue_by_city": "staged purchases only (partition pruning), partial sums per place",
    "etl_abandonment": "staged add_to_cart and purchase partitions only",
    "etl_delivery_status": "staged delivery_status partition only, one column",
    "etl_dedup_stats": "sums of the staged copy counts",
    "serving_view_city": "insight-sized table and view",
    "etl_order_totals": "per-row higher-order aggregate over each purchase's items array: map-only, no shuffle",
    "etl_cart_state": "max_by partial per (session, product) over the staged add_to_cart partition",
    "sql_faturamento_categoria": "scan of an insight-sized table through a view",
    "sql_faturamento_cidade": "scan of an insight-sized table through a view",
    "sql_abandono_carrinho": "scan of a one-row table through a view",
    "sql_status_entrega": "scan of an insight-sized table through a view",
    "trending_default_windows": "as trending, with the job's 60 s / 30 s windows",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def summarise(text: str) -> dict[str, object]:
    out: dict[str, object] = {k: len(re.findall(p, text)) for k, p in COUNTERS.items()}
    scans = re.findall(r"FileScan (\w+)", text)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    out["scans"] = ",".join(sorted(set(scans)))
    out["pushed filters"] = sum(1 for p in pushed if p.strip())
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "local[4]",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "false"},
    )
    cols = list(COUNTERS) + ["scans", "pushed filters", "oracle"]
    lines = [
        "# PLANS",
        "",
        "Physical plans of the registered queries (`python tools/plan_report.py`), static",
        "planning (AQE off, so what the optimizer decides before run-time statistics).",
        "Counts are operators in the plan of the returned DataFrame; queries that write",
        "and read back (sinks, streams) show the read-back plan.  The static broadcast",
        "threshold is off in this library's sessions: the broadcasts shown are the two",
        "explicit ones (nation, region); at run time AQE broadcasts a side it has measured",
        "below `spark.sql.adaptive.autoBroadcastJoinThreshold`.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "|---|" + "---|" * len(cols),
    ]
    for name, fn in QUERIES.items():
        s = summarise(plan_text(fn(spark, sf_dir)))
        s["oracle"] = "yes" if name in ORACLE_SQL else "no"
        lines.append(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    lines += ["", "## At 1000x the data", "", "| query | plan at scale |", "|---|---|"]
    for name in QUERIES:
        lines.append(f"| {name} | {SCALE_NOTES.get(name, '')} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
