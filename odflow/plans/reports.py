"""Business-question runs that write their result tables (SNK-8, SNK-9).

Each run writes to ``<lake>/gold/<bq>/<name>``: the tables behind the
charts, maps and report of the question, plus the report lines as text.
Intermediate results used by several outputs (the BQ2 scored pairs, the
BQ3 ranking) are written once and read back, so they are not recomputed
per output and a retried output does not repeat the fact scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.functions.scalar import fixed_decimals, latin1_text
from odflow.lake import Lake
from odflow.params import MobilityParams, resolve_gold_table
from odflow.plans import questions as Q


def _inputs(lake: Lake, p: MobilityParams):
    gold = lake.read("gold", resolve_gold_table(p.tipo_zona))
    return gold, lake.read("silver", "lugares")


def _save(lake: Lake, df: DataFrame, bq: str, name: str) -> DataFrame:
    lake.overwrite(df, "gold", f"{bq}/{name}")
    return lake.read("gold", f"{bq}/{name}")


def _save_lines(lake: Lake, lines: DataFrame, bq: str, name: str) -> None:
    lines.coalesce(1).write.mode("overwrite").text(lake.path("gold", f"{bq}/{name}"))


def run_bq1(lake: Lake, p: MobilityParams) -> dict[str, DataFrame]:
    """Day clusters by hourly profile: hourly totals, day labels, cluster profiles."""
    gold, lugares = _inputs(lake, p)
    hourly = _save(lake, Q.bq1_hourly_profile(gold, lugares, p), "bq1", "hourly_profile")
    if hourly.isEmpty():
        return {"hourly_profile": hourly}
    clusters = _save(lake, Q.bq1_day_clusters(hourly, p.k, p.seed), "bq1", "day_clusters")
    profile = _save(lake, Q.cluster_profile(clusters), "bq1", "cluster_profile")
    return {"hourly_profile": hourly, "day_clusters": clusters, "cluster_profile": profile}


def run_bq2(lake: Lake, p: MobilityParams) -> dict[str, DataFrame]:
    """Gravity mismatch: scored pairs, map (bottom 50), chart (top 10), critical routes (top 15)."""
    gold, lugares = _inputs(lake, p)
    base = Q.bq2_od_base(gold, lugares, lake.read("silver", "poblacion"), lake.read("silver", "renta"), p)
    base = _save(lake, base, "bq2", "od_base")      # scored against its own global sums: the fact is read once
    scored = _save(lake, Q.gravity_mismatch(base), "bq2", "scored_pairs")
    out = {
        "scored_pairs": scored,
        "mismatch_map": _save(lake, Q.bq2_ranking(scored, Q.BQ2_MAP_ROWS, ascending=True), "bq2", "mismatch_map"),
        "mismatch_chart": _save(lake, Q.bq2_ranking(scored, Q.BQ2_CHART_ROWS, ascending=False), "bq2", "mismatch_chart"),
        "critical_routes": _save(lake, Q.bq2_ranking(scored, Q.BQ2_LIST_ROWS, ascending=False), "bq2", "critical_routes"),
    }
    lines = Q.bq2_ranking(out["critical_routes"], Q.BQ2_LIST_ROWS, ascending=False).select(
        F.format_string("%s -> %s | Weighted mismatch: %s", latin1_text(F.col("origen")),
                        latin1_text(F.col("destino")), fixed_decimals("weighted_mismatch", 4)).alias("value")
    )
    _save_lines(lake, lines, "bq2", "report_lines")
    return out


def run_bq3(lake: Lake, p: MobilityParams) -> dict[str, DataFrame]:
    """Industrial places: ranking, hourly volumes, flows, labelled points (nothing more if the ranking is empty)."""
    gold, lugares = _inputs(lake, p)
    calendario = lake.read("silver", "calendario")
    ranking = _save(lake, Q.bq3_ranking(gold, lugares, calendario, p), "bq3", "ranking")
    out = {"ranking": ranking}
    if ranking.isEmpty():
        return out
    out["hourly"] = _save(lake, Q.bq3_hourly(gold, lugares, calendario, ranking, p), "bq3", "hourly")
    out["flows"] = _save(lake, Q.bq3_flows(gold, lugares, ranking, p), "bq3", "flows")
    out["points"] = _save(lake, Q.bq3_points(lugares, ranking, p), "bq3", "points")
    lines = ranking.orderBy(F.col("ratio").desc_nulls_last(), "nombre").select(
        F.format_string("- %s: Ratio %s", latin1_text(F.col("nombre")), fixed_decimals("ratio", 2)).alias("value")
    )
    _save_lines(lake, lines, "bq3", "report_lines")
    return out
