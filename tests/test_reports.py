import os

from pyspark.sql import functions as F

from odflow.lake import Lake
from odflow.params import MobilityParams
from odflow.plans import reports
from odflow.plans.pipeline import build_all
from odflow.sources import fixtures as fx
from odflow.sources.fixture_lake import fixture_inputs

SF = "/root/testdata/sf0.001"


def test_question_runs_write_their_tables(spark, scratch):
    lake = Lake(spark, os.path.join(scratch, "lake"))
    build_all(lake, fixture_inputs(spark, SF))
    p = MobilityParams(fx.RECT_WKT, "2023-01-01", "2023-01-14", "municipios")

    bq3 = reports.run_bq3(lake, p)
    assert bq3["ranking"].count() >= 1
    assert os.path.exists(os.path.join(lake.path("gold", "bq3/points"), "_SUCCESS"))
    lines = [r.value for r in spark.read.text(lake.path("gold", "bq3/report_lines")).collect()]
    assert len(lines) == bq3["ranking"].count() and lines[0].startswith("- ")

    bq2 = reports.run_bq2(lake, p)
    assert bq2["critical_routes"].count() == 15 and bq2["mismatch_chart"].count() == 10
    top = bq2["critical_routes"].agg(F.max("weighted_mismatch")).first()[0]
    assert top == bq2["scored_pairs"].agg(F.max("weighted_mismatch")).first()[0]

    bq1 = reports.run_bq1(lake, p)
    assert bq1["day_clusters"].count() == 14
    assert bq1["cluster_profile"].agg(F.sum("n_days")).first()[0] == 14
