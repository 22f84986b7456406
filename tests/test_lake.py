import datetime as dt

from pyspark.sql import functions as F

from odflow import schema as S
from odflow.lake import Lake
from odflow.plans import gold as G
from odflow.plans import pipeline


def _viajes(spark, days, level_rows=None):
    rows = []
    for d in days:
        for lv in ("municipios", "gaus"):
            rows.append((dt.date.fromisoformat(d), 1, lv, 1, 2, 3.0, 100.0))
            rows.append((dt.date.fromisoformat(d), 1, lv, 1, 2, 5.0, 300.0))
    return spark.createDataFrame(rows, S.SILVER_VIAJES)


def _snapshot(df):
    return sorted(tuple(r) for r in df.collect())


def test_zone_reload_twice_equals_once_and_drops_missing_days(spark, scratch):
    lake = Lake(spark, scratch)
    pipeline.write_viajes(lake, _viajes(spark, ["2023-01-01", "2023-01-02"]))
    fewer = _viajes(spark, ["2023-01-01"])
    pipeline.write_viajes(lake, fewer, levels=["gaus"])
    once = _snapshot(lake.read("silver", "viajes"))
    pipeline.write_viajes(lake, fewer, levels=["gaus"])
    assert _snapshot(lake.read("silver", "viajes")) == once
    got = lake.read("silver", "viajes").groupBy("tipo_zona").agg(F.countDistinct("fecha").alias("d"))
    assert sorted(tuple(r) for r in got.collect()) == [("gaus", 1), ("municipios", 2)]


def test_empty_zone_reload_clears_the_zone(spark, scratch):
    lake = Lake(spark, scratch)
    pipeline.write_viajes(lake, _viajes(spark, ["2023-01-01"]))
    pipeline.write_viajes(lake, _viajes(spark, []) if False else spark.createDataFrame([], S.SILVER_VIAJES), levels=["gaus"])
    assert lake.read("silver", "viajes").filter(F.col("tipo_zona") == "gaus").count() == 0
    assert lake.read("silver", "viajes").filter(F.col("tipo_zona") == "municipios").count() == 2


def test_gold_day_reload(spark, scratch):
    lake = Lake(spark, scratch)
    v = _viajes(spark, ["2023-01-01", "2023-01-02", "2023-01-03"])
    G.write_gold(lake, v, "municipios")
    table = "mobility_municipios_periodo"
    g = lake.read("gold", table)
    assert _snapshot(g.select("fecha", "periodo", "total_viajes", "avg_viajes_metros")) == [
        (dt.date(2023, 1, d), "1", 8.0, 200.0) for d in (1, 2, 3)
    ]
    without = v.filter(F.col("fecha") != F.lit("2023-01-02").cast("date"))
    for _ in range(2):
        G.write_gold(lake, without, "municipios", days=["2023-01-02", "2023-01-03", "2023-02-01"])
    assert [r.fecha.day for r in lake.read("gold", table).orderBy("fecha").collect()] == [1, 3]


def test_append_then_overwrite(spark, scratch):
    lake = Lake(spark, scratch)
    v = _viajes(spark, ["2023-01-01"])
    lake.append(v, "silver", "t")
    lake.append(v, "silver", "t")
    assert lake.read("silver", "t").count() == 8
    lake.overwrite(v, "silver", "t")
    assert lake.read("silver", "t").count() == 4


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_gold_by_one_exchange_is_the_same_table(spark, scratch):
    rows = spark.range(5000).selectExpr(
        "date_add(date'2023-01-01', cast(id % 5 as int)) as fecha", "cast(id % 24 as int) as periodo", "'municipios' as tipo_zona",
        "cast(if(id % 3 = 0, 7, id % 40) as int) as id_origen", "cast(id % 31 as int) as id_destino", "cast(id % 9 as double) as viajes", "10D as viajes_metros")
    lake = Lake(spark, scratch)
    lake.overwrite(rows, "silver", "viajes")
    v = lake.read("silver", "viajes")
    assert _exchanges(G.gold_rollup(v, "municipios", one_exchange=True)) == 1
    G.write_gold(lake, v, "municipios")
    two = _snapshot(lake.read("gold", G.ZONES["municipios"].gold_table))
    G.write_gold(lake, v, "municipios", one_exchange=True)
    assert _snapshot(lake.read("gold", G.ZONES["municipios"].gold_table)) == two
    G.write_gold(lake, v.filter("id_origen <> 7"), "municipios", days=["2023-01-02"], one_exchange=True)
    left = lake.read("gold", G.ZONES["municipios"].gold_table)
    assert left.filter("fecha = '2023-01-02' and id_origen = 7").count() == 0 and left.filter("fecha = '2023-01-03' and id_origen = 7").count() > 0


def test_days_are_reloaded_by_one_run_of_the_rows(spark, scratch):
    lake, runs = Lake(spark, scratch), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    days = spark.createDataFrame([(1, "2023-01-01"), (2, "2023-01-02"), (3, "2023-01-02"), (4, None)], "a int, d string")
    rows = days.select("a", F.col("d").cast("date").alias("fecha"))
    lake.replace_days(rows, "s", "t", ["2023-01-01", "2023-01-02"])
    rows = rows.filter("a <> 1 or a is null").mapInPandas(seen, rows.schema)
    lake.replace_days(rows, "s", "t", ["2023-01-01", "2023-01-02"])
    assert sorted(r.a for r in lake.read("s", "t").collect()) == [2, 3]       # the day without rows is emptied
    assert runs.value == 3
