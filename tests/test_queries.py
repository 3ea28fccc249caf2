"""Every query against its SQL, on the smallest tables, and plan checks."""

import decimal
import re
from datetime import timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import NOW, values
from oracle import SQL
from quaywise.plans import dashboard, facts, forecast, forest, kpi, registry
from quaywise.plans.registry import LINES
from quaywise.plans.sample_warehouse import AS_OF, warehouse

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


# one place of the smallest tables need not have a train at the moment
MAY_BE_EMPTY = {"board_of_station", "board_of_commune", "board_of_region"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def w(spark):
    return warehouse(spark, SF_DIR)


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return repr(value)
    return str(value.normalize()) if isinstance(value, decimal.Decimal) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(row[i])) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    expected = duck.sql(SQL[name])
    assert sorted(result.columns) == sorted(expected.columns)
    found = rows_of(result.columns, result.collect())
    assert found == rows_of(expected.columns, expected.fetchall())
    assert found or name in MAY_BE_EMPTY


def test_every_query_but_the_model_has_sql():
    assert set(registry.queries()) - set(SQL) == {"train_volume_forecast"}


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 10 and sum(r.nb_trains_total for r in rows) > 1000


def test_forecast_covers_the_coming_hours(spark, w):
    rows = entry_module.queries()["train_volume_forecast"](spark, SF_DIR).collect()
    assert max(r["date"] for r in rows) == AS_OF.replace(day=16, hour=23)
    assert len({r["date"] for r in rows}) == len(rows)
    actual = [r.nb_trains_actifs for r in
              forecast.training_set(w, *forecast.recent_window(AS_OF)).collect()]
    assert all(0 <= r["predicted_nb_train"] <= max(actual) for r in rows)


def test_plans_have_no_cross_join_and_no_python(spark):
    """Loops over all pairs and row-wise Python never occur in a query plan."""
    slow = {"train_volume_forecast", "upsert_metrics", "daily_objects", "forecast_grid"}
    for name, query in registry.queries().items():
        if name in slow or name.startswith(("stream_", "siri_", "trip_message")):
            continue
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "BatchEval",
                     "MapInPandas", "FlatMapGroups"):
            assert word not in plan, (name, word)


def test_scans_read_only_the_columns_they_need(w):
    rows = facts.daily_punctuality(w["dwh/f_trips"], None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert schema == "struct<trip_id:string,delay_arrival_minutes:int,is_terminus:boolean>"
    plan = kpi.late_rate(w)._jdf.queryExecution().executedPlan().toString()
    assert "f_trips/" not in plan and "nb_late" in plan


def test_day_filters_reach_the_partitions(w):
    plan = dashboard.lines_table(w, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*20240115", plan)


def test_one_station_and_all(w):
    every = dashboard.station_kpi(w, AS_OF)
    tk = w["dwh/d_station"].where("station_name = 'Supplier 000000003'").first()["tk_station"]
    assert values(dashboard.station_kpi(w, AS_OF, tk)) == values(
        every.where("station_name = 'Supplier 000000003'")
    )
    assert 0 < dashboard.platforms_today(w, AS_OF, tk).count() < dashboard.platforms_today(
        w, AS_OF
    ).count()


def test_one_line_and_some_lines(w):
    keys = {r["line_name"]: r["tk_line"] for r in w["dwh/d_line"].collect()}
    one = dashboard.line_volume(w, AS_OF, keys[LINES[0]])
    assert {r["line_name"] for r in one.collect()} == {LINES[0]}
    two = dashboard.lines_chart(w, AS_OF, [keys[LINES[1]], keys[LINES[2]]])
    assert {r["ligne"] for r in two.collect()} == set(LINES[1:3])
    assert dashboard.line_rates_today(w, AS_OF, keys[LINES[3]]).count() == 1


def test_places_narrow_each_other(w):
    full = dashboard.stations(w).count()
    code = w["ods/ref_departements"].first()
    region, departement = code["code_region"], code["code_departement"]
    by_region = dashboard.stations(w, region).count()
    by_departement = dashboard.stations(w, region, departement).count()
    assert full > by_region >= by_departement > 0
    assert dashboard.stations(w, "-2", "-2", "-2").count() == full
    commune = dashboard.communes(w, region, departement).where("commune_key <> '-2'").first()[0]
    by_commune = dashboard.stations(w, commune=commune.upper()).count()
    assert 0 < by_commune <= full
    assert dashboard.stations_or_all(w, commune=commune).first()["tk_station"] == "-2"
    assert dashboard.departements(w, region).count() <= dashboard.departements(w).count()


def test_board_of_a_station_is_part_of_the_board(w):
    tk = w["dwh/d_station"].where("station_name = 'Supplier 000000003'").first()["tk_station"]
    part = values(dashboard.departure_board(w, AS_OF, station=tk))
    assert set(part) <= set(values(dashboard.departure_board(w, AS_OF)))
    assert all(row[2].startswith("Supplier 000000003") for row in part)


def test_hour_bounds_closed_for_views_and_half_open_for_training(spark, tables):
    """A dwell that ends on the hour counts in both hours of the view, once in training."""
    hour = NOW - timedelta(hours=2)
    late = frame_of_dwell(spark, hour - timedelta(minutes=5), hour)
    tables.reload("dwh/f_trips_realtime", late)
    counts = {r.hour_start.hour: r.nb_trains_actifs for r in
              kpi.trains_per_hour(tables, NOW).collect() if r.nb_trains_actifs}
    assert counts == {9: 1}
    exact = frame_of_dwell(spark, hour, hour)
    tables.reload("dwh/f_trips_realtime", exact)
    counts = {r.hour_start.hour: r.nb_trains_actifs for r in
              kpi.trains_per_hour(tables, NOW).collect() if r.nb_trains_actifs}
    assert counts == {9: 1, 10: 1}


def frame_of_dwell(spark, arrival, departure):
    from conftest import frame

    return frame(spark, "dwh/f_trips_realtime", [{
        "trip_id": "x", "expected_arrival": arrival, "expected_departure": departure,
        "delay_arrival_minutes": 1,
    }])


def test_training_counts_against_a_loop(spark, w):
    first, last = forecast.yesterday_window(AS_OF)
    stops = [
        (r.trip_id, r.a, r.d)
        for r in w["dwh/f_trips"].select(
            "trip_id",
            forecast.times.keys_to_ts(
                F.col("expected_arrival_date_tk"), F.col("expected_arrival_time_tk")
            ).alias("a"),
            forecast.times.keys_to_ts(
                F.col("expected_departure_date_tk"), F.col("expected_departure_time_tk")
            ).alias("d"),
        ).collect()
    ]
    rows = forecast.training_set(w, first, last).collect()
    assert len(rows) == 47
    for row in rows:
        end = row.hour_start + timedelta(hours=1)
        active = {t for t, a, d in stops if a and d and d < end and a >= row.hour_start}
        assert row.nb_trains_actifs == len(active)


def test_split_and_overlapping_sets(spark, w):
    rows = forecast.training_set(w, *forecast.yesterday_window(AS_OF))
    unique = forecast.unique_hours(rows.unionByName(rows))
    assert unique.count() == 47
    train, test = forecast.split_by_time(unique)
    assert (train.count(), test.count()) == (37, 10)
    latest = train.agg(F.max("hour_start")).first()[0]
    assert latest < test.agg(F.min("hour_start")).first()[0]


def test_nodes_of_the_forest_recompute_its_predictions(spark, w, duck, folder):
    """The stored nodes, walked by another engine, give what the model predicts."""
    past, models = forecast.training_set(w, *forecast.recent_window(AS_OF)), folder("models")
    model, metadata = forecast.fit(past, AS_OF)
    forecast.save(model, metadata, models)
    grid = forecast.future_grid(w, metadata.first()["trained_until"], AS_OF)
    nodes = forest.read_nodes(spark, f"{models}/models/{metadata.first()['model_name']}")
    assert nodes.select("tree").distinct().count() == forecast.TREES
    expected = {r["hour_start"]: r["prediction"] for r in forecast.raw_predictions(model, grid).collect()}
    by_joins = forest.predictions(nodes, grid, "hour_start", forecast.FEATURES, forecast.DEPTH).collect()
    assert {r["hour_start"]: pytest.approx(r["prediction"]) for r in by_joins} == expected
    duck.register("nodes", nodes.toPandas())
    duck.register("hours", grid.select("hour_start", *(F.col(c).cast("double") for c in forecast.FEATURES)).toPandas())
    found = duck.sql(f"""
        with recursive walk as (
          select hour_start, [{", ".join(forecast.FEATURES)}] x, tree, 0 node
          from hours, (select distinct tree from nodes)
          union all
          select hour_start, x, tree, cast(case when x[cast(feature as int) + 1] <= threshold
            then left_node else right_node end as int)
          from walk join nodes using (tree, node) where left_node is not null and not isnan(left_node))
        select hour_start, avg(value) from walk join nodes using (tree, node)
        where left_node is null or isnan(left_node) group by 1""").fetchall()
    assert {h: pytest.approx(p) for h, p in found} == expected
