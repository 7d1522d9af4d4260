"""The registered queries: every operator on the shared test tables, whole tables throughout.

Each query takes (spark, sf_dir). Results carry rounded doubles (six places unless the
values often end just there) and timestamps without zone, so that they can be compared
with SQL on the same tables.
"""

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrisk.functions import basis, geo, timefn
from windrisk.operators import correlation, diagnostics, energy, features, fit_ledger, hsgp, ranks, risk, snapshots, spatial, zone_search
from windrisk.plans import adapters, forecasting, serve
from windrisk.session import configure, store, work_path
from windrisk.sources import binary_grid, calendar, files, gates, kafka, market_xml, sinks, topic, versions
from windrisk.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLACES = 6


def tidy(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded (without a negative zero), instants as zone-less timestamps."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "double":
            column = F.round(column, places) + F.lit(0.0)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def query(name: str, places: int = PLACES):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(configure(spark), sf_dir), places)
        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        return build
    return register


def _flags(spark: SparkSession, **values) -> DataFrame:
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def _zone_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = adapters.zone_draws(spark, sf_dir)
    stamp = F.timestamp_seconds(F.lit(1704067200) + F.col("horizon_h") * 3600)
    return risk.forecasts(draws, issued_for=stamp)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshots(adapters.obs(spark, sf_dir), hourly=True)


# --- Sources --------------------------------------------------------------------------

@query("s1_weather_files")
def s1_weather_files(spark, sf_dir):
    path = work_path(spark, "grid")
    adapters.grid(spark, sf_dir).write.partitionBy("file_id").parquet(path)
    grid = files.weather_grid(spark, path)
    return (grid.groupBy(F.regexp_extract("file_id", r"file_id=(\d+)", 1).cast("int").alias("file_id"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("u10").alias("u10"), F.sum("latitude").alias("latitude"),
                 F.max("timestamp").alias("last_timestamp")))


@query("s2_time_column")
def s2_time_column(spark, sf_dir):
    path = work_path(spark, "grid")
    adapters.grid(spark, sf_dir).drop("file_id").withColumnRenamed("timestamp", "valid_time").write.parquet(path)
    return files.weather_grid(spark, path).groupBy("timestamp").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("u10").alias("u10"))


def _energy_csv(spark, sf_dir):
    folder = work_path(spark, "energy")
    rows = adapters.energy(spark, sf_dir)
    text = rows.select(
        timefn.iso_text(F.col("timestamp")).alias("timestamp"), "region_id", "variable",
        F.when(F.col("file_id") == 7, F.lit("bad")).otherwise(F.col("value_mwh").cast("string")).alias("value_mwh"))
    is_load = F.col("variable") == "load_mwh"
    sinks.write_energy_csv(text.where(~is_load), f"{folder}/generation")
    sinks.write_energy_csv(text.where(is_load), f"{folder}/load")
    return files.energy_csv(spark, f"{folder}/generation", f"{folder}/load")


@query("s3_energy_csv")
def s3_energy_csv(spark, sf_dir):
    good = energy.normalise(files.good_rows(_energy_csv(spark, sf_dir)))
    return good.groupBy("timestamp", "region_id", "variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value_mwh").alias("value_mwh"))


@query("s3_bad_lines")
def s3_bad_lines(spark, sf_dir):
    return files.bad_rows(_energy_csv(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_bad"))


@query("s4_market_xml")
def s4_market_xml(spark, sf_dir):
    """Generation and load documents in one scan, told apart by their production type."""
    return market_xml.points(adapters.xml_docs(spark, sf_dir))


@query("s5_acknowledgements")
def s5_acknowledgements(spark, sf_dir):
    return market_xml.acknowledgements(adapters.error_docs(spark, sf_dir)).groupBy(
        "region_id", "reason", "is_error").agg(F.count(F.lit(1)).alias("n_docs"))


@query("s6_silver_alias")
def s6_silver_alias(spark, sf_dir):
    path = work_path(spark, "silver")
    adapters.obs(spark, sf_dir).withColumnRenamed("wind_speed_mps", "wind_speed").write.parquet(path)
    return files.silver_weather(spark, path)


@query("s7_silver_or_table")
def s7_silver_or_table(spark, sf_dir):
    """One read finds Silver, the other falls back to the table."""
    path = work_path(spark, "silver")
    rows = adapters.obs(spark, sf_dir)
    rows.write.parquet(path)
    view = f"weather_obs_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    found = files.weather_or_table(spark, path, view)
    missing = files.weather_or_table(spark, f"{path}-absent", view)
    return found.unionByName(missing).groupBy("source", "region_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("wind_speed_mps").alias("wind"))


@query("s8_table_scan")
def s8_table_scan(spark, sf_dir):
    view = f"weather_obs_{uuid.uuid4().hex}"
    adapters.obs(spark, sf_dir).createOrReplaceTempView(view)
    return files.weather_table(spark, view, ordered=True)


@query("s9_decode_messages")
def s9_decode_messages(spark, sf_dir):
    """Rows encoded for a topic and decoded again."""
    rows = adapters.obs(spark, sf_dir).withColumn("event_id", F.lit(0))
    messages = kafka.encode(rows.select("timestamp", "region_id", "wind_speed_mps")).select(
        "value", F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"))
    return kafka.decode(messages).select("timestamp", "region_id", "wind_speed_mps")


@query("s9_replayed_topic")
def s9_replayed_topic(spark, sf_dir):
    """A stream that copies a topic, stopped half-way and started again: each row once, offsets without gaps."""
    source, copy, checkpoint = (work_path(spark, n) for n in ("topic", "topic-copy", "topic-checkpoint"))
    rows = _ordered_obs(spark, sf_dir)
    for half in (0, 1):
        topic.append(rows.where(F.col("event_id") % 2 == half), source, "region_id")
        found = topic.rows_of(topic.stream(spark, source), EVENT).drop("partition", "offset")
        topic.publish(found, copy, checkpoint, "region_id", "copy").awaitTermination()
    found = topic.rows_of(topic.read(spark, copy), EVENT)
    parts = found.groupBy("region_id", "partition").agg(F.count("*").alias("n"), F.countDistinct("offset").alias("n_offsets"),
                                                        F.max("offset").alias("last"), F.sum("wind_speed_mps").alias("total"))
    # A window over whole partitions of the topic would hold one of them in a task; it sees a row for each zone.
    whole = Window.partitionBy("partition")
    dense = parts.withColumn("dense", F.max("last").over(whole) + 1 == F.sum("n").over(whole))
    return dense.groupBy("region_id").agg(F.sum("n").alias("n_rows"), F.sum("n_offsets").alias("n_offsets"),
                                          F.bool_and("dense").alias("dense"), F.round(F.sum("total"), 4).alias("total"))


@query("s10_gold_forecasts")
def s10_gold_forecasts(spark, sf_dir):
    path = work_path(spark, "gold")
    assert files.gold_forecasts(spark, path) is None
    sinks.overwrite_parquet(_zone_forecasts(spark, sf_dir), path, ("region_id", "horizon_h"))
    return files.gold_forecasts(spark, path)


# --- Sinks and gates ------------------------------------------------------------------

@query("k1_overwrite_silver")
def k1_overwrite_silver(spark, sf_dir):
    path = work_path(spark, "silver")
    weather = spatial.silver_weather(adapters.grid(spark, sf_dir))
    sinks.overwrite_parquet(adapters.obs(spark, sf_dir), path)
    sinks.overwrite_parquet(weather, path)
    return files.silver_weather(spark, path)


@query("k2_year_partitions")
def k2_year_partitions(spark, sf_dir):
    path = work_path(spark, "years")
    sinks.write_by_year(adapters.energy(spark, sf_dir), path)
    rows = sinks.read_years(spark, path, dt.datetime(1996, 7, 1), dt.datetime(1998, 2, 15))
    return rows.groupBy("year", "variable").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value_mwh").alias("value_mwh"))


@query("k3_bulk_append")
def k3_bulk_append(spark, sf_dir):
    folder = work_path(spark, "tables")
    weather, demand = adapters.obs(spark, sf_dir), adapters.energy(spark, sf_dir)
    for _ in range(2):
        written = sinks.append_tables({"weather_obs": weather, "grid_demand": demand.where(F.lit(False)),
                                       "spot_prices": adapters.prices(spark, sf_dir)}, folder)
        assert written == ["weather_obs", "spot_prices"]
    def total(name: str, value: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}").groupBy(F.lit(name).alias("table_name"), "region_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"))
    return total("weather_obs", "wind_speed_mps").unionByName(total("spot_prices", "price_eur_mwh"))


@query("k4_replace_table", places=8)
def k4_replace_table(spark, sf_dir):
    asset = ["gold", "snapshots", uuid.uuid4().hex]
    place = work_path(spark, "table")
    sinks.replace_table(adapters.obs(spark, sf_dir), asset, place)
    name = sinks.replace_table(snapshots.snapshots(adapters.obs(spark, sf_dir), hourly=True), asset, place)
    return spark.table(name)


@query("k5_write_if_changed")
def k5_write_if_changed(spark, sf_dir):
    """Written at first; skipped for the same rows in another order and column order; written again when changed."""
    folder = work_path(spark, "gold")
    rows = adapters.obs(spark, sf_dir)
    first = sinks.write_if_changed(rows, folder, "obs")
    again = sinks.write_if_changed(_dealt(rows.select("wind_speed_mps", "region_id", "timestamp"), 5), folder, "obs")
    changed = sinks.write_if_changed(rows.unionByName(rows), folder, "obs")
    nothing = sinks.write_if_changed(None, folder, "obs")
    content = spark.read.parquet(f"{folder}/obs").groupBy("region_id").agg(F.count(F.lit(1)).alias("n_rows"))
    flags = {"first": first, "again": again, "changed": changed, "nothing": nothing}
    return content.select("*", *[F.lit(v).alias(k) for k, v in flags.items()])


@query("k6_noop_with_count")
def k6_noop_with_count(spark, sf_dir):
    """The plan runs once; the row count is observed on the way."""
    rows, seen = snapshots.observed_rows(spatial.silver_weather(adapters.grid(spark, sf_dir)))
    sinks.noop(rows)
    return _flags(spark, n_rows=seen.get["n_rows"])


@query("k7_csv_round_trip")
def k7_csv_round_trip(spark, sf_dir):
    path = work_path(spark, "csv")
    rows = adapters.energy(spark, sf_dir).withColumn("timestamp", timefn.iso_text(F.col("timestamp")))
    sinks.write_energy_csv(rows, path)
    return files.good_rows(files.energy_csv(spark, path)).groupBy("timestamp", "region_id", "variable").agg(
        F.sum("value_mwh").alias("value_mwh"))


@query("k8_encode_messages")
def k8_encode_messages(spark, sf_dir):
    """JSON payloads, read back field by field."""
    payload = kafka.encode(adapters.prices(spark, sf_dir))
    return payload.select(
        F.get_json_object("value", "$.region_id").alias("region_id"),
        F.to_timestamp(F.get_json_object("value", "$.timestamp")).alias("timestamp"),
        F.get_json_object("value", "$.price_eur_mwh").cast("double").alias("price_eur_mwh"))


@query("k9_run_log")
def k9_run_log(spark, sf_dir):
    path = work_path(spark, "runs")
    run = adapters.elbo(spark, sf_dir)
    sinks.log_metric_rows(diagnostics.run_diagnostics(spark, elbo=run.where("run_id = '5-LOW'")), path, "low")
    sinks.log_run(spark, path, "low", {"m_spatial": 5}, {"ok": True, "n": 3, "note": "text"}, {"model_type": "hsgp"})
    return spark.read.parquet(path)


@query("i1_freshness")
def i1_freshness(spark, sf_dir):
    """Stale before the target exists, fresh after, stale again once a source is newer."""
    source, target = work_path(spark, "bronze"), work_path(spark, "silver")
    rows = adapters.obs(spark, sf_dir)
    rows.write.parquet(source)
    before = gates.is_fresh(spark, target, [(source, "parquet")])
    rows.write.parquet(target)
    after = gates.is_fresh(spark, target, [(source, "parquet")])
    rows.write.mode("append").parquet(source)
    newer = gates.is_fresh(spark, target, [(source, "parquet")])
    counted = spark.read.parquet(source).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(newer).alias("newer"))


@query("i2_content_gate")
def i2_content_gate(spark, sf_dir):
    """The fit is repeated only if the snapshots changed or its result is gone."""
    folder = work_path(spark, "gold")
    snaps = store(_hourly(spark, sf_dir))
    first = sinks.retrain_needed(snaps, folder, "model")
    sinks.mark_trained(snaps, folder, "model")
    no_result = sinks.retrain_needed(snaps, folder, "model")
    sinks.overwrite_parquet(snaps, f"{folder}/model")
    unchanged = sinks.retrain_needed(_dealt(snaps, 7), folder, "model")
    changed = sinks.retrain_needed(snaps.where("region_id <> 'view'"), folder, "model")
    hashed = gates.hash_columns(snaps, ["timestamp", "region_id", "wind_speed_mps"])
    return hashed.select("n_rows", F.lit(first).alias("first"), F.lit(no_result).alias("no_result"),
                         F.lit(unchanged).alias("unchanged"), F.lit(changed).alias("changed"))


@query("i3_missing_keys")
def i3_missing_keys(spark, sf_dir):
    manifest = adapters.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    urgent = adapters.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    existing = urgent.select(F.col("o_custkey").alias("key"))
    return gates.missing_keys(manifest, existing)


@query("i4_month_calendar")
def i4_month_calendar(spark, sf_dir):
    return calendar.months_covering(adapters.table(spark, sf_dir, "orders"), "o_orderdate").select("month")


@query("i5_month_windows")
def i5_month_windows(spark, sf_dir):
    return calendar.months_covering(adapters.table(spark, sf_dir, "orders"), "o_orderdate")


# --- Scalar functions -----------------------------------------------------------------

@query("p1_wind_speed")
def p1_wind_speed(spark, sf_dir):
    return (adapters.grid(spark, sf_dir).withColumn("speed", geo.wind_speed("u10", "v10"))
            .groupBy("timestamp").agg(F.sum("speed").alias("speed"), F.max("speed").alias("top")))


@query("p2_region_of_code")
def p2_region_of_code(spark, sf_dir):
    rows = adapters.energy(spark, sf_dir)
    return rows.groupBy("region_id", energy.region_of(F.col("region_id")).alias("mapped")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("p3_parse_iso")
def p3_parse_iso(spark, sf_dir):
    """Minute and second precision, an offset, and unreadable text."""
    ts = F.col("ts").cast("timestamp")
    turn = F.col("event_id") % 4
    text = (F.when(turn == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm'Z'"))
            .when(turn == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(turn == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .otherwise(F.concat(F.lit("at "), F.date_format(ts, "yyyy"))))
    events = adapters.table(spark, sf_dir, "events")
    return events.select("event_id", timefn.parse_iso(text).alias("parsed")).where(F.col("parsed").isNotNull())


@query("p4_resolution")
def p4_resolution(spark, sf_dir):
    docs = adapters.xml_docs(spark, sf_dir)
    text = F.regexp_extract("xml", "<resolution>(.*?)</resolution>", 1)
    return docs.groupBy(text.alias("resolution"), timefn.resolution_minutes(text).alias("minutes")).agg(
        F.count(F.lit(1)).alias("n_docs"))


@query("p5_point_time")
def p5_point_time(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events")
    at = timefn.point_time(F.col("ts").cast("timestamp"), F.col("user_id"), F.lit(15))
    return events.select("event_id", at.alias("at"))


@query("p6_haversine")
def p6_haversine(spark, sf_dir):
    """Distance of every weather cell to the zone it belongs to, summed by zone."""
    cells = spatial.assign_zone(adapters.grid(spark, sf_dir))
    centroid = F.create_map(*[x for z, (lat, lon) in geo.ZONES.items()
                              for x in (F.lit(z), F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")))])[F.col("region_id")]
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), centroid["lat"], centroid["lon"])
    return cells.groupBy("region_id").agg(F.avg(km).alias("mean_km"), F.max(km).alias("max_km"))


@query("p7_matern")
def p7_matern(spark, sf_dir):
    distances = spatial.distance_matrix(adapters.zones25(spark, sf_dir))
    out = spatial.matern_matrix(distances, 500.0, 1.5, 4.0).withColumnRenamed("value", "nu_1_5")
    for nu in (0.5, 2.5):
        name = f"nu_{str(nu).replace('.', '_')}"
        other = spatial.matern_matrix(distances, 500.0, nu, 4.0).withColumnRenamed("value", name)
        out = out.join(other, ["zone_a", "zone_b"])
    return out


@query("p7_matern_any_nu")
def p7_matern_any_nu(spark, sf_dir):
    """General smoothness by numerical integration; 7/2 has a closed form to compare with."""
    return spatial.matern_matrix(spatial.distance_matrix(adapters.zones25(spark, sf_dir)), 500.0, 3.5)


@query("p8_elapsed_hours", places=4)
def p8_elapsed_hours(spark, sf_dir):
    return features.elapsed_hours(adapters.obs(spark, sf_dir)).select("timestamp", "region_id", "hours")


@query("p9_features", places=8)
def p9_features(spark, sf_dir):
    return features.features(_hourly(spark, sf_dir))


@query("p11_rounding")
def p11_rounding(spark, sf_dir):
    rows = adapters.table(spark, sf_dir, "lineitem")
    half_up = snapshots.published(F.col("l_quantity") / 4.0, 1)
    half_even = snapshots.published(F.col("l_quantity") / 4.0, 1, half_even=True)
    return rows.groupBy("l_quantity").agg(F.max(half_up).alias("half_up"), F.max(half_even).alias("half_even"),
                                          F.max(snapshots.published(F.col("l_quantity") / 7.0)).alias("four_places"))


@query("p12_iso_text")
def p12_iso_text(spark, sf_dir):
    return adapters.table(spark, sf_dir, "events").select(
        "event_id", timefn.iso_text(F.col("ts").cast("timestamp")).alias("text"))


@query("p13_shortfall")
def p13_shortfall(spark, sf_dir):
    return adapters.draws(spark, sf_dir).groupBy("horizon_h", "region_id").agg(
        F.sum(risk.shortfall(F.col("value"))).alias("shortfall"), F.max(risk.shortfall(F.col("value"))).alias("worst"))


@query("p14_basis")
def p14_basis(spark, sf_dir):
    rows = features.features(_hourly(spark, sf_dir))
    phi = basis.tensor_product(basis.eigenfunctions(F.col("x_s"), 5, 0.5, 0.75),
                               basis.eigenfunctions(F.col("x_t"), 10, 2.0, 3.5))
    return rows.select(F.posexplode(phi).alias("j", "value")).groupBy("j").agg(
        F.sum("value").alias("total"), F.max("value").alias("top"))


@query("p15_horizon_points")
def p15_horizon_points(spark, sf_dir):
    return features.horizon_points(_hourly(spark, sf_dir))


@query("p16_json_records")
def p16_json_records(spark, sf_dir):
    """Records of a table without quantile columns: they are there, and NULL."""
    records = serve.scenario_records(_zone_forecasts(spark, sf_dir).drop("wind_p10", "wind_p50", "wind_p90"))
    field = lambda n: F.get_json_object("record", f"$.{n}")
    return records.select(
        field("timestamp").alias("timestamp"), field("region_id").alias("region_id"),
        field("horizon_h").cast("int").alias("horizon_h"), field("p_shortfall").cast("double").alias("p_shortfall"),
        field("wind_p10").cast("double").alias("wind_p10"), F.col("record").contains('"wind_p90":null').alias("has_null_field"))


@query("p17_verdicts")
def p17_verdicts(spark, sf_dir):
    worst = diagnostics.rhat(adapters.chains(spark, sf_dir), "split").agg(F.max("r_hat").alias("value"))
    metrics = worst.select(F.lit("max_r_hat").alias("key"), "value")
    return diagnostics.verdicts(metrics)


# --- Filters --------------------------------------------------------------------------

@query("f1_f2_known_regions")
def f1_f2_known_regions(spark, sf_dir):
    return energy.normalise(adapters.energy(spark, sf_dir)).groupBy("region_id", "variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value_mwh").alias("value_mwh"))


@query("f3_f4_readable_points")
def f3_f4_readable_points(spark, sf_dir):
    return market_xml.points(adapters.xml_docs(spark, sf_dir)).groupBy("region_id", "variable").agg(F.count(F.lit(1)).alias("n_points"))


@query("f5_alerts")
def f5_alerts(spark, sf_dir):
    table = risk.tail_risk(adapters.draws(spark, sf_dir))
    return risk.alerts(table, 0.2)


@query("f6_at_risk")
def f6_at_risk(spark, sf_dir):
    return risk.at_risk(risk.tail_risk(adapters.draws(spark, sf_dir)))


@query("f8_minimum_rows")
def f8_minimum_rows(spark, sf_dir):
    rows = adapters.obs(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(hsgp.enough_rows(rows)).alias("enough"),
        F.lit(hsgp.enough_rows(rows.where("region_id = 'none'"))).alias("empty_is_enough"))


@query("f9_null_keys_dropped", places=8)
def f9_null_keys_dropped(spark, sf_dir):
    rows = adapters.obs(spark, sf_dir).withColumn("region_id", F.nullif(F.col("region_id"), F.lit("error")))
    return snapshots.snapshots(rows, hourly=True)


# --- Joins ----------------------------------------------------------------------------

@query("j1_nearest_zone")
def j1_nearest_zone(spark, sf_dir):
    return (spatial.assign_zone(adapters.grid(spark, sf_dir)).groupBy("latitude", "longitude", "region_id")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("j1_nearest_zone_km")
def j1_nearest_zone_km(spark, sf_dir):
    return (spatial.assign_zone(adapters.grid(spark, sf_dir), metric="haversine").groupBy("region_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("latitude").alias("latitude")))


@query("j1_nearest_zone_list")
def j1_nearest_zone_list(spark, sf_dir):
    """A zone list that grows with the customers."""
    placed = zone_search.assign_zone_list(adapters.grid(spark, sf_dir), adapters.many_zones(spark, sf_dir))
    return placed.groupBy("latitude", "longitude", "region_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("j2_wind_outer_join")
def j2_wind_outer_join(spark, sf_dir):
    return energy.generation_rows(energy.normalise(adapters.energy(spark, sf_dir))).drop("total_load_mwh")


@query("j3_zone_distances")
def j3_zone_distances(spark, sf_dir):
    return spatial.distance_matrix(adapters.zones25(spark, sf_dir))


@query("j4_zones_by_horizon")
def j4_zones_by_horizon(spark, sf_dir):
    return features.horizon_points(adapters.zone_obs(spark, sf_dir)).select("region_id", "horizon_h")


@query("j5_hour_scaffold", places=8)
def j5_hour_scaffold(spark, sf_dir):
    rows = adapters.obs(spark, sf_dir)
    return snapshots.fill_scaffold(snapshots.hour_scaffold(rows), snapshots.snapshots(rows, hourly=True))


@query("j6_zone_index")
def j6_zone_index(spark, sf_dir):
    return features.zone_index(adapters.obs(spark, sf_dir))


@query("j8_in_drought")
def j8_in_drought(spark, sf_dir):
    flags = snapshots.drought_flags(_hourly(spark, sf_dir))
    return snapshots.in_drought(adapters.prices(spark, sf_dir), flags)


@query("j9_tail_draws")
def j9_tail_draws(spark, sf_dir):
    draws = adapters.draws(spark, sf_dir)
    tail = risk.tail_scenarios(draws)
    return draws.join(tail.select(*risk.SCENARIO), risk.SCENARIO, "left_semi").groupBy("horizon_h").agg(
        F.count(F.lit(1)).alias("n_draws"), F.count_distinct("sample_id").alias("n_scenarios"))


@query("j10_weather_energy")
def j10_weather_energy(spark, sf_dir):
    weather = spatial.silver_weather(adapters.grid(spark, sf_dir))
    return energy.with_weather(weather, energy.wide(energy.normalise(adapters.energy(spark, sf_dir))))


@query("j11_matrix_difference")
def j11_matrix_difference(spark, sf_dir):
    """Observed correlation against the kernel of the zone distances."""
    observed = correlation.correlation_matrix(snapshots.snapshots(adapters.zone_obs(spark, sf_dir), hourly=True))
    used = {z: geo.ZONES[z] for z in adapters.EVENT_ZONE.values()}
    places = F.create_map(*[x for z, (lat, lon) in used.items()
                            for x in (F.lit(z), F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")))])
    zones = adapters.zone_obs(spark, sf_dir).select("region_id").distinct().select(
        "region_id", places[F.col("region_id")]["lat"].alias("lat"), places[F.col("region_id")]["lon"].alias("lon"))
    kernel = spatial.matern_matrix(spatial.distance_matrix(zones), 500.0)
    return spatial.matrix_difference(observed, kernel)


# --- Aggregations ---------------------------------------------------------------------

@query("a1_zone_means_per_file")
def a1_zone_means_per_file(spark, sf_dir):
    return spatial.zone_means_per_file(adapters.grid(spark, sf_dir))


@query("a2_silver_weather")
def a2_silver_weather(spark, sf_dir):
    return spatial.silver_weather(adapters.grid(spark, sf_dir))


@query("a3_energy_sums")
def a3_energy_sums(spark, sf_dir):
    return energy.sums_per_file(energy.normalise(adapters.energy(spark, sf_dir)))


@query("a4_energy_wide")
def a4_energy_wide(spark, sf_dir):
    return energy.wide(energy.normalise(adapters.energy(spark, sf_dir)))


@query("a4_energy_wide_hourly", places=8)
def a4_energy_wide_hourly(spark, sf_dir):
    """Points of an hour averaged per file, then added over seven files with both wind kinds and load.

    A date's rows are spread over four quarters of an hour by their value.
    """
    rows = adapters.energy(spark, sf_dir)
    quarter = F.pmod(F.col("value_mwh").cast("long"), F.lit(4)) * 15
    spread = rows.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(mins=quarter.cast("int")))
    return energy.wide(energy.normalise(spread), hourly=True)


@query("a5_snapshots", places=8)
def a5_snapshots(spark, sf_dir):
    return snapshots.snapshots(adapters.obs(spark, sf_dir))


@query("a5_snapshots_hourly", places=8)
def a5_snapshots_hourly(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query("a6_extent")
def a6_extent(spark, sf_dir):
    return snapshots.extent(adapters.obs(spark, sf_dir))


@query("a7_span")
def a7_span(spark, sf_dir):
    return snapshots.span(adapters.obs(spark, sf_dir))


@query("a8_droughts")
def a8_droughts(spark, sf_dir):
    return snapshots.drought_flags(_hourly(spark, sf_dir))


@query("a9_tail_risk")
def a9_tail_risk(spark, sf_dir):
    return risk.tail_risk(adapters.draws(spark, sf_dir))


@query("a10_scenario_totals")
def a10_scenario_totals(spark, sf_dir):
    return risk.scenario_totals(adapters.draws(spark, sf_dir))


@query("a11_cvar")
def a11_cvar(spark, sf_dir):
    return risk.cvar(adapters.draws(spark, sf_dir))


@query("a11_cvar_any_size")
def a11_cvar_any_size(spark, sf_dir):
    """The same through the path for groups of any size."""
    return risk.cvar(adapters.draws(spark, sf_dir), in_memory_rows=0)


@query("a12_quantiles")
def a12_quantiles(spark, sf_dir):
    return risk.quantiles(adapters.draws(spark, sf_dir))


@query("a12_quantiles_any_size")
def a12_quantiles_any_size(spark, sf_dir):
    """The same through the path for groups of any size, over a hot key too."""
    return risk.quantiles(adapters.draws(spark, sf_dir), in_memory_rows=0)


@query("a13_frobenius")
def a13_frobenius(spark, sf_dir):
    return spatial.frobenius(spatial.matern_matrix(spatial.distance_matrix(adapters.zones25(spark, sf_dir)), 500.0))


@query("a14_median_error")
def a14_median_error(spark, sf_dir):
    """Observation of an id: its first component; samples: all its components."""
    rows = adapters.draws(spark, sf_dir)
    observed = rows.where("region_id = 'd0'").select(F.col("sample_id").alias("obs_id"), F.col("value").alias("y"))
    return diagnostics.median_error(observed, rows.select(F.col("sample_id").alias("obs_id"), "value"))


@query("a15_elbo_converged")
def a15_elbo_converged(spark, sf_dir):
    return diagnostics.elbo_converged(adapters.elbo(spark, sf_dir))


@query("a16_elbo_drift", places=9)
def a16_elbo_drift(spark, sf_dir):
    return diagnostics.elbo_drift(adapters.elbo(spark, sf_dir)).select("run_id", "rel_delta", "still_improving")


@query("a17_split_rhat")
def a17_split_rhat(spark, sf_dir):
    return diagnostics.rhat(adapters.chains(spark, sf_dir), "split")


@query("a17_rank_rhat")
def a17_rank_rhat(spark, sf_dir):
    return diagnostics.rhat(adapters.chains(spark, sf_dir))


@query("a17_average_ranks")
def a17_average_ranks(spark, sf_dir):
    return ranks.average_ranks(adapters.chains(spark, sf_dir), ["param"], "value").select("param", "value", "rank", "n")


@query("a17_ess")
def a17_ess(spark, sf_dir):
    chains = store(adapters.chains(spark, sf_dir))
    return diagnostics.ess(chains)


@query("a17_divergences")
def a17_divergences(spark, sf_dir):
    """Draws flagged divergent: here those with an extreme component."""
    stats = adapters.chains(spark, sf_dir).groupBy("chain", "draw").agg((F.max(F.abs("value")) > 0.25).alias("diverging"))
    return diagnostics.divergences(stats).select(F.col("value").cast("bigint").alias("n_divergences"))


@query("a18_zone_correlation")
def a18_zone_correlation(spark, sf_dir):
    return correlation.correlation_matrix(_hourly(spark, sf_dir))


@query("a18_zone_correlation_many")
def a18_zone_correlation_many(spark, sf_dir):
    """The path for long zone lists, over all 64 components."""
    rows = adapters.draws(spark, sf_dir).select(
        F.col("sample_id").alias("timestamp"), "region_id", F.col("value").alias("wind_speed_mps"))
    return correlation.correlation_matrix(rows)


@query("a18_zone_correlation_tiled")
def a18_zone_correlation_tiled(spark, sf_dir):
    """The path for thousands of zones, tile by tile, over all 64 components."""
    rows = adapters.draws(spark, sf_dir).select(
        F.col("sample_id").alias("timestamp"), "region_id", F.col("value").alias("wind_speed_mps"))
    return correlation.correlation_matrix(rows, array_zones=24, tile=24)


@query("a19_zone_means")
def a19_zone_means(spark, sf_dir):
    means = correlation.zone_means(_hourly(spark, sf_dir))
    return means.select(F.explode("mean_wind_per_region").alias("region_id", "mean_wind"))


@query("a20_parameter_correlation")
def a20_parameter_correlation(spark, sf_dir):
    return diagnostics.parameter_correlation(adapters.chains(spark, sf_dir), ["d0", "d1", "d2"])


@query("a21_share_below")
def a21_share_below(spark, sf_dir):
    return snapshots.share_below(adapters.obs(spark, sf_dir))


@query("a23_sufficient_statistics", places=4)
def a23_sufficient_statistics(spark, sf_dir):
    rows = store(features.features(_hourly(spark, sf_dir)))
    stats = hsgp.sufficient_statistics(rows, hsgp.domain_of(rows))
    return stats


@query("a23_incremental_fit", places=4)
def a23_incremental_fit(spark, sf_dir):
    """A ledger of one file a day, filled in two updates: the second adds a third of the days, replaces another third and withdraws a file."""
    folder = work_path(spark, "ledger")
    snaps = store(_hourly(spark, sf_dir)).withColumn("file_id", F.date_format("timestamp", "yyyy-MM-dd"))
    turn = F.pmod(F.crc32("file_id"), F.lit(3))
    ends = snaps.agg(F.min("file_id").alias("low"), F.max("file_id").alias("high")).first()
    early = snaps.where((turn != 0) | F.col("file_id").isin(ends.low, ends.high)).withColumn(
        "wind_speed_mps", F.when(turn == 1, F.col("wind_speed_mps") * 2.0).otherwise(F.col("wind_speed_mps")))
    stray = snaps.where(turn == 2).withColumn("file_id", F.lit("withdrawn"))
    fit_ledger.update(early.unionByName(stray), folder)
    fit_ledger.update(snaps, folder)
    sums, domain, _ = fit_ledger.zone_totals(spark, folder)
    return hsgp.expand_sums(sums, domain)


@query("a24_hyper_posterior")
def a24_hyper_posterior(spark, sf_dir):
    model = hsgp.fit(store(features.features(_hourly(spark, sf_dir))))
    nodes = hsgp.hyper_posterior(spark, model)
    return nodes.agg(*[F.sum(F.col(p) * F.col("weight")).alias(p) for p in hsgp.PARAMS], F.sum("weight").alias("weight"))


@query("a24_log_posterior", places=4)
def a24_log_posterior(spark, sf_dir):
    """The density that the quadrature integrates, with two basis functions, at a lattice of hyper-parameters."""
    model = hsgp.fit(store(features.features(_hourly(spark, sf_dir))), 1, 2)
    axes = {"ell_spatial": (0.1, 0.5, 2.0), "ell_temporal": (0.2, 1.0, 5.0), "eta": (0.5, 4.0), "sigma": (1.0, 3.0)}
    lattice = spark.range(1)
    for name, values in axes.items():
        lattice = lattice.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return hsgp.log_posterior(lattice, model)


@query("a25_predictive_draws")
def a25_predictive_draws(spark, sf_dir):
    snaps = store(_hourly(spark, sf_dir))
    return forecasting.predictive_draws(snaps, forecasting.train(snaps))


@query("a26_fixed_count")
def a26_fixed_count(spark, sf_dir):
    return hsgp.fixed_count(adapters.draws(spark, sf_dir), 30)


@query("a27_forecasts")
def a27_forecasts(spark, sf_dir):
    return risk.forecasts(adapters.draws(spark, sf_dir)).drop("timestamp")


@query("a27_raw_to_forecasts")
def a27_raw_to_forecasts(spark, sf_dir):
    """End to end: observations, snapshots, model, draws, forecast table."""
    return forecasting.raw_to_forecasts(adapters.zone_obs(spark, sf_dir))


@query("a28_alert_records")
def a28_alert_records(spark, sf_dir):
    return risk.alert_records(risk.tail_risk(adapters.draws(spark, sf_dir)), 0.2)


@query("a28_alert_count")
def a28_alert_count(spark, sf_dir):
    return risk.alerts(risk.tail_risk(adapters.draws(spark, sf_dir)), 0.2).agg(F.count(F.lit(1)).alias("alerts_published"))


@query("a29_price_regimes")
def a29_price_regimes(spark, sf_dir):
    return snapshots.price_regimes(adapters.prices(spark, sf_dir), snapshots.drought_flags(_hourly(spark, sf_dir)))


@query("a30_joint_drought")
def a30_joint_drought(spark, sf_dir):
    return risk.joint_drought(adapters.draws(spark, sf_dir), 12)


@query("a31_diagnostics")
def a31_diagnostics(spark, sf_dir):
    rows = adapters.draws(spark, sf_dir)
    observed = rows.where("region_id = 'd0'").select(F.col("sample_id").alias("obs_id"), F.col("value").alias("y"))
    return diagnostics.run_diagnostics(
        spark, elbo=adapters.elbo(spark, sf_dir).where("run_id = '5-LOW'"),
        correlation=spatial.matern_matrix(spatial.distance_matrix(adapters.zones25(spark, sf_dir)), 500.0),
        observed=observed, samples=rows.select(F.col("sample_id").alias("obs_id"), "value"))


# --- Ordering, limits, unions ---------------------------------------------------------

@query("o2_worst_scenarios")
def o2_worst_scenarios(spark, sf_dir):
    return risk.tail_scenarios(adapters.draws(spark, sf_dir))


@query("o4_last_points")
def o4_last_points(spark, sf_dir):
    return diagnostics.last_points(adapters.elbo(spark, sf_dir), 500)


@query("o5_zone_list")
def o5_zone_list(spark, sf_dir):
    return snapshots.zone_list(adapters.obs(spark, sf_dir))


@query("u1_energy_union")
def u1_energy_union(spark, sf_dir):
    return energy.stacked(energy.normalise(adapters.energy(spark, sf_dir)))


@query("u2_concat_chains")
def u2_concat_chains(spark, sf_dir):
    chains = adapters.chains(spark, sf_dir)
    parts = [chains.where(F.col("chain") == c).drop("chain") for c in range(4)]
    return hsgp.concat_chains(parts).groupBy("chain", "param").agg(
        F.count(F.lit(1)).alias("n_draws"), F.sum("value").alias("total"))


# --- Arrays, maps ---------------------------------------------------------------------

@query("m1_last_write_wins")
def m1_last_write_wins(spark, sf_dir):
    snaps = jobs.hourly_snapshots(_ordered_obs(spark, sf_dir), ("timestamp", "event_id"))
    return snaps.select(F.col("window.start").alias("hour"), "timestamp", F.explode("regions").alias("region_id", "wind_speed_mps"))


@query("m2_map_lookup")
def m2_map_lookup(spark, sf_dir):
    """A zone missing from the hour's map gives NULL."""
    snaps = jobs.hourly_snapshots(_ordered_obs(spark, sf_dir), ("timestamp", "event_id"))
    return snaps.select(F.col("window.start").alias("hour"), F.try_element_at("regions", F.lit("view")).alias("view"),
                        F.try_element_at("regions", F.lit("absent")).alias("absent"))


@query("m3_nested_matrix")
def m3_nested_matrix(spark, sf_dir):
    """Long to nested and back."""
    return correlation.unnested(correlation.nested(correlation.correlation_matrix(_hourly(spark, sf_dir))))


# --- Streams --------------------------------------------------------------------------

def _ordered_obs(spark, sf_dir):
    return adapters.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("region_id"),
        (F.col("value") / 10.0).alias("wind_speed_mps"), "event_id")


EVENT = "timestamp timestamp, region_id string, wind_speed_mps double, event_id long"


def _event_topic(spark, sf_dir):
    """All events on a topic, in two commits, then an end mark two days after the last one."""
    path, rows = work_path(spark, "event-topic"), _ordered_obs(spark, sf_dir)
    topic.append(rows.where("event_id % 2 = 0"), path, "region_id")
    topic.append(rows.where("event_id % 2 = 1"), path, "region_id")
    end = rows.agg((F.max("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("timestamp")).withColumn("region_id", F.lit(None).cast("string"))
    topic.append(end, path, "region_id")
    return path


def _event_stream(spark, sf_dir):
    return topic.rows_of(topic.stream(spark, _event_topic(spark, sf_dir)), EVENT)


def _streamed(spark, df, name):
    """What the stream itself gives when run to its end."""
    path, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    run = jobs.run_to_files(df, path, checkpoint)
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _correlation_stream(spark, sf_dir):
    return jobs.window_correlations(jobs.hourly_snapshots(_event_stream(spark, sf_dir), ("timestamp", "event_id")))


@query("t1_hourly_snapshots")
def t1_hourly_snapshots(spark, sf_dir):
    """Hours closed by timers, the last ones by the end mark."""
    found = jobs.hourly_snapshots(_event_stream(spark, sf_dir), ("timestamp", "event_id"))
    rows = _streamed(spark, found.select(F.col("window.start").alias("hour"), "timestamp", "regions"), "snapshots")
    return rows.select("hour", "timestamp", F.explode("regions").alias("region_id", "wind_speed_mps"))


@query("t2_t4_window_correlations")
def t2_t4_window_correlations(spark, sf_dir):
    rows = _streamed(spark, _correlation_stream(spark, sf_dir), "correlations")
    return rows.select("window_start", "window_end", "timestamp", F.explode("mean_wind_per_region").alias("region_id", "mean_wind"))


@query("t3_window_correlation_cells")
def t3_window_correlation_cells(spark, sf_dir):
    """The batch form of the same windows, cell by cell."""
    events = jobs.window_correlations(jobs.hourly_snapshots(_ordered_obs(spark, sf_dir), ("timestamp", "event_id")))
    rows = events.select("window_start", "zone_ids", F.posexplode("correlation_matrix").alias("i", "row"))
    cells = rows.select("window_start", "zone_ids", "i", F.posexplode("row").alias("j", "value"))
    return cells.select("window_start", F.element_at("zone_ids", F.col("i") + 1).alias("zone_a"),
                        F.element_at("zone_ids", F.col("j") + 1).alias("zone_b"), "value")


@query("t5_alert_stream")
def t5_alert_stream(spark, sf_dir):
    source = work_path(spark, "forecasts")
    table = risk.tail_risk(adapters.draws(spark, sf_dir))
    # Probabilities of the test draws stay under the real threshold; five times as much does not.
    table.withColumn("p_shortfall", F.col("p_shortfall") * 5.0).write.parquet(source)
    stream = jobs.file_stream(spark, source, spark.read.parquet(source).schema)
    return _streamed(spark, jobs.alert_stream(stream), "alerts")


@query("t6_early_warnings")
def t6_early_warnings(spark, sf_dir):
    events = jobs.window_correlations(jobs.hourly_snapshots(_ordered_obs(spark, sf_dir), ("timestamp", "event_id")))
    return jobs.early_warnings(events, -0.6).select("window_start", "window_end", "timestamp")


@query("t6_warning_episodes")
def t6_warning_episodes(spark, sf_dir):
    """Two streams with a topic between them: correlations to warnings, warnings to episodes."""
    path = work_path(spark, "warning-topic")
    warned = jobs.warning_strengths(_correlation_stream(spark, sf_dir), -0.6)
    topic.publish(warned, path, work_path(spark, "warnings-checkpoint"), "zones", "warnings", "window_end").awaitTermination()
    end = _ordered_obs(spark, sf_dir).agg((F.max("timestamp") + F.expr("INTERVAL 2 DAYS")).alias("window_end"))
    topic.append(end.withColumn("zones", F.lit(None).cast("string")), path, "zones", "window_end")
    warnings = topic.rows_of(topic.stream(spark, path), "zones string, window_start timestamp, window_end timestamp, strength double")
    rows = _streamed(spark, jobs.warning_episodes(warnings.drop("partition", "offset")), "episodes")
    return rows.withColumn("peak", F.round("peak", 6))


# --- Look-ups -------------------------------------------------------------------------

@query("q1_forecast")
def q1_forecast(spark, sf_dir):
    table = _zone_forecasts(spark, sf_dir)
    return serve.forecast(spark, table, "se1", 24).unionByName(serve.forecast(spark, table.where("region_id <> 'FI'"), "FI", 48))


@query("q2_scenario")
def q2_scenario(spark, sf_dir):
    table = _zone_forecasts(spark, sf_dir)
    return serve.scenario(spark, table, "dk1", 48).unionByName(
        serve.scenario(spark, table.where("region_id <> 'FI'"), "FI", 72))


@query("q3_scenarios")
def q3_scenarios(spark, sf_dir):
    return serve.scenarios(_zone_forecasts(spark, sf_dir))


@query("q3_scenario_count")
def q3_scenario_count(spark, sf_dir):
    return serve.scenario_summary(_zone_forecasts(spark, sf_dir), spark)


@query("q4_correlations")
def q4_correlations(spark, sf_dir):
    served = serve.correlations(spark, correlation.correlation_matrix(_hourly(spark, sf_dir)))
    return correlation.unnested(served)


@query("f10_o3_first_match")
def f10_o3_first_match(spark, sf_dir):
    """A table without horizons: the newest row of the region is taken."""
    table = _zone_forecasts(spark, sf_dir).drop("horizon_h")
    return serve.scenario(spark, table, "no2", 24)


# --- One rule for every size ----------------------------------------------------------

@query("a12_quantiles_wide_range")
def a12_quantiles_wide_range(spark, sf_dir):
    """Values from 1e-130 to 1e130 by the way of large groups, as decimal logarithms."""
    power = F.pow(F.lit(10.0), F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13, F.lit(261)) - 130)
    rows = adapters.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), (power * F.col("l_quantity")).alias("value"))
    bands = ranks.quantiles(rows, ["flag"], "value", in_memory_rows=0)
    return bands.select("flag", *[F.log10(c).alias(c) for c in ("p10", "p50", "p90")])


@query("a17_average_ranks_nulls")
def a17_average_ranks_nulls(spark, sf_dir):
    """NULL and NaN values are left out before ranks are counted."""
    tenth = F.col("event_id") % 10
    value = F.when(tenth == 0, F.lit(None)).when(tenth == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    rows = adapters.table(spark, sf_dir, "events").select(F.col("event_type").alias("param"), "event_id", value.alias("x"))
    return ranks.with_average_ranks(rows, ["param"], "x", in_memory_rows=0).select("param", "event_id", "rank", "n")


@query("a18_constant_zone")
def a18_constant_zone(spark, sf_dir):
    """A zone that stays at 0.1 has NULL correlations, whatever its mean rounds to; by the way of many zones."""
    hourly = _hourly(spark, sf_dir)
    constant = hourly.select("timestamp").distinct().select(
        "timestamp", F.lit("constant").alias("region_id"), F.lit(0.1).alias("wind_speed_mps"))
    snaps = hourly.select("timestamp", "region_id", "wind_speed_mps").unionByName(constant)
    return correlation.correlation_matrix(snaps, pivot_zones=1)


@query("a27_missing_draws")
def a27_missing_draws(spark, sf_dir):
    """Every fifth draw and a whole zone are NaN: both ways to the tail risk agree, and the zone keeps its rows."""
    rows = adapters.draws(spark, sf_dir)
    gone = (F.col("region_id") == "d0") | (F.col("sample_id") % 5 == 0)
    holed = rows.withColumn("value", F.when(gone, F.lit(float("nan"))).otherwise(F.col("value")))
    tail = risk.tail_risk(holed).withColumnRenamed("p_shortfall", "p_tail")
    return risk.forecasts(holed).select("horizon_h", "region_id", "p_shortfall").join(tail, ["horizon_h", "region_id"])


@query("a14_crps")
def a14_crps(spark, sf_dir):
    rows = adapters.draws(spark, sf_dir)
    observed = rows.where("region_id = 'd0'").select(F.col("sample_id").alias("obs_id"), F.col("value").alias("y"))
    return diagnostics.crps(observed, rows.select(F.col("sample_id").alias("obs_id"), "value"))


# --- Nothing is lost unseen -----------------------------------------------------------

# Rows of a grid file, and of a dealt part of the grid: what one task reads stays the same however many rows there are.
GRID_FILE_ROWS = 500_000
GRID_PART_ROWS = 1_000_000


def _grid_files(spark, sf_dir, path):
    """The grid of all rows in whole files of bounded size, and beside it one of these with broken pages, and one that is no Parquet."""
    (adapters.grid(spark, sf_dir).drop("file_id").write.option("compression", "none").option("maxRecordsPerFile", GRID_FILE_ROWS)
     .parquet(f"{path}/whole"))

    def binary(folder):
        return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    # A list of names reads no content; then a single file is opened.
    first = binary(f"{path}/whole").agg(F.min("path")).first()[0]
    content = bytes(binary(first).select("content").first()[0])
    middle = len(content) // 2
    _write_bytes(spark, f"{path}/broken/part-0.parquet", content[:4] + bytes(middle - 4) + content[middle:])
    _write_bytes(spark, f"{path}/unreadable/part-0.parquet", b"no grid at all")


@query("s1_skipped_files")
def s1_skipped_files(spark, sf_dir):
    """Grid files of all rows, one more with a footer but broken pages, one that is no Parquet."""
    path = work_path(spark, "grid")
    _grid_files(spark, sf_dir, path)
    return files.skipped_files(spark, path).groupBy("why").agg(F.count(F.lit(1)).alias("n_files"))


def _write_bytes(spark, path: str, content: bytes) -> None:
    """One small file through the file system that Spark itself uses."""
    jvm, target = spark.sparkContext._jvm, None
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(content))
    stream.close()


@query("s4_unreadable_documents")
def s4_unreadable_documents(spark, sf_dir):
    """One document per event, every third cut off."""
    whole = "<GL_MarketDocument><TimeSeries></TimeSeries></GL_MarketDocument>"
    events = adapters.table(spark, sf_dir, "events")
    docs = events.select(F.col("event_type").alias("region_id"), F.when(F.col("event_id") % 3 == 0, F.lit(whole[:40])).otherwise(F.lit(whole)).alias("xml"))
    return market_xml.unreadable(docs).groupBy("region_id").agg(F.count(F.lit(1)).alias("n_documents"))


def _dealt(rows: DataFrame, least: int) -> DataFrame:
    """Rows dealt out to `least` tasks, and one more for every GRID_PART_ROWS rows."""
    return rows.repartition(least + rows.count() // GRID_PART_ROWS)


@query("k5_recomputed_means")
def k5_recomputed_means(spark, sf_dir):
    """Zone means computed again from differently dealt rows are the same content."""
    folder = work_path(spark, "silver")
    few, many = (_dealt(adapters.grid(spark, sf_dir), least) for least in (3, 11))
    first = sinks.write_if_changed(spatial.silver_weather(few), folder, "weather")
    again = sinks.write_if_changed(spatial.silver_weather(many), folder, "weather")
    rows = spark.read.parquet(f"{folder}/weather").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("n_rows", F.lit(first).alias("first"), F.lit(again).alias("again"))


@query("i2_saved_model")
def i2_saved_model(spark, sf_dir):
    """Fitted and saved at first, loaded for the same snapshots; forecasts of both are the same."""
    folder = work_path(spark, "gold")
    snaps = store(_hourly(spark, sf_dir))
    fresh, fitted = forecasting.train_or_load(snaps, folder, n_samples=50)
    loaded, again = forecasting.train_or_load(_dealt(snaps, 5), folder, n_samples=50)
    left = forecasting.forecast_table(snaps, fresh).select("region_id", "horizon_h", "p_shortfall", "wind_p50")
    right = forecasting.forecast_table(snaps, loaded).select("region_id", "horizon_h", F.col("p_shortfall").alias("p"), F.col("wind_p50").alias("w"))
    gap = F.greatest(F.abs(F.col("p_shortfall") - F.col("p")), F.abs(F.col("wind_p50") - F.col("w")))
    return left.join(right, ["region_id", "horizon_h"]).select(
        "region_id", "horizon_h", F.lit(fitted).alias("fitted"), F.lit(again).alias("fitted_again"), gap.alias("gap"))


@query("k5_changed_parts")
def k5_changed_parts(spark, sf_dir):
    """Second version without the first day and with the last hour's wind raised: the hash tree names the parts of these two days."""
    folder = work_path(spark, "versioned")
    rows = store(adapters.obs(spark, sf_dir))
    ends = rows.agg(F.date_trunc("day", F.min("timestamp")).alias("low"), F.date_trunc("hour", F.max("timestamp")).alias("high"))
    versions.commit(rows, folder, slot_days=1)
    edited = rows.join(F.broadcast(ends)).where(F.date_trunc("day", "timestamp") > F.col("low")).withColumn(
        "wind_speed_mps", F.col("wind_speed_mps") + F.when(F.col("timestamp") >= F.col("high"), 1.0).otherwise(0.0)).drop("low", "high")
    versions.commit(edited, folder, slot_days=1)
    return versions.changes(spark, folder, 0, 1)


@query("k1_table_versions")
def k1_table_versions(spark, sf_dir):
    """Two versions of a table, each read as it was committed; the same rows in another order are none."""
    folder = work_path(spark, "versioned")
    rows = store(adapters.obs(spark, sf_dir))
    versions.commit(rows, folder, slot_days=7)
    versions.commit(rows.where("region_id <> 'view'"), folder, slot_days=7)
    again = versions.commit(_dealt(rows.where("region_id <> 'view'"), 5), folder, slot_days=7)
    read = [versions.read(spark, folder, v).withColumn("version", F.lit(v)) for v in range(versions.newest(spark, folder) + 1)]
    whole = read[0].unionByName(read[1])
    return whole.groupBy("version", "region_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("wind_speed_mps").alias("wind_sum")).withColumn(
        "written_again", F.lit(again is not None))


def _yearly_binary_grids(spark, sf_dir):
    """The grid on cells of 5 by 10 degrees, one binary file a year."""
    folder = work_path(spark, "binary-grid")
    cell = {"latitude": F.floor(F.col("latitude") / 5) * 5.0, "longitude": F.floor(F.col("longitude") / 10) * 10.0}
    coarse = adapters.grid(spark, sf_dir).groupBy("timestamp", *[c.alias(n) for n, c in cell.items()]).agg(
        F.sum("u10").alias("u10"), F.max("v10").alias("v10"))
    binary_grid.write_binary_grid(coarse.withColumn("year", F.year("timestamp")), folder, "year")
    return folder


@query("s1_binary_grid")
def s1_binary_grid(spark, sf_dir):
    """Written as binary grids and read back over a range of times that cuts two files."""
    folder = _yearly_binary_grids(spark, sf_dir)
    read = binary_grid.binary_grid(spark, folder, start=dt.datetime(1994, 3, 1), end=dt.datetime(1996, 10, 15), split_bytes=100_000)
    return read.where("u10 IS NOT NULL").select("timestamp", "latitude", "longitude", "u10", "v10")


@query("s1_binary_grid_report")
def s1_binary_grid_report(spark, sf_dir):
    report = binary_grid.grid_report(spark, _yearly_binary_grids(spark, sf_dir))
    return report.select(F.regexp_extract("file_id", r"(\d+)\.nc$", 1).cast("int").alias("year"), "n_times", "n_cells", F.col("why").isNull().alias("readable"))
