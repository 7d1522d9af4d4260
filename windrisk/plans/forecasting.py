"""From raw inputs to forecasts and alerts, each step a DataFrame job."""

from dataclasses import asdict, dataclass, fields

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.operators import features as feat
from windrisk.operators import fit_ledger, hsgp, risk, snapshots
from windrisk.schemas import HORIZONS
from windrisk.session import keep, small_side, store
from windrisk.sources.files import empty_forecasts
from windrisk.sources.gates import path_exists
from windrisk.sources.sinks import mark_trained, retrain_needed

FIT = ("m_spatial int, m_temporal int, center_s double, length_s double, center_t double, length_t double, gram array<double>, "
       "proj array<double>, yy double, n long, y_mean double")


@dataclass(frozen=True)
class Trained:
    """Fitted model, hyper-parameter draws and the zone index they refer to."""
    model: hsgp.Fit
    draws: DataFrame
    index: DataFrame


def train(snaps: DataFrame, n_samples: int = 500, m_spatial: int = hsgp.M_SPATIAL, m_temporal: int = hsgp.M_TEMPORAL,
          seed: int = 42, center_y: bool = False, grid_points: int = hsgp.GRID_POINTS) -> Trained | None:
    """Fit the model on zone-hour snapshots; None if there are too few rows."""
    if not hsgp.enough_rows(snaps):
        return None
    index = feat.zone_index(snaps)
    rows = store(feat.features(snaps, index=index))
    model = hsgp.fit(rows, m_spatial, m_temporal, center_y=center_y)
    posterior = hsgp.hyper_posterior(snaps.sparkSession, model, points=grid_points)
    return Trained(model, keep(hsgp.hyper_draws(posterior, n_samples, seed)), index)


def train_ledger(spark: SparkSession, folder: str, n_samples: int = 500, seed: int = 42, grid_points: int = hsgp.GRID_POINTS) -> Trained | None:
    """Fit from the totals of a ledger of files (`fit_ledger.update`), without reading any observations."""
    found = fit_ledger.fit(spark, folder)
    if found is None:
        return None
    model, index = found
    posterior = hsgp.hyper_posterior(spark, model, points=grid_points)
    return Trained(model, keep(hsgp.hyper_draws(posterior, n_samples, seed)), index)


def save_model(trained: Trained, path: str) -> None:
    """Write a fitted model: its sums in one row, hyper-parameter draws and zone index as tables."""
    model, spark = trained.model, trained.draws.sparkSession
    row = asdict(model.domain) | {"gram": model.gram.ravel().tolist(), "proj": model.proj.ravel().tolist(), "yy": float(model.yy),
                                  "n": int(model.n), "y_mean": float(model.y_mean)}
    spark.createDataFrame([row], FIT).coalesce(1).write.mode("overwrite").parquet(f"{path}/fit")
    trained.index.write.mode("overwrite").parquet(f"{path}/index")
    # The draws come last: a model without them was not saved whole.
    trained.draws.write.mode("overwrite").parquet(f"{path}/draws")


def load_model(spark: SparkSession, path: str) -> Trained | None:
    """A saved model, or None if there is none or it was not saved whole."""
    if not path_exists(spark, f"{path}/draws"):
        return None
    row = spark.read.parquet(f"{path}/fit").first().asDict()
    size = row["m_spatial"] * row["m_temporal"]
    domain = hsgp.Domain(**{f.name: row[f.name] for f in fields(hsgp.Domain)})
    model = hsgp.Fit(domain, np.array(row["gram"]).reshape(size, size), np.array(row["proj"]), row["yy"], row["n"], row["y_mean"])
    return Trained(model, spark.read.parquet(f"{path}/draws"), spark.read.parquet(f"{path}/index"))


def train_or_load(snaps: DataFrame, folder: str, name: str = "model", **options) -> tuple[Trained | None, bool]:
    """The saved model if the snapshots are unchanged since its fit, else a new one that is saved; and whether it was fitted."""
    spark = snaps.sparkSession
    if not retrain_needed(snaps, folder, name):
        found = load_model(spark, f"{folder}/{name}")
        if found is not None:
            return found, False
    trained = train(snaps, **options)
    if trained is not None:
        save_model(trained, f"{folder}/{name}")
        mark_trained(snaps, folder, name)
    return trained, True


def predictive_draws(snaps: DataFrame, trained: Trained, horizons=HORIZONS, seed: int = 42) -> DataFrame:
    """Draws (timestamp, region_id, horizon_h, sample_id, value) for every zone and horizon."""
    points = feat.horizon_points(snaps, horizons, index=trained.index)
    weights = hsgp.weight_draws(trained.draws, trained.model, seed)
    return hsgp.predictive(points, weights, trained.model, ["timestamp", "region_id", "horizon_h"], seed)


def forecast_table(snaps: DataFrame, trained: Trained | None, horizons=HORIZONS, seed: int = 42) -> DataFrame:
    """The forecast table; empty without a model."""
    if trained is None:
        return empty_forecasts(snaps.sparkSession)
    draws = store(predictive_draws(snaps, trained, horizons, seed))
    stamps = small_side(draws.select("horizon_h", F.col("timestamp").alias("issued_for")).distinct())
    table = risk.forecasts(draws.drop("timestamp"))
    return (table.drop("timestamp").join(stamps, "horizon_h")
            .select(F.col("issued_for").alias("timestamp"), *[c for c in table.columns if c != "timestamp"]))


def raw_to_forecasts(obs: DataFrame, n_samples: int = 500, hourly: bool = True, seed: int = 42) -> DataFrame:
    """Observations to forecasts: snapshots, model, draws, risk measures."""
    snaps = store(snapshots.snapshots(obs, hourly=hourly))
    return forecast_table(snaps, train(snaps, n_samples, seed=seed), seed=seed)
