import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac.operators import delay_model as dm
from tarmac.operators import requests as rq
from tarmac.plans.silver import silver_lookup

RUN = dt.datetime(2024, 2, 1)
REQUEST = ("carrier_code string, origin_iata string, dest_iata string, distance_miles int, scheduled_dep_hour int, "
           "day_of_week int, month int, dep_delay_min int")


def test_validation(spark):
    good = ("wn", "den", "LAX", 863, 8, 1, 6, None)
    data = [good, ("W", "Denver", "LAX", 0, 99, 7, 13, 721), (None, "DEN", "LAX", 15000, 0, 0, 1, -60)]
    got = rq.validate_requests(spark.createDataFrame(data, REQUEST)).collect()
    assert (got[0].valid, got[0].carrier_code, got[0].origin_iata, got[0].dep_delay_min) == (True, "WN", "DEN", 0)
    assert set(got[1].reasons) == set(rq.FEATURE_ORDER) - {"dest_iata"} and not got[1].valid
    assert got[2].reasons == ["carrier_code"]


@pytest.fixture(scope="module")
def silver(spark):
    n = 1200
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("flight_event_natural_key"),
        F.element_at(F.array(*[F.lit(c) for c in ("AA", "DL", "WN")]), (F.col("id") % 3 + 1).cast("int")).alias("carrier_code"),
        F.col("id").cast("string").alias("flight_number"), F.lit(dt.date(2024, 1, 10)).alias("flight_date"),
        F.lit("DEN").alias("origin_iata"), F.when(F.col("id") % 2 == 0, "LAX").otherwise("JFK").alias("dest_iata"),
        (F.col("id") % 2000 + 100).cast("int").alias("distance_miles"),
        F.timestamp_seconds(F.lit(1704844800) + (F.col("id") % 24) * 3600).alias("scheduled_dep_ts"),
        F.when(F.col("id") % 10 > 0, (F.col("id") % 60).cast("int")).alias("dep_delay_min"),
        F.when(F.col("id") % 50 > 0, (F.col("id") % 60 + 3).cast("int")).alias("arr_delay_min"),
    )


def test_features(spark, silver):
    got = rq.feature_matrix(silver.filter("flight_number = '10'"))
    assert got.columns == rq.FEATURE_ORDER
    assert tuple(got.first()) == ("DL", "DEN", "LAX", 110, 10, 2, 1, 0)


def test_lookup(spark, silver):
    day = dt.date(2024, 1, 10)
    assert silver_lookup(silver, "DL", 10, day).first().distance_miles == 110
    assert silver_lookup(silver, "AA", 10, day).count() == 0
    assert silver_lookup(silver, "DL", 10, dt.date(2024, 1, 11)).count() == 0


def test_split_ignores_partitioning(spark, silver):
    one = rows(dm.split(silver, "flight_event_natural_key"), "flight_event_natural_key", "is_validation")
    assert one == rows(dm.split(silver.repartition(7), "flight_event_natural_key"), "flight_event_natural_key", "is_validation")
    share = sum(v for _, v in one) / len(one)
    assert 0.15 < share < 0.25
    assert one != rows(dm.split(silver, "flight_event_natural_key", seed=1), "flight_event_natural_key", "is_validation")


def test_registered_model_has_the_declared_parameters(spark, silver, monkeypatch):
    from tarmac.registry import frames, streams

    monkeypatch.setattr(frames, "gold_tables", lambda *_: {"silver_flight_event": silver})
    monkeypatch.setattr(dm, "train", lambda *given, **changed: (len(given), changed))
    monkeypatch.setattr(streams, "_models", {})
    assert streams.model(spark, "declared") == (2, {})


def test_patience_counts_rounds():
    curve = [5.0, 4.0, 4.5, 4.2, 3.9, 4.0, 4.0, 4.0, 1.0]
    assert dm.kept_rounds(curve, 3) == 5 and dm.kept_rounds(curve, 2) == 2 and dm.kept_rounds(curve, 25) == 9
    assert dm.kept_rounds([2.0, 2.0, 2.0]) == 1 and dm.kept_rounds([]) == 0


def test_model_is_cut_at_the_best_round(spark, silver):
    """A rate far too high makes later rounds worse: those go, and the errors of what is left are those of the curve."""
    data = dm.split(dm.training_rows(silver), "flight_event_natural_key")
    model = dm.train(data, RUN, trees=8, learning_rate=1.0, depth=2, max_categories=32, patience=2)
    about, forest = model.metadata, model.pipeline.stages[-1]
    assert forest.getNumTrees == about["best_iteration"] == dm.kept_rounds(about["val_mae_by_round"], 2)
    assert dm.first_trees(forest, 1).getNumTrees == 1 and forest.getFeaturesCol() == "features"
    one = dm.DelayModel(type(model.pipeline)([*model.pipeline.stages[:-1], dm.first_trees(forest, 1)]), about)
    errors = dm.model_mae(one.pipeline.transform(data.filter("is_validation")), 0.0).first()
    assert round(errors.mae_minutes, 4) == about["val_mae_by_round"][0] and errors.constant_mae_minutes > errors.mae_minutes


def test_training_without_validation_rows_keeps_all_rounds(spark, silver):
    data = dm.training_rows(silver).withColumn("is_validation", F.lit(False))
    about = dm.train(data, RUN, trees=3, depth=2, max_categories=32).metadata
    assert about["best_iteration"] == 3 and about["val_mae_minutes"] is None and about["val_mae_by_round"] == []


def test_train_save_load_score(spark, silver, tmp_path):
    data = dm.split(dm.training_rows(silver), "flight_event_natural_key")
    model = dm.train(data, RUN, trees=6, learning_rate=0.5, depth=3, max_categories=32)
    about = model.metadata
    assert 0 < about["val_mae_minutes"] < about["median_mae_minutes"] and len(about["val_mae_by_round"]) == 6
    held_back = model.pipeline.transform(data.filter("is_validation"))
    assert round(dm.model_mae(held_back).first().mae_minutes, 3) == about["val_mae_minutes"]
    assert about["best_iteration"] == model.pipeline.stages[-1].getNumTrees == dm.kept_rounds(about["val_mae_by_round"])
    assert model.metadata["n_rows"] == 1176 and model.metadata["feature_order"] == rq.FEATURE_ORDER
    again = dm.train(data, RUN, trees=6, learning_rate=0.5, depth=3, max_categories=32)
    assert again.metadata == model.metadata
    dm.save(spark, model, str(tmp_path / "m"))
    loaded = dm.load(spark, str(tmp_path / "m"))
    assert loaded.metadata == model.metadata
    features = rq.feature_matrix(silver, "flight_number")
    assert rows(dm.score(loaded, features)) == rows(dm.score(model, features))
    unseen = features.limit(1).withColumn("origin_iata", F.lit("ZZZ"))
    assert dm.score(model, unseen).first().predicted_arr_delay_min is not None
    with pytest.raises(ValueError, match="missing features"):
        dm.score(model, features.drop("month"))
    with pytest.raises(ValueError, match="feature_order"):
        dm.check_contract({"feature_order": rq.FEATURE_ORDER[::-1]})
    asked = spark.createDataFrame(
        [("dl", "10", dt.datetime(2024, 1, 10, 1)), ("AA", "10", dt.datetime(2024, 1, 10, 1)),
         ("DL", "10", dt.datetime(2024, 1, 11, 1)), ("?", "10", dt.datetime(2024, 1, 10, 1))], "carrier_code string, flight_number string, scheduled_dep_ts timestamp")
    got = dm.score_by_id(model, asked, silver)
    assert rows(got, "carrier_code", "status") == [
        ("?", "invalid"), ("AA", "not_found"), ("DL", "not_found"), ("DL", "ok")]
    assert got.filter("predicted_arr_delay_min is not null and feature_source = 'silver'").count() == 1
