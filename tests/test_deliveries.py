"""Repeated and late leads, and models published while a stream goes on."""

import datetime

import pytest
from pyspark.ml.functions import vector_to_array

from sluice.operators import models
from sluice.streaming import (
    deliver, delivery_counts, first_deliveries, lead_stream, publish_model, score_newest, scored_leads,
)

SCHEMA = "Lead_ID long, x double, at timestamp"


@pytest.fixture(scope="module")
def trained(spark):
    def fit(sign):
        rows = [(float(i), "Converted" if sign * (i - 20) + (i % 3 - 1) * 4 > 0 else "Not Converted")
                for i in range(40)]
        df = spark.createDataFrame(rows, "x double, Conversion_Status string")
        return models.fit(models.logistic(df, "Conversion_Status"), df)
    return fit(1), fit(-1)


def leads(spark, ids, day):
    return spark.createDataFrame([(i, float(i), datetime.datetime(2024, 1, day)) for i in ids], SCHEMA)


def test_repeats_late_leads_newer_models_and_restarts(spark, trained, tmp_path):
    inbox, registry, out, checkpoint = (str(tmp_path / n) for n in ("in", "models", "out", "cp"))
    schema = leads(spark, [1], 1).schema

    def run():
        stream = first_deliveries(lead_stream(spark, inbox, schema, files_per_batch=1),
                                  ["Lead_ID"], "at", "5 days")
        started = score_newest(stream, registry, out, checkpoint, ["Lead_ID"])
        started.awaitTermination()
        rows = delivery_counts(spark, started).collect()
        return [sum(r[c] for r in rows) for c in ("arrived", "late", "repeated")]

    def versions():
        return {r.Lead_ID: r.model_version for r in scored_leads(spark, out).collect()}

    assert publish_model(spark, trained[0], registry) == 1
    leads(spark, range(10, 30), 20).coalesce(1).write.mode("append").parquet(inbox)
    assert run() == [20, 0, 0]
    # Ten of these came before, two are older than the watermark of 15 January.
    assert publish_model(spark, trained[1], registry) == 2
    again = leads(spark, range(20, 35), 20).unionByName(leads(spark, [1, 2], 3))
    again.coalesce(1).write.mode("append").parquet(inbox)
    assert run() == [17, 2, 10]
    assert versions() == {i: 1 if i < 30 else 2 for i in range(10, 35)}
    assert run()[0] == 0
    rows = scored_leads(spark, out).collect()
    assert len(rows) == 25 and {r.predicted_status for r in rows} == {"Converted", "Not Converted"}
    by_version = {1: trained[0], 2: trained[1]}
    for r in rows:
        one = by_version[r.model_version].score(leads(spark, [r.Lead_ID], 20)) if r.Lead_ID in (12, 33) else None
        if one is not None:
            expected = one.select(vector_to_array("probability").alias("p")).first().p
            assert r.probability == pytest.approx(expected, abs=1e-9)


def test_a_batch_that_runs_again_replaces_its_rows(spark, trained, tmp_path):
    """The log of finished batches is lost after a batch wrote; it runs again."""
    inbox, registry, out, checkpoint = (str(tmp_path / n) for n in ("in", "models", "out", "cp"))
    publish_model(spark, trained[0], registry)
    leads(spark, range(5), 1).coalesce(1).write.parquet(inbox)
    schema = leads(spark, [1], 1).schema
    for _ in range(2):
        stream = lead_stream(spark, inbox, schema)
        score_newest(stream, registry, out, checkpoint, ["Lead_ID"]).awaitTermination()
        for entry in (tmp_path / "cp" / "commits").glob("*0*"):
            entry.unlink()
    assert sorted(r.Lead_ID for r in scored_leads(spark, out).collect()) == list(range(5))


def test_a_batch_per_delivery_of_many_files(spark, trained, tmp_path):
    inbox, registry, out, checkpoint = (str(tmp_path / n) for n in ("in", "models", "out", "cp"))
    publish_model(spark, trained[0], registry)
    rows = leads(spark, range(50), 1).repartition(5)
    files = deliver(rows, inbox, 2)
    assert files == 5
    stream = first_deliveries(lead_stream(spark, inbox, rows.schema, files_per_batch=files), ["Lead_ID"], "at", "5 days")
    query = score_newest(stream, registry, out, checkpoint, ["Lead_ID"])
    query.awaitTermination()
    counts = sorted((r.arrived, r.repeated) for r in delivery_counts(spark, query).collect() if r.arrived)
    assert counts == [(50, 0), (50, 50)]
    assert scored_leads(spark, out).count() == 50
