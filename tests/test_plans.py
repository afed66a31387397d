"""What plans show and when jobs run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.keys import hmac_sha256
from sedimenta.operators import reshape
from sedimenta.operators.chunks import encrypt
from sedimenta.testbed import frames as fr
from sedimenta.testbed.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["m1_over_limit_latest", "m3_historic_peak", "alias_resolution", "governance_filter", "band_lookup"])
def test_building_a_frame_runs_no_job(spark, name):
    for table in ("lineitem", "supplier", "nation", "region"):
        fr.table(spark, FOLDER, table)  # reads footers
    context = spark.sparkContext
    context.setJobGroup(f"build {name}", name)
    QUERIES[name](spark, FOLDER)
    assert list(context.statusTracker().getJobIdsForGroup(f"build {name}")) == []


def test_bronze_is_built_without_a_job(spark):
    wide = spark.createDataFrame([("A", "Semanas", "1"), ("A", "P1", "0.5")], "planta string, etiqueta string, column01 string")
    spark.sparkContext.setJobGroup("build bronze", "bronze")
    reshape.wide_to_bronze(wide)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build bronze")) == []


def test_plans_do_not_show_keys(spark):
    key = b"0123456789abcdef0123456789abcdef"
    text = F.col("id").cast("string")
    shown = spark.range(3).select(hmac_sha256(text, key), encrypt(text, key))._jdf.queryExecution().toString()
    assert "redacted" in shown and key.hex() not in shown.lower()
    assert bytes(b ^ 0x36 for b in key).hex() not in shown.lower()
