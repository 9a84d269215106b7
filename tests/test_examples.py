"""The three example pipelines run end to end on landed sf0.001 payloads."""

import importlib.util
import os

from pyspark.sql import functions as F

from marketlake.plans import fixtures as fx
from marketlake.plans import statements as PS
from marketlake.plans import streams
from marketlake.session import scratch_dir
from marketlake.streaming.tables import KeyedTable

from conftest import SF_SMALL

EXAMPLES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples")


def _load(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(EXAMPLES, f"{name}.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_examples_run(spark):
    root = scratch_dir(spark, "examples")
    _load("ingest_frames").main(streams.land_frames(spark, SF_SMALL), f"{root}/f", 2)
    assert KeyedTable(spark, f"{root}/f", "bars").read().count() > 0

    units = PS.statement_units(spark, SF_SMALL).unionByName(
        PS.calendar_units(spark, SF_SMALL).withColumn("symbol", F.get_json_object("body", "$.symbol"))
        .withColumn("seq", F.col("seq") + F.lit(1 << 40)))
    _load("ingest_statements").main(streams._land(units, spark, "units", ["seq"]), f"{root}/s")
    assert KeyedTable(spark, f"{root}/s", "calendar_dates").read().count() > 0

    pages = streams._land(fx.fx_pages(spark, SF_SMALL), spark, "pages", ["walk_id", "page_no"])
    _load("ingest_markets").main(pages, f"{root}/m")
    assert KeyedTable(spark, f"{root}/m", "polymarket_markets").read().count() > 0
