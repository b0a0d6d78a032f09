"""A load whose partitioned source lacks the day raises instead of publishing nothing."""

import pytest
from pyspark.sql import functions as F

from starflow.operators.dimensions import MissingDayError, scd1_load, scd2_merge
from starflow.operators.facts import load_fact
from starflow.plans.model import DIMS, FACTS
from starflow.plans.schemas import SOURCES


def day_of(spark, table, rows, day):
    return spark.createDataFrame(rows, SOURCES[table]).withColumn("pt", F.lit(day))


def test_dimension_loads_refuse_an_absent_day(spark):
    src = day_of(spark, "user_info", [], "2026-07-07")
    with pytest.raises(MissingDayError):
        scd2_merge(None, src, DIMS["user"], "2026-07-08")
    assert scd2_merge(None, src, DIMS["user"], "2026-07-08", allow_empty=True).count() == 0
    shops = day_of(spark, "shop_info", [], "2026-07-07")
    with pytest.raises(MissingDayError):
        scd1_load(shops, DIMS["shop"], "2026-07-08")


def test_fact_loads_refuse_an_absent_day(spark):
    src = day_of(spark, "order_info", [], "2026-07-07")
    with pytest.raises(MissingDayError):
        load_fact(src, {}, FACTS["place_order"], DIMS, "2026-07-08")
