import pytest

from starflow.plans.model import FACTS, SUMMARIES
from starflow.plans.queries import DIM_SOURCE, Retail
from starflow.plans.schemas import SOURCES, landed_name
from starflow.plans.tables import table_schema, table_schemas
from starflow.sources.catalog import add_partition, create_table, refresh_partitions
from starflow.sources.storage import publish

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def retail(spark):
    return Retail(spark, FOLDER)


def layout(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_there_are_26_tables():
    assert len(table_schemas()) == 26


@pytest.mark.parametrize("table", SOURCES)
def test_landed_layout(retail, table):
    assert layout(retail.landed(table).schema) == layout(table_schema(landed_name(table)))


@pytest.mark.parametrize("name", DIM_SOURCE)
def test_dimension_layout(retail, name):
    assert layout(retail.dim(name).schema) == layout(table_schema(f"dim_{name}"))


@pytest.mark.parametrize("name", FACTS)
def test_fact_layout(retail, name):
    table = FACTS[name].table
    assert layout(retail.fact(name).schema) == layout(table_schema(table))


@pytest.mark.parametrize("name", SUMMARIES)
def test_summary_layout(retail, name):
    got = layout(retail.summary(name).schema)
    assert got == layout(table_schema(SUMMARIES[name].table))


def test_published_table_in_sql(spark, retail, tmp_path):
    root = str(tmp_path / "dim_shop")
    create_table(spark, "shops", table_schema("dim_shop"), root)
    create_table(spark, "shops", table_schema("dim_shop"), root)
    publish(retail.dim("shop"), root, "2026-07-07")
    publish(retail.dim("shop").limit(4), root, "2026-07-08")
    add_partition(spark, "shops", "2026-07-08")
    assert [r.pt for r in spark.sql("SELECT DISTINCT pt FROM shops").collect()] == ["2026-07-08"]
    refresh_partitions(spark, "shops")
    counts = spark.sql("SELECT pt, count(*) AS n FROM shops GROUP BY pt").collect()
    assert {(r.pt, r.n) for r in counts} == {("2026-07-07", 10), ("2026-07-08", 4)}
    spark.sql("DROP TABLE shops")
