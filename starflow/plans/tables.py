"""Schemas of every published table, derived from the landed schemas and the specs."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from starflow.plans.model import DIMS, FACTS, SUMMARIES
from starflow.plans.schemas import SOURCES, landed_name
from starflow.specs import DimSpec, FactSpec, SummarySpec

_TEXT, _LONG, _FLAG, _TIME = StringType(), LongType(), IntegerType(), TimestampType()
_METRIC_TYPES = {"bigint": _LONG, "decimal(18,2)": DecimalType(18, 2)}
_BY_LANDED_NAME = {landed_name(t): schema for t, schema in SOURCES.items()}


def landed_schema(table: str) -> StructType:
    extra = {"etl_time": _TEXT, "pt": _TEXT}
    return _struct({f.name: f.dataType for f in SOURCES[table].fields} | extra)


def dimension_schema(spec: DimSpec) -> StructType:
    src = _BY_LANDED_NAME[spec.source]
    columns: dict[str, DataType] = {spec.sk: _LONG}
    columns |= {c: src[c].dataType for c in (spec.key, *spec.attributes)}
    if spec.tracked:
        columns |= {"begin_date": _TEXT, "end_date": _TEXT, "is_active": _FLAG}
    columns |= {"etl_insert_time": _TIME, "etl_update_time": _TIME}
    return _struct(columns | {"pt": _TEXT})


def fact_schema(spec: FactSpec) -> StructType:
    src = _BY_LANDED_NAME[spec.source]
    columns: dict[str, DataType] = {spec.grain: _LONG, spec.sk: _LONG}
    columns |= {DIMS[d].sk: _LONG for d, _ in spec.lookups}
    columns |= {c: src[c].dataType for c in (*spec.carried, *spec.measure_names)}
    columns |= {"is_valid": _FLAG, "etl_insert_time": _TIME, "etl_update_time": _TIME}
    return _struct(columns | {"source_system": _TEXT, "pt": _TEXT})


def summary_schema(spec: SummarySpec) -> StructType:
    columns: dict[str, DataType] = {DIMS[d].key: _LONG for d in spec.grain}
    for d in spec.grain:
        src = _BY_LANDED_NAME[DIMS[d].source]
        columns |= {a: src[a].dataType for a in spec.attributes.get(d, ())}
    columns |= {m.name: _METRIC_TYPES[m.dtype] for m in spec.metrics}
    return _struct(columns | {"dt": _TEXT})


@cache
def table_schemas() -> dict[str, StructType]:
    """All 26 tables by name; the partition column comes last."""
    found = {landed_name(t): landed_schema(t) for t in SOURCES}
    found |= {d.table: dimension_schema(d) for d in DIMS.values()}
    found |= {f.table: fact_schema(f) for f in FACTS.values()}
    return found | {s.table: summary_schema(s) for s in SUMMARIES.values()}


def table_schema(name: str) -> StructType:
    return table_schemas()[name]


def _struct(columns: dict[str, DataType]) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema
