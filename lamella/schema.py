"""Schemas of the stages' tables, and their check.

A stage's output is a table with fixed columns; assert_schema stands where a written table is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

SCHEMAS: dict[str, str] = {
    "image": "z int, y int, x int, v double",
    "feature": "z int, y int, x int, feature string, v double",
    "probability": "z int, y int, x int, p double",
    "segmentation": "z int, seg int, y int, x int, is_boundary boolean",
    "seglabel": "block bigint, z int, seg int, y int, x int, label int",
    "labels": "block bigint, z int, y int, x int, label bigint",
    "merges": "a bigint, b bigint",
    "remap": "old bigint, new bigint",
    "stumps": "feature string, thr double, lo double, hi double",
    "forest": "tree int, node int, status int, feature int, thr double, left int, right int, cls int",
    "tile_index": "id bigint, w int, x int, y int, z int",
    "edges": "src bigint, dst bigint, w double",
}


def schema_of(name: str) -> StructType:
    return _parse_datatype_string(SCHEMAS[name])


def assert_schema(df: DataFrame, name: str) -> DataFrame:
    """df, if its columns are exactly those of the named table; else a ValueError that names the difference."""
    want = {f.name: f.dataType for f in schema_of(name)}
    have = {f.name: f.dataType for f in df.schema}
    if want != have:
        raise ValueError(f"{name}: missing {sorted(want.keys() - have.keys())}, unknown {sorted(have.keys() - want.keys())}, of another type {sorted(k for k in want.keys() & have.keys() if want[k] != have[k])}")
    return df
