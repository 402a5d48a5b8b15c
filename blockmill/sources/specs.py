"""The list of sources: a small JSON setting, typed and checked."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import fields

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from blockmill.config import SourceSpec
from blockmill.session import small_table


def spec_list(text: str) -> list[SourceSpec]:
    """Parse the JSON list; a missing or unknown key is an error."""
    known = {f.name for f in fields(SourceSpec)}
    specs = []
    for entry in json.loads(text):
        if set(entry) != known:
            raise TypeError(f"a source needs exactly {sorted(known)}, got {sorted(entry)}")
        specs.append(SourceSpec(**entry))
    validate_specs(specs)
    return specs


def validate_specs(specs: Sequence[SourceSpec]) -> None:
    """Raise for settings with which no mix can be built."""
    if not specs:
        raise ValueError("at least one source is needed")
    names = [s.name for s in specs]
    if len(set(names)) != len(names):
        raise ValueError(f"source names must differ: {names}")
    for s in specs:
        if s.token_cap is not None and s.token_cap <= 0:
            raise ValueError(f"token_cap of {s.name} must be positive: {s.token_cap}")
        if not 0 <= s.weight < float("inf"):
            raise ValueError(f"weight of {s.name} must be zero or more: {s.weight}")
    if not any(s.weight > 0 for s in specs):
        raise ValueError("at least one source needs a positive weight")


def source_specs(spark: SparkSession, specs: str | Sequence[SourceSpec]) -> DataFrame:
    """The sources as a table in list order, one row each, hinted for broadcast."""
    if isinstance(specs, str):
        specs = spec_list(specs)
    return small_table(spark, {
        "position": pa.array(range(len(specs)), pa.int32()),
        "name": pa.array([s.name for s in specs], pa.string()),
        "dataset": pa.array([s.dataset for s in specs], pa.string()),
        "config": pa.array([s.config for s in specs], pa.string()),
        "text_col": pa.array([s.text_col for s in specs], pa.string()),
        "weight": pa.array([float(s.weight) for s in specs], pa.float64()),
        "token_cap": pa.array([s.token_cap for s in specs], pa.int64()),
    })
