"""Places of rows in files that are read in several parts."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from parley.sources import base, readers  # noqa: F401 - registers the readers


@pytest.fixture
def small_parts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(("source", "name", "fields", "first"), [
    ("airoboros", "instructions.jsonl", ("instruction", "response"), "prompt"),
    ("airoboros2", "instructions.jsonl", ("instruction", "response", "system", "category"), "instruction"),
    ("dolly", "databricks-dolly-15k.jsonl", ("instruction", "context", "response"), "instruction"),
])
def test_places_in_json_lines(spark, small_parts, tmp_path, source, name, fields, first):
    os.makedirs(tmp_path / source)
    lines = [json.dumps({f: f"{f} {k}" for f in fields} if k % 7 else {"instruction": "no answer"}) for k in range(120)]
    with open(tmp_path / source / name, "w") as f:
        f.write("\n\n".join(lines) + "\n")  # blank lines are no rows
    d = base.read(spark, source, str(tmp_path))
    assert d.rdd.getNumPartitions() > 3
    assert sorted((r["row"], r[first]) for r in d.collect()) == [(k, f"instruction {k}") for k in range(120) if k % 7]


@pytest.mark.parametrize(("source", "name", "columns", "first"), [
    ("gpt4all_prompt_generations", "p.parquet", ("prompt", "response", "source"), "prompt"), ("openorca", "p.parquet", ("id", "system_prompt", "question", "response"), "id"), ("soda", "train.parquet", ("narrative", "relation", "literal", "original_index"), "narrative"),
])
def test_places_in_parquet(spark, small_parts, tmp_path, source, name, columns, first):
    os.makedirs(tmp_path / source)
    table = {c: [f"{c} {k:03d}" for k in range(120)] for c in columns} | ({"dialogue": [["a"]] * 120, "speakers": [["b"]] * 120} if source == "soda" else {})
    pq.write_table(pa.table(table), tmp_path / source / name, row_group_size=20)
    d = base.read(spark, source, str(tmp_path))
    assert d.rdd.getNumPartitions() > 3
    assert sorted((r["row"], r[first]) for r in d.collect()) == [(k, f"{first} {k:03d}") for k in range(120)]
