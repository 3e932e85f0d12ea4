"""CSV that is read in blocks, against Spark's reader of whole files."""

from __future__ import annotations

import csv
import json
import os
import random

import pytest

from parley.plans import source_queries, tasks
from parley.sources import base


@pytest.fixture
def small_parts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_blocks(spark, small_parts, tmp_path, end):
    rng = random.Random(3)
    for k in range(3):
        rows = ["x,y"]
        for i in range(150):
            inside = "".join(rng.choice(["a", "é", ",", '""', end, "  ", "b c", end * 3]) for _ in range(rng.choice([0, 3, 9])))
            rows.append(rng.choice([f'{i},"{inside}"', f'"{i}","{inside}"', f'{i},a"b', f'{i},"q"z', f"{i},", f'{i},""', "", f"{i}", f"{i},1,2", f'"{i}{end * 400}",z' if i == 70 else f"{i},w", " "]))
        with open(tmp_path / f"f{k}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(end.join(rows) + end)
    for k in range(3):
        path = f"{tmp_path}/f{k}.csv"
        wanted = [tuple(r) for r in spark.read.schema("x string, y string").option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).fillna("").collect()]
        d = base.csv(spark, path, "x string, y string")
        assert d.rdd.getNumPartitions() > 3
        got = sorted((r["row"], r["x"], r["y"]) for r in d.collect())
        assert got == [(i, *w) for i, w in enumerate(wanted)]


def test_csv_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("y,x\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        base.csv(spark, f"{tmp_path}/a.csv", "x string, y string")


def test_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source_queries, "PART_ROWS", 100, raising=False)
    texts = [(c, t, ("user", "assistant")[t % 2], f"said {c}\n{t}") for c in range(200) for t in range(4)]
    spark.createDataFrame(texts, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = source_queries._ordered(spark, str(tmp_path), {"k": "k"})
    assert rows.rdd.getNumPartitions() > 4
    d = base.read(spark, "whocars", source_queries._root(spark, str(tmp_path), "whocars"))
    asked = [r["prompt_json"][1]["content"] for r in d.orderBy("row").collect()]
    assert asked == [f"said {c}\n{t}" for c in range(200) for t in (0, 2) if (c * 1000 + t) % 13]


def test_roleplay_task_reads_blocks(spark, small_parts, tmp_path):
    said = [json.dumps([{"role": "system", "content": "You play."}, {"role": "user", "content": f"a \"{k}\",\n{k}?"}, {"role": "assistant", "content": f"b {k}\n\n"}], indent=1) for k in range(60)]
    os.makedirs(tmp_path / "whocars")
    with open(tmp_path / "whocars" / "logs.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["model", "endpoint", "prompt json", "response"], *[["gpt-4", "openai", s, "r\n"] for s in said]])
    assert base.read(spark, "whocars", str(tmp_path)).rdd.getNumPartitions() > 3
    got = {r["identifier"]: r["turns"][1]["utterance"] for r in tasks.run(spark, "WhocarsRoleplayTask", str(tmp_path)).collect()}
    assert got == {f"whocars-{k}": f"a \"{k}\",\n{k}?" for k in range(60)}
