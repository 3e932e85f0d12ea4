"""Queries against their SQL on texts that the small tables lack."""

from __future__ import annotations

import itertools
import re
import time

import duckdb
from pyspark.sql import functions as F

from parley.functions import html_md
from parley.plans import queries


def test_story_markers(spark, tmp_path):
    texts = ["", "a", "a\n", "\n", "\n\n", "a\r\nb", "a\rb\n\nc", "a\x0bb\x1cc\x85d e", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = sorted(con.sql(queries.ORACLE["story_markers"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["story_markers"](spark, str(tmp_path)).collect()) == wanted


def test_emphasis_grows_with_the_text(spark):
    texts = ["a*b*c **d** e*f", "a***b", "é*é**ß*x", "*a*", "", None, "the*end " + "th*e*s **" * 20_000]

    def spaced(text):
        turns = itertools.cycle((" {}", "{} "))
        return None if text is None else re.sub(r"(?<=\w)\*{1,2}(?=\w)", lambda m: next(turns).format(m[0]), text)

    d = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    began = time.time()
    assert [r["t"] for r in d.select("k", html_md.loosen_emphasis(F.col("t")).alias("t")).orderBy("k").collect()] == [spaced(t) for t in texts]
    assert time.time() - began < 30  # 40,000 marks; each of them looked for once
