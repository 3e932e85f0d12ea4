"""Registered queries of the readers, the tasks and the build.

The tables have no files of the sources' layouts, so each query first writes
one from the whole table ``conversations`` (a question, and the answer that
follows it), with rows that a reader must leave out, and then reads it back.
The SQL oracles say what must come out, from the table alone. Order within a
file has meaning: tasks write its parts, which are joined in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import picks, templates
from parley.plans import banks as B
from parley.plans import build, tasks
from parley.plans.queries import _q, _read, _sql_bank, _sql_one_of, query
from parley.session import shared_folder
from parley.sources import base

_PAIRS = "SELECT a.conv_id, a.turn, a.text AS asked, b.text AS told, a.conv_id * 1000 + a.turn AS k FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'"
_P = f"WITH p AS (SELECT *, row_number() OVER (ORDER BY k, asked, told) - 1 AS row FROM ({_PAIRS}))"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _read(spark, sf_dir, "conversations")
    b = a.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("told"), F.col("role").alias("answers"))
    p = a.filter("role = 'user'").withColumnRenamed("text", "asked").join(b.filter("answers = 'assistant'"), ["conv_id", "turn"])
    return p.select("conv_id", "turn", "asked", "told", (F.col("conv_id") * 1000 + F.col("turn")).alias("k"))


#: Rows and bytes of the table for each part of a file: parts grow in number, not in size.
PART_ROWS, PART_BYTES = 20_000, 8 << 20


def _one_file(rows: DataFrame, path: str, kind: str, head: str = "", tail: str = "", **options) -> None:
    """Write rows, in the order of their partitions, to one file of this name.

    Tasks write a part each. The driver joins the parts' bytes, or row groups, a buffer at a time.
    """
    at, spark = f"{path}.parts", rows.sparkSession
    rows.write.options(**options).format(kind).save(at)
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    to = hadoop.fs.Path(path)
    fs = to.getFileSystem(conf)
    parts = sorted((f.getPath() for f in fs.globStatus(hadoop.fs.Path(f"{at}/part-*"))), key=lambda p: p.getName())
    fs.mkdirs(to.getParent())
    if kind == "parquet":
        parquet = spark._jvm.org.apache.parquet.hadoop
        files = [parquet.util.HadoopInputFile.fromPath(p, conf) for p in parts]
        first = parquet.ParquetFileReader.open(files[0])
        meta = first.getFooter().getFileMetaData()
        first.close()
        out = parquet.ParquetFileWriter(parquet.util.HadoopOutputFile.fromPath(to, conf), meta.getSchema(), parquet.ParquetFileWriter.Mode.CREATE, 128 << 20, 8 << 20)
        out.start()
        for f in files:
            out.appendFile(f)
        out.end(meta.getKeyValueMetaData())
    else:
        out = fs.create(to)
        out.write(bytearray(head.encode()))
        for p in parts:
            part = fs.open(p)
            hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
        out.write(bytearray(tail.encode()))
        out.close()
    fs.delete(hadoop.fs.Path(at), True)


def _ordered(spark: SparkSession, sf_dir: str, fields: dict[str, str]) -> DataFrame:
    """The fields, as expressions over the pairs, in order: each partition's rows come before the next one's."""
    table, at = _read(spark, sf_dir, "conversations"), spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/conversations.parquet")
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    parts = 1 + max(table.count() // PART_ROWS, size // PART_BYTES)
    keys = ["k", "asked", "told"]
    return _pairs(spark, sf_dir).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(*[F.expr(e).alias(c) for c, e in fields.items()])


def _json(rows: DataFrame, path: str, array: bool) -> None:
    """JSON Lines, or one array; null fields are missing keys."""
    line = F.to_json(F.struct(*rows.columns))
    if array:  # it ends with an object without keys, which is no record
        _one_file(rows.select(F.concat(line, F.lit(",")).alias("value")), path, "text", "[\n", "{}]\n")
    else:
        _one_file(rows.select(line.alias("value")), path, "text")


def _csv(rows: DataFrame, path: str) -> None:
    _one_file(rows, path, "csv", ",".join(f'"{c}"' for c in rows.columns) + "\n", header=False, quoteAll=True, escape='"', emptyValue="")


#: What is planted: answers that are missing, empty or odd, and contexts that are missing, empty or given.
_TOLD = "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '' ELSE told END"
_NOTE = "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '' ELSE concat('Note ', CAST(k AS STRING)) END"
_NOTE_SQL = _NOTE.replace("AS STRING", "AS VARCHAR")
_TALK = "transform(array(0, 1), i -> named_struct('from', CASE WHEN i = 0 THEN 'human' WHEN k % 11 = 0 THEN 'system' ELSE 'gpt' END, 'value', CASE WHEN i = 0 THEN asked WHEN k % 17 = 0 THEN '' WHEN k % 7 = 0 THEN concat('and ', told) ELSE told END))"
_TALK_TOLD = "CASE WHEN k % 17 = 0 THEN '' WHEN k % 7 = 0 THEN concat('and ', told) ELSE told END"

Stage = Callable[[SparkSession, str, str], None]
STAGES: dict[str, Stage] = {}


def _stage(source: str, name: str, fields: dict[str, str], array: bool = False) -> None:
    def write(spark: SparkSession, sf_dir: str, root: str) -> None:
        _json(_ordered(spark, sf_dir, fields), f"{root}/{source}/{name}", array)

    STAGES[source] = write


_stage("airoboros", "instructions.jsonl", {"instruction": "asked", "response": "CASE WHEN k % 19 = 0 THEN ' AIROBOROS\n' ELSE " + _TOLD + " END"})
_stage("airoboros2", "instructions.jsonl", {"instruction": "asked", "response": _TOLD, "system": "'A chat.'", "category": "CASE WHEN k % 5 = 0 THEN 'orca' WHEN k % 5 = 1 THEN 'trivia' ELSE 'general' END"})
_stage("claude-evol", "claude_evol_instruct_210k.json", {"instruction": "asked", "output": "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 4 = 0 THEN concat('Hi, I''m Claude. ', told) ELSE told END"}, True)
_stage("claude-multiround", "claude_multiround_chat_30k.json", {"id": "CAST(k AS STRING)", "conversations": f"CASE WHEN k % 13 = 0 THEN NULL ELSE {_TALK} END"}, True)
_stage("dolly", "databricks-dolly-15k.jsonl", {"instruction": "concat('What  is ', asked)", "context": _NOTE, "response": _TOLD})
_stage("evol-instruct", "alpaca_evol_instruct_70k.json", {"instruction": "CASE WHEN k % 7 = 0 THEN concat('No Output ', asked) ELSE asked END", "output": _TOLD}, True)
_stage("gpt-4-llm", "alpaca_gpt4_data.json", {"instruction": "asked", "input": _NOTE, "output": _TOLD}, True)
_stage("supercot", "filtered.json", {"instruction": "asked", "input": "CASE WHEN k % 2 = 0 THEN concat('Note ', CAST(k AS STRING)) END", "rewritten_intent": "CASE WHEN k % 2 = 1 THEN 'Intent' END", "output": "CASE WHEN k % 13 = 0 THEN NULL ELSE told END"}, True)
_stage("wizard_vicuna_70k", "wizard_vicuna_dataset.json", {"id": "CAST(k AS STRING)", "conversations": _TALK}, True)


def _gpteacher(spark: SparkSession, sf_dir: str, root: str) -> None:
    rows = _ordered(spark, sf_dir, {"instruction": "asked", "input": _NOTE, "response": _TOLD, "m": "k % 3"})
    for m, name in enumerate(("Instruct/gpt4-instruct-similarity-0.9", "Roleplay/roleplay-similarity_0.9-instruct", "Toolformer/toolformer-similarity-0.9")):
        _json(rows.filter(F.col("m") == m).drop("m"), f"{root}/gpteacher/{name}-dataset.json", True)


def _whocars(spark: SparkSession, sf_dir: str, root: str) -> None:
    prompt = "to_json(array(named_struct('role', CASE WHEN k % 5 = 0 THEN 'user' ELSE 'system' END, 'content', 'You help.'), named_struct('role', 'user', 'content', asked), named_struct('role', 'assistant', 'content', told)))"
    fields = {"model": "CASE WHEN k % 3 = 0 THEN 'gpt-3.5' ELSE 'gpt-4-0314' END", "endpoint": "CASE WHEN k % 7 = 0 THEN 'other' ELSE 'openai' END", "prompt json": f"CASE WHEN k % 13 = 0 THEN 'oops' ELSE {prompt} END", "response": "told"}
    _csv(_ordered(spark, sf_dir, fields), f"{root}/whocars/logs.csv")


def _parquet(source: str, name: str, fields: dict[str, str]) -> None:
    def write(spark: SparkSession, sf_dir: str, root: str) -> None:
        _one_file(_ordered(spark, sf_dir, fields), f"{root}/{source}/{name}", "parquet")

    STAGES[source] = write


_parquet("gpt4all_prompt_generations", "data.parquet", {"prompt": "asked", "response": "told", "source": "'x'"})
_parquet("openorca", "1M-GPT4.parquet", {"id": "concat('t.', CAST(k AS STRING))", "system_prompt": "CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'You are a guide.  Be brief.' ELSE 'Think.' END", "question": "asked", "response": "told"})
_parquet("soda", "train.parquet", {"narrative": "asked", "dialogue": "array(asked, told)", "speakers": "array('Ann', 'Bo')", "relation": "'xWant'", "literal": "'so'", "original_index": "CAST(k AS STRING)"})
STAGES |= {"gpteacher": _gpteacher, "whocars": _whocars}


def _stories(spark: SparkSession, sf_dir: str, root: str) -> None:
    fields = {"story_title": "concat('T', CAST(k AS STRING))", "story_author": "'Ann \"A\" B'", "story_date": "'2001'", "story_tags": "'[''bd'']'", "story_summary": "asked", "story_href": "''", "story_header": "''", "story": "told", "story_footer": "'end'"}
    _csv(_ordered(spark, sf_dir, fields), f"{root}/mcstories/mcstories--all.csv")


def _forum(spark: SparkSession, sf_dir: str, root: str) -> None:
    _csv(_ordered(spark, sf_dir, {"thread_title": "concat('Thread ', CAST(floor(conv_id / 3) % 5 AS STRING))", "message_username": "concat('u', CAST(turn AS STRING))", "message": "asked"}), f"{root}/rp_forums/board.csv")


def _guild(spark: SparkSession, sf_dir: str, root: str) -> None:
    tags = "CASE WHEN k % 2 = 0 THEN '[\"Fantasy\", ''1x1'']' ELSE '[''Modern'']' END"
    _csv(_ordered(spark, sf_dir, {"thread_title": "concat('Thread ', CAST(floor(conv_id / 3) % 5 AS STRING))", "thread_type": "CASE WHEN conv_id % 2 = 0 THEN '1x1' ELSE 'group' END", "thread_tags": tags, "message_username": "concat('u', CAST(turn AS STRING))", "message": "told"}), f"{root}/rp-guild/board.csv")


def _adventures(spark: SparkSession, sf_dir: str, root: str) -> None:
    lines = _ordered(spark, sf_dir, {"value": "concat('<|startoftext|>', told, '\n> ', replace(asked, '\n', ' '), '\n<|endoftext|>')"})
    _one_file(lines, f"{root}/ai-dungeon/text_adventures.txt", "text")


STAGES |= {"mcstories": _stories, "rp_forums": _forum, "rp-guild": _guild, "ai-dungeon": _adventures}


def _root(spark: SparkSession, sf_dir: str, *sources: str) -> str:
    root = f"{shared_folder(spark)}/sources-{uuid.uuid4().hex}"
    for s in sources:
        STAGES[s](spark, sf_dir, root)
    return root


def _source(source: str, sql: str, columns: list[str]) -> None:
    @query(f"source_{source.replace('-', '_')}", sql)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return base.read(spark, source, _root(spark, sf_dir, source)).select(*[F.expr(c) for c in columns])


_source("airoboros", f"{_P} SELECT asked AS prompt, CASE WHEN k % 19 = 0 THEN ' AIROBOROS' || chr(10) ELSE {_TOLD} END AS generation, row FROM p WHERE k % 13 <> 0 OR k % 19 = 0", ["prompt", "generation", "row"])
_source("airoboros2", f"{_P} SELECT asked AS instruction, {_TOLD} AS response, 'A chat.' AS system_prompt, CASE WHEN k % 5 = 0 THEN 'orca' WHEN k % 5 = 1 THEN 'trivia' ELSE 'general' END AS category, row FROM p WHERE k % 13 <> 0", ["instruction", "response", "system_prompt", "category", "row"])
_source("claude-evol", f"{_P} SELECT asked AS prompt, CASE WHEN k % 4 = 0 THEN 'Hi, I''m Claude. ' || told ELSE told END AS generation, row FROM p WHERE k % 13 <> 0", ["prompt", "generation", "row"])
_source("claude-multiround", f"{_P} SELECT CAST(k AS VARCHAR) AS id, CAST(2 AS INTEGER) AS n, asked, CASE WHEN k % 11 = 0 THEN 'system' ELSE 'gpt' END AS who, {_TALK_TOLD} AS told, row FROM p WHERE k % 13 <> 0", ["id", "size(conversation) AS n", "conversation[0].value AS asked", "conversation[1].from AS who", "conversation[1].value AS told", "row"])
_source("dolly", f"{_P} SELECT 'What  is ' || asked AS instruction, {_NOTE_SQL} AS input, {_TOLD} AS output, row FROM p WHERE k % 13 <> 0", ["instruction", "input", "output", "row"])
_source("evol-instruct", f"{_P} SELECT CASE WHEN k % 7 = 0 THEN 'No Output ' || asked ELSE asked END AS instruction, {_TOLD} AS output, row FROM p WHERE k % 13 <> 0", ["instruction", "output", "row"])
_source("gpt-4-llm", f"{_P} SELECT asked AS instruction, {_NOTE_SQL} AS input, {_TOLD} AS output, row FROM p WHERE k % 13 <> 0", ["instruction", "input", "output", "row"])
_source("gpt4all_prompt_generations", f"{_P} SELECT asked AS prompt, told AS response, 'x' AS source, row FROM p", ["prompt", "response", "source", "row"])
_source("gpteacher", f"{_P} SELECT k % 3 AS part, asked AS instruction, {_NOTE_SQL} AS input, {_TOLD} AS output FROM p WHERE k % 13 <> 0", ["CAST(substring(file, 1, 1) AS BIGINT) AS part", "instruction", "input", "output"])
_source("openorca", f"{_P} SELECT 't.' || k AS id, CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'You are a guide.  Be brief.' ELSE 'Think.' END AS system_prompt, asked AS question, told AS response, row FROM p", ["id", "system_prompt", "question", "response", "row"])
_source("soda", f"{_P} SELECT asked AS narrative, told, 'Ann,Bo' AS speakers, CAST(k AS VARCHAR) AS original_index, row FROM p", ["narrative", "dialogue[1] AS told", "array_join(speakers, ',') AS speakers", "original_index", "row"])
_source("supercot", f"{_P} SELECT asked AS instruction, CASE WHEN k % 2 = 0 THEN 'Note ' || k ELSE 'Intent' END AS input, told AS output, row FROM p WHERE k % 13 <> 0", ["instruction", "input", "output", "row"])
_source("whocars", f"{_P} SELECT CASE WHEN k % 3 = 0 THEN 'gpt-3.5' ELSE 'gpt-4-0314' END AS model, CASE WHEN k % 7 = 0 THEN 'other' ELSE 'openai' END AS endpoint, CASE WHEN k % 5 = 0 THEN 'user' ELSE 'system' END AS lead, asked, told, told AS response FROM p WHERE k % 13 <> 0", ["model", "endpoint", "prompt_json[0].role AS lead", "prompt_json[1].content AS asked", "prompt_json[2].content AS told", "response"])
_source("wizard_vicuna_70k", f"{_P} SELECT CAST(k AS VARCHAR) AS id, asked AS human_question, {_TALK_TOLD} AS gpt_response, row FROM p WHERE k % 11 <> 0", ["id", "human_question", "gpt_response", "row"])
_source("mcstories", f"{_P} SELECT 'T' || k AS title, 'Ann \"A\" B' AS author, '2001' AS date, '[''bd'']' AS tags, asked AS summary, '' AS href, '' AS header, told AS text_contents, 'end' AS footer FROM p", ["title", "author", "date", "tags", "summary", "href", "header", "text_contents", "footer"])
_RUNS = "t AS (SELECT *, 'Thread ' || CAST(CAST(floor(conv_id / 3) AS BIGINT) % 5 AS VARCHAR) AS title, CASE WHEN conv_id % 2 = 0 THEN '1x1' ELSE 'group' END AS kind FROM p)"
_ISLANDS = "g AS (SELECT *, sum(new) OVER (ORDER BY row) AS island FROM (SELECT *, CASE WHEN row > 0 AND {0} THEN 1 ELSE 0 END AS new FROM (SELECT *, lag(title) OVER (ORDER BY row) AS t0, lag(kind) OVER (ORDER BY row) AS k0 FROM t)))"
_source("rp_forums", f"{_P}, {_RUNS}, {_ISLANDS.format('title <> t0')} SELECT any_value(title) AS thread_name, count(*) AS n, string_agg('u' || turn, ',' ORDER BY row) AS authors, string_agg(asked, '|' ORDER BY row) AS said, 'mixed' AS content_type, 'board.csv' AS source_file, CAST(island AS BIGINT) AS row FROM g GROUP BY island", ["thread_name", "CAST(size(messages) AS BIGINT) AS n", "array_join(messages.author, ',') AS authors", "array_join(messages.message, '|') AS said", "content_type", "source_file", "row"])
_source("rp-guild", f"{_P}, {_RUNS}, {_ISLANDS.format('(title <> t0 OR kind <> k0)')} SELECT any_value(title) AS thread_name, any_value(kind) AS thread_type, CASE WHEN last(k ORDER BY row) % 2 = 0 THEN 'Fantasy,1x1' ELSE 'Modern' END AS tags, string_agg(told, '|' ORDER BY row) AS said, CAST(island AS BIGINT) AS row FROM g WHERE island < (SELECT max(island) FROM g) GROUP BY island", ["thread_name", "thread_type", "array_join(tags, ',') AS tags", "array_join(messages.message, '|') AS said", "row"])
_source("ai-dungeon", f"{_P} SELECT '<|startoftext|>' || told || chr(10) || '> ' || replace(asked, chr(10), ' ') || chr(10) || '<|endoftext|>' || chr(10) AS story FROM p", ["story"])


# -- tasks ---------------------------------------------------------------------
def _task(name: str, source: str, sql: str, bank, prefix: str, where: str = "true", start: int = 0, before: str = "true", key: str | None = None, system: str | None = None, **options) -> None:
    """A task of three turns. ``before`` holds for the records that are numbered, ``where`` for those of them that stay."""
    numbered = f"n AS (SELECT *, row_number() OVER (ORDER BY row) - 1 + {start} AS idx FROM p WHERE {before})"
    keyed = f"i AS (SELECT *, {_q(prefix)} || {key or 'idx'} AS identifier FROM n WHERE {where})"
    own = system or "bank"
    said = f"SELECT identifier, {own.replace('bank', _sql_bank(templates.bank(bank), 'identifier', 'system'))} AS system, {sql} FROM i"

    @query(f"task_{name}", f"{_P}, {numbered}, {keyed} {said}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = tasks.run(spark, name, _root(spark, sf_dir, source), picks.SEED, **options)
        said = [F.col("turns")[k]["utterance"].alias(c) for k, c in enumerate(("system", "user", "model"))]
        return made.filter(F.size("turns") == 3).select("identifier", *said)


_AIRO = f"CASE WHEN k % 19 = 0 THEN ' AIROBOROS' || chr(10) ELSE {_TOLD} END"
_task("AiroborosInstructionFollowingTask", "airoboros", f"asked AS user, {_AIRO} AS model", B.ASSISTANT, "airoboros-instruct-", "k % 19 <> 0", 1, "k % 13 <> 0 OR k % 19 = 0")
_task("AiroborosGuessTheInstructionTask", "airoboros", f"{_AIRO} AS user, asked AS model", B.GUESS, "airoboros-gti-", "k % 19 <> 0", 1, "k % 13 <> 0 OR k % 19 = 0")
_task("ClaudeEvolInstructTask", "claude-evol", "asked AS user, CASE WHEN k % 4 = 0 THEN 'Hi, I''m Parley. ' || told ELSE told END AS model", B.ASSISTANT, "claude-evol-instruct-", before="k % 13 <> 0")
_task("ClaudeGuessTheInstructionTask", "claude-multiround", f"{_TALK_TOLD} AS user, asked AS model", B.GUESS, "claude-gti-", f"{_TALK_TOLD} <> ''", before="k % 13 <> 0", key="k")
_task("ClaudeInstructTask", "claude-multiround", f"asked AS user, {_TALK_TOLD} AS model", B.ASSISTANT, "claude-instruct-", f"{_TALK_TOLD} <> ''", before="k % 13 <> 0", key="k")
_CONTEXT = f"CASE WHEN coalesce({_NOTE_SQL}, '') = '' THEN '' ELSE ltrim({_sql_one_of(list(B.DOLLY_CONTEXT), 'identifier', 'context')} || ({_NOTE_SQL}), chr(10) || ' ') END"
_task("DollyGuessTheInstructionTask", "dolly", f"replace(replace({_sql_bank(templates.bank(B.DOLLY_USER), 'identifier', 'user')}, '<INFO>', {_TOLD}), '<CONTEXT>', {_CONTEXT}) AS user, 'What is ' || asked AS model", B.GUESS, "dolly-", before="k % 13 <> 0")
_task("OpenOrcaInstructionFollowingTask", "openorca", "asked AS user, told AS model", B.ASSISTANT, "openorca-", key="'t.' || k", system="CASE WHEN k % 3 = 0 THEN bank WHEN k % 3 = 1 THEN bank || ' Be brief.' ELSE bank || ' Think.' END")
_OWN = f"(coalesce({_NOTE_SQL}, '') <> '' AND NOT contains(asked, {_NOTE_SQL}))"
_TEACH = "p AS (SELECT conv_id, turn, asked, told, k, row_number() OVER (ORDER BY k % 3, row) - 1 AS row FROM q)"


@query("task_SingleTurnInstructionFollowingTask", f"{_P.replace('WITH p AS', 'WITH q AS')}, {_TEACH}, n AS (SELECT *, row_number() OVER (ORDER BY row) - 1 AS idx FROM p WHERE k % 13 <> 0), i AS (SELECT *, 'gpteacher-' || idx AS identifier FROM n) SELECT identifier, CASE WHEN {_OWN} THEN asked ELSE {_sql_bank(templates.bank(B.ASSISTANT), 'identifier', 'system')} END AS system, CASE WHEN {_OWN} THEN {_NOTE_SQL} ELSE asked END AS user, {_TOLD} AS model FROM i")
def single_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = tasks.run(spark, "SingleTurnInstructionFollowingTask", _root(spark, sf_dir, "gpteacher"), picks.SEED)
    return made.select("identifier", *[F.col("turns")[k]["utterance"].alias(c) for k, c in enumerate(("system", "user", "model"))])


_task("SuperCotInstructionFollowingTask", "supercot", "asked || chr(10) || CASE WHEN k % 2 = 0 THEN 'Note ' || k ELSE 'Intent' END AS user, told AS model", B.ASSISTANT, "supercot-", before="k % 13 <> 0")
_task("WizardVicunaQuestionAnsweringTask", "wizard_vicuna_70k", f"asked AS user, {_TALK_TOLD} AS model", B.ASSISTANT, "wizard-vicuna-", f"{_TALK_TOLD} <> '' AND NOT regexp_matches({_TALK_TOLD}, '^[a-z ]')", before="k % 11 <> 0", key="k || '-' || idx")
_task("WhocarsRoleplayTask", "whocars", "asked AS user, told AS model", B.ASSISTANT, "whocars-", "k % 7 <> 0 AND k % 3 <> 0 AND k % 5 <> 0", before="k % 13 <> 0", system="'{{user}} help.'")


# -- the build -------------------------------------------------------------------
_BUILT = f"""{_P}, n AS (SELECT *, row_number() OVER (ORDER BY row) - 1 AS idx FROM p), i AS (SELECT *, 'openorca-t.' || k AS identifier FROM n)
SELECT '<|system|>' || replace(CASE WHEN k % 3 = 0 THEN s WHEN k % 3 = 1 THEN s || ' Be brief.' ELSE s || ' Think.' END, '~', '') || '<|user|>' || asked || '<|model|>' AS prompt, trim(told, ' ' || chr(10)) AS generation, identifier || '-0' AS identifier
FROM (SELECT *, {_sql_bank(templates.bank(B.ASSISTANT), 'identifier', 'system')} AS s FROM i) WHERE NOT contains(s, '{{{{')"""


@query("build_jsonl", _BUILT)
def build_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build to JSON Lines and back; prompts with a placeholder for a hint are left to ``examples_hinted``."""
    root = _root(spark, sf_dir, "openorca")
    config = build.Config(["OpenOrcaInstructionFollowingTask"], output=f"{root}/out", max_length=1_000_000, root=root)
    found = build.examples(spark, config)
    hinted = tasks.run(spark, "OpenOrcaInstructionFollowingTask", root, config.seed).filter(F.col("turns")[0]["utterance"].contains("{{")).select(F.concat("identifier", F.lit("-0")).alias("identifier"))
    build.write(found.join(hinted, "identifier", "left_anti"), config.output)
    return spark.read.schema("prompt string, generation string, identifier string").json(config.output)
