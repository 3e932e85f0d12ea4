"""The readers. Each has the columns of its records, then ``file`` and ``row``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import grouping
from parley.session import ship
from parley.sources.base import base_name, csv, documents, exists, json_lines, placed_rows, reader, rejecting

SPLITS = ("train", "test", "valid")


@reader("ai-dungeon")
def ai_dungeon(spark: SparkSession, path: str) -> DataFrame:
    """``story`` texts: what starts with a line that opens with the start marker."""
    d = documents(spark, f"{path}/text_adventures.txt")
    each = d.select("file", F.posexplode(F.split("value", "(?m)^(?=<\\|startoftext\\|>)", -1)).alias("row", "story"))
    return each.filter(F.col("story").startswith("<|startoftext|>")).select("story", "file", F.col("row").cast("bigint").alias("row"))


@reader("airoboros")
def airoboros(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/instructions.jsonl", "instruction string, response string")
    return d.filter("instruction is not null and response is not null").withColumnsRenamed({"instruction": "prompt", "response": "generation"})


@reader("airoboros2")
def airoboros2(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/instructions.jsonl", "instruction string, response string, system string, category string")
    return d.filter("instruction is not null and response is not null and category is not null").withColumnRenamed("system", "system_prompt")


_BOT = "struct<name:string,title:string,description:string,greeting:string,definition:string,external_id:string>"


def _characters(spark: SparkSession, path: str) -> DataFrame:
    """All dumps, public ones first, with their kind by their keys; one scan of each folder."""
    parts = [documents(spark, f"{path}/{folder}/*.json").withColumn("part", F.lit(k)) for k, folder in enumerate(("public", "private")) if exists(spark, f"{path}/{folder}/*.json")]
    if not parts:
        return spark.createDataFrame([], "file string, value string, part int, keys array<string>, ts bigint")
    d = grouping.chain(*[p.drop("part") for p in parts])
    ts = F.expr("try_cast(regexp_extract(element_at(split(file, '/'), -1), '^([0-9]+)_', 1) as bigint)")
    return d.withColumn("keys", F.array_sort(F.json_object_keys("value"))).withColumn("ts", ts)


@reader("characterai")
def characterai(spark: SparkSession, path: str) -> DataFrame:
    """``messages, bot, identifier, timestamp`` of every history; definitions override public descriptions."""
    d = _characters(spark, path).filter("ts is not null")
    bot = lambda c: F.struct(c["name"].alias("name"), c["title"].alias("title"), F.nullif(c["description"], F.lit("")).alias("description"), c["greeting"].alias("greeting"), c["definition"].alias("definitions"), c["external_id"].alias("external_id"))
    plain = F.array(F.lit("character"))
    named = F.array(F.lit("character"), F.lit("user__username"))
    defs = d.filter((F.col("keys") == plain) | (F.col("keys") == named)).withColumn("c", F.from_json("value", f"struct<character:{_BOT}>")["character"])
    defs = defs.filter("c.external_id is not null").select(F.col("c.external_id").alias("id"), bot(F.col("c")).alias("bot"), F.struct("part", "file").alias("at"))
    kind = f"struct<histories:struct<histories:array<struct<external_id:string,msgs:array<struct<text:string,src:struct<is_human:boolean>>>>>>,info:struct<character:{_BOT}>>"
    chats = d.filter(F.col("keys") == F.array(F.lit("histories"), F.lit("info"))).withColumn("v", F.from_json("value", kind)).filter("v.info.character.external_id is not null")
    chats = chats.select("part", "file", "ts", bot(F.col("v.info.character")).alias("bot"), F.col("v.info.character.external_id").alias("id"), F.posexplode("v.histories.histories").alias("row", "h"))
    chats = grouping.override(chats, defs, "id", "at", ["bot"])
    messages = F.transform("h.msgs", lambda m: F.struct(m["text"].alias("text"), m["src"]["is_human"].alias("is_human")))
    return chats.select(messages.alias("messages"), "bot", F.col("id").alias("identifier"), F.col("ts").alias("timestamp"), F.concat(F.col("part").cast("string"), F.lit(":"), "file").alias("file"), F.col("row").cast("bigint").alias("row"))


@rejecting("characterai")
def characterai_rejects(spark: SparkSession, path: str) -> DataFrame:
    d = _characters(spark, path)
    known = (F.col("keys") == F.array(F.lit("character"))) | (F.col("keys") == F.array(F.lit("character"), F.lit("user__username"))) | (F.col("keys") == F.array(F.lit("histories"), F.lit("info")))
    reason = F.when(F.col("ts").isNull(), "no time in the file name").when(F.col("keys").isNull(), "no JSON object").when(~known, "unknown keys")
    return d.select("file", F.lit(0).cast("bigint").alias("row"), reason.alias("reason")).filter("reason is not null")


@reader("claude-evol")
def claude_evol(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/claude_evol_instruct_210k.json", "instruction string, output string", array=True)
    return d.filter("instruction is not null and output is not null").withColumnsRenamed({"instruction": "prompt", "output": "generation"})


@reader("claude-rp")
def claude_rp(spark: SparkSession, path: str) -> DataFrame:
    """``messages, user_name, bot_name, convo_id, persona`` of chat logs; a leading row may hold metadata."""
    parts = [documents(spark, f"{path}/{f}/*.jsonl") for f in ("public", "private") if exists(spark, f"{path}/{f}/*.jsonl")]
    if not parts:
        return spark.createDataFrame([], "messages array<struct<message:string,is_user:boolean>>, user_name string, bot_name string, convo_id bigint, persona string, file string, row bigint")
    line = "struct<name:string,is_user:boolean,mes:string,chat_metadata:struct<note_prompt:string>>"
    d = grouping.chain(*parts).withColumn("lines", F.filter(F.split("value", "\n"), lambda x: F.trim(x) != ""))
    d = d.withColumn("rows", F.transform("lines", lambda x: F.from_json(x, line))).filter(F.size("rows") > 0).filter(F.forall("rows", lambda r: r.isNotNull() & (r["mes"].isNotNull() | r["chat_metadata"].isNotNull() | r["name"].isNotNull())))
    d = grouping.number(d.select("part", "file", "rows"), ["part", "file"], "convo_id")
    head = F.get("rows", F.lit(0))["chat_metadata"]
    d = d.withColumn("persona", F.nullif(head["note_prompt"], F.lit(""))).withColumn("said", F.when(head.isNotNull(), F.slice("rows", 2, F.size("rows"))).otherwise(F.col("rows")))
    d = d.filter(F.forall("said", lambda r: r["mes"].isNotNull() & r["is_user"].isNotNull()))
    first = lambda user: F.get(F.filter("said", lambda r: r["is_user"] == user), F.lit(0))["name"]
    out = d.select(F.transform("said", lambda r: F.struct(r["mes"].alias("message"), r["is_user"].alias("is_user"))).alias("messages"), first(True).alias("user_name"), first(False).alias("bot_name"), "convo_id", "persona", "file", F.lit(0).cast("bigint").alias("row"))
    return out.filter("user_name is not null and bot_name is not null")


_TALK = "id string, conversations array<struct<from:string,value:string>>"


@reader("claude-multiround")
def claude_multiround(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/claude_multiround_chat_30k.json", _TALK, array=True)
    return d.filter("conversations is not null").withColumnRenamed("conversations", "conversation")


@reader("club-floyd")
def club_floyd(spark: SparkSession, path: str) -> DataFrame:
    """One row per story of an object of stories, in document order; stories with ill-typed actions are left out."""
    story = "struct<name:string,author:string,genres:array<string>,tags:array<string>,year:int,ratings:array<int>,total_ratings:int,average_rating:double,transcript_id:string,discretion_advised:boolean,description:string,data:array<struct<action:string,response:string,endoftext:boolean>>>"
    d = documents(spark, f"{path}/floyd.json").select("file", F.from_json("value", f"map<string,{story}>").alias("m"))
    each = d.select("file", F.posexplode(F.map_values("m")).alias("row", "s")).filter(F.forall("s.data", lambda a: a["action"].isNotNull() & a["response"].isNotNull() & a["endoftext"].isNotNull()))
    return each.select("s.*", "file", F.col("row").cast("bigint").alias("row")).withColumnRenamed("data", "actions")


@reader("dolly")
def dolly(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/databricks-dolly-15k.jsonl", "instruction string, context string, response string")
    return d.filter("instruction is not null and response is not null").withColumnsRenamed({"context": "input", "response": "output"})


@reader("evol-instruct")
def evol_instruct(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/alpaca_evol_instruct_70k.json", "instruction string, output string", array=True)
    return d.filter("instruction is not null and output is not null").withColumn("input", F.lit(None).cast("string"))


@reader("gpt4all_prompt_generations")
def gpt4all(spark: SparkSession, path: str) -> DataFrame:
    return placed_rows(spark.read.schema("prompt string, response string, source string").parquet(f"{path}/*.parquet"))


@reader("gpt-4-llm")
def gpt4llm(spark: SparkSession, path: str) -> DataFrame:
    d = json_lines(spark, f"{path}/*.json", "instruction string, input string, output string", array=True)
    return d.filter(~F.col("file").contains("comparision_data.json")).filter("instruction is not null and output is not null")


TEACHER_FILES = (("Instruct", "gpt4-instruct-similarity-0.9"), ("Roleplay", "roleplay-similarity_0.9-instruct"), ("Toolformer", "toolformer-similarity-0.9"))


@reader("gpteacher")
def gpteacher(spark: SparkSession, path: str) -> DataFrame:
    """The three files in their order: ``file`` starts with a digit that says so."""
    files = [f"{folder}/{name}-dataset.json" for folder, name in TEACHER_FILES]
    kind = "instruction string, input string, response string"
    parts = [json_lines(spark, f"{path}/{f}", kind, array=True) for f in files if exists(spark, f"{path}/{f}")]
    d = grouping.chain(*parts).withColumn("file", F.concat(F.col("part").cast("string"), F.lit(":"), "file")).drop("part")
    return d.filter("instruction is not null and response is not null").withColumnRenamed("response", "output")


def _yaml(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import json

    import yaml

    for b in batches:
        found = []
        for path, raw in zip(b["path"], b["content"]):
            try:
                found.append((path, json.dumps(yaml.safe_load(bytes(raw)), default=str)))
            except (yaml.YAMLError, UnicodeDecodeError):
                found.append((path, None))
        yield pd.DataFrame(found, columns=["path", "doc"])


@reader("lima-erp")
def lima_erp(spark: SparkSession, path: str) -> DataFrame:
    """``personas, names, scenario, conversation, forum, thread_id`` of YAML files at any depth; broken ones are left out."""
    ship(spark)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.yaml").load(f"{path}/data").select("path", "content")
    kind = "struct<persona:map<string,string>,names:map<string,string>,scenario:string,conversation:array<struct<name:string,text:string>>>"
    d = raw.mapInPandas(_yaml, "path string, doc string").withColumn("v", F.from_json("doc", kind)).filter("v.conversation is not null and v.names is not null")
    forum = F.element_at(F.split("path", "/"), -2)
    thread = F.get(F.split(base_name(F.col("path")), "\\."), F.lit(0))
    return d.select(F.col("v.persona").alias("personas"), F.col("v.names").alias("names"), F.col("v.scenario").alias("scenario"), F.col("v.conversation").alias("conversation"), forum.alias("forum"), thread.alias("thread_id"), F.col("path").alias("file"), F.lit(0).cast("bigint").alias("row"))


@reader("mcstories")
def mcstories(spark: SparkSession, path: str) -> DataFrame:
    d = csv(spark, f"{path}/mcstories--all.csv", "story_title string, story_author string, story_date string, story_tags string, story_summary string, story_href string, story_header string, story string, story_footer string")
    return d.withColumnsRenamed({"story_title": "title", "story_author": "author", "story_date": "date", "story_tags": "tags", "story_summary": "summary", "story_href": "href", "story_header": "header", "story": "text_contents", "story_footer": "footer"})


@reader("openorca")
def openorca(spark: SparkSession, path: str) -> DataFrame:
    return placed_rows(spark.read.schema("id string, system_prompt string, question string, response string").parquet(f"{path}/*.parquet"))


#: Content type of the known forum dumps by the SHA-256 of their file name; further ones are a parameter of the reader.
FORUM_TYPES: dict[str, str] = {
    digest: kind
    for kind, digests in {
        "rp": """dfa38d0b1db60bf999aec14973a6919d8fbc57d217262a3877e5026f71b39d0a""",
        "mixed": """20bc5e687f866428cc1e7ad4e500c58c0d1083f6a91e8e28950449639f7c8d21 99131ae34901d21eca1a33ad0112fdb3f13df649c4bcf0d9e244c26273727849""",
        "erp": """03aee36448fc81f8bae062196bad9767bfc1610c537e3a58660ba4047d49aeb5 14cc766f100cc8f1c5644d3edf822aba312d8a1c40beea7810adbd29608c9c53
        1bfadd54f7b41f5c2d387a4cbb9bda9342a203870e0f7be7a56a24ad3947f47a 3179b0c4ee80dc14eb3b08447d693382df2062602c40d543b1946b2ddf32daf8
        328f8498522ba006378a15b1bb8382278617077084afa68d865eb45edb3e2476 3d4b7c9d57643279ce091dc32e06006bc5195ab71ec3be98fef81623dcb132e7
        5d2f252abc9008cb05e1584b77347050e309abb5cde09616d1de5645658e278a 795074be9881eb21bfb2ce958eda47d12e63cce1d955599d528ea257ac66f4b7
        92dfc2e9f0fdf7efc7115e5b51ad88f01837360e9776d5e81085263b1971a9a1 c961c08eb87511193e127da59fbefb0084e325304eda86ce43ace033ad3464a3
        e519b14a4591a5d334d3b0e74a924296c457625cbebc3fbdc30f8810dbef3da9""",
    }.items()
    for digest in digests.split()
}


@reader("rp_forums")
def rp_forums(spark: SparkSession, path: str, types: dict[str, str] | None = None, default: str = "mixed") -> DataFrame:
    """``messages, thread_name, content_type, source_file``: runs of rows of one title."""
    d = csv(spark, f"{path}/*.csv", "thread_title string, message_username string, message string")
    d = grouping.islands(d, ["file"], ["row"], ["thread_title"]).withColumnRenamed("message_username", "author")
    g = grouping.gather(d, ["file"], ["row"], first=("thread_title",), items=("author", "message"))
    name = base_name(F.col("file"))
    kind = grouping.constant_map(F.sha2(name.cast("binary"), 256), FORUM_TYPES | (types or {}), F.lit(default))
    return g.select(F.col("items").alias("messages"), F.col("thread_title").alias("thread_name"), kind.alias("content_type"), name.alias("source_file"), "file", F.col("island").cast("bigint").alias("row"))


@reader("rp-guild")
def rp_guild(spark: SparkSession, path: str, mode: str = "reference") -> DataFrame:
    """``messages, thread_name, thread_type, tags``: runs of rows of one title and type; tags of the last row.

    Mode ``reference`` leaves out the last run of each file.
    """
    d = csv(spark, f"{path}/*.csv", "thread_title string, thread_type string, thread_tags string, message_username string, message string")
    d = grouping.islands(d, ["file"], ["row"], ["thread_title", "thread_type"]).withColumnRenamed("message_username", "author")
    g = grouping.gather(d, ["file"], ["row"], first=("thread_title", "thread_type"), last=("thread_tags",), items=("author", "message"))
    g = grouping.without_last(g, ["file"]) if mode == "reference" else g
    tags = F.transform(F.regexp_extract_all("thread_tags", F.lit("'(?:[^'\\\\]|\\\\.)*'|\"(?:[^\"\\\\]|\\\\.)*\""), F.lit(0)), lambda t: F.substring(t, F.lit(2), F.length(t) - 2))
    return g.select(F.col("items").alias("messages"), F.col("thread_title").alias("thread_name"), "thread_type", tags.alias("tags"), "file", F.col("island").cast("bigint").alias("row"))


@reader("sharegpt")
def sharegpt(spark: SparkSession, path: str) -> DataFrame:
    """``messages`` (array of arrays of texts), ``source_file``; a message is a list of texts, or a list of such lists of which the first counts."""
    d = documents(spark, f"{path}/*.json").withColumn("items", F.from_json("value", "array<string>"))
    nested = lambda m: F.get(F.from_json(m, "array<array<string>>"), F.lit(0))
    part = lambda m: F.when(m.rlike("^\\s*\\[\\s*\\["), nested(m)).otherwise(F.from_json(m, "array<string>"))
    d = d.withColumn("messages", F.transform("items", part)).filter("items is not null").filter(F.forall("messages", lambda m: m.isNotNull()))
    name = F.regexp_replace(base_name(F.col("file")), "\\.json$", "")
    return d.select("messages", name.alias("source_file"), "file", F.lit(0).cast("bigint").alias("row"))


@rejecting("sharegpt")
def sharegpt_rejects(spark: SparkSession, path: str) -> DataFrame:
    bad = documents(spark, f"{path}/*.json").join(sharegpt(spark, path).select("file"), "file", "left_anti")
    return bad.select("file", F.lit(0).cast("bigint").alias("row"), F.lit("no list of messages").alias("reason"))


@reader("soda")
def soda(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}; there are {', '.join(SPLITS)}")
    d = spark.read.parquet(f"{path}/{split}.parquet")
    kinds = {"narrative": "string", "dialogue": "array<string>", "speakers": "array<string>", "relation": "string", "literal": "string", "original_index": "string"}
    return placed_rows(d).select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()], "file", "row")


@reader("supercot")
def supercot(spark: SparkSession, path: str) -> DataFrame:
    """The input is ``input``, or ``rewritten_intent`` where the row has no such key."""
    d = documents(spark, f"{path}/filtered.json").select("file", F.posexplode(F.from_json("value", "array<string>")).alias("row", "item"))
    v = F.from_json("item", "struct<instruction:string,input:string,rewritten_intent:string,output:string>")
    given = F.array_contains(F.json_object_keys("item"), "input")
    d = d.select(v.alias("v"), given.alias("given"), "file", F.col("row").cast("bigint").alias("row")).filter("v.instruction is not null and v.output is not null")
    return d.select(F.col("v.instruction").alias("instruction"), F.when(F.col("given"), F.col("v.input")).otherwise(F.col("v.rewritten_intent")).alias("input"), F.col("v.output").alias("output"), "file", "row")


@reader("whocars")
def whocars(spark: SparkSession, path: str) -> DataFrame:
    d = csv(spark, f"{path}/*.csv", "model string, endpoint string, `prompt json` string, response string").filter(~F.col("file").contains("__index__"))
    d = d.withColumn("prompt_json", F.from_json("prompt json", "array<struct<role:string,content:string>>"))
    return d.filter("prompt_json is not null").select("model", "endpoint", "prompt_json", "response", "file", "row")


@rejecting("whocars")
def whocars_rejects(spark: SparkSession, path: str) -> DataFrame:
    d = csv(spark, f"{path}/*.csv", "model string, endpoint string, `prompt json` string, response string").filter(~F.col("file").contains("__index__"))
    bad = F.from_json("prompt json", "array<struct<role:string,content:string>>").isNull()
    return d.filter(bad).select("file", "row", F.lit("prompt is no JSON list").alias("reason"))


def _pairs(d: DataFrame) -> DataFrame:
    n = F.size("conversations")
    pairs = F.transform(F.when(n >= 2, F.sequence(F.lit(0), n - 2, F.lit(2))).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.get("conversations", i).alias("h"), F.get("conversations", i + 1).alias("g")))
    return d.select("id", F.posexplode(pairs).alias("pair", "p"), "file", "row")


@reader("wizard_vicuna_70k")
def wizard_vicuna(spark: SparkSession, path: str) -> DataFrame:
    """One row per question and answer; pairs of other speakers and odd messages are left out."""
    d = _pairs(json_lines(spark, f"{path}/wizard_vicuna_dataset.json", _TALK, array=True).filter("conversations is not null"))
    d = d.filter("p.h.from = 'human' and p.g.from = 'gpt'")
    return d.select("id", F.col("p.h.value").alias("human_question"), F.col("p.g.value").alias("gpt_response"), "file", "row", "pair")


@rejecting("wizard_vicuna_70k")
def wizard_vicuna_rejects(spark: SparkSession, path: str) -> DataFrame:
    d = _pairs(json_lines(spark, f"{path}/wizard_vicuna_dataset.json", _TALK, array=True).filter("conversations is not null"))
    return d.filter("not (p.h.from <=> 'human' and p.g.from <=> 'gpt')").select("file", "row", F.lit("speakers do not alternate").alias("reason"))

