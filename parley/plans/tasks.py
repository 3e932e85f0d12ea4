"""The tasks: records of a source to episodes.

A task is a function ``(spark, root, seed, mode, …) -> DataFrame`` with
``identifier, turns`` and the order columns ``file, row, sub``. Mode
``reference`` keeps the known oddities of the behaviour that is matched;
``fixed`` does what was meant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import chunks, hints, html_md, picks, templates
from parley.functions import text as T
from parley.operators import filters, grouping
from parley.plans import banks as B
from parley.schema import turn, turns
from parley.sources import base, readers  # noqa: F401 - registers the readers

Task = Callable[..., DataFrame]
TASKS: dict[str, Task] = {}
MODES = ("reference", "fixed")


def task(name: str) -> Callable[[Task], Task]:
    def add(f: Task) -> Task:
        TASKS[name] = f
        return f

    return add


def run(spark: SparkSession, name: str, root: str | None = None, seed: int = picks.SEED, mode: str = "reference", **options) -> DataFrame:
    """Episodes of a task by name."""
    if name not in TASKS:
        raise ValueError(f"unknown task {name!r}; there are {', '.join(sorted(TASKS))}")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    return TASKS[name](spark, root or base.data_root(spark), seed, mode, **options)


def _read(spark: SparkSession, source: str, root: str, **options) -> DataFrame:
    return base.READERS[source](spark, f"{root}/{source}", **options)


def _indexed(rows: DataFrame, start: int = 0) -> DataFrame:
    order = ["file", "row", *(["pair"] if "pair" in rows.columns else [])]
    return grouping.number(rows, order, "idx", start)


def _prompt(bank, key: Column, seed: int, salt: str = "system") -> Column:
    return picks.from_bank(templates.bank(bank), key, salt, seed)


def _id(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _episodes(rows: DataFrame, said: Column, sub: Column | None = None) -> DataFrame:
    return rows.select("identifier", said.alias("turns"), "file", "row", (F.lit(0) if sub is None else sub).cast("bigint").alias("sub"))


def _three(rows: DataFrame, system: Column, user: Column | str, model: Column | str) -> DataFrame:
    return _episodes(rows, turns(turn(system, "system"), turn(user, "user"), turn(model, "model")))


@task("AiDungeonTextAdventureTask")
def ai_dungeon(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    """Reference: an empty episode 0 comes first, and the last story is lost, so the k-th story is number k."""
    d = _indexed(_read(spark, "ai-dungeon", root), 1 if mode == "reference" else 0)
    if mode == "reference":
        last = d.agg(F.max("idx").alias("last"))  # one row
        d = d.join(F.broadcast(last), F.col("idx") < F.col("last")).drop("last")
    d = d.withColumn("identifier", _id("ai-dungeon-", F.col("idx")))
    told = F.transform(chunks.adventure(F.col("story"), keep_rest=mode == "fixed"), lambda t: turn(t["text"], t["kind"]))
    out = _episodes(d, F.concat(turns(turn(_prompt(B.ADVENTURE, F.col("identifier"), seed), "system")), told))
    if mode == "reference":
        first = spark.range(1).select(F.lit("ai-dungeon-0").alias("identifier"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("row"))
        out = _episodes(first, turns(turn(_prompt(B.ADVENTURE, F.col("identifier"), seed), "system"))).unionByName(out)
    return out


def _airoboros(spark: SparkSession, root: str, seed: int, name: str, bank, user: str, model: str) -> DataFrame:
    d = _indexed(_read(spark, "airoboros", root), 1).filter(T.strip(F.lower("generation")) != "airoboros").withColumn("identifier", _id(name, F.col("idx")))
    return _three(d, _prompt(bank, F.col("identifier"), seed), user, model)


@task("AiroborosInstructionFollowingTask")
def airoboros(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    return _airoboros(spark, root, seed, "airoboros-instruct-", B.ASSISTANT, "prompt", "generation")


@task("AiroborosGuessTheInstructionTask")
def airoboros_guess(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    return _airoboros(spark, root, seed, "airoboros-gti-", B.GUESS, "generation", "prompt")


def _parts_of_chat(instruction: Column) -> Column:
    """``model, user, about, said``: a chat's names, the lines before the user's first one, and those from it on."""
    names, split = T.name_pair(F.substring_index(instruction, "\n", 1)), T.speaker_lines(instruction)
    rest = F.slice(split, 2, F.greatest(F.size(split) - 1, F.lit(0)))
    at = F.array_position(F.transform(rest, lambda x: x.startswith(F.concat(F.get(names, F.lit(1)), F.lit(":")))), True).cast("int")
    return F.when(at > 0, F.struct(F.get(names, F.lit(0)).alias("model"), F.get(names, F.lit(1)).alias("user"), F.slice(rest, 1, at - 1).alias("about"), F.slice(rest, at, F.size(rest)).alias("said")))


def _acquaint(chat: Column, key: Column, seed: int) -> Column:
    line = templates.fill(picks.one_of(list(B.ACQUAINT), key, "acquaint", seed), {"MODEL": chat["model"], "USER": chat["user"]}, "<%s>")
    return T.strip(F.concat(line, F.lit("\n"), F.array_join(chat["about"], "\n\n")))


def _contextual(d: Column, system: Column, key: Column, seed: int) -> Column:
    """System and user texts: context goes to the user half the time, else above or below the system's."""
    context = T.block(d, "BEGINCONTEXT", "ENDCONTEXT")
    asked = F.replace(T.block(d, "BEGININPUT", "ENDINPUT"), F.concat(F.lit("BEGINCONTEXT\n"), context, F.lit("\nENDCONTEXT\n")), F.lit(""))
    with_prelude = T.strip(F.concat(picks.one_of(list(B.PRELUDES), key, "prelude", seed), F.lit("\n"), context))
    to_user, above = picks.below(2, key, "side", seed) == 0, picks.below(2, key, "place", seed) == 0
    what = F.when(to_user, system).when(above, F.concat(with_prelude, F.lit("\n"), system)).otherwise(F.concat(system, F.lit("\n"), with_prelude))
    asked = F.when(to_user, F.concat(asked, F.lit("\n"), with_prelude)).otherwise(asked)
    return F.struct(what.alias("system"), F.concat(asked, F.lit("\n"), T.block(d, "BEGININSTRUCTION", "ENDINSTRUCTION")).alias("user"))


def _acquainted_turns(chat: Column, system: Column, response: Column) -> Column:
    """Lines are joined until the next one opens with a name; who comes next tells who spoke. The last block is the user's."""
    starts = lambda x, who: x.startswith(F.concat(chat[who], F.lit(":")))
    kind = "struct<done:array<struct<utterance:string,kind:string,name:string>>,cur:array<string>>"
    said = chat["said"]

    def step(s: Column, i: Column) -> Column:
        cur, following = F.concat(s["cur"], F.array(F.get(said, i))), F.get(said, i + 1)
        who = F.when(starts(following, "model"), "user").when(starts(following, "user"), "model")
        whole = turns(turn(F.array_join(cur, "\n\n"), who))
        return F.when(who.isNotNull(), F.struct(F.concat(s["done"], whole).alias("done"), F.array().cast("array<string>").alias("cur"))).otherwise(F.struct(s["done"].alias("done"), cur.alias("cur"))).cast(kind)

    first = F.struct(turns(turn(system, "system")).alias("done"), F.array().cast("array<string>").alias("cur")).cast(kind)
    end = lambda s: F.concat(F.when(F.size(s["cur"]) > 0, F.concat(s["done"], turns(turn(F.array_join(s["cur"], "\n\n"), "user")))).otherwise(s["done"]), turns(turn(F.concat(chat["model"], F.lit(": "), response), "model")))
    return F.aggregate(F.sequence(F.lit(0), F.size(said) - 1), first, step, end)


@task("Airoboros2InstructionFollowingTask")
def airoboros2(spark: SparkSession, root: str, seed: int, mode: str, exclude: tuple[str, ...] | None = ("orca",)) -> DataFrame:
    """Entries are handled by category; unknown categories and entries without the parts they need are left out."""
    d = _read(spark, "airoboros2", root)
    d = d.filter(~F.col("category").isin(*exclude)) if exclude else d
    handled = (*B.GENERIC, "agent", "awareness", "contextual", "counterfactual_contextual", "gtkm", "greeting", "stylized_response", "summarization", "trivia")
    d = grouping.counter(d.filter(F.col("category").isin(*handled)), "category", ["file", "row"], "n")
    d = d.withColumn("identifier", _id("airoboros2-", F.col("category"), "-", F.col("n")))
    said, key, reply, cat = F.col("instruction"), F.col("identifier"), F.col("response"), F.col("category")
    plain = _prompt(B.ASSISTANT, key, seed)
    three = lambda s, u, m: turns(turn(s, "system"), turn(u, "user"), turn(m, "model"))
    d = d.withColumn("chat", F.when(cat.isin("gtkm", "awareness"), _parts_of_chat(said)))
    chat = F.col("chat")
    cut = F.locate("\n\n", said)
    agent = F.when(cut > 0, three(F.substring(said, F.lit(1), cut - 1), F.substring(said, cut + 9, F.length(said)), reply))
    known = _acquaint(chat, key, seed)
    aware = F.when(F.col("system_prompt") != "A chat.", three(F.col("system_prompt"), F.concat(F.lit("USER: "), said), F.concat(F.lit("ASSISTANT: "), reply)))
    aware = aware.when(~said.contains("\n"), three(picks.one_of(list(B.AWARE), key, "aware", seed), said, reply))
    aware = aware.when(chat.isNotNull(), three(known, F.array_join(chat["said"], "\n"), F.concat(chat["model"], F.lit(": "), reply)))
    factual = F.lower(said).rlike("|".join(f"\\Q{f}\\E" for f in B.FACTS))
    context = _contextual(said, F.when((cat == "counterfactual_contextual") & ~factual, picks.one_of(list(B.COUNTER), key, "counter", seed)).otherwise(plain), key, seed)
    given = T.block(said, "BEGININPUT", "ENDINPUT")
    given = F.when(given == "Summarize the input in around 0 words.", F.replace(given, F.lit("0"), F.lit("5"))).otherwise(given)
    found = (
        F.when(cat.isin(*B.GENERIC), three(plain, said, reply)).when(cat == "agent", agent).when(cat == "awareness", aware)
        .when(cat.isin("contextual", "counterfactual_contextual"), three(context["system"], context["user"], reply))
        .when(cat == "gtkm", F.when(chat.isNotNull(), _acquainted_turns(chat, known, reply)))
        .when(cat.isin("greeting", "stylized_response"), three(F.col("system_prompt"), said, reply))
        .when(cat == "summarization", three(T.block(said, "BEGININSTRUCTION", "ENDINSTRUCTION"), given, reply))
        .when(cat == "trivia", three(picks.one_of(list(B.TRIVIA), key, "trivia", seed), said, reply))
    )
    return _episodes(d, found).filter("turns is not null").filter(F.forall("turns", lambda t: t["utterance"].isNotNull()))


@task("CharacterAiRoleplayTask")
def characterai(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _read(spark, "characterai", root).filter("bot.description is not null").withColumn("identifier", _id("characterai-roleplay-", F.col("timestamp"), "-", F.col("identifier")))
    name = F.col("bot.name")
    system = templates.fill(_prompt(B.CHARACTER, F.col("identifier"), seed), {"char": name, "persona": F.col("bot.description")})
    said = F.transform("messages", lambda m: turn(T.unify_redactions(m["text"], name, list(B.REDACTIONS)), F.when(m["is_human"], "user").otherwise("model")))
    return _episodes(d, F.concat(turns(turn(system, "system")), said))


@task("ClaudeEvolInstructTask")
def claude_evol(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "claude-evol", root)).withColumn("generation", T.rename(T.single_spaces(F.col("generation")), list(B.RENAMES)))
    if mode == "fixed":
        d = d.filter(~F.col("generation").rlike("|".join(f"\\Q{p}\\E" for p in B.APOLOGIES)))
    d = d.withColumn("identifier", _id("claude-evol-instruct-", F.col("idx")))
    return _three(d, _prompt(B.ASSISTANT, F.col("identifier"), seed), "prompt", "generation")


@task("ClaudeGuessTheInstructionTask")
def claude_guess(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _read(spark, "claude-multiround", root).withColumns({"asked": F.get("conversation", F.lit(0)), "told": F.get("conversation", F.lit(1))})
    d = d.filter("asked.value <> '' and told.value <> ''")
    d = d.filter("asked.from = 'human' and told.from = 'gpt'") if mode == "fixed" else d
    d = d.withColumn("identifier", _id("claude-gti-", F.col("id")))
    return _three(d, _prompt(B.GUESS, F.col("identifier"), seed), F.col("told.value"), F.col("asked.value"))


@task("ClaudeInstructTask")
def claude_instruct(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    """A talk ends before its first blank message; if that is the model's, the user's before it goes too."""
    d = _read(spark, "claude-multiround", root).withColumn("identifier", _id("claude-instruct-", F.col("id")))
    n = F.size("conversation")
    at = F.array_position(F.transform("conversation", lambda m: T.strip(F.coalesce(m["value"], F.lit(""))) == ""), True).cast("int")
    d = d.withColumn("at", at).filter("at = 0 or at > 2")
    keep = F.when(F.col("at") == 0, n).otherwise(F.col("at") - 1 - (F.get("conversation", F.col("at") - 1)["from"] == "gpt").cast("int"))
    said = F.transform(F.slice("conversation", F.lit(1), keep), lambda m: turn(m["value"], F.when(m["from"] == "human", "user").otherwise("model")))
    return _episodes(d, F.concat(turns(turn(_prompt(B.ASSISTANT, F.col("identifier"), seed), "system")), said))


@task("ClaudeRoleplayTask")
def claude_roleplay(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _read(spark, "claude-rp", root).filter(F.size("messages") >= 2).withColumn("identifier", _id("claude-rp-", F.col("convo_id")))
    key = F.col("identifier")
    # A blank template is an option of its own here.
    options = [v for t in B.CHAT_ROLE for v in [templates.expand(t) or [""]]]
    system = picks.from_bank(options, key, "system", seed)
    system = F.when(F.col("persona").isNotNull() & (system != ""), F.concat(system, F.lit("\n"), picks.one_of(list(B.PERSONA_LINES), key, "persona", seed), F.lit(" "), F.col("persona"))).otherwise(system)
    user = F.when(T.strip(F.lower("user_name")) == "you", F.lit("the user")).otherwise(F.col("user_name"))
    said = F.transform("messages", lambda m: turn(m["message"], F.when(m["is_user"], "user").otherwise("model")))
    return _episodes(d, F.concat(turns(turn(templates.fill(system, {"char": F.col("bot_name"), "user": user}), "system")), said))


@task("ClubFloydTextAdventureTask")
def club_floyd(spark: SparkSession, root: str, seed: int, mode: str, least_rating: float = 3.0) -> DataFrame:
    d = _indexed(_read(spark, "club-floyd", root)).filter(F.col("average_rating") >= least_rating).withColumn("identifier", _id("club-floyd-", F.col("idx")))
    key = F.col("identifier")
    tags = picks.shuffled(F.array_distinct(T.without(F.concat("tags", "genres"), list(B.BLOCKED_TAGS))), key, "tags", seed)
    rating = F.when(F.col("discretion_advised"), _prompt(B.EXPLICIT, key, seed, "rating")).otherwise(_prompt(B.TAME, key, seed, "rating"))
    system = templates.fill(_prompt(B.GAME, key, seed), {"title": F.col("name"), "description": F.col("description"), "discretion_advised_str": rating, "tags": F.array_join(tags, ", ")})
    said = F.flatten(F.transform("actions", lambda a: F.when(a["action"] == "%", turns(turn(a["response"], "model"))).otherwise(turns(turn(a["action"], "user"), turn(a["response"], "model")))))
    return _episodes(d, F.concat(turns(turn(system, "system")), said))


@task("DollyGuessTheInstructionTask")
def dolly(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "dolly", root)).withColumn("identifier", _id("dolly-", F.col("idx")))
    key, given = F.col("identifier"), F.coalesce("input", F.lit(""))
    context = F.when(given == "", F.lit("")).otherwise(T.lstrip(F.concat(picks.one_of(list(B.DOLLY_CONTEXT), key, "context", seed), given)))
    user = templates.fill(_prompt(B.DOLLY_USER, key, seed, "user"), {"INFO": F.col("output"), "CONTEXT": context}, "<%s>")
    return _three(d, _prompt(B.GUESS, key, seed), user, T.squeeze_spaces(F.col("instruction")))


@task("EvolInstructTask")
def evol_instruct(spark: SparkSession, root: str, seed: int, mode: str, most_similar: float = 0.9) -> DataFrame:
    d = _indexed(_read(spark, "evol-instruct", root)).filter("output <> ''")
    d = d.filter(~F.lower("instruction").rlike("|".join(filters.NO_OUTPUT))).filter(~filters.similar(F.col("instruction"), F.col("output"), most_similar))
    d = d.withColumn("identifier", _id("evol-instruct-", F.col("idx")))
    return _three(d, _prompt(B.QUESTION, F.col("identifier"), seed), "instruction", "output")


@task("Gpt4AllQuestionAnsweringTask")
def gpt4all(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "gpt4all_prompt_generations", root)).withColumn("identifier", _id("gpt4all-", F.col("idx")))
    clean = lambda c: T.strip(T.squeeze_newlines(html_md.to_markdown(F.col(c))))
    return _three(d, _prompt(B.QUESTION, F.col("identifier"), seed), clean("prompt"), clean("response"))


@task("McStoriesWritingTask")
def mcstories(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    """Stories with an unknown tag are left out."""
    d = _indexed(_read(spark, "mcstories", root)).withColumn("identifier", _id("mcstories-", F.col("idx")))
    key = F.col("identifier")
    d = d.withColumn("full", F.transform(T.list_literal(F.col("tags")), lambda t: grouping.constant_map(t, B.STORY_TAGS))).filter(F.forall("full", lambda t: t.isNotNull()))
    d = d.withColumn("md", html_md.to_markdown(F.col("text_contents"))).withColumn("parts", chunks.paragraphs(T.drop_heading_lines(F.col("md")), keep_rest=mode == "fixed"))
    system = templates.fill(_prompt(B.STORY, key, seed), {"title": F.col("title"), "summary": F.col("summary"), "tags": F.array_join("full", ", ")})
    first = picks.below(2, key, "first", seed)
    said = F.transform("parts", lambda p, i: turn(p, F.when((i + first) % 2 == 0, "user").otherwise("model")))
    return _episodes(d, F.concat(turns(turn(system, "system")), said))


@task("LimaRpRoleplayTask")
def limarp(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _read(spark, "lima-erp", root).withColumn("identifier", _id("limarp-", F.col("forum"), "-", F.col("thread_id")))
    name = F.try_element_at("names", F.lit("<FIRST>"))
    fill = lambda c: T.plain_punctuation(templates.fill(c, {"CHAR": name, "PERSONA": F.try_element_at("personas", F.lit("<FIRST>")), "SCENARIO": F.col("scenario"), "SECOND": F.lit("{{user}}"), "FIRST": name}, "<%s>"))
    said = F.transform("conversation", lambda m: turn(fill(m["text"]), F.when(m["name"] == "<FIRST>", "model").otherwise("user")))
    return _episodes(d, F.concat(turns(turn(fill(_prompt(B.PERSONAS, F.col("identifier"), seed)), "system")), said))


@task("OpenOrcaInstructionFollowingTask")
def openorca(spark: SparkSession, root: str, seed: int, mode: str, max_examples: int = 250_000) -> DataFrame:
    d = grouping.source_cap(_read(spark, "openorca", root), ["file", "row"], max_examples, mode)
    d = d.filter(~filters.refuses(F.col("response"))) if mode == "fixed" else d
    d = d.withColumn("identifier", _id("openorca-", F.col("id")))
    more = T.drop_role_sentence(F.coalesce("system_prompt", F.lit("")))
    system = _prompt(B.ASSISTANT, F.col("identifier"), seed)
    return _three(d, F.when(more == "", system).otherwise(F.concat(system, F.lit(" "), more)), "question", "response")


def _posts(d: DataFrame, key: Column, seed: int) -> DataFrame:
    """A row per cleaned post part: ``id`` of the thread, ``m`` and ``k`` (places), ``post``, and the thread's columns."""
    each = d.withColumn("authors", F.array_distinct(F.transform("messages", lambda m: m["author"]))).select("*", F.posexplode("messages").alias("m", "_message"))
    raw = T.drop_urls(html_md.drop_quotes_and_scripts(T.tidy_spacing(F.col("_message.message"))))
    target = picks.between(200, 600, F.concat(key, F.lit("#"), F.col("m").cast("string")), "target", seed)
    each = each.withColumn("_raw", raw).filter(~T.has_url(F.col("_raw"))).select("*", F.posexplode(chunks.remerge(F.col("_raw"), target)).alias("k", "_part"))
    md = T.squeeze_newlines(html_md.loosen_emphasis(T.drop_reply_lines(F.col("_md"))))
    return each.withColumn("_md", html_md.to_markdown(F.col("_part"))).withColumn("post", T.pseudonymise(md, F.col("authors"))).drop("_message", "_raw", "_part", "_md", "messages")


def _labelled(posts: Column) -> Column:
    """All posts are the model's but careless ones, and asides that no aside came before; the system's turn counts as none."""
    return F.transform(posts, lambda p, i: turn(p["post"], F.when(T.unusable(p["post"]) | (T.out_of_character(p["post"]) & ~F.coalesce(T.out_of_character(F.get(posts, i - 1)["post"]), F.lit(False))), "user").otherwise("model")))


def _threads(posts: DataFrame, keep: list[str]) -> DataFrame:
    g = posts.groupBy("identifier", "file", "row").agg(F.array_sort(F.collect_list(F.struct("m", "k", "post"))).alias("posts"), *[F.first(c).alias(c) for c in keep])
    return g


@task("RpForumsWritingTask")
def rp_forums(spark: SparkSession, root: str, seed: int, mode: str, all_model_turns: bool = False) -> DataFrame:
    d = _read(spark, "rp_forums", root).filter(~F.lower("thread_name").rlike("|".join(f"\\Q{x}\\E" for x in B.NO_ROLEPLAY))).filter(F.size("messages") >= 2)
    d = d.withColumn("identifier", _id("rp-", F.col("source_file"), "-", F.col("thread_name")))
    key = F.concat("file", F.lit("#"), F.col("row").cast("string"))
    kind = None
    for name, bank in B.FORUM_TYPES.items():
        pick = _prompt(bank, key, seed, "content")
        kind = F.when(F.col("content_type") == name, pick) if kind is None else kind.when(F.col("content_type") == name, pick)
    system = templates.fill(_prompt(B.FORUM, key, seed), {"content_type_str": kind}) if mode == "reference" else templates.fill(_prompt(B.FORUM, key, seed), {"content_type_str": kind, "content_style_str": F.lit("")})
    first = picks.below(4, key, "first", seed) == 0
    g = _threads(_posts(d.withColumns({"system": system, "first": first}), key, seed), ["system", "first"])
    toggled = F.transform("posts", lambda p: turn(p["post"], F.when((p["m"] % 2 == 0) == F.col("first"), "model").otherwise("user")))
    return _episodes(g, F.concat(turns(turn("system", "system")), _labelled(F.col("posts")) if all_model_turns else toggled))


@task("RpGuildWritingTask")
def rp_guild(spark: SparkSession, root: str, seed: int, mode: str, all_model_turns: bool = False, keep_ooc: bool = False) -> DataFrame:
    """Reference: one speaker has all posts of a thread; fixed: speakers take turns by message."""
    d = _read(spark, "rp-guild", root, mode=mode).filter(~F.col("thread_name").isin(*B.BROKEN_THREADS) if B.BROKEN_THREADS else F.lit(True)).filter("thread_type = 'IC'").filter(F.size("messages") >= 2)
    authors = F.size(F.array_distinct(F.transform("messages", lambda m: m["author"])))
    d = d.filter((authors <= 2) | F.array_contains("tags", "1x1")).withColumn("identifier", _id("rp-guild-", F.col("thread_name")))
    key = F.concat("file", F.lit("#"), F.col("row").cast("string"))
    style = F.get(F.filter("tags", lambda t: t.isin(*B.GUILD_STYLES)), F.lit(0))
    styled = None
    for name, bank in B.GUILD_STYLES.items():
        styled = F.when(style == name, _prompt(bank, key, seed, "style")) if styled is None else styled.when(style == name, _prompt(bank, key, seed, "style"))
    named = lambda table, bank, salt: F.concat(_prompt(bank, key, seed, salt), T.conjunction(F.array_compact(F.transform("tags", lambda t: grouping.constant_map(t, table))), mode), F.lit("."))
    explicit = F.when(F.array_contains("tags", "18+"), F.concat(F.lit(" "), _prompt(B.EXPLICIT, key, seed, "rating")))
    system = F.concat(*[F.coalesce(x, F.lit("")) for x in (_prompt(B.GUILD, key, seed), styled, named(B.GENRES, B.GUILD_GENRE, "genre"), named(B.PERIODS, B.GUILD_TIME, "time"), explicit)])
    p = _posts(d.withColumns({"system": system, "first": picks.below(4, key, "first", seed) == 0}), key, seed)
    post = F.col("post") if keep_ooc else T.drop_out_of_character(F.col("post"))
    p = p.withColumn("post", T.strip(T.drop_mentions(post, mode))).filter("post <> ''")
    g = _threads(p, ["system", "first"])
    turn_of = (lambda p: F.lit(True)) if mode == "reference" else (lambda p: p["m"] % 2 == 0)
    toggled = F.transform("posts", lambda p: turn(p["post"], F.when(turn_of(p) == F.col("first"), "model").otherwise("user")))
    return _episodes(g, F.concat(turns(turn("system", "system")), _labelled(F.col("posts")) if all_model_turns else toggled))


@task("ShareGptInstructionFollowingTask")
def sharegpt(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    """Even messages are the human's; such with other than one part are left out, and speakers keep their places."""
    d = _read(spark, "sharegpt", root).withColumn("identifier", _id("sharegpt-", F.col("source_file")))
    each = d.select("identifier", "file", "row", F.posexplode("messages").alias("m", "parts")).filter((F.col("m") % 2 == 1) | (F.size("parts") == 1))
    each = each.withColumn("md", html_md.to_markdown(html_md.drop_openings(F.array_join("parts", "<br />"))))
    each = each.withColumn("md", html_md.compact(html_md.drop_copy_captions(html_md.drop_counter(html_md.mend_fences(F.col("md"))))))
    g = each.groupBy("identifier", "file", "row").agg(F.array_sort(F.collect_list(F.struct("m", "md"))).alias("said"), F.max(html_md.residue(F.col("md"))).alias("bad")).filter("not bad")
    said = F.transform("said", lambda s: turn(s["md"], F.when(s["m"] % 2 == 0, "user").otherwise("model")))
    return _episodes(g, F.concat(turns(turn(_prompt(B.ASSISTANT, F.col("identifier"), seed), "system")), said))


@task("SingleTurnInstructionFollowingTask")
def single_turn(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "gpteacher", root)).withColumn("identifier", _id("gpteacher-", F.col("idx")))
    own = F.coalesce((F.col("input") != "") & ~F.col("instruction").contains(F.col("input")), F.lit(False))
    system = F.when(own, F.col("instruction")).otherwise(_prompt(B.ASSISTANT, F.col("identifier"), seed))
    return _three(d, system, F.when(own, F.col("input")).otherwise(F.col("instruction")), "output")


def _soda(spark: SparkSession, root: str, split: str, seed: int) -> DataFrame:
    d = _read(spark, "soda", root, split=split).filter(F.size("speakers") >= F.size("dialogue")).filter(F.size("dialogue") > 0)
    d = d.withColumn("said", F.transform(F.arrays_zip("dialogue", F.slice("speakers", F.lit(1), F.size("dialogue"))), lambda z: F.concat(z.getField("1"), F.lit(": "), z.getField("dialogue"))))
    return d


@task("SodaReplyGenerationTask")
def soda_reply(spark: SparkSession, root: str, seed: int, mode: str, split: str = "train") -> DataFrame:
    """An episode for every utterance from the fourth on, all of one identifier."""
    d = _soda(spark, root, split, seed).filter(F.size("said") >= 4).select("*", F.explode(F.sequence(F.lit(3), F.size("said") - 1)).alias("at"))
    d = d.withColumn("identifier", _id("soda-", split, "-", F.col("original_index"), "-reply-generation"))
    key = F.concat("identifier", F.lit("#"), F.col("at").cast("string"))
    who = T.participants(picks.shuffled(F.array_distinct("speakers"), key, "participants", seed))
    reply = F.get("dialogue", F.col("at"))
    system = templates.fill(_prompt(B.REPLY, key, seed), {"participants": who, "conversation": F.array_join(F.slice("said", F.lit(1), F.col("at") - 1), "\n"), "narrative": F.col("narrative"), "respond_for": F.get("speakers", F.col("at")), "response_length_str": hints.spoken_length(reply, key, seed)})
    return _episodes(d, turns(turn(system, "system"), turn(F.get("said", F.col("at") - 1), "user"), turn(F.get("said", F.col("at")), "model")), F.col("at"))


@task("SodaSummarizationTask")
def soda_summary(spark: SparkSession, root: str, seed: int, mode: str, split: str = "train") -> DataFrame:
    d = _soda(spark, root, split, seed).withColumn("identifier", _id("soda-", split, "-", F.col("original_index"), "-summarization"))
    key = F.col("identifier")
    user = templates.fill(_prompt(B.SUMMARY_USER, key, seed, "user"), {"conversation": F.array_join("said", "\n"), "participants": T.participants(F.array_distinct("speakers"))})
    return _three(d, _prompt(B.SUMMARY, key, seed), user, "narrative")


@task("SuperCotInstructionFollowingTask")
def supercot(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "supercot", root)).withColumn("identifier", _id("supercot-", F.col("idx")))
    return _three(d, _prompt(B.ASSISTANT, F.col("identifier"), seed), F.concat_ws("\n", "instruction", "input"), "output")


@task("WhocarsRoleplayTask")
def whocars(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    d = _indexed(_read(spark, "whocars", root)).filter("endpoint = 'openai'").filter(F.col("model").contains("gpt-4")).filter(F.get("prompt_json", F.lit(0))["role"] == "system")
    d = d.withColumn("identifier", _id("whocars-", F.col("idx")))

    def said(m: Column) -> Column:
        text = T.strip(m["content"])
        return turn(F.when(m["role"] == "system", T.user_token(text)).otherwise(T.mend_tokens(text)), F.when(m["role"] == "system", "system").when(m["role"] == "user", "user").otherwise("model"))

    return _episodes(d, F.transform("prompt_json", said))


@task("WizardVicunaQuestionAnsweringTask")
def wizard_vicuna(spark: SparkSession, root: str, seed: int, mode: str) -> DataFrame:
    """Empty answers and those that start midway are left out."""
    d = _indexed(_read(spark, "wizard_vicuna_70k", root)).filter("gpt_response <> ''").filter(~T.starts_midway(F.col("gpt_response")))
    d = d.withColumn("identifier", _id("wizard-vicuna-", F.col("id"), "-", F.col("idx")))
    return _three(d, _prompt(B.ASSISTANT, F.col("identifier"), seed), "human_question", T.drop_trailing_brace(F.col("gpt_response")))


