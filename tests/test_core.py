from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from parley.functions import formats
from parley.operators import episodes, filters, grouping, windowing
from parley.plans import build, queries, tasks
from parley.schema import TURNS
from parley.sources import base


def model(kinds, costs, budget, policy):
    """The windows of an episode, turn by turn."""
    out, window, n = [], [], costs[0]
    for i in range(1, len(kinds)):
        cost = costs[i]
        if n + cost > budget:
            if policy == "reference":
                over = float("inf")
                while over > 0:
                    if not window:
                        return out
                    n -= costs[window.pop(0)]
                    over = budget - (n + cost)
            else:
                while window and n + cost > budget:
                    n -= costs[window.pop(0)]
                if n + cost > budget:
                    return out
        window.append(i)
        n += cost
        if kinds[i] == "model":
            out.append((window[0], i))
    return out


@pytest.mark.parametrize("policy", windowing.POLICIES)
def test_windows(spark, policy):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        n = rng.randint(1, 12)
        rows.append((k, ["system"] + [rng.choice(["user", "model"]) for _ in range(n)], [rng.randint(0, 9) for _ in range(n + 1)]))
    rows.append((600, ["system"], [3]))
    df = spark.createDataFrame(rows, "k int, kinds array<string>, costs array<bigint>")
    for budget in (4, 12, 25):
        got = {r["k"]: [(w["start"], w["end"]) for w in r["w"]] for r in df.select("k", windowing.windows(F.col("kinds"), F.col("costs"), budget, policy).alias("w")).collect()}
        assert got == {k: model(kinds, costs, budget, policy) for k, kinds, costs in rows}


def _episode(spark, said, name="e"):
    turns = [(u, k, "<BOT>") for k, u in said]
    return spark.createDataFrame([(name, turns)], f"identifier string, turns {TURNS}")


@pytest.mark.parametrize(
    ("fmt", "prompt", "reply"),
    [
        ("markers", "<|system|>S<|user|>U<|model|>", "M"), ("Persona", "<BOT>'s Persona: S\n<START><BOT>: U\n<BOT>: ", "M"), ("minimal_alpaca", "### Instruction:\nS\n### Instruction:\nU\n### Response:\n", "M"),
        ("henkpaca", "### Instruction:\nS\n### Response:\n<BOT>: U\n<BOT>: ", "M"), ("chatml", "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\n", "M<|im_end|>"),
        ("chatml_named", "<|im_start|>system name=<BOT>\nS<|im_end|>\n<|im_start|>user name=<BOT>\nU<|im_end|>\n<|im_start|>assistant name=<BOT>\n", "M<|im_end|>"), ("alpaca", formats.ALPACA_SYSTEM + "\nS\n\n### Input:\nU\n\n### Response:\n", "M"),
    ],
)
def test_formats(spark, fmt, prompt, reply):
    r = windowing.examples(_episode(spark, [("system", "S"), ("user", "U"), ("model", " M ")]), fmt=fmt).collect()
    assert [(x["identifier"], x["prompt"], x["generation"]) for x in r] == [("e-0", prompt, reply)]


def test_bad_names(spark):
    with pytest.raises(ValueError):
        formats.lookup("nope")
    with pytest.raises(ValueError):
        base.read(spark, "nope")
    with pytest.raises(ValueError):
        tasks.run(spark, "nope")
    with pytest.raises(ValueError):
        filters.apply_all(spark.range(1), ["nope"], ["id"])
    with pytest.raises(ValueError):
        build.Config(["WizardVicunaQuestionAnsweringTask"]).check()


def test_examples_need_a_system_turn(spark):
    e = _episode(spark, [("user", "U"), ("model", "M")]).union(_episode(spark, [])).union(_episode(spark, [("system", "S")]))
    assert windowing.examples(e).count() == 0


def test_placeholders_are_filled(spark):
    e = _episode(spark, [("system", "{{response_length_str}}|{{response_style_str}}"), ("user", "U"), ("model", "*M*")])
    r = windowing.examples(e).first()["prompt"]
    assert "{{" not in r and windowing.examples(e).first()["prompt"] == r
    assert windowing.examples(e.repartition(3)).first()["prompt"] == r


def test_dedup_joins_without_a_mark(spark):
    df = spark.createDataFrame([(1, "ab", "c"), (2, "a", "bc"), (3, "x", "y"), (4, "x", "y"), (0, "x", "z")], "o int, prompt string, generation string")
    assert sorted(r["o"] for r in grouping.dedup(df, ["o"]).collect()) == [0, 1, 3]


def test_refusals(spark):
    df = spark.createDataFrame([("Sure.",), ("As an AI, I think",), ("I CANNOT HELP WITH that",)], "generation string")
    assert [r[0] for r in filters.no_refusals(df, []).collect()] == ["Sure."]


@pytest.mark.parametrize(("start", "most", "mode", "want"), [(0, 3, "reference", [0, 1, 2]), (1, 3, "reference", [0, 1, 2, 3]), (5, 2, "reference", [4, 5, 6]), (5, 2, "fixed", [4, 5]), (8, 0, "reference", [7, 8, 9]), (0, 0, "fixed", list(range(10)))])
def test_offset_and_limit(spark, start, most, mode, want):
    assert [r[0] for r in grouping.window_of(spark.range(10), ["id"], start, most, mode).collect()] == want


def test_islands(spark):
    rows = [("f", 0, "a"), ("f", 1, "a"), ("f", 2, None), ("f", 3, None), ("f", 4, "a"), ("g", 0, "a")]
    df = spark.createDataFrame(rows, "file string, row int, t string")
    got = {(r["file"], r["row"]): r["island"] for r in grouping.islands(df, ["file"], ["row"], ["t"]).collect()}
    assert got == {("f", 0): 0, ("f", 1): 0, ("f", 2): 1, ("f", 3): 1, ("f", 4): 2, ("g", 0): 0}


def test_number(spark):
    got = grouping.number(spark.range(1000).withColumn("k", F.hash("id")), ["k", "id"], start=5).orderBy("k", "id").collect()
    assert [r["idx"] for r in got] == list(range(5, 1005))
    assert grouping.number(spark.range(0), ["id"]).count() == 0


def test_override(spark):
    rows = spark.createDataFrame([(1, "own"), (2, "own")], "k int, v string")
    other = spark.createDataFrame([(1, 1, "old"), (1, 2, "new")], "k int, at int, v string")
    assert {r["k"]: r["v"] for r in grouping.override(rows, other, "k", "at", ["v"]).collect()} == {1: "new", 2: "own"}


def test_episodes(spark):
    m = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "system", "s"), (2, 1, "user", "u"), (3, 0, "user", None), (4, 0, "tool", "x")], "conv_id long, turn long, role string, text string")
    got = {r["ord"]: [t["kind"] for t in r["turns"]] for r in episodes.from_messages(m).collect()}
    assert got == {1: ["system", "user", "model"], 2: ["system", "user"]}


def test_queries_are_complete():
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert len(queries.QUERIES) > 80


def test_every_source_reads(spark, sources):
    for name in base.READERS:
        assert base.read(spark, name, sources).count() > 0, name


@pytest.mark.parametrize(("name", "reasons"), [("characterai", {"no time in the file name"}), ("sharegpt", {"no list of messages"}), ("whocars", {"prompt is no JSON list"}), ("wizard_vicuna_70k", {"speakers do not alternate"}), ("dolly", set())])
def test_rejects(spark, sources, name, reasons):
    assert {r["reason"] for r in base.rejects(spark, name, sources).collect()} == reasons


IDS = {
    "AiDungeonTextAdventureTask": (["ai-dungeon-0", "ai-dungeon-1"], ["ai-dungeon-0", "ai-dungeon-1"]),
    "AiroborosInstructionFollowingTask": (["airoboros-instruct-1", "airoboros-instruct-3"],) * 2,
    "AiroborosGuessTheInstructionTask": (["airoboros-gti-1", "airoboros-gti-3"],) * 2,
    "CharacterAiRoleplayTask": (["characterai-roleplay-1700000000001-m1"],) * 2,
    "ClaudeEvolInstructTask": (["claude-evol-instruct-0", "claude-evol-instruct-1"], ["claude-evol-instruct-0"]),
    "ClaudeGuessTheInstructionTask": (["claude-gti-a", "claude-gti-c", "claude-gti-d"], ["claude-gti-a", "claude-gti-c"]),
    "ClaudeInstructTask": (["claude-instruct-a", "claude-instruct-c", "claude-instruct-d"],) * 2,
    "ClaudeRoleplayTask": (["claude-rp-0", "claude-rp-1"],) * 2,
    "ClubFloydTextAdventureTask": (["club-floyd-0", "club-floyd-2"],) * 2,
    "DollyGuessTheInstructionTask": (["dolly-0", "dolly-1"],) * 2,
    "EvolInstructTask": (["evol-instruct-0"],) * 2,
    "Gpt4AllQuestionAnsweringTask": (["gpt4all-0", "gpt4all-1"],) * 2,
    "McStoriesWritingTask": (["mcstories-0"],) * 2,
    "LimaRpRoleplayTask": (["limarp-forum-a-12"],) * 2,
    "OpenOrcaInstructionFollowingTask": (["openorca-q.1", "openorca-q.2", "openorca-q.3"], ["openorca-q.1", "openorca-q.3"]),
    "RpForumsWritingTask": (["rp-board.csv-Inn", "rp-board.csv-Road"],) * 2,
    "RpGuildWritingTask": (["rp-guild-Crowd", "rp-guild-Keep"], ["rp-guild-Crowd", "rp-guild-Keep", "rp-guild-Last"]),
    "ShareGptInstructionFollowingTask": (["sharegpt-one"],) * 2,
    "SingleTurnInstructionFollowingTask": ([f"gpteacher-{k}" for k in range(6)],) * 2,
    "SodaReplyGenerationTask": (["soda-train-7-reply-generation"] * 2,) * 2,
    "SodaSummarizationTask": (["soda-train-7-summarization"],) * 2,
    "SuperCotInstructionFollowingTask": (["supercot-0", "supercot-1", "supercot-2"],) * 2,
    "WhocarsRoleplayTask": (["whocars-0"],) * 2,
    "WizardVicunaQuestionAnsweringTask": (["wizard-vicuna-w1-0", "wizard-vicuna-w4-3"],) * 2,
}


@pytest.mark.parametrize("name", IDS)
def test_task_identifiers(spark, sources, name):
    for mode, want in zip(tasks.MODES, IDS[name]):
        rows = tasks.run(spark, name, sources, mode=mode).collect()
        assert sorted(r["identifier"] for r in rows) == want
        assert all(r["turns"][0]["kind"] == "system" for r in rows)
        assert all(t["utterance"] is not None for r in rows for t in r["turns"])


def test_airoboros2(spark, sources):
    got = {r["identifier"]: [(t["kind"], t["utterance"]) for t in r["turns"]] for r in tasks.run(spark, "Airoboros2InstructionFollowingTask", sources).collect()}
    assert {"airoboros2-song-1", "airoboros2-song-2", "airoboros2-agent-1", "airoboros2-awareness-3", "airoboros2-gtkm-1", "airoboros2-trivia-1"} <= set(got)
    assert not any("orca" in k for k in got) and len(got) == 12
    assert got["airoboros2-agent-1"][:2] == [("system", "Use the tools."), ("user", "find it")]
    assert got["airoboros2-awareness-2"][1:] == [("user", "USER: Do you sleep?"), ("model", "ASSISTANT: No.")]
    chat = got["airoboros2-gtkm-1"]
    assert [k for k, _ in chat] == ["system", "user", "model", "user", "model"]
    assert chat[1][1] == "Bob: What do you keep?\nIt hums." and chat[-1][1] == "Ann: Rarely."
    assert got["airoboros2-contextual-1"][1][1].endswith("Why is it wet?") and "BEGINCONTEXT" not in got["airoboros2-contextual-1"][1][1]


def test_roleplay_details(spark, sources):
    moss = tasks.run(spark, "CharacterAiRoleplayTask", sources).first()["turns"]
    assert "A quiet troll." in moss[0]["utterance"] and moss[1]["utterance"] == "Hi {{user}}, I am Moss"
    inn = {r["identifier"]: r["turns"] for r in tasks.run(spark, "RpForumsWritingTask", sources).collect()}["rp-board.csv-Inn"]
    assert "https" not in inn[-1]["utterance"] and inn[-1]["utterance"] == "{{char_0}} nods... see now"
    guild = tasks.run(spark, "RpGuildWritingTask", sources, mode="fixed").collect()
    keep = {r["identifier"]: r["turns"] for r in guild}["rp-guild-Keep"]
    assert keep[1]["kind"] != keep[2]["kind"] and "brb" not in keep[2]["utterance"]
    labelled = tasks.run(spark, "RpForumsWritingTask", sources, all_model_turns=True).collect()
    road = {r["identifier"]: r["turns"] for r in labelled}["rp-board.csv-Road"]
    assert [t["kind"] for t in road] == ["system", "user", "user"]  # an aside, then a glued quotation mark


def test_build_writes_lines(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    names = ["WizardVicunaQuestionAnsweringTask", "OpenOrcaInstructionFollowingTask", "WizardVicunaQuestionAnsweringTask"]
    config = build.Config(names, out, "chatml", ["DuplicateFilter", "RefusalFilter"], root=sources)
    build.run(spark, config)
    rows = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert sorted(r["identifier"] for r in rows) == ["openorca-q.1-0", "openorca-q.3-0", "wizard-vicuna-w1-0-0", "wizard-vicuna-w4-3-0"]
    assert all(set(r) == {"prompt", "generation", "identifier"} for r in rows)
    with pytest.raises(ValueError):
        build.run(spark, build.Config(names, "  ", root=sources))


def test_command_line(spark, sources, capsys):
    c = build.parse(["-t", "DollyGuessTheInstructionTask", "-p", "--data", sources, "--max-count", "1"])
    assert c.show and c.max_count == 1
    build.run(spark, c)
    assert "Why is it so?" in capsys.readouterr().out


def test_streaming(spark, sources, tmp_path):
    from parley.streaming import examples as stream

    src, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    e = tasks.run(spark, "WizardVicunaQuestionAnsweringTask", sources).select("identifier", "turns", F.lit("2024-01-01").cast("timestamp").alias("at"))
    e.union(e).write.json(src)
    q = stream.start(stream.examples(stream.read_episodes(spark, src)), out, at)
    q.processAllAvailable()
    q.stop()
    assert spark.read.json(out).count() == 2


def test_ranks_by_value_and_without_one_task(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("o"))
    got = {r["id"]: r["n"] for r in grouping.counter(rows, "k", ["o", "id"]).collect()}
    want: dict[int, int] = {}
    seen: dict = {}
    for i in sorted(range(500), key=lambda i: (i % 50 if i % 7 else -1, i)):
        k = i % 3 > 0
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert got == want
    for df in (grouping.counter(rows, "k", ["id"]), grouping.window_of(rows, ["id"], 3), grouping.source_cap(rows, ["id"], 100)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CollectLimit" not in plan and "TakeOrdered" not in plan


def test_dedup_of_nulls(spark):
    df = spark.createDataFrame([(0, None, None), (1, "a", None), (2, None, "a"), (3, "", ""), (4, "b", "c")], "o int, prompt string, generation string")
    assert sorted(r["o"] for r in grouping.dedup(df, ["o"]).collect()) == [0, 1, 4]


def test_no_output_in_any_case(spark, tmp_path):
    import json

    (tmp_path / "evol-instruct").mkdir()
    rows = [{"instruction": x, "output": "z q"} for x in ("No Output", "see NOINPUT", "No input", "a fine one", "no outputs at all")]
    (tmp_path / "evol-instruct/alpaca_evol_instruct_70k.json").write_text(json.dumps(rows))
    assert [r["identifier"] for r in tasks.run(spark, "EvolInstructTask", str(tmp_path)).collect()] == ["evol-instruct-3"]


def test_markers_without_a_system_turn_end_the_job(spark):
    from parley.operators import windowing

    e = spark.createDataFrame([("e", [("x", "system", "n"), ("y", "model", "n")])], "identifier string, turns array<struct<utterance: string, kind: string, name: string>>")
    assert windowing.examples(e).first()["prompt"].startswith("<|system|>")
