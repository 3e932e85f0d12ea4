"""Small original data in the layout of every source."""

from __future__ import annotations

import csv
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from parley.sources.readers import TEACHER_FILES

CHAT = "A chat between Ann and Bob. Both like tea.\nAnn: keeps bees.\nBob: What do you keep?\nIt hums.\nAnn: Bees, mostly.\nBob: Do they sting?"


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def _json(path: str, value) -> None:
    _write(path, json.dumps(value, ensure_ascii=False))


def _lines(path: str, rows: list) -> None:
    _write(path, "".join(json.dumps(r) + "\n" for r in rows))


def _csv(path: str, header: list[str], rows: list[list[str]]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def _parquet(path: str, columns: dict) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def make(root: str) -> None:
    d = lambda *p: os.path.join(root, *p)
    tale = " ".join(["The road went on past the mill"] * 60)
    _write(d("ai-dungeon", "text_adventures.txt"), f"<|startoftext|>You wake.\n> look\n{tale}\n> go north\n{tale}\n<|endoftext|>\n<|startoftext|>A cave.\n> \n{tale}\nThe rest.\n<|endoftext|>\n")
    _lines(d("airoboros", "instructions.jsonl"), [{"instruction": "Name a tree.", "response": "An oak."}, {"instruction": "Who are you?", "response": " Airoboros "}, {"instruction": "Count to two.", "response": "One, two."}])
    block = "BEGININPUT\nBEGINCONTEXT\nit rained\nENDCONTEXT\nThe street is wet.\nENDINPUT\nBEGININSTRUCTION\nWhy is it wet?\nENDINSTRUCTION"
    _lines(d("airoboros2", "instructions.jsonl"), [
        {"instruction": "Sing.", "response": "La.", "system": "A chat.", "category": "song"}, {"instruction": "Skip me.", "response": "No.", "system": "A chat.", "category": "orca"}, {"instruction": "Sing again.", "response": "La la.", "system": "A chat.", "category": "song"},
        {"instruction": "Use the tools.\n\nInput: find it", "response": "found", "system": "A chat.", "category": "agent"}, {"instruction": "Do you eat?", "response": "I do not.", "system": "A chat.", "category": "awareness"}, {"instruction": "Do you sleep?", "response": "No.", "system": "You are stone.", "category": "awareness"},
        {"instruction": CHAT, "response": "Rarely.", "system": "A chat.", "category": "awareness"}, {"instruction": block, "response": "It rained.", "system": "A chat.", "category": "contextual"}, {"instruction": block, "response": "It snowed.", "system": "A chat.", "category": "counterfactual_contextual"},
        {"instruction": CHAT, "response": "Rarely.", "system": "A chat.", "category": "gtkm"}, {"instruction": "Hi!", "response": "Arr!", "system": "You are a pirate.", "category": "greeting"}, {"instruction": "BEGININPUT\nLong text.\nENDINPUT\nBEGININSTRUCTION\nShorten it.\nENDINSTRUCTION", "response": "Text.", "system": "A chat.", "category": "summarization"},
        {"instruction": "Highest hill?", "response": "That one.", "system": "A chat.", "category": "trivia"}, {"instruction": "x", "response": "y", "system": "A chat.", "category": "no such thing"},
    ])
    bot = {"name": "Moss", "title": "t", "description": "", "greeting": "Hm.", "external_id": "m1"}
    _write(d("characterai", "public", "1700000000000_a.json"), "﻿" + json.dumps({"character": bot | {"description": "A quiet troll.", "definition": "Likes rain."}}))
    _json(d("characterai", "public", "1700000000001_b.json"), {"histories": {"histories": [{"external_id": "h", "msgs": [{"text": "Hi [REDACTED], I am {{char}}", "src": {"is_human": False}}, {"text": "Hello", "src": {"is_human": True}}]}]}, "info": {"character": bot}})
    _json(d("characterai", "private", "1700000000002_c.json"), {"histories": {"histories": [{"external_id": "h", "msgs": [{"text": "x", "src": {"is_human": True}}]}]}, "info": {"character": bot | {"external_id": "m2", "name": "Nobody"}}})
    _write(d("characterai", "private", "broken.json"), "{")
    _json(d("claude-evol", "claude_evol_instruct_210k.json"), [{"instruction": "Who?", "output": "I am Claude,  an assistant."}, {"instruction": "Do it.", "output": "I apologize, no."}])
    _write(d("claude-rp", "public", "a.jsonl"), "\n".join(json.dumps(x) for x in [{"chat_metadata": {"note_prompt": "A baker."}}, {"name": "You", "is_user": True, "mes": "Bread?"}, {"name": "Rye", "is_user": False, "mes": "Fresh."}]))
    _write(d("claude-rp", "private", "b.jsonl"), "\n".join(json.dumps(x) for x in [{"name": "Sal", "is_user": True, "mes": "Hey"}, {"name": "Tam", "is_user": False, "mes": "Ho"}, {"name": "Sal", "is_user": True, "mes": "Bye"}]))
    _write(d("claude-rp", "private", "c.jsonl"), "{not json")
    talk = lambda *v: [{"from": ("human", "gpt")[k % 2], "value": x} for k, x in enumerate(v)]
    _json(d("claude-multiround", "claude_multiround_chat_30k.json"), [{"id": "a", "conversations": talk("Hi", "Hello", "More", " ")}, {"id": "b", "conversations": talk("Hi", "")}, {"id": "c", "conversations": talk("One", "Two", "Three", "Four")}, {"id": "d", "conversations": [{"from": "gpt", "value": "First"}, {"from": "human", "value": "Second"}]}])
    story = {"name": "Lamp", "author": "N", "genres": ["Fantasy"], "tags": ["dark", "Parser based", "dark"], "year": 2001, "ratings": [3, 4], "total_ratings": 2, "average_rating": 3.5, "transcript_id": "9", "discretion_advised": False, "description": "A cellar.", "data": [{"action": "%", "response": "It is dark.", "endoftext": False}, {"action": "light lamp", "response": "It is bright.", "endoftext": True}]}
    _json(d("club-floyd", "floyd.json"), {"9": story, "1": story | {"name": "Poor", "average_rating": 2.0}, "5": story | {"name": "Third", "discretion_advised": True}})
    _lines(d("dolly", "databricks-dolly-15k.jsonl"), [{"instruction": "Why  is it   so?", "context": "Because.", "response": "So."}, {"instruction": "What?", "context": "", "response": "That."}])
    _json(d("evol-instruct", "alpaca_evol_instruct_70k.json"), [{"instruction": "Write a poem on salt.", "output": "White grains."}, {"instruction": "Say the same words", "output": "say the same words"}, {"instruction": "noinput here", "output": "x y"}, {"instruction": "Empty", "output": ""}])
    _parquet(d("gpt4all_prompt_generations", "p.parquet"), {"prompt": ["<p>What is <b>this</b>?</p>", "x"], "response": ["<p>A</p><p>test</p>", "y"], "source": ["s", "s"]})
    _json(d("gpt-4-llm", "one.json"), [{"instruction": "i", "input": "", "output": "o"}])
    _json(d("gpt-4-llm", "comparision_data.json"), [{"instruction": "no", "input": "", "output": "no"}])
    for k, f in enumerate(f"{a}/{b}-dataset.json" for a, b in TEACHER_FILES):
        _json(d("gpteacher", f), [{"instruction": f"Translate {k} now", "input": "le mot", "response": "the word"}, {"instruction": "Say le mot", "input": "le mot", "response": "ok"}])
    _write(d("lima-erp", "data", "forum-a", "12.yaml"), "persona:\n  <FIRST>: Tall and shy.\nnames:\n  <FIRST>: Ada\n  <SECOND>: Ben\nscenario: A train.\nconversation:\n- name: <SECOND>\n  text: “Hello”  <FIRST> !\n- name: <FIRST>\n  text: Hi <SECOND>....oh\n")
    _write(d("lima-erp", "data", "forum-a", "13.yaml"), "a: [")
    prose = "".join(f"<p>{' '.join(['word'] * 130)}</p>" for _ in range(5))
    _csv(d("mcstories", "mcstories--all.csv"), ["story_title", "story_author", "story_date", "story_tags", "story_summary", "story_href", "story_header", "story", "story_footer"], [["Fog", "A", "2001", "['sc', 'hu']", "It, \"lifts\"", "h", "", "<h3>Fog</h3>" + prose, ""], ["Bad tag", "A", "2001", "['zz']", "s", "h", "", prose, ""]])
    _parquet(d("openorca", "p.parquet"), {"id": ["q.1", "q.2", "q.3"], "system_prompt": ["You are an AI assistant. Be brief.", "", "You are a poet."], "question": ["a?", "b?", "c?"], "response": ["A", "As an AI I cannot", "C"]})
    long = " ".join(["walks"] * 150)
    _csv(d("rp_forums", "board.csv"), ["thread_title", "message_username", "message"], [["Inn", "Eve", f"{long}<br/><br/>{long}<br/><br/>{long}"], ["Inn", "Kai", "Eve nods .. see https://x.example/a now"], ["OOC chat", "Eve", "hi"], ["OOC chat", "Kai", "ho"], ["Inn", "Kai", "alone"], ["Road", "Eve", "<blockquote>q</blockquote>(OOC: brb)"], ["Road", "Kai", "He said \"stop\" , then left."]])
    _csv(d("rp-guild", "g.csv"), ["thread_title", "thread_type", "thread_tags", "message_username", "message"], [["Keep", "IC", "['Casual', 'Fantasy', 'Medieval', '18+']", "Eve", "Eve waits."], ["Keep", "IC", "['Casual', 'Fantasy', 'Medieval', '18+']", "Kai", "((brb)) Kai comes @Eve."], ["Keep", "OOC", "['Casual']", "Kai", "talk"], ["Crowd", "IC", "[\"1x1\", 'Horror', 'Drama', 'Comedy']", "A", "one"], ["Crowd", "IC", "['1x1', 'Horror', 'Drama', 'Comedy']", "B", "two"], ["Crowd", "IC", "['1x1', 'Horror', 'Drama', 'Comedy']", "C", "three"], ["Last", "IC", "[]", "A", "x"], ["Last", "IC", "[]", "B", "y"]])
    _json(d("sharegpt", "one.json"), [["Write code"], ["<div>Sure</div><pre>pythonCopy codeprint(1)</pre>", "<p>Done</p>"], ["a", "b"], [["<p>Fine</p>"], ["noise"]]])
    _json(d("sharegpt", "bad.json"), [["Q"], ["left .terminal-x"]])
    _write(d("sharegpt", "broken.json"), "nothing")
    _parquet(d("soda", "train.parquet"), {"head": ["h"], "relation": ["r"], "literal": ["l"], "narrative": ["They meet."], "dialogue": [["a", "b", "c", "d e", "f"]], "speakers": [["Al", "Bo", "Al", "Bo", "Cy"]], "original_index": pa.array([7], pa.int64())})
    _json(d("supercot", "filtered.json"), [{"instruction": "Sort", "input": "3 1", "output": "1 3"}, {"instruction": "Run", "rewritten_intent": "fast", "output": "ok"}, {"instruction": "Null", "input": None, "rewritten_intent": "no", "output": "ok"}])
    messages = json.dumps([{"role": "system", "content": " You play {{chaar}}. "}, {"role": "user", "content": "You see?"}, {"role": "assistant", "content": "I, {{character}}, see."}])
    _csv(d("whocars", "w.csv"), ["model", "endpoint", "prompt json", "response"], [["gpt-4-x", "openai", messages, "r"], ["gpt-4-x", "kobold", messages, "r"], ["gpt-3", "openai", messages, "r"], ["gpt-4", "openai", "{", "r"], ["gpt-4", "openai", json.dumps([{"role": "user", "content": "x"}]), "r"]])
    _csv(d("whocars", "__index__.csv"), ["model"], [["no"]])
    _json(d("wizard_vicuna_70k", "wizard_vicuna_dataset.json"), [{"id": "w1", "conversations": talk("Q1", "A1 {", "Q2", "lower", "Q3")}, {"id": "w2", "conversations": [{"from": "gpt", "value": "x"}, {"from": "human", "value": "y"}]}, {"id": "w3", "conversations": talk("Q4", "")}, {"id": "w4", "conversations": talk("Q5", "Fine.{")}])
