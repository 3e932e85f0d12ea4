from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions import chunks, hints, html_md, picks, templates
from parley.functions import text as T

ODD = "a B\t\n \u001c　 .,!?()*\"'é日-"


def run(spark, rows, make, kind="string"):
    data = [(k, v) for k, v in enumerate(rows)]
    df = spark.createDataFrame(data, f"k long, v {kind}")
    return [r["o"] for r in df.select("k", make(F.col("v")).alias("o")).orderBy("k").collect()]


def test_words_and_tokens(spark):
    rows = ["", "  ", "a", "a b c\u001cd　e f", "x" * 10, " lead", None]
    assert run(spark, rows, T.word_count) == [len((r or "").split()) for r in rows]
    assert run(spark, rows, T.token_estimate) == [math.ceil(len((r or "").split()) * 1.7) for r in rows]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ODD, max_size=30), min_size=1, max_size=40))
def test_against_python(spark, rows):
    assert run(spark, rows, T.word_count) == [len(r.split()) for r in rows]
    assert run(spark, rows, T.strip) == [r.strip() for r in rows]
    assert run(spark, rows, T.lines) == [r.splitlines() for r in rows]
    assert run(spark, rows, lambda c: T.paired(c, "*")) == [r.count("*") > 0 and r.count("*") % 2 == 0 for r in rows]
    assert run(spark, rows, T.squeeze_spaces) == [re.sub(" {2,}", " ", r) for r in rows]
    assert run(spark, rows, T.single_spaces) == [re.sub("(?<! ) {2}(?! )", " ", r) for r in rows]


@pytest.mark.parametrize(
    ("make", "given", "wanted"),
    [
        (T.tidy_spacing, "so .. well , no…yes donâ??t", "so... well, no… yes don't"),
        (T.drop_urls, "see https://x.y/z?q now", "see now"),
        (T.drop_reply_lines, "RE: a \nb \n**RE: c\nd", "b\nd"),
        (T.drop_heading_lines, "### T\n a \nb", "a\nb"),
        (T.plain_punctuation, "“a”  b !c.....d", '"a" b!c... d'),
        (T.drop_role_sentence, "You are a bot. Be kind.", "Be kind."),
        (T.drop_trailing_brace, "x{", "x"),
        (T.drop_out_of_character, "hi ((x)) yo (OOC: z) a OOC: brb\nq", "hi  yo  a \nq"),
        (T.drop_mentions, " @ann hi ", "@ann hi"),
        (lambda c: T.drop_mentions(c, "fixed"), "@ann hi @bob.", "hi ."),
        (T.user_token, "You and Your {{chaar}} {{character}}", "{{user}} and Your {{char}} {{char}}"),
        (lambda c: T.block(c, "A(", ")B"), "x A( y )B A( z )B", "y"),
        (lambda c: T.rename(c, [("a", "b"), ("bb", "c")]), "ab", "c"),
        (html_md.mend_fences, "```jsCopy codelet x```", "```js\nlet x```"),
        (html_md.drop_counter, "1 / 2x 1 / 2", "x 1 / 2"),
        (html_md.drop_copy_captions, "Copy3 chars / 1 wordsx``` ```y", "xy"),
        (html_md.compact, " a \n\n\n\nb ", "a\n\nb"),
        (html_md.loosen_emphasis, "a*b*c **d** e*f", "a *b* c **d** e *f"),
        (html_md.drop_quotes_and_scripts, "<blockquote>a</blockquote>b<script>c</script><div>d</div>", "b<div>d</div>"),
    ],
)
def test_cleaning(spark, make, given, wanted):
    assert run(spark, [given, None], make) == [wanted, None]


def test_predicates(spark):
    rows = ['a " b', 'a"b', "a(b", "i'm", "[x](y)", "Fine (yes) \"no\" I am", "(OOC: x)", "x (y)"]
    assert run(spark, rows[:6], T.unusable) == [True, True, True, True, True, False]
    assert run(spark, rows[6:], T.out_of_character) == [True, False]
    assert run(spark, ["abc", " Abc", "Abc", ""], T.starts_midway) == [True, True, False, False]


def test_lists(spark):
    kind = "array<string>"
    rows = [[], ["x"], ["x", "y"], ["x", "y", "z"]]
    assert run(spark, rows, T.conjunction, kind) == [None, "x", "x and y", None]
    assert run(spark, rows, lambda c: T.conjunction(c, "fixed"), kind) == [None, "x", "x and y", "x, y and z"]
    assert run(spark, rows[1:], T.participants, kind) == [" and x", "x and y", "x, y and z"]
    assert run(spark, [["Ab", "cd"]], lambda c: T.without(c, ["A"]), kind) == [["cd"]]
    assert run(spark, ["['a', 'b c']"], T.list_literal) == [["a", "b c"]]
    assert run(spark, ["A chat between Al and Bo. x", "A chat between Al. x"], T.name_pair) == [["Al", "Bo"], None]
    assert run(spark, ["first\nAl: x\nmore\nBo: y"], T.speaker_lines) == [["first", "Al: x\nmore", "Bo: y"]]


def test_pseudonyms(spark):
    names = F.array(F.lit("Bob"), F.lit(""), F.lit("A.l"))
    assert run(spark, ["Bob, Bobby, A.l and Axl"], lambda c: T.pseudonymise(c, names)) == ["{{char_0}}, Bobby, {{char_2}} and Axl"]


def test_cosine(spark):
    pairs = [("a bb bb cc", "bb cc dd"), ("", "x"), ("aa", "aa"), ("Äb äb", "äb"), ("one two", "three four")]

    def want(a, b):
        x, y = (Counter(re.findall(r"\b\w\w+\b", t.lower())) for t in (a, b))
        n = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
        return sum(x[t] * y[t] for t in x) / n if n else None

    got = [r[0] for r in spark.createDataFrame(pairs, "a string, b string").select(T.cosine(F.col("a"), F.col("b"))).collect()]
    for g, (a, b) in zip(got, pairs):
        assert g == pytest.approx(want(a, b)) if want(a, b) is not None else g is None


def test_variants():
    assert templates.expand("%{Hello|Hi} there%{.|!}") == ["Hello there.", "Hello there!", "Hi there.", "Hi there!"]
    assert templates.expand("plain") == ["plain"]
    assert templates.expand("%{a| |b}") == ["a", "b"]
    assert len(templates.expand("%{a|b}" * 10)) == 256
    assert len(templates.expand("%{a|b}" * 8)) == 256
    assert len(templates.expand("%{a|b}" * 9, None)) == 512


def test_picks_are_plan_independent(spark):
    df = spark.range(200)
    one = {r[0]: r[1] for r in df.select("id", picks.below(7, F.col("id"), "s")).collect()}
    two = {r[0]: r[1] for r in df.repartition(9).select("id", picks.below(7, F.col("id"), "s")).collect()}
    assert one == two and set(one.values()) == set(range(7))
    other = {r[0]: r[1] for r in df.select("id", picks.below(7, F.col("id"), "s", 1)).collect()}
    assert other != one


def test_hints(spark):
    texts = ["w " * n for n in (1, 15, 16, 95, 96, 191, 192)]
    got = run(spark, texts, lambda c: hints.length(c, F.lit("k")))
    for g, step in zip(got, (0, 0, 1, 1, 2, 2, 3)):
        assert any(g.startswith(o) for o in hints.LENGTHS[step][1])
    assert "3 paragraphs" in run(spark, ["a\n\nb\n\nc"], lambda c: hints.length(c, F.lit("k")))[0]
    styles = run(spark, ["*a*", '"a"', '*a* "b"', "*a", ""], lambda c: hints.style(c, F.lit("k")))
    assert styles[0] in hints.ACTIONS and styles[1] in hints.SPEECH and styles[3] == styles[4] == ""
    assert set(styles[2].split(". ")) <= {*hints.ACTIONS, *hints.SPEECH}


def _remerge(message, target, mark):
    out = None
    for p in message.split(mark):
        if out is None:
            out = [p]
        elif len(out[-1].split()) + len(p.split()) > target:
            out.append(p)
        else:
            out[-1] += mark + p
    return out


def _adventure(story, least):
    out, cur, n = [], "", 0
    for line in story.splitlines():
        if line.startswith("> "):
            if command := "".join(line.split("> ")).strip():
                out.append(("user", command))
            continue
        cur, n = cur + line.strip() + "\n", n + len(line.split())
        if n >= least:
            out.append(("model", re.compile("\n\n\n+").sub("\n\n", cur)))
            cur, n = "", 0
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a b", "> go", "c d e f", "", ">", "> ", "g"]), max_size=14).map("\n".join), min_size=1, max_size=20))
def test_folds(spark, rows):
    assert run(spark, rows, lambda c: chunks.remerge(c, 5, "\n")) == [_remerge(r, 5, "\n") for r in rows]
    got = run(spark, rows, lambda c: chunks.adventure(c, 5))
    assert [[(t["kind"], t["text"]) for t in g] for g in got] == [_adventure(r, 5) for r in rows]


def test_paragraphs(spark):
    story = "\n\n".join(["w " * 100] * 6)
    assert [len(p.split()) for p in run(spark, [story], chunks.paragraphs)[0]] == [300, 300]
    assert [len(p.split()) for p in run(spark, [story + "\n\nlast"], lambda c: chunks.paragraphs(c, keep_rest=True))[0]] == [300, 300, 1]


def test_markdown(spark):
    html = "<h2>T</h2><p>a <b>b</b> &amp; <i>c</i><br>d</p><ul><li>x</li><li>y<ol><li>z</li></ol></li></ul><a href='u'>l</a><script>no()</script><pre>k  v</pre>"
    want = "## T\n\na **b** & *c*  \nd\n\n* x\n* y\n  1. z\n\n[l](u)\n\n```\nk  v\n```"
    assert run(spark, [html, None, "", "<b>open"], html_md.to_markdown) == [want, None, "", "**open"]
