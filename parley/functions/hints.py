"""Hints on style and length that a prompt gives about its reply, in our own words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions import picks, text

ACTIONS = ["Put actions between asterisks", "Mark what characters do with asterisks", "Actions stand in asterisks, as in online roleplay", "Show every action with asterisks around it", "Asterisks should enclose the actions"]
SPEECH = ["Put speech in quotation marks", "What is said goes between quotes", 'Quote spoken lines ("as here")', "Speech stands in quotes"]
LENGTHS = (
    (16, ["Keep the reply short", "Answer briefly", "A small message will do"]),
    (96, ["Write a reply of medium length", "The message should be of moderate size", "Answer at some length"]),
    (192, ["Write a long reply", "The message should be lengthy", "Answer at length"]),
    (None, ["Write a very long reply", "The message should be extremely long", "Answer at great length"]),
)
ONE_PARAGRAPH = ["Use a single paragraph", "One paragraph only", "All of it in one paragraph", "Do not break it into paragraphs"]
PARAGRAPHS = ["Use %d paragraphs", "It takes %d paragraphs", "Write exactly %d paragraphs", "Split it into %d paragraphs", "Answer in %d paragraphs"]
#: Another ladder, for short spoken replies.
SPOKEN = (
    (16, ["Say something short", "Be brief", "A few words", "Keep it short", "Reply in brief", "Short answer", "Say little"]),
    (32, ["Say a sentence or two", "A reply of some length", "Neither short nor long", "A medium reply", "Say a bit more", "A fair amount"]),
    (64, ["Talk for a while", "A long reply", "Several sentences", "Be talkative", "Say a lot", "Answer at length"]),
    (None, ["Talk at great length", "A very long reply", "As long as it takes", "Be very talkative", "Say everything", "Do not hold back", "A speech"]),
)


def _ladder(words: Column, steps, key: Column, salt: str, seed: int) -> Column:
    out = None
    for limit, options in steps:
        pick = picks.one_of(options, key, salt, seed)
        if limit is None:
            return pick if out is None else out.otherwise(pick)
        out = F.when(words < limit, pick) if out is None else out.when(words < limit, pick)
    raise ValueError("the last step of a ladder has no limit")


def style(reply: Column, key: Column, seed: int = picks.SEED) -> Column:
    """Hints on asterisks and quotes where the reply has pairs of them, in seeded order; may be empty."""
    found = F.array_compact(F.array(F.when(text.paired(reply, "*"), picks.one_of(ACTIONS, key, "actions", seed)), F.when(text.paired(reply, '"'), picks.one_of(SPEECH, key, "speech", seed))))
    return F.array_join(picks.shuffled(found, key, "style", seed), ". ")


def length(reply: Column, key: Column, seed: int = picks.SEED) -> Column:
    """A hint on length, with the number of paragraphs: always for two and more, one time in three for one."""
    said = _ladder(text.word_count(reply), LENGTHS, key, "length", seed)
    paragraphs = text.occurrences(reply, "\n\n") + 1
    many = F.replace(picks.one_of(PARAGRAPHS, key, "paragraphs", seed), F.lit("%d"), paragraphs.cast("string"))
    one = picks.one_of(ONE_PARAGRAPH, key, "paragraph", seed)
    single = F.when(picks.below(3, key, "mention", seed) < 2, said).otherwise(F.concat(said, F.lit(". "), one))
    return F.when(paragraphs == 1, single).otherwise(F.concat(said, F.lit(". "), many))


def spoken_length(reply: Column, key: Column, seed: int = picks.SEED) -> Column:
    return _ladder(text.word_count(reply), SPOKEN, key, "spoken", seed)
