"""Example filters: refusals, similarity; and the registry of filters by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text
from parley.operators import grouping

#: Parts of replies that refuse, moralise or speak as a model; in lower case, none holds another.
REFUSALS = tuple((
    "ableist|activities that could harm|activities that could undermine|adhere to safety|adherence to the law|against my programming|ai assistant|"
    "ai principles|an ai language|as a language model|as a large language model|as an ai|as an artificial intelligence|bias|"
    "cannot engage in discussions|cannot provide|cannot support or promote|capitalism|chatgpt|committed to promoting|communist|consensual|"
    "consult a professional|content policy|dangerous activities|derogatory|discriminat|domestic violence|empowerment|ensure the safety|ethic|extremist|"
    "feminis|focus on promoting safety|gender inequality|gender-based|glorify|harmful|hate speech|hateful|hurtful|i am just a machine|i am not able to|"
    "i am sorry, but i|i am unable to|i apologize, but|i can't assist|i can't comply|i can't create|i can't fulfil|i can't help with|i can't provide|"
    "i cannot assist|i cannot comply|i cannot create|i cannot fulfil|i cannot help with|i do not have access to|i do not have feelings|"
    "i do not have opinions|i do not have personal|i don't have access to|i don't have feelings|i don't have opinions|i don't have personal|"
    "i have to decline|i must decline|i will not be able to|i won't be able to|i'm not able to|i'm only a program|i'm sorry, but i|i'm unable to|"
    "illegal|inappropriate|inclusive workplace|inclusivity|it is important to|it is never okay|it is not appropriate|it's important to|"
    "it's not appropriate|jeopardize the safety|knowledge cut-off|lawful information|legality|lgbt|maintain user safety|microaggression|morals|"
    "my guidelines|my knowledge cutoff|my training data|not able to provide|not be appropriate|not within the scope|offensive|openai|please refrain|"
    "pose a risk to others|potentially dangerous|prioritize human safety|prioritize safety|prioritize user|programming prohibits|promote harm|"
    "promote safety|promote the well-being|racial|racis|real-time information|real-world consequences|respectful and inclusive|responsible ai|"
    "responsible information|safe information|safe spaces|seek professional help|sexis|sorry, i can't|sorry, i cannot|stereotype|supremacist|"
    "transgender|unable to offer assistance|unacceptable|undermine the stability|underrepresentation|well-being of all users"
).split("|"))
NO_OUTPUT = ("nooutput", "no output", "noinput", "no input")


def refuses(reply: Column, phrases: tuple[str, ...] = REFUSALS) -> Column:
    """Whether a reply holds one of the phrases, in any case of letters: one pass of one pattern."""
    return F.lower(reply).rlike("|".join(f"\\Q{p}\\E" for p in phrases))


def no_refusals(examples: DataFrame, order: list[str]) -> DataFrame:
    return examples.filter(~refuses(F.col("generation")))


def similar(a: Column, b: Column, most: float = 0.9) -> Column:
    """Whether the term counts of two texts are nearer than ``most``; texts without terms are not."""
    return F.coalesce(text.cosine(a, b) > most, F.lit(False))


Filter = Callable[[DataFrame, list[str]], DataFrame]
FILTERS: dict[str, Filter] = {"DuplicateFilter": grouping.dedup, "RefusalFilter": no_refusals}


def register(name: str, apply: Filter) -> None:
    FILTERS[name] = apply


def apply_all(examples: DataFrame, names: list[str], order: list[str]) -> DataFrame:
    """Apply filters by name; tests of single rows go first, since that leaves less to compare.

    The result is the same as in the order given but for examples that are
    equal only once prompt and generation are joined.
    """
    for n in sorted(names, key=lambda n: n == "DuplicateFilter"):
        if n not in FILTERS:
            raise ValueError(f"unknown filter {n!r}; there are {', '.join(sorted(FILTERS))}")
        examples = FILTERS[n](examples, order)
    return examples
