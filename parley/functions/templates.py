"""Prompt templates: ``%{a|b}`` blocks with alternatives, and placeholders."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = re.compile(r"%\{([^\n]+?)\}")
LIMIT = 256


def expand(template: str, limit: int | None = LIMIT) -> list[str]:
    """All variants of a template in order, at most ``limit``; blank alternatives don't count.

    A block without any alternative left gives no variant. The limit is hard.
    """
    parts = BLOCK.split(template)
    options = [[p] if k % 2 == 0 else [a for a in p.split("|") if a.strip()] for k, p in enumerate(parts)]
    found = ("".join(x) for x in itertools.product(*options))
    return list(found if limit is None else itertools.islice(found, limit))


def bank(templates: list[str] | tuple[str, ...], limit: int | None = LIMIT) -> list[list[str]]:
    """The variants of each template; those with none are left out."""
    return [v for t in templates if (v := expand(t, limit))]


def fill(template: Column, values: dict[str, Column | str], style: str = "{{%s}}") -> Column:
    """Replace placeholders one after the other; later ones are also found in text that was filled in.

    Literal replacement; a null value counts as empty.
    """
    for name, value in values.items():
        what = F.lit(value) if isinstance(value, str) else F.coalesce(value, F.lit(""))
        template = F.replace(template, F.lit(style % name), what)
    return template
