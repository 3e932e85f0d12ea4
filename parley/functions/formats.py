"""The seven prompt formats: how a turn reads, and what leads in the model's reply."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The preamble that models of this format were trained with, to the letter.
ALPACA_SYSTEM = "Below is an instruction that describes a task. " + "Write a response that appropriately completes the request." + "\n\n### Instruction:"


def _by_kind(t: Column, system: Column | str, user: Column | str, model: Column | str) -> Column:
    s, u, m = (F.lit(x) if isinstance(x, str) else x for x in (system, user, model))
    return F.when(t["kind"] == "system", s).when(t["kind"] == "user", u).otherwise(m)


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _markers(t: Column) -> Column:
    return _cat(_by_kind(t, "<|system|>", "<|user|>", "<|model|>"), t["utterance"])


def _persona(t: Column) -> Column:
    said = _cat(t["name"], ": ", t["utterance"])
    return _by_kind(t, _cat(t["name"], "'s Persona: ", t["utterance"], "\n<START>"), said, said)


def _alpaca(t: Column) -> Column:
    return _cat(_by_kind(t, ALPACA_SYSTEM, "### Input:", "### Response:"), "\n", t["utterance"], "\n\n")


def _minimal_alpaca(t: Column) -> Column:
    return _cat(_by_kind(t, "### Instruction:", "### Instruction:", "### Response:"), "\n", t["utterance"], "\n")


def _henkpaca(t: Column) -> Column:
    said = _cat(t["name"], ": ", t["utterance"], "\n")
    return _by_kind(t, _cat("### Instruction:\n", t["utterance"], "\n### Response:\n"), said, said)


def _role(t: Column) -> Column:
    return _by_kind(t, "system", "user", "assistant")


def _chatml(t: Column) -> Column:
    return _cat("<|im_start|>", _role(t), "\n", t["utterance"], "<|im_end|>\n")


def _chatml_named(t: Column) -> Column:
    return _cat("<|im_start|>", _role(t), " name=", t["name"], "\n", t["utterance"], "<|im_end|>\n")


Turn = Callable[[Column], Column]
#: Name: (a turn as text, what a prompt ends with before the reply of a turn).
FORMATS: dict[str, tuple[Turn, Turn]] = {
    "markers": (_markers, lambda t: F.lit("<|model|>")),
    "persona": (_persona, lambda t: _cat("\n", t["name"], ": ")),
    "alpaca": (_alpaca, lambda t: F.lit("### Response:\n")),
    "minimal_alpaca": (_minimal_alpaca, lambda t: F.lit("### Response:\n")),
    "henkpaca": (_henkpaca, lambda t: _cat(t["name"], ": ")),
    "chatml": (_chatml, lambda t: F.lit("<|im_start|>assistant\n")),
    "chatml_named": (_chatml_named, lambda t: _cat("<|im_start|>assistant name=", t["name"], "\n")),
}
#: What a reply ends with.
ENDINGS = {"chatml": "<|im_end|>", "chatml_named": "<|im_end|>"}


def register(name: str, as_text: Turn, lead_in: Turn, ending: str = "") -> None:
    """Add a format; names are in lower case."""
    FORMATS[name.lower()] = (as_text, lead_in)
    if ending:
        ENDINGS[name.lower()] = ending


def alias(name: str, known: str) -> None:
    """Let a format go by another name as well, such as one that a user's scripts have."""
    key, *format_ = lookup(known)
    register(name, *format_, ENDINGS.get(key, ""))


def lookup(name: str) -> tuple[str, Turn, Turn]:
    """The format of a name in any case of letters."""
    key = name.lower()
    if key not in FORMATS:
        raise ValueError(f"unknown format {name!r}; there are {', '.join(sorted(FORMATS))}")
    return key, *FORMATS[key]
