"""Text operators as column expressions.

White space is Unicode's and the four separators U+001C to U+001F throughout;
patterns say so themselves, since ``\\s`` alone means ASCII here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = "[\\s\\x1c-\\x1f]"
NOT_WS = "[^\\s\\x1c-\\x1f]"
#: Ends of lines: \n, \r, \r\n, \v, \f, U+001C to U+001E, U+0085, U+2028 and U+2029.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
#: Words to tokens, as an estimate: ceil(words * 1.7), in whole numbers.
TOKENS_PER_10_WORDS = 17


def sub(text: Column, pattern: str, to: str | Column = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(to) if isinstance(to, str) else to)


def literal(text: Column, old: str, new: str | Column) -> Column:
    return F.replace(text, F.lit(old), F.lit(new) if isinstance(new, str) else new)


def word_count(text: Column) -> Column:
    """Words parted by white space, as bigint; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"(?U){NOT_WS}+")).cast("bigint")


def token_estimate(text: Column) -> Column:
    """Tokens that a text is taken to have."""
    return F.floor((word_count(text) * TOKENS_PER_10_WORDS + 9) / 10).cast("bigint")


def strip(text: Column) -> Column:
    return sub(text, f"(?U)\\A{WS}+|{WS}+\\z")


def lstrip(text: Column) -> Column:
    return sub(text, f"(?U)\\A{WS}+")


def rstrip(text: Column) -> Column:
    return sub(text, f"(?U){WS}+\\z")


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal, as bigint."""
    return F.floor((F.length(text) - F.length(literal(text, part, ""))) / len(part)).cast("bigint")


def paired(text: Column, mark: str) -> Column:
    """Whether a mark occurs, and an even number of times."""
    n = occurrences(text, mark)
    return (n > 0) & (n % 2 == 0)


def lines(text: Column) -> Column:
    """Lines without their ends; no empty one after a final end."""
    cut = F.split(text, LINE_END, -1)
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def normal_newlines(text: Column) -> Column:
    return sub(text, "\\r\\n?", "\n")


# -- cleaning ---------------------------------------------------------------
def tidy_spacing(text: Column) -> Column:
    """Repair detached punctuation, glued ellipses and three kinds of broken apostrophes, in this order."""
    for dots in (" .. ", " ... "):
        text = literal(text, dots, "... ")
    text = sub(text, "(?U)\\b\\.{2,3}\\b", "... ")
    for mark in ".,?!":
        text = literal(text, f" {mark} ", f"{mark} ")
    text = sub(text, f"(?U)({NOT_WS})…({NOT_WS})", "$1… $2")
    text = literal(text, "â??", "'")
    text = literal(text, "â?\u009d", "'")
    return literal(text, "\u009d", " ")


def drop_urls(text: Column) -> Column:
    """Remove web addresses with one white space after each."""
    return sub(text, f"(?Ud)https?://.+?(?:{WS}|\\z)")


def has_url(text: Column) -> Column:
    return text.rlike("https?://")


def drop_reply_lines(text: Column) -> Column:
    """Strip line ends and drop lines that repeat a subject (``RE: ``, also in bold)."""
    kept = F.filter(F.transform(lines(text), rstrip), lambda x: ~x.startswith("RE: ") & ~x.startswith("**RE: "))
    return F.array_join(kept, "\n")


def drop_heading_lines(text: Column, mark: str = "###") -> Column:
    """Strip lines and drop those that start with ``mark``."""
    return F.array_join(F.filter(F.transform(lines(text), strip), lambda x: ~x.startswith(mark)), "\n")


def rstrip_lines(text: Column) -> Column:
    return F.array_join(F.transform(lines(text), rstrip), "\n")


def squeeze_newlines(text: Column, least: int = 2) -> Column:
    """Runs of ``least`` or more line feeds become two."""
    return sub(text, f"\\n{{{least},}}", "\n\n")


def squeeze_spaces(text: Column) -> Column:
    return sub(text, " {2,}", " ")


def single_spaces(text: Column) -> Column:
    """Isolated double spaces become one; longer runs stay."""
    return sub(text, "(?<! ) {2}(?! )", " ")


def plain_punctuation(text: Column) -> Column:
    """Straight quotes, dotted ellipses, em dashes, and no space before ! and ?."""
    text = squeeze_spaces(text)
    for mark in "!?":
        text = literal(text, f" {mark}", mark)
    for fancy, plain in (("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"), ("…", "..."), ("---", "—")):
        text = literal(text, fancy, plain)
    text = sub(text, "(?U)(\\w)\\.{2,8}(\\w)", "$1... $2")
    return sub(text, "(?U)(\\w)\\.{3,8}", "$1...")


def rename(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements one after the other; later ones see what earlier ones made."""
    for old, new in pairs:
        text = literal(text, old, new)
    return text


def drop_role_sentence(text: Column) -> Column:
    """Remove a first sentence that starts with ``You are a``."""
    return sub(text, f"(?Ud)\\AYou are a.*?\\.{WS}*")


def drop_trailing_brace(text: Column) -> Column:
    return F.when(text.endswith("{"), F.left(text, F.length(text) - 1)).otherwise(text)


def starts_midway(text: Column) -> Column:
    """Whether a text starts in lower case or with a space: the rest of a bad split."""
    return text.rlike("\\A[a-z ]")


def unusable(text: Column) -> Column:
    """Whether a message is too careless to be an example: floating or glued quotes and brackets, lower-case I, links."""
    return (
        text.rlike("(?U)\\b \" \\b")
        | text.rlike(f"(?U){NOT_WS}\"{NOT_WS}")
        | text.rlike(f"(?U){NOT_WS}\\(|\\){NOT_WS}")
        | text.rlike("(?U)\\bi(?:'m|'ll)?\\b")
        | text.rlike("(?d)\\[.+\\]\\([^\\s]+\\)")
    )


def out_of_character(text: Column) -> Column:
    """Whether a line as a whole is in brackets, with or without OOC."""
    return text.rlike("(?md)^\\((?:OOC: ?)?.+\\)$")


def drop_out_of_character(text: Column) -> Column:
    """Remove double-bracketed asides, ``(OOC: …)``, and ``OOC:`` to the end of its line."""
    return sub(text, "(?Ud)" + "|".join(ASIDES))


#: Double brackets up to the last closing pair of the line; one bracket that starts with OOC; and a
#: bare OOC after white space, to the end of the line (of the text's last line, one character stays).
ASIDES = ("(?:\\[{2}|\\({2}).*(?:\\){2}|\\]{2})", "\\(OOC:.+\\)", f"(?<={WS})OOC:.*(?!$)")


def drop_mentions(text: Column, mode: str = "reference") -> Column:
    """Remove ``@name`` before a space or end mark, and strip.

    Mode ``reference`` only strips: there, the test for the end mark can never hold.
    """
    return strip(text if mode == "reference" else sub(text, "(?U)@\\w+(?=[ .!?])"))


def pseudonymise(text: Column, names: Column, form: str = "{{char_%d}}") -> Column:
    """Replace each name of an array, as a whole word and in its order, by a numbered stand-in; blank names are skipped."""
    numbered = F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("i")))
    numbered = F.filter(numbered, lambda s: F.length(F.trim(s["name"])) > 0)
    before, after = form.split("%d")
    edge = lambda s: F.concat(F.lit("(?U)\\b\\Q"), s["name"], F.lit("\\E\\b"))
    return F.aggregate(numbered, text, lambda t, s: F.regexp_replace(t, edge(s), F.concat(F.lit(before), s["i"].cast("string"), F.lit(after))))


def unify_redactions(text: Column, bot: Column, tokens: list[str]) -> Column:
    """User tokens of many makes become ``{{user}}``; ``{{char}}`` becomes the bot's name."""
    for t in tokens:
        text = literal(text, t, "{{user}}")
    return literal(text, "{{char}}", bot)


def mend_tokens(text: Column) -> Column:
    """Misspelt character tokens become ``{{char}}``."""
    return rename(text, [("{{%s}}" % x, "{{char}}") for x in ("chaar", "character")])


def user_token(text: Column) -> Column:
    """``You`` as a whole word becomes ``{{user}}``; two misspelt tokens are mended."""
    text = sub(text, "(?U)\\bYou\\b", "{{user}}")
    return mend_tokens(text)


# -- parsing ----------------------------------------------------------------
def block(text: Column, start: str, end: str) -> Column:
    """What stands between two marks, stripped; null where the first is missing."""
    rest = F.get(F.split(text, f"\\Q{start}\\E", -1), F.lit(1))
    return strip(F.get(F.split(rest, f"\\Q{end}\\E", -1), F.lit(0)))


def speaker_lines(text: Column) -> Column:
    """Split before lines that hold a colon."""
    return F.split(text, "(?d)[\\n\\t\\r\\f]+(?=.*:)", -1)


def name_pair(text: Column) -> Column:
    """Both names of ``A chat between X and Y.``; null unless there are just two."""
    found = F.split(F.regexp_extract(text, "(?d)(?<=A chat between )(.+? and .+?)(?=\\.)", 1), " and ", -1)
    return F.when(F.size(found) == 2, found)


def list_literal(text: Column) -> Column:
    """Items of a bracketed, quoted list: brackets cut off, quotes removed, split at comma and space."""
    inner = literal(F.substring(text, F.lit(2), F.length(text) - 2), "'", "")
    return F.split(inner, ", ", -1)


def without(tags: Column, parts: list[str]) -> Column:
    """Items that hold none of the parts, in any case of letters."""
    return F.filter(tags, lambda t: ~F.lower(t).rlike("|".join(f"\\Q{p.lower()}\\E" for p in parts)))


def conjunction(items: Column, mode: str = "reference") -> Column:
    """``x``, ``x and y``; null for none. For three and more null in mode ``reference``, else ``x, y and z``."""
    n = F.size(items)
    more = F.lit(None).cast("string") if mode == "reference" else participants(items)
    return F.when(n == 1, F.get(items, F.lit(0))).when(n == 2, F.array_join(items, " and ")).when(n > 2, more)


def participants(names: Column) -> Column:
    """All names but the last joined by commas, then ``and`` and the last one."""
    n = F.size(names)
    return F.concat(F.array_join(F.slice(names, 1, F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.get(names, n - 1))


def terms(text: Column) -> Column:
    """Lower-cased terms of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit("(?U)\\b\\w\\w+\\b"), F.lit(0))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of the term counts of two texts; null where one has no term.

    The terms of both are sorted together, with the side they come from; runs
    of equal ones are the counts, and runs of one term on both sides are
    neighbours, so the work is that of the sort.
    """
    side = lambda c, k: F.transform(terms(c), lambda t: F.struct(t.alias("t"), F.lit(k).alias("k")))

    def score(z: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(z) - 1), lambda i: (i == 0) | (F.get(z, i) != F.get(z, i - 1)))
        runs = lambda s: F.transform(s, lambda i, k: F.struct(F.get(z, i)["t"].alias("t"), F.get(z, i)["k"].alias("k"), (F.coalesce(F.get(s, k + 1), F.size(z)) - i).cast("double").alias("c")))
        return let(let(starts, runs), measure)

    def measure(r: Column) -> Column:
        total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda x, y: x + y)
        dot = total(F.transform(r, lambda x, i: F.when(F.coalesce(F.get(r, i - 1)["t"] == x["t"], F.lit(False)), x["c"] * F.get(r, i - 1)["c"]).otherwise(0.0)))
        norm = lambda k: F.sqrt(total(F.transform(F.filter(r, lambda x: x["k"] == k), lambda x: x["c"] * x["c"])))
        return F.when((norm(0) > 0) & (norm(1) > 0), dot / (norm(0) * norm(1)))

    both = F.array_sort(F.concat(side(a, 0), side(b, 1)))
    return let(both, lambda z: F.when(F.size(z) > 0, score(z)))
