"""Column functions on catalogue values: literals, scripts, templates, markup.

All are JVM expressions. Patterns use no look-around, so that both Java and
RE2 read them alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three placeholder dialects, tags and entities.
POSITIONAL = "%s"
TOKEN = r"(%s|:[A-Za-z][A-Za-z0-9_]*|_[A-Z]+_)"
TAG = r"</?([A-Za-z][A-Za-z0-9]*)"
ENTITY = r"&[A-Za-z][A-Za-z0-9]*;|&#[0-9]+;"
ODD_BLANKS = r"^ +| +\z|  +"
#: Scripts by the code points of their letters.
SCRIPTS = {
    "latin": r"[A-Za-z]",
    "accented": r"[\x{00C0}-\x{024F}]",
    "georgian": r"[\x{10A0}-\x{10FF}\x{1C90}-\x{1CBF}\x{2D00}-\x{2D2F}]",
}


def decode_literal(raw: Column, quote: Column) -> Column:
    """The value of a quoted literal's inside.

    Both kinds undo a doubled backslash and their own escaped quote; double
    quotes also undo ``\\n``, ``\\t`` and ``\\$``. Cut at doubled backslashes,
    no part has a backslash that belongs to another one.
    """

    def double(part: Column) -> Column:
        for written, meant in (('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\\$", "$")):
            part = F.replace(part, F.lit(written), F.lit(meant))
        return part

    def single(part: Column) -> Column:
        return F.replace(part, F.lit("\\'"), F.lit("'"))

    parts = F.split(raw, r"\\\\")
    decoded = F.when(quote == '"', F.transform(parts, double)).otherwise(F.transform(parts, single))
    return F.array_join(decoded, "\\")


def script_class(value: Column, scripts: Mapping[str, str] = SCRIPTS) -> Column:
    """The one script that a value has letters of, ``mixed`` for several, ``none`` for none; null for null."""
    hits = [F.when(F.regexp_like(value, F.lit(pattern)), F.lit(name)) for name, pattern in scripts.items()]
    found = F.array_compact(F.array(*hits))
    return F.when(value.isNull(), None).when(F.size(found) == 0, "none").when(F.size(found) > 1, "mixed").otherwise(F.get(found, F.lit(0)))


def template_tokens(value: Column) -> Column:
    """Placeholders of all dialects in order."""
    return F.regexp_extract_all(value, F.lit(TOKEN), 1)


def dialect(token: Column) -> Column:
    return F.when(token == POSITIONAL, "positional").when(F.startswith(token, F.lit(":")), "named").otherwise("widget")


def same_tokens(one: Column, other: Column) -> Column:
    """Whether two values have the same placeholders, in any order."""
    return F.sort_array(template_tokens(one)) == F.sort_array(template_tokens(other))


def render_named(template: Column, variables: Mapping[str, Column]) -> Column:
    """``:name`` replaced by each variable, the longest name first, so that no name eats another's beginning."""
    ordered = sorted(variables, key=lambda name: (-len(name), name))
    return reduce(lambda text, name: F.replace(text, F.lit(f":{name}"), variables[name].cast("string")), ordered, template)


def render_positional(template: Column, values: Sequence[Column]) -> Column:
    """Each ``%s`` replaced by the next value; literal percent signs stay, spare places become empty."""
    parts = F.split(template, POSITIONAL)
    filled = F.array(F.lit(""), *(v.cast("string") for v in values))
    woven = F.transform(parts, lambda part, at: F.concat(F.coalesce(F.get(filled, at), F.lit("")), part))
    return F.array_join(woven, "")


def render_widget(template: Column, values: Mapping[str, Column]) -> Column:
    """``_NAME_`` replaced by each value; other names stay."""
    return reduce(lambda text, name: F.replace(text, F.lit(f"_{name}_"), values[name].cast("string")), values, template)


def tags(value: Column) -> Column:
    """Lower-case names of opening and closing tags, in order."""
    return F.transform(F.regexp_extract_all(value, F.lit(TAG), 1), F.lower)


def tag_balance(value: Column, name: str) -> Column:
    """Opening less closing tags of a name."""
    return F.regexp_count(value, F.lit(f"<{name}[ >]")) - F.regexp_count(value, F.lit(f"</{name}>"))


def entities(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(ENTITY), F.lit(0))


def bare_ampersands(value: Column) -> Column:
    """Ampersands that begin no entity."""
    return F.regexp_count(value, F.lit("&")) - F.regexp_count(value, F.lit(ENTITY))


def odd_blanks(value: Column) -> Column:
    """Runs of blanks at either edge, and of more than one inside."""
    return F.regexp_count(value, F.lit(ODD_BLANKS))


def fragment_family(key: Column) -> Column:
    """A numbered key's stem and number, as a struct; the number is null for others, and for one beyond 64 bits."""
    number = F.regexp_extract(key, r"(\d+)$", 1)
    return F.struct(F.regexp_replace(key, r"\d+$", "").alias("stem"), F.when(number != "", number.try_cast("bigint")).alias("number"))
