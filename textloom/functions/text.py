"""Text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rough_sentences(text: Column) -> Column:
    """Parts after . ! ? and white space; blank parts are dropped."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.trim(s) != "")


def slug(text: Column, key: Column | None = None) -> Column:
    """Everything but ASCII letters, digits, _ and - becomes _; a key goes before it."""
    bare = F.regexp_replace(text, "[^a-zA-Z0-9_-]", "_")
    return bare if key is None else F.concat_ws("_", key.cast("string"), bare)


def url_base(url: Column) -> Column:
    """The URL before its first fragment."""
    return F.substring_index(url, "#", 1)


def last_fragment_cut(url: Column) -> Column:
    """The URL without its last fragment."""
    return F.regexp_replace(url, "#[^#]*$", "")


def importance(label: Column) -> Column:
    """Number or label of importance as a value between 0 and 1; anything else is 0.5."""
    # The weights of the labels.
    named = F.when(F.lower(F.trim(label)) == "core", 1.0).when(F.lower(F.trim(label)) == "section_specific", 0.7).when(F.lower(F.trim(label)) == "supporting", 0.5).when(F.lower(F.trim(label)) == "peripheral", 0.2)
    number = label.try_cast("double")
    clamped = F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0)))
    return F.coalesce(named, clamped, F.lit(0.5))


def pipe_triplet(line: Column) -> Column:
    """Struct (subject, relation, object) of a line `subject | relation | object`; null where a part is missing. Further pipes stay in the object."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(line), "^[- ]+", ""), r"^[0-9.)]+\s*", "")
    parts = F.transform(F.split(bare, r"\|", 3), lambda p: F.btrim(F.trim(p), F.lit("\"'")))
    return F.get(F.transform(F.filter(F.array(parts), lambda p: (F.size(p) == 3) & ~F.exists(p, lambda x: x == "")), lambda p: F.struct(p[0].alias("subject"), p[1].alias("relation"), p[2].alias("object"))), 0)


def salience(distance: Column, dep: Column, pos: Column) -> Column:
    """Salience of a mention: nearness in sentences, grammatical role, proper nouns."""
    # The weights of nearness, roles and proper nouns.
    role = F.when(dep == "nsubj", 80).when(dep == "dobj", 50).when(dep.isin("pobj", "iobj"), 40).otherwise(0)
    return F.greatest(F.lit(0), 100 - 25 * distance) + role + F.when(pos == "PROPN", 30).otherwise(0)
