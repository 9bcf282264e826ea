"""Hierarchies over ordered units, and the best antecedent of a pronoun."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import salience
from textloom.operators.places import placed, running_best
from textloom.session import discard, materialize

MAX_LEVELS = 10
DOUBLINGS = 24  # paths of up to 2**24 steps; only a cycle needs more


def levels(units: DataFrame, key: str, order: str, width: int, top: int = 1) -> DataFrame:
    """(key, level, node, parent): units in order are grouped by width, groups again, until at most `top` remain.

    Levels are bounded by MAX_LEVELS; the parent of the last level is null.
    """
    base = placed(units.select(key, order), [key], order, "node").select(key, "node")
    sizes = base.groupBy(key).agg(F.count("*").alias("size"))
    rows = base.join(sizes, key)
    out = None
    for level in range(MAX_LEVELS):
        done = (F.col("size") <= top) | F.lit(level == MAX_LEVELS - 1)
        parent = F.when(~done, F.floor(F.col("node") / width).cast("int"))
        now = rows.select(key, F.lit(level).alias("level"), "node", parent.alias("parent"))
        out = now if out is None else out.unionByName(now)
        rows = rows.where(~done).select(key, F.floor(F.col("node") / width).cast("int").alias("node"), F.ceil(F.col("size") / width).alias("size")).distinct()
    return out


def level_sizes(tree: DataFrame, key: str) -> DataFrame:
    """(key, level, n)."""
    return tree.groupBy(key, "level").agg(F.count("*").alias("n"))


# Gender and number of the pronouns.
PRONOUNS = {
    "he": ("male", "sing"), "him": ("male", "sing"), "his": ("male", "sing"), "she": ("female", "sing"), "her": ("female", "sing"),
    "it": ("neutral", "sing"), "its": ("neutral", "sing"), "they": ("unknown", "plural"), "them": ("unknown", "plural"), "their": ("unknown", "plural"),
}
NEAR = 3  # sentences back within which nearness still counts


def agreement(pronoun: Column) -> Column:
    """Struct of the gender and number a pronoun asks for; null for another word."""
    out = F.lit(None).cast("struct<gender: string, number: string>")
    for word, (gender, number) in PRONOUNS.items():
        out = F.when(F.lower(pronoun) == word, F.struct(F.lit(gender).alias("gender"), F.lit(number).alias("number"))).otherwise(out)
    return out


def compatible(pronoun: Column, gender: Column, number: Column) -> Column:
    """Whether a mention's gender and number fit what a pronoun asks for; unknown genders fit all."""
    asked = agreement(pronoun)
    return F.coalesce((asked["number"] == number) & ((asked["gender"] == "unknown") | (gender == "unknown") | (asked["gender"] == gender)), F.lit(False))


def antecedents(pronouns: DataFrame, mentions: DataFrame, key: str) -> DataFrame:
    """(key, token, antecedent, score): the most salient earlier mention that agrees with each pronoun, the earliest among equals; -1 without one.

    pronouns (key, token, sent, word), mentions (key, token, sent, text, dep,
    pos, gender, number). Mentions of the last sentences are joined by
    sentence; to those further back nearness adds nothing, so of each kind of
    gender and number only the running best is needed.
    """
    kinds = sorted(set(PRONOUNS.values()))
    asked = pronouns.select(key, F.col("token").alias("at"), F.col("sent").alias("now"), "word", agreement(F.col("word")).alias("ask")).where("ask is not null")
    near = asked.select("*", F.explode(F.sequence(F.greatest(F.lit(0), F.col("now") - NEAR), F.col("now"))).alias("sent")).join(mentions, [key, "sent"])
    near = near.where((F.col("token") < F.col("at")) & compatible(F.col("word"), F.col("gender"), F.col("number")))
    candidate = lambda score: F.struct(score.cast("int").alias("score"), (-F.col("token")).alias("minus"), F.col("text"))
    best = near.select(key, "at", candidate(salience(F.col("now") - F.col("sent"), F.col("dep"), F.col("pos"))).alias("c"))
    fits = F.array(*(F.when((F.col("number") == n) & ((F.lit(g) == "unknown") | F.col("gender").isin("unknown", g)), F.lit(f"{g} {n}")) for g, n in kinds))
    far = mentions.select(F.col(key), "token", candidate(salience(F.lit(NEAR + 1), F.col("dep"), F.col("pos"))).alias("c"), F.explode(F.filter(fits, lambda x: x.isNotNull())).alias("kind"))
    wanted = asked.select(F.col(key), F.col("at").alias("token"), F.concat_ws(" ", "ask.gender", "ask.number").alias("kind"))
    split = lambda df: df.withColumn("_group", F.struct(key, "kind"))
    earlier = running_best(split(far), split(wanted), "_group", "token", "c").select(key, F.col("token").alias("at"), "c")
    top = best.unionByName(earlier.where("c is not null")).groupBy(key, "at").agg(F.max("c").alias("b"))
    joined = pronouns.select(key, F.col("token").alias("at")).join(top, [key, "at"], "left")
    return joined.select(key, F.col("at").alias("token"), F.col("b.text").alias("antecedent"), F.coalesce("b.score", F.lit(-1)).alias("score"))


def paths_to_root(tree: DataFrame, key: str, node: str, parent: str) -> DataFrame:
    """(key, node, depth, root): steps from each node up to its root, by doubling jumps; nodes on a cycle have no root.

    Each round reads what the last one wrote, so plans stay small; there are as
    many rounds as the depth has binary digits.
    """
    now = tree.select(key, F.col(node).alias("node"), F.col(parent).alias("up"), F.when(F.col(parent).isNull(), 0).otherwise(1).alias("depth"), F.col(node).alias("top"))
    now = now.withColumn("top", F.coalesce("up", "node"))
    older = None
    for _ in range(DOUBLINGS):
        now = materialize(now, "paths")
        discard(older)
        older = now
        if now.where("up is not null").isEmpty():
            break
        jump = now.select(key, F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("top").alias("t2"))
        joined = now.join(jump, [key, "up"], "left")
        now = joined.select(key, "node", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.coalesce("t2", "top").alias("top"))
    return now.select(key, "node", "depth", F.when(F.col("up").isNull(), F.col("top")).alias("root"))


def aggregation_parts(sizes: Column, most: int, depth: int = 8) -> Column:
    """Segments (start, stop) into which the children of a node are cut to be summarised: one of more than two children and more than `most` characters is halved, and its halves again, up to `depth` times."""
    whole = F.array(F.struct(F.lit(0).alias("start"), F.size(sizes).alias("stop")))
    n = lambda s: s["stop"] - s["start"]
    weight = lambda s: F.aggregate(F.slice(sizes, s["start"] + 1, n(s)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    middle = lambda s: s["start"] + F.floor(n(s) / 2).cast("int")
    halves = lambda s: F.array(F.struct(s["start"].alias("start"), middle(s).alias("stop")), F.struct(middle(s).alias("start"), s["stop"].alias("stop")))
    for _ in range(depth):
        whole = F.flatten(F.transform(whole, lambda s: F.when((n(s) > 2) & (weight(s) > most), halves(s)).otherwise(F.array(s))))
    return whole
