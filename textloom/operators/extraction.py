"""What language models and parsers gave for chunks, as rows: JSON with recovery, normalized triplets, duplicates, substitutions, contexts."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import importance
from textloom.operators.resolution import pairs_within
from textloom.session import batched

# Modifiers that say nothing about a term, and pronouns with gender and number.
STOP_MODIFIERS = {
    "en": ("some", "this", "these", "certain", "various", "the", "a", "an"),
    "ru": ("некоторый", "данный", "этот", "такой", "различный", "определённый", "определенный", "свой", "весь"),
}
ARTICLES = ("the", "a", "an")

ENTITY = "struct<mention_text: string, canonical_name: string, entity_type: string, importance: string, rationale: string>"
TRIPLET = "struct<subject: string, predicate: string, object: string, importance: string, confidence: string, evidence: string>"
REPLY = f"entities array<{ENTITY}>, triplets array<{TRIPLET}>"


def fenced_body(reply: Column) -> Column:
    """A reply without its code fence and without what stands before its first brace."""
    inner = F.regexp_extract(reply, r"(?is)```(?:json)?\s*(.+?)\s*```", 1)
    text = F.when(inner != "", inner).otherwise(reply)
    return F.regexp_replace(text, r"(?s)^[^{\[]*(?=[{\[])", "")


def truncated(reply: Column) -> Column:
    """Whether a reply breaks off: it ends with neither brace nor bracket."""
    bare = F.rtrim(F.regexp_replace(F.rtrim(reply), r"[`\s]+$", ""))
    return F.coalesce((reply != "") & ~F.endswith(bare, F.lit("}")) & ~F.endswith(bare, F.lit("]")), F.lit(False))


def recovered(text: str | None) -> str | None:
    """JSON of what is whole in a text that breaks off: its arrays' whole items, and its whole values; null if nothing is.

    The text is read once: at the last place where an array's item or a value of
    the outermost object ended, open brackets are closed.
    """
    if not text:
        return None
    start = text.find("{")
    if start < 0:
        return None
    stack, inside, escaped, cut = [], False, False, None
    for i, c in enumerate(text[start:], start):
        if inside:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                inside = False
            continue
        if c == '"':
            inside = True
        elif c in "{[":
            stack.append(c)
            if c == "[" and len(stack) == 2:
                cut = (i + 1, "]}")
        elif c in "}]":
            if not stack:
                break
            stack.pop()
            if not stack:
                cut = (i + 1, "")
                break
            if stack in (["{"], ["{", "["]):
                cut = (i + 1, "}" if len(stack) == 1 else "]}")
        elif c == "," and stack in (["{"], ["{", "["]):
            cut = (i, "}" if len(stack) == 1 else "]}")
    if cut is None:
        return None
    whole = text[start : cut[0]] + cut[1]
    for candidate in (whole, re.sub(r",\s*([}\]])", r"\1", whole)):
        try:
            return json.dumps(json.loads(candidate), ensure_ascii=False)
        except ValueError:
            continue
    return None


def parsed_replies(rows: DataFrame, keys: list[str], reply: str) -> DataFrame:
    """(keys, reply struct, truncated): strict JSON by built-in functions; only what these can't read goes through the recovery."""
    body = fenced_body(F.col(reply))
    strict = rows.select(*keys, body.alias("_body"), truncated(F.col(reply)).alias("truncated")).withColumn("_json", F.when(F.try_parse_json("_body").isNotNull(), F.col("_body")))
    good = strict.where("_json is not null or _body is null")
    poor = strict.where("_json is null and _body is not null").withColumn("_json", batched(recovered, "string")("_body"))
    return good.unionByName(poor).select(*keys, F.from_json("_json", REPLY).alias("reply"), "truncated")


def text_or(value: Column, other: Column) -> Column:
    """The value, trimmed; where it is null or empty, the other one."""
    return F.trim(F.coalesce(F.nullif(value, F.lit("")), other, F.lit("")))


def entities_of(replies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, mention, name, entity_type, importance, rationale): entities with a name; the mention stands in for it."""
    e = F.col("e")
    rows = replies.select(*keys, F.posexplode("reply.entities").alias("pos", "e"))
    name = text_or(e["canonical_name"], e["mention_text"])
    named = rows.select(*keys, "pos", text_or(e["mention_text"], name).alias("mention"), name.alias("name"), text_or(e["entity_type"], F.lit("")).alias("entity_type"), importance(e["importance"]).alias("importance"), text_or(e["rationale"], F.lit("")).alias("rationale"))
    return named.where("name != ''")


def unit(value: Column, default: float) -> Column:
    """A number between 0 and 1, or the default for what is none."""
    n = value.try_cast("double")
    return F.coalesce(F.when(n.isNotNull(), F.least(F.greatest(n, F.lit(0.0)), F.lit(1.0))), F.lit(default))


def triplets_of(replies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, subject, predicate, object, importance, confidence, evidence): triplets of three parts that aren't blank."""
    t = F.col("t")
    rows = replies.select(*keys, F.posexplode("reply.triplets").alias("pos", "t"))
    part = lambda c: text_or(t[c], F.lit("")).alias(c)
    whole = rows.select(*keys, "pos", part("subject"), part("predicate"), part("object"), importance(t["importance"]).alias("importance"), unit(t["confidence"], 1.0).alias("confidence"), part("evidence"))
    return whole.where("subject != '' and predicate != '' and object != ''")


def normalized(text: Column, language: str, lemma: Callable[[Column], Column] | None = None) -> Column:
    """A term in lower case, its words as lemmas, without modifiers that say nothing; acronyms of up to six characters stay.

    `lemma` gives the lemma of a word; without it words stay as they are.
    English modifiers are dropped as they stand, Russian ones by their lemma.
    """
    bare = F.trim(text)
    of = lemma or (lambda w: w)
    stop = [F.lit(w) for w in STOP_MODIFIERS[language]]
    words = F.filter(F.split(F.lower(bare), r"\s+"), lambda w: w != "")
    lemmas = F.filter(F.transform(words, of), lambda w: ~w.isin(*stop)) if language == "ru" else F.transform(F.filter(words, lambda w: ~w.isin(*stop)), of)
    acronym = (bare == F.upper(bare)) & (bare != F.lower(bare)) & (F.length(bare) <= 6)
    return F.when((bare == "") | acronym, bare).otherwise(F.array_join(lemmas, " "))


def chunk_label(text: Column, lemma: Callable[[Column], Column] | None = None) -> Column:
    """A noun chunk's label: lower case, without articles, words as lemmas."""
    words = F.filter(F.split(F.lower(F.trim(text)), r"\s+"), lambda w: (w != "") & ~w.isin(*[F.lit(a) for a in ARTICLES]))
    return F.array_join(F.transform(words, lemma or (lambda w: w)), " ")


def greedy_kept(rows: list[tuple], threshold: float) -> list[bool]:
    """Which rows (unit vector, relation) stay: in order, a later similar one goes, unless its relation is shorter: then the earlier one goes and its turn ends."""
    kept = [True] * len(rows)
    for i, (v, relation) in enumerate(rows):
        if not kept[i]:
            continue
        for j in range(i + 1, len(rows)):
            if kept[j] and sum(a * b for a, b in zip(v, rows[j][0], strict=True)) > threshold:
                if len(rows[j][1]) < len(relation):
                    kept[i] = False
                    break
                kept[j] = False
    return kept


def greedy_dedup(rows: DataFrame, block: list[str], order: str, vector: str, relation: str, threshold: float = 0.92) -> DataFrame:
    """(block, order): the rows that a greedy pass in order keeps within each block.

    Only rows similar to some other one need the pass; they are found by a join
    within the block and go to it by connected component, so what one task holds
    is a chain of similar rows, not a block.
    """
    from textloom.operators.graphs import components

    keyed = rows.select(F.xxhash64(*block).alias("_block"), order, vector) if len(block) > 1 else rows.select(F.col(block[0]).alias("_block"), order, vector)
    pairs = pairs_within(keyed, "_block", order, vector, threshold).where(F.col("similarity") > threshold).select("a", "b")
    classes = components(pairs, "a", "b").select(F.col("node").alias(order), F.col("component").alias("_class"))
    linked = rows.join(classes, order).select(*block, order, vector, F.col(relation).alias("_relation"), "_class")
    schema = linked.select(*block, order).schema

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order)
        units = []
        for v in part[vector]:
            size = sum(float(x) ** 2 for x in v) ** 0.5 or 1.0
            units.append([float(x) / size for x in v])
        kept = greedy_kept(list(zip(units, part["_relation"].fillna(""), strict=True)), threshold)
        return part.loc[kept, [*block, order]]

    alone = rows.join(classes, order, "left_anti").select(*block, order)
    return alone.unionByName(linked.groupBy("_class").applyInPandas(run, schema))


def substituted(text: Column, changes: Column, mark: bool = False) -> Column:
    """The text with changes (start, stop, original, replacement) put in from right to left; null replacements are skipped.

    With `mark` the original stays behind its replacement: `replacement{original}`.
    """
    ordered = F.array_sort(F.filter(changes, lambda c: c["replacement"].isNotNull()), lambda x, y: F.when(x["start"] > y["start"], -1).when(x["start"] < y["start"], 1).otherwise(0))
    put = lambda c: F.concat(c["replacement"], F.lit("{"), c["original"], F.lit("}")) if mark else c["replacement"]
    return F.aggregate(ordered, text, lambda t, c: F.concat(F.substring(t, F.lit(1), c["start"]), put(c), F.substring(t, c["stop"] + 1, F.length(t))))


def cluster_heads(spans: DataFrame, cluster: list[str], start: str, stop: str, text: str) -> DataFrame:
    """(cluster, start, stop, original, replacement, score): every later span of a cluster of two and more is replaced by its first."""
    order = F.struct(F.col(start).alias("start"), F.col(stop).alias("stop"), F.col(text).alias("text"))
    heads = spans.groupBy(*cluster).agg(F.min(order).alias("_head"), F.count("*").alias("_n")).where("_n > 1")
    later = spans.join(heads, cluster).where((F.col(start) != F.col("_head.start")) | (F.col(stop) != F.col("_head.stop")))
    return later.select(*cluster, F.col(start).alias("start"), F.col(stop).alias("stop"), F.col(text).alias("original"), F.col("_head.text").alias("replacement"), F.lit(1.0).alias("score"))


def occurrences(text: Column, term: Column, most: int) -> Column:
    """Places (from 0) of the first `most` occurrences of a term, whatever their case, none overlapping."""
    parts = F.split(F.lower(text), F.concat(F.lit(r"\Q"), F.lower(term), F.lit(r"\E")), -1)
    sizes = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.length(p))
    place = lambda k: F.aggregate(F.slice(sizes, F.lit(1), k + 1), F.lit(0), lambda s, x: s + x) + k * F.length(term)
    ks = F.sequence(F.lit(0), F.least(F.size(sizes), F.lit(most)) - 1)
    return F.when((F.size(sizes) > 0) & (term != ""), F.transform(ks, place)).otherwise(F.array().cast("array<int>"))


def windows_around(text: Column, term: Column, reach: int = 300, most: int = 8) -> Column:
    """Windows of the text that reach so many characters around each occurrence of a term."""
    return F.transform(occurrences(text, term, most), lambda p: F.substring(text, F.greatest(p - reach, F.lit(0)) + 1, F.least(p, F.lit(reach)) + F.length(term) + reach))


def pair_windows(text: Column, first: Column, second: Column, apart: int = 400, reach: int = 200, most: int = 6, fallback: int = 3) -> Column:
    """Windows around two terms that occur within 2 * apart of each other; without any, the first windows of each."""
    a, b = occurrences(text, first, 1 << 20), occurrences(text, second, 1 << 20)
    cut = lambda low, high: F.substring(text, F.greatest(low - reach, F.lit(0)) + 1, high + reach - F.greatest(low - reach, F.lit(0)))
    both = F.flatten(F.transform(a, lambda p: F.transform(F.filter(b, lambda q: F.abs(p - q) <= 2 * apart), lambda q: cut(F.least(p, q), F.greatest(p + F.length(first), q + F.length(second))))))
    return F.when(F.size(both) > 0, F.slice(both, 1, most)).otherwise(F.concat(windows_around(text, first, reach, fallback), windows_around(text, second, reach, fallback)))


def context_windows(sentences: DataFrame, keys: list[str], pos: str, text: str, size: int = 5, before: int = 3) -> DataFrame:
    """(keys, window, context, text): windows of `size` sentences with the sentences before them, for coreference step by step."""
    no = F.floor(F.col(pos) / size)
    own = sentences.select(*keys, no.alias("window"), F.col(pos).alias("_p"), F.col(text).alias("_t"), F.lit(1).alias("_own"))
    ahead = sentences.where(F.pmod(F.col(pos), F.lit(size)) >= size - before).select(*keys, (no + 1).alias("window"), F.col(pos).alias("_p"), F.col(text).alias("_t"), F.lit(0).alias("_own"))
    rows = own.unionByName(ahead).groupBy(*keys, "window").agg(F.array_sort(F.collect_list(F.struct("_p", "_t", "_own"))).alias("x"))  # at most size + before rows
    join = lambda k: F.array_join(F.transform(F.filter("x", lambda x: x["_own"] == k), lambda x: x["_t"]), " ")
    return rows.where(F.exists("x", lambda x: x["_own"] == 1)).select(*keys, "window", join(0).alias("context"), join(1).alias("text"))


def leaves(summaries: DataFrame, keys: list[str], reply: str, text: str) -> DataFrame:
    """(keys, summary, topic, concepts): leaf nodes of chunk summaries; what can't be read becomes the text's first 240 characters."""
    r = F.from_json(fenced_body(F.col(reply)), "summary string, topic string, key_concepts array<struct<name: string, importance: string>>")
    rows = summaries.select(*keys, r.alias("r"), text)
    rank = lambda c: F.when(F.lower(F.trim(c)).isin("core", "supporting", "peripheral"), F.lower(F.trim(c))).otherwise("supporting")
    concepts = F.transform(F.filter(F.coalesce("r.key_concepts", F.array()), lambda c: F.trim(c["name"]) != ""), lambda c: F.struct(F.trim(c["name"]).alias("name"), rank(c["importance"]).alias("importance")))
    return rows.select(*keys, F.coalesce(F.nullif(F.trim("r.summary"), F.lit("")), F.substring(text, 1, 240)).alias("summary"), F.coalesce("r.topic", F.lit("")).alias("topic"), concepts.alias("concepts"))


def assembled_context(root: Column, path: Column, concepts: Column, neighbours: Column, most: int = 6000, suffix: str = "…") -> Column:
    """Root summary, summaries on the path, concepts and neighbours as one context, cut to `most` characters."""
    whole = F.concat_ws("\n\n", F.nullif(root, F.lit("")), F.nullif(F.array_join(path, "\n"), F.lit("")), F.nullif(F.array_join(concepts, ", "), F.lit("")), F.nullif(neighbours, F.lit("")))
    return F.when(F.length(whole) > most, F.concat(F.substring(whole, 1, most), F.lit(suffix))).otherwise(whole)


def relations_of_tokens(tokens: list[dict]) -> list[tuple[str, str, str]]:
    """(subject, relation, object) by rules over parsed tokens (text, lemma, pos, dep, head).

    Subjects and their conjuncts with the objects of their verb; nouns with
    their prepositional objects; conjoined nouns by `and`.
    """
    nouns = ("NOUN", "PROPN")
    kids: dict[int, list[int]] = {}
    for i, t in enumerate(tokens):
        if t["head"] != i:
            kids.setdefault(t["head"], []).append(i)
    of = lambda i, *deps: [k for k in kids.get(i, []) if tokens[k]["dep"] in deps]
    name = lambda i: tokens[i]["lemma"] if tokens[i]["pos"] == "NOUN" else tokens[i]["text"]
    out = []
    for i, t in enumerate(tokens):
        if t["pos"] in nouns:
            out += [(name(i), "and", name(k)) for k in of(i, "conj") if tokens[k]["pos"] in nouns]
            out += [(name(i), tokens[p]["text"], name(o)) for p in of(i, "prep") for o in of(p, "pobj")]
        elif t["pos"] == "VERB":
            subjects = [s for k in of(i, "nsubj", "nsubjpass") for s in (k, *of(k, "conj"))]
            objects = [(t["lemma"], o) for k in of(i, "dobj", "obj") for o in (k, *of(k, "conj"))]
            objects += [(f"{t['lemma']} {tokens[p]['text']}", o) for p in of(i, "prep") for o in of(p, "pobj")]
            out += [(name(s), r, name(o)) for s in subjects for r, o in objects]
    return out


def token_relations(parsed: DataFrame, keys: list[str], tokens: str) -> DataFrame:
    """(keys, subject, relation, object) of parsed sentences: tokens array<struct<text, lemma, pos, dep, head int>>."""
    kinds = ", ".join(f"{k} {parsed.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(*key, *r) for *key, sentence in batch.itertuples(index=False) for r in relations_of_tokens(list(sentence) if sentence is not None else [])]
            yield pd.DataFrame(out, columns=[*keys, "subject", "relation", "object"])

    return parsed.select(*keys, tokens).mapInPandas(run, f"{kinds}, subject string, relation string, object string")


def noun_concepts(rows: DataFrame, key: str, text: str, stop_words: DataFrame, least: int = 3) -> DataFrame:
    """(key, concept, n): words of at least three letters that are no stop words; the stand-in where no parser gives noun phrases."""
    words = rows.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).alias("concept")).where(F.length("concept") >= least)
    return words.groupBy(key, "concept").agg(F.count("*").alias("n")).join(stop_words.select(F.col("word").alias("concept")), "concept", "left_anti")


def ordered_distinct(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, values): the distinct values of each key in the order of their first appearance, one by one before they are gathered."""
    first = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias("_at"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda x: x[value]).alias("values"))


def numbered_in(rows: DataFrame, key: str, order: str, prefix: str) -> DataFrame:
    """Rows with ids `prefix0`, `prefix1`, … in their order within each key."""
    return rows.withColumn("new_id", F.concat(F.lit(prefix), F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1))
