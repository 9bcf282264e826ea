"""Language of each document and of each segment in one language.

Hierarchical discrimination over sentence units: the family comes first (the
script most letters of the sentence belong to), then a linear support vector
machine for each pair of languages of the family, one versus one, over hashed
letter groups and words. The machines learn from the delivered labels, wrong
ones included, on a bounded hash sample. A brief undecided unit between two
of one language takes theirs; runs of sentences in one language are segments.

Defined results: null, empty and blank texts have no segment; a sentence
without letters joins the segment before it (or the first after it); null,
empty and unknown labels denote no language; a chunk without its graph is
treated as unlabelled; extra columns are not read.

Scale: features are worked out in Arrow batches where they are used and never
stored; the machines of all pairs are fitted in one job, one task for each
pair's sample of at most `fit_rows` sentences; a machine is a vector of WIDTH
numbers, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import sentences as units
from textloom.session import materialize

FIT_ROWS = 12_000  # bound of the fitting sample of each pair
WIDTH = 1 << 14
GROUPS = 4  # longest letter group
STEPS = 60
FIRM, LOOSE = 0.03, 0.003  # regularisation of the first and of the second machine
UNSURE = 0.5  # margin below which a brief unit (a heading, a number line) follows its neighbours
BRIEF = 40
FAINT = 0.05  # the same for any unit
FIT_LENGTH = 20  # shortest sentence to learn from

# Families by script, and the usual codes of the languages.
FAMILIES = {"latin": ("en", "de"), "cyrillic": ("ru", "uk"), "gujarati": ("gu",), "devanagari": ("hi",), "han": ("zh",), "thai": ("th",)}
# Letters of each family as ranges of code points.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2B8), (0x1E00, 0x1EFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)), "gujarati": ((0xA80, 0xAFF),), "devanagari": ((0x900, 0x963), (0x966, 0x97F)),
    "han": ((0x2E80, 0x2FD5), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)), "thai": ((0xE01, 0xE3A), (0xE40, 0xE5B)),
}
WEIGHT = {"han": 3.0}
CODES = {
    "en": ("en", "eng", "english"), "ru": ("ru", "rus", "russian"), "uk": ("uk", "ukr", "ua", "ukrainian"), "gu": ("gu", "guj", "gujarati"),
    "hi": ("hi", "hin", "hindi"), "de": ("de", "deu", "ger", "german"), "zh": ("zh", "zho", "chi", "cmn", "chinese"), "th": ("th", "tha", "thai"),
}
WORDS = regex.compile(r"[\p{L}\p{M}]+")


def label_language(label: Column) -> Column:
    """The language that a code in any case, spelling or region denotes; null for none."""
    base = F.split(F.lower(F.trim(label)), "[-_]")[0]
    out = F.lit(None).cast("string")
    for language, codes in CODES.items():
        out = F.when(base.isin(*codes), F.lit(language)).otherwise(out)
    return out


def scripts_of(text: str) -> tuple[str | None, float]:
    """The family most letters belong to (None without letters) and its share."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = {f: WEIGHT.get(f, 1.0) * sum(int(((points >= a) & (points <= b)).sum()) for a, b in ranges) for f, ranges in SCRIPTS.items()}
    total = sum(counts.values())
    if not total:
        return None, 0.0
    top = max(counts, key=lambda f: (counts[f], f))
    return top, counts[top] / total


def letter_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, place, value): hashed letter groups of 1 to GROUPS and words of each text; what recurs adds up.

    All texts of a batch are hashed together: letters in lower case, anything
    else as one space, groups that reach into the next text left out.
    """
    plain = [f" {' '.join(WORDS.findall(t.lower()))} " for t in texts]
    sizes = np.array([len(p) for p in plain])
    points = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    odd = np.uint64(0x9E3779B97F4A7C15)
    owners, hashes = [], []
    rolled = np.zeros(len(points), np.uint64)
    for k in range(1, min(GROUPS, len(points)) + 1):
        rolled = (rolled[: len(points) - k + 1] + points[k - 1 :] + np.uint64(1)) * odd
        rolled ^= rolled >> np.uint64(29)
        whole = owner[: len(rolled)] == owner[k - 1 :]
        owners.append(owner[: len(rolled)][whole])
        hashes.append(rolled[whole] + np.uint64(k))
    starts = np.flatnonzero((points != 32) & np.concatenate([[True], points[:-1] == 32]))
    if len(starts):
        inner = points != 32
        at = np.arange(len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points)))) if starts[0] == 0 else np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))])
        mixed = (points * odd) * ((at.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) * inner
        words = np.add.reduceat(mixed, starts)
        owners.append(owner[starts])
        hashes.append(words ^ np.uint64(0x5BD1E995))
    owner, h = np.concatenate(owners), np.concatenate(hashes) * odd
    place = (h >> np.uint64(64 - WIDTH.bit_length() + 1)).astype(np.int64)
    return owner, place, (1 / np.sqrt(np.bincount(owner, minlength=len(texts))))[owner]


def fit_machine(features: tuple[np.ndarray, np.ndarray, np.ndarray], y: np.ndarray, firmness: float) -> np.ndarray:
    """Weights (the last one is the bias) of a linear support vector machine with squared hinge loss; both classes weigh the same.

    Accelerated gradient descent; y is 1 or -1.
    """
    owner, place, value = features
    n = len(y)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, ahead = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)
    cells, times = np.unique(owner * WIDTH + place, return_counts=True)
    size = np.bincount(cells // WIDTH, times.astype(float) ** 2, n) * np.bincount(owner, value**2, n) / np.maximum(np.bincount(owner, minlength=n), 1)
    rate = 1 / (2 * ((share * size).sum() + 1) + firmness)  # the slope changes no faster than the mean squared length of a row, its bias with it
    for t in range(STEPS):
        margin = np.bincount(owner, ahead[place] * value, n) + ahead[-1]
        push = -2 * share * y * np.maximum(0, 1 - y * margin)
        slope = np.append(np.bincount(place, push[owner] * value, WIDTH), push.sum())
        slope[:-1] += firmness * ahead[:-1]
        after = ahead - rate * slope
        ahead = after + t / (t + 3) * (after - w)
        w = after
    return w


def margins(features: tuple[np.ndarray, np.ndarray, np.ndarray], w: np.ndarray, n: int) -> np.ndarray:
    owner, place, value = features
    return np.bincount(owner, w[place] * value, n) + w[-1]


def fit_pair(sample: pd.DataFrame) -> pd.DataFrame:
    """The machine of one pair's sample (pair, sentence, y), in the order of its rows' hashes.

    Strong regularisation learns the bulk, not the wrong labels; labels that
    the first machine contradicts are taken for wrong.
    """
    sample = sample.sort_values(["lot", "sentence"])
    y = np.where(sample["y"].to_numpy() > 0, 1.0, -1.0)
    owner, place, value = features = letter_features(list(sample["sentence"]))
    first = margins(features, fit_machine(features, y, FIRM), len(y))
    right = (first > 0) == (y > 0)
    kept = right[owner]
    number = np.cumsum(right) - 1
    w = fit_machine((number[owner[kept]], place[kept], value[kept]), y[right], LOOSE)
    return pd.DataFrame({"pair": [sample["pair"].iloc[0]], "w": [w]})


def sentence_units(chunks: DataFrame, graphs: DataFrame) -> DataFrame:
    """(chunk_id, start_pos, end_pos, sentence, label, family, share) of the chunks of origin `text`."""
    rows = chunks.where("origin = 'text' and text is not null").select("chunk_id", "graph_id", "text")
    labels = graphs.select("graph_id", label_language(F.col("preproc_language")).alias("label")).groupBy("graph_id").agg(F.max("label").alias("label"))
    rows = rows.join(labels, "graph_id", "left").select("chunk_id", "label", "text")
    spans = units.spans_of(rows, units.fit(rows.select("text")), ["chunk_id"], ["label", "text"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["sentence"] = [t[a:b] for t, a, b in zip(batch["text"], batch["start_pos"], batch["end_pos"], strict=True)]
            found = [scripts_of(x) for x in batch["sentence"]]
            batch["family"], batch["share"] = [f for f, _ in found], [x for _, x in found]
            yield batch.drop(columns="text")

    kind = rows.schema["chunk_id"].dataType.simpleString()
    return spans.mapInPandas(cut, f"chunk_id {kind}, label string, start_pos int, end_pos int, sentence string, family string, share double")


def machines(rows: DataFrame, fit_rows: int = FIT_ROWS) -> dict[tuple[str, str], np.ndarray]:
    """A support vector machine for each pair of languages of a family; positive margins mean the second."""
    pairs = {f"{a} {b}": (name, a, b) for name, languages in FAMILIES.items() for a, b in combinations(languages, 2)}
    each = [F.struct(F.lit(p).alias("pair"), (F.col("label") == b).cast("double").alias("y"), ((F.col("family") == name) & F.col("label").isin(a, b)).alias("fits")) for p, (name, a, b) in pairs.items()]
    known = rows.where(F.length("sentence") >= FIT_LENGTH).select("chunk_id", "start_pos", "sentence", F.explode(F.array(*each)).alias("x")).where("x.fits")
    known = known.select("x.pair", "x.y", "sentence", F.pmod(F.xxhash64("chunk_id", "start_pos"), F.lit(1_000_000)).alias("lot"))
    counts = {(r["pair"], r["y"]): r["n"] for r in known.groupBy("pair", "y").agg(F.count("*").alias("n")).collect()}  # two rows a pair
    keep = F.lit(0)
    for (p, y), n in counts.items():
        if len([1 for q, _ in counts if q == p]) == 2:
            keep = F.when((F.col("pair") == p) & (F.col("y") == y), F.lit(int(min(1.0, fit_rows / 2 / n) * 1_000_000))).otherwise(keep)
    fitted = known.where(F.col("lot") < keep).groupBy("pair").applyInPandas(fit_pair, "pair string, w array<double>").collect()  # a row for each pair of FAMILIES
    return {pairs[r["pair"]][1:]: np.array(r["w"]) for r in fitted}


def sentence_languages(chunks: DataFrame, graphs: DataFrame) -> DataFrame:
    """(chunk_id, start_pos, end_pos, label, lang, margin, confidence) of every sentence."""
    rows = materialize(sentence_units(chunks, graphs), "language-units")
    fitted = machines(rows)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            family = batch["family"].to_numpy()
            lang = np.array([FAMILIES[f][0] if f else None for f in family], object)
            margin = np.full(len(batch), 10.0)
            for name, languages in FAMILIES.items():
                at = np.flatnonzero(family == name)
                machine = {p: w for p, w in fitted.items() if p[0] in languages}
                if not machine or not len(at):
                    continue
                features = letter_features([batch["sentence"].iat[i] for i in at])
                votes = np.zeros((len(at), len(languages)))
                near = np.full(len(at), np.inf)
                for (a, b), w in machine.items():
                    m = margins(features, w, len(at))
                    votes[:, languages.index(b)] += m > 0
                    votes[:, languages.index(a)] += m <= 0
                    near = np.minimum(near, np.abs(m))
                lang[at] = np.array(languages, object)[votes.argmax(axis=1)]
                margin[at] = near
            yield pd.DataFrame({"chunk_id": batch["chunk_id"], "start_pos": batch["start_pos"], "end_pos": batch["end_pos"], "label": batch["label"], "share": batch["share"], "lang": lang, "margin": margin})

    kind = rows.schema["chunk_id"].dataType.simpleString()
    out = rows.mapInPandas(judged, f"chunk_id {kind}, start_pos int, end_pos int, label string, share double, lang string, margin double")
    order = Window.partitionBy("chunk_id").orderBy("start_pos")
    filled = out.withColumn("lang", F.coalesce("lang", F.last("lang", True).over(order), F.first("lang", True).over(order.rowsBetween(0, Window.unboundedFollowing))))
    before, after = F.lag("lang").over(order), F.lead("lang").over(order)
    around = F.coalesce(before, after)
    same = (around == F.coalesce(after, before)) & (F.col("margin") < F.when(F.col("end_pos") - F.col("start_pos") < BRIEF, F.lit(UNSURE)).otherwise(F.lit(FAINT)))
    related = F.lit(False)
    for languages in FAMILIES.values():
        if len(languages) > 1:
            related = related | (F.col("lang").isin(*languages) & around.isin(*languages))
    filled = filled.withColumn("lang", F.when(same & related, around).otherwise(F.col("lang")))
    sure = F.coalesce("share", F.lit(0.0)) / (1 + F.exp(-2 * F.col("margin")))
    return filled.where("lang is not null").select("chunk_id", "start_pos", "end_pos", "label", "lang", "margin", F.round(sure, 4).alias("confidence"))


def segments(chunks: DataFrame, graphs: DataFrame) -> DataFrame:
    """(chunk_id, label, start_pos, end_pos, lang, confidence, n_segments)."""
    order = Window.partitionBy("chunk_id").orderBy("start_pos")
    rows = sentence_languages(chunks, graphs)
    rows = rows.withColumn("turn", F.when(F.lag("lang").over(order) == F.col("lang"), 0).otherwise(1))
    rows = rows.withColumn("no", F.sum("turn").over(order))
    runs = rows.groupBy("chunk_id", "no").agg(F.max("label").alias("label"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.max("lang").alias("lang"), F.round(F.avg("confidence"), 4).alias("confidence"))
    return runs.withColumn("n_segments", F.count("*").over(Window.partitionBy("chunk_id"))).drop("no")


def found(chunks: DataFrame, graphs: DataFrame) -> DataFrame:
    """(chunk_id, start_pos, lang): the segments of mixed and of wrongly labelled chunks."""
    runs = segments(chunks, graphs)
    wrong = ~F.col("label").eqNullSafe(F.col("lang"))
    return runs.where((F.col("n_segments") > 1) | wrong).select("chunk_id", "start_pos", "lang")
