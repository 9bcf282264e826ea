"""Keyword-stuffed pages, link lists and product tag lists.

Content and link features are taken in one Arrow pass over the whole texts.
Weak labels are votes: eight signs of spam and seven of true text, none of
which decides alone. A page is labelled only where the votes of one side are
clearly ahead; the rest has no label. Bagged decision trees (every tree on a
bootstrap sample, all features open at every split) are fitted on a bounded
hash sample of the labelled pages and judge every page, labelled or not. Page
predictions are then smoothed with the spam rate of the page's host.

Defined results: null, empty, blank and very short texts are no case; a null
site is smoothed with the rate of all pages; an empty table gives no rows;
where labels of one side are missing no trees can be fitted and no page is a
case unless it is labelled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import add

import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

SHORT = 80
FIT_ROWS = 20_000  # bound of the fitting sample
TREES = 30
DEPTH = 7
HOST_PRIOR = 200.0
HOST_WEIGHT = 0.3

URL = re.compile(r"https?://\S++|(?<![\w.:/-])(?:www\.\S++|[\w-]++(?:\.[\w-]++)++/\S*+)", re.I)
HOST = re.compile(r"(?:https?://)?(?:www\.)?([^/\s:]+)", re.I)
TAG = re.compile(r"#\w+")
CODE = re.compile(r"\b[A-Z]{1,3}\d{4,}\b")
DIGITS = re.compile(r"\d+")
STOPS = tuple(".!?…。！？।॥")
FULL_STOP = re.compile(r"[.!?…](?=[\s\"”»’)\]]|$)|[。！？।॥]")
PIECE = re.compile(r"[^.!?…。！？।॥\n|#>•·»*]++[.!?…。！？।॥]?+")
SEPARATOR = re.compile(r"[,;|>•·»*/–\n]|\s-\s")
BETWEEN = re.compile(r"[\s,;|>•·»*/#–]+")
LISTED = re.compile(r"^\s*[\[(]?\d|\d\s*$")
CLOSING = " \t\r\"”»’)"

FEATURES = [
    "url_share", "tag_share", "code_rate", "prose_share", "stop_rate", "sep_rate", "repeat_share", "pair_repeat", "line_stop_share", "words_per_line", "digit_share", "token_length", "long_token_share", "words_per_stop",
    "separator_repeat", "top_share", "listed_share", "links", "link_lines", "link_hosts", "own_links",
]


def repeated(parts: list) -> float:
    return 1 - len(set(parts)) / len(parts) if parts else 0.0


def page_features(text: str, site: str | None) -> tuple[float, ...] | None:
    """FEATURES of a page; None for a short one."""
    size = len("".join(text.split()))
    if size < SHORT:
        return None
    urls = URL.findall(text) if "/" in text or "www." in text.lower() else []
    bare = URL.sub("|", text) if urls else text
    low = bare.lower()
    tokens = [t for t in BETWEEN.split(low) if t]
    n = max(len(tokens), 1)
    stops = len(FULL_STOP.findall(low))
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(len(lines), 1)
    prose = sum(len(p) for p in PIECE.findall(bare) if len(p) > 15 and p.endswith(STOPS) and (p.count(",") + 1) * 14 < len(p) + 56)
    parts = [p for p in map(str.strip, SEPARATOR.split(low)) if p]
    digits = DIGITS.findall(bare)
    hosts = [m[1].lower() for m in map(HOST.match, urls) if m]
    return (
        sum(map(len, urls)) / size,
        sum(map(len, TAG.findall(text))) / size if "#" in text else 0.0,
        len(CODE.findall(text)) / n if any(len(d) > 3 for d in digits) else 0.0,
        min(1.0, prose / max(1, len(bare))),
        stops * 100 / size,
        len(SEPARATOR.findall(text)) / n,
        repeated(tokens),
        repeated(list(zip(tokens, tokens[1:]))),
        sum(x.rstrip(CLOSING).endswith(STOPS) for x in lines) / n_lines,
        n / n_lines,
        sum(map(len, digits)) / size,
        size / n,
        sum(len(t) for t in tokens if len(t) >= 18) / size,
        min(n / max(1, stops), 100.0),
        repeated(parts),
        sum(c for _, c in Counter(tokens).most_common(5)) / n,
        sum(bool(LISTED.search(x)) for x in bare.split("\n") if x.strip()) / n_lines if len(lines) > 2 else 0.0,
        len(urls) * 100 / n,
        sum(bool(URL.search(x)) for x in lines) / n_lines if urls else 0.0,
        len(set(hosts)) / len(hosts) if hosts else 0.0,
        sum(bool(site) and h.endswith(site.lower()) for h in hosts) / len(hosts) if hosts else 0.0,
    )


def feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [(doc, site, *found) for doc, site, text in batch[["doc_id", "site", "text"]].itertuples(index=False) if (found := page_features(text, site)) is not None]
        yield pd.DataFrame(out, columns=["doc_id", "site", *FEATURES])


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, site, the features) of the pages that are long enough."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "site", "text").where("text is not null")
    return rows.mapInPandas(feature_rows, f"doc_id {kind}, site string, " + ", ".join(f"{f} double" for f in FEATURES))


def votes() -> tuple[Column, Column]:
    """(signs of spam, signs of true text): numbers of independent signs that a page shows."""
    c = F.col
    spaced = c("long_token_share") <= 0.5
    spam = [
        c("url_share") > 0.5, c("tag_share") > 0.35, c("code_rate") > 0.06, (c("pair_repeat") > 0.5) & spaced, (c("top_share") > 0.5) & (c("repeat_share") > 0.6) & spaced, c("sep_rate") > 0.3,
        (c("stop_rate") < 0.3) & (c("prose_share") < 0.1) & (c("digit_share") < 0.3) & spaced, (c("words_per_stop") < 4.5) & (c("repeat_share") > 0.65),
    ]
    true = [
        (c("prose_share") > 0.7) & (c("words_per_stop") > 4.5), (c("stop_rate") > 1) & (c("stop_rate") < 5), (c("pair_repeat") < 0.3) & (c("repeat_share") < 0.5), (c("words_per_stop") > 5) & (c("words_per_stop") < 25), c("line_stop_share") > 0.6,
        c("listed_share") > 0.6, (c("digit_share") > 0.08) & (c("pair_repeat") < 0.3),
    ]
    count = lambda signs: add_all([x.cast("int") for x in signs])
    return count(spam), count(true)


def add_all(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = add(out, c)
    return out


def weak_label() -> Column:
    """1.0 and 0.0 where one side's votes are clearly ahead, null elsewhere."""
    spam, true = votes()
    return F.when((spam >= true + 2) | ((spam >= 3) & (spam >= true)), 1.0).when(true >= spam + 2, 0.0)


def logit(p: Column) -> Column:
    clipped = F.least(F.greatest(p, F.lit(0.001)), F.lit(0.999))
    return F.log(clipped / (1 - clipped))


def scored(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, site, label, page_score, score): weak label, the trees' prediction and the smoothed one."""
    rows = materialize(features(docs).withColumn("label", weak_label()), "spam-features")
    counts = {r["label"]: r["n"] for r in rows.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(counts) < 2:
        scores = rows.select("doc_id", "site", "label", F.coalesce("label", F.lit(0.0)).alias("page_score"))
    else:
        # up to a half of the sample from each side, so that rare spam is seen
        lot = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
        share = {k: int(min(1.0, fit_rows / 2 / n) * 1_000_000) for k, n in counts.items()}
        known = rows.where(lot < F.when(F.col("label") == 1.0, share[1.0]).when(F.col("label") == 0.0, share[0.0]))
        gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
        trees = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="all", subsamplingRate=1.0, seed=11, probabilityCol="p")
        model = trees.fit(gather.transform(known).select("features", "label"))
        scores = model.transform(gather.transform(rows)).select("doc_id", "site", "label", vector_to_array("p")[1].alias("page_score"))
        scores = materialize(scores, "spam-scores")
    overall = scores.agg(F.coalesce(F.avg("page_score"), F.lit(0.0)).alias("rate")).first()["rate"]
    hosts = scores.where("site is not null").groupBy("site").agg(F.sum("page_score").alias("s"), F.count("*").alias("n"))
    hosts = hosts.select("site", ((F.col("s") + HOST_PRIOR * overall) / (F.col("n") + HOST_PRIOR)).alias("rate"))
    joined = scores.join(hosts, "site", "left")
    shift = HOST_WEIGHT * (logit(F.coalesce("rate", F.lit(overall))) - logit(F.lit(overall)))
    return joined.select("doc_id", "site", "label", "page_score", (1 / (1 + F.exp(-(logit(F.col("page_score")) + shift)))).alias("score"))


def found(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id) of the spam pages."""
    return scored(docs).where(F.col("score") >= threshold).select("doc_id").distinct()
