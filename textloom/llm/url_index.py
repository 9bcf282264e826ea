"""Batches of document URLs against a persisted inverted file of everything accepted before.

A URL is reduced to its exact part (host with number, handle and file, hash,
DOI, or the numbers of a title) and a title; the title's full vector are its
letter counts. The index is an inverted file: a list for each cell, a cell
being the exact part and the ranges in which the sums of the vector's thirds
fall. A slip of a letter moves each sum by at most 1 and the vector by at most
2, so with a bound on slips a probe opens only the cells whose ranges are
within that bound, and no vector in another cell can match. What a probe meets
is filtered by vector distance and reranked exactly by edit distance. Exact
parts are never near each other, so they need one cell only.

Texts that match are linked; links are closed within a batch, and where a new
text links two documents accepted before, they become one: the index notes
which document went into which. So the result doesn't depend on how the rows
are cut into batches. A batch reads the lists of its buckets and appends its
new texts, never the rows of earlier batches.

Two titles match if their exact parts are equal and they are at most SLIPS
edits apart (two slips each), and no more than a fourth of the shorter one.

Defined results: null, blank and non-URL values are no case; a redelivered row
(same id) isn't its own duplicate; within a batch the smallest id is the first;
rows without batch number come last; extra columns are not read.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import parse_qsl, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import discard, materialize, shared_dir

SLIPS = 4
DIM = 32
THIRDS = ((0, 11), (11, 22), (22, DIM))
RANGE = 9  # width of a cell in each sum; a probe opens at most two ranges of each
BUCKET_ROWS = 250_000
SENT_ROWS = 200_000  # a batch with no more probes is sent to the index's tasks; a larger one is joined by cell
BATCH_MEETS = 20  # a batch of so many texts for each bucket meets nearly all buckets, so it reads them without asking which
SENT_TEXTS = 400_000  # a batch of no more texts sends its cells to the index's tasks, and only what these hold is moved
DELIVERIES = 64  # a table of more batches is given in so many groups of batches, in order

LEAD = re.compile(r"^[\s\"'<(\[]*(?:url=)?[\s\"'<(\[]*", re.I)
SCHEMES = re.compile(r"^(?:https?:/+)+", re.I)
AUTHORITY = re.compile(r"^(?:[^/@?#]*@)?(?:www\.)?([^/:?#\s]+\.[^/:?#\s]+)(?::\d*)?(?=[/?]|$)", re.I)
TRAIL = re.compile(r"[\s\"'<>,.;:!)\]/]+$")
FILE_END = re.compile(r"\.(?:pdf?|p|html?)$", re.I)
DOI = re.compile(r"10\.\d{4,9}/[^\s?#&]+")
HASH = re.compile(r"^[0-9a-f]{32,}$")
NUMBER = re.compile(r"^(\d{4}\.\d{4,})(?:v\d+)?$")
BITSTREAM = re.compile(r"bitstream/(\d+/\d+)/(?:\d+/)?([^/]+)$")
# Path parts that name no item.
PLAIN_PARTS = frozenset({"pdf", "main", "download", "fetch", "get", "fulltext", "view", "article", "articles", "doi"})
# Query parameters that name no item.
PLAIN_KEYS = re.compile(r"^(?:utm_\w*|ref|from|src|source|sid|session|token|page|download|v|version|lang)$", re.I)


def item_of(url: str | None) -> tuple[str, str] | None:
    """(exact part with its host, title) of a URL; None for what is no URL."""
    if url is None:
        return None
    text = LEAD.sub("", html.unescape(url))
    scheme = SCHEMES.match(text)
    if not scheme:
        return None
    text = text[scheme.end() :].split("#", 1)[0]
    named = AUTHORITY.match(text)
    if not named:
        return None
    host = named[1].lower().rstrip(".")
    path, _, query = text[named.end() :].partition("?")
    path = unicodedata.normalize("NFC", unquote(re.sub(r";[^/]*", "", path).replace("+", " "))).casefold()
    path = FILE_END.sub("", TRAIL.sub("", path))
    parts = [p.strip() for p in path.split("/") if p.strip() not in ("", ".")]
    asked = TRAIL.sub("", query)
    values = [FILE_END.sub("", TRAIL.sub("", unicodedata.normalize("NFC", v).casefold())) for k, v in parse_qsl(asked) if not PLAIN_KEYS.match(k)]
    places = ["/".join(parts), *values]
    for place in [*places, unquote(asked).casefold()]:
        if doi := DOI.search(place):
            return f"{host}|doi|{FILE_END.sub('', doi[0])}", ""
    for place in places:
        if stream := BITSTREAM.search(place):
            return f"{host}|file|{stream[1]}|{stream[2]}", ""
    named_parts = [p for p in parts if p not in PLAIN_PARTS]
    last = named_parts[-1] if named_parts else ""
    for name in [last, *(v.rsplit("/", 1)[-1] for v in values)]:
        if HASH.match(name):
            return f"{host}|hash|{name}", ""
        if number := NUMBER.match(name):
            return f"{host}|number|{number[1]}", ""
    if not last:
        last = next((v for v in values if any(c.isalpha() for c in v)), "")
    if not last:
        return (f"{host}|query|{'&'.join(sorted(values))}", "") if values else None
    digits = re.findall(r"\d+", last)
    title = "".join(c for c in last if not c.isdigit() and (c.isalpha() or unicodedata.category(c)[0] == "M"))
    return f"{host}|titled|{'.'.join(digits)}", title


def letter_counts(title: str) -> list[int]:
    """The title's full vector: counts of its letters in DIM places. It is kept with 127 for more, so vectors are never further apart than titles."""
    out = [0] * DIM
    for c in title:
        out[(ord(c) * 7 + (ord(c) >> 5)) % DIM] += 1
    return out


def item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for no, row, url in batch.itertuples(index=False):
            item = item_of(url)
            if item:
                vec = letter_counts(item[1]) if item[1] else None
                out.append((no, row, *item, [min(n, 127) for n in vec] if vec else None, [sum(vec[a:b]) for a, b in THIRDS] if vec else None))
        yield pd.DataFrame(out, columns=["batch_no", "id", "exact", "title", "vec", "sums"]).astype({"batch_no": "Int64"})


def items(rows: DataFrame) -> DataFrame:
    """(batch_no, id, exact, title, vec, sums) of the rows that are a URL."""
    named = rows.select(F.col("batch_no").cast("bigint").alias("batch_no"), F.col("id").cast("bigint").alias("id"), F.col("pdf_url").alias("url")).where("url is not null")
    return named.mapInPandas(item_rows, "batch_no bigint, id bigint, exact string, title string, vec array<tinyint>, sums array<int>")


def ranges(k: int, slack: int) -> Column:
    """Ranges of one sum that vectors within `slack` edits can fall in; range 0 for items without title."""
    at = F.col("sums")[k]
    low, high = F.floor(F.greatest(at - slack, F.lit(0)) / RANGE), F.floor((at + slack) / RANGE)
    return F.when(F.col("sums").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(low, high))


def in_cells(texts: DataFrame, slack: int) -> DataFrame:
    """Texts with `cell`, in each cell within `slack` edits; one cell for slack 0."""
    out = texts.select("*", F.explode(ranges(0, slack)).alias("r0"))
    for k in (1, 2):
        out = out.select("*", F.explode(ranges(k, slack)).alias(f"r{k}"))
    return out.withColumn("cell", F.xxhash64("exact", "r0", "r1", "r2")).drop("r0", "r1", "r2")


def texts_of(rows: DataFrame) -> DataFrame:
    """(batch_no, exact, title, id, vec, sums): the distinct texts of each batch with their smallest id."""
    return rows.groupBy("batch_no", "exact", "title").agg(F.min("id").alias("id"), F.any_value("vec").alias("vec"), F.any_value("sums").alias("sums"))


def matching(probes: DataFrame, held: DataFrame) -> DataFrame:
    """(id, other, same, text): what each probing text meets in its cells; same: an equal text that is held; text: itself, once."""
    known = held.select("cell", F.col("exact").alias("k_exact"), F.col("title").alias("k_title"), F.col("vec").alias("k_vec"), "other", "old")
    met = probes.join(known, "cell").where(F.col("exact") == F.col("k_exact"))
    apart = F.aggregate(F.zip_with("vec", "k_vec", lambda a, b: F.abs(a.cast("int") - b.cast("int"))), F.lit(0), lambda s, x: s + x)
    most = F.least(F.lit(SLIPS), F.floor(F.least(F.length("title"), F.length("k_title")) / 4)).cast("int")
    near = (apart <= 2 * most) & (F.levenshtein(F.col("title"), F.col("k_title")) <= most)
    equal = F.col("title") == F.col("k_title")
    text = F.when(equal & ~F.col("old"), F.struct("cell", "exact", "title", "vec"))
    return met.where(equal | near).select("id", "other", (equal & F.col("old")).alias("same"), text.alias("text"))


class UrlIndex:
    """Cells under one path of the shared folder, grown by append only."""

    schema = "bucket int, cell bigint, exact string, title string, vec array<tinyint>, other bigint, batch_no bigint, fresh boolean"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 1):
        self.spark, self.path, self.buckets = spark, path or shared_dir(spark, "url-index"), buckets
        self.taken, self.merged = 0, None

    def bucket(self) -> Column:
        return F.pmod(F.col("cell"), F.lit(self.buckets)).cast("int")

    def texts(self) -> DataFrame:
        """Every text of every batch with the document it led to at that time."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def resolved(self, rows: DataFrame, column: str) -> DataFrame:
        """Rows whose documents went into others get these."""
        if self.merged is None:
            return rows
        moves = self.merged.select(F.col("doc").alias(column), "into")
        return rows.join(moves, column, "left").withColumn(column, F.coalesce("into", column)).drop("into")

    def accept(self, batch: DataFrame) -> DataFrame:
        """(id_a, id_b) of the batch's rows whose document is known or came earlier in the batch, and of documents that this batch joined to older ones."""
        rows = materialize(items(batch).withColumn("batch_no", F.lit(self.taken).cast("bigint")), "batch-items")
        before = self.merged
        self.take(texts_of(rows))
        first = self.assigned(rows).where("id != other").select(F.col("other").alias("id_a"), F.col("id").alias("id_b"))
        if self.merged is before:
            return first.distinct()
        return first.unionByName(self.merged.select(F.col("into").alias("id_a"), F.col("doc").alias("id_b"))).distinct()

    def assigned(self, rows: DataFrame) -> DataFrame:
        """(id, other): the document of each row taken."""
        joined = rows.select("id", "batch_no", "exact", "title").join(self.texts().select("batch_no", "exact", "title", "other"), ["batch_no", "exact", "title"])
        return self.resolved(joined.select("id", "other"), "other").distinct()

    def take(self, texts: DataFrame, n: int | None = None) -> None:
        """Find the documents of one batch of `n` distinct texts and append these."""
        probes = in_cells(texts, SLIPS)
        n = texts.count() if n is None else n
        small = n * 2 ** len(THIRDS) <= SENT_ROWS
        held = in_cells(texts, 0).select("cell", "exact", "title", "vec", F.col("id").alias("other"), F.lit(False).alias("old"))
        if self.taken:
            known = self.texts().where("fresh")
            if not small and n <= SENT_TEXTS:
                known = known.join(F.broadcast(probes.select("cell").distinct()), "cell", "left_semi")
            if self.buckets > 1 and n < self.buckets * BATCH_MEETS:
                asked = [r[0] for r in probes.select(self.bucket()).distinct().collect()]  # at most `buckets` numbers
                known = known.where(F.col("bucket").isin(asked))
            held = held.unionByName(self.resolved(known, "other").select("cell", "exact", "title", "vec", "other", F.lit(True).alias("old")))
        edges = materialize(matching(F.broadcast(probes) if small else probes, held), "batch-links")
        rounds = self.closed(edges)
        least = edges if rounds is None else edges.drop("other").join(rounds.withColumnRenamed("label", "other"), "id")
        new = least.groupBy("id").agg(F.min("other").alias("other"), F.max("same").alias("same"), F.first("text", True).alias("text")).select("other", "same", "text.*")
        new = new.select(self.bucket().alias("bucket"), "cell", "exact", "title", "vec", "other", F.lit(self.taken).cast("bigint").alias("batch_no"), (~F.col("same")).alias("fresh"))
        if self.buckets > 1:
            new = new.repartition(self.buckets, "bucket")
        new.write.mode("append").partitionBy(*["bucket"][: self.buckets - 1]).parquet(self.path)
        discard(edges)
        discard(rounds)
        self.taken += 1

    def closed(self, edges: DataFrame) -> DataFrame | None:
        """(id, label): the smallest document each text is linked with through any number of links; None if that is the smallest of its own links.

        Notes the documents that became one. A text that links documents
        accepted before needs more than one round, others none.
        """
        labels, rounds = edges.groupBy("id").agg(F.min("other").alias("label")), None
        while True:
            around = edges.select("id", "other").join(labels, "id").groupBy("other").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.bool_or(F.col("id") == F.col("other")).alias("new"))
            counts = around.agg(F.count_if(F.col("least") < F.col("most")).alias("open"), F.count_if((F.col("least") < F.col("other")) & ~F.col("new")).alias("moved")).first()
            if not counts["open"]:
                break
            labels = rounds = materialize(edges.join(around, "other").groupBy("id").agg(F.min("least").alias("label")), "batch-labels")
        if counts["moved"]:
            moves = around.where((F.col("least") < F.col("other")) & ~F.col("new")).select(F.col("other").alias("doc"), F.col("least").alias("into"))
            if self.merged is not None:
                further = moves.select(F.col("doc").alias("into"), F.col("into").alias("last"))
                moves = moves.unionByName(self.merged.join(further, "into", "left").select("doc", F.coalesce("last", "into").alias("into")))
            self.merged = materialize(moves, "url-moves")
        return rounds


def found(rows: DataFrame, deliveries: int | None = None) -> DataFrame:
    """(id_a, id_b) over a whole table; each batch is given to a new index by itself, or at most `deliveries` groups of batches in order."""
    named = items(rows)
    order = [r[0] for r in rows.select(F.col("batch_no").cast("bigint")).distinct().collect()]  # a number for each batch
    order = sorted(n for n in order if n is not None) + [n for n in order if n is None]
    width = max(1, -(-len(order) // (deliveries or DELIVERIES)))
    places = rows.sparkSession.createDataFrame([(n, at // width) for at, n in enumerate(order)], "b bigint, place bigint")
    placed = named.join(F.broadcast(places), F.col("batch_no").eqNullSafe(F.col("b"))).withColumn("batch_no", F.col("place")).drop("b", "place")
    parsed = materialize(placed, "url-items")
    texts = materialize(texts_of(parsed).repartition("batch_no"), "url-texts", ["batch_no"])
    index = UrlIndex(rows.sparkSession, buckets=1 + parsed.count() // BUCKET_ROWS)
    sizes = {r["batch_no"]: r["n"] for r in texts.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}  # a row for each delivery
    for no in range(-(-len(order) // width)):
        index.take(texts.where(F.col("batch_no") == no), sizes.get(no, 0))
    if not order:
        return parsed.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"))
    return index.assigned(parsed).where("id != other").select(F.col("other").alias("id_a"), F.col("id").alias("id_b"))
