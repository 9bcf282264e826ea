"""Text that was decoded with the wrong character encoding: find it and restore it.

Every distinct clean token of the corpus is garbled under all chains of
encodings; the forms, with their originals, make a table. Tokens of the
suspect documents are hash-joined against it. Only forms that a Bloom filter of
the suspect tokens lets through are made into rows: a filter never holds back a
form that a suspect has, so the table is as good as whole. A form that the clean corpus
itself uses proves nothing and is left out; of several originals the most
frequent is taken. Tokens are non-ASCII runs, words, letter pieces, and words
whose ASCII letters and digits are counted as one of their kind (so quotes and
dashes around any word are known from those around others); what stays unknown of a run (scripts without spaces, new words) is looked up in
windows against the forms of short clean letter groups, and at least three
different windows of a run must agree.

Defined results: null, empty and blank texts are never affected; rightly
decoded rare letters and signs are none; records delivered twice come out
once; forms that lost characters count as affected. A restored text is `whole`
only where every garbled token is read back exactly through its chain; one put
in from the table of forms is the likeliest original, not a certain one.

Scale: token and form tables are distinct rows with counts (map-side
combine); the joins are plain hash joins on the token. No token's rows are
gathered in one task. The filters have a fixed number of bits, whatever the
corpus; when they fill up, more forms become rows and nothing else changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

RUN = r"[^\x00-\x7f]+|(?<![\p{L}\p{N}!?.])\?{2,}|\?{2,}(?=\p{L})"
PIECE = r"(?<![A-Za-z])[\p{L}\p{M}]{3,}"
# Characters of the wrong decodings: Latin-1 and Latin Extended, Greek, Cyrillic, signs, box drawing.
SUSPECT = r"[\x{80}-\x{52f}\x{2010}-\x{22ff}\x{2300}-\x{25ff}\x{f8ff}\x{fb00}-\x{fb06}\x{fffd}]"
WINDOWS = (3, 4, 6, 7, 8, 9)
LEAST_WINDOWS = 3
LEAST_SINGLE = 3
LEAST_SIGNS = 3  # records of clean text that must have a sign whose readings count
FILTER_BITS = 1 << 24  # of each Bloom filter: 2 MB

# Encodings in which the texts were written, and in which they were read.
WRITTEN = ("utf-8", "cp1251", "koi8-r", "cp866", "cp1252", "mac-roman", "gbk", "cp874", "iso8859-5")
READ = ("cp1252", "latin-1", "cp1251", "koi8-r", "cp866", "cp437", "mac-roman", "cp1250", "utf-8", "ascii")
TWICE = {"cp1252": ("cp1252", "latin-1"), "latin-1": ("latin-1", "cp1252"), "cp1251": ("cp1251", "cp1252"), "cp437": ("cp437",)}
LOST = "�"
BAD = "\0"


def read_as(raw: bytes, encoding: str) -> str:
    """Bytes without a character in the encoding become control characters, as browsers read them."""
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        if encoding in ("utf-8", "ascii"):
            return raw.decode(encoding, "replace")
        return "".join(chr(b) if (c := bytes([b]).decode(encoding, "replace")) == LOST else c for b in raw)


class Garbler(dict):
    """What one chain makes of each character; characters are worked out once. An impossible one gives BAD."""

    def __init__(self, written: str, reads: tuple[str, ...], lossy: bool = False):
        super().__init__()
        self.written, self.reads, self.lossy = written, reads, lossy

    def __missing__(self, code: int) -> str:
        try:
            text = chr(code)
            for k, read in enumerate(self.reads):
                raw = text.encode(self.written if k == 0 else "utf-8")
                text = raw.decode(read, "replace") if self.lossy else read_as(raw, read)
        except UnicodeEncodeError:
            text = BAD
        self[code] = text
        return text


@lru_cache(maxsize=1)
def chains() -> list[tuple[str, Garbler]]:
    """All chains that work character by character (every reading but UTF-8 does)."""
    out = []
    for written in WRITTEN:
        for read in READ:
            if read in (written, "utf-8"):
                continue
            out.append((f"{written}>{read}", Garbler(written, (read,))))
            if written == "utf-8" and read in TWICE:
                out.append((f"{written}>{read}", Garbler(written, (read,), lossy=True)))
                for again in TWICE[read]:
                    out.append((f"{written}>{read}>{again}", Garbler(written, (read, again))))
                    out.append((f"{written}>{read}>{again}>{again}", Garbler(written, (read, again, again))))
    return out


def garbled_forms(token: str, starts: frozenset[str] | None = None) -> dict[str, str]:
    """Garbled form -> name of the chain that made it; of `starts`, if given, only forms that begin with one."""
    forms: dict[str, str] = {}
    for name, garbler in chains():
        if starts is not None and token and garbler[ord(token[0])][:1] not in starts:
            continue
        form = token.translate(garbler)
        if BAD not in form:
            forms.setdefault(form, name)
    for written in WRITTEN[1:]:
        try:
            forms.setdefault(token.encode(written).decode("utf-8", "replace"), f"{written}>utf-8")
        except UnicodeEncodeError:
            continue
    forms.setdefault("?" * len(token), "ascii?")
    forms.setdefault("?" * len(token.encode("utf-8", "replace")), "ascii?")
    forms.pop(token, None)
    return forms


def filter_places(text: str) -> tuple[int, int, int]:
    """The bits of a text in a Bloom filter."""
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h % FILTER_BITS, (h >> 20) % FILTER_BITS, (h >> 40) % FILTER_BITS


def bloom_filter(texts: DataFrame) -> tuple[np.ndarray, frozenset[str]]:
    """The Bloom filter of a one-column table, and the characters its texts begin with: each task fills a filter of its own, these are joined bit by bit, FILTER_BITS in all."""

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for text in batch["text"]:
                bits[list(filter_places(text))] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at, "word": words[at]})

    parts = texts.toDF("text").mapInPandas(fill, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for r in parts.collect():  # at most FILTER_BITS / 64 numbers
        words[r["at"]] = r["word"]
    starts = texts.toDF("text").select(F.substring("text", 1, 1).alias("c")).distinct().collect()  # no more than there are characters
    return words, frozenset(r["c"] for r in starts)


def rows_of_forms(lengths: tuple[int, ...] | None, wanted: tuple[np.ndarray, frozenset[str]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Forms of tokens as rows, those that the filter lets through; only of the given lengths, if any are given."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(wanted[0].view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            rows = []
            for token, n in zip(batch["token"], batch["n"], strict=True):
                for form, chain in garbled_forms(token, wanted[1]).items():
                    if lengths and len(form) not in lengths or form.isascii() and form.strip("?"):
                        continue
                    a, b, c = filter_places(form)
                    if not (bits[a] and bits[b] and bits[c]):
                        continue
                    multi = chain.startswith(("utf-8", "gbk")) or LOST in form
                    if not multi and len(token) < LEAST_SINGLE or len(form) < 2 and form != LOST:
                        continue
                    rows.append((form, token, int(n), chain))
            yield pd.DataFrame(rows, columns=["form", "original", "n", "chain"])

    return make


def rows_of_signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(form, read): what one-byte readings make of single signs."""
    for batch in batches:
        rows = [(form, chain.split(">")[1]) for token in batch["token"] for form, chain in garbled_forms(token).items() if len(form) == 1 and form not in (LOST, "?") and not chain.startswith(("utf-8", "gbk"))]
        yield pd.DataFrame(rows, columns=["form", "read"])


def runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def tokens(text: Column) -> Column:
    """Distinct (form, word) of a text: non-ASCII runs, words and letter pieces as they are, and the shape of words that are ASCII in part."""
    words = F.transform(F.split(text, r"[ \t\r\n]+"), lambda w: F.regexp_replace(w, r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", ""))
    wide = F.filter(words, lambda w: w.rlike(r"[^\x00-\x7f]"))
    pieces = F.filter(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda w: w.rlike(r"[^\x00-\x7f]"))
    shape = lambda w: F.regexp_replace(F.regexp_replace(F.regexp_replace(w, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    whole = F.filter(F.concat(wide, pieces), lambda w: F.length(w) >= LEAST_SINGLE)
    same = F.transform(F.concat(runs(text), whole), lambda w: F.struct(w.alias("form"), w.alias("word")))
    shaped = F.filter(F.transform(wide, lambda w: F.struct(shape(w).alias("form"), w.alias("word"))), lambda x: (F.length(x["form"]) >= LEAST_SINGLE) & (F.length(x["form"]) < F.length(x["word"])))
    return F.array_distinct(F.concat(same, shaped))


def counted(rows: DataFrame) -> DataFrame:
    """(token, n documents)."""
    return rows.select(F.explode(F.array_distinct(F.transform(tokens(F.col("text")), lambda t: t["form"]))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def spread(rows: DataFrame) -> DataFrame:
    """Small rows that make much work each, over all cores."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "token")


def form_table(clean: DataFrame, wanted: tuple[np.ndarray, frozenset[str]]) -> DataFrame:
    """(form, original, n, chain): one row for each garbled form that the filter lets through; forms that are clean tokens are left out."""
    forms = spread(clean).mapInPandas(rows_of_forms(None, wanted), "form string, original string, n bigint, chain string")
    forms = forms.join(clean.select(F.col("token").alias("form")), "form", "left_anti")
    best = F.max(F.struct("n", "original", "chain"))
    return forms.groupBy("form").agg(best.alias("b")).select("form", "b.original", "b.n", "b.chain")


def letter_groups(clean: DataFrame) -> DataFrame:
    """(token, n): clean letter groups whose garbled forms fill a window (1 to 4 letters), beyond ASCII and Latin."""
    text = F.regexp_replace("token", r"[\x00-\x{24f}\x{2000}-\x{206f}]+", " ")
    words = clean.select(F.explode(F.split(text, " ")).alias("w"), "n").where("w != ''")
    grams = [F.transform(F.sequence(F.lit(1), F.greatest(F.length("w") - (k - 1), F.lit(1))), lambda i, k=k: F.substring(F.col("w"), i, F.lit(k))) for k in (1, 2, 4)]
    groups = words.select(F.explode(F.array_distinct(F.concat(*grams))).alias("token"), "n")
    return groups.groupBy("token").agg(F.sum("n").alias("n"))


def windows(run: Column) -> Column:
    cut = lambda k: F.when(F.length(run) >= k, F.transform(F.sequence(F.lit(1), F.length(run) - (k - 1)), lambda i: F.substring(run, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*(cut(k) for k in WINDOWS)))


def matches(suspects: DataFrame, clean: DataFrame) -> DataFrame:
    """(src, rec_id, form, original, chain): garbled tokens of the suspects (src, rec_id, text)."""
    clean_tokens = materialize(counted(clean), "clean-tokens")
    held = materialize(suspects.select("src", "rec_id", F.explode(tokens(F.col("text"))).alias("t")).select("src", "rec_id", "t.form", "t.word").distinct(), "suspect-tokens")
    wanted = bloom_filter(held.select("form").distinct())
    forms = materialize(form_table(clean_tokens, wanted), "garbled-forms")
    # of a shape the word itself is what goes on; its original is for its chain to tell
    named = ["src", "rec_id", F.col("word").alias("form"), F.when(F.col("form") == F.col("word"), F.col("original")).alias("original"), "chain"]
    first = held.join(forms, "form").select(*named)

    # clean words that only the suspects have: unknown, in one script beyond Latin, and not rarer than their garbled forms
    known = clean_tokens.select(F.col("token").alias("form")).unionByName(forms.select("form"))
    rest = held.where("form = word").join(known, "form", "left_anti")
    counts = materialize(rest.groupBy("form").agg(F.count("*").alias("k")), "unknown-tokens")
    whole = r"^(?:[\p{IsCyrillic}]{3,}|[\p{IsDevanagari}]{2,}|[\p{IsGujarati}]{2,}|[\p{IsThai}]+|[\p{IsHan}]+|[\x{a1}-\x{17f}\x{2010}-\x{2122}])$"
    own = counts.where(F.col("form").rlike(whole)).select(F.col("form").alias("token"), F.col("k").alias("n"))
    own_forms = form_table(own, wanted).join(counts, "form").where(F.col("n") > F.col("k"))
    second = rest.join(own_forms.select("form", "original", "chain"), "form").select(*named)

    own_forms = materialize(own_forms, "own-forms")
    # single signs and accented letters that clean text doesn't have: two and more in a record, and at least half of all such, are what one reading makes of signs that it has
    singles = rest.where(F.length("form") == 1).select("src", "rec_id", "form")
    signs = clean_tokens.where((F.length("token") == 1) & (F.col("n") >= LEAST_SIGNS) & F.col("token").rlike(r"[\x{a1}-\x{17f}\x{2010}-\x{2122}]")).select("token")
    read = singles.join(signs.mapInPandas(rows_of_signs, "form string, read string").distinct(), "form")
    per = read.groupBy("src", "rec_id", "read").agg(F.count_distinct("form").alias("n")).join(singles.groupBy("src", "rec_id").agg(F.count_distinct("form").alias("all")), ["src", "rec_id"])
    fitting = per.where("n >= 2 and 2 * n >= all").groupBy("src", "rec_id").agg(F.min("read").alias("read"))
    fourth = read.join(fitting, ["src", "rec_id", "read"]).select("src", "rec_id", "form", F.lit(None).cast("string").alias("original"), F.concat(F.lit("cp1252>"), "read").alias("chain")).distinct()
    own = own.join(own_forms.select(F.col("form").alias("token")), "token", "left_anti")
    left = counts.select("form").where(F.col("form").rlike(SUSPECT) & (F.length("form") >= 3)).join(own_forms.select("form").unionByName(own.select("token").toDF("form")), "form", "left_anti")
    cut = left.select("form", F.explode(windows(F.col("form"))).alias("window"))
    # a window that clean text shows as it stands proves nothing
    plain = clean_tokens.where(F.col("token").rlike(SUSPECT)).select(F.explode(windows(F.col("token"))).alias("window")).distinct()
    cut = materialize(cut.join(plain, "window", "left_anti"), "suspect-windows")
    groups = letter_groups(clean_tokens.unionByName(own))
    small = spread(groups).mapInPandas(rows_of_forms(WINDOWS, bloom_filter(cut.select("window").distinct())), "form string, original string, n bigint, chain string")
    small = small.where(~F.col("form").rlike(r"^[?�]+$")).groupBy("form").agg(F.max(F.struct("n", "original", "chain")).alias("b"))
    small = small.select(F.col("form").alias("window"), "b.original", "b.chain")
    met = cut.join(small, "window").groupBy("form", "chain").agg(F.count("*").alias("hits"), F.max(F.length("window")).alias("wide"))
    fits = met.where((F.col("hits") >= LEAST_WINDOWS) | ((F.col("hits") * F.col("wide") >= F.length("form")) & F.col("chain").startswith("utf-8")))
    third = rest.join(fits.groupBy("form").agg(F.max(F.struct("hits", "chain")).alias("b")).select("form", "b.chain"), "form").select("src", "rec_id", "form", F.lit(None).cast("string").alias("original"), "chain")
    lost = rest.where(F.col("form").contains(LOST)).select("src", "rec_id", "form", F.lit(None).cast("string").alias("original"), F.lit("lost").alias("chain"))
    return first.unionByName(second).unionByName(fourth).unionByName(third).unionByName(lost)


def records(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, origin, text) of both tables; rows delivered twice once."""
    a = chunks.select(F.lit("chunk").alias("src"), F.col("chunk_id").alias("rec_id"), "origin", "text")
    b = sentences.select(F.lit("sentence").alias("src"), F.col("sentence_id").alias("rec_id"), "origin", "text")
    return a.unionByName(b.distinct()).where("text is not null")


def all_matches(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    rows = records(chunks, sentences)
    return matches(rows.where("origin = 'legacy'"), rows.where("origin is null or origin != 'legacy'"))


def found(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id) of the affected records."""
    return all_matches(chunks, sentences).select("src", "rec_id").distinct()


def undo(chain: str, form: str) -> str | None:
    """The form read backwards through its chain, if every step is exact."""
    steps = chain.split(">")
    if len(steps) < 2:
        return None
    try:
        text = form
        for k in range(len(steps) - 1, 0, -1):
            raw = b"".join(c.encode("latin-1") if "\x80" <= c <= "\x9f" else c.encode(steps[k]) for c in text)
            text = raw.decode(steps[0] if k == 1 else "utf-8")
        return text
    except (UnicodeError, LookupError):
        return None


def restored(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, text, whole): the affected records with originals put in; whole is false where some part stays lost or isn't certain."""
    hits = materialize(all_matches(chunks, sentences), "garbled-hits")

    @F.pandas_udf("string")
    def backwards(chain: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([undo(c, f) for c, f in zip(chain, form, strict=True)], dtype=object)

    pairs = hits.withColumn("exact", backwards("chain", "form"))
    pairs = pairs.select("src", "rec_id", "form", F.coalesce("exact", "original").alias("original"), F.col("exact").isNotNull().alias("sure"))
    longest = F.sort_array(F.collect_set(F.struct((-F.length("form")).alias("o"), "form", "original", "sure")))
    lists = pairs.groupBy("src", "rec_id").agg(longest.alias("pairs"))
    rows = records(chunks, sentences).where("origin = 'legacy'").join(lists, ["src", "rec_id"])
    text = F.aggregate("pairs", F.col("text"), lambda t, p: F.when(p["original"].isNull(), t).otherwise(F.replace(t, p["form"], p["original"])))
    rows = rows.withColumn("restored", text)
    # a token that went with a longer one around it is not looked at again
    doubtful = F.exists("pairs", lambda p: ~p["sure"] & (F.contains(F.col("restored"), p["form"]) | ~F.exists("pairs", lambda q: q["sure"] & (F.length(q["form"]) > F.length(p["form"])) & F.contains(q["form"], p["form"]))))
    return rows.select("src", "rec_id", F.col("restored").alias("text"), (~doubtful).alias("whole"))
