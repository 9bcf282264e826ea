"""Text of scanned pages made readable: page furniture, broken words, misread characters.

Structure first: page number lines, and running titles, which recur within a
graph, carry a page number, or stop before the line is full. A word broken at a
line end is told from a compound's own hyphen by the counts of both spellings.
Then noisy-channel correction: every word gets the candidates that look alike
(same shape key), words that clean text never has also those that differ in
any one character. Confusion probabilities of the aligned characters, and how
often words are misread at all, are learned by expectation and maximisation
over all candidates, each word itself among them; Viterbi decoding over the
words of a line weighs them with the counts and bigrams of the corpus and, for
new words, with their spelling. A place whose word itself wins is no case.

Defined results: null, empty and blank texts have no line; a line is header or
page, or may be hyphen and misread; repeated rows count once; extra columns
are not read.

Scale: vocabulary, bigrams and keys are distinct rows with counts, joined by
hash; only lines with a word that has candidates are decoded; a task holds one record.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import batched, discard, materialize

WORD = r"[\p{L}\p{M}]+(?:[-’'][\p{L}\p{M}]+)*"
ROUNDS = 2  # of expectation and maximisation
PRIOR = 100.0  # occurrences that a word's own share weighs among those of its pairs
LETTERS = 10.0  # the same for letters

PAGE = re.compile(r"^\W*(?:(?:page|p\.|стр\.?|с\.|стор\.?|seite|s\.|पृष्ठ|પૃષ્ઠ|页|หน้า)\s*)?(?:\d{1,4}|[ivxlc]{1,6})\W*$", re.I)
NOT_PAGE = re.compile(r"\d\.\s*$|[,;:!?%»”\")]\s*$|^\s*[§№(“«\"]")
NUMBERED = re.compile(r"^(?:\d{1,4}\s{2,}(\S.*)|(.*\S)\s{2,}\d{1,4}|\d{1,4}\s+[|·•]\s+(\S.*)|(.*\S)\s+[|·•]\s+\d{1,4})$")
SECTION = re.compile(r"^\d+(?:\.\d+)*\.?\s(?!\s)")
STOP = re.compile(r"[.!?…,;:।。]['\"”»’)\]]*$")
BROKEN = re.compile(r"[-‐‑–¬­]\s*$")
SMALL = frozenset("a an and as at by for from in of on or the to und zum zur im der die das in von".split())

# Characters that look alike, as one shape or as the strokes they break into.
SHAPES = {
    "0": "o", "о": "o", "ο": "o", "1": "i", "l": "i", "!": "i", "|": "i", "і": "i", "ı": "i", "j": "i", "r": "i", "г": "i", "5": "s", "ѕ": "s", "$": "s", "†": "t", "9": "g", "q": "g",
    "n": "ii", "u": "ii", "h": "ii", "и": "ii", "н": "ii", "й": "ii", "m": "iii", "м": "iii", "т": "iii", "d": "ci", "w": "vv", "ν": "v", "ы": "bi",
    "6": "b", "б": "b", "в": "b", "ь": "b", "ъ": "b", "3": "з", "э": "з", "е": "c", "e": "c", "с": "c", "є": "c", "а": "a", "α": "a", "@": "a", "р": "p", "ρ": "p", "х": "x", "у": "y",
    "ĸ": "k", "к": "k", "κ": "k", "ж": "k", "п": "л", "д": "л", "щ": "ш", "ц": "ш",
}
JUNK = "^~\\`*_¦()"


def shape_key(word: str) -> str:
    """Words that can be misread for each other share a key."""
    plain = "".join(c for c in unicodedata.normalize("NFD", word.casefold()) if unicodedata.category(c) != "Mn" and c not in JUNK)
    return "".join(SHAPES.get(c, c) for c in plain)


def keys_of_word(word: str | None) -> list[str]:
    """Shape key, and the word with each character in turn left open."""
    if not word:
        return []
    w = word.casefold()
    return [shape_key(w), *(f"{w[:i]}\0{w[i + 1 :]}" for i in range(len(w)) if len(w) > 3), *([shape_key(w) + "|"] if "|" not in w else [])]


def keys_of_token(token: str | None) -> list[str]:
    """Shape key with and without strokes; with one odd character left open; of a new word, which begins with a line end here, with any."""
    if not token:
        return []
    t = token.casefold()
    new, t = t[0] == "\n", t.lstrip("\n")
    keys = [shape_key(t), shape_key(t.replace("|", "")) + "|"] if "|" in t else [shape_key(t)]
    odd = [i for i, c in enumerate(t) if not (c.isalpha() or unicodedata.category(c)[0] == "M" or c in "-’'")]
    if len(t) > 3 and (new or len(odd) == 1):
        keys += [f"{t[:i]}\0{t[i + 1 :]}" for i in (range(len(t)) if new and not odd else odd[:1])]
    return keys


def line_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines with what their place says: page number, title candidate, its key, page number beside it, early end, isolation."""
    names = ["src", "rec_id", "graph_id", "line_no", "line", "page", "title", "key", "numbered", "early", "alone", "shaped"]
    for batch in batches:
        out = []
        for src, rec, graph, text in batch[["src", "rec_id", "graph_id", "text"]].itertuples(index=False):
            lines = [x.rstrip("\r") for x in text.split("\n")]
            width = max((len(x.rstrip()) for x in lines), default=0)
            for i, line in enumerate(lines):
                s = line.strip()
                if not s:
                    continue
                page = bool(PAGE.match(s)) and not NOT_PAGE.search(s)
                number = NUMBERED.match(s)
                body = next((g for g in number.groups() if g), "") if number else s
                letters = sum(c.isalpha() for c in body)
                spaced = len(re.findall(r"\S\s{2,}\S", body))
                title = not page and letters >= 4 and letters * 2 > len(body) and not spaced and not body[0].islower() and not BROKEN.search(body) and not STOP.search(body)
                title = title and not re.search(r"[.!?…]\s", body) and (bool(number) or not SECTION.match(s))
                before = lines[i - 1].strip() if i else ""
                after = lines[i + 1].strip() if i + 1 < len(lines) else ""
                first = after.split(" ")[0] if after else ""
                early = bool(after) and len(s) + 1 + len(first) < width - 1
                words = re.findall(r"[^\W\d_]+", body)
                beside = PAGE.match(after) is not None
                early = early and not beside and (len(s) <= 0.85 * width or bool(number))
                indented = len(line) - len(line.lstrip()) >= 3
                # a paragraph's last line ends with a stop; one that begins after a stop or within a broken word and has none is no text
                stray = not after and bool(before) and bool(STOP.search(before) or BROKEN.search(before) or PAGE.match(before))
                apart = not before and not after and len(words) >= 3
                early = early or indented or stray or apart
                big = [w for w in words if not w[0].islower() or w.casefold() in SMALL]
                shaped = body.upper() == body or (len(big) == len(words) and len(words) > 1)
                if src == "raw_graph" and i == len(lines) - 1 and not (shaped or number):
                    title = False  # source_text may be cut off here
                key = shape_key(re.sub(r"[\W\d_]+", "", body))
                out.append((src, rec, graph, i, line, page, title, key, bool(number and title), early and title, not before and not after and not apart and not indented, shaped))
        yield pd.DataFrame(out, columns=names)


LINES = "src string, rec_id bigint, graph_id bigint, line_no int, line string, page boolean, title boolean, key string, numbered boolean, early boolean, alone boolean, shaped boolean"


def classified_lines(records: DataFrame) -> DataFrame:
    """(src, rec_id, line_no, line, kind): kind is header, page or null."""
    lines = materialize(records.mapInPandas(line_rows, LINES), "scan-lines")
    # source_text repeats the beginning of the chunks, so a title is counted in one of both
    titles = lines.where("title").groupBy("graph_id", "key", "src").agg(F.count("*").alias("n"), F.sum(F.expr("if(numbered or not alone, 1, 0)")).alias("placed"))
    titles = titles.groupBy("graph_id", "key").agg(F.max("n").alias("n"), F.max("placed").alias("placed"))
    joined = lines.join(titles, ["graph_id", "key"], "left")
    recurs = (F.col("n") >= 3) | ((F.col("n") >= 2) & (F.col("placed") >= 1) & (F.col("early") | F.col("alone") | F.col("shaped") | F.col("numbered")))
    header = F.col("title") & (F.col("numbered") | recurs | (~F.col("alone") & (F.col("shaped") | F.col("early"))))
    kind = F.when(F.col("page"), "page").when(header, "header")
    return joined.select("src", "rec_id", "line_no", "line", kind.alias("kind"))


TOKEN = re.compile(r"\S+")
EDGE = ".,;:!?()“”\"«»„…[]‘’'—–‚"


def line_words(lines: list[str]) -> Iterator[tuple[int, int, str, str | None, str | None, tuple[int, int], tuple[int, int] | None]]:
    """(line, place in it, word, left, right, span, span in the next line) of the words of text lines; words broken at a line end as one, with both parts."""
    skip = False
    for k, line in enumerate(lines):
        found = list(TOKEN.finditer(line))
        if skip:
            found = found[1:]
        skip, joined = False, None
        last = found[-1][0] if found else ""
        broken = bool(BROKEN.search(last)) and len(last) > 1 and last.rstrip("-‐‑–¬­")[-1:].isalpha() and k + 1 < len(lines)
        follow = TOKEN.search(lines[k + 1]) if broken else None
        if follow and follow[0][:1].isalpha() and (follow[0][0].islower() or last.isupper()):
            left, right = last.rstrip("-‐‑–¬­").lstrip(EDGE), follow[0].rstrip(EDGE)
            end = found[-1].start() + len(last.rstrip("-‐‑–¬­"))
            if left:
                joined = (left + right, left, right, (end - len(left), end), (follow.start(), follow.start() + len(right)))
            found, skip = found[:-1], True
        at = 0
        for m in found:
            bare = m[0].strip(EDGE)
            if bare:
                start = m.start() + len(m[0]) - len(m[0].lstrip(EDGE))
                yield k, at, bare, None, None, (start, start + len(bare)), None
                at += 1
        if joined:
            yield k, at, *joined


def word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each record's text lines."""
    for batch in batches:
        out = [(src, rec, int(numbers[k]), at, word, left, right) for src, rec, numbers, lines in batch[["src", "rec_id", "numbers", "lines"]].itertuples(index=False) for k, at, word, left, right, _, _ in line_words(list(lines))]
        yield pd.DataFrame(out, columns=["src", "rec_id", "line_no", "pos", "token", "left", "right"])


def words_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w))


def vocabulary(clean: DataFrame) -> DataFrame:
    """(word, n) over all clean texts."""
    return clean.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def bigrams(clean: DataFrame) -> DataFrame:
    """(a, b, n): neighbouring words of clean texts."""
    w = clean.select(words_of(F.col("text")).alias("w")).where(F.size("w") > 1)
    pairs = w.select(F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))


def decode_line(steps: list[list[tuple[str, float, int]]], pair: dict[tuple[str, str], int], total: float) -> list[str]:
    """Viterbi: the likeliest words, one of each step's (word, score, count); the first of equals.

    A pair adds log P(b | a) / P(b), where P(b | a) is the pair's share of a's
    occurrences, drawn to P(b) as if a had been seen PRIOR times more.
    """
    best = {w: (s, n, None) for w, s, n in steps[0]}
    trail = [best]
    for step in steps[1:]:
        now = {}
        for w, s, n in step:
            at, frm = max(((t + math.log((pair.get((v, w), 0) * total / max(n, 1) + PRIOR) / (m + PRIOR)), v) for v, (t, m, _) in best.items()), key=lambda x: x[0])
            now[w] = (at + s, n, frm)
        best = now
        trail.append(best)
    path = [max(best, key=lambda w: best[w][0])]
    for done in trail[:0:-1]:
        path.append(done[path[-1]][2])
    return path[::-1]


def letter_pairs(word: str) -> Column:
    """Neighbouring characters of a column's words, both ends marked."""
    return F.expr(f"transform(sequence(1, length({word}) + 1), i -> substring(concat('\\u0002', {word}, '\\u0003'), i, 2))")


def spelling(vocab: DataFrame, tokens: DataFrame) -> DataFrame:
    """(low, spelled): log probability of a new word to be spelled so, by the letter pairs of the distinct words."""
    seen = vocab.where("n > 0").select(F.explode(letter_pairs("word")).alias("g")).groupBy("g").agg(F.count("*").alias("c"))
    firsts = seen.groupBy(F.substring("g", 1, 1).alias("a")).agg(F.sum("c").alias("ca"))
    seconds = seen.groupBy(F.substring("g", 2, 1).alias("b")).agg(F.sum("c").alias("cb"))
    whole = seen.agg(F.sum("c").alias("whole"))
    asked = tokens.select("low", F.explode(letter_pairs("low")).alias("g")).withColumn("a", F.substring("g", 1, 1)).withColumn("b", F.substring("g", 2, 1))
    asked = asked.join(seen, "g", "left").join(firsts, "a", "left").join(seconds, "b", "left").crossJoin(F.broadcast(whole))  # one row
    n = lambda c: F.coalesce(c, F.lit(0))
    alone = (n("cb") + 0.5) / (n("whole") + 1.0)
    return asked.groupBy("low").agg(F.sum(F.log((n("c") + LETTERS * alone) / (n("ca") + LETTERS))).alias("spelled"))


def odd_tokens(clean: DataFrame) -> DataFrame:
    """(low, n_odd): tokens of clean texts that are no words, as `5g`."""
    tokens = clean.select(F.explode(F.split("text", r"\s+")).alias("t")).select(F.lower(F.btrim("t", F.lit(EDGE))).alias("low"))
    return tokens.where((F.col("low") != "") & ~F.col("low").rlike(f"^{WORD}$")).groupBy("low").agg(F.count("*").alias("n_odd"))


def confusions(token: str, word: str) -> list[str]:
    """What was read for what, `read>written`, in the cheapest alignment of two words; neighbouring differences are one."""
    n, m = len(token), len(word)
    cost = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (token[i - 1] != word[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, x, y, i, j = [], "", "", n, m
    while i or j:
        if i and j and token[i - 1] == word[j - 1] and cost[i][j] == cost[i - 1][j - 1]:
            if x or y:
                out.append(f"{x}>{y}")
            x, y, i, j = "", "", i - 1, j - 1
        elif i and j and cost[i][j] == cost[i - 1][j - 1] + 1:
            x, y, i, j = token[i - 1] + x, word[j - 1] + y, i - 1, j - 1
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            x, i = token[i - 1] + x, i - 1
        else:
            y, j = word[j - 1] + y, j - 1
    return [*out, f"{x}>{y}"] if x or y else out


def misread_rate(part: DataFrame, n_words: int) -> float:
    """The share of words that are misread, by the parts of their candidates."""
    misread = part.agg(F.coalesce(F.sum(F.col("part") * F.col("times")), F.lit(0.0)).alias("n")).first()["n"]
    return (misread + 0.5) / (n_words + 1.0)


def channel_score(pairs: DataFrame, part: DataFrame) -> DataFrame:
    """(low, word, channel): log probability that the word was read as the token, by the confusions of all others.

    pairs and part hold (low, word, edits, part): a pair's own part doesn't speak for it.
    """
    counts = part.select(F.explode("edits").alias("edit"), "part").groupBy("edit").agg(F.sum("part").alias("c"))
    whole = part.agg(F.coalesce(F.sum("part"), F.lit(0.0)).alias("n")).first()["n"]
    each = pairs.select("low", "word", "part", F.explode("edits").alias("edit")).join(counts, "edit", "left")
    others = F.greatest(F.coalesce("c", F.lit(0.0)) - F.col("part"), F.lit(0.0))
    return each.groupBy("low", "word").agg(F.sum(F.log((others + 0.5) / (whole + 1.0))).alias("channel"))


def corrections(words: DataFrame, clean: DataFrame) -> DataFrame:
    """(src, rec_id, line_no, pos, token, left, word): tokens that decoding read as another word.

    The token itself is among the options of its place: as a word of the clean
    corpus by its count, as a new one by the share of new words and its
    spelling. All words that look alike compete with it, be it known or not.
    """
    vocab = materialize(vocabulary(clean), "scan-vocabulary")
    sums = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") == 1).alias("once")).first()
    total = float(max(sums["n"], 1))
    new = (sums["once"] + 0.5) / (total + 1.0)  # Good and Turing's share of words not seen so far
    lower = words.withColumn("low", F.lower("token"))
    letters = F.length(F.regexp_replace("low", r"[^\p{L}]", ""))
    tokens = lower.where((letters >= 2) | ((letters == 1) & F.col("low").rlike(r"[^\p{L}\p{M}]"))).groupBy("low").agg(F.count("*").alias("times"))
    tokens = materialize(tokens.join(vocab.select(F.col("word").alias("low"), F.col("n").alias("n_word")), "low", "left"), "scan-tokens")
    # parts of compounds written with another hyphen, numbers with letters and the like have no candidate
    marked = F.when(F.col("n_word").isNull(), F.concat(F.lit("\n"), "low")).otherwise(F.col("low"))
    asked = tokens.select("low", F.explode(batched(keys_of_token, "array<string>")(marked)).alias("key"))
    offered = vocab.select("word", "n", F.explode(batched(keys_of_word, "array<string>")("word")).alias("key")).where("key != ''")
    met = asked.join(offered, "key").select("low", "word", "n").distinct()
    near = F.levenshtein(F.translate("low", JUNK, ""), F.col("word"))
    met = met.where((near <= F.greatest(F.lit(2), F.length("low") / 4)) & (F.col("low") != F.regexp_replace("word", "-", "")) & (F.col("low") != F.col("word")))
    aligned = batched(lambda x: confusions(*x.split("\x1f")), "array<string>")
    met = materialize(met.withColumn("edits", aligned(F.concat_ws("\x1f", "low", "word"))), "scan-candidates")
    # the tokens that have candidates, as themselves
    own = met.select("low").distinct().join(tokens, "low")
    own = own.join(odd_tokens(clean), "low", "left").join(spelling(vocab, own), "low")
    own = materialize(own.select("low", "times", F.coalesce("n_word", "n_odd", F.lit(0)).alias("n"), "spelled"), "scan-own")
    chance = lambda n: F.col(n) / F.lit(total) * F.lit(1 - new)
    itself = F.greatest(F.log(chance("n") + F.lit(new) * F.exp("spelled")), math.log(new) + F.col("spelled"))
    sizes = own.select("low", "times", "n", itself.alias("itself"))
    # confusions are learned from the tokens that clean text never has; a candidate's part in them is its likelihood among all of the token
    learned = met.join(sizes.where("n = 0").select("low", "times", "itself"), "low")
    part = learned.withColumn("part", 1.0 / F.count("*").over(Window.partitionBy("low")))
    n_words = lower.count()
    older = None
    for _ in range(ROUNDS):
        part = materialize(part, "scan-parts")
        discard(older)
        older = part
        rate = misread_rate(part, n_words)
        likely = part.join(channel_score(part, part), ["low", "word"]).withColumn("likely", F.col("channel") + math.log(rate) + F.log(chance("n")))
        top = F.greatest(F.max("likely").over(Window.partitionBy("low")), F.col("itself"))
        likely = likely.withColumn("weight", F.exp(F.col("likely") - top)).withColumn("stays", F.exp(math.log(max(1 - rate, 1e-9)) + F.col("itself") - top))
        share = F.col("weight") / (F.sum("weight").over(Window.partitionBy("low")) + F.col("stays"))
        part = likely.select(*learned.columns, share.alias("part"))
    part = materialize(part, "scan-parts")
    rate = misread_rate(part, n_words)
    seen = met.join(part.select("low", "word", "part"), ["low", "word"], "left").fillna(0.0, ["part"])
    scored = met.join(channel_score(seen, part), ["low", "word"]).select("low", F.col("word").alias("option"), "n", (F.col("channel") + math.log(rate) + F.log(chance("n"))).alias("score"))
    scored = scored.unionByName(sizes.select("low", F.col("low").alias("option"), "n", (math.log(max(1 - rate, 1e-9)) + F.col("itself")).alias("score")))
    order = ["src", "rec_id", "line_no"]
    lines = lower.join(lower.join(own, "low", "left_semi").select(*order).distinct(), order, "left_semi")
    options = lines.join(scored, "low", "left")
    options = options.select(*order, "pos", "token", "left", "low", F.coalesce("option", "low").alias("option"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("score", F.lit(0.0)).alias("score"), F.col("option").isNotNull().alias("open"))
    # of a word without candidates only its count is missing
    options = options.join(vocab.select(F.col("word").alias("option"), F.col("n").alias("n_word")), "option", "left").withColumn("n", F.coalesce("n_word", "n")).drop("n_word")
    options = materialize(options, "scan-options")
    following = options.select(*order, (F.col("pos") - 1).alias("pos"), F.col("option").alias("b"), F.col("open").alias("next_open"))
    pairs = options.select(*order, "pos", F.col("option").alias("a"), "open").join(following, [*order, "pos"]).where("open or next_open")
    pairs = pairs.join(bigrams(clean).withColumnRenamed("n", "k"), ["a", "b"])
    pair_lists = pairs.groupBy(*order).agg(F.collect_set(F.struct("a", "b", "k")).alias("pairs"))
    steps = options.groupBy(*order).agg(F.collect_list(F.struct("pos", "token", "left", "low", "option", "score", "n")).alias("steps"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for src, rec, line, steps, pairs in batch[[*order, "steps", "pairs"]].itertuples(index=False):
                by: dict[int, list] = {}
                for x in steps:
                    by.setdefault(x["pos"], []).append(x)
                pair = {(p["a"], p["b"]): p["k"] for p in (pairs if pairs is not None else [])}
                at = sorted(by)
                ranked = [sorted(by[k], key=lambda x: (x["option"] != x["low"], x["option"])) for k in at]
                words = decode_line([[(x["option"], x["score"], x["n"]) for x in xs] for xs in ranked], pair, total)
                for k, w in zip(at, words, strict=True):
                    x = by[k][0]
                    if w != x["low"]:
                        out.append((src, rec, int(line), int(k), x["token"], x["left"], w))
            yield pd.DataFrame(out, columns=[*order, "pos", "token", "left", "word"])

    return steps.join(pair_lists, order, "left").mapInPandas(decode, "src string, rec_id bigint, line_no int, pos int, token string, left string, word string")


def scan_records(chunks: DataFrame, graphs: DataFrame) -> DataFrame:
    """(src, rec_id, graph_id, text) of origin `scan`; repeated rows once."""
    a = chunks.where("origin = 'scan'").select(F.lit("chunk").alias("src"), F.col("chunk_id").alias("rec_id"), "graph_id", "text")
    b = graphs.where("origin = 'scan'").select(F.lit("raw_graph").alias("src"), F.col("graph_id").alias("rec_id"), "graph_id", F.col("source_text").alias("text"))
    return a.unionByName(b).where("text is not null").distinct()


def clean_texts(chunks: DataFrame, graphs: DataFrame, sentences: DataFrame) -> DataFrame:
    keep = lambda df, c: df.where("origin = 'text'").select(F.col(c).alias("text")).where("text is not null")
    return keep(chunks, "text").unionByName(keep(graphs, "source_text")).unionByName(keep(sentences, "text"))


def record_words(lines: DataFrame) -> DataFrame:
    """Words of the text lines, broken words joined."""
    body = lines.where("kind is null").groupBy("src", "rec_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    body = body.select("src", "rec_id", F.col("x.line_no").alias("numbers"), F.col("x.line").alias("lines"))
    return body.mapInPandas(word_rows, "src string, rec_id bigint, line_no int, pos int, token string, left string, right string")


def broken_lines(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """(src, rec_id, line_no) of the lines that end inside a word, a compound's own hyphen aside."""
    counts = lambda c: vocab.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    pairs = words.where("left is not null").select("src", "rec_id", "line_no", F.lower("token").alias("joined"), F.lower(F.concat_ws("-", "left", "right")).alias("compound"), F.lower("left").alias("l"), F.lower("right").alias("r"))
    for c in ("joined", "compound", "l", "r"):
        pairs = pairs.join(counts(c), c, "left")
    n = lambda c: F.coalesce(f"n_{c}", F.lit(0))
    parts = (n("l") > 0) & (n("r") > 0) & (n("joined") == 0)
    return pairs.where((n("joined") >= n("compound")) & ~((n("compound") == 0) & parts)).select("src", "rec_id", "line_no")


def analysed(chunks: DataFrame, graphs: DataFrame, sentences: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines with kind, broken lines, corrections)."""
    lines = materialize(classified_lines(scan_records(chunks, graphs)), "scan-kinds")
    words = materialize(record_words(lines), "scan-words")
    clean = clean_texts(chunks, graphs, sentences)
    return lines, broken_lines(words, vocabulary(clean)), corrections(words, clean)


def found(chunks: DataFrame, graphs: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, line_no, kind)."""
    lines, broken, wrong = analysed(chunks, graphs, sentences)
    furniture = lines.where("kind is not null").select("src", "rec_id", "line_no", "kind")
    hyphen = broken.withColumn("kind", F.lit("hyphen"))
    second = F.col("left").isNotNull() & F.col("word").startswith(F.lower("left"))
    at = wrong.select("src", "rec_id", F.when(second, F.col("line_no") + 1).otherwise(F.col("line_no")).alias("line_no"), F.lit("misread").alias("kind"))
    return furniture.unionByName(hyphen).unionByName(at).distinct()


def cased(word: str, token: str) -> str:
    """The word in the letter case of the token it replaces."""
    return word.upper() if token.isupper() and len(word) > 1 else word[:1].upper() + word[1:] if token[:1].isupper() else word


def corrected(lines: list[str], fixes: dict[tuple[int, int], str]) -> list[str]:
    """Text lines with the words of `fixes` (line, place) put where they stand; of a broken word each line gets its part."""
    changes: dict[int, list[tuple[int, int, str]]] = {}
    for k, at, token, left, _, span, after in line_words(lines):
        word = fixes.get((k, at))
        if word is None:
            continue
        word = cased(word, token)
        cut = len(word) if after is None else min(len(left or ""), len(word) - 1)
        changes.setdefault(k, []).append((*span, word[:cut]))
        if after is not None:
            changes.setdefault(k + 1, []).append((*after, word[cut:]))
    out = list(lines)
    for k, edits in changes.items():
        for start, end, word in sorted(edits, reverse=True):
            out[k] = out[k][:start] + word + out[k][end:]
    return out


def repaired(chunks: DataFrame, graphs: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, text): paragraphs without furniture, broken words joined, misread words replaced where they stand."""
    lines, broken, wrong = analysed(chunks, graphs, sentences)
    key = ["src", "rec_id", "line_no"]
    fixes = wrong.groupBy("src", "rec_id").agg(F.collect_set(F.struct("line_no", "pos", "word")).alias("fixes"))
    body = lines.where("kind is null").join(broken.withColumn("broken", F.lit(True)), key, "left")
    body = body.groupBy("src", "rec_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line", F.coalesce("broken", F.lit(False)).alias("broken")))).alias("lines"))
    furniture = lines.where("kind is not null").groupBy("src", "rec_id").agg(F.collect_set("line_no").alias("gone"))

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for src, rec, lines, fixes, gone in batch[["src", "rec_id", "lines", "fixes", "gone"]].itertuples(index=False):
                gone = set(gone) if gone is not None else set()
                place = {x["line_no"]: k for k, x in enumerate(lines)}
                right = corrected([x["line"] for x in lines], {(place[f["line_no"]], f["pos"]): f["word"] for f in (fixes if fixes is not None else [])})
                text, last, last_line = "", None, ""
                for x, line in zip(lines, right, strict=True):
                    line, number = line.strip(), x["line_no"]
                    if last is None:
                        text = line
                    elif last["broken"]:
                        text = re.sub(r"[-‐‑–¬­]\s*$", "", text) + line
                    else:
                        between = set(range(last["line_no"] + 1, number)) - gone
                        done = STOP.search(last_line) and not last_line.endswith(",")
                        joint = "\n\n" if between and (done or not gone & set(range(last["line_no"], number))) else "" if BROKEN.search(text) and line[:1].islower() else " "
                        text += joint + line
                    last, last_line = x, line
                out.append((src, rec, text))
            yield pd.DataFrame(out, columns=["src", "rec_id", "text"])

    rows = body.join(fixes, ["src", "rec_id"], "left").join(furniture, ["src", "rec_id"], "left")
    return rows.mapInPandas(rebuild, "src string, rec_id bigint, text string")
