"""Sentence boundaries across languages and scripts.

Possible boundaries of a block (text between blank lines) are scored as whole
spans by semi-Markov dynamic programming: the length of a span, its opening
word, its closing word, and whether its quotations and brackets balance. How
well a word opens or closes comes from counts over the corpus: how often it
begins or ends a block against how often it stands at a possible boundary
within one. Scripts without spaces use letter groups for words.

Every span that begins before a boundary is weighed, however long the block:
a span's score changes at three places only (long enough, long, reporting
words reached), so the best beginnings are kept in heaps and a block of k
boundaries takes k log k steps.

Defined results: null, empty and blank texts give no sentence; a row delivered
twice gives its sentences once; positions count code points; blank lines always
part; a text without any stop is one sentence for each block.

Scale: the counts cover all rows and stay a table. Up to `model_rows` keys
they go to the tasks as they are; beyond, each record is joined with the counts
of its own keys. Both ways give the same spans.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

MODEL_ROWS = 50_000  # keys that may go to the tasks; more are joined
LONG = 300  # from here a span costs DRAG a character
DRAG = 0.002
WORD_END = 24  # longer words are named by a digest

STOPS = ".!?…。！？।॥"
WIDE_STOPS = "。！？।॥"
BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
CANDIDATE = re.compile(f"[{STOPS}]+|(?<=[฀-๿])[^\\S\\n]+|[^\\S\\n]+(?=[฀-๿])|\\n(?=[฀-๿])")
CLOSE = {"”": "“", "»": "«", "“": "„", "》": "《", "」": "「", ")": "(", "]": "[", "）": "（", "’": "‘", "›": "‹"}
OPEN = frozenset("“«„《「([（‘‹")
MARKS = re.compile("[\"" + re.escape("".join({*CLOSE, *OPEN})) + "]")
THAI = re.compile("[฀-๿]")
DASH = "—–―-"
WORD = re.compile(r"[^\W_]+(?:[ऀ-ॿ઀-૿฀-๿]+[^\W_]*)*|[ऀ-ॿ઀-૿]+")


def script_of(c: str) -> str:
    o = ord(c)
    if 0x0E00 <= o <= 0x0E7F:
        return "thai"
    if 0x0900 <= o <= 0x097F:
        return "deva"
    if 0x0A80 <= o <= 0x0AFF:
        return "gujr"
    if 0x0400 <= o <= 0x052F:
        return "cyrl"
    if 0x3400 <= o <= 0x9FFF:
        return "hani"
    return "latn"


def depths(block: str) -> list[int]:
    """Open quotations and brackets after each character; openers never closed don't count."""
    stack: list[tuple[str, int]] = []
    held: Counter = Counter()  # openers on the stack
    change = [0] * (len(block) + 1)

    def close(opener: str, i: int) -> None:
        while True:
            o, at = stack.pop()
            held[o] -= 1
            if o == opener:
                change[at] += 1
                change[i] -= 1
                return

    for m in MARKS.finditer(block):
        c, i = m[0], m.start()
        if c == '"':
            if held[c]:
                close(c, i)
                continue
        elif c in CLOSE and held[CLOSE[c]]:
            close(CLOSE[c], i)
            continue
        elif c not in OPEN or (c == "‘" and i and block[i - 1].isalnum()):
            continue
        stack.append((c, i))
        held[c] += 1
    out, now = [], 0
    for d in change[: len(block)]:
        now += d
        out.append(now)
    return out


def closing_key(block: str, at: int, thai: bool) -> tuple[str, str]:
    """(script, key) of the word that ends before position `at`."""
    end = at
    while end > 0 and not (block[end - 1].isalnum() or script_of(block[end - 1]) in ("thai", "deva", "gujr")):
        end -= 1
    if not end:
        return "latn", "<none>"
    script = script_of(block[end - 1])
    if script == "thai":
        word = block[max(0, end - 6) : end].split()[-1]
        return script, word + ("." if end < at and block[end] == "." else "")
    if script == "hani":
        return script, block[max(0, end - 2) : end]
    start = end
    while start > 0 and (block[start - 1].isalnum() or script_of(block[start - 1]) in ("deva", "gujr")) and script_of(block[start - 1]) not in ("thai", "hani"):
        start -= 1
    return among(thai, script), word_key(block[start:end])


def among(thai: bool, script: str) -> str:
    """Numbers and Latin words among Thai count as Thai."""
    return "thai" if script == "latn" and thai else script


def word_key(word: str) -> str:
    if word.isdigit():
        return "<n>" if len(word) < 3 else "<nn>"
    if len(word) == 1 and word.isupper():
        return "<i>"
    return word if len(word) <= WORD_END else hashlib.md5(word.encode("utf-8", "replace")).hexdigest()


def opening_key(block: str, at: int, thai: bool) -> tuple[str, str]:
    """(script, key) of the word that begins at or after position `at`."""
    start, lead = at, ""
    while start < len(block) and not block[start].isalnum() and script_of(block[start]) not in ("thai", "deva", "gujr"):
        if block[start] in DASH or block[start] in OPEN or block[start] == '"':
            lead = "q"
        start += 1
    if start == len(block):
        return "latn", "<none>"
    script = script_of(block[start])
    if script == "thai":
        return script, lead + block[start : start + 5]
    if script == "hani":
        return script, lead + block[start : start + 2]
    end = start
    while end < len(block) and (block[end].isalnum() or script_of(block[end]) in ("deva", "gujr")):
        end += 1
    return among(thai, script), lead + word_key(block[start:end])


def boundaries(block: str) -> list[tuple[int, int, int]]:
    """Possible boundaries as (end of the left part, start of the right part, 1 if quotations are open there)."""
    depth = depths(block)
    n, out = len(block), []
    for m in CANDIDATE.finditer(block):
        if m[0][0] in STOPS:
            at, end = m.start(), m.end()
            while end < n and (block[end] in CLOSE or block[end] == '"') and depth[end] < depth[end - 1]:
                end += 1
        else:
            at, end = m.start(), m.start()
        right = end
        while right < n and block[right].isspace():
            right += 1
        if right == n or not end:
            continue
        c = block[right]
        if m[0][0] in STOPS:
            if right == end:
                before = block[at - 1] if at else " "
                if m[0][-1] in WIDE_STOPS:
                    if c in ",，、；：;:)）" or (end > m.end() and script_of(c) == "hani" and "q" not in c):
                        continue
                elif not (before.isalpha() or script_of(before) in ("deva", "gujr") or (before.isdigit() and c.isupper())) or not (c.isupper() or script_of(c) in ("deva", "gujr", "hani", "thai") or c in OPEN):
                    continue
            if c.islower() or c in ",;:)]»”，、；：":
                continue
            if c in DASH:
                rest = block[right + 1 :].lstrip()
                if right == end or not rest or rest[0].islower() or rest[0].isdigit():
                    continue
        elif not (script_of(block[end - 1]) == "thai" or script_of(c) == "thai"):
            continue
        if out and out[-1][1] == right:
            continue
        out.append((end, right, int(depth[end - 1] > 0)))
    return out


class Model:
    """Scores of opening and closing keys, relative to the base rate of their script."""

    def __init__(self, totals: list[tuple[str, str, int, int]], rows: list[tuple[str, str, str, int, int]]):
        """totals (side, script, yes, no) over the whole corpus; rows (side, script, key, yes, no) of some or all keys."""
        base = {(side, script): math.log((yes + 1) / (yes + no + 2)) for side, script, yes, no in totals}
        self.score = {(side, script, key): max(-6.0, min(1.5, math.log((yes + 0.3) / (yes + no + 0.6)) - base[side, script])) for side, script, key, yes, no in rows}

    def of(self, side: str, where: tuple[str, str]) -> float:
        return self.score.get((side, *where), 0.0)


def best_parting(starts: list[int], ends: list[int], gain: list[float], short: int, said: list[tuple[float, int, float]]) -> list[int]:
    """Where the span that ends at each boundary begins in the best parting.

    Semi-Markov search over all pairs i < j: the value of a span is what led to
    i, -1 if it is shorter than `short`, -DRAG for each character beyond LONG,
    said[i] = (score before, place, score from that place on), and gain[j].
    The value of i changes at these places only: `near` holds it for spans up
    to LONG, `far` with the drag taken out for longer ones. Equals go to the
    earlier i.
    """
    k = len(ends)
    best, came = [0.0] * k, [0] * k
    near: list[tuple[float, int, int]] = []
    far: list[tuple[float, int, int]] = []
    turn, grown, long, spoken = [0] * k, [False] * k, [False] * k, [False] * k
    events: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        turn[i] += 1
        value = best[i] - (0.0 if grown[i] else 1.0) + (said[i][2] if spoken[i] else said[i][0])
        if long[i]:
            heapq.heappush(far, (-(value + DRAG * (starts[i] + LONG)), i, turn[i]))
        else:
            heapq.heappush(near, (-value, i, turn[i]))

    for j in range(1, k):
        i = j - 1
        for kind, place in enumerate((starts[i] + short, starts[i] + LONG, said[i][1])):
            heapq.heappush(events, (place, i, kind))
        offer(i)
        changed = set()
        while events and events[0][0] <= ends[j]:
            _, i, kind = heapq.heappop(events)
            (grown, long, spoken)[kind][i] = True
            changed.add(i)
        for i in changed:
            offer(i)
        for heap in (near, far):
            while heap and turn[heap[0][1]] != heap[0][2]:
                heapq.heappop(heap)
        options = [(round(-heap[0][0] - drag, 9), -heap[0][1]) for heap, drag in ((near, 0.0), (far, DRAG * ends[j])) if heap]
        value, minus = max(options)
        best[j], came[j] = value + gain[j], -minus
    return came


def split_block(block: str, model: Model) -> list[tuple[int, int]]:
    """Spans of the best parting of one block."""
    n = len(block)
    cuts = boundaries(block)
    if not cuts:
        return [(0, n)]
    thai = bool(THAI.search(block))
    ends, starts, gain = [0], [0], [0.0]
    for end, right, inside in cuts:
        spaced = block[end - 1] not in STOPS and not any(c in STOPS for c in block[max(0, end - 3) : end])
        score = (0.4 if spaced else 1.6) + model.of("close", closing_key(block, end, thai)) + model.of("open", opening_key(block, right, thai))
        if spaced and changes_script(block, end, right):
            score += 2.0
        if inside:
            score -= 8.0
        ends.append(end)
        starts.append(right)
        gain.append(score)
    ends.append(n)
    starts.append(n)
    gain.append(0.0)
    came = best_parting(starts, ends, gain, 4 if script_of(block[n // 2]) == "hani" else 10, speech(block, starts))
    spans, j = [], len(ends) - 1
    while j:
        i = came[j]
        spans.append((starts[i], ends[j]))
        j = i
    spans.reverse()
    return spans


def changes_script(block: str, end: int, right: int) -> bool:
    """A sentence of another script begins: a letter of it that is a capital or has no case."""
    c = block[right]
    return (c.isalpha() or script_of(c) in ("deva", "gujr")) and not c.islower() and script_of(c) != script_of(block[end - 1]) and (script_of(c) != "latn" or block[right + 1 : right + 2].islower())


SAID = re.compile(r"(?=([!?….,]\s+[—–]\s+[^\W\d_]))")


def speech(block: str, starts: list[int]) -> list[tuple[float, int, float]]:
    """Of a span that begins at each start: score before a dash is reached, its place, score from there on.

    Speech after a dash ends with its reporting words: both dashes belong to one span.
    """
    dashes = [(m.start(1), m.end(1)) for m in SAID.finditer(block)] if "—" in block or "–" in block else []
    at = [a for a, _ in dashes]
    out = []
    for start in starts:
        opened = block[start : start + 1] in ("—", "–")
        before = after = -3.0 if opened else 0.0
        k = bisect_left(at, start)
        if k == len(at):
            out.append((before, len(block) + 1, after))
            continue
        a, end = dashes[k]
        said = block[end - 1].islower()
        quoted = any(c in "»”\"" for c in block[max(start, a - 2) : a + 1])
        if said:
            after = 0.0 if opened else -4.0 if not quoted and block[a] in "!?…" else 0.0
        out.append((before, end, after))
    return out


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans between blank lines, without the white space around them."""
    at = 0
    for m in [*BLANK.finditer(text), None]:
        end = m.start() if m else len(text)
        s, e = at, end
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if e > s:
            yield s, e
        at = m.end() if m else end


def shaped(text: str) -> str:
    """One kind of line end; positions stay."""
    return text.replace("\r\n", " \n").replace("\r", "\n").replace(" ", "\n")


def split_text(text: str | None, model: Model) -> list[tuple[int, int]]:
    """Sentence spans of a text."""
    if not text:
        return []
    text = shaped(text)
    return [(s + a, s + b) for s, e in blocks(text) for a, b in split_block(text[s:e], model)]


def keys_within(text: str) -> Iterator[tuple[str, str, str, int]]:
    """(side, script, key, 1 at a block edge or 0 at a possible boundary within) of a text."""
    text = shaped(text)
    for s, e in blocks(text):
        block = text[s:e]
        thai = bool(THAI.search(block))
        yield "close", *closing_key(block, len(block), thai), 1
        yield "open", *opening_key(block, 0, thai), 1
        for end, right, inside in boundaries(block):
            if not inside:
                yield "close", *closing_key(block, end, thai), 0
                yield "open", *opening_key(block, right, thai), 0


def observed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of (side, script, key, edge), summed for each batch."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch["text"]:
            counts.update(keys_within(text))
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["side", "script", "key", "edge", "n"])


def fit(texts: DataFrame) -> DataFrame:
    """(side, script, key, yes, no) over a one-column table of texts, written once."""
    rows = texts.toDF("text").where("text is not null").mapInPandas(observed, "side string, script string, key string, edge int, n bigint")
    sums = rows.groupBy("side", "script", "key").agg(F.sum(F.expr("if(edge = 1, n, 0)")).alias("yes"), F.sum(F.expr("if(edge = 0, n, 0)")).alias("no"))
    return materialize(sums, "sentence-keys")


def spans_of(rows: DataFrame, counts: DataFrame, keys: list[str], carried: list[str] | None = None, model_rows: int = MODEL_ROWS) -> DataFrame:
    """(keys, carried, start_pos, end_pos) for each sentence of (keys, carried, text); keys name a row."""
    carried = carried or []
    per_side = counts.groupBy("side", "script").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.count("*").alias("n")).collect()  # a row for each side and script
    totals = [tuple(r)[:4] for r in per_side]
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in [*keys, *carried])
    schema = f"{kinds}, start_pos int, end_pos int"
    names = [*keys, *carried, "start_pos", "end_pos"]
    texts = rows.select(*keys, *carried, F.col("text").alias("whole_text"))
    if sum(r["n"] for r in per_side) <= model_rows:
        model = Model(totals, [tuple(r) for r in counts.select("side", "script", "key", "yes", "no").collect()])  # at most model_rows rows

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame([(*key, a, b) for *key, text in batch.itertuples(index=False) for a, b in split_text(text, model)], columns=names)

        return texts.mapInPandas(split, schema)

    def own_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(*key, *k) for *key, text in batch.itertuples(index=False) for k in boundary_keys(text)]
            yield pd.DataFrame(out, columns=[*keys, "side", "script", "key"])

    ids = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    asked = texts.where("whole_text is not null").select(*keys, "whole_text").mapInPandas(own_keys, f"{ids}, side string, script string, key string")
    known = asked.join(counts, ["side", "script", "key"]).groupBy(*keys).agg(F.collect_list(F.struct("side", "script", "key", "yes", "no")).alias("counts"))

    def split_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *key, text, own in batch.itertuples(index=False):
                model = Model(totals, [(c["side"], c["script"], c["key"], c["yes"], c["no"]) for c in (own if own is not None else [])])
                out += [(*key, a, b) for a, b in split_text(text, model)]
            yield pd.DataFrame(out, columns=names)

    return texts.join(known, keys, "left").select(*keys, *carried, "whole_text", "counts").mapInPandas(split_joined, schema)


def boundary_keys(text: str) -> set[tuple[str, str, str]]:
    """Keys that splitting a text asks for: those at all its possible boundaries."""
    out, text = set(), shaped(text)
    for s, e in blocks(text):
        block = text[s:e]
        thai = bool(THAI.search(block))
        for end, right, _ in boundaries(block):
            out |= {("close", *closing_key(block, end, thai)), ("open", *opening_key(block, right, thai))}
    return out


def corpus(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, text) of the rows of origin `text` in both tables, rows delivered twice once."""
    a = chunks.where("origin = 'text'").select(F.lit("chunk").alias("src"), F.col("chunk_id").alias("rec_id"), "text")
    b = sentences.where("origin = 'text'").select(F.lit("sentence").alias("src"), F.col("sentence_id").alias("rec_id"), "text").distinct()
    return a.unionByName(b).where("text is not null")


def found(chunks: DataFrame, sentences: DataFrame) -> DataFrame:
    """(src, rec_id, start_pos, end_pos) of every sentence."""
    rows = corpus(chunks, sentences)
    return spans_of(rows, fit(rows.select("text")), ["src", "rec_id"])
