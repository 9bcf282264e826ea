"""Corpus encoding with a public byte-level BPE vocabulary, by a tokenization automaton.

The merges are compiled, one gadget after another, into a deterministic
automaton over tokens that accepts exactly the token strings the merges
produce. Encoding a pre-split word is then a walk: from each reached byte
position, follow the arcs whose labels spell the next bytes; one path only
survives, and its arc labels are the ids.

Results: null and empty texts give an empty list; nothing is trimmed or
normalised; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCAB = "/opt/tokenizers/byte_bpe_50k.json"

# Fixed value: the pre-splitting pattern of the public vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE_WORDS = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + k)] = b
    return letters


class Automaton:
    """Deterministic token automaton in compressed form.

    All arcs with one label lead to one state, so `after[token]` is the whole
    target table. A merge (u, v) splits u's target state: the new state keeps
    the arcs of its parent but v, and every state with an arc u gets an arc
    uv. A state thus stores its parent, the arc removed and its time; whether
    it has an arc follows from these by going back in time.
    """

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = max(ids.values()) + 1
        self.ids = ids
        self.after = [0] * size
        self.made = [-1] * size
        self.left = [-1] * size
        self.parent, self.removed, self.born = [-1], [-1], [0]
        self.spelled: list[bytes] = [b""] * size
        for token, k in ids.items():
            self.spelled[k] = token
            if len(token) == 1:
                self.made[k] = 0
        for time, (a, b) in enumerate(merges, 1):
            u, v, uv = ids[a], ids[b], ids[a + b]
            source = self.after[u]
            if self.made[u] < 0 or self.made[v] < 0 or not self.has_arc(source, v):
                continue  # never applies: the label stays without arcs
            self.made[uv], self.left[uv], self.after[uv] = time, u, self.after[v]
            self.parent.append(source)
            self.removed.append(v)
            self.born.append(time)
            self.after[u] = len(self.parent) - 1
        self.trie: dict = {}
        for token, k in ids.items():
            if self.made[k] < 0:
                continue
            node = self.trie
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = k
        self.words: dict[bytes, list[int]] = {}

    def has_arc(self, state: int, token: int) -> bool:
        born, made, left, parent, removed = self.born, self.made, self.left, self.parent, self.removed
        while True:
            if born[state] > made[token]:
                if removed[state] == token:
                    return False
                state = parent[state]
            elif made[token] == 0:
                return True
            else:
                token = left[token]

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        last, came = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            if i and last[i] < 0:
                continue
            state = self.after[last[i]] if i else 0
            node = self.trie
            for j in range(i, n):
                node = node.get(word[j])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None and self.has_arc(state, token):
                    last[j + 1], came[j + 1] = token, i
        ids, i = [], n
        while i:
            ids.append(last[i])
            i = came[i]
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        words = self.words
        for word in SPLIT.findall(text):
            known = words.get(word)
            if known is None:
                if len(words) >= CACHE_WORDS:
                    words.clear()
                known = words[word] = self.encode_word(word.encode("utf-8", "replace"))
            ids += known
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.spelled[k] for k in ids).decode("utf-8", "replace")


SPLIT = regex.compile(PATTERN)


@lru_cache(maxsize=2)
def automaton(path: str = VOCAB) -> Automaton:
    """The automaton of a vocabulary file; built once in each Python worker."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()
    to_bytes = lambda s: bytes(letters[c] for c in s)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = {a + b for a, b in pairs}
    ids = {to_bytes(t): k for t, k in model["vocab"].items() if len(t) == 1 or t in merged}  # no special tokens
    return Automaton(ids, [(to_bytes(a), to_bytes(b)) for a, b in pairs])


def sent(docs: DataFrame, path: str) -> str:
    """The name under which the tasks find a vocabulary file of the driver; it is sent once a session."""
    sc = docs.sparkSession.sparkContext
    known = sc.__dict__.setdefault("_textloom_files", set())
    if path not in known:
        sc.addFile(path)
        known.add(path)
    return os.path.basename(path)


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCAB) -> DataFrame:
    """(id_col, ids array<int>) for every row; a narrow pass without a shuffle."""
    name = sent(docs, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(SparkFiles.get(name))
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for text in batch.column(1).to_pylist():
                if text:
                    flat.extend(machine.encode(text))
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def count_tokens(docs: DataFrame, id_col: str, text_col: str, path: str = VOCAB) -> DataFrame:
    """(id_col, n_tokens bigint) for every row."""
    coded = encode_corpus(docs, id_col, text_col, path)
    return coded.select(id_col, F.size("ids").cast("bigint").alias("n_tokens"))


def decode_corpus(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = VOCAB) -> DataFrame:
    """(id_col, text): the texts that the ids spell. A null list gives a null text."""

    name = sent(coded, path)

    @F.pandas_udf("string")
    def decode(ids):
        machine = automaton(SparkFiles.get(name))
        return ids.map(lambda x: None if x is None else machine.decode(list(x)))

    return coded.select(id_col, decode(ids_col).alias("text"))
