"""Encoding of a corpus with a public byte-level BPE vocabulary.

The words of the corpus are counted in SQL; the most frequent are compiled, with their ids as outputs, into a minimal
acyclic automaton whose suffixes are shared. It is written once to the shared folder and memory-mapped by the workers.
A word that it lacks is merged pair by pair, exactly as the vocabulary's ranks say. The lexicon decides the speed alone,
never a result.
"""

from __future__ import annotations

import base64
import heapq
import io
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from testimonia.sources.shared import shared_dir
from testimonia.sources.tables import table

#: Words compiled into the automaton, the most frequent ones; what it lacks is merged, so the bound changes no result.
LEXICON = 20_000
# The vocabulary's own split of a text into words, and the same for texts of ASCII signs only.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: of adjacent parts the pair of lowest rank, leftmost first, is merged until none is left."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, nxt, prv = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != e:
            continue
        end[i], alive[j], nxt[i] = e, False, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return out


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton over the words, with each word's number in sorted order and from it its ids.

    Arrays: ``first`` edge of each state, edge ``label`` and ``target``, ``skip`` (words passed over by taking an edge),
    ``final``; ``at`` and ``ids`` give the ids of the word of each number.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def freeze(node: list) -> int:
        sign = (node[0], tuple(node[1]))
        if sign not in register:
            register[sign] = len(states)
            states.append(sign)
        return register[sign]

    path: list[list] = [[False, []]]
    prev = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((prev[len(path) - 1], freeze(node)))

    for w in words:
        common = 0
        while common < min(len(w), len(prev)) and w[common] == prev[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(w) - common))
        path[-1][0] = True
        prev = w
    close(0)
    root = freeze(path[0])
    below = [0] * len(states)
    for s, (final, edges) in enumerate(states):  # targets are numbered before their sources
        below[s] = int(final) + sum(below[t] for _, t in edges)
    first, label, target, skip = [0], [], [], []
    for final, edges in states:
        passed = int(final)
        for c, t in edges:
            label.append(c)
            target.append(t)
            skip.append(passed)
            passed += below[t]
        first.append(len(label))
    at = np.cumsum([0, *(len(entries[w]) for w in words)])
    arrays = {"first": np.array(first, np.int32), "label": np.array(label, np.uint8), "target": np.array(target, np.int32), "skip": np.array(skip, np.int32), "final": np.array([f for f, _ in states], np.uint8), "at": at.astype(np.int32), "ids": np.array([i for w in words for i in entries[w]], np.int32)}
    out = io.BytesIO()
    out.write(np.array([root, *(len(a) for a in arrays.values())], np.int64).tobytes())
    for a in arrays.values():
        out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    return out.getvalue()


class Lexicon:
    """The compiled automaton over a buffer, which may be a memory-mapped file."""

    def __init__(self, raw: np.ndarray) -> None:
        head = raw[:64].view(np.int64)
        self.root, at = int(head[0]), 64
        for name, kind, n in zip(("first", "label", "target", "skip", "final", "at", "ids"), (np.int32, np.uint8, np.int32, np.int32, np.uint8, np.int32, np.int32), head[1:].tolist()):
            size = n * np.dtype(kind).itemsize
            setattr(self, name, raw[at : at + size].view(kind))
            at += size + -size % 8

    def get(self, word: bytes) -> list[int] | None:
        s, number = self.root, 0
        first, label = self.first, self.label
        for c in word:
            a, b = int(first[s]), int(first[s + 1])
            i = a + int(np.searchsorted(label[a:b], c))
            if i >= b or label[i] != c:
                return None
            number += int(self.skip[i])
            s = int(self.target[i])
        return self.ids[self.at[number] : self.at[number + 1]].tolist() if self.final[s] else None


class WordIds(dict):
    """Ids by word, filled from the lexicon and, for words that it lacks, by merging."""

    def __init__(self, lexicon: Lexicon, ranks: dict[bytes, int], most: int = 300_000) -> None:
        self.lexicon, self.ranks, self.most = lexicon, ranks, most

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= self.most:
            self.clear()
        raw = word.encode()
        ids = self.lexicon.get(raw)
        ids = merge_word(raw, self.ranks) if ids is None else ids
        if len(raw) <= 64:
            self[word] = ids
        return ids


def frequent_words(texts: DataFrame, most: int = LEXICON) -> list[str]:
    """The ``most`` most frequent words of all texts, ties by the word. A bounded list."""
    words = texts.select(F.explode(F.expr(f"regexp_extract_all(text, r\"{PATTERN}\", 0)")).alias("w"))
    counts = words.groupBy("w").agg(F.count("*").alias("n")).where(F.length("w") <= 32)
    return [r[0] for r in counts.orderBy(F.desc("n"), "w").limit(most).select("w").collect()]


def encode_texts(docs: DataFrame, key: str = "doc_id", vocabulary: str | None = None, lexicon: int = LEXICON, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, ids) and the columns ``keep``: the ids of each row's ``text``, without special tokens.

    A null and an empty text both give an empty list; a special token's string is ordinary text. Each row gives a row,
    repeated ones too; other columns are not read. ``vocabulary``: path of a ranks file, read by the driver only.
    """
    spark = docs.sparkSession
    docs = docs.select(key, "text", *keep)
    with open(vocabulary or default_vocabulary(), "rb") as f:
        content = f.read()
    ranks = read_ranks(content)
    raw = compile_lexicon({(b := w.encode()): merge_word(b, ranks) for w in frequent_words(docs, lexicon)})
    folder = shared_dir(spark)
    local = re.sub(r"^file:/*", "/", folder)
    path = None
    if local.startswith("/"):
        import os

        os.makedirs(local, exist_ok=True)
        path = f"{local}/lexicon-{uuid.uuid4().hex}.bin"
        with open(path, "wb") as f:
            f.write(raw)
    # without a shared folder that can be mapped, the automaton is sent; it is bounded by the lexicon's size
    sent, vocab = (None if path else spark.sparkContext.broadcast(raw)), spark.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        mapped = np.memmap(path, np.uint8, "r") if path else np.frombuffer(sent.value, np.uint8)
        known = WordIds(Lexicon(mapped), read_ranks(vocab.value))
        # \s of the vocabulary's own split has no separators of information (U+001C to U+001F)
        full = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\p{L}\p{N}]|[\x1c-\x1f])").replace(r"\s+(?!\S)|\s+", r"[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+"))
        plain = re.compile(ASCII_PATTERN, re.ASCII)
        get = known.__getitem__
        for b in batches:
            ends, flat = [0], []
            for t in b.column(1).to_pylist():
                if t:
                    flat.extend(chain.from_iterable(map(get, (plain if t.isascii() else full).findall(t))))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids, *b.columns[2:]], [key, "ids", *keep])

    kind = lambda c: f"{c} {docs.schema[c].dataType.simpleString()}"
    return docs.mapInArrow(encode, ", ".join([kind(key), "ids array<int>", *map(kind, keep)]))


def p8_ids(spark: SparkSession, directory: str) -> DataFrame:
    return encode_texts(table(spark, directory, "documents"))
