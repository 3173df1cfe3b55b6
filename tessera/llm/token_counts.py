"""Operator 1: word-piece token counts by a linear longest-match automaton.

Greedy word-piece splitting takes, at each place of a word, the longest
vocabulary entry, then goes on behind it. The automaton does it in one pass:
the trie of the vocabulary gets, for each node, a failure link (where the
walk goes on when no edge fits: the longest suffix that is still open once
the greedy pieces are cut off) and the number of pieces so cut off ("popped").
Counting needs only that number, no piece is ever built. Each byte is
consumed once and each failure step pops at least one piece, so a word costs
time linear in its length.
"""

from __future__ import annotations

import json
from collections import Counter, deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary_column, text_bytes

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
MAX_VOCABULARY_BYTES = 64 << 20   # of the broadcast vocabulary; checked
MAX_MEMO = 400_000                # distinct words a task remembers at a time (speed only)
MAX_MEMO_WORD = 256               # longer words are walked each time (speed only)


def byte_symbols() -> dict[str, int]:
    """Printable symbol of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str = DEFAULT_VOCABULARY) -> tuple[list[bytes], list[bytes]]:
    """(word-initial pieces, continuation pieces) of a byte-level vocabulary.

    Entries that begin with the space symbol begin a word, the others go on
    in one; entries with a space inside can match in no word and special
    tokens are left out. The lone space symbol is the initial piece of no
    byte: it opens words whose first byte no longer initial piece covers.
    """
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    special = {t["content"] for t in doc.get("added_tokens", []) if t.get("special")}
    symbols = byte_symbols()
    initial, inner = [], []
    for piece in doc["model"]["vocab"]:
        if piece in special:
            continue
        raw = bytes(symbols[c] for c in piece)
        if raw[:1] == b" " and b" " not in raw[1:]:
            initial.append(raw[1:])
        elif b" " not in raw:
            inner.append(raw)
    return initial, inner


class Automaton:
    """Longest-match trie with failure links and popped-piece counts."""

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        initial, inner = set(initial), set(inner) - {b""}
        # node 0: start of a word; node 1: behind a piece, in a word
        self.edges: list[dict[int, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    nxt = self.edges[node].get(byte)
                    if nxt is None:
                        nxt = len(self.edges)
                        self.edges[node][byte] = nxt
                        self.edges.append({})
                        final.append(False)
                    node = nxt
                if node != root:
                    final[node] = True
        self.fail = [-1] * len(self.edges)   # -1: the word cannot be split
        self.popped = [0] * len(self.edges)
        if b"" in initial:                   # an empty first piece: pop it
            self.fail[0], self.popped[0] = 1, 1
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, child in self.edges[node].items():
                queue.append(child)
                if final[child]:             # the whole path is one piece
                    self.fail[child], self.popped[child] = 1, 1
                    continue
                at, pops = self.fail[node], self.popped[node]
                while at >= 0 and byte not in self.edges[at]:
                    pops += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.popped[child] = self.edges[at][byte], pops
        # an empty first piece alone is the whole split of no word
        self.empty_start = b"" in initial

    def count(self, word: bytes) -> int:
        """Pieces of the greedy split; -1 if the word has none."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = n = 0
        for byte in word:
            nxt = edges[node].get(byte)
            while nxt is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
                nxt = edges[node].get(byte)
            node = nxt
        while node != 1:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return n


def token_counts(df: DataFrame, initial: list[bytes], inner: list[bytes], text: str = "text",
                 out: tuple[str, str, str] = ("n_words", "n_tokens", "n_unknown")) -> DataFrame:
    """Adds word, word-piece and unknown-word counts of the whole ``text``.

    Words are separated by ASCII white space and matched byte for byte. A
    word that no sequence of pieces covers counts as one unknown token. Null
    and empty texts have 0 words and 0 tokens. Rows, also repeated ones, are
    handled one by one, all columns pass through; columns already named like
    an output column are replaced. Narrow: no shuffle; a task holds one batch
    and a bounded memo of word counts.
    """
    if sum(map(len, initial)) + sum(map(len, inner)) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to broadcast")
    shared = df.sparkSession.sparkContext.broadcast((initial, inner))
    kept = [c for c in df.columns if c not in out]
    raw = "_utf8"
    while raw in kept:
        raw += "_"
    work = df.select(*kept, text_bytes(text).alias(raw))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema if f.name != raw)
    schema += "".join(f", `{c}` bigint" for c in out)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(*shared.value)
        memo: dict[bytes, int] = {}
        for table in batches(it, 8 << 20, raw):
            buf, off = binary_column(table[raw])
            data = buf.tobytes()
            made = np.zeros((3, len(off) - 1), np.int64)
            for i in range(len(off) - 1):
                words = data[off[i]:off[i + 1]].split()
                n = unknown = 0
                for word, times in Counter(words).items():
                    c = memo.get(word)
                    if c is None:
                        c = automaton.count(word)
                        if len(word) <= MAX_MEMO_WORD:
                            if len(memo) >= MAX_MEMO:
                                memo.clear()
                            memo[word] = c
                    if c < 0:
                        unknown += times
                        c = 1
                    n += c * times
                made[:, i] = len(words), n, unknown
            table = table.drop_columns([raw])
            for name, values in zip(out, made):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches()

    return work.mapInArrow(run, schema)


def q_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, *read_vocabulary()).select("doc_id", "n_words", "n_tokens", "n_unknown")
