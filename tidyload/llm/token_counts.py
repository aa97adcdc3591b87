"""Edit-aware token counts (operator 9).

A document is cut into pre-tokens by the tokenizer's pattern, and each pre-token's
number of tokens is a leaf of a segment tree; inner nodes hold the sums of
characters and tokens below them. An edit (characters from ``start`` to ``end``
become ``replacement``) is found by the sums of characters; only the pre-tokens it
touches are cut and encoded again, from a pre-token edge far enough before it
(``LOOK`` characters, the furthest the pattern looks ahead) until the new cut meets
an old edge after it, and the sums on the path to the root are updated.

Edits of a document come in one array, in any order, in terms of the text before
all of them; they must not overlap. The vocabulary is read once on the driver
(``vocabulary``, a path) and broadcast: its size is fixed. One narrow pass over
whole texts; nothing is shuffled. The cache of encoded pre-tokens is bounded.

Defined cases: a null text has no tokens; null or empty edits change nothing; an
edit out of range is cut to the text, one with a null bound is ignored, a null
replacement is empty; of edits that overlap the later one by (start, end) is ignored.
"""

from __future__ import annotations

import base64
import re
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidyload.llm import common as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern that belongs to the vocabulary; its value is fixed.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOK = 3
LEAVES = 64
CACHE = 300_000
EDITS = "array<struct<start:bigint,end:bigint,replacement:string>>"

# Personal data as it is met in texts: mail addresses, IPv4 addresses, telephone numbers.
PERSONAL = {
    "[mail]": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "[address]": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",
    "[phone]": r"\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3}-[0-9]{4}",
}


class Tokenizer:
    """Pre-tokens of a text and their numbers of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex
        import tiktoken

        self.cut = regex.compile(PATTERN).findall
        self.encode = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        out = list(map(known.get, pieces))
        for i, n in enumerate(out):
            if n is None:
                if len(known) >= CACHE:
                    known.clear()
                out[i] = known[pieces[i]] = len(self.encode(pieces[i]))
        return out


class Tree:
    """Segment tree over chunks of pre-tokens."""

    def __init__(self, text: str, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        pieces = tokenizer.cut(text)
        counts = tokenizer.counts(pieces)
        self.pieces = [pieces[i: i + LEAVES] for i in range(0, len(pieces), LEAVES)] or [[]]
        self.counts = [counts[i: i + LEAVES] for i in range(0, len(counts), LEAVES)] or [[]]
        self.encoded = 0
        self.width = 1 << (len(self.pieces) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i in range(len(self.pieces)):
            self._leaf(i)
        for i in range(self.width - 1, 0, -1):
            self._node(i)

    def _leaf(self, i: int) -> None:
        self.chars[self.width + i] = sum(map(len, self.pieces[i]))
        self.tokens[self.width + i] = sum(self.counts[i])

    def _node(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return self.tokens[1]

    def size(self) -> int:
        """Characters of the text."""
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for chunk in self.pieces for p in chunk)

    def _find(self, at: int) -> tuple[int, int]:
        """The chunk that holds a character, and the characters before the chunk."""
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if at >= before + self.chars[i] and self.chars[i + 1]:
                before += self.chars[i]
                i += 1
        return i - self.width, before

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters start to end, and encode again what that touches."""
        chunk, at = self._find(max(0, start - LOOK))
        edges = list(accumulate(map(len, self.pieces[chunk]), initial=at))
        keep = max([k for k, e in enumerate(edges) if e + LOOK <= start], default=0)
        at = edges[keep]
        while at + LOOK > start and at > 0:  # the chunk holds no edge far enough before
            chunk, before = self._find(at - 1)
            edges = list(accumulate(map(len, self.pieces[chunk]), initial=before))
            keep = max([k for k, e in enumerate(edges[:-1]) if e + LOOK <= start], default=0)
            at = edges[keep]
        # old pre-tokens from the edge on, read chunk by chunk as far as needed
        old, old_counts, last = self.pieces[chunk][keep:], self.counts[chunk][keep:], chunk
        while True:
            have = sum(map(len, old))
            while last + 1 < len(self.pieces) and have < end - at + 64:
                last += 1
                old, old_counts = old + self.pieces[last], old_counts + self.counts[last]
                have = sum(map(len, old))
            joined = "".join(old)
            fresh = joined[: start - at] + replacement + joined[end - at:]
            shift, whole = len(fresh) - have, last + 1 == len(self.pieces)
            olds = {e: k for k, e in enumerate(accumulate(map(len, old), initial=0))}
            new, place, met = [], 0, None
            for piece in self.tokenizer.cut(fresh):
                if place >= start - at + len(replacement) and place - shift in olds and place - shift >= end - at:
                    met = olds[place - shift]
                    break
                place += len(piece)
                if not whole and place + LOOK > len(fresh):
                    break  # the cut here may depend on what follows
                new.append(piece)
            else:
                met = len(old) if whole else None
            if met is not None:
                break
            last += 1
            old, old_counts = old + self.pieces[last], old_counts + self.counts[last]
        self.encoded += len(new)
        self.pieces[chunk] = self.pieces[chunk][:keep] + new + old[met:]
        self.counts[chunk] = self.counts[chunk][:keep] + self.tokenizer.counts(new) + old_counts[met:]
        for i in range(chunk + 1, last + 1):
            self.pieces[i], self.counts[i] = [], []
        touched = set(range(chunk, last + 1))
        for i in touched:
            self._leaf(i)
        nodes = {(self.width + i) // 2 for i in touched}
        while nodes - {0}:
            for i in nodes - {0}:
                self._node(i)
            nodes = {i // 2 for i in nodes}


def ordered(edits, size: int) -> list[tuple[int, int, str]]:
    """Sound edits by falling start, so that one does not move the next."""
    out, reach = [], 0
    for start, end, text in sorted((min(max(e["start"], 0), size), min(max(e["end"], 0), size), e["replacement"] or "")
                                   for e in edits or [] if e and e["start"] is not None and e["end"] is not None):
        if start >= reach and end >= start:
            out.append((start, end, text))
            reach = max(end, start + (start == end))
    return out[::-1]


@cache
def _tokenizer(vocabulary: bytes) -> Tokenizer:
    return Tokenizer({base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())})


RESULT = [StructField(n, LongType()) for n in ("n_tokens_before", "n_tokens", "n_pretokens", "n_edits", "n_reencoded")]


def count_tokens(docs: DataFrame, text_col: str = "text", edits_col: str | None = None, vocabulary: str = VOCABULARY,
                 keep: list[str] | None = None) -> DataFrame:
    """``doc`` (a struct of the columns in ``keep``, all by default), ``n_tokens_before``,
    ``n_tokens`` (after the edits), ``n_pretokens``, ``n_edits`` (applied) and
    ``n_reencoded`` (pre-tokens encoded again) of every row. ``edits_col`` holds an
    array of ``EDITS``, positions in characters."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    C.ship(spark)
    edits = F.col(edits_col) if edits_col else F.lit(None)
    own = docs.select(C.whole(docs, keep), C.as_bytes(text_col).alias("bytes"), edits.cast(EDITS).alias("edits"))
    out = StructType([own.schema["doc"], *RESULT])
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    arrow = to_arrow_schema(out)

    def run(batches):
        tokenizer = _tokenizer(sent.value)
        for batch in batches:
            rows = []
            for raw, wanted in zip(batch.column("bytes"), batch.column("edits").to_pylist()):
                tree = Tree(raw.as_py().decode("utf-8", "replace"), tokenizer)
                before = tree.total()
                some = ordered(wanted, tree.size()) if wanted else []
                for start, end, replacement in some:
                    tree.edit(start, end, replacement)
                rows.append((before, tree.total(), sum(map(len, tree.pieces)), len(some), tree.encoded))
            columns = np.array(rows, np.int64).reshape(-1, len(RESULT)).T
            yield C.appended(batch, arrow, **{f.name: c for f, c in zip(RESULT, columns)})

    return own.mapInArrow(run, out)


def personal_data_edits(text_col: str = "text"):
    """Edits that mask personal data, as a column of ``EDITS`` (positions in characters)."""
    patterns = [(mask, re.compile(p)) for mask, p in PERSONAL.items()]

    @F.pandas_udf(EDITS)
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": m.start(), "end": m.end(), "replacement": mask} for mask, p in patterns
                                    for m in p.finditer(t or "")])

    return find(F.coalesce(F.col(text_col), F.lit("")))
