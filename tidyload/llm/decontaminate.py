"""Benchmark decontamination (operator 4): training token windows against a
broadcast set of hashed benchmark n-grams.

Words: A-Z lower-cased, then maximal runs of digits, a-z and any byte from 0x80
up. A window is ``n`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. Every word of a document inside an occurrence
of a window is hit; hash hits are verified on the words themselves.

The benchmark is collected and broadcast only while its texts and the index built
from them hold at most ``broadcast_bytes`` (``index_bytes``, from counts of words
and bytes); beyond that its windows stay a distributed table and
documents meet it in a join on a 128-bit fingerprint of the window. Documents are
scanned once, whole, in slices of bounded bytes; the broadcast form shuffles nothing.

Defined cases: a null text has no words; a null item id is reported as an empty
string; items that share an id count once; repeated documents are judged each on
their own; an empty benchmark hits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidyload.llm import common as C

INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[97:123] = INSIDE[128:] = True
BROADCAST_BYTES = 32 << 20
SLICE_BYTES = 1 << 18
"""Text bytes of a slice: a worker keeps tables of hashes, and much of the room it took, for its largest."""
ENTRY_BYTES = 500
"""Of a window in ``Index``, besides its words: dicts, list, numbers, the item's name (468 to 484 as measured)."""
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


@dataclass
class Words:
    """The words of a slice of texts: places, hashes, and the row of each."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    offsets: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        raw, offsets = C.joined(texts, b"\n")
        data = C.lowered(raw)
        start, end = C.word_spans(data, INSIDE)
        hashes = C.ROLLING.spans(C.ROLLING.prefix(data), start, end)
        row = np.searchsorted(offsets, start, side="right") - 1
        return cls(data, start, end, row, offsets, (C.ROLLING.prefix(hashes), C.ROLLING_2.prefix(hashes)))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and two hashes of every window of n words within a text."""
        if len(self.start) < n:
            return (np.zeros(0, np.int64), *(np.zeros(0, np.uint64),) * 2)
        first = np.flatnonzero(self.row[: len(self.row) - n + 1] == self.row[n - 1:])
        one, two = C.ROLLING.windows(self.sums[0], n), C.ROLLING_2.windows(self.sums[1], n)
        return first, one[first], two[first]

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[first: first + n], self.end[first: first + n]))


def item_windows(texts: list[bytes], n: int) -> list[tuple[int, int, int, int, bytes]]:
    """Row, length, two hashes and words of every window of the items."""
    words = Words.of(texts)
    count = np.bincount(words.row, minlength=len(texts))
    out = []
    for length in sorted({min(n, int(c)) for c in count if c}):
        for first, one, two in zip(*words.windows(length)):
            row = int(words.row[first])
            if min(n, count[row]) == length:
                out.append((row, length, int(one), int(two), words.text(int(first), length)))
    return out


@dataclass
class Index:
    """Benchmark windows by length: sorted hashes, and per hash the words and item ids."""

    hashes: dict[int, np.ndarray]
    items: dict[int, dict[int, dict[bytes, list[str]]]]

    @classmethod
    def of(cls, ids: list, texts: list[bytes], n: int) -> Index:
        items: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for row, length, one, _, words in item_windows(texts, n):
            name = "" if ids[row] is None else str(ids[row])
            items.setdefault(length, {}).setdefault(one, {}).setdefault(words, []).append(name)
        return cls({k: np.array(sorted(v), np.uint64) for k, v in items.items()}, items)

    def hits(self, words: Words):
        """Verified hits: first word, length, item ids."""
        for length, hashes in self.hashes.items():
            first, one, _ = words.windows(length)
            place = np.minimum(np.searchsorted(hashes, one), len(hashes) - 1)
            for i in np.flatnonzero(hashes[place] == one):
                names = self.items[length][int(one[i])].get(words.text(int(first[i]), length))
                if names:
                    yield int(first[i]), length, names


def _report(words: Words, n_rows: int, hits) -> dict[str, list]:
    """Per row: counts of words and hit words, item ids and hit byte spans."""
    depth = np.zeros(len(words.start) + 1, np.int32)
    items: list[set[str]] = [set() for _ in range(n_rows)]
    for first, length, names in hits:
        depth[first] += 1
        depth[first + length] -= 1
        items[words.row[first]].update(names)
    hit = np.cumsum(depth[:-1]) > 0
    joined = hit[1:] & hit[:-1] & (words.row[1:] == words.row[:-1]) if len(hit) else hit
    begin = np.flatnonzero(hit & ~np.concatenate([[False], joined])) if len(hit) else hit
    finish = np.flatnonzero(hit & ~np.concatenate([joined, [False]])) if len(hit) else hit
    spans: list[list] = [[] for _ in range(n_rows)]
    for i, j in zip(begin, finish):
        at = words.offsets[words.row[i]]
        spans[words.row[i]].append({"start": int(words.start[i] - at), "end": int(words.end[j] - at)})
    return {"n_words": np.bincount(words.row, minlength=n_rows), "n_hit": np.bincount(words.row[hit], minlength=n_rows),
            "items": [sorted(x) for x in items], "hit_spans": spans}


def index_bytes(text: Column, n: int) -> Column:
    """About the memory that an item's text (as bytes) and its windows in ``Index`` take."""
    size, words = F.octet_length(text), F.regexp_count(F.decode(text, "ISO-8859-1"), F.lit(r"[0-9A-Za-z\x80-\xFF]+"))
    windows = F.when(words >= n, words - n + 1).when(words > 0, 1).otherwise(0)
    each = F.least(size, F.ceil(size * F.lit(float(n)) / F.greatest(words, F.lit(1))))
    return size + 40 + windows.cast("long") * (each + ENTRY_BYTES)


RESULT = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())),
          StructField("hit_spans", ArrayType(SPAN))]


def _scan(index, arrow):
    """Report on the documents of each batch by the broadcast index."""
    def scan(batches):
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SLICE_BYTES):
                words = Words.of(texts[part])
                found = _report(words, part.stop - part.start, index.value.hits(words))
                yield C.appended(batch.slice(part.start, part.stop - part.start), arrow, **found)
            words = found = None
            del batch, texts
            C.release()

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", n: int = 10, keep: list[str] | None = None,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc`` (a struct of the columns in ``keep``, all by default), ``n_words``,
    ``n_hit``, ``items`` (sorted item ids as strings) and ``hit_spans`` (start and
    end in bytes of the text) of every document."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    C.ship(spark)
    own = docs.select(C.whole(docs, keep), C.as_bytes(text_col).alias("bytes"))
    out = StructType([own.schema["doc"], *RESULT])
    items = benchmark.select(F.col(item_col).alias("id"), C.as_bytes(item_text).alias("words"))
    if (items.agg(F.sum(index_bytes(F.col("words"), n))).first()[0] or 0) > broadcast_bytes:
        return _joined_leaks(own, items, n, out)
    rows = items.collect()  # at most broadcast_bytes
    index = spark.sparkContext.broadcast(Index.of([r.id for r in rows], [bytes(r.words) for r in rows], n))
    return own.mapInArrow(_scan(index, to_arrow_schema(out)), out)


def _joined_leaks(own: DataFrame, items: DataFrame, n: int, out: StructType) -> DataFrame:
    """The same for a benchmark too large to broadcast: documents and items meet
    in a join on the fingerprints of their windows. Documents are keyed by their
    text, so copies are looked up once."""
    from pyspark.sql.pandas.types import to_arrow_schema

    def cut(lengths):
        def run(batches):
            import pandas as pd

            for batch in batches:
                texts = [bytes(t) for t in batch["words"]]
                for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SLICE_BYTES):
                    some, keys = texts[part], batch["id"].iloc[part].to_numpy()
                    if lengths is None:
                        found = [(keys[r], length, np.int64(np.uint64(a)), np.int64(np.uint64(b)), 0)
                                 for r, length, a, b, _ in item_windows(some, n)]
                        yield pd.DataFrame(found, columns=["id", "length", "one", "two", "first"])
                        continue
                    words = Words.of(some)
                    begins = np.searchsorted(words.row, np.arange(len(some)))
                    for length in lengths:
                        first, one, two = words.windows(length)
                        row = words.row[first]
                        yield pd.DataFrame({"id": keys[row], "length": length, "one": one.view(np.int64),
                                            "two": two.view(np.int64), "first": first - begins[row]})
            C.release()
        return run

    table = "id string, length int, one long, two long, first long"
    wanted = C.written(items.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "words")
                       .mapInPandas(cut(None), table).select(F.col("id").alias("item"), "length", "one", "two").distinct())
    lengths = [r[0] for r in wanted.select("length").distinct().collect()]  # at most n
    key = F.sha2("bytes", 256)
    texts = own.select(key.alias("id"), F.col("bytes").alias("words")).dropDuplicates(["id"])
    hits = texts.mapInPandas(cut(lengths), table).join(wanted, ["length", "one", "two"]).groupBy("id").agg(
        F.collect_set(F.struct("first", "length", "item")).alias("hits"))
    both = own.withColumn("id", key).join(hits, "id", "left")
    arrow = to_arrow_schema(out)

    def report(batches):
        for batch in batches:
            texts, hits = batch.column("bytes").to_pylist(), batch.column("hits").to_pylist()
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SLICE_BYTES):
                words = Words.of(texts[part])
                begins = np.searchsorted(words.row, np.arange(part.stop - part.start))
                found = ((int(begins[i]) + h["first"], h["length"], [h["item"]])
                         for i, some in enumerate(hits[part]) for h in some or [])
                yield C.appended(batch.slice(part.start, part.stop - part.start), arrow,
                                 **_report(words, part.stop - part.start, found))
            C.release()

    return both.mapInArrow(report, out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """The documents without benchmark passages, with their own columns:
    ``remove="documents"`` drops documents with a hit word, ``remove="spans"``
    cuts the hit spans out of the texts."""
    found = find_leaks(docs, benchmark, text_col=text_col, **options)
    if remove == "documents":
        return found.where("n_hit = 0").select("doc.*")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    text = F.col(f"doc.`{text_col}`")
    raw = text.cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("hit_spans.end"))
    ends = F.concat(F.col("hit_spans.start"), F.array(F.octet_length(raw).cast("long")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")))
    cut = F.when(F.size("hit_spans") == 0, text).otherwise(
        F.aggregate(pieces, F.lit(b""), lambda a, b: F.concat(a, b)).cast("string"))
    return found.select(*[cut.alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns])
