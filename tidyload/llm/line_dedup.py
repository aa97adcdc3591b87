"""Reversible line dedup over cuckoo filters and reference counts (operator 11).

A text is split at ``\\n`` (a null or empty text is one empty line). A line's key is the
line without the bytes 0x20 and 0x09-0x0D at both ends, A-Z lower-cased. A key of at
least ``shortest`` code points that at least ``least`` documents hold is repeated: all
its lines go, except in the document of the largest id that holds it.

Method. The index of a corpus has three tables: ``postings`` (a row for each key and
document), ``refs`` (for each key the exact number of documents and the largest id) and
``filters`` (for each shard of the keys a cuckoo filter of those that are repeated).
Keys are 128-bit digests of the lines. ``insert`` adds documents and ``delete`` takes
documents away by id; both change the exact counts first, and a key that thereby becomes
repeated, or no longer is, is inserted into its shard's filter or deleted from it, so
deleting what was inserted leads back to the same counts and the same kept lines. An
index is never changed in place: both return a new one over new tables, and the old one
stays valid. ``dedup_lines`` asks the filters first: a text none of whose lines may be
repeated passes as it is; for the others the lines in question are looked up in
``refs``, so that a filter's false answer has no effect.

Distribution. Keys are counted by partial aggregates; the lines in question meet
the repeated keys over ``SALTS`` slices of a key, so one that a third of all documents
holds is spread. The filters are broadcast while they have at most ``MAX_FILTER_BYTES``
(their size is known from the counts before any is fetched; 5 bytes a repeated key at
most); beyond it every line is looked up, which gives the same result. A shard's filter
has a place for ``SHARD_KEYS`` keys and is half full at most when made; what finds no
place in an insertion is listed beside it (``spill``), and when the counts say that the
filters are three quarters full, they are made anew with more shards.

Defined cases: rows of one id are one document, which holds the lines of all of them; a
row with a null id is in no document: its lines neither count nor go; repeated lines
within a document go or stay together; if every line goes, an empty text is left; lines
and texts of any length are taken whole; ids that the index has not are ignored by
``delete``, and lines that a document has in the index already by ``insert``; an empty
table gives an empty index and an empty result; other columns are carried along,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tidyload.llm import common as C

SHORTEST, LEAST = 20, 3
SALTS = 32
SLOTS = 4
SHARD_KEYS = 1 << 16
MAX_FILTER_BYTES = 64 << 20
KICKS = 500
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str, shortest: int = SHORTEST) -> bytes | None:
    """Digest of a line's key; none if the key is too short."""
    line = line.strip(BLANK)
    return blake2b(line.encode().lower(), digest_size=16).digest() if len(line) >= shortest else None  # bytes: A-Z only


class Cuckoo:
    """A cuckoo filter of 128-bit digests: 16-bit fingerprints, four to a bucket, each
    in one of two buckets. What finds no place is listed in ``spill``."""

    def __init__(self, table: np.ndarray, spill: Counter[int]):
        self.table, self.spill = table, spill
        self.mask = len(table) - 1

    @classmethod
    def empty(cls) -> Cuckoo:
        return cls(np.zeros((SHARD_KEYS // SLOTS, SLOTS), np.uint16), Counter())

    @classmethod
    def load(cls, raw: bytes, spill: list[int]) -> Cuckoo:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy(), Counter(spill))

    def places(self, keys: np.ndarray):
        """Fingerprint and both buckets of keys (rows of two 64-bit numbers)."""
        mark = (keys[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.int64)
        first = (keys[:, 1] >> np.uint64(20)).astype(np.int64) & self.mask
        return mark, first, self.other(first, mark)

    def other(self, bucket, mark):
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(keys)
        found = (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)
        if self.spill:
            found |= np.isin(np.minimum(a, b) << 16 | mark, np.fromiter(self.spill, np.int64, len(self.spill)))
        return found

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def insert(self, keys: np.ndarray) -> None:
        for mark, a, b in zip(*(x.tolist() for x in self.places(keys))):
            if self._put(a, mark) or self._put(b, mark):
                continue
            bucket = a
            for kick in range(KICKS):
                slot = (mark + kick) % SLOTS
                mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
                bucket = int(self.other(bucket, mark))
                if self._put(bucket, mark):
                    break
            else:
                self.spill[min(bucket, int(self.other(bucket, mark))) << 16 | mark] += 1

    def delete(self, keys: np.ndarray) -> None:
        """Only keys that were inserted may be deleted."""
        for mark, a, b in zip(*(x.tolist() for x in self.places(keys))):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break
            else:
                self.spill -= Counter([min(a, b) << 16 | mark])


def as_numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)


FILTERS = "shard long, marks binary, spill array<long>, n long"


def _updated(key, old, changes):
    """A shard's filter after its keys to delete and to insert."""
    import pyarrow as pa

    known = Cuckoo.load(old["marks"][0].as_py(), old["spill"][0].as_py()) if len(old) else Cuckoo.empty()
    n = old["n"][0].as_py() if len(old) else 0
    for enters, act in ((False, known.delete), (True, known.insert)):
        keys = sorted(k for k, e in zip(changes["key"].to_pylist(), changes["enters"].to_pylist()) if e == enters)
        if keys:
            act(as_numbers(keys))
            n += len(keys) if enters else -len(keys)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "marks": pa.array([known.table.tobytes()], pa.binary()),
                     "spill": pa.array([sorted(known.spill.elements())], pa.list_(pa.int64())), "n": pa.array([n], pa.int64())})


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    shortest: int
    least: int


def _shard(shards: int) -> Column:
    return (F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % shards).alias("shard")


def _postings(docs: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """(key, doc) of every line that is long enough, once for each row."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("doc"), batch.column("text")
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                keys = {line_key(x, shortest) for x in text.split("\n")} - {None} if text else ()
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sorted(keys), pa.binary()), pa.array([ids[i].as_py()] * len(keys), pa.int64())], names=["key", "doc"])

    C.ship(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return given.where("doc is not null").mapInArrow(run, "key binary, doc long")


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("top"))


def _filters(index: LineIndex | None, refs: DataFrame, before: DataFrame | None, least: int, shards: int) -> tuple[DataFrame, int]:
    """Filters of the repeated keys of ``refs``, and the number of shards: the old ones
    changed by the keys that entered or left, or made anew where there are none or they are full."""
    spark = refs.sparkSession
    many = refs.where(F.col("n_docs") >= least).select("key")
    n = many.count()
    if index is None or n > SHARD_KEYS * shards * 3 // 4:
        shards = 1 << max(0, (2 * n - 1) // SHARD_KEYS).bit_length()
        old, changes = spark.createDataFrame([], FILTERS), many.withColumn("enters", F.lit(True))
    else:
        were = before.where(F.col("n_docs") >= least).select("key")
        old = index.filters
        changes = many.join(were, "key", "left_anti").withColumn("enters", F.lit(True)).unionByName(
            were.join(many, "key", "left_anti").withColumn("enters", F.lit(False)))
    return C.written(old.groupBy("shard").cogroup(changes.select("key", "enters", _shard(shards)).groupBy("shard")).applyInArrow(
        _updated, FILTERS)), shards


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST) -> LineIndex:
    """The index of a corpus."""
    postings = C.written(_postings(docs, id_col, text_col, shortest).distinct())
    refs = C.written(_counts(postings))
    filters, shards = _filters(None, refs, None, least, 1)
    return LineIndex(postings, refs, filters, shards, shortest, least)


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """The index with further documents."""
    new = C.written(_postings(docs, id_col, text_col, index.shortest).distinct().join(index.postings, ["key", "doc"], "left_anti"))
    refs = C.written(index.refs.unionByName(_counts(new)).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top")))
    filters, shards = _filters(index, refs, index.refs, index.least, index.shards)
    return LineIndex(index.postings.unionByName(new), refs, filters, shards, index.shortest, index.least)


def delete(index: LineIndex, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without the documents of the given ids. Counts go down by the postings
    that go; where a key's largest id goes, the next one is found in those that stay."""
    ids = ids.select(F.col(f"`{id_col}`").cast("long").alias("doc")).distinct()
    gone = C.written(index.postings.join(ids, "doc", "left_semi"))
    stay = C.written(index.postings.join(ids, "doc", "left_anti").select("key", "doc"))
    fewer = gone.groupBy("key").agg(F.count("*").alias("n_gone"), F.max("doc").alias("last_gone"))
    met = index.refs.join(fewer, "key", "left")
    same = met.where("n_gone is null or (last_gone < top and n_docs > n_gone)").select(
        "key", (F.col("n_docs") - F.coalesce("n_gone", F.lit(0))).alias("n_docs"), "top")
    headless = met.where("last_gone = top and n_docs > n_gone").select("key", (F.col("n_docs") - F.col("n_gone")).alias("n_docs"))
    heads = stay.join(headless.select("key"), "key", "left_semi").groupBy("key").agg(F.max("doc").alias("top"))
    refs = C.written(same.unionByName(headless.join(heads, "key")))
    filters, shards = _filters(index, refs, index.refs, index.least, index.shards)
    return LineIndex(stay, refs, filters, shards, index.shortest, index.least)


def save(index: LineIndex, path: str) -> None:
    for name in ("postings", "refs", "filters"):
        getattr(index, name).write.parquet(f"{path}/{name}")
    index.refs.sparkSession.createDataFrame([(index.shards, index.shortest, index.least)], "shards int, shortest int, least int").write.parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> LineIndex:
    return LineIndex(*[spark.read.parquet(f"{path}/{name}") for name in ("postings", "refs", "filters")], *spark.read.parquet(f"{path}/about").first())


class Probe:
    """The filters of all shards, at hand in a task."""

    def __init__(self, rows: list[tuple[int, bytes, list[int]]], shards: int):
        self.known = {shard: Cuckoo.load(marks, spill) for shard, marks, spill in rows}
        self.shards = shards

    def has(self, keys: list[bytes]) -> np.ndarray:
        numbers, out = as_numbers(keys), np.zeros(len(keys), bool)
        shard = (numbers[:, 0] >> np.uint64(32)) % np.uint64(self.shards)
        for s in np.unique(shard).tolist():
            if s in self.known:
                own = np.flatnonzero(shard == s)
                out[own] = self.known[s].has(numbers[own])
        return out


def _ask(filters, shards: int, shortest: int, schema):
    """Number of lines, and the keys of lines that may be repeated."""
    def run(batches):
        probe = None if filters is None else Probe(filters.value, shards)
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            lines, keys, owner = [], [], []
            for i in range(batch.num_rows):
                cut = (texts[i].as_py() or "").split("\n")
                lines.append(len(cut))
                if ids[i].is_valid:
                    own = {line_key(x, shortest) for x in cut} - {None}
                    keys += own
                    owner += [i] * len(own)
            asked = [[] for _ in lines]
            for k in np.flatnonzero(np.ones(len(keys), bool) if probe is None else probe.has(keys)) if keys else ():
                asked[owner[k]].append(keys[k])
            yield C.appended(batch, schema, n_lines=lines, asked=asked)
    return run


def _cut(shortest: int, schema):
    """What is left of a text without the lines whose keys are listed."""
    def run(batches):
        for batch in batches:
            texts, listed, dropped, kept = batch.column("text"), batch.column("gone"), [], []
            for i in range(batch.num_rows):
                gone = set(listed[i].as_py() or ())
                cut = (texts[i].as_py() or "").split("\n")
                stay = [x for x in cut if line_key(x, shortest) not in gone] if gone else cut
                dropped.append(len(cut) - len(stay))
                kept.append("\n".join(stay))
            yield C.appended(batch, schema, n_dropped=dropped, kept=kept)
    return run


def dedup_lines(docs: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns ``keep``, all by default), ``n_lines``, ``n_dropped`` and
    ``kept`` (the lines that stay) of every row of ``docs``, judged by the index."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    C.ship(spark)
    filters = None
    if index.shards * SHARD_KEYS * 2 <= MAX_FILTER_BYTES:
        filters = spark.sparkContext.broadcast([(r.shard, bytes(r.marks), r.spill) for r in index.filters.select("shard", "marks", "spill").collect()])
    given = docs.select(C.whole(docs, keep), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = StructType([*given.schema.fields, StructField("n_lines", LongType()), StructField("asked", ArrayType(BinaryType()))])
    probed = given.mapInArrow(_ask(filters, index.shards, index.shortest, to_arrow_schema(asked)), asked)
    clean = probed.where(F.size("asked") == 0).select("doc", "n_lines", F.lit(0).cast("long").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("kept"))

    met = C.written(probed.where(F.size("asked") > 0).withColumn("row", F.monotonically_increasing_id()))
    repeated = index.refs.where(F.col("n_docs") >= index.least).select("key", "top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    gone = met.select("row", "id", F.explode("asked").alias("key"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")).join(
        repeated, ["key", "salt"]).where("id != top").groupBy("row").agg(F.collect_list("key").alias("gone"))
    joined = met.join(gone, "row", "left").select("doc", "n_lines", "text", "gone")
    schema = StructType([joined.schema["doc"], joined.schema["n_lines"], StructField("n_dropped", LongType()), StructField("kept", StringType())])
    return clean.unionByName(joined.mapInArrow(_cut(index.shortest, to_arrow_schema(schema)), schema))
