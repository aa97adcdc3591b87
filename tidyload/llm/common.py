"""Helpers shared by the corpus operators: table reading, byte-level hashing of
whole texts inside tasks, and connected components over a distributed edge table."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyload.session import ensure_checkpoint_dir, shared_path

CHUNK_BYTES = 2 << 20
"""Text bytes that one vectorised step of a task handles at a time."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's executors, once
    (Spark's own file server serves it), so that nothing need be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidyload-code-"), f"{package.name}_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent).as_posix())
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def as_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text column, a null text as no bytes."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def whole(docs: DataFrame, columns: list[str] | None = None) -> Column:
    """The given columns (all by default) as one struct ``doc``: rows travel whole,
    and no name of theirs can clash with one of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)]).alias("doc")


def slices(sizes: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Consecutive row slices of at most ``limit`` bytes each (one row at least)."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield slice(start, i)
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield slice(start, len(sizes))


def joined(texts: list[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, and the offsets where each begins (the last
    entry is the end); every text is followed by ``gap``."""
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return np.frombuffer(gap.join(texts) + gap if texts else b"", np.uint8), offsets


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


class Rolling:
    """Polynomial hashes modulo 2**64 of any span of a byte array, from prefix sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._powers = np.ones(1, np.uint64)
        self._inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            for name, step in (("_powers", self.base), ("_inverses", self.inverse)):
                run = np.full(n, step, np.uint64)
                run[0] = 1
                setattr(self, name, np.multiply.accumulate(run))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        terms = data.astype(np.uint64)  # a copy, worked on in place
        terms += np.uint64(1)
        terms *= self._powers[: len(data)]
        np.cumsum(terms, out=sums[1:])
        return sums

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((prefix[end] - prefix[start]) * self._inverses[start])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """The hash of every window of ``width`` bytes, by its start."""
        n = max(0, len(prefix) - width)
        return mixed((prefix[width:] - prefix[:n]) * self._inverses[:n])


ROLLING = Rolling(0x9E3779B97F4A7C15)
ROLLING_2 = Rolling(0xC2B2AE3D27D4EB4F)


def word_spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes for which ``inside`` (a table of
    256 flags) holds."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = inside[data]
    edges = np.diff(flags)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return LOWER[data]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has two id columns; null ids and self-loops are ignored. Returns
    ``node, component`` for every node that is not the smallest of its component;
    the component is the smallest id in it. Every step is a partial minimum per node
    and a join back, so a node with very many edges is pre-aggregated and its
    rows stay spread; each round is checkpointed in the shared folder.
    """
    low, high = F.least(u, v), F.greatest(u, v)
    held = checkpointed(edges.where(F.col(u) != F.col(v)).select(low.alias("lo"), high.alias("hi")).distinct())
    state = None
    while True:
        both = held.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(
            held.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        least = both.groupBy("n").agg(F.least("n", F.min("m")).alias("least"))
        large = both.join(least, "n").where("m > n and m > least").select(
            F.col("m").alias("hi"), F.col("least").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(least, "hi").where("lo > least").select(
            F.col("lo").alias("hi"), F.col("least").alias("lo"))
        held = checkpointed(small.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct())
        now = held.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            return held.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        state = now


def written(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, its
    columns prunable, and safe from the loss of executors."""
    spark = df.sparkSession
    path = shared_path(spark, "llm")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within it, jobs send at most ``rows`` rows at a time to Python: whole texts are
    long, and a worker holds a batch in several forms. The session's setting holds again after."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def release() -> None:
    """Give back what a Python worker has freed: workers outlive their tasks, and what the
    allocators keep for the next step would stand beside the memory of all later stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def appended(batch, schema, **columns):
    """An Arrow batch with further columns, in the field order of ``schema``."""
    import pyarrow as pa

    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name).cast(f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
