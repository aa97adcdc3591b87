"""MinHash near-duplicates with odd sketches (operator 2).

Words: A-Z lower-cased, then maximal runs of bytes other than 0x09-0x0D and 0x20.
A document's set holds its distinct shingles of ``width`` words; with fewer words
the whole sequence is its one shingle; without words the set is empty and links
with nothing. Two documents link if 100 * |intersection| >= ``percent`` * |union|.

Method. ``BANDS * ROWS`` MinHash samples are taken of each set. They are cut into
bands: documents that agree in a band are candidates. The samples are also folded
into an odd sketch, a bitmap in which each (place, value) flips one bit; the
population count of the XOR of two sketches estimates their similarity, most
precisely where it is high, and candidates whose estimate lies more than
``MARGIN`` below the threshold go. The rest is confirmed on the full sets.

Distribution. Documents with equal sets form a class, and only the class goes on, so exact
copies of any number are one row. The classes of a band form a group with its first
class as pivot (bands of one pivot are one group); pivot and members are compared, which is
linear in the size of the group, and components follow. What is left to find are links
between members of a group that lie in different components. They are found exactly, and
without a pair of each two near misses, from the members' differences to the pivot
(shingles that only one of the two has): x and y link if and only if their differences
share at least k = (|Dx| + |Dy| - q (|x| + |y|)) / 2 shingles, q = (100 - percent) / (100 +
percent). With the shingles of all differences in one order, rarest in the group first, the
first one that x and y share stands among the first |Dx| - k + 1 of x and at a place from which
k can still be reached in both; a member's own bound on k (its partner does not link with
the pivot, or is at least as small as sizes allow) cuts what is looked up at all. Shared
shingles of one part only are dropped before members meet. With 40 bands of 5
rows a pair at similarity 0.8 is missed with probability 1.2e-7.

Defined cases: a null or empty text has an empty set; rows that share an id are
one vertex; a row with a null id links with nothing and is kept; ties in nothing
matter, since components and sets don't depend on an order; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyload.llm import common as C

BANDS, ROWS = 40, 5
SKETCH_BITS = 512
MARGIN = 0.2
SLICE_BYTES = 1 << 19
"""Text bytes that one vectorised step handles: a step holds some hundred bytes for each."""
MAX_BROADCAST = 1_000_000
"""Ids that are broadcast at most (8 bytes each) to pick texts; beyond, texts meet them by a shuffle."""
SPACE = np.zeros(256, bool)
SPACE[9:14] = SPACE[32] = True

_random = np.random.default_rng(20)
_XOR = _random.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_TIMES = _random.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each begins."""
    raw, offsets = C.joined(texts, b"\n")
    data = C.lowered(raw)
    start, end = C.word_spans(data, ~SPACE)
    words = C.ROLLING.spans(C.ROLLING.prefix(data), start, end)
    row = np.searchsorted(offsets, start, side="right") - 1
    sums = C.ROLLING_2.prefix(words)
    count = np.bincount(row, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(count)])
    whole = np.flatnonzero((count > 0) & (count < width))
    first = np.flatnonzero(row[: max(0, len(row) - width + 1)] == row[width - 1:])
    owner = np.concatenate([row[first], whole])
    found = np.concatenate([C.ROLLING_2.spans(sums, first, first + width),
                            C.ROLLING_2.spans(sums, begin[whole], begin[whole + 1])])
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return found[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def _keys(sets: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """A 128-bit fingerprint of each set; empty sets have none."""
    sums = np.zeros((len(starts) - 1, 2), np.uint64)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        for i, times in enumerate((0x9FB21C651E98DF25, 0xD1342543DE82EF95)):
            sums[full, i] = np.add.reduceat(C.mixed(sets * np.uint64(times)), starts[full])
    keys = [x.tobytes() for x in sums]
    return [k if n else None for k, n in zip(keys, np.diff(starts))]


def signatures(sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and odd sketches (as 64-bit words) of sets that are not empty."""
    low = (sets >> np.uint64(32)).astype(np.uint32)
    n = len(starts) - 1
    samples = np.empty((n, BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        samples[:, k] = np.minimum.reduceat((low ^ _XOR[k]) * _TIMES[k], starts[:-1])
    bands = np.full((n, BANDS), 1, np.uint64) + np.arange(BANDS, dtype=np.uint64)
    grouped = samples.reshape(n, BANDS, ROWS)
    for r in range(ROWS):
        bands = C.mixed(bands * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, r])
    place = np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(32)
    bits = (C.mixed((samples | place) * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    cells = np.bincount((bits + np.arange(n)[:, None] * SKETCH_BITS).ravel(), minlength=n * SKETCH_BITS)
    sketch = np.packbits((cells & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)
    return bands.view(np.int64), np.ascontiguousarray(sketch).view(np.int64)


def _sign(width: int):
    def run(batches):
        import pandas as pd

        for batch in batches:
            texts = [bytes(t) for t in batch["bytes"]]
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SLICE_BYTES):
                sets, starts = shingles(texts[part], width)
                sizes = np.diff(starts)
                bands, sketches = [None] * len(sizes), [None] * len(sizes)
                full = np.flatnonzero(sizes)
                if len(full):
                    for i, b, s in zip(full, *signatures(sets, np.append(starts[full], len(sets)))):
                        bands[i], sketches[i] = b, s
                yield pd.DataFrame({"id": batch["id"].iloc[part].array, "n": sizes, "key": _keys(sets, starts),
                                    "bands": bands, "sketch": sketches})
        C.release()
    return run


def _sets(width: int):
    def run(batches):
        import pandas as pd

        for batch in batches:
            texts = [bytes(t) for t in batch["bytes"]]
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SLICE_BYTES):
                sets, starts = shingles(texts[part], width)
                yield pd.DataFrame({"id": batch["id"].iloc[part].array, "key": _keys(sets, starts),
                                    "shingles": [x.view(np.int64) for x in np.split(sets, starts[1:-1])]})
        C.release()
    return run


def estimate(a: Column, b: Column) -> Column:
    """Similarity of the sets behind two odd sketches."""
    flips = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    n, k = SKETCH_BITS, BANDS * ROWS
    share = F.greatest(1 - 2 * flips / F.lit(float(n)), F.lit(1e-9))
    return 1 + F.lit(n / (4.0 * k)) * F.log(share)


def _sets_of(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(k, n, shingles, sketch) of the given classes, from the texts of their ids."""
    ids = classes.select("id").distinct()
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids
    found = docs.join(ids, "id", "left_semi").mapInPandas(_sets(width), "id long, key binary, shingles array<long>")
    return C.written(found.where("key is not null").select("key", "shingles").dropDuplicates(["key"]).join(
        classes.select("key", "k", "n", "sketch"), "key").drop("key"))


def _agree(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Two sets link, by the number of shingles that only the first has."""
    common = n_a - F.size(F.array_except(a, b))
    return 100 * common >= percent * (n_a + n_b - common)


def _side(sets: DataFrame, key: str) -> DataFrame:
    return sets.select(F.col("k").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in ("n", "shingles", "sketch")])


def _likely(u: str, v: str, percent: int) -> Column:
    """What the odd sketches say of a candidate pair."""
    return estimate(F.col(f"sketch_{u}"), F.col(f"sketch_{v}")) >= percent / 100 - MARGIN


def _differences(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each member (k) of a group (g, its pivot): whether both link, and ``d``,
    the shingles that only one of the two has (those of the pivot bit-inverted)."""
    met = groups.where("g != k").join(_side(sets, "k"), "k").join(_side(sets, "g"), "g")
    apart = met.select("g", "k", F.col("n_k").alias("n"), F.col("n_g").alias("nc"), _likely("k", "g", percent).alias("likely"),
                       F.array_except("shingles_k", "shingles_g").alias("more"), F.array_except("shingles_g", "shingles_k").alias("less"))
    common = F.col("n") - F.size("more")
    return C.written(apart.select(
        "g", "k", "n", "nc", (F.col("likely") & (100 * common >= percent * (F.col("n") + F.col("nc") - common))).alias("direct"),
        F.concat("more", F.transform("less", lambda t: F.bitwise_not(t))).alias("d")))


def _candidates(apart: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of members of a group, in different parts, that may link. ``apart``:
    differences with the member's ``part``."""
    low, high = 100 - percent, 100 + percent  # q = low / high, kept in whole numbers
    each = apart.select("g", "k", F.explode("d").alias("t"))
    often = each.groupBy("g", "t").agg(F.count("*").alias("f")).where("f > 1")
    ordered = each.join(often, ["g", "t"], "left").groupBy("g", "k").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "t"))).alias("order"))
    size = F.size("order")
    # least number of shared shingles: with a partner that does not link with the pivot; with any partner
    apart_too = F.ceil((high * size + low * (F.col("nc") - F.col("n"))) / (2.0 * high) - 1e-9)
    any_kind = F.ceil((high * size - low * (F.col("n") * (1 + 100.0 / percent))) / (2.0 * high) - 1e-9)
    known = apart.select("g", "k", "n", "nc", "direct", "part").join(ordered, ["g", "k"]).select(
        "g", "k", "n", "direct", "part", "order", size.alias("nd"), (size - F.greatest(F.lit(1), apart_too) + 1).alias("near"),
        (size - F.greatest(F.lit(1), any_kind) + 1).alias("far"))
    looked = F.when(F.col("direct"), F.col("near")).otherwise(F.col("far")).cast("int")
    rows = known.select("g", "k", "n", "nd", "direct", "part", "near", F.posexplode(F.slice("order", F.lit(1), F.greatest(F.lit(0), looked)))).where(
        F.col("col.f") > 1).select("g", "k", "n", "nd", "direct", "part", F.col("col.t").alias("t"), (F.col("pos") + 1).alias("at"),
                                   (F.col("pos") < F.col("near")).alias("early"))
    rows = C.written(rows)
    several = rows.groupBy("g", "t").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b").select("g", "t")
    rows = rows.join(several, ["g", "t"])
    x, y = (rows.select("g", "t", *[F.col(c).alias(f"{s}_{c}") for c in ("k", "n", "nd", "direct", "part", "at", "early")]) for s in "xy")
    reach = 1 + F.least(F.col("x_nd") - F.col("x_at"), F.col("y_nd") - F.col("y_at"))
    inside = F.col("x_direct") | F.col("y_direct") | (F.col("x_early") & F.col("y_early"))
    return x.join(y, ["g", "t"]).where(
        (F.col("x_k") < F.col("y_k")) & (F.col("x_part") != F.col("y_part")) & ~(F.col("x_direct") & F.col("y_direct")) & inside
        & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
        & (2 * high * reach >= high * (F.col("x_nd") + F.col("y_nd")) - low * (F.col("x_n") + F.col("y_n")))).select(
        F.col("x_k").alias("u"), F.col("y_k").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable by
    links) and ``kept`` (the id is the component's) for every row of ``docs``."""
    C.ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), C.as_bytes(text_col).alias("bytes"))
    with C.small_batches(docs.sparkSession):
        signed = C.written(own.mapInPandas(
            _sign(width), "id long, n long, key binary, bands array<long>, sketch array<long>"))
    known = signed.where("key is not null and id is not null")
    nodes = C.written(known.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"),
                                               F.first("sketch").alias("sketch")).withColumn("k", F.monotonically_increasing_id()))
    # a copy follows its class; only where an id has several rows do its classes meet in the id
    reps = nodes.select("key", F.col("id").alias("rep"))
    repeated = signed.where("id is not null").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    copies = known.select("id", "key").join(repeated, "id").join(reps, "key").where("id != rep").select(
        F.col("id").alias("u"), F.col("rep").alias("v")).distinct()

    rows = nodes.select("k", F.explode("bands").alias("band"))
    pivots = rows.groupBy("band").agg(F.min("k").alias("g"), F.count("*").alias("size")).where("size > 1").drop("size")
    groups = C.written(rows.join(pivots, "band").select("g", "k").distinct())
    classes = C.written(nodes.drop("bands").join(groups.select("k").distinct(), "k", "left_semi"))
    with C.small_batches(docs.sparkSession):
        sets = _sets_of(own, classes, width)
    apart = _differences(groups, sets, percent)

    def by_id(pairs: DataFrame) -> DataFrame:
        u, v = (classes.select(F.col("k").alias(c), F.col("id").alias(f"id_{c}")) for c in "uv")
        return pairs.join(u, "u").join(v, "v").select(F.col("id_u").alias("u"), F.col("id_v").alias("v"))

    first = by_id(apart.where("direct").select(F.col("g").alias("u"), F.col("k").alias("v"))).unionByName(copies)
    found = C.written(C.components(first))
    parts = C.written(classes.select("k", "id").join(found, F.col("id") == F.col("node"), "left").select(
        "k", F.coalesce("component", "id").alias("part")))
    several = groups.join(parts, "k").groupBy("g").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a != b").select("g")
    pairs = C.written(_candidates(C.written(apart.join(several, "g").join(parts, "k")), percent))
    near = pairs.join(_side(sets, "u"), "u").join(_side(sets, "v"), "v").where(_likely("u", "v", percent)).where(
        _agree(F.col("shingles_u"), F.col("shingles_v"), F.col("n_u"), F.col("n_v"), percent)).select("u", "v")
    u, v = (parts.select(F.col("k").alias(c), F.col("part").alias(f"part_{c}")) for c in "uv")
    across = C.written(near.join(u, "u").join(v, "v").select(F.col("part_u").alias("u"), F.col("part_v").alias("v")).distinct())
    merged = C.components(across) if not across.isEmpty() else across.select(F.col("u").alias("node"), F.col("v").alias("component"))
    merged = merged.select(F.col("node").alias("part"), F.col("component").alias("whole"))

    part = F.coalesce("component", "own")
    component = F.coalesce("whole", "part")
    own_class = F.when(F.col("id").isNotNull(), F.coalesce("rep", "id"))
    placed = signed.select("id", "n", "key").join(reps, "key", "left").select("id", "n", own_class.alias("own"))
    placed = placed.join(found, F.col("own") == F.col("node"), "left").select("id", "n", part.alias("part"))
    return placed.join(merged, "part", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that are the smallest id of their group, with their own columns."""
    found = near_duplicates(docs, id_col, **options).where("not kept").select(F.col(id_col).alias("__drop")).distinct()
    return docs.join(found, docs[id_col] == found["__drop"], "left_anti")


def keep_one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group, with its own columns: the one of smallest id, then of
    smallest text hash, null ids last. Rows are told apart by a number of their
    own, fixed by writing them once, so null and repeated ids are settled too; rows
    without words stay."""
    rows = C.written(docs.select(C.whole(docs), F.monotonically_increasing_id().alias("row")))
    found = C.written(near_duplicates(rows, "row", f"doc.`{text_col}`", **options).where("not kept").select("row", "component_id"))
    # a group's first row is in none of its links as the one to go: add it back
    members = found.unionByName(found.select(F.col("component_id").alias("row"), "component_id").distinct())
    own = F.col(f"doc.`{id_col}`")
    ranked = rows.select("row", F.struct(own.isNull(), own, F.xxhash64(f"doc.`{text_col}`"), "row").alias("rank")).join(members, "row")
    best = ranked.groupBy("component_id").agg(F.min("rank")["row"].alias("row"))
    gone = members.join(best, "row", "left_anti").select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
