"""Embedding near-duplicates by cross-polytope hashing (operator 1).

Vectors link if their labels are equal and not null and their cosine, in double
precision, is at least ``threshold``. Vectors that are null, empty, zero or hold
null or non-finite components link with nothing.

Method. A unit vector is rotated by three rounds of random signs and the fast
Hadamard transform; the cross-polytope hash is the coordinate of largest size and
its sign. ``PARTS`` such hashes make a bucket of a table, and there are ``TABLES``
of them. Every vector stands in one bucket of each table and looks into
``PROBES`` more: those that replace one or two of its hashes by the runner-up
coordinates, in the order of the loss of size. Pairs met in a bucket are verified
by their cosine. The tests hold the recall against brute force.

Distribution. Equal vectors of a label form a class, and only its smallest id is
hashed, so copies of any number are one row; the links of the class count for all
its members. Buckets are joined by (label, table, bucket), whose rows Spark splits
where a bucket is skewed; pairs beyond the verified links are few, since vectors
that are not close agree in all hashes of a table by chance only.

Defined cases: rows that share an id are one vertex for components; vectors of
different lengths link with nothing of another length; a null id with a sound
vector counts as a link of its neighbours, has no component and is kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyload.llm import common as C

TABLES, PARTS, PROBES = 10, 3, 12
CHOICES = 4
"""Coordinates of each hash that probing may use."""


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform along the last axis, whose length is a power of two."""
    n, step = x.shape[-1], 1
    while step < n:
        pairs = x.reshape(*x.shape[:-1], n // (2 * step), 2, step)
        x = np.concatenate([pairs[..., :1, :] + pairs[..., 1:, :], pairs[..., :1, :] - pairs[..., 1:, :]], axis=-2).reshape(x.shape)
        step *= 2
    return x / np.sqrt(n)


def buckets(unit: np.ndarray, tables: int = TABLES, parts: int = PARTS, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers, (vectors, tables, 1 + probes); the first is the vector's own."""
    count, dim = unit.shape
    padded = 1 << max(1, (dim - 1).bit_length())
    x = np.zeros((count, padded))
    x[:, :dim] = unit
    out = np.empty((count, tables, 1 + probes), np.int64)
    choices = min(CHOICES, padded)
    grid = np.indices((choices,) * parts).reshape(parts, -1)
    changed = (grid > 0).sum(axis=0)
    grid = grid[:, np.argsort(changed, kind="stable")][:, : int((changed <= 2).sum())]  # the vector's own bucket comes first
    for t in range(tables):
        values, codes = np.empty((parts, count, choices)), np.empty((parts, count, choices), np.int64)
        for p in range(parts):
            signs = np.random.default_rng([7, t, p, padded]).choice([-1.0, 1.0], (3, padded))
            y = x
            for s in signs:
                y = hadamard(y * s)
            best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :choices]
            top = np.take_along_axis(y, best, axis=1)
            values[p], codes[p] = np.abs(top), best * 2 + (top < 0)
        loss = sum((values[p][:, :1] - values[p])[:, grid[p]] for p in range(parts))
        loss[:, 0] = -1
        chosen = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
        number = np.zeros((count, grid.shape[1]), np.int64)
        for p in range(parts):
            number = number * (2 * padded) + codes[p][:, grid[p]]
        picked = np.take_along_axis(number, chosen, axis=1)
        if picked.shape[1] < 1 + probes:  # fewer buckets than probes: repeat the own one
            picked = np.concatenate([picked, np.repeat(picked[:, :1], 1 + probes - picked.shape[1], axis=1)], axis=1)
        out[:, t] = picked
    return out


def _prepare(batches):
    """Sound vectors scaled to length one, with a fingerprint of label and components."""
    import pandas as pd

    for batch in batches:
        keys, units = [], []
        for label, vector in zip(batch["label"], batch["vector"]):
            unit = None
            if isinstance(label, str) and vector is not None and len(vector):
                x = np.array([np.nan if c is None else c for c in vector], np.float64)
                top = np.abs(x).max() if np.isfinite(x).all() else 0.0
                if top > 0:
                    unit = x / top
                    unit = unit / np.sqrt(unit @ unit) + 0.0
            units.append(unit)
            keys.append(None if unit is None else hashlib.blake2b((x + 0.0).tobytes(), digest_size=16, key=hashlib.blake2b(label.encode(), digest_size=16).digest()).digest())
        yield pd.DataFrame({"id": batch["id"].array, "label": batch["label"].array, "key": keys, "unit": units})


def _hash(batches):
    import pandas as pd

    for batch in batches:
        dims = batch["unit"].map(len).to_numpy()
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            for part in np.array_split(own, 1 + len(own) * dim // 100_000):
                some = batch.iloc[part]
                found = buckets(np.stack(some["unit"].to_list()))
                yield pd.DataFrame({"key": some["key"].array, "place": some["label"] + f":{dim}", "buckets": list(found.reshape(len(some), -1))})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98) -> DataFrame:
    """``id_col``, ``n_links`` (other vectors linked directly), ``component_id``
    (smallest id reachable by links) and ``kept`` for every row of ``vectors``."""
    C.ship(vectors.sparkSession)
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("vector"))
    ready = C.written(own.mapInPandas(_prepare, "id long, label string, key binary, unit array<double>"))
    classes = C.written(ready.where("key is not null").groupBy("key").agg(
        F.min("id").alias("rep"), F.count("*").alias("members"), F.first("label").alias("label"), F.first("unit").alias("unit")))
    hashed = classes.select("key", "label", "unit").mapInPandas(_hash, "key binary, place string, buckets array<long>")
    width = 1 + PROBES
    every = hashed.select("key", "place", F.posexplode("buckets").alias("at", "bucket")).select(
        "key", "place", F.floor(F.col("at") / width).alias("slot"), "bucket", (F.col("at") % width == 0).alias("home"))
    every = C.written(every.distinct() if PROBES == 0 else every)
    home = every.where("home").select(F.col("key").alias("other"), "place", "slot", "bucket")
    pairs = every.join(home, ["place", "slot", "bucket"]).where("key != other").select(
        F.least("key", "other").alias("u"), F.greatest("key", "other").alias("v")).distinct()

    def side(name: str) -> DataFrame:
        return classes.select(F.col("key").alias(name), F.col("unit").alias(f"x_{name}"), F.col("members").alias(f"n_{name}"),
                              F.col("rep").alias(f"id_{name}"))

    cosine = F.aggregate(F.zip_with("x_u", "x_v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    links = C.written(pairs.join(side("u"), "u").join(side("v"), "v").where(cosine >= threshold).select(
        "u", "v", "n_u", "n_v", "id_u", "id_v"))
    counts = links.select(F.col("u").alias("key"), F.col("n_v").alias("n")).unionByName(
        links.select(F.col("v").alias("key"), F.col("n_u").alias("n"))).groupBy("key").agg(F.sum("n").alias("outside"))
    shared = ready.where("id is not null and key is not null").join(classes.select("key", "rep"), "key").where("id != rep").select(
        F.col("id").alias("u"), F.col("rep").alias("v"))
    found = C.components(links.select(F.col("id_u").alias("u"), F.col("id_v").alias("v")).unionByName(shared))
    per_class = classes.select("key", "members").join(counts, "key", "left").select(
        "key", (F.col("members") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    component = F.coalesce("component", "id")
    return ready.select("id", "key").join(per_class, "key", "left").join(found, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))
