"""Operators held against their DuckDB SQL or a brute-force version on small tables."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidyload.llm import common, decontaminate, embedding_lsh, minhash, mixing, suffix_dedup
from tidyload.llm.queries import QUERIES
from tidyload.llm.sql import SQL


def cell(value) -> str:
    """A value as text, the same for a null or whole number of any column type."""
    if pd.isna(value):
        return "null"
    return str(int(value)) if isinstance(value, float) and value == int(value) else str(value)


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    got, want = (x[names].astype(object).map(cell).sort_values(names).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_column_type=False)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    same(QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(SQL[name]).df())


def reach(ids, links):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    want = reach({x for p in links for x in p}, links)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}


# -- embeddings ---------------------------------------------------------------

def test_embedding_links_and_recall(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 48))
    rows = []
    for k in range(900):
        b = base[k % 120]
        noise = rng.normal(size=48)
        cos = 0.985 + 0.014 * rng.random()
        b = b / np.linalg.norm(b)
        noise -= b * (noise @ b)
        noise /= np.linalg.norm(noise)
        rows.append((k, (b * cos + noise * np.sqrt(1 - cos * cos)).tolist(), k % 3))
    rows += [(900 + i, rows[7][1], 7 % 3) for i in range(5)]
    rows += [(910, [0.0] * 48, 1), (911, None, 1), (912, rows[3][1], None), (913, [None] + [1.0] * 47, 1), (914, [float("nan")] * 48, 1),
             (915, [1e300] * 48, 1), (916, [2e300] * 48, 1), (917, [], 1), (918, rows[3][1][:40], 0), (None, rows[4][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_lsh.near_duplicates(df).collect()}
    x = np.array([r[1] for r in rows[:905]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows[:905]])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(905, dtype=bool)
    true = near.sum() + 2 + 2 * (near[4].sum() + 1)  # 915 and 916, and the row without an id that equals row 4
    found = sum(got[i].n_links for i in got)
    assert 0.999 * true <= found <= true
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near))]
    least = reach(range(905), links)
    assert np.mean([got[i].component_id == least[i] for i in range(905)]) >= 0.999
    assert got[916].component_id == 915 and not got[916].kept
    for i in (910, 911, 912, 913, 914, 917, 918):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].kept and got[None].component_id is None


def test_embeddings_empty(spark):
    assert embedding_lsh.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# -- MinHash ------------------------------------------------------------------

def brute_sets(text, width):
    words = (text or "").encode().translate(bytes(common.LOWER.tolist())).split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i: i + width]) for i in range(len(words) - width + 1))


def varied(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for k in range(n):
        if k % 4 == 0 or not texts:
            texts.append([rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 200))])
        else:
            t = list(texts[rnd.randrange(max(0, len(texts) - 8), len(texts))])
            for _ in range(rnd.randrange(0, 1 + len(t) // 20)):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            texts.append(t)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_against_brute_force(spark, width):
    texts = varied(width, 240) + [None, "", " \t\n", "One", "oNe\n", "É one", "é one", "a\x0bb", "a b"]
    texts += [varied(9, 1)[0]] * 12
    rows = [(3 * i + 1, t, "x") for i, t in enumerate(texts)] + [(4, "repeated id with another text entirely here", "x"), (None, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(3)
    sets = [(i, brute_sets(t, width)) for i, t, _ in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    least = reach([i for i, _ in sets if i is not None], links)
    want = sorted(((i, len(s), least.get(i), i is None or least[i] == i) for i, s in sets), key=str)
    got = sorted((tuple(r) for r in minhash.near_duplicates(df, width=width).collect()), key=str)
    assert got == want


def test_minhash_large_group_of_near_copies(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(300):
        t = list(base)
        t[rnd.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(t)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert {r.component_id for r in got.collect()} == {0}


def test_odd_sketch_estimate(spark):
    rng = np.random.default_rng(0)
    both = rng.integers(0, 2**63, 2000, np.int64).astype(np.uint64)
    a, b = np.unique(both[:1800]), np.unique(both[200:])
    _, sketch = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    got = spark.createDataFrame([(sketch[0].tolist(), sketch[1].tolist())], "a array<long>, b array<long>").select(
        minhash.estimate(F.col("a"), F.col("b"))).first()[0]
    assert abs(got - 0.8) < 0.12


def test_keep_one_of_each(spark):
    df = spark.createDataFrame([(5, "a b c d e f", 1), (2, "a b c d e f", 2), (9, None, 3), (8, "", 4), (None, "a b c d e f", 5)],
                               "doc_id long, text string, kept int")
    got = minhash.keep_one_of_each(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(2, "a b c d e f", 2), (9, None, 3), (8, "", 4), (None, "a b c d e f", 5)], key=str)


# -- substrings ---------------------------------------------------------------

def brute_removed(rows, width):
    best = {}
    for i, t in rows:
        raw = (t or "").encode()
        for s in range(len(raw) - width + 1) if i is not None else ():
            best[raw[s: s + width]] = min(best.get(raw[s: s + width], i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - width + 1) if i is not None else ():
            if best[raw[s: s + width]] < i:
                gone[s: s + width] = [True] * width
        out.append((i, bytes(c for c, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [50, 16, 100])
def test_substrings_against_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 15_000)
    rnd = random.Random(width)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60").collect()]
    texts = [t for _, t in rows]
    for k in range(50):
        a, b = rnd.choice(texts), rnd.choice(texts)
        i = rnd.randrange(len(a))
        rows.append((100 + k, b[: rnd.randrange(80)] + a[i: i + rnd.randrange(width // 2, 3 * width)] + b[-50:]))
    near = texts[3]
    for k in range(25):
        j = rnd.randrange(len(near))
        rows.append((200 + k, near[:j] + "#" + near[j + 1:]))
    rows += [(None, texts[0]), (300, None), (301, ""), (302, "a" * 500), (303, "a" * 300 + "b"), (303, "a" * 300 + "b"), (304, "é" * 200), (305, "xé" + "é" * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.dedup_substrings(df, min_bytes=width).select("doc.doc_id", "kept_bytes", "removed_spans").collect()
    assert sorted(((r[0], bytes(r[1])) for r in got), key=str) == brute_removed(rows, width)
    by_id = {r[0]: r for r in got}
    for i, t in rows:
        raw, spans = (t or "").encode(), by_id[i][2]
        if i != 303:
            assert len(raw) - sum(s.end - s.start for s in spans) == len(by_id[i][1])


def test_null_and_repeated_ids_fill_no_block(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 5_000)
    rnd = random.Random(12)
    texts = ["".join(rnd.choices("abcdefgh ", k=300)) for _ in range(300)]
    rows = [((None, 7, i)[i % 3], t + rnd.choice(texts)[:120]) for i, t in enumerate(texts)]
    pack, seen = suffix_dedup._pack, str(tmp_path)

    def spy(batches):
        from uuid import uuid4

        for batch in batches:
            with open(f"{seen}/{uuid4()}", "w") as f:
                f.writelines(f"{b} {i}\n" for b, i in zip(batch.column("block").to_pylist(), batch.column("id").to_pylist()))
            yield from pack([batch])

    monkeypatch.setattr(suffix_dedup, "_pack", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix_dedup.dedup_substrings(df).select("doc.doc_id", "kept_bytes").collect()
    assert sorted(((r[0], bytes(r[1])) for r in got), key=str) == brute_removed(rows, 50)
    held = {}
    for line in next(tmp_path.iterdir()).read_text().splitlines():
        held.setdefault(line.split()[0], []).append(line.split()[1])
    assert sum(map(len, held.values())) == 200 and max(map(len, held.values())) < 40


def test_without_repeats_keeps_columns(spark):
    shared = "é" * 120
    df = spark.createDataFrame([(1, "abc " + shared, 5, "k"), (2, shared + " xyz", 6, "m"), (3, None, None, None)],
                               "doc_id long, text string, n_chars long, kept_bytes string")
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(df, min_bytes=100).collect()}
    assert suffix_dedup.without_repeats(df).columns == df.columns
    assert got[1].text == "abc " + shared and got[2].text == " xyz" and got[2].n_chars == 4 and got[2].kept_bytes == "m"
    assert got[3].text is None and got[3].n_chars is None


def test_a_block_takes_a_bounded_multiple_of_its_bytes():
    """However many of its strings two phrases may hold, here every one of 2 MB."""
    import tracemalloc

    import pyarrow as pa
    rnd, width, buckets = np.random.default_rng(7), 100, 32
    texts = [rnd.integers(97, 123, 2000, np.uint8).tobytes() for _ in range(1000)]
    rows = pa.record_batch({"id": np.arange(1000), "bytes": pa.array(texts, pa.binary()), "block": np.zeros(1000, np.int32),
                            "width": np.full(1000, width, np.int32), "doc": pa.array([{"doc_id": i} for i in range(1000)])})
    size, peak = sum(map(len, texts)), {}

    def step(name, run):
        tracemalloc.start()
        out = run()
        peak[name] = tracemalloc.get_traced_memory()[1] / size
        tracemalloc.stop()
        return out

    def answers(kind, sent, column):
        return pa.Table.from_pylist([{"block": 0, "kind": kind, "bucket": r["bucket"], "a": r[column], "b": b""} for r in sent.to_pylist()],
                                    suffix_dedup._ARROW_ANSWER)

    packed = step("pack", lambda: pa.Table.from_batches(suffix_dedup._pack([rows])))
    triggers = step("triggers", lambda: suffix_dedup._triggers(width, buckets)(packed))
    phrases = step("phrases", lambda: suffix_dedup._phrases(width, buckets)(0, packed, answers(suffix_dedup.SHARED, triggers, "a")))
    first = answers(suffix_dedup.FIRST, phrases, "b")
    likely = step("candidates", lambda: suffix_dedup._candidates(width, buckets)(0, packed, first))
    told = pa.concat_tables([first, answers(suffix_dedup.LIKELY, likely, "a")])
    found = step("suffixes", lambda: suffix_dedup._suffixes(width, buckets)(0, packed, told))
    strings = {t[i: i + width] for t in texts for i in range(len(t) - width + 1)}
    assert sum(len(x) for x in found.column("a").to_pylist()) == 8 * len(strings)
    assert max(peak["pack"], peak["triggers"], peak["phrases"]) < 20 and peak["candidates"] < 70 and peak["suffixes"] < 110, peak


def test_the_last_pass_looks_up_only_strings_of_phrases_held_first(monkeypatch):
    """Strings of unshared phrases are in no class, and later holders of a phrase lose it whole."""
    import pyarrow as pa
    rnd, width = random.Random(15), 50
    texts = ["".join(rnd.choices("abcdefgh ", k=1000)) for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts[:40])]
    rows += [(200 + i, t[300:300 + rnd.randrange(40, 140)] + rnd.choice("xyz") * 3 + texts[i + 1][10:75]) for i, t in enumerate(texts[:8])]
    rows += [(3, texts[50][:200]), (90, texts[3][500:700]), (207, "")]
    batch = pa.record_batch({"block": np.zeros(len(rows), np.int32), "width": np.full(len(rows), width, np.int32),
                             "id": np.array([i for i, _ in rows]), "bytes": pa.array([t.encode() for _, t in rows], pa.binary()),
                             "doc": pa.array([{"doc_id": i} for i, _ in rows])})
    packed = pa.Table.from_batches(suffix_dedup._pack([batch]))
    shared = suffix_dedup._shared(suffix_dedup.SHARED)(suffix_dedup._triggers(width, 1)(packed))
    entries = suffix_dedup._dictionary(suffix_dedup._phrases(width, 1)(0, packed, shared))
    likely = suffix_dedup._shared(suffix_dedup.LIKELY)(suffix_dedup._candidates(width, 1)(0, packed, entries))
    classes = suffix_dedup._one_class(suffix_dedup._suffixes(width, 1)(0, packed, pa.concat_tables([entries, likely])))
    expanded, seen = suffix_dedup._expanded, []
    monkeypatch.setattr(suffix_dedup, "_expanded", lambda block: (seen.append(len(c[0])) or c for c in expanded(block)))
    schema = pa.schema([("doc", pa.struct([("doc_id", pa.int64())])),
                        ("removed_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_bytes", pa.binary())])
    found = suffix_dedup._removed(width, False, schema)(0, packed, pa.concat_tables([entries, classes])).to_pylist()
    assert sorted(((r["doc"]["doc_id"], r["kept_bytes"]) for r in found), key=str) == brute_removed(rows, width)
    assert 0 < sum(seen) < sum(len(t) for _, t in rows) / 20


def test_substrings_empty(spark):
    assert suffix_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- benchmark ----------------------------------------------------------------

BENCH = [(1, "One two three four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "--"), (None, "lone words here now"),
         (1, "short item"), (10, "Ünï çode wörds ÄB")]
DOCS = [(1, "x one TWO three, four five six seven eight nine ten! eleven twelve"), (2, "a short, ITEM and a short item"), (3, None), (4, ""),
        (5, "one two three four five six seven eight nine"), (6, "lone words here now"), (6, "short item"), (None, "ünï çode wörds Äb")]


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_leaks_both_ways(spark, limit):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.find_leaks(docs, bench, keep=["doc_id"], broadcast_bytes=limit).select("doc.doc_id", "n_words", "n_hit", "items")
    rows = sorted(((r[0], r[1], r[2], tuple(r[3])) for r in got.collect()), key=str)
    assert rows == sorted([(1, 13, 11, ("1",)), (2, 7, 4, ("1", "2")), (3, 0, 0, ()), (4, 0, 0, ()), (5, 9, 0, ()),
                           (6, 4, 4, ("",)), (6, 2, 2, ("1", "2")), (None, 4, 0, ())], key=str)


def test_index_size_bounds_the_broadcast(spark, monkeypatch):
    import tracemalloc

    rnd = random.Random(3)
    items = [(i, " ".join("".join(rnd.choices("abcdeé", k=4)) for _ in range(rnd.choice([3, 40, 200])))) for i in range(60)] + [(60, "-- --"), (61, None)]
    bench, texts = spark.createDataFrame(items, "item_id long, text string"), [(t or "").encode() for _, t in items]
    tracemalloc.start()
    index = decontaminate.Index.of([i for i, _ in items], texts, 10)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    told = bench.agg(F.sum(decontaminate.index_bytes(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 10))).first()[0]
    assert index.hashes and 0.8 * held < told < 1.5 * held
    joined, calls = decontaminate._joined_leaks, []
    monkeypatch.setattr(decontaminate, "_joined_leaks", lambda *a: calls.append(1) or joined(*a))
    docs = spark.createDataFrame([(1, "x " + items[2][1]), (2, "none")], "doc_id long, text string")
    limit = 4 * sum(map(len, texts))  # well over the texts, under the index
    hit = {r[0]: r[1] for r in decontaminate.find_leaks(docs, bench, broadcast_bytes=limit).select("doc.doc_id", "items").collect()}
    assert calls and hit == {1: ["2"], 2: []}


def test_a_scan_takes_a_bounded_room():
    """Whatever a batch holds, here 6 MB in texts of 3 KB."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices("abcdeé", k=4)) for _ in range(500)).encode() for _ in range(2000)]
    index = decontaminate.Index.of([1], [texts[5]], 10)
    batch = pa.record_batch({"doc": pa.array([{"doc_id": i} for i in range(2000)]), "bytes": pa.array(texts, pa.binary())})
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.schema([("doc", batch.schema.field("doc").type), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("items", pa.list_(pa.string())), ("hit_spans", pa.list_(span))])
    none = batch.slice(0, 0)
    tracemalloc.start()
    hit = [r["doc"]["doc_id"] for b in decontaminate._scan(SimpleNamespace(value=index), arrow)([none, batch, none])
           for r in b.to_pylist() if r["n_hit"]]
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert hit == [5] and peak < 40, peak


def test_decontaminate_modes(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in DOCS], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, 5, None], key=str)
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, remove="spans").where("doc_id in (1, 2, 3, 5)").collect()}
    assert cut == {1: "x  twelve", 2: "a  and a ", 3: None, 5: DOCS[4][1]}


def test_empty_benchmark(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).agg(F.sum("n_hit")).first()[0] == 0


# -- mixing -------------------------------------------------------------------

def water(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if level[s] > cap * sizes[s]]
        if not over:
            return full | level
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


def mixed(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string, target string").repartition(3))


def test_mix(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["b", "a", "Z", "é", None, "a"]), " ".join("w" * rnd.randrange(0, 40)), "t") for i in range(3000)]
    rows += [(5000 + i, "huge", "v " * 5, "t") for i in range(4000)] + [(9000, "a", None, "t")] + [(9001, "a", "p q r", "t")] * 40
    got = mixed(spark, rows).toPandas()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water(sizes)
    got["source"] = got["source"].where(got["source"].notna(), None)
    for s, g in got.groupby("source", dropna=False):
        s = None if pd.isna(s) else s
        assert (g["source_size"] == sizes[s]).all() and np.allclose(g["target"], want[s])
        assert abs(g["taken"].sum() - want[s]) <= 45 * 2
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] == got["copies"] * got["size"]).all()
    again = mixed(spark, rows[::-1]).toPandas()
    names = ["doc_id", "source", "taken"]
    a, b = (x[names].astype(str).sort_values(names).reset_index(drop=True) for x in (got, again))
    pd.testing.assert_frame_equal(a, b)


def test_mix_keeps_expectations(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "x " * (1 + i % 7)) for i in range(40)], "doc_id long, source string, text string")
    runs = [mixing.mix(df, weights=(1, 1), share=1.3, seed=s).select("doc_id", "copies", "target", "source_size").toPandas() for s in range(6)]
    mean = pd.concat(runs).groupby("doc_id").mean()
    assert abs(mean["copies"] - mean["target"] / mean["source_size"]).mean() < 0.25


def test_mix_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(empty).count() == 0
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, None, None)], empty.schema)).collect()] == [0]
    one = mixing.mix(spark.createDataFrame([(1, "s", "a b")], empty.schema)).collect()[0]
    assert one.target == 3.0 and one.taken in (2, 4)


def test_mix_is_native(spark):
    df = mixing.mix(spark.createDataFrame([(1, "s", "a b")], "doc_id long, source string, text string"))
    assert "Python" not in df._jdf.queryExecution().toString()
