"""Line dedup, Merkle manifest and periodic runs against brute-force versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyload.llm import line_dedup, periodic_runs
from tidyload.llm.queries import tampered_manifest

BLANK = " \t\n\x0b\x0c\r"


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# -- line dedup -----------------------------------------------------------------

def brute_lines(rows):
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = lowered(line.strip(BLANK))
            if len(key) >= 20 and i is not None:
                held.setdefault(key, set()).add(i)
    out = []
    for i, t in rows:
        lines, stay = (t or "").split("\n"), []
        for line in lines:
            docs = held.get(lowered(line.strip(BLANK)), ())
            if i is None or len(docs) < 3 or max(docs) == i:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def line_rows(seed, n, first=0):
    rnd = random.Random(seed)
    pool = [f"Line number {k} with É and words" for k in range(60)] + ["x" * 19, "x" * 20, "é" * 20, "", "K" * 30, "long " * 20000]

    def text():
        if rnd.random() < 0.05:
            return rnd.choice([None, "", "\n"])
        return "\n".join(rnd.choice(["", " ", "\t", "\x0b"]) + rnd.choice([str.upper, str.lower, str])(rnd.choice(pool)) + rnd.choice(["", " ", "\r"])
                         for _ in range(rnd.randrange(1, 8)))

    return [(first + i if first or rnd.random() < 0.9 else rnd.choice([None, 5, 6]), text()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, n_lines int, doc string").repartition(3)


def judged(spark, index, rows):
    out = line_dedup.dedup_lines(frame(spark, rows), index)
    assert out.schema["doc"].dataType.names == ["doc_id", "text", "n_lines", "doc"]
    return sorted([(r.doc.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()], key=str)


def tables(index):
    held = {r.shard: (r.n, int((np.frombuffer(bytes(r.marks), np.uint16) > 0).sum()) + len(r.spill)) for r in index.filters.collect()}
    assert all(n == marks for n, marks in held.values())
    return sorted(map(tuple, index.refs.collect()), key=str), sorted(map(tuple, index.postings.collect()), key=str), held


def test_lines_inserted_and_deleted(spark, tmp_path):
    rows, more = line_rows(3, 120), line_rows(4, 60, 200)
    first = line_dedup.build(frame(spark, rows))
    assert judged(spark, first, rows) == brute_lines(rows)
    both = line_dedup.insert(first, frame(spark, more))
    assert judged(spark, both, rows + more) == brute_lines(rows + more)
    again = line_dedup.insert(both, frame(spark, more))  # what is there already adds nothing
    assert tables(again) == tables(both)
    back = line_dedup.delete(both, frame(spark, [(i, None) for i, _ in more] + [(9999, None), (None, None)]))
    assert tables(back) == tables(first) and judged(spark, back, rows) == brute_lines(rows)
    # the largest ids of many lines go: the next ones are found
    low = [r for r in rows if r[0] is None or r[0] < 60]
    fewer = line_dedup.delete(first, frame(spark, [(i, None) for i in range(60, 120)]))
    assert judged(spark, fewer, low) == brute_lines(low)
    line_dedup.save(fewer, str(tmp_path / "index"))
    assert judged(spark, line_dedup.load(spark, str(tmp_path / "index")), low) == brute_lines(low)


def test_lines_without_filters(spark, monkeypatch):
    rows = line_rows(5, 80)
    index = line_dedup.build(frame(spark, rows))
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BYTES", 0)
    assert judged(spark, index, rows) == brute_lines(rows)


def test_lines_empty(spark):
    none = frame(spark, [(1, "x")]).where("doc_id = 0")
    index = line_dedup.build(none)
    assert judged(spark, index, []) == [] and line_dedup.dedup_lines(none, index).count() == 0
    some = [(k, "a line that is long enough\nb") for k in range(3)]
    assert judged(spark, line_dedup.insert(index, frame(spark, some)), some) == brute_lines(some)


def test_cuckoo_filter_is_whole_and_deletes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (60000, 2), np.int64).astype(np.uint64)
    keys[:12] = keys[0]  # one key more often than its two buckets hold
    known = line_dedup.Cuckoo.empty()
    known.insert(keys)
    assert known.has(keys).all() and known.spill
    other = rng.integers(0, 1 << 63, (100000, 2), np.int64).astype(np.uint64)
    assert known.has(other).mean() < 0.001
    copy = line_dedup.Cuckoo.load(known.table.tobytes(), sorted(known.spill.elements()))
    copy.delete(keys[:30000])
    assert copy.has(keys[30000:]).all() and copy.has(keys[12:30000]).mean() < 0.001
    copy.delete(keys[30000:])
    assert not copy.table.any() and not copy.spill


# -- Merkle manifest ------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i: i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute_manifest(rows):
    def leaf(r):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[2], r[1], r[3], r[4])))

    def siblings(levels, p):
        for nodes in levels[:-1]:
            yield (p & 1, nodes[p ^ 1]) if p ^ 1 < len(nodes) else (0, "")
            p >>= 1

    names = sorted({r[1] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {n: sorted((r for r in rows if r[1] == n), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for n in names}
    trees = {n: brute_tree([leaf(r) for r in own[n]]) for n in names}
    top = brute_tree([trees[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for p, r in enumerate(own[n]):
            way = [*siblings(trees[n], p), *siblings(top, k)]
            d = leaf((*r[:3], r[3] + 1, r[4])) if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for right, s in way:
                d = digest(s + d if right else d + s)
            out.append((r[0], leaf(r), trees[n][-1][0], top[-1][0], digest("".join(s for _, s in way)), d, d == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, bits", [(0, 2), (1, 2), (300, 2), (300, 10)])
def test_manifest_against_brute_force(spark, n, bits):
    rnd = random.Random(n)
    rows = [(i if rnd.random() < 0.9 else rnd.choice([None, 3]), rnd.choice([None, "", "en", "en", "en", "é", "zz", f"z{rnd.randrange(9)}"]),
             rnd.choice([None, "s", ""]), rnd.choice([None, i, 2**63 - 1]), rnd.choice([None, "", "té:x" * i * 20])) for i in range(n)]
    rows += rows[:n // 10]  # repeated rows
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, lang string, source string, n_chars long, text string, pos int, tree int")
    got = tampered_manifest(docs.repartition(3), bits).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


def test_versions_share_all_but_ancestors(spark):
    from tidyload.llm import merkle
    docs = spark.range(40).selectExpr("id AS doc_id", "if(id < 37, 'a', 'b') AS lang", "'t' AS text")
    found = merkle.manifest(docs, ["doc_id", "text"], tampered={"text": F.lit("u")}, where=F.col("doc_id") % 5 == 0, bits=3).collect()
    for r in found:
        if r.id % 5:
            assert r.copied is None and r.altered is None and r.folded == r.root
        else:  # six levels over the 37 leaves of a, two over the 3 of b, one over both
            assert len(r.copied) == (7 if r.id < 37 else 3) and r.copied[-1] == r.folded != r.root


# -- periodic runs --------------------------------------------------------------

def brute_runs(words, shortest=24):
    out = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def run_text(rnd):
    words = []
    while rnd.random() < 0.8:
        names = rnd.choice([1, 2, 3, 50])
        period = [b"w%d" % rnd.randrange(names + 1) for _ in range(rnd.choice([1, 2, 5, 8, 15, 16, 17, 18, 25, 40, 77, 120]))]
        if rnd.random() < 0.4:
            words += [b"w%d" % rnd.randrange(names) for _ in range(rnd.randrange(60))]
        else:
            words += [period[i % len(period)] for i in range(rnd.randrange(0, 6 * len(period) + 20))]
    return words


def test_runs_against_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        texts = [b" ".join(run_text(rnd)) for _ in range(rnd.randrange(1, 5))]
        cut, words, begin = periodic_runs.numbered(texts)
        want = [(s + int(begin[i]), n, q) for i, w in enumerate(cut) for s, n, q in brute_runs(w)]
        assert periodic_runs.find_runs(words, len(cut), max(map(len, cut))) == sorted(want)


def test_scales_cover_every_period():
    for k, w in periodic_runs.scales(100000):
        assert w >= 1
    covered = periodic_runs.DIRECT
    for k, w in periodic_runs.scales(100000):
        assert w + k - 1 <= 2 * (covered + 1)
        covered = k
    assert covered >= 100000


def test_runs_of_rows(spark):
    rnd = random.Random(7)
    long = " ".join(f"v{k % 700}" for k in range(30000)) + " end"  # a very long text with a long period
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a  b\n" * 30), (None, "x " * 30), (5, long), (5, long)]
    rows += [(10 + k, b" ".join(run_text(rnd)).decode()) for k in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int").repartition(4)
    found = periodic_runs.word_runs(docs, plant=F.crc32(F.col("doc_id").cast("string"))).withColumn("best", periodic_runs.strongest()).collect()
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        h = None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(len(words))]
        runs = brute_runs(words) if len(words) < 5000 else [(0, 30000, 700)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
        want.append((i, runs, b" ".join(w for k, w in enumerate(words) if k not in gone).decode(), best))
    got = [(r.doc.doc_id, [tuple(x) for x in r.runs], r.collapsed, None if r.best is None else tuple(r.best)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic_runs.word_runs(docs.where("false")).count() == 0
