"""Quality classifier from weak labels (operator 8).

Overlapping heuristic labellers vote good, bad or nothing on each text. Their
accuracies are not known: expectation-maximisation over all documents estimates,
for each labeller, how often it votes what on good and on bad texts, and with them
the posterior of every pattern of votes. These posteriors label the rows on which a
hashed linear scorer is trained; the scorer then judges every whole text.

The labellers see: length; repeated neighbouring words; symbols per word; capitals;
share of short words; letters per word; share of lines that repeat in the text;
share of words without odd marks; variety of neighbouring pairs; runs of three equal words. The scorer's features are hashed shapes of words (runs of
character classes), pairs of shapes, repeats of a word and lengths of words, as
shares of the text's words.

Distribution. One narrow pass takes votes; patterns of votes are counted by Spark
(at most 3 ** labellers rows reach the driver, where EM runs). The scorer is fitted
on a bounded sample, ``train_rows`` rows picked by a hash of the id, a documented
bound; judging is one narrow pass over whole texts.

Defined cases: a null or empty text, or one without words, scores 0 and is bad;
ties at 0.5 are good; with no rows, or none of a kind, the scorer keeps to the prior;
repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tidyload.llm import common as C

LABELLERS = ("length", "repeats", "symbols", "capitals", "short_words", "letters_per_word", "repeated_lines", "plain_words",
             "pair_variety", "runs")
DIMS = 1 << 12
TRAIN_ROWS = 20_000
STEPS = 300

# Classes of bytes: 0 white space, 1 capital, 2 small letter or beyond ASCII, 3 digit, 4 sentence mark, then every other mark by itself.
CLASS = np.arange(256, dtype=np.uint8)
CLASS[CLASS < 5] = 5
CLASS[9:14] = CLASS[32] = 0
CLASS[65:91], CLASS[97:123], CLASS[128:], CLASS[48:58] = 1, 2, 2, 3
CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 4
CLASS[ord("!")] = 33


class Shapes:
    """Words of a slice of texts with what labellers and scorer look at."""

    def __init__(self, texts: list[bytes]):
        data, offsets = C.joined(texts, b"\n")
        self.n = len(texts)
        kinds = CLASS[data].copy()
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) if len(data) else np.zeros(0, np.int64)
        kinds[upper] = kinds[upper + 1] = 1
        start, end = C.word_spans(data, CLASS != 0)
        self.row = np.searchsorted(offsets, start, side="right") - 1
        self.words = np.bincount(self.row, minlength=self.n)
        hashes = C.ROLLING.spans(C.ROLLING.prefix(data), start, end)
        self.same = np.zeros(len(start), bool)
        self.same[1:] = (hashes[1:] == hashes[:-1]) & (self.row[1:] == self.row[:-1])

        self.run = self.same.copy()
        self.run[1:] &= self.same[:-1]
        pairs = C.mixed(hashes[:-1] * np.uint64(31) + hashes[1:])[self.row[1:] == self.row[:-1]]
        pair_row = self.row[1:][self.row[1:] == self.row[:-1]]
        order = np.lexsort((pairs, pair_row))
        pairs, pair_row = pairs[order], pair_row[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:] != pairs[:-1]) | (pair_row[1:] != pair_row[:-1])
        self.variety = np.bincount(pair_row[new], minlength=self.n) / np.maximum(self.words - 1, 1)

        def per_word(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return sums[end] - sums[start]

        heads = (data & 0xC0) != 0x80  # one byte of each character
        self.letters = per_word(heads & ((kinds == 1) | (kinds == 2)))
        self.capitals = per_word(heads & (kinds == 1))
        self.marks = per_word(kinds > 4)
        turn = np.ones(len(kinds), bool)  # a word's shape: its classes, each run once
        turn[1:] = kinds[1:] != kinds[:-1]
        turns = np.flatnonzero(turn & (kinds != 0))
        self.shape = C.ROLLING_2.spans(C.ROLLING_2.prefix(kinds[turns]), np.searchsorted(turns, start), np.searchsorted(turns, end))
        line_start, line_end = C.word_spans(data, np.arange(256) != 10)
        line_row = np.searchsorted(offsets, line_start, side="right") - 1
        lines = C.ROLLING.spans(C.ROLLING.prefix(data), line_start, line_end)
        order = np.lexsort((lines, line_row))
        again = np.zeros(len(lines), bool)
        again[order[1:]] = (lines[order[1:]] == lines[order[:-1]]) & (line_row[order[1:]] == line_row[order[:-1]])
        self.lines = np.bincount(line_row, minlength=self.n)
        self.lines_again = np.bincount(line_row[again], minlength=self.n)

    def share(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, flags, self.n) / np.maximum(self.words, 1)

    def votes(self) -> np.ndarray:
        """(texts, labellers): 1 good, 0 bad, -1 nothing."""
        letters = np.bincount(self.row, self.letters, self.n)

        def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
            return np.where(bad, 0, np.where(good, 1, -1))

        repeats, marks, short = self.share(self.same), self.share(self.marks > 0), self.share(self.letters <= 3)
        capitals = np.bincount(self.row, self.capitals, self.n) / np.maximum(letters, 1)
        mean, again = letters / np.maximum(self.words, 1), self.lines_again / np.maximum(self.lines, 1)
        plain, runs = self.share(self.marks == 0), self.share(self.run)
        long = self.words >= 20
        return np.column_stack([
            vote(self.words >= 50, self.words < 5),
            vote((repeats < 0.02) & long, repeats > 0.2),
            vote(marks < 0.02, marks > 0.2),
            vote(capitals < 0.15, capitals > 0.5),
            vote((short > 0.15) & (short < 0.7) & long, long & ((short < 0.05) | (short > 0.9))),
            vote((mean > 3) & (mean < 9), (mean < 1.5) | (mean > 15)),
            vote((again < 0.05) & (self.lines > 3), again > 0.3),
            vote(plain > 0.97, plain < 0.8),
            vote((self.variety > 0.7) & long, long & (self.variety < 0.4)),
            vote((runs < 0.01) & long, runs > 0.1)]).astype(np.int32)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, hashed feature and weight of every feature of every word."""
        before = np.zeros_like(self.shape)
        before[1:] = np.where(self.row[1:] == self.row[:-1], self.shape[:-1], 0)
        size = np.minimum(self.letters, 20).astype(np.uint64)
        kinds = [self.shape, self.shape * np.uint64(31) + before, size + np.uint64(1 << 40), self.same.astype(np.uint64) + np.uint64(1 << 41)]
        found = np.concatenate([(C.mixed(k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i)) >> np.uint64(52)).astype(np.int64)
                                for i, k in enumerate(kinds)])
        row = np.tile(self.row, len(kinds))
        return row, found, 1.0 / np.maximum(self.words, 1)[row]


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over patterns of votes: P(vote | class) by labeller, posterior of good
    by pattern, and the share of good texts. Started from the majority vote."""
    votes = patterns[:, :, None] == np.array([-1, 0, 1])
    yes, no = (patterns == 1).sum(axis=1), (patterns == 0).sum(axis=1)
    good = np.clip(0.5 + 0.4 * np.sign(yes - 1.5 * no - 0.5), 0.05, 0.95)
    chance, prior = np.zeros((2, patterns.shape[1], 3)), 0.5
    for _ in range(steps):
        weight = np.stack([(1 - good) * counts, good * counts])
        chance = np.einsum("cp,plv->clv", weight, votes) + 0.5
        chance /= chance.sum(axis=2, keepdims=True)
        prior = float((weight[1].sum() + 0.5) / (counts.sum() + 1.0))
        logs = np.einsum("plv,clv->pc", votes, np.log(chance)) + np.log([1 - prior, prior])
        logs = np.clip(logs[:, 1] - logs[:, 0], -50, 50)
        after = 1 / (1 + np.exp(-logs))
        done = np.abs(after - good).max(initial=0) < 1e-9
        good = after
        if done:
            break
    return chance, good, prior


def fit(row: np.ndarray, feature: np.ndarray, weight: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch gradient steps, classes weighed alike."""
    mass = np.where(goal >= 0.5, 0.5 / max((goal >= 0.5).sum(), 1), 0.5 / max((goal < 0.5).sum(), 1))
    w, b, speed, lift = np.zeros(DIMS), 0.0, np.full(DIMS, 1e-8), 1e-8
    for _ in range(STEPS):
        score = np.bincount(row, w[feature] * weight, len(goal)) + b
        error = mass * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - goal)
        slope = np.bincount(feature, error[row] * weight, DIMS) + 1e-6 * w
        speed += slope ** 2
        lift += error.sum() ** 2
        w -= 0.5 * slope / np.sqrt(speed)
        b -= 0.5 * error.sum() / np.sqrt(lift)
    return w, b


RESULT = [StructField("votes", ArrayType(IntegerType())), StructField("score", DoubleType())]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
            train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc`` (a struct of the columns in ``keep``, all by default), ``votes`` (by
    ``LABELLERS``; 1 good, 0 bad, -1 nothing), ``posterior`` (of good, from the
    votes), ``score`` (of the scorer, 0 to 1) and ``good`` of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    C.ship(spark)
    own = docs.select(C.whole(docs, keep), C.as_bytes(text_col).alias("bytes"))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(1 << 32))
    total = docs.count()
    picked = docs.where(draw < int(min(1.0, train_rows / max(total, 1)) * (1 << 32))).select(C.as_bytes(text_col).alias("bytes"))

    def vote(batches):
        import pandas as pd

        for batch in batches:
            texts = [bytes(t) for t in batch["bytes"]]
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                yield pd.DataFrame({"votes": list(Shapes(texts[part]).votes())})

    def featured(batches):
        import pandas as pd

        for batch in batches:
            texts = [bytes(t) for t in batch["bytes"]]
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                shapes = Shapes(texts[part])
                row, feature, weight = shapes.features()
                key, place = np.unique(row * DIMS + feature, return_inverse=True)
                sums = np.bincount(place, weight)
                rows, at = key // DIMS, np.searchsorted(key // DIMS, np.arange(shapes.n + 1))
                yield pd.DataFrame({"votes": list(shapes.votes()), "features": [(key[i:j] % DIMS).astype(np.int32) for i, j in zip(at, at[1:])],
                                    "weights": [sums[i:j].astype(np.float32) for i, j in zip(at, at[1:])]})

    counted = docs.select(C.as_bytes(text_col).alias("bytes")).mapInPandas(vote, "votes array<int>").groupBy("votes").count().toPandas()
    patterns = np.array(counted["votes"].to_list(), np.int64).reshape(-1, len(LABELLERS))
    _, good, prior = estimate(patterns, counted["count"].to_numpy(np.float64))
    posterior = {tuple(p): float(g) for p, g in zip(patterns.tolist(), good)}
    sample = picked.mapInPandas(featured, "votes array<int>, features array<int>, weights array<float>").toPandas()  # about train_rows
    w, b = np.zeros(DIMS), float(np.log(prior / (1 - prior)))
    if len(sample):
        lengths = sample["features"].map(len).to_numpy()
        w, b = fit(np.repeat(np.arange(len(sample)), lengths), np.concatenate(sample["features"].to_list()).astype(np.int64),
                   np.concatenate(sample["weights"].to_list()).astype(np.float64),
                   np.array([posterior.get(tuple(v), prior) for v in sample["votes"].map(list)]))
    sent = spark.sparkContext.broadcast((w, b, posterior, prior))
    out = StructType([own.schema["doc"], RESULT[0], StructField("posterior", DoubleType()), RESULT[1]])
    arrow = to_arrow_schema(out)

    def judge(batches):
        w, b, posterior, prior = sent.value
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                shapes = Shapes(texts[part])
                row, feature, weight = shapes.features()
                linear = np.bincount(row, w[feature] * weight, shapes.n) + b
                score = np.where(shapes.words > 0, 1 / (1 + np.exp(-np.clip(linear, -50, 50))), 0.0)
                votes = shapes.votes().tolist()
                yield C.appended(batch.slice(part.start, part.stop - part.start), arrow, votes=votes, score=score,
                                 posterior=[posterior.get(tuple(v), prior) for v in votes])

    return own.mapInArrow(judge, out).withColumn("good", F.col("score") >= 0.5)
