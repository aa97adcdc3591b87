"""Runs of repeating words (operator 13).

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least ``max(shortest, 3 * q)`` words, which no neighbouring word
extends. A word is dropped if a run holds it after that run's first q words.

Method. The words of many texts are numbered (equal numbers for equal words) and laid
end to end, with a number of its own between two texts. Periods up to ``DIRECT`` are
found by comparing the words with those 1, 2, .. places on. For longer ones, each
scale takes the hashes of all stretches of k words and keeps the minimum of every
window of w hashes. In a run with (w + k - 1) / 2 <= q <= k a window and the one q
words on both fit, so their minima lie q apart; and as no stretch of k >= q words
occurs twice within a period, the next equal minimum is exactly q words on. Such
pairs are the seeds; each is extended word by word, in doubling steps, to the whole
stretch in which words q apart agree. The scales follow each other so that every
period has one. A run found under a multiple of its period has the same ends (Fine
and Wilf), so the least period of equal ends is the smallest.

Distribution: one narrow pass over whole texts, nothing is shuffled; a task holds some
hundred bytes for each word of ``common.CHUNK_BYTES`` of text, or of the longest text.

Defined cases: a null or empty text has no words, no runs and an empty collapsed
text; very long texts are handled whole; repeated rows are judged one by one; other
columns are carried along whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidyload.llm import common as C

SHORTEST = 24
DIRECT = 16
"""Periods up to this one are found by comparing words directly."""

RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
RESULT = StructType([StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType())])

_TIMES = np.uint64(0x9E3779B97F4A7C15)


def scales(longest: int) -> list[tuple[int, int]]:
    """(k, w) of the scales that cover all periods from ``DIRECT`` + 1 to ``longest``."""
    out, covered = [], DIRECT
    while covered < longest:
        k = covered + 1
        while (k + 1) // 8 + k <= 2 * (covered + 1):
            k += 1
        out.append((k, max(1, k // 8)))
        covered = k
    return out


def _minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` keys."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def _seeds(sums: np.ndarray, k: int, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places x and lags d such that the k words at x and at x + d are equal minimizers."""
    hashes = C.ROLLING_2.windows(sums, k)
    if len(hashes) <= least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    chosen = _minima((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), width) & low
    at = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])].astype(np.int64)
    order = np.argsort(hashes[at], kind="stable")
    at, found = at[order], hashes[at[order]]
    same = np.flatnonzero(found[1:] == found[:-1])
    lag = at[same + 1] - at[same]
    good = (lag >= least) & (lag <= k)
    return at[same][good], lag[good]


def _agree(words: np.ndarray, x: int, lag: int, step: int) -> int:
    """How many places from x on, in direction ``step``, agree with those ``lag`` on."""
    done, size = 0, 64
    room = len(words) - lag - x if step > 0 else x + 1
    while done < room:
        size = min(size * 2, room - done)
        if step > 0:
            a = words[x + done: x + done + size]
            b = words[x + lag + done: x + lag + done + size]
        else:
            a = words[x - done - size + 1: x - done + 1][::-1]
            b = words[x + lag - done - size + 1: x + lag - done + 1][::-1]
        differ = a != b
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += size
    return done


def find_runs(words: np.ndarray, texts: int, longest: int, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), in order, of texts laid end to end: number
    ``texts`` of them, the longest of ``longest`` words, with a number of its own
    (not that of a word) after each."""
    best: dict[tuple[int, int], int] = {}

    def hold(start: int, end: int, lag: int) -> None:
        if end - start >= max(shortest, 3 * lag):
            best[start, end] = min(lag, best.get((start, end), lag))

    for lag in range(1, min(DIRECT, longest // 3) + 1):
        gaps = np.flatnonzero(words[lag:] != words[:-lag])
        edges = np.concatenate([[-1], gaps, [len(words) - lag]])
        for i in np.flatnonzero(np.diff(edges) - 1 >= max(shortest, 3 * lag) - lag):
            hold(int(edges[i]) + 1, int(edges[i + 1]) + lag, lag)
    if longest // 3 > DIRECT:
        sums = C.ROLLING_2.prefix(C.mixed(words.astype(np.uint64) * _TIMES + _TIMES))
        covered = DIRECT
        for k, width in scales(longest // 3):
            end_of: dict[int, int] = {}
            places, lags = _seeds(sums, k, width, covered + 1)
            for i in np.lexsort((places, lags)):
                x, lag = int(places[i]), int(lags[i])
                if x < end_of.get(lag, 0):
                    continue
                start = x - _agree(words, x - 1, lag, -1) if x else x
                end = x + _agree(words, x, lag, 1) + lag
                end_of[lag] = end - lag
                hold(start, end, lag)
            covered = k
    return sorted((start, end - start, lag) for (start, end), lag in best.items())


def numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, all words by number with a number of its own after
    each text, and where each text begins."""
    cut = [t.split() for t in texts]  # of bytes: at 0x20 and 0x09-0x0D
    known: dict[bytes, int] = {}
    begin = np.zeros(len(cut) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in cut], out=begin[1:])
    words = np.empty(int(begin[-1]), np.int64)
    for i, w in enumerate(cut):
        words[begin[i]: begin[i + 1] - 1] = [known.setdefault(x, len(known)) for x in w]
        words[begin[i + 1] - 1] = -1 - i
    return cut, words, begin


def periods_planted(words: list[bytes], number: int | None) -> list[bytes]:
    """The words of a text after its planted repetition: ``number`` is the crc32 of the
    id, and one text in ten repeats a stretch of its words up to its end."""
    n = len(words)
    if number is None or number % 10 or not n:
        return words
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _judge(shortest: int, schema):
    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("bytes").to_pylist()]
            plant = batch.column("plant").to_pylist()
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                planted = [t if p is None or p % 10 else b" ".join(periods_planted(t.split(), p))
                           for t, p in zip(texts[part], plant[part])]
                cut, words, begin = numbered(planted)
                found = find_runs(words, len(cut), max(map(len, cut)), shortest)
                runs = [[] for _ in cut]
                for start, length, period in found:
                    i = int(np.searchsorted(begin, start, side="right")) - 1
                    runs[i].append({"start": start - int(begin[i]), "length": length, "period": period})
                kept = []
                for w, own in zip(cut, runs):
                    if own:
                        stays = np.ones(len(w), bool)
                        for r in own:
                            stays[r["start"] + r["period"]: r["start"] + r["length"]] = False
                        w = [w[i] for i in np.flatnonzero(stays)]
                    kept.append(b" ".join(w).decode())
                rows = batch.slice(part.start, part.stop - part.start)
                yield C.appended(rows, schema, runs=runs, collapsed=kept)
    return run


def word_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, plant: Column | None = None,
              shortest: int = SHORTEST) -> DataFrame:
    """``doc`` (the columns ``keep``, all by default), ``runs`` (start, length and
    period in words, by start then period) and ``collapsed`` (the words that stay,
    joined by one space) of every row. ``plant`` (a number, or null) plants a
    repetition before the text is judged, see ``periods_planted``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    C.ship(docs.sparkSession)
    given = docs.select(C.whole(docs, keep), C.as_bytes(text_col).alias("bytes"),
                        (F.lit(None) if plant is None else plant).cast("long").alias("plant"))
    schema = StructType([given.schema["doc"], *RESULT.fields])
    return given.mapInArrow(_judge(shortest, to_arrow_schema(schema)), schema)


def strongest(runs: str = "runs") -> Column:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    def better(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when((y > x) | ((y == x) & (F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"]))), b).otherwise(a)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
