"""Language of texts and of spans in mixed texts (operator 7).

Learned: how often each hashed letter trigram (with word edges) occurs in each
language, and the scripts it is written in. A word's script narrows the candidate
languages; its score under each is the sum of its trigrams' log probabilities; a
Viterbi search over the words of a text, in which a switch of language costs
``SWITCH``, labels spans. The language of a text is the one with the most labelled
letters, the score their share. Every word gets a learned language; a word is known
to it if the language uses one of the word's scripts and the word's trigrams are
likelier in it than buckets drawn at random, on average: trigrams at random are less
likely than those, the language's own are more.

Training uses the labelled rows the caller admits, at most about ``per_language``
of each language (picked by a hash of the id, so the sample is the same each time;
a documented bound). Counts are summed by Spark; what is broadcast is one table of
``BUCKETS`` floats a language (fewer beyond 512 languages, see ``TABLE_CELLS``). Prediction is one narrow pass over whole texts in
slices of bounded bytes, nothing is shuffled; the search runs step by step over all
texts of a slice at once, the longest first.

Defined cases: a null text or one without letters is ``und`` with score 0, and so
is every text if nothing could be learned (``known_language`` then keeps all texts
with letters); ties go to the language first by code
point; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tidyload.llm import common as C

BUCKETS = 1 << 16
SWITCH = 12.0
PER_LANGUAGE = 20_000
TABLE_CELLS = 1 << 25
"""Cells (bucket and language) of the learned table at most: 128 MiB of floats. Up to 512
languages have ``BUCKETS`` buckets each; with more, buckets are halved until all fit."""
FAR = -60.0
UNKNOWN = "und"

# First code points of the script ranges (Unicode blocks, joined where one script follows itself).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2C00, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter, and the bit of its script (0 for no letter)."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    names = list(dict.fromkeys(name for _, name in SCRIPTS))
    bits = np.zeros(0x110000, np.uint32)
    for (start, name), end in zip(SCRIPTS, [s for s, _ in SCRIPTS[1:]] + [0x110000]):
        bits[start:end] = 1 << names.index(name)
    return letter, np.where(letter, bits, 0).astype(np.uint32)


@dataclass
class Letters:
    """The words of a slice of texts: letters, their trigram buckets and scripts,
    the words' first letters, places and texts."""

    buckets: np.ndarray
    scripts: np.ndarray
    first: np.ndarray
    size: np.ndarray
    place: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Letters:
        letter, script = tables()
        decoded = [t.decode("utf-8", "replace") for t in texts]
        lower = [low if len(low := t.lower()) == len(t) else "".join(c if len(c.lower()) != 1 else c.lower() for c in t) for t in decoded]
        points = np.frombuffer("\n".join(["", *lower, ""]).encode("utf-32-le", "replace"), np.uint32)
        offsets = np.cumsum([1, *(len(t) + 1 for t in lower)])
        inside = letter[points]
        padded = np.where(inside, points, 0).astype(np.uint64)
        at = np.flatnonzero(inside)
        grams = (padded[at - 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (padded[at] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (
            padded[at + 1] * np.uint64(0xD6E8FEB86659FD93))
        buckets = (C.mixed(grams) >> np.uint64(48)).astype(np.int64)
        start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        first = np.searchsorted(at, start)
        row = np.searchsorted(offsets, start, side="right") - 1
        return cls(buckets, script[points[at]], first, np.diff(np.append(first, len(at))), start - offsets[row], row)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages), log probabilities
    scripts: np.ndarray  # by language, the bits of its scripts


def admitted(id_col: str) -> Column:
    """The rows that training may use: not held out, by the id's checksum."""
    return ~F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def buckets_for(languages: int) -> int:
    """Buckets of a learned table for so many languages."""
    buckets = BUCKETS
    while buckets * languages > TABLE_CELLS and buckets > 1:
        buckets //= 2
    return buckets


def slice_bytes(limit: int, model: Model) -> int:
    """Text bytes of a slice: a word has a number for each language, so many languages make slices smaller."""
    return max(1, limit * 32 // max(32, len(model.languages)))


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the rows whose language is not null."""
    C.ship(rows.sparkSession)
    known = rows.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(1 << 32)).alias("draw"),
        C.as_bytes(text_col).alias("bytes"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    buckets = buckets_for(len(sizes))
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.uint32))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    picked = known.where(F.col("draw") < share[F.col("lang")] * float(1 << 32)).select("lang", "bytes")
    n_scripts = len({name for _, name in SCRIPTS})

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, some in batch.groupby("lang")["bytes"]:
                texts = [bytes(t) for t in some]
                held = sums.setdefault(lang, np.zeros(buckets + n_scripts, np.int64))
                for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), SHARE_BYTES):
                    letters = Letters.of(texts[part])
                    held[:buckets] += np.bincount(letters.buckets & (buckets - 1), minlength=buckets)
                    held[buckets:] += [np.count_nonzero(letters.scripts & (1 << s)) for s in range(n_scripts)]
        C.release()
        for lang, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": held[at]})

    counted = picked.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    sums = np.zeros((buckets + n_scripts, len(languages)), np.float32)
    number = {lang: i for i, lang in enumerate(languages)}
    sums[counted["bucket"], counted["lang"].map(number).to_numpy(np.int64)] = counted["n"]
    grams, scripts = sums[:buckets], sums[buckets:]
    logs = np.empty(grams.shape, np.float32)
    for i in range(len(languages)):
        seen = grams[:, i].astype(float)
        logs[:, i] = np.log(seen + 0.5) - np.log(seen.sum() + 0.5 * buckets)
    used = scripts >= np.maximum(1, 0.001 * scripts.sum(axis=0))
    return Model(languages, logs, (used * (1 << np.arange(n_scripts))[:, None]).sum(axis=0).astype(np.uint32))


def label(letters: Letters, model: Model, n_rows: int) -> np.ndarray:
    """The language number of every word: the best path of each text."""
    n_langs = len(model.languages)
    emitted = np.add.reduceat(model.scores[letters.buckets & (len(model.scores) - 1)], letters.first, axis=0) if len(letters.first) else np.zeros((0, n_langs))
    if len(letters.first):
        written = np.bitwise_or.reduceat(letters.scripts, letters.first)
        candidate = (written[:, None] & model.scripts[None, :]) != 0
        narrowed = candidate.any(axis=1) & ~candidate.all(axis=1)
        emitted[narrowed] += np.where(candidate[narrowed], 0.0, FAR)
    begin = np.searchsorted(letters.row, np.arange(n_rows + 1))
    length = np.diff(begin)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[:-1][order], length[order]
    steps = int(length[0]) if n_rows else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # texts with more words than the step
    out = np.zeros(len(letters.first), np.int64)
    best, moved, source = np.zeros((n_rows, n_langs)), [], []
    for t in range(steps):
        n = active[t]
        if t:
            value = best[:n]
            top = value.argmax(axis=1)
            jump = value[np.arange(n), top][:, None] - SWITCH
            moved.append(jump > value)
            source.append(top)
            best[:n] = np.maximum(value, jump)
        best[:n] += emitted[begin[:n] + t]
    now = best.argmax(axis=1) if n_langs else np.zeros(n_rows, np.int64)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        out[begin[:n] + t] = now[:n]
        if t:
            now[:n] = np.where(moved[t - 1][np.arange(n), now[:n]], source[t - 1], now[:n])
    return out


def known_share(letters: Letters, named: np.ndarray, model: Model, n_rows: int) -> np.ndarray:
    """By text, the share of its letters in words known to their language (0 without
    letters). If no letter was learned, there is nothing to tell by and all count."""
    total = np.bincount(letters.row, letters.size, n_rows)
    if not len(letters.first) or not model.scripts.any():
        return (total > 0).astype(float)
    gained = np.add.reduceat(model.scores[letters.buckets & (len(model.scores) - 1), np.repeat(named, letters.size)] + np.log(len(model.scores)), letters.first)
    written = np.bitwise_or.reduceat(letters.scripts, letters.first)
    known = (gained > 0) & ((written & model.scripts[named]) != 0)
    return np.bincount(letters.row, letters.size * known, n_rows) / np.maximum(total, 1)


SPAN = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("lang", StringType())])
RESULT = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("lang_spans", ArrayType(SPAN))]
KNOWN = StructField("known", DoubleType())
SLICE_BYTES = 4 << 20
SHARE_BYTES = 1 << 20


def _judged(texts: list[bytes], model: Model, known: bool = False) -> dict[str, list]:
    letters, n, n_langs = Letters.of(texts), len(texts), len(model.languages)
    named = label(letters, model, n) if n_langs else np.zeros(len(letters.first), np.int64)
    more = {KNOWN.name: known_share(letters, named, model, n).tolist()} if known else {}
    if not n_langs:
        return {"lang_pred": [UNKNOWN] * n, "score": [0.0] * n, "lang_spans": [[] for _ in range(n)], **more}
    share = np.bincount(letters.row * n_langs + named, letters.size, n * n_langs).reshape(n, n_langs)
    total, top = share.sum(axis=1), share.argmax(axis=1)
    score = np.where(total > 0, share[np.arange(n), top] / np.maximum(total, 1), 0.0)
    spans: list[list] = [[] for _ in range(n)]
    if len(named):
        edge = np.flatnonzero((named[1:] != named[:-1]) | (letters.row[1:] != letters.row[:-1]))
        for i, j in zip(np.append(0, edge + 1), np.append(edge, len(named) - 1)):
            spans[letters.row[i]].append({"start": int(letters.place[i]), "end": int(letters.place[j] + letters.size[j]),
                                          "lang": model.languages[named[i]]})
    return {"lang_pred": [model.languages[k] if s else UNKNOWN for k, s in zip(top, total)], "score": score.tolist(), "lang_spans": spans, **more}


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
             known: bool = False) -> DataFrame:
    """``doc`` (a struct of the columns in ``keep``, all by default), ``lang_pred``,
    ``score`` and ``lang_spans`` (start and end in characters, language) of every row;
    with ``known``, also the share of its letters in ``known`` words."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    C.ship(spark)
    own = docs.select(C.whole(docs, keep), C.as_bytes(text_col).alias("bytes"))
    out = StructType([own.schema["doc"], *RESULT, *[KNOWN] * known])
    arrow, sent = to_arrow_schema(out), spark.sparkContext.broadcast((model.languages, model.scores, model.scripts))

    def run(batches):
        held = Model(*sent.value)
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), slice_bytes(SLICE_BYTES, held)):
                yield C.appended(batch.slice(part.start, part.stop - part.start), arrow, **_judged(texts[part], held, known))

    return own.mapInArrow(run, out)


def shares_known(spark: SparkSession, model: Model):
    """A function of a text's bytes: the share of its letters in known words. Only the
    text goes to Python and one number comes back, in slices of ``SHARE_BYTES``."""
    C.ship(spark)
    sent = spark.sparkContext.broadcast((model.languages, model.scores, model.scripts))

    @F.pandas_udf("double")
    def share(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = Model(*sent.value)
        for batch in batches:
            texts, out = [bytes(t) for t in batch], []
            for part in C.slices(np.fromiter(map(len, texts), np.int64, len(texts)), slice_bytes(SHARE_BYTES, held)):
                out += _judged(texts[part], held, known=True)[KNOWN.name]
            yield pd.Series(out, dtype=float)
            del batch, texts
            C.release()

    return share


def known_language(docs: DataFrame, id_col: str = "doc_id", least: float = 0.25, text_col: str = "text", **options) -> DataFrame:
    """The documents, with their own columns, of whose letters a share of ``least``
    is in words known to learned languages, however many there are: others (no
    letters, unlearned scripts, letters at random) go. Texts in an unlearned
    language that is written and spelt much like a learned one may stay. If nothing
    could be learned (no admitted row has a language and letters), all documents
    with letters stay."""
    model = train(docs.where(admitted(id_col)), id_col, text_col, **options)
    rows = docs.select(C.whole(docs), shares_known(docs.sparkSession, model)(C.as_bytes(text_col)).alias("known"))
    return rows.where((F.col("known") >= least) & (F.col("known") > 0)).select("doc.*")
