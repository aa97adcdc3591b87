"""Exact substring deduplication by prefix-free parsing (operator 5).

Rule: a byte goes if some string of ``min_bytes`` bytes covers it that also starts
in a document with a smaller id. Strings are judged on the input, never cross a
document, and overlaps count.

Method. A rolling hash of ``TRIGGER`` bytes marks triggers: a position is one if
its hash is the smallest among the positions of some string of ``min_bytes``
bytes, so every such string holds a trigger that depends on its own bytes alone,
and equal strings hold it at the same place. Triggers cut a document into
phrases: the strings that share a trigger, overlapping into the next phrase as
prefix-free parsing wants it. The parse is the row of triggers of a document, the
dictionary the distinct phrases. The rule looks at the first ``min_bytes`` bytes
of a suffix only, so the corpus order is needed only up to that depth, and there
a suffix sorts by its place in a phrase:

1. ``parse``: triggers that occur in one document cannot lie in a shared string;
   one exchange of 4-byte trigger codes finds the others.
2. ``dictionary``: phrases with a shared trigger meet by it, and each distinct
   phrase gets the smallest id that holds it. Every later holder of a phrase loses
   all strings of it, so copies of any number are settled here.
3. ``suffixes``: what is left is the first holder of a phrase whose trigger has
   other phrases too. The suffixes of these dictionary entries (once each, not once
   per occurrence) are sorted, cut at ``min_bytes`` (a suffix array of a block's part
   of the dictionary); equal neighbours form a class, and classes merge across
   blocks under a 96-bit fingerprint with the smallest id. An exchange of 4-byte
   codes first drops the suffixes that one phrase alone holds.
4. ``remove``: each block marks the bytes that phrases and classes with smaller
   ids cover.

Distribution. Documents are packed into blocks of about ``BLOCK_BYTES`` by a hash
of id and text, so that the texts of a repeated id spread (rows equal in both share
a block, however many); rows with a null id pass by. Texts are parsed once, when packed,
and their phrases go with them. The five passes read the same exchange of blocks. Each pass sends at
most one entry per distinct value and block to a bucket by the value's hash, and
the bucket answers the blocks. The number of blocks and buckets follows the bytes
of the input, so the size of a group does not; a passage that a third of the
documents share is one entry per block. Nothing is collected to the driver but
the sum of bytes.

Defined cases: a null text counts as empty; texts shorter than ``min_bytes`` keep
all bytes; rows with a null id lose nothing and cause no removal; rows with equal
ids do not remove from each other; an empty table gives an empty result.
"""

from __future__ import annotations

import inspect
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, LongType, StructField, StructType)

from tidyload.llm import common as C

TRIGGER = 28
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
PIECE = 1 << 18
"""Bytes, or strings, that one vectorised step handles: a step holds some ten numbers for each,
and a worker keeps much of what its largest step took."""
NEVER = np.iinfo(np.int64).max

MESSAGE = "bucket int, block int, kind int, a binary, b binary, c binary, d binary"
ANSWER = "block int, kind int, bucket int, a binary, b binary"
SHARED, PHRASE, FIRST, LIKELY, CLASS = 1, 2, 3, 4, 5


def _trigger(width: int) -> int:
    return TRIGGER if width > TRIGGER else max(1, width // 2)


def _small(width: int):
    """A type for places within a phrase, of which a phrase has ``width`` at most."""
    return np.uint8 if width < 256 else np.uint32


def parse(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The phrases of texts laid end to end: the first start of the strings that share
    a trigger, their number, and the trigger's start. The phrases of a text follow each
    other without a gap from its first byte on."""
    w, none = _trigger(width), np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none
    grams = C.ROLLING.windows(C.ROLLING.prefix(data), w)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, step = width - w + 1, 1  # the smallest of ``span`` neighbours, by doubling
    while step * 2 <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if span > step:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    valid = np.ones(len(data) + 1, bool)  # a string must end within its document
    tail = np.minimum(sizes, width - 1)
    ends = np.repeat(offsets[1:], tail) - (np.arange(tail.sum()) - np.repeat(np.cumsum(tail) - tail, tail)) - 1
    valid[ends] = False
    starts = np.flatnonzero(valid[: len(at)])
    if not len(starts):
        return none, none, none
    at = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), at[first]


def _parsed(texts: pa.Array, width: int) -> tuple[list[bytes], list[bytes]]:
    """Of each text the numbers of starts of its phrases, and where in them the triggers begin."""
    counts, places, small = [], [], _small(width)
    for part in C.slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), PIECE):
        data, offsets = C.joined(texts.slice(part.start, part.stop - part.start).to_pylist())
        lo, count, at = parse(data, offsets, width)
        cuts = np.searchsorted(lo, offsets)
        count, place = count.astype(small), (at - lo).astype(small)
        for i, j in zip(cuts, cuts[1:]):
            counts.append(count[i:j].tobytes())
            places.append(place[i:j].tobytes())
    return counts, places


def _pack(batches):
    """Rows of a batch with their phrases, grouped by block, each group as one compressed Arrow stream."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    for batch in batches:
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        rest = batch.drop_columns(["block", "width"])
        width = batch.column("width")[0].as_py() if len(order) else 0
        for name, values in zip(("counts", "places"), _parsed(rest.column("bytes"), width)):
            rest = rest.append_column(name, pa.array(values, pa.binary()))
        names, streams = [], []
        for rows in np.split(order, cuts) if len(order) else []:
            sink = io.BytesIO()
            part = rest.take(pa.array(rows))
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            names.append(int(blocks[rows[0]]))
            streams.append(sink.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(streams, pa.binary())], ["block", "rows"])
        del batch, rest, streams
        C.release()


class Block:
    """The documents of a block with their triggers and phrases, as parsed when packed.

    lo, hi: first and last start of the strings that share the trigger at ``at``;
    doc: the row they belong to."""

    def __init__(self, packed: pa.Table, width: int):
        tables = [pa.ipc.open_stream(x).read_all() for x in packed.column("rows").to_pylist()]
        self.table = pa.concat_tables(tables) if tables else None
        counts, places, small = [], [], _small(width)
        if self.table is None:
            self.texts, self.ids = [], np.zeros(0, np.int64)
        else:
            self.texts = self.table.column("bytes").to_pylist()
            counts, places = (self.table.column(c).to_pylist() for c in ("counts", "places"))
            ids = self.table.column("id")
            self.known = ids.is_valid().to_numpy()
            self.ids = ids.fill_null(NEVER).to_numpy().astype(np.int64)
        self.width = width
        self.data, self.offsets = C.joined(self.texts)
        own = np.fromiter((len(c) // small().itemsize for c in counts), np.int64, len(counts))
        count = np.frombuffer(b"".join(counts), small).astype(np.int64)
        before = np.cumsum(count) - count  # starts of earlier phrases of all texts
        self.doc = np.repeat(np.arange(len(own)), own)
        ahead = np.append(before, count.sum())[np.cumsum(own) - own]
        self.lo = before - ahead[self.doc] + self.offsets[:-1][self.doc]
        self.hi = self.lo + count - 1
        self.at = self.lo + np.frombuffer(b"".join(places), small)
        self.grams = self.spans(self.at, self.at + _trigger(width))

    def spans(self, start: np.ndarray, end: np.ndarray, rolling: C.Rolling = C.ROLLING) -> np.ndarray:
        """The hash of each string, from prefix sums of the ``PIECE`` bytes that it starts in."""
        out = np.empty(len(start), np.uint64)
        order = np.argsort(start, kind="stable")
        pieces = np.arange(0, len(self.data) + PIECE, PIECE)
        edges = np.searchsorted(start, pieces, sorter=order)
        for at, i, j in zip(pieces, edges, edges[1:]):
            if i < j:
                rows = order[i:j]
                prefix = rolling.prefix(self.data[at: end[rows].max()])
                out[rows] = rolling.spans(prefix, start[rows] - at, end[rows] - at)
        return out

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("lo", "hi", "at", "doc", "grams"):
            setattr(self, name, getattr(self, name)[chosen])


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _messages(block: int, kind: int, keys: np.ndarray, n: int, *columns: np.ndarray) -> list[tuple]:
    """Sorted keys and their columns, cut by bucket."""
    buckets = _buckets(keys, n)
    edges = np.flatnonzero(np.diff(buckets)) + 1
    cuts = [0, *edges.tolist(), len(keys)] if len(keys) else []
    return [(int(buckets[i]), block, kind, *(c[i:j].tobytes() for c in columns)) for i, j in zip(cuts, cuts[1:])]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW_MESSAGE = pa.schema([(n, pa.int32()) for n in ("bucket", "block", "kind")] + [(n, pa.binary()) for n in "abcd"])
_ARROW_ANSWER = pa.schema([(n, pa.int32()) for n in ("block", "kind", "bucket")] + [(n, pa.binary()) for n in "ab"])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sort order by the keys (the first counts most), and where each run of equal keys starts in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _released(run):
    """The same function of a group, of a bucket or block; what it held goes back."""
    def alone(group: pa.Table) -> pa.Table:
        out = run(group)
        C.release()
        return out

    def both(key, packed: pa.Table, told: pa.Table) -> pa.Table:
        out = run(key, packed, told)
        C.release()
        return out

    return alone if len(inspect.signature(run).parameters) == 1 else both


def _number(group: pa.Table, column: str = "block") -> int:
    return group.column(column)[0].as_py()


def _codes(keys: np.ndarray, n: int) -> np.ndarray:
    """The bucket of a value and its low 32 bits."""
    return (keys & np.uint64(0xFFFFFFFF)) | _buckets(keys, n).astype(np.uint64) << np.uint64(32)


def _announced(number: int, keys: np.ndarray, doc: np.ndarray, n: int) -> pa.Table:
    """The distinct values of a block as 4-byte codes; kind 1 if two documents of the block hold them."""
    parts, rows = 1 + len(keys) // PIECE, []
    part = (_buckets(keys, n) * parts // n).astype(np.int32)  # whole buckets, some at a time
    for p in range(parts):
        here = np.flatnonzero(part == p)
        own, owner = keys[here], doc[here]
        order, first = _runs(own, owner)
        own = own[order][first]  # once per document
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        starts = np.flatnonzero(new)
        many = np.diff(np.append(starts, len(own))) > 1
        for kind, chosen in ((0, ~many), (1, many)):
            found = own[starts[chosen]]
            rows += [r + (b"", b"", b"") for r in _messages(number, kind, found, n, found.astype(np.uint32))]
    return _table(rows, _ARROW_MESSAGE)


def _triggers(width: int, n: int):
    """Pass 1, in a block: the distinct triggers."""

    def send(group: pa.Table) -> pa.Table:
        block = Block(group, width)
        return _announced(_number(group), block.grams, block.doc, n)

    return send


def _shared(answer: int):
    """In a bucket: tell each block which of its codes two documents hold."""

    def settle(group: pa.Table) -> pa.Table:
        blocks, kinds, sent = (group.column(x).to_pylist() for x in ("block", "kind", "a"))
        codes = [np.frombuffer(x, np.uint32) for x in sent]
        every = np.sort(np.concatenate(codes))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        known = np.union1d(twice, np.concatenate([c for c, k in zip(codes, kinds) if k == 1] or [np.zeros(0, np.uint32)]))
        bucket, rows = _number(group, "bucket"), []
        for block, code in zip(blocks, codes):
            found = code[_member(code, known)]
            if len(found):
                rows.append((block, answer, bucket, found.tobytes(), b""))
        return _table(rows, _ARROW_ANSWER)

    return settle


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are among the ordered ones; a table of last bits rules out most others before the search."""
    out = np.zeros(len(values), bool)
    if len(ordered):
        last = values.dtype.type((1 << min(22, len(ordered).bit_length() + 3)) - 1)
        held = np.zeros(int(last) + 1, bool)
        held[ordered & last] = True
        at = np.flatnonzero(held[values & last])
        found = values[at]
        out[at] = ordered[np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)] == found
    return out


def _told_codes(told: pa.Table, kind: int) -> np.ndarray:
    """The codes that buckets answered, sorted."""
    rows = [r for r in told.to_pylist() if r["kind"] == kind]
    return np.sort(np.concatenate([np.frombuffer(r["a"], np.uint32) | np.uint64(r["bucket"] << 32) for r in rows] or [np.zeros(0, np.uint64)]))


def _told_ids(told: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that buckets answered, sorted, and their smallest ids."""
    rows = [r for r in told.to_pylist() if r["kind"] == kind]
    keys = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
    ids = np.concatenate([np.frombuffer(r["b"], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    order = np.argsort(keys, kind="stable")
    return keys[order], ids[order]


def _prints(block: Block) -> np.ndarray:
    """A fingerprint of each phrase: its bytes, its trigger and where that stands in it."""
    shape = ((block.hi - block.lo) << 20 | (block.at - block.lo)).astype(np.uint64)
    own = block.spans(block.lo, block.hi + block.width)
    return C.mixed(own + shape * np.uint64(0x9E3779B97F4A7C15)) ^ block.grams


def _phrases(width: int, n: int):
    """Pass 2, in a block: the distinct phrases with a shared trigger, the smallest
    id of each, and whether it occurs more than once."""

    def send(key, packed: pa.Table, told: pa.Table) -> pa.Table:
        if not packed.num_rows or not told.num_rows:
            return _table([], _ARROW_MESSAGE)
        block = Block(packed, width)
        block.keep(_member(_codes(block.grams, n), _told_codes(told, SHARED)))
        phrase = _prints(block)
        order, first = _runs(block.grams, phrase)
        if not len(first):
            return _table([], _ARROW_MESSAGE)
        least = np.minimum.reduceat(block.ids[block.doc][order], first)
        again = (np.diff(np.append(first, len(order))) > 1).astype(np.uint8)
        keys, phrase = block.grams[order][first], phrase[order][first]
        return _table(_messages(_number(packed), 0, keys, n, keys, phrase, least, again), _ARROW_MESSAGE)

    return send


def _columns(group: pa.Table, **types) -> list[list[np.ndarray]]:
    return [[np.frombuffer(x, t) for x in group.column(c).to_pylist()] for c, t in types.items()]


def _spread(order: np.ndarray, first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values by run, laid out as the entries were."""
    out = np.empty(len(order), values.dtype)
    out[order] = np.repeat(values, np.diff(np.append(first, len(order))))
    return out


def _dictionary(group: pa.Table) -> pa.Table:
    """Pass 2, in a bucket: the dictionary's entries at its triggers. A block learns
    the smallest id of each of its phrases (PHRASE) unless that is its only
    occurrence there; the block that holds it learns so (FIRST) if the trigger has
    other phrases too."""
    keys, phrase, least, again = _columns(group, a=np.uint64, b=np.uint64, c=np.int64, d=np.uint8)
    gram, entry, own, more = (np.concatenate(x) for x in (keys, phrase, least, again))
    order, first = _runs(gram, entry)
    ids = _spread(order, first, np.minimum.reduceat(own[order], first))
    grams, start = gram[order][first], np.ones(len(first), bool)
    start[1:] = grams[1:] != grams[:-1]
    heads = np.flatnonzero(start)
    several = np.repeat(np.diff(np.append(heads, len(first))) > 1, np.diff(np.append(heads, len(first))))
    several = _spread(order, first, several)
    wanted, holder = (more > 0) | (ids < own), several & (ids == own)
    bucket, rows, at = _number(group, "bucket"), [], 0
    for block, part in zip(group.column("block").to_pylist(), phrase):
        here = slice(at, at + len(part))
        told = part[wanted[here]]
        rows.append((block, PHRASE, bucket, told.tobytes(), ids[here][wanted[here]].tobytes()))
        rows.append((block, FIRST, bucket, part[holder[here]].tobytes(), b""))
        at += len(part)
    return _table([r for r in rows if r[3]], _ARROW_ANSWER)


def _told_first(told: pa.Table) -> np.ndarray:
    """The phrases that the block was told it holds first, sorted."""
    return np.sort(np.concatenate([np.frombuffer(r["a"], np.uint64) for r in told.to_pylist() if r["kind"] == FIRST] or [np.zeros(0, np.uint64)]))


def _first_held(block: Block, told: pa.Table) -> None:
    """Keep one occurrence of each phrase that the block was told it holds first."""
    phrase = _prints(block)
    mine = np.flatnonzero(_member(phrase, _told_first(told)))
    order = mine[np.lexsort((block.ids[block.doc[mine]], phrase[mine]))]
    new = np.ones(len(order), bool)
    new[1:] = phrase[order][1:] != phrase[order][:-1]
    block.keep(np.sort(order[new]))


def _expanded(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, phrase and fingerprint of every string in the block's phrases, about ``PIECE`` at a time."""
    count = block.hi - block.lo + 1
    for part in C.slices(count, PIECE):
        own = count[part]
        starts = np.repeat(block.lo[part] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        yield (starts.astype(np.int32), np.repeat(np.arange(part.start, part.stop, dtype=np.int32), own),
               block.spans(starts, starts + block.width))


def _chosen(block: Block, keys: np.ndarray, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, phrase and fingerprint of the block's strings whose ``of(fingerprint)`` is among the keys."""
    none = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64))
    parts = [none]
    for columns in _expanded(block):
        found = _member(of(columns[2]), keys)
        parts.append(tuple(c[found] for c in columns))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _suffix_array(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``starts``, cut at ``width``, and which of them, so ordered, differ
    from the one before. Their first bytes part them, and each part is sorted by itself, so that not
    all suffixes are laid out at a time."""
    strings = np.lib.stride_tricks.sliding_window_view(data, width)
    lead = np.zeros((len(starts), 8), np.uint8)
    lead[:, : min(8, width)] = np.lib.stride_tricks.sliding_window_view(data, min(8, width))[starts]
    lead = lead.view(">u8").ravel().astype(np.uint64)
    order = np.argsort(lead, kind="stable")
    lead = lead[order]
    heads = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))
    wanted = np.arange(0, len(order), max(1, 8 * PIECE // width))
    cuts = np.append(np.unique(heads[np.searchsorted(heads, wanted, side="right") - 1]), len(order))
    new = np.ones(len(order), bool)
    for i, j in zip(cuts, cuts[1:]):
        cut = strings[starts[order[i:j]]]
        own = np.argsort(np.ascontiguousarray(cut).view(f"S{width}" if (cut != 0).all() else f"V{width}").ravel(), kind="stable")
        cut = cut[own]
        order[i:j] = order[i:j][own]
        new[i + 1:j] = (cut[1:] != cut[:-1]).any(axis=1)
    return order, new


def _candidates(width: int, n: int):
    """Pass 3, in a block: the suffixes, cut at ``width``, of the dictionary's
    phrases that it holds first and that have others at their trigger."""

    def send(key, packed: pa.Table, told: pa.Table) -> pa.Table:
        if not packed.num_rows or not told.num_rows:
            return _table([], _ARROW_MESSAGE)
        block = Block(packed, width)
        _first_held(block, told)
        parts = [(phrase, one) for _, phrase, one in _expanded(block)]
        phrase, one = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.uint64))
        return _announced(_number(packed), one, phrase, n)

    return send


def _suffixes(width: int, n: int):
    """Pass 4, in a block: sort these suffixes if two phrases may hold them; one
    entry for each run of equal neighbours."""

    def send(key, packed: pa.Table, told: pa.Table) -> pa.Table:
        if not packed.num_rows or not told.num_rows:
            return _table([], _ARROW_MESSAGE)
        block = Block(packed, width)
        _first_held(block, told)
        starts, phrase, _ = _chosen(block, _told_codes(told, LIKELY), lambda one: _codes(one, n))
        doc = block.doc[phrase]
        if not len(starts):
            return _table([], _ARROW_MESSAGE)
        order, new = _suffix_array(block.data, starts, width)
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(block.ids[doc][order], first)
        starts = starts[order][first].astype(np.int64)
        one, two = block.spans(starts, starts + width), block.spans(starts, starts + width, C.ROLLING_2).astype(np.uint32)
        order = np.lexsort((two, one))
        one, two, least = one[order], two[order], least[order]
        return _table([r + (b"",) for r in _messages(_number(packed), 0, one, n, one, two, least)], _ARROW_MESSAGE)

    return send


def _one_class(group: pa.Table) -> pa.Table:
    """Pass 4, in a bucket: the smallest id of each class of equal strings."""
    one, two, least = _columns(group, a=np.uint64, b=np.uint32, c=np.int64)
    order, first = _runs(np.concatenate(one), np.concatenate(two))
    ids = _spread(order, first, np.minimum.reduceat(np.concatenate(least)[order], first))
    bucket, rows, at = _number(group, "bucket"), [], 0
    for block, own in zip(group.column("block").to_pylist(), one):
        rows.append((block, CLASS, bucket, own.tobytes(), ids[at: at + len(own)].tobytes()))
        at += len(own)
    return _table(rows, _ARROW_ANSWER)


def _removed(width: int, whole_chars: bool, schema: pa.Schema):
    """Pass 5, in a block: the removed spans and the bytes that stay. A class can remove strings
    of the phrases that the block holds first only: those of all later holders go with the phrase."""

    def finish(key, packed: pa.Table, told: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return schema.empty_table()
        block = Block(packed, width)
        own = np.where(block.known, block.ids, np.iinfo(np.int64).min)
        depth = np.zeros(len(block.data) + 1, np.int32)
        if told.num_rows:
            keys, ids = _told_ids(told, PHRASE)
            prints = _prints(block)
            later = np.flatnonzero(_member(prints, keys))
            if len(later):
                later = later[ids[np.searchsorted(keys, prints[later])] < own[block.doc[later]]]
                np.add.at(depth, block.lo[later], 1)
                np.add.at(depth, block.hi[later] + width, -1)
            held = _member(prints, _told_first(told))
            held[later] = False
            block.keep(held)
            classes, least = _told_ids(told, CLASS)
            starts, phrase, one = _chosen(block, classes, lambda one: one)
            if len(starts):
                gone = starts[least[np.searchsorted(classes, one)] < own[block.doc[phrase]]]
                np.add.at(depth, gone, 1)
                np.add.at(depth, gone + width, -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        if whole_chars and len(gone):
            heads = np.flatnonzero((block.data & 0xC0) != 0x80)
            gone = np.repeat(np.logical_and.reduceat(gone, heads), np.diff(np.append(heads, len(gone))))
        spans, kept = [], []
        for text, i, j in zip(block.texts, block.offsets, block.offsets[1:]):
            flags = np.zeros(j - i + 2, np.int8)
            flags[1:-1] = gone[i:j]
            edges = np.diff(flags)
            start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end)])
            kept.append(text if not len(start) else block.data[i:j][~gone[i:j]].tobytes())
        table = block.table.select(["doc"])
        for name, values in (("removed_spans", spans), ("kept_bytes", kept)):
            table = table.append_column(schema.field(name), pa.array(values, schema.field(name).type))
        return table.cast(schema)

    return finish


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 50,
                     keep: list[str] | None = None, whole_chars: bool = False) -> DataFrame:
    """Remove repeated strings of ``min_bytes`` bytes or more, keeping those in the
    document with the smallest id.

    Returns ``doc`` (a struct of the columns in ``keep``, the id alone by default),
    ``removed_spans`` (array of start and end, in bytes of the input text) and
    ``kept_bytes`` (what stays, joined). With ``whole_chars`` a character of which
    only some bytes are covered stays. See the module text for the defined cases.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if min_bytes < 2:
        raise ValueError("min_bytes must be 2 or more")
    C.ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), C.as_bytes(text_col).alias("bytes"), C.whole(docs, keep or [id_col]))
    nameless, own = own.where("id is null"), own.where("id is not null")
    total = own.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    blocks, buckets = 1 + total // BLOCK_BYTES, 1 + total // BUCKET_BYTES
    by_block = own.withColumn("block", F.pmod(F.xxhash64("id", "bytes"), F.lit(blocks)).cast("int")).withColumn(
        "width", F.lit(min_bytes)).mapInArrow(_pack, "block int, rows binary").groupBy("block")

    def ask(messages: DataFrame, settle) -> DataFrame:
        return messages.groupBy("bucket").applyInArrow(_released(settle), ANSWER)

    def told(send, answers: DataFrame) -> DataFrame:
        return by_block.cogroup(answers.groupBy("block")).applyInArrow(_released(send), MESSAGE)

    shared = ask(by_block.applyInArrow(_released(_triggers(min_bytes, buckets)), MESSAGE), _shared(SHARED))
    entries = ask(told(_phrases(min_bytes, buckets), shared), _dictionary)
    first = entries.where(F.col("kind") == FIRST)
    likely = ask(told(_candidates(min_bytes, buckets), first), _shared(LIKELY))
    classes = ask(told(_suffixes(min_bytes, buckets), first.unionByName(likely)), _one_class)
    out = StructType([own.schema["doc"],
                      StructField("removed_spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
                      StructField("kept_bytes", BinaryType())])
    answers = entries.unionByName(classes)
    found = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _released(_removed(min_bytes, whole_chars, to_arrow_schema(out))), out)
    return found.unionByName(nameless.select(
        "doc", F.array().cast(out["removed_spans"].dataType).alias("removed_spans"), F.col("bytes").alias("kept_bytes")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 100) -> DataFrame:
    """The documents with their own columns, repeated strings cut out of the texts
    (whole characters only). A null text stays null; ``n_chars``, if there, follows the text."""
    others = [c for c in docs.columns if c != text_col]  # the text itself travels once, as bytes
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), C.whole(docs, others).alias("rest"),
                       F.col(text_col).isNull().alias("missing"))
    found = dedup_substrings(rows, "id", "text", min_bytes, keep=["rest", "missing"], whole_chars=True)
    text = F.when(~F.col("doc.missing"), F.col("kept_bytes").cast("string"))
    fresh = {text_col: text, "n_chars": F.char_length(text)}
    return found.select(*[(fresh[f.name].cast(f.dataType) if f.name in fresh else F.col(f"doc.rest.`{f.name}`")).alias(f.name)
                          for f in docs.schema])
