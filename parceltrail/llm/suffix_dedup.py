"""Operator 3: removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when a WIDTH-byte string that covers it also starts in a document of smaller doc_id. Every such string (window)
is named by its anchor, the GRAM-byte piece of smallest hash in it, so equal windows have equal anchors; windows that follow
each other under one anchor travel as one context. In three steps:

1. Which anchors occur twice? Chunks of documents send the sorted hashes of their anchors to buckets, and get back those
   that another document holds too. An anchor that very many chunks hold is marked hot.
2. Chunks send the contexts of these anchors to buckets (of a hot anchor: window by window, each to the bucket of its own
   hash). Of equal contexts in a chunk only the smallest document's is sent; the others are repeats already. Buckets sort
   contexts as suffixes: a mergesort whose comparison finds the common extension of two suffixes by binary search over
   prefix polynomial hashes. Neighbours that are equal by hash are verified byte by byte. Where contexts of an anchor
   differ, their windows are sorted the same way. (A string whose hash no other has needs no place in the order.)
3. Chunks get back the repeated windows of their documents and cut them out.

Texts are shuffled once: all three steps read one exchange by chunk. No group grows with the number of documents: chunks and
buckets have a set size, and a hot anchor's windows leave one context per chunk.

A null text counts as empty; texts under WIDTH bytes stay whole. A null doc_id counts as larger than any. Documents of one
doc_id don't remove each other's bytes; repeated rows have the same result. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail.llm.bpe import spans
from parceltrail.llm.common import byte_view, documents
from parceltrail.llm.rolling import PrefixHash, distinct, mixed

WIDTH, GRAM = 50, 20
CHUNK_BYTES, BUCKET_ANCHORS, HOT_CHUNKS = 2_000_000, 250_000, 1024
#: Bytes of text for each partition of the exchanges, where that makes more of them than the session has.
PART_BYTES = 64 << 20
LAST = np.iinfo(np.int64).max
_PLACE = np.uint64((1 << 31) - 1)


# ---- suffix sort


class Suffixes:
    """Pieces of a byte array (starts, sizes), compared in a logarithmic number of hash probes."""

    def __init__(self, data: np.ndarray, hashes: PrefixHash, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.data, self.hashes, self.starts, self.sizes = data, hashes, starts, sizes

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of pieces x and y, by binary search over prefix hashes."""
        a, b = self.starts[x], self.starts[y]
        high = np.minimum(self.sizes[x], self.sizes[y])
        low = high.copy()
        # Pieces that agree in all of the shorter one are many, and one probe tells them.
        todo = np.flatnonzero(self.hashes.of(a, a + high) != self.hashes.of(b, b + high))
        low[todo] = 0
        high[todo] -= 1
        while len(todo := todo[low[todo] < high[todo]]):
            middle = (low[todo] + high[todo] + 1) // 2
            same = self.hashes.of(a[todo], a[todo] + middle) == self.hashes.of(b[todo], b[todo] + middle)
            low[todo] = np.where(same, middle, low[todo])
            high[todo] = np.where(same, high[todo], middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """True where piece x is smaller than piece y."""
        n = self.common(x, y)
        over = (n >= self.sizes[x]) | (n >= self.sizes[y])
        at = np.where(over, 0, n)
        top = len(self.data) - 1
        smaller = self.data[np.minimum(self.starts[x] + at, top)] < self.data[np.minimum(self.starts[y] + at, top)]
        return np.where(over, self.sizes[x] < self.sizes[y], smaller)

    def leading(self, offset: int) -> np.ndarray:
        """Eight bytes of every piece as a number; what lies beyond its end counts 0."""
        out = np.zeros(len(self.starts), np.uint64)
        for k in range(offset, offset + 8):
            inside = k < self.sizes
            value = np.where(inside, self.data[np.minimum(self.starts + k, len(self.data) - 1)], 0)
            out = out << np.uint64(8) | value.astype(np.uint64)
        return out

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """(pieces in order, True where a piece equals the one before it), equality verified byte by byte."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        first, second = self.leading(0), self.leading(8)
        order = np.lexsort((second, first))
        # Runs of one leading are merged bottom up; all runs at once, each element finding its rank in the other half.
        cut = np.r_[True, (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])]
        begin = np.flatnonzero(cut)
        stop = np.r_[begin[1:], n]
        run_of = np.cumsum(cut) - 1
        active = np.flatnonzero((stop - begin)[run_of] > 1)
        half = 1
        while len(active):
            base, end = begin[run_of[active]], stop[run_of[active]]
            at = active - base
            pair = at // (2 * half) * (2 * half)
            middle = np.minimum(base + pair + half, end)
            upper = np.minimum(base + pair + 2 * half, end)
            left = active < middle
            low, high = np.where(left, middle, base + pair), np.where(left, upper, middle)
            start = low.copy()
            me = order[active]
            while (todo := np.flatnonzero(low < high)).size:
                probe = (low[todo] + high[todo]) // 2
                other, own = order[probe], me[todo]
                # An element of the left half goes before its equals in the right half.
                goes = np.where(left[todo], self.before(other, own), ~self.before(own, other))
                low[todo], high[todo] = np.where(goes, probe + 1, low[todo]), np.where(goes, high[todo], probe)
            place = np.where(left, active + low - start, active - (middle - base - pair) + low - start)
            order[place] = me
            half *= 2
            active = active[(end - base) > half]
        equal = np.zeros(n, bool)
        x, y = order[:-1], order[1:]
        whole = self.hashes.of(self.starts, self.starts + self.sizes)
        equal[1:] = (self.sizes[x] == self.sizes[y]) & (whole[x] == whole[y])
        hit = np.flatnonzero(equal)
        ours, ends = spans(self.data, self.starts[order[hit]], self.starts[order[hit]] + self.sizes[order[hit]])
        theirs, _ = spans(self.data, self.starts[order[hit - 1]], self.starts[order[hit - 1]] + self.sizes[order[hit - 1]])
        if (ours != theirs).any():
            return self._plain()
        return order, equal

    def _plain(self) -> tuple[np.ndarray, np.ndarray]:
        """The same order without hashes, for pieces among which two different ones share a hash."""
        raw = self.data.tobytes()
        pieces = [raw[a : a + s] for a, s in zip(self.starts.tolist(), self.sizes.tolist())]
        order = np.array(sorted(range(len(pieces)), key=pieces.__getitem__), np.int64)
        return order, np.array([k > 0 and pieces[order[k]] == pieces[order[k - 1]] for k in range(len(order))], bool)


def lowest_of_equals(pieces: Suffixes, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each piece's class of equals, smallest rank in the class).

    A piece whose hash no other has equals no other; the rest are sorted.
    """
    _, which = distinct(pieces.hashes.of(pieces.starts, pieces.starts + pieces.sizes))
    alone = (np.bincount(which) == 1)[which] if len(which) else np.zeros(0, bool)
    shared = np.flatnonzero(~alone)
    part = Suffixes(pieces.data, pieces.hashes, pieces.starts[shared], pieces.sizes[shared])
    order, equal = part.order()
    number = np.empty(len(rank), np.int64)
    number[shared[order]] = np.cumsum(~equal) - 1
    classes = int((~equal).sum())
    number[alone] = classes + np.arange(alone.sum())
    lowest = np.full(classes + int(alone.sum()), LAST)
    np.minimum.at(lowest, number, rank)
    return number, lowest


# ---- anchors


def anchors(data: np.ndarray, bounds: np.ndarray, hashes: PrefixHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor's place, anchor's hash) of each run of windows under one anchor."""
    n = len(data)
    if n < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = mixed(hashes.all_of(GRAM))
    key = grams & ~_PLACE | np.arange(n - GRAM + 1, dtype=np.uint64)
    lowest, covered, reach = key, 1, WIDTH - GRAM + 1
    while covered < reach:
        step = min(covered, reach - covered)
        lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
        covered += step
    place = (lowest & _PLACE).astype(np.int64)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, bounds[:-1], 1)
    np.add.at(change, np.maximum(bounds[1:] - WIDTH + 1, bounds[:-1]), -1)
    whole = np.cumsum(change)[: len(place)] > 0
    new = np.r_[True, (place[1:] != place[:-1]) | ~whole[:-1]] & whole
    first = np.flatnonzero(new)
    past = np.flatnonzero(whole & ~np.r_[whole[1:] & (place[1:] == place[:-1]), False]) + 1
    return first, past - first, place[first], grams[place[first]]


def short(hashes: np.ndarray) -> np.ndarray:
    """47 bits of a hash, the lowest bit left free for a mark."""
    return hashes >> np.uint64(17) << np.uint64(1)


def six(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Chunk:
    """The documents of one chunk: bytes, bounds, rank (doc_id, null last) and identity."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        self.data, self.bounds = byte_view(table.column("text"))
        self.rank = table.column("rank").to_numpy().astype(np.int64)
        self.mark = table.column("mark").to_numpy().astype(np.int64)

    @functools.cached_property
    def hashes(self) -> PrefixHash:
        return PrefixHash(self.data)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, at, side="right") - 1


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of runs in a sorted array."""
    if len(bucket):
        cut = np.flatnonzero(np.diff(bucket)) + 1
        yield from zip(bucket[np.r_[0, cut]].tolist(), np.r_[0, cut].tolist(), np.r_[cut, len(bucket)].tolist())


def rows(names: list[str], kinds: list[pa.DataType], columns: list[list]) -> pa.Table:
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# ---- steps


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Rows of each key from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        for value, a, b in by_bucket(batch.column(key).to_numpy()):
            if held and value != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = value
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def send_anchors(buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        first, _, _, grams = anchors(chunk.data, chunk.bounds, chunk.hashes)
        document = chunk.document(first)
        order = np.argsort(grams, kind="stable")
        grams, document = grams[order], document[order]
        start = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
        many = np.minimum.reduceat(document, start) != np.maximum.reduceat(document, start) if len(start) else np.zeros(0, bool)
        grams = grams[start]
        marked = short(grams) | many.astype(np.uint64)
        parts = [(b, key[0].as_py(), six(marked[i:j])) for b, i, j in by_bucket(bucket_of(grams, buckets))]
        return rows(["bucket", "chunk", "sent"], [pa.int64(), pa.int64(), pa.binary()], [list(c) for c in zip(*parts)] or [[], [], []])

    return run


def answer_anchors(hot_chunks: int):
    """(chunk, held): for each chunk its anchors that more than one document holds, marked where very many chunks do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in grouped(batches, "bucket"):
            sent = [from_six(raw) for raw in table.column("sent").to_pylist()]
            chunk = np.repeat(table.column("chunk").to_numpy(), [len(s) for s in sent])
            value = np.concatenate(sent)
            key, many = value >> np.uint64(1), (value & np.uint64(1)).astype(bool)
            _, which, count = np.unique(key, return_inverse=True, return_counts=True)
            repeated = np.bincount(which, many) > 0
            keep = np.flatnonzero((repeated | (count > 1))[which])
            keep = keep[np.argsort(chunk[keep], kind="stable")]
            out = key[keep] << np.uint64(1) | (count[which[keep]] >= hot_chunks).astype(np.uint64)
            parts = [(c, six(out[i:j])) for c, i, j in by_bucket(chunk[keep])]
            if parts:
                yield from rows(["chunk", "held"], [pa.int64(), pa.binary()], [list(c) for c in zip(*parts)]).to_batches()

    return run


def packed(rank: np.ndarray, mark: np.ndarray, chunk: np.ndarray, place: np.ndarray, count: np.ndarray, offset: np.ndarray, text: np.ndarray) -> bytes:
    head = np.array([len(rank)], "<u4").tobytes()
    parts = (rank.astype("<i8"), mark.astype("<i8"), chunk.astype("<i8"), place.astype("<u4"), count.astype("<u1"), offset.astype("<u1"), text)
    return zlib.compress(head + b"".join(p.tobytes() for p in parts), 1)


def unpacked(raw: bytes) -> list[np.ndarray]:
    raw = zlib.decompress(raw)
    n, at = int(np.frombuffer(raw, "<u4", 1)[0]), 4
    out = []
    for kind in ("<i8", "<i8", "<i8", "<u4", "<u1", "<u1"):
        out.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
        at += out[-1].shape[0] * np.dtype(kind).itemsize
    return [*out, np.frombuffer(raw, np.uint8, offset=at)]


HOT_OFFSET = 255
CONTEXTS = "bucket long, chunk long, kind int, sent binary"


def repeats(rank: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    """Repeated stretches of documents; stretches of one document that touch are joined first."""
    order = np.lexsort((start, mark, rank))
    rank, mark, start, stop = rank[order], mark[order], start[order], stop[order]
    # Stretches come sorted and no shorter than WIDTH; a new one begins where the last one's end is passed.
    new = np.ones(len(rank), bool)
    same = (rank[1:] == rank[:-1]) & (mark[1:] == mark[:-1])
    group = np.r_[0, np.cumsum(~same)]
    far = np.maximum.accumulate(stop + group * (1 << 32)) - group * (1 << 32)
    new[1:] = ~same | (start[1:] > far[:-1])
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(rank)] - 1
    return b"".join(x.astype("<i8").tobytes() for x in (rank[head], mark[head], start[head], far[tail])) if len(head) else b""


def send_contexts(buckets: int):
    names, kinds = ["bucket", "chunk", "kind", "sent"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not table.num_rows:
            return rows(names, kinds, [[], [], [], []])
        chunk, number = Chunk(table), key[0].as_py()
        held = np.concatenate([from_six(raw) for raw in answers.column("held").to_pylist()])
        held = held[np.argsort(held >> np.uint64(1))]
        first, count, place, grams = anchors(chunk.data, chunk.bounds, chunk.hashes)
        short_key = short(grams) >> np.uint64(1)
        at = np.minimum(np.searchsorted(held >> np.uint64(1), short_key), len(held) - 1)
        met = (held[at] >> np.uint64(1)) == short_key
        hot = met & ((held[at] & np.uint64(1)) == 1)
        cold = met & ~hot
        # Of a hot anchor every window is a context of its own.
        window = np.repeat(first[hot], count[hot]) + np.arange(count[hot].sum()) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
        start = np.r_[first[cold], window]
        size = np.r_[count[cold], np.ones(len(window), np.int64)] + WIDTH - 1
        offset = np.r_[place[cold] - first[cold], np.full(len(window), HOT_OFFSET)]
        content = mixed(chunk.hashes.of(start, start + size))
        route = np.r_[grams[cold], content[len(content) - len(window) :]]
        document = chunk.document(start)
        rank, mark, inside = chunk.rank[document], chunk.mark[document], start - chunk.bounds[document]
        # Equal contexts in this chunk: all but those of the smallest document are repeats already.
        model, which = distinct(content)
        lowest = np.full(len(model), LAST)
        np.minimum.at(lowest, which, rank)
        later = np.flatnonzero((rank > lowest[which]) & (size == size[model[which]]))
        ours, ends = spans(chunk.data, start[later], start[later] + size[later])
        other = start[model[which[later]]]
        theirs, _ = spans(chunk.data, other, other + size[later])
        wrong = np.r_[0, np.cumsum(ours != theirs)]
        later = later[wrong[ends[1:]] == wrong[ends[:-1]]]
        out = []
        if len(later):
            got = repeats(rank[later], mark[later], inside[later], inside[later] + size[later])
            out.append((number % buckets, number, 0, got))
        stays = np.ones(len(start), bool)
        stays[later] = False
        bucket = bucket_of(mixed(route), buckets)
        pick = np.flatnonzero(stays)
        pick = pick[np.argsort(bucket[pick], kind="stable")]
        for b, i, j in by_bucket(bucket[pick]):
            own = pick[i:j]
            text, _ = spans(chunk.data, start[own], start[own] + size[own])
            out.append((b, number, 1, packed(rank[own], mark[own], np.full(len(own), number), inside[own], size[own] - WIDTH + 1, offset[own], text)))
        return rows(names, kinds, [list(c) for c in zip(*out)] or [[], [], [], []])

    return run


def answer_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, found): repeated stretches of each chunk's documents."""
    names, kinds = ["chunk", "found"], [pa.int64(), pa.binary()]
    for _, table in grouped(batches, "bucket"):
        kind = table.column("kind").to_pylist()
        sent = table.column("sent").to_pylist()
        passed = [(c, raw) for c, k, raw in zip(table.column("chunk").to_pylist(), kind, sent) if k == 0]
        if passed:
            yield from rows(names, kinds, [list(c) for c in zip(*passed)]).to_batches()
        blobs = [unpacked(raw) for k, raw in zip(kind, sent) if k == 1]
        if not blobs:
            continue
        rank, mark, chunk, place, count, offset, text = (np.concatenate(c) for c in zip(*blobs))
        record, window = repeated_windows(rank, count, offset, text)
        order = np.argsort(chunk[record], kind="stable")
        record, window = record[order], window[order]
        parts = []
        for c, i, j in by_bucket(chunk[record]):
            own = record[i:j]
            start = place[own] + window[i:j]
            parts.append((c, repeats(rank[own], mark[own], start, start + WIDTH)))
        if parts:
            yield from rows(names, kinds, [list(c) for c in zip(*parts)]).to_batches()


def repeated_windows(rank: np.ndarray, count: np.ndarray, offset: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(record, window in it) of every window that a record of smaller rank holds too.

    Records: contexts in a row in `text`, `count` windows each; `offset`: the anchor's place in it.
    """
    size = count + WIDTH - 1
    start = np.cumsum(size) - size
    hashes = PrefixHash(text)
    number, lowest = lowest_of_equals(Suffixes(text, hashes, start, size), rank)
    later = np.flatnonzero(rank > lowest[number])
    sizes = count[later]
    whole = np.repeat(later, sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # One record for each different context; anchors under which contexts differ have their windows sorted.
    stays = np.flatnonzero(rank == lowest[number])
    _, model = np.unique(number[stays], return_index=True)
    model = stays[model]
    model = model[offset[model] != HOT_OFFSET]
    gram = hashes.of(start[model] + offset[model], start[model] + offset[model] + GRAM)
    _, which, members = np.unique(gram, return_inverse=True, return_counts=True)
    model = model[members[which] > 1]
    sizes = count[model]
    of = np.repeat(np.arange(len(model)), sizes)
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    windows = Suffixes(text, hashes, start[model][of] + step, np.full(len(of), WIDTH))
    number_of, lowest_of = lowest_of_equals(windows, rank[model][of])
    # A window's smallest rank holds for all records with its context.
    due = lowest_of[number_of] < rank[model][of]
    hit_model, hit_step = of[due], step[due]
    slot = np.full(int(number.max()) + 1 if len(number) else 0, -1)
    slot[number[model]] = np.arange(len(model))
    alike = stays[slot[number[stays]] >= 0]
    alike_of = slot[number[alike]]
    order = np.argsort(alike_of, kind="stable")
    alike, alike_of = alike[order], alike_of[order]
    low, high = np.searchsorted(alike_of, hit_model), np.searchsorted(alike_of, hit_model, side="right")
    records, _ = spans(alike, low, high)
    return np.r_[whole[0], records], np.r_[whole[1], np.repeat(hit_step, high - low)]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut_out(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
    """Every document of a chunk without its repeated stretches."""
    chunk = Chunk(table)
    n = len(chunk.data)
    change = np.zeros(n + 1, np.int64)
    found = [np.frombuffer(raw, "<i8").reshape(4, -1) for raw in answers.column("found").to_pylist() if raw]
    if found:
        rank, mark, start, stop = np.concatenate(found, axis=1)
        own = np.lexsort((chunk.mark, chunk.rank))
        ids = list(zip(chunk.rank[own].tolist(), chunk.mark[own].tolist()))
        # Rows with equal doc_id and text have the same stretches.
        places: dict[tuple[int, int], list[int]] = {}
        for k, identity in zip(own.tolist(), ids):
            places.setdefault(identity, []).append(k)
        target = [(k, r) for r, identity in enumerate(zip(rank.tolist(), mark.tolist())) for k in places.get(identity, ())]
        if target:
            document, row = np.array(target).T
            np.add.at(change, chunk.bounds[document] + start[row], 1)
            np.add.at(change, chunk.bounds[document] + stop[row], -1)
    gone = np.cumsum(change)[:n] > 0
    removed = np.r_[0, np.cumsum(gone)]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    edges = chunk.bounds[:-1][chunk.bounds[:-1] < n]
    begins[edges] = gone[edges]
    spans_before = np.r_[0, np.cumsum(begins)]
    kept_before = np.arange(n + 1) - removed
    raw = chunk.data[~gone].tobytes()
    bounds = kept_before[chunk.bounds].tolist()
    kept = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
    return pa.table(
        [
            table.column("doc_id"), pa.array(np.diff(chunk.bounds)), pa.array(np.diff(removed[chunk.bounds])), pa.array(np.diff(spans_before[chunk.bounds])),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()),
        ],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
    )


def remove_repeats(
    docs: DataFrame,
    with_kept: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
    hot_chunks: int = HOT_CHUNKS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes that are kept, of every row."""
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_bytes))
    buckets = max(1, math.ceil(2 * total / (WIDTH - GRAM + 2) / BUCKET_ANCHORS))
    source = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(LAST)).alias("rank"), F.xxhash64(text).alias("mark"))
    source = source.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(chunks)))

    # Chunks and buckets grow in number with the input, and so do the partitions that they are dealt to.
    parts = math.ceil(total / part_bytes)
    grown = [parts] if parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []

    by_chunk = (source.repartition(*grown, "chunk") if grown else source).groupBy("chunk")
    sent = by_chunk.applyInArrow(send_anchors(buckets), "bucket long, chunk long, sent binary")
    answers = sent.repartition(*grown, "bucket").sortWithinPartitions("bucket").mapInArrow(answer_anchors(hot_chunks), "chunk long, held binary")
    contexts = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(send_contexts(buckets), CONTEXTS)
    found = contexts.repartition(*grown, "bucket").sortWithinPartitions("bucket").mapInArrow(answer_contexts, "chunk long, found binary")
    if with_kept:
        return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(cut_out, RESULT)

    def slim(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        return cut_out(key, table, answers).drop_columns(["kept"])

    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(slim, RESULT.removesuffix(", kept binary"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_kept=False)
