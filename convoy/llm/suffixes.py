"""Removal of byte strings that stand earlier in the corpus, by hash-compared suffix sorting.

Every window of ``length`` bytes is assigned to an anchor: the k-gram inside it
with the smallest hash. Equal windows have equal anchors at equal places, so only
the suffixes at anchors are sorted, and only those whose anchor occurs more than once.
A segment is an anchor with all bytes of the windows assigned to it.

1. Anchor hashes are counted over the corpus; every document learns which of its own repeat.
2. Equal segments fall together and keep their first place.
3. The different segments of one anchor are sorted by what follows and by what precedes
   the anchor: a merge sort whose comparisons find the common extension of two suffixes by
   binary search over prefix polynomial hashes. Neighbours are verified byte by byte.
   Two windows at offset o are equal if their extensions share o bytes to the left and
   length - o to the right, which the sorted order answers for all of them at once.
   A group too large for one task is sorted in shards; the windows that shards keep
   meet by their bytes, and the first of equal ones stays.
4. The first place of each window stays; all other windows of repeated anchors go.

Rows without a doc_id are left out, null texts are empty, and repeated rows count as one
document. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from zstandard import ZstdCompressor, ZstdDecompressor

from convoy.llm.hashing import BLOCK, mix, prefix_hashes, powers, spans_hash
from convoy.llm.tables import flat, landed, released, slices

_U = np.uint64
_POSITION = _U((1 << 21) - 1)

LENGTH = 100
GRAM = 24
# Different segments of one anchor that are sorted together, on average; larger groups
# are dealt into shards of this size, whose results are merged.
GROUP = 4096
# Segments that a task sorts at once.
BATCH = 20_000
# Bytes of text that a step holds as arrays, and of neighbours that are compared at once.
SLICE = 1 << 18
VERIFIED = 1 << 18


def segments(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows, anchor's offset in the first window).

    Windows that would cross the end of a text do not exist. A text is never cut but
    at multiples of the block size from its own beginning, so its segments never
    depend on the texts around it.
    """
    found = []
    for at, end in _blocks(offsets, length):
        chunk = data[at : end + length - 1]
        prefix = prefix_hashes(chunk)
        _, down = powers(len(prefix))
        grams = mix((prefix[gram:] - prefix[:-gram]) * down[: len(prefix) - gram])
        smallest = (grams & ~_POSITION) | np.arange(len(grams), dtype=_U)
        width, wanted = 1, length - gram + 1
        while 2 * width <= wanted:
            smallest = np.minimum(smallest[:-width], smallest[width:])
            width *= 2
        if wanted > width:
            smallest = np.minimum(smallest[: width - wanted], smallest[wanted - width :])
        anchor = (smallest & _POSITION).astype(np.int64)
        crossing = np.zeros(len(anchor) + 1, np.int32)
        edges = offsets[(offsets > at) & (offsets < end + length - 1)] - at
        np.add.at(crossing, np.clip(edges - length + 1, 0, len(anchor)), 1)
        np.add.at(crossing, np.clip(edges, 0, len(anchor)), -1)
        inside = np.cumsum(crossing[:-1]) == 0
        moved = np.ones(len(anchor), bool)
        moved[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        first = np.flatnonzero(moved & inside)
        stop = np.ones(len(anchor), bool)
        stop[:-1] = (anchor[1:] != anchor[:-1]) | ~inside[1:]
        last = np.flatnonzero(stop & inside)
        where = anchor[first]
        found.append((grams[where].view(np.int64), first + at, last - first + 1, where - first))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _blocks(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """(first window, end of the windows) of blocks: runs of whole texts, or parts of a long one."""
    text, n = 0, len(offsets) - 1
    while text < n:
        begin = int(offsets[text])
        until = int(np.searchsorted(offsets, begin + BLOCK, side="right")) - 1
        text = max(until, text + 1)
        stop = int(offsets[text]) - length + 1
        for at in range(begin, stop, BLOCK):
            yield at, min(at + BLOCK, stop)


def _anchors(length: int, gram: int):
    """(h, doc_id, n): how often each anchor stands in each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = flat(part.column("text"))
                hashes, first, _, _ = segments(data, offsets, length, gram)
                owner = np.searchsorted(offsets, first, side="right") - 1
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                start = np.flatnonzero(new)
                counts = np.diff(np.append(start, len(hashes))).astype(np.int32)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[start]), pa.array(ids[owner[start]]), pa.array(counts)],
                    names=["h", "doc_id", "n"],
                )

    return run


def _repeated(part: pa.RecordBatch, length: int, gram: int):
    """The segments of the rows of ``part`` whose anchors are listed for their row."""
    data, offsets = flat(part.column("text"))
    hashes, first, count, anchor = segments(data, offsets, length, gram)
    owner = np.searchsorted(offsets, first, side="right") - 1
    listed = part.column("hashes")
    wanted = listed.flatten().to_numpy()
    sizes = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(part.num_rows), sizes)
    keep = np.isin(_paired(owner, hashes), _paired(rows, wanted))
    return data, offsets, hashes[keep], first[keep], count[keep], anchor[keep], owner[keep]


def _paired(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(value.view(_U) + _U(0x9E3779B97F4A7C15) * (row.astype(_U) + _U(1)))


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle, which is most of what this job moves."""
    tool = ZstdCompressor(level=1)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            packed = [tool.compress(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(packed, pa.binary()),
                    pc.binary_length(part.column("text")).cast(pa.int64()),
                    part.column("others"),
                ],
                names=["doc_id", "packed", "size", "others"],
            )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of rows with their texts unpacked, by the size of those."""
    tool = ZstdDecompressor()
    for batch in batches:
        for part in slices(batch, "size", SLICE):
            raw = [tool.decompress(z) for z in part.column("packed").to_pylist()]
            yield part.append_column("text", pa.array(raw, pa.binary()))


def _places(length: int, gram: int):
    """(h, anchor, e1, e2, n, doc_id, start): where segments with repeated anchors stand.

    e1 and e2 are a digest of the segment's bytes; the bytes stay where they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _texts(batches):
            data, offsets, h, first, count, anchor, owner = _repeated(part, length, gram)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            raw = data.tobytes()
            stop = first + count + length - 1
            digest = b"".join(
                [
                    blake2b(raw[a:b], digest_size=16).digest()
                    for a, b in zip(first.tolist(), stop.tolist(), strict=True)
                ]
            )
            e = np.frombuffer(digest, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h),
                    pa.array(anchor.astype(np.int32)),
                    pa.array(e[:, 0]),
                    pa.array(e[:, 1]),
                    pa.array(count.astype(np.int32)),
                    pa.array(ids[owner]),
                    pa.array(first - offsets[owner]),
                ],
                names=["h", "anchor", "e1", "e2", "n", "doc_id", "start"],
            )

    return run


def _bytes(length: int, gram: int):
    """(h, shard, segment, anchor, doc_id, start) of the segments listed for each row.

    ``shard`` is null for segments of groups that one task sorts whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _texts(batches):
            data, offsets, h, first, count, anchor, owner = _repeated(part, length, gram)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            listed = part.column("several")
            sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
            several = listed.flatten()
            rows = np.repeat(np.arange(part.num_rows), sizes).tolist()
            starts, shards = (several.field(k).to_pylist() for k in (0, 1))
            wanted = {(r, s): x for r, s, x in zip(rows, starts, shards, strict=True)}
            raw = data.tobytes()
            at = (first - offsets[owner]).tolist()
            keep = [k for k, key in enumerate(zip(owner.tolist(), at, strict=True)) if key in wanted]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[keep]),
                    pa.array(
                        [raw[first[k] : first[k] + count[k] + length - 1] for k in keep], pa.binary()
                    ),
                    pa.array(anchor[keep].astype(np.int32)),
                    pa.array(ids[owner[keep]]),
                    pa.array([at[k] for k in keep], pa.int64()),
                    pa.array([wanted[int(owner[k]), at[k]] for k in keep], pa.int32()),
                ],
                names=["h", "segment", "anchor", "doc_id", "start", "shard"],
            )

    return run


class Suffixes:
    """Byte strings data[start:start + size], sorted within groups by hashed comparison."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size
        self.prefix = prefix_hashes(data)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions of strings x and y: binary search over hashes."""
        low = np.zeros(len(x), np.int64)
        high = np.minimum(self.size[x], self.size[y])
        sx, sy = self.start[x], self.start[y]
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = spans_hash(self.prefix, sx, sx + middle) == spans_hash(
                self.prefix, sy, sy + middle
            )
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        shared = self.common(x, y)
        end_x, end_y = shared == self.size[x], shared == self.size[y]
        last = max(len(self.data) - 1, 0)
        byte_x = self.data[np.minimum(self.start[x] + shared, last)]
        byte_y = self.data[np.minimum(self.start[y] + shared, last)]
        return np.where(end_x | end_y, end_x & ~end_y, byte_x < byte_y)

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings by (group, bytes), and what each shares with the one before it.

        ``group`` ascends. Runs of doubling width are merged in all groups at once:
        each string finds its place in the run beside its own by binary search.
        """
        n = len(group)
        begin = np.searchsorted(group, group, side="left")
        end = np.searchsorted(group, group, side="right")
        order = np.arange(n)
        at = np.arange(n)
        width = 1
        while width < (end - begin).max(initial=0):
            within = at - begin
            block = begin + within // (2 * width) * (2 * width)
            middle = np.minimum(block + width, end)
            stop = np.minimum(block + 2 * width, end)
            left = at < middle
            low, high = np.where(left, middle, block), np.where(left, stop, middle)
            other = low.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                probe = (low[open_] + high[open_]) // 2
                mine, theirs = order[open_], order[probe]
                side = left[open_]
                # On equality the left string comes first.
                before = self.less(np.where(side, theirs, mine), np.where(side, mine, theirs))
                before = np.where(side, before, ~before)
                low[open_] = np.where(before, probe + 1, low[open_])
                high[open_] = np.where(before, high[open_], probe)
                open_ = open_[low[open_] < high[open_]]
            moved = np.where(left, at + low - other, block + (at - middle) + (low - block))
            fresh = np.empty(n, np.int64)
            fresh[moved] = order
            order = fresh
            width *= 2
        shared = np.zeros(n, np.int64)
        if n > 1:
            same = group[1:] == group[:-1]
            shared[1:] = np.where(same, self.common(order[:-1], order[1:]), 0)
            if not self._verified(order, shared, same):
                return self._plain(group)
        return order, shared

    def _verified(self, order: np.ndarray, shared: np.ndarray, same: np.ndarray) -> bool:
        """Whether neighbours really share those bytes and are in order."""
        x, y, sizes = order[:-1], order[1:], shared[1:]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            base = ends[at] - sizes[at]
            stop = max(int(np.searchsorted(ends, base + VERIFIED, side="right")), at + 1)
            some = slice(at, stop)
            step = np.arange(ends[stop - 1] - base) - np.repeat(ends[some] - sizes[some] - base, sizes[some])
            one = self.data[np.repeat(self.start[x[some]], sizes[some]) + step]
            other = self.data[np.repeat(self.start[y[some]], sizes[some]) + step]
            if not (one == other).all():
                return False
            at = stop
        return not self.less(y, x)[same].any()

    def _plain(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by comparing bytes, where two hashes have collided."""
        raw = self.data.tobytes()
        texts = [raw[a : a + n] for a, n in zip(self.start, self.size, strict=True)]
        order = sorted(range(len(texts)), key=lambda i: (group[i], texts[i]))
        shared = np.zeros(len(texts), np.int64)
        for k in range(1, len(order)):
            x, y = order[k - 1], order[k]
            if group[x] == group[y]:
                n = min(len(texts[x]), len(texts[y]))
                differ = (j for j in range(n) if texts[x][j] != texts[y][j])
                shared[k] = next(differ, n)
        return np.array(order, np.int64), shared


def first_windows(
    group: np.ndarray,
    texts: list[bytes],
    anchor: np.ndarray,
    rank: np.ndarray,
    length: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of every window that is the first of its kind.

    ``group`` ascends; ``rank`` orders the places of the segments' anchors.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    right, shared_right = Suffixes(data, ends[:-1] + anchor, sizes - anchor).sort(group)
    backward = data[::-1]
    start = len(data) - (ends[:-1] + anchor)
    left, shared_left = Suffixes(backward, start, anchor).sort(group)
    windows = sizes - length + 1
    segment, window = [], []
    for o in range(int((anchor - windows + 1).min()), int(anchor.max()) + 1):
        some = (o <= anchor) & (o > anchor - windows)
        by_left, by_right = np.empty(n, np.int64), np.empty(n, np.int64)
        by_left[left] = np.cumsum(_breaks(group, left, shared_left, o))
        by_right[right] = np.cumsum(_breaks(group, right, shared_right, length - o))
        chosen = np.flatnonzero(some)
        kind = by_left[chosen] * (n + 1) + by_right[chosen]
        order = chosen[np.lexsort((rank[chosen], kind))]
        kind = by_left[order] * (n + 1) + by_right[order]
        first = np.ones(len(order), bool)
        first[1:] = kind[1:] != kind[:-1]
        segment.append(order[first])
        window.append(anchor[order[first]] - o)
    return np.concatenate(segment), np.concatenate(window)


def _breaks(group: np.ndarray, order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Where, in sorted order, a string shares fewer than ``least`` bytes with the one before."""
    new = np.ones(len(order), bool)
    new[1:] = (shared[1:] < least) | (group[order[1:]] != group[order[:-1]])
    return new


_KEPT = ["doc_id", "start", "n"]


def _sorted_groups(length: int, sharded: bool = False):
    """Kept windows of segments that arrive sorted by anchor hash and shard.

    Those of ``sharded`` groups come with their bytes, as runs of windows.
    """

    def keys(rows: pa.Table) -> np.ndarray:
        """Numbers that ascend with the group."""
        h = rows.column("h").to_numpy()
        shard = pc.fill_null(rows.column("shard"), 0).to_numpy()
        new = (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])
        return np.concatenate(([0], np.cumsum(new)))

    def work(rows: pa.Table) -> pa.RecordBatch:
        h = keys(rows)
        ids, start = rows.column("doc_id").to_numpy(), rows.column("start").to_numpy()
        anchor = rows.column("anchor").to_numpy().astype(np.int64)
        rank = np.empty(len(h), np.int64)
        rank[np.lexsort((start + anchor, ids))] = np.arange(len(h))
        texts = rows.column("segment").to_pylist()
        segment, window = first_windows(h, texts, anchor, rank, length)
        order = np.lexsort((window, segment))
        segment, window = segment[order], window[order]
        new = np.ones(len(segment), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (window[1:] != window[:-1] + 1)
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(segment)))
        owner = segment[at]
        columns = [pa.array(ids[owner]), pa.array(start[owner] + window[at]), pa.array(counts)]
        if not sharded:
            return pa.RecordBatch.from_arrays(columns, names=_KEPT)
        runs = [
            texts[k][a : a + n + length - 1]
            for k, a, n in zip(*(x.tolist() for x in (owner, window[at], counts)), strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [*columns[:2], pa.array(runs, pa.binary())], names=["doc_id", "start", "segment"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BATCH:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            h = keys(rows)
            whole = int(np.searchsorted(h, h[-1], side="left"))
            if whole:
                yield work(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield work(pa.Table.from_batches(held).combine_chunks())

    return run


def _windows(length: int):
    """(window, doc_id, start) of every window of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "segment", 1 << 16):
                texts = part.column("segment").to_pylist()
                counts = np.array([len(t) - length + 1 for t in texts])
                rows = np.repeat(np.arange(len(texts)), counts)
                step = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
                cut = [texts[r][s : s + length] for r, s in zip(rows, step, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cut, pa.binary()),
                        pa.array(part.column("doc_id").to_numpy()[rows]),
                        pa.array(part.column("start").to_numpy()[rows] + step),
                    ],
                    names=["window", "doc_id", "start"],
                )

    return run


def _removal(length: int, gram: int, as_text: bool):
    """Spans to remove from each text, and what is left of it."""
    kind = pa.string() if as_text else pa.binary()
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _texts(batches):
            data, offsets, _, first, count, _, owner = _repeated(part, length, gram)
            gone = np.zeros(len(data) + 1, np.int32)
            np.add.at(gone, first, 1)
            np.add.at(gone, first + count, -1)
            listed = part.column("kept")
            sizes = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
            pairs = listed.flatten()
            base = np.repeat(offsets[:-1], sizes)
            start, n = (pairs.field(k).to_numpy() for k in (0, 1))
            # Other texts under the same doc_id may be shorter.
            fits = start + n + length - 1 <= np.repeat(np.diff(offsets), sizes)
            np.add.at(gone, (base + start)[fits], -1)
            np.add.at(gone, (base + start + n)[fits], 1)
            windows = np.cumsum(gone[:-1]) > 0
            edge = np.diff(windows.astype(np.int8), prepend=0, append=0)
            begin = np.flatnonzero(edge == 1)
            stop = np.flatnonzero(edge == -1) + length - 1
            # Runs of windows that overlap or touch are one removed span.
            row = np.searchsorted(offsets, begin, side="right") - 1
            new = np.ones(len(begin), bool)
            new[1:] = (begin[1:] > stop[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            begin, row = begin[at], row[at]
            stop = stop[np.append(at[1:], len(new)) - 1] if len(at) else stop
            spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
            kept = []
            raw = data.tobytes()
            ends = offsets[:-1].copy()
            pieces: list[list[bytes]] = [[] for _ in range(part.num_rows)]
            for r, a, b in zip(row.tolist(), begin.tolist(), stop.tolist(), strict=True):
                base = int(offsets[r])
                spans[r].append({"start": a - base, "stop": b - base})
                pieces[r].append(raw[ends[r] : a])
                ends[r] = b
            for r in range(part.num_rows):
                left = b"".join([*pieces[r], raw[ends[r] : offsets[r + 1]]])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array(spans, span),
                    pa.array(kept, kind),
                    part.column("others"),
                ],
                names=["doc_id", "n_bytes", "spans", "kept", "others"],
            )

    return run


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    as_text: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, others): each text without bytes that stand earlier.

    A byte goes if a string of ``length`` bytes around it also starts at a smaller
    doc_id, or earlier in the same document. ``spans`` are the maximal removed runs in
    the text's UTF-8 bytes. ``kept`` holds the bytes left or, with ``as_text``, their
    text, without characters of which only a part is left. ``others`` holds the columns
    to ``carry`` along.
    """
    nothing = F.lit(None).cast("struct<none:int>")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.struct(*carry) if carry else nothing).alias("others"),
    ).filter(F.col("doc_id").isNotNull())
    others = texts.schema["others"].dataType
    plain = texts.drop("others")
    listed = released(landed(_repeated_anchors(plain, length, gram), "listed"))
    squeezed = T.StructType.fromDDL("doc_id long, packed binary, size long").add("others", others)
    packed = texts.mapInArrow(_squeezed, squeezed)
    # Texts move once for each of three steps; each step's files go before the next.
    single = released(landed(_first_places(packed.join(listed, "doc_id"), length, gram), "places"))
    sizes = single.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    counted = single.join(sizes, "h")
    shards = F.ceil(F.col("kinds") / GROUP)
    shard = F.when(shards > 1, F.pmod(F.xxhash64("doc_id", "start"), shards).cast("int"))
    several = counted.filter("kinds > 1").groupBy("doc_id")
    several = several.agg(F.collect_list(F.struct("start", shard.alias("shard"))).alias("several"))
    differing = packed.join(listed, "doc_id").join(several, "doc_id").mapInArrow(
        _bytes(length, gram),
        "h long, segment binary, anchor int, doc_id long, start long, shard int",
    )
    differing = released(landed(differing, "segments"))
    groups = differing.filter("shard is null").repartition("h").sortWithinPartitions("h")
    sort = groups.mapInArrow(_sorted_groups(length), "doc_id long, start long, n long")
    large = differing.filter("shard is not null")
    large = large.repartition("h", "shard").sortWithinPartitions("h", "shard")
    runs = large.mapInArrow(
        _sorted_groups(length, sharded=True), "doc_id long, start long, segment binary"
    )
    rows = runs.mapInArrow(_windows(length), "window binary, doc_id long, start long")
    merged = rows.groupBy("window").agg(_place().alias("place"))
    merged = merged.select(*_from_place(), F.lit(1).cast("long").alias("n"))
    alone = counted.filter("kinds = 1").select("doc_id", "start", F.col("n").cast("long"))
    first = alone.unionByName(sort).unionByName(merged)
    first = first.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("kept"))
    first = released(landed(first, "kept"))
    shown = T.StructType.fromDDL(
        "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, "
        + f"kept {'string' if as_text else 'binary'}"
    ).add("others", others)
    joined = packed.join(listed, "doc_id", "left").join(first, "doc_id", "left")
    return joined.mapInArrow(_removal(length, gram, as_text), shown)


def _repeated_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, hashes): the anchors of each document that stand in the corpus more than once."""
    anchors = texts.mapInArrow(_anchors(length, gram), "h long, doc_id long, n int")
    often = anchors.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    both = anchors.select("h", "doc_id").join(often, "h")
    return both.groupBy("doc_id").agg(F.collect_set("h").alias("hashes"))


def _first_places(marked: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, n, doc_id, start): the first place of every distinct segment."""
    found = marked.mapInArrow(
        _places(length, gram),
        "h long, anchor int, e1 long, e2 long, n int, doc_id long, start long",
    )
    first = found.groupBy("h", "anchor", "e1", "e2").agg(
        _place().alias("place"), F.min("n").alias("n")
    )
    return first.select("h", "n", *_from_place())


# One number per place, so that the first is a plain minimum; texts are shorter than this.
_LONGEST = 1 << 40


def _place() -> Column:
    wide = F.lit(_LONGEST).cast("decimal(13,0)")
    return F.min(F.col("doc_id").cast("decimal(19,0)") * wide + F.col("start"))


def _from_place() -> list[Column]:
    wide = F.lit(_LONGEST).cast("decimal(13,0)")
    start = F.pmod("place", wide)
    doc_id = ((F.col("place") - start) / wide).cast("long")
    return [doc_id.alias("doc_id"), start.cast("long").alias("start")]


def removal_digest(result: DataFrame) -> DataFrame:
    """What ``without_repeats`` did to each document, in four numbers and a digest."""
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, x: total + x["stop"] - x["start"]
    )
    return result.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
