"""Removal of byte strings that also start in an earlier document, with suffix arrays.

Texts are read into bundles of a few megabytes. Every window of ``width`` bytes goes to
a shard chosen by the smallest hash among its 16-byte strings, so equal windows meet
wherever they stand; consecutive windows with the same smallest hash travel as one
segment. A bundle sends each distinct segment once, with the smallest id it has it
from, so a passage that many documents share is not sent once for each. Hashes whose
distinct segments are too many for one suffix array, such as those of a line that stands
between differing neighbours, are counted beforehand and passed over: their windows go by
their next smallest hash, and by a hash of the whole window where that is as common. A shard builds
the suffix array of its segments by induced sorting (``induced``), takes permuted
common prefixes, and reads off runs of at least ``width`` common bytes which smallest
id each window starts in. Bundles get back where an earlier document has a window and
mark the bytes that such windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.bytewords import BASE, Powers, mixed
from pulsemill.llm.induced import common_prefixes, suffix_array, words_at
from pulsemill.session import cut_lineage

WIDTH = 50
GRAM = 16
#: Windows of a segment at most.
RUN = 64
BUNDLE_BYTES = 2 << 20
SHARD_BYTES = 2 << 20
#: Bytes of segments that are looked through at once for equal ones and for such as cannot meet any other.
LOOK_BYTES = 16 << 20
#: Shards for each shuffle partition, so that one is a small part of a task's memory.
SHARDS_PER_PARTITION = 2
#: Bytes of segments that a shard is meant to get.
SENT_BYTES = 128 << 20
#: Hashes are counted by their first bits. Hashes that begin alike and have more bytes of
#: segments than this are split; of what is not split none has twice as many.
CELL_BITS = 20
HOT_BYTES = 4 << 20
#: Places of a bundle that are worked on at once, so that their hashes stay in a core's cache.
CHUNK = 1 << 15
MULTIPLIER = np.uint64(BASE)
NO_CELLS = np.empty(0, np.int64)
NO_ID = np.iinfo(np.int64).max
NO_HASH = np.iinfo(np.uint64).max
LEVEL = 6


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of known types as one compressed run: sizes first."""
    sizes = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    raw = sizes + b"".join(a.tobytes() for a in arrays)
    body = pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)
    return len(raw).to_bytes(8, "little") + body


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += size
    return out


def planes(values: np.ndarray) -> np.ndarray:
    """First bytes of all values, then second ones: compresses better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).ravel()


def from_planes(data: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(size, -1).T).view(kind).ravel()


def bundles(docs: DataFrame) -> DataFrame:
    """(bundle, data): ids, lengths and bytes of texts, some megabytes at a time."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        known: list[bool] = []
        texts: list[bytes] = []
        held, number = 0, 0
        task = TaskContext.get().partitionId()

        def row() -> pa.RecordBatch:
            data = packed(np.array(ids, np.int64), np.array(known, bool), np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) | number]), pa.array([data], pa.large_binary() if len(data) >> 31 else pa.binary())], names=["bundle", "data"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(NO_ID if i is None else i)
                known.append(i is not None)
                texts.append(b"" if text is None else text.encode("utf-8", "surrogatepass"))
                held += len(texts[-1])
                if held >= BUNDLE_BYTES:
                    yield row()
                    ids, known, texts, held, number = [], [], [], 0, number + 1
        if ids:
            yield row()

    return docs.mapInArrow(gather, "bundle bigint, data binary")


def cells_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def cell_table(cells: np.ndarray) -> np.ndarray:
    """For every cell, whether it is one of ``cells``."""
    table = np.zeros(1 << CELL_BITS, bool)
    table[cells] = True
    return table


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on."""
    words = words_at(text)
    return mixed(words[: len(text) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15) ^ mixed(words[GRAM - 8 : len(text) - 7]))


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` values in a row."""
    least, reach = values, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if span > reach:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    return least


def in_order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places by ``first``, then ``second``; few of ``first`` are equal."""
    order = np.argsort(first)
    value = first[order]
    equal = value[1:] == value[:-1]
    tied = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
    part = order[tied]
    order[tied] = part[np.lexsort((second[part], first[part]))]
    return order


class Segments:
    """The windows of a bundle in segments, and the distinct ones of these by shard.

    Hashes in the cells ``passed`` are no window's smallest one; windows whose smallest
    one is then in the cells ``whole``, or that have no other, go by a hash of their bytes.
    """

    def __init__(self, data: bytes, width: int, shards: int, passed: np.ndarray = NO_CELLS, whole: np.ndarray = NO_CELLS):
        ids, known, sizes, text = unpacked(data, "<i8", "?", "<i8", "u1")
        self.ids, self.known, self.sizes, self.text, self.width = ids, known, sizes, text, width
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        n = len(text)
        count = n - width + 1
        self.start = np.empty(0, np.int64)
        if count < 1:
            self.none()
            return
        up, down = powers(n)
        total = np.zeros(n + 1, np.uint64)
        for at in range(0, n, CHUNK):
            part = total[at + 1 : at + 1 + CHUNK]
            np.cumsum((text[at : at + CHUNK].astype(np.uint64) + np.uint64(1)) * up[at : at + CHUNK], out=part)
            part += total[at]
        least = np.empty(count, np.uint64)
        table = cell_table(passed)
        for at in range(0, count, CHUNK):
            stop = min(at + CHUNK, count)
            grams = gram_hashes(text[at : stop + width - 1])
            if len(passed):
                grams[table[cells_of(grams)]] = NO_HASH
            least[at:stop] = sliding_least(grams, width - GRAM + 1)
        if len(passed):
            at = np.flatnonzero((least == NO_HASH) | cell_table(whole)[cells_of(least)])
            least[at] = mixed((total[at + width] - total[at]) * down[at])
        # Runs of one hash, apart where a text begins and where windows begin to leave it.
        new = np.ones(count, bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        for edge in (self.begins, np.maximum(self.begins, self.ends - width + 1)):
            new[edge[edge < count]] = True
        first = np.flatnonzero(new)
        length = np.diff(first, append=count)
        doc = np.searchsorted(self.ends, first, side="right")
        inside = first + width <= self.ends[doc]
        first, length, doc = first[inside], length[inside], doc[inside]
        if not len(first):
            self.none()
            return
        tag = least[first]
        pieces = -(-length // RUN)  # long runs of one hash are cut
        if pieces.max() > 1:
            each = np.repeat(first, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            length = np.minimum(np.repeat(first + length, pieces) - each, RUN)
            first, doc, tag = each, np.repeat(doc, pieces), np.repeat(tag, pieces)
        self.start, self.windows, self.doc = first, length, doc
        del least, new, inside
        # Equal segments of the bundle, by a hash of their bytes.
        stop = self.start + self.windows + width - 1
        content = mixed((total[stop] - total[self.start]) * down[self.start]) ^ mixed(self.windows.astype(np.uint64))
        shard = (tag >> np.uint64(32)).astype(np.int64) % shards
        order = in_order((shard.astype(np.uint64) << np.uint64(32)) | (tag & np.uint64(0xFFFFFFFF)), content)
        c, t, s = content[order], tag[order], shard[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (c[1:] != c[:-1]) | (t[1:] != t[:-1])
        group = np.cumsum(fresh) - 1
        self.group = np.empty(len(order), np.int64)
        self.group[order] = group
        self.sample = order[fresh]
        self.shard = s[fresh]
        self.cell = cells_of(t[fresh])
        self.tag = (t[fresh] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        self.least_id = np.minimum.reduceat(ids[self.doc[order]], np.flatnonzero(fresh))
        self.bounds = np.searchsorted(self.shard, np.arange(shards + 1))

    def none(self) -> None:
        self.windows = self.doc = self.group = self.sample = self.shard = self.least_id = self.cell = np.empty(0, np.int64)
        self.tag = np.empty(0, np.uint32)
        self.bounds = None

    def packets(self) -> Iterator[tuple[int, bytes]]:
        """(shard, distinct segments of it: tags, windows, smallest ids, bytes)."""
        if self.bounds is None:
            return
        raw = self.text.tobytes()
        for shard in np.unique(self.shard).tolist():
            a, b = self.bounds[shard], self.bounds[shard + 1]
            pick = self.sample[a:b]
            stop = self.start[pick] + self.windows[pick] + self.width - 1
            joined = b"".join([raw[i:j] for i, j in zip(self.start[pick].tolist(), stop.tolist())])
            steps = np.diff(self.tag[a:b], prepend=np.uint32(0))  # sorted, so steps are small
            yield shard, packed(planes(steps), self.windows[pick].astype(np.uint8), planes(self.least_id[a:b]), np.frombuffer(joined, np.uint8))


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n + 1:
        _POWERS[:] = Powers().to(n + 1)
    return _POWERS[0][:n], _POWERS[1]


def answer(packets: list[tuple[int, bytes]], width: int) -> Iterator[tuple[int, bytes]]:
    """(bundle, segments' numbers, first windows, last windows, ids): where windows of the
    segments that a bundle sent start in a document with a smaller id than it gave."""
    parts = [unpacked(data, "u1", "u1", "u1", "u1") for _, data in packets]
    tag = np.concatenate([from_planes(p[0], "<u4").cumsum(dtype=np.uint32) for p in parts])
    windows = np.concatenate([p[1] for p in parts]).astype(np.int64)
    ids = np.concatenate([from_planes(p[2], "<i8") for p in parts])
    text = np.concatenate([p[3] for p in parts])
    counts = np.array([len(p[1]) for p in parts])
    bundle = np.repeat(np.arange(len(parts)), counts)
    number = np.arange(len(tag)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = windows + width - 1
    start = np.cumsum(size) - size
    # Segments that share their tag with none cannot match anything.
    order = np.argsort(tag, kind="stable")
    t = tag[order]
    again = np.zeros(len(t), bool)
    again[1:] |= t[1:] == t[:-1]
    again[:-1] |= t[1:] == t[:-1]
    order = order[again]
    replies = [matched(order[a:b], start, size, ids, tag, text, width) for a, b in whole_tags(tag[order], size[order], LOOK_BYTES)]
    if not replies:
        return
    segment, low, high, least = (np.concatenate(c) for c in zip(*replies))
    by = np.argsort(bundle[segment], kind="stable")
    segment, low, high, least = segment[by], low[by], high[by], least[by]
    bounds = np.searchsorted(bundle[segment], np.arange(len(parts) + 1))
    for i, (name, _) in enumerate(packets):
        own = slice(bounds[i], bounds[i + 1])
        if bounds[i] < bounds[i + 1]:
            yield name, packed(number[segment[own]].astype(np.int32), low[own].astype(np.uint8), high[own].astype(np.uint8), least[own])


def whole_tags(tag: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of about ``most`` bytes each that part no tag, for segments in order of their tags."""
    ends = np.append(np.flatnonzero(tag[1:] != tag[:-1]) + 1, len(tag))
    upto = np.append(0, np.cumsum(size))
    at = 0
    while at < len(tag):
        reach = int(np.searchsorted(upto, upto[at] + most))
        stop = int(ends[np.searchsorted(ends, min(reach, len(tag)))])
        yield at, stop
        at = stop


def can_meet(order: np.ndarray, start: np.ndarray, size: np.ndarray, tag: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """For segments in order of their tags: whether one may have a window in common with another one.

    Equal windows have the hash of their tag at the same place. So if a segment has it
    at one place only, as most do, its windows equal such of others only if half of the
    other bytes are equal too, all before that place or all behind it. Segments of a tag
    that some segment has elsewhere or nowhere (a hash of a window) are all kept.
    """
    n, half = len(order), -(-(width - GRAM) // 2)
    size, tag = size[order], tag[order]
    ends = np.cumsum(size)
    once = np.empty(n, bool)
    before, behind = np.empty(n, np.uint64), np.empty(n, np.uint64)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK)))
        stop = np.cumsum(size[a:b])
        begin = stop - size[a:b]
        own = text[spread_runs(start[order[a:b]], size[a:b])]
        hits = np.flatnonzero(gram_hashes(own).astype(np.uint32) == np.repeat(tag[a:b], size[a:b])[: len(own) - GRAM + 1])
        of = np.searchsorted(stop, hits, side="right")
        within = hits + GRAM <= stop[of]
        hits, of = hits[within], of[within]
        once[a:b] = np.bincount(of, minlength=b - a) == 1
        at = begin.copy()
        at[of] = hits
        # Sides that are too short are equal to none.
        for out, low in ((before, at - half), (behind, at + GRAM)):
            whole = np.flatnonzero((low >= begin) & (low + half <= stop))
            side = np.zeros(len(whole), np.uint64)
            for k in range(half):
                side = side * MULTIPLIER + own[low[whole] + k]
            out[a:b] = mixed(np.arange(a, b, dtype=np.uint64) * MULTIPLIER)
            out[a + whole] = mixed(side + np.uint64(1))
        a = b
    first = np.ones(n, bool)
    first[1:] = tag[1:] != tag[:-1]
    group = np.cumsum(first) - 1
    keep = ~np.logical_and.reduceat(once, np.flatnonzero(first))[group]
    for side in (before, behind):
        by = in_order(group, side)
        equal = (side[by[1:]] == side[by[:-1]]) & (group[by[1:]] == group[by[:-1]])
        keep[by[1:][equal]] = True
        keep[by[:-1][equal]] = True
    return keep & (np.bincount(group)[group] > 1)


def matched(picked: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray, tag: np.ndarray, text: np.ndarray, width: int) -> list[np.ndarray]:
    """For some segments, all those of their tags: (segment, first window, last window,
    smallest id), where it is below the segment's own."""
    # Equal segments once, with their smallest id; all of them get the answer.
    view = memoryview(text)
    distinct: dict[bytes, int] = {}
    same = np.array([distinct.setdefault(view[a:b].tobytes(), len(distinct)) for a, b in zip(start[picked].tolist(), (start[picked] + size[picked]).tolist())])
    least = np.full(len(distinct), NO_ID)
    np.minimum.at(least, same, ids[picked])
    contents = list(distinct)
    sample = picked[np.unique(same, return_index=True)[1]]
    length = size[sample]
    meet = can_meet(sample, start, size, tag, text, width)
    lone, meet = np.flatnonzero(~meet), np.flatnonzero(meet)
    # The windows of one that meets no other start in its copies alone.
    runs = [(lone, np.zeros(len(lone), np.int64), length[lone] - width, least[lone])]
    for a, b in whole_tags(tag[sample[meet]], length[meet], SHARD_BYTES):
        own = meet[a:b]
        segment, low, high, found = window_runs([contents[i] for i in own.tolist()], least[own], width)
        runs.append((own[segment], low, high, found))
    run_segment, low, high, run_least = (np.concatenate(c) for c in zip(*runs))
    by = np.argsort(run_segment, kind="stable")
    run_segment, low, high, run_least = run_segment[by], low[by], high[by], run_least[by]
    # Back to all the segments that were sent.
    bounds = np.searchsorted(run_segment, np.arange(len(contents) + 1))
    many = np.diff(bounds)[same]
    sent = np.repeat(np.arange(len(picked)), many)
    run = spread_runs(bounds[:-1][same], many)
    earlier = run_least[run] < ids[picked][sent]
    return [picked[sent[earlier]], low[run[earlier]], high[run[earlier]], run_least[run[earlier]]]


def window_runs(contents: list[bytes], least: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(segment, first window, last window, smallest id): runs of windows with one answer, for distinct segments."""
    joined = np.frombuffer(b"".join(contents), np.uint8)
    length = np.array([len(b) for b in contents])
    begin = np.cumsum(length) - length
    segment = np.repeat(np.arange(len(contents)), length)
    place = np.arange(len(joined)) - begin[segment]
    window = place <= length[segment] - width
    fresh = np.zeros(len(joined), bool)
    fresh[begin] = True
    order = suffix_array(joined)
    # Far enough to tell at every place of a segment, windows or not: those between link them.
    common = common_prefixes(joined, order, fresh, 2 * width + RUN)
    linked = common[order] >= width
    linked[0] = False
    runs = np.flatnonzero(~linked)
    value = np.where(window[order], least[segment[order]], NO_ID)
    smallest = np.repeat(np.minimum.reduceat(value, runs), np.diff(np.concatenate([runs, [len(order)]])))
    at = np.empty(len(joined), np.int64)
    at[order] = smallest
    # Runs of windows of a segment with one answer.
    places = np.flatnonzero(window)
    answer, segment, place = at[places], segment[places], place[places]
    new = np.ones(len(places), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (answer[1:] != answer[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(places)]]) - 1
    return segment[first], place[first], place[last], answer[first]


def spread_runs(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All integers of the runs that start at ``first``."""
    before = np.cumsum(length) - length
    return np.repeat(first - before, length) + np.arange(int(length.sum()))


def counted(kept: DataFrame, width: int, passed: np.ndarray) -> tuple[np.ndarray, int]:
    """(cells with more than HOT_BYTES of segments, bytes of all segments).

    A task tells of the cells that have its share of HOT_BYTES, so what it leaves out
    amounts to less than HOT_BYTES over all tasks.
    """
    least = HOT_BYTES / max(kept.rdd.getNumPartitions(), 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for data in batch.column(0):
                segments = Segments(data.as_py(), width, 1, passed)
                np.add.at(held, segments.cell, segments.windows[segments.sample] + width - 1)
        many = np.flatnonzero(held >= least)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(many, -1)), pa.array(np.append(held[many], held.sum()))], names=["cell", "bytes"])

    sums = kept.select("data").mapInArrow(count, "cell bigint, bytes bigint").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    rows = sums.where((F.col("cell") < 0) | (F.col("bytes") > HOT_BYTES)).collect()
    return np.array(sorted(r.cell for r in rows if r.cell >= 0), np.int64), sum(r.bytes for r in rows if r.cell < 0)


def hot_cells(kept: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(cells to pass over, cells to go by whole windows, bytes of all segments) for ``Segments``."""
    passed, size = counted(kept, width, NO_CELLS)
    if not len(passed):
        return passed, NO_CELLS, size
    whole, size = counted(kept, width, passed)
    return passed, whole, size


def removed_bytes(segments: Segments, replies: list[tuple[int, bytes]]) -> np.ndarray:
    """True for each byte of the bundle that an earlier document's window covers."""
    n, width = len(segments.text), segments.width
    gone = np.zeros(n + 1, np.int32)

    def mark(first: np.ndarray, windows: np.ndarray) -> None:
        np.add.at(gone, first, 1)
        np.subtract.at(gone, first + windows - 1 + width, 1)

    if len(segments.start):
        own_id = np.where(segments.known, segments.ids, -NO_ID - 1)[segments.doc]  # the least: nothing is earlier
        earlier = segments.least_id[segments.group] < own_id
        mark(segments.start[earlier], segments.windows[earlier])
        by_group = np.argsort(segments.group, kind="stable")
        bounds = np.searchsorted(segments.group[by_group], np.arange(len(segments.sample) + 1))
        for shard, data in replies:
            number, low, high, found = unpacked(data, "<i4", "u1", "u1", "<i8")
            group = segments.bounds[shard] + number
            many = bounds[group + 1] - bounds[group]
            own = by_group[spread_runs(bounds[group], many)]
            run = np.repeat(np.arange(len(number)), many)
            earlier = found[run] < own_id[own]
            own, run = own[earlier], run[earlier]
            mark(segments.start[own] + low[run], high[run].astype(np.int64) - low[run] + 1)
    return np.cumsum(gone[:-1]) > 0


def dedup_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans[, kept]) for each row of ``docs``.

    Removed is every byte that lies in a string of ``width`` bytes that also starts in a
    document with a smaller id; strings are judged on the input. ``spans`` are the
    maximal removed runs as (start, end) in bytes; ``kept`` are the remaining bytes.

    Null texts are empty; texts shorter than ``width`` stay whole; rows that repeat an
    id do not remove from each other. Rows without an id remove nothing and stay whole.
    Texts are taken whole, however long. Extra columns are ignored; an empty table gives
    an empty one. Ids are integers.
    """
    spark = docs.sparkSession
    kept = cut_lineage(bundles(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))))
    passed, whole, size = hot_cells(kept, width)
    shards = max(SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SENT_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                packets = list(Segments(data.as_py(), width, shards, passed, whole).packets())
                columns = [pa.array([s for s, _ in packets], pa.int64()), pa.array([bundle] * len(packets), pa.int64()), pa.array([p for _, p in packets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "bundle", "packet"])

    def reply(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        found = list(answer(list(zip(table.column("bundle").to_pylist(), table.column("packet").to_pylist())), width))
        return pa.table({"bundle": pa.array([b for b, _ in found], pa.int64()), "shard": pa.array([shard] * len(found), pa.int64()), "reply": pa.array([r for _, r in found], pa.binary())})

    sent = kept.mapInArrow(send, "shard bigint, bundle bigint, packet binary")
    replies = cut_lineage(sent.groupBy("shard").applyInArrow(reply, "bundle bigint, shard bigint, reply binary"))

    def finish(bundle: pa.Table, answers: pa.Table) -> pa.Table:
        rows: dict[str, list] = {name: [] for name in names}
        for data in bundle.column("data").to_pylist():
            segments = Segments(data, width, shards, passed, whole)
            gone = removed_bytes(segments, list(zip(answers.column("shard").to_pylist(), answers.column("reply").to_pylist())))
            for i, known, a, b in zip(segments.ids.tolist(), segments.known.tolist(), segments.begins.tolist(), segments.ends.tolist()):
                own = gone[a:b]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                left = segments.text[a:b][~own].tobytes()
                for name, value in zip(names, (i if known else None, b - a, int(own.sum()), len(edges) // 2, hashlib.sha256(left).hexdigest(), [{"start": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()], left)):
                    rows[name].append(value)
        return pa.table({name: pa.array(rows[name], kind) for name, kind in zip(names, kinds)})

    names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_text
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
    schema = f"`{doc_id}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>" + ", kept binary" * with_text
    return kept.groupBy("bundle").cogroup(replies.groupBy("bundle")).applyInArrow(finish, schema)
