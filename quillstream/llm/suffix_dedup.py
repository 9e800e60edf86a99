"""Removal of repeated byte strings through a distributed difference-cover suffix sort.

A byte goes if a string of WINDOW bytes that covers it also starts in a document with a smaller id; strings are judged
on the input. What matters of a suffix is its first WINDOW bytes, so the suffix order is only needed among strings
that can be equal, and it is distributed by content:

1. Blocks. Documents are packed, as they are read, into compressed blocks, stored in the shared folder. Everything
   below works on blocks, so a lost task reads its block again and comes to the same results.
2. Anchors. The anchor of a window is the 20-byte string in it with the least hash, the leftmost if it stands there
   twice; equal windows have equal anchors. Neighbouring windows on the same anchor form one stretch (16 windows, 65
   bytes on average). Stretches of a block with equal bytes are one entry, and each entry's anchor hash is shuffled.
3. Candidates. An anchor that only one document has can't be on a repeated window. Of all others, every block sends the
   text of its entries. Hashes decide nothing else: a false match only sends a text in vain.
   Near copies of one text that differ in one place all have the anchors around it, each with a text of its own. Such
   anchors, with more than DIFFERENT entries in one block or MANY in all, are hot: their windows are sent one by one, to
   where the window's own hash says, so that no task gets an anchor whole.
4. Suffix order. The texts meet by anchor. Equal ones, byte for byte, are one string from there; the strings' suffixes
   are sorted by the difference-cover algorithm: sampled triples, recursion on their names, the remaining suffixes
   merged in. Neighbours in that order with equal prefixes of WINDOW bytes are the same window, and the least document
   of each window is told to the blocks that hold it.
5. Blocks again: every window marks its bytes if an earlier document has it.

Buckets hold BUCKET_BYTES of text on average, whatever the input's size; one bucket sorts about SORT_BYTES at once.

A null or empty text has no bytes; texts of any length are whole, long ones are searched in overlapping chunks. A null
id counts as larger than all others. Rows with one id are one document: they don't remove from each other. Empty
tables give empty results. Columns besides id and text, whatever their names, are handed on as they are by
`deduplicate`, which gives texts without the removed bytes (a character cut in two goes whole).
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import forget, materialise, pack, right_sized, rows_of, trimmed, trimmed_group, unpack
from quillstream.llm.suffix_array import suffix_array

WINDOW = 50
ANCHOR = 20
BLOCK_BYTES = 8_000_000
CHUNK = 500_000
BUCKET_BYTES = 8_000_000
SORT_BYTES = 500_000
FINER = 2
#: The order of a row without an id: that of the greatest one, with which it counts as one document. Results have the ids as they were.
NO_ID = 2**63 - 1
DIFFERENT, MANY = 32, 100_000
#: Windows that are gathered at once.
WINDOWS = 200_000
#: Hash bits of an anchor; the lower bits of its key are its place in a chunk.
ANCHOR_BITS, PLACE_BITS = 41, 23
PLACE = np.uint64(2**PLACE_BITS - 1)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
BASE = 0x5851F42D4C957F2D
BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
BLOCK = "block long, raw_bytes long, ids binary, ends binary, body binary, rest binary"
PART = "block long, bucket long, kind int, part binary"


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def stretches(raw: np.ndarray, ends: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
    """Stretches of the windows that start in [a, b): first and last window, anchor hash, content hash."""
    body = raw[a : min(len(raw), b + WINDOW - 1)]
    n = len(body)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = body
    eight = np.empty(n, np.uint64)  # the 8 bytes from each place on
    for s in range(8):
        k = len(eight[s::8])
        eight[s::8] = np.frombuffer(padded[s : s + 8 * k].tobytes(), "<u8")
    m = n - ANCHOR + 1
    key = eight[:m] * MIX[0] + eight[8 : 8 + m] * MIX[1] + eight[12 : 12 + m] * MIX[2]
    del eight
    key ^= key >> np.uint64(29)
    key *= MIX[3]
    key ^= key >> np.uint64(32)
    key = (key & ~PLACE) | np.arange(m, dtype=np.uint64)
    done = 1  # least key of `done` places from each on
    while 2 * done <= WINDOW - ANCHOR + 1:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    if rest := WINDOW - ANCHOR + 1 - done:
        key = np.minimum(key[:-rest], key[rest:])
    n_windows = len(key)
    # windows that end in their document
    i = np.searchsorted(ends, a, side="right")
    begins = np.r_[a, ends[i:]]
    begins = begins[begins < a + n_windows]
    stops = np.clip(ends[i : i + len(begins)] - WINDOW + 1 - a, 0, n_windows)
    begins = begins - a
    real = stops > begins
    step = np.zeros(n_windows + 1, np.int32)
    np.add.at(step, begins[real], 1)
    np.add.at(step, stops[real], -1)
    whole = np.cumsum(step[:-1]) > 0
    place = key & PLACE
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (whole[1:] != whole[:-1])])
    last = np.r_[first[1:], n_windows] - 1
    first, last = first[whole[first]], last[whole[first]]
    # least hashes are small ones; mixed once more they are dealt evenly to the buckets
    anchor = (((key[first] >> np.uint64(PLACE_BITS)) * MIX[0]) & np.uint64(2**ANCHOR_BITS - 1)).astype(np.int64)
    before = np.zeros(n + 1, np.uint64)  # polynomial hash of the bytes before each place
    np.cumsum(BYTE[body] * powers(n, pow(BASE, -1, 2**64)), out=before[1:])
    content = (before[last + WINDOW] - before[first]) * powers(n, BASE)[first]
    content ^= content >> np.uint64(31)
    content *= MIX[0]
    return first + a, last + a, anchor, (content >> np.uint64(16)).astype(np.int64)


class Block:
    """An unpacked block with its stretches and its entries: stretches of equal bytes, in order of (anchor, content)."""

    def __init__(self, ids: bytes, ends: bytes, body: bytes) -> None:
        import zstandard

        self.ids, self.ends = np.frombuffer(ids, "<i8"), np.frombuffer(ends, "<i8")
        self.raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
        found = [stretches(self.raw, self.ends, a, min(len(self.raw), a + CHUNK)) for a in range(0, len(self.raw), CHUNK)] or [(np.zeros(0, np.int64),) * 4]
        self.first, self.last, anchor, content = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
        self.doc = self.ids[np.searchsorted(self.ends, self.first, side="right")]
        order = content_order(anchor, content)
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(content[order]) != 0)
        new = parted(self.raw, self.first[order], self.last[order] + WINDOW - self.first[order], new)
        begin = np.flatnonzero(new)
        self.order, self.begin = order, np.r_[begin, len(order)]
        self.anchor, self.content = anchor[order[begin]], content[order[begin]]
        self.example = order[begin]  # a stretch of each entry
        self.least = np.minimum.reduceat(self.doc[order], begin) if len(begin) else self.doc
        self.several = (np.maximum.reduceat(self.doc[order], begin) > self.least if len(begin) else self.doc).astype(np.int64)

    def windows_of(self, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(entry, offset) of every window of all entries on the anchors that some entries are on, about WINDOWS at once."""
        anchor = np.unique(self.anchor[place])
        a, b = np.searchsorted(self.anchor, anchor), np.searchsorted(self.anchor, anchor, side="right")
        entry = np.repeat(a - np.r_[0, np.cumsum(b - a)[:-1]], b - a) + np.arange((b - a).sum()) if len(anchor) else anchor
        n = self.last[self.example[entry]] + 1 - self.first[self.example[entry]]
        cut = np.flatnonzero(np.r_[True, np.diff(np.cumsum(n) // WINDOWS) > 0]) if len(entry) else []
        for x, y in zip(cut, [*cut[1:], len(entry)]):
            own, m = entry[x:y], n[x:y]
            yield np.repeat(own, m), np.arange(m.sum()) - np.repeat(np.r_[0, np.cumsum(m)[:-1]], m)

    def told(self) -> tuple[np.ndarray, ...]:
        """anchor, least document, whether there are several, place, hot of each entry; the entries of an anchor with more than DIFFERENT as one, at the first's place."""
        n = len(self.anchor)
        if not n:
            return (np.zeros(0, np.int64),) * 5
        first = np.flatnonzero(np.r_[True, np.diff(self.anchor) != 0])
        size = np.diff(np.r_[first, n])
        hot = np.repeat(size > DIFFERENT, size)
        keep = ~hot
        keep[first] = True
        least = np.where(hot, np.repeat(np.minimum.reduceat(self.least, first), size), self.least)
        several = np.where(hot, np.repeat((np.maximum.reduceat(self.least, first) > np.minimum.reduceat(self.least, first)) | (np.maximum.reduceat(self.several, first) > 0), size), self.several)
        return self.anchor[keep], least[keep], several[keep].astype(np.int64), np.flatnonzero(keep), hot[keep].astype(np.int64)


def content_order(anchor: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Order by anchor, equal contents together: by one number with a part of the content's hash, unless that part is equal where the whole isn't."""
    key = (anchor << (63 - ANCHOR_BITS)) | (content & ((1 << (63 - ANCHOR_BITS)) - 1))
    order = np.argsort(key)
    alike = (np.diff(key[order]) == 0) & (np.diff(content[order]) != 0)
    return np.lexsort((content, anchor)) if alike.any() else order


def gathered(text: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """text[b : b + l] of each place, one after the other."""
    return text[np.repeat(begin - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())] if len(begin) else text[:0]


def parted(text: np.ndarray, begin: np.ndarray, length: np.ndarray, new: np.ndarray) -> np.ndarray:
    """`new` (which strings begin a group) with strings that differ from their group's first, byte for byte, in groups of their own."""
    first = np.flatnonzero(new)
    of = first[np.cumsum(new) - 1] if len(new) else first
    rest = np.flatnonzero(~new)
    other = length[rest] != length[of[rest]]
    same = rest[~other]
    new = new.copy()
    for at in range(0, len(same), 50_000):
        own = same[at : at + 50_000]
        differ = gathered(text, begin[own], length[own]) != gathered(text, begin[of[own]], length[own])
        wrong = np.add.reduceat(differ, np.r_[0, np.cumsum(length[own])[:-1]], dtype=np.int64) > 0
        new[own[wrong]] = True
        new[own[wrong][own[wrong] + 1 < len(new)] + 1] = True  # what follows may equal the group's first, or not
    new[rest[other]] = True
    new[rest[other][rest[other] + 1 < len(new)] + 1] = True
    return new


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each anchor hash, in the hashes' order."""
    return ((anchor >> (ANCHOR_BITS - 31)) * buckets) >> 31


def bucket_slices(anchor: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, its part) of sorted anchor hashes."""
    bucket = bucket_of(anchor, buckets)
    cut = np.flatnonzero(np.r_[True, np.diff(bucket) > 0, True]) if len(bucket) else []
    for a, b in zip(cut, cut[1:]):
        yield int(bucket[a]), slice(a, b)


def blocks_of(docs: DataFrame, key: str, text: str, rest: list[str], size: int) -> DataFrame:
    """Rows of BLOCK: documents as they are read, about `size` bytes of text each (more, if one text is longer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        task, made = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        bodies: list[bytes] = []
        others: list[pa.RecordBatch] = []
        waiting = 0

        def block() -> pa.RecordBatch:
            nonlocal made, waiting
            made += 1
            sink = io.BytesIO()
            if rest:
                with pa.ipc.new_stream(sink, others[0].schema) as out:
                    for o in others:
                        out.write_batch(o)
            squeeze = zstandard.ZstdCompressor(level=3).compress
            row = [
                pa.array([task * 2**24 + made], pa.int64()), pa.array([waiting], pa.int64()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                pa.array([np.cumsum([len(x) for x in bodies]).astype("<i8").tobytes()], pa.binary()), pa.array([squeeze(b"".join(bodies))], pa.binary()), pa.array([squeeze(sink.getvalue())], pa.binary()),
            ]
            ids.clear(), bodies.clear(), others.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays(row, names=["block", "raw_bytes", "ids", "ends", "body", "rest"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids += [NO_ID if x is None else x for x in part.column(0).to_pylist()]
                own = [(t or "").encode() for t in part.column(1).to_pylist()]
                bodies += own
                waiting += sum(map(len, own))
                others.append(pa.RecordBatch.from_arrays([part.column(2 + i) for i in range(len(rest))], names=rest))
                if waiting >= size:
                    yield block()
        if ids:
            yield block()

    return docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"), *rest).mapInArrow(trimmed(run), BLOCK)


def part_rows(rows: list[tuple]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((("block", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("part", pa.binary())))})


def anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, kind 0: anchors, least documents, whether there are several, places, whether hot) of each block's entries; a hot anchor's are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, ends, body in rows_of(batches):
            own = Block(ids, ends, body)
            rows = []
            anchor, least, several, place, hot = own.told()
            for bucket, k in bucket_slices(anchor, buckets):
                rows.append((number, bucket, 0, pack(np.diff(anchor[k], prepend=0), least[k], several[k], place[k], hot[k])))
            yield from part_rows(rows).to_batches()

    return blocks.select("block", "ids", "ends", "body").mapInArrow(trimmed(run), PART)


def decide(bucket: pa.Table) -> pa.Table:
    """For each block (kind 1): the places of its entries on anchors that several documents have, and whether those are hot."""
    numbers = bucket.column("block").to_pylist()
    found = [unpack(p, 5)[0] for p in bucket.column("part").to_pylist()]
    anchor = np.concatenate([np.cumsum(f[0]) for f in found])
    least, several, place, hot = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3, 4))
    source = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    order = np.argsort(anchor)
    begin = np.flatnonzero(np.r_[True, np.diff(anchor[order]) != 0])
    shared = (np.minimum.reduceat(least[order], begin) < np.maximum.reduceat(least[order], begin)) | (np.maximum.reduceat(several[order], begin) > 0)
    size = np.diff(np.r_[begin, len(order)])
    hot[order] = np.repeat((np.maximum.reduceat(hot[order], begin) > 0) | (size > MANY), size)
    where = np.sort(order[np.repeat(shared, size)])
    cut = np.searchsorted(source[where], np.arange(len(found) + 1))
    return part_rows([(number, bucket.column("bucket")[0].as_py(), 1, pack(np.diff(place[where[a:b]], prepend=0), hot[where[a:b]])) for number, a, b in zip(numbers, cut, cut[1:]) if b > a])


def opened(left: pa.Table) -> Block:
    return Block(left.column("ids")[0].as_py(), left.column("ends")[0].as_py(), left.column("body")[0].as_py())


def window_hashes(raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that begin somewhere, in the forms of an anchor's and of a content's."""
    words = np.zeros((len(begin), -(-WINDOW // 8) * 8), np.uint8)
    words[:, :WINDOW] = raw[begin[:, None] + np.arange(WINDOW)]
    h = np.full(len(begin), 0x243F6A8885A308D3, np.uint64)
    for column in words.view("<u8").T:
        h = (h ^ column) * MIX[0]
        h ^= h >> np.uint64(29)
    h *= MIX[3]
    h ^= h >> np.uint64(32)
    return (h >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64), (h & np.uint64(2**48 - 1)).astype(np.int64)


def sent_rows(own: Block, number: int, buckets: int, anchor: np.ndarray, content: np.ndarray, entry: np.ndarray, offset: np.ndarray, begin: np.ndarray, length: np.ndarray) -> list[tuple]:
    """Rows of texts by bucket, from columns in the anchors' order."""
    rows = []
    for bucket, k in bucket_slices(anchor, buckets * FINER):
        e = entry[k]
        rows.append((number, bucket, 3, pack(np.diff(anchor[k], prepend=0), content[k], own.least[e], own.several[e], np.diff(e, prepend=0), length[k], offset[k], text=gathered(own.raw, begin[k], length[k]).tobytes())))
    return rows


def senders(buckets: int):
    """Map of a block and its candidates: the entries' texts, by bucket."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            own = opened(left)
            told = [unpack(p, 2)[0] for p in right.column("part").to_pylist()]
            place, hot = np.concatenate([np.cumsum(t[0]) for t in told]), np.concatenate([t[1] for t in told]) > 0
            number, sent = left.column("block")[0].as_py(), np.sort(place[~hot])
            begin = own.first[own.example[sent]]
            rows += sent_rows(own, number, buckets, own.anchor[sent], own.content[sent], sent, np.zeros(len(sent), np.int64), begin, own.last[own.example[sent]] + WINDOW - begin)
            for entry, offset in own.windows_of(place[hot]):
                begin = own.first[own.example[entry]] + offset
                anchor, content = window_hashes(own.raw, begin)
                order = np.argsort(anchor)
                rows += sent_rows(own, number, buckets, anchor[order], content[order], entry[order], offset[order], begin[order], np.full(len(begin), WINDOW))
        return part_rows(rows)

    return run


def earlier_windows(least: np.ndarray, length: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """The least document of each window of the strings, whose own least documents are given, as runs: (string, offset, windows, document)."""
    begin = np.r_[0, np.cumsum(length)[:-1]]
    lone = np.arange(len(length))
    s = np.ones(len(text) + len(length), np.int64)  # a mark ends each stretch
    at = np.arange(len(text)) + np.repeat(lone, length)
    s[at] = text.astype(np.int64) + 2
    order = suffix_array(s, WINDOW)
    of = np.full(len(s), -1, np.int64)
    n_windows = length - WINDOW + 1
    starts = np.repeat(begin + lone, n_windows) + np.arange(n_windows.sum()) - np.repeat(np.r_[0, np.cumsum(n_windows)[:-1]], n_windows)
    of[starts] = np.repeat(lone, n_windows)
    order = order[of[order] >= 0]
    padded = np.r_[np.minimum(s - 1, 255).astype(np.uint8), np.zeros(64, np.uint8)]  # a byte may share a mark's value: marks aren't in windows
    padded[at] = text
    same = np.ones(len(order) - 1, bool)
    for k in (*range(0, WINDOW - 7, 8), WINDOW - 8):
        eight = np.zeros(len(order), np.uint64)
        for j in range(8):
            eight |= padded[order + k + j].astype(np.uint64) << np.uint64(8 * j)
        same &= eight[1:] == eight[:-1]
    group = np.flatnonzero(np.r_[True, ~same])
    minimum = np.repeat(np.minimum.reduceat(least[of[order]], group), np.diff(np.r_[group, len(order)]))
    least_at = np.empty(len(s), np.int64)
    least_at[order] = minimum
    found = least_at[starts]
    stretch = of[starts]
    offset = starts - (begin + lone)[stretch]
    new = np.ones(len(found), bool)
    new[1:] = (stretch[1:] != stretch[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    return stretch[first], offset[first], np.diff(np.r_[first, len(found)]), found[first]


def compare(bucket: pa.Table) -> pa.Table:
    """Texts of a bucket's candidates -> (kind 4) for each block, runs of windows that an earlier document has: (place of the entry, offset, windows, document)."""
    found = [unpack(p, 7) for p in bucket.column("part").to_pylist()]
    anchor, place = (np.concatenate([np.cumsum(f[0][i]) for f in found]) for i in (0, 4))
    content, least, several, length, shift = (np.concatenate([f[0][i] for f in found]) for i in (1, 2, 3, 5, 6))
    source = np.repeat(np.arange(len(found)), [len(f[0][0]) for f in found])
    text = np.frombuffer(b"".join(f[1] for f in found), np.uint8)
    del found
    begin = np.r_[0, np.cumsum(length)[:-1]]
    order = content_order(anchor, content)
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(content[order]) != 0)
    new = parted(text, begin[order], length[order], new)
    first = np.flatnonzero(new)
    string = np.empty(len(order), np.int64)  # of each entry
    string[order] = np.cumsum(new) - 1
    example = order[first]
    string_least = np.minimum.reduceat(least[order], first)
    # anchors together, as many as fit
    of_anchor = np.flatnonzero(np.r_[True, np.diff(anchor[example]) != 0])
    sizes = np.cumsum(np.add.reduceat(length[example], of_anchor))
    cut = np.r_[of_anchor[np.flatnonzero(np.r_[True, np.diff(sizes // SORT_BYTES) > 0])], len(example)]
    runs = []
    for a, b in zip(cut, cut[1:]):
        own, *rest = earlier_windows(string_least[a:b], length[example[a:b]], gathered(text, begin[example[a:b]], length[example[a:b]]))
        runs.append((own + a, *rest))
    run_string, offset, n, document = (np.concatenate([r[i] for r in runs]) for i in range(4))
    start = np.searchsorted(run_string, np.arange(len(example) + 1))
    times = np.diff(start)[string]
    entry = np.repeat(np.arange(len(string)), times)
    at = np.repeat(start[string] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
    use = (document[at] < least[entry]) | (several[entry] > 0)
    entry, at = entry[use], at[use]
    rows = []
    edges = np.searchsorted(source[entry], np.arange(bucket.num_rows + 1))
    for block, a, b in zip(bucket.column("block").to_pylist(), edges, edges[1:]):
        if b > a:
            rows.append((block, bucket.column("bucket")[0].as_py(), 4, pack(np.diff(place[entry[a:b]], prepend=0), offset[at[a:b]] + shift[entry[a:b]], n[at[a:b]], document[at[a:b]])))
    return part_rows(rows)


def removed_bytes(own: Block, parts: pa.Table) -> np.ndarray:
    """Which of the block's bytes go."""
    step = np.zeros(len(own.raw) + 1, np.int32)
    for part in parts.column("part").to_pylist():
        (entry, offset, n, document), _ = unpack(part, 4)
        entry = np.cumsum(entry)
        times = own.begin[entry + 1] - own.begin[entry]
        which = own.order[np.repeat(own.begin[entry] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())]
        offset, n, document = np.repeat(offset, times), np.repeat(n, times), np.repeat(document, times)
        hit = own.doc[which] > document
        a = own.first[which[hit]] + offset[hit]
        np.add.at(step, a, 1)
        np.add.at(step, a + n[hit] + WINDOW - 1, -1)
    return np.cumsum(step[:-1]) > 0


def run_through(docs: DataFrame, key: str, text: str, rest: list[str], finish, schema: str | T.StructType, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All steps; finish(block, removed, rest of the rows) gives a block's output table."""
    spark = docs.sparkSession
    blocks = materialise(blocks_of(docs, key, text, rest, block_bytes), "text-blocks", 4)
    total = blocks.agg(F.coalesce(F.sum("raw_bytes"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    told = materialise(anchors(blocks, buckets).groupBy("bucket").applyInArrow(trimmed_group(decide), PART), "candidates")
    forget(spark)
    by_block = blocks.groupBy("block")
    sent = by_block.cogroup(told.groupBy("block")).applyInArrow(trimmed_group(senders(buckets)), PART)
    windows = materialise(sent.groupBy("bucket").applyInArrow(trimmed_group(compare), PART), "windows")
    forget(spark)

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        own = opened(left)
        others = zstandard.ZstdDecompressor().decompress(left.column("rest")[0].as_py())
        return finish(own, removed_bytes(own, right), pa.ipc.open_stream(others).read_all() if rest else None)

    out = by_block.cogroup(windows.groupBy("block")).applyInArrow(trimmed_group(last), schema)
    return right_sized(out, blocks)


def digest_table(own: Block, removed: np.ndarray, rest: pa.Table) -> pa.Table:
    begins = np.r_[0, own.ends[:-1]].astype(np.int64)
    sizes = own.ends - begins
    total = np.r_[0, np.cumsum(removed)]
    n_removed = total[own.ends] - total[begins]
    run = removed.copy()
    run[1:] &= ~removed[:-1]
    inner = begins[(begins < len(removed)) & (sizes > 0)]
    run[inner] = removed[inner]
    runs = np.r_[0, np.cumsum(run)]
    hashes = []
    for a, b, n in zip(begins.tolist(), own.ends.tolist(), n_removed.tolist(), strict=True):
        body = own.raw[a:b]
        hashes.append(hashlib.sha256((body[~removed[a:b]] if n else body).tobytes()).hexdigest())
    return pa.table({"doc_id": rest.column("id"), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(runs[own.ends] - runs[begins], pa.int64()), "kept_sha256": pa.array(hashes, pa.string())})


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of each row."""
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return run_through(narrow, "id", "text", ["id"], digest_table, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", **sizes)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", count: str | None = "n_removed", **sizes: int) -> DataFrame:
    """The rows with what is left of their texts; texts that were null stay null. The number of removed bytes is in `count` (None: nowhere)."""
    others = [c for c in docs.columns if c != text]
    numbered = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text).alias("body"), F.col(text).isNull().alias("was_null"))
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(others)]
    schema = T.StructType([*fields, T.StructField("was_null", T.BooleanType()), T.StructField("body", T.StringType()), T.StructField("n_removed", T.LongType())])

    def finish(own: Block, removed: np.ndarray, rest: pa.Table) -> pa.Table:
        begins = np.r_[0, own.ends[:-1]].astype(np.int64).tolist()
        left = [own.raw[a:b][~removed[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(begins, own.ends.tolist(), strict=True)]
        gone = [int(removed[a:b].sum()) for a, b in zip(begins, own.ends.tolist(), strict=True)]
        return rest.append_column("body", pa.array(left, pa.string())).append_column("n_removed", pa.array(gone, pa.int64()))

    out = run_through(numbered, f"c{others.index(key)}", "body", [*[f.name for f in fields], "was_null"], finish, schema, **sizes)
    told = {c: F.col(f"c{i}") for i, c in enumerate(others)} | {text: F.when(~F.col("was_null"), F.col("body"))}
    return out.select(*[told[c].alias(c) for c in docs.columns], *([] if count is None else [F.col("n_removed").alias(count)]))
