"""BPE encoding and decoding over a pair occurrence index.

A batch's texts are cut into pre-tokens, and the distinct pre-tokens not met before are encoded together: their
bytes become one linked sequence of symbols, and an index maps each adjacent pair that the vocabulary can merge to
all its positions. Ranks that have positions are active; they are applied in ascending order, each to its whole
position list from left to right, and each merge updates the lists of the pairs that it makes. Lists of pairs that it
breaks aren't searched: a position counts only if its pair still stands there. A symbol's own merge always ranks
before those it takes part in, so ascending order over all pre-tokens is the order within each.

Results of pre-tokens are kept in the worker, in two stores of half of STORE_BYTES each: a full one replaces the older
one, from which what is met again moves over. So memory is bounded, and frequent pre-tokens stay; long ones aren't kept.
Tasks of other operators in the same worker empty both. Special strings are cut out first, and each is one id.

Null texts are empty texts: no ids, and the digests of nothing. Texts of any length are encoded whole; a batch's
pre-tokens are encoded LEARN_BYTES at a time, and a longer one by itself, over arrays of 4 bytes a symbol. Repeated rows
give repeated results, an empty table gives none, and other columns than the id and the text aren't read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillstream.llm.common import stores, trimmed

STORE_BYTES = 180_000_000
#: What an entry takes besides its strings; pre-tokens longer than KEPT characters have none.
ENTRY_BYTES, KEPT = 200, 1000
LEARN_BYTES = 400_000
#: Bits of a symbol in a pair's number.
PAIR_BITS = 24
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Fixed value: the split pattern of byte-level BPE, as the vocabulary's library defines it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[str, "Codec"] = stores.setdefault("bpe", {})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def printable_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file -> byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        byte_of, vocab = printable_bytes(), told["model"]["vocab"]
        raw = {s: bytes(byte_of[c] for c in s) for s in vocab}
        self.bytes_of: dict[int, bytes] = {i: raw[s] for s, i in vocab.items()}
        self.first = np.zeros(256, np.int64)
        for s, i in vocab.items():
            if len(raw[s]) == 1:
                self.first[raw[s][0]] = i
        self.rank: dict[int, int] = {}  # of a pair, its symbols in one number
        self.by_rank: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(told["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a] << PAIR_BITS | vocab[b]] = rank
            self.by_rank.append((vocab[a], vocab[b], vocab[a + b]))
        pairs = np.array(list(self.rank), np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.array(list(self.rank.values()), np.int64)[order]
        special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in special.items()}
        self.special = {s: i.to_bytes(4, "little") for s, i in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.split = regex.compile(SPLIT).findall
        self.known: dict[str, bytes] = dict(self.special)
        self.older: dict[str, bytes] = {}
        self.size = 0

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens, encoded together, as little-endian 32-bit integers."""
        raw = [p.encode() for p in pieces]
        ends = np.cumsum([len(r) + 1 for r in raw]) - 1
        start = self.first[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
        start[ends] = -1  # ends the piece; no pair has it
        n = len(start)
        key = start[:-1] << PAIR_BITS | start[1:]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        places = np.flatnonzero((self.pairs[at] == key) & (start[:-1] >= 0) & (start[1:] >= 0))
        ranks = self.pair_ranks[at[places]]
        order = np.argsort(ranks)
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else np.zeros(0, np.int64)
        active: list[int] = ranks[cuts].tolist()  # in order, so a heap
        # Python's own integers are quicker; a long sequence's would take a hundred bytes each
        listed = np.ndarray.tolist if n <= 2 * LEARN_BYTES else lambda a: array("i", a.astype(np.int32).tobytes())
        where = {r: listed(p) for r, p in zip(active, np.split(places, cuts[1:]), strict=len(cuts) > 0)}
        symbol, after, before = listed(start), listed(np.arange(1, n + 1)), listed(np.arange(-1, n - 1))
        del start, key, at, places, ranks, order
        find, by_rank, pop, push = self.rank.get, self.by_rank, heapq.heappop, heapq.heappush
        while active:
            rank = pop(active)
            a, b, new = by_rank[rank]
            found = sorted(where.pop(rank))
            left, right = new << PAIR_BITS, new
            for i in found:
                if symbol[i] != a:
                    continue
                j = after[i]
                if symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, -2
                k = after[i] = after[j]
                before[k] = i
                if (s := symbol[k]) >= 0 and (r := find(left | s)) is not None:
                    if r in where:
                        where[r].append(i)
                    else:
                        where[r] = [i]
                        push(active, r)
                h = before[i]
                if h >= 0 and (s := symbol[h]) >= 0 and (r := find(s << PAIR_BITS | right)) is not None:
                    if r in where:
                        where[r].append(h)
                    else:
                        where[r] = [h]
                        push(active, r)
        final = np.array(symbol, np.int64)
        alive = final >= 0
        ids = final[alive].astype("<u4").tobytes()
        until = (4 * np.cumsum(alive)[ends]).tolist()
        return dict(zip(pieces, [ids[x:y] for x, y in zip([0, *until], until)]))

    def cut_text(self, text: str) -> list[str]:
        """Pre-tokens and special strings, in order."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out.extend([part] if i % 2 else self.split(part))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            cut = [self.cut_text(t) for t in texts[at : at + 256]]
            if self.size > STORE_BYTES // 2:
                self.older, self.known, self.size = self.known, dict(self.special), 0
            known, older = self.known, self.older
            unknown = set().union(*cut).difference(known)
            fresh = {p: older[p] for p in unknown if p in older}
            for group in by_bytes(unknown.difference(older)):
                fresh |= self.learn(group)
            long = {p: fresh.pop(p) for p in [p for p in fresh if len(p) > KEPT]}
            known.update(fresh)
            self.size += sum(ENTRY_BYTES + len(p) + len(x) for p, x in fresh.items())
            if long:
                known = known | long
            find = known.__getitem__
            out.extend([b"".join(map(find, pieces)) for pieces in cut])
        return out

    def decode(self, ids: bytes) -> str:
        find = self.bytes_of.__getitem__
        return b"".join(map(find, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def by_bytes(pieces: Iterable[str]) -> Iterator[list[str]]:
    """Pieces in groups of about LEARN_BYTES characters; a longer one by itself."""
    group, size = [], 0
    for p in pieces:
        if size and size + len(p) > LEARN_BYTES:
            yield group
            group, size = [], 0
        group.append(p)
        size += len(p)
    if group:
        yield group


def codec(path: str) -> Codec:
    """One codec for each worker process."""
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def encode_column(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id with its token ids (array of int) and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                encoded = own.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([list(memoryview(e).cast("I")) for e in encoded], pa.list_(pa.int32())), pa.array([own.decode(e) for e in encoded], pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    return docs.select(key, text).mapInArrow(trimmed(run, "bpe"), "doc_id long, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count, and digests of the ids and of the text decoded from them, of each row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                encoded = own.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([len(e) // 4 for e in encoded], pa.int64()),
                        pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                        pa.array([hashlib.sha256(own.decode(e).encode()).hexdigest() for e in encoded], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(key, text).mapInArrow(trimmed(run, "bpe"), SCHEMA)
