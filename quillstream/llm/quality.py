"""Quality rules: base counts of each text, and n-gram perplexity bands for each language.

The language model is an interpolated, modified Kneser-Ney model over n-grams of ORDER characters, real code points
but for blanks, which are one character, and digits, which are another. It is made of distinct texts, so copies change
no verdict. An n-gram enters it if it stands in texts of different signatures (least hash of a text's strings of ALIKE
characters, 16 bits): what one text and its near copies alone have doesn't make them likely. Near copies in a unit count
as one text, so a group of any size has little weight. The counts' own statistics give the discounts before that cut.

1. Units. Texts of a language are dealt by a hash into units of UNIT_BYTES, whatever the input's size. A unit's content, its distinct
   texts, follows from the data alone, so it is put together again for scoring instead of being stored.
2. Counts. Each unit gives its distinct n-grams with their counts and holders; Spark adds them up.
   Continuation counts, discounts and back-off weights are joins over the distinct n-grams, which grow with the corpus.
   Every n-gram of the corpus gets its log-probability there, by back-off if it isn't in the model itself.
3. Arrays. The model is stored as arrays sorted by the n-grams' 64-bit hashes, cut into shards of SHARD_ENTRIES by the
   hashes' ranges. Each unit sends its hashes to the shards, where they are found by binary search, and gets the
   log-probabilities back. So no task and no driver holds more of the model than a shard and a unit's share.
4. Scores. A text's score is its mean negative log-probability for each character.

Within each language, the distinct texts that pass the base rules are grouped by length (powers of two). Each group
takes in its neighbours in length, one on either side at least and more until LEAST_TEXTS texts are there (or the
language has no more), and gives a lower and an upper band around the median: LOW_SPREADS and HIGH_SPREADS robust
standard deviations below and above. A neighbour's deviations are scaled by the square root of the lengths' ratio, as
texts vary less the longer they are. The lower band is LOW_LEAST divided by the square root of the text's characters
wide at least (what texts of that length vary by on their own), the upper one
HIGH_LEAST nats: passages in another language raise a clean text's perplexity. Bands made of few texts are wider.

Null and empty texts have no words and fail the base rule. A language is the first part of its code, two or three
letters; null and anything else is "und". Texts of any length are whole: long ones are worked on in pieces of PIECE
characters that overlap by an n-gram. Each repeated row gets its own result row, with the verdict of its text and
language; equal losses get equal verdicts. Empty tables give empty results, and columns besides id, text and language
aren't read (`kept_documents` hands them on, whatever their names).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.common import forget, grouped, materialise, pack, right_sized, rows_of, trimmed, trimmed_group, unpack

ORDER = 5
#: Strings of so many characters tell near copies; a power of two.
ALIKE = 32
SEVERAL = -1
MIN_WORDS = 50
MAX_REPEATED = 0.5
LOW_SPREADS, LOW_LEAST = 5.0, 4.5
HIGH_SPREADS, HIGH_LEAST = 10.0, 0.9
#: Distinct texts that a band is made of, if the language has so many; one of n texts is 1 + FEW / n times as wide.
LEAST_TEXTS = 200
FEW = 10
#: Medians are exact to this part of a nat.
STEPS = 10_000
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
UNIT_BYTES = 8_000_000
PIECE = 1_000_000
SHARD_ENTRIES = 500_000
LEAST_SHARDS = 16
#: Texts that a task holds back to send them together, and n-grams that it adds up by itself.
SENT_BYTES, COUNTED = 16_000_000, 2_000_000
#: A character in a code: two longs hold three and two of them.
BITS = 21
THREE, TWO, ONE = (1 << 3 * BITS) - 1, (1 << 2 * BITS) - 1, (1 << BITS) - 1
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: What names a text in its language: two hashes, the language.
TEXT = ["key1", "key2", "model_lang"]


def language(column: Column) -> Column:
    code = F.lower(F.regexp_extract(F.trim(column), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(F.coalesce(code, F.lit("")) == "", "und").otherwise(code)


def text_names(text: str, lang: str) -> list[Column]:
    """TEXT: 128 bits of the text, which tell null and empty apart, and its language."""
    return [F.xxhash64(text, F.col(text).isNull()).alias("key1"), F.xxhash64(F.lit("second"), text).alias("key2"), language(F.col(lang)).alias("model_lang")]


def folding() -> np.ndarray:
    """The character that each code point counts as."""
    out = np.arange(0x110000, dtype=np.uint32)
    out[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x2028, 0x2029, 0x3000]] = 32
    out[48:58] = 48
    return out


FOLDED = folding()
#: Stands before a text; a text's own character of that number counts as the last code point.
MARK, NO_MARK = "\0", chr(0x10FFFF)


def parts_of(texts: list[str]) -> Iterator[tuple[list[int], list[str], list[str]]]:
    """(text numbers, what stands before, characters) of PIECE characters together; a longer text has pieces of its own."""
    waiting: tuple[list[int], list[str], list[str]] = ([], [], [])
    size = 0
    start = MARK * (ORDER - 1)
    for i, t in enumerate(texts):
        if len(t) > PIECE:
            for at in range(0, len(t), PIECE):
                yield [i], [(start + t[max(0, at - ORDER + 1) : at])[-(ORDER - 1) :]], [t[at : at + PIECE]]
            continue
        if size + len(t) > PIECE and size:
            yield waiting
            waiting, size = ([], [], []), 0
        if t:
            waiting[0].append(i), waiting[1].append(start), waiting[2].append(t)
            size += len(t)
    if size:
        yield waiting


def grams_of(before: list[str], parts: list[str]) -> tuple[np.ndarray, ...]:
    """hi, lo of the distinct n-grams that end on a character of the parts, and (n-gram, part, count) of each pair."""
    raw = "".join([x for p in zip(before, parts, strict=True) for x in p])
    s = FOLDED[np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + ORDER - 1)
    part = np.repeat(np.arange(len(parts), dtype=np.uint64), sizes)
    last = np.arange(len(part)) + np.repeat(ends - sizes - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
    present = np.zeros(0x110000, bool)
    present[s] = True
    alphabet = np.flatnonzero(present)
    number = np.zeros(0x110000, np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    dense = number[s].astype(np.uint64)
    width, part_width = np.uint64(max(1, (len(alphabet) - 1).bit_length())), np.uint64(max(1, (len(parts) - 1).bit_length()))
    joined = lambda a, b: _shifted(dense, a, b, width)[last - b]  # noqa: E731  characters a to b before the last one
    if ORDER * int(width) + int(part_width) <= 64:
        code, names = joined(ORDER - 1, 0), None
    else:  # names of the first characters and of the last two: at most PIECE each
        first, first_at = np.unique(joined(ORDER - 1, 2), return_inverse=True)
        second, second_at = np.unique(joined(1, 0), return_inverse=True)
        names = first, second
        code = (first_at.astype(np.uint64) << np.uint64(22)) | second_at.astype(np.uint64)
    pairs = np.sort((code << part_width) | part)
    begin = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    count = np.diff(np.r_[begin, len(pairs)])
    pairs = pairs[begin]
    code = pairs >> part_width
    new = np.r_[True, code[1:] != code[:-1]]
    of = np.cumsum(new) - 1
    code = code[new]
    if names is None:
        letters = [alphabet[((code >> (width * np.uint64(i))) & np.uint64((1 << int(width)) - 1)).astype(np.int64)] for i in range(ORDER)]
    else:
        head, tail = names[0][(code >> np.uint64(22)).astype(np.int64)], names[1][(code & np.uint64(2**22 - 1)).astype(np.int64)]
        mask = np.uint64((1 << int(width)) - 1)
        letters = [alphabet[((tail >> (width * np.uint64(i))) & mask).astype(np.int64)] for i in range(2)]
        letters += [alphabet[((head >> (width * np.uint64(i))) & mask).astype(np.int64)] for i in range(ORDER - 2)]
    hi = letters[2] | (letters[3] << BITS) | (letters[4] << 2 * BITS)
    return hi, letters[0] | (letters[1] << BITS), of, (pairs & np.uint64((1 << int(part_width)) - 1)).astype(np.int64), count


def _shifted(dense: np.ndarray, a: int, b: int, width: np.uint64) -> np.ndarray:
    """At each place, the characters from a - b before it to it, as one number."""
    out = np.zeros(len(dense), np.uint64)
    for back in range(a - b, -1, -1):
        out <<= width
        out[back:] |= dense[: len(dense) - back] if back else dense
    return out


def hashed(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    h = hi.astype(np.uint64) * MIX[0] + lo.astype(np.uint64) * MIX[1]
    h ^= h >> np.uint64(32)
    h *= MIX[2]
    return h ^ (h >> np.uint64(29))


def added(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(hi, lo, count, holder) lists as one, in the order of the hashes."""
    hi, lo, n, holder = (np.concatenate(x) for x in zip(*found, strict=True))
    h = hashed(hi, lo)
    order = np.argsort(h)
    begin = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    return hi[order[begin]], lo[order[begin]], np.add.reduceat(n[order], begin), common(holder[order], begin)


def common(holder: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of each group its one holder, or SEVERAL."""
    least = np.minimum.reduceat(holder, begin)
    return np.where(least == np.maximum.reduceat(holder, begin), least, SEVERAL)


def signatures(texts: list[str]) -> np.ndarray:
    """Least hash of each text's strings of ALIKE characters, which near copies mostly share."""
    out = np.full(len(texts), 2**64 - 1, np.uint64)
    cut = [(i, t[at : at + PIECE + ALIKE - 1]) for i, t in enumerate(texts) for at in range(0, max(1, len(t)), PIECE)]
    sizes = np.cumsum([len(t) for _, t in cut])
    for a, b in itertools.pairwise([0, *np.flatnonzero(np.diff(sizes // PIECE)).__add__(1).tolist(), len(cut)]):
        own = [t.ljust(ALIKE, MARK) for _, t in cut[a:b]]
        s = FOLDED[np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        base, width = MIX[0], 1
        while width < ALIKE:  # hashes of strings of twice the length
            s = s[: len(s) - width] * base + s[width:]
            base, width = np.uint64(int(base) ** 2 % 2**64), 2 * width
        s ^= s >> np.uint64(31)
        s *= MIX[1]
        s ^= s >> np.uint64(30)
        s *= MIX[2]
        s ^= s >> np.uint64(29)
        ends = np.cumsum([len(t) for t in own])
        for back in range(1, ALIKE):  # strings across two texts
            s[ends[:-1] - back] = 2**64 - 1
        np.minimum.at(out, np.array([i for i, _ in cut[a:b]]), np.minimum.reduceat(s, np.r_[0, ends[:-1]]))
    return out


def counted(texts: list[str]) -> tuple[np.ndarray, ...]:
    """hi, lo, count and holder of each distinct n-gram of the texts, in the order of the hashes. Neighbours with one signature count as one text, by the larger count."""
    signature = signatures(texts)
    order = np.argsort(signature, kind="stable")
    found = []
    for numbers, before, parts in parts_of([texts[i] for i in order]):
        hi, lo, of, part, count = grams_of(before, parts)
        alike, kind = np.unique(signature[order[numbers]], return_inverse=True)
        if len(alike) < len(numbers):
            key = of * len(alike) + kind[part]
            by = np.argsort(key)
            begin = np.flatnonzero(np.r_[True, np.diff(key[by]) > 0])
            of, count, part = of[by[begin]], np.maximum.reduceat(count[by], begin), part[by[begin]]
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        holder = (alike & np.uint64(0xFFFF)).astype(np.int64)[kind[part]]
        found.append((hi, lo, np.add.reduceat(count, begin), common(holder, begin)))
    return added(found) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


def losses(texts: list[str], logp: np.ndarray) -> np.ndarray:
    """Mean loss of each text, by binary search in the texts' n-gram hashes in order, whose log-probabilities are given; 0 of an empty text."""
    made = lambda: ((numbers, grams_of(before, parts)) for numbers, before, parts in parts_of(texts))
    pieces = list(made()) if sum(map(len, texts)) <= 16 * PIECE else None
    hashes = np.zeros(0, np.uint64)
    for _, (hi, lo, *_) in pieces or made():
        hashes = np.union1d(hashes, hashed(hi, lo))
    if len(logp) != len(hashes):
        raise ValueError("the texts aren't those that the model was asked about: they have to be the same each time they are read")
    total = np.zeros(len(texts))
    for numbers, (hi, lo, of, part, count) in pieces or made():
        own = logp[np.searchsorted(hashes, hashed(hi, lo))].astype(np.float64)
        total += np.bincount(np.array(numbers)[part], own[of] * count, len(texts))
    return -total / np.maximum(1, [len(t) for t in texts])


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three which the text has twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) < 2_000_000:
        windows = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    else:  # their product wouldn't fit
        pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
        windows = pairs * len(number) + ids[2:]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(n + 2, bool)
    for k in range(3):
        hit[k : k + n] |= twice[:n]
    return int(hit.sum())


def n_units(docs: DataFrame, text: str, lang: str) -> dict[str, int]:
    """Units of each language: 18,279 entries at most."""
    sizes = docs.groupBy(language(F.col(lang)).alias("lang")).agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0)).alias("n"))
    return {r.lang: max(1, -(-r.n // UNIT_BYTES)) for r in sizes.collect()}


PART = "unit long, lang string, kind int, shard int, body binary"


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["unit", "lang", "kind", "shard", "body"])


def dealt(docs: DataFrame, text: str, lang: str, units: dict[str, int]) -> DataFrame:
    """PART rows (kind 0) that hold the texts which aren't empty, compressed, for their units. A task sends each text once, so none arrives more often than there are tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        waiting: dict[tuple, tuple[list, list, list]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (unit, k), (one, two, bodies) in waiting.items():
                yield batch_of([(unit, k, 0, 0, pack(np.array(one), np.array(two), np.array([len(b) for b in bodies]), text=b"".join(bodies), level=3))])
            waiting.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for t, one, two, k in zip(*[part.column(i).to_pylist() for i in range(4)], strict=True):
                    if t and (one, two, k) not in seen:
                        seen.add((one, two, k))
                        body = t.encode()
                        for x, into in zip((one, two, body), waiting.setdefault((one % units[k], k), ([], [], [])), strict=True):
                            into.append(x)
                        size += len(body)
                        if size >= SENT_BYTES:
                            yield from out()
                            size = 0
        yield from out()

    return docs.select(F.col(text).alias("text"), *text_names(text, lang)).mapInArrow(trimmed(run), PART)


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("lang", "unit").sortWithinPartitions("lang", "unit", "kind", "shard")


def opened(rows: Iterator[tuple]) -> tuple[list[tuple[int, int]], list[str], list[bytes]]:
    """Names and texts of a unit, each text once, and the bodies of what else it has got."""
    names, texts, rest = {}, [], []
    for _, _, kind, _, body in rows:
        if kind:
            rest.append(body)
            continue
        (one, two, sizes), raw = unpack(body, 3)
        ends = np.cumsum(sizes)
        for name, a, b in zip(zip(one.tolist(), two.tolist(), strict=True), (ends - sizes).tolist(), ends.tolist(), strict=True):
            if name not in names:
                names[name] = None
                texts.append(raw[a:b].decode())
    order = sorted(range(len(texts)), key=list(names).__getitem__)  # the same whatever order the rows came in
    return sorted(names), [texts[i] for i in order], rest


def unit_counts(docs: DataFrame, text: str, lang: str, units: dict[str, int]) -> DataFrame:
    """unit, lang, body: each unit's distinct n-grams in code order, counts and holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (unit, k), rows in grouped(batches, 2):
            _, texts, _ = opened(rows)
            hi, lo, n, holder = counted([t.replace(MARK, NO_MARK) for t in texts])
            order = np.lexsort((lo, hi))
            yield batch_of([(unit, k, 0, 0, pack(np.diff(hi[order], prepend=0), lo[order], n[order], holder[order]))])

    return by_unit(dealt(docs, text, lang, units)).mapInArrow(trimmed(run), PART)


def codes_in(body: bytes) -> tuple[np.ndarray, ...]:
    (hi, lo, n, holder), _ = unpack(body, 4)
    return np.cumsum(hi), lo, n, holder


def count_n_grams(unit_rows: DataFrame) -> DataFrame:
    """lang, hi, lo, n, and whether several hold it, of every n-gram of the corpus; tasks add up their own units' first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[tuple]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for k, found in waiting.items():
                columns = added(found)
                for at in range(0, len(columns[0]), 100_000):
                    own = [pa.array(np.asarray(c[at : at + 100_000], np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(own[0]), pa.string()), *own], names=["lang", "hi", "lo", "n", "holder"])
            waiting.clear()

        for (_, k), rows in grouped(batches, 2):
            for row in rows:
                waiting.setdefault(k, []).append(codes_in(row[-1]))
                size += len(waiting[k][-1][0])
            if size >= COUNTED:
                yield from out()
                size = 0
        yield from out()

    per_task = unit_rows.mapInArrow(trimmed(run), "lang string, hi long, lo long, n long, holder long")
    return per_task.groupBy("lang", "hi", "lo").agg(F.sum("n").alias("n"), ((F.min("holder") == SEVERAL) | (F.min("holder") != F.max("holder"))).alias("several"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """lang, hi, lo, logp: the log-probability of the last character after those before it, for every n-gram of the corpus.

    At each level the n-grams of the model have n > 0; shorter ones have the number of different characters before
    them, in the model, as their n. The others are there because their probabilities are asked for.
    """
    level = {ORDER: counts.select("lang", "hi", "lo", F.when(F.col("several"), F.col("n")).otherwise(0).alias("n"), F.col("n").alias("all"))}
    for k in range(ORDER - 1, 0, -1):
        keep = (1 << BITS * max(0, k - 2)) - 1
        above = level[k + 1].select("lang", F.col("hi").bitwiseAND(F.lit(keep)).alias("hi"), (F.col("lo") if k > 1 else F.col("lo").bitwiseAND(F.lit(ONE))).alias("lo"), "n")
        own = above.groupBy("lang", "hi", "lo").agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("n"))
        level[k] = materialise(own.withColumn("all", F.col("n")), f"continuations-{k}")
    letters = level[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("letters"))
    lower = None
    for k in range(1, ORDER + 1):
        times = lambda r: F.sum(F.when(F.col("all") == r, 1).otherwise(0)).cast("double")
        t = level[k].groupBy("lang").agg(*[times(r).alias(f"t{r}") for r in (1, 2, 3, 4)])
        y = F.col("t1") / F.greatest(F.col("t1") + 2 * F.col("t2"), F.lit(1.0))
        d = [F.least(F.greatest(r - (r + 1) * y * F.col(f"t{r + 1}") / F.greatest(f"t{r}", F.lit(1.0)), F.lit(0.05)), F.lit(r - 0.05)).alias(f"d{r}") for r in (1, 2, 3)]
        told = t.select("lang", *d).join(letters, "lang")  # a row for each language: 18,279 at most
        less = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = [F.shiftright("hi", BITS).alias("c_hi"), (F.shiftleft(F.col("hi").bitwiseAND(F.lit(ONE)), BITS) + F.shiftright("lo", BITS)).alias("c_lo")]
        own = level[k].join(F.broadcast(told), "lang").select("lang", "hi", "lo", "n", "letters", less.alias("less"), *context)
        by_context = own.where("n > 0").groupBy("lang", "c_hi", "c_lo").agg(F.sum("n").alias("whole"), F.sum("less").alias("freed"))
        own = own.join(by_context, ["lang", "c_hi", "c_lo"], "left")
        seen, freed = F.coalesce((F.col("n") - F.col("less")) / F.col("whole"), F.lit(0.0)), F.coalesce(F.col("freed") / F.col("whole"), F.lit(1.0))
        if lower is None:
            p = seen + freed / F.col("letters")
        else:
            keep = (1 << BITS * max(0, k - 3)) - 1
            own = own.withColumns({"s_hi": F.col("hi").bitwiseAND(F.lit(keep)), "s_lo": F.col("lo") if k > 2 else F.col("lo").bitwiseAND(F.lit(ONE))})
            own = own.join(lower.select("lang", F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), F.col("p").alias("p_shorter")), ["lang", "s_hi", "s_lo"])
            p = seen + freed * F.col("p_shorter")
        lower = own.select("lang", "hi", "lo", p.alias("p"))
        if k < ORDER:
            lower = materialise(lower, f"probabilities-{k}")
    return lower.select("lang", "hi", "lo", F.log("p").alias("logp"))


SHARD = "lang string, shard int, kind int, unit long, body binary"


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def arrays(model: DataFrame, shards: int) -> DataFrame:
    """SHARD rows (kind 0): the hashes of a language's shard in order, and their log-probabilities."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = hashed(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard_of(h, shards)), pa.array(h.view(np.int64)), batch.column(3).cast(pa.float32())], names=["lang", "shard", "h", "logp"])

    def one(rows: pa.Table) -> pa.Table:
        h = rows.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        body = pack(h[order].view(np.int64), text=rows.column("logp").to_numpy()[order].astype("<f4").tobytes())
        return pa.table({"lang": rows.column("lang").slice(0, 1), "shard": rows.column("shard").slice(0, 1), "kind": pa.array([0], pa.int32()), "unit": pa.array([0], pa.int64()), "body": pa.array([body], pa.binary())})

    hashes = model.select("lang", "hi", "lo", "logp").mapInArrow(trimmed(named), "lang string, shard int, h long, logp float")
    return hashes.groupBy("lang", "shard").applyInArrow(trimmed_group(one), SHARD)


def requests(unit_rows: DataFrame, shards: int) -> DataFrame:
    """SHARD rows (kind 1): a unit's hashes in order, those of one shard together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, k, _, _, body in rows_of(batches):
            hi, lo, _, _ = codes_in(body)
            h = np.sort(hashed(hi, lo))
            cut = np.searchsorted(shard_of(h, shards), np.arange(shards + 1))
            full = np.flatnonzero(np.diff(cut))
            parts = [pack(np.diff(h[cut[s] : cut[s + 1]].view(np.int64), prepend=0)) for s in full]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(full), pa.string()), pa.array(full.astype(np.int32)), pa.array([1] * len(full), pa.int32()), pa.array([unit] * len(full), pa.int64()), pa.array(parts, pa.binary())], names=["lang", "shard", "kind", "unit", "body"])

    return unit_rows.mapInArrow(trimmed(run), SHARD)


def answers(asked: DataFrame) -> DataFrame:
    """SHARD rows of both kinds -> PART rows (kind 1): the log-probabilities of what each unit asked for, in its order. One shard and one request are in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, shard), rows in grouped(batches, 2):
            hashes, logp = np.zeros(0, np.uint64), np.zeros(0, np.float32)
            for _, _, kind, unit, body in rows:
                (found,), rest = unpack(body, 1)
                if not kind:
                    hashes, logp = found.view(np.uint64), np.frombuffer(rest, "<f4")
                else:
                    yield batch_of([(unit, k, 1, shard, logp[np.searchsorted(hashes, np.cumsum(found).view(np.uint64))].tobytes())])

    return asked.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "kind").mapInArrow(trimmed(run), PART)


def score_units(rows: DataFrame) -> DataFrame:
    """PART rows of texts and answers -> TEXT, n_chars, loss and the base counts of each distinct text."""
    names = [*TEXT, "n_chars", "loss", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, k), group in grouped(batches, 2):
            keys, texts, answered = opened(group)
            logp = np.frombuffer(b"".join(answered), "<f4")
            loss = losses([t.replace(MARK, NO_MARK) for t in texts], logp)
            for at in range(0, len(texts), 1000):
                counts = [base_counts(t) for t in texts[at : at + 1000]]
                own = [*[[n[i] for n in keys[at : at + 1000]] for i in (0, 1)], [k] * len(counts), list(map(len, texts[at : at + 1000])), loss[at : at + 1000], *[[c[i] for c in counts] for i in range(5)]]
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(own, types, strict=True)], names=names)

    return by_unit(rows).mapInArrow(trimmed(run), f"key1 long, key2 long, model_lang string, n_chars long, loss double, {COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > F.lit(int(100 * MAX_REPEATED)) * F.col("n_words"))


def pools(sizes: dict[tuple[str, int], int], least: int) -> list[tuple[str, int, int]]:
    """(language, length group, length group to take in): one neighbour on either side, and more until there are `least` texts."""
    of: dict[str, dict[int, int]] = {}
    for (lang, group), n in sizes.items():
        of.setdefault(lang, {})[group] = n
    out = []
    for lang, own in of.items():
        for group in own:
            reach = 1
            while sum(n for g, n in own.items() if abs(g - group) <= reach) < least and reach < max(abs(g - group) for g in own):
                reach += 1
            out += [(lang, group, g) for g in own if abs(g - group) <= reach]
    return out


def bands(scored: DataFrame) -> DataFrame:
    """model_lang, length_group, middle, spread, wider: from all distinct texts that pass the base rules."""
    good = scored.where(~F.col("base_failed")).select("model_lang", "length_group", "loss")
    sizes = {(r.model_lang, r.length_group): r["count"] for r in good.groupBy("model_lang", "length_group").count().collect()}  # 18,279 languages times 32 lengths at most
    pool = scored.sparkSession.createDataFrame(pools(sizes, LEAST_TEXTS), "model_lang string, pool int, length_group int")
    scale = F.sqrt(F.pow(F.lit(2.0), F.col("length_group") - F.col("pool")))  # a neighbour's spread at this length
    good = good.join(F.broadcast(pool), ["model_lang", "length_group"]).select("model_lang", F.col("pool").alias("length_group"), "loss", scale.alias("scale"))
    cell = ["model_lang", "length_group"]
    middle = medians(good, cell, F.col("loss"), "middle")
    off = good.join(F.broadcast(middle), cell).withColumn("off", F.abs(F.col("loss") - F.col("middle")) * F.col("scale"))
    spread = medians(off, cell, F.col("off"), "off").withColumn("spread", 1.4826 * F.col("off")).drop("off")
    counts = good.groupBy(*cell).agg((1 + FEW / F.count(F.lit(1))).alias("wider"))
    return middle.join(spread, cell).join(counts, cell)


def medians(rows: DataFrame, cell: list[str], value: Column, name: str) -> DataFrame:
    """cell, the lower median of the values to 1 / STEPS, by exact counts: the same in each run. A loss is below 20 nats, so a cell has 20 * STEPS different values at most."""
    counted = rows.groupBy(*cell, F.round(value * STEPS).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*cell)
    placed = counted.select(*cell, "v", F.sum("n").over(whole.orderBy("v")).alias("until"), F.sum("n").over(whole).alias("all"))
    return placed.where(2 * F.col("until") >= F.col("all")).groupBy(*cell).agg((F.min("v") / STEPS).alias(name))


def judged_texts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """TEXT, counts, loss, its band and kept of each distinct text that isn't empty."""
    spark = docs.sparkSession
    units = n_units(docs, text, lang)
    unit_rows = materialise(unit_counts(docs, text, lang, units), "n-gram-units")
    forget(spark)
    counts = materialise(count_n_grams(unit_rows), "n-grams")
    shards = max(LEAST_SHARDS, -(-counts.count() // SHARD_ENTRIES))
    model = materialise(arrays(kneser_ney(counts), shards), "n-gram-model")
    forget(spark)
    answered = answers(model.unionByName(requests(unit_rows, shards)))
    scored = materialise(score_units(dealt(docs, text, lang, units).unionByName(answered)), "scored-texts")
    forget(spark)
    scored = scored.withColumn("base_failed", base_failed()).withColumn("length_group", F.floor(F.log2("n_chars")).cast("int"))
    band = materialise(bands(scored).coalesce(1), "bands")  # as many rows as sizes above
    found = scored.join(F.broadcast(band), ["model_lang", "length_group"], "left")
    low = F.col("middle") - F.col("wider") * F.greatest(LOW_SPREADS * F.col("spread"), LOW_LEAST / F.sqrt("n_chars"))
    high = F.col("middle") + F.col("wider") * F.greatest(HIGH_SPREADS * F.col("spread"), F.lit(HIGH_LEAST))
    found = found.withColumns({"low": low, "high": high})
    return found.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("loss").between(F.col("low"), F.col("high")), F.lit(True)))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base counts, base_failed, perplexity, its band, and kept, for each row: one narrow join with the texts' verdicts."""
    rows = docs.select(F.col(key).alias("doc_id"), *text_names(text, lang))
    found = rows.join(judged_texts(docs, text, lang), TEXT, "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")]
    out = found.select("doc_id", "model_lang", *zero, "loss", "low", "high", F.coalesce("base_failed", F.lit(True)).alias("base_failed"), F.coalesce("kept", F.lit(False)).alias("kept"))
    return right_sized(out.withColumn("perplexity", F.exp("loss")), docs)


def kept_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that `judge` keeps, with all their columns."""
    kept = judged_texts(docs, text, lang).where("kept").select(TEXT)
    rows = docs.select(F.struct("*").alias("row"), *text_names(text, lang))  # a struct, so that no names clash
    return right_sized(rows.join(kept, TEXT, "left_semi").select("row.*"), docs)


def verdicts(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity", F.exp("low").alias("lowest"), F.exp("high").alias("highest"))
