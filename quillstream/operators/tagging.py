"""Dictionary tagging of names in texts, and alignment helpers over tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.operators.dictionary import named_spans

#: Tokens that are tagged at once; a longer text is tagged whole.
TOKENS = 500_000


def placed(spans: Iterable[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Of spans (first, n, kind) those none of whose places went to a longer one, or to an earlier one of equal length; of one place and length the least kind."""
    taken = set()
    for first, n, kind in sorted(spans, key=lambda s: (-s[1], s[0], s[2])):
        own = range(first, first + n)
        if taken.isdisjoint(own):
            yield first, n, kind
        taken.update(own)


def tagged(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """key, position, token, tag of rows (key, words, spans: first, n, value), some TOKENS at a time; empty words are left out."""
    for batch in batches:
        lengths = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(lengths, (lengths[at - 1] if at else 0) + TOKENS, "right")))
            keys, words, spans = (batch.column(c).slice(at, to - at) for c in (key, "words", "spans"))
            at = to
            row, tokens = pc.list_parent_indices(words).to_numpy().astype(np.int64), words.flatten()
            begins = np.searchsorted(row, np.arange(len(words)))
            names, tag = {"O": 0}, np.zeros(len(row), np.int32)
            for begin, found in zip(begins.tolist(), spans.to_pylist(), strict=True):
                for first, n, kind in placed((s["first"], s["n"], s["value"]) for s in found or ()):
                    marks = [f"<{kind}/>"] if n == 1 else [f"<{kind}>", *[kind] * (n - 2), f"</{kind}>"]
                    tag[begin + first : begin + first + n] = [names.setdefault(m, len(names)) for m in marks]
            some = pc.fill_null(pc.not_equal(tokens, ""), False)
            position = pa.array((np.arange(len(row)) - begins[row]).astype(np.int32))
            tags = pa.array(list(names)).take(pa.array(tag))
            yield pa.RecordBatch.from_arrays([c.filter(some) for c in (keys.take(pa.array(row)), position, tokens, tags)], [key, "position", "token", "tag"])


def tag_names(docs: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    """key, position, token, tag of each token: X of a name of one word is <X/>, of more <X> … </X>, everything else O.

    Names (name, kind) of any number of words; of names that overlap the longer one stands. Rows of one key are tagged one by one.
    """
    found = named_spans(docs.select(key, F.split(text, r"\s+").alias("words")), names.select("name", F.col("kind").alias("value")))
    kind = docs.schema[key].dataType.simpleString()
    return found.mapInArrow(lambda batches: tagged(batches, key), f"`{key}` {kind}, position int, token string, tag string")


def normalisation_pairs(lines: DataFrame, line: str) -> DataFrame:
    """orig, norm of <normalised orig="X" …>Y</normalised> tags."""
    pattern = r'<normalised orig="([^"]*)"[^>]*>([^<]*)</normalised>'
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit(pattern), F.lit(1)).alias("orig"), F.regexp_extract_all(line, F.lit(pattern), F.lit(2)).alias("norm"))
    return lines.select(F.explode(pairs).alias("p")).select(F.col("p.orig").alias("orig"), F.col("p.norm").alias("norm"))
