"""Token counts with overlap resynchronisation.

Short texts are encoded whole. A huge text is encoded as chunks that overlap, each with character offsets, and two
neighbours are spliced at a boundary that both have and that is proven to be one of the whole text:

* The byte-level pre-tokeniser scans left to right, looks at one character beyond a match at most, and remembers
  nothing. A pre-token that ends before the chunk's last character ends there in the whole text as well, if the
  chunk began at a true boundary.
* So a word boundary that the left chunk has, and the right chunk has too, is true, and from there on the right
  chunk's pre-tokens are those of the whole text. A special token's string may be cut by the left chunk's end, so
  boundaries less than its length from the end don't count.
* Merges never cross pre-tokens, so tokens on both sides are those of the whole text.

If no such boundary is in the overlap (one unbroken word, say), the overlap is widened twofold until there is one or
it holds the whole chunk and the chunk itself is lengthened; in the worst case the text is encoded whole.

Null and empty texts have 0 tokens and 0 bytes. Repeated rows give repeated results, an empty table gives none, and
other columns than the id and the text aren't read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillstream.llm.common import trimmed

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 512
GROUP_CHARS = 262_144
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

_loaded: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str):
    """The tokenizer of a .json file, once for each worker process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _loaded[path] = made
    return _loaded[path]


def _boundaries(encoding, start: int) -> dict[int, int]:
    """Position in the whole text of each word's end -> number of the chunk's tokens up to there."""
    out, words, offsets = {}, encoding.word_ids, encoding.offsets
    for i in range(len(words)):
        if i + 1 == len(words) or words[i + 1] != words[i] or words[i] is None:
            out[start + offsets[i][1]] = i + 1
    return out


def count_huge(text: str, tokenizer, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, guard: int | None = None) -> int:
    """Tokens of one text, chunk by chunk."""
    if guard is None:
        guard = max([1, *(len(t.content) for t in tokenizer.get_added_tokens_decoder().values())])
    total, start, end = 0, 0, min(len(text), chunk)
    left = tokenizer.encode(text[start:end], add_special_tokens=False)
    from_token = 0  # tokens of the left chunk before this one are counted already
    while end < len(text):
        ends = _boundaries(left, start)
        width, spliced = overlap, None
        while spliced is None:
            begin = max(start, end - width)
            if begin == start:  # the overlap is the whole chunk: lengthen the chunk instead
                end = min(len(text), end + (end - start))
                left = tokenizer.encode(text[start:end], add_special_tokens=False)
                break
            until = min(len(text), begin + max(chunk, 2 * width))
            right = tokenizer.encode(text[begin:until], add_special_tokens=False)
            starts = _boundaries(right, begin)
            common = [p for p in ends if begin < p <= end - guard and p in starts and ends[p] >= from_token]
            spliced = min(common, default=None)
            width *= 2
        if spliced is not None:
            total += ends[spliced] - from_token
            left, from_token, start, end = right, starts[spliced], begin, until
    return total + len(left.ids) - from_token


def _groups(texts: list[str]) -> Iterator[list[int]]:
    """Indices of short texts, in groups of bounded size."""
    group, size = [], 0
    for i, t in enumerate(texts):
        if len(t) <= CHUNK_CHARS:
            group.append(i)
            size += len(t)
            if size >= GROUP_CHARS:
                yield group
                group, size = [], 0
    if group:
        yield group


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                counts = [0] * len(texts)
                for group in _groups(texts):
                    for i, e in zip(group, tokenizer.encode_batch_fast([texts[i] for i in group], add_special_tokens=False), strict=True):
                        counts[i] = len(e)
                for i, t in enumerate(texts):
                    if len(t) > CHUNK_CHARS:
                        counts[i] = count_huge(t, tokenizer)
                sizes = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(key, text).mapInArrow(trimmed(run), SCHEMA)
