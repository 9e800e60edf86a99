"""Table functions for SQL: rows of a text's parts."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

from pyspark.sql.functions import udtf

_EDGES = re.compile(f"^[{re.escape(string.punctuation)}]+|[{re.escape(string.punctuation)}]+$")
_TOKEN = re.compile(r"(?:[^\s]*-\s+)*[^\s]+", re.ASCII)


@udtf(returnType="pos: int, term: string, start: int, end: int")
class Terms:
    """The default analyzer's terms of a text with their places, as functions.text.offset_postings has them."""

    def eval(self, text: str) -> Iterator[tuple]:
        for i, m in enumerate(_TOKEN.finditer(text or "")):
            if term := _EDGES.sub("", re.sub(r"-\s+(?=\S)", "", m[0], flags=re.ASCII)).lower():
                yield i, term, m.start(), m.end()


@udtf(returnType="hit: int, offset: int, before: string, word: string, after: string")
class Concordance:
    """Hits of a word between non-word characters with up to `width` characters on either side, cut at blanks, as functions.text.kwic has them."""

    def eval(self, text: str, word: str, width: int) -> Iterator[tuple]:
        flat = (text or "").replace("\n", " ")
        found = list(re.finditer(rf"(?:\W|^){re.escape(word)}(?:\W|$)", flat, re.IGNORECASE | re.ASCII))
        ends = [0, *(m.end() for m in found)]
        begins = [*(m.start() for m in found), len(flat)]
        for i, m in enumerate(found):
            before, after = flat[ends[i] : m.start()], flat[m.end() : begins[i + 1]]
            before = re.sub("^[^ ]* ", "", before[-width:]) if len(before) > width else before
            after = re.sub(" [^ ]*$", "", after[:width]) if len(after) > width else after
            yield i, m.start(), before, m[0], after


@udtf(returnType="page: string, sub_page: int, text: string")
class TeiPages:
    """Pages of a TEI document, given as a string."""

    def eval(self, document: str) -> Iterator[tuple]:
        from quillstream.plans.tei import page_rows

        yield from page_rows(b'<?xml version="1.0" encoding="utf-8"?>' + (document or "<TEXT/>").encode())


SQL_TABLES = {"text_terms": Terms, "concordance": Concordance, "tei_pages": TeiPages}
