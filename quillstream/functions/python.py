"""Functions that built-in expressions can't state, as Arrow-batched pandas functions: spans of sentences, edit distance, XML and HTML events."""

from __future__ import annotations

import codecs
import functools
import html
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.parsers import expat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TEXT, NUMBER = T.StringType(), T.IntegerType()
SPANS = T.ArrayType(struct(start=NUMBER, end=NUMBER))
EVENTS = T.ArrayType(struct(kind=TEXT, name=TEXT, attributes=T.MapType(TEXT, TEXT), text=TEXT))


#: Fixed values of the sentence boundary rules: marks that end a sentence for sure, that may, that go on, and quotes that close.
SURE, MAYBE, GOES_ON, QUOTES = "!?\u203c\u203d\u2047\u2048\u2049\u3002\ufe56\ufe57\uff01\uff1f\uff61\u061f\u06d4\u0964\u0965", ".\u2024\ufe52\uff0e", ",-:\u055d\u060c\u2013\u2014\u3001\ufe10\ufe11\ufe50\ufe51\ufe55\ufe58\ufe63\uff0c\uff0d\uff1a\uff64", "\"'"
_SENTENCE_END = re.compile("P|[AT]C*S*P?")
_THEN_LOWER = re.compile("[^OULPAT]*L")


@functools.lru_cache(maxsize=65_536)
def sentence_class(c: str) -> str:
    """Class of a character in the sentence boundary rules: A maybe and T surely an end, C closing, S blank, P new paragraph, L U O letters, N digit, M going on, E part of the character before, X other."""
    for marks, name in ((SURE, "T"), (MAYBE, "A"), (GOES_ON, "M"), (QUOTES, "C")):
        if c in marks:
            return name
    kind = unicodedata.category(c)
    if c in "\n\r\x85\u2028\u2029":
        return "P"
    if c.isspace():
        return "S"
    if kind in ("Mn", "Mc", "Me", "Cf"):
        return "E"
    if kind in ("Ps", "Pe", "Pi", "Pf"):
        return "C"
    if kind == "Nd":
        return "N"
    return {"Ll": "L", "Lu": "U", "Lt": "U"}.get(kind, "O" if kind[0] == "L" or kind == "Nl" else "X")


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """Spans that tile a text, by Unicode's sentence boundary rules."""
    of = {c: sentence_class(c) for c in set(text)}
    at, classes = [], []
    for i, c in enumerate(text):
        if of[c] == "E" and classes and classes[-1] != "P":  # belongs to the character before
            continue
        if c == "\n" and i and text[i - 1] == "\r":  # one line end
            continue
        at.append(i)
        classes.append("X" if of[c] == "E" else of[c])
    at.append(len(text))
    joined = "".join(classes)
    cuts = [0]
    for m in _SENTENCE_END.finditer(joined):
        a, b = m.span()
        if joined[b - 1] != "P":
            then = joined[b : b + 1]
            number = m[0] == "A" and then == "N"
            initial = m[0] == "A" and a > 0 and joined[a - 1] in "UL" and then == "U"
            if not then or then in "MAT" or number or initial or (joined[a] == "A" and _THEN_LOWER.match(joined, b)):
                continue
        cuts.append(at[b])
    cuts.append(len(text))
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


@F.pandas_udf(SPANS)
def sentence_spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else [{"start": a, "end": b} for a, b in sentence_bounds(t)])


def substring_distances(needle: str, haystack: str) -> list[tuple[int, int, int]]:
    """(start, length, cost) of the best substring of the haystack that ends at each place, start 0 or more.

    One row of costs for each letter of the needle. Among equal costs a letter is inserted, then substituted, then
    deleted. What a row inserts depends on its own left neighbour: costs that only rise by one along the row are a
    running minimum of cost - place, and the length follows from where that minimum was taken.
    """
    n, m = len(needle), len(haystack)
    if not m:
        return [(0, 0, n)]
    place = np.arange(m + 1)
    hay = np.array([ord(c) for c in haystack])
    cost, length = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i, c in enumerate(needle):
        substituted, deleted = cost[:-1] + (hay != ord(c)), cost[1:] + 1
        own = np.r_[i + 1, np.minimum(substituted, deleted)]
        own_length = np.r_[i + 1, np.where(substituted <= deleted, length[:-1] + 1, length[1:])]
        from_left = own - place
        best = np.minimum.accumulate(from_left)
        # the leftmost place with the minimum: insertion wins ties
        source = np.maximum.accumulate(np.where(np.r_[True, best[1:] < best[:-1]], place, 0))
        cost, length = best + place, own_length[source] + place - source
    return [(e - k, k, d) for e, (k, d) in enumerate(zip(length.tolist(), cost.tolist(), strict=True)) if e - k >= 0]


def end_costs(needle: str, haystack: str, anchored: bool = False, steps: list[tuple[int, int]] | None = None) -> list[int]:
    """The least cost of a substring that ends at each place (anchored: of the one from the start), a column of the table at a time. steps: gets the bit sets of each column.

    The steps down a column differ by one at most, so they are two bit sets, and one addition carries along runs of matches.
    """
    m = len(needle)
    whole, top = (1 << m) - 1, 1 << max(m - 1, 0)
    equal: dict[str, int] = {}
    for i, c in enumerate(needle):
        equal[c] = equal.get(c, 0) | 1 << i
    up, down, cost, out = whole, 0, m, [m]
    if not m:
        return [i if anchored else 0 for i in range(len(haystack) + 1)]
    for c in haystack:
        match = equal.get(c, 0)
        vertical = match | down
        horizontal = (((match & up) + up) ^ up) | match
        more, less = down | ~(horizontal | up) & whole, up & horizontal
        if steps is not None:
            steps.append((more, less))
        cost += 1 if more & top else -1 if less & top else 0
        more, less = (more << 1 | anchored) & whole, less << 1 & whole
        up, down = less | ~(vertical | more) & whole, more & vertical
        out.append(cost)
    return out


#: Cells of a table whose bit sets are kept to trace an alignment back; beyond them, numbers of two rows are.
TRACED = 1 << 26


def traced_start(needle: str, haystack: str, steps: list[tuple[int, int]], end: int) -> int:
    """Where the best substring that ends there starts, as substring_distances has it; below 0 if that reaches before the haystack.

    steps: of each column, where a row's cost rises from the column before and where it falls. Back from the last cell, a letter
    is inserted if a step rises there, else deleted if only that is as cheap, else substituted.
    """
    i, j = len(needle), end
    while i and j:
        rises, falls = steps[j - 1]
        bit = 1 << i - 1
        if rises & bit:
            j -= 1
        elif needle[i - 1] != haystack[j - 1] and falls << 1 & bit:
            i -= 1
        else:
            i, j = i - 1, j - 1
    return j - i


def best_substring(needle: str, haystack: str, expected: int | None = None, below: int | None = None) -> tuple[int, int, int]:
    """(cost, start, length), the least; with an expected start, the nearest to it of those of the least cost; place 0 for a cost that isn't `below`.

    Costs are found for every end at once; only ends of the least cost that can still win are traced back, in the piece of the
    haystack that can have a part in it: an alignment of cost c is c letters longer than the needle at most.
    """
    m, steps = len(needle), []
    traced = 0 < m * len(haystack) <= TRACED
    costs = end_costs(needle, haystack, steps=steps if traced else None)
    least = min(costs)
    if below is not None and least >= below:
        return least, 0, 0
    ends = [e for e, c in enumerate(costs) if c == least]
    off = (lambda start: start) if expected is None else (lambda start: abs(start - expected))
    nearest = (lambda e: max(0, e - m - least)) if expected is None else (lambda e: max(0, abs(e - m - expected) - least))
    found: tuple[int, int, int] | None = None
    for e in sorted(ends, key=nearest):
        if found is not None and nearest(e) > found[0]:
            break
        a = max(0, e - m - 2 * least - 1)
        if traced and e:
            starts = [start] if (start := traced_start(needle, haystack, steps, e) - a) >= 0 else []
        elif 0 < m * (e - a) <= TRACED:
            end_costs(needle, haystack[a:e], steps=(own := []))
            starts = [start] if (start := traced_start(needle, haystack[a:e], own, e - a)) >= 0 else []
        else:
            starts = [start for start, length, cost in substring_distances(needle, haystack[a:e]) if cost == least and start + length == e - a]
        for start in starts:
            found = min(found or (off(a + start), a + start, e - a - start), (off(a + start), a + start, e - a - start))
    for e in () if found else ends:  # the table's own lengths can reach before the haystack: back from the end, letter by letter
        for length, cost in enumerate(end_costs(needle[::-1], haystack[max(0, e - m - least) : e][::-1], anchored=True)):
            if cost == least:
                found = min(found or (off(e - length), e - length, length), (off(e - length), e - length, length))
    return (least, *(found or (0, 0, 0))[1:])


@F.pandas_udf(struct(cost=NUMBER, start=NUMBER, length=NUMBER))
def align_substring(needles: pd.Series, haystacks: pd.Series) -> pd.DataFrame:
    rows = [best_substring(n or "", h or "") for n, h in zip(needles, haystacks, strict=True)]
    return pd.DataFrame(rows, columns=["cost", "start", "length"])


@F.pandas_udf(struct(cost=NUMBER, start=NUMBER, length=NUMBER))
def align_near(needles: pd.Series, haystacks: pd.Series, expected: pd.Series, below: pd.Series) -> pd.DataFrame:
    """As align_substring, with expected starts (null: the first counts) and with the costs below which a place is asked for (null: all)."""
    number = lambda x: None if pd.isna(x) else int(x)
    rows = [best_substring(n or "", h or "", number(x), number(b)) for n, h, x, b in zip(needles, haystacks, expected, below, strict=True)]
    return pd.DataFrame(rows, columns=["cost", "start", "length"])


#: What may stand before a document's first element: blanks, instructions, comments of any content, a document type with its own declarations.
_PROLOG = re.compile(r"""(?s)(?:\s+|<\?.*?\?>|<!--.*?-->|<!DOCTYPE(?:[^\["'>]|"[^"]*"|'[^']*')*(?:\[(?:[^\]"'<]|"[^"]*"|'[^']*'|<!--.*?-->|<)*\]\s*)?>)*""")
#: Byte marks and their encodings, the longest first.
_MARKS = ((codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def decoded(content: bytes) -> str:
    """A file's text by its byte mark, else by its first bytes or its declaration, else as ISO-8859-1."""
    for mark, encoding in _MARKS:
        if content.startswith(mark):
            return content.decode(encoding, "replace")
    for begin, encoding in ((b"<\0?\0", "utf-16-le"), (b"\0<\0?", "utf-16-be")):
        if content.startswith(begin):
            return content.decode(encoding, "replace")
    told = re.match(rb"""\s*<\?xml[^>]*encoding=["']([\w-]+)""", content)
    return content.decode(told[1].decode() if told else "iso-8859-1", "replace")


def xml_events(content: bytes) -> list[dict]:
    """Start, end, text and comment events in their order. A document type's entities stay as they are."""
    body = _PROLOG.sub("", decoded(content), count=1)
    out: list[dict] = []

    def add(kind: str, name: str | None = None, attributes: dict | None = None, text: str | None = None) -> None:
        if kind == "text" and out and out[-1]["kind"] == "text":
            out[-1]["text"] += text
        else:
            out.append({"kind": kind, "name": name, "attributes": attributes, "text": text})

    parser = expat.ParserCreate("utf-8")
    parser.UseForeignDTD(True)
    parser.StartElementHandler = lambda n, a: add("start", n, a)
    parser.EndElementHandler = lambda n: add("end", n)
    parser.CharacterDataHandler = lambda t: add("text", text=t)
    parser.CommentHandler = lambda t: add("comment", text=t)
    parser.SkippedEntityHandler = lambda n, _: add("text", text=f"&{n};")
    parser.Parse(body.encode(), True)
    return out


@F.pandas_udf(struct(events=EVENTS, error=TEXT))
def parse_xml(contents: pd.Series) -> pd.DataFrame:
    """Events of each file, or the error that its parser met: one bad file doesn't end the others."""
    rows = []
    for c in contents:
        try:
            rows.append((xml_events(bytes(c)), None))
        except Exception as e:  # noqa: BLE001  isolated by design
            rows.append((None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["events", "error"])


#: Marks that stand for inline elements of annotated verse, on both sides of what they hold.
SIGILS = {"I": "@", "H": "$", "SUP": "^", "KA": "°", "SMALLCAPS": "¨", "SUB": "ˇ", "FR": "€"}


def marked_text(content: bytes) -> str:
    """A piece of XML as text: SIGILS for inline elements, entities decoded, other elements left out but for what they hold."""
    told = [SIGILS.get(e["name"], "") if e["kind"] in ("start", "end") else decode_entities(e["text"]) if e["kind"] == "text" else "" for e in xml_events(content)]
    return "".join(told)


@F.pandas_udf(TEXT)
def inline_marks(pieces: pd.Series) -> pd.Series:
    """marked_text of strings of mixed content; null for one that can't be read."""

    def one(p: str | None) -> str | None:
        try:
            return None if p is None else marked_text(f'<?xml version="1.0" encoding="utf-8"?><_>{p}</_>'.encode())
        except expat.ExpatError:
            return None

    return pieces.map(one)


class _Paragraphs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "p":
            self.found.append("")
            self.open = True

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "article", "body"):
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open:
            self.found[-1] += data


def paragraph_texts(page: str) -> list[str]:
    p = _Paragraphs()
    p.feed(page.replace("&shy;", "").replace("\xad", ""))
    p.close()
    return p.found


@F.pandas_udf(T.ArrayType(TEXT))
def html_paragraphs(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: None if p is None else paragraph_texts(p))


class _Markdown(HTMLParser):
    """Headings, lists and paragraphs as Markdown."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "h1":
            self.out.append("\n\n # ")
        elif re.fullmatch("h[2-4]", tag):
            self.out.append("\n\n ## ")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n* " if kind[0] == "ul" else f"\n{kind[1]}. ")
        elif tag in ("p", "div"):
            self.out.append("\n\n")
        elif tag == "br":
            self.out.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif re.fullmatch("h[1-4]", tag):
            self.out.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.out.append(data)


def markdown(page: str) -> str:
    m = _Markdown()
    m.feed(page)
    m.close()
    return re.sub(r"\n{3,}", "\n\n", "".join(m.out)).strip()


#: Characters of pages whose results leave at once.
PAGE_CHARS = 4_000_000


def in_parts(values: Iterable[str | None], size: int, f: Callable[[str], str]) -> Iterator[list[str | None]]:
    """f of each value, in lists of values of some `size` characters together, one at least."""
    out, held = [], 0
    for v in values:
        out.append(None if v is None else f(v))
        held += len(v or "")
        if held >= size:
            yield out
            out, held = [], 0
    yield out


@F.arrow_udf(TEXT)
def html_markdown(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pages one at a time from Arrow's memory; neither a batch's pages nor its results are held as strings together."""
    for pages in batches:
        for part in in_parts((p.as_py() for p in pages), PAGE_CHARS, markdown):
            yield pa.array(part, pa.string())


#: What a news item's record holds: codes of subjects, then of genres, and the texts that stand in elements of each name.
FEED_TEXTS = ("contentCreated", "contentModified", "headline", "creditline", "by", "urgency")


def feed_item(record: str | None) -> tuple | None:
    """Codes and texts of a record, parsed once; an element's text is as many texts as elements and comments cut it into. versionCreated counts as contentCreated."""
    if not record:
        return None
    codes: dict[str, list] = {"subject": [], "genre": []}
    texts: dict[str, list] = {n: [] for n in FEED_TEXTS}
    around: list[str] = []
    more = False  # whether the next characters belong to the last text

    def start(name: str, attributes: dict) -> None:
        nonlocal more
        more = False
        around.append("contentCreated" if name == "versionCreated" else name)
        if name in codes and "qcode" in attributes:
            codes[name].append(attributes["qcode"])

    def cut(*_) -> None:
        nonlocal more
        more = False

    def end(_: str) -> None:
        cut()
        around.pop()

    def said(text: str) -> None:
        nonlocal more
        held = texts.get(around[-1])
        if held is not None:
            held.append((held.pop() if more else "") + text)
        more = True

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler, parser.CommentHandler, parser.ProcessingInstructionHandler = start, end, said, cut, cut
    parser.Parse(record.encode(), True)
    return (codes["subject"] + codes["genre"], *texts.values())


@F.pandas_udf(struct(codes=T.ArrayType(TEXT), **{n: T.ArrayType(TEXT) for n in FEED_TEXTS}))
def feed_items(records: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([feed_item(r) or (None,) * (1 + len(FEED_TEXTS)) for r in records], columns=["codes", *FEED_TEXTS])


def decode_entities(text: str, extra: dict[str, str] | None = None) -> str:
    """Named entities by HTML's table, then by `extra`, else 〈name〉; numeric ones by their number."""

    def one(m: re.Match) -> str:
        plain = html.unescape(m[0])
        return plain if plain != m[0] else (extra or {}).get(m[1], f"〈{m[1]}〉")

    return re.sub(r"&(#?\w+);", one, text)


def found_within(value: object, name: str) -> list:
    """Everything under a name at any depth of a JSON value, outer before inner, in order."""
    if isinstance(value, list):
        return [x for v in value for x in found_within(v, name)]
    if isinstance(value, dict):
        return [*([value[name]] if name in value else []), *(x for v in value.values() for x in found_within(v, name))]
    return []


def deep_search(column: str, name: str):
    """Values of a name at any depth of JSON strings, as an array of JSON strings; null for what isn't JSON."""

    @F.pandas_udf(T.ArrayType(TEXT))
    def search(values: pd.Series) -> pd.Series:
        def one(v: str | None) -> list | None:
            try:
                return None if v is None else [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in found_within(json.loads(v), name)]
            except ValueError:
                return None

        return values.map(one)

    return search(column)


#: Functions that SQL gets, beside Spark's own.
SQL_FUNCTIONS = {"sentence_spans": sentence_spans, "align_substring": align_substring, "parse_xml": parse_xml, "html_paragraphs": html_paragraphs, "html_markdown": html_markdown, "inline_marks": inline_marks}


def register(spark: SparkSession) -> None:
    """The functions under SQL names, and table functions over a text's parts: its terms, its concordance and its TEI pages."""
    for name, f in SQL_FUNCTIONS.items():
        spark.udf.register(name, f)
    from quillstream.functions import tables

    for name, t in tables.SQL_TABLES.items():
        spark.udtf.register(name, t)


@F.pandas_udf(T.ArrayType(NUMBER))
def running_begins(gaps: pd.Series, hits: pd.Series) -> pd.Series:
    """Where each hit begins, from the lengths of gaps and hits that stand in turn: one pass, however many there are."""
    return pd.Series([None if g is None or h is None else np.cumsum(g[: len(h)]) + np.append(0, np.cumsum(h))[: len(h)] for g, h in zip(gaps, hits, strict=True)], dtype=object)
