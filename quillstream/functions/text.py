"""Text analysis as Column expressions: the default analyzer, token counts, splitting, term forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions.python import running_begins

#: Editorial marks that the poem tokenizer deletes (fixed values).
POEM_MARKS = "[]'^°@*|$€\"¨ˇ"
#: White space at a text's ends, each run tried once.
EDGE_BLANKS = r"^\s++|(?<!\s)\s++$"


def trim_space(c: Column) -> Column:
    """Without blanks and line feeds at either end; null stays null."""
    return F.regexp_replace(c, r"^[ \n]+|[ \n]+$", "")


def clean(c: Column) -> Column:
    """Empty cells between pipes collapsed, two or more line feeds made two, ends trimmed."""
    return trim_space(F.regexp_replace(F.replace(c, F.lit(" |  | "), F.lit(" | ")), r"\n\n+", "\n\n"))


def whitespace_tokens(text: Column) -> Column:
    """Tokens between white space; one that ends in a hyphen is joined with the next."""
    return F.split(F.regexp_replace(F.regexp_replace(text, EDGE_BLANKS, ""), r"-\s++(?=\S)", ""), r"\s+")


def strip_punctuation(token: Column) -> Column:
    return F.regexp_replace(token, r"^\p{Punct}++|(?<!\p{Punct})\p{Punct}++$", "")


def analyzer(tokenizer: Callable[[Column], Column], *filters: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """A tokenizer and filters on tokens as one function from text to tokens, empty ones included (they are gaps)."""

    def run(text: Column) -> Column:
        def fold(token: Column) -> Column:
            for f in filters:
                token = f(token)
            return token

        return F.transform(tokenizer(text), fold)

    return run


def default_analyzer(text: Column) -> Column:
    """White-space tokens without punctuation at their ends, in lower case: what
    analyzer(whitespace_tokens, strip_punctuation, F.lower) gives, but with each rule applied once to the whole text
    instead of once to each token. Empty tokens stay, as they are gaps."""
    joined = F.regexp_replace(F.regexp_replace(text, EDGE_BLANKS, ""), r"-\s++(?=\S)", "")
    spaced = F.lower(F.regexp_replace(joined, r"\s+", " "))
    # each run of punctuation is tried once, at its begin: runs of any length take linear time
    return F.split(F.regexp_replace(spaced, r"(?<![^ ])\p{Punct}++|(?<!\p{Punct})\p{Punct}++(?![^ ])", ""), " ")


def n_terms(tokens: Column) -> Column:
    """Tokens that aren't empty."""
    return F.size(F.filter(tokens, lambda t: t != ""))


def n_tokens(tokens: Column) -> Column:
    """Sum of position increments: dropped tokens count with the next one kept, trailing ones don't."""
    return F.coalesce(F.array_max(F.transform(tokens, lambda t, i: F.when(t != "", i + 1).otherwise(0))), F.lit(0))


def letter_tokens(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.filter(F.split(F.lower(text), r"\PL+"), lambda t: t != "")


def word_characters(text: Column) -> Column:
    """Parts between blanks, without anything but ASCII letters, digits and underscores."""
    return F.filter(F.transform(F.split(text, " "), lambda t: F.regexp_replace(t, r"\W", "")), lambda t: t != "")


def topic_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def keyword_set(line: Column) -> Column:
    """Distinct tokens of a lemmatised line, compound marks removed, in order."""
    return F.filter(F.array_distinct(F.transform(F.split(line, r" "), lambda t: F.replace(t, F.lit("#"), F.lit("")))), lambda t: t != "")


def paragraphs(text: Column, mark: str = "\n\n") -> Column:
    return F.split(text, mark)


def heading_level(line: Column) -> Column:
    """1 to 3 for lines that begin with one to three number signs and a blank, else null."""
    return F.when(line.rlike("^#{1,3} "), F.length(F.regexp_extract(line, "^(#{1,3}) ", 1)))


def heading_text(line: Column) -> Column:
    return F.when(line.rlike("^#{1,3} "), F.regexp_replace(line, "^#{1,3} ", ""))


def poem_tokens(text: Column) -> Column:
    """Tokens of annotated verse: footnotes and verse numbers dropped, punctuation at word ends stripped, marks deleted, lower case."""
    bare = F.regexp_replace(text, r"#\d+", "")
    bare = F.regexp_replace(bare, r"(^|\n)[£∞≈]?\d+[\s_]*", "$1")
    mark = r"[\p{Punct}\p{InGeneral_Punctuation}°£∞≈€¨ˇ&&[^\[\]]]"
    edge = rf"(?:\[{mark}*\]|{mark})+"
    kept = F.transform(F.split(bare, r"[\s_]+"), lambda t: F.regexp_replace(F.regexp_replace(t, rf"^{edge}|{edge}$", ""), f"[{''.join(chr(92) + c if c in '[]^' else c for c in POEM_MARKS)}]", ""))
    return F.transform(F.filter(kept, lambda t: t != ""), F.lower)


#: Letters of dialect spelling and their base letters.
DIALECT = dict(zip("üűšśžźżčćńñéèêëíìîïóòôúùûŕřĺľťďý", "yysszzzccnneeeeiiiiooouuurrlltdy", strict=True))


def base_form(token: Column) -> Column:
    """Dialect spelling reduced: base letters, no combining marks; ä, ö and å stay."""
    for pair, letter in (("ä", "ä"), ("ö", "ö"), ("å", "å"), ("ü", "y")):
        token = F.replace(token, F.lit(pair), F.lit(letter))
    return F.translate(F.regexp_replace(token, "[̀-ͯ]", ""), "".join(DIALECT), "".join(DIALECT.values()))


def poem_terms(text: Column) -> Column:
    """Each token's base form, followed at the same position by the token itself where they differ."""
    return token_terms(poem_tokens(text))


def token_terms(tokens: Column) -> Column:
    """The terms of poem_terms, of tokens that have been made already."""
    return F.flatten(F.transform(tokens, lambda t: F.array_distinct(F.array(base_form(t), t))))


def vrt_terms(line: Column) -> Column:
    """Terms of one annotated token line: the word, then lemma, part of speech, features and relations at its position."""
    f = F.split(line, r"\t")
    at = lambda i, mark: F.when(~F.coalesce(F.get(f, F.lit(i)), F.lit("_")).isin("_", ""), F.concat(F.lit(mark), F.get(f, F.lit(i))))
    features = F.transform(F.filter(F.split(F.coalesce(F.get(f, F.lit(4)), F.lit("_")), r"\|"), lambda x: ~x.isin("_", "")), lambda x: F.concat(F.lit("A="), x))
    return F.array_compact(F.concat(F.array(at(0, "W="), at(2, "L="), at(3, "POS=")), features, F.array(at(5, "HEAD="), at(6, "DEPREL="), at(7, "TAG="))))


def postings(tokens: Column) -> Column:
    """array<struct<pos, term>> of the tokens that aren't empty, positions from 0."""
    placed = F.transform(tokens, lambda t, i: F.struct(i.alias("pos"), t.alias("term")))
    return F.filter(placed, lambda p: p["term"] != "")


def offset_postings(text: Column) -> Column:
    """array<struct<pos, term, start, end>> of the default analyzer's tokens that aren't empty, with their places in the text.

    A token's place is that of the white-space token it comes from; one joined over a line's end reaches over both parts.
    """
    raw = r"(?:[^\s]*-\s+)*[^\s]+"
    gaps, hits = F.split(text, raw), F.regexp_extract_all(text, F.lit(raw), F.lit(0))
    begins = running_begins(F.transform(gaps, F.length), F.transform(hits, F.length))
    term = lambda h: F.lower(strip_punctuation(F.regexp_replace(h, r"-\s++(?=\S)", "")))
    placed = F.transform(F.arrays_zip(hits.alias("h"), begins.alias("b")), lambda z, i: F.struct(i.alias("pos"), term(z["h"]).alias("term"), z["b"].alias("start"), (z["b"] + F.length(z["h"])).alias("end")))
    return F.filter(placed, lambda p: p["term"] != "")


def piece_begins(gaps: Column, hits: Column) -> Column:
    """Where each hit begins: gaps and hits stand in turn, so their lengths add up to the offsets."""
    return F.aggregate(
        F.arrays_zip(F.transform(gaps, F.length).alias("g"), F.transform(hits, F.length).alias("h")), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
        lambda a, x: F.struct((a["at"] + x["g"] + F.coalesce(x["h"], F.lit(0))).alias("at"), F.array_append(a["begins"], a["at"] + x["g"]).alias("begins")), lambda a: a["begins"],
    )


def kwic(text: Column, word: str, width: int = 120) -> Column:
    """array<struct<hit, offset, before, word, after>>: hits of a word between non-word characters, with their contexts."""
    pattern = r"(?i)((?:\W|^)" + quote(word) + r"(?:\W|$))"
    flat = F.regexp_replace(text, "\n", " ")
    gaps, hits = F.split(flat, pattern), F.regexp_extract_all(flat, F.lit(pattern), F.lit(1))
    before = lambda g: F.when(F.length(g) > width, F.regexp_replace(F.right(g, F.lit(width)), r"^[^ ]* ", "")).otherwise(g)
    after = lambda g: F.when(F.length(g) > width, F.regexp_replace(F.left(g, F.lit(width)), r" [^ ]*$", "")).otherwise(g)
    begins = piece_begins(gaps, hits)
    zipped = F.arrays_zip(hits.alias("word"), begins.alias("offset"), gaps.alias("gap"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))
    found = F.filter(zipped, lambda z: z["word"].isNotNull())
    return F.transform(found, lambda z, i: F.struct(i.alias("hit"), z["offset"].alias("offset"), before(z["gap"]).alias("before"), z["word"].alias("word"), after(z["next"]).alias("after")))


def quote(word: str) -> str:
    """A word as a literal in a regular expression."""
    return "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in word)
