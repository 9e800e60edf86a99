import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstream.functions import python as py
from quillstream.functions import text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("value", "terms", "tokens"),
    [
        ("Foo, bar!", ["foo", "bar"], 2), ("foo - bar", ["foo", "bar"], 2), ("co-\noperate now", ["cooperate", "now"], 2), ("a !!! b ...", ["a", "b"], 3), ("", [], 0), ("  ", [], 0), ("end-", ["end"], 1), ("“Hi!", ["“hi"], 1), ("...", [], 0), ("..a.b.. -c- ,d", ["a.b", "c,d"], 2), ("x\t\n -\n y", ["x", "y"], 2),
    ],
)
def test_default_analyzer(spark, value, terms, tokens):
    t = text.default_analyzer(F.col("t"))
    assert one(spark, value, t) == one(spark, value, text.analyzer(text.whitespace_tokens, text.strip_punctuation, F.lower)(F.col("t")))
    assert one(spark, value, F.filter(t, lambda x: x != "")) == terms
    assert one(spark, value, text.n_tokens(t)) == tokens
    assert one(spark, value, text.n_terms(t)) == len(terms)


@pytest.mark.parametrize(
    ("value", "terms"),
    [
        (
            "∞15 Tuop_ol' vuaksuva#16† *n[uori]* ,[!],J[ougavoine],[!] €Juokahaińe€. \"Oi šie, ^mua̯mo^, kandai̭̯ańi, Ken °miuv_virren °kiit|tä|nöö,\n@Testaan@ *kaikkea* ki'vaa_mitä_ ¨#17¨ voi olla. Läks_on nogi#1 ˇnuorasestaˇ, joka\noli\n35 jotain∞",
            "tuop ol vuaksuva nuori jougavoine juokahaine juokahaińe oi sie šie muamo mua̯mo kandaiani kandai̭̯ańi ken miuv virren kiittänöö testaan kaikkea kivaa mitä voi olla läks on nogi nuorasesta joka oli jotain",
        ),
        ("\"Vesi miun.\n£(Pakka^i^ńi£\n*V[aka] seb°üä°^i^l'i", "vesi miun pakkaini pakkaińi vaka sebyäili sebüäili"),
        ("*Nouzigo kolmen", "nouzigo kolmen"), ("\"Vesi", "vesi"), ("\"*seb°üä°^i^l'i", "sebyäili sebüäili"), ("", ""),
    ],
)
def test_poem_terms(spark, value, terms):
    assert one(spark, value, text.poem_terms(F.col("t"))) == terms.split()


def test_token_forms(spark):
    assert one(spark, "Ab1cd é", text.letter_tokens(F.col("t"))) == ["ab", "cd", "é"]
    assert one(spark, "it's a_b !", text.word_characters(F.col("t"))) == ["its", "a_b"]
    assert one(spark, "talo#n talo kissa talon", text.keyword_set(F.col("t"))) == ["talon", "talo", "kissa"]
    assert one(spark, "X_1 y!", text.topic_tokens(F.col("t"))) == ["x_1", "y"]
    assert one(spark, "word\t_\tlem\tN\tA|_|B\t2\tobj\t_", text.vrt_terms(F.col("t"))) == ["W=word", "L=lem", "POS=N", "A=A", "A=B", "HEAD=2", "DEPREL=obj"]
    assert one(spark, "## Two words", text.heading_level(F.col("t"))) == 2
    assert one(spark, "#no", text.heading_level(F.col("t"))) is None


def test_kwic(spark):
    found = one(spark, "the cat saw The\ndog; other", text.kwic(F.col("t"), "the", 6))
    assert [(k.hit, k.offset, k.before, k.word, k.after) for k in found] == [(0, 0, "", "the ", "cat"), (1, 11, "saw", " The ", "dog;")]


def test_clean(spark):
    assert one(spark, " \n a |  | b\n\n\n\nc \n", text.clean(F.col("t"))) == "a | b\n\nc"


@given(st.text(alphabet="aB .!?\n\"é", max_size=60))
@settings(max_examples=200)
def test_sentences_tile(value):
    spans = py.sentence_bounds(value)
    assert "".join(value[a:b] for a, b in spans) == value


def brute(needle, haystack):
    """Costs and lengths by the plain recurrence, letter by letter."""
    row = [(0, 0)] * (len(haystack) + 1)
    for i, c in enumerate(needle):
        new = [(i + 1, i + 1)]
        for j, h in enumerate(haystack):
            options = [(new[j][0] + 1, new[j][1] + 1), (row[j][0] + (c != h), row[j][1] + 1), (row[j + 1][0] + 1, row[j + 1][1])]
            new.append(min(options, key=lambda o: o[0]))
        row = new
    return [(e - k, k, d) for e, (d, k) in enumerate(row) if e - k >= 0]


@given(st.text(alphabet="abc", max_size=8), st.text(alphabet="abc", min_size=1, max_size=14))
@settings(max_examples=300)
def test_substring_distance(needle, haystack):
    got = {e + k: d for e, k, d in py.substring_distances(needle, haystack)}
    want = {e + k: d for e, k, d in brute(needle, haystack)}
    assert all(got[e] == want[e] for e in got.keys() & want.keys())
    assert py.best_substring(haystack, haystack)[0] == 0


def test_xml_and_html():
    events = py.xml_events('<?xml version="1.0" encoding="iso-8859-1"?><V a="1">x<I>y</I>é&foo;</V>'.encode("iso-8859-1"))
    assert [(e["kind"], e["name"] or e["text"]) for e in events] == [("start", "V"), ("text", "x"), ("start", "I"), ("text", "y"), ("end", "I"), ("text", "é&foo;"), ("end", "V")]
    assert py.paragraph_texts("<p>a &amp; b</p><div>no</div><p>c<b>d</b></p>") == ["a & b", "cd"]
    assert py.markdown("<h1>T</h1><ol><li>a</li><li>b</li></ol><script>x</script>").split("\n") == ["# T", "", "1. a", "2. b"]
    assert py.decode_entities("&amp;&foo;&bar;", {"foo": "F"}) == "&F〈bar〉"


def test_bad_xml_is_isolated(spark):
    rows = spark.createDataFrame([(bytearray(b"<a>1</a>"),), (bytearray(b"<a>"),)], "c binary").select(py.parse_xml("c").alias("p")).select("p.*").collect()
    assert rows[0].error is None and len(rows[0].events) == 3
    assert rows[1].events is None and "ExpatError" in rows[1].error


def test_analyzer_is_linear(spark):
    """Long runs of punctuation and of blanks within a text."""
    import time

    value = "a" + "-" * 300_000 + "b " + " " * 300_000 + "c" + "!" * 300_000 + " d"
    start = time.time()
    got = one(spark, value, F.transform(text.default_analyzer(F.col("t")), F.length))
    assert got == [300_002, 1, 1] and time.time() - start < 20


@pytest.mark.parametrize(
    ("value", "sentences"),
    [
        ("One. Two", ["One. ", "Two"]), ("e.g. this. And", ["e.g. this. ", "And"]), ("U.S.A. is", ["U.S.A. is"]), ("It is 3.14. Yes", ["It is 3.14. ", "Yes"]), ("He said (no.) Then", ["He said (no.) ", "Then"]), ("What?! No", ["What?! ", "No"]),
        ("“Stop.” he said. “Go.” She", ["“Stop.” he said. ", "“Go.” ", "She"]), ("a\nb", ["a\n", "b"]), ("a\r\nb", ["a\r\n", "b"]), ("まず。次", ["まず。", "次"]), ("End. 5 more", ["End. 5 more"]), ("End. 5 More", ["End. ", "5 More"]), ("end. – then", ["end. – then"]), ("Oh! dear", ["Oh! ", "dear"]), ("", []), ("x", ["x"]),
    ],
)
def test_sentence_boundaries(value, sentences):
    assert [value[a:b] for a, b in py.sentence_bounds(value)] == sentences


def test_offset_postings(spark):
    value = "Foo, co-\n operate (now)  ... end-"
    got = one(spark, value, text.offset_postings(F.col("t")))
    assert [(p.pos, p.term, value[p.start : p.end]) for p in got] == [(0, "foo", "Foo,"), (1, "cooperate", "co-\n operate"), (2, "now", "(now)"), (4, "end", "end-")]


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32"])
def test_xml_encodings(encoding):
    events = py.xml_events('<?xml version="1.0"?><a>é漢</a>'.encode(encoding))
    assert [e["text"] for e in events if e["kind"] == "text"] == ["é漢"]


def test_xml_prologs():
    head = '<?xml version="1.0" encoding="utf-8"?>\n<!-- a > b <c> --><!DOCTYPE d PUBLIC "x>y" "z" [<!ENTITY e "]>"><!-- ] > --><!ELEMENT d ANY>] >\n'
    events = py.xml_events(f"{head}<d>&e;x</d>".encode())
    assert [(e["kind"], e["name"] or e["text"]) for e in events] == [("start", "d"), ("text", "&e;x"), ("end", "d")]


def test_inline_marks(spark):
    got = one(spark, "a<I>b</I> <FR>c</FR>&amp;&foo; <Z>d</Z>", py.inline_marks("t"))
    assert got == "a@b@ €c€&〈foo〉 d"
    assert one(spark, "a<I>b", py.inline_marks("t")) is None


def test_sql_functions(spark):
    py.register(spark)
    rows = spark.sql("SELECT * FROM concordance('the cat saw The\ndog; other', 'the', 6)").collect()
    assert [(r.hit, r.offset, r.before, r.word, r.after) for r in rows] == [(0, 0, "", "the ", "cat"), (1, 11, "saw", " The ", "dog;")]
    assert [tuple(r) for r in spark.sql("SELECT * FROM text_terms('co-\n op, x')").collect()] == [(0, "coop", 0, 8), (1, "x", 9, 10)]
    assert [r.text for r in spark.sql("SELECT * FROM tei_pages('<T>a<PB REF=\"2\"/>b</T>')").collect()] == ["a", "b"]
    assert spark.sql("SELECT size(sentence_spans('One. Two.')) AS n").first().n == 2
