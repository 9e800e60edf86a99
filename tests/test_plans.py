import json

import pytest
from pyspark.sql import functions as F

from quillstream.plans import books, media, scans
from quillstream.plans import tei as plans_tei
from quillstream.sources import readers


def test_books(spark):
    files = spark.createDataFrame([("/x/B1_1_front.txt", "# A\none two\n\nthree."), ("/x/B1_10_body.txt", "four\n"), ("/x/B1_page7.txt", "")], "path string, text string")
    parts = books.part_files(files).withColumnRenamed("prefix", "document_id")
    assert books.page_total(files).collect() == [("B1", 7)]
    meta = books.document_rows(spark.createDataFrame([("B1", "1809", None, None)], "document_id string, pub_date string, pub_date_start string, pub_date_end string"))
    assert meta.select("date_start", "date_end").first() == (18090000, 18099999)
    reuse = spark.createDataFrame([("B1", 4, 8, "f1"), ("B1", 13, 30, "f2")], "document_id string, start int, end int, fragment_id string")
    graphics = spark.createDataFrame([("B1", 1, "", "cap")], "document_id string, part int, type string, caption string")
    got = books.book_levels(parts, meta, reuse, graphics)
    document = got["document"].first()
    assert (document.text, document.reuse_ids, document.total_paragraphs, document.graphic_types, document.content_tokens) == ("# A\none two\n\nthree.four\n", ["f1", "f2"], 2, ["unknown"], 5)  # a lone number sign leaves a gap
    paragraphs = got["paragraph"].orderBy("part", "paragraph").collect()
    assert [(p.text, p.start, p.end, p.headings, p.reuse_ids) for p in paragraphs] == [("# A\none two\n", 0, 12, ["A"], ["f1"]), ("three.\n", 13, 20, ["A"], ["f2"]), ("four\n", 19, 24, [], ["f2"])]
    assert [(s.heading, s.text) for s in got["section"].collect()] == [("A", "one two\n\nthree.")]
    assert sum(len(s.text) for s in got["sentence"].collect()) == sum(len(p.text) for p in paragraphs)
    assert [r.reuses for r in got["part"].orderBy("part").collect()] == [2, 1]


def test_bibliographic(spark):
    level = spark.createDataFrame([("T001",), ("N9",)], "estc_id string")
    meta = spark.createDataFrame([("T0001", "1720", "NA", "English", "TRUE", "FALSE", "a; b", "0")], "estc_id string, publication_year string, latitude string, language string, `language.Latin` string, `language.Greek` string, publication_topic string, obl string")
    got = {r.estc_id: r for r in books.bibliographic(level, meta).collect()}
    assert (got["T001"].publication_year, got["T001"].latitude, got["T001"].estc_language, got["T001"].publication_topic, got["T001"].obl) == (1720, 0.0, ["English", "Latin"], ["a", "b"], "FALSE")
    assert (got["N9"].publication_year, got["N9"].latitude, got["N9"].obl, got["N9"].estc_language) == (0, 0.0, "", [])


def test_bibliographic_kinds(spark):
    level = spark.createDataFrame([("T1",)], "estc_id string")
    meta = lambda pages, born: spark.createDataFrame([("T1", pages, "12", born, "x; y", "1.5")], "estc_id string, pagecount string, `pagecount.orig` string, author_birth string, subject string, obl_area string")
    row = books.bibliographic(level, meta("12.5", "1700")).first()
    assert (row.pagecount, row.pagecount_orig, row.author_birth, row.subject, row.obl_area) == (12.5, 12, 1700, ["x", "y"], "1.5")
    with pytest.raises(Exception, match="author_birth isn't a number"):
        books.bibliographic(level, meta("1", "about 1700")).collect()


def test_reuse(spark):
    hits = spark.createDataFrame([("7", "/x/A1_at_10.txt__5_q", 1, 5, "abcd"), ("7", "/x/2.txt__0_q", 2, 4, "ab")], "cluster string, path string, start int, end int, text string")
    rows, spans = books.reuse_fragments(hits)
    assert {(r.document_id, r["count"], r.avg_length) for r in rows.collect()} == {("101", 2, 3), ("22", 2, 3)}
    assert sorted(spans.collect()) == [("101", 16, 20, "7"), ("22", 2, 4, "7")]


def test_tweets(spark, tmp_path):
    rows = [
        {"id_str": "1", "created_at": "Wed Oct 10 20:19:24 +0000 2018", "text": "Hi #A", "user": {"id_str": "u"}, "entities": {"hashtags": [{"text": "A"}]}, "place": {"bounding_box": {"coordinates": [[[1.0, 2.0], [3.0, 4.0]]]}}},
        {"id_str": "2", "text": "x", "retweeted_status": {"id_str": "9", "text": "orig", "user": {"screen_name": "me"}}}, {"id_str": "3", "text": "re", "in_reply_to_user_id_str": "u"},
    ]
    (tmp_path / "t.json").write_text("\n".join(map(json.dumps, rows)))
    got = {r.id: r for r in media.tweets(readers.read_json_objects(spark, str(tmp_path / "t.json"), media.TWEET), skip=("reply",)).collect()}
    assert set(got) == {"1", "2"} and got["2"].text == "RT @me: orig" and got["2"].type == "retweet"
    assert (got["1"].hashtags, got["1"].hashtags_as_written, got["1"].coordinates.lat, got["1"].possibly_sensitive) == (["a"], ["A"], 3.0, "unknown")


def test_forum(spark, tmp_path):
    (tmp_path / "f.vrt").write_text('<text tid="1" nick="x" title="T" datefrom="20180102" dateto="20180103" time="10:00" views="4">\n<paragraph>\n<sentence>\nHei\t_\tHei\tN\n!\t_\n</sentence>\n</text>\n<text tid="1" nick="y" datefrom="20180104" dateto="20180104" time="11:00">\n<paragraph>\n<sentence>\nMoi\t_\n</text>\n')
    got = media.forum_levels(readers.vrt_rows(readers.read_lines(spark, str(tmp_path / "f.vrt"))))
    thread = got["thread"].first()
    assert (thread.text, thread.posts, thread.nicks, thread.heading) == ("Hei !\n\n====\n\nMoi", 2, ["x", "y"], "T")
    assert [r.is_thread_starter for r in got["post"].orderBy("post").collect()] == ["T", "F"]
    assert got["sentence"].orderBy("post").first().terms[0] == ["W=Hei", "L=Hei", "POS=N"]


def test_speeches(spark):
    frame = spark.createDataFrame
    got = media.speech_levels(
        frame([("s1", "One. Two.")], "id string, text string"), frame([("s1", "en", "2001-02-03", "p1", "a1")], "id string, lang string, date string, speaker string, agenda string"),
        frame([("p1", "Ann", "FI", "", "1950-01-02", "f")], "id string, name string, country string, birthplace string, birthdate string, sex string"), frame([("a1", "Fish")], "id string, text string"), frame([("s1", "f1")], "speech string, function string"),
        frame([("f1", "i1", "x" * 36 + "member")], "id string, institution_id string, role string"), frame([("i1", "House", "chamber")], "id string, name string, type string"),
    )
    speech = got["speech"].first()
    assert (speech.speaker_functions, speech.date, speech.sentences, speech.speaker_place_of_birth, speech.agenda_item) == (["Member, House (chamber)"], 20010203, 2, None, "Fish")
    assert got["sentence"].count() == 2


def test_poems(spark):
    frame = spark.createDataFrame
    got = media.poem_levels(
        frame([("p", 1, "verse", "Vesi šie"), ("p", 2, "comment", "note")], "poem_id string, line_no int, kind string, text string"), frame([("p", 1900, 1, 2)], "poem_id string, year int, place_id int, collector_id int"), frame([(1, "Place")], "place_id int, place string"),
        frame([(2, "Coll")], "collector_id int, collector string"), frame([(5, "T5"), (6, "T6")], "theme_id int, theme string"), frame([("p", 5, False), ("p", 6, True)], "poem_id string, theme_id int, weak boolean"),
    )
    poem = got["poem"].first()
    assert (poem.text, poem.verses, poem.comments, poem.place, poem.themes, poem.weak_themes) == ("Vesi šie\n∞note∞", 1, 1, "Place", ["T5"], ["T6"])
    assert got["line"].orderBy("line_no").first().normalized == "vesi sie"


def test_articles(spark):
    word = lambda w, *tags: {"word": w, "analysis": [{"globalTags": [{t: ["TRUE"] for t in tags}]}]}
    analyzed = json.dumps([[word("Hi", "FIRST_IN_SENTENCE"), word(" ", "WHITESPACE"), word("you", "X"), word(" ", "FIRST_IN_SENTENCE", "WHITESPACE")], [word("Bye", "FIRST_IN_SENTENCE")]])
    levels, missing = media.article_levels(spark.createDataFrame([("a", "T"), ("b", "U")], "article_id string, title string"), spark.createDataFrame([("a", analyzed)], "article_id string, analyzed string"))
    assert missing.collect() == [("b",)]
    assert levels["article"].select("text", "paragraphs", "sentences", "title").first() == ("Hi you \n\nBye", 2, 2, "T")
    assert sorted(r.text for r in levels["sentence"].collect()) == ["Bye", "Hi you"]
    scores = spark.createDataFrame([("a", "sv", 2.0), ("a", "fi", 1.0)], "article_id string, lang string, score double")
    assert [r.article_id for r in media.foreign_articles(spark.createDataFrame([("a",), ("b",)], "article_id string"), scores).collect()] == ["b"]


def test_authorities(spark):
    record = "<r><viafID>1</viafID><nameType>Personal</nameType><mainHeadings><data><text>A; B</text></data><data><text>A; B</text></data></mainHeadings><countries><data><text>FI</text><count>3</count></data></countries><x400s><x400><datafield><subfield code='a'>Alt</subfield><subfield code='9'>no</subfield></datafield></x400></x400s></r>"
    got = media.authority_rows(spark.createDataFrame([(record,)], "record string")).first()
    assert (got.id, got.countries, got.pref_labels, got.alt_labels, got.birth_date) == ("1", "FI:3", "A\\; B", "Alt", None)


def test_kwic_and_ocr(spark):
    docs = spark.createDataFrame([(1, "The cat saw a cat. concat")], "id int, t string")
    got = media.kwic_rows(docs, spark.createDataFrame([("cat",)], "word string"), "id", "t", "cat", width=8).orderBy("offset").collect()
    assert [(r.offset, r.before) for r in got] == [(4, "The "), (14, "saw a ")]
    pages = spark.createDataFrame([("12-3_1900-01", "a", "a", "0.9", "9"), ("12-3_1900-01", "b", "c", "0.1", "1"), ("12-3_1901-01", "d", "d", "", "8")], "page string, clean string, noisy string, confidence string, character_confidence string")
    found = {r.group: r for r in media.ocr_correlations(pages).collect()}
    assert found["all"].n == 2 and abs(found["issn:12-3"].pearson - 1) < 1e-9 and abs(found["year:1900"].kendall - 1) < 1e-9
    assert media.character_pairs(pages).count() == 3


def test_xml_words(spark):
    events = spark.createDataFrame([("p", 0, "text", None, "a"), ("p", 1, "start", "foreign", None), ("p", 2, "text", None, "b"), ("p", 3, "end", "foreign", None), ("p", 4, "text", None, "c")], "path string, event_no int, kind string, name string, text string")
    assert [r.text for r in media.xml_words(events).orderBy("event_no").collect()] == ["a", "c"]


def test_ocr_xml(spark):
    content = b'<book><page type="body"><p><wd pos="0,0,10,10">The</wd><wd pos="12,0,30,10">cat</wd><wd pos="0,12,10,22">sat</wd></p></page><page type="index"><sectionHeader type="section">Index</sectionHeader><p><wd pos="0,0,9,9">end</wd></p></page></book>'
    got = scans.ocr_tables(spark.createDataFrame([("f", bytearray(content))], "path string, content binary"))
    assert [r.text for r in got["pages"].orderBy("page").collect()] == ["The cat\nsat", "end"]
    assert [(r.page_type, r.text) for r in got["sections"].orderBy("section").collect()] == [("body", "The cat\nsat"), ("index", "end")]
    assert [(r.offset, r.x, r.w) for r in got["boxes"].orderBy("offset").collect()][:2] == [(0, 0, 10), (4, 12, 18)]
    assert got["headings"].first().heading == "## Index"


def tei(spark, *bodies, **options):
    """The conversions of several documents."""
    rows = [(f"{i:04}", bytearray(b if isinstance(b, bytes) else f'<?xml version="1.0" encoding="utf-8"?><ETS>{b}</ETS>'.encode())) for i, b in enumerate(bodies)]
    found = plans_tei.convert_tei(spark.createDataFrame(rows, "path string, content binary"), **options).collect()
    return [r.asDict(recursive=True) for r in sorted(found, key=lambda r: r.path)]


def test_tei(spark):
    whole = b'<TEI><DIV1><HEAD>Title</HEAD><P>One <HI>two</HI><NOTE>aside</NOTE> th|ree<PB REF="5"/> four</P><DIV2><HEAD>Sub</HEAD><P><GAP DISP="[..]"/>end</P></DIV2></DIV1></TEI>'
    got, broken, empty = tei(spark, whole, b"<TEI>", b"<TEI/>")
    assert got["text"] == "# Title\n\nOne *two* three four\n\n## Sub\n\n[..]end"
    assert [e["text"] for e in got["extracts"]] == ["aside"] and got["pages"][0]["page"] == "5" and got["gaps"][0]["text"] == "[..]"
    assert "ExpatError" in broken["error"] and broken["text"] is None and broken["parts"] is None
    assert (empty["text"], empty["parts"], empty["error"]) == ("", [], None)


def test_tei_elements(spark):
    through, paragraphs, lines, notes = sorted(plans_tei.PASSED_THROUGH), sorted(plans_tei.PARAGRAPHS - {"TEXT", "ARGUMENT"}), sorted(plans_tei.LINES), sorted(plans_tei.NOTES)
    bodies = [f"<P>a <{n}>b</{n}> c</P>" for n in through] + [f"a<{n}>b</{n}>c" for n in paragraphs + lines] + [f"<P>a<{n}>b</{n}>c</P>" for n in notes]
    got = tei(spark, *bodies)
    assert [g["text"] for g in got] == ["a b c"] * len(through) + ["a\n\nb\n\nc"] * len(paragraphs) + ["a\nb\nc"] * len(lines) + ["ac"] * len(notes)
    assert [[(e["kind"], e["offset"], e["text"]) for e in g["extracts"]] for g in got[-len(notes) :]] == [[(n.lower(), 1, "b")] for n in notes]
    assert {g["text"] for g in tei(spark, *bodies[-len(notes) :], inline_notes=True)} == {"abc"}


def test_tei_structure(spark):
    listed, table, figure, comment = tei(
        spark, "<DIV1><ARGUMENT>about</ARGUMENT><LABEL>L</LABEL>x<LIST><LABEL>l</LABEL><ITEM>i</ITEM></LIST></DIV1>", "<TABLE><ROW><CELL>a\n</CELL><CELL>b</CELL></ROW></TABLE>",
        "<FIGURE><FIGDESC>map</FIGDESC></FIGURE>x<HI>y</HI>", "<!-- unknown entity apos; -->x<!-- unknown entity abque; -->",
    )
    assert listed["text"] == "## about\n\n## L\n\nxl\n * i"
    assert table["text"] == "| a | b |"
    assert figure["text"] == "〈 image: map 〉\n\nx*y*"
    assert comment["text"] == "'x〈abque〉"
    assert tei(spark, "<TABLE><ROW><CELL>a</CELL><CELL>b</CELL></ROW></TABLE>", structure=False)[0]["text"] == "a b"
    core = tei(spark, "x<FIGURE><FIGDESC>map</FIGDESC></FIGURE><HI>y</HI><GAP/>z", core=True, emphases=False)[0]
    assert core["text"] == "x\n\nyz" and core["extracts"][0]["kind"] == "image" and core["gaps"][0]["text"] == "〈?〉"
    assert tei(spark, "so|ft and f\u2223ar", rehyphenate=True)[0]["text"] == "so-\nft and f-\nar"


def test_tei_parts_and_pages(spark):
    got, nested = tei(
        spark, '<TEXT><FRONT><P>f</P></FRONT><PB REF="2"/><BODY><P>b</P><PB REF="3"/><P>c</P><PB REF="3"/><P>d</P></BODY></TEXT>',
        '<TEXT>ahead<BODY><P>one<NOTE>n<NOTE>inner</NOTE></NOTE></P><TEXT><P>two<GAP DISP="?"/></P></TEXT><PB REF="9"/><P>three<NOTE>late</NOTE></P></BODY><BACK> </BACK></TEXT>',
    )
    assert {p["part"]: p["text"] for p in got["parts"]} == {"1_text": "f\n\nb\n\nc\n\nd", "1_text_1_front": "f", "1_text_2_body": "b\n\nc\n\nd"}
    assert [(p["page"], p["text"]) for p in got["page_texts"]] == [("0", "f"), ("2", "b"), ("3", "c"), ("3", "d")] and got["page_texts"][3]["sub_page"] == 2
    assert [p["page"] for p in got["pages"]] == ["2", "3"]
    assert {p["part"]: p["text"] for p in nested["parts"]} == {
        "1_text": "ahead\n\none\n\ntwo?\n\nthree", "1_text_1_prebody": "ahead", "1_text_2_body": "one\n\ntwo?\n\nthree", "1_text_2_body_1_pretext": "one", "1_text_2_body_2_text": "two?",
    }
    assert [(e["kind"], e["text"], e["part"], e["page"]) for e in nested["extracts"]] == [("note", "n", "1_text_2_body", "0"), ("note", "inner", "1_text_2_body_note_at_3", "0"), ("note", "late", "1_text_2_body", "9")]
    assert [(g["offset"], g["page"]) for g in nested["gaps"]] == [(17, "0")]
    assert [(p["page"], p["text"]) for p in nested["page_texts"]] == [("0", "ahead" + "onen" + "inner" + "\n\ntwo?"), ("9", "threelate")]


ALTO = b"""<alto><Styles><TextStyle ID="s0" FONTFAMILY="A" FONTSIZE="8" FONTSTYLE="bold italics"/><TextStyle ID="s1" FONTFAMILY="B" FONTSIZE="9"/><TextStyle ID="s2" FONTFAMILY="C" FONTSIZE="7"/></Styles>
<preProcessingStep><softwareName>pre</softwareName></preProcessingStep><ocrProcessingStep><softwareName>ocr</softwareName><softwareVersion>1.2</softwareVersion></ocrProcessingStep><bindingIdentifier>77</bindingIdentifier><identifier>1234-5678</identifier>
<Page WIDTH="100" HEIGHT="200"><PrintSpace WIDTH="90" HEIGHT="180"/>
<ComposedBlock ID="C" HPOS="0" VPOS="0" WIDTH="9" HEIGHT="9"><TextBlock ID="A" HPOS="0" VPOS="0" WIDTH="40" HEIGHT="10" STYLEREFS="x s0"><TextLine WIDTH="20" HEIGHT="5" STYLEREFS="s1"><String CONTENT="ex-" WIDTH="2" HEIGHT="3" STYLEREFS="s2" SUBS_TYPE="HypPart1" SUBS_CONTENT="example"/></TextLine>
<TextLine><String CONTENT="ample" SUBS_TYPE="HypPart2" WIDTH="5" HEIGHT="2"/><String CONTENT="text" WIDTH="4" HEIGHT="2" STYLEREFS="s1"/></TextLine></TextBlock></ComposedBlock><TextBlock ID="B" HPOS="50" VPOS="5" WIDTH="40" HEIGHT="10"><TextLine><String CONTENT="lone"/></TextLine></TextBlock></Page></alto>"""
METS = b"""<mets><dmdSec ID="MODSMD_ISSUE1"><identifier type="ISSN">1234</identifier><identifier type="binding">77</identifier><dateIssued>1900-01-02</dateIssued></dmdSec>
<amdSec ID="IMGPARAM00001"><PixelSize>0.5</PixelSize><ImageWidth>100</ImageWidth><ImageLength>200</ImageLength></amdSec>
<structMap TYPE="PHYSICAL"><div TYPE="Newspaper"><div TYPE="PAGE"><fptr><par><area FILEID="IMG00001"/><area FILEID="ALTO00001"/></par></fptr></div></div></structMap>
<structMap TYPE="LOGICAL"><div TYPE="Issue"><div TYPE="Article"><area FILEID="ALTO00001"/><area FILEID="ALTO00001"/></div><div TYPE="Ad"><area FILEID="ALTO00002"/></div></div></structMap></mets>"""


def test_alto(spark):
    files = spark.createDataFrame([("i", 1, bytearray(ALTO)), ("i", 2, bytearray(b"<alto><Page/></alto>")), ("i", 3, bytearray(b"<broken"))], "issue string, page int, content binary")
    tables = scans.alto_tables(files)
    assert [(r.page, "ExpatError" in r.error) for r in tables["errors"].collect()] == [(3, True)]
    blocks = tables["blocks"]
    areas = spark.createDataFrame([("i", "u1", "article", None, "d1", 0, "C")], "issue string, unit string, type string, parent_unit string, dmd_id string, place int, block string")
    got = scans.logical_units(blocks, areas, spark.createDataFrame([("d1", "Title")], "dmd_id string, title string"))
    assert got["units"].select("text", "pages", "ordinal", "title").first() == ("example\ntext", [1], 1, "Title")
    assert [r.block for r in got["unreferenced"].collect()] == ["B"]
    assert got["pages"].first().text == "example\ntext\n\nlone"
    mets = scans.mets_tables(spark.createDataFrame([("m", bytearray(METS)), ("n", bytearray(b"no xml"))], "path string, content binary"))
    stats = {k: v.collect() for k, v in scans.materiality(tables, mets).items()}
    assert sorted((r.page, r.weighted_mode, r.median) for r in stats["columns"]) == [(1, 2, 2), (2, 0, 0)]
    assert {r.page: r.words for r in stats["words"]} == {1: 4, 2: 0}
    # block 400 less line 100 and string 8; line 100 less string 6; strings 6 and 8
    assert {r.style: (r.font, r.bold, r.words, r.chars, r.area) for r in stats["styles"]} == {"s0": ("A", True, 1, 5, 400 - 100 - 8), "s1": ("B", False, 1, 4, 100 - 6 + 8), "s2": ("C", False, 1, 3, 6)}
    assert {(r.page, r.width, r.height) for r in stats["page_sizes"]} == {(1, 100, 200), (2, 0, 0)} and [(r.width, r.height) for r in stats["print_spaces"]] == [(90, 180)]
    assert [(r.binding, r.pre_software, r.pre_version, r.ocr_version) for r in stats["software"] if r.page == 1] == [("77", "pre", "?", "1.2")]
    assert ("77", "1234-5678", "?") in stats["issues"] and stats["mets_issues"] == [("77", "1234", "1900-01-02")]
    assert stats["sizes"] == [("77", 1, 50.0, 100.0)]
    assert sorted((r.page, r.type) for r in stats["page_types"]) == [(1, "issue_article"), (2, "issue_ad")]
    assert mets["errors"].count() == 1


def test_style_statistics_stay_in_their_page(spark):
    """Elements aren't joined with each other, which shuffled each of them several times; a single table is not written to be read once."""
    files = spark.createDataFrame([("i", 1, bytearray(ALTO)), (None, 1, bytearray(ALTO)), ("i", 3, bytearray(b"<broken"))], "issue string, page int, content binary")
    styles = scans.materiality(scans.alto_tables(files))["styles"]
    for df in (styles, scans.alto_tables(files, "style_statistics")["style_statistics"]):
        plan = df._jdf.queryExecution().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert sorted((r.issue or "", r.style, r.words, r.chars, r.area) for r in df.collect()) == sorted((i, *x) for i in ("", "i") for x in (("s0", 1, 5, 292), ("s1", 1, 4, 102), ("s2", 1, 3, 6)))
    assert "parquet" not in plan
    one = {"font": "F", "size": 1, "bold": False, "italics": False, "underline": False}
    element = lambda name, parent, refs: {"element": name, "parent": parent, "kind": name[:-1], "refs": refs, "area": 10, "words": 1, "chars": 2}
    got = scans.style_statistics([element("block0", None, ["a"]), element("line1", "block0", ["c"]), element("string2", "line1", ["b", "a", "c"]), element("string3", "line9", []), element("string4", "line1", [])], [{"id": k, **one} for k in ("a", "a", "b", None)])
    assert [(r["style"], r["words"], r["chars"], r["area"]) for r in got] == [("a", 2, 4, 10), ("a", 2, 4, 10), ("b", 0, 0, 0), (None, 0, 0, 0)]


def test_unit_paths(spark):
    rows = [("i", f"u{k}", f"u{k - 1}" if k else None, "t", k) for k in range(20)] + [("i", "x", "nowhere", "t", 1)]
    paths = {r.unit: r.path for r in scans.unit_paths(spark.createDataFrame(rows, "issue string, unit string, parent string, type string, ordinal int")).collect()}
    assert paths == {f"u{k}": "_".join(f"t_{i}" for i in range(k + 1)) for k in range(20)}
    assert scans.unit_paths(spark.createDataFrame([], "issue string, unit string, parent string, type string, ordinal int")).count() == 0


def test_bad_files_do_not_end_others(spark):
    files = spark.createDataFrame([("a", bytearray(b"<T>x</T>")), ("b", bytearray(b"<T>"))], "path string, content binary")
    assert {r.path: (r.text, r.error is None) for r in plans_tei.convert_tei(files).collect()} == {"a": ("x", True), "b": (None, False)}
    ocr = scans.ocr_tables(spark.createDataFrame([("a", bytearray(b'<b><page><p><wd pos="0,0,1,1">w</wd></p></page></b>')), ("b", bytearray(b"<b"))], "path string, content binary"))
    assert [r.path for r in ocr["errors"].collect()] == ["b"] and ocr["words"].count() == 1


def test_passim(spark):
    docs = spark.createDataFrame([("a", "s", ["x", "y"], "180912")], "id string, series string, pages array<string>, d string")
    assert json.loads(scans.passim_json(docs, F.col("d")).first().value) == {"id": "a", "series": "s", "date": "1809-12-01", "text": '<pb n="1"/>x\n<pb n="2"/>y'}


def test_newspapers(spark):
    from quillstream.plans import newspapers

    frame = spark.createDataFrame
    got = newspapers.newspaper_levels(
        frame([("i", "a1", 0, "One. Two."), ("i", "a1", 1, "Three"), ("i", "a2", 0, "Four")], "issue_id string, article_id string, paragraph int, text string"),
        frame([("i", "a1", 0, ["p1", "p2"], 1, "en", ["87.5", "x", "80.0"]), ("i", "a2", 1, ["p2"], 0, "fi", [])], "issue_id string, article_id string, place int, page_ids array<string>, illustrations int, language string, confidences array<string>"),
        frame([("i", 18090101, 18090199)], "issue_id string, date_start int, date_end int"),
    )
    issue = got["issue"].first()
    assert (issue.text, issue.articles, issue.paragraphs, issue.sentences, issue.pages, issue.languages) == ("One. Two.\n\nThree\n\nFour", 2, 3, 4, 2, ["en", "fi"])
    assert [(a.start_offset, a.end_offset, a.ocr_confidence) for a in got["article"].orderBy("place").collect()] == [(0, 16, 837), (18, 22, 0)]
    assert newspapers.in_years(got["issue"], 1810, None).count() == 0 and newspapers.in_years(got["issue"], 1809, 1809).count() == 1
    assert sum(len(s.text) for s in got["sentence"].collect()) == 18


def test_feeds(spark):
    from quillstream.plans import newspapers

    record = '<item><subject qcode="sttdepartment:3"/><subject qcode="sttsubject:9"/><genre qcode="sttversion:2"/><contentCreated>2001-01-01</contentCreated><versionCreated></versionCreated><headline>H</headline></item>'
    facts, subjects = newspapers.feed_records(spark.createDataFrame([("1", record)], "id string, record string"))
    assert facts.select("department", "version", "time_published", "headline", "urgency").first() == ("3", "2", "2001-01-01", "H", None)
    assert subjects.collect() == [("1", "sttsubject:9")]
    library = "<d:r xmlns:d='x'><d:identifier>N:1</d:identifier><d:title>Paper</d:title><d:date>1900-02-03</d:date></d:r>"
    assert newspapers.library_articles(spark.createDataFrame([(library,)], "record string")).first() == ("N:1", "Paper", 19000203)


def test_offset_stores(spark):
    payload = spark.createDataFrame([("b", 0, 1, 2, 3, 4, 5), ("a", 7, 1, 2, 3, 4, 5)], "document_id string, offset int, page int, x int, y int, w int, h int")
    store = books.offset_store(payload)
    assert sorted((r.ordinal, r.offset, r.w) for r in books.by_ordinal(store, store).collect()) == [(0, 7, 4), (1, 0, 4)]
    puts = spark.createDataFrame([("a", 1, 1, 9, 9, 9, 9, 1), ("a", 1, 2, 1, 1, 1, 1, 3), ("a", 1, 3, 5, 5, 5, 5, 2)], "document_id string, offset int, page int, x int, y int, w int, h int, put int")
    assert books.offset_store(puts, "put").first().page == 2 and books.offset_store(puts).first().page == 3


def test_programs(spark, tmp_path):
    from quillstream.__main__ import main

    (tmp_path / "in/issue").mkdir(parents=True)
    (tmp_path / "in/issue/a_1.xml").write_bytes(ALTO)
    (tmp_path / "in/issue/mets.xml").write_bytes(METS)
    main(["alto", "--files", str(tmp_path / "in"), "--to", str(tmp_path / "alto"), "--order", "issue,page"], spark)
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    assert read("alto/words").first().words == 4
    assert read("alto/page_types").count() == 2 and read("alto/errors").count() == 0
    (tmp_path / "tei").mkdir()
    (tmp_path / "tei/x.xml").write_text("<T><P>a<HI>b</HI></P></T>")
    (tmp_path / "tei/bad.xml").write_text("<T>")
    main(["tei", "--files", str(tmp_path / "tei"), "--to", str(tmp_path / "out"), "--omit-emphases"], spark)
    assert [r.text for r in read("out/documents").collect()] == ["ab"] and read("out/errors").count() == 1
    (tmp_path / "t.json").write_text('{"id_str": "1", "text": "x"}\n{"id_str": "2", "text": "y", "in_reply_to_user_id_str": "3"}\n')
    main(["tweets", "--files", str(tmp_path / "t.json"), "--to", str(tmp_path / "tw"), "--skip", "reply"], spark)
    assert [r.id for r in read("tw/tweets").collect()] == ["1"]


def test_nested_blocks(spark):
    blocks = spark.createDataFrame([("i", 1, "A", "ComposedBlock", None, 0, ""), ("i", 1, "B", "ComposedBlock", "A", 0, ""), ("i", 1, "C", "ComposedBlock", "B", 0, ""), ("i", 1, "t", "TextBlock", "C", 5, "deep"), ("i", 1, "u", "TextBlock", "A", 9, "flat"), ("i", 1, "v", "TextBlock", None, 12, "lone")], "issue string, page int, block string, kind string, parent string, vpos int, text string")
    areas = spark.createDataFrame([("i", "x", "article", None, "d", 0, "A")], "issue string, unit string, type string, parent_unit string, dmd_id string, place int, block string")
    got = scans.logical_units(blocks, areas, spark.createDataFrame([("d", "T")], "dmd_id string, title string"))
    assert got["units"].first().text == "deep\n\nflat" and [r.block for r in got["unreferenced"].collect()] == ["v"]


def test_tei_marks_alone_meet_names_and_pages(spark, monkeypatch):
    """every piece of a document, text too, was joined with its scope's name and its page."""
    stored = {}
    keep = plans_tei.scratch.kept

    def kept(df, name, by=None):
        stored[name] = keep(df, name, by)
        return stored[name]

    monkeypatch.setattr(plans_tei.scratch, "kept", kept)
    files = [("a", b"<T><P>a<HI>b</HI>c<NOTE>n</NOTE></P><PB REF='2'/><P>d<GAP/></P></T>"), ("b", b"<T>"), ("c", b""), ("d", None), ("e", b"<T>x</T>")]
    found = {r.path: r for r in plans_tei.convert_tei(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert {r.kind for r in stored["met"].collect()} == {"gap", "extract", "end", "page"}
    assert found["a"].text == "a*b*c\n\nd〈?〉" and [tuple(p) for p in found["a"].pages] == [(5, "2")] and [(e.text, e.page_offset) for e in found["a"].extracts] == [("n", 6)]
    assert [(g.page, g.offset) for g in found["a"].gaps] == [("2", 8)]
    assert "ExpatError" in found["b"].error and "ExpatError" in found["c"].error and "TypeError" in found["d"].error and (found["e"].text, found["e"].error) == ("x", None)
