import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.functions import hashing
from lexloom.functions import text as tx
from lexloom.functions.hangul import LEADS, TAILS, VOWELS, loosen_echoes, normalize_repeats, to_jamo
from lexloom.operators import rows, sentences


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


def many(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", fn(F.col("x")).alias("y"))
    return [r.y for r in df.orderBy("i").collect()]


def test_strip_and_collapse(spark):
    assert one(spark, "\t a b \n", tx.strip_line) == "a b"
    assert one(spark, "\x1c　 x\x85", tx.strip_line) == "x"
    assert one(spark, "a  b\t c", tx.collapse_ws) == "a b c"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\x1c\x1f\x85  　\n\r\x0b", max_size=12), min_size=1, max_size=40))
def test_white_space_matches_python(spark, values):
    assert many(spark, values, tx.strip_line) == [v.replace("\n", "").strip() for v in values]
    assert many(spark, values, tx.collapse_ws) == [re.sub(r"\s+", " ", v) for v in values]


def test_repeats(spark):
    assert one(spark, "yesssss", normalize_repeats) == "yesss"
    assert one(spark, "a!!!!!  b", normalize_repeats) == "a!!!!! b"
    assert one(spark, "ㅋ쿠ㅜ", loosen_echoes) == "ㅋㅋㅜㅜ"
    assert one(spark, "갘ㅋㅋ", loosen_echoes) == "가ㅋㅋㅋ"
    assert one(spark, "가나 ㅋ", loosen_echoes) == "가나 ㅋ"


def test_digits(spark):
    assert one(spark, ["a1b23", "4", "x"], tx.split_digits, "array<string>") == ["a", "1", "b", "2", "3", "4", "x"]
    assert one(spark, ["١x"], tx.split_digits, "array<string>") == ["١", "x"]


def test_jamo(spark):
    assert one(spark, "값 가a", to_jamo) == "ㄱㅏㅄ ㄱㅏ-a"
    assert one(spark, "ㅋㅜ😀", to_jamo) == "ㅋ---ㅜ-😀"
    assert one(spark, "no  hangul", to_jamo) == "no hangul"


def test_jamo_covers_every_syllable(spark):
    every = "".join(chr(c) for c in range(0xAC00, 0xD7A4))
    assert one(spark, every, to_jamo) == "".join(a + b + c for a in LEADS for b in VOWELS for c in TAILS)


def test_labelled_lines(spark):
    raw = spark.createDataFrame([("good␞1",), ("",), ("a␞b␞c",), (" x y␞0 ",)], "line string")
    good, corrupt = rows.parse_labelled(raw)
    assert sorted((r.line, r.label) for r in good.collect()) == [("good", "1"), ("x y", "0")]
    assert sorted(r.line for r in corrupt.collect()) == ["", "a␞b␞c"]
    assert sorted(r.line for r in rows.format_labelled(good).collect()) == ["good␞1", "x y␞0"]


def test_blank_lines_stay_except_on_request(spark):
    df = spark.createDataFrame([(0, "a"), (1, ""), (2, "b")], "line_no int, line string")
    assert rows.drop_blank(df).count() == 2
    assert df.withColumn("line", tx.collapse_ws("line")).count() == 3


def test_tags(spark):
    df = spark.createDataFrame([([("집", "NNG"), ("", "SW")],)], "t array<struct<morph:string,tag:string>>")
    assert df.select(rows.format_pos("t", pos=True).alias("x")).first().x == ["집/NNG", "/SW"]
    plain = df.select(rows.format_pos("t").alias("x"), tx.split_digits(rows.format_pos("t")).alias("y")).first()
    assert plain.x == ["집", ""] and plain.y == ["집"]


def test_label_switch():
    assert rows.label_flag("TRUE") and not rows.label_flag("1") and not rows.label_flag("False")


def test_clean_text_and_markup(spark):
    assert one(spark, "A\x00b​　c中d", tx.clean_text) == "Ab c 中 d"
    html = "<script>x<b></script><p>a &amp;lt; b</p><!-- n -->[[t|u]] '''v''' == h =="
    assert one(spark, html, tx.strip_markup) == "a &lt; b u v h"
    assert one(spark, "Hi! you.\n\n ok", tx.sentences_of) == ["Hi!", "you.", "ok"]


def test_nested_markup(spark):
    page = "a {{Info|a={{b|{{c}}}}}} [[File:x|thumb|cap [[in|side]]]] [[one|two|three]] {| t\n|- \n| x {{y}} |} &#44032;&#xAC01;&#99999999; &amp;#65; z"
    assert one(spark, page, tx.strip_markup) == "a three 가각&#99999999; &#65; z"


def scanned(text):
    """The marks of a text resolved by a plain scan with a stack."""
    closes, stack, at = {"{{": "}}", "{|": "|}", "[[": "]]"}, [["", ""]], 0
    while at < len(text):
        two, end = text[at : at + 2], text.find("</nowiki>", at)
        if text.startswith("<nowiki>", at) and end > 0:
            stack[-1][1] += text[at + 8 : end]
            at = end + 9
        elif two in closes:
            stack.append([two, ""])
            at += 2
        elif two == closes.get(stack[-1][0]) and not (two == "|}" and text[at + 2 : at + 3] == "}"):
            mark, inside = stack.pop()
            hidden = re.match(f"({'|'.join(tx.HIDDEN_LINKS)}):", inside)
            stack[-1][1] += " " if mark != "[[" else "" if hidden else inside.split("|")[-1]
            at += 2
        elif two in ("}}", "]]") or two == "|}" and text[at + 2 : at + 3] != "}":
            stack[-1][1] += two  # closes nothing
            at += 2
        else:
            stack[-1][1] += text[at]
            at += 1
    return "".join(a + b for a, b in stack)


def test_marks_of_any_depth(spark):
    deep = "x" + "{{a|" * 20 + "b" + "}}" * 20 + "[[c|" * 40 + "d" + "]]" * 40 + "{|" * 30 + "e" + "|}" * 30
    assert one(spark, deep, tx.strip_wiki) == "x d "
    assert one(spark, "{{x|}} {{open [[a|b <nowiki>[[c]]</nowiki>", tx.strip_wiki) == "  {{open [[a|b [[c]]"
    assert one(spark, None, tx.strip_wiki) is None and one(spark, "plain } ] |", tx.strip_wiki) == "plain } ] |"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="{}[]|aF", max_size=24), min_size=1, max_size=60))
def test_marks_match_a_plain_scan(spark, values):
    values = [v.replace("F", "File:") for v in values] + ["<nowiki>" + v + "</nowiki>" + v for v in values[:10]]
    assert many(spark, values, tx.strip_wiki) == [scanned(v) for v in values]


def test_learned_boundaries(spark):
    text = [
        "Yesterday Dr. Kim met Mr. Lee. They spoke. J. Park came at noon.",
        "Dr. Han left. Nobody knew why. Mr. Oh stayed! Why? Dr. Kim knew.",
        "A cat sat. The cat sat there with Mr. Park and Dr. Kim. Dr. Lee\nsaw it there. End of it.",
    ]
    docs = spark.createDataFrame(list(enumerate(text * 20)), "doc_id int, text string")
    found = sentences.to_sentences(docs)
    rows_ = [r.sentence for r in found.filter("doc_id = 0").orderBy("sent_no").collect()]
    assert rows_ == ["Yesterday Dr. Kim met Mr. Lee.", "They spoke.", "J. Park came at noon."]
    rows_ = [r.sentence for r in found.filter("doc_id = 2").orderBy("sent_no").collect()]
    assert rows_ == ["A cat sat.", "The cat sat there with Mr. Park and Dr. Kim.", "Dr. Lee", "saw it there.", "End of it."]
    known = {r.word for r in sentences.abbreviations(sentences.period_counts(docs)).collect()}
    assert {"dr", "mr"} <= known and not known & {"sat", "lee", "kim", "spoke"}
    none = spark.createDataFrame([], "word string")
    plain = sentences.to_sentences(docs, none).filter("doc_id = 1").orderBy("sent_no").collect()
    assert [r.sentence for r in plain][:3] == ["Dr.", "Han left.", "Nobody knew why."]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "x.")], "doc_id int, text string")
    assert [(r.doc_id, r.sentence) for r in sentences.to_sentences(odd).collect()] == [(4, "x.")]


def test_many_hashes_of_a_row_equal_md5(spark):
    """Starts of any length, beyond one block and not ASCII too, and numbers of one to six digits."""
    starts = ["", "7|a", "값|é", "x" * 50, "y" * 53, "z" * 54, "w" * 80, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(starts)], "id int, s string").withColumn("start", hashing.joined(7, F.col("s")))
    for places in ([0, 9, 10, 99, 100, 12345], [3, 70000], []):
        at = F.array(*[F.lit(p) for p in places]).cast("array<int>")
        for part in (df, df.filter("length(start) < 40")):
            want = F.transform(at, lambda i: hashing.number(hashing.continued(F.col("start"), i)))
            assert all(r.a == r.b for r in part.select(hashing.hashes_at(F.col("start"), at).alias("a"), want.alias("b")).collect())
    units = F.array(*[hashing.unit_hash(7, F.col("s"), i) for i in range(12)])
    assert all(r.a == r.b for r in df.select(hashing.unit_hashes(F.col("start"), 12).alias("a"), units.alias("b")).collect())
