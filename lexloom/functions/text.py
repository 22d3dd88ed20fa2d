r"""Line and token expressions, all inside whole-stage codegen.

Java's ``(?U)\s`` leaves out U+001C to U+001F, which count as white space for the jobs here, so
the class names them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_MARK = "␞"
SPACE = r"[\s\x1c-\x1f]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_line(col) -> Column:
    """Drop newlines, then white space at both ends."""
    bare = F.replace(_col(col), F.lit("\n"), F.lit(""))
    return F.regexp_replace(bare, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def collapse_ws(col) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(_col(col), rf"(?U){SPACE}+", " ")


def split_tokens(col) -> Column:
    """White-space tokens of a line; a blank line gives an empty array."""
    return F.filter(F.split(_col(col), rf"(?U){SPACE}+"), lambda t: t != "")


def split_digits(tokens) -> Column:
    """Every decimal digit becomes a token of its own; empty tokens go."""

    def parts(token: Column) -> Column:
        spaced = F.split(F.regexp_replace(token, r"(\p{Nd})", " $1 "), " ")
        return F.filter(spaced, lambda part: part != "")

    # Most lines hold no digit: one look at the whole line spares a pattern per token.
    line = _col(tokens)
    has_digit = F.array_join(line, " ").rlike(r"\p{Nd}")
    return F.when(has_digit, F.flatten(F.transform(line, parts))).otherwise(F.filter(line, lambda t: t != ""))


def limit_repeats(col, n: int = 3) -> Column:
    """A word character repeated more than ``n`` times in a row is kept ``n`` times."""
    return F.regexp_replace(_col(col), rf"(?U)(\w)\1{{{n},}}", "$1" * n)


# The code point blocks of Chinese characters that get spaces around them.
CJK_BLOCKS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)


def clean_text(col) -> Column:
    """Case-keeping clean-up: no control characters, plain spaces, CJK characters apart."""
    spaced = F.regexp_replace(_col(col), r"[\t\n\r\p{Zs}]", " ")
    visible = F.regexp_replace(spaced, r"[\p{Cc}\p{Cf}\x{FFFD}]", "")
    apart = F.regexp_replace(visible, f"([{CJK_BLOCKS}])", " $1 ")
    return F.trim(F.regexp_replace(apart, " +", " "))


def split_punctuation(col) -> Column:
    """Clean-up plus every punctuation mark as a word: the words the sub-word step sees."""
    marked = F.regexp_replace(clean_text(col), r"([\p{P}$+<=>^`|~])", " $1 ")
    return F.filter(F.split(marked, " +"), lambda w: w != "")


# The named character entities that are resolved, ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


# Link targets that show a file or sort a page, in English and Korean.
HIDDEN_LINKS = ("File", "Image", "Category", "파일", "그림", "분류")


def _numeric_entities(text: Column) -> Column:
    """``&#44032;`` and ``&#xAC00;`` as characters; numbers that are none stay as they are."""
    pattern = "&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

    def character(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "([0-9a-fA-F]+);", 1)
        is_hex = F.lower(F.substring(entity, 3, 1)) == "x"
        code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        sound = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        wide = F.unhex(F.lpad(F.hex(code), 8, "0"))
        return F.when(sound, F.decode(wide, "UTF-32")).otherwise(entity)

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), character)
    parts = F.zip_with(F.split(text, pattern, -1), found, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))))
    return F.when(F.contains(text, F.lit("&#")), F.array_join(parts, "")).otherwise(text)


# What opens, closes or quotes wiki markup. ``|}}`` ends a template whose last part is empty.
WIKI_MARKS = r"(?s)<nowiki>.*?</nowiki>|\{\{|\}\}|\{\||\|\}(?!\})|\[\[|\]\]"
_CLOSES = (("{{", "}}"), ("{|", "|}"), ("[[", "]]"))
_FRAME = "struct<mark: string, text: string>"


def _resolved(mark: Column, inside: Column) -> Column:
    """What a closed template, table or link leaves."""
    hidden = F.rlike(inside, F.lit(rf"^(?:{'|'.join(HIDDEN_LINKS)}):"))
    shown = F.when(hidden, "").otherwise(F.substring_index(inside, "|", -1))
    return F.when(mark == "[[", shown).otherwise(" ")


def strip_wiki(col) -> Column:
    """Wiki templates, tables and links resolved in one pass from left to right, at any depth.

    Open marks lie on a stack, each with the text since it. A mark that closes the topmost one puts
    what that leaves behind into the text below: nothing of templates and tables, the last part of a
    link, nothing of links to files and categories. Marks that close nothing and marks never closed
    stay as they are, as does what ``<nowiki>`` quotes. Texts without marks are not looked at twice.
    """
    text = _col(col)
    marks = F.regexp_extract_all(text, F.lit(WIKI_MARKS), F.lit(0))
    gaps = F.split(text, WIKI_MARKS, -1)
    steps = F.zip_with(marks, F.slice(gaps, F.lit(2), F.size(marks)), lambda m, g: F.struct(m.alias("mark"), g.alias("text")))
    start = F.array(F.struct(F.lit("").alias("mark"), F.get(gaps, F.lit(0)).alias("text")).cast(_FRAME))

    def below(stack: Column) -> Column:
        return F.slice(stack, F.lit(1), F.size(stack) - 1)

    def on_top(stack: Column, more: Column) -> Column:
        top = F.element_at(stack, -1)
        return F.concat(below(stack), F.array(F.struct(top["mark"].alias("mark"), F.concat(top["text"], more).alias("text"))))

    def step(stack: Column, s: Column) -> Column:
        top, mark = F.element_at(stack, -1), s["mark"]
        quoted = F.regexp_replace(mark, "^<nowiki>|</nowiki>$", "")
        opens = mark.isin(*[o for o, _ in _CLOSES])
        closes = F.lit(False)
        for o, c in _CLOSES:
            closes = closes | ((mark == c) & (top["mark"] == o))
        return (
            F.when(opens, F.concat(stack, F.array(s)))
            .when(closes, on_top(below(stack), F.concat(_resolved(top["mark"], top["text"]), s["text"])))
            .otherwise(on_top(stack, F.concat(quoted, s["text"])))
        )

    def rest(stack: Column) -> Column:
        return F.array_join(F.transform(stack, lambda f: F.concat(f["mark"], f["text"])), "")

    some = F.contains(text, F.lit("{{")) | F.contains(text, F.lit("{|")) | F.contains(text, F.lit("[[")) | F.contains(text, F.lit("<nowiki>"))
    return F.when(some, F.aggregate(steps, start, step, rest)).otherwise(text)


def strip_markup(col) -> Column:
    """Markup to plain text: hidden blocks first, then wiki marks, tags, entities and spacing."""
    text = F.regexp_replace(_col(col), r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    text = strip_wiki(text)
    text = F.regexp_replace(text, r"'{2,}|={2,}", "")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    text = _numeric_entities(text)
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return F.trim(collapse_ws(text))


# Between candidates for sentences, and before one that begins a line.
_CUT, _LINE = "\x02", "\x03"


def sentence_candidates(col) -> Column:
    """Pieces of a text that end at newlines and after ``.``, ``!`` or ``?`` plus space; one that begins a
    line starts with U+0003. U+0002 and U+0003 of the text go."""
    bare = F.translate(_col(col), _CUT + _LINE, "")
    marked = F.replace(bare, F.lit("\n"), F.lit(_CUT + _LINE))
    return F.split(F.regexp_replace(marked, rf"(?U)([.!?]){SPACE}+", f"$1{_CUT}"), _CUT)


def last_word(candidate: Column) -> Column:
    """The word that ends a candidate with a period, without it; NULL if another sign ends it."""
    return F.nullif(F.regexp_extract(candidate, rf"(?U)(?:^|[\s\x03(\"'])([^\s\x03(\"']+)\.$", 1), F.lit(""))


def joined_sentences(candidates: Column, goes_on: Column) -> Column:
    """Stripped, non-blank sentences from candidates; ``goes_on`` tells for each whether the next one on its
    line belongs to it."""
    previous = F.concat(F.array(F.lit(False)), goes_on)
    parts = F.zip_with(
        candidates,
        F.slice(previous, F.lit(1), F.size(candidates)),
        lambda c, on: F.when(on & ~F.startswith(c, F.lit(_LINE)), F.concat(F.lit(" "), c)).otherwise(F.concat(F.lit(_CUT), c)),
    )
    pieces = F.split(F.replace(F.array_join(parts, ""), F.lit(_LINE), F.lit("")), _CUT)
    return F.filter(F.transform(pieces, strip_line), lambda s: s != "")


def sentences_of(col) -> Column:
    """Stripped, non-blank sentences: cut at newlines and after ``.``, ``!`` or ``?`` plus space."""
    broken = F.regexp_replace(_col(col), rf"(?U)([.!?]){SPACE}+", "$1\n")
    return F.filter(F.transform(F.split(broken, "\n"), strip_line), lambda s: s != "")


def labelled_fields(col) -> Column:
    """Fields of a stripped ``text␞label`` line; a sound line has exactly two."""
    return F.split(strip_line(col), LABEL_MARK, -1)
