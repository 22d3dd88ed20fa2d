"""Hangul syllables and letters as native expressions.

A syllable's code is 0xAC00 + (lead * 21 + vowel) * 28 + tail, so its letters come from integer
arithmetic and three literal alphabets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, collapse_ws, limit_repeats, strip_line

# Lead, vowel and tail letters in Unicode order; no tail is written "-".
LEADS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
VOWELS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
TAILS = "-ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"

HANGUL = "[가-힣ㄱ-ㅣ]"
_BASE = 0xAC00
_LEAD_SPAN, _TAIL_SPAN = 588, 28


def _pick(alphabet: str, index: Column) -> Column:
    return F.substr(F.lit(alphabet), index.cast("int") + 1, F.lit(1))


def _lead(offset: Column) -> Column:
    return _pick(LEADS, F.floor(offset / _LEAD_SPAN))


def _vowel(offset: Column) -> Column:
    return _pick(VOWELS, F.floor(F.pmod(offset, F.lit(_LEAD_SPAN)) / _TAIL_SPAN))


def _tail(offset: Column) -> Column:
    return _pick(TAILS, F.pmod(offset, F.lit(_TAIL_SPAN)))


def _is_syllable(char: Column) -> Column:
    return char.between("가", "힣")


def _decomposed() -> str:
    """The letters of all syllables in code order, one per space-separated entry."""
    return " ".join(a + b + c for a in LEADS for b in VOWELS for c in TAILS)


def _letters(char: Column) -> Column:
    by_code = F.split(F.lit(_decomposed()), " ")  # folded into one constant array
    return (
        F.when(_is_syllable(char), F.get(by_code, F.ascii(char) - _BASE))
        .when(char.between("ㄱ", "ㅎ"), F.concat(char, F.lit("--")))
        .when(char.between("ㅏ", "ㅣ"), F.concat(F.lit("-"), char, F.lit("-")))
        .otherwise(char)
    )


def to_jamo(col) -> Column:
    """Every syllable becomes lead, vowel and tail; white-space runs collapse; the rest passes."""
    line = _col(col)
    letters = F.array_join(F.transform(F.split(line, ""), _letters), "")
    return collapse_ws(F.when(line.rlike(HANGUL), letters).otherwise(line))


def _open_syllable(offset: Column) -> Column:
    code = F.pmod(offset, F.lit(_TAIL_SPAN))
    point = F.lpad(F.hex((offset - code + _BASE).cast("bigint")), 4, "0")
    return F.decode(F.unhex(point), "UTF-16BE")


def loosen_echoes(col) -> Column:
    """Take apart syllables that only echo a neighbouring bare letter (laughing, crying marks).

    Our rule: an open syllable whose lead repeats the letter before it becomes lead and vowel; a
    closed syllable whose tail repeats the letter after it becomes the open syllable and the tail.
    """
    line = _col(col)
    chars = F.split(line, "")

    none = F.array(F.lit(""))
    before_all = F.concat(none, F.slice(chars, F.lit(1), F.size(chars) - 1))
    after_all = F.concat(F.slice(chars, F.lit(2), F.size(chars)), none)

    def one(x: Column) -> Column:
        char, before, after = x["c"], x["b"], x["a"]
        offset = F.ascii(char) - _BASE
        lead, tail = _lead(offset), _tail(offset)
        return (
            F.when(~_is_syllable(char), char)
            .when((tail == "-") & (lead == before), F.concat(lead, _vowel(offset)))
            .when((tail != "-") & (tail == after), F.concat(_open_syllable(offset), tail))
            .otherwise(char)
        )

    around = F.arrays_zip(chars.alias("c"), before_all.alias("b"), after_all.alias("a"))
    loose = F.array_join(F.transform(around, one), "")
    return F.when(line.rlike("[가-힣]") & line.rlike("[ㄱ-ㅎ]"), loose).otherwise(line)


def normalize_repeats(col, n: int = 3) -> Column:
    """Emoticon clean-up: echoes taken apart, long runs cut to ``n``, spacing collapsed."""
    return strip_line(collapse_ws(limit_repeats(loosen_echoes(col), n)))
