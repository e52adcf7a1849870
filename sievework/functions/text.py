"""Text expressions.

Everything here is a JVM-side ``Column`` except Unicode NFKC, which Spark does
not offer and which only rows with non-ASCII characters pay for.

Character classes follow Python's Unicode rules: a word character is a letter,
a number or an underscore (combining vowel signs are not), and white space is
the set of ``str.isspace``.
"""

from __future__ import annotations

import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

WORD = r"[\p{L}\p{N}_]"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BENGALI = r"\x{0980}-\x{09ff}"

# Bengali digits 0 to 9.
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
ASCII_DIGITS = "0123456789"

# Every decimal digit of every script and its ASCII value, from the Unicode data.
_DECIMALS = [chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
_DECIMAL_VALUES = "".join(str(unicodedata.decimal(c)) for c in _DECIMALS)

# Labels and marks of the record formats.
QUESTION_LABEL = "প্রশ্ন"
ANSWER_LABEL = "উত্তর"
FINAL_ANSWER_LABEL = "চূ(?:\u09dc|\u09a1\u09bc)ান্ত উত্তর"  # the letter in one code point or in two
COLON = "[:：]"
GARBLE = "[£€¥©®]"
DANDA = "[।॥]+"
DEVANAGARI = r"[\x{0900}-\x{0939}\x{093E}-\x{094D}\x{0950}-\x{0954}\x{0960}-\x{0963}]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
CONTEXT_MARK = "CONTEXT"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(s: Column | str) -> Column:
    """Trim Unicode white space at both ends (``trim`` alone takes only blanks)."""
    return F.btrim(col(s), F.lit(SPACES))


def strict_json(text: Column | str) -> Column:
    """A text that is one JSON value and nothing else as a variant, else null.

    The parser stops after the first value; that a line holds no more shows when
    it is also the one element of a list and the one member of an object. ``NaN``
    and infinities are refused.
    """
    text = F.col(text) if isinstance(text, str) else text
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when((F.size(listed) == 1) & member.isNotNull(), F.try_parse_json(text))


def blank(s: Column | str) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip(s), F.lit("")) == ""


def first_line(s: Column | str) -> Column:
    return F.substring_index(col(s), "\n", 1)


def remove(s: Column | str, pattern: str) -> Column:
    return F.regexp_replace(col(s), F.lit(pattern), F.lit(""))


# ---- digits -----------------------------------------------------------------

def normalize_digits(s: Column | str) -> Column:
    """Bengali digits to ASCII."""
    return F.translate(col(s), BENGALI_DIGITS, ASCII_DIGITS)


def to_bengali(s: Column | str) -> Column:
    return F.translate(col(s), ASCII_DIGITS, BENGALI_DIGITS)


def numerals(s: Column | str, mode: str = "bengali") -> Column:
    """One numeral convention for a text: ``bengali``, ``ascii`` or ``keep``."""
    if mode not in ("bengali", "ascii", "keep"):
        raise ValueError(f"unknown numeral mode: {mode}")
    return {"bengali": to_bengali, "ascii": normalize_digits, "keep": col}[mode](s)


def any_digits_to_ascii(s: Column | str) -> Column:
    """Decimal digits of any script to ASCII, as a numeric parse needs them."""
    return F.translate(col(s), "".join(_DECIMALS), _DECIMAL_VALUES)


# ---- tokens -----------------------------------------------------------------

def _find_all(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(0))


def tokens(s: Column | str, kind: str = "bn") -> Column:
    """Token array.

    ``bn``     runs of the Bengali block or of ``a-z0-9``, digits folded
    ``word``   runs of word characters
    ``ascii``  runs of ``a-z0-9`` (what ROUGE's own tokenizer keeps)
    ``term``   word characters and the Bengali block (TF-IDF, Bengali form)
    ``term2``  word characters, two at least (TF-IDF, English form)
    ``space``  split on white space, case kept
    """
    low = F.lower(col(s))
    if kind == "bn":
        return _find_all(normalize_digits(low), rf"[{BENGALI}]+|[a-z0-9]+")
    if kind == "space":
        return _find_all(col(s), r"(?U)[^\s\x1c-\x1f]+")
    patterns = {
        "word": rf"{WORD}+",
        "ascii": r"[a-z0-9]+",
        "term": rf"[{BENGALI}\p{{L}}\p{{N}}_]+",
        "term2": rf"{WORD}{{2,}}",
    }
    return _find_all(low, patterns[kind])


# ---- normal forms -----------------------------------------------------------

#: Texts that are Python strings at a time.
NFKC_ROWS = 256


@F.arrow_udf(StringType())
def _nfkc(s: pa.Array) -> pa.Array:
    parts = (s.slice(at, NFKC_ROWS).to_pylist() for at in range(0, len(s), NFKC_ROWS))
    normal = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in part], pa.string()) for part in parts]
    return pa.concat_arrays(normal) if normal else pa.array([], pa.string())


def nfkc(s: Column | str) -> Column:
    s = col(s)
    return F.coalesce(_nfkc(F.when(s.rlike(r"[^\x00-\x7f]"), s)), s)


def hash_normalize(s: Column | str, form: str = "bn") -> Column:
    """Text reduced to what counts for equality.

    ``word`` lower-cases, drops what is neither word character nor space and
    collapses spaces; ``bn`` also folds digits and keeps the Bengali block;
    ``nfkc`` applies NFKC first.
    """
    s = nfkc(s) if form == "nfkc" else col(s)
    digits = ("", "") if form == "word" else (BENGALI_DIGITS, ASCII_DIGITS)
    # One pass turns every kind of white space into the blank, so that the two
    # patterns after it stay small.
    plain = F.translate(F.lower(s), SPACES + digits[0], " " * len(SPACES) + digits[1])
    kept = remove(plain, rf"[^ \p{{L}}\p{{N}}_{'' if form == 'word' else BENGALI}]+")
    return F.btrim(F.regexp_replace(kept, F.lit(" {2,}"), F.lit(" ")))


def content_hash(s: Column | str) -> Column:
    """First 16 hex digits of SHA-256 over the NFKC normal form."""
    return F.substring(F.sha2(hash_normalize(s, "nfkc"), 256), 1, 16)


# ---- question templates -----------------------------------------------------

def template(s: Column | str) -> Column:
    """Question line with every number replaced by ``#``."""
    return strip(F.regexp_replace(normalize_digits(first_line(s)), F.lit(r"\p{Nd}+"), F.lit("#")))


def split_question(s: Column | str) -> Column:
    return strip(remove(first_line(s), rf"^{SPACE}*{QUESTION_LABEL}{SPACE}*{COLON}{SPACE}*"))


def split_answer(s: Column | str) -> Column:
    s = col(s)
    pattern = rf"(?s){ANSWER_LABEL}{SPACE}*{COLON}(.*)"
    return strip(F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 1)).otherwise(s))


# ---- corruption checks ------------------------------------------------------

def strip_layout(s: Column | str) -> Column:
    """Code-fence lines and lines of rules (``_ - = |``) become one blank."""
    fences = F.regexp_replace(col(s), F.lit(rf"(?md)^{SPACE}*```.*$"), F.lit(" "))
    return F.regexp_replace(fences, F.lit(rf"(?md)^[{SPACE[1:-1]}_\-=|]+$"), F.lit(" "))


def has_garbage(s: Column | str) -> Column:
    return col(s).rlike(GARBLE) & strip_layout(s).rlike(GARBLE)


def has_mixed_script(s: Column | str) -> Column:
    """A Bengali character next to a Devanagari one, dandas aside."""
    pattern = rf"[{BENGALI}]{DEVANAGARI}|{DEVANAGARI}[{BENGALI}]"
    return col(s).rlike(DEVANAGARI) & remove(strip_layout(s), DANDA).rlike(pattern)


def has_control(s: Column | str) -> Column:
    return col(s).rlike(CONTROL)


def has_corrupt_math(s: Column | str) -> Column:
    return col(s).rlike(rf"\${SPACE}*[\t\r\f\x0B]+")


def has_odd_dollars(s: Column | str) -> Column:
    s = col(s)
    return (F.length(s) - F.length(F.replace(s, F.lit("$"), F.lit("")))) % 2 != 0


def text_issues(s: Column | str) -> Column:
    """Objective faults of an answer text, ``"; "``-joined in fixed order."""
    faults = F.array(
        F.when(has_control(s), "illegal control character"),
        F.when(has_corrupt_math(s), "corrupted math expression after dollar sign"),
        F.when(has_odd_dollars(s), "unbalanced dollar math delimiter"),
    )
    return F.when(col(s).isNull(), "answer is not a string").otherwise(F.array_join(faults, "; "))


def drop_control(s: Column | str) -> Column:
    return remove(s, CONTROL)


def is_degenerate(s: Column | str) -> Column:
    """The same word four or more times in a row, or nothing at all."""
    repeated = rf"(?iu)(?<!{WORD})({WORD}+)(?!{WORD})( \1){{3,}}"
    return blank(s) | F.coalesce(col(s).rlike(repeated), F.lit(False))


# ---- answers ----------------------------------------------------------------

def last_number(s: Column | str) -> Column:
    """Last number of a text as a double; thousands commas are ignored."""
    plain = any_digits_to_ascii(F.replace(col(s), F.lit(","), F.lit("")))
    found = _find_all(plain, r"-?[0-9]+(?:\.[0-9]+)?")
    return F.try_element_at(found, F.lit(-1)).cast("double")


def final_answer(s: Column | str) -> Column:
    """First line after the final-answer label, else of the whole text."""
    s = col(s)
    pattern = rf"(?s){FINAL_ANSWER_LABEL}{COLON}?{SPACE}*(.+)"
    return first_line(strip(F.coalesce(F.nullif(F.regexp_extract(s, pattern, 1), F.lit("")), s)))


def answer_key(s: Column | str) -> Column:
    """First number as written (digits folded), else the lower-cased text."""
    folded = normalize_digits(s)
    number = F.nullif(F.regexp_extract(folded, r"-?\p{Nd}+\.?\p{Nd}*", 0), F.lit(""))
    return F.coalesce(number, F.lower(strip(folded)))


def choice_letter(s: Column | str) -> Column:
    """First standalone letter A to D."""
    return F.nullif(F.regexp_extract(col(s), rf"(?<!{WORD})([A-D])(?!{WORD})", 1), F.lit(""))


# ---- shaping ----------------------------------------------------------------

def truncate(s: Column | str, n: int, suffix: str = " …[truncated]") -> Column:
    t = strip(F.coalesce(col(s), F.lit("")))
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.substring(t, 1, n), F.lit(suffix)))


def preview(s: Column | str, n: int = 200) -> Column:
    return F.replace(F.substring(col(s), 1, n), F.lit("\n"), F.lit(" | "))


def token_estimate(s: Column | str, chars_per_token: float = 4) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(col(s)) / F.lit(chars_per_token)).cast("int"))


def context_block(s: Column | str) -> Column:
    """Text after the context marker line, else after the last marker, else all."""
    s = col(s)
    line = f"\n{CONTEXT_MARK}\n"
    after_line = F.substring(s, F.instr(s, line) + F.lit(len(line)), F.length(s))
    return (
        F.when(F.contains(s, F.lit(line)), after_line)
        .when(F.contains(s, F.lit(CONTEXT_MARK)), F.substring_index(s, CONTEXT_MARK, -1))
        .otherwise(s)
    )


def render_chat(messages: Column | str, turn: str = "<|{role}|>\n{content}<|end|>\n") -> Column:
    """One training string from a message array; ``turn`` is the chat template."""
    before, middle, after = turn.replace("{role}", "\0").replace("{content}", "\0").split("\0")
    if turn.index("{role}") > turn.index("{content}"):
        raise ValueError("the template must name the role before the content")

    def one(m: Column) -> Column:
        return F.concat(
            F.lit(before), F.coalesce(m["role"], F.lit("")), F.lit(middle),
            F.coalesce(m["content"], F.lit("")), F.lit(after),
        )

    return F.array_join(F.transform(col(messages), one), "")
