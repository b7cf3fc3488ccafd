"""Text-cleaning Column functions (string column -> string column).

Every rule runs JVM-side as ``translate`` / ``regexp_replace`` / higher-order
array functions, so the cleaning chain stays inside Spark's expression engine.
The one exception is Unicode compatibility normalisation, which Spark has no
built-in for; it is an Arrow UDF that only receives the rows holding a non-ASCII
character (all other rows send a null) and gives a batch back in small pieces.

Regex dialect: Java regex with ASCII ``\\w \\s \\d`` (Python's are Unicode).  The
chain removes every non-ASCII character before any ``\\w`` rule runs, so the two
dialects agree on the cleaned text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These rule lists must equal the reference's cleaning rules.
# ---------------------------------------------------------------------------

# One-character OCR confusions, source -> target.
CHAR_SUBSTITUTIONS = [
    ("0", "o"), ("1", "l"), ("5", "s"), ("6", "b"), ("8", "B"), ("|", "l"),
    ("¢", "c"), ("@", "a"), ("!", "i"), ("\\", "/"),
    ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"),
]

# Noise patterns, each match replaced by one space, applied in order.
NOISE_PATTERNS = [
    "[–—]",
    "[_~]",
    r"\n+",
    r"\s{2,}",
    r"[^\x00-\x7F]+",
]

# Spacing rules (pattern, replacement), applied in order.
SPACING_RULES = [
    (r"([a-z])([A-Z][a-z])", "$1 $2"),
    (r"([a-zA-Z])(\d)", "$1 $2"),
    (r"(\d)([a-zA-Z])", "$1 $2"),
    (r"\.(\w)", ". $1"),
    (r"([a-z])([A-Z])", "$1 $2"),
    (r"([,;:])([a-zA-Z0-9])", "$1 $2"),
    (r"to([A-Z])", "to $1"),
    (r"and([A-Z])", "and $1"),
    (r"of([a-zA-Z])", "of $1"),
    (r"in([A-Z])", "in $1"),
    (r"([a-z])the([A-Z])", "$1 the $2"),
    (r"([a-z])at([a-zA-Z])", "$1 at $2"),
]

# Small words split out of the middle of long glued tokens, in order.
GLUED_SMALL_WORDS = ["and", "the", "with", "for", "from", "to", "of", "in", "at", "by", "on"]
LONG_TOKEN_MIN = 13  # tokens longer than 12 characters

# Characters kept besides word characters and whitespace.
KEEP_BASIC = r"[^\w\s\.,\-\:/]"
KEEP_CLASSIFIER = r"[^\w\s\.,\-\:/\?\(\)]"

# ---------------------------------------------------------------------------


def _ascii_of(rule: str) -> str:
    """The ASCII characters that a one-character rule matches, one by one:
    Java looks such a class up in a table, ten times as fast as the rule."""
    return "".join(f"\\x{c:02x}" for c in range(128) if re.match(rule, chr(c), re.ASCII))


# T5 for ASCII text, which T3 leaves.
DROP_ASCII = f"[{_ascii_of(KEEP_BASIC)}]"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Unicode words and spaces, as the insides of a character class that Java and RE2 both read.
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"


def unicode_classes(pattern: str) -> str:
    """``pattern`` with ``\\w`` and ``\\s`` meaning Unicode word characters and
    spaces, as in the rules' own language, in any engine."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two in (r"\w", r"\s"):
            body = WORD_CLASS if two == r"\w" else SPACE_CLASS
            out.append(body if inside else f"[{body}]")
            i += 2
        elif two.startswith("\\"):
            out.append(two)
            i += 2
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
            i += 1
    return "".join(out)


STRIP = unicode_classes(r"^\s+|\s+$")


def strip_ws(c) -> Column:
    """Whitespace of any script off both ends (Spark ``trim`` only removes spaces)."""
    return F.regexp_replace(col_of(c), STRIP, "")


#: Characters of text that are Python strings at a time: a batch, of up to 10,000 rows or 64 MiB
#: by Spark's default, stays in Arrow's form but for a piece of this size (or one longer text).
PIECE_CHARS = 1 << 20


@F.arrow_udf(T.StringType())
def _nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        piece, chars = [], 0
        for text in texts:
            text = text.as_py()
            if text is not None:
                text = unicodedata.normalize("NFKC", text)
                chars += len(text)
            piece.append(text)
            if chars >= PIECE_CHARS:
                yield pa.array(piece, texts.type)
                piece, chars = [], 0
        if piece:
            yield pa.array(piece, texts.type)


def nfkc(c) -> Column:
    """NFKC.  ASCII rows never leave the JVM: the UDF sees null for them."""
    c = col_of(c)
    has_non_ascii = c.rlike(r"[^\x00-\x7F]")
    return F.when(has_non_ascii, _nfkc(F.when(has_non_ascii, c))).otherwise(c)


def ocr_substitute(c) -> Column:
    """No target is itself a source, so one ``translate`` equals the loop."""
    src = "".join(a for a, _ in CHAR_SUBSTITUTIONS)
    dst = "".join(b for _, b in CHAR_SUBSTITUTIONS)
    return F.translate(col_of(c), src, dst)


def noise_strip(c) -> Column:
    """T3 + T4 + T5."""
    out = col_of(c)
    for pattern in NOISE_PATTERNS:
        out = F.regexp_replace(out, pattern, " ")
    out = F.regexp_replace(out, r"([\.,])\1+", "$1")
    return F.regexp_replace(out, DROP_ASCII, "")  # T5


def _split_glued(tok: Column) -> Column:
    fixed = F.regexp_replace(tok, r"([a-z])([A-Z])", "$1 $2")
    for part in GLUED_SMALL_WORDS:
        fixed = F.regexp_replace(fixed, f"(?i)([a-z])({part})([A-Z])", "$1 $2 $3")
    all_upper = tok.rlike("[A-Z]") & ~tok.rlike("[a-z]")
    return F.when((F.length(tok) >= LONG_TOKEN_MIN) & ~all_upper, fixed).otherwise(tok)


def _token_pass(stripped: Column) -> Column:
    """T8 per token of a stripped text; tokens are joined with one space, as the reference does."""
    return F.array_join(F.transform(F.split(stripped, r"\s+"), _split_glued), " ")


#: White space that T5 leaves, for plain trimming where it has run.
ASCII_SPACE = " \t\n\x0b\f\r"


def fix_spacing(c) -> Column:
    """T7 + T8: ordered spacing rules, then per-token split of long glued words."""
    out = col_of(c)
    for pattern, repl in SPACING_RULES:
        out = F.regexp_replace(out, pattern, repl)
    return _token_pass(strip_ws(out))


# T7 in three passes.  Five rules put a space between two neighbouring characters (letter and digit, digit and letter,
# full stop and word character, lower and upper case, other stops and what follows); no two of them share a place, and none
# makes or takes one of another, so one pass does all.  The first rule's places are the fifth's.  After the fifth no capital follows a
# small letter, so of the rules for single words only those that take small letters can still match: "of" and "at".
SPACING_AT_ONCE = r"[a-z](?=[A-Z0-9])|[A-Z](?=\d)|\d(?=[a-zA-Z])|\.(?=\w)|[,;:](?=[a-zA-Z0-9])"
SPACING_LATER = [SPACING_RULES[8], SPACING_RULES[11]]
# T3 where all white space is squashed in the end: its runs need no pass of their own.
NOISE_AT_ONCE = r"[_~]|[^\x00-\x7F]+"


def _stripped_and_spaced(c: Column) -> Column:
    """T3, T4, T5, T7, T8 and T9 in one chain."""
    out = F.regexp_replace(c, NOISE_AT_ONCE, " ")
    out = F.regexp_replace(out, r"([\.,])\1+", "$1")
    out = F.regexp_replace(out, DROP_ASCII, "")
    out = F.regexp_replace(out, SPACING_AT_ONCE, "$0 ")
    for pattern, repl in SPACING_LATER:
        out = F.regexp_replace(out, pattern, repl)
    # the token pass leaves single spaces, so T9 has nothing to squash but the ends
    return F.trim(_token_pass(F.trim(out, F.lit(ASCII_SPACE))))


def squash_ws(c) -> Column:
    """Collapse whitespace runs to one space and strip."""
    return strip_ws(F.regexp_replace(col_of(c), r"\s+", " "))


def clean_text(c, normalize: bool = True) -> Column:
    """The full basic cleaning chain T1..T9 (T6 is a no-op once T3 removed
    every non-ASCII character).  Null stays null."""
    out = col_of(c)
    if normalize:
        out = nfkc(out)
    return _stripped_and_spaced(ocr_substitute(out))


# --- advanced cleanup (T11..T14) -------------------------------------------

def _clean_line(line: Column) -> Column:
    line = strip_ws(line)
    line = F.regexp_replace(line, r"^[^\w\d]+|[^\w\d]+$", "")
    line = F.regexp_replace(line, r"(\d)\s+(\d)", "$1$2")
    line = F.regexp_replace(line, r"(\d)([a-zA-Z])", "$1 $2")
    return F.regexp_replace(line, r"([a-zA-Z])(\d)", "$1 $2")


def alnum_ascii_len(c) -> Column:
    return F.length(F.regexp_replace(col_of(c), "[^a-zA-Z0-9]", ""))


def line_cleanup(cleaned, newline_free: bool = False) -> Column:
    """T11 without the spelling pass: split the cleaned text into lines (on
    newlines when there are any, else on ``.``), clean each line, drop lines
    with fewer than 3 ASCII alphanumerics, join by one space.

    ``newline_free=True`` states that the input holds no newline (true of
    ``clean_text`` output, Q11), so only the ``.`` split is planned and the
    input expression is referenced once."""
    cleaned = col_of(cleaned)
    if newline_free:
        lines = F.split(cleaned, r"\.")
    else:
        has_nl = F.instr(cleaned, "\n") > 0
        lines = F.when(has_nl, F.split(cleaned, "\n")).otherwise(F.split(cleaned, r"\."))
    kept = F.filter(F.transform(lines, _clean_line), lambda x: alnum_ascii_len(x) >= 3)
    return strip_ws(F.regexp_replace(F.array_join(kept, " "), r"\s{2,}", " "))


def advanced_cleanup(c, normalize: bool = True) -> Column:
    """T11 (T10 then T12..T14).  The dictionary pass (J8) is a join, see
    ``quire.operators.spell``."""
    return line_cleanup(clean_text(c, normalize=normalize), newline_free=True)


# --- small scalars -----------------------------------------------------------

def accent_fold(c) -> Column:
    """T6 exposed on its own: strip diacritics from accented Latin letters.

    A ``translate`` table over the precomposed Latin-1 / Latin Extended-A
    letters (built from Unicode decomposition, not typed by hand)."""
    src, dst = _accent_table()
    return F.translate(col_of(c), src, dst)


def _accent_table():
    import unicodedata
    src, dst = [], []
    for cp in list(range(0xC0, 0x250)):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def classifier_normalize(c) -> Column:
    """Collapse whitespace, keep word characters of any script, whitespace
    and basic punctuation (adds ``? ( )`` to the T5 set)."""
    out = F.regexp_replace(col_of(c), unicode_classes(r"\s+"), " ")
    return F.regexp_replace(out, unicode_classes(KEEP_CLASSIFIER), "")


def char_length(c) -> Column:
    """Length with null counted as empty."""
    return F.length(F.coalesce(col_of(c), F.lit("")))


def alnum_count(c) -> Column:
    """Unicode letters and digits."""
    return F.length(F.regexp_replace(col_of(c), r"[^\p{L}\p{N}]", ""))
