"""DuckDB SQL fragments for the oracle side of the query catalogue.

The oracle re-expresses each rule in DuckDB (RE2 regex, ``\\1`` replacements,
list lambdas) from the same rule tables, so an engine-level difference shows up
as a mismatch.  RE2 has no back-references: T4 is written as two rules.
"""

from __future__ import annotations

from quire.functions import extract as X
from quire.functions import text as TX


def q(s: str) -> str:
    """SQL string literal (DuckDB keeps backslashes literally)."""
    return "'" + s.replace("'", "''") + "'"


def repl(r: str) -> str:
    """Java ``$1`` replacement -> RE2 ``\\1``."""
    out = []
    i = 0
    while i < len(r):
        if r[i] == "$" and i + 1 < len(r) and r[i + 1].isdigit():
            out.append("\\" + r[i + 1])
            i += 2
        else:
            out.append(r[i])
            i += 1
    return "".join(out)


def rr(e: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(repl(replacement))}, 'g')"


def strip_ws(e: str) -> str:
    return rr(e, TX.STRIP, "")


def ocr_substitute(e: str) -> str:
    src = "".join(a for a, _ in TX.CHAR_SUBSTITUTIONS)
    dst = "".join(b for _, b in TX.CHAR_SUBSTITUTIONS)
    return f"translate({e}, {q(src)}, {q(dst)})"


def noise_strip(e: str) -> str:
    for p in TX.NOISE_PATTERNS:
        e = rr(e, p, " ")
    e = rr(e, r"\.{2,}", ".")
    e = rr(e, r",{2,}", ",")
    return rr(e, TX.KEEP_BASIC, "")


def _split_glued(tok: str) -> str:
    fixed = rr(tok, r"([a-z])([A-Z])", "$1 $2")
    for part in TX.GLUED_SMALL_WORDS:
        fixed = rr(fixed, f"(?i)([a-z])({part})([A-Z])", "$1 $2 $3")
    upper = f"(regexp_matches({tok}, '[A-Z]') AND NOT regexp_matches({tok}, '[a-z]'))"
    return f"CASE WHEN length({tok}) >= {TX.LONG_TOKEN_MIN} AND NOT {upper} THEN {fixed} ELSE {tok} END"


def fix_spacing(e: str) -> str:
    for p, r in TX.SPACING_RULES:
        e = rr(e, p, r)
    toks = f"string_split_regex({strip_ws(e)}, '\\s+')"
    return f"array_to_string(list_transform({toks}, lambda t: {_split_glued('t')}), ' ')"


def squash_ws(e: str) -> str:
    return strip_ws(rr(e, r"\s+", " "))


def clean_text(e: str) -> str:
    """T2..T9 (T1 is the identity on the test tables: nothing in them changes
    under NFKC)."""
    return squash_ws(fix_spacing(noise_strip(ocr_substitute(e))))


def _clean_line(x: str) -> str:
    x = strip_ws(x)
    x = rr(x, r"^[^\w\d]+|[^\w\d]+$", "")
    x = rr(x, r"(\d)\s+(\d)", "$1$2")
    x = rr(x, r"(\d)([a-zA-Z])", "$1 $2")
    return rr(x, r"([a-zA-Z])(\d)", "$1 $2")


def line_cleanup(e: str) -> str:
    lines = (f"CASE WHEN strpos({e}, chr(10)) > 0 THEN string_split({e}, chr(10)) "
             f"ELSE string_split({e}, '.') END")
    cleaned = f"list_transform({lines}, lambda l: {_clean_line('l')})"
    kept = f"list_filter({cleaned}, lambda k: length(regexp_replace(k, '[^a-zA-Z0-9]', '', 'g')) >= 3)"
    return strip_ws(rr(f"array_to_string({kept}, ' ')", r"\s{2,}", " "))


def classifier_normalize(e: str) -> str:
    return rr(rr(e, TX.unicode_classes(r"\s+"), " "), TX.unicode_classes(TX.KEEP_CLASSIFIER), "")


# --- extraction -------------------------------------------------------------

def rule_value(e: str, rule: str, ci: bool = True) -> str:
    pat = ("(?i)" if ci else "") + TX.unicode_classes(rule)
    return f"NULLIF({strip_ws(f'regexp_extract({e}, {q(pat)}, 1)')}, '')"


def hash_id_fallback(e: str) -> str:
    after = f"regexp_extract({e}, '^[^#]*#([^#]*)', 1)"
    found = f"NULLIF({strip_ws(f'regexp_extract({after}, {q(TX.unicode_classes(X.HASH_ID_RULE))}, 1)')}, '')"
    return (f"CASE WHEN strpos({e}, '#') > 0 AND regexp_matches({after}, '\\d') "
            f"THEN {found} END")


def org_fallback(e: str) -> str:
    return f"NULLIF({strip_ws(f'regexp_extract({e}, {q(X.ORG_RULE)}, 1)')}, '')"


def extract_field(e: str, field: str, use_org_fallback: bool = True) -> str:
    t = f"coalesce({e}, '')"
    steps = [rule_value(t, r) for r in X.FIELD_RULES.get(field, [])]
    if field == "invoice_number":
        steps.append(hash_id_fallback(t))
    if field in X.NAME_FIELDS and use_org_fallback:
        steps.append(org_fallback(t))
    return "coalesce(" + ", ".join(steps + ["''"]) + ")"


# --- derived inputs -----------------------------------------------------------

INVOICE_TEXT = """
SELECT o_orderkey, o_custkey,
       'INVOICE Invoice No: INV-' || CAST(o_orderkey + 100000 AS VARCHAR)
       || ' Invoice Date: ' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
       || ' Due Date: ' || strftime(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d')
       || chr(10) || 'Seller: Acme Ltd; Bill to: ' || c_name
       || '; Total: $' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS text
FROM orders JOIN customer ON o_custkey = c_custkey
"""

CORPUS = """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
       source || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS filename,
       text, lang, source, n_chars
FROM documents
"""
