"""Invoice field extraction as priority-ordered regex cascades.

A cascade is a ``coalesce`` over ``regexp_extract`` calls: Spark evaluates
``coalesce`` lazily, so the first rule that matches ends the search, the same
short-circuit the reference gets from returning early.  Rules are data (the
``FIELD_RULES`` table); callers can pass their own table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import col_of, strip_ws, unicode_classes

# ---------------------------------------------------------------------------
# Field names, category table and extraction rules must equal
# the reference's.  Rules are matched case-insensitively, group 1 is the value.
# ---------------------------------------------------------------------------

FIELD_KEYS = ["invoice_number", "invoice_date", "due_date", "issuer_name", "recipient_name", "total_amount"]

# (category id, category name) in field order; supercategory is "field".
CATEGORIES = [
    (1, "invoice number"),
    (2, "invoice date"),
    (3, "due date"),
    (4, "billing address"),
    (5, "name_client"),
    (6, "total"),
]

# field -> [main rule, fallback rules...]
FIELD_RULES = {
    "invoice_number": [
        r"(?:invoice|inv|ref|reference)[\s_]*(?:no|number|#|code)?[:.\-\s]*([A-Za-z0-9][\w\-]*\d[\w\-]*)",
        r"(?:#|no\.?|number)[\s:]*(\d+[\w\-]*\d*)",
        r"(?:invoice|inv)[\s:]*(\d{4,})",
    ],
    "invoice_date": [
        r"(?:invoice|inv)[\s_]*(?:date|dt)[:.\-\s]*(\d{1,4}[\/\-\.]\d{1,2}[\/\-\.]\d{1,4})",
        r"(?:date|issued)[\s:]*(\d{1,4}[\/\-\.]\d{1,2}[\/\-\.]\d{1,4})",
        r"(\d{1,2}[\/\-\.]\d{1,2}[\/\-\.]\d{2,4})",
    ],
    "due_date": [
        r"(?:due|payment)[\s_]*(?:date|dt)[:.\-\s]*(\d{1,4}[\/\-\.]\d{1,2}[\/\-\.]\d{1,4})",
    ],
    "total_amount": [
        r"(?:total|amount|sum|balance)[\s_]*(?:due|:|\-)?[\s]*[\$£€]?([0-9,]+\.[0-9]{2})",
        r"(?:total|amount|payment)[\s\$]*(\d+\.\d{2})",
        r"(?:\$|USD|EUR|GBP)[\s]*([0-9,]+\.[0-9]{2})",
    ],
    "issuer_name": [
        r"(?:from|sender|company|issued by|seller)[\s:]*([A-Za-z][\w\s,\.\-&]+(?:Inc|LLC|Ltd|GmbH|Co|Corp)?)",
    ],
    "recipient_name": [
        r"(?:to|bill to|recipient|client|customer)[\s:]*([A-Za-z][\w\s,\.\-&]+)",
    ],
}

# Last resort for the number, searched (case-sensitively) in the text
# between the first and second '#'.
HASH_ID_RULE = r"([A-Za-z0-9][\w\-]*\d[\w\-]*)"

# ---------------------------------------------------------------------------

# X8 re-aimed: the reference asks a trained entity recogniser for the first
# organisation.  Here: the first run of capitalised words ending in a company
# suffix, anywhere in the text.
ORG_RULE = (r"(?:^|[^\p{L}\p{N}])((?:\p{Lu}[\p{L}\p{N}&\-]*[ ]+)+"
            r"(?:Inc|LLC|Ltd|GmbH|Co|Corp|SA|SARL|AG|BV|PLC)\.?)(?:[^\p{L}\p{N}]|$)")
NAME_FIELDS = ("issuer_name", "recipient_name")


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def rule_value(text: Column, rule: str, case_insensitive: bool = True) -> Column:
    """Group 1 of the first match, stripped; null when the rule does not match.
    Words and spaces of a rule are those of any script."""
    pattern = ("(?i)" if case_insensitive else "") + unicode_classes(rule)
    return _nonempty(strip_ws(F.regexp_extract(text, pattern, 1)))


def hash_id_fallback(text: Column) -> Column:
    """Text after the first '#' up to the next one; first token with a digit."""
    after_hash = F.regexp_extract(text, r"^[^#]*#([^#]*)", 1)
    found = F.regexp_extract(after_hash, unicode_classes(HASH_ID_RULE), 1)
    return F.when(F.instr(text, "#") > 0, F.when(after_hash.rlike(r"\d"), _nonempty(strip_ws(found))))


def org_fallback(text) -> Column:
    """X8 (re-aimed): first organisation-like name of the text."""
    return _nonempty(strip_ws(F.regexp_extract(col_of(text), ORG_RULE, 1)))


def extract_field(text, field: str, rules: dict | None = None,
                  use_org_fallback: bool = True) -> Column:
    """Main rule -> fallbacks in order -> X7 (number) -> X8 (names) -> ''."""
    rules = rules or FIELD_RULES
    t = F.coalesce(col_of(text), F.lit(""))
    steps = [rule_value(t, r) for r in rules.get(field, [])]
    if field == "invoice_number":
        steps.append(hash_id_fallback(t))
    if field in NAME_FIELDS and use_org_fallback:
        steps.append(org_fallback(t))
    return F.coalesce(*steps, F.lit(""))


def extract_all_fields(text, rules: dict | None = None, use_org_fallback: bool = True) -> list[Column]:
    """The six fields as aliased columns."""
    return [extract_field(text, f, rules, use_org_fallback).alias(f) for f in FIELD_KEYS]


def extract_struct(text, rules: dict | None = None) -> Column:
    return F.struct(*extract_all_fields(text, rules))
