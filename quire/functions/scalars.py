"""Path, size, time, hash and name scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import accent_fold, col_of

# ---------------------------------------------------------------------------
# Routing, upload whitelist, type descriptions and display
# names; they must equal the reference's tables.
# ---------------------------------------------------------------------------
ROUTES = [
    ("pdf", [".pdf"]),
    ("image", [".png", ".jpg", ".jpeg", ".tiff", ".bmp"]),
    ("text", [".txt", ".md", ".csv"]),
    ("spreadsheet", [".xls", ".xlsx"]),
]
UNSUPPORTED = "unsupported"

ALLOWED_EXTENSIONS = ["pdf", "png", "jpg", "jpeg", "tiff", "txt", "md", "csv", "xls", "xlsx"]

FILE_TYPE_NAMES = [
    (".pdf", "PDF Document"),
    (".doc", "Word Document"),
    (".docx", "Word Document"),
    (".jpg", "JPEG Image"),
    (".jpeg", "JPEG Image"),
    (".png", "PNG Image"),
    (".txt", "Text Document"),
    (".csv", "CSV Spreadsheet"),
    (".xls", "Excel Spreadsheet"),
    (".xlsx", "Excel Spreadsheet"),
]

DISPLAY_CLASSES = [
    ("contracts", "Contract"),
    ("emails", "Email"),
    ("invoices", "Invoice"),
    ("other", "Other"),
    ("receipts", "Receipt"),
    ("Contracts", "Contract"),
    ("Emails", "Email"),
    ("Invoices", "Invoice"),
    ("Other", "Other"),
    ("Receipts", "Receipt"),
]

SIZE_UNITS = ["B", "KB", "MB", "GB"]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------

EXT_RULE = r"^\.*[^.].*(\.[^.]*)$"  # os.path.splitext: leading dots are not an extension


def base_name(path) -> Column:
    """Part after the last '/'."""
    return F.regexp_extract(col_of(path), r"([^/]*)$", 1)


def extension(path) -> Column:
    """Lower-cased extension with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(base_name(path), EXT_RULE, 1))


def file_type(path) -> Column:
    """Upper-cased extension without the dot."""
    return F.upper(F.substring(extension(path), 2, 1 << 20))


def route(ext) -> Column:
    """Extension -> reader family; unsupported rows go to the reject output."""
    ext = col_of(ext)
    out = None
    for family, exts in ROUTES:
        cond = ext.isin(*exts)
        out = F.when(cond, F.lit(family)) if out is None else out.when(cond, F.lit(family))
    return out.otherwise(F.lit(UNSUPPORTED))


def allowed_file(name) -> Column:
    """Must contain a dot; the part after the last dot, lower-cased, is whitelisted."""
    name = col_of(name)
    last = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    return (F.instr(name, ".") > 0) & last.isin(*ALLOWED_EXTENSIONS)


def type_description(ext) -> Column:
    """Extension -> description, fallback ``<EXT> File``."""
    ext = col_of(ext)
    mapping = F.create_map(*[F.lit(x) for kv in FILE_TYPE_NAMES for x in kv])
    fallback = F.concat(F.upper(F.substring(ext, 2, 1 << 20)), F.lit(" File"))
    return F.coalesce(F.element_at(mapping, ext), fallback)


def _fmt(value: Column, decimals: int, unit: str) -> Column:
    # Java's %f rounds half up; the reference rounds the binary value (half even
    # on exact ties), so round half-even first.
    return F.format_string(f"%.{decimals}f {unit}", F.bround(value, decimals))


def format_size(size) -> Column:
    """D3: 2 decimals, B / KB / MB / GB (GB is the cap)."""
    s = col_of(size).cast("double")
    out = None
    scaled = s
    for i, unit in enumerate(SIZE_UNITS):
        if i == len(SIZE_UNITS) - 1:
            out = out.otherwise(_fmt(scaled, 2, unit))
        else:
            branch = _fmt(scaled, 2, unit)
            out = F.when(scaled < 1024.0, branch) if out is None else out.when(scaled < 1024.0, branch)
        scaled = scaled / 1024.0
    return out


def format_size_short(size) -> Column:
    """Integer bytes, else 1 decimal KB, else 1 decimal MB (MB is the cap)."""
    s = col_of(size).cast("long")
    return (F.when(s < 1024, F.concat(s.cast("string"), F.lit(" bytes")))
            .when(s < 1024 * 1024, _fmt(s / 1024.0, 1, "KB"))
            .otherwise(_fmt(s / (1024.0 * 1024.0), 1, "MB")))


def format_timestamp(ts) -> Column:
    """D5 (session time zone pinned to UTC; NTZ inputs are zone-free)."""
    return F.date_format(col_of(ts), TIMESTAMP_FORMAT)


def capitalize(c) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    c = col_of(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def display_class(name) -> Column:
    """Capitalise, then plural -> singular display name; unmapped kept."""
    cap = capitalize(name)
    mapping = F.create_map(*[F.lit(x) for kv in DISPLAY_CLASSES for x in kv])
    return F.coalesce(F.element_at(mapping, cap), cap)


def safe_name(name) -> Column:
    """ASCII-fold, path separators and whitespace runs -> '_', drop all but
    ``[A-Za-z0-9_.-]``, strip leading / trailing ``.`` and ``_``."""
    c = accent_fold(col_of(name))
    c = F.regexp_replace(c, r"[/\\]", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+", "_")
    c = F.regexp_replace(c, r"[^A-Za-z0-9_.\-]", "")
    return F.regexp_replace(c, r"^[._]+|[._]+$", "")


def content_hash(text) -> Column:
    """MD5 hex of the UTF-8 bytes."""
    return F.md5(col_of(text).cast("binary"))
