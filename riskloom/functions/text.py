"""Text, number, date and flag parsing as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from riskloom import constants as K

_BLANKS = " \t\n\r\x0b\x0c\x85  　"
_DIGITS = r"\d+(?:_\d+)*"
_FLOAT_TEXT = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf|infinity)$"
)
#: Units and white space that a number may carry.
UNITS = r"(?iU)[%\s]|km"
_INT_TEXT = rf"^[+-]?{_DIGITS}$"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Drop leading and trailing white space of any kind."""
    return F.btrim(_col(x).cast("string"), F.lit(_BLANKS))


def folded(x) -> Column:
    return F.lower(strip(x))


def clean_text(x, missing: Iterable[str] = tuple(K.TEXT_MISSING)) -> Column:
    """Trimmed text, NULL for the spellings of a missing value."""
    return F.when(~folded(x).isin(*missing), strip(x))


def _plain_float(text: Column) -> Column:
    return F.when(text.rlike(_FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def parse_number(x) -> Column:
    """Number from text such as ``61,8``, ``85 %`` or ``14.4 km``; NULL when unreadable."""
    kept = clean_text(x, K.NUMBER_MISSING)
    bare = F.regexp_replace(kept, UNITS, "")
    return _plain_float(F.replace(bare, F.lit(","), F.lit(".")))


# Shape of the text -> pattern that reads it. Only the matching pattern is tried, so a
# non-matching row costs a regular expression and not a parser exception.
DATE_SHAPES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2} \p{L}{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} \p{L}{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}-\p{L}{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\p{L}{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\p{L}{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
]


def parse_date(x) -> Column:
    """Day from several spellings, day before month; NULL when none fits."""
    text = strip(x)
    chosen = F.lit(None).cast("timestamp")
    for shape, pattern in reversed(DATE_SHAPES):
        chosen = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern))).otherwise(chosen)
    return chosen.cast("date")


def map_codes(x, codes: Mapping[str, object]) -> Column:
    """Canonical value of a trimmed, case-folded code; NULL for unknown codes."""
    spellings: dict[object, list[str]] = {}
    for spelling, value in codes.items():
        spellings.setdefault(value, []).append(spelling)
    key = folded(x)
    out = None
    for value, keys in spellings.items():
        out = F.when(key.isin(*keys), F.lit(value)) if out is None else out.when(
            key.isin(*keys), F.lit(value)
        )
    return out


def title_key(x) -> Column:
    """Trimmed text with every run of letters capitalised, also after ``-`` or ``'``."""
    text = strip(x)
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+|[^\p{L}]+"), F.lit(0))
    by_run = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(text.rlike(r"[^\p{L} ]"), by_run).otherwise(F.initcap(text))


def lower_key(x) -> Column:
    """Trimmed lower-case text; NULL when empty or spelled ``nan``."""
    key = folded(x)
    return F.when(~key.isin("", "nan"), key)


def optional_int(x) -> Column:
    return plain_number(x).try_cast("int")


def plain_number(x) -> Column:
    """Number from its plain text; NULL for anything else, type suffixes such as ``5d`` included."""
    return _plain_float(strip(x))


def optional_float(x) -> Column:
    value = plain_number(x)
    return F.when(~F.isnan(value), value)


def bounded_int(x, default: int, low: int, high: int) -> Column:
    """Whole number kept within bounds; ``default`` when the text is not one."""
    text = strip(x)
    digits = F.replace(text, F.lit("_"), F.lit(""))
    value = F.when(text.rlike(_INT_TEXT), digits.try_cast("decimal(38,0)"))
    bounded = F.least(F.lit(high), F.greatest(F.lit(low), value)).cast("long")
    return F.when(value.isNotNull(), bounded).otherwise(F.lit(default).cast("long"))


def bounded_float(x, low: float, high: float) -> Column:
    """Number (comma or point) kept within bounds; NULL when the text is not one."""
    value = _plain_float(F.replace(strip(x), F.lit(","), F.lit(".")))
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def unless_false(x) -> Column:
    """True for any text that is not one of the spellings of "no"; False for NULL."""
    return F.coalesce(~folded(x).isin(*K.FALSE_FLAGS), F.lit(False))


def is_true(x) -> Column:
    """True only for the spellings of "yes"."""
    return F.coalesce(folded(x).isin(*K.TRUE_FLAGS), F.lit(False))


def matches(x, pattern: str) -> Column:
    return F.coalesce(_col(x).rlike(pattern), F.lit(False))


def safe_file_stem(x, length: int = K.BATCH_DISPLAY_LENGTH, default: str = "lot") -> Column:
    stem = F.substring(F.regexp_replace(_col(x), K.FILENAME_UNSAFE, ""), 1, length)
    return F.coalesce(F.nullif(stem, F.lit("")), F.lit(default))


def csv_safe(x) -> Column:
    """Text a spreadsheet will not run as a formula; NULL becomes empty."""
    text = F.coalesce(_col(x).cast("string"), F.lit(""))
    return F.when(text.rlike(K.CSV_FORMULA_PATTERN), F.concat(F.lit("'"), text)).otherwise(text)
