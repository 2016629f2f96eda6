"""The Column functions as SQL functions, inlined by the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskloom import constants as K
from riskloom.functions import text as X



def _literal(text: str) -> str:
    """SQL literal of any text."""
    return "'" + "".join(c if c.isascii() and c.isprintable() and c not in "'\\" else f"\\u{ord(c):04x}" for c in text) + "'"


# The patterns and lists are those of the Column functions.
_BLANK_SQL = _literal(X._BLANKS)
_STRIPPED = f"btrim(x, {_BLANK_SQL})"


def _not_missing(missing) -> str:
    return f"lower({_STRIPPED}) NOT IN ({', '.join(_literal(m) for m in missing)})"


_BARE = f"replace(regexp_replace({_STRIPPED}, {_literal(X.UNITS)}, ''), ',', '.')"

# name -> (parameters, result type, SQL expression)
SQL_FUNCTIONS = {
    "clean_text": ("x STRING", "STRING", f"CASE WHEN {_not_missing(K.TEXT_MISSING)} THEN {_STRIPPED} END"),
    "parse_number_fr": (
        "x STRING", "DOUBLE",
        f"CASE WHEN {_not_missing(K.NUMBER_MISSING)} AND {_BARE} RLIKE {_literal(X._FLOAT_TEXT)} "
        f"THEN try_cast(replace({_BARE}, '_', '') AS DOUBLE) END",
    ),
    "parse_date_multi": (
        "x STRING", "DATE",
        "CASE " + " ".join(
            f"WHEN btrim(x) RLIKE '{shape}' THEN CAST(try_to_timestamp(btrim(x), '{pattern}') AS DATE)"
            for shape, pattern in (
                (s.replace("\\", "\\\\"), p.replace("'", "\\'")) for s, p in X.DATE_SHAPES
            )
        ) + " END",
    ),
    "csv_safe": (
        "x STRING", "STRING",
        r"CASE WHEN coalesce(x, '') RLIKE '^[=+\\-@\\t\\r]' THEN concat('\'', x) ELSE coalesce(x, '') END",
    ),
    "classify_psi": (
        "x DOUBLE", "STRING",
        "CASE WHEN x IS NULL OR isnan(x) THEN 'missing' WHEN x >= 0.25 THEN 'alert' WHEN x >= 0.1 THEN 'watch' ELSE 'ok' END",
    ),
    "risk_trend": (
        "a DOUBLE, b DOUBLE", "STRING",
        "CASE WHEN b - a > 0.05 THEN 'worse' WHEN b - a < -0.05 THEN 'better' ELSE 'stable' END",
    ),
    "safe_share": ("a DOUBLE, b DOUBLE", "DOUBLE", "least(1D, greatest(0D, a / nullif(b, 0D)))"),
}


def register(spark: SparkSession) -> list[str]:
    for name, (params, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)


