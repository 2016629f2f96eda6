"""Scalar projections and column-perimeter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import display as D, keys as KEY, numbers as N, payload as P, sql as SQLF, text as X
from riskloom.operators import cleaning as CL, perimeter as PM
from riskloom.queries.base import (
    MISSING_SQL, Tables, query, r6, sql_list, sql_map, sql_text, sql_title,
)

# Messy spellings, the same expression in both dialects.
NUMBER_TEXT = """CASE p_partkey % 7
  WHEN 0 THEN replace(CAST(p_retailprice AS STRING), '.', ',') || ' km'
  WHEN 1 THEN CAST(p_retailprice AS STRING) || ' %'
  WHEN 2 THEN '  ' || CAST(p_size AS STRING) || ',5KM '
  WHEN 3 THEN 'NaN' WHEN 4 THEN p_name WHEN 5 THEN '' ELSE CAST(p_size AS STRING) || 'e2' END"""
NUMBER_SQL = """CASE WHEN lower(trim(x)) IN ('', 'nan', 'none', 'null') THEN NULL
  WHEN regexp_full_match(replace(regexp_replace(x, '[%\\s]|km', '', 'gi'), ',', '.'),
       '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
  THEN TRY_CAST(replace(regexp_replace(x, '[%\\s]|km', '', 'gi'), ',', '.') AS DOUBLE) END"""

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_Y = "CAST(year(o_orderdate) AS STRING)"
_M2 = "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')"
_D2 = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
_D1 = "CAST(day(o_orderdate) AS STRING)"
DATE_TEXT = f"""CASE o_orderkey % 6
  WHEN 0 THEN {_Y} || '-' || {_M2} || '-' || {_D2}
  WHEN 1 THEN {_D2} || '/' || {_M2} || '/' || {_Y}
  WHEN 2 THEN ' ' || {_D2} || ' ' || substr('{_MONTHS}', (month(o_orderdate) - 1) * 3 + 1, 3) || ' ' || {_Y}
  WHEN 3 THEN {_D1} || '-' || {_M2} || '-' || {_Y}
  WHEN 4 THEN '31/02/' || {_Y}
  ELSE o_orderpriority END"""
DATE_SQL = """CAST(coalesce(try_strptime(trim(x), '%Y-%m-%d'), try_strptime(trim(x), '%d/%m/%Y'),
  try_strptime(trim(x), '%d %b %Y'), try_strptime(trim(x), '%d-%m-%Y')) AS DATE)"""

CODE_TEXT = {
    "sexe": "CASE c_custkey % 6 WHEN 0 THEN ' Femme ' WHEN 1 THEN 'H' WHEN 2 THEN 'f' WHEN 3 THEN 'Other' WHEN 4 THEN '?' ELSE NULL END",
    "bac_type": "CASE c_custkey % 6 WHEN 0 THEN 'Général' WHEN 1 THEN ' pro' WHEN 2 THEN 'TECHNO' WHEN 3 THEN 'Generale' WHEN 4 THEN c_mktsegment ELSE 'G' END",
    "mention_bac": "CASE c_custkey % 5 WHEN 0 THEN 'Très Bien' WHEN 1 THEN 'ab' WHEN 2 THEN 'P ' WHEN 3 THEN 'Bien' ELSE '' END",
    "boursier": "CASE c_custkey % 5 WHEN 0 THEN 'Oui' WHEN 1 THEN '0' WHEN 2 THEN ' FAUX' WHEN 3 THEN '1' ELSE c_name END",
}
CODES = {
    "sexe": K.SEX_CODES, "bac_type": K.SCHOOL_TYPE_CODES, "mention_bac": K.HONOURS_CODES,
    "boursier": K.GRANT_CODES,
}


@query(
    "parse_number", "P1 P2",
    f"WITH m AS (SELECT p_partkey, {NUMBER_TEXT} AS x FROM part) SELECT p_partkey, round({NUMBER_SQL}, 6) AS number FROM m",
)
def parse_number(t: Tables) -> DataFrame:
    messy = t.part.select("p_partkey", F.expr(NUMBER_TEXT).alias("number"))
    return CL.parse_numbers(messy, ["number", "absent"]).withColumn("number", r6("number"))


@query(
    "parse_date", "P3",
    f"WITH m AS (SELECT o_orderkey, {DATE_TEXT} AS x FROM orders) SELECT o_orderkey, {DATE_SQL} AS day FROM m",
)
def parse_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", X.parse_date(F.expr(DATE_TEXT)).alias("day"))


@query(
    "map_codes", "P4 P5 P6 P7",
    "SELECT c_custkey, " + ", ".join(f"{sql_map(CODE_TEXT[c], CODES[c])} AS {c}" for c in CODES) + " FROM customer",
)
def map_codes(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", *[X.map_codes(F.expr(CODE_TEXT[c]), CODES[c]).alias(c) for c in CODES])


_NAME_TEXT = "CASE p_partkey % 3 WHEN 0 THEN '  ' || upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-') ELSE 'l''' || p_name || ' 2b' END"


@query("title_key", "P8", f"SELECT p_partkey, {sql_title(_NAME_TEXT)} AS title FROM part")
def title_key(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.title_key(F.expr(_NAME_TEXT)).alias("title"))


_SPARSE = "CASE c_custkey % 4 WHEN 0 THEN ' ' || c_mktsegment || ' ' WHEN 1 THEN 'NaN' WHEN 2 THEN ' ' ELSE 'None' END"


@query(
    "null_tokens", "P9 P22",
    f"WITH m AS (SELECT c_custkey, {_SPARSE} AS x FROM customer) SELECT c_custkey, "
    "CASE WHEN lower(trim(x)) NOT IN ('', 'nan') THEN lower(trim(x)) END AS lowered, "
    f"CASE WHEN lower(trim(x)) NOT IN ({MISSING_SQL}) THEN trim(x) END AS cleaned FROM m",
)
def null_tokens(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", X.lower_key(F.expr(_SPARSE)).alias("lowered"), X.clean_text(F.expr(_SPARSE)).alias("cleaned")
    )


_RAW_ORDERS = f"""
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS STRING) || ' km' AS distance_domicile_km,
  replace(CAST(o_orderkey % 100 AS STRING), '.', ',') || '%' AS taux_presence_pct,
  {DATE_TEXT} AS date_inscription, lower(o_orderpriority) AS filiere,
  CASE o_orderstatus WHEN 'O' THEN 'oui' WHEN 'F' THEN 'NON' ELSE o_orderstatus END AS boursier,
  ' ' || o_orderstatus AS etablissement_origine
FROM orders"""


@query(
    "clean_dedupe", "P10 U1",
    f"WITH r AS ({_RAW_ORDERS}), b AS (SELECT * FROM r UNION SELECT * FROM r) SELECT o_orderkey, o_custkey, "
    + ", ".join(
        f"{NUMBER_SQL.replace('x,', c + ',').replace('trim(x)', f'trim({c})')} AS {c}"
        for c in K.TEXT_NUMERIC_COLS
    )
    + f", date_inscription, {DATE_SQL.replace('trim(x)', 'trim(date_inscription)')} AS date_inscription_parsed, "
    f"{sql_title('filiere')} AS filiere, {sql_map('boursier', K.GRANT_CODES)} AS boursier, "
    "lower(trim(etablissement_origine)) AS etablissement_origine FROM b",
)
def clean_dedupe(t: Tables) -> DataFrame:
    raw = t.spark.sql(_RAW_ORDERS.replace("FROM orders", "FROM {orders}"), orders=t.orders)
    return CL.clean(raw.unionByName(raw))


@query(
    "safe_ratios", "P11 P12 P13 P15",
    """SELECT l_orderkey, l_linenumber,
    round(CASE WHEN l_quantity - l_linenumber <> 0 THEN least(1.0, greatest(0.0, l_discount * 100 / (l_quantity - l_linenumber))) END, 6) AS share,
    round(coalesce(l_extendedprice / nullif(l_quantity - 1, 0), 0), 8) AS per_unit,
    CAST(trim(CASE WHEN l_linestatus = 'O' THEN '  ' ELSE l_returnflag END) <> '' AS INT) AS present FROM lineitem""",
)
def safe_ratios(t: Tables) -> DataFrame:
    note = F.when(F.col("l_linestatus") == "O", "  ").otherwise(F.col("l_returnflag"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        r6(N.share(F.col("l_discount") * 100, F.col("l_quantity") - F.col("l_linenumber"))).alias("share"),
        r6(N.ratio_or_zero("l_extendedprice", F.col("l_quantity") - 1), 8).alias("per_unit"),
        CL.text_present(note).alias("present"),
    )


@query(
    "engineered_features", "P15",
    """SELECT l_orderkey, l_linenumber,
    round(CASE WHEN l_quantity <> 0 THEN least(1.0, greatest(0.0, l_linenumber / l_quantity)) END, 6) AS taux_rendu_devoirs,
    round(coalesce(l_extendedprice / nullif(l_quantity, 0), 0), 8) AS heures_lms_par_connexion,
    round(coalesce(l_linenumber / nullif(l_quantity, 0), 0), 6) AS ressources_par_connexion,
    CAST(l_returnflag <> '' AS INT) AS commentaire_present,
    date_diff('day', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem), CAST(l_shipdate AS DATE)) AS jours_inscription
    FROM lineitem""",
)
def engineered_features(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("nb_devoirs_rendus"),
        F.col("l_quantity").alias("nb_devoirs_total"), F.col("l_extendedprice").alias("heures_lms_total"),
        F.col("l_quantity").alias("connexions_lms_30j"), F.col("l_linenumber").alias("ressources_consultees"),
        F.col("l_returnflag").alias(K.TEXT_COL), F.to_date("l_shipdate").alias("date_inscription_parsed"),
    )
    return CL.add_features(rows).select(
        "l_orderkey", "l_linenumber", r6("taux_rendu_devoirs").alias("taux_rendu_devoirs"),
        r6("heures_lms_par_connexion", 8).alias("heures_lms_par_connexion"),
        r6("ressources_par_connexion").alias("ressources_par_connexion"),
        "commentaire_present", F.col("jours_inscription").cast("long").alias("jours_inscription"),
    )


@query(
    "days_since_first", "P14 A29",
    "SELECT o_orderkey, date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), CAST(o_orderdate AS DATE)) AS days FROM orders",
)
def days_since_first(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return rows.select("o_orderkey", CL.days_since_first(rows, "day").cast("long").alias("days"))


_DEMO_SECRET = "demo-secret"
_PAD = _DEMO_SECRET.encode().ljust(64, b"\0")
_INNER, _OUTER = bytes(b ^ 0x36 for b in _PAD).hex(), bytes(b ^ 0x5C for b in _PAD).hex()


def _hmac_sql(x: str) -> str:
    return f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode({x}))))"


@query(
    "pseudonym", "P16 P17",
    f"SELECT c_custkey, {_hmac_sql('c_name')} AS student_id, "
    f"CASE WHEN c_nationkey <> 0 THEN {_hmac_sql('CAST(c_custkey AS VARCHAR)')} END AS id_dossier FROM customer",
)
def pseudonym(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey", F.col("c_name").alias("student_id"),
        F.when(F.col("c_nationkey") != 0, F.col("c_custkey").cast("string")).alias("id_dossier"),
    )
    return KEY.pseudonymize(rows, secret=_DEMO_SECRET)


@query(
    "payload_json", "P18",
    """SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name,
      'segment': CASE WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END, 'balance': CASE WHEN c_nationkey = 2 THEN NULL ELSE c_nationkey + 0.5 END}) AS VARCHAR) AS payload FROM customer""",
)
def payload_json(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey", "c_name", F.when(F.col("c_nationkey") != 1, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") == 2, F.lit(float("nan"))).otherwise(F.col("c_nationkey") + F.lit(0.5)).alias("balance"),
    )
    return rows.select("c_custkey", P.to_payload(rows).alias("payload"))




@query(
    "json_whitelist", "P19 P20",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS k,
    CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS n_fields FROM events""",
)
def json_whitelist(t: Tables) -> DataFrame:
    """Stored objects cut down to allowed names; broken ones become empty."""
    stored = F.when(F.col("event_type") == "error", F.lit("broken {")).otherwise(
        F.to_json(
            F.map_concat(
                P.read_object("props"),
                F.create_map(F.lit("type"), F.col("event_type"), F.lit("abandon"), F.lit("1")),
            )
        )
    )
    shown = P.visible_fields(P.read_object(stored), ["k", "type", K.TARGET_CLF], PM.HIDDEN_FROM_READERS)
    return t.events.select("event_id", shown["k"].alias("k"), F.size(shown).alias("n_fields"))


_TYPED = "CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN CAST(p_size AS STRING) || '.75' WHEN 2 THEN p_name ELSE NULL END"


@query(
    "optional_casts", "P21",
    f"WITH m AS (SELECT p_partkey, {_TYPED} AS x FROM part) SELECT p_partkey, x AS as_text, TRY_CAST(x AS DOUBLE) AS as_float, CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INT) AS as_int FROM m",
)
def optional_casts(t: Tables) -> DataFrame:
    x = F.expr(_TYPED)
    return t.part.select(
        "p_partkey", x.alias("as_text"), X.optional_float(x).alias("as_float"), X.optional_int(x).alias("as_int")
    )


_SUFFIXED = "CASE p_size % 7 WHEN 0 THEN '5d' WHEN 1 THEN ' 7f ' WHEN 2 THEN '1_000' WHEN 3 THEN 'Infinity' WHEN 4 THEN '-2.5e1' WHEN 5 THEN '3L' ELSE CAST(p_size AS VARCHAR) END"


@query(
    "number_texts", "P1 P21 F10",
    f"""WITH m AS (SELECT p_partkey, {_SUFFIXED} AS x FROM part), v AS (SELECT p_partkey, CASE WHEN x = '1_000' THEN 1000.0::DOUBLE
      WHEN x = 'Infinity' THEN 'inf'::DOUBLE WHEN regexp_matches(trim(x), '[dfL]$') THEN NULL ELSE x::DOUBLE END AS v FROM m)
    SELECT p_partkey, v AS number, v AS parsed, v AS optional, v AS by_sql, CASE WHEN isfinite(v) THEN v::INT END AS whole FROM v""",
)
def number_texts(t: Tables) -> DataFrame:
    """One rule for number texts everywhere: no type suffixes, underscores between digits."""
    SQLF.register(t.spark)
    x = F.expr(_SUFFIXED.replace("VARCHAR", "STRING"))
    return t.part.select(
        "p_partkey", X.plain_number(x).alias("number"), X.parse_number(x).alias("parsed"), X.optional_float(x).alias("optional"),
        F.call_function("parse_number_fr", x).alias("by_sql"), X.optional_int(x).alias("whole"),
    )


@query(
    "sql_functions", "P1 P2 P27 D3",
    """SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS cleaned,
      CAST(make_date(1990 + p_size, CAST(1 + p_partkey % 12 AS INT), CAST(1 + p_partkey % 28 AS INT)) AS VARCHAR) AS day,
      CASE WHEN p_size % 2 = 0 THEN chr(39) || '=' ELSE '' END || p_name AS safe,
      CASE WHEN p_size >= 40 THEN 'alert' WHEN p_size >= 20 THEN 'watch' ELSE 'ok' END AS psi,
      CASE WHEN p_size > 30 THEN 'worse' WHEN p_size < 10 THEN 'better' ELSE 'stable' END AS trend,
      CAST(least(1.0, p_size / 40.0) AS DOUBLE) AS share FROM part""",
)
def sql_functions(t: Tables) -> DataFrame:
    """Every registered SQL function but the number parser, over a whole table."""
    SQLF.register(t.spark)
    size, key = F.col("p_size"), F.col("p_partkey")
    day = F.format_string("%02d/%02d/%d", (key % 28 + 1).cast("int"), (key % 12 + 1).cast("int"), (size + 1990).cast("int"))
    psi = F.when(size >= 40, 0.3).when(size >= 20, 0.15).otherwise(0.01)
    moved = F.when(size > 30, 0.7).when(size < 10, 0.3).otherwise(0.5)
    brand = F.when(size % 3 == 0, " nan ").otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" ")))
    return t.part.select(
        "p_partkey", F.call_function("clean_text", brand).alias("cleaned"),
        F.call_function("parse_date_multi", day).cast("string").alias("day"),
        F.call_function("csv_safe", F.concat(F.when(size % 2 == 0, "=").otherwise(""), "p_name")).alias("safe"),
        F.call_function("classify_psi", psi).alias("psi"), F.call_function("risk_trend", F.lit(0.5), moved).alias("trend"),
        F.call_function("safe_share", size.cast("double"), F.lit(40.0)).alias("share"),
    )


@query(
    "display_texts", "P23",
    """SELECT o_orderkey, substr(o_orderpriority || '-' || CAST(o_orderkey AS VARCHAR) || '-0000000', 1, 12) AS short_id,
    printf('%.1f', o_totalprice / 500009.0::DOUBLE * 100) || ' %' AS pct, '—' AS target FROM orders""",
)
def display_texts(t: Tables) -> DataFrame:
    long_id = F.concat("o_orderpriority", F.lit("-"), F.col("o_orderkey").cast("string"), F.lit("-0000000"))
    return t.orders.select(
        "o_orderkey", D.short_key(long_id).alias("short_id"),
        D.percent_text(F.col("o_totalprice") / F.lit(500009.0)).alias("pct"),
        D.short_target(F.lit(None).cast("string")).alias("target"),
    )


_SOURCE_COLS = ["p_type", "p_size", "p_brand", "p"]
_FEATURE = "CASE p_partkey % 4 WHEN 0 THEN 'cat__p_type_' || p_type WHEN 1 THEN 'num__p_size' WHEN 2 THEN 'p_brand_' || p_brand ELSE 'remainder__zz_' || p_type END"


@query(
    "source_columns", "P24",
    f"""WITH m AS (SELECT p_partkey, {_FEATURE} AS name FROM part),
    b AS (SELECT p_partkey, name, regexp_replace(name, '^(num__|cat__|remainder__)', '') AS base FROM m),
    c AS (SELECT unnest([{sql_list(_SOURCE_COLS)}]) AS col)
    SELECT p_partkey, name, (SELECT arg_max(col, length(col)) FROM c WHERE base = col OR starts_with(base, col || '_')) AS source FROM b""",
)
def source_columns(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_FEATURE).alias("name")).withColumn(
        "source", D.source_column("name", _SOURCE_COLS)
    )


_LABEL_NAMES = "CASE p_partkey % 5 WHEN 0 THEN 'cat__mention_bac_' || p_brand WHEN 1 THEN 'num__age' WHEN 2 THEN 'cat__filiere_' || p_type WHEN 3 THEN 'num__heures_lms_total' ELSE 'p_' || p_type END"


@query(
    "feature_labels", "P25",
    f"""WITH m AS (SELECT p_partkey, {_LABEL_NAMES} AS name FROM part),
    b AS (SELECT p_partkey, name, regexp_replace(name, '^(num__|cat__|remainder__)', '') AS base FROM m),
    d AS (SELECT unnest([{", ".join(f"{{'k': {sql_text(k)}, 'v': {sql_text(v)}}}" for k, v in K.FEATURE_LABELS.items())}]) AS e),
    h AS (SELECT p_partkey, name, base, (SELECT arg_max(e, length(e.k)) FROM d WHERE base = e.k OR starts_with(base, e.k || '_')) AS hit FROM b)
    SELECT p_partkey, name, CASE WHEN hit IS NULL THEN trim(replace(base, '_', ' ')) WHEN base = hit.k THEN hit.v
      ELSE hit.v || ' : ' || trim(replace(substr(base, length(hit.k) + 2), '_', ' ')) END AS label FROM h""",
)
def feature_labels(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_LABEL_NAMES).alias("name")).withColumn(
        "label", D.feature_label("name")
    )


_VALUE_NAMES = "CASE l_linenumber % 4 WHEN 0 THEN 'num__taux_rendu_devoirs' WHEN 1 THEN 'taux_presence_pct' WHEN 2 THEN 'boursier' ELSE 'autre' END"
_VALUE = "CASE WHEN l_linenumber % 4 = 3 AND l_tax = 0 THEN l_quantity ELSE l_discount * 7.3 + l_tax + 0.0001 END"


@query(
    "value_texts", "P26",
    f"""WITH m AS (SELECT l_orderkey, l_linenumber, regexp_replace({_VALUE_NAMES}, '^num__', '') AS name,
      CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE {_VALUE} END AS v FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN v IS NULL THEN {sql_text(K.NOT_PROVIDED)}
      WHEN name = 'taux_rendu_devoirs' THEN printf('%.0f', v * 100) || ' %'
      WHEN name LIKE '%\\_pct' ESCAPE '\\' THEN printf('%.0f', v) || ' %'
      WHEN name = 'boursier' THEN CASE WHEN v >= 0.5 THEN 'oui' ELSE 'non' END
      WHEN v = floor(v) THEN printf('%.0f', v) ELSE printf('%.2f', v) END AS shown FROM m""",
)
def value_texts(t: Tables) -> DataFrame:
    hidden = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        D.number_text(F.expr(_VALUE_NAMES), F.when(~hidden, F.expr(_VALUE))).alias("shown"),
    )


_CELL = "CASE p_partkey % 5 WHEN 0 THEN '=' || p_name WHEN 1 THEN '-' || p_brand WHEN 2 THEN '@x' WHEN 3 THEN p_name ELSE NULL END"


@query(
    "csv_safe", "P27",
    f"WITH m AS (SELECT p_partkey, coalesce({_CELL}, '') AS x FROM part) SELECT p_partkey, CASE WHEN substr(x, 1, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || x ELSE x END AS cell FROM m",
)
def csv_safe(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.csv_safe(F.expr(_CELL)).alias("cell"))


_DIRTY = "CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN ' -' || CAST(p_size AS STRING) WHEN 2 THEN CAST(p_size AS STRING) || ',5' WHEN 3 THEN p_name WHEN 4 THEN '' ELSE '999999' END"


@query(
    "bounded_values", "P28",
    f"""WITH m AS (SELECT p_partkey, {_DIRTY} AS x FROM part)
    SELECT p_partkey, CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN least(40, greatest(1, CAST(trim(x) AS BIGINT))) ELSE 7 END AS whole,
    CASE WHEN regexp_full_match(replace(trim(x), ',', '.'), '[+-]?[0-9]+[.]?[0-9]*') THEN least(40.5, greatest(-3.5, CAST(replace(trim(x), ',', '.') AS DOUBLE))) END AS fraction FROM m""",
)
def bounded_values(t: Tables) -> DataFrame:
    x = F.expr(_DIRTY)
    return t.part.select(
        "p_partkey", X.bounded_int(x, 7, 1, 40).alias("whole"), X.bounded_float(x, -3.5, 40.5).alias("fraction")
    )


_FLAG = "CASE p_partkey % 7 WHEN 0 THEN ' No' WHEN 1 THEN 'OFF ' WHEN 2 THEN p_name WHEN 3 THEN NULL WHEN 4 THEN 'Yes' WHEN 5 THEN '0' ELSE 'on' END"


@query(
    "flag_values", "P29",
    f"WITH m AS (SELECT p_partkey, {_FLAG} AS x FROM part) SELECT p_partkey, coalesce(lower(trim(x)) NOT IN ({sql_list(K.FALSE_FLAGS)}), false) AS unless_false, coalesce(lower(trim(x)) IN ({sql_list(K.TRUE_FLAGS)}), false) AS is_true FROM m",
)
def flag_values(t: Tables) -> DataFrame:
    x = F.expr(_FLAG)
    return t.part.select("p_partkey", X.unless_false(x).alias("unless_false"), X.is_true(x).alias("is_true"))


_SCOPE = """CASE c_custkey % 5 WHEN 0 THEN '["' || lower(c_mktsegment) || '", " law ", ""]' WHEN 1 THEN NULL WHEN 2 THEN 'oops' WHEN 3 THEN '{"a": 1}' ELSE '[]' END"""


@query(
    "scope_values", "P30",
    f"""WITH m AS (SELECT c_custkey, c_mktsegment, {_SCOPE} AS x FROM customer)
    SELECT c_custkey, CASE WHEN coalesce(trim(x), '') = '' THEN 'all'
      WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) || '|law' ELSE '' END AS scope,
      CASE WHEN c_custkey % 5 = 0 THEN CAST(to_json(list_sort([{sql_title('c_mktsegment')}, 'Law'])) AS VARCHAR) END AS stored FROM m""",
)
def scope_values(t: Tables) -> DataFrame:
    scope = P.read_scope(F.expr(_SCOPE))
    return t.customer.select(
        "c_custkey", F.when(scope.isNull(), "all").otherwise(F.array_join(scope, "|")).alias("scope"),
        P.write_scope(scope).alias("stored"),
    )


@query(
    "expiry_days_left", "P31",
    """SELECT o_orderkey, CAST(floor((epoch(o_orderdate) + 365 * 86400 - epoch(TIMESTAMP '1999-06-30 18:00:00')) / 86400.0) AS BIGINT) AS days FROM orders""",
)
def expiry_days_left(t: Tables) -> DataFrame:
    now = F.lit("1999-06-30 18:00:00").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", N.days_left(N.expires_at("o_orderdate"), now).alias("days"))


_IDS = "CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', '-') WHEN 2 THEN replace(c_name, '#', '._') ELSE '' END"


@query(
    "identifier_rules", "P32",
    f"""WITH m AS (SELECT c_custkey, {_IDS} AS x FROM customer)
    SELECT c_custkey, regexp_full_match(x, '[A-Za-z0-9._-]{{1,64}}') AS request_ok, regexp_full_match(x, '[A-Za-z0-9-]{{1,64}}') AS batch_ok,
    coalesce(nullif(substr(regexp_replace(x, '[^A-Za-z0-9_-]', '', 'g'), 1, 8), ''), 'lot') AS stem FROM m""",
)
def identifier_rules(t: Tables) -> DataFrame:
    x = F.expr(_IDS)
    return t.customer.select(
        "c_custkey", X.matches(x, K.REQUEST_ID_PATTERN).alias("request_ok"),
        X.matches(x, K.BATCH_ID_PATTERN).alias("batch_ok"), X.safe_file_stem(x).alias("stem"),
    )


@query(
    "alert_flags", "P33",
    "SELECT o_orderkey, CAST(o_totalprice / 500009.0::DOUBLE >= 0.3 AS INT) AS alerte FROM orders",
)
def alert_flags(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", N.alert_flag(F.col("o_totalprice") / F.lit(500009.0), 0.3).alias("alerte")
    )


@query(
    "event_overlay", "P35",
    """SELECT event_id, 'INFO' AS level, CASE WHEN event_type = 'error' THEN 'override' ELSE event_type END AS kind,
    CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events""",
)
def event_overlay(t: Tables) -> DataFrame:
    base = F.create_map(F.lit("level"), F.lit("INFO"), F.lit("kind"), F.col("event_type"))
    event = P.read_object("props")
    event = F.when(
        F.col("event_type") == "error", F.map_concat(event, F.create_map(F.lit("kind"), F.lit("override")))
    ).otherwise(event)
    merged = P.overlay(base, event)
    return t.events.select("event_id", merged["level"].alias("level"), merged["kind"].alias("kind"), merged["k"].alias("k"))


@query(
    "class_percentages", "P36 A7",
    """SELECT CASE quality WHEN 0 THEN 'Poursuit' ELSE 'Décroche' END AS class, count(*) AS n,
    round(100.0 * count(*) / (SELECT count(*) FROM labels), 1) AS pct FROM labels GROUP BY 1""",
)
def class_percentages(t: Tables) -> DataFrame:
    from riskloom.operators import quality as Q

    counted = Q.value_counts(t.labels.withColumnRenamed("quality", "class"), "class", K.CLASS_LABELS)
    whole = t.labels.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("pct", F.round(100.0 * F.col("n") / whole, 1))


# --- perimeter --------------------------------------------------------------

# Line items under the perimeter's own column names.
_AS_COHORT = {
    "l_orderkey": "student_id", "l_partkey": "id_dossier", "l_suppkey": "groupe_td", "l_linenumber": "nb_devoirs_rendus",
    "l_quantity": "nb_ue_validees_s1", "l_extendedprice": "moyenne_finale", "l_discount": "taux_presence_pct",
    "l_tax": "heures_lms_total", "l_returnflag": "sexe", "l_linestatus": "niveau", "l_shipdate": "date_inscription",
}


def _cohort(t: Tables) -> DataFrame:
    renamed = t.lineitem.withColumnsRenamed(_AS_COHORT)
    return renamed.withColumn(K.TARGET_CLF, (F.col("sexe") == "R").cast("int"))


_KEPT = "l_linenumber AS nb_devoirs_rendus, l_discount AS taux_presence_pct, l_tax AS heures_lms_total, l_returnflag AS sexe"


@query("perimeter_select", "C1 C10 U3", f"SELECT {_KEPT} FROM lineitem")
def perimeter_select(t: Tables) -> DataFrame:
    df = _cohort(t)
    numeric, other = PM.split_by_type(df, PM.feature_columns(df))
    return df.select(*numeric, *other)


@query(
    "gold_dataset", "C3 C4 C7",
    f"SELECT {_KEPT}, CAST(l_returnflag = 'R' AS INT) AS abandon, l_extendedprice AS moyenne_finale, l_orderkey AS student_id, l_partkey AS id_dossier FROM lineitem",
)
def gold_dataset(t: Tables) -> DataFrame:
    return PM.gold(_cohort(t), keep=K.ID_COLS)


@query(
    "scoring_contract", "C5 C6",
    "SELECT l_returnflag AS sexe, CAST(NULL AS DOUBLE) AS motivation, l_tax AS heures_lms_total FROM lineitem",
)
def scoring_contract(t: Tables) -> DataFrame:
    return PM.reindex(PM.gold(_cohort(t), include_labels=False), ["sexe", "motivation", "heures_lms_total"])


@query(
    "excluded_columns", "C2 C11",
    "SELECT x.col AS \"column\", x.title, count(*) AS n_rows FROM lineitem CROSS JOIN (VALUES "
    + ", ".join(
        f"({sql_text(c)}, {sql_text(title)})" for title, cols, _ in K.EXCLUSION_REASONS for c in cols
        if c in _AS_COHORT.values()
    )
    + ") AS x(col, title) GROUP BY ALL",
)
def excluded_columns(t: Tables) -> DataFrame:
    """Excluded columns present in the table, with their reason group and row count."""
    df = PM.mark_forbidden(_cohort(t))
    features = PM.gold(df, include_labels=False)
    PM.assert_no_marked(features)
    present = PM.exclusions(t.spark).where(F.col("column").isin(*df.columns))
    return present.select("column", "title", df.agg(F.count(F.lit(1))).scalar().alias("n_rows"))


_DISGUISES = {
    "renamed": "l_extendedprice", "computed": "l_extendedprice * 1", "nested": "struct(l_tax, l_extendedprice)",
    "ranked": "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice)", "clean": "l_tax * (1 - l_discount)",
    "grouped": "count(*) OVER (PARTITION BY l_returnflag)",
}


@query(
    "leakage_lineage", "C2",
    "SELECT x.feature, x.hidden, count(*) AS n_rows, min(l_linenumber) AS least FROM lineitem CROSS JOIN (VALUES ('averaged', 'moyenne_finale'), ('clean', ''), "
    "('computed', 'moyenne_finale'), ('grouped', ''), ('joined', 'moyenne_finale'), ('nested', 'moyenne_finale'), ('ranked', 'moyenne_finale'), "
    "('renamed', 'moyenne_finale')) AS x(feature, hidden) GROUP BY ALL",
)
def leakage_lineage(t: Tables) -> DataFrame:
    """What the guard says of a forbidden column in several disguises, per feature of the rows."""
    rows = t.lineitem.withColumn("moyenne_finale", F.col("l_extendedprice"))
    made = rows.withColumns({name: F.expr(code.replace("l_extendedprice", "moyenne_finale")) for name, code in _DISGUISES.items()})
    means = rows.groupBy(F.col("l_returnflag").alias("flag")).agg(F.avg("moyenne_finale").alias("averaged"))
    best = rows.groupBy(F.col("l_returnflag").alias("flag")).agg(F.max("moyenne_finale").alias("best"))
    made = made.join(F.broadcast(means), F.col("l_returnflag") == F.col("flag")).drop("flag")
    made = made.join(F.broadcast(best), F.col("l_returnflag") == F.col("flag")).drop("flag").withColumn("joined", F.col("best") > 0)
    features = sorted([*_DISGUISES, "averaged", "joined"])
    hidden = PM.derived_from(made, features)
    verdicts = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(",".join(hidden.get(c, []))).alias("hidden")) for c in features])
    return made.select("l_linenumber", F.inline(verdicts)).groupBy("feature", "hidden").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("l_linenumber").alias("least")
    )
