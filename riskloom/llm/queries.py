"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm import bpe, chat, decontaminate, language, licenses, negatives, repair, secrets, simhash, spelling, topk, toxicity, warc
from riskloom.llm.common import remainder
from riskloom.session import scratch_path

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(build: Build) -> Build:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '</', '<')))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS n,
    lag(role) OVER w IS DISTINCT FROM role AS starts
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN starts THEN 14 + CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role)
       ELSE 1 + length(url_encode(role)) END ELSE 7 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op1_chat_format", OP1_SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    made = chat.format_chats(rows.unionByName(extra))
    read = made.select("conv_id", "formatted", chat.read_turns().alias("turns"), chat.loss_text().alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _spans_sql(pattern: str, group: int, least: int) -> str:
    """Spans of a pattern in ``text`` as a list of (start, stop, value)."""
    pattern = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(g) + 0), lambda i: {{'start':
        list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
        'stop': list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))), 'value': v[i]}}),
        lambda s: length(s.value) >= {least}) FROM (SELECT string_split_regex(text, '{pattern}') AS g,
        regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {group}) AS v)"""


def _op2_sql() -> str:
    kinds = {**secrets.BASE, "mixed": secrets.TOKEN[1:]}
    columns = ",\n  ".join(f"(SELECT {_spans_sql(*p)}) AS s_{k}" for k, p in kinds.items())
    tagged = lambda k, i: f"list_transform(s_{k}, lambda s: {{'start': CAST(s.start AS BIGINT), 'kind': {i}, 'stop': CAST(s.stop AS BIGINT)}})"
    base = " || ".join(tagged(k, i) for i, k in enumerate(secrets.BASE))
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    write = lambda spans: f"array_to_string(list_transform(list_sort({spans}), lambda s: {names}[s.kind + 1] || ':' || s.start || ':' || s.stop), ',')"
    return f"""
WITH docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
spans AS (SELECT doc_id, source, lang, {columns} FROM docs),
mixed AS (SELECT doc_id, source, lang, unnest(list_filter(s_mixed, lambda s: regexp_matches(s.value, '{secrets.DIGIT}') AND regexp_matches(s.value, '{secrets.LETTER}'))) AS s FROM spans),
held AS (SELECT s.value AS value, count(DISTINCT coalesce(source, '?')) AS owners, count(DISTINCT concat_ws('/', source, lang)) AS repositories FROM mixed GROUP BY ALL),
marks AS (SELECT m.doc_id, count(*) AS n_candidates, count(*) FILTER (owners > 1) AS n_copied, count(*) FILTER (owners = 1 AND repositories > 1) AS n_shared,
  list({{'start': CAST(m.s.start AS BIGINT), 'kind': {len(secrets.BASE)}, 'stop': CAST(m.s.stop AS BIGINT)}}) FILTER (owners = 1) AS owned
  FROM mixed m JOIN held ON held.value = m.s.value GROUP BY m.doc_id)
SELECT doc_id, CAST(len(s_assign) AS BIGINT) AS n_assign, CAST(len(s_access) AS BIGINT) AS n_access, CAST(len(s_hex) AS BIGINT) AS n_hex,
  sha256({write(base)}) AS base_sha256, {write(f"({base}) || coalesce(owned, [])")} AS spans,
  coalesce(n_candidates, 0) AS n_candidates, coalesce(n_copied, 0) AS n_copied, coalesce(n_shared, 0) AS n_shared
FROM spans LEFT JOIN marks USING (doc_id)
"""


def repository() -> Column:
    """A source's texts of one language count as one repository of that source."""
    return F.concat_ws("/", "source", "lang")


@query("op2_secret_scan", _op2_sql())
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), repository=repository(), owner="source", candidates=secrets.mixed)
    count = lambda name: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(name))).cast("long").alias(f"n_{name}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.rendered(F.col("base")), 256).alias("base_sha256"),
        secrets.rendered(F.concat("base", "owned")).alias("spans"), "n_candidates", "n_copied", "n_shared",
    )


def _op3_sql() -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, texts in licenses.KNOWN.items() for text in texts)
    copyright_line = r"(?im)^[^\p{L}\n]*(?:copyright|\(c\)|©)[^\n]*\d{4}[^\n]*$"
    text = f"' ' || trim(regexp_replace(lower(regexp_replace(text, '{copyright_line}', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for old, new in licenses.SPELLINGS.items():
        text = f"replace({text}, ' {old} ', ' {new} ')"
    return f"""
WITH known AS (SELECT trim({text}) AS norm, min(license) AS license FROM (VALUES {known}) AS k(license, text) GROUP BY 1),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT doc_id, 'text' AS unit, text FROM docs
  UNION ALL SELECT doc_id, 'paragraph', p FROM (SELECT doc_id, unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) AS p FROM docs) WHERE contains(p, chr(10))
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM docs),
norms AS (SELECT doc_id, unit, trim({text}) AS norm FROM units),
hits AS (SELECT doc_id, unit, license FROM norms JOIN known USING (norm) WHERE norm <> '')
SELECT d.doc_id, min(license) FILTER (unit = 'text') AS text_license, count(license) AS n_matches,
  coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id
"""


@query("op3_license_scan", _op3_sql().replace("\\\\", "\\"))
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(table(spark, folder, "documents"), licenses.registry(spark))


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op4_exact_top_k", OP4_SQL)
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op5_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    part = remainder("doc_id", 3)
    model = language.fit(docs.where(part != 1))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (part == 1).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"),
    )


@query("op6_toxicity")
def toxicity_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    part = remainder("doc_id", 5)
    model = toxicity.fit(table(spark, folder, "labels").where(part != 0), docs)
    return toxicity.score(docs, model).select(
        "doc_id", (part == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query("op7_token_shards")
def token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return repair.round_trip(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), end=2)


@query("op8_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op9_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op10_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents").select("doc_id", "text"))


def digests(docs: DataFrame, ids: bool = False) -> DataFrame:
    """Encode and decode documents; digests of the ids and of the decoded bytes, and the ``ids`` if asked for."""
    path = vocabulary("byte_bpe_50k.json")
    bpe.check_ranks(path, vocabulary("byte_bpe_50k.tiktoken"))
    coded = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if ids else []),
    )


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, n.vec_id) AS INT) AS rank,
  n.vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", OP11_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS step),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
coded AS (SELECT run, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)]
    ELSE [CAST(192 + (ord(x) >> 6) AS BIGINT), CAST(128 + (ord(x) & 63) AS BIGINT)] END)) AS bytes FROM runs),
hashed AS (SELECT run, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM coded, crc),
uses AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM uses WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cuts AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS cut FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
found AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
  CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM found
  UNION ALL SELECT w.word, coalesce(f.form, f.word), f.form IS NULL FROM walk w JOIN found f ON f.word = w.root WHERE NOT w.done)
SELECT word, form, root, n, n_near, form_n FROM found JOIN (SELECT word, root FROM walk WHERE done) USING (word)
"""


@query("op12_spelling_variants", OP12_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(spelling.runs(F.col("text"))).alias("run"))
    rows = rows.select("id", spelling.lowered(F.col("run")).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.variants(spelling.counted(words))


OP13_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
coded AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || hex[5 * (i // 4) + 1:5 * (i // 4) + 5] AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '') AS payload_digest FROM d),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts
"""


@query("op13_warc_captures", OP13_SQL)
def warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path, least_bytes=0)
    found = warc.resolved(warc.assemble(warc.read(spark, path)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
