"""Every operator as a query over the given tables, with the same question in SQL beside it.

A query without SQL has none because its result depends on random projections.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import json as fj
from folioflow.functions import text as ft
from folioflow.functions import vectors as fv
from folioflow.functions.binary import b64_decode, b64_decode_text, b64_encode
from folioflow.operators import cells as ce
from folioflow.operators import chunks as oc
from folioflow.operators import embed as oe
from folioflow.operators import evaluate as ov
from folioflow.operators import events as ev
from folioflow.operators import metadata as om
from folioflow.operators import search as ks
from folioflow.operators import store as st
from folioflow.operators.plugins import per_page
from folioflow.plans import fixtures as fx
from folioflow.plans.evaluation import evaluate
from folioflow.plans.ingest import build_chunks, embed_pages, sheet_chunks, to_page_records
from folioflow.operators.ranking import number_rows
from folioflow.session import scratch_path, written
from folioflow.sources import events as se
from folioflow.sources import records as sr
from folioflow.sources.files import keep_objects
from folioflow.streaming import delivery as sd
from folioflow.streaming import pipeline as sp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return register


# ---------------------------------------------------------------- shared SQL views

FILES = """files AS (
  SELECT 'corpus' AS bucket, doc_id, text, source,
         source || '/' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.png'
                                    WHEN 3 THEN '.xlsx' WHEN 4 THEN '.txt' ELSE '.pdf' END AS name
  FROM documents)"""

ENVELOPES = FILES + """, raw AS (
  SELECT doc_id, '{"bucket":"' || bucket || '","name":"' || name || '"}' AS whole, bucket FROM files
), envelopes AS (
  SELECT doc_id, CASE doc_id % 7 WHEN 1 THEN '!!!'
           WHEN 0 THEN to_base64(encode('{"bucket":"' || bucket || '"}'))
           WHEN 2 THEN to_base64(encode(whole || ' tail'))
           ELSE to_base64(encode(whole)) END AS data
  FROM raw
), texts AS (
  SELECT doc_id, data, decode(TRY(from_base64(data))) AS body FROM envelopes
), decoded AS (
  SELECT doc_id, data, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.bucket') END AS bucket,
         CASE WHEN json_valid(body) THEN json_extract_string(body, '$.name') END AS name
  FROM texts
), events AS (
  SELECT *, CASE WHEN bucket <> '' AND name <> '' THEN 'ok' ELSE 'bad_request' END AS status FROM decoded)"""

PAGES = FILES + """, lines AS (SELECT *, string_split(text, chr(10)) AS l FROM files
), pages AS (
  SELECT doc_id, bucket, name, i + 1 AS page_num, array_to_string(l[i * 20 + 1 : i * 20 + 20], chr(10)) AS page_text,
         'gs://' || bucket || '/' || name AS source_file
  FROM (SELECT *, unnest(range(0, (len(l) + 19) // 20)) AS i FROM lines))"""

EXT = "string_split(lower(name), '.')[-1]"
ROUTE = f"""CASE WHEN {EXT} = 'pdf' THEN 'pdf' WHEN {EXT} IN ('png','jpg','jpeg','gif','bmp') THEN 'image'
  WHEN {EXT} IN ('xls','xlsx') THEN 'sheet' ELSE 'unsupported' END"""

# Whitespace as Python trims it; chr() keeps this text plain.
WS = "||".join(f"chr({ord(c)})" for c in ft.PY_WHITESPACE)


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS})"


def tokens_sql(x: str) -> str:
    return rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def summary_sql(x: str) -> str:
    cut = f"list_transform(string_split_regex({x}, '[.!?。！？]'), lambda s: {strip_sql('s')})"
    return f"coalesce(list_filter({cut}, lambda s: s <> '')[1], '')"


def entities_sql(x: str) -> str:
    found = [f"regexp_extract_all({x}, '{p}')" for p, _ in om.ENTITY_PATTERNS.values()]
    joined = found[0]
    for more in found[1:]:
        joined = f"list_concat({joined}, {more})"
    return f"list_sort(list_distinct({joined}))"


def type_sql(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({x}), '{'|'.join(words)}') THEN '{name}'" for name, words in om.TYPE_RULES)
    return f"CASE {whens} ELSE 'other' END"


def hashed_sql(source: str, key: str, text: str, dim: int = 768) -> str:
    """Views ``{source}_vec(key, dim, v)`` of hashed token vectors, zeros left out."""
    return f"""{source}_tok AS (SELECT {key}, unnest({tokens_sql(text)}) AS w FROM {source}
), {source}_h AS (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM {source}_tok
), {source}_sum AS (
  SELECT {key}, h % {dim} AS dim, sum(1 - 2 * ((h // {dim}) % 2))::DOUBLE AS s FROM {source}_h GROUP BY ALL
), {source}_norm AS (SELECT {key}, sqrt(sum(s * s)) AS n FROM {source}_sum GROUP BY {key}
), {source}_vec AS (
  SELECT {key}, dim, round(s / n, 6)::FLOAT::DOUBLE AS v FROM {source}_sum JOIN {source}_norm USING ({key}) WHERE s <> 0)"""


# ---------------------------------------------------------------- events and files


@query(f"""WITH {FILES}, listing AS (
  SELECT bucket, name FROM files UNION ALL SELECT DISTINCT 'corpus', source || '/' FROM files)
SELECT bucket, name FROM listing WHERE name NOT LIKE '%/'""")
def list_files(spark, sf):
    return keep_objects(fx.listing(spark, sf)).select("bucket", "name")


@query(f"""WITH {FILES}
SELECT name, to_base64(encode('{{"bucket":"' || bucket || '","name":"' || name || '"}}')) AS data FROM files""")
def backfill_events(spark, sf):
    stored = keep_objects(fx.listing(spark, sf))
    sent = se.to_envelopes(stored).select(F.col("message.data").alias("data"))
    return sent.select(fj.json_field(fj.parse_json_strict(b64_decode_text(F.col("data"))), "name").alias("name"), "data")


@query(f"WITH {ENVELOPES} SELECT doc_id, bucket, name, status FROM events")
def decode_events(spark, sf):
    return ev.decode_events(fx.envelopes(spark, sf)).select("doc_id", "bucket", "name", "status")


@query(f"""WITH {FILES} SELECT name, {EXT} AS ext, {ROUTE} AS route,
  CASE WHEN {ROUTE} = 'unsupported' THEN 'unsupported' ELSE 'ok' END AS status FROM files""")
def route_files(spark, sf):
    return ev.route_files(fx.files(spark, sf)).select("name", ft.file_ext(F.col("name")).alias("ext"), "route", "status")


@query(f"""WITH {ENVELOPES}, routed AS (
  SELECT doc_id, name, CASE WHEN status = 'ok' AND {ROUTE} = 'unsupported' THEN 'unsupported' ELSE status END AS status
  FROM events)
SELECT doc_id, name, status, CASE status WHEN 'unsupported' THEN 204 ELSE 400 END AS answer FROM routed WHERE status <> 'ok'""")
def quarantine_files(spark, sf):
    routed = ev.route_files(ev.decode_events(fx.envelopes(spark, sf)))
    _, refused = ev.split_status(routed)
    return refused.select("doc_id", "name", "status", ev.answer_code(F.col("status")).alias("answer"))


FAILURES = """failures AS (SELECT event_id, user_id, CASE event_type
  WHEN 'error' THEN 'ServiceUnavailable: try later' WHEN 'signup' THEN 'api.exceptions.ResourceExhausted: quota'
  WHEN 'click' THEN 'ValueError: broken file' WHEN 'view' THEN 'PermissionDenied: no access' END AS error FROM events
), outcomes AS (SELECT *, CASE WHEN error IS NULL THEN 'ok'
  WHEN regexp_matches(error, '^([^:]*[.])?(DatabaseError|DeadlineExceeded|ServiceUnavailable|ResourceExhausted)(:|$)')
  THEN 'transient' ELSE 'permanent' END AS status FROM failures)"""


@query(f"WITH {FAILURES} SELECT event_id, status, CASE status WHEN 'ok' THEN 204 WHEN 'transient' THEN 503 ELSE 200 END AS answer FROM outcomes")
def classify_error(spark, sf):
    judged = fx.failures(spark, sf).withColumn("status", ev.classify_error(F.col("error")))
    return judged.select("event_id", "status", ev.answer_code(F.col("status")).alias("answer"))


@query(f"WITH {FAILURES} SELECT event_id, event_type, value FROM events WHERE event_id IN (SELECT event_id FROM outcomes WHERE status = 'transient')")
def retry_pending(spark, sf):
    outcomes = fx.failures(spark, sf).withColumn("status", ev.classify_error(F.col("error")))
    inputs = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    return ev.retry_pending(outcomes, inputs, ["event_id"])


@query(f"WITH {FAILURES} SELECT event_id, user_id FROM outcomes WHERE error IS NULL")
def drop_failed(spark, sf):
    return om.drop_failed(fx.failures(spark, sf)).select("event_id", "user_id")


# ---------------------------------------------------------------- text, names, JSON, base64


@query(f"""WITH padded AS (SELECT doc_id, chr(12288) || chr(9) || text || chr(160) || chr(133) || chr(10) AS text FROM documents)
SELECT doc_id, {strip_sql('text')} AS stored, CASE WHEN {strip_sql('text')} = '' THEN '(No text content found on this page)'
  ELSE {strip_sql('text')} END AS shown FROM padded
UNION ALL
SELECT doc_id, {strip_sql("regexp_replace(text, '[^ ]', '', 'g')")}, '(No text content found on this page)' FROM padded""")
def strip_text(spark, sf):
    docs = fx.table(spark, sf, "documents")
    padded = docs.select("doc_id", F.concat(F.lit("　\t"), "text", F.lit("\xa0\x85\n")).alias("text"))
    blank = padded.select("doc_id", F.regexp_replace("text", "[^ ]", "").alias("text"))
    stored = padded.unionByName(blank).select("doc_id", ft.py_strip(F.col("text")).alias("stored"))
    return stored.withColumn("shown", ft.model_text(F.col("stored")))


@query(f"""WITH {PAGES} SELECT name, page_num, 'gs://' || bucket || '/' || name AS uri,
  replace(name, '.pdf', '') || '-page-' AS prefix, replace(name, '.pdf', '') || '-page-' || page_num || '.json' AS object_name FROM pages""")
def page_names(spark, sf):
    name, num = F.col("name"), F.col("page_num")
    return fx.pages(spark, sf).select(
        "name",
        num.cast("bigint").alias("page_num"),
        ft.source_uri(F.col("bucket"), name).alias("uri"),
        ft.page_prefix(name).alias("prefix"),
        ft.page_object_name(name, num).alias("object_name"),
    )


@query(f"""WITH {PAGES}, routed AS (SELECT *, {ROUTE} AS route FROM pages)
SELECT source_file, page_num, 'Content from page ' || page_num || ' of file ' || string_split(source_file, '/')[-1] AS short,
  CASE route WHEN 'image' THEN 'Image file: ' || name
    WHEN 'sheet' THEN 'Content from sheet ''Sheet1'', rows ' || ((page_num - 1) * 20 + 1) || '-' || page_num * 20 || ' in file ' || name
    ELSE 'Content from page ' || page_num || ' of file ' || name END AS long
FROM routed""")
def descriptions(spark, sf):
    num, name = F.col("page_num"), F.col("name")
    uri = ft.source_uri(F.col("bucket"), name)
    label = ft.block_label((num - 1) * 20)
    return fx.pages(spark, sf).select(
        uri.alias("source_file"),
        num.cast("bigint").alias("page_num"),
        ft.page_description(num, uri).alias("short"),
        ft.chunk_description(ft.route(name), name, num, F.lit("Sheet1"), label).alias("long"),
    )


@query("SELECT doc_id, substring(text, 1, 1024) AS text FROM documents")
def truncate_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", ft.truncate_text(F.col("text")).alias("text"))


@query("""WITH raw AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN props || ' tail' WHEN 'view' THEN '{''a'':1}'
    WHEN 'error' THEN props || '] x' ELSE props END AS raw FROM events)
SELECT event_id, json_valid(raw) AS valid, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k')::BIGINT END AS k FROM raw""")
def strict_json(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    raw = (
        F.when(kind == "click", F.concat(props, F.lit(" tail")))
        .when(kind == "view", "{'a':1}")
        .when(kind == "error", F.concat(props, F.lit("] x")))
        .otherwise(props)
    )
    parsed = fx.table(spark, sf, "events").select("event_id", fj.parse_json_strict(raw).alias("v"))
    return parsed.select("event_id", F.col("v").isNotNull().alias("valid"), fj.json_field(F.col("v"), "k", "bigint").alias("k"))


@query("""WITH raw AS (
  SELECT event_id, CASE event_type
    WHEN 'click' THEN 'Answer: {"summary":"' || event_id || ' {' || user_id || '}","meta":' || props || '} done.'
    WHEN 'view' THEN props || ' and ' || props WHEN 'error' THEN 'no object here }{'
    WHEN 'signup' THEN '{"summary":""}' ELSE 'see ' || props END AS raw FROM events
), cut AS (
  SELECT event_id, CASE WHEN strpos(raw, '{') > 0 AND strpos(raw, '}') > 0 THEN
    substr(raw, strpos(raw, '{'), greatest(0, length(raw) - strpos(reverse(raw), '}') + 2 - strpos(raw, '{'))) END AS obj FROM raw)
SELECT event_id, obj, coalesce(json_valid(obj), false) AS valid,
  CASE WHEN json_valid(obj) THEN json_extract_string(obj, '$.summary') END AS summary,
  coalesce(CASE WHEN json_valid(obj) THEN json_extract_string(obj, '$.summary') END <> '', false) AS usable FROM cut""")
def lenient_json(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    raw = (
        F.when(kind == "click", F.concat(F.lit('Answer: {"summary":"'), "event_id", F.lit(" {"), "user_id", F.lit('}","meta":'), props, F.lit("} done.")))
        .when(kind == "view", F.concat(props, F.lit(" and "), props))
        .when(kind == "error", "no object here }{")
        .when(kind == "signup", '{"summary":""}')
        .otherwise(F.concat(F.lit("see "), props))
    )
    cut = fx.table(spark, sf, "events").select("event_id", fj.extract_json_object(raw).alias("obj"))
    parsed = cut.withColumn("v", fj.parse_json_strict(F.col("obj")))
    return parsed.select(
        "event_id",
        "obj",
        F.col("v").isNotNull().alias("valid"),
        fj.json_field(F.col("v"), "summary").alias("summary"),
        fj.has_summary(F.col("v")).alias("usable"),
    )


@query("""SELECT doc_id, to_base64(encode(text)) AS data, md5(text) AS back FROM documents
UNION ALL SELECT page_id, to_base64(encode(html)), md5(html) FROM pages""")
def base64_roundtrip(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    html = fx.table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    coded = docs.unionByName(html).select("doc_id", b64_encode(F.encode("text", "UTF-8")).alias("data"))
    return coded.select("doc_id", "data", F.md5(b64_decode(F.col("data"))).alias("back"))


# ---------------------------------------------------------------- pages and blocks


@query(f"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
), pages AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS page_num, unnest(l) AS t FROM split)
SELECT doc_id, page_num, {strip_sql('t')} AS page_text FROM pages""")
def explode_pages(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return oc.explode_pages(docs, sep="\n").withColumn("page_num", F.col("page_num").cast("bigint"))


@query(f"WITH {PAGES} SELECT doc_id, page_num, page_text FROM pages")
def line_blocks(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return oc.line_blocks(docs).withColumn("page_num", F.col("page_num").cast("bigint"))


def sheet_sql(table: str, part: str, order: str, cells: str) -> str:
    return f"""WITH numbered AS (
  SELECT {part} AS sheet, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn, concat_ws(chr(9), {cells}) AS line FROM {table}
), blocks AS (
  SELECT sheet, (rn - 1) // 20 AS block, max(rn) AS last_row, string_agg(line, chr(10) ORDER BY rn) AS text FROM numbered GROUP BY ALL)
SELECT sheet, block, block * 20 + 1 AS first_row, last_row, 'rows ' || (block * 20 + 1) || '-' || (block * 20 + 20) AS label, text
FROM blocks WHERE {strip_sql('text')} <> ''"""


LINE_CELLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
LINE_CELLS_SQL = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in LINE_CELLS)


def _sheet(spark, sf, **options):
    sheet = fx.table(spark, sf, "lineitem")
    blocks = oc.drop_blank_blocks(oc.row_blocks(sheet, "l_returnflag", LINE_CELLS, LINE_CELLS, **options))
    return blocks.withColumnRenamed("l_returnflag", "sheet")


@query(sheet_sql("lineitem", "l_returnflag", ", ".join(LINE_CELLS), LINE_CELLS_SQL))
def sheet_blocks(spark, sf):
    return _sheet(spark, sf)


@query(ORACLE["sheet_blocks"])
def sheet_blocks_sliced(spark, sf):
    """The same through the path for sheets larger than one task."""
    return _sheet(spark, sf, slices=37)


@query(sheet_sql("part", "p_brand", "p_partkey", "p_partkey::VARCHAR, p_name, p_type, p_size::VARCHAR, p_retailprice::VARCHAR"))
def sheet_blocks_by_brand(spark, sf):
    cells = ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"]
    blocks = oc.row_blocks(fx.table(spark, sf, "part"), "p_brand", ["p_partkey"], cells)
    return oc.drop_blank_blocks(blocks).withColumnRenamed("p_brand", "sheet")


@query(f"""WITH {PAGES} SELECT source_file, (page_num - 1) // 3 AS batch, count(*) AS n_pages,
  string_agg(page_text, chr(12) ORDER BY page_num) AS text FROM pages GROUP BY ALL""")
def batch_by_file(spark, sf):
    pages = fx.keyed_pages(spark, sf)
    batches = oc.batch_by_file(pages, ["source_file", "part"], size=3)
    text = F.array_join(F.transform("pages", lambda p: p["page_text"]), "\f")
    return batches.select("source_file", "batch", F.col("n_pages").cast("bigint").alias("n_pages"), text.alias("text"))


# ---------------------------------------------------------------- metadata

@query(f"WITH {PAGES} SELECT source_file, page_num, {summary_sql('page_text')} AS summary FROM pages")
def lead_summary(spark, sf):
    return fx.keyed_pages(spark, sf).select("source_file", F.col("page_num").cast("bigint").alias("page_num"), om.lead_summary(F.col("page_text")).alias("summary"))


@query(f"SELECT doc_id, array_to_string({entities_sql('text')}, '|') AS entities FROM documents UNION ALL SELECT page_id, array_to_string({entities_sql('html')}, '|') FROM pages")
def pattern_entities(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    html = fx.table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    return docs.unionByName(html).select("doc_id", F.array_join(om.pattern_entities(F.col("text")), "|").alias("entities"))


@query(f"SELECT doc_id, {type_sql('text')} AS document_type FROM documents")
def rule_type(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", om.rule_type(F.col("text")).alias("document_type"))


def keywords_sql(source: str, key: str, text: str) -> str:
    return f"""kw_w AS (SELECT {key}, unnest({tokens_sql(text)}) AS word FROM {source}
), kw_tf AS (SELECT {key}, word, count(*) AS tf FROM kw_w GROUP BY ALL
), kw_df AS (SELECT word, count(*) AS df FROM kw_tf GROUP BY word
), kw_score AS (
  SELECT {key}, word, round(tf * ln(((SELECT count(*) FROM {source}) + 1)::DOUBLE / (df + 1)), 6) AS score FROM kw_tf JOIN kw_df USING (word)
), kw_rank AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, word) AS rank FROM kw_score
), kw AS (SELECT {key}, string_agg(word, '|' ORDER BY rank) AS keywords FROM kw_rank WHERE rank <= 5 GROUP BY {key})"""


@query(f"WITH {keywords_sql('documents', 'doc_id', 'text')} SELECT doc_id, keywords FROM kw")
def top_keywords(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return om.top_keywords(docs, ["doc_id"], "text").withColumn("keywords", F.array_join("keywords", "|"))


@query(f"""WITH {PAGES}, {keywords_sql('pages', 'source_file, page_num', 'page_text')}
SELECT source_file, page_num, {summary_sql('page_text')} AS summary, array_to_string({entities_sql('page_text')}, '|') AS entities,
  {type_sql('page_text')} AS document_type, coalesce(keywords, '') AS keywords FROM pages LEFT JOIN kw USING (source_file, page_num)""")
def metadata_json(spark, sf):
    """Default metadata, written to JSON text and read back."""
    pages = om.extract_metadata(fx.keyed_pages(spark, sf))
    text = pages.select("source_file", F.col("page_num").cast("bigint").alias("page_num"), om.metadata_json().alias("raw"))
    back = text.withColumn("m", om.metadata_from_text(F.col("raw"), strict=True))
    # An empty summary reads back as no metadata; the other fields come from the text itself.
    value = fj.parse_json_strict(F.col("raw"))
    listed = lambda name: F.array_join(F.try_variant_get(value, f"$.{name}", "array<string>"), "|")
    return back.select(
        "source_file",
        "page_num",
        F.coalesce("m.summary", F.lit("")).alias("summary"),
        listed("extracted_entities").alias("entities"),
        fj.json_field(value, "document_type").alias("document_type"),
        listed("keywords").alias("keywords"),
    )


def _model(batches):
    """A stand-in for a hosted model: answers in JSON with chatter, and fails on pages that start with 'A'."""

    def ask(text, image):
        if text.startswith("A"):
            raise ValueError("cannot read this page")
        first = text.split()[0]
        return f"Here you are: {json.dumps({'summary': first, 'document_type': 'page', 'keywords': [first]}, ensure_ascii=False)} Bye."

    yield from per_page(ask, "metadata_raw")(batches)


@query(rf"""WITH {PAGES}, shown AS (SELECT *, list_filter(string_split_regex(page_text, '[ \t\n\x0b\x0c\r]+'), lambda w: w <> '')[1] AS w FROM pages)
SELECT source_file, page_num, CASE WHEN page_text NOT LIKE 'A%' THEN w END AS summary,
  CASE WHEN page_text NOT LIKE 'A%' THEN 'page' END AS document_type,
  CASE WHEN page_text LIKE 'A%' THEN 'permanent' ELSE 'ok' END AS status FROM shown""")
def metadata_plugin(spark, sf):
    """Metadata by a plug-in: chatter around the JSON, single failing pages."""
    asked = om.extract_metadata(fx.keyed_pages(spark, sf), _model, batch_rows=64)
    return asked.select(
        "source_file",
        F.col("page_num").cast("bigint").alias("page_num"),
        F.col("metadata.summary").alias("summary"),
        F.col("metadata.document_type").alias("document_type"),
        ev.classify_error(F.col("error")).alias("status"),
    )


def _seeing_model(batches):
    """Stands for a model that is shown an image, a text, or both."""

    def ask(text, image):
        seen = "no image" if image is None else f"image of {len(image)} bytes"
        return json.dumps({"summary": f"{seen}; {text}", "document_type": "image" if image is not None else "text"}, ensure_ascii=False)

    yield from per_page(ask, "metadata_raw")(batches)


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'image of ' || strlen(html) || ' bytes; (No text content found on this page)'
    WHEN 1 THEN 'no image; ' || url ELSE 'image of ' || strlen(html) || ' bytes; ' || url END AS summary,
  CASE page_id % 3 WHEN 1 THEN 'text' ELSE 'image' END AS document_type, 'ok' AS status FROM pages""")
def metadata_of_images_and_texts(spark, sf):
    """Metadata of pages that are an image only, a text only, or both."""
    kind = F.col("page_id") % 3
    pages = fx.table(spark, sf, "pages").select(
        "page_id",
        F.concat(F.lit("gs://web/"), F.col("page_id").cast("string")).alias("source_file"),
        F.lit("").alias("part"),
        F.lit(0).alias("page_num"),
        F.when(kind == 0, "").otherwise(F.col("url")).alias("page_text"),
        F.when(kind != 1, F.encode("html", "UTF-8")).alias("image"),
    )
    told = om.extract_metadata(pages, _seeing_model, batch_rows=32)
    return told.select("page_id", F.col("metadata.summary").alias("summary"), F.col("metadata.document_type").alias("document_type"), ev.classify_error(F.col("error")).alias("status"))


@query(f"WITH {PAGES} SELECT source_file, page_num, {summary_sql('page_text')} AS summary FROM pages WHERE {summary_sql('page_text')} <> ''")
def require_summary(spark, sf):
    told = fx.keyed_pages(spark, sf).withColumn("summary", om.lead_summary(F.col("page_text")))
    return om.require_summary(told, "summary").select("source_file", F.col("page_num").cast("bigint").alias("page_num"), "summary")


# ---------------------------------------------------------------- vectors


def _long(df: DataFrame, key: str, vec: str) -> DataFrame:
    return (
        df.select(key, F.posexplode(vec).alias("dim", "v"))
        .filter(F.col("v") != 0)
        .select(key, F.col("dim").cast("bigint").alias("dim"), F.round(F.col("v").cast("double"), 6).alias("v"))
    )


@query(f"WITH {hashed_sql('documents', 'doc_id', 'text')} SELECT doc_id, dim, round(v, 6) AS v FROM documents_vec WHERE v <> 0")
def hash_embed(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return _long(oe.embed_text(docs, text="text"), "doc_id", "text_embedding")


BYTE_PAIRS = """bytes AS (
  SELECT page_id, list_transform(regexp_extract_all(hex(encode(html)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM pages
), pairs AS (SELECT page_id, unnest(b[1:-2]) AS x, unnest(b[2:]) AS y FROM bytes
), pair_sum AS (SELECT page_id, (x * 256 + y) % 1408 AS dim, count(*)::DOUBLE AS s FROM pairs GROUP BY ALL
), pair_norm AS (SELECT page_id, sqrt(sum(s * s)) AS n FROM pair_sum GROUP BY page_id
), pair_vec AS (SELECT page_id, dim, round(s / n, 6)::FLOAT::DOUBLE AS v FROM pair_sum JOIN pair_norm USING (page_id))"""


@query(f"WITH {BYTE_PAIRS} SELECT page_id, dim, round(v, 6) AS v FROM pair_vec WHERE v <> 0")
def binary_embed(spark, sf):
    raw = fx.table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("image"))
    return _long(oe.embed_binary(raw), "page_id", "multimodal_embedding")


@query(f"""WITH {BYTE_PAIRS}, {hashed_sql('pages', 'page_id', 'url', 1408)}, both_sum AS (
  SELECT page_id, dim, sum(v) AS s FROM (SELECT * FROM pair_vec UNION ALL SELECT * FROM pages_vec) GROUP BY ALL
), both_norm AS (SELECT page_id, sqrt(sum(s * s)) AS n FROM both_sum GROUP BY page_id)
SELECT page_id, dim, round(round(s / n, 6)::FLOAT::DOUBLE, 4) AS v FROM both_sum JOIN both_norm USING (page_id)
WHERE round(round(s / n, 6)::FLOAT::DOUBLE, 4) <> 0""")
def multimodal_embed(spark, sf):
    """Bytes and text in one vector, shown to four digits: the parts are single precision."""
    raw = fx.table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("image"), F.col("url").alias("page_text"))
    told = oe.embed_multimodal(raw).select("page_id", F.posexplode("multimodal_embedding").alias("dim", "v"))
    shown = F.round(F.col("v").cast("double"), 4)
    return told.select("page_id", F.col("dim").cast("bigint").alias("dim"), shown.alias("v")).filter(F.col("v") != 0)


@query("""SELECT vec_id, len(embedding) = 64 AS fits, len(embedding) = 768 AS fits_text FROM embeddings
UNION ALL SELECT vec_id, false, false FROM embeddings UNION ALL SELECT vec_id, false, false FROM embeddings""")
def check_dim(spark, sf):
    whole = fx.table(spark, sf, "embeddings").select("vec_id", "embedding")
    short = whole.select("vec_id", F.slice("embedding", 1, 63).alias("embedding"))
    nan = whole.select("vec_id", F.concat(F.slice("embedding", 1, 63), F.array(F.lit(float("nan")).cast("float"))).alias("embedding"))
    every = whole.unionByName(short).unionByName(nan)
    return every.select("vec_id", fv.check_dim(F.col("embedding"), 64).alias("fits"), fv.check_dim(F.col("embedding"), 768).alias("fits_text"))


@query("SELECT vec_id, i - 1 AS dim, round(embedding[i]::DOUBLE, 6) AS v FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)")
def vector_text(spark, sf):
    """Vectors to text and back."""
    text = fx.table(spark, sf, "embeddings").select("vec_id", fv.vector_to_text(F.col("embedding")).alias("t"))
    back = text.select("vec_id", F.posexplode(fv.vector_from_text(F.col("t"), 64)).alias("dim", "v"))
    return back.select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("v").cast("double"), 6).alias("v"))


# ---------------------------------------------------------------- store


@query("""SELECT vec_id, label, i - 1 AS dim, round(embedding[i]::DOUBLE, 6) AS text_v, round(embedding[65 - i]::DOUBLE, 6) AS image_v
  FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)""")
def attach_vectors(spark, sf):
    vec = fx.vectors(spark, sf)
    key = [F.concat(F.lit("s"), F.col("label").cast("string")).alias("source_file"), F.lit("").alias("part"), F.col("id").alias("page_num")]
    whole = st.attach_vectors(vec.select(*key, "label"), vec.select(*key, "text_embedding"), vec.select(*key, "multimodal_embedding"))
    both = F.arrays_zip(F.col("text_embedding").alias("t"), F.col("multimodal_embedding").alias("m"))
    return whole.select(F.col("page_num").alias("vec_id"), "label", F.posexplode(both).alias("dim", "v")).select(
        "vec_id",
        "label",
        F.col("dim").cast("bigint").alias("dim"),
        F.round(F.col("v.t").cast("double"), 6).alias("text_v"),
        F.round(F.col("v.m").cast("double"), 6).alias("image_v"),
    )


CHUNKS = PAGES + f""", routed AS (SELECT *, {ROUTE} AS route FROM pages
), chunks AS (
  SELECT doc_id, name, source_file, route, '' AS part, page_num, {strip_sql('page_text')} AS page_text,
    'Content from page ' || page_num || ' of file ' || name AS chunk_description FROM routed WHERE route = 'pdf'
  UNION ALL SELECT doc_id, name, source_file, route, 'Sheet1', page_num, {strip_sql('page_text')},
    'Content from sheet ''Sheet1'', rows ' || ((page_num - 1) * 20 + 1) || '-' || page_num * 20 || ' in file ' || name
    FROM routed WHERE route = 'sheet' AND {strip_sql('page_text')} <> ''
  UNION ALL SELECT doc_id, name, 'gs://' || bucket || '/' || name, 'image', '', 0, '', 'Image file: ' || name FROM files WHERE {ROUTE} = 'image')"""


def _chunks(spark, sf):
    """Chunks of all files; an image's bytes are those of its document."""
    files = fx.files(spark, sf)
    return build_chunks(files.withColumn("content", F.when(F.col("name").endswith(".png"), F.col("text").cast("binary"))), page_lines=20)


SHEETS = sheet_sql("lineitem", "l_returnflag", ", ".join(LINE_CELLS), LINE_CELLS_SQL)


@query(f"""WITH {CHUNKS} SELECT source_file, part, page_num, route, page_text, chunk_description FROM chunks
UNION ALL SELECT 'gs://corpus/tables/lineitem.xlsx', sheet, block + 1, 'sheet', {strip_sql('text')},
  'Content from sheet ' || chr(39) || sheet || chr(39) || ', ' || label || ' in file tables/lineitem.xlsx' FROM ({SHEETS})""")
def build_all_chunks(spark, sf):
    """All routes in one table, with the sheets of an ordered table under their names."""
    sheets = sheet_chunks(_sheet(spark, sf), fx.BUCKET, "tables/lineitem.xlsx")
    return oc.union_chunks(_chunks(spark, sf), sheets).select("source_file", "part", F.col("page_num").cast("bigint").alias("page_num"), "route", "page_text", "chunk_description")


@query(f"""WITH {CHUNKS}, described AS (SELECT *, {summary_sql('page_text')} AS summary FROM chunks)
SELECT sha256(source_file || '|' || part || '|' || page_num) AS id, source_file, part, page_num, chunk_description, summary,
  768 AS text_dims FROM described WHERE summary <> '' ORDER BY source_file, part, page_num""")
def store_rows(spark, sf):
    """Files of all routes to store rows, in page order."""
    records = to_page_records(om.extract_metadata(_chunks(spark, sf)))
    good, _ = ev.split_status(embed_pages(records, with_text=True))
    shown = good.select(
        "id",
        "source_file",
        "part",
        F.col("page_num").cast("bigint").alias("page_num"),
        "chunk_description",
        fj.json_field(F.try_parse_json("metadata"), "summary").alias("summary"),
        F.size("text_embedding").alias("text_dims"),
    )
    # Sorting reads its input twice.
    return oc.order_pages(written(shown, "shown"))


@query("""SELECT 'doc' AS kind, doc_id, CASE WHEN length(text) > 1024 THEN 'source_too_long' ELSE 'ok' END AS status FROM documents
UNION ALL SELECT 'page', page_id, 'no_source' FROM pages UNION ALL SELECT 'vector', vec_id, 'bad_text_embedding' FROM embeddings""")
def check_store_row(spark, sf):
    """Whole texts as source names, pages without one, vectors of the wrong size."""
    none = F.lit(None).cast("array<float>")
    docs = fx.table(spark, sf, "documents").select(F.lit("doc").alias("kind"), "doc_id", F.col("text").alias("source_file"), none.alias("text_embedding"))
    lost = fx.table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("doc_id"), F.lit(None).cast("string").alias("source_file"), none.alias("text_embedding"))
    wrong = fx.table(spark, sf, "embeddings").select(F.lit("vector").alias("kind"), F.col("vec_id").alias("doc_id"), F.lit("s").alias("source_file"), F.col("embedding").alias("text_embedding"))
    return st.check_store_row(oc.union_chunks(docs, lost, wrong)).select("kind", "doc_id", "status")


DONE = f"""done AS (SELECT source_file, page_num, replace(name, '.pdf', '') || '-page-' || page_num || '.json' AS object_name
  FROM pages JOIN labels USING (doc_id) WHERE toxic = 0 AND (quality = 1 OR page_num = 1))"""


def _done(spark, sf):
    labels = fx.table(spark, sf, "labels").filter("toxic = 0").select("doc_id", "quality")
    pages = fx.pages(spark, sf).join(labels, "doc_id").filter("quality = 1 OR page_num = 1")
    return pages.select(
        ft.source_uri(F.col("bucket"), F.col("name")).alias("source_file"),
        F.lit("").alias("part"),
        "page_num",
        ft.page_object_name(F.col("name"), F.col("page_num")).alias("object_name"),
    )


@query(f"""WITH {PAGES}, {DONE} SELECT doc_id, name FROM files WHERE NOT EXISTS (
  SELECT 1 FROM done WHERE starts_with(object_name, replace(name, '.pdf', '') || '-page-'))""")
def skip_done_prefix(spark, sf):
    return st.skip_done(fx.files(spark, sf), _done(spark, sf), "prefix").select("doc_id", "name")


@query(f"""WITH {PAGES}, {DONE} SELECT source_file, page_num, page_text FROM pages p WHERE NOT EXISTS (
  SELECT 1 FROM done d WHERE d.source_file = p.source_file AND d.page_num = p.page_num)""")
def skip_done_page(spark, sf):
    todo = st.skip_done(fx.keyed_pages(spark, sf), _done(spark, sf), "page")
    return todo.select("source_file", F.col("page_num").cast("bigint").alias("page_num"), "page_text")


LOADS = """loads AS (
  SELECT doc_id, 0 AS batch_id, text FROM documents
  UNION ALL SELECT doc_id, 1, text || ' again' FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT doc_id, 2, text || ' and again' FROM documents JOIN labels USING (doc_id) WHERE quality = 0)"""


def _loads(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    labels = fx.table(spark, sf, "labels")

    def load(batch, rows, tail):
        return rows.select("doc_id", F.lit(batch).cast("bigint").alias("batch_id"), F.concat("text", F.lit(tail)).alias("text"))

    second, third = docs.join(labels, "doc_id"), docs.join(labels.filter("quality = 0"), "doc_id")
    return load(0, docs, "").unionByName(load(1, second, " again")).unionByName(load(2, third, " and again"))


@query(f"WITH {LOADS} SELECT doc_id, max(batch_id)::BIGINT AS batch_id, arg_max(text, batch_id) AS text FROM loads GROUP BY doc_id")
def upsert_latest(spark, sf):
    return st.latest_per_key(_loads(spark, sf), ["doc_id"], ["batch_id"])


@query(f"""WITH {CHUNKS}, statuses AS (SELECT source_file, CASE WHEN {summary_sql('page_text')} = '' THEN 'no_summary' ELSE 'ok' END AS status FROM chunks)
SELECT source_file, status, count(*) AS n FROM statuses GROUP BY ALL""")
def ingest_report(spark, sf):
    told = _chunks(spark, sf).withColumn("summary", om.lead_summary(F.col("page_text")))
    return st.ingest_report(told.withColumn("status", F.when(F.col("summary") == "", "no_summary").otherwise("ok")))


# ---------------------------------------------------------------- retrieval


def knn_sql(vec: str) -> str:
    return f"""WITH v AS (SELECT vec_id, list_transform({vec}, lambda x: x::DOUBLE) AS e FROM embeddings
), d AS (SELECT a.vec_id AS qid, b.vec_id AS cid, round(list_distance(a.e, b.e), 6) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rank FROM d)
SELECT qid, cid, rank, dist FROM r WHERE rank <= 5"""


def _knn(spark, sf, **options):
    vec = fx.vectors(spark, sf)
    hits = ks.knn(vec, vec, 5, "id", "id", dim=64, other_only=True, **options)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query(knn_sql("embedding"))
def knn_l2(spark, sf):
    """Five nearest other vectors of every stored vector."""
    return _knn(spark, sf)


@query(knn_sql("list_reverse(embedding)"))
def knn_second_vector(spark, sf):
    return _knn(spark, sf, vec="multimodal_embedding")


@query(ORACLE["knn_l2"])
def knn_by_pivots(spark, sf):
    """The same through pivot cells and the triangle inequality."""
    vec = fx.vectors(spark, sf)
    asked, stored = written(vec.select(F.col("id").alias("qid"), F.col("text_embedding").alias("vec")), "asked"), vec.select(F.col("id").alias("cid"), F.col("text_embedding").alias("vec"))
    hits = ks.knn_by_pivots(asked, written(stored, "stored"), 5, 64, True, 256, 4)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query(ORACLE["knn_l2"])
def knn_by_bounds(spark, sf):
    """The same through the path for query sets too large to broadcast."""
    return _knn(spark, sf, broadcast_bytes=0, block_rows=256)


# The same hyperplanes by md5, and the exact rank of the vectors that share a bucket.
@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), planes AS (
  SELECT p, list(1.0::DOUBLE - 2 * (instr('0123456789abcdef', md5('42:' || p || ':' || d)[1]) % 2 = 0)::INT ORDER BY d) AS w
  FROM range(24) a(p), range(64) b(d) GROUP BY p
), sides AS (SELECT vec_id, p // 3 AS t, p % 3 AS bit, (list_dot_product(e, w) >= 0)::BIGINT AS side FROM v, planes
), buckets AS (SELECT vec_id, t, sum(side << bit) AS cell FROM sides GROUP BY ALL
), pairs AS (SELECT DISTINCT a.vec_id AS qid, b.vec_id AS cid FROM buckets a JOIN buckets b USING (t, cell) WHERE a.vec_id <> b.vec_id
), d AS (SELECT qid, cid, round(list_distance(a.e, b.e), 6) AS dist FROM pairs JOIN v a ON a.vec_id = qid JOIN v b ON b.vec_id = cid
), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rank FROM d)
SELECT qid, cid, rank, dist FROM r WHERE rank <= 5""")
def knn_lsh(spark, sf):
    """Approximate neighbours: eight tables of three hyperplanes."""
    vec = fx.vectors(spark, sf)
    hits = ks.knn_lsh(vec, vec, 5, "id", "id", dim=64, bits=3, other_only=True)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


def floored(total: str, n: str) -> str:
    """Integer division that rounds down."""
    return f"(({total} - (({total} % {n}) + {n}) % {n}) // {n})::BIGINT"


def cells_sql(cells: int, codes: int, run: int, rounds: int, scale: int, probes: int, shortlist: int, dim: int = 64, k: int = 5) -> str:
    """The trained index as relations: integers, centroids round by round, codebooks, codes, estimates, exact ranks."""
    steps = [f"""v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
, xs AS MATERIALIZED (SELECT vec_id, d, greatest(-65536, least(65536, floor({scale} * e[d + 1])))::BIGINT AS x FROM v, range({dim}) t(d))
, seq AS (SELECT vec_id, row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS n FROM v)
, c0 AS MATERIALIZED (SELECT n AS c, d, x AS w FROM seq JOIN xs USING (vec_id) WHERE n < {cells})"""]

    def near(rows: str, centres: str, by: str, number: str, size: int, at: str) -> str:
        far = f"SELECT {by}, {number}, sum((x - w) * (x - w))::BIGINT AS f FROM {rows} JOIN {centres} USING ({at}) GROUP BY ALL"
        return f"AS MATERIALIZED (SELECT {by}, min(f * {size} + {number}) % {size} AS {number} FROM ({far}) GROUP BY {by})"

    for i in range(rounds + 1):
        steps.append(f"a{i} {near('xs', f'c{i}', 'vec_id', 'c', cells, 'd')}")
        if i < rounds:
            steps.append(f"m{i} AS (SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN xs USING (vec_id) GROUP BY ALL)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c, d, {floored('s', 'n')} AS w FROM m{i} UNION ALL SELECT c, d, w FROM c{i} WHERE c NOT IN (SELECT c FROM m{i}))")
    steps.append(f"""rest AS MATERIALIZED (SELECT vec_id, d // {run} AS p, d, x - w AS x FROM xs JOIN a{rounds} USING (vec_id) JOIN c{rounds} USING (c, d))
, b0 AS MATERIALIZED (SELECT p, n AS k, d, x AS w FROM rest JOIN seq USING (vec_id) WHERE n < {codes})""")
    for i in range(rounds + 1):
        steps.append(f"e{i} {near('rest', f'b{i}', 'vec_id, p', 'k', codes, 'p, d')}")
        if i < rounds:
            steps.append(f"g{i} AS (SELECT p, k, d, sum(x)::BIGINT AS s, count(*) AS n FROM e{i} JOIN rest USING (vec_id, p) GROUP BY ALL)")
            steps.append(f"b{i + 1} AS MATERIALIZED (SELECT p, k, d, {floored('s', 'n')} AS w FROM g{i} UNION ALL SELECT p, k, d, w FROM b{i} WHERE (p, k) NOT IN (SELECT p, k FROM g{i}))")
    steps.append(f"""far AS (SELECT vec_id AS qid, c, sum((x - w) * (x - w)) AS f FROM xs JOIN c{rounds} USING (d) GROUP BY ALL)
, probed AS (SELECT qid, c FROM far QUALIFY row_number() OVER (PARTITION BY qid ORDER BY f, c) <= {probes})
, tables AS (SELECT qid, c, p, k, sum((x - m.w - b.w) * (x - m.w - b.w)) AS f
    FROM probed JOIN xs ON vec_id = qid JOIN c{rounds} m USING (c, d) JOIN b{rounds} b USING (d) GROUP BY ALL)
, chunks AS (SELECT vec_id AS cid, c, p, k FROM a{rounds} JOIN e{rounds} USING (vec_id))
, estimates AS (SELECT qid, cid, sum(f) AS f FROM tables JOIN chunks USING (c, p, k) WHERE qid <> cid GROUP BY ALL)
, short AS (SELECT qid, cid FROM estimates QUALIFY row_number() OVER (PARTITION BY qid ORDER BY f, cid) <= {shortlist})
, ranked AS (SELECT qid, cid, round(list_distance(a.e, b.e), 6) AS dist FROM short JOIN v a ON a.vec_id = qid JOIN v b ON b.vec_id = cid)
SELECT * FROM (SELECT qid, cid, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rank, dist FROM ranked) WHERE rank <= {k}""")
    return "WITH " + "\n, ".join(steps)


# Small and fixed, so that SQL can follow; a user leaves these to the index.
CELL_SETTINGS = {"cells": 16, "codes": 8, "run": 8, "rounds": 3, "scale": 4096, "probes": 8, "shortlist": 60}


def _knn_cells(spark, sf, **options):
    vec = fx.vectors(spark, sf)
    hits = ce.build_index(vec, dim=64, **CELL_SETTINGS).search(vec, 5, "id", other_only=True, **options)
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query(cells_sql(**CELL_SETTINGS))
def knn_cells(spark, sf):
    """Approximate neighbours by trained cells and codes."""
    return _knn_cells(spark, sf)


@query(ORACLE["knn_cells"])
def knn_cells_large(spark, sf):
    """The same through the path for query sets too large to broadcast."""
    return _knn_cells(spark, sf, broadcast_bytes=0, block_rows=64)


def _page_vectors(spark, sf):
    return oe.embed_text(fx.keyed_pages(spark, sf).withColumn("id", st.chunk_id()), text="page_text")


def retrieval_sql(questions: str, qid: str) -> str:
    """Ten-line views: distances of hashed question and page vectors, best five pages per question."""
    return f"""{hashed_sql('questions', 'qid', 'question')}, {hashed_sql('chunks', 'cid', 'page_text')}
, q_len AS (SELECT qid, coalesce(sum(v * v), 0) AS n FROM questions LEFT JOIN questions_vec USING (qid) GROUP BY qid
), c_len AS (SELECT cid, coalesce(sum(v * v), 0) AS n FROM chunks LEFT JOIN chunks_vec USING (cid) GROUP BY cid
), dots AS (SELECT qid, cid, sum(q.v * c.v) AS dot FROM questions_vec q JOIN chunks_vec c USING (dim) GROUP BY ALL
), dist AS (
  SELECT q.qid, c.cid, round(sqrt(greatest(q.n + c.n - 2 * coalesce(dot, 0), 0)), 6) AS dist
  FROM q_len q CROSS JOIN c_len c LEFT JOIN dots USING (qid, cid)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rank FROM dist
), hits AS (SELECT * FROM ranked WHERE rank <= 5)"""


PAGE_CHUNKS = "chunks AS (SELECT sha256(source_file || '||' || page_num) AS cid, page_text FROM pages)"
PASSAGES = f"""WITH {PAGES}, {PAGE_CHUNKS}, questions AS (SELECT item_id AS qid, text AS question FROM benchmark), {retrieval_sql('benchmark', 'item_id')}"""


def _passage_hits(spark, sf):
    asked = fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return ks.knn(oe.embed_text(asked, text="text"), _page_vectors(spark, sf), 5)


@query(f"{PASSAGES} SELECT qid, cid, rank, dist FROM hits")
def retrieve_passages(spark, sf):
    """Benchmark passages as questions, all document pages as the index."""
    return _passage_hits(spark, sf).withColumn("rank", F.col("rank").cast("bigint"))


@query(f"{PASSAGES} SELECT qid, string_agg(page_text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits JOIN chunks USING (cid) GROUP BY qid")
def build_context(spark, sf):
    texts = fx.keyed_pages(spark, sf).withColumn("id", st.chunk_id())
    return ks.build_context(_passage_hits(spark, sf), texts, "id", "page_text")


# ---------------------------------------------------------------- evaluation

PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS question, lead(text) OVER w AS golden_answer, role, lead(role) OVER w AS next_role
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), questions AS (
  SELECT conv_id || ':' || turn AS qid, question, golden_answer FROM pairs WHERE role = 'user' AND next_role = 'assistant')"""


def graded_sql(answers: str) -> str:
    """``graded(qid, question, golden_answer, answer, score, reason)`` from ``answers(qid, answer)``."""
    return f"""sets AS (
  SELECT q.*, answer, list_distinct({tokens_sql("coalesce(answer, '')")}) AS said, list_distinct({tokens_sql("coalesce(golden_answer, '')")}) AS gold
  FROM questions q JOIN {answers} USING (qid)
), counted AS (SELECT *, len(list_intersect(said, gold)) AS shared, len(said) AS ns, len(gold) AS ng FROM sets
), graded AS (
  SELECT *, (1 + round(4 * CASE WHEN ns + ng > 0 THEN round(2.0::DOUBLE * shared / (ns + ng), 6) ELSE 0 END))::BIGINT AS score,
    shared || ' tokens shared, ' || ns || ' in the answer, ' || ng || ' in the golden answer' AS reason FROM counted)"""


def _questions(spark, sf):
    pairs = ov.turn_pairs(fx.table(spark, sf, "conversations"))
    named = pairs.withColumn("qid", F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")))
    return ov.eval_set(named, "question", "golden_answer", "qid")


@query(f"WITH {PAIRS} SELECT qid AS question_id, question, golden_answer FROM questions")
def eval_set(spark, sf):
    return _questions(spark, sf)


@query(f"""WITH {PAIRS}, told AS (SELECT qid, golden_answer || ' ' || question AS answer FROM questions), {graded_sql('told')}
SELECT qid AS question_id, score, reason, CASE WHEN score BETWEEN 1 AND 5 THEN 'ok' ELSE 'bad_score' END AS status FROM graded""")
def grade_answers(spark, sf):
    """Golden answers with the question's words mixed in, graded by token overlap."""
    questions = _questions(spark, sf)
    answers = questions.select("question_id", F.concat("golden_answer", F.lit(" "), "question").alias("answer"))
    return ov.grade(questions, answers).select("question_id", "score", "reason", "status")


def _judge_model(batches):
    """A stand-in for a judge model: the number of words of the answer as score, right or not."""
    for batch in batches:
        scores = batch["answer"].str.split().str.len()
        yield pd.DataFrame({"grade_raw": [json.dumps({"score": int(n), "reason": f"{n} words"}) if n != 4 else "score: 4" for n in scores]})


@query(rf"""WITH {PAIRS}, told AS (SELECT qid, len(list_filter(string_split_regex(golden_answer, '[ \t\n\x0b\x0c\r]+'), lambda w: w <> '')) AS n FROM questions)
SELECT qid AS question_id, CASE WHEN n <> 4 THEN n END AS score, CASE WHEN n <> 4 THEN n || ' words' END AS reason,
  CASE WHEN n <> 4 AND n BETWEEN 1 AND 5 THEN 'ok' ELSE 'bad_score' END AS status FROM told""")
def judge_plugin(spark, sf):
    """A judge plug-in whose scores may leave the scale or be no JSON."""
    answered = _questions(spark, sf).withColumn("answer", F.col("golden_answer"))
    return ov.judge(answered, _judge_model).select("question_id", "score", "reason", "status")


RETRIEVED = f"""WITH {PAIRS}, {PAGES}, {PAGE_CHUNKS}, {retrieval_sql('questions', 'qid')}
, told AS (SELECT qid, page_text AS answer FROM hits JOIN chunks USING (cid) WHERE rank = 1), {graded_sql('told')}"""


def _graded(spark, sf):
    """Question to vector, nearest page as answer, grade."""
    return evaluate(_questions(spark, sf), _page_vectors(spark, sf))


@query(f"{RETRIEVED} SELECT question AS prompt, answer AS response, score AS evaluation_score, reason AS evaluation_reason FROM graded")
def eval_rows(spark, sf):
    good, _ = ev.split_status(_graded(spark, sf))
    return ov.to_eval_rows(good)


@query(f"{RETRIEVED} SELECT score AS evaluation_score, count(*) AS n, round(avg(score), 6) AS mean_score FROM graded GROUP BY ROLLUP (score)")
def eval_summary(spark, sf):
    good, _ = ev.split_status(_graded(spark, sf))
    return ov.eval_summary(ov.to_eval_rows(good))


@query(f"""WITH {PAIRS}, told AS (SELECT qid, golden_answer AS answer FROM questions), {graded_sql('told')}
SELECT question AS prompt, answer AS response, score AS evaluation_score, reason AS evaluation_reason, true AS stamped FROM graded""")
def append_eval(spark, sf):
    """Graded rows written to the evaluation table and read back."""
    folder = scratch_path(spark, "evaluation")
    answered = _questions(spark, sf).withColumn("answer", F.col("golden_answer"))
    sr.append_eval(ov.to_eval_rows(ov.judge(answered)), folder)
    back = spark.read.parquet(folder)
    return back.select("prompt", "response", "evaluation_score", "evaluation_reason", F.col("timestamp").isNotNull().alias("stamped"))


# ---------------------------------------------------------------- sinks and streams


@query(f"""WITH {CHUNKS} SELECT source_file, part, page_num, replace(name, '.pdf', '') || '-page-' || page_num || '.json' AS object_name,
  page_text, {summary_sql('page_text')} AS summary, CASE WHEN route = 'image' THEN to_base64(encode(text)) END AS image_base64
  FROM chunks LEFT JOIN (SELECT doc_id, text FROM documents) USING (doc_id)""")
def page_records(spark, sf):
    """Page records written as JSON and read back."""
    folder = scratch_path(spark, "records")
    sr.write_page_records(to_page_records(om.extract_metadata(_chunks(spark, sf))), folder)
    back = sr.read_page_records(spark, folder)
    return back.select("source_file", "part", F.col("page_num").cast("bigint").alias("page_num"), "object_name", "page_text", F.col("metadata.summary").alias("summary"), "image_base64")


STORED = f"""WITH {CHUNKS}, described AS (SELECT *, {summary_sql('page_text')} AS summary FROM chunks)
SELECT sha256(source_file || '|' || part || '|' || page_num) AS id, source_file, part, page_num, chunk_description, summary
FROM described WHERE summary <> ''"""


def _stored(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "source_file",
        "part",
        F.col("page_num").cast("bigint").alias("page_num"),
        "chunk_description",
        fj.json_field(F.try_parse_json("metadata"), "summary").alias("summary"),
    )


@query(STORED)
def upsert_store(spark, sf):
    """Two loads of the same keys, the first with other values, compacted, read back: one row per key, the newest."""
    folder = scratch_path(spark, "store")
    records = to_page_records(om.extract_metadata(_chunks(spark, sf)))
    good = written(ev.split_status(embed_pages(records))[0], "rows")
    old = {"chunk_description": F.lit("old"), "metadata": F.lit('{"summary": "old"}')}
    sr.upsert_store(good.withColumns(old), folder, 0)
    sr.upsert_store(good, folder, 1)
    compact = scratch_path(spark, "store")
    st.compact_store(sr.read_store(spark, folder), compact)
    return _stored(sr.read_store(spark, compact))


def _stream(spark, sf, times: int, reprocess: bool = False) -> tuple[str, str]:
    """Events of all files through both stages, sent ``times`` times; what is reprocessed had other texts at first."""
    base = scratch_path(spark, "stream")
    files = fx.files(spark, sf).select("bucket", "name", "text")
    for n in range(times):
        other = reprocess and n == 0
        load = sp.from_table(files.withColumn("text", F.translate("text", "aeiou", "xxxxx")) if other else files)
        sp.backfill(spark, files, f"{base}/events", load, f"{base}/out", f"{base}/cp1", page_lines=20, reprocess=reprocess and n > 0).awaitTermination()
        sp.run_embed_stream(spark, f"{base}/out", f"{base}/store", f"{base}/cp2").awaitTermination()
    return f"{base}/out", f"{base}/store"


@query(STORED)
def ingest_stream(spark, sf):
    """Both streaming stages over one event per file."""
    _, store = _stream(spark, sf, 1)
    return _stored(sr.read_store(spark, store))


@query(STORED)
def ingest_stream_redelivery(spark, sf):
    """Every event twice: the second delivery finds all pages done and adds nothing."""
    _, store = _stream(spark, sf, 2)
    return _stored(sr.read_store(spark, store))


@query(STORED)
def ingest_stream_reprocess(spark, sf):
    """Every file again with reprocessing: new rows under the same keys, newest per key."""
    _, store = _stream(spark, sf, 2, reprocess=True)
    return _stored(st.latest_per_key(sr.read_store(spark, store)))


@query(f"WITH {FILES} SELECT name, 'unsupported' AS status FROM files WHERE {ROUTE} = 'unsupported'")
def ingest_stream_quarantine(spark, sf):
    """What stage 1 refuses."""
    base = scratch_path(spark, "stream")
    files = fx.files(spark, sf).select("bucket", "name", "text")
    sp.backfill(spark, files, f"{base}/events", sp.from_table(files), f"{base}/out", f"{base}/cp1", page_lines=20).awaitTermination()
    refused = spark.read.parquet(sp.quarantine_dir(f"{base}/out")).filter("stage = 'event'")
    return refused.select(fj.json_field(F.try_parse_json("body"), "name").alias("name"), "status")


@query(f"WITH {FILES} SELECT bucket, name FROM files")
def dedupe_events_stream(spark, sf):
    """Each event delivered twice, deduplicated by a stream with a watermark."""
    base = scratch_path(spark, "dedupe")
    stored = fx.files(spark, sf).select("bucket", "name")
    se.emit_backfill_events(stored.unionByName(stored), f"{base}/events")
    good, _ = ev.split_status(ev.decode_events(se.read_events_stream(spark, f"{base}/events")))
    unique = ev.dedupe_events(good.select("bucket", "name", "event_time"))
    writer = unique.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select("bucket", "name")


# Names that a file index would drop or take for patterns; some objects are missing, some are no text.
ODD_FILES = f"""odd AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '_draft/' WHEN 2 THEN '.hid/' ELSE 'a[1]*/_' END || name AS name, {ROUTE} AS route FROM files)"""


@query(f"""WITH {FILES}, {ODD_FILES} SELECT name, 1::BIGINT AS n, CASE WHEN route = 'unsupported' THEN 'unsupported' WHEN doc_id % 11 = 5 THEN 'transient'
  WHEN doc_id % 13 = 6 AND route <> 'image' THEN 'undecoded' ELSE 'written' END AS outcome FROM odd""")
def ingest_stream_outcomes(spark, sf):
    """Objects in a folder, under names of all kinds: each event ends in exactly one place."""
    base = scratch_path(spark, "objects")
    folder = F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, "_draft/").when(F.col("doc_id") % 4 == 2, ".hid/").otherwise("a[1]*/_")
    files = fx.files(spark, sf).withColumn("name", F.concat(folder, "name"))
    broken = F.concat(F.unhex(F.lit("FFFE00")), F.col("text").cast("binary"))
    stored = files.filter("doc_id % 11 <> 5").withColumn("content", F.when(F.col("doc_id") % 13 == 6, broken).otherwise(F.col("text").cast("binary")))
    fx.write_objects(stored.select("name", "content"), f"{base}/root")
    sp.backfill(spark, files, f"{base}/events", sp.from_folder(spark, f"{base}/root"), f"{base}/out", f"{base}/cp1", page_lines=20).awaitTermination()
    records = sr.read_page_records(spark, sp.records_dir(f"{base}/out")).select(F.expr(f"substring(source_file, {len('gs://' + fx.BUCKET) + 2})").alias("name")).distinct()
    refused = sr.read_quarantine(spark, sp.quarantine_dir(f"{base}/out")).select(fj.json_field(F.try_parse_json("body"), "name").alias("name"), F.col("status").alias("outcome"))
    return records.withColumn("outcome", F.lit("written")).unionByName(refused).groupBy("name").agg(F.count("*").alias("n"), F.max("outcome").alias("outcome"))


@query(f"WITH {CHUNKS} SELECT source_file, part, page_num, 'again' AS summary FROM chunks")
def ingest_stream_retry(spark, sf):
    """A model that is out of service, or answers nonsense, the first time: after a retry every page is in the store."""
    base = scratch_path(spark, "retry")
    files = fx.files(spark, sf).select("bucket", "name", "text")
    load, out = sp.from_table(files), f"{base}/out"

    def ask(word):
        def call(text, image):
            if word == "first" and len(text) % 2:
                raise type("ServiceUnavailable", (Exception,), {})("try later")
            return "no answer" if word == "first" else '{"summary": "again"}'

        return per_page(call, "metadata_raw")

    sp.backfill(spark, files, f"{base}/events", load, out, f"{base}/cp1", page_lines=20, metadata_fn=ask("first")).awaitTermination()
    sp.retry(spark, out, f"{base}/events")
    sp.run_parse_stream(spark, f"{base}/events", load, out, f"{base}/cp1", page_lines=20, metadata_fn=ask("again")).awaitTermination()
    sp.run_embed_stream(spark, out, f"{base}/store", f"{base}/cp2").awaitTermination()
    return _stored(sr.read_store(spark, f"{base}/store")).select("source_file", "part", "page_num", "summary")


@query(f"""WITH {CHUNKS}, {keywords_sql('chunks', 'source_file, part, page_num', 'page_text')}
SELECT source_file, part, page_num, {summary_sql('page_text')} AS summary, array_to_string({entities_sql('page_text')}, '|') AS entities,
  {type_sql('page_text')} AS document_type, coalesce(keywords, '') AS keywords FROM chunks LEFT JOIN kw USING (source_file, part, page_num)""")
def ingest_stream_batches(spark, sf):
    """Many small batches: with the corpus' statistics, what is said of a page does not depend on its batch."""
    base = scratch_path(spark, "batches")
    files = fx.files(spark, sf).select("bucket", "name", "text")
    stats = written(om.word_stats(_chunks(spark, sf), "page_text"), "stats")
    options = {"page_lines": 20, "max_files": 2, "word_stats": stats}
    sp.backfill(spark, files, f"{base}/events", sp.from_table(files), f"{base}/out", f"{base}/cp1", **options).awaitTermination()
    found = sr.read_page_records(spark, sp.records_dir(f"{base}/out"))
    listed = lambda name: F.array_join(f"metadata.{name}", "|").alias({"extracted_entities": "entities"}.get(name, name))
    return found.select(
        "source_file", "part", F.col("page_num").cast("bigint").alias("page_num"), "metadata.summary", listed("extracted_entities"), "metadata.document_type", listed("keywords")
    )


@query(f"WITH {CHUNKS} SELECT source_file, part, page_num, row_number() OVER (ORDER BY source_file, part, page_num) AS place FROM chunks")
def order_pages(spark, sf):
    """Reading order, with a running number."""
    ordered = oc.order_pages(_chunks(spark, sf).select("source_file", "part", F.col("page_num").cast("bigint").alias("page_num"), F.lit(0).alias("all")))
    return number_rows(ordered, ["all"], ["source_file", "part", "page_num"], "place").drop("all")


@query(f"""WITH {FILES} SELECT name, 1::BIGINT AS generation, 1 AS try FROM files
  UNION ALL SELECT name, 1, 2 FROM files WHERE doc_id % 11 = 5 AND doc_id % 13 <> 0
  UNION ALL SELECT name, 2, 1 FROM files WHERE doc_id % 13 = 0""")
def delivery_stream(spark, sf):
    """All files announced twice, some of them failed and sent again by the stream, some uploaded anew."""
    folder = scratch_path(spark, "delivery")
    files = fx.files(spark, sf).select("bucket", "name", "doc_id")
    given, out = f"{folder}/given", f"{folder}/out"

    def announce(rows, generation, name):
        rows.select("bucket", "name", F.lit(generation).cast("bigint").alias("generation")).write.parquet(f"{given}/{name}")

    spark.createDataFrame([], sr.QUARANTINE).write.parquet(sp.quarantine_dir(out))
    announce(files.unionAll(files), 1, "first")
    events = spark.readStream.schema("bucket string, name string, generation bigint").option("recursiveFileLookup", "true").parquet(given)
    query = sd.run_delivery_stream(spark, events, out, f"{folder}/events", f"{folder}/checkpoint", delay_s=0, trigger={"processingTime": "0 seconds"}, log=f"{folder}/log", partitions=8)
    try:
        sd.read_all(query)
        failed = files.filter("doc_id % 11 = 5 AND doc_id % 13 <> 0").select("bucket", "name", F.lit("transient").alias("status"), F.lit("busy").alias("error"))
        sr.write_quarantine(failed, sp.quarantine_dir(out), "metadata")
        sd.read_all(query)
        announce(files, 1, "again")
        announce(files.filter("doc_id % 13 = 0"), 2, "new")
        sd.read_all(query)
    finally:
        query.stop()
    sent = spark.read.schema(sd.SENT).option("recursiveFileLookup", "true").parquet(f"{folder}/log")
    return sent.select("name", "generation", "try")
