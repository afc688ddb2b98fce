"""All queries of the engine proper, with their SQL for DuckDB where SQL expresses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import tokens
from .operators import chunks, export, fidelity, layout, redact, review, summary
from .plans.ingest import ingest_pdf
from .sources import adapters as A
from .sources.pdf_writer import text_pdfs
from .sources.sample_report import report

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str = ""):
    """Registers a query under its function's name, with its SQL if there is any."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _flat(df: DataFrame) -> DataFrame:
    return df.select("document_id", "chunk_id", "text", F.array_join("parent_hierarchy", " > ").alias("hierarchy"), "token_count", F.array_join(F.transform("source_pages", lambda p: p.cast("string")), ",").alias("pages"))


_PACK = """
, first_nodes AS (SELECT doc, section, rn, tokens AS held, 0 AS part FROM numbered WHERE rn = 1),
packed AS (
  SELECT * FROM first_nodes
  UNION ALL
  SELECT n.doc, n.section, n.rn,
    CASE WHEN p.held + n.tokens + n.context <= 512 THEN p.held + n.tokens ELSE n.tokens END,
    CASE WHEN p.held + n.tokens + n.context <= 512 THEN p.part ELSE p.part + 1 END
  FROM packed p JOIN numbered n ON n.doc = p.doc AND n.section = p.section AND n.rn = p.rn + 1),
rolled AS (
  SELECT n.doc, n.section, p.part, string_agg(n.text, chr(10) || chr(10) ORDER BY n.rn) AS text, min(n.hierarchy) AS hierarchy,
    sum(n.tokens)::BIGINT AS token_count, list_sort(list(DISTINCT n.page)) AS page_list
  FROM numbered n JOIN packed p USING (doc, section, rn) GROUP BY n.doc, n.section, p.part),
chunk_rows AS (
  SELECT doc AS document_id, (row_number() OVER (PARTITION BY doc ORDER BY section, part) - 1)::INTEGER AS chunk_id, text, hierarchy, token_count, array_to_string(page_list, ',') AS pages FROM rolled)
"""

_LINES = """
WITH RECURSIVE split_lines AS (SELECT doc_id::VARCHAR AS doc, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc, unnest(parts) AS line, generate_subscripts(parts, 1) AS page FROM split_lines),
numbered AS (
  SELECT doc, 0 AS section, page, trim(line) AS text, len(regexp_extract_all(line, '\\S+')) AS tokens, 0 AS context, '' AS hierarchy,
    row_number() OVER (PARTITION BY doc ORDER BY page) AS rn
  FROM lines WHERE trim(line) <> '')
""" + _PACK

_TURNS = """
WITH RECURSIVE turns AS (
  SELECT conv_id::VARCHAR AS doc, (turn + 1)::INTEGER AS page, role, trim(replace(text, chr(10), ' ')) AS text,
    CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS changed FROM conversations),
sectioned AS (SELECT *, sum(changed) OVER (PARTITION BY doc ORDER BY page)::BIGINT AS section FROM turns),
numbered AS (
  SELECT doc, section, page, text, len(regexp_extract_all(text, '\\S+')) AS tokens, 1 AS context, role AS hierarchy,
    row_number() OVER (PARTITION BY doc, section ORDER BY page) AS rn
  FROM sectioned WHERE text <> '')
""" + _PACK


@query(_LINES + "SELECT * FROM chunk_rows")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(chunks.chunk_pages(A.document_pages(spark, sf_dir), tokens.words))


@query(_TURNS + "SELECT * FROM chunk_rows")
def chunk_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(chunks.chunk_pages(A.conversation_pages(spark, sf_dir), tokens.words))


@query(
    _TURNS + ", nodes AS (SELECT doc, page, 1 AS seq, 'header' AS kind, section, role AS hierarchy FROM sectioned UNION ALL SELECT doc, page, 3, 'paragraph', section, role FROM sectioned WHERE text <> '')"
    " SELECT doc AS document_id, page AS page_num, seq AS node_seq, kind AS node_type, section, hierarchy FROM nodes"
)
def section_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = chunks.with_context(chunks.nodes(A.conversation_pages(spark, sf_dir)))
    return df.select("document_id", "page_num", "node_seq", "node_type", "section", F.array_join("hierarchy", " > ").alias("hierarchy"))


@query(
    _TURNS + ", heads AS (SELECT *, lag(hierarchy) OVER (PARTITION BY document_id ORDER BY chunk_id) AS before FROM chunk_rows)"
    " SELECT document_id, string_agg(CASE WHEN before IS DISTINCT FROM hierarchy THEN '# ' || hierarchy || chr(10) || chr(10) || text ELSE text END, chr(10) || chr(10) ORDER BY chunk_id) AS markdown FROM heads GROUP BY document_id"
)
def stitched_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.stitch(chunks.chunk_pages(A.conversation_pages(spark, sf_dir), tokens.words))


# DuckDB counts edits by byte, so letters with accents stand in for control characters, which the texts don't hold.
_ACCENTS = "èéÍÊÄñÉßêçíÇÈÑöüÖóÓäÜáÁúÚà"
_BYTES = " || ".join(f"chr({c})" for c in [*range(1, 9), *range(14, 32)][: len(_ACCENTS)])
_ALIKE = "CASE WHEN {a} = {b} THEN true WHEN abs(len({a}) - len({b})) > 0.36 * greatest(len({a}), len({b})) THEN false ELSE 1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(len({a}), len({b})) >= 0.65::DOUBLE END"
_CLUSTERS = f"""
WITH RECURSIVE l AS (SELECT source, doc_id::INTEGER AS page, string_split(text, chr(10)) AS parts FROM documents),
e AS (SELECT source AS doc, page, unnest(parts) AS line, generate_subscripts(parts, 1) AS k, len(parts) AS n FROM l),
found AS (SELECT doc, page, k, CASE WHEN k = 1 THEN '0.04' ELSE '0.96' END AS zone, trim(line) AS text FROM e WHERE k = 1 OR k = n),
firsts AS (SELECT doc, zone, text, min((page, k)) AS place FROM found GROUP BY ALL),
ordered AS (SELECT doc, zone, text, translate(text, '{_ACCENTS}', {_BYTES}) AS key, row_number() OVER (PARTITION BY doc, zone ORDER BY place) AS r FROM firsts),
walk AS (
  SELECT doc, zone, r, [key] AS heads, text, key AS head FROM ordered WHERE r = 1
  UNION ALL
  SELECT doc, zone, r, CASE WHEN hit IS NULL THEN list_append(heads, key) ELSE heads END, text, coalesce(hit, key)
  FROM (SELECT o.doc, o.zone, o.r, o.text, o.key, w.heads, list_filter(w.heads, lambda h: {_ALIKE.format(a="h", b="o.key")})[1] AS hit
    FROM walk w JOIN ordered o ON o.doc = w.doc AND o.zone = w.zone AND o.r = w.r + 1)),
named AS (SELECT w.doc, w.zone, w.text, o.text AS representative_text FROM walk w JOIN ordered o ON o.doc = w.doc AND o.zone = w.zone AND o.key = w.head),
totals AS (SELECT source AS doc, count(*) AS total FROM documents GROUP BY 1),
seen AS (SELECT doc, zone, representative_text, count(DISTINCT page) AS pages_seen FROM found JOIN named USING (doc, zone, text) GROUP BY ALL),
clusters AS (SELECT doc, zone, representative_text, pages_seen, pages_seen / total AS frequency FROM seen JOIN totals USING (doc))
"""


@query(_CLUSTERS + "SELECT doc AS document_id, zone AS y_zone, representative_text, pages_seen, round(frequency, 6) AS frequency, frequency >= 0.3 AS redact FROM clusters")
def redact_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements, pages = A.line_elements(spark, sf_dir)
    return redact.clusters(redact.candidates(elements, pages), redact.page_counts(pages)).withColumn("frequency", F.round("frequency", 6))


@query(
    _CLUSTERS + ", bad AS (SELECT c.doc, c.zone, o.key FROM clusters c JOIN ordered o ON o.doc = c.doc AND o.zone = c.zone AND o.text = c.representative_text WHERE frequency >= 0.3),"
    " gone AS (SELECT DISTINCT f.doc, f.page, f.k FROM found f JOIN ordered o ON o.doc = f.doc AND o.zone = f.zone AND o.text = f.text JOIN bad b ON b.doc = f.doc AND b.zone = f.zone WHERE " + _ALIKE.format(a="b.key", b="o.key") + ")"
    " SELECT doc AS document_id, page AS page_num, count(*) AS kept FROM e ANTI JOIN gone USING (doc, page, k) GROUP BY doc, page"
)
def kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements, pages = A.line_elements(spark, sf_dir)
    return redact.kept_elements(elements, pages).groupBy("document_id", "page_num").agg(F.count("*").alias("kept"))


@query(
    "WITH l AS (SELECT source, doc_id, string_split(text, chr(10)) AS parts FROM documents), e AS (SELECT source, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS k, len(parts) AS n FROM l)"
    " SELECT source AS document_id, CASE WHEN k = 1 THEN '0.04' ELSE '0.96' END AS y_zone, count(*) AS n FROM e WHERE k = 1 OR k = n GROUP BY 1, 2"
)
def zone_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.candidates(*A.line_elements(spark, sf_dir)).groupBy("document_id", "y_zone").agg(F.count("*").alias("n"))


_RETENTION = """
WITH l AS (SELECT doc_id, text, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents),
c AS (SELECT doc_id, any_value(length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'))) AS raw, sum(length(regexp_replace(line, '[^\\p{L}\\p{N}]', '', 'g'))) AS md FROM l GROUP BY doc_id),
r AS (SELECT doc_id, CASE WHEN raw = 0 THEN 1.0::DOUBLE ELSE greatest(0.0, least(1.0, 1.0 - abs(raw - md)::DOUBLE / raw)) END AS c_retention FROM c)
"""


def _retentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = A.table(spark, sf_dir, "documents")
    once = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    return df.select("doc_id", "source", fidelity.retention(T.alnum_count(F.col("text")), T.alnum_count(once)).alias("c"))


@query(_RETENTION + "SELECT doc_id, round(c_retention, 6) AS c_retention FROM r")
def char_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _retentions(spark, sf_dir).select("doc_id", F.round("c", 6).alias("c_retention"))


_GATE = "CASE WHEN 0.4 * c_retention + 0.6 >= 0.9 THEN 'pass' WHEN 0.4 * c_retention + 0.6 >= 0.7 THEN 'warning_layout_anomaly' ELSE 'quarantined' END"


@query(_RETENTION + f"SELECT doc_id, round(0.4 * c_retention + 0.6, 6) AS s_fidelity, {_GATE} AS quality FROM r")
def fidelity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fidelity.fidelity(F.col("c"), F.lit(1.0))
    return _retentions(spark, sf_dir).select("doc_id", F.round(s, 6).alias("s_fidelity"), fidelity.quality(s).alias("quality"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fidelity.fidelity(F.col("c"), F.lit(1.0))
    return _retentions(spark, sf_dir).select(F.col("source").alias("document_id"), s.alias("s_fidelity"), fidelity.quality(s).alias("quality"))


_SUMMARY = _RETENTION + f", s AS (SELECT source AS document_id, 0.4 * c_retention + 0.6 AS s, {_GATE} AS q FROM r JOIN documents USING (doc_id))"


@query(_SUMMARY + " SELECT document_id, count(*) AS total_pages, count(*) FILTER (q = 'pass') AS pages_passed, count(*) FILTER (q = 'warning_layout_anomaly') AS pages_warned, count(*) FILTER (q = 'quarantined') AS pages_quarantined, round(avg(s), 6) AS avg_fidelity FROM s GROUP BY 1")
def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summarize(_scored(spark, sf_dir)).select("document_id", "total_pages", "pages_passed", "pages_warned", "pages_quarantined", F.round("avg_fidelity", 6).alias("avg_fidelity"))


@query(_SUMMARY + " SELECT document_id, CASE WHEN count(*) FILTER (q = 'quarantined') > 0 THEN 'needs_review' ELSE 'clean' END AS status FROM s GROUP BY 1")
def document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summarize(_scored(spark, sf_dir)).select("document_id", summary.status(F.col("pages_quarantined")).alias("status"))


@query("SELECT l_orderkey AS page, CASE WHEN count(*) >= 2 THEN count(*)::INTEGER END AS n_rows, CASE WHEN count(*) >= 2 THEN 3 END AS n_cols FROM lineitem GROUP BY 1")
def md_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "l_partkey", "l_suppkey", "l_returnflag"), F.lit(" |"))
    rows = A.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.sort_array(F.collect_list(row)).alias("r"))
    md = F.array_join(F.concat(F.slice("r", 1, 1), F.array(F.lit("| --- | --- | --- |")), F.slice("r", F.lit(2), F.size("r"))), "\n")
    return rows.select("page", fidelity.markdown_grid(md).alias("g")).select("page", F.col("g.n_rows").alias("n_rows"), F.col("g.n_cols").alias("n_cols"))


_CELLS = "WITH r AS (SELECT l_orderkey AS page_num, l_linenumber AS n, 3 * count(*) AS members FROM lineitem GROUP BY 1, 2)"


@query(_CELLS + " SELECT page_num::INTEGER AS page_num, CASE WHEN count(*) >= 2 THEN count(*)::INTEGER END AS grid_rows, CASE WHEN count(*) >= 2 THEN min(members)::INTEGER END AS grid_cols FROM r GROUP BY 1")
def spatial_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.spatial_grids(A.order_cells(spark, sf_dir)).select("page_num", "grid_rows", "grid_cols")


@query("SELECT l_orderkey::INTEGER AS page_num, (dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1)::INTEGER AS line, 3 * count(*) AS cells FROM lineitem GROUP BY l_orderkey, l_linenumber")
def line_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.lines(A.order_cells(spark, sf_dir)).groupBy("page_num", "line").agg(F.count("*").alias("cells"))


@query("WITH n AS (SELECT l_orderkey, count(*)::INTEGER AS n FROM lineitem GROUP BY 1) SELECT l_orderkey::INTEGER AS page_num, n AS grid_rows, least(n, 4)::INTEGER AS grid_cols FROM n")
def grid_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.ruled_grids(A.order_segments(spark, sf_dir)).select("page_num", "grid_rows", "grid_cols")


@query("SELECT l_orderkey::INTEGER AS page_num, count(*) * 3 AS cells, 0 AS column_num FROM lineitem GROUP BY 1")
def page_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.columns(A.order_cells(spark, sf_dir, apart=True)).groupBy("page_num").agg(F.count("*").alias("cells"), F.max("column_num").alias("column_num"))


@query(
    "WITH p AS (SELECT DISTINCT (p_partkey // 10 + 1)::INTEGER AS page_num, (p_partkey % 10)::INTEGER AS line FROM part), n AS (SELECT page_num, count(*) AS n FROM p GROUP BY 1), r AS (SELECT p.*, k FROM p, range(2) t(k) WHERE k = 0 OR page_num % 2 = 1)"
    " SELECT page_num, (line * 2 + k)::INTEGER AS elem_seq, (CASE WHEN n >= 10 THEN k ELSE 0 END)::INTEGER AS column_num FROM r JOIN n USING (page_num)"
)
def two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layout.columns(A.paired_lines(spark, sf_dir))
    return df.select("page_num", "elem_seq", "column_num")


_LEVELS = ("o_orderstatus", "o_orderpriority", "year(o_orderdate)", "quarter(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)")


@query(
    "WITH o AS (SELECT o_custkey, o_orderkey, " + ", ".join(f"{c}::VARCHAR AS h{k}" for k, c in enumerate(_LEVELS, 1)) + " FROM orders),"
    " c1 AS (SELECT *, h1 IS DISTINCT FROM lag(h1) OVER w AS c1 FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"
    + "".join(f", c{k} AS (SELECT *, c{k - 1} OR h{k} IS DISTINCT FROM lag(h{k}) OVER w AS c{k} FROM c{k - 1} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))" for k in range(2, 7))
    + " SELECT o_custkey::VARCHAR AS document_id, (row_number() OVER w)::INTEGER AS page_num, sum(" + " + ".join(f"c{k}::INTEGER" for k in range(1, 7)) + ")  OVER w::BIGINT AS section,"
    " concat_ws(' > ', h1, h2, h3, h4, h5, h6) AS hierarchy FROM c6 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)"
)
def outline_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = chunks.with_context(chunks.nodes(A.outline_pages(spark, sf_dir))).where("node_type = 'paragraph'")
    return df.select("document_id", "page_num", "section", F.array_join("hierarchy", " > ").alias("hierarchy"))


@query(
    "WITH o AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT l_orderkey, CASE WHEN n < 2 OR l_orderkey % 2 = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS t, greatest(0.0, 1.0 - (n - 1) / 20.0)::DOUBLE AS c FROM o)"
    " SELECT l_orderkey AS page, t AS t_matrix, round(0.4 * c + 0.6 * t, 6) AS s_fidelity FROM s"
)
def table_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables: of every other one the Markdown has lost the table, and of each some text."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "l_partkey", "l_suppkey", "l_returnflag"), F.lit(" |"))
    df = A.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.sort_array(F.collect_list(row)).alias("r"), F.count("*").cast("int").alias("n"))
    table = F.array_join(F.concat(F.slice("r", 1, 1), F.array(F.lit("| --- | --- | --- |")), F.slice("r", F.lit(2), F.size("r"))), "\n")
    md = fidelity.markdown_grid(F.when(F.col("page") % 2 == 1, table).otherwise(F.array_join("r", " ")))
    t = fidelity.table_score(F.when(F.col("n") >= 2, F.col("n")), F.when(F.col("n") >= 2, F.lit(3)), md)
    scored = df.select("page", "n", t.alias("t_matrix"), fidelity.retention(F.lit(20).cast("long"), (F.lit(21) - F.col("n")).cast("long")).alias("c"))
    return scored.select("page", "t_matrix", F.round(fidelity.fidelity(F.col("c"), F.col("t_matrix")), 6).alias("s_fidelity"))


_MODE = "WITH c AS (SELECT p_brand, p_size * 2 AS bucket, count(*) AS n FROM part GROUP BY 1, 2), b AS (SELECT p_brand, bucket / 2.0 AS body_size FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, bucket) = 1)"


@query(_MODE + " SELECT p_brand AS document_id, body_size::DOUBLE AS body_size FROM b")
def body_font_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.body_font_size(A.part_elements(spark, sf_dir))


@query(
    _MODE + ", s AS (SELECT DISTINCT p_brand, p_size FROM part), k AS (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rank FROM s JOIN b USING (p_brand) WHERE p_size::DOUBLE > body_size::DOUBLE * 1.15::DOUBLE)"
    " SELECT p_brand AS document_id, p_partkey::INTEGER AS elem_seq, CASE WHEN rank IS NOT NULL THEN least(rank, 4)::INTEGER END AS depth FROM part LEFT JOIN k USING (p_brand, p_size)"
)
def heading_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = A.part_elements(spark, sf_dir)
    sizes = layout.heading_sizes(elements, layout.body_font_size(elements))
    return elements.join(sizes, "document_id").select("document_id", "elem_seq", layout.heading_depth(F.col("font_size"), F.col("body_size"), F.col("sizes")).alias("depth"))


@query(
    "WITH m AS (SELECT page_id, string_split(regexp_replace(html, '(?s)(</?(?:h1|p|li|ul|article|footer|nav)\\b)', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM pages),"
    " b AS (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k, len(parts) AS n FROM m),"
    " t AS (SELECT page_id, k, CASE WHEN starts_with(part, '<h1') THEN '# ' WHEN starts_with(part, '<li') THEN '- ' ELSE '' END || trim(regexp_replace(regexp_replace(part, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS raw"
    " FROM b WHERE k < n AND regexp_matches(part, '(?s)^<(?:h1|p|li)(?:\\s[^>]*)?>')),"
    " l AS (SELECT page_id, trim(raw) AS line, row_number() OVER (PARTITION BY page_id ORDER BY k) AS r FROM t),"
    " f AS (SELECT *, first_value(line) OVER (PARTITION BY page_id ORDER BY r) = '' AS blank_first FROM l),"
    " j AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY r) AS j FROM f WHERE line <> ''),"
    " c AS (SELECT *, len(regexp_extract(line, '^(#{1,6}) ', 1)) AS depth FROM j)"
    " SELECT page_id::VARCHAR AS document_id, 1 AS page_num, (2 * j - CASE WHEN blank_first THEN 0 ELSE 1 END)::INTEGER AS node_seq,"
    " CASE WHEN depth > 0 THEN 'header' WHEN starts_with(line, '|') THEN 'table' WHEN regexp_matches(line, '^[-*]') OR regexp_matches(line, '^[0-9]+\\.') THEN 'list' ELSE 'paragraph' END AS node_type,"
    " CASE WHEN depth > 0 THEN depth::INTEGER END AS level, CASE WHEN depth > 0 THEN trim(regexp_replace(line, '^#+', '')) ELSE line END AS text FROM c"
)
def html_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.nodes(A.html_markdown(spark, sf_dir))


@query("SELECT count(*) AS documents_ingested_total, sum(user_id % 10)::BIGINT AS pages_total, count(*) FILTER (event_type = 'click') AS pages_quarantined_total, sum(length(props))::BIGINT AS tokens_processed_total FROM events")
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0).cast("long")
    df = A.table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("total_pages"), zero.alias("pages_passed"), zero.alias("pages_warned"), (F.col("event_type") == "click").cast("long").alias("pages_quarantined"), zero.alias("redact_clusters"), zero.alias("chunks_emitted"), F.length("props").cast("long").alias("tokens_processed"))
    return summary.counters(df).select("documents_ingested_total", "pages_total", "pages_quarantined_total", "tokens_processed_total")


@query(
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{b}' AS le, count(*) FILTER (value <= {b}) AS n FROM events" for b in summary.LATENCY_BOUNDS) + " UNION ALL SELECT '+Inf', count(value) FROM events) t"
)
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.histogram(A.table(spark, sf_dir, "events"), "value").select("le", "n")


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = A.table(spark, sf_dir, "documents").join(A.table(spark, sf_dir, "labels"), "doc_id")
    state = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "approved").otherwise("pending")
    return df.select(
        F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("tenant-"), (F.col("doc_id") % 3).cast("string")).alias("tenant_id"), F.col("source").alias("document_id"), F.lit(1).alias("page_num"), F.lit(0.4).alias("s_fidelity"),
        F.col("text").alias("markdown"), state.alias("status"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("reviewed "), F.left("text", F.lit(20)))).otherwise("").alias("reviewed_markdown"), F.lit(None).cast("timestamp").alias("created_at"),
    )


@query("SELECT doc_id::VARCHAR AS id, source AS document_id FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 = 1 AND toxic <> 1 AND quality <> 1")
def quarantine_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.records(_store(spark, sf_dir), "tenant-1", "pending").select("id", "document_id")


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 0 THEN 'reviewed ' || left(text, 20) ELSE text END AS text, source AS document_id FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 = 0 AND toxic <> 1 AND quality = 1")
def approved_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.approved_chunks(_store(spark, sf_dir), "tenant-0").select("id", "text", F.col("metadata")["document_id"].alias("document_id"))


@query("SELECT vec_id::VARCHAR AS id, len(embedding)::INTEGER AS dims FROM embeddings WHERE len(embedding) <> 128")
def dims_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = A.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    return export.check_dimensions(df, 128)


@query(
    "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: regexp_replace(CASE WHEN contains(x::FLOAT::VARCHAR, 'e') THEN rtrim(x::FLOAT::VARCHAR::DOUBLE::DECIMAL(38, 18)::VARCHAR, '0') ELSE x::FLOAT::VARCHAR END, '\\.0?$', '')) AS parts FROM embeddings)"
    " SELECT vec_id, '[' || array_to_string(parts, ',') || ']' AS literal FROM v"
)
def vector_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "embeddings").select("vec_id", T.vector_literal(F.col("embedding")).alias("literal"))


@query("SELECT vec_id::VARCHAR AS id, CASE WHEN label % 2 = 0 THEN 64 ELSE 2 END::INTEGER AS dims FROM embeddings")
def embed_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = A.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("label").cast("string").alias("text"), F.when(F.col("label") % 2 == 0, F.col("embedding")).alias("embedding"))
    return export.embed_missing(df, LengthEmbedder()).select("id", F.size("embedding").alias("dims"))


class LengthEmbedder:
    """Two numbers from a text, for queries without a network."""

    dimensions = 2

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[float(len(t)), 1.0] for t in texts]


@query("SELECT c_custkey, n_name AS tenant_id FROM customer JOIN nation ON c_nationkey = n_nationkey")
def tenant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("api_key"), F.col("n_name").alias("tenant_id"))
    return review.with_tenant(A.table(spark, sf_dir, "customer").withColumn("api_key", F.col("c_nationkey")), keys).select("c_custkey", "tenant_id")


@query(
    "WITH s AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '\\.\\.', '_', 'g'), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS d FROM pages)"
    " SELECT page_id, left(CASE WHEN d = '' THEN '_' ELSE d END, 200) AS dir FROM s"
)
def sanitize_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", T.sanitize_path(F.col("url")).alias("dir"))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS tokens FROM documents")
def token_counts_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select("doc_id", tokens.words(F.col("text")).alias("tokens"))


@query()
def token_counts_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    count = tokens.bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    return A.table(spark, sf_dir, "documents").select("doc_id", count(F.col("text")).alias("tokens"))


@query()
def pdf_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a PDF file, read back and ingested."""
    done = ingest_pdf(text_pdfs(A.table(spark, sf_dir, "documents")))
    return done.summary.select("document_id", "total_pages", "pages_passed", "pages_warned", "pages_quarantined", "redact_clusters", "chunks_emitted", "tokens_processed", F.round("avg_fidelity", 6).alias("avg_fidelity"))


def _report(spark: SparkSession):
    return ingest_pdf(spark.createDataFrame([("report", report())], "document_id string, content binary"))


@query("SELECT 'report' AS document_id, 27::BIGINT AS total_pages, 26::BIGINT AS pages_passed, 0::BIGINT AS pages_warned, 1::BIGINT AS pages_quarantined, 4::BIGINT AS redact_clusters, 8::BIGINT AS chunks_emitted")
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample report, read from its PDF file and ingested."""
    return _report(spark).summary.select("document_id", "total_pages", "pages_passed", "pages_warned", "pages_quarantined", "redact_clusters", "chunks_emitted")


@query(
    "SELECT k::INTEGER AS page_num, CASE WHEN k = 13 THEN 0.0 ELSE 1.0 END::DOUBLE AS t_matrix, CASE WHEN k = 13 THEN 0.4 ELSE 1.0 END::DOUBLE AS s_fidelity, CASE WHEN k = 13 THEN 'quarantined' ELSE 'pass' END AS quality,"
    " k IN (2, 13, 26) AS table_detected_in_pdf, k IN (2, 26) AS table_detected_in_md FROM range(1, 28) t(k)"
)
def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark).pages.select("page_num", "t_matrix", F.round("s_fidelity", 6).alias("s_fidelity"), "quality", "table_detected_in_pdf", "table_detected_in_md")


@query(
    "SELECT * FROM (VALUES (0, 'Product X > System Requirements', '1'), (1, 'Product X > Deployment Notes', '1'), (2, 'Product X > Quarterly Revenue', '2'), (3, 'Product Y > System Requirements', '3'), (4, 'Product Y > Appendix Notes', NULL),"
    " (5, 'Product Y > Appendix Notes', NULL), (6, 'Product Y > Regional Headcount', '26'), (7, 'Product Y > Risk Factors Overview', '27')) t(chunk_id, hierarchy, pages)"
)
def report_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages fill the first part of the appendix is up to the counter, so its chunks' pages are left out."""
    df = _flat(_report(spark).chunks)
    return df.select("chunk_id", "hierarchy", F.when(~F.col("hierarchy").endswith("Appendix Notes"), F.col("pages")).alias("pages"))


_TABLES = {
    1: ["# Product X", "", "## System Requirements", "", "Product X needs at least sixteen gigabytes of memory and four cores that run at two gigahertz or faster. Storage grows with the data, and a fast disk of half a terabyte is a good start for production use.",
        "## Deployment Notes", "", "Deploy to the second group of machines first and switch over when all checks have passed. Going back must be possible within a quarter of an hour, as the service agreement says."],
    2: ["## Quarterly Revenue", "", "| Quarter | Product X | Product Y | Total |", "| --- | --- | --- | --- |", "| First | 12.5 | 3.0 | 15.5 |", "| Second | 13.9 | 3.5 | 17.4 |", "| Third | 15.1 | 4.0 | 19.1 |", "| Fourth | 16.9 | 4.1 | 21.0 |"],
    26: ["## Regional Headcount", "", "| Region | Staff | Open |", "| --- | --- | --- |", "| North | 410 | 17 |", "| South | 266 | 8 |", "| East | 197 | 15 |"],
    27: ["## Risk Factors Overview", "", "Market risk comes from changes in the rates of exchange between the regions in which the firm makes and sells its instruments each year. The board looks at these rates every quarter and buys cover for the larger part of them, so that earnings stay close to the plan. The treasury reports on this to the board.",
         "", "Operational risk is mostly a matter of supply. Some parts come from one maker only, which may be cut off by new rules or by the weather. The firm keeps two makers for all parts that it needs in numbers, and tests twice a year how it would ship without its main harbour. Every region takes part in these tests."],
}


@query("SELECT * FROM (VALUES " + ", ".join(f"({n}, '" + "' || chr(10) || '".join(rows) + "')" for n, rows in _TABLES.items()) + ") t(page_num, markdown)")
def report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with headings, a borderless and a ruled table, and two columns."""
    return _report(spark).pages.where(F.col("page_num").isin(*_TABLES)).select("page_num", "markdown")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks and fidelity of every document, in one row each."""
    of_chunks = chunks.chunk_pages(A.document_pages(spark, sf_dir), tokens.words).groupBy("document_id").agg(F.count("*").alias("chunks_emitted"), F.sum("token_count").alias("tokens_processed"))
    gate = fidelity_gate(spark, sf_dir).select(F.col("doc_id").cast("string").alias("document_id"), "s_fidelity", "quality")
    return gate.join(of_chunks, "document_id", "left")
