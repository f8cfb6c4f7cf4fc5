"""Every operator outside the training-data subpackage applied to the tables, with the SQL that its result must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import detect, keywords, text
from quire.functions.text import BLANK, NAME_KEEPS
from quire.operators import elements as el
from quire.operators import naming, ranking, tables
from quire.plans import corpus, executor, review
from quire.plans import expand as expand_
from quire.plans.expand import expand
from quire.sources import corpus_source, packages
from quire.sources.shared import new_folder, staged
from quire.streaming import findings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with its SQL if it has one."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- elements and chunks of documents -----------------------------------------------------------------

_LINES = rf"""list_transform(list_filter(string_split_regex(coalesce(text, ''), '\r?\n'), lambda x: NOT regexp_matches(x, '\A[{BLANK}]*\z')),
  lambda x: regexp_replace(x, '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g'))"""
_D = f"d AS (SELECT doc_id, {_LINES} AS ls FROM documents)"
_E = f"{_D}, e AS (SELECT doc_id, CAST(i AS INTEGER) AS idx, ls[i + 1] AS content FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM d))"
_C = f"""{_D}, c AS (SELECT doc_id, ls, k AS chunk_no, n AS chunks, (k - 1) * 50 AS lo, least(k * 50, len(ls)) - 1 AS hi
  FROM (SELECT doc_id, ls, n, unnest(range(1, n + 1)) AS k FROM (SELECT doc_id, ls, greatest(1, (len(ls) + 49) // 50) AS n FROM d)))"""
_FILE = "printf('chunk_%04d.md', chunk_no)"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return el.text_documents(table(spark, sf_dir, "documents"))


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return el.exploded(_documents(spark, sf_dir))


@query(f"WITH {_E} SELECT doc_id, idx AS position, 'paragraph' AS type, content FROM e")
def text_elements(spark, sf_dir):
    return _elements(spark, sf_dir).select("doc_id", "position", "type", "content")


@query(f"WITH {_E} SELECT doc_id, idx, CAST(idx // 50 + 1 AS INTEGER) AS chunk_no, printf('chunk_%04d.md', idx // 50 + 1) AS file FROM e")
def chunk_assignment(spark, sf_dir):
    number = F.expr(f"cast(idx div {el.CHUNK} as int)") + 1
    return _elements(spark, sf_dir).select("doc_id", "idx", number.alias("chunk_no"), el.chunk_file(number).alias("file"))


@query(f"WITH {_C} SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, {_FILE} AS file, CAST(lo AS INTEGER) AS pos_lo, CAST(hi AS INTEGER) AS pos_hi, CAST(hi - lo + 1 AS INTEGER) AS element_count FROM c")
def chunk_stats(spark, sf_dir):
    return el.with_chunks(_documents(spark, sf_dir)).select("doc_id", "chunk_no", el.chunk_file(F.col("chunk_no")).alias("file"), "pos_lo", "pos_hi", "element_count")


@query(f"""WITH {_C} SELECT doc_id, '{{"source":"doc_' || doc_id || '/doc_' || doc_id || '.md","total_elements":' || len(any_value(ls)) || ',"total_large_tables":0,"total_images":0,"chunk_size":50,"chunks":['
  || string_agg('{{"file":"' || {_FILE} || '","pos_range":[' || lo || ',' || hi || '],"element_count":' || (hi - lo + 1) || ',"includes_large_table":false}}', ',' ORDER BY chunk_no) || '],"large_tables":[]}}' AS index_json
  FROM c GROUP BY doc_id""")
def chunk_index_json(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", corpus.index_json(_body_path(), F.size("elements"), F.lit(0)).alias("index_json"))


def _body_path():
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    return F.concat(name, F.lit("/"), name, F.lit(".md"))


_MD = "list_transform(range({lo}, {hi}), lambda i: '# POS: ' || i || ' | TYPE: paragraph' || chr(10) || ls[i + 1] || chr(10) || chr(10))"


@query(f"""WITH {_C} SELECT doc_id, {_FILE} AS file, md5('# Chunk ' || chunk_no || ' of ' || chunks || chr(10) || '# Source: doc_' || doc_id || '/doc_' || doc_id || '.md' || chr(10)
  || '# Pos range: ' || lo || ' - ' || hi || chr(10) || chr(10) || coalesce(array_to_string({_MD.format(lo="lo", hi="hi + 1")}, ''), '')) AS content_md5 FROM c""")
def chunk_markdown_hash(spark, sf_dir):
    return corpus.chunk_markdown(_documents(spark, sf_dir), _body_path()).select("doc_id", "file", F.md5("content").alias("content_md5"))


@query(f"""WITH {_D} SELECT doc_id, md5('# DOC: ' || doc_id || chr(10) || '# SOURCE: doc_' || doc_id || '/doc_' || doc_id || '.md' || chr(10) || '# PARENT: root' || chr(10) || chr(10)
  || coalesce(array_to_string({_MD.format(lo="0", hi="len(ls)")}, ''), '')) AS body_md5 FROM d""")
def body_markdown_hash(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.md5(corpus.body_markdown(F.col("doc_id"), _body_path(), F.lit("root"), F.col("elements"))).alias("body_md5"))


# --- manifests: a conversation is a session, its turns are documents --------------------------------------

_TURNS = f"""t AS (SELECT conv_id, turn, role, len({_LINES}) AS element_count, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq,
  row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rank FROM conversations),
m AS (SELECT conv_id, CAST(seq AS INTEGER) AS seq, CASE WHEN rank = 1 THEN role ELSE role || '_' || rank END AS dir, role || '.txt' AS source, CAST(element_count AS INTEGER) AS element_count FROM t),
p AS (SELECT m.*, dir || '/' || source AS source_copy, CASE WHEN seq = 0 THEN 'root' ELSE first_value(dir) OVER (PARTITION BY conv_id ORDER BY seq) || ', pos=' || (seq - 1) END AS parent FROM m)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first turn is a session's root and holds the others."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "role", F.array(F.col("turn").cast("int")).alias("path"), F.size(text.lines(F.col("text"))).alias("element_count"))
    named = naming.simple_names(el.preorder(rows, ["conv_id"]), ["conv_id"], "role")
    root = F.first("dir").over(_in_order("conv_id", "seq"))
    parent = corpus.parent_label(F.when(F.col("seq") > 0, root), F.col("seq") - 1)
    source = F.concat("role", F.lit(".txt"))
    return named.select("conv_id", "seq", "dir", source.alias("source"), F.concat_ws("/", "dir", source).alias("source_copy"), F.lit("txt").alias("type"), "element_count", F.lit(0).alias("data_ref_count"), F.lit(0).alias("image_count"), parent.alias("parent"))


def _in_order(*keys):
    from pyspark.sql import Window

    return Window.partitionBy(*keys[:-1]).orderBy(keys[-1])


@query(f"WITH {_TURNS} SELECT conv_id, seq, dir, source, source_copy, 'txt' AS type, element_count, CAST(0 AS INTEGER) AS data_ref_count, CAST(0 AS INTEGER) AS image_count, parent FROM p")
def manifest_rows(spark, sf_dir):
    return _turns(spark, sf_dir)


@query(f"""WITH {_TURNS} SELECT 'conv_' || conv_id AS session_id, '{{"session_id":"conv_' || conv_id || '","source_file":"' || min_by(source, seq) || '","docs":[' || string_agg('{{"seq":' || seq || ',"dir":"' || dir || '","source":"' || source
  || '","source_copy":"' || source_copy || '","type":"txt","element_count":' || element_count || ',"data_ref_count":0,"image_count":0,"parent":"' || parent || '"}}', ',' ORDER BY seq) || ']}}' AS manifest FROM p GROUP BY conv_id""")
def manifest_json(spark, sf_dir):
    return corpus.manifest_json(_turns(spark, sf_dir).withColumn("session_id", F.concat(F.lit("conv_"), F.col("conv_id").cast("string"))))


@query("SELECT role AS type, count(*) AS n FROM conversations GROUP BY role")
def element_type_counts(spark, sf_dir):
    return el.element_counts(table(spark, sf_dir, "conversations").withColumnRenamed("role", "type"), [])


# --- names ------------------------------------------------------------------------------------------------

_BASE = rf"""CASE WHEN coalesce(b, '') = '' THEN 'unknown' ELSE b END AS base_name FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '(?s)\A(.+)\.[^.]*\z', '\1'),
  '[^.{NAME_KEEPS}]', '_', 'g'), '_+', '_', 'g'), '\A[._]+|[._]+\z', '', 'g') AS b FROM """
_NAMES = "(SELECT url AS name FROM pages UNION ALL SELECT p_name FROM part UNION ALL SELECT source FROM documents)"


@query(f"SELECT name, regexp_replace(name, '[^{NAME_KEEPS}]', '_', 'g') AS safe_name, string_split(name, '/')[-1] AS last_segment, {_BASE}{_NAMES})")
def file_names(spark, sf_dir):
    names = [table(spark, sf_dir, t).select(F.col(c).alias("name")) for t, c in (("pages", "url"), ("part", "p_name"), ("documents", "source"))]
    name = F.col("name")
    return reduce(DataFrame.unionAll, names).select("name", text.safe_file_name(name).alias("safe_name"), text.last_segment(name).alias("last_segment"), text.base_name(name).alias("base_name"))


#: Parts of a session, at most: a session is what came out of one file, so it doesn't grow with the table.
SESSION_PARTS, FOLDED_PARTS = 4096, 128
_PARTS = f"SELECT p_partkey, p_partkey // {SESSION_PARTS} AS session, {_BASE}(SELECT p_partkey, p_name AS name FROM part))"


def _session(size):
    return F.expr(f"p_partkey div {size}").alias("session")


@query(f"""SELECT p_partkey, session, CASE WHEN rank = 1 THEN base_name ELSE base_name || '_' || rank END AS dir FROM (SELECT *, row_number() OVER (PARTITION BY session, base_name ORDER BY p_partkey) AS rank FROM ({_PARTS}))""")
def directory_suffix(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", _session(SESSION_PARTS), text.base_name(F.col("p_name")).alias("base"))
    return naming.simple_names(parts, ["session"], "base", "p_partkey").drop("base")


#: Three bases in a session's turn, so that names clash; each takes the first that is free of base, base_2, base_3, ...
_ODD = "'p' || p_partkey % 3 || CASE WHEN p_partkey % 5 = 0 THEN '_2' WHEN p_partkey % 7 = 0 THEN '_3' ELSE '' END"


@query(f"""WITH s AS (SELECT p_partkey // {FOLDED_PARTS} AS session, list(p_partkey ORDER BY p_partkey) AS keys, list([{_ODD}] ORDER BY p_partkey) AS bases FROM part GROUP BY 1),
n AS (SELECT session, keys, bases, list_reduce(bases, lambda acc, x: list_append(acc, list_filter(list_transform(range(1, len(acc) + 2), lambda k: CASE WHEN k = 1 THEN x[1] ELSE x[1] || '_' || k END), lambda c: NOT list_contains(acc, c))[1])) AS dirs FROM s)
SELECT session, unnest(keys) AS p_partkey, unnest(list_transform(bases, lambda b: b[1])) AS base, unnest(dirs) AS dir FROM n""")
def directory_fold(spark, sf_dir):
    """Some bases already look like given names, so order decides who gets which."""
    key = F.col("p_partkey")
    odd = F.concat(F.lit("p"), (key % 3).cast("string"), F.when(key % 5 == 0, "_2").when(key % 7 == 0, "_3").otherwise(""))
    parts = table(spark, sf_dir, "part").select("p_partkey", _session(FOLDED_PARTS), odd.alias("base"))
    return naming.directory_names(parts, ["session"], "base", "p_partkey")


#: As above, over the whole table as one session: three bases, also numbered ones and numbered ones of those.
_ODDER = "'p' || p_partkey % 3 || CASE WHEN p_partkey % 5 = 0 THEN '_2' WHEN p_partkey % 7 = 0 THEN '_3' WHEN p_partkey % 11 = 0 THEN '_2_2' WHEN p_partkey % 13 = 0 THEN '_40' ELSE '' END"


@query(f"""WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS i, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS j FROM (SELECT p_partkey, {_ODDER} AS base FROM part)),
f AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS p_partkey, '' AS base, CAST([] AS VARCHAR[]) AS used
  UNION ALL SELECT o.i, o.p_partkey, o.base, list_append(f.used, list_filter(list_transform(range(o.j, o.j + 8), lambda k: CASE WHEN k = 1 THEN o.base ELSE o.base || '_' || k END), lambda c: NOT list_contains(f.used, c))[1])
  FROM f JOIN o ON o.i = f.i + 1)
SELECT p_partkey, base, used[-1] AS dir FROM f WHERE i > 0""")
def directory_fold_whole(spark, sf_dir):
    """One session over the whole table; claims to one name are settled by joins."""
    key = F.col("p_partkey")
    end = F.when(key % 5 == 0, "_2").when(key % 7 == 0, "_3").when(key % 11 == 0, "_2_2").when(key % 13 == 0, "_40").otherwise("")
    return naming.directory_names(table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("p"), (key % 3).cast("string"), end).alias("base")), [], "base", "p_partkey")


# --- quoting and formats ------------------------------------------------------------------------------------

_CSV = """coalesce(CASE WHEN regexp_matches({0}, '[,"\\n]') THEN '"' || replace({0}, '"', '""') || '"' ELSE {0} END, '')"""


@query(f"SELECT event_id AS id, 'event' AS kind, {_CSV.format('props')} AS field FROM events UNION ALL SELECT doc_id, 'document', {_CSV.format('text')} FROM documents")
def csv_field_escape(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("event").alias("kind"), text.csv_field(F.col("props")).alias("field"))
    return events.unionAll(table(spark, sf_dir, "documents").select("doc_id", F.lit("document"), text.csv_field(F.col("text"))))


@query(r"""SELECT doc_id, replace(replace(replace(replace(replace(coalesce(text, ''), '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS escaped FROM documents""")
def json_field_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.json_text(F.col("text")).alias("escaped"))


_NUM = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"


@query(f"""SELECT l_orderkey AS k, CAST(l_linenumber AS INTEGER) AS n, {_NUM.format("l_quantity")} AS quantity, {_NUM.format("l_extendedprice")} AS price, CAST(l_quantity AS VARCHAR) AS formula, CAST(l_discount > 0.05 AS VARCHAR) AS flag FROM lineitem
  UNION ALL SELECT o_orderkey, 0, {_NUM.format("o_totalprice")}, o_orderstatus, o_orderpriority, '' FROM orders""")
def cell_text_format(spark, sf_dir):
    none = lambda kind: F.lit(None).cast(kind)
    cell = lambda number=None, string=None, flag=None, formula=None: text.cell_text(
        none("double") if number is None else F.col(number), none("string") if string is None else F.col(string), none("boolean") if flag is None else flag, none("string") if formula is None else formula
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("int").alias("n"), cell("l_quantity").alias("quantity"), cell("l_extendedprice").alias("price"),
        cell("l_quantity", formula=F.lit("SUM(A1)")).alias("formula"), cell(flag=F.col("l_discount") > 0.05).alias("flag"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(0), cell("o_totalprice"), cell(string="o_orderstatus"), cell(string="o_orderpriority", formula=F.lit("A1&B1")), cell())
    return lines.unionAll(orders)


@query("SELECT doc_id, substring(text, 1, 100) AS short, substring(text, 1, 200) AS long FROM documents")
def evidence_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.evidence(F.col("text"), 100).alias("short"), text.evidence(F.col("text"), 200).alias("long"))


@query("SELECT event_id, 'extract_' || strftime(ts, '%Y%m%d_%H%M%S') AS session_id FROM events")
def session_id_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.session_id(F.col("ts")).alias("session_id"))


# --- sheets ----------------------------------------------------------------------------------------------------

_SHEETS = """s AS (
  SELECT 'nation ' || c_nationkey || ' part ' || c_custkey // 10000 AS sheet, c_custkey AS row_no, [CAST(c_custkey AS VARCHAR), c_name, c_mktsegment] AS cells FROM customer
  UNION ALL SELECT 'user ' || user_id, event_id, [CAST(event_id AS VARCHAR), event_type, props] FROM events
  UNION ALL SELECT 'orders of ' || o_custkey, o_orderkey, [CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority] FROM orders)"""


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of sheets of three kinds, so that small and large ones occur; a sheet holds no more customers than its part has."""
    parts = (("customer", "nation ", "c_nationkey", "c_custkey", ("c_name", "c_mktsegment")), ("events", "user ", "user_id", "event_id", ("event_type", "props")), ("orders", "orders of ", "o_custkey", "o_orderkey", ("o_orderstatus", "o_orderpriority")))
    rows = [
        table(spark, sf_dir, name).select(F.concat(F.lit(word), F.col(key).cast("string"), *([F.lit(" part "), F.expr("cast(c_custkey div 10000 as string)")] if name == "customer" else [])).alias("sheet"), F.col(number).alias("row_no"), F.array(F.col(number).cast("string"), *cells).alias("cells"))
        for name, word, key, number, cells in parts
    ]
    return reduce(DataFrame.unionAll, rows)


@query(f"WITH {_SHEETS} SELECT sheet, count(*) AS row_count, CAST(3 AS INTEGER) AS first_width, count(*) > 50 AS is_large FROM s GROUP BY sheet")
def table_classify(spark, sf_dir):
    return tables.classify(_sheets(spark, sf_dir), ["sheet"])


@query(f"""WITH {_D} SELECT doc_id, CAST(coalesce((SELECT min(i) FROM unnest(range(len(ls))) AS t(i) WHERE len(list_filter(string_split(ls[i + 1], ', '), lambda x: regexp_replace(x, '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') <> '')) >= 2), 0) AS INTEGER) AS header_row FROM d""")
def header_row_detect(spark, sf_dir):
    grid = F.transform(text.lines(F.col("text")), lambda line: F.split(line, ", "))
    return table(spark, sf_dir, "documents").select("doc_id", tables.header_index(grid).alias("header_row"))


_NUMBERED = f"{_SHEETS}, r AS (SELECT sheet, row_number() OVER (PARTITION BY sheet ORDER BY row_no) - 1 AS row_no, cells FROM s)"


def _numbered_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered from 0 in each sheet, however long it is."""
    ranks = ranking.ranked(_sheets(spark, sf_dir).select("sheet", "row_no", "cells"), ["sheet"], ["row_no"], "place")
    return ranks.select("sheet", F.col("place").cast("int").alias("row_no"), "cells")


@query(f"""WITH {_NUMBERED}, f AS (SELECT sheet, count(*) AS row_count FROM r GROUP BY sheet HAVING count(*) > 50)
  SELECT sheet, any_value(row_count) AS row_count, CAST(0 AS INTEGER) AS header_row, array_to_string(max(CASE WHEN row_no = 0 THEN cells END), ' | ') AS schema_text,
  'Columns: ' || array_to_string(max(CASE WHEN row_no = 0 THEN cells END), ' | ') || string_agg(CASE WHEN row_no > 0 THEN chr(10) || 'Row ' || row_no || ': ' || array_to_string(cells, ', ') ELSE '' END, '' ORDER BY row_no) AS preview
  FROM r JOIN f USING (sheet) WHERE row_no <= 2 GROUP BY sheet""")
def large_table_schema_preview(spark, sf_dir):
    return tables.large_tables(_numbered_sheets(spark, sf_dir), ["sheet"])


@query("""SELECT r_name AS sheet, '| ' || string_agg(CAST(n_nationkey AS VARCHAR) || ' | ' || n_name || ' |', chr(10) || '| ' ORDER BY n_nationkey) FILTER (WHERE first) || chr(10) || '| --- | --- |' || chr(10)
  || '| ' || string_agg(CAST(n_nationkey AS VARCHAR) || ' | ' || n_name || ' |', chr(10) || '| ' ORDER BY n_nationkey) FILTER (WHERE NOT first) AS markdown
  FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) = 1 AS first FROM nation) JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def small_table_markdown(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nations.select(F.col("r_name").alias("sheet"), F.col("n_nationkey").alias("row_no"), F.array(F.col("n_nationkey").cast("string"), "n_name").alias("cells"))
    return tables.small_tables(rows, ["sheet"])


@query(f"""WITH {_SHEETS} SELECT sheet, row_no, array_to_string(list_transform(cells, lambda x: CASE WHEN regexp_matches(x, '[,"\\n]') THEN '"' || replace(x, '"', '""') || '"' ELSE x END), ',') AS line FROM s""")
def large_table_csv(spark, sf_dir):
    return tables.csv_lines(_sheets(spark, sf_dir), ["sheet"])


#: Workbooks whose sheets are 200 users of events each: a header at 2i, then the table at 2i + 1; large tables are no elements.
BOOK_USERS = 200
_BOOK = f"""u AS (SELECT user_id // {BOOK_USERS} AS book, user_id, count(*) AS n, row_number() OVER (PARTITION BY user_id // {BOOK_USERS} ORDER BY user_id) - 1 AS i FROM events GROUP BY user_id),
b AS (SELECT book, user_id, n, i, 2 * i + 1 AS position, n > 50 AS is_large FROM u),
k AS (SELECT book, count(*) + count(*) FILTER (WHERE NOT is_large) AS elements FROM b GROUP BY book),
c AS (SELECT book, CAST(unnest(range(greatest(1, (elements + 49) // 50))) AS BIGINT) AS q, elements FROM k)"""


def _workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of the workbooks as (book, user_id, n, position, is_large), numbered within their book."""
    sheets = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).withColumn("book", F.expr(f"user_id div {BOOK_USERS}"))
    place = F.row_number().over(_in_order("book", "user_id")) - 1
    return sheets.select("book", "user_id", "n", (2 * place + 1).alias("position"), (F.col("n") > tables.MOST_ROWS).alias("is_large"))


@query(f"""WITH {_BOOK} SELECT book, printf('chunk_%04d.md', q + 1) AS file, CAST(q * 50 AS INTEGER) AS pos_lo, CAST(least(q * 50 + 49, elements - 1) AS INTEGER) AS pos_hi,
  EXISTS (SELECT 1 FROM b WHERE b.book = c.book AND is_large AND position BETWEEN q * 50 AND least(q * 50 + 49, elements - 1)) AS includes_large_table FROM c""")
def chunk_has_large_table(spark, sf_dir):
    """Ranges of chunks are on element indexes, positions of tables are not; both are compared as they are."""
    sheets = _workbooks(spark, sf_dir)
    size = el.CHUNK
    chunks = sheets.groupBy("book").agg((F.count("*") + F.count_if(~F.col("is_large"))).cast("int").alias("n"))
    rows = chunks.select("book", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / size).cast("int"), F.lit(1)) - 1)).alias("q"))
    ranges = rows.select("book", "q", (F.col("q") * size).alias("pos_lo"), F.least(F.col("q") * size + size - 1, F.col("n") - 1).alias("pos_hi"))
    # a table can only lie in the chunk that its position divided by the size names, so the range test becomes an equality and a filter
    held = sheets.where("is_large").select("book", F.expr(f"cast(position div {size} as int)").alias("q"), "position")
    hits = ranges.join(held, ["book", "q"]).where(F.col("position").between(F.col("pos_lo"), F.col("pos_hi"))).select("book", "q").distinct()
    flagged = ranges.join(hits.withColumn("hit", F.lit(True)), ["book", "q"], "left")
    return flagged.select("book", el.chunk_file(F.col("q") + 1).alias("file"), "pos_lo", "pos_hi", F.coalesce("hit", F.lit(False)).alias("includes_large_table"))


@query(f"""WITH {_BOOK} SELECT book, user_id, CAST(position AS INTEGER) AS position, printf('chunk_%04d.md', position // 50 + 1) AS in_chunk, position // 50 < greatest(1, (elements + 49) // 50) AS in_chunk_exists FROM b JOIN k USING (book) WHERE is_large""")
def large_table_in_chunk(spark, sf_dir):
    """The chunk that a position names may not exist; it is then flagged."""
    sheets = _workbooks(spark, sf_dir)
    count = sheets.groupBy("book").agg((F.count("*") + F.count_if(~F.col("is_large"))).alias("elements"))
    number = F.expr(f"cast(position div {el.CHUNK} as int)") + 1
    large = sheets.where("is_large").join(count, "book")
    return large.select("book", "user_id", "position", el.chunk_file(number).alias("in_chunk"), (number <= F.greatest(F.ceil(F.col("elements") / el.CHUNK), F.lit(1))).alias("in_chunk_exists"))


@query(f"""WITH {_NUMBERED} SELECT sheet, '# POS: 1 | TYPE: data_ref | schema: ' || array_to_string(max(CASE WHEN row_no = 0 THEN cells END), ' | ') || ' | rows: ' || count(*) || ' | file: data/' || replace(sheet, ' ', '_') || '.csv' AS line
  FROM r GROUP BY sheet HAVING count(*) > 50""")
def data_ref_lines(spark, sf_dir):
    found = tables.large_tables(_numbered_sheets(spark, sf_dir), ["sheet"])
    return found.select("sheet", tables.data_ref(F.lit(1), F.col("schema_text"), F.col("row_count"), F.col("sheet")).alias("line"))


# --- files of workbooks: a user is a workbook, an event type a sheet; two are wide, so large, and their names sanitise equally

_WIDE = {"error": "big data", "signup": "big_data"}
_FILLERS = ", ".join(f"'x{k}'" for k in range(8))
_WORKBOOKS = f"""sh AS (SELECT user_id, event_type, CASE event_type WHEN 'error' THEN 'big data' WHEN 'signup' THEN 'big_data' ELSE event_type END AS sheet, count(*) AS n,
  event_type IN ('error', 'signup') OR count(*) > 50 AS large, row_number() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS i,
  list(CASE WHEN event_type IN ('error', 'signup') THEN [CAST(event_id AS VARCHAR), event_type, props, {_FILLERS}] ELSE [CAST(event_id AS VARCHAR), event_type, props] END ORDER BY event_id) AS g FROM events GROUP BY user_id, event_type),
fs AS (SELECT *, replace(sheet, ' ', '_') || CASE WHEN row_number() OVER (PARTITION BY user_id, large, replace(sheet, ' ', '_') ORDER BY i) = 1 THEN '' ELSE '_2' END AS file,
  array_to_string(g[1], ' | ') AS head FROM sh),
tx AS (SELECT *, '# POS: ' || 2 * i || ' | TYPE: sheet_header' || chr(10) || '[Sheet: ' || sheet || ']' || chr(10) || chr(10) || CASE WHEN large THEN '' ELSE '# POS: ' || (2 * i + 1) || ' | TYPE: table' || chr(10) || '| ' || head || ' |' || chr(10) || '| --- | --- | --- |'
    || array_to_string(list_transform(g[2:], lambda r: chr(10) || '| ' || array_to_string(r, ' | ') || ' |'), '') || chr(10) || chr(10) END AS told,
  CASE WHEN large THEN '# POS: ' || (2 * i + 1) || ' | TYPE: data_ref | schema: ' || head || ' | rows: ' || n || ' | file: data/' || file || '.csv' || chr(10) || 'Columns: ' || head
    || CASE WHEN n > 1 THEN chr(10) || 'Row 1: ' || array_to_string(g[2], ', ') ELSE '' END || CASE WHEN n > 2 THEN chr(10) || 'Row 2: ' || array_to_string(g[3], ', ') ELSE '' END || chr(10) || chr(10) ELSE '' END AS refs,
  CASE WHEN large THEN '{{"name":"' || file || '.csv","sheet":"' || sheet || '","pos":' || (2 * i + 1) || ',"rows":' || n || ',"file":"data/' || file || '.csv","in_chunk":"chunk_0001.md"}}' END AS listed FROM fs),
wb AS (SELECT 'user_' || user_id AS d, count(*) + count(*) FILTER (WHERE NOT large) AS e, count(*) FILTER (WHERE large) AS t, count(*) AS s, string_agg(told, '' ORDER BY i) AS told, string_agg(refs, '' ORDER BY i) AS refs,
  coalesce(string_agg(listed, ',' ORDER BY i), '') AS listed, max(CASE WHEN large THEN 2 * i + 1 ELSE -1 END) AS last, min(CASE WHEN large THEN 2 * i + 1 ELSE 999 END) AS first FROM tx GROUP BY user_id),
csv AS (SELECT 'user_' || user_id AS d, file, array_to_string(list_transform(g, lambda r: array_to_string(list_transform(r, lambda x: CASE WHEN regexp_matches(x, '[,"\\n]') THEN '"' || replace(x, '"', '""') || '"' ELSE x END), ',') || chr(10)), '') AS content FROM fs WHERE large),
files AS (
  SELECT d || '/' || d || '/' || d || '.md' AS path, '# DOC: 0' || chr(10) || '# SOURCE: ' || d || '.xlsx' || chr(10) || chr(10) || told || refs || '# POS: ' || 2 * s || ' | TYPE: image | file: media/p_q.png' || chr(10) || chr(10)
    || '# POS: ' || (2 * s + 1) || ' | TYPE: image | file: media/p_q_2.png' || chr(10) || chr(10) AS content FROM wb
  UNION ALL SELECT d || '/' || d || '/chunks/index.json', '{{"source":"' || d || '/' || d || '.md","total_elements":' || e || ',"total_large_tables":' || t || ',"total_images":2,"chunk_size":50,"chunks":[{{"file":"chunk_0001.md","pos_range":[0,' || (e - 1) || '],"element_count":' || e
    || ',"includes_large_table":' || CASE WHEN first <= e - 1 THEN 'true' ELSE 'false' END || '}}],"large_tables":[' || listed || ']}}' FROM wb
  UNION ALL SELECT d || '/' || d || '/chunks/chunk_0001.md', '# Chunk 1 of 1' || chr(10) || '# Source: ' || d || '/' || d || '.md' || chr(10) || '# Pos range: 0 - ' || (e - 1) || chr(10) || chr(10) || told FROM wb
  UNION ALL SELECT d || '/' || d || '/data/' || file || '.csv', content FROM csv
  UNION ALL SELECT d || '/' || d || '/media/' || unnest(['p_q.png', 'p_q_2.png']), 'picture of ' || d FROM wb
  UNION ALL SELECT d || '/manifest.json', '{{"session_id":"' || d || '","source_file":"' || d || '.xlsx","docs":[{{"seq":0,"dir":"' || d || '","source":"' || d || '.xlsx","source_copy":"' || d || '/' || d || '.xlsx","type":"xlsx","element_count":' || e
    || ',"data_ref_count":' || t || ',"image_count":2,"parent":"root"}}]}}' FROM wb)"""


def _workbook_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks as ``expand`` gives them: their sheets' rows, a header element per sheet, two pictures after the last sheet."""
    wide = F.col("event_type").isin(*_WIDE)
    plain = [F.col("event_id").cast("string"), F.col("event_type"), F.col("props")]
    cells = F.when(wide, F.array(*plain, *[F.lit(f"x{k}") for k in range(8)])).otherwise(F.array(*plain))
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", cells.alias("cells"))
    # a sheet is one page of a workbook, a workbook one file
    sheets = rows.groupBy("user_id", "event_type").agg(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "cells"))), lambda r: r["cells"]).alias("rows"))
    books = sheets.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_type", "rows"))).alias("pages"))
    name = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    known = F.create_map(*[F.lit(x) for pair in _WIDE.items() for x in pair])
    title = lambda p: F.coalesce(F.try_element_at(known, p["event_type"]), p["event_type"])
    header = lambda p, i: F.struct((2 * i).alias("position"), F.lit("sheet_header").alias("type"), F.concat(F.lit("[Sheet: "), title(p), F.lit("]")).alias("content"), F.lit(None).cast("string").alias("metadata"))
    page = lambda p, i: F.struct(title(p).alias("sheet"), (2 * i + 1).alias("position"), p["rows"].alias("rows"))
    picture = lambda file, k: F.struct(F.lit(file).alias("file_name"), (2 * F.size("pages") + k).alias("position"), F.lit("png").alias("format"), F.encode(F.concat(F.lit("picture of "), name), "UTF-8").alias("data"))
    return books.select(
        name.alias("session_id"), name.alias("dir"), name.alias("base"), F.concat(name, F.lit(".xlsx")).alias("file_name"), F.lit(0).alias("seq"), F.lit(0).alias("depth"), F.lit("xlsx").alias("parser"), F.lit("root").alias("parent"),
        F.transform("pages", header).alias("elements"), F.transform("pages", page).alias("sheets"), F.array(picture("p q.png", 0), picture("p_q.png", 1)).alias("images"),
    )


@query(f"WITH {_WORKBOOKS} SELECT path, md5(content) AS content_md5 FROM files")
def workbook_corpus_files(spark, sf_dir):
    """Every file of the workbooks' corpora: bodies, indexes, chunks, CSV files, pictures, manifests."""
    return corpus.corpus_files(staged(_workbook_documents(spark, sf_dir))).select("path", F.md5("content").alias("content_md5"))


# --- detection and routing -------------------------------------------------------------------------------------

_LIST = ("a.docx", "B.DOCM", "old.doc", "t.xlsx", "t.XLS", "p.pdf", "z.zip", "i.JPeG", "i.webp", "notes.txt", "rows.csv", "noext", "dot.", ".hidden")
_EXT = r"CASE WHEN regexp_extract(name, '(?s)\.([^.]+)\z', 1) = '' THEN 'bin' ELSE lower(regexp_extract(name, '(?s)\.([^.]+)\z', 1)) END"
_PARSER = "CASE WHEN ext IN ('docx', 'docm') THEN 'docx' WHEN ext = 'doc' THEN 'doc' WHEN ext IN ('xlsx', 'xls') THEN 'xlsx' WHEN ext = 'pdf' THEN 'pdf' WHEN ext = 'zip' THEN 'zip' WHEN ext IN ('png', 'jpg', 'jpeg', 'gif', 'bmp', 'tiff', 'tif', 'webp') THEN 'image' END"
_FILES = f"(SELECT *, {_EXT} AS ext FROM (SELECT url AS name FROM pages UNION ALL SELECT unnest({list(_LIST)})))"


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names alone, as of files whose bytes tell nothing."""
    listed = spark.createDataFrame([(n,) for n in _LIST], "name string")
    names = table(spark, sf_dir, "pages").select(F.col("url").alias("name")).unionAll(listed)
    ext = detect.suffix(F.lit(detect.UNKNOWN), F.col("name"))
    return names.select("name", ext.alias("ext"), detect.parser(ext, F.col("name")).alias("parser"))


@query(f"SELECT name, ext, {_PARSER} AS parser FROM {_FILES}")
def handler_route(spark, sf_dir):
    return _routed(spark, sf_dir)


@query(f"SELECT ext, count(*) AS n FROM {_FILES} WHERE {_PARSER} IS NULL GROUP BY ext")
def unsupported_drop(spark, sf_dir):
    return _routed(spark, sf_dir).where("parser is null").groupBy("ext").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CAST(d AS INTEGER) AS depth, CAST(d AS INTEGER) AS seq, 'a_b' || CASE d WHEN 0 THEN '' ELSE '_' || (d + 1) END AS dir, CASE d WHEN 0 THEN 'root' WHEN 1 THEN 'a_b, pos=0' ELSE 'a_b_' || d || ', pos=0' END AS parent, 'png' AS format,
  octet_length(encode(coalesce(text, ''))) + 8 AS n_bytes FROM documents, range(10) t(d)""")
def picture_recursion(spark, sf_dir):
    """Texts as pictures, each of which holds itself down to the depth limit, as older corpora have it; parsed once all the same."""
    content = F.concat(F.unhex(F.lit("89504E470D0A1A0A")), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    sources = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("session_id"), F.lit("a b.png").alias("file_name"), content.alias("content"))
    docs = expand(sources, images_recurse=True)["docs"]
    image = F.get("images", F.lit(0))
    return docs.select(F.col("session_id").alias("doc_id"), "depth", "seq", "dir", "parent", image["format"].alias("format"), F.octet_length(image["data"]).cast("bigint").alias("n_bytes"))


#: What files begin with, the name that they go by, and what both are told to be.
_BEGINS = (
    ("255044462D", "a.txt", "application/pdf", "pdf", "pdf"), ("89504E470D0A1A0A", "b", "image/png", "png", "image"), ("FFD8FFE0", "c.jpeg", "image/jpeg", "jpg", "image"), ("47494638", "d.webp", "image/gif", "gif", "image"),
    ("424D", "e.x.bmp", "image/bmp", "bmp", "image"), ("49492A00", "f.tif", "image/tiff", "tiff", "image"), ("4D4D002A", "g", "image/tiff", "tiff", "image"), ("504B0304", "h.docx", "application/zip", "zip", "zip"),
    ("524946460000000057454250", "i.dat", "image/webp", "webp", "image"), ("D0CF11E0A1B11AE1", "j.XLS", "application/x-ole-storage", "xls", "xlsx"), ("00", "k.Docm", "application/octet-stream", "docm", "docx"), ("00", "l", "application/octet-stream", "bin", None),
)
_BEGUN = ", ".join(f"({k}, '{n}', '{m}', '{e}', {'NULL' if h is None else repr(h)})" for k, (_, n, m, e, h) in enumerate(_BEGINS))


@query(f"SELECT doc_id, name AS file_name, kind, ext, parser, CASE WHEN name LIKE '%.jpeg' THEN 'jpg' WHEN name LIKE '%.tif' THEN 'tiff' WHEN regexp_matches(name, '[.](webp|bmp)$') THEN regexp_extract(name, '[^.]*$') WHEN kind LIKE 'image/%' THEN ext ELSE 'png' END AS picture FROM documents JOIN (VALUES {_BEGUN}) v(k, name, kind, ext, parser) ON k = doc_id % {len(_BEGINS)}")
def sniffed_files(spark, sf_dir):
    """Texts behind the first bytes of known formats, under names that say something else or nothing."""
    k = F.col("doc_id") % len(_BEGINS)
    head = lambda j: F.element_at(F.array(*[F.lit(b[j]) for b in _BEGINS]), (k + 1).cast("int"))
    content = F.concat(F.unhex(head(0)), F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    files = expand_.routed(table(spark, sf_dir, "documents").select("doc_id", head(1).alias("file_name"), content.alias("content")))
    return files.select("doc_id", "file_name", "kind", "ext", "parser", detect.image_format(F.col("file_name"), F.col("kind")).alias("picture"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 'doc ' || doc_id || '.txt' END AS file_name, CASE doc_id % 5 WHEN 0 THEN md5(coalesce(text, '')) WHEN 1 THEN md5('tail' || coalesce(text, '')) WHEN 2 THEN md5(coalesce(text, '') || 'after') END AS content_md5
  FROM documents WHERE coalesce(text, '') <> ''""")
def embedded_objects(spark, sf_dir):
    """Texts in the layout of embedded objects: with a length, without one, with bytes behind it, without a name, without a NUL in reach."""
    rows = table(spark, sf_dir, "documents").where("coalesce(text, '') <> ''")
    bytes_ = lambda c: F.encode(c, "UTF-8")
    how, text_, nul = F.col("doc_id") % 5, bytes_(F.col("text")), F.lit(b"\0")
    name = bytes_(F.concat(F.lit(" doc "), F.col("doc_id").cast("string"), F.lit(".txt ")))
    digits = F.lpad(F.hex(F.octet_length(text_)), 8, "0")
    size = F.unhex(F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)]))
    blob = (
        F.when(how == 0, F.concat(name, nul, size, text_, bytes_(F.lit("beyond"))))
        .when(how == 1, F.concat(name, nul, bytes_(F.lit("tail")), text_))
        .when(how == 2, F.concat(name, nul, text_, bytes_(F.lit("after"))))
        .when(how == 3, F.concat(nul, text_))
        .otherwise(F.concat(bytes_(F.repeat(F.lit("x"), 261)), nul, text_))
    )
    file = packages.object_file(blob)
    return rows.select("doc_id", file["file_name"].alias("file_name"), F.md5(file["data"]).alias("content_md5"))


# --- trees: a binary heap over the parts of a session ------------------------------------------------------------

_HEAP = f"""h AS (SELECT p_partkey // {SESSION_PARTS} AS session, CAST(row_number() OVER (PARTITION BY p_partkey // {SESSION_PARTS} ORDER BY p_partkey) AS INTEGER) AS k, p_partkey FROM part)"""
_TREE = f"""RECURSIVE {_HEAP}, t AS (SELECT session, k, p_partkey, [0] AS path, 0 AS depth FROM h WHERE k = 1
  UNION ALL SELECT h.session, h.k, h.p_partkey, list_append(t.path, h.k % 2), t.depth + 1 FROM t JOIN h ON h.session = t.session AND h.k // 2 = t.k WHERE h.k > 1 AND t.depth + 1 < {{limit}})"""
TREE_DEPTH = 10


def _heap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with the ordinals on the way to them: the bits of their number."""
    rank = F.row_number().over(_in_order("session", "p_partkey"))
    nodes = table(spark, sf_dir, "part").select(_session(SESSION_PARTS), "p_partkey").select("session", "p_partkey", rank.alias("k"))
    bits = F.bin("k")
    return nodes.select("session", "p_partkey", "k", _heap_path(bits).alias("path"), (F.length(bits) - 1).cast("int").alias("depth"))


def _heap_path(bits):
    return F.transform(F.sequence(F.lit(1), F.length(bits)), lambda i: F.when(i == 1, 0).otherwise(F.substr(bits, i, F.lit(1)).cast("int")))


@query(f"WITH {_TREE.format(limit=TREE_DEPTH)} SELECT session, p_partkey, CAST(depth AS INTEGER) AS depth FROM t")
def tree_depth_limit(spark, sf_dir):
    return _heap(spark, sf_dir).where(F.col("depth") < TREE_DEPTH).select("session", "p_partkey", "depth")


@query(f"WITH {_TREE.format(limit=99)} SELECT session, p_partkey, CAST(row_number() OVER (PARTITION BY session ORDER BY path) - 1 AS INTEGER) AS seq FROM t")
def preorder_seq(spark, sf_dir):
    return el.preorder(_heap(spark, sf_dir), ["session"]).select("session", "p_partkey", "seq")


@query("""WITH RECURSIVE h AS (SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS k, p_partkey FROM part), t AS (SELECT k, p_partkey, [0] AS path FROM h WHERE k = 1
  UNION ALL SELECT h.k, h.p_partkey, list_append(t.path, h.k % 2) FROM t JOIN h ON h.k // 2 = t.k WHERE h.k > 1)
SELECT p_partkey, CAST(row_number() OVER (ORDER BY path) - 1 AS INTEGER) AS seq FROM t""")
def preorder_whole(spark, sf_dir):
    """One session over the whole table, so the numbers of ranges are added up."""
    nodes = ranking.ranked(table(spark, sf_dir, "part").select("p_partkey"), [], ["p_partkey"], "k").withColumn("k", F.col("k") + 1)
    return el.preorder(nodes.select("p_partkey", _heap_path(F.bin("k")).alias("path")), []).select("p_partkey", "seq")


@query(f"WITH {_HEAP} SELECT c.session, c.p_partkey, CASE WHEN c.k = 1 THEN 'root' ELSE 'part_' || p.p_partkey || ', pos=' || (c.k % 2) END AS parent FROM h c LEFT JOIN h p ON p.session = c.session AND p.k = c.k // 2 AND c.k > 1")
def parent_label(spark, sf_dir):
    nodes = _heap(spark, sf_dir)
    up = F.when(F.col("depth") > 0, F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(1))))
    above = nodes.select("session", F.col("path").alias("up"), F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("parent_dir"))
    both = nodes.withColumn("up", up).join(above, ["session", "up"], "left")
    return both.select("session", "p_partkey", corpus.parent_label(F.col("parent_dir"), F.element_at("path", -1)).alias("parent"))


@query(f"WITH {_E} SELECT 'doc_' || doc_id AS session_id, idx, idx AS position, content FROM e")
def corpus_reread(spark, sf_dir):
    """Chunk files and manifests of all documents, written in one commit and read back as elements."""
    parsed = _documents(spark, sf_dir).withColumn("session_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))
    chunks = corpus.chunk_markdown(parsed.select("session_id", "elements"), F.lit("d/d.md")).select(F.concat_ws("/", "session_id", F.lit("d/chunks"), "file").alias("path"), "content")
    listed = parsed.select(
        "session_id", F.lit(0).alias("seq"), F.lit("d").alias("dir"), F.lit("d.txt").alias("source"), F.lit("d/d.txt").alias("source_copy"), F.lit("txt").alias("type"),
        F.size("elements").alias("element_count"), F.lit(0).alias("data_ref_count"), F.lit(0).alias("image_count"), F.lit("root").alias("parent"),
    )
    manifests = corpus.manifest_json(listed).select(F.concat_ws("/", "session_id", F.lit("manifest.json")).alias("path"), F.col("manifest").alias("content"))
    folder = new_folder(spark, "quire-corpus")
    corpus_source.save_files(chunks.union(manifests), folder)
    return corpus_source.read_corpora(spark, folder, task_types=["chunk"]).select("session_id", "idx", "position", "content")


# --- expansion: a document is a file that holds its two halves, down to single lines -------------------------------

_HALVES = """RECURSIVE f AS (SELECT doc_id, [0] AS path, 0 AS depth, 'document.half' AS name, CAST(NULL AS INTEGER) AS pos, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
  UNION ALL SELECT doc_id, list_append(path, k), depth + 1, CASE k WHEN 0 THEN 'front.half' ELSE 'back.half' END, CAST(k + 5 AS INTEGER), CASE k WHEN 0 THEN ls[1 : len(ls) // 2] ELSE ls[len(ls) // 2 + 1 :] END
  FROM f, (VALUES (0), (1)) v(k) WHERE len(ls) > 1 AND depth + 1 < 10)"""
_EXPANDED = rf"""{_HALVES}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY path) - 1 AS seq, row_number() OVER (PARTITION BY doc_id, name ORDER BY path) AS r FROM f),
d AS (SELECT *, regexp_replace(name, '\.half$', '') || CASE WHEN r = 1 THEN '' ELSE '_' || r END AS dir FROM n)"""


def halves(data: bytes) -> dict:
    """A container made of lines: one line is an element, several are two files with half of them each."""
    lines = data.split(b"\n")
    if len(lines) == 1:
        return {"elements": [{"position": 0, "type": "paragraph", "content": data.decode(), "metadata": None}]}
    half = len(lines) // 2
    parts = (("front.half", lines[:half]), ("back.half", lines[half:]))
    return {"embedded": [{"file_name": name, "position": k + 5, "data": b"\n".join(part)} for k, (name, part) in enumerate(parts)]}


def _halved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files that hold their halves."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("session_id"), F.lit("document.half").alias("file_name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))


@query(f"""WITH {_EXPANDED} SELECT d.doc_id, CAST(d.seq AS INTEGER) AS seq, CAST(d.depth AS INTEGER) AS depth, d.name AS file_name, d.dir, coalesce(u.dir || ', pos=' || d.pos, 'root') AS parent, d.dir || '/' || d.name AS source_copy,
  CASE WHEN len(d.ls) = 1 THEN md5(d.ls[1]) END AS line_md5 FROM d LEFT JOIN d u ON u.doc_id = d.doc_id AND u.path = d.path[1 : len(d.path) - 1] AND d.depth > 0""")
def expanded_files(spark, sf_dir):
    """Every file within the documents: level, number, directory, parent, and the line that a leaf holds."""
    docs = expand(_halved(spark, sf_dir), parsers={"half": halves})["docs"]
    return docs.select(F.col("session_id").alias("doc_id"), "seq", "depth", "file_name", "dir", "parent", "source_copy", F.md5(F.get("elements", F.lit(0))["content"]).alias("line_md5"))


@query(f"WITH {_EXPANDED} SELECT doc_id || '/' || dir || '/' || name AS path, md5(array_to_string(ls, chr(10))) AS content_md5 FROM d")
def source_copies(spark, sf_dir):
    """The copies of all files, nested ones too, among the files of their corpora."""
    sources = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("session_id"), F.lit("document.half").alias("file_name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    found = expand(sources, parsers={"half": halves}, keep_content=True)
    files = corpus.corpus_files(found["docs"], found["bare"])
    return files.where(F.col("path").endswith(".half")).select("path", F.md5("content").alias("content_md5"))


@query(f"WITH {_HALVES}, c AS (SELECT md5(array_to_string(ls, chr(10))) || ':half' AS content_key, len(ls) > 1 AS holds FROM f) SELECT content_key, CAST(any_value(CASE WHEN holds THEN 2 ELSE 0 END) AS INTEGER) AS n_embedded FROM c GROUP BY content_key")
def parsed_contents(spark, sf_dir):
    """Each distinct content once, however many documents hold it."""
    return expand_.distinct_contents(expand_.contents_of(_halved(spark, sf_dir), parsers={"half": halves})).select("content_key", F.size("embedded").alias("n_embedded"))


# --- review ---------------------------------------------------------------------------------------------------

#: Words of the made-up prose that stand for the keywords of a real corpus.
WORDS = ("ation", "keit", "mente", "ou")
_HIT = "(" + " OR ".join(f"contains(lower({{0}}), '{w}')" for w in WORDS) + ")"


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, with whether the first element has a keyword; every seventh document has a table and every ninth a picture."""
    chunks = el.with_chunks(_documents(spark, sf_dir))
    first = F.coalesce(F.get("elements", F.col("pos_lo"))["content"], F.lit(""))
    hit = review.has_keyword(first, WORDS)
    more = [F.struct(F.lit(kind).alias("task_type"), F.lit(name).alias("file"), F.lit(False).alias("keyword_hit")) for kind, name in (("csv", "data.csv"), ("image", "image.png"))]
    unit = F.struct(F.lit("chunk").alias("task_type"), el.chunk_file(F.col("chunk_no")).alias("file"), hit.alias("keyword_hit"))
    once = F.col("chunk_no") == 1
    listed = F.array_compact(F.array(unit, F.when(once & (F.col("doc_id") % 7 == 0), more[0]), F.when(once & (F.col("doc_id") % 9 == 0), more[1])))
    return chunks.select("doc_id", F.explode(listed).alias("u")).select("doc_id", "u.*")


_UNITS = f"""{_C}, units AS (SELECT doc_id, 'chunk' AS task_type, {_FILE} AS file, {_HIT.format("coalesce(ls[lo + 1], '')")} AS keyword_hit FROM c
  UNION ALL SELECT doc_id, 'csv', 'data.csv', false FROM documents WHERE doc_id % 7 = 0 UNION ALL SELECT doc_id, 'image', 'image.png', false FROM documents WHERE doc_id % 9 = 0)"""


@query(f"""WITH {_UNITS} SELECT doc_id, task_type, file, check_type FROM units, (VALUES ('PII', true, true, true, false), ('REGULATORY', false, true, false, false), ('PAGE_INPUT', true, true, false, false), ('KNOWLEDGE', true, true, true, true)) AS s(check_type, every, chunk, csv, image)
  WHERE (task_type = 'chunk' AND (every OR keyword_hit)) OR (task_type = 'csv' AND csv) OR (task_type = 'image' AND image)""")
def map_task_list(spark, sf_dir):
    return review.tasks(_units(spark, sf_dir)).select("doc_id", "task_type", "file", "check_type")


@query(f"WITH {_C} SELECT doc_id, {_FILE} AS file, {_HIT.format("coalesce(ls[lo + 1], '')")} AS first_hit, {_HIT.format("coalesce(array_to_string(ls[lo + 1:hi + 1], chr(10)), '')")} AS chunk_hit FROM c")
def keyword_chunk_filter(spark, sf_dir):
    chunks = el.with_chunks(_documents(spark, sf_dir))
    own = F.array_join(F.transform(F.slice("elements", F.col("pos_lo") + 1, F.greatest("element_count", F.lit(0))), lambda e: e["content"]), "\n")
    first = F.coalesce(F.get("elements", F.col("pos_lo"))["content"], F.lit(""))
    return chunks.select("doc_id", el.chunk_file(F.col("chunk_no")).alias("file"), review.has_keyword(first, WORDS).alias("first_hit"), review.has_keyword(own, WORDS).alias("chunk_hit"))


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map tasks of the chunks, each with the chunk's elements as text."""
    chunks = el.with_chunks(_documents(spark, sf_dir))
    own = F.array_join(F.transform(F.slice("elements", F.col("pos_lo") + 1, F.greatest("element_count", F.lit(0))), lambda e: e["content"]), "\n")
    units = chunks.select("doc_id", el.chunk_file(F.col("chunk_no")).alias("file"), own.alias("text"), F.lit("chunk").alias("task_type"), review.has_keyword(own, WORDS).alias("keyword_hit"))
    return review.tasks(units).select("doc_id", "file", "check_type", "text")


_TASKS = f"""{_C}, w AS (SELECT doc_id, {_FILE} AS file, coalesce(array_to_string(ls[lo + 1:hi + 1], chr(10)), '') AS text FROM c),
k AS (SELECT w.*, check_type FROM w, (VALUES ('PII'), ('REGULATORY'), ('PAGE_INPUT'), ('KNOWLEDGE')) v(check_type) WHERE check_type <> 'REGULATORY' OR {_HIT.format("text")})"""


def letters_counted(check: str, text: str) -> str:
    """A detector in place of a model."""
    return f"{check}: {text.count('e')} of {len(text)}"


@query(f"WITH {_TASKS} SELECT doc_id, file, check_type, check_type || ': ' || (length(text) - length(replace(text, 'e', ''))) || ' of ' || length(text) AS answer, CAST(1 AS INTEGER) AS tries FROM k")
def executed_tasks(spark, sf_dir):
    """Every task through the durable executor; equal texts of one check are called once."""
    done = executor.run_tasks(_tasks(spark, sf_dir), letters_counted, new_folder(spark, "quire-answers"), buckets=16, calls_per_file=500)
    return done.select("doc_id", "file", "check_type", "answer", "tries")


@query(f"WITH {_TASKS} SELECT doc_id, file, check_type, md5(CASE check_type {' '.join(f"WHEN '{c}' THEN '{p}'" for c, p in review.PROMPTS.items())} END || chr(10) || chr(10) || text) AS prompt_md5 FROM k")
def task_prompts(spark, sf_dir):
    return _tasks(spark, sf_dir).select("doc_id", "file", "check_type", F.md5(review.prompt(F.col("check_type"), F.col("text"))).alias("prompt_md5"))


_PII = f"{_E}, f AS (" + " UNION ALL ".join(
    f"SELECT doc_id, idx AS position, '{c}' AS category, '{f}' AS field, unnest(regexp_extract_all(content, '{p}')) AS value_example, substring(content, 1, 100) AS evidence FROM e" for c, (f, p) in review.PERSONAL.items()
) + rf"), pf AS (SELECT doc_id, position, category, field, value_example, regexp_matches(value_example, '{review.MASKED}') AS has_masking, evidence FROM f)"
_FITS = " OR ".join(f"(category = '{c}' AND regexp_matches(value_example, '{p}'))" for c, p in review.MASKING.items())
_RISK = f"CASE WHEN NOT has_masking THEN 'HIGH' WHEN NOT ({_FITS}) THEN 'MEDIUM' ELSE 'LOW' END"
_PD = f"{_PII}, pd AS (SELECT doc_id, category, field, value_example, list_sort(list(DISTINCT position)) AS pos, min(has_masking) AS has_masking, min(evidence) AS evidence FROM pf GROUP BY ALL)".replace("GROUP BY ALL)", "GROUP BY doc_id, category, field, value_example)")
_PG = f"{_PD}, pg AS (SELECT category, field, value_example, count(*) AS documents, CAST(sum(len(pos)) AS BIGINT) AS places, min(doc_id) AS first_doc_id, min(has_masking) AS has_masking FROM pd GROUP BY category, field, value_example)"


def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a hint of personal data are left out before they are split into lines."""
    likely = table(spark, sf_dir, "documents").where(F.col("text").rlike(review.PERSONAL_HINT))
    return review.personal_findings(el.exploded(el.text_documents(likely)), ["doc_id"])


@query(f"WITH {_PII} SELECT * FROM pf")
def pii_findings(spark, sf_dir):
    return _personal(spark, sf_dir)


@query(f"WITH {_PD} SELECT doc_id, category, field, value_example, array_to_string(pos, ',') AS pos, has_masking, evidence, {_RISK} AS risk FROM pd")
def pii_reduce_doc(spark, sf_dir):
    found = review.personal_by_document(_personal(spark, sf_dir), ["doc_id"])
    return found.withColumn("pos", F.array_join(F.col("pos").cast("array<string>"), ","))


@query(f"WITH {_PG} SELECT category, field, value_example, documents, places, first_doc_id, {_RISK} AS risk FROM pg")
def pii_reduce_global(spark, sf_dir):
    return review.personal_overall(review.personal_by_document(_personal(spark, sf_dir), ["doc_id"]), ["doc_id"])


@query(f"WITH {_PG} SELECT category, {_RISK} AS risk, CAST(CASE {_RISK} WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS INTEGER) AS rank, count(*) AS findings, CAST(sum(places) AS BIGINT) AS places FROM pg GROUP BY ALL")
def pii_risk_rank(spark, sf_dir):
    found = pii_reduce_global(spark, sf_dir)
    grouped = found.groupBy("category", "risk").agg(F.count("*").alias("findings"), F.sum("places").alias("places"))
    return grouped.select("category", "risk", review.risk_order(F.col("risk")).alias("rank"), "findings", "places").orderBy("category", "rank")


#: Rules for found values: a category or all, order, pattern, verdict; several match some values, and the first decides.
RULES = (
    ("e-mail", 2, "@", "HIGH"), ("e-mail", 1, r"\.(org|net)$", "LOW"), ("mobile", 1, r"^\+", "HIGH"), ("mobile", 5, "[0-9]$", "LOW"), ("mobile", 3, "7", "MEDIUM"),
    (None, 4, "[0-9]{4}", "MEDIUM"), ("bank card", 1, "^4", "HIGH"), ("password", 9, ".", "HIGH"), (None, 1, r"\*{3}", "MASKED"),
)
_RULES = ", ".join(f"({'NULL' if c is None else repr(c)}, {o}, '{p}', '{v}')" for c, o, p, v in RULES)


@query(f"""WITH {_PD}, rules(category, ord, pattern, verdict) AS (VALUES {_RULES}) SELECT doc_id, category, field, value_example, coalesce((SELECT arg_min(verdict, (ord, pattern)) FROM rules r
  WHERE (r.category IS NULL OR r.category = pd.category) AND regexp_matches(pd.value_example, r.pattern)), 'UNRULED') AS verdict FROM pd""")
def masking_rules(spark, sf_dir):
    """Values judged by a table of rules, the first match deciding."""
    found = review.personal_by_document(_personal(spark, sf_dir), ["doc_id"]).select("doc_id", "category", "field", "value_example")
    return review.by_rules(found, spark.createDataFrame(RULES, "category string, order int, pattern string, verdict string"), "UNRULED")


_WORDS_OF = "SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark"


@query(rf"""WITH {_E}, w AS (SELECT doc_id, idx, unnest(string_split(content, ' ')) AS word, generate_subscripts(string_split(content, ' '), 1) AS k FROM e),
a AS (SELECT doc_id, idx, word, CAST(coalesce(sum(length(word) + 1) OVER (PARTITION BY doc_id, idx ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS spot FROM w)
SELECT doc_id, word, count(*) AS n, md5(string_agg(idx || ':' || spot, ',' ORDER BY idx, spot)) AS places_md5 FROM a SEMI JOIN ({_WORDS_OF}) b USING (word) WHERE word <> '' GROUP BY doc_id, word""")
def keyword_places(spark, sf_dir):
    """Where the words of all benchmark items stand in the documents."""
    words = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("kind"), F.explode(F.split("text", " ")).alias("word")).distinct()
    found = keywords.keyword_places(_elements(spark, sf_dir).select("doc_id", "position", "content"), words, boundary=" ")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", "at"))), lambda p: F.concat_ws(":", p["position"], p["at"]))
    return found.groupBy("doc_id", "word").agg(F.count("*").alias("n"), F.md5(F.array_join(listed, ",")).alias("places_md5"))


#: Answers of a model, one per document, with what goes wrong with them: cut off, words around, a wrong element.
_ANSWERED = """a AS (SELECT doc_id, doc_id % 5 AS how, '{"category":"' || coalesce(lang, 'none') || '","pos":' || coalesce(length(text), 0) || '}' AS good FROM documents)"""


@query(f"""WITH {_ANSWERED}, g AS (SELECT doc_id, good, unnest(CASE how WHEN 0 THEN [0, 1] WHEN 1 THEN [0] WHEN 2 THEN [0] WHEN 3 THEN [1] ELSE CAST([] AS INTEGER[]) END) AS k FROM a)
SELECT doc_id, CAST(k AS INTEGER) AS k, json_extract_string(good, '$.category') AS category, CAST(json_extract(good, '$.pos') AS INTEGER) AS pos FROM g""")
def salvaged_findings(spark, sf_dir):
    """Elements that fit, from answers that are whole, cut off, surrounded by words, or hold one wrong element."""
    return review.salvaged(_answers(spark, sf_dir), {"category": "string", "pos": "int"}, ["category"])[0]


@query(f"""WITH {_ANSWERED} SELECT doc_id, CAST(CASE how WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS INTEGER) AS k, CASE how WHEN 1 THEN 'no whole element' WHEN 2 THEN 'no whole element' WHEN 3 THEN 'another type of pos' ELSE 'no whole element' END AS reason FROM a WHERE how > 0""")
def rejected_findings(spark, sf_dir):
    return review.salvaged(_answers(spark, sf_dir), {"category": "string", "pos": "int"}, ["category"])[1].select("doc_id", "k", "reason")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.to_json(F.struct(F.coalesce("lang", F.lit("none")).alias("category"), F.coalesce(F.length("text"), F.lit(0)).alias("pos")))
    how = F.col("doc_id") % 5
    answer = (
        F.when(how == 0, F.concat(F.lit("["), good, F.lit(","), good, F.lit("]")))
        .when(how == 1, F.concat(F.lit("["), good, F.lit(',{"category":"cut", "po')))
        .when(how == 2, F.concat(F.lit("Here it is:\n["), good, F.lit("]")))
        .when(how == 3, F.concat(F.lit('[{"category":"x","pos":"no number"},'), good, F.lit("]")))
        .otherwise("I found nothing.")
    )
    return table(spark, sf_dir, "documents").select("doc_id", answer.alias("answer"))


#: Patterns for the made-up prose, one for each attribute and rule.
PROSE_ATTRIBUTES = dict(zip(review.REPORT_ATTRIBUTES, ("the", "and|und", "tion", "ou", "en", "er", "la"), strict=True))
#: What the input fields of events may state.
PROSE_RULES = dict(zip(review.INPUT_RULES, ("[0-9][0-9]", ": [0-5]", "7", "error|click"), strict=True))
PROSE_KNOWLEDGE = {"INDICATOR": r"[a-z]{3,}(?:tion|keit)", "QUALITY_RULE": r"ver[a-z]+", "TAG": r"thou[a-z]*", "DATA_ITEM": r"[a-z]+mente"}


def _bits(patterns: dict[str, str], column: str = "content") -> str:
    return " + ".join(f"CASE WHEN regexp_matches({column}, '{p}') THEN 0 ELSE {1 << k} END" for k, p in enumerate(patterns.values()))


def _listed(patterns: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN (bits & {1 << k}) <> 0 THEN '{n}' END" for k, n in enumerate(patterns)) + "], lambda x: x IS NOT NULL)"


def _reg(patterns: dict[str, str], rows: str) -> str:
    names = ", ".join(f"'{n}'" for n in patterns)
    return rf"""{_E}, {rows}g AS (SELECT lower(regexp_extract(content, '[^\W\d_]+')) AS item_name, bit_or({_bits(patterns)}) AS bits, count(*) AS places FROM {'pe' if rows else 'e'} WHERE regexp_extract(content, '[^\W\d_]+') <> '' GROUP BY 1),
reg AS (SELECT item_name, coalesce(array_to_string({_listed(patterns)}, ','), '') AS missing_fields, coalesce(({_listed(patterns)})[1], 'none') AS severity,
  CAST(coalesce(list_position([{names}], ({_listed(patterns)})[1]), {len(patterns) + 1}) AS INTEGER) AS severity_rank, places FROM g)"""


_REG = _reg(PROSE_ATTRIBUTES, "")


@query(f"WITH {_REG} SELECT * FROM reg")
def regulatory_reduce(spark, sf_dir):
    return review.regulatory_overall(review.regulatory_findings(_elements(spark, sf_dir), ["doc_id"], PROSE_ATTRIBUTES), ["doc_id"], PROSE_ATTRIBUTES)


#: Documents without every tenth one, which its last version empties.
_LAST = _REG.replace("FROM documents)", "FROM documents WHERE doc_id % 10 <> 0)")


@query(f"WITH {_LAST} SELECT * FROM reg")
def regulatory_state(spark, sf_dir):
    """Versions of documents come in three batches, some newest first; the state equals a reduce over the newest."""
    parsed = _documents(spark, sf_dir)
    half = parsed.withColumn("elements", F.slice("elements", F.lit(1), F.floor(F.size("elements") / 2).cast("int")))
    lines, halves_ = (el.exploded(df).select("doc_id", "position", "content") for df in (parsed, half))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    kinds = {1: (docs, halves_), 2: (docs, lines), 3: (docs.where("doc_id % 10 = 0"), lines.where("false"))}
    bits = [f"missing_{k}" for k in range(len(PROSE_ATTRIBUTES))]
    values = {"places": F.lit(1)} | {n: F.shiftright("missing", k).bitwiseAND(F.lit(1)) for k, n in enumerate(bits)}
    batches = ([(1, "doc_id % 2 = 1"), (2, "doc_id % 2 = 0")], [(1, "doc_id % 2 = 0"), (2, "doc_id % 2 = 1")], [(3, "true")])
    folder, out = new_folder(spark, "quire-versions"), new_folder(spark, "quire-changes")
    for batch in batches:  # one after the other, as they would come
        parts = []
        for version, which in batch:
            files, own = (df.where(which) for df in kinds[version])
            found = review.regulatory_findings(own, ["doc_id"], PROSE_ATTRIBUTES).withColumnRenamed("doc_id", "file_id").withColumn("version", F.lit(version))
            parts.append(findings.contributions(files.select(F.col("doc_id").alias("file_id"), F.lit(version).alias("version")), found, values, "item_name"))
        reduce(DataFrame.unionByName, parts).write.mode("append").parquet(folder)
        findings.take_versions(spark, folder, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    names = ["places", *bits]
    kept = findings.state(spark.read.schema(findings.CHANGES).parquet(f"{out}/table"), names, "item_name")
    return review.regulatory_listed(kept.select("item_name", findings.bits_of(bits).alias("bits"), "places"), PROSE_ATTRIBUTES)


#: Words that the specification names, and others, to be planted behind the lines of documents and the fields of events.
SPECIFIED = (
    "owner", "取数逻辑", "rule", "中文名", "definition of", "口径", "scope", "报送范围", "daily", "校验规则", "name", "logic derived", "Owner: logic rule name defined scope weekly", "必填", "format", "枚举", "精度", "required",
    "between 1 and 2, decimal", "取值范围 小数 格式", "不良率", "资本充足比", "click ratio", "完整性", "accuracy", "标签", "label", "user_name", "监管报送", "Disclosure", "nothing",
)
_PLANTED = "[" + ", ".join(f"'{w}'" for w in SPECIFIED) + f"][{{0}} % {len(SPECIFIED)} + 1]"
#: Accented letters go, as the two engines differ in whether one of them ends a word.
_PE = f"pe AS (SELECT doc_id, idx, regexp_replace(content, '[À-ÿ]', 'z', 'g') || ' ' || {_PLANTED.format('(doc_id + idx)')} AS content FROM e), "


def _planted(number):
    return F.element_at(F.array(*[F.lit(w) for w in SPECIFIED]), (number % len(SPECIFIED) + 1).cast("int"))


def _planted_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.regexp_replace("content", "[À-ÿ]", "z"), F.lit(" "), _planted(F.col("doc_id") + F.col("position")))
    return _elements(spark, sf_dir).select("doc_id", "position", line.alias("content"))


@query(f"WITH {_E}, {_PE.rstrip(', ')} SELECT doc_id, idx AS position, " + " OR ".join(f"contains(lower(content), '{k}')" for k in review.KEYWORDS) + " AS hit FROM pe")
def specified_keywords(spark, sf_dir):
    rows = _planted_elements(spark, sf_dir)
    return rows.select("doc_id", "position", review.has_keyword(F.col("content")).alias("hit"))


@query(f"WITH {_reg(review.REPORT_ATTRIBUTES, _PE)} SELECT * FROM reg")
def specified_attributes(spark, sf_dir):
    return review.regulatory_overall(review.regulatory_findings(_planted_elements(spark, sf_dir), ["doc_id"]), ["doc_id"])


@query(f"""WITH {_E}, {_PE}kf AS ({" UNION ALL ".join(f"SELECT '{c}' AS category, unnest(regexp_extract_all(lower(content), '{p}')) AS name FROM pe" for c, p in review.KNOWLEDGE.items())}) SELECT category, name, count(*) AS places FROM kf GROUP BY category, name""")
def specified_knowledge(spark, sf_dir):
    return review.knowledge_overall(review.knowledge_findings(_planted_elements(spark, sf_dir), ["doc_id"]), ["doc_id"]).select("category", "name", "places")


@query(f"""WITH ie AS (SELECT event_type AS field_location, 'Field ' || event_id % 40 || ': ' || {_PLANTED.format('event_id')} AS content FROM events),
ig AS (SELECT lower(trim(string_split(content, ':')[1])) AS field_name, field_location, bit_or({_bits(review.INPUT_RULES)}) AS bits, count(*) AS places FROM ie GROUP BY 1, 2)
SELECT field_name, field_location, coalesce(array_to_string({_listed(review.INPUT_RULES)}, ','), '') AS missing_rules, CAST(bit_count(bits) AS INTEGER) AS n_missing, places FROM ig""")
def specified_inputs(spark, sf_dir):
    line = F.concat(F.lit("Field "), (F.col("event_id") % 40).cast("string"), F.lit(": "), _planted(F.col("event_id")))
    rows = table(spark, sf_dir, "events").select("event_id", F.lit(0).alias("position"), line.alias("content"), "event_type")
    return review.input_overall(review.input_findings(rows, ["event_id"], F.col("event_type")))


_INP = f"""ie AS (SELECT event_id, 0 AS position, event_type AS field_location, 'Field ' || event_id % 40 || ': ' || event_type || ' ' || props AS content FROM events),
ig AS (SELECT substring(lower(trim(string_split(content, ':')[1])), 1, 40) AS field_name, field_location, bit_or({_bits(PROSE_RULES)}) AS bits, count(*) AS places FROM ie WHERE contains(content, ':') GROUP BY 1, 2),
inp AS (SELECT field_name, field_location, coalesce(array_to_string({_listed(PROSE_RULES)}, ','), '') AS missing_rules, CAST(bit_count(bits) AS INTEGER) AS n_missing, places FROM ig)"""


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of a page that describe its input fields."""
    line = F.concat(F.lit("Field "), (F.col("event_id") % 40).cast("string"), F.lit(": "), "event_type", F.lit(" "), "props")
    rows = table(spark, sf_dir, "events").select("event_id", F.lit(0).alias("position"), line.alias("content"), "event_type")
    return review.input_findings(rows, ["event_id"], F.col("event_type"), PROSE_RULES)


@query(f"WITH {_INP} SELECT * FROM inp")
def page_input_reduce(spark, sf_dir):
    return review.input_overall(_inputs(spark, sf_dir), PROSE_RULES)


_KNOW = "kf AS (" + " UNION ALL ".join(f"SELECT doc_id, idx AS position, '{c}' AS category, unnest(regexp_extract_all(lower(content), '{p}')) AS name, substring(content, 1, 200) AS evidence FROM e" for c, p in PROSE_KNOWLEDGE.items()) + """),
know AS (SELECT category, name, count(*) AS places, min({'doc_id': doc_id, 'position': position, 'evidence': evidence}) AS f FROM kf GROUP BY category, name)"""


@query(f"WITH {_E}, {_KNOW} SELECT category, name, places, f.doc_id AS first_doc_id, f.position AS first_position, f.evidence AS evidence FROM know")
def knowledge_reduce(spark, sf_dir):
    return review.knowledge_overall(review.knowledge_findings(_elements(spark, sf_dir), ["doc_id"], PROSE_KNOWLEDGE), ["doc_id"])


def _linked(sql: str, finding: str) -> str:
    """Positions and evidence of each finding in each document, as text."""
    return f"""SELECT {finding}, doc_id, array_to_string(list_transform(h, lambda x: x.position), ',') AS pos, md5(array_to_string(list_transform(h, lambda x: x.evidence), '|')) AS evidence_md5
  FROM (SELECT {finding}, doc_id, list_sort(list(DISTINCT {{'position': position, 'evidence': evidence}})) AS h FROM ({sql}) GROUP BY {finding}, doc_id)"""


def _links(findings: DataFrame, finding: list[str]) -> DataFrame:
    found = review.places(findings, finding, ["doc_id"])
    return found.select(*finding, "doc_id", F.array_join(F.col("pos").cast("array<string>"), ",").alias("pos"), F.md5(F.array_join("evidence", "|")).alias("evidence_md5"))


@query(f"WITH {_PII} {_linked('SELECT * FROM pf', 'category, field, value_example')}")
def pii_places(spark, sf_dir):
    return _links(_personal(spark, sf_dir), ["category", "field", "value_example"])


_ITEMS = r"SELECT lower(regexp_extract(content, '[^\W\d_]+')) AS item_name, doc_id, idx AS position, substring(content, 1, 200) AS evidence FROM e WHERE regexp_extract(content, '[^\W\d_]+') <> ''"


@query(f"WITH {_E} {_linked(_ITEMS, 'item_name')}")
def regulatory_places(spark, sf_dir):
    return _links(review.regulatory_findings(_elements(spark, sf_dir), ["doc_id"], PROSE_ATTRIBUTES), ["item_name"])


@query(f"WITH {_INP} {_linked('SELECT substring(lower(trim(string_split(content, chr(58))[1])), 1, 40) AS field_name, field_location, event_id AS doc_id, position, substring(content, 1, 200) AS evidence FROM ie', 'field_name, field_location')}")
def page_input_places(spark, sf_dir):
    return _links(_inputs(spark, sf_dir).withColumnRenamed("event_id", "doc_id"), ["field_name", "field_location"])


@query(f"WITH {_E}, {_KNOW} {_linked('SELECT * FROM kf', 'category, name')}")
def knowledge_places(spark, sf_dir):
    return _links(review.knowledge_findings(_elements(spark, sf_dir), ["doc_id"], PROSE_KNOWLEDGE), ["category", "name"])


@query(f"WITH {_E}, {_KNOW} SELECT CASE category WHEN 'INDICATOR' THEN 'indicators' WHEN 'TAG' THEN 'tags' WHEN 'DATA_ITEM' THEN 'data_items' ELSE 'quality_rules' END AS list, name, places FROM know")
def knowledge_lists(spark, sf_dir):
    """The four lists of a report, one after the other."""
    lists = review.knowledge_lists(staged(knowledge_reduce(spark, sf_dir)))
    return reduce(DataFrame.unionAll, [rows.select(F.lit(name).alias("list"), "name", "places") for name, rows in lists.items()])


@query(f"""WITH {_PG}, {_REG.removeprefix(_E + ', ')}, {_INP}, {_KNOW} SELECT (SELECT count(*) FROM pg) AS pii_total, (SELECT count(*) FROM pg WHERE {_RISK} = 'HIGH') AS pii_high_risk, (SELECT count(*) FROM reg WHERE missing_fields <> '') AS regulatory_missing,
  (SELECT count(*) FROM inp WHERE n_missing > 0) AS page_input_missing_rules, (SELECT count(*) FROM know WHERE category = 'INDICATOR') AS indicators_extracted, (SELECT count(*) FROM know WHERE category = 'TAG') AS tags_extracted""")
def report_summary(spark, sf_dir):
    """Documents are split into elements once, for all checks but the personal one, which reads few of them."""
    elements = staged(_elements(spark, sf_dir).select("doc_id", "position", "content"))
    regulatory = review.regulatory_overall(review.regulatory_findings(elements, ["doc_id"], PROSE_ATTRIBUTES), ["doc_id"], PROSE_ATTRIBUTES)
    knowledge = review.knowledge_overall(review.knowledge_findings(elements, ["doc_id"], PROSE_KNOWLEDGE), ["doc_id"])
    return review.summary(pii_reduce_global(spark, sf_dir), regulatory, page_input_reduce(spark, sf_dir), knowledge)


_COUNTERS = ("pii_total", "pii_high_risk", "regulatory_missing", "page_input_missing_rules", "indicators_extracted", "tags_extracted")


@query(f"""SELECT '{{"session_id":"review","source_file":"documents","generated_at":"2024-02-03T04:05:06","summary":{{' || {" || ',' || ".join(f"'{chr(34)}{c}{chr(34)}:' || {c}" for c in _COUNTERS)} || '}}}}' AS report FROM ({ORACLE_SQL["report_summary"]})""")
def report_json(spark, sf_dir):
    """The head of a report with its counters."""
    counters = report_summary(spark, sf_dir)
    return counters.select(review.report(F.lit("review"), F.lit("documents"), F.lit("2024-02-03 04:05:06").cast("timestamp"), {c: F.col(c) for c in _COUNTERS}).alias("report"))


@query(f"""WITH {_UNITS} SELECT doc_id, map_tokens, map_tokens + 12000 AS total_tokens FROM (SELECT doc_id, CAST(sum(CASE task_type WHEN 'csv' THEN 3000 WHEN 'chunk' THEN 2000 ELSE 0 END) AS BIGINT) AS map_tokens FROM units GROUP BY doc_id)""")
def token_budget(spark, sf_dir):
    return review.token_budget(_units(spark, sf_dir), ["doc_id"])


@query(f"WITH {_UNITS} SELECT max(n) * 3 + 6 AS parallel_s, CAST(sum(n) AS BIGINT) * 3 + 6 AS serial_s, CAST(9 AS BIGINT) AS full_parallel_s FROM (SELECT doc_id, count(*) AS n FROM units GROUP BY doc_id)")
def wall_time_model(spark, sf_dir):
    return review.wall_time(_units(spark, sf_dir), ["doc_id"])
