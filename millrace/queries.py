"""Registered queries of the library's own operators over the driver's tables, with SQL twins for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T
from millrace.operators import bm25, chunks, citations, context, hierarchy, quality_audit, quantiles, retrieval_metrics, runs, sampling, term_index, validity
from millrace.sources.session import kept, read_table, shared_folder, ship_package
from millrace.streaming import ingest, paged_stream, source_state, state_log, sync_state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# --- documents as numbered texts ------------------------------------------------------------------------------------
# The tables hold no headings, so every line gets one by its number: a rule of the queries, not of the operators.

HEADS = {0: "'Chương ' || (pos div 9 + 1) || ' '", 1: "'Điều ' || (pos + 1) || '. '", 2: "pos || '. '", 3: "'a) '", 5: "'đ) '", 6: "'Mục ' || (pos div 9 + 1) || ' '", 7: "'Điều này '", 8: "'b) '"}
_HEAD_SPARK = "CASE pos % 9 " + " ".join(f"WHEN {k} THEN {v}" for k, v in HEADS.items()) + " ELSE '' END"
_HEAD_DUCK = _HEAD_SPARK.replace("pos div 9", "pos // 9")


def lines_of(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    return hierarchy.split_lines(docs)


def numbered(spark, sf_dir) -> DataFrame:
    w = W.partitionBy("document_id").orderBy("pos")
    rows = lines_of(spark, sf_dir).withColumn("pos", F.row_number().over(w) - 1)
    return rows.withColumn("text", F.concat(F.expr(_HEAD_SPARK), "text"))


def units_of(spark, sf_dir) -> DataFrame:
    return hierarchy.parse_units(numbered(spark, sf_dir))


def documents_of(spark, sf_dir) -> DataFrame:
    """Documents whose text is their numbered lines."""
    return documents_from(numbered(spark, sf_dir))


def documents_from(rows: DataFrame) -> DataFrame:
    lines = F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    texts = rows.groupBy("document_id").agg(F.array_join(lines, "\n").alias("source_text"))
    return texts.select(
        "document_id",
        F.sha2(F.col("source_text").cast("binary"), 256).alias("source_hash"),
        F.concat(F.lit("http://d/"), "document_id").alias("source_url"),
        F.concat(F.lit("No. "), "document_id").alias("document_number"),
        F.when(F.col("document_id").cast("long") % 3 > 0, F.concat(F.lit("Title "), "document_id")).alias("title"),
        "source_text",
    )


def parsed_of(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(units, documents): each written once, since the steps after them read both several times."""
    units = kept(units_of(spark, sf_dir), "units")
    return units, kept(documents_from(units), "numbered-documents")


LINES = r"""
    raw AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    lines AS (SELECT document_id, CAST(pos AS INT) AS pos, regexp_replace(line, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS text
              FROM raw WHERE regexp_replace(line, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') <> '')"""
PLACED = """
    placed AS (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS start FROM {src})"""
NUMBERED = f"""{LINES},
    ranked AS (SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY pos) - 1 AS INT) AS pos, text FROM lines),
    numbered AS (SELECT document_id, pos, ({_HEAD_DUCK}) || text AS text FROM ranked)"""


def _carry(put: str, clear: str) -> str:
    return f"substr(last_value(CASE WHEN {put} THEN 'v' || found WHEN {clear} THEN '' END IGNORE NULLS) OVER w, 2)"


def _null(x: str) -> str:
    return f"nullif({x}, '')"


_RULES = [(kind, pattern.replace("(?iuU)", "(?i)").replace("(?U)", "")) for kind, pattern in hierarchy.HEADINGS]
_UPPER = "kind IN ('part', 'chapter', 'section')"
UNITS = f"""{NUMBERED},{PLACED.format(src="numbered")},
    kinds AS (SELECT *, CASE {" ".join(f"WHEN regexp_matches(text, '{p}') THEN '{k}'" for k, p in _RULES)} ELSE 'text' END AS kind,
                     CASE {" ".join(f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}', 1)" for k, p in _RULES)} END AS found FROM placed),
    stray AS (SELECT *, kind = 'text' AND regexp_matches(text, '^(?:Điều|ĐIỀU)\\b') AS stray FROM kinds),
    one AS (SELECT *, {_null(_carry("kind = 'part'", "false"))} AS part, {_null(_carry("kind = 'chapter'", "kind = 'part'"))} AS chapter,
                   {_null(_carry("kind = 'section'", "kind IN ('part', 'chapter')"))} AS section,
                   {_null(_carry("kind = 'clause'", f"{_UPPER} OR kind = 'article' OR stray"))} AS clause
            FROM stray WINDOW w AS (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    two AS (SELECT *, kind = 'point' AND clause IS NULL AS orphan FROM one),
    three AS (SELECT *, {_null(_carry("kind = 'article'", f"{_UPPER} OR stray OR orphan"))} AS article,
                     {_null(_carry("kind = 'point' AND NOT orphan", f"{_UPPER} OR kind IN ('article', 'clause') OR stray OR orphan"))} AS point
              FROM two WINDOW w AS (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    units AS (SELECT document_id, pos, text, start, CAST(start + length(text) AS INT) AS "end", kind,
                     CASE kind WHEN 'part' THEN part WHEN 'chapter' THEN chapter WHEN 'section' THEN section WHEN 'article' THEN article WHEN 'clause' THEN clause WHEN 'point' THEN point END AS label,
                     part, chapter, section, article, clause, point,
                     kind IN ('article', 'clause', 'point', 'text') AND article IS NOT NULL AND NOT stray AND NOT orphan AS citation_verified,
                     CASE WHEN orphan THEN '{hierarchy.ORPHAN_POINT}' || start WHEN stray THEN '{hierarchy.STRAY_ARTICLE}' || start END AS warning
              FROM three)"""
_SAME = " AND ".join(f"{k} IS NOT DISTINCT FROM lag({k}) OVER w" for k in ("citation_verified", *hierarchy.LEVELS))
MERGED = f"""{UNITS},
    fresh AS (SELECT *, CASE WHEN lag(kind) OVER w IS NOT NULL AND lag(kind) OVER w NOT IN ('part', 'chapter', 'section') AND kind = 'text' AND {_SAME} THEN 0 ELSE 1 END AS fresh
              FROM units WINDOW w AS (PARTITION BY document_id ORDER BY pos)),
    islands AS (SELECT *, sum(fresh) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM fresh),
    merged AS (SELECT document_id, min(pos) AS pos, min(start) AS start, max("end") AS "end", string_agg(text, chr(10) ORDER BY pos) AS text,
                      {", ".join(f"arg_min_null({c}, pos) AS {c}" for c in ("kind", "label", *hierarchy.LEVELS, "citation_verified"))}
               FROM islands GROUP BY document_id, island)"""
DOCS = """
    docs AS (SELECT document_id, string_agg(text, chr(10) ORDER BY pos) AS source_text FROM numbered GROUP BY document_id),
    documents_n AS (SELECT document_id, sha256(source_text) AS source_hash, 'No. ' || document_id AS document_number, 'http://d/' || document_id AS source_url,
                           CASE WHEN CAST(document_id AS BIGINT) % 3 > 0 THEN 'Title ' || document_id END AS title, source_text FROM docs)"""


def _context_sql(kind: str, clears: list[str]) -> str:
    own = ", ".join(f"'{k}'" for k in [kind, *clears])
    cleared = ", ".join(f"'{k}'" for k in [kind, *clears, "part", "chapter", "section"])
    event = f"CASE WHEN kind = '{kind}' AND citation_verified THEN 'v' || left(string_split(text, chr(10))[1], 300) WHEN kind IN ({cleared}) THEN '' END"
    return f"CASE WHEN kind NOT IN ({own}) THEN nullif(substr(last_value({event} IGNORE NULLS) OVER v, 2), '') END"


HIER = f"""{MERGED},{DOCS},
    told AS (SELECT *, {_context_sql("article", [])} AS c1, {_context_sql("clause", ["article"])} AS c2, {_context_sql("point", ["article", "clause"])} AS c3
             FROM merged WINDOW v AS (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    good AS (SELECT document_id, pos, start, text, kind, part, chapter, section, concat_ws(' | ', c1, c2, c3) AS context,
                    citation_verified AND article IS NOT NULL AS ok, article, clause, point FROM told WHERE kind NOT IN ('part', 'chapter', 'section')),
    path AS (SELECT * REPLACE (CASE WHEN ok THEN article END AS article, CASE WHEN ok THEN clause END AS clause, CASE WHEN ok THEN point END AS point) FROM good),
    named AS (SELECT *, concat_ws(' / ', {", ".join(f"'{k}:' || nullif({k}, '')" for k in hierarchy.LEVELS)}) AS hierarchy FROM path),
    cut AS (SELECT *, unnest(generate_series(0, length(text) - 1, 400)) AS off FROM named WHERE length(text) > 0),
    hier AS (SELECT c.document_id, d.source_hash, CAST(c.start + off AS INT) AS source_start, CAST(c.start + off + length(substr(c.text, CAST(off AS INT) + 1, 400)) AS INT) AS source_end,
                    substr(c.text, CAST(off AS INT) + 1, 400) AS content, c.kind, c.text, c.context, c.hierarchy, c.ok AS citation_verified, CAST(off // 400 + 1 AS INT) AS chunk_part,
                    c.part, c.chapter, c.section, c.article, c.clause, c.point, d.document_number, d.title
             FROM cut c JOIN documents_n d ON c.document_id = d.document_id),
    chunks AS (SELECT sha256(concat_ws('|', document_id, source_hash, source_start, source_end, hierarchy)) AS chunk_id,
                      concat_ws(' | ', nullif(concat_ws(' | ', document_number, title), ''), nullif(hierarchy, ''), nullif(context, ''), nullif(content, '')) AS embed_text,
                      CASE WHEN kind IN ('article', 'clause', 'point') THEN text END AS heading, * EXCLUDE (text) FROM hier)"""
SIZE = 400


def hier_of(spark, sf_dir) -> DataFrame:
    units, docs = parsed_of(spark, sf_dir)
    return chunks.hierarchy_chunks(units, docs, SIZE)


@query(f'WITH {LINES},{PLACED.format(src="lines")} SELECT document_id, pos, start, CAST(start + length(text) AS INT) AS "end", text FROM placed')
def lines_offsets(spark, sf_dir):
    return hierarchy.with_offsets(lines_of(spark, sf_dir)).select("document_id", "pos", "start", "end", "text")


@query(f"WITH {LINES}, b AS (SELECT *, lag(text) OVER (PARTITION BY document_id ORDER BY pos) AS before FROM lines) SELECT document_id, pos, text FROM b WHERE before IS NULL OR before <> text")
def line_run_dedup(spark, sf_dir):
    return hierarchy.drop_repeats(lines_of(spark, sf_dir)).select("document_id", "pos", "text")


_UNIT_COLUMNS = ["document_id", "pos", "start", "end", "kind", "label", *hierarchy.LEVELS, "citation_verified"]


@query(f'WITH {UNITS} SELECT document_id, pos, start, "end", kind, label, {", ".join(hierarchy.LEVELS)}, citation_verified FROM units')
def hierarchy_paths(spark, sf_dir):
    return units_of(spark, sf_dir).select(*_UNIT_COLUMNS)


@query(f"WITH {UNITS} SELECT document_id, pos, warning FROM units WHERE warning IS NOT NULL")
def hierarchy_warnings(spark, sf_dir):
    return units_of(spark, sf_dir).where("warning IS NOT NULL").select("document_id", "pos", "warning")


@query(f'WITH {MERGED} SELECT document_id, pos, start, "end", text, kind, article, clause, point, citation_verified FROM merged')
def unit_islands(spark, sf_dir):
    return chunks.merge_continuations(units_of(spark, sf_dir)).select("document_id", "pos", "start", "end", "text", "kind", "article", "clause", "point", "citation_verified")


@query(f"WITH {HIER} SELECT chunk_id, document_id, source_start, source_end, content, embed_text, heading, {', '.join(hierarchy.LEVELS)}, chunk_part, citation_verified FROM chunks")
def hier_chunks(spark, sf_dir):
    return hier_of(spark, sf_dir).select("chunk_id", "document_id", "source_start", "source_end", "content", "embed_text", "heading", *hierarchy.LEVELS, "chunk_part", "citation_verified")


@query(f"WITH {HIER} SELECT CASE WHEN citation_verified THEN 'chunks' ELSE 'discovery_chunks' END AS sink, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT document_id) AS BIGINT) AS n_documents FROM chunks GROUP BY 1")
def chunk_split_sink(spark, sf_dir):
    sink = F.when(F.col("citation_verified"), "chunks").otherwise("discovery_chunks")
    return hier_of(spark, sf_dir).groupBy(sink.alias("sink")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("document_id").alias("n_documents"))


def _coverage_sql(source: str) -> str:
    return f"""
    judged AS (SELECT c.document_id, c.source_start, c.source_end, c.content, c.source_hash, d.source_hash AS own, d.source_text,
                      row_number() OVER (PARTITION BY c.document_id, c.chunk_id ORDER BY c.source_start, c.source_end) AS again,
                      lag(c.source_end) OVER (PARTITION BY c.document_id ORDER BY c.source_start, c.source_end) AS before
               FROM {source} c JOIN documents_n d ON c.document_id = d.document_id),
    gaps AS (SELECT u.document_id, u.start, u."end", coalesce(sum(CASE WHEN c.source_start IS NOT NULL THEN least(u."end", c.source_end) - greatest(u.start, c.source_start) END), 0) AS held
             FROM units u LEFT JOIN {source} c ON u.document_id = c.document_id AND c.source_start < u."end" AND c.source_end > u.start
             WHERE u.kind NOT IN ('part', 'chapter', 'section') GROUP BY ALL)
    SELECT document_id, source_start AS at, 'repeated chunk id' AS error FROM judged WHERE again > 1
    UNION ALL SELECT document_id, source_start, 'chunk of another source' FROM judged WHERE own <> source_hash
    UNION ALL SELECT document_id, source_start, 'chunk overlaps the one before' FROM judged WHERE source_start < before
    UNION ALL SELECT document_id, source_start, 'content differs from its span' FROM judged WHERE source_end > length(source_text) OR substr(source_text, source_start + 1, source_end - source_start) <> content
    UNION ALL SELECT document_id, start, 'unit not covered' FROM gaps WHERE held < "end" - start"""


@query(f"WITH {HIER},{_coverage_sql('chunks')}")
def chunk_coverage_check(spark, sf_dir):
    """No row: these chunks are sound."""
    units, docs = parsed_of(spark, sf_dir)
    return chunks.coverage_errors(units, docs, chunks.hierarchy_chunks(units, docs, SIZE))


@query(f"""WITH {HIER}, spoilt AS (SELECT chunk_id, document_id, source_start, source_end, CASE WHEN source_start % 13 = 5 THEN 'x' ELSE source_hash END AS source_hash,
           CASE WHEN source_start % 11 = 4 THEN content || '!' ELSE content END AS content FROM chunks JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR source_start % 17 = 6 WHERE source_start % 7 <> 3),{_coverage_sql('spoilt')}""")
def chunk_coverage_broken(spark, sf_dir):
    """The same check of chunks that are spoilt by rule: dropped, repeated, of another source, with other content."""
    units, docs = parsed_of(spark, sf_dir)
    at = F.col("source_start")
    rows = chunks.hierarchy_chunks(units, docs, SIZE).where(at % 7 != 3).withColumn("copy", F.explode(F.when(at % 17 == 6, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    spoilt = rows.withColumn("source_hash", F.when(at % 13 == 5, "x").otherwise(F.col("source_hash"))).withColumn("content", F.when(at % 11 == 4, F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    return chunks.coverage_errors(units, docs, spoilt)


def _windows_sql(variant: str, source: str, limit: int) -> str:
    return f"""
    w AS (SELECT *, unnest(generate_series(first, last - 1, {limit})) AS off FROM ({source}) WHERE last > first),
    k AS (SELECT document_id, source_hash, CAST(off AS INT) AS source_start, CAST(least(off + {limit}, last) AS INT) AS source_end, article, document_number, title, source_text FROM w),
    base AS (SELECT sha256(concat_ws('|', '{variant}', document_id, source_hash, source_start, source_end)) AS chunk_id, document_id, source_start, source_end,
                    substr(source_text, source_start + 1, source_end - source_start) AS content, article FROM k)"""


_FIXED = "SELECT *, 0 AS first, length(source_text) AS last, NULL AS article FROM documents_n"
_ARTICLE = 'SELECT d.*, s.first, s.last, s.article FROM (SELECT document_id, article, min(start) AS first, max("end") AS last FROM units WHERE article IS NOT NULL GROUP BY 1, 2) s JOIN documents_n d ON s.document_id = d.document_id'


@query(f"WITH {NUMBERED},{DOCS},{_windows_sql('fixed', _FIXED, 1800)} SELECT chunk_id, document_id, source_start, source_end, content FROM base")
def fixed_chunks(spark, sf_dir):
    return chunks.fixed_chunks(documents_of(spark, sf_dir)).select("chunk_id", "document_id", "source_start", "source_end", "content")


@query(f"WITH {UNITS},{DOCS},{_windows_sql('article', _ARTICLE, 1800)} SELECT chunk_id, document_id, source_start, source_end, article, content FROM base")
def article_chunks(spark, sf_dir):
    return chunks.article_chunks(units_of(spark, sf_dir), documents_of(spark, sf_dir)).select("chunk_id", "document_id", "source_start", "source_end", "article", "content")


# --- retrieval -------------------------------------------------------------------------------------------------------

_TOK = r"regexp_extract_all(replace(lower({0}), 'ß', 'ss'), '[\p{{L}}\p{{N}}_]+')"
PLAIN = f"""
    plain AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS source_text FROM documents),
    cutp AS (SELECT *, unnest(generate_series(0, length(source_text) - 1, 1800)) AS off FROM plain WHERE length(source_text) > 0),
    pieces AS (SELECT document_id || ':' || CAST(off AS INT) AS chunk_id, document_id, CAST(off AS INT) AS source_start, CAST(least(off + 1800, length(source_text)) AS INT) AS source_end,
                      substr(source_text, CAST(off AS INT) + 1, 1800) AS embed_text FROM cutp),
    toks AS (SELECT chunk_id, {_TOK.format("embed_text")} AS terms FROM pieces),
    terms AS (SELECT chunk_id, len(terms) AS len, unnest(terms) AS term FROM toks),
    tf AS (SELECT chunk_id, term, CAST(len AS BIGINT) AS len, CAST(count(*) AS BIGINT) AS tf FROM terms GROUP BY ALL),
    stats AS (SELECT CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(len(terms)) AS BIGINT) AS total_len, sum(len(terms)) / greatest(1, count(*)) AS avg_len FROM toks),
    df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term)"""
RANKED = f"""{PLAIN},
    asked AS (SELECT DISTINCT item_id AS query_id, unnest({_TOK.format("text")}) AS term FROM benchmark),
    scored AS (SELECT a.query_id, t.chunk_id, round(sum(ln(1.0 + (s.n_chunks::DOUBLE - d.df::DOUBLE + 0.5) / (d.df::DOUBLE + 0.5)) * t.tf::DOUBLE * 2.2::DOUBLE / (t.tf::DOUBLE + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * t.len::DOUBLE / greatest(1.0::DOUBLE, s.avg_len)))), 9) AS score
               FROM asked a JOIN tf t ON a.term = t.term JOIN df d ON d.term = t.term CROSS JOIN stats s GROUP BY 1, 2),
    ranked20 AS (SELECT r.*, p.document_id, p.source_start, p.source_end FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS BIGINT) AS rank FROM scored) r JOIN pieces p ON r.chunk_id = p.chunk_id WHERE rank <= 20)"""
GOLD = """
    gold AS (SELECT b.item_id AS query_id, CAST(d.doc_id AS VARCHAR) AS document_id, CAST(instr(d.text, b.text) - 1 AS INT) AS start, CAST(instr(d.text, b.text) - 1 + length(b.text) AS INT) AS "end"
             FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""


def pieces_of(spark, sf_dir, size: int = 1800) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("source_text"))
    rows = docs.select("document_id", F.posexplode(T.pieces("source_text", size)).alias("piece", "embed_text")).withColumn("source_start", F.col("piece") * size)
    return rows.select(F.concat_ws(":", "document_id", "source_start").alias("chunk_id"), "document_id", "source_start", (F.col("source_start") + F.char_length("embed_text")).alias("source_end"), "embed_text")


def asked_of(spark, sf_dir) -> DataFrame:
    """Each item's whole text as its query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def ranked_of(spark, sf_dir, k: int) -> DataFrame:
    pieces = pieces_of(spark, sf_dir)
    best = kept(bm25.best(pieces, asked_of(spark, sf_dir), k), "ranked")  # k rows a query
    return best.join(pieces.drop("embed_text"), "chunk_id").withColumn("citation_verified", F.lit(True)).persist()


def gold_of(spark, sf_dir) -> DataFrame:
    """Where items stand verbatim in documents, the first place in each document.

    Items are looked up by six of their inner words, shorter ones by all inner words, and then checked in full. Items without
    an inner word are checked against all documents.
    """
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("item"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    # the first and the last word of an item may go on in the document
    inner = F.least(F.size(T.tokens("item")) - 2, F.lit(6))
    keyed = items.where(inner > 0).select("query_id", F.slice(T.tokens("item"), F.lit(2), inner).alias("key"))
    least = items.agg(F.min(inner)).first()[0]
    met = kept(runs.meeting(docs.select("document_id", T.tokens("text").alias("words")), keyed).distinct(), "met")
    # texts meet only the items that share a key with them, by which far fewer rows are moved than there are texts
    hits = docs.join(met, "document_id").join(items, "query_id")
    if least is not None and least <= 0:
        hits = hits.unionByName(docs.crossJoin(items.where(inner <= 0)))  # a stated set of queries
    hits = hits.where(F.contains("text", "item")).select("query_id", "document_id", (F.expr("instr(text, item)") - 1).cast("int").alias("start"), F.char_length("item").alias("n")).distinct()
    w = W.partitionBy("query_id").orderBy("document_id", "start")
    blank = [F.lit(None).cast("string").alias(k) for k in retrieval_metrics.KEYS]
    return hits.select("query_id", F.row_number().over(w).alias("evidence_id"), "document_id", "start", (F.col("start") + F.col("n")).alias("end"), *blank).persist()


def with_null_keys(ranked: DataFrame) -> DataFrame:
    return ranked.select("*", *[F.lit(None).cast("string").alias(k) for k in retrieval_metrics.KEYS])


@query(f"WITH {PLAIN} SELECT chunk_id, term, tf, len FROM tf")
def tokens_tf(spark, sf_dir):
    return bm25.term_frequencies(pieces_of(spark, sf_dir))


@query(f"WITH {PLAIN} SELECT term, df FROM df")
def term_df(spark, sf_dir):
    return bm25.term_frequencies(pieces_of(spark, sf_dir)).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


@query(f"WITH {PLAIN} SELECT n_chunks, total_len, round(avg_len, 6) AS avg_len FROM stats")
def chunk_len_stats(spark, sf_dir):
    return bm25.collection_stats(pieces_of(spark, sf_dir)).withColumn("avg_len", F.round("avg_len", 6))


@query(f"WITH {RANKED} SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM ranked20 WHERE rank <= 10")
def bm25_top10(spark, sf_dir):
    best = bm25.best(pieces_of(spark, sf_dir), asked_of(spark, sf_dir), 10)
    return best.select("query_id", "rank", "chunk_id", F.round("score", 6).alias("score"))


@query(f"WITH {RANKED} SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM ranked20 WHERE rank <= 10")
def bm25_indexed_top10(spark, sf_dir):
    """The same ranking from a stored index of two segments; ranges that can't reach the tenth score aren't read."""
    index = term_index.TermIndex(spark, shared_folder(spark, "term-index"))
    pieces = pieces_of(spark, sf_dir)
    late = F.pmod(F.xxhash64("document_id"), F.lit(4)) == 0  # documents that come in a second delivery
    by = ("document_id", "source_start", "chunk_id")
    term_index.append(index, pieces.where(~late), order_by=by)
    term_index.append(index, pieces.where(late), order_by=by)
    return term_index.top_k(index, asked_of(spark, sf_dir), 10).withColumn("score", F.round("score", 6))


@query(f"WITH {PLAIN} SELECT t.chunk_id, round(ln(1.0 + (s.n_chunks::DOUBLE - d.df::DOUBLE + 0.5) / (d.df::DOUBLE + 0.5)) * t.tf::DOUBLE * 2.2::DOUBLE / (t.tf::DOUBLE + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * t.len::DOUBLE / greatest(1.0::DOUBLE, s.avg_len))), 6) AS score FROM tf t JOIN df d ON t.term = d.term CROSS JOIN stats s WHERE t.term = 'the'")
def bm25_scores_one_term(spark, sf_dir):
    one = spark.createDataFrame([(1, "The the")], "query_id long, query string")
    return bm25.scores(pieces_of(spark, sf_dir), one).select("chunk_id", F.round("score", 6).alias("score"))


@query(f'WITH {GOLD} SELECT query_id, document_id, start, "end" FROM gold')
def gold_spans(spark, sf_dir):
    return gold_of(spark, sf_dir).select("query_id", "document_id", "start", "end")


@query()
def context_pack(spark, sf_dir):
    """What goes into a context of 600 tokens for each item, from the twenty best pieces of two sizes, which overlap."""
    pieces = None
    for size in (1800, 500):
        own = pieces_of(spark, sf_dir, size).withColumn("chunk_id", F.concat_ws(":", F.lit(size), "chunk_id"))
        pieces = own if pieces is None else pieces.unionByName(own)
    best = kept(bm25.best(pieces, asked_of(spark, sf_dir), 20), "ranked")  # twenty rows a query
    # only the terms of what is ranked are counted again
    ranked = best.join(pieces, "chunk_id").withColumn("n_tokens", F.size(T.tokens("embed_text")).cast("long")).drop("embed_text")
    return context.pack_context(ranked, 600).select("query_id", "rank", "document_id", "start", "end", "tokens", "used")


@query()
def citation_audit(spark, sf_dir):
    """Sentences of documents that cite their own text or that of the next one, and the openings of conversations, which cite some document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("document_id"), "text")
    own = F.array_join(F.slice(T.tokens("text"), F.lit(11), F.lit(14)), " ")
    cited = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.col("doc_id") + 1).cast("string")
    said = docs.select("document_id", own.alias("sentence"), cited.alias("cited_id")).where("sentence <> ''")
    taken = said.select(F.concat(F.lit("d"), "document_id").alias("answer_id"), F.lit(0).alias("sentence_no"), "sentence", F.col("cited_id").alias("document_id"), F.lit(0).alias("start"), F.lit(2000).alias("end"))
    turns = table(spark, sf_dir, "conversations")
    opening = F.array_join(F.slice(T.tokens("text"), F.lit(1), F.lit(14)), " ")
    loose = turns.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("answer_id"), F.col("turn").cast("int").alias("sentence_no"), opening.alias("sentence"), F.col("conv_id").cast("string").alias("document_id"), F.lit(0).alias("start"), F.lit(500).alias("end"))
    return citations.audit_citations(taken.unionByName(loose), docs.select("document_id", "text"))


_COVER = """
    hit AS (SELECT g.query_id, g.document_id, g.start AS es, g."end" AS ee, r.rank, greatest(r.source_start, g.start) AS s, least(r.source_end, g."end") AS t
            FROM gold g JOIN ranked20 r ON g.query_id = r.query_id AND g.document_id = r.document_id AND r.source_start < g."end" AND r.source_end > g.start),
    pre AS (SELECT a.query_id, a.document_id, a.es, a.ee, a.rank AS upto, b.s, b.t FROM (SELECT DISTINCT query_id, document_id, es, ee, rank FROM hit) a JOIN hit b ON a.query_id = b.query_id AND a.document_id = b.document_id AND a.es = b.es AND b.rank <= a.rank),
    run AS (SELECT *, coalesce(max(t) OVER (PARTITION BY query_id, document_id, es, upto ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s) AS reach FROM pre),
    cov AS (SELECT query_id, document_id, es, ee, upto AS rank, CAST(sum(greatest(0, t - greatest(s, reach))) AS BIGINT) AS covered FROM run GROUP BY ALL),
    firsts AS (SELECT query_id, document_id, es, min(rank) AS first_rank FROM cov WHERE covered >= 0.8::DOUBLE * (ee - es) GROUP BY ALL)"""


@query(f"WITH {RANKED},{GOLD},{_COVER} SELECT query_id, document_id, es AS start, rank, covered FROM cov")
def prefix_coverage(spark, sf_dir):
    gold = gold_of(spark, sf_dir)
    found = retrieval_metrics.prefix_coverage(with_null_keys(ranked_of(spark, sf_dir, 20)), gold)
    return found.join(gold.select("query_id", "evidence_id", "document_id", "start"), ["query_id", "evidence_id"]).select("query_id", "document_id", "start", "rank", "covered")


_METRICS = """
    rel AS (SELECT DISTINCT g.query_id, r.rank FROM gold g JOIN ranked20 r ON g.query_id = r.query_id AND g.document_id = r.document_id WHERE least(r.source_end, g."end") - greatest(r.source_start, g.start) >= 0.5::DOUBLE * (g."end" - g.start)),
    gains AS (SELECT query_id, sum(1.0::DOUBLE / log2(rank + 1)) AS dcg, count(*) AS n FROM rel GROUP BY 1),
    ideals AS (SELECT query_id, sum(1.0::DOUBLE / log2(i + 1)) AS ideal FROM (SELECT query_id, unnest(generate_series(1, n)) AS i FROM gains) GROUP BY 1),
    exact AS (SELECT g.query_id, min(r.rank) AS er FROM gold g JOIN ranked20 r ON g.query_id = r.query_id AND g.document_id = r.document_id WHERE greatest(0, least(r.source_end, g."end") - greatest(r.source_start, g.start)) >= 0.8::DOUBLE * (g."end" - g.start) GROUP BY 1),
    per AS (SELECT q.query_id, coalesce(f.c5, 0)::DOUBLE / q.n AS recall_at_5, coalesce(f.c10, 0)::DOUBLE / q.n AS recall_at_10, coalesce(f.c20, 0)::DOUBLE / q.n AS recall_at_20,
                   CASE WHEN e.er <= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_citation_at_5, CASE WHEN e.er <= 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_citation_at_10, CASE WHEN e.er <= 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_citation_at_20,
                   coalesce(1.0::DOUBLE / f.best, 0.0::DOUBLE) AS reciprocal_rank, coalesce(g.dcg / i.ideal, 0.0::DOUBLE) AS ndcg
            FROM (SELECT query_id, count(*) AS n FROM gold GROUP BY 1) q
            LEFT JOIN (SELECT query_id, min(first_rank) AS best, count(*) FILTER (WHERE first_rank <= 5) AS c5, count(*) FILTER (WHERE first_rank <= 10) AS c10, count(*) FILTER (WHERE first_rank <= 20) AS c20 FROM firsts GROUP BY 1) f ON q.query_id = f.query_id
            LEFT JOIN exact e ON q.query_id = e.query_id LEFT JOIN gains g ON q.query_id = g.query_id LEFT JOIN ideals i ON q.query_id = i.query_id)"""
_METRIC_NAMES = [f"{m}_at_{k}" for m in ("recall", "exact_citation") for k in (5, 10, 20)] + ["reciprocal_rank", "ndcg"]


def metrics_of(spark, sf_dir) -> DataFrame:
    gold = gold_of(spark, sf_dir)
    return retrieval_metrics.per_query(with_null_keys(ranked_of(spark, sf_dir, 20)), gold, gold.select("query_id").distinct())


@query(f"WITH {RANKED},{GOLD},{_COVER},{_METRICS} SELECT query_id, {', '.join(f'round({m}, 6) AS {m}' for m in _METRIC_NAMES)} FROM per")
def retrieval_per_query(spark, sf_dir):
    return metrics_of(spark, sf_dir).select("query_id", *[F.round(m, 6).alias(m) for m in _METRIC_NAMES])


@query(f"WITH {RANKED},{GOLD},{_COVER},{_METRICS} SELECT 'fixed' AS variant, CAST(count(*) AS BIGINT) AS case_count, {', '.join(f'round(avg({m}), 6) AS ' + m.replace('reciprocal_rank', 'mrr') for m in _METRIC_NAMES)} FROM per")
def retrieval_summary(spark, sf_dir):
    rows = retrieval_metrics.summary(metrics_of(spark, sf_dir).withColumn("variant", F.lit("fixed")))
    return rows.select("variant", "case_count", *[F.round(c, 6).alias(c) for c in rows.columns if c not in ("variant", "case_count")])


# --- the three variants of chunks against evidence with citation keys ------------------------------------------------

_BASE_TEXT = "concat_ws(' | ', nullif(document_number, ''), nullif(title, ''), CASE WHEN article <> '' THEN 'article ' || article END, nullif(substr(source_text, source_start + 1, source_end - source_start), ''))"
VARIANTS = f"""{HIER},
    wf AS (SELECT *, unnest(generate_series(first, last - 1, 1800)) AS off FROM ({_FIXED}) WHERE last > first),
    wa AS (SELECT *, unnest(generate_series(first, last - 1, 1800)) AS off FROM ({_ARTICLE}) WHERE last > first),
    kf AS (SELECT 'fixed' AS variant, document_id, source_hash, CAST(off AS INT) AS source_start, CAST(least(off + 1800, last) AS INT) AS source_end, CAST(NULL AS VARCHAR) AS article, document_number, title, source_text FROM wf),
    ka AS (SELECT 'article' AS variant, document_id, source_hash, CAST(off AS INT) AS source_start, CAST(least(off + 1800, last) AS INT) AS source_end, article, document_number, title, source_text FROM wa),
    variants AS (SELECT variant, sha256(concat_ws('|', variant, document_id, source_hash, source_start, source_end)) AS chunk_id, document_id, source_start, source_end, {_BASE_TEXT} AS embed_text,
                        article, CAST(NULL AS VARCHAR) AS clause, CAST(NULL AS VARCHAR) AS point, article IS NOT NULL AS citation_verified FROM (SELECT * FROM kf UNION ALL SELECT * FROM ka)
                 UNION ALL SELECT 'hierarchy', chunk_id, document_id, source_start, source_end, embed_text, article, clause, point, true FROM chunks WHERE citation_verified)"""


def variants_of(spark, sf_dir) -> DataFrame:
    units, docs = parsed_of(spark, sf_dir)
    return chunks.variant_union(chunks.fixed_chunks(docs), chunks.article_chunks(units, docs), chunks.hierarchy_chunks(units, docs, SIZE))


@query(f"WITH {VARIANTS} SELECT variant, chunk_id, document_id, source_start, source_end, sha256(embed_text) AS text_hash, article, clause, point, citation_verified FROM variants")
def variant_union(spark, sf_dir):
    """The chunks of the fixed, article and hierarchy variants, with a digest of what is embedded."""
    rows = variants_of(spark, sf_dir)
    return rows.select("variant", "chunk_id", "document_id", "source_start", "source_end", F.sha2(F.col("embed_text").cast("binary"), 256).alias("text_hash"), "article", "clause", "point", "citation_verified")


@query(f"WITH {VARIANTS}, t AS (SELECT variant, chunk_id, {_TOK.format('embed_text')} AS terms FROM variants) SELECT variant, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM t GROUP BY 1")
def variant_sizes(spark, sf_dir):
    rows = variants_of(spark, sf_dir).select("variant", T.token_count("embed_text").cast("long").alias("n"))
    return rows.groupBy("variant").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n").alias("n_terms"))


def unit_gold(spark, sf_dir) -> DataFrame:
    """Evidence built from units: every third asks for a wrong article or reaches beyond its unit."""
    units = units_of(spark, sf_dir).where("kind = 'clause'")
    wrong = F.floor(F.col("pos") / 9) % 3
    return units.select(
        F.concat_ws(":", "document_id", "pos").alias("query_id"),
        "document_id",
        F.col("start"),
        F.when(wrong == 1, F.col("end") + 5).otherwise(F.col("end")).alias("end"),
        F.when(wrong == 2, "none").otherwise(F.col("article")).alias("article"),
        "clause",
        F.lit(None).cast("string").alias("point"),
        F.when(F.col("document_id").cast("long") % 2 == 0, "dev").when(F.col("pos") % 2 == 0, "test").otherwise("dev").alias("split"),
    )


UNIT_GOLD = f"""{UNITS},
    ug AS (SELECT document_id || ':' || pos AS query_id, document_id, start, CAST(CASE WHEN pos // 9 % 3 = 1 THEN "end" + 5 ELSE "end" END AS INT) AS "end",
                  CASE WHEN pos // 9 % 3 = 2 THEN 'none' ELSE article END AS article, clause,
                  CASE WHEN CAST(document_id AS BIGINT) % 2 = 0 THEN 'dev' WHEN pos % 2 = 0 THEN 'test' ELSE 'dev' END AS split FROM units WHERE kind = 'clause')"""


@query(f"""WITH {UNIT_GOLD},{DOCS} SELECT g.query_id, g.article, g.clause FROM ug g JOIN docs d ON d.document_id = g.document_id WHERE g.article IS NOT NULL AND g."end" <= length(d.source_text)
    AND EXISTS (SELECT 1 FROM units u WHERE u.document_id = g.document_id AND u.citation_verified AND u.start <= g.start AND g."end" <= u."end" AND u.article = g.article AND (g.clause IS NULL OR u.clause = g.clause))""")
def gold_resolvable(spark, sf_dir):
    return retrieval_metrics.resolvable(unit_gold(spark, sf_dir), units_of(spark, sf_dir), documents_of(spark, sf_dir)).select("query_id", "article", "clause")


@query(f"WITH {UNIT_GOLD} SELECT document_id FROM ug WHERE split = 'dev' INTERSECT SELECT document_id FROM ug WHERE split = 'test'")
def gold_leakage(spark, sf_dir):
    return retrieval_metrics.leaked_documents(unit_gold(spark, sf_dir))


@query(f"""WITH {UNITS},{DOCS}, c AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY CASE kind WHEN 'point' THEN 0 WHEN 'clause' THEN 1 ELSE 2 END, start) AS n FROM units WHERE citation_verified AND kind IN ('point', 'clause', 'article'))
    SELECT c.document_id, d.title, d.source_url, d.source_hash, c.start, c."end", c.article, c.clause, c.point, substr(d.source_text, c.start + 1, c."end" - c.start) AS text FROM c JOIN documents_n d ON c.document_id = d.document_id WHERE n <= 3""")
def annotation_candidates(spark, sf_dir):
    return retrieval_metrics.annotation_candidates(units_of(spark, sf_dir), documents_of(spark, sf_dir))


@query("""WITH v AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
    SELECT event_type, max(CASE WHEN i = n // 2 THEN value END) AS p50, max(CASE WHEN i = least(n - 1, ceil(n * 0.95::DOUBLE) - 1) THEN value END) AS p95 FROM v GROUP BY 1""")
def latency_percentiles(spark, sf_dir):
    return quantiles.latency_percentiles(table(spark, sf_dir, "events"), "value", ("event_type",))


# --- sampling and audit ----------------------------------------------------------------------------------------------

_STRATA = ["status", "kind", "bucket"]
SAMPLED = """
    c AS (SELECT CAST(d.doc_id AS VARCHAR) AS source_id, coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS status, d.lang AS kind,
                 CASE WHEN octet_length(encode(d.text)) < 10000 THEN 'short' WHEN octet_length(encode(d.text)) < 100000 THEN 'medium' ELSE 'long' END AS bucket,
                 CASE WHEN l.doc_id IS NULL THEN 'missing_json_or_html' WHEN d.source = 'src0' THEN 'missing_provenance' WHEN l.toxic = 1 THEN 'invalid_content' WHEN length(d.text) < 200 THEN 'empty_or_mismatched_content' END AS reject_reason
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def candidates_of(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("labelled"))
    rows = docs.join(labels, "doc_id", "left")
    rules = [
        ("missing_json_or_html", F.col("labelled").isNull()),
        ("missing_provenance", F.col("source") == "src0"),
        ("invalid_content", F.col("toxic") == 1),
        ("empty_or_mismatched_content", F.char_length("text") < 200),
    ]
    return rows.select(F.col("doc_id").cast("string").alias("source_id"), T.or_unknown(F.col("quality").cast("string")).alias("status"), F.col("lang").alias("kind"), T.length_bucket(F.octet_length("text")).alias("bucket"), sampling.first_reason(rules).alias("reject_reason"))


@query(f"WITH {SAMPLED} SELECT status, kind, bucket, CAST(count(*) AS BIGINT) AS n FROM c WHERE reject_reason IS NULL GROUP BY 1, 2, 3")
def strata_counts(spark, sf_dir):
    return candidates_of(spark, sf_dir).where("reject_reason IS NULL").groupBy(*_STRATA).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SAMPLED} SELECT reject_reason, CAST(count(*) AS BIGINT) AS n FROM c WHERE reject_reason IS NOT NULL GROUP BY 1")
def reject_reasons(spark, sf_dir):
    return candidates_of(spark, sf_dir).where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


_PILOT = f"{SAMPLED}, r AS (SELECT *, row_number() OVER (PARTITION BY status, kind, bucket ORDER BY sha256('pilot-v1|' || source_id)) AS turn FROM c WHERE reject_reason IS NULL), s AS (SELECT * FROM r ORDER BY turn, status, kind, bucket LIMIT 50)"


@query(f"WITH {_PILOT} SELECT source_id, status, kind, bucket, CAST(turn AS BIGINT) AS turn FROM s")
def stratified_pilot(spark, sf_dir):
    good = candidates_of(spark, sf_dir).where("reject_reason IS NULL")
    return sampling.round_robin(good, _STRATA, 50, "pilot-v1").select("source_id", *_STRATA, "turn")


@query(f"WITH {_PILOT} SELECT a.status, a.kind, a.bucket, CAST(coalesce(b.n, 0) AS BIGINT) AS n_selected FROM (SELECT DISTINCT status, kind, bucket FROM c WHERE reject_reason IS NULL) a LEFT JOIN (SELECT status, kind, bucket, count(*) AS n FROM s GROUP BY 1, 2, 3) b USING (status, kind, bucket)")
def stratum_selected_counts(spark, sf_dir):
    good = candidates_of(spark, sf_dir).where("reject_reason IS NULL")
    return sampling.stratum_counts(good, sampling.round_robin(good, _STRATA, 50, "pilot-v1"), _STRATA)


# A record log over the documents: every fault that the audit knows is put in by the number of the document.

_PAGE = "CASE WHEN n % 23 = 4 THEN '<script>x</script>' ELSE '<p>' || coalesce(lang, '') || ' ' || n || '</p>' END"
_BODY = f"""CASE WHEN n % 29 = 5 THEN '{{"data"' WHEN n % 101 = 22 THEN '{{"data":[]}}' ELSE '{{"data":{{"id":' || n || CASE WHEN n % 11 = 3 THEN '' ELSE ',"title":"t"' END
    || ',"docNum":' || CASE WHEN n % 13 = 2 THEN '""' ELSE '"d"' END || ',"docType":' || CASE WHEN n % 103 = 23 THEN '{{}}' ELSE '{{"name":"x"}}' END || ',"effStatus":' || CASE WHEN n % 17 = 1 THEN 'null' ELSE '{{"name":"y"}}' END
    || ',"issueDate":"2020-01-0' || n % 10 || '","effFrom":' || CASE WHEN n % 107 = 24 THEN '20200201' ELSE '"2020-02-01T00:00:00"' END || ',"effTo":' || CASE n % 7 WHEN 1 THEN '"2019-01-01"' WHEN 2 THEN 'null' WHEN 3 THEN '"2021-13-01"' ELSE '"2021-01-01"' END
    || ',"documentContent":{{"content":"' || CASE WHEN n % 19 = 6 THEN 'other' ELSE page END || '"}}}}}}' END"""
_LOGGED = f"""
    base AS (SELECT doc_id AS n, lang FROM <docs>),
    paged AS (SELECT n, CAST(CASE WHEN n % 89 = 20 THEN n - 1 ELSE n END AS <text>) AS source_id, {_PAGE} AS page FROM base),
    logged AS (SELECT n, source_id, page, {_BODY} AS body FROM paged),
    refs AS (SELECT n, source_id, 0 AS pos, 'document_json' AS kind, source_id AS ref_source, 'http://s/' || n AS url, 'now' AS fetched, CASE WHEN n % 61 = 14 THEN 'x' ELSE <sha_body> END AS sha,
                    CASE WHEN n % 47 = 11 THEN '../' || n ELSE 'artifacts/' || n || '.json' END AS path, CASE WHEN n % 73 = 17 THEN 404 ELSE 200 END AS status FROM logged WHERE n % 31 <> 7
             UNION ALL SELECT n, source_id, 1, 'document_json', source_id, 'http://s/' || n, 'now', <sha_body>, 'artifacts/' || n || '.json', 200 FROM logged WHERE n % 37 = 8
             UNION ALL SELECT n, source_id, 2, 'document_html', CASE WHEN n % 79 = 18 THEN 'z' ELSE source_id END, CASE WHEN n % 67 = 15 THEN 'http://t/' ELSE 'http://s/' END || n, CASE WHEN n % 71 = 16 THEN NULL ELSE 'now' END, <sha_page>, 'artifacts/' || n || '.html', 200 FROM logged WHERE n % 41 <> 9
             UNION ALL SELECT n, source_id, 3, 'document_html', source_id, 'http://s/' || n, 'now', <sha_page>, 'artifacts/' || n || '.html', 200 FROM logged WHERE n % 43 = 10),
    files AS (SELECT 'artifacts/' || n || '.json' AS relative_path, <sha_body> AS sha256, true AS is_text, body AS content FROM logged WHERE n % 53 <> 12
              UNION ALL SELECT 'artifacts/' || n || '.html', <sha_page>, n % 97 <> 21, CASE WHEN n % 97 <> 21 THEN page END FROM logged WHERE n % 59 <> 13)"""


def _log_sql(docs: str, text: str, digest: str) -> str:
    made = {"<docs>": docs, "<text>": text, "<sha_body>": digest.format("body"), "<sha_page>": digest.format("page")}
    sql = _LOGGED
    for mark, value in made.items():
        sql = sql.replace(mark, value)
    return sql


_LOG_DUCK = _log_sql("documents", "VARCHAR", "sha256({})")
_DAY = "CASE WHEN json_type(data, '$.{0}') = 'VARCHAR' THEN try_cast(left(json_extract_string(data, '$.{0}'), 10) AS DATE) END"
_NONE = "(json_type(data, '$.{0}') IS NULL OR json_type(data, '$.{0}') = 'NULL' OR CAST(json_extract(data, '$.{0}') AS VARCHAR) IN ('\"\"', '0', '{{}}', '[]', 'false'))"
_DATED = {d: _DAY.format(d) for d in quality_audit.DATES}
_ROW_RULES = [
    ("json_reference_count", "n_json <> 1"),
    ("html_reference_count", "n_html > 1"),
    ("artifact_source_url_mismatch", "differs"),
    ("missing_html", "n_html = 0"),
    ("missing_document_data", "data IS NULL"),
    *[(f"missing_{f}", f"data IS NOT NULL AND {_NONE.format(f)}") for f in quality_audit.FIELDS],
    *[(f"invalid_{d}", f"data IS NOT NULL AND NOT {_NONE.format(d)} AND ({_DATED[d]}) IS NULL") for d in quality_audit.DATES],
    ("reversed_effective_dates", f"data IS NOT NULL AND ({_DATED['effTo']}) < ({_DATED['effFrom']})"),
    ("record_error", "n % 83 = 19"),
]
_AUDITED = f"""{_LOG_DUCK},
    met AS (SELECT r.*, f.sha256 AS own, f.is_text, f.content,
                   CASE WHEN r.path LIKE '../%' THEN 'unsafe_path' WHEN f.sha256 IS NULL THEN 'missing_artifact' WHEN f.sha256 <> r.sha THEN 'hash_mismatch' END AS fatal
            FROM refs r LEFT JOIN files f ON r.path = f.relative_path),
    judged AS (SELECT *, fatal IS NULL AND ref_source <> source_id AS strange, fatal IS NULL AND fetched IS NULL AS unproven, fatal IS NULL AND status <> 200 AS not_200 FROM met),
    sound AS (SELECT *, fatal IS NULL AND NOT strange AND NOT unproven AND NOT not_200 AS ok FROM judged),
    parsed AS (SELECT *, CASE WHEN ok AND kind = 'document_json' AND json_valid(content) THEN json_extract(content, '$.data') END AS d, ok AND kind = 'document_html' AND is_text AS readable FROM sound),
    per AS (SELECT n, count(*) FILTER (WHERE kind = 'document_json') AS n_json, count(*) FILTER (WHERE kind = 'document_html') AS n_html,
                   arg_min(url, pos) FILTER (WHERE kind = 'document_json') AS json_url, arg_min(url, pos) FILTER (WHERE kind = 'document_html') AS html_url,
                   list(url) FILTER (WHERE kind = 'document_html') AS html_urls, arg_max(CAST(d AS VARCHAR), pos) FILTER (WHERE d IS NOT NULL) AS last,
                   count(*) FILTER (WHERE ok AND kind = 'document_json' AND NOT json_valid(content)) AS bad_json, count(*) FILTER (WHERE ok AND kind = 'document_html' AND NOT is_text) AS bad_encoding,
                   count(*) FILTER (WHERE readable AND content LIKE '<script>%') AS empty_pages, list(content) FILTER (WHERE readable AND content NOT LIKE '<script>%') AS pages FROM parsed GROUP BY n),
    state AS (SELECT l.n, l.source_id, coalesce(n_json, 0) AS n_json, coalesce(n_html, 0) AS n_html, json_url, html_urls, coalesce(json_url <> html_url, false) AS differs, bad_json, bad_encoding, empty_pages, pages,
                     CASE WHEN NOT coalesce(json_url <> html_url, false) AND last LIKE '{{%' THEN CAST(last AS JSON) END AS data FROM logged l LEFT JOIN per p ON l.n = p.n),
    ranked AS (SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY n) AS again FROM logged),
    i AS (SELECT source_id, fatal AS code FROM sound WHERE fatal IS NOT NULL
          UNION ALL SELECT source_id, 'artifact_source_id_mismatch' FROM sound WHERE strange UNION ALL SELECT source_id, 'missing_provenance' FROM sound WHERE unproven UNION ALL SELECT source_id, 'non_200_artifact' FROM sound WHERE not_200
          UNION ALL SELECT source_id, 'duplicate_record_id' FROM ranked WHERE again > 1
          {" ".join(f"UNION ALL SELECT source_id, '{code}' FROM state WHERE {rule}" for code, rule in _ROW_RULES)}
          {" ".join(f"UNION ALL SELECT source_id, '{code}' FROM (SELECT source_id, unnest(generate_series(1, {many})) FROM state)" for code, many in (("invalid_document_json", "bad_json"), ("invalid_html_encoding", "bad_encoding"), ("empty_html", "empty_pages")))}
          UNION ALL SELECT source_id, 'json_html_mismatch' FROM (SELECT source_id, data, unnest(pages) AS page FROM state WHERE data IS NOT NULL) WHERE page <> json_extract_string(data, '$.documentContent.content'))"""


def logged(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, references, files) as the audit reads them from a dataset folder; one scan each."""
    table(spark, sf_dir, "documents").select("doc_id", "lang").createOrReplaceTempView("audited_documents")
    rows = spark.sql(f"WITH {_log_sql('audited_documents', 'STRING', 'sha2({}, 256)')} SELECT * FROM logged")
    n, number, source = F.col("n"), F.col("n").cast("string"), F.col("source_id")
    errors = F.when(n % 83 == 19, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    records = rows.select(n.alias("line_no"), F.struct("source_id", errors.alias("errors")).alias("r"))
    hashed = rows.withColumns({"sha_body": F.sha2("body", 256), "sha_page": F.sha2("page", 256)})
    plain, json_path, html_path = F.concat(F.lit("http://s/"), number), F.concat(F.lit("artifacts/"), number, F.lit(".json")), F.concat(F.lit("artifacts/"), number, F.lit(".html"))

    def ref(pos, kind, held, sha, path, ref_source=source, url=plain, fetched=F.lit("now"), status=F.lit(200)):
        a = F.struct(F.lit(kind).alias("kind"), ref_source.alias("source_id"), url.alias("source_url"), fetched.alias("fetched_at"), sha.alias("sha256"), path.alias("relative_path"), status.alias("http_status"))
        return F.when(held, F.struct(F.lit(pos).alias("pos"), a.alias("a")))

    odd = {"sha": F.when(n % 61 == 14, F.lit("x")).otherwise(F.col("sha_body")), "path": F.when(n % 47 == 11, F.concat(F.lit("../"), number)).otherwise(json_path), "status": F.when(n % 73 == 17, F.lit(404)).otherwise(F.lit(200))}
    strange = {"ref_source": F.when(n % 79 == 18, F.lit("z")).otherwise(source), "url": F.concat(F.when(n % 67 == 15, F.lit("http://t/")).otherwise(F.lit("http://s/")), number), "fetched": F.when(n % 71 != 16, F.lit("now"))}
    refs = [
        ref(0, "document_json", n % 31 != 7, **odd),
        ref(1, "document_json", n % 37 == 8, F.col("sha_body"), json_path),
        ref(2, "document_html", n % 41 != 9, F.col("sha_page"), html_path, **strange),
        ref(3, "document_html", n % 43 == 10, F.col("sha_page"), html_path),
    ]
    is_text = n % 97 != 21
    files = [
        F.when(n % 53 != 12, F.struct(json_path.alias("relative_path"), F.col("sha_body").alias("sha256"), F.lit(True).alias("is_text"), F.col("body").alias("content"))),
        F.when(n % 59 != 13, F.struct(html_path.alias("relative_path"), F.col("sha_page").alias("sha256"), is_text.alias("is_text"), F.when(is_text, F.col("page")).alias("content"))),
    ]
    referenced = hashed.select(n.alias("line_no"), "source_id", F.explode(F.array_compact(F.array(*refs))).alias("ref")).select("line_no", "source_id", "ref.pos", "ref.a")
    return records, referenced, hashed.select(F.explode(F.array_compact(F.array(*files))).alias("file")).select("file.*")


def findings(spark, sf_dir) -> DataFrame:
    records, refs, files = logged(spark, sf_dir)
    state = quality_audit.document_state(records, quality_audit.checked_references(refs, files))
    return quality_audit.repeated_records(records).unionByName(quality_audit.document_issues(state, with_references=True))


@query(f"WITH {_AUDITED} SELECT source_id, code FROM i")
def audit_issues(spark, sf_dir):
    """The audit's own rules over a record log whose faults are put in by number."""
    return findings(spark, sf_dir)


@query(f"WITH {_AUDITED} SELECT code, CAST(count(*) AS BIGINT) AS n FROM i GROUP BY 1")
def audit_issue_counts(spark, sf_dir):
    return quality_audit.count_by_code(findings(spark, sf_dir))


@query("SELECT coalesce(nullif(CAST(l.quality AS VARCHAR), ''), 'unknown') AS status, CAST(count(*) AS BIGINT) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def audit_status_counts(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_audit.count_by_status(docs.join(labels, "doc_id", "left").select(F.col("quality").cast("string").alias("source_status_label")))


@query(f"WITH {_AUDITED} SELECT n AS line_no, source_id FROM state WHERE len(pages) > 0 AND data IS NOT NULL AND n_json = 1 AND n_html = 1 AND list_contains(html_urls, json_url)")
def audit_usable(spark, sf_dir):
    records, refs, files = logged(spark, sf_dir)
    return quality_audit.usable(quality_audit.document_state(records, quality_audit.checked_references(refs, files))).select("line_no", "source_id")


@query(f"WITH {_AUDITED} SELECT relative_path FROM files WHERE relative_path NOT IN (SELECT path FROM refs)")
def audit_orphans(spark, sf_dir):
    _, refs, files = logged(spark, sf_dir)
    return quality_audit.orphans(files.select("relative_path"), refs.select(F.col("a.relative_path").alias("relative_path")))


@query("SELECT sha256(text) AS source_id, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def audit_duplicates(spark, sf_dir):
    return sampling.repeated_ids(table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("source_id")))


@query("SELECT CAST(doc_id AS VARCHAR) AS relative_path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans_anti(spark, sf_dir):
    name = F.col("doc_id").cast("string").alias("relative_path")
    return quality_audit.orphans(table(spark, sf_dir, "documents").select(name), table(spark, sf_dir, "labels").select(name))


@query("SELECT CAST((SELECT count(*) FROM documents) AS BIGINT) AS records, CAST((SELECT count(*) FROM labels) AS BIGINT) AS completed, (SELECT count(*) FROM documents) <> (SELECT count(*) FROM labels) AS mismatch")
def reconcile_counts(spark, sf_dir):
    n = [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias(a)) for t, a in (("documents", "records"), ("labels", "completed"))]
    return n[0].crossJoin(n[1]).withColumn("mismatch", F.col("records") != F.col("completed"))


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_id, CAST(count(*) - 1 AS BIGINT) AS n_suppressed, CAST(max(octet_length(encode(text))) AS BIGINT) AS n_bytes FROM documents GROUP BY 1")
def content_dedup(spark, sf_dir):
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return table(spark, sf_dir, "documents").groupBy(digest.alias("sha256")).agg(F.min("doc_id").alias("first_id"), (F.count(F.lit(1)) - 1).alias("n_suppressed"), F.max(F.octet_length("text")).cast("long").alias("n_bytes"))


@query("SELECT doc_id, sha256(concat_ws('|', 'pilot-v1', doc_id)) AS hash_rank, sha256(concat_ws('|', lang, source, n_chars)) AS row_hash FROM documents")
def sha_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sampling.hash_rank("pilot-v1", "doc_id").alias("hash_rank"), T.sha256_hex("lang", "source", "n_chars").alias("row_hash"))


# --- pages, urls, statuses, dates, JSON ------------------------------------------------------------------------------


# The SQL twins know the markup of these pages only: four entities, no tags within attributes, hrefs that begin with "/".
_PLAIN_TEXT = "replace(replace(replace(replace({0}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_HIDDEN = "(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->"
_SHOWN = f"regexp_replace(html, '{_HIDDEN}|<[^>]*>', '', 'g')"


@query(f"SELECT page_id, CAST(length({_STRIP.format(_PLAIN_TEXT.format(_SHOWN))}) AS BIGINT) AS visible_length FROM pages")
def html_visible_length(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.html_visible_length("html").alias("visible_length"))


_BLOCK_TEXT = f"list_aggregate(list_filter(list_transform(string_split(regexp_replace(block, '<[^>]*>', chr(1), 'g'), chr(1)), lambda t: {_STRIP.format(_PLAIN_TEXT.format('t'))}), lambda t: t <> ''), 'string_agg', ' ')"


@query(f"""WITH b AS (SELECT page_id, unnest(found) AS block, generate_subscripts(found, 1) AS i FROM (SELECT page_id,
               regexp_extract_all(replace(replace(regexp_replace(html, '{_HIDDEN}', '', 'g'), '<p>', '</p><p>'), '</article>', '</p></article>'), '(?s)<(?:p|li|h1)>(.*?)</(?:p|li|h1)>', 1) AS found FROM pages)),
    t AS (SELECT page_id, i, {_BLOCK_TEXT} AS line FROM b), n AS (SELECT *, lag(line) OVER (PARTITION BY page_id ORDER BY i) AS before FROM t WHERE line <> '')
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS pos, line FROM n WHERE before IS NULL OR before <> line""")
def html_blocks(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(H.html_lines("html")).alias("pos", "line"))


@query(f"""WITH h AS (SELECT page_id, unnest(found) AS href, generate_subscripts(found, 1) AS i, regexp_extract(url, '^[a-z]+://[^/?#]+') AS base FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS found FROM pages)),
    f AS (SELECT page_id, base || {_PLAIN_TEXT.format('href')} AS target, min(i) AS i FROM h GROUP BY 1, 2)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS pos, target FROM f""")
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(H.html_links("html", "url")).alias("pos", "target"))


@query(r"SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)) AS origin FROM pages")
def url_origin(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.origin("url").alias("origin"))


@query(r"SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_no FROM pages")
def url_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(F.try_parse_url("url", F.lit("QUERY"), F.lit("page")), F.lit("")).alias("page_no"))


@query("SELECT page_id, CASE WHEN url LIKE 'https://%' THEN url ELSE 'https://example.org/doc/' || page_id END AS canonical_url FROM pages")
def https_fallback(spark, sf_dir):
    fallback = T.from_template("https://example.org/doc/{doc_id}", "page_id")
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.try_parse_url("url", F.lit("PROTOCOL")) == "https", F.col("url")).otherwise(fallback).alias("canonical_url"))


STATUS = ["Còn hiệu lực", "Hết hiệu lực một phần", "Chưa có hiệu lực", "Hết hiệu lực toàn bộ", "CÒN HIỆU LỰC", "Đã hết hiệu lực", "Ngưng", "", None]
_STATUS_SQL = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN {'NULL' if s is None else repr(s)}" for i, s in enumerate(STATUS)) + " END"
_FOLD = r"regexp_replace(replace(replace(lower(strip_accents(s)), 'đ', ''), 'ß', 'ss'), '[^\x00-\x7F]', '', 'g')"


def _statuses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.expr(_STATUS_SQL.replace('"', "'")).alias("s"))


@query(f"SELECT doc_id, {_FOLD} AS folded, CASE {_FOLD} WHEN 'con hieu luc' THEN 'active' WHEN 'het hieu luc mot phan' THEN 'partially_expired' WHEN 'chua co hieu luc' THEN 'future' ELSE 'unclassified' END AS bucket, coalesce({_FOLD} IN ('con hieu luc', 'het hieu luc mot phan', 'chua co hieu luc'), false) AS selected FROM (SELECT doc_id, {_STATUS_SQL} AS s FROM labels)")
def status_bucket_exact(spark, sf_dir):
    return _statuses(spark, sf_dir).select("doc_id", T.folded("s").alias("folded"), T.bucket_exact("s").alias("bucket"), F.coalesce(T.is_selected("s"), F.lit(False)).alias("selected"))


@query(f"SELECT doc_id, CASE WHEN f LIKE '%het hieu luc toan bo%' THEN 'expired' WHEN f LIKE '%het hieu luc mot phan%' THEN 'partially_expired' WHEN f LIKE '%chua co hieu luc%' THEN 'future' WHEN f LIKE '%con hieu luc%' THEN 'active' ELSE 'unclassified' END AS bucket FROM (SELECT doc_id, coalesce({_FOLD}, '') AS f FROM (SELECT doc_id, {_STATUS_SQL} AS s FROM labels))")
def status_bucket_contains(spark, sf_dir):
    return _statuses(spark, sf_dir).select("doc_id", T.bucket_contains("s").alias("bucket"))


_ODD_DATE = "CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 1 THEN '' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' WHEN 3 THEN '2026-13-45' WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') WHEN 5 THEN strftime(o_orderdate, '%Y') || '-W' || lpad(CAST(o_orderkey // 9 % 55 AS VARCHAR), 2, '0') || '-' || (o_orderkey // 7 % 9) WHEN 6 THEN strftime(o_orderdate, '%Y') || 'W' || lpad(CAST(o_orderkey // 9 % 55 AS VARCHAR), 2, '0') ELSE strftime(o_orderdate, '%Y-%m-%d') END"
_WEEK_OF = "date_trunc('week', make_date(CAST(left(s, 4) AS INT), 1, 4))"
_WEEK = "CAST(regexp_extract(s, 'W([0-9][0-9])', 1) AS INT)"
_DAY = "coalesce(CAST(nullif(regexp_extract(s, 'W[0-9][0-9]-?([0-9])$', 1), '') AS INT), 1)"
_PARSED = f"""CASE WHEN regexp_matches(s, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(T|$)') THEN try_cast(left(s, 10) AS DATE)
    WHEN regexp_matches(s, '^[0-9]{{8}}$') THEN try_cast(left(s, 4) || '-' || substr(s, 5, 2) || '-' || substr(s, 7, 2) AS DATE)
    WHEN regexp_matches(s, '^[0-9]{{4}}-?W') AND {_WEEK} BETWEEN 1 AND week(make_date(CAST(left(s, 4) AS INT), 12, 28)) AND {_DAY} BETWEEN 1 AND 7 THEN CAST({_WEEK_OF} + to_days(({_WEEK} - 1) * 7 + {_DAY} - 1) AS DATE) END"""


@query(f"SELECT o_orderkey, {_PARSED} AS parsed, s <> '' AND ({_PARSED}) IS NULL AS invalid FROM (SELECT o_orderkey, {_ODD_DATE} AS s FROM orders)")
def date_validation(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    week = F.lpad((F.floor(key / 9) % 55).cast("string"), 2, "0")
    forms = {0: F.date_format("o_orderdate", "yyyy/MM/dd"), 1: F.lit(""), 2: F.concat(day, F.lit("T00:00:00")), 3: F.lit("2026-13-45"), 4: F.date_format("o_orderdate", "yyyyMMdd")}
    forms[5] = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-W"), week, F.lit("-"), (F.floor(key / 7) % 9).cast("string"))
    forms[6] = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("W"), week)
    odd = F.coalesce(*[F.when(key % 9 == k, v) for k, v in forms.items()], day)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", odd.alias("s"))
    return rows.select("o_orderkey", T.source_date("s").alias("parsed"), ((F.col("s") != "") & T.source_date("s").isNull()).alias("invalid"))


@query("SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS eff_from, CAST(l_shipdate AS DATE) AS eff_to FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)")
def reversed_dates(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    start, end = T.source_date(F.date_format("o_orderdate", "yyyy-MM-dd")), T.source_date(F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return rows.where(end < start).select("l_orderkey", "l_linenumber", start.alias("eff_from"), end.alias("eff_to"))


_VERSIONS = """versions AS (SELECT o_custkey, o_orderdate AS start, max(CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '9999-01-01' ELSE o_orderdate + to_days(CAST(o_orderkey % 400 AS INT)) END) AS "end", max_by(o_orderpriority, (CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '9999-01-01' ELSE o_orderdate + to_days(CAST(o_orderkey % 400 AS INT)) END, o_orderpriority)) AS label
    FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1, 2)"""


@query(f"""WITH {_VERSIONS}, asked AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT a.o_orderkey, CASE WHEN a.o_orderdate <= v."end" THEN v.label END AS label FROM asked a ASOF LEFT JOIN versions v ON a.o_custkey = v.o_custkey AND a.o_orderdate >= v.start""")
def status_as_of(spark, sf_dir):
    """The status of a customer at each order's date; each fifth order begins a status, a third of them are open, many overlap."""
    orders = table(spark, sf_dir, "orders")
    to = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate") + F.make_dt_interval(F.col("o_orderkey") % 400))
    versions = orders.where("o_orderkey % 5 = 0").select("o_custkey", F.col("o_orderdate").alias("start"), to.alias("end"), F.col("o_orderpriority").alias("label"))
    asked = orders.where("o_orderkey % 5 <> 0").select("o_orderkey", "o_custkey", "o_orderdate")
    return validity.as_of(asked, versions, "o_custkey", "o_orderdate", keep=("label",)).select("o_orderkey", "label")


# --- incremental state -----------------------------------------------------------------------------------------------

_LOG = "log AS (SELECT CAST(user_id AS VARCHAR) AS source_id, event_id, event_type FROM events)"


def log_of(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_id"), "event_id", F.col("event_type").alias("action"))


def actions_of(spark, sf_dir) -> DataFrame:
    """Events as actions: the event id decides whether a source was seen, completed or left pending; odd sources never complete."""
    action = F.when((F.col("event_id") % 3 == 0) & (F.col("user_id") % 2 == 0), "completed").when(F.col("event_id") % 3 == 1, "seen").otherwise("pending")
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_id"), F.col("event_id").alias("seq"), action.alias("action"))


_ACTIONS = "acts AS (SELECT CAST(user_id AS VARCHAR) AS source_id, event_id AS seq, CASE WHEN event_id % 3 = 0 AND user_id % 2 = 0 THEN 'completed' WHEN event_id % 3 = 1 THEN 'seen' ELSE 'pending' END AS action FROM events)"
_FOLDED = f"{_ACTIONS}, folded AS (SELECT source_id, true AS seen, bool_or(action = 'completed') AS completed, coalesce(max(CASE WHEN action = 'pending' THEN seq END) > coalesce(max(CASE WHEN action = 'completed' THEN seq END), -1), false) AS pending FROM acts GROUP BY 1)"


@query(f"WITH {_FOLDED} SELECT source_id, seen, completed, pending FROM folded")
def sync_state_fold(spark, sf_dir):
    return sync_state.fold_actions(actions_of(spark, sf_dir))


PAGES = 8  # of events, in the order of their arrival


def put_pages(spark, sf_dir, rows: DataFrame, folder: str, first: int = 0, end: int = PAGES) -> None:
    """Write pages of rows that have a ``seq`` from 0 on, a page for each eighth of the events."""
    size = max(1, -(-table(spark, sf_dir, "events").count() // PAGES))
    paged = rows.withColumn("page", F.expr(f"cast(seq div {size} AS int)")).where(F.col("page").between(first, end - 1))
    paged.hint("rebalance", F.col("page")).write.mode("append").partitionBy("page").parquet(folder)


@query(f"WITH n AS (SELECT greatest(1, CAST(ceil(count(*) / {PAGES}.0) AS BIGINT)) AS size FROM events) SELECT event_id AS seq, event_id // size AS page, event_type FROM events, n")
def paged_events(spark, sf_dir):
    """Events as a stream of pages, in two runs from one checkpoint; every page is read once, over several partitions."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    folder, target = shared_folder(spark, "pages"), shared_folder(spark, "paged-events")
    for first, end in ((0, 3), (3, PAGES)):
        put_pages(spark, sf_dir, rows, folder, first, end)
        stream = paged_stream.read_pages(spark, folder, "seq long, event_type string", f"{target}-at.json", pages_per_batch=3, lanes=4)
        paged_stream.run_once(stream, target, f"{target}-checkpoint")
    return spark.read.schema("seq long, event_type string, page long").parquet(target).select("seq", "event_type", "page")


@query(f"WITH {_FOLDED} SELECT source_id, seen, completed, pending FROM folded")
def keyed_state_stream(spark, sf_dir):
    """The fold of the action log, kept by key while its pages stream in."""
    rows = actions_of(spark, sf_dir).join(table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "ts"), "seq")
    folder, out = shared_folder(spark, "pages"), shared_folder(spark, "keyed-state")
    put_pages(spark, sf_dir, rows, folder)
    columns = "source_id string, seq long, action string, ts timestamp"
    stream = paged_stream.read_pages(spark, folder, columns, f"{out}-at.json", pages_per_batch=4, lanes=4)
    source_state.run(source_state.keyed_state(stream), out, f"{out}-checkpoint")
    return source_state.current(spark, out)


_ARRIVALS = f"""n AS (SELECT count(*) AS n, greatest(1, CAST(ceil(count(*) / {PAGES}.0) AS BIGINT)) AS size FROM events),
    sent AS (SELECT event_id + CASE WHEN event_id % 50 = 0 THEN n // 2 ELSE 0 END AS seq, user_id, event_type, ts FROM events, n
             UNION ALL SELECT event_id + n // 3, user_id, event_type, ts FROM events, n WHERE event_id % 7 = 0),
    came AS (SELECT seq // size // 2 AS batch, user_id, event_type, date_trunc('day', ts) AS day FROM sent, n),
    tops AS (SELECT batch, max(max(day)) OVER (ORDER BY batch) - INTERVAL 2 DAY AS reached FROM came GROUP BY batch)"""


@query(f"""WITH {_ARRIVALS}, marks AS (SELECT c.batch, max(t.reached) AS mark FROM (SELECT DISTINCT batch FROM came) c LEFT JOIN tops t ON t.batch < c.batch - 1 GROUP BY 1)
    SELECT DISTINCT user_id, event_type, CAST(day AS DATE) AS day FROM came c JOIN marks m ON c.batch = m.batch WHERE m.mark IS NULL OR c.day > m.mark""")
def streamed_dedup(spark, sf_dir):
    """What users did on each day, once, from a stream in which a seventh comes again and a fiftieth comes late.

    Rows later than two days behind the watermark are dropped, repeated ones are told by the state of their digests, which ends with
    the watermark. The watermark that rows have to beat is that of the batch before theirs.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    n = events.count()
    once = events.withColumn("seq", F.col("event_id") + F.when(F.col("event_id") % 50 == 0, n // 2).otherwise(0))
    sent = once.unionByName(events.where("event_id % 7 = 0").withColumn("seq", F.col("event_id") + n // 3))
    day = F.date_trunc("day", "ts")
    digest = F.sha2(F.concat_ws("|", "user_id", "event_type", day.cast("string")), 256)
    folder, out = shared_folder(spark, "pages"), shared_folder(spark, "streamed-dedup")
    put_pages(spark, sf_dir, sent.select("seq", "user_id", "event_type", day.alias("day"), digest.alias("sha256")), folder, 0, 2 * PAGES)
    columns = "seq long, user_id long, event_type string, day timestamp, sha256 string"
    stream = paged_stream.read_pages(spark, folder, columns, f"{out}-at.json", pages_per_batch=2, lanes=4)
    paged_stream.run_once(ingest.dedup_content(stream, "2 days", "day"), out, f"{out}-checkpoint")
    return spark.read.schema(f"{columns}, batch long").parquet(out).select("user_id", "event_type", F.col("day").cast("date").alias("day"))


@query(f"WITH {_FOLDED} SELECT source_id, seen, completed, pending FROM folded")
def snapshot_state(spark, sf_dir):
    """The same fold from a snapshot of half the log and the tail that came after it."""
    log = state_log.StateLog(spark, shared_folder(spark, "state-log"))
    acts = actions_of(spark, sf_dir).withColumn("part", F.expr("seq % 4"))
    for part in range(4):
        log.append(acts.where(F.col("part") == part).drop("part"))
        if part in (1, 2):
            log.snapshot()
    return log.state()


@query(f"WITH {_FOLDED} SELECT CAST(count(*) FILTER (WHERE seen) AS BIGINT) AS seen_count, CAST(count(*) FILTER (WHERE completed) AS BIGINT) AS completed_count, CAST(count(*) FILTER (WHERE pending) AS BIGINT) AS pending_count FROM folded")
def sync_state_counts(spark, sf_dir):
    return sync_state.state_counts(sync_state.fold_actions(actions_of(spark, sf_dir)))


@query(f"WITH {_ACTIONS} SELECT DISTINCT source_id FROM acts WHERE action = 'pending' AND source_id NOT IN (SELECT source_id FROM acts WHERE action = 'completed')")
def pending_anti(spark, sf_dir):
    acts = actions_of(spark, sf_dir)
    return sync_state.reconcile_pending(acts.where("action = 'pending'").select("source_id").distinct(), acts.where("action = 'completed'"))


@query("WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) SELECT event_type AS status, CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS status_count, CAST(count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS BIGINT) AS skipped_count FROM e GROUP BY 1")
def seen_counters(spark, sf_dir):
    items = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    return sync_state.status_counters(items, F.col("status").isin("click", "view"))


@query("WITH p AS (SELECT CAST(date_part('hour', ts) AS INT) AS page, CAST(ts AS DATE) AS pass, count(*) AS total FROM events GROUP BY 1, 2), g AS (SELECT *, lag(total) OVER (PARTITION BY pass ORDER BY page) AS before FROM p) SELECT pass, page, CAST(before AS BIGINT) AS before, CAST(total AS BIGINT) AS total FROM g WHERE before <> total")
def total_drift(spark, sf_dir):
    pages = table(spark, sf_dir, "events").groupBy(F.hour("ts").alias("page"), F.to_date("ts").alias("pass")).agg(F.count(F.lit(1)).alias("total"))
    return sync_state.total_drift(pages, ["pass"], "page")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("SELECT conv_id, role, min(turn) AS turn, arg_min(text, turn) AS text FROM conversations GROUP BY 1, 2")
def first_occurrence(spark, sf_dir):
    rows = sampling.first_occurrence(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn", "text"])
    return rows.select("conv_id", "role", "turn", "text")


@query("WITH r AS (SELECT source, doc_id, n_chars, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS BIGINT) AS place FROM documents) SELECT * FROM r WHERE place <= 3")
def topk_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return sampling.top_per_group(rows, ["source"], [F.desc("n_chars"), "doc_id"], 3)


# --- dense and fused ranking -----------------------------------------------------------------------------------------

_COS = """
    v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    z AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda y: y * y))) AS n FROM v),
    n AS (SELECT vec_id, list_transform(e, lambda x: x / n) AS u FROM z),
    pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_inner_product(a.u, b.u), 6) AS score FROM n a JOIN n b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    top AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS BIGINT) AS rank FROM pairs)"""


def dense_top(spark, sf_dir, k: int) -> DataFrame:
    from millrace.operators.dense import cosine_top_k

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cosine_top_k(vectors, vectors.where("vec_id % 100 = 0"), k)


@query(f"WITH {_COS} SELECT query_id, vec_id, rank, score FROM top WHERE rank <= 10")
def dense_cosine_topk(spark, sf_dir):
    return dense_top(spark, sf_dir, 10)


@query(f"""WITH {_COS}, a AS (SELECT query_id, vec_id, rank FROM top WHERE rank <= 20),
    b AS (SELECT a.query_id, a.vec_id, CAST(row_number() OVER (PARTITION BY a.query_id ORDER BY abs(e.label - q.label), a.vec_id) AS BIGINT) AS rank FROM a JOIN embeddings e ON a.vec_id = e.vec_id JOIN embeddings q ON a.query_id = q.vec_id),
    f AS (SELECT query_id, vec_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2)
    SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS BIGINT) AS rank FROM f""")
def rrf_fusion(spark, sf_dir):
    from millrace.operators.dense import reciprocal_rank_fusion

    a = dense_top(spark, sf_dir, 20).select("query_id", "vec_id", "rank")
    label = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    other = a.join(label, "vec_id").join(label.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id")
    w = W.partitionBy("query_id").orderBy(F.abs(F.col("label") - F.col("own")), "vec_id")
    b = other.select("query_id", "vec_id", F.row_number().over(w).cast("long").alias("rank"))
    return reciprocal_rank_fusion([a, b], "vec_id")
