"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import packing, perspective_chat, secret_scan, simhash_golay, toxicity, warc_bundles, weak_quality
from millrace.llm.decontamination import decontaminate
from millrace.llm.embedding_dedup import embedding_components
from millrace.llm.line_runs import drop_common_lines
from millrace.llm.suffix_dedup import dedup_substrings
from millrace.llm.tiered_search import build_index, search
from millrace.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cross_polytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_table(spark, sf_dir, "embeddings"))


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_digest(packing.pack(_table(spark, sf_dir, "documents")))


def op3_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay.with_hex(simhash_golay.simhash_components(_table(spark, sf_dir, "documents")))


def op4_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return weak_quality.score_quality(docs, weak_quality.fit_quality(docs))


def op5_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.with_digest(secret_scan.scan_secrets(_table(spark, sf_dir, "documents")))


def op6_perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspective_chat.rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op7_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc_bundles.round_trip(_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), F.col("score"), F.col("predicted"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents"))


def op11_levelled_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(_table(spark, sf_dir, "documents"))


def op12_tiered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    # rows that share an id are one item with all their terms, those of repeated rows too; search() takes equal rows once
    rows = _table(spark, sf_dir, "benchmark").groupBy("item_id").agg(F.array_join(F.collect_list(F.col("text").cast("string")), " ").alias("text"))
    return search(build_index(_table(spark, sf_dir, "documents")), rows)


def op13_chan_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_cross_polytope_dedup": op1_cross_polytope_dedup,
    "op2_sum_of_squares_packing": op2_sum_of_squares_packing,
    "op3_golay_simhash": op3_golay_simhash,
    "op4_weak_label_quality": op4_weak_label_quality,
    "op5_trigram_secret_scan": op5_trigram_secret_scan,
    "op6_perspective_chat": op6_perspective_chat,
    "op7_seekable_warc": op7_seekable_warc,
    "op8_levenshtein_toxicity": op8_levenshtein_toxicity,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_difference_cover_dedup": op10_difference_cover_dedup,
    "op11_levelled_line_dedup": op11_levelled_line_dedup,
    "op12_tiered_search": op12_tiered_search,
    "op13_chan_whitening": op13_chan_whitening,
}

ORACLES: dict[str, str] = {
    "op1_cross_polytope_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL),
        n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM v),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE a.size > 0 AND b.size > 0 AND list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95),
        r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON r.vec_id = l.a),
        m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1),
        k AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
        SELECT m.vec_id, CAST(coalesce(k.n_links, 0) AS BIGINT) AS n_links, m.component_id, m.vec_id = m.component_id AS kept
        FROM m LEFT JOIN k ON m.vec_id = k.vec_id
    """,
    "op9_benchmark_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bs AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(0, len(w) - least(10, len(w)))) AS i FROM b WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS g FROM bs),
        ds AS (SELECT doc_id, w, n, unnest(generate_series(0, len(w) - n)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
        dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS g FROM ds),
        hit AS (SELECT dw.doc_id, win.item_id, dw.i, dw.n FROM dw JOIN win ON dw.n = win.n AND dw.g = win.g),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
        it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items,
               coalesce(it.h, sha256('')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
    """,
    "op6_perspective_chat": """
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content
                   FROM conversations WHERE conv_id IS NOT NULL),
        p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
        r AS (SELECT t.conv_id, p.perspective, t.turn, t.speaker, t.content,
                     CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS role
              FROM t JOIN p ON t.conv_id = p.conv_id),
        n AS (SELECT *, CASE WHEN role = 'user' THEN replace(regexp_replace(speaker, '[ \\t\\r\\n]', '_', 'g'), '<|', '< |') END AS name FROM r),
        h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head, replace(content, '<|', '< |') || '<|im_end|>' AS body FROM n),
        s AS (SELECT *, head || body || chr(10) AS rendered FROM h),
        o AS (SELECT *, CAST(row_number() OVER w AS BIGINT) AS segment,
                     CAST(sum(length(rendered)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "end"
              FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, content))
        SELECT conv_id, perspective, segment, turn, role, name, rendered, CAST("end" - length(rendered) AS BIGINT) AS start, "end",
               CASE WHEN role = 'assistant' THEN CAST("end" - length(rendered) + length(head) AS BIGINT) END AS mask_start,
               CASE WHEN role = 'assistant' THEN CAST("end" - 1 AS BIGINT) END AS mask_end
        FROM o
    """,
    "op7_seekable_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
        k AS (SELECT page_id, octet_length(raw) AS n, sha1(raw) AS digest FROM p),
        b AS (SELECT digest, n, max(page_id) AS best FROM k WHERE n >= 1000 GROUP BY digest, n)
        SELECT k.page_id, CAST(k.n AS BIGINT) AS payload_bytes, k.digest AS payload_digest,
               CASE WHEN k.page_id < b.best THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN k.page_id < b.best THEN b.best END AS refers_to
        FROM k LEFT JOIN b ON k.digest = b.digest AND k.n = b.n
    """,
    "op11_levelled_line_dedup": """
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        j AS (SELECT k.*, c.top IS NOT NULL AND k.doc_id < c.top AS gone FROM k LEFT JOIN c ON k.key = c.key)
        SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id
    """,
    "op12_tiered_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        n AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
        m AS (SELECT doc_id, t, 75 + (25 * CAST(len(t) AS BIGINT) * n.n) // n.l AS m FROM d, n WHERE len(t) > 0),
        tf AS (SELECT doc_id, m, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, m, unnest(t) AS term FROM m) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, n GROUP BY term, n.n),
        a AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
        s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM a JOIN tf ON a.term = tf.term JOIN w ON w.term = a.term GROUP BY ALL),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
    """,
}
