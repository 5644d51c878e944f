"""The registered queries of the operators, over their whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import prepare, read


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.mixing import planned_mix

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return planned_mix(docs).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


_OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals
), levels AS (
  SELECT *,
         CAST(3 * CAST(sum(source_size) OVER () AS BIGINT)
              - 2 * (CAST(sum(cap) OVER so_far AS BIGINT) - cap) AS DOUBLE)
         / CAST(2 * CAST(sum(weight) OVER from_here AS BIGINT) AS DOUBLE) AS level
  FROM weighed
  WINDOW so_far AS (ORDER BY CAST(cap AS DOUBLE) / weight, encode(source) NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         from_here AS (ORDER BY CAST(cap AS DOUBLE) / weight, encode(source) NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, encode(source) NULLS LAST) AS place
  FROM levels
), opened AS (
  SELECT place AS open_place, level AS open_level FROM numbered
  WHERE level * weight < cap ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN place >= open_place THEN weight * open_level ELSE CAST(cap AS DOUBLE) END AS target
  FROM numbered LEFT JOIN opened ON true
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null'))[1:13] AS BIGINT) AS DOUBLE)
         / 4503599627370496.0 AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.embedding_dedup import near_vectors

    return near_vectors(read(spark, sf_dir, "embeddings"))


_OP2_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
), normed AS (
  SELECT vec_id, label, e, sqrt(list_sum([x * x FOR x IN e])) AS norm FROM usable
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0
   AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id,
       e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.node = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.secret_scan import scan_secrets

    return scan_secrets(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.ngram_join import jaccard_join

    return jaccard_join(read(spark, sf_dir, "documents"))


_OP4_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_reduce(w, lambda a, b: a || ' ' || b)]
         ELSE [w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4]
               FOR i IN range(1, len(w) - 3)] END) AS s
  FROM worded
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sized x ON x.doc_id = c.a JOIN sized y ON y.doc_id = c.b
  WHERE c.n / (x.n + y.n - c.n) >= 0.8
), reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.class_id, d.doc_id = l.class_id AS kept
FROM documents d JOIN least l ON l.node = d.doc_id LEFT JOIN counted c ON c.a = d.doc_id
"""


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.packing import pack_documents

    return pack_documents(read(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.chat_format import formatted_conversations

    return formatted_conversations(read(spark, sf_dir, "conversations"))


_OP6_SQL = r"""
WITH logged AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn) AS turns,
         list('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) ORDER BY turn) AS shown
  FROM conversations GROUP BY conv_id
), maximal AS (
  SELECT a.* FROM logged a
  WHERE NOT EXISTS (SELECT 1 FROM logged b WHERE len(b.turns) > len(a.turns) AND b.turns[1:len(a.turns)] = a.turns)
), kept AS (
  SELECT min(conv_id) AS conv_id, CAST(len(turns) AS BIGINT) AS total_turns, CAST(count(*) AS BIGINT) AS copies,
         any_value(shown) AS shown
  FROM maximal GROUP BY turns
), cut AS (
  SELECT *, unnest(range(0, (total_turns + 255) // 256)) AS segment FROM kept
)
SELECT conv_id, CAST(segment AS BIGINT) AS segment, least(256, total_turns - 256 * segment) AS n_turns, total_turns, copies,
       array_to_string(shown[256 * segment + 1:256 * (segment + 1)], '') AS text
FROM cut
"""


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.quality import quality_scores

    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.toxicity import toxicity_scores

    return toxicity_scores(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.warc import archived_pages

    return archived_pages(read(spark, sf_dir, "pages"))


_OP8_SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), headed AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS head
  FROM sized
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN head IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head IS NOT DISTINCT FROM page_id THEN NULL ELSE head END AS refers_to
FROM headed
"""


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.topk import top_k

    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_OP10_SQL = """
WITH whole AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _crc32(text: str) -> str:
    """DuckDB expression of the unsigned crc32 of an ASCII text."""
    return f"""xor(4294967295::BIGINT, list_reduce([CAST(ord(x) AS BIGINT) FOR x IN string_split({text}, '')],
      lambda c, b: list_reduce([0::BIGINT, 1, 2, 3, 4, 5, 6, 7],
        lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384::BIGINT) ELSE d >> 1 END, xor(c, b)),
      4294967295::BIGINT))"""


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.repair import damaged_turns, repaired_conversations

    return repaired_conversations(damaged_turns(read(spark, sf_dir, "conversations")))


_AFTER = "CASE {q} WHEN 2 THEN 3 ELSE 2 END"
_INSERTED = """CASE n.k WHEN 0 THEN {q} WHEN 1 THEN {one} ELSE CASE {one} WHEN 2 THEN 3 ELSE 2 END END"""
_LINES = """CASE n.k WHEN 0 THEN CAST([] AS VARCHAR[]) ELSE
    [CASE {one} WHEN 3 THEN 'assistant:' ELSE 'user:' END] || CASE n.k WHEN 2
    THEN [CASE {one} WHEN 2 THEN 'assistant:' ELSE 'user:' END] ELSE CAST([] AS VARCHAR[]) END END"""
_ONE = "(CASE edited.q WHEN 2 THEN 3 ELSE 2 END)"

_OP11_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM damaged
), faulted AS (
  SELECT *, CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS r,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
              WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
), convs AS (
  SELECT DISTINCT conv_id FROM conversations
), state(conv_id, i, q, best) AS (
  SELECT conv_id, 0::BIGINT, q, {{'cost': cost::BIGINT, 'audit': audit, 'lines': CAST(lines AS VARCHAR[])}}
  FROM convs, (VALUES (0, 0, '', []), (2, 5, 'I', ['user:']), (3, 10, 'II', ['user:', 'assistant:'])) v(q, cost, audit, lines)
  UNION ALL
  SELECT conv_id, i, q, min(best) FROM (
    SELECT conv_id, i, {_INSERTED.format(q="edited.q", one=_ONE)} AS q,
           {{'cost': CAST(cost + 5 * n.k AS BIGINT), 'audit': audit || repeat('I', n.k),
             'lines': lines || {_LINES.format(one=_ONE)}}} AS best
    FROM (
      SELECT s.conv_id, f.i,
             CASE e.letter WHEN 'D' THEN s.q WHEN 'R' THEN {_AFTER.format(q="s.q")} ELSE f.r + 1 END AS q,
             s.best.cost + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
               + CASE WHEN e.letter <> 'D' AND f.fault = 3 THEN 5 ELSE 0 END AS cost,
             s.best.audit || e.letter AS audit,
             s.best.lines || CASE e.letter WHEN 'D' THEN CAST([] AS VARCHAR[])
               WHEN 'R' THEN [CASE s.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text]
               ELSE [f.role || ':' || f.text] END AS lines
      FROM state s JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1,
           (VALUES ('D'), ('K'), ('R')) e(letter)
      WHERE e.letter = 'D' OR (f.fault NOT IN (1, 2) AND (e.letter = 'R'
            OR (f.r = 0 AND s.q = 0) OR (f.r = 1 AND s.q <> 2) OR (f.r = 2 AND s.q = 2)))
    ) edited, (VALUES (0), (1), (2)) n(k)
  ) GROUP BY conv_id, i, q
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY conv_id
), chosen AS (
  SELECT s.conv_id, min(s.best) AS best
  FROM state s LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE s.i = coalesce(c.n, 0) AND s.q IN (0, 3) GROUP BY s.conv_id
)
SELECT v.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, h.best.cost AS cost, h.best.audit AS audit,
       sha256(array_to_string(h.best.lines, chr(10))) AS repaired_sha256
FROM convs v JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
"""


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.pii import KINDS, personal_data, span_text

    found = personal_data(read(spark, sf_dir, "documents"))
    counts = (f"cast(size(filter(base, s -> s.kind = {k})) AS long) AS n_{kind}" for k, kind in enumerate(KINDS))
    return found.selectExpr("doc_id", *counts, f"sha2({span_text('base')}, 256) AS base_sha256", f"{span_text('spans')} AS spans")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blotter.llm.prefix_trie import prefix_trie

    return prefix_trie(read(spark, sf_dir, "conversations"))


_OP13_SQL = f"""
WITH logged AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM logged
), rebuilt AS (
  SELECT c.conv_id, CASE WHEN c.conv_id = c.base THEN c.turns
    ELSE coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] END AS turns
  FROM headed c LEFT JOIN logged b ON b.conv_id = c.base
), members AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), prefixes AS (
  SELECT conv_id, n, depth, turns[1:depth] AS prefix FROM members
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(n = depth) AS childless,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth
), weighed AS (
  SELECT *, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(prefix[depth].text) ELSE 0 END AS saved FROM nodes
), above AS (
  SELECT depth AS below, childless, saved, unnest(range(0, depth + 1)) AS depth, prefix FROM weighed
), summed AS (
  SELECT prefix[1:depth] AS prefix, depth, sum(saved) AS saved_tokens, count(*) FILTER (childless) AS n_leaves,
         count(*) FILTER (below = depth + 1) AS n_children
  FROM above GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM weighed n JOIN summed s ON s.prefix = n.prefix AND s.depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _prepared(f)
    for f in (op1_mix_sources, op2_embedding_near_dedup, op3_secret_scan, op4_ngram_jaccard_join, op5_best_fit_packing, op6_chat_format, op7_quality_classifier, op8_warc, op9_toxicity, op10_top_k, op11_structure_repair, op12_personal_data, op13_prefix_trie)
}

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": _OP1_SQL,
    "op2_embedding_near_dedup": _OP2_SQL,
    "op4_ngram_jaccard_join": _OP4_SQL,
    "op6_chat_format": _OP6_SQL,
    "op8_warc": _OP8_SQL,
    "op10_top_k": _OP10_SQL,
    "op11_structure_repair": _OP11_SQL,
    "op13_prefix_trie": _OP13_SQL,
}
