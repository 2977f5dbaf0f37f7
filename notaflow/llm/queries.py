"""The operators over the shared tables (``queries``) and DuckDB twins where SQL
can express the result (``oracle_sql``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (collocations, decontaminate, fm_dedup, hard_negatives, html_consensus, jaccard, line_spread, maxscore,
               packing, pieces, pseudo_lm, quality, radix_dedup)
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_spread(spark, sf_dir):
    return line_spread.remove_boilerplate(table(spark, sf_dir, "documents")).drop("kept_text")


def op2_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return radix_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_pieces(spark, sf_dir):
    return pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), outputs=False)


def op5_maxscore(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op6_html_consensus(spark, sf_dir):
    return html_consensus.extract(table(spark, sf_dir, "pages"))


def op7_jaccard(spark, sf_dir):
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op8_pseudo_lm(spark, sf_dir):
    return pseudo_lm.score(table(spark, sf_dir, "documents"))


def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op10_fm_dedup(spark, sf_dir):
    return fm_dedup.remove_repeats(table(spark, sf_dir, "documents"), outputs=False)


def op11_bond_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, "id % 100 = 0")


def op12_phrases(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("cut")


def op13_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_line_spread": op1_line_spread,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_pieces": op4_pieces,
    "op5_maxscore": op5_maxscore,
    "op6_html_consensus": op6_html_consensus,
    "op7_jaccard": op7_jaccard,
    "op8_pseudo_lm": op8_pseudo_lm,
    "op9_packing": op9_packing,
    "op10_fm_dedup": op10_fm_dedup,
    "op11_bond_negatives": op11_bond_negatives,
    "op12_phrases": op12_phrases,
    "op13_decontamination": op13_decontamination,
}

WS = r"[\x20\x09-\x0D]"

ORACLES = {
    "op1_line_spread": rf"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS lines
                   FROM documents),
             l AS (SELECT doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
             k AS (SELECT *, regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') AS key FROM l),
             b AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}),
             j AS (SELECT k.*, b.key IS NOT NULL AS gone FROM k LEFT JOIN b ON k.key = b.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op5_maxscore": """
        WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
                   FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_exact_dedup": rf"""
        WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n,
                          regexp_replace(coalesce(text, ''), '{WS}+', '', 'g') AS t FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)""",
    "op7_jaccard": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM w),
             g AS (SELECT doc_id, n, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS c, pos FROM x
                   WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
             sh AS (SELECT DISTINCT doc_id, s FROM g WHERE c = 4 OR (n < 4 AND pos = 1)),
             size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
             o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
                   GROUP BY 1, 2),
             l AS (SELECT a, b FROM o JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
                   WHERE 100 * o >= 85 * (x.n + y.n - o)),
             e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
             r(doc_id, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
             m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
        FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id""",
    "op10_fm_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
             g AS (SELECT doc_id, pos, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS c FROM x
                   WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
             m AS (SELECT s, min(doc_id) AS first FROM g WHERE c = 13 GROUP BY s),
             r AS (SELECT DISTINCT g.doc_id, g.pos + o.o AS pos FROM g JOIN m ON g.s = m.s CROSS JOIN range(0, 13) o(o)
                   WHERE g.c = 13 AND m.first < g.doc_id),
             k AS (SELECT x.doc_id, x.word, x.pos, r.pos IS NOT NULL AS gone
                   FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.pos = x.pos),
             a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS g,
                          string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS t FROM k GROUP BY doc_id)
        SELECT d.doc_id, coalesce(a.n, 0) AS n_words, coalesce(a.g, 0) AS n_removed, sha256(coalesce(a.t, '')) AS kept_sha256
        FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id""",
    "op11_bond_negatives": """
        WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND label IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.id AS anchor_id, c.id, q.label = c.label AS same,
                          CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.id <> c.id WHERE q.id % 100 = 0),
             p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
             n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score FROM p JOIN s USING (anchor_id)
                   WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)
        QUALIFY rank <= 10""",
    "op12_phrases": r"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                   FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
             g AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, range(1, 6) r(m)),
             f AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
             n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
             c AS (SELECT * FROM f WHERE m > 1 AND f >= 100),
             k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c q WHERE q.lang = c.lang AND q.m > c.m
                       AND 100 * q.f >= 100 * c.f AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
             x AS (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM k),
             s AS (SELECT x.lang, x.phrase, x.k, x.f AS a, l.f AS l, r.f AS r, n.n,
                          (1000 * CAST(x.f AS HUGEINT) * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
                   FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(ws[1:k], ' ')
                   JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(ws[k + 1:], ' ') JOIN n ON n.lang = x.lang),
             b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM b WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= 2000""",
    "op13_decontamination": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
                   FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
                   FROM benchmark),
             bw AS (SELECT item_id, ws, least(10, len(ws)) AS m, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i
                    FROM b WHERE len(ws) > 0),
             p AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, m, array_to_string(ws[i:i + m - 1], ' ') AS s FROM bw),
             z AS (SELECT DISTINCT m FROM p),
             g AS (SELECT row, m, ws, unnest(range(1, len(ws) - m + 2)) AS i FROM d, z),
             q AS (SELECT row, m, i, array_to_string(ws[i:i + m - 1], ' ') AS s FROM g),
             h AS (SELECT q.row, q.i, q.m, p.item FROM q JOIN p ON p.m = q.m AND p.s = q.s),
             hit AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS j FROM h) GROUP BY row),
             it AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
                    FROM h GROUP BY row)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit ON hit.row = d.row LEFT JOIN it ON it.row = d.row""",
}
