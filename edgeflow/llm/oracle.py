"""DuckDB SQL of the queries that SQL can express."""

from edgeflow.llm import licences, rules

ORACLE = {}

def rules_sql(share=rules.MAX_SHARE, least=rules.LEAST_DOCUMENTS, left=rules.LEAST_LEFT):
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), windows AS (
    SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5)
), repeats AS (
    SELECT r, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM (
        SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n >= 2)
    GROUP BY r
), bodies AS (
    SELECT r, source, [trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) FOR l IN lines] AS lines,
           array_to_string(lines, chr(10)) AS body
    FROM docs
), lines AS (SELECT r, source, unnest(lines) AS line, body FROM bodies),
hosts AS (SELECT source, count(DISTINCT body) AS documents FROM bodies GROUP BY source),
frequent AS (
    SELECT l.source, line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
    GROUP BY l.source, line
    HAVING count(DISTINCT body) > {least} AND count(DISTINCT body) > any_value(documents) * {share}::DOUBLE
), removed AS (
    SELECT r, sum(len(string_split(line, ' '))) AS n
    FROM lines JOIN frequent USING (line) WHERE lines.source IS NOT DISTINCT FROM frequent.source GROUP BY r
), measured AS (
    SELECT doc_id, len(words) AS n_words, coalesce(list_sum([length(w) FOR w IN words]), 0) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(words) - coalesce(removed.n, 0) AS words_left
    FROM docs LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       words_left::BIGINT AS words_left,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= {left}::DOUBLE * n_words AS kept
FROM measured
"""


ORACLE["op9_rules"] = rules_sql()


def _licences():
    idf, other, vectors = licences.weights()
    terms = ", ".join(f"('{term}', {value!r}::DOUBLE)" for term, value in sorted(idf.items()))
    weights = ", ".join(
        f"({k}, '{licence}', '{term}', {value!r}::DOUBLE)"
        for k, (licence, vector) in enumerate(vectors) for term, value in sorted(vector.items())
    )
    whole = " UNION ALL ".join(
        f"SELECT '{licence}', unnest({sorted(vector)!r}), unnest({[vector[term] for term in sorted(vector)]!r}::DOUBLE[])"
        for licence, vector in licences.full_weights(idf, other)
    )
    return rf"""
WITH terms(term, idf) AS (VALUES {terms}), weights(k, licence, term, w) AS (VALUES {weights}),
templates AS (SELECT DISTINCT k, licence FROM weights), in_full(licence, term, w) AS ({whole}),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           concat_ws('/', source, lang, (floor(doc_id / 1000)::BIGINT)::VARCHAR, doc_id::VARCHAR) AS path
    FROM documents
), files AS (SELECT r, doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS folder FROM docs),
parts AS (
    SELECT r, true AS whole, text AS part FROM docs WHERE regexp_matches(text, '{licences.NAMED}')
    UNION ALL
    SELECT r, false, part FROM (
        SELECT r, unnest(list_distinct(list_concat(
            string_split(text, chr(10)), regexp_split_to_array(text, '\n[ \t\r]*\n')))) AS part FROM docs)
    WHERE regexp_matches(part, '{licences.NAMED}')
), units AS (
    SELECT row_number() OVER () AS u, r, whole, regexp_extract_all(lower(part), '{licences.TERM}') AS found FROM parts
), counted AS (
    SELECT u, term, count(*) AS n FROM (SELECT u, unnest(found) AS term FROM units) GROUP BY u, term
), norms AS (
    SELECT u, sqrt(sum((n * coalesce(idf, {other!r}::DOUBLE)) ** 2)) AS norm
    FROM counted LEFT JOIN terms USING (term) GROUP BY u
), dots AS (
    SELECT u, k, sum(n * idf * w) AS dot FROM counted JOIN terms USING (term) JOIN weights USING (term) GROUP BY u, k
), scores AS (
    SELECT r, whole, licence, round(coalesce(dot, 0) / norm, {licences.PLACES}) AS score
    FROM units JOIN norms USING (u) CROSS JOIN templates LEFT JOIN dots USING (u, k)
), fulls AS (
    SELECT r, licence, round(sum(n * coalesce(idf, {other!r}::DOUBLE) * w) / any_value(norm), {licences.PLACES}) AS score
    FROM units JOIN norms USING (u) JOIN counted USING (u) JOIN in_full USING (term) LEFT JOIN terms USING (term)
    WHERE whole GROUP BY u, r, licence
), best_notice AS (
    SELECT r, score, licence, row_number() OVER (PARTITION BY r ORDER BY score DESC, licence DESC) AS place
    FROM scores WHERE NOT whole AND score >= {licences.NOTICE!r}
), best_full AS (
    SELECT r, score, licence, row_number() OVER (PARTITION BY r ORDER BY score DESC, licence DESC) AS place
    FROM fulls WHERE score >= {licences.FULL!r}
), as_file AS (
    SELECT r, score, licence FROM scores WHERE whole AND score >= {licences.FILE!r}
    UNION ALL
    SELECT f.r, f.score, CASE WHEN f.licence = '{licences.LIKE}' AND n.licence = '{licences.TWIN}' THEN n.licence ELSE f.licence END
    FROM best_full f LEFT JOIN best_notice n ON n.r = f.r AND n.place = 1 WHERE f.place = 1
), own AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY origin, score DESC, licence DESC) AS place FROM (
        SELECT r, 'file' AS origin, score, licence FROM as_file
        UNION ALL SELECT r, 'notice', score, licence FROM best_notice WHERE place = 1)
), mine AS (SELECT * FROM own WHERE place = 1),
licensed AS (
    SELECT folder, score, licence, path, row_number() OVER (
        PARTITION BY folder ORDER BY score DESC, licence DESC, path DESC) AS place
    FROM files JOIN mine USING (r) WHERE origin = 'file'
), nearest AS (
    SELECT r, l.score, l.licence, l.path, row_number() OVER (PARTITION BY r ORDER BY length(l.folder) DESC) AS place
    FROM (SELECT r, unnest([array_to_string(string_split(folder, '/')[1:n], '/')
                            FOR n IN range(0, len(string_split(folder, '/')) + 1)]) AS above FROM files)
    JOIN licensed l ON l.folder = above AND l.place = 1
)
SELECT doc_id, f.path, coalesce(m.licence, n.licence) AS licence, coalesce(m.score, n.score) AS score,
       CASE WHEN m.r IS NOT NULL THEN m.origin WHEN n.r IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN m.r IS NULL THEN n.path END AS origin_path
FROM files f LEFT JOIN mine m USING (r) LEFT JOIN (SELECT * FROM nearest WHERE place = 1) n USING (r)
"""


ORACLE["op2_licences"] = _licences()

ORACLE["op4_search"] = r"""
WITH counted AS (
    SELECT doc_id, term, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents)
    GROUP BY doc_id, term
), lengths AS (SELECT doc_id, sum(n) AS words FROM counted GROUP BY doc_id),
whole AS (SELECT count(*) AS documents, (SELECT sum(n) FROM counted)::DOUBLE / count(*) AS mean FROM documents),
idf AS (
    SELECT term, ln(1 + (any_value(documents) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
    FROM counted CROSS JOIN whole GROUP BY term
), scored AS (
    SELECT q.doc_id AS query_id, d.doc_id, round(sum(
        q.n * idf * d.n * (1.2 + 1)::DOUBLE / (d.n + 1.2::DOUBLE * (0.25 + 0.75 * words / mean))), 6) AS score
    FROM counted q JOIN counted d USING (term) JOIN idf USING (term)
    JOIN lengths ON lengths.doc_id = d.doc_id CROSS JOIN whole
    WHERE q.doc_id % 50 = 0 GROUP BY q.doc_id, d.doc_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE["op13_middle"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digits
    FROM documents
), draws AS (
    SELECT *, len(lines) AS n, [('0x' || digits[8 * k + 1:8 * k + 8])::BIGINT FOR k IN range(4)] AS h FROM docs
), cuts AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
), parts AS (
    SELECT *, array_to_string(lines[1:low], '') AS prefix, array_to_string(lines[low + 1:high], '') AS middle,
           array_to_string(lines[high + 1:], '') AS suffix
    FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLE["op12_embeddings"] = r"""
WITH RECURSIVE rows AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), fine AS MATERIALIZED (
    SELECT r, label, v FROM rows
    WHERE label IS NOT NULL AND len(v) > 0 AND len([c FOR c IN v IF c IS NULL OR NOT isfinite(c)]) = 0
      AND len([c FOR c IN v IF c <> 0]) > 0
), links AS MATERIALIZED (
    SELECT a.r AS a, b.r AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached(r, other) AS (
    SELECT r, r FROM rows UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.other
), least AS (
    SELECT reached.r, min(vec_id) AS component_id FROM reached JOIN rows ON rows.r = reached.other GROUP BY reached.r
), counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (r) LEFT JOIN counts USING (r)
"""
