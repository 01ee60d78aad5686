"""DuckDB SQL equivalents of the named queries (the correctness oracle).

The views ``documents``, ``orders``, ``lineitem`` ... are registered by
the caller. Column names and types are aligned with the Spark results
(counts ``bigint``, ranks and positions ``int``).
"""

from __future__ import annotations

from termcluster.operators.mentions import DEFAULT_BLOCK
from termcluster.operators.postings import DEFAULT_PART
from termcluster.operators.report import REPORT_FORMAT
from termcluster.params import ClusterParams
from termcluster.plans.catalog import LARGE_SAMPLE, MIXED_PARAMS, ONE_TERM, POSTING_PARAMS, SAMPLE_FRACTION, SAMPLE_SEED, SMALL_BLOCK
from termcluster.sources.postings import DRAW_DIGITS, poisson_thresholds
from termcluster.sources.tables import ANSWER_ID_FACTOR, DOCUMENT_TERMS


def _str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_str(t) for t in items) + "]"


_TERMS = _list(DOCUMENT_TERMS)

# Distinct (doc_id, term) pairs: whole space-separated words.
_PAIRS = f"""
pairs AS (
  SELECT DISTINCT doc_id, tok AS term
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents)
  WHERE tok IN (SELECT unnest({_TERMS}))
)"""

# The same for the words of the benchmark texts.
_LONG_PAIRS = """
words AS (SELECT DISTINCT term FROM (SELECT unnest(string_split(text, ' ')) AS term FROM benchmark) WHERE term <> ''),
pairs AS (
  SELECT DISTINCT doc_id, tok AS term
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents) JOIN words ON tok = term)"""

_COUNTS = f"""{_PAIRS},
counts AS (SELECT term, count(*)::BIGINT AS n FROM pairs GROUP BY term)"""


def _ranked(src: str) -> str:
    return f"SELECT term, n, (row_number() OVER (ORDER BY n DESC, term))::INTEGER AS rnk FROM {src}"


ORACLE: dict[str, str] = {
    "article_lines_parse": "SELECT doc_id::VARCHAR AS title, text FROM documents",
    "articles_mentioning_term": f"""
SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), {_str(ONE_TERM)})""",
    "term_occurrence_count": f"""
SELECT {_str(ONE_TERM)} AS term,
       count(*) FILTER (WHERE list_contains(string_split(text, ' '), {_str(ONE_TERM)}))::BIGINT AS n
FROM documents""",
    "article_term_pairs": f"WITH {_PAIRS} SELECT doc_id, term FROM pairs",
    "rank_terms_all": f"""
WITH {_COUNTS},
terms AS (SELECT unnest({_TERMS}) AS term),
full_counts AS (SELECT t.term, coalesce(c.n, 0)::BIGINT AS n FROM terms t LEFT JOIN counts c USING (term))
{_ranked('full_counts')}""",
    "term_index": f"""
WITH {_PAIRS}
SELECT term, block, list(doc_id ORDER BY doc_id) AS docs, count(*)::BIGINT AS n
FROM (SELECT *, (row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // {DEFAULT_BLOCK} AS block FROM pairs)
GROUP BY term, block""",
    "article_term_pairs_long": f"WITH {_LONG_PAIRS} SELECT doc_id, term FROM pairs",
    "rank_terms_all_long": f"""
WITH {_LONG_PAIRS},
full_counts AS (SELECT w.term, count(p.doc_id)::BIGINT AS n FROM words w LEFT JOIN pairs p USING (term) GROUP BY w.term)
{_ranked('full_counts')}""",
    "term_index_long": f"""
WITH {_LONG_PAIRS}
SELECT term, block, list(doc_id ORDER BY doc_id) AS docs, count(*)::BIGINT AS n
FROM (SELECT *, (row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // {SMALL_BLOCK} AS block FROM pairs)
GROUP BY term, block""",
    "rank_terms_from_index": f"WITH {_COUNTS} {_ranked('counts')}",
    "rank_terms_grouped": f"WITH {_COUNTS} {_ranked('counts')}",
}


# ---------------------------------------------------------------------------
# Postings and clustering
# ---------------------------------------------------------------------------

def _postings_ctes() -> str:
    return f"""
questions AS (SELECT o_orderkey AS question_id, o_orderpriority AS tag FROM orders),
answers AS (SELECT l_orderkey AS question_id, l_orderkey * {ANSWER_ID_FACTOR} + l_linenumber AS answer_id,
                   trunc(l_extendedprice)::INTEGER AS score
            FROM lineitem WHERE l_orderkey IS NOT NULL),
uq AS (SELECT question_id, min(tag) AS tag FROM questions GROUP BY question_id),
best AS (SELECT question_id, max(score) AS max_score FROM answers GROUP BY question_id),
scored AS (SELECT q.question_id, q.tag, b.max_score FROM uq q JOIN best b USING (question_id))"""


def _customer_ctes() -> str:
    return """
best AS (SELECT l_orderkey AS question_id, max(trunc(l_extendedprice)::INTEGER) AS max_score
         FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey),
uq AS (SELECT o_orderkey AS question_id, min('C' || o_custkey) AS tag FROM orders GROUP BY o_orderkey),
listed AS (SELECT 'C' || c_custkey AS tag, c_custkey AS idx FROM customer WHERE c_mktsegment = 'BUILDING'),
tagged AS (SELECT question_id, idx, max_score FROM uq JOIN best USING (question_id) JOIN listed USING (tag))"""


def _vector_ctes(p: ClusterParams) -> str:
    tags = _list(p.terms)
    return f"""{_postings_ctes()},
qidx AS (SELECT question_id, list_position({tags}, tag) - 1 AS idx FROM uq
         WHERE list_position({tags}, tag) IS NOT NULL),
vectors AS (SELECT question_id AS id, (idx * {p.spread})::INTEGER AS x, max_score AS y
            FROM qidx JOIN best USING (question_id)),
smp AS (SELECT x, y, id,
               row_number() OVER (PARTITION BY x ORDER BY md5('{p.seed}:' || id::VARCHAR), id) AS rn
        FROM vectors QUALIFY rn <= {p.per_stratum}),
init AS (SELECT list({{'x': x::BIGINT, 'y': y::BIGINT}} ORDER BY x, rn) AS c FROM smp)"""


def _sq(a: str, b: str) -> str:
    return f"(({a} - {b})::DOUBLE) * (({a} - {b})::DOUBLE)"


def _kmeans_ctes(p: ClusterParams) -> str:
    """The whole k-means as a recursive CTE whose single state row holds
    the list of centres: ``km(it, c, mv)``, ``final(c, it)``."""
    dist = f"{_sq('x', 'cc.x')} + {_sq('y', 'cc.y')}"
    move = f"{_sq('k.c[i].x', 'nc[i].x')} + {_sq('k.c[i].y', 'nc[i].y')}"
    return f"""{_vector_ctes(p)},
km(it, c, mv) AS (
  SELECT 0, c, NULL::DOUBLE FROM init
  UNION ALL
  SELECT k.it + 1, s.nc, s.mv FROM km k, LATERAL (
    SELECT nc, list_sum(list_transform(range(1, len(k.c) + 1), lambda i: {move})) AS mv
    FROM (
      SELECT list({{'x': coalesce(m.mx, k.c[r.i].x), 'y': coalesce(m.my, k.c[r.i].y)}} ORDER BY r.i) AS nc
      FROM range(1, len(k.c) + 1) r(i) LEFT JOIN (
        SELECT cl, (sum(x)::BIGINT // count(*))::BIGINT AS mx, (sum(y)::BIGINT // count(*))::BIGINT AS my
        FROM (SELECT x, y, list_position(ds, list_min(ds)) AS cl
              FROM (SELECT x, y, list_transform(k.c, lambda cc: {dist}) AS ds FROM vectors))
        GROUP BY cl) m ON m.cl = r.i
    )
  ) s
  WHERE k.it < {p.max_iterations} AND (k.mv IS NULL OR k.mv >= {float(p.eta)})
),
final AS (SELECT c, it, mv FROM km ORDER BY it DESC LIMIT 1)"""


def _assigned(centres: str) -> str:
    """Vectors with the index (0-based) of their nearest centre in the
    list ``(SELECT c FROM <centres>)``; ties to the lowest index."""
    dist = f"{_sq('x', 'cc.x')} + {_sq('y', 'cc.y')}"
    return f"""
assigned AS (
  SELECT id, x, y, (list_position(ds, list_min(ds)) - 1)::INTEGER AS cluster
  FROM (SELECT id, x, y, list_transform((SELECT c FROM {centres}), lambda cc: {dist}) AS ds FROM vectors)
)"""


def _unnest_centres(src: str, extra: str = "") -> str:
    return f"""
SELECT (i - 1)::INTEGER AS cluster, c[i].x::BIGINT AS x, c[i].y::BIGINT AS y{extra}
FROM {src}, range(1, len(c) + 1) r(i)"""


def _means(centres: str) -> str:
    return f"""{_assigned(centres)},
means AS (SELECT cluster, (sum(x)::BIGINT // count(*))::BIGINT AS mx,
                 (sum(y)::BIGINT // count(*))::BIGINT AS my FROM assigned GROUP BY cluster),
old AS ({_unnest_centres(centres)}),
new AS (SELECT o.cluster, coalesce(m.mx, o.x)::BIGINT AS x, coalesce(m.my, o.y)::BIGINT AS y
        FROM old o LEFT JOIN means m USING (cluster))"""


def _dominant(p: ClusterParams, centres: str) -> str:
    tags = _list(p.terms)
    return f"""
per_x AS (SELECT cluster, x, count(*) AS n FROM assigned GROUP BY cluster, x),
sizes AS (SELECT cluster, count(*)::BIGINT AS size FROM assigned GROUP BY cluster),
top AS (SELECT cluster, x, n FROM per_x
        QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, x DESC) = 1),
dominant AS (SELECT t.cluster, {tags}[(t.x // {p.spread}) + 1] AS label,
                    100.0::DOUBLE * t.n / s.size AS percent, s.size
             FROM top t JOIN sizes s USING (cluster)),
medians AS (SELECT cluster, trunc(median(y))::INTEGER AS median FROM assigned GROUP BY cluster)"""


def _report(p: ClusterParams) -> str:
    return f"""WITH RECURSIVE {_kmeans_ctes(p)},{_assigned('final')},{_dominant(p, 'final')},
report AS (SELECT d.label, d.percent, d.size, m.median FROM dominant d JOIN medians m USING (cluster))"""


def _postings_oracle() -> dict[str, str]:
    p, mixed = POSTING_PARAMS, MIXED_PARAMS
    tags = _list(p.terms)
    return {
        "posting_lines_parse": f"""
SELECT 1 AS posting_type, o_orderkey AS id, NULL::BIGINT AS accepted_answer, NULL::BIGINT AS parent_id,
       0 AS score, o_orderpriority AS tag FROM orders
UNION ALL
SELECT 2, l_orderkey * {ANSWER_ID_FACTOR} + l_linenumber, NULL, l_orderkey,
       trunc(l_extendedprice)::INTEGER, NULL FROM lineitem""",
        "lines_sample_with_replacement": f"""
WITH lines AS (
  SELECT concat('1,', o_orderkey, ',,,0', coalesce(',' || o_orderpriority, '')) AS value FROM orders
  UNION ALL
  SELECT concat('2,', l_orderkey * {ANSWER_ID_FACTOR} + l_linenumber, ',,', l_orderkey, ',',
                trunc(l_extendedprice)::INTEGER) FROM lineitem),
numbered AS (SELECT value, row_number() OVER (PARTITION BY value) - 1 AS k FROM lines),
draws AS (SELECT value, ('0x' || substr(md5('{SAMPLE_SEED}:' || k || ':' || value), 1, {DRAW_DIGITS}))::BIGINT AS d FROM numbered),
copies AS (SELECT value, len(list_filter({poisson_thresholds(SAMPLE_FRACTION)}, lambda t: d >= t)) AS k FROM draws)
SELECT value FROM (SELECT value, unnest(range(k)) AS i FROM copies)""",
        "questions_keyed": f"WITH {_postings_ctes()} SELECT question_id, tag FROM questions",
        "answers_keyed": f"WITH {_postings_ctes()} SELECT question_id, answer_id, score FROM answers",
        "question_answer_pairs": f"""
WITH {_postings_ctes()}
SELECT question_id, tag, answer_id, score FROM answers JOIN uq USING (question_id)""",
        "question_answer_groups": f"""
WITH {_postings_ctes()}
SELECT question_id, tag, part, count(*)::BIGINT AS n,
       list(answer_id ORDER BY answer_id, score) AS answer_ids, list(score ORDER BY answer_id, score) AS scores
FROM (SELECT *, (row_number() OVER (PARTITION BY question_id ORDER BY answer_id, score) - 1) // {DEFAULT_PART} AS part
      FROM answers JOIN uq USING (question_id))
GROUP BY question_id, tag, part""",
        "question_answer_groups_split": f"""
WITH a AS (SELECT ascii(o_orderpriority)::BIGINT AS question_id, o_orderpriority AS tag, o_orderkey AS answer_id,
                  trunc(o_totalprice)::INTEGER AS score FROM orders),
r AS (SELECT *, (row_number() OVER (PARTITION BY question_id ORDER BY answer_id, score) - 1) // {SMALL_BLOCK} AS part FROM a)
SELECT question_id, tag, part, count(*)::BIGINT AS n,
       list(answer_id ORDER BY answer_id, score) AS answer_ids, list(score ORDER BY answer_id, score) AS scores
FROM r GROUP BY question_id, tag, part""",
        "question_tag_index_long": f"WITH {_customer_ctes()} SELECT question_id, idx FROM tagged",
        "score_vectors_long": f"WITH {_customer_ctes()} SELECT question_id AS id, idx * {p.spread}::BIGINT AS x, max_score AS y FROM tagged",
        "sample_global_large": f"""
WITH {_vector_ctes(p)}
SELECT x, y, id FROM vectors ORDER BY md5('{p.seed}:' || id::VARCHAR), id LIMIT {LARGE_SAMPLE}""",
        "question_max_score": f"WITH {_postings_ctes()} SELECT question_id, tag, max_score FROM scored",
        "question_tag_index": f"""
WITH {_postings_ctes()}
SELECT question_id, (list_position({tags}, tag) - 1)::INTEGER AS idx
FROM scored WHERE list_position({tags}, tag) IS NOT NULL""",
        "score_vectors": f"WITH {_vector_ctes(p)} SELECT id, x, y FROM vectors",
        "score_vectors_sorted": f"WITH {_vector_ctes(p)} SELECT id, x, y FROM vectors ORDER BY x, id",
        "sample_per_stratum": f"WITH {_vector_ctes(p)} SELECT x, y, id FROM smp",
        "sample_global": f"""
WITH {_vector_ctes(p)}
SELECT x, y, id FROM vectors ORDER BY md5('{p.seed}:' || id::VARCHAR), id LIMIT {p.kernels}""",
        "assign_nearest": f"WITH {_vector_ctes(p)},{_assigned('init')} SELECT id, x, y, cluster FROM assigned",
        "cluster_means": f"WITH {_vector_ctes(p)},{_means('init')} SELECT cluster, x, y FROM new",
        "cluster_sizes": f"""
WITH {_vector_ctes(p)},{_assigned('init')}
SELECT cluster, count(*)::BIGINT AS size FROM assigned GROUP BY cluster""",
        "centre_movement": f"""
WITH {_vector_ctes(p)},{_means('init')}
SELECT coalesce(sum({_sq('n.x', 'o.x')} + {_sq('n.y', 'o.y')}), 0.0)::DOUBLE AS movement
FROM old o JOIN new n USING (cluster)""",
        "kmeans": f"WITH RECURSIVE {_kmeans_ctes(p)} {_unnest_centres('final', f', it::INTEGER AS iterations, mv AS movement, mv < {float(p.eta)} AS converged')}",
        "cluster_dominant": f"""
WITH {_vector_ctes(p)},{_assigned('init')},{_dominant(p, 'init')}
SELECT cluster, label, percent FROM dominant""",
        "cluster_dominant_mixed": f"""
WITH {_vector_ctes(mixed)},{_assigned('init')},{_dominant(mixed, 'init')}
SELECT cluster, label, percent FROM dominant""",
        "cluster_median": f"""
WITH {_vector_ctes(p)},{_assigned('init')},{_dominant(p, 'init')}
SELECT cluster, median FROM medians""",
        "cluster_report": f"{_report(p)} SELECT label, percent, size, median FROM report",
        "cluster_report_mixed": f"{_report(mixed)} SELECT label, percent, size, median FROM report",
        "cluster_report_text": f"""{_report(p)}
SELECT printf('{REPORT_FORMAT}', median, label, percent, size) AS line FROM report""",
    }


ORACLE.update(_postings_oracle())
