"""Registered queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import LOWER, NON_WORD_CLASS, UPPER, ship
from .decontamination import op2_decontamination
from .exact_dedup import op12_exact_dedup
from .fingerprints import op10_fingerprints
from .hard_negatives import op11_hard_negatives
from .language_id import op5_language_id
from .line_dedup import op9_line_dedup
from .lm_scoring import op1_lm_scoring
from .packing import op6_packing
from .phrases import op13_phrases
from .pii import op3_pii
from .quality import op8_quality
from .simhash import op7_simhash
from .token_counts import op4_token_counts


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_lm_scoring, op2_decontamination, op3_pii, op4_token_counts, op5_language_id, op6_packing, op7_simhash, op8_quality,
    op9_line_dedup, op10_fingerprints, op11_hard_negatives, op12_exact_dedup, op13_phrases)}

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{NON_WORD_CLASS.replace('[', '[^', 1)}')"

ORACLE_SQL = {"op2_decontamination": f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM starts),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
           FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size),
doc_windows AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM places),
hits AS (SELECT DISTINCT doc_id, i, size, item FROM doc_windows JOIN item_windows USING (size, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit_words.n, 0) AS n_hit, coalesce(hit_items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit_words.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",

"op11_hard_negatives": """
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
             CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.e, b.e)]) AS BIGINT) AS score
      FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
f AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 5
""",

"op12_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",

"op13_phrases": f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
g AS (SELECT lang, size, w[i:i + size - 1] AS p, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT g.lang, g.size, g.p, g.f AS a, k, x.f AS l, y.f AS r,
                CAST(CAST(2000000 AS HUGEINT) * g.f // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
         FROM (SELECT *, unnest(range(1, size)) AS k FROM g WHERE size > 1) AS g
         JOIN g AS x ON x.lang = g.lang AND x.p = g.p[1:k] JOIN g AS y ON y.lang = g.lang AND y.p = g.p[k + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
parts AS (SELECT lang, p[i:i + n - 1] AS p, max(f) AS most
          FROM (SELECT lang, p, f, n, unnest(range(1, size - n + 2)) AS i FROM g, (SELECT unnest([2, 3]) AS n) WHERE size > n) GROUP BY ALL),
kept AS (SELECT scored.* FROM scored LEFT JOIN parts USING (lang, p) WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""}
