"""The queries of this subpackage by name, and their SQL where SQL can say it."""

from __future__ import annotations

from fieldlens.llm.alignment import op13_cross_tokenizer
from fieldlens.llm.line_dedup import op2_line_dedup
from fieldlens.llm.mixing import op8_sainte_lague_mix
from fieldlens.llm.negatives import op12_hard_negatives
from fieldlens.llm.order_minhash import op4_order_minhash
from fieldlens.llm.packing import op3_residual_packing
from fieldlens.llm.quality import op9_risk_controlled_rules
from fieldlens.llm.secrets import op7_markov_secrets
from fieldlens.llm.sharding import op5_external_shuffle
from fieldlens.llm.simhash import op6_simhash_components
from fieldlens.llm.substring import op10_difference_cover
from fieldlens.llm.suffixes import op11_suffix_buckets
from fieldlens.llm.toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_line_dedup, op3_residual_packing, op4_order_minhash, op5_external_shuffle, op6_simhash_components, op7_markov_secrets,
    op8_sainte_lague_mix, op9_risk_controlled_rules,
    op10_difference_cover, op11_suffix_buckets, op12_hard_negatives, op13_cross_tokenizer,
)}

# every word with its document and place; a window of 35 words as text; words under a window met twice
REPEATED_WINDOWS = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM docs),
placed AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM words),
windows AS (SELECT r, i, word, string_agg(word, ' ') OVER ahead AS run, count(*) OVER ahead AS n FROM placed WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
marked AS (SELECT r, i, word, n = 35 AND count(*) OVER (PARTITION BY run) > 1 AS repeated FROM windows),
covered AS (SELECT r, i, word, max(repeated) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM marked),
found AS (SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN found USING (r)
"""

# every byte as two hex digits; of equal runs of 100 bytes all but the first start again
REPEATED_BYTES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT r, doc_id, i, substring(h, 2 * i + 1, 2) AS byte, substring(h, 2 * i + 1, 200) AS run FROM (SELECT r, doc_id, h, unnest(range(len(h) // 2)) AS i FROM docs)),
marked AS (SELECT r, i, byte, len(run) = 200 AND row_number() OVER (PARTITION BY md5(run), len(run) ORDER BY doc_id, r, i) > 1 AS again FROM bytes),
covered AS (SELECT r, i, byte, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM marked),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS begins FROM covered),
found AS (SELECT r, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM edges GROUP BY r)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM docs LEFT JOIN found USING (r)
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY rank <= 3
"""

ORACLES: dict[str, str] = {"op10_difference_cover": REPEATED_WINDOWS, "op11_suffix_buckets": REPEATED_BYTES, "op12_hard_negatives": HARD_NEGATIVES}
