"""Independent SQL formulation of every registered query (DuckDB dialect).

Only the driver tables are registered on the SQL side, so every statement
starts with the fixture views of FIXTURES.md and the shared intermediate
results as CTEs. The SQL uses the plain textbook formulations (window
``ROW_NUMBER``, ``arg_min``, ``string_agg ... ORDER BY``, ``regexp_split``) so
that it checks the Spark plans rather than mirroring them.
"""

from __future__ import annotations

from shelfwise.fixed_values import (
    COLD_START_PHRASE,
    COLD_START_REPLACEMENT,
    DEV_FRACTION,
    MAX_TEXT_TOKENS,
    RESOURCE_PREFIX,
    SPLIT_SEED,
    STRUCTURED_PLACEHOLDERS,
    TEXT_PLACEHOLDERS,
)
from shelfwise.operators.prompts import default_runs


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


P = _q(RESOURCE_PREFIX)

FIXTURE_CTES = f"""
interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         MAX(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey),
raw_train AS (
  SELECT * FROM interactions
  WHERE (user_id * 7 + item_id * 13) % 10 < 8 AND user_id % 20 <> 0),
raw_test AS (
  SELECT * FROM interactions
  WHERE NOT ((user_id * 7 + item_id * 13) % 10 < 8 AND user_id % 20 <> 0)),
entity_src AS (
  SELECT p_partkey AS item_id, 2 AS type, concat({P}, p_brand) AS prop FROM part WHERE p_partkey % 11 <> 0
  UNION SELECT p_partkey, 4, concat({P}, p_type, '_(genre)') FROM part WHERE p_partkey % 7 <> 0
  UNION SELECT p_partkey, 3, concat({P}, p_name) FROM part WHERE p_partkey % 13 <> 0
  UNION SELECT l_partkey, 5, concat({P}, s_name) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  UNION SELECT p_partkey, 7, concat({P}, 'Category:', split_part(p_name, ' ', 1)) FROM part
  UNION SELECT p_partkey, 7, concat({P}, 'Category:', split_part(p_name, ' ', 2)) FROM part
  UNION SELECT p_partkey, 6, concat({P}, 'size_', CAST(p_size AS VARCHAR)) FROM part),
mapping_entities AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY md5(prop)) AS BIGINT) AS id, prop
  FROM (SELECT DISTINCT prop FROM entity_src) t),
item_prop AS (
  SELECT s.item_id, m.id, s.type FROM entity_src s JOIN mapping_entities m ON s.prop = m.prop),
texts AS (SELECT doc_id AS item_id, text AS item_text FROM documents),
scores AS (
  SELECT user_id, item_id, CAST((user_id * 31 + item_id * 17) % 1000 AS DOUBLE) / 1000 AS score
  FROM raw_test),
predictions AS (
  SELECT user_id, item_id, score,
         CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
  FROM scores),
answers AS (
  SELECT user_id, item_id,
         concat('<pad> ', CASE WHEN (user_id * 31 + item_id * 17) % 1000 < 600 THEN 'Yes' ELSE 'No' END, '</s>') AS pred_raw,
         CASE WHEN label = 1 THEN 'Yes' ELSE 'No' END AS label_word
  FROM raw_test)"""


def _runs_values() -> str:
    rows = [
        f"({k}, {_q(r.run_name)}, {_q(r.kind)}, {_q(r.template)}, {_q(r.word_neg)}, {_q(r.word_pos)})"
        for k, r in enumerate(default_runs())
    ]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS r(k, run_name, kind, template, word_neg, word_pos)"


def _render(placeholders) -> str:
    t = "template"
    for name in placeholders:
        v = f"CAST({name} AS VARCHAR)" if name in ("user_id", "item_id") else f"coalesce({name}, '')"
        t = f"replace({t}, '*{name}*', {v})"
    return (
        f"CASE WHEN coalesce(user_genres, '') <> '' THEN replace({t}, '*user_genres*', user_genres) "
        f"ELSE replace({t}, {_q(COLD_START_PHRASE)}, {_q(COLD_START_REPLACEMENT)}) END"
    )


def _strip_resource(col: str) -> str:
    return f"split_part({col}, {P}, 2)"


DERIVED_CTES = f"""
item_features AS (
  SELECT ip.item_id,
    arg_min({_strip_resource('m.prop')}, m.id) FILTER (WHERE ip.type = 2 AND m.prop IS NOT NULL) AS author,
    arg_min(replace({_strip_resource('m.prop')}, '_(genre)', ''), m.id) FILTER (WHERE ip.type = 4 AND m.prop IS NOT NULL) AS genre,
    arg_min({_strip_resource('m.prop')}, m.id) FILTER (WHERE ip.type = 3 AND m.prop IS NOT NULL) AS series,
    arg_min({_strip_resource('m.prop')}, m.id) FILTER (WHERE ip.type = 5 AND m.prop IS NOT NULL) AS publisher,
    string_agg(split_part({_strip_resource('m.prop')}, 'Category:', 2), ',' ORDER BY m.id)
      FILTER (WHERE ip.type = 7 AND m.prop IS NOT NULL) || ',' AS subject
  FROM item_prop ip LEFT JOIN mapping_entities m ON ip.id = m.id
  GROUP BY ip.item_id),
split_ranked AS (
  SELECT *,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY
      md5(concat_ws('|', '{SPLIT_SEED}', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR))), item_id, label) AS rk,
    COUNT(*) OVER (PARTITION BY user_id) AS n
  FROM raw_train),
split AS (
  SELECT user_id, item_id, label,
    CASE WHEN user_id IS NOT NULL AND rk <= round_even({DEV_FRACTION}::DOUBLE * n, 0) THEN 'dev' ELSE 'train' END AS split
  FROM split_ranked),
profiles AS (
  SELECT s.user_id,
    coalesce(array_to_string(list_sort(list(DISTINCT f.genre) FILTER (WHERE f.genre <> '')), ', '), '') AS user_genres
  FROM split s LEFT JOIN item_features f ON s.item_id = f.item_id
  WHERE s.split = 'train' AND s.label = 1 AND s.user_id IS NOT NULL
  GROUP BY s.user_id),
all_rows AS (
  SELECT user_id, item_id, label, split FROM split
  UNION ALL SELECT user_id, item_id, label, 'test' AS split FROM raw_test),
examples AS (
  SELECT a.user_id, a.item_id, a.label, coalesce(p.user_genres, '') AS user_genres,
         coalesce(f.genre, '') AS item_genre, a.split
  FROM all_rows a LEFT JOIN profiles p ON a.user_id = p.user_id
  LEFT JOIN item_features f ON a.item_id = f.item_id),
truncated AS (
  SELECT item_id,
    array_to_string(regexp_split_to_array(regexp_replace(item_text, '^\\s+|\\s+$', '', 'g'), '\\s+')[1:{MAX_TEXT_TOKENS}], ' ') AS item_text
  FROM texts),
text_examples AS (
  SELECT e.user_id, e.item_id, e.label, e.user_genres, e.item_genre, t.item_text, e.split
  FROM examples e JOIN truncated t ON e.item_id = t.item_id WHERE t.item_text <> ''),
complete_items AS (
  SELECT item_id, author AS item_author, series AS item_series, publisher AS item_publisher,
         subject AS item_subject
  FROM item_features
  WHERE coalesce(author, '') <> '' AND coalesce(genre, '') <> '' AND coalesce(series, '') <> ''
    AND coalesce(publisher, '') <> '' AND coalesce(subject, '') <> ''),
structured_examples AS (
  SELECT e.user_id, e.item_id, e.label, e.user_genres, e.item_genre, c.item_author, c.item_series,
         c.item_publisher, c.item_subject, e.split
  FROM examples e JOIN complete_items c ON e.item_id = c.item_id WHERE e.item_genre <> ''),
cand_text AS (
  SELECT user_id, item_id, user_genres, item_text FROM text_examples WHERE split = 'test'),
cand_structured AS (
  SELECT user_id, item_id, user_genres, item_genre, item_author, item_series, item_publisher, item_subject
  FROM structured_examples WHERE split = 'test'),
runs AS ({_runs_values()}),
rprompts_text AS (
  SELECT r.run_name, c.user_id, c.item_id, {_render(TEXT_PLACEHOLDERS)} AS prompt, r.word_pos
  FROM cand_text c CROSS JOIN runs r WHERE r.kind = 'text'),
rprompts_structured AS (
  SELECT r.run_name, c.user_id, c.item_id, {_render(STRUCTURED_PLACEHOLDERS)} AS prompt, r.word_pos
  FROM cand_structured c CROSS JOIN runs r WHERE r.kind = 'structured'),
scored_text AS (
  SELECT run_name, user_id, item_id,
         CAST((user_id * 31 + item_id * 17 + length(prompt)) % 1000 AS DOUBLE) / 1000 AS score
  FROM rprompts_text),
scored_structured AS (
  SELECT run_name, user_id, item_id,
         CAST((user_id * 31 + item_id * 17 + length(prompt)) % 1000 AS DOUBLE) / 1000 AS score
  FROM rprompts_structured),
ranked_text AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY run_name, user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
  FROM scored_text),
ranked_structured AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY run_name, user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
  FROM scored_structured),
gt_text AS (
  SELECT user_id, item_id, label FROM raw_test
  WHERE label IS DISTINCT FROM 0 AND item_id IN (SELECT item_id FROM texts WHERE item_text <> '')),
gt_structured AS (
  SELECT user_id, item_id, label FROM raw_test
  WHERE label IS DISTINCT FROM 0 AND item_id IN (SELECT item_id FROM complete_items))"""

_CLEAN = "regexp_replace(split_part(split_part(pred_raw, '<pad>', 2), '</s>', 1), '^\\s+|\\s+$', '', 'g')"

QUERIES = {
    "item_features": "SELECT * FROM item_features",
    "item_first_publisher": f"""
        SELECT ip.item_id, arg_min({_strip_resource('m.prop')}, m.id) AS publisher
        FROM item_prop ip JOIN mapping_entities m ON ip.id = m.id
        WHERE ip.type = 5 GROUP BY ip.item_id""",
    "item_subjects": f"""
        SELECT ip.item_id,
               string_agg(split_part({_strip_resource('m.prop')}, 'Category:', 2), ',' ORDER BY m.id) || ',' AS subject
        FROM item_prop ip JOIN mapping_entities m ON ip.id = m.id
        WHERE ip.type = 7 GROUP BY ip.item_id""",
    "mapping_entities": "SELECT * FROM mapping_entities",
    "split_assignment": "SELECT * FROM split",
    "split_counts_by_user": """
        SELECT user_id, COUNT(*) AS n_rows,
               CAST(SUM(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
               CAST(SUM(CASE WHEN split = 'dev' THEN 1 ELSE 0 END) AS BIGINT) AS n_dev
        FROM split GROUP BY user_id""",
    "user_profiles": "SELECT * FROM profiles",
    "examples_train": "SELECT user_id, item_id, label, user_genres, item_genre FROM examples WHERE split = 'train'",
    "examples_dev": "SELECT user_id, item_id, label, user_genres, item_genre FROM examples WHERE split = 'dev'",
    "examples_test": "SELECT user_id, item_id, label, user_genres, item_genre FROM examples WHERE split = 'test'",
    "truncated_texts": "SELECT * FROM truncated",
    "text_examples": "SELECT * FROM text_examples",
    "structured_examples": "SELECT * FROM structured_examples",
    "ranking_candidates_text": "SELECT * FROM cand_text",
    "ranking_candidates_structured": "SELECT * FROM cand_structured",
    "prompts_text_multi": f"""
        SELECT r.run_name, e.split, e.user_id, e.item_id, e.label, {_render(TEXT_PLACEHOLDERS)} AS prompt,
               CASE WHEN e.label = 1 THEN r.word_pos WHEN e.label = 0 THEN r.word_neg END AS label_word
        FROM text_examples e CROSS JOIN runs r WHERE r.kind = 'text'""",
    "prompts_structured": f"""
        SELECT r.run_name, e.split, e.user_id, e.item_id, e.label, {_render(STRUCTURED_PLACEHOLDERS)} AS prompt,
               CASE WHEN e.label = 1 THEN r.word_pos WHEN e.label = 0 THEN r.word_neg END AS label_word
        FROM structured_examples e CROSS JOIN runs r WHERE r.kind = 'structured'""",
    "ranking_prompts_text": "SELECT * FROM rprompts_text",
    "ranking_prompts_structured": "SELECT * FROM rprompts_structured",
    "ranked_predictions": "SELECT user_id, item_id, score, rank FROM predictions",
    "scored_ranking": "SELECT run_name, user_id, item_id, score, rank FROM ranked_text",
    "scored_ranking_structured": "SELECT run_name, user_id, item_id, score, rank FROM ranked_structured",
    "answer_accuracy": f"SELECT avg(CASE WHEN {_CLEAN} = label_word THEN 1.0 ELSE 0.0 END::DOUBLE) AS acc FROM answers",
    "task_registry_accuracy": f"""
        SELECT run_name, avg(CASE WHEN {_CLEAN} = label_word THEN 1.0 ELSE 0.0 END::DOUBLE) AS acc
        FROM (
          SELECT r.run_name,
                 concat('<pad> ', CASE WHEN (t.user_id * 31 + t.item_id * 17 + r.k * 97) % 1000 < 600
                                       THEN r.word_pos ELSE r.word_neg END, '</s>') AS pred_raw,
                 CASE WHEN t.label = 1 THEN r.word_pos WHEN t.label = 0 THEN r.word_neg END AS label_word
          FROM raw_test t CROSS JOIN runs r) a
        GROUP BY run_name""",
    "ground_truth_text": "SELECT * FROM gt_text",
    "ground_truth_structured": "SELECT * FROM gt_structured",
    "train_positives": "SELECT user_id, item_id, label FROM raw_train WHERE label IS DISTINCT FROM 0",
    "evaluable_predictions": """
        SELECT user_id, item_id, rank FROM predictions
        WHERE user_id IN (SELECT user_id FROM gt_text)""",
    "dropped_users": """
        SELECT DISTINCT p.user_id FROM predictions p
        WHERE NOT EXISTS (SELECT 1 FROM gt_text g WHERE g.user_id = p.user_id)""",
    "evaluable_predictions_all_runs": """
        SELECT run_name, user_id, item_id, rank FROM ranked_text
        WHERE user_id IN (SELECT user_id FROM gt_text)
        UNION ALL
        SELECT run_name, user_id, item_id, rank FROM ranked_structured
        WHERE user_id IN (SELECT user_id FROM gt_structured)""",
    "user_candidates": """
        SELECT * FROM cand_text
        WHERE user_id = (SELECT user_id FROM cand_text GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)""",
    "item_features_skew_safe": "SELECT * FROM item_features",
    "text_examples_skew_safe": "SELECT * FROM text_examples",
    "structured_examples_skew_safe": "SELECT * FROM structured_examples",
    "entities_from_files": "SELECT id, prop, id AS place FROM mapping_entities",
    "item_features_from_files": "SELECT * FROM item_features",
    "quoted_features_from_files": """
        SELECT item_id, author || chr(10) || '"by" ' || publisher AS author, '"' || genre || '"' AS genre,
               series || chr(9) || chr(10) || chr(10) || genre AS series, publisher,
               CASE WHEN item_id % 5 <> 0 THEN replace(subject, ',', ',' || chr(10)) END AS subject
        FROM item_features""",
    "examples_from_files": "SELECT * FROM examples",
    "predictions_from_files": """
        SELECT 'best first' AS run_name, user_id, item_id, rank FROM predictions
        UNION ALL
        SELECT 'worst:first', user_id, item_id, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rank DESC) AS BIGINT) FROM predictions""",
    "latest_scores_from_files": """
        SELECT user_id, item_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
        FROM (
          SELECT o_custkey AS user_id, l_partkey AS item_id,
                 arg_max(CAST((l_orderkey * 7 + l_linenumber * 13) % 1000 AS DOUBLE) / 1000, l_orderkey * 1000 + l_linenumber) AS score
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)""",
    "ground_truth_from_files": "SELECT * FROM gt_text",
}


def oracle_sql() -> dict[str, str]:
    prelude = "WITH " + FIXTURE_CTES.strip() + ",\n" + DERIVED_CTES.strip() + "\n"
    return {name: prelude + body.strip() for name, body in QUERIES.items()}
