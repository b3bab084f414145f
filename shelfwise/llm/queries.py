"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (decontaminate, exact_dedup, fill_middle, html_text, line_rules, packing, prefix_trie, quality,
                           simhash, substring, suffix, toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.as_contract(exact_dedup.deduplicate(_table(spark, sf_dir, "documents")))


def op2_quality(spark, sf_dir):
    return quality.as_contract(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_simhash(spark, sf_dir):
    return simhash.as_contract(simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, max_bits=2))


def op4_decontaminate(spark, sf_dir):
    return decontaminate.as_contract(decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op5_toxicity(spark, sf_dir):
    return toxicity.as_contract(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_warc(spark, sf_dir):
    folder, index = warc.archive(_table(spark, sf_dir, "pages"))
    return warc.as_contract(warc.read_bundles(spark, folder, index))


def op7_packing(spark, sf_dir):
    return packing.as_contract(packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path()))


def op8_html_text(spark, sf_dir):
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark, sf_dir):
    return substring.as_contract(substring.remove_repeats(_table(spark, sf_dir, "documents")))


def op10_suffix_dedup(spark, sf_dir):
    return suffix.as_contract(suffix.remove_repeats(_table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    return prefix_trie.as_contract(prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences(turns))))


def op12_fill_middle(spark, sf_dir):
    return fill_middle.as_contract(fill_middle.fill_in_middle(_table(spark, sf_dir, "documents")))


def op13_line_rules(spark, sf_dir):
    return line_rules.as_contract(line_rules.judge(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_quality, op3_simhash, op4_decontaminate, op5_toxicity, op6_warc,
                                    op7_packing, op8_html_text, op9_substring_dedup, op10_suffix_dedup, op11_prefix_trie,
                                    op12_fill_middle, op13_line_rules)}


_BLANK = r"[\x20\x09-\x0D]"

_OP1 = rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS rn,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) s, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n),
hits AS (SELECT DISTINCT doc_id, item_id, n, i FROM dw JOIN bw USING (n, g)),
words AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit
  FROM hits, unnest(range(0, n)) t(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP6 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((instr('0123456789abcdef', substr(hex, (5 * j) // 4 + 1, 1)) - 1) * 16
           + greatest(instr('0123456789abcdef', substr(hex || '0', (5 * j) // 4 + 2, 1)) - 1, 0))
          >> (3 - (5 * j) % 4) & 31) + 1, 1) for j in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""

_OP9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k
  FROM d, unnest(range(1, len(w) - 11)) t(i) WHERE len(w) > 12),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + j AS i
  FROM g JOIN f USING (k), unnest(range(0, 13)) t(j) WHERE first < doc_id),
u AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) t(i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS body
  FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


_OP11 = r"""
WITH t AS (
  SELECT conv_id AS c, turn, substr(sha256(length(r) || ':' || r || x), 1, 32) AS dg, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT c, list({'dg': dg, 'w': w} ORDER BY turn NULLS FIRST, dg, w) AS s FROM t GROUP BY c),
drawn AS (
  SELECT c, s, c - c % 20 AS b, xor(list_reduce(
    flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM own),
rb AS (
  SELECT a.c, CASE WHEN o.c IS NULL THEN a.s[a.h + 1:] ELSE list_concat(o.s[1:a.h], a.s[a.h + 1:]) END AS s
  FROM drawn a LEFT JOIN own o ON o.c = a.b),
p AS (
  SELECT c, d, md5(array_to_string(list_transform(s[1:d], lambda z: z.dg), ',')) AS k, coalesce(s[d].w, 0) AS w, d = len(s) AS ends
  FROM rb, unnest(range(0, len(s) + 1)) u(d)),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(w) AS w, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY k, d),
up AS (SELECT n.k, q.k AS parent FROM nodes n JOIN p q ON q.c = n.conv_id AND q.d = n.d - 1),
kids AS (SELECT parent AS k, count(*) AS n_children FROM up GROUP BY parent),
whole AS (
  SELECT a.k, CAST(sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.w) AS BIGINT) AS saved_tokens
  FROM nodes n JOIN p a ON a.c = n.conv_id AND a.d <= n.d LEFT JOIN kids ON kids.k = n.k GROUP BY a.k)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN whole USING (k) LEFT JOIN kids USING (k) LEFT JOIN up USING (k) LEFT JOIN nodes q ON q.k = up.parent
"""

_OP12 = r"""
WITH u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
h AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform(range(0, 4), lambda j: CAST(CAST('0x' || substr(hx, 8 * j + 1, 8) AS UBIGINT) AS BIGINT)) AS h FROM u),
c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
x AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM x
"""

_OP13 = rf"""
WITH d AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS l
  FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM d, unnest(range(1, len(w) - 1)) u(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM r, unnest(range(0, 3)) u(j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, t, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, source, t, unnest(l) AS line FROM d)),
worded AS (SELECT * FROM lines WHERE norm <> ''),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT t) AS host_docs FROM worded GROUP BY source),
often AS (
  SELECT f.source, norm FROM (SELECT source, norm, count(DISTINCT t) AS n_docs FROM worded GROUP BY source, norm) f
  JOIN hosts h ON h.source IS NOT DISTINCT FROM f.source WHERE n_docs > 10 AND n_docs > 0.05 * host_docs),
lost AS (
  SELECT doc_id, CAST(sum(len(string_split(worded.norm, ' '))) AS BIGINT) AS lost
  FROM worded JOIN often ON often.norm = worded.norm AND often.source IS NOT DISTINCT FROM worded.source GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS n_frequent_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - n_frequent_words < 0.5 * n_words) AS kept
FROM m
"""


def oracle_sql() -> dict[str, str]:
    """The other operators have none: fitted models, page markup, tokenizers, XXH64 and byte strings aren't in SQL;
    ``tests/llm`` holds them against brute force."""
    return {"op1_exact_dedup": _OP1, "op4_decontaminate": _OP4, "op6_warc": _OP6, "op9_substring_dedup": _OP9,
            "op11_prefix_trie": _OP11, "op12_fill_middle": _OP12, "op13_line_rules": _OP13}
