"""SQL counterparts of the queries, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import licenses

ORACLE = {
    "op8_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(concat_ws('|', '1', CAST(doc_id AS VARCHAR), text)) AS key
  FROM documents
), sizes AS (
  SELECT source, sum(size) AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] :: DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, source_size * 2.0 :: DOUBLE AS most,
         (sum(source_size) OVER () * 1.5 :: DOUBLE
          - coalesce(sum(source_size * 2.0 :: DOUBLE) OVER (ORDER BY source_size * 2.0 :: DOUBLE / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY source_size * 2.0 :: DOUBLE / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sizes
), aimed AS (
  SELECT source, source_size,
         CASE WHEN source_size > 0 THEN least(weight * max(level) FILTER (level <= most / weight) OVER (), most)
              ELSE 0 END AS target
  FROM levels
), placed AS (
  SELECT s.doc_id, s.size, a.source_size, a.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS epochs
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN before + size / 2.0 :: DOUBLE <= target - epochs * source_size
                                   AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
""",
    "op6_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 3 AS tokens,
         length(replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\')) + 1
         + length(replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\')) + 16 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth
  FROM turns
), led AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY nth) - tokens AS start,
         first(CASE WHEN role = 'system' THEN tokens END) OVER (PARTITION BY conv_id ORDER BY nth) AS system_tokens,
         first(CASE WHEN role = 'system' THEN chars END) OVER (PARTITION BY conv_id ORDER BY nth) AS system_chars
  FROM counted
), strided AS (
  SELECT *, greatest(768 - coalesce(system_tokens, 0), 256) AS stride FROM led
), cut AS (
  SELECT *, CASE WHEN start // stride = (start + tokens - 1) // stride THEN 2 * (start // stride)
                 ELSE 2 * (start // stride) + 1 END AS win
  FROM strided
), opened AS (
  SELECT conv_id, win, min(start) AS opens, any_value(system_chars) AS system_chars FROM cut GROUP BY ALL
), seen AS (
  SELECT o.conv_id, o.win, sum(c.chars) AS chars
  FROM opened o JOIN cut c ON o.conv_id = c.conv_id AND c.start < o.opens AND c.start >= o.opens - 256
  GROUP BY ALL
), repeated AS (
  SELECT o.conv_id, sum(coalesce(s.chars, 0)
         + CASE WHEN o.opens > 256 THEN coalesce(system_chars, 0) ELSE 0 END) AS chars
  FROM opened o LEFT JOIN seen s ON o.conv_id = s.conv_id AND o.win = s.win GROUP BY ALL
), told AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS aimed
  FROM cut GROUP BY conv_id
)
SELECT t.conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(aimed) AS BIGINT) AS loss_chars,
       sha256(aimed) AS loss_sha256, CAST(t.chars + r.chars AS BIGINT) AS formatted_chars
FROM told t JOIN repeated r ON t.conv_id = r.conv_id
""",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    text = f"lower(regexp_replace({text}, {_quoted(licenses.COPYRIGHT)}, '', 'g'))"
    text = rf"regexp_replace({text}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for spelling, usual in licenses.SPELLINGS.items():
        text = rf"regexp_replace({text}, '\b{spelling}\b', '{usual}', 'g')"
    return rf"regexp_replace({text}, ' ?\n ?', chr(10), 'g')"


_ENTIRE = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'))"
_KNOWN = ", ".join(
    f"({_quoted(name)}, {_quoted(text)})" for name, texts in licenses.KNOWN.items() for text in texts
)
ORACLE["op4_license_scan"] = rf"""
WITH clean AS (SELECT doc_id, {_canonical("text")} AS clean FROM documents),
units AS (
  SELECT doc_id, 'text' AS scope, [clean] AS parts FROM clean
  UNION ALL SELECT doc_id, 'block', regexp_split_to_array(clean, '\n\n+') FROM clean
  UNION ALL SELECT doc_id, 'line', string_split(clean, chr(10)) FROM clean
), numbered AS (
  SELECT doc_id, scope, unnest(list_filter(parts, lambda p: trim(p, chr(10) || ' ') <> '')) AS part,
         generate_subscripts(list_filter(parts, lambda p: trim(p, chr(10) || ' ') <> ''), 1) - 1 AS nth
  FROM units
), texts AS (
  SELECT doc_id, scope, nth, {_ENTIRE.format("part")} AS text FROM numbered
  WHERE scope <> 'block' OR contains(trim(part, chr(10)), chr(10))
), known AS (
  SELECT DISTINCT license, sha256({_ENTIRE.format(_canonical("text"))}) AS digest
  FROM (VALUES {_KNOWN}) AS k(license, text)
)
SELECT doc_id, scope, CAST(nth AS BIGINT) AS nth, license
FROM texts JOIN known ON sha256(text) = digest
WHERE length(text) >= {licenses.SHORTEST}
"""
ORACLE["op3_top_k"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
ORACLE["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
                 FROM scored WHERE alike) s WHERE nth <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""


def _top_gram(width: int) -> str:
    """Most code points in one run of so many words that comes twice or more."""
    return f"""
  SELECT rid, max(often * chars) AS most FROM (
    SELECT rid, any_value(chars) AS chars, count(*) AS often FROM (
      SELECT rid, array_to_string(w[i : i + {width - 1}], ' ') AS gram,
             length(array_to_string(w[i : i + {width - 1}], '')) AS chars
      FROM (SELECT rid, w, unnest(generate_series(1, len(w) - {width - 1})) AS i FROM cut WHERE len(w) >= {width}) p
    ) g GROUP BY rid, gram HAVING count(*) > 1
  ) c GROUP BY rid"""


ORACLE["op13_quality_rules"] = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(w[i : i + 4], ' ')) AS often
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM cut WHERE len(w) >= 5) p
), repeats AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM windows, (SELECT unnest([0, 1, 2, 3, 4]) AS d) o WHERE often > 1 GROUP BY rid
), pairs AS ({_top_gram(2)}), triples AS ({_top_gram(3)}), quadruples AS ({_top_gram(4)}),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered,
         length(regexp_replace(text, '\P{{L}}', '', 'g')) AS n_letters,
         length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS n_upper,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses,
         coalesce(p.most, 0) AS top_pair, coalesce(t.most, 0) AS top_triple, coalesce(q.most, 0) AS top_quadruple
  FROM cut c LEFT JOIN repeats r ON c.rid = r.rid LEFT JOIN pairs p ON c.rid = p.rid
  LEFT JOIN triples t ON c.rid = t.rid LEFT JOIN quadruples q ON c.rid = q.rid
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_symbols > 10 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_lettered < 70 * n_words OR 100 * n_upper > 50 * n_letters
            OR 100 * n_bullets > 90 * n_lines OR 100 * n_ellipses > 30 * n_lines OR 100 * top_pair > 20 * word_chars
            OR 100 * top_triple > 18 * word_chars OR 100 * top_quadruple > 16 * word_chars) AS kept
FROM based
"""
