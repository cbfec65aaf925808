"""SQL twins of the queries that SQL can express (DuckDB)."""

from . import chat, license_scan, mixing, quality_rules

OP2 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP3 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")}) AS size,
         -ln((('0x' || substr(md5('{mixing.SEED}|' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496::DOUBLE)
         / greatest(0.05::DOUBLE, 1 - 4 * (CASE WHEN length(text) > 0 THEN
             (length(text) - length(translate(text, '{mixing.SYMBOLS}', '')))::DOUBLE
             / length(text) ELSE 0 END)) AS k
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source),
weighed AS (SELECT *, (sid % 3 + 1)::DOUBLE AS weight, 3 * source_size::DOUBLE AS ceiling FROM sums),
filled AS (
  SELECT *, ((SELECT sum(source_size) FROM sums)::DOUBLE - coalesce(sum(ceiling) OVER b, 0))
            / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY ceiling / weight, sid
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT arg_min(level, ceiling / weight + sid * 1e-9) AS level FROM filled
           WHERE level * weight <= ceiling),
targets AS (SELECT source, sid, source_size, least(ceiling, levels.level * weight) AS target
            FROM filled, levels),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS e
           FROM targets),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.e, t.target - t.e * t.source_size AS rest,
         sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.k, s.doc_id
                           ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN epochs t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (e + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT
         AS taken,
       (e + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END)::INTEGER
         AS copies
FROM placed
"""


def _controls(value: str) -> str:
    """Length of a text after escaping: one more for each escape sign and each control string."""
    more = " + ".join(f"(length({value}) - length(replace({value}, '{c}', ''))) // {len(c)}"
                      for c in (*chat.CONTROLS, "\\"))
    return f"(length({value}) + {more})"


OP4 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
grouped AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS spoken,
         coalesce(string_agg(text, '' ORDER BY turn, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         sum({len(chat.TURN + chat.TEXT + chat.END)} + {_controls("role")} + {_controls("text")})
           AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM grouped
"""

_MENUS = " OR ".join(
    f"length(l) - length(replace(l, '{m}', '')) >= {len(m) * (quality_rules.MENU_ENTRIES - 1)}"
    for m in quality_rules.SEPARATORS)
_SYMBOLS = f"(length({{0}}) - length(translate({{0}}, '{quality_rules.SYMBOLS}', '')))"
_END = quality_rules.SENTENCE_END.replace("'", "''")
_BARE = r"length(regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g'))"

OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_WORDS.format("t")} AS ws, string_split(t, chr(10)) AS ls FROM d),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
          FROM w, unnest(range(1, len(ws) - 3)) AS r(i) WHERE len(ws) >= 5),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(5)) AS r(k)
            GROUP BY doc_id),
lines AS (
  SELECT doc_id, n, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS full_line
  FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS n FROM w)),
judged AS (
  SELECT doc_id, n, l, full_line, NOT full_line OR NOT (
    NOT regexp_matches(l, '{_END}') OR {_SYMBOLS.format("l")} * 100 > length(l) * 10
    OR regexp_matches(l, '{quality_rules.NAVIGATION}') OR {_MENUS}
    OR regexp_matches(l, '{quality_rules.BOILERPLATE}')) AS good FROM lines),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE full_line)
                 - count(DISTINCT l) FILTER (WHERE full_line) AS n_dup_lines,
         count(*) FILTER (WHERE NOT good) AS n_removed_lines,
         coalesce(sum({_BARE.format("l")}) FILTER (WHERE good), 0) AS left_chars
  FROM judged GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, {_BARE.format("t")}::BIGINT AS word_chars,
         {_SYMBOLS.format("t")}::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, n_removed_lines::BIGINT AS n_removed_lines,
         left_chars::BIGINT AS left_chars
  FROM w JOIN per_doc USING (doc_id) LEFT JOIN repeats r USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND 100 * left_chars >= 50 * word_chars AS kept FROM base
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TEMPLATES = ", ".join(
    f"('{label}', {words}, {license_scan.needed_words(len(words))})"
    for label, words in license_scan.template_words().items())
_PHRASES = ", ".join(f"({p.split()}, '{label}')" for p, label in license_scan.PHRASES)

OP9 = rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t
           FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{license_scan.WORDS}') AS ws FROM d),
phrases(p, label) AS (VALUES {_PHRASES}), templates(label, words, needed) AS (VALUES {_TEMPLATES}),
hits AS (SELECT doc_id, i - 1 AS place, label FROM w, phrases,
                unnest(range(1, len(ws) + 1)) AS r(i) WHERE ws[i:i + len(p) - 1] = p),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l,
                 generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d),
found AS (SELECT * FROM (SELECT doc_id, n, label, len(list_intersect(list_distinct(
                   regexp_extract_all(l, '{license_scan.WORDS}')), words)) AS shared,
                 len(words) AS size, needed
          FROM lines, templates) WHERE shared >= needed),
h AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
             list_sort(list_distinct(list(label))) AS labels FROM hits GROUP BY doc_id),
f AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(shared::DOUBLE / size) AS score,
             count(DISTINCT n) AS n_blocks FROM found GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(h.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(
         coalesce(h.labels, []), coalesce(f.labels, [])))), ',') AS labels,
       coalesce(score, 0::DOUBLE) AS score, coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id)
"""
