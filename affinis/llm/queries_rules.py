"""Queries on quality rules, vector codes and the audit of filters."""

from __future__ import annotations

from affinis.llm import filter_audit, line_rules, vector_codes
from affinis.llm.registry import query, table

SQL_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL_LINE_RULES = rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {SQL_W} AS w FROM documents),
win AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
repeats AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + j AS p FROM win JOIN again USING (r, s) CROSS JOIN range(0, 5) AS x(j)) GROUP BY r),
line AS MATERIALIZED (SELECT r, source, t, line, trim(regexp_replace(translate(line, '{line_rules.WRITTEN}', '{line_rules.NORMAL}'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM d)),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM line WHERE norm <> '' GROUP BY r),
host AS (SELECT source, count(DISTINCT t) AS n_host FROM d GROUP BY source),
frequent AS (SELECT f.source, norm FROM (SELECT source, norm, count(DISTINCT t) AS n FROM line WHERE norm <> '' GROUP BY source, norm) f
  JOIN host h ON h.source IS NOT DISTINCT FROM f.source WHERE n > {line_rules.LINE_DOCUMENTS} AND n * {line_rules.LINE_SHARE} > n_host),
gone AS (SELECT r, count(*) AS n_lines, sum(len(string_split(l.norm, ' '))) AS n FROM line l JOIN frequent f ON f.norm = l.norm AND f.source IS NOT DISTINCT FROM l.source GROUP BY r),
m AS (SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(t) - len(translate(t, '#*$%&|<>', '')) AS n_symbols,
  coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(gone.n_lines, 0) AS n_lines_removed, coalesce(gone.n, 0) AS words_removed
  FROM d LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
  base_failed, n_lines_removed, CAST(words_removed AS BIGINT) AS words_removed,
  NOT base_failed AND n_words - words_removed >= {line_rules.MIN_WORDS} AND 100 * words_removed <= {line_rules.MOST_REMOVED} * n_words AS kept FROM b"""


@query("op11_line_rules", SQL_LINE_RULES)
def op11(spark, sf):
    found = line_rules.judged(table(spark, sf, "documents"))
    return found.select("row.doc_id", *line_rules.BASE, "base_failed", "n_lines_removed", "words_removed", "kept")


def _sql_assign(turn: int) -> str:
    """Nearest entries of the codebooks of a turn; distance and entry are one number, so ties go to the lower entry."""
    return f"""a{turn} AS MATERIALIZED (SELECT r, part, CAST(min(far * 256 + entry) % 256 AS INTEGER) AS entry, min(far * 256 + entry) // 256 AS error FROM (
  SELECT p.r, p.part, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far FROM p JOIN c{turn} c USING (part)) GROUP BY r, part)"""


def _sql_update(turn: int) -> str:
    return f"""s{turn} AS (SELECT part, entry, i, sum(y) AS s, count(*) AS n FROM (SELECT part, entry, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS i FROM p JOIN a{turn} USING (r, part)) GROUP BY part, entry, i),
m{turn} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{turn} GROUP BY part, entry),
c{turn + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{turn} c LEFT JOIN m{turn} m ON m.part = c.part AND m.entry = c.entry)"""


SQL_VECTOR_CODES = f"""WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, k AS part, v[k * (len(v) // 4) + 1:(k + 1) * (len(v) // 4)] AS x FROM e CROSS JOIN range(0, 4) AS t(k)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 256),
{", ".join(f"{_sql_assign(turn)}, {_sql_update(turn)}" for turn in range(vector_codes.ROUNDS))}, {_sql_assign(vector_codes.ROUNDS)},
f AS MATERIALIZED (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error FROM a{vector_codes.ROUNDS} GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{vector_codes.ROUNDS})
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e JOIN f USING (r) CROSS JOIN b"""


@query("op12_vector_codes", SQL_VECTOR_CODES)
def op12(spark, sf):
    return vector_codes.coded(table(spark, sf, "embeddings"))


SQL_AUDIT = rf"""WITH d AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {SQL_W} AS w FROM documents),
least AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS MATERIALIZED (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (len(d.t) - len(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 10 * len(d.t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > m THEN 16 ELSE 0 END AS bits
  FROM d JOIN least USING (t) LEFT JOIN marks USING (doc_id)),
g AS MATERIALIZED (SELECT part, good, toxic, bits, count(*) AS n FROM f GROUP BY ALL),
x(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS MATERIALIZED (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM x a, x b, x c, x d, x e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS MATERIALIZED (SELECT filter_order, unnest(range(1, 6)) AS step, bits[unnest(range(1, 6))] AS bit, coalesce(list_sum(bits[1:unnest(range(1, 6)) - 1]), 0) AS before FROM o),
r AS MATERIALIZED (SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
  sum(CASE WHEN g.bits & (bit | CAST(before AS INTEGER)) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN g.bits & bit > 0 AND g.bits & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN g.bits & bit > 0 AND g.bits & CAST(before AS INTEGER) > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN g.bits = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN good AND g.bits & bit > 0 AND g.bits & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS good_lost,
  sum(CASE WHEN toxic AND g.bits & bit > 0 AND g.bits & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS toxic_lost
  FROM g CROSS JOIN s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""


@query("op13_filter_audit", SQL_AUDIT)
def op13(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
