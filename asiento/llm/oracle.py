"""Check statements of this subpackage, written apart from the operators."""

from __future__ import annotations

from asiento.llm.licence_texts import patterns

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

DECONTAMINATION = f"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, {WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         list_slice(w, i + 1, i + least(len(w), 10)) AS win
  FROM items, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS r(i) WHERE len(w) > 0
), docs AS (
  SELECT row_number() OVER () AS n, doc_id, {WORDS} AS w FROM documents
), hits AS (
  SELECT DISTINCT d.n, i, windows.size, item
  FROM docs d, (SELECT DISTINCT size FROM windows) s,
       unnest(range(0, greatest(len(d.w) - s.size + 1, 0))) AS r(i), windows
  WHERE windows.size = s.size AND windows.win = list_slice(d.w, i + 1, i + s.size)
), covered AS (
  SELECT n, count(DISTINCT p) AS n_hit
  FROM hits, unnest(range(i, i + size)) AS r(p) GROUP BY n
), held AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT n, item FROM hits) GROUP BY n
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (n) LEFT JOIN held USING (n)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = ", ".join(f"({', '.join(map(_quoted, row))})" for row in patterns())
_PLAIN = r"trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x80-\x{{10FFFF}}]+', ' ', 'g'))"
_SIGN = r"[^0-9A-Za-z\x80-\x{10FFFF}]"
_MARK = rf"^{_SIGN}*(?:[•‣◦▪·–—]|(?:[0-9]{{1,3}}|[A-Za-z]|[ivxIVX]{{2,4}})[.)])[ \t]+"

# Whole texts are looked for at each piece, as one pattern; what lies inside a longer text that was met is left out.
LICENCES = rf"""
WITH rules AS (SELECT * FROM (VALUES {_RULES}) v(licence, fixed, pattern)
), docs AS (
  SELECT row_number() OVER () AS n, doc_id, string_split(replace(coalesce(text, ''), 'https://', 'http://'), chr(10)) AS lines FROM documents
), unmarked AS (
  SELECT n, list_transform(lines, lambda l, i: CASE
           WHEN i = 1 OR regexp_matches(lines[i - 1], '[.!?:;]{_SIGN}*$') OR (i > 2 AND regexp_full_match(lines[i - 1], '{_SIGN}*'))
           THEN regexp_replace(l, '{_MARK}', '') ELSE l END) AS lines FROM docs
), cut AS (
  SELECT n, list_filter(list_transform(
           string_split(regexp_replace(array_to_string(lines, chr(10)), '([.!?:])[ \t]+', '\1' || chr(10), 'g'), chr(10)),
           lambda s: {_PLAIN.format("s")}), lambda s: s <> '') AS pieces FROM unmarked
), flat AS (
  SELECT n, pieces, chr(10) || array_to_string(pieces, chr(10)) || chr(10) AS words FROM cut WHERE len(pieces) > 0
), candidates AS (
  SELECT n, words, licence, pattern FROM flat, rules WHERE contains(replace(words, chr(10), ' '), fixed)
), starts AS (
  SELECT n, sum(size + 1) OVER (PARTITION BY n ORDER BY i) - size AS start
  FROM (SELECT n, length(unnest(pieces)) AS size, generate_subscripts(pieces, 1) AS i FROM flat WHERE n IN (SELECT n FROM candidates))
), met AS (
  SELECT DISTINCT n, licence, start, start + length(found) - 2 AS stop
  FROM (SELECT n, licence, start, regexp_extract(substr(words, start::BIGINT, 3000), '^' || pattern) AS found FROM candidates JOIN starts USING (n))
  WHERE found <> ''
), longest AS (
  SELECT n, licence FROM met a
  WHERE NOT EXISTS (FROM met b WHERE a.n = b.n AND b.start <= a.start AND b.stop >= a.stop AND b.stop - b.start > a.stop - a.start)
), found AS (
  SELECT n, count(*) AS n_matches, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM longest GROUP BY n
)
SELECT doc_id, coalesce(licences, '') AS licences, coalesce(n_matches, 0)::BIGINT AS n_matches
FROM docs LEFT JOIN found USING (n)
"""

LINE_DEDUP = f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, text, coalesce(source::VARCHAR, '') AS site,
         string_split(text, chr(10)) AS lines
  FROM documents
), placed AS (
  SELECT n, site, i, line, trim(line, {SPACE}) AS bare
  FROM (SELECT n, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs)
), common AS (
  SELECT bare FROM placed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 8
), left_over AS (
  SELECT n, count(*) FILTER (common.bare IS NOT NULL) AS removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (common.bare IS NULL) AS kept
  FROM placed LEFT JOIN common USING (bare) GROUP BY n
), judged AS (
  SELECT doc_id, text, lines, removed, kept,
         coalesce(removed, 0) = 0 OR trim(coalesce(kept, ''), {SPACE}) = '' AS spared
  FROM docs LEFT JOIN left_over USING (n)
)
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(lines) END::BIGINT AS n_lines,
       CASE WHEN spared THEN 0 ELSE removed END::BIGINT AS n_removed,
       sha256(coalesce(CASE WHEN spared THEN text ELSE kept END, '')) AS kept_sha256
FROM judged
"""

SQL = {
    "op3_decontamination": DECONTAMINATION,
    "op4_licences": LICENCES,
    "op5_line_dedup": LINE_DEDUP,
}
