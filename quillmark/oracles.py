"""DuckDB SQL for the queries, written independently of their plans; only the
rules' fixed patterns are shared."""

from __future__ import annotations

from .operators import codeblocks, hierarchy, patterns


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _any(x: str, found: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {_quoted(p)})" for p in found) + ")"


def _list(found: list[str]) -> str:
    return "(" + ", ".join(map(_quoted, found)) + ")"


_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_F = "'```'"
_BOOK = "source || '-' || (doc_id // 4000)"
BASE = rf"""WITH RECURSIVE parts AS (
  SELECT {_BOOK} AS book, doc_id, lang, string_split(coalesce(text, ''), chr(10)) AS body,
    CAST(row_number() OVER (PARTITION BY {_BOOK} ORDER BY doc_id) AS VARCHAR) AS p FROM documents WHERE doc_id IS NOT NULL AND source IS NOT NULL),
e AS (SELECT *, len(body) AS n, substr(body[1], 1, 24) AS t FROM parts),
slots AS (
  SELECT book, doc_id, 0 AS slot, '## IEEE Standard for ' || book || ' interfaces' AS line FROM e
  UNION ALL SELECT book, doc_id, unnest([1, 3]), '' FROM e
  UNION ALL SELECT book, doc_id, 2, CASE doc_id % 6 WHEN 0 THEN '## ' || p || '. ' || t WHEN 1 THEN '## ' || p || '.1 ' || t WHEN 2 THEN '## ' || p || '.1.1 ' || t
    WHEN 3 THEN '## Rules' WHEN 4 THEN '## Overview of ' || t || CASE WHEN doc_id % 12 = 10 THEN ' #' ELSE '' END ELSE '## A.' || p || ' ' || t END FROM e
  UNION ALL SELECT book, doc_id, 100 + 10 * unnest(range(1, n + 1)), unnest(body) FROM e
  UNION ALL SELECT book, doc_id, unnest([119, 131]), {_F} FROM e WHERE doc_id % 5 = 0 AND n >= 3
  UNION ALL SELECT book, doc_id, 125, p FROM e WHERE doc_id % 10 = 0 AND n >= 3
  UNION ALL SELECT book, doc_id, unnest([126, 127, 128]), unnest(['Copyright © 2024 by ' || p, 'Page ' || p, 'authorized licensed use limited to member ' || p]) FROM e WHERE doc_id % 10 = 0 AND n >= 3
  UNION ALL SELECT book, doc_id, unnest([132, 133, 134, 135, 136]), unnest(['', {_F}, 'value' || p || ' = compute(a, b);', 'This is a sentence of plain prose that stands alone in the code of part ' || p, {_F}]) FROM e WHERE doc_id % 15 = 5 AND n >= 3
  UNION ALL SELECT book, doc_id, 999999989 + unnest([1, 2, 3, 4, 5, 6]), unnest(['~~~~ text', 'This is a sentence of plain prose that stands in a block of tildes of part ' || p, 'And this is a second sentence of plain prose in the same block of part ' || p, {_F}, '~~~', '~~~~~ end']) FROM e WHERE doc_id % 12 = 7
  UNION ALL SELECT book, doc_id, 1000000000 + unnest([0, 1, 2]), unnest(['| id | lang |', '', '| ' || doc_id || ' | ' || lang || ' |']) FROM e WHERE doc_id % 5 = 1
  UNION ALL SELECT book, doc_id, 1000000010, '![fig](out/' || book || '_images/fig_' || doc_id || '.png)' FROM e WHERE doc_id % 4 = 0
  UNION ALL SELECT book, doc_id, 1000000020, '    ' || {_F} FROM e WHERE doc_id % 11 = 0
  UNION ALL SELECT book, doc_id, unnest([1000000031, 1000000032, 1000000033]), '' FROM e WHERE doc_id % 7 = 0
  UNION ALL SELECT book, doc_id, 1000000030, {_F} FROM e WHERE doc_id % 97 = 5
  UNION ALL SELECT book, doc_id, 1000000035, 'Copyrght 2023 2024 ' || book || ' All rights reserved by ' || p FROM e WHERE doc_id % 9 = 2
  UNION ALL SELECT book, doc_id, 1000000037, '  ' || p || ' Copyright 2023 2024 ' || book || ' All rights reserved' || CASE doc_id % 14 WHEN 3 THEN ' and this stays in the text' ELSE ' short' END FROM e WHERE doc_id % 14 IN (3, 10)
  UNION ALL SELECT book, doc_id, 1000000036, 'Working draft of the ' || (['first', 'third', 'sixth', 'tenth'])[CAST(p AS INTEGER) % 4 + 1] || ' part' FROM e
  UNION ALL SELECT book, doc_id, 1000000040, p || ' Copyright 2023 2024 ' || book || ' All rights reserved' FROM e
  UNION ALL SELECT book, doc_id, 1000000041, p FROM e),
lines AS (SELECT book, doc_id, line, CAST(row_number() OVER (PARTITION BY book ORDER BY doc_id, slot) AS INTEGER) AS line_no FROM slots),
s AS (SELECT *, {_STRIP.format("line")} AS s FROM lines),
mask AS (SELECT *, starts_with(s, {_F}) AS is_fence, starts_with(s, {_F}) OR sum(CASE WHEN starts_with(s, {_F}) THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY line_no) % 2 = 1 AS in_code FROM s),
heads AS (SELECT book, doc_id, line_no, CAST(length(regexp_extract(s, '^(#{{1,6}})\s', 1)) AS INTEGER) AS level, {_STRIP.format("regexp_extract(s, '^#{1,6}\\s+(.+)$', 1)")} AS title
  FROM mask WHERE NOT in_code AND regexp_matches(s, '^#{{1,6}}\s+.+$')),
totals AS (SELECT book, count(*) AS total, max(line_no) AS last_line FROM lines GROUP BY book),
z AS (SELECT book, CAST(sum(octet_length(encode(line)) + 1) - 1 AS BIGINT) AS size FROM lines GROUP BY book),
auto AS (SELECT book, CASE WHEN size < 51200 THEN 4 WHEN size < 204800 THEN 3 ELSE 2 END AS depth FROM z)
"""


def _chunks(depth: int | str) -> str:
    return f"""{BASE}, h AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY line_no) AS o, lead(line_no) OVER (PARTITION BY book ORDER BY line_no) AS nxt FROM heads JOIN auto USING (book) WHERE level <= {depth}),
c AS (SELECT h.book, h.o, h.level, h.title, h.line_no AS start_line, coalesce(nxt - 1, last_line) AS end_line, last_line FROM h JOIN totals USING (book)),
x AS (SELECT c.book, c.o, any_value(c.level) AS level, any_value(c.title) AS title, any_value(c.start_line) AS start_line, any_value(c.end_line) AS end_line, any_value(last_line) AS last_line,
  count(*) AS line_count, string_agg(l.line, chr(10) ORDER BY l.line_no) AS content FROM c JOIN lines l ON l.book = c.book AND l.line_no BETWEEN c.start_line AND c.end_line GROUP BY c.book, c.o),
chunks AS (SELECT book, 'chunk_' || lpad(CAST(o AS VARCHAR), CAST(greatest(3, length(CAST(o AS VARCHAR))) AS INTEGER), '0') AS id, title, level, start_line, CAST(end_line AS INTEGER) AS end_line, line_count,
  CAST(length(content) + CASE WHEN end_line = last_line THEN 0 ELSE 1 END AS BIGINT) AS char_count, content,
  {_STRIP.format("replace(substr(content, 1, 200), chr(10), ' ')")} || CASE WHEN length(content) > 200 THEN '...' ELSE '' END AS content_preview FROM x)"""


_SHOW_CHUNKS = " SELECT book, id, title, level, start_line, end_line, line_count, char_count, content_preview FROM chunks"
_KEYWORDS = f"""{_chunks(4)}, w AS (SELECT book, id, unnest(regexp_extract_all(lower(content), '[a-z]{{4,}}')) AS keyword FROM chunks),
k AS (SELECT book, id, keyword, row_number() OVER (PARTITION BY book, id ORDER BY count(*) DESC, keyword) AS r FROM w GROUP BY book, id, keyword QUALIFY r <= 5)"""

_TOKEN = r"list_transform(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'), lambda t: CASE WHEN regexp_matches(t, '^[0-9]{1,4}$') THEN '{NUM}' WHEN regexp_matches(t, '^[ivxlcdmIVXLCDM]+$') THEN '{ROMAN}' ELSE t END)"
_PREFIX = r"^([ivxlcdmIVXLCDM]+|\d{1,4})\s+(.{10,80})$"
_DETECT = rf"""{BASE},
exact AS (SELECT book, 0 AS seq, s AS text, 'exact' AS pattern_type, count(*) AS count, least(0.9, 0.4 + count(*) / any_value(total) * 50 + count(*) / 100 * 0.3) AS confidence, min(line_no) AS first_line, CAST([] AS VARCHAR[]) AS variants
  FROM s JOIN totals USING (book) WHERE length(s) > 3 GROUP BY book, s HAVING count(*) >= greatest(5, any_value(total) // 100)),
n0 AS (SELECT book, line_no, s AS text FROM s WHERE length(s) > 3), n1 AS (SELECT *, array_to_string({_TOKEN}, '') AS norm FROM n0),
n2 AS (SELECT *, row_number() OVER (PARTITION BY book, norm ORDER BY line_no) AS nth FROM n1 WHERE norm <> text),
norm AS (SELECT book, 1 AS seq, arg_min(text, line_no) AS text, 'normalized' AS pattern_type, count(*) AS count, least(0.85, 0.35 + count(*) / any_value(total) * 50 + count(*) / 100 * 0.3) AS confidence, min(line_no) AS first_line,
  list_sort(list_distinct(list(text) FILTER (WHERE nth <= 10))) AS variants FROM n2 JOIN totals USING (book) GROUP BY book, norm HAVING count(*) >= greatest(5, any_value(total) // 100)),
p0 AS (SELECT book, line_no, s AS full_, regexp_extract(s, '{_PREFIX}', 2) AS text FROM s WHERE regexp_matches(s, '{_PREFIX}')),
p1 AS (SELECT *, regexp_replace(text, '\d+', '{{N}}', 'g') AS norm FROM p0), p2 AS (SELECT *, row_number() OVER (PARTITION BY book, norm ORDER BY line_no) AS nth FROM p1),
mode_ AS (SELECT book, norm, text FROM p1 GROUP BY book, norm, text QUALIFY row_number() OVER (PARTITION BY book, norm ORDER BY count(*) DESC, min(line_no)) = 1),
prefix AS (SELECT p2.book, 3 AS seq, any_value(m.text) AS text, 'footer' AS pattern_type, count(*) AS count, least(0.8, 0.4 + count(*) / any_value(total) * 30) AS confidence, min(line_no) AS first_line,
  list_sort(list_distinct(list(full_) FILTER (WHERE nth <= 20))) AS variants FROM p2 JOIN mode_ m ON m.book = p2.book AND m.norm = p2.norm JOIN totals ON totals.book = p2.book GROUP BY p2.book, p2.norm HAVING count(*) >= 5),
best AS (SELECT * FROM (SELECT * FROM exact UNION ALL SELECT * FROM norm UNION ALL SELECT * FROM prefix) QUALIFY row_number() OVER (PARTITION BY book, lower(text) ORDER BY confidence DESC, seq, first_line, text) = 1),
found AS (SELECT *, CAST(row_number() OVER (PARTITION BY book ORDER BY confidence DESC, count DESC, seq, first_line, text) AS INTEGER) AS place FROM best)"""
_HEADER = f"length(text) > 15 AND length(text) < 200 AND (regexp_matches(text, {_quoted(patterns.HEADER)}) OR (count >= 10 AND NOT regexp_matches(text, {_quoted(patterns.SENTENCE_ENDS)}) AND regexp_matches(text, '^(\\p{{Lu}}|#)')))"
_KIND = f"CASE WHEN {_any('text', patterns.PAGE_NUMBER)} THEN 'page_number' WHEN {_HEADER} THEN 'header' WHEN {_any('text', patterns.WATERMARK)} THEN 'watermark' WHEN {_any('text', patterns.FOOTER)} THEN 'footer' ELSE 'unknown' END"
_CLASSIFIED = rf"""{_DETECT}, k AS (SELECT * EXCLUDE (pattern_type), {_KIND} AS kind, length(text) > 300 OR len(string_split_regex(text, '[.!?]\s+[A-Z]')) > 2 OR ({_any("text", patterns.STARTERS)} AND NOT regexp_matches(text, {_quoted(patterns.HEADER)})) AS content FROM found),
classified AS (SELECT book, seq, place, text, count, first_line, variants, CASE WHEN content THEN 'content' ELSE kind END AS pattern_type,
  CASE WHEN content THEN 0.0 ELSE least(1.0, confidence + CASE kind WHEN 'page_number' THEN 0.25 WHEN 'header' THEN 0.15 WHEN 'watermark' THEN 0.2 WHEN 'footer' THEN 0.15 ELSE 0 END) END AS confidence FROM k)"""


def _show(name: str) -> str:
    return f" SELECT book, text, pattern_type, count, round(CAST(confidence AS DOUBLE), 6) AS confidence, first_line, array_to_string(variants, chr(10)) AS variants FROM {name}"


_REMOVAL = rf"""{_CLASSIFIED}, f AS (SELECT *, regexp_replace(lower(text), '\s+', ' ', 'g') AS k FROM classified WHERE pattern_type <> 'content' AND confidence >= 0.35),
ex AS (SELECT DISTINCT book, text AS s FROM f UNION SELECT DISTINCT book, {_STRIP.format("unnest(variants)")} FROM f),
l0 AS (SELECT s.*, regexp_replace(lower(s), '\s+', ' ', 'g') AS k, EXISTS (SELECT 1 FROM ex WHERE ex.book = s.book AND ex.s = s.s) AS exact_,
  EXISTS (SELECT 1 FROM f WHERE f.book = s.book AND f.pattern_type = 'page_number') AS pages FROM s),
l1 AS (SELECT *, EXISTS (SELECT 1 FROM f WHERE f.book = l0.book AND f.k = l0.k AND f.pattern_type IN ('footer', 'header', 'watermark')) AS loose FROM l0),
l2 AS (SELECT *, regexp_replace(k, '^([ivxlcdm]+|\d{{1,4}})?\s*', '') AS bare FROM l1),
l3 AS (SELECT *, (SELECT arg_min(f.k, f.place) FROM f WHERE f.book = l2.book AND f.pattern_type = 'footer' AND length(f.text) > 20 AND (starts_with(l2.bare, f.k) OR starts_with(l2.k, f.k))) AS hit FROM l2),
l4 AS (SELECT *, {_STRIP.format("substr(regexp_replace(s, '\\s+', ' ', 'g'), CASE WHEN starts_with(k, hit) THEN 0 ELSE length(k) - length(bare) END + length(hit) + 1)")} AS rest FROM l3),
r0 AS (SELECT *, CASE WHEN s = '' OR starts_with(s, {_F}) THEN NULL WHEN exact_ THEN 'exact_match' WHEN loose THEN 'regex_pattern'
  WHEN pages AND regexp_matches(s, '^([ivxlcdmIVXLCDM]+|\d{{1,4}})$') AND length(s) <= 5 THEN 'page_number' WHEN length(rest) <= 10 THEN 'inline_footer_removed' WHEN rest IS NOT NULL THEN 'inline_footer_partial' END AS reason FROM l4),
r AS (SELECT * EXCLUDE (line), CASE WHEN reason = 'inline_footer_partial' THEN repeat(' ', length(line) - length(regexp_replace(line, '^\s+', ''))) || rest ELSE line END AS line FROM r0)"""

_GROUPS = " OR ".join("(" + " + ".join(f"CAST(list_contains(w, '{x}') AS INTEGER)" for x in group) + f") >= {least}" for group, least in patterns.KEYWORD_GROUPS)
_NEAR = f"""{BASE}, near AS (SELECT *, last_value(CASE WHEN s <> '' THEN s END IGNORE NULLS) OVER (PARTITION BY book ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above,
  first_value(CASE WHEN s <> '' THEN s END IGNORE NULLS) OVER (PARTITION BY book ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS below,
  sum(CAST(is_fence AS INTEGER)) OVER (PARTITION BY book ORDER BY line_no) AS nth FROM mask)"""
_BLANKS = f"""{BASE}, i AS (SELECT *, sum(CASE WHEN s <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY line_no) AS island FROM s),
j AS (SELECT *, row_number() OVER (PARTITION BY book, island, s = '' ORDER BY line_no) AS nth FROM i), kept AS (SELECT * FROM j WHERE s <> '' OR nth <= 2)"""

_CASES = lambda pick: " ".join(f"WHEN regexp_matches(title, {_quoted(p)}) THEN {pick(p, level, sure)}" for p, level, sure in hierarchy.NUMBERINGS)
_NORM = _STRIP.format(r"regexp_replace(lower(title), '[:;.,]+$', '')")
_SKELETON = rf"""{BASE}, nu AS (SELECT *, CASE {_CASES(lambda p, level, sure: level)} ELSE -1 END AS rule_level, CASE {_CASES(lambda p, level, sure: f"regexp_extract(title, {_quoted(p)}, 1)")} ELSE '' END AS numbering,
  CASE {_CASES(lambda p, level, sure: sure)} WHEN regexp_matches(title, {_quoted(hierarchy.FIGURE)}) THEN 0.5 ELSE 0.0 END AS confidence FROM heads),
po AS (SELECT *, count(*) OVER (PARTITION BY book, lower(title)) AS occurrences, row_number() OVER (PARTITION BY book, lower(title) ORDER BY line_no) AS nth FROM nu),
pq AS (SELECT *, occurrences > 1 AND nth > 1 AND {_any("title", hierarchy.PAGE_HEADINGS)} AS polluted FROM po),
pr AS (SELECT *, confidence > 0.8 AND NOT polluted AS is_rule, {_NORM} AS norm FROM pq),
sk AS (SELECT *, row_number() OVER w - 1 AS idx, last_value(CASE WHEN is_rule THEN rule_level END IGNORE NULLS) OVER b AS prev_level, last_value(CASE WHEN is_rule THEN numbering END IGNORE NULLS) OVER b AS prev_numbering,
  first_value(CASE WHEN is_rule THEN rule_level END IGNORE NULLS) OVER a AS next_level, first_value(CASE WHEN is_rule THEN numbering END IGNORE NULLS) OVER a AS next_numbering,
  regexp_extract(norm, '^(\S+)', 1) AS word FROM pr WINDOW w AS (PARTITION BY book ORDER BY line_no), b AS (PARTITION BY book ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY book ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
si AS (SELECT *, norm IN {_list(hierarchy.INLINE_TITLES)} OR regexp_replace(norm, 's+$', '') IN {_list(hierarchy.INLINE_TITLES)} OR ((word IN {_list(hierarchy.INLINE_TITLES)} OR regexp_replace(word, 's+$', '') IN {_list(hierarchy.INLINE_TITLES)})
  AND regexp_matches({_STRIP.format("substr(norm, length(word) + 1)")}, '^[a-z0-9]*$')) AS inline FROM sk),
lm AS (SELECT *, CASE WHEN polluted THEN 'removed' WHEN is_rule THEN 'rule' WHEN inline THEN 'inline' ELSE 'context' END AS method, {_any("lower(title)", hierarchy.DOCUMENT_TITLES)} AS dt, {_any("lower(title)", hierarchy.TOP_SECTIONS)} AS ts FROM si),
levels AS (SELECT * EXCLUDE (confidence), CAST(CASE method WHEN 'removed' THEN level WHEN 'rule' THEN least(rule_level, 6) WHEN 'inline' THEN coalesce(least(prev_level + 1, 6), 2)
  ELSE least(6, CASE WHEN dt THEN CASE WHEN idx = 0 OR (idx < 3 AND prev_level IS NULL) THEN 1 ELSE greatest(coalesce(prev_level + 1, 1), 2) END WHEN ts THEN greatest(coalesce(prev_level + 1, 1), 2)
    WHEN prev_level IS NOT NULL THEN prev_level + 1 WHEN idx = 0 THEN 1 ELSE 2 END) END AS INTEGER) AS new_level,
  CAST(CASE method WHEN 'removed' THEN 0 WHEN 'rule' THEN confidence WHEN 'inline' THEN CASE WHEN prev_level IS NULL THEN 0.6 ELSE 0.85 END ELSE CASE WHEN dt THEN 0.7 WHEN ts THEN 0.6 WHEN prev_level IS NOT NULL THEN 0.5 ELSE 0.3 END END AS DOUBLE) AS confidence FROM lm)"""

_COUNT = lambda chars: f"length(s) - length(translate(s, '{chars}', ''))"
_PSEUDO = rf"length(s) >= 8 AND (regexp_matches(s, '(?i)^({codeblocks.MATHS}|MOD|LOG2)\s*\(') OR regexp_matches(s, '(?i)=\s*({codeblocks.MATHS})\s*\(') OR (regexp_matches(s, '[A-Za-z_][\w.]*\s*=\s*') AND {_COUNT('=*()')} >= 3) OR {_COUNT('=*()[]')} >= 5 OR regexp_matches(s, '(?i)^where\s*:'))"
_NARRATIVE = "length(s) >= 40 AND (starts_with(lower(s), 'in addition to responding') OR (contains(lower(s), 'referred to as') AND contains(s, '`')) OR (starts_with(s, 'The ') AND (contains(lower(s), 'are blended') OR contains(lower(s), 'value is true when') OR contains(lower(s), 'algorithm adjusts'))))"
_STRONG = "(" + " OR ".join(f"contains(s, {_quoted(x)})" for x in codeblocks.STRONG) + ")"
_WORDS = r"len(string_split_regex(s, '\s+'))"
_TYPED = rf"""{BASE}, fe AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY line_no) AS k FROM (SELECT book, line_no, regexp_extract(line, '^ {{0,3}}(`{{3,}}|~{{3,}})', 1) AS run FROM lines) WHERE run <> ''),
st AS (SELECT book, k, line_no, run AS opener, 'open' AS role FROM fe WHERE k = 1
  UNION ALL SELECT fe.book, fe.k, fe.line_no, CASE WHEN st.opener = '' THEN fe.run WHEN fe.run[1] = st.opener[1] AND length(fe.run) >= length(st.opener) THEN '' ELSE st.opener END,
    CASE WHEN st.opener = '' THEN 'open' WHEN fe.run[1] = st.opener[1] AND length(fe.run) >= length(st.opener) THEN 'close' END FROM st JOIN fe ON fe.book = st.book AND fe.k = st.k + 1),
typed AS (SELECT s.*, st.k IS NOT NULL AS fence, regexp_matches(line, '^( {{4,}}|\t+)(`{{3,}}|~{{3,}})') AS indented, st.role,
  coalesce(st.role = 'close', false) OR coalesce(last_value(st.role IGNORE NULLS) OVER (PARTITION BY s.book ORDER BY s.line_no), 'close') = 'open' AS in_code FROM s LEFT JOIN st ON st.book = s.book AND st.line_no = s.line_no)"""
_PROSE = rf"""{_TYPED}, prose AS (SELECT book, line_no, s, CASE WHEN regexp_matches(s, '^#{{1,6}}\s') OR starts_with(s, '|') THEN 'HIGH' WHEN length(s) > 80 AND {_WORDS} > 10 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM typed
  WHERE in_code AND NOT fence AND NOT indented AND length(s) >= 15 AND NOT ({_PSEUDO}) AND NOT ({_NARRATIVE}) AND NOT {_any("s", codeblocks.NOT_PROSE)} AND NOT {_STRONG}
  AND ({_any("s", codeblocks.PROSE)} OR (regexp_matches(s, '^\p{{Lu}}') AND length(s) > 60 AND {_WORDS} > 8))),
code AS (SELECT *, {_any("s", codeblocks.CODE)} AS is_code FROM typed), around AS (SELECT *, coalesce(lag(is_code) OVER (PARTITION BY book ORDER BY line_no), false) AS up, coalesce(lead(is_code) OVER (PARTITION BY book ORDER BY line_no), false) AS down FROM code),
indented AS (SELECT book, line_no, line, CASE CAST(up AS INTEGER) + CAST(down AS INTEGER) WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM around WHERE indented),
open_ AS (SELECT book, max(line_no) AS line_no, arg_max(line, line_no) AS line, 'HIGH' AS confidence FROM typed WHERE role IS NOT NULL GROUP BY book HAVING arg_max(role, line_no) = 'open'),
issues AS (SELECT book, line_no, 'indented_fence' AS type, confidence, substr(regexp_replace(line, '\s+$', ''), 1, 80) AS content FROM indented UNION ALL SELECT book, line_no, 'prose_in_code', confidence, substr(s, 1, 100) FROM prose
  UNION ALL SELECT book, line_no, 'unclosed_block', confidence, substr(regexp_replace(line, '\s+$', ''), 1, 80) FROM open_),
gaps AS (SELECT *, CASE WHEN line_no - coalesce(lag(line_no) OVER (PARTITION BY book ORDER BY line_no), -10) > 2 THEN 1 ELSE 0 END AS new FROM prose),
grouped AS (SELECT book, min(line_no) AS first_line, max(line_no) AS last_line, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY book ORDER BY line_no) AS grp FROM gaps) GROUP BY book, grp)"""


def _without_pairs(table: str) -> str:
    """Line tables without pairs of bare fences: the run of each, and its place in it."""
    return rf"""v AS (SELECT *, substr(regexp_extract(s, '^(`{{3,}}|~{{3,}})[\p{{L}}\p{{N}}_]*$', 1), 1, 1) AS kind FROM {table} WHERE s <> ''),
v1 AS (SELECT *, CASE WHEN kind = '' OR coalesce(lag(kind) OVER (PARTITION BY book ORDER BY line_no), '') <> kind THEN 1 ELSE 0 END AS new FROM v),
v2 AS (SELECT *, sum(new) OVER (PARTITION BY book ORDER BY line_no) AS run FROM v1), v3 AS (SELECT *, row_number() OVER (PARTITION BY book, run ORDER BY line_no) AS nth, count(*) OVER (PARTITION BY book, run) AS many FROM v2 WHERE kind <> ''),
gone AS (SELECT book, min(line_no) AS a, max(line_no) AS b FROM v3 WHERE nth <= many - many % 2 GROUP BY book, run, (nth + 1) // 2)"""


_REPAIR = rf"""{_PROSE}, touched AS (SELECT DISTINCT book FROM issues),
put AS (SELECT l.book, l.line_no, 2 AS p, CASE WHEN i.book IS NULL THEN line ELSE {_STRIP.format("line")} END AS line FROM lines l LEFT JOIN (SELECT book, line_no FROM indented) i ON i.book = l.book AND i.line_no = l.line_no
  UNION ALL SELECT book, first_line, 0, {_F} FROM grouped UNION ALL SELECT book, last_line, CASE WHEN first_line = last_line THEN 1 ELSE 3 END, {_F} FROM grouped UNION ALL SELECT o.book, last_line, 4, {_F} FROM open_ o JOIN totals t ON t.book = o.book),
w AS (SELECT book, line, {_STRIP.format("line")} AS s, CAST(row_number() OVER (PARTITION BY book ORDER BY line_no, p) AS INTEGER) AS line_no FROM put), {_without_pairs("w")},
kept AS (SELECT * FROM w WHERE NOT (EXISTS (SELECT 1 FROM touched t WHERE t.book = w.book) AND EXISTS (SELECT 1 FROM gone g WHERE g.book = w.book AND w.line_no BETWEEN g.a AND g.b)))
SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY line_no) AS INTEGER) AS line_no, line FROM kept"""

_LINK = r"!\[[^\]]*\]\(([^)]+)\)"
_LINKS = rf"""{BASE}, li AS (SELECT book, line_no, unnest(range(1, len(regexp_extract_all(line, '{_LINK}', 1)) + 1)) AS p, unnest(regexp_extract_all(line, '{_LINK}', 1)) AS href FROM lines),
links AS (SELECT book, line_no, CAST(row_number() OVER (PARTITION BY book ORDER BY line_no, p) AS INTEGER) AS ordinal, href, regexp_extract(href, '([^/]+)$', 1) AS basename FROM li WHERE NOT regexp_matches(href, '(?i)^(https?|data|ftp|file|mailto):'))"""
_RECORDS = f"records AS (SELECT {_BOOK} AS book, doc_id AS ord, 'rec_' || doc_id AS image_id, n_chars AS size_bytes, doc_id % 700 AS area, CASE WHEN doc_id % 3 = 0 THEN doc_id % 500 END AS pixels FROM documents)"
_REASONS = "array_to_string(list_filter([CASE WHEN size_bytes < 3072 THEN 'size_bytes < 3072' END, CASE WHEN area < 100 THEN 'bbox_area < min' END, CASE WHEN pixels < 50 THEN 'pixels < min' END], lambda x: x IS NOT NULL), '; ')"
_EVALUATED = f"WITH {_RECORDS}, ev AS (SELECT book, image_id, {_REASONS} AS drop_reasons FROM records)"
_NUMBERED = "numbered AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY ord) AS ordinal FROM records)"
_CONTEXT = lambda before, after: rf"""{_LINKS}, im AS (SELECT book, line_no, regexp_replace(line, '\s+$', '') AS line, regexp_matches(line, '{_LINK}') AS image FROM lines),
ctx AS (SELECT k.book, k.line_no, k.href, k.basename,
  coalesce((SELECT {_STRIP.format(f"right(string_agg(line, chr(10) ORDER BY line_no), {before})")} FROM im WHERE im.book = k.book AND im.line_no < k.line_no AND NOT image), '') AS context_before,
  coalesce((SELECT {_STRIP.format(f"substr(string_agg(line, chr(10) ORDER BY line_no), 1, {after})")} FROM im WHERE im.book = k.book AND im.line_no > k.line_no AND im.line_no < coalesce((SELECT min(line_no) FROM im i2 WHERE i2.book = k.book AND i2.line_no > k.line_no AND i2.image), 2147483647)), '') AS context_after
  FROM links k)"""  # noqa: E731
_OUT = f"WITH sizes AS (SELECT {_BOOK} AS book, CAST(count(*) * 3 AS INTEGER) AS total_pages FROM documents GROUP BY 1), o AS (SELECT {_BOOK} AS book, CAST(row_number() OVER (PARTITION BY {_BOOK} ORDER BY doc_id) AS INTEGER) AS ord FROM documents), outline AS (SELECT book, ord, CASE WHEN ord % 7 = 1 THEN 0 ELSE 1 END AS depth, 'part ' || ord AS title, CAST(3 * (ord - 1) + CASE WHEN ord % 7 = 1 THEN 1 ELSE 0 END AS INTEGER) AS page FROM o)"
_FIXED = f"{_OUT}, u AS (SELECT book, total_pages, unnest(range(0, total_pages, 20)) AS a FROM sizes), fx AS (SELECT book, CAST(a // 20 + 1 AS INTEGER) AS ord, 'fixed pages ' || (a + 1) || '-' || least(a + 20, total_pages) AS title, CAST(a AS INTEGER) AS start_page, CAST(least(a + 20, total_pages) AS INTEGER) AS end_page FROM u)"
_FILES = f"""WITH f0 AS (SELECT {_BOOK} AS base_stem, CAST(doc_id % 3 + 1 AS INTEGER) AS part_no, {_BOOK} || '_pt00' || (doc_id % 3 + 1) AS stem, CASE WHEN doc_id % 2 = 0 THEN 'images' ELSE 'artifacts' END AS folder, doc_id,
  CASE WHEN doc_id % 11 = 0 THEN 'cover' || doc_id || '.png' ELSE 'image_' || lpad(CAST(doc_id % 40 AS VARCHAR), 6, '0') || '_' || doc_id || '.png' END AS name FROM documents),
files AS (SELECT *, stem || '_' || folder || '/' || name AS path FROM f0),
mapping AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY path) AS place, base_stem || '_merged_images/' || stem || '_' || name AS new FROM files)"""
_SCAN = rf"""WITH fl AS (SELECT CAST(doc_id AS VARCHAR) AS book, string_split('# Title ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(12) || '| a | b |' || chr(10) || '![x](y.png)' || chr(10) || '##  Part ' || doc_id, chr(12)) AS pages FROM documents WHERE doc_id IS NOT NULL),
pa AS (SELECT book, unnest(range(1, len(pages) + 1)) AS page_no, unnest(pages) AS body FROM fl), ln AS (SELECT book, page_no, unnest(range(len(string_split(body, chr(10))))) AS k, unnest(string_split(body, chr(10))) AS line FROM pa),
nb AS (SELECT *, length(line) - length(ltrim(line, '#')) AS lv FROM ln WHERE {_STRIP.format("line")} <> ''),
scan AS (SELECT book, row_number() OVER (PARTITION BY book ORDER BY page_no, k) - 1 AS ord, CASE WHEN lv > 0 THEN 'SECTION_HEADER' WHEN starts_with(line, '![') THEN 'PICTURE' WHEN starts_with(line, '|') THEN 'TABLE' ELSE 'TEXT' END AS label,
  CASE WHEN lv > 0 THEN {_STRIP.format("ltrim(line, '#')")} ELSE line END AS text, CAST(CASE WHEN lv > 0 THEN lv END AS INTEGER) AS level, CAST(page_no AS INTEGER) AS page_no FROM nb)"""
_ITEMS = f"""WITH items AS (SELECT {_BOOK} AS book, doc_id AS ord, CASE doc_id % 10 WHEN 0 THEN 'PICTURE' WHEN 1 THEN 'SECTION_HEADER' WHEN 2 THEN 'PAGE_FOOTER' ELSE 'TEXT' END AS label,
  CASE WHEN doc_id % 10 = 2 THEN 'All rights reserved 12' ELSE substr(text, 1, 20) END AS text, CAST(CASE WHEN doc_id % 10 = 1 THEN doc_id % 3 + 1 END AS INTEGER) AS level, CAST(doc_id // 60 AS INTEGER) AS page_no, 50.0 AS l, doc_id % 84 * 10 AS t, 500.0 AS r, doc_id % 84 * 10 + 9 AS b FROM documents)"""

_HSTACK = ", ".join(f"(SELECT max(line_no) FROM hh WHERE hh.book = i.book AND hh.line_no < i.line_no AND hh.level = {k}) AS l{k}" for k in range(1, 7))
_TRAIL = ", ".join(f"CASE WHEN l{k} > greatest({', '.join(['0', *(f'coalesce(l{j}, 0)' for j in range(1, k))])}) THEN (SELECT title FROM hh WHERE hh.book = q.book AND hh.line_no = q.l{k}) END" for k in range(1, 7))
_CRUMBS = rf"""hh AS (SELECT book, line_no, length(regexp_extract(line, '^(#{{1,6}})\s+.+$', 1)) AS level, regexp_replace(regexp_replace({_STRIP.format("regexp_extract(line, '^#{1,6}\\s+(.+)$', 1)")}, '[#§]$', ''), '\s+$', '') AS title FROM lines WHERE regexp_matches(line, '^#{{1,6}}\s+.+$')),
q AS (SELECT i.book, i.line_no, {_HSTACK} FROM lines i WHERE regexp_matches(line, '{_LINK}')),
crumbs AS (SELECT book, line_no, array_to_string(list_filter([{_TRAIL}], lambda x: x IS NOT NULL), ' > ') AS trail FROM q)"""

ORACLE_SQL: dict[str, str] = {
    "lines_explode": BASE + " SELECT book, line_no, doc_id, line FROM lines",
    "fence_mask": BASE + " SELECT book, line_no, is_fence, in_code FROM mask",
    "headings": BASE + " SELECT book, line_no, level, title FROM heads",
    "chunks_h4": _chunks(4) + _SHOW_CHUNKS,
    "chunks_h2": _chunks(2) + _SHOW_CHUNKS,
    "toc_parent": BASE + """, h AS (SELECT book, line_no, CAST(row_number() OVER (PARTITION BY book ORDER BY line_no) AS INTEGER) AS ordinal, level, title FROM heads WHERE level <= 4)
        SELECT book, ordinal, level, title, coalesce((SELECT max(g.ordinal) FROM h g WHERE g.book = h.book AND g.ordinal < h.ordinal AND g.level < h.level), 0) AS parent FROM h""",
    "toc_children": BASE + """, h AS (SELECT book, line_no, row_number() OVER (PARTITION BY book ORDER BY line_no) AS ordinal, level FROM heads WHERE level <= 4),
        t AS (SELECT book, ordinal, CAST(coalesce((SELECT max(g.ordinal) FROM h g WHERE g.book = h.book AND g.ordinal < h.ordinal AND g.level < h.level), 0) AS INTEGER) AS parent FROM h)
        SELECT book, parent, string_agg(CAST(ordinal AS VARCHAR), ',' ORDER BY ordinal) AS children FROM t GROUP BY book, parent""",
    "breadcrumb": f"{BASE}, {_CRUMBS} SELECT book, line_no, trail FROM crumbs",
    "keyword_index": _KEYWORDS + " SELECT book, keyword, string_agg(id, ',' ORDER BY id) AS ids FROM k GROUP BY book, keyword",
    "index_stats": _KEYWORDS + f" SELECT c.book, count(*) AS chunks, CAST(sum(CASE WHEN length({_STRIP.format('content')}) < 50 THEN 1 ELSE 0 END) AS BIGINT) AS empty, coalesce(any_value(n), 0) AS keywords FROM chunks c LEFT JOIN (SELECT book, count(DISTINCT keyword) AS n FROM k GROUP BY book) x ON x.book = c.book GROUP BY c.book",
    "depth_selector": BASE + " SELECT book, size, depth FROM z JOIN auto USING (book)",
    "exact_frequency": _DETECT + _show("exact"),
    "exact_positions": _DETECT + " SELECT s.book, s.s AS text, string_agg(CAST(s.line_no AS VARCHAR), ',' ORDER BY s.line_no) AS line_numbers FROM s JOIN exact x ON x.book = s.book AND x.text = s.s GROUP BY s.book, s.s",
    "normalized_frequency": _DETECT + _show("norm"),
    "prefix_footers": _DETECT + _show("prefix"),
    "pattern_dedupe": _DETECT + _show("found"),
    "pattern_classify": _CLASSIFIED + _show("classified"),
    "line_removal": _REMOVAL + " SELECT book, line_no, line, reason FROM r WHERE reason IS NOT NULL",
    "incode_cleanup": BASE + rf""", x AS (SELECT *, list_distinct(regexp_extract_all(lower(s), '[a-z]+')) AS w FROM mask WHERE in_code AND NOT is_fence AND length(s) >= 5),
        y AS (SELECT *, CASE WHEN {_any("s", patterns.CODE_PAGE_NUMBER)} THEN 'page_number' WHEN {_any("s", patterns.CODE_FURNITURE)} THEN 'header_footer_pattern' WHEN ({_GROUPS}) AND NOT {_any("s", patterns.STRONG_CODE)} THEN 'keyword_group' END AS reason FROM x)
        SELECT book, line_no, line, reason FROM y WHERE reason IS NOT NULL""",
    "merge_code_blocks": _NEAR + f" SELECT book, line_no FROM near WHERE (is_fence AND nth % 2 = 0 AND below = {_F}) OR (s = {_F} AND nth % 2 = 1 AND starts_with(above, {_F})) OR (s = '' AND nth > 0 AND nth % 2 = 0 AND starts_with(above, {_F}) AND below = {_F})",
    "merge_tables": _NEAR + r" SELECT book, line_no FROM near WHERE s = '' AND regexp_matches(above, '^\|.*\|$') AND regexp_matches(below, '^\|.*\|$')",
    "blank_compress": _BLANKS + " SELECT book, line_no, line FROM kept",
    "heading_numbering": _SKELETON + " SELECT book, line_no, rule_level, numbering, CAST(confidence AS DOUBLE) AS confidence FROM nu",
    "header_pollution": _SKELETON + " SELECT book, line_no, occurrences, polluted FROM pq",
    "skeleton_interval": _SKELETON + " SELECT book, line_no, is_rule, prev_level, prev_numbering, next_level, next_numbering FROM sk",
    "inline_sections": _SKELETON + " SELECT book, line_no, inline FROM si",
    "heading_levels": _SKELETON + " SELECT book, line_no, new_level, method, confidence FROM levels",
    "hierarchy_rewrite": _SKELETON + """, j AS (SELECT s.book, s.line_no, s.line, s.s, v.new_level, v.title, coalesce(v.polluted, false) AS gone FROM s LEFT JOIN levels v ON v.book = s.book AND v.line_no = s.line_no),
        k AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY book ORDER BY line_no), false) AND s = '' AS skip FROM j)
        SELECT book, line_no, CASE WHEN new_level IS NULL THEN line ELSE repeat('#', new_level) || ' ' || title END AS line FROM k WHERE NOT gone AND NOT skip""",
    "hierarchy_stats": _SKELETON + " SELECT book, count(*) AS total, count(*) FILTER (WHERE new_level <> level AND NOT polluted) AS fixed, count(*) FILTER (WHERE method = 'rule') AS rule, count(*) FILTER (WHERE method = 'inline') AS inline, count(*) FILTER (WHERE method = 'context') AS context, count(*) FILTER (WHERE method = 'removed') AS removed FROM levels GROUP BY book",
    "indented_fences": _PROSE + " SELECT book, line_no, confidence FROM indented",
    "prose_in_code": _PROSE + " SELECT book, line_no, confidence FROM prose",
    "code_outside": _PROSE + " SELECT book, line_no FROM code WHERE NOT in_code AND NOT fence AND NOT indented AND is_code AND length(s) > 15 AND length(s) - length(replace(s, '|', '')) < 2",
    "prose_groups": _PROSE + " SELECT book, first_line, last_line, n FROM grouped",
    "unclosed_blocks": _PROSE + " SELECT book, line_no, confidence FROM open_",
    "issue_counts": _PROSE + " SELECT type, confidence, count(*) AS n FROM issues GROUP BY type, confidence",
    "surrounding_lines": _PROSE + r" SELECT p.book, p.line_no, string_agg(CASE WHEN l.line_no = p.line_no THEN '>>> ' ELSE '    ' END || lpad(CAST(l.line_no AS VARCHAR), CAST(greatest(5, length(CAST(l.line_no AS VARCHAR))) AS INTEGER), ' ') || ': ' || substr(regexp_replace(l.line, '\s+$', ''), 1, 70), chr(10) ORDER BY l.line_no) AS around FROM prose p JOIN lines l ON l.book = p.book AND l.line_no BETWEEN p.line_no - 2 AND p.line_no + 2 GROUP BY p.book, p.line_no",
    "fence_pair_cleanup": f"""{BASE}, {_without_pairs("s")} SELECT book, line_no, line FROM lines l WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.book = l.book AND l.line_no BETWEEN g.a AND g.b)""",
    "image_links": _LINKS + " SELECT book, line_no, ordinal, href, basename FROM links",
    "image_pairing": f"{_LINKS}, {_RECORDS}, {_NUMBERED} SELECT k.book, k.ordinal, k.basename, n.image_id FROM links k JOIN numbered n ON n.book = k.book AND n.ordinal = k.ordinal",
    "image_mismatch": f"{_LINKS}, {_RECORDS} SELECT coalesce(a.book, b.book) AS book, coalesce(links, 0) AS links, coalesce(records, 0) AS records FROM (SELECT book, count(*) AS links FROM links GROUP BY book) a FULL JOIN (SELECT book, count(*) AS records FROM records GROUP BY book) b ON a.book = b.book WHERE coalesce(links, 0) <> coalesce(records, 0)",
    "image_filter": _EVALUATED + " SELECT book, image_id, drop_reasons, drop_reasons = '' AS keep FROM ev",
    "image_filter_summary": f"{_LINKS}, {_RECORDS}, {_NUMBERED}, m AS (SELECT n.book, {_REASONS} AS drop_reasons FROM links k JOIN numbered n ON n.book = k.book AND n.ordinal = k.ordinal), a AS (SELECT book, count(*) AS matched, count(*) FILTER (WHERE drop_reasons = '') AS kept, count(*) FILTER (WHERE drop_reasons <> '') AS dropped FROM m GROUP BY book), b AS (SELECT book, count(*) AS json FROM records GROUP BY book) SELECT b.book, json, coalesce(matched, 0) AS matched, coalesce(kept, 0) AS kept, coalesce(dropped, 0) AS dropped FROM b LEFT JOIN a ON a.book = b.book",
    "figure_context": _CONTEXT(2000, 1500) + " SELECT * FROM ctx",
    "relative_links": BASE + " SELECT book, line_no, replace(line, '](out/', '](../output/') AS line, 1 AS found, 1 AS changed FROM lines WHERE starts_with(line, '![fig](out/')",
    "describe_input": rf"""{_CONTEXT(200, 150)}, {_CRUMBS}, y AS (SELECT c.book, c.basename, c.context_before AS cb, c.context_after AS ca, trail FROM ctx c JOIN crumbs USING (book, line_no)),
        x AS (SELECT *, array_to_string(list_filter([CASE WHEN trail <> '' THEN 'Headings: ' || trail END, CASE WHEN cb <> '' THEN '[Before the figure in Markdown]' || chr(10) || cb END, CASE WHEN ca <> '' THEN '[After the figure in Markdown]' || chr(10) || ca END], lambda x: x IS NOT NULL), chr(10) || chr(10)) AS whole FROM y)
        SELECT k.book, k.basename, CASE WHEN trail <> '' THEN string_split(trail, ' > ')[-1] ELSE 'unknown' END AS section, CASE WHEN length(whole) > 300 THEN substr(whole, 1, 300) || chr(10) || '... [context truncated]' ELSE whole END AS document_context,
        CASE WHEN ordinal % 5 = 0 THEN 'ocr_failed: no reader' WHEN ordinal % 3 = 1 THEN 'read ' || k.basename ELSE 'unknown' END AS ocr FROM links k LEFT JOIN x ON x.book = k.book AND x.basename = k.basename""",
    "enrich_inject": rf"""{_LINKS}, b AS (SELECT book, line_no, ['<!-- figure-enrich -->', '**Figure (enriched):** ' || basename, '', 'a figure', '', '*Keywords:* one, two', '<!-- /figure-enrich -->'] AS block FROM links WHERE ordinal % 2 = 1),
        r AS (SELECT l.book, l.line_no, 0 AS p, l.line FROM lines l UNION ALL SELECT book, line_no, unnest(range(1, 8)), unnest(block) FROM b) SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY line_no, p) AS INTEGER) AS line_no, line FROM r""",
    "fixed_ranges": _FIXED + " SELECT book, ord, title, start_page, end_page FROM fx",
    "chapter_ranges": _OUT + """, c AS (SELECT o.*, coalesce(lead(page) OVER (PARTITION BY book ORDER BY ord), total_pages) AS stop FROM outline o JOIN sizes USING (book)
          WHERE depth = (SELECT CASE WHEN count(*) FILTER (WHERE depth = 0) <= 3 AND count(*) FILTER (WHERE depth = 1) > 3 THEN 1 ELSE 0 END FROM outline x WHERE x.book = o.book)),
        u AS (SELECT *, unnest(range(page, stop, 8)) AS a FROM c) SELECT book, ord, CAST((a - page) // 8 AS INTEGER) AS part, CASE WHEN stop - page > 8 THEN title || ' (part ' || ((a - page) // 8 + 1) || ')' ELSE title END AS title, CAST(a AS INTEGER) AS start_page, CAST(least(a + 8, stop) AS INTEGER) AS end_page FROM u""",
    "bookmark_pages": _OUT + ", m AS (SELECT book, ord, title, greatest(0, least(page * 2, total_pages - 1)) AS page FROM outline JOIN sizes USING (book)) SELECT book, page, arg_min(title, ord) AS title FROM m GROUP BY book, page",
    "atomic_ranges": _OUT + """, m AS (SELECT book, arg_min(title, ord) AS title, least(page, total_pages - 1) AS page, any_value(total_pages) AS total FROM outline JOIN sizes USING (book) GROUP BY book, least(page, total_pages - 1)),
        f AS (SELECT book, page, title, total FROM m WHERE page >= 2 UNION ALL SELECT book, 2, '第 3 页起', total_pages FROM sizes WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.book = sizes.book AND m.page = 2))
        SELECT book, 0 AS region, page AS start_page, coalesce(lead(page) OVER (PARTITION BY book ORDER BY page), total) AS end_page, title FROM f""",
    "split_manifest": _FIXED + ", st AS (SELECT *, book || '_pt' || lpad(CAST(ord AS VARCHAR), 3, '0') AS stem FROM fx) SELECT book, ord AS part_no, stem, stem || '.pdf' AS pdf, title, start_page + 1 AS page_start_1based, end_page AS page_end_1based_inclusive FROM st",
    "merge_parts": f"WITH d AS (SELECT {_BOOK} AS base_stem, doc_id, text, row_number() OVER (PARTITION BY {_BOOK} ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY {_BOOK}) AS n FROM documents) SELECT base_stem, string_agg('<!-- split part ' || i || '/' || n || ': doc ' || doc_id || ' -->' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY i) AS text FROM d GROUP BY base_stem",
    "artifact_dedupe": _FILES + ", x AS (SELECT stem, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(doc_id % 40 AS INTEGER) END AS idx, path FROM files), y AS (SELECT stem, idx, min(path) AS path FROM x WHERE idx IS NOT NULL GROUP BY stem, idx UNION ALL SELECT stem, idx, path FROM x WHERE idx IS NULL) SELECT stem, idx, path, CAST(row_number() OVER (PARTITION BY stem ORDER BY idx NULLS LAST, path) AS INTEGER) AS rank FROM y",
    "richer_folder": _FILES + ", c AS (SELECT stem, folder, count(*) AS n FROM files GROUP BY stem, folder) SELECT stem, folder, n FROM c QUALIFY row_number() OVER (PARTITION BY stem ORDER BY n DESC, folder = 'images' DESC) = 1",
    "path_lookup": _FILES + ", r AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY doc_id) AS nth FROM mapping) SELECT r.stem, r.doc_id AS ord, CASE r.doc_id % 6 WHEN 3 THEN 'gone/' || r.doc_id WHEN 4 THEN m.new ELSE r.new END AS new_path FROM r JOIN mapping m ON m.stem = r.stem AND m.place = r.nth",
    "path_rewrite": _FILES + """ SELECT base_stem, string_agg(CASE doc_id % 8 WHEN 0 THEN '<img alt="" src="../' || new || '">' WHEN 4 THEN '<img alt="" src="' || new || '">' ELSE '![x](' || new || ')' END, chr(10) ORDER BY path) AS text FROM mapping GROUP BY base_stem""",
    "edge_text": _ITEMS + rf", e AS (SELECT book, page_no, {_STRIP.format('text')} AS text FROM items WHERE t < 842 * 0.08 OR b > 842 * 0.92), g AS (SELECT book, count(DISTINCT page_no) AS total FROM items GROUP BY book) SELECT e.book, e.text, count(DISTINCT page_no) AS pages FROM e JOIN g USING (book) WHERE length(e.text) >= 2 GROUP BY e.book, e.text HAVING count(DISTINCT page_no) >= greatest(1, floor(any_value(total) * 0.1))",
    "edge_text_removal": BASE + r""", x AS (SELECT DISTINCT book, CASE WHEN doc_id % 2 = 0 THEN line ELSE line || ' of it' END AS s FROM lines WHERE line LIKE '%All rights reserved'), y AS (SELECT *, regexp_replace(s, '\p{Nd}+', '', 'g') AS k FROM x)
        SELECT book, line_no, line FROM s WHERE NOT EXISTS (SELECT 1 FROM y WHERE y.book = s.book AND (y.s = s.s OR (length(y.k) > 3 AND y.k = regexp_replace(s.s, '\p{Nd}+', '', 'g'))))""",
    "label_stats": _ITEMS + " SELECT book, label, CASE WHEN label = 'SECTION_HEADER' THEN coalesce(level, 1) ELSE 0 END AS level, count(*) AS n FROM items GROUP BY ALL",
    "image_index": _ITEMS + " SELECT book, 'fig_' || lpad(CAST(row_number() OVER (PARTITION BY book ORDER BY ord) - 1 AS VARCHAR), 4, '0') AS image_id, page_no, CAST(4050 AS DOUBLE) AS area, CASE WHEN ord % 20 = 0 THEN CASE WHEN length(text) > 0 THEN text || chr(10) ELSE '' END || 'b' END AS caption, CAST(to_json({'l': CAST(50 AS DOUBLE), 't': CAST(t AS DOUBLE), 'r': CAST(500 AS DOUBLE), 'b': CAST(b AS DOUBLE)}) AS VARCHAR) AS bbox FROM items WHERE label = 'PICTURE'",
    "layout_markdown": _ITEMS + ", q AS (SELECT book, ord, CASE label WHEN 'SECTION_HEADER' THEN [repeat('#', level) || ' ' || text] WHEN 'PICTURE' THEN ['<!-- image -->'] ELSE string_split(text, chr(10)) END AS parts FROM items WHERE label <> 'PAGE_FOOTER'), u AS (SELECT book, ord, unnest(range(len(parts))) AS p, unnest(parts) AS line FROM q) SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY ord, p) AS INTEGER) AS line_no, line FROM u",
    "vector_top_k": "WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS query FROM embeddings WHERE vec_id % 50 = 0), r AS (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), query), 9) DESC, vec_id) AS rank FROM embeddings, q) SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5",
    "chunks_auto": _chunks("depth") + _SHOW_CHUNKS,
    "pattern_order": _DETECT + " SELECT book, place, text FROM found",
    "index_json": _KEYWORDS + """, ck AS (SELECT c.*, coalesce(kw, []) AS keywords FROM chunks c LEFT JOIN (SELECT book, id, list(keyword ORDER BY r) AS kw FROM k GROUP BY book, id) x ON x.book = c.book AND x.id = c.id),
        cj AS (SELECT book, count(*) AS n, list({'id': id, 'title': title, 'level': level, 'start_line': start_line, 'end_line': end_line, 'line_count': line_count, 'char_count': char_count, 'content_preview': content_preview, 'summary': '', 'keywords': keywords} ORDER BY id) AS chunks FROM ck GROUP BY book),
        hd AS (SELECT book, line_no, row_number() OVER (PARTITION BY book ORDER BY line_no) AS ordinal, level, title FROM heads WHERE level <= 4),
        tj AS (SELECT book, list({'ordinal': ordinal, 'parent': coalesce((SELECT max(g.ordinal) FROM hd g WHERE g.book = hd.book AND g.ordinal < hd.ordinal AND g.level < hd.level), 0), 'level': level, 'title': title} ORDER BY ordinal) AS toc FROM hd GROUP BY book),
        kj AS (SELECT book, count(*) AS n, map_from_entries(list({'k': keyword, 'v': ids} ORDER BY keyword)) AS terms FROM (SELECT book, keyword, list(id ORDER BY id) AS ids FROM k GROUP BY book, keyword) GROUP BY book)
        SELECT cj.book, CAST(to_json({'metadata': {'depth': 4, 'total_lines': total, 'total_chunks': cj.n, 'total_keywords': kj.n, 'without_summary': cj.n}, 'chunks': cj.chunks, 'toc': toc, 'keyword_index': terms}) AS VARCHAR) AS index FROM cj JOIN tj USING (book) JOIN kj USING (book) JOIN totals USING (book)""",
    "typed_fences": _TYPED + " SELECT book, line_no, in_code, role FROM typed",
    "issue_report": _PROSE + " SELECT book, line_no, type, CASE WHEN length(content) > 60 THEN substr(content, 1, 57) || '...' ELSE content END AS content FROM issues QUALIFY row_number() OVER (PARTITION BY book ORDER BY line_no, type) <= 30",
    "issue_verification": _PROSE + " SELECT book, line_no, type, confidence FROM issues WHERE confidence <> 'LOW' OR line_no % 2 = 0",
    "codeblock_repair": _REPAIR,
    "pattern_validation": _CLASSIFIED + """, va AS (SELECT * REPLACE (CASE WHEN confidence < 0.35 OR confidence >= 0.6 OR count % 3 = 2 THEN pattern_type WHEN count % 3 = 0 THEN 'footer' ELSE 'content' END AS pattern_type,
        CASE WHEN confidence < 0.35 OR confidence >= 0.6 OR count % 3 = 2 THEN confidence WHEN count % 3 = 0 THEN least(1.0, confidence + 0.2) ELSE greatest(0.0, confidence - 0.3) END AS confidence) FROM classified)""" + _show("va"),
    "line_classes": BASE + " SELECT book, line_no FROM lines WHERE line_no % 4 IN (0, 1)",
    "heading_judged": _SKELETON + """, ju AS (SELECT *, method = 'context' AND line_no % 5 <> 0 AS takes FROM levels) SELECT book, line_no, CAST(CASE WHEN takes THEN least(6, greatest(line_no % 6 + 1, coalesce(prev_level + 1, 1))) ELSE new_level END AS INTEGER) AS new_level,
        CASE WHEN takes THEN 'llm' ELSE method END AS method, CASE WHEN takes THEN 0.75 ELSE confidence END AS confidence FROM ju""",
    "chunk_summaries": _chunks(4) + f""" SELECT book, id, CASE WHEN length({_STRIP.format('content')}) < 50 THEN '' ELSE substr('About ' || title, 1, 100) END AS summary, CASE WHEN length({_STRIP.format('content')}) < 50 THEN '' ELSE 'one,two,three' END AS keywords FROM chunks""",
    "offline_summaries": _KEYWORDS + " SELECT c.book, c.id, coalesce(kw, '') AS keywords FROM chunks c LEFT JOIN (SELECT book, id, string_agg(keyword, ',' ORDER BY r) AS kw FROM k GROUP BY book, id) x ON x.book = c.book AND x.id = c.id",
    "image_pairing_shift": f"{_LINKS}, {_RECORDS}, {_NUMBERED}, th AS (SELECT book, basename, CAST(row_number() OVER (PARTITION BY book ORDER BY ordinal) AS INTEGER) AS ordinal FROM links WHERE CAST(regexp_extract(basename, '[0-9]+') AS BIGINT) % 7 <> 0) SELECT k.book, k.ordinal, k.basename, n.image_id FROM th k JOIN numbered n ON n.book = k.book AND n.ordinal = k.ordinal",
    "figure_descriptions": f"WITH {_RECORDS} SELECT image_id, ord % 5 <> 0 AS ok, CASE WHEN ord % 5 <> 0 THEN 'T ' || image_id END AS title, CASE WHEN ord % 5 <> 0 THEN CAST(1 AS DOUBLE) END AS sure, CASE WHEN ord % 5 <> 0 THEN 'unknown' END AS summary, CASE WHEN ord % 5 <> 0 THEN image_id || '.png' END AS image_path FROM records",
    "record_paths": f"WITH {_RECORDS} SELECT image_id, CASE WHEN ord % 2 = 0 THEN './a/' || image_id ELSE '/data/out/' || image_id END AS by_marker, CASE WHEN ord % 2 = 0 THEN '/srv/output/./a/' || image_id ELSE 'out/' || image_id END AS image_path FROM records",
    "batch_status": "SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 5 <> 0) AS succeeded, count(*) FILTER (WHERE doc_id % 5 = 0) AS failed, CAST(CASE WHEN count(*) FILTER (WHERE doc_id % 5 = 0) = 0 THEN 0 ELSE 1 END AS INTEGER) AS status FROM documents",
    "resumed_parts": _FIXED + " SELECT book, ord AS part_no, book || '_pt' || lpad(CAST(ord AS VARCHAR), 3, '0') AS stem FROM fx WHERE ord >= 2 AND ord % 2 = 0",
    "size_bounded_ranges": _FIXED.replace("WITH ", "WITH RECURSIVE ", 1).replace("0, total_pages, 20", "0, total_pages, 50").replace("a + 20", "a + 50") + """, m AS (SELECT DISTINCT book, least(page, total_pages - 1) AS page FROM outline JOIN sizes USING (book)),
        pg AS (SELECT book, unnest(range(0, total_pages)) AS page, total_pages FROM sizes), cum AS (SELECT book, page, sum(1000 + page % 7 * 500) OVER (PARTITION BY book ORDER BY page) AS upto, 1000 + page % 7 * 500 AS own FROM pg),
        rr AS (SELECT book, title, start_page AS a, end_page AS b FROM fx UNION ALL SELECT book, title || half, CASE WHEN half = '（子段·前）' THEN a ELSE cut END, CASE WHEN half = '（子段·前）' THEN cut ELSE b END FROM (
          SELECT rr.book, rr.title, rr.a, rr.b, unnest(['（子段·前）', '（子段·后）']) AS half, CAST(coalesce((SELECT arg_min(m.page, abs(m.page - (rr.a + rr.b) // 2) * 100000 + m.page) FROM m WHERE m.book = rr.book AND m.page > rr.a AND m.page < rr.b), (rr.a + rr.b) // 2) AS INTEGER) AS cut
          FROM rr JOIN cum x ON x.book = rr.book AND x.page = rr.a JOIN cum y ON y.book = rr.book AND y.page = rr.b - 1 WHERE rr.b - rr.a > 1 AND y.upto - x.upto + x.own > 30000))
        SELECT rr.book, rr.title, rr.a AS start_page, rr.b AS end_page FROM rr JOIN cum x ON x.book = rr.book AND x.page = rr.a JOIN cum y ON y.book = rr.book AND y.page = rr.b - 1 WHERE rr.b - rr.a <= 1 OR y.upto - x.upto + x.own <= 30000""",
    "merged_images": _FILES + " SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE stem || '__fig_' || doc_id END AS image_id, stem AS source_part_stem FROM files",
    "layout_scan": _SCAN + " SELECT book, ord, label, text, level, page_no FROM scan",
    "outline_scan": _SCAN + " SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY ord) AS INTEGER) AS ord, level - 1 AS depth, CASE WHEN text = '' THEN '?' ELSE text END AS title, page_no - 1 AS page FROM scan WHERE level IS NOT NULL",
    "hybrid_search": _KEYWORDS + ", hy AS (SELECT book || ':' || keyword AS query_id, id, 0.4 * (1 / r) + 0.6 * (1 / (1 + r % 3)) AS score FROM k), hz AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM hy) SELECT query_id, id, rank, round(CAST(score AS DOUBLE), 6) AS score FROM hz WHERE rank <= 5",
}
