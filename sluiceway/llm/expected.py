"""Expected results of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), tokens AS (
    SELECT r, regexp_extract_all(text, '{_WORD}') AS w FROM docs
), places AS (
    SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM tokens WHERE len(w) >= 5
), windows AS (
    SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM places
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) >= 2
), covered AS (
    SELECT r, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT r, i + unnest([0, 1, 2, 3, 4]) AS place FROM repeated) GROUP BY r
), lines AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), full_lines AS (
    SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
           length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
    FROM lines WHERE regexp_matches(line, '{_WORD}')
), judged AS (
    SELECT r, line, chars,
        (n >= 2 AND len(regexp_extract_all(
            line, '[\x20\x09-\x0D](\||»|›|>|·|•)([\x20\x09-\x0D]|\z)')) * 5 >= n)
        OR (n >= 3 AND len(regexp_extract_all(line,
            '(##+|\*\*+|\$\$+|%%+|&&+|\|\|+|<<+|>>+|!!+|\?\?+)([\x20\x09-\x0D]|\z)')) * 2 >= n)
        OR (n >= 3 AND regexp_matches(line, '\p{{Lu}}') AND NOT regexp_matches(line, '\p{{Ll}}'))
        OR regexp_matches(line, '(?i)licensed under|all rights reserved|copyright \(?c?\)?'
            || '|terms of (use|service)|privacy policy|cookies?\b|subscribe to|sign up for'
            || '|click here|powered by|javascript')
        OR (n < 4 AND NOT regexp_matches(line, '[.!?…:;"''”»)。！？][\x20\x09-\x0D]*\z'))
        AS fails
    FROM full_lines
), summed AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
           sum(chars) AS word_chars, count(*) FILTER (fails) AS n_lines_removed,
           coalesce(sum(chars) FILTER (NOT fails), 0) AS kept_chars
    FROM judged GROUP BY r
), figures AS (
    SELECT doc_id, len(w) AS n_words, coalesce(word_chars, 0) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(kept_chars, 0) AS kept_chars
    FROM docs JOIN tokens USING (r) LEFT JOIN covered USING (r) LEFT JOIN summed USING (r)
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_lines_removed AS BIGINT) AS n_lines_removed,
       CAST(kept_chars AS BIGINT) AS kept_chars, base_failed,
       NOT base_failed AND kept_chars >= word_chars * 0.3 AS kept
FROM failed
"""

_MIX = rf"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
    FROM docs GROUP BY source
), limits AS (
    SELECT *, source_size * 2.0::DOUBLE AS most,
           row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST) AS k
    FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
               - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM limits
), chosen AS (
    SELECT level FROM levels WHERE most >= w * level ORDER BY k LIMIT 1
), rates AS (
    SELECT source, source_size, least(most, w * level) AS target,
           CASE WHEN source_size > 0 THEN least(most, w * level) / source_size ELSE 0.0 END AS rate
    FROM limits, chosen
), planned AS (
    SELECT doc_id, size, source_size, target, rate,
           CAST(floor(rate) AS BIGINT) + CASE WHEN
               CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)
                    AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate)
               THEN 1 ELSE 0 END AS copies
    FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM planned
"""

# The SHA-1 comes as hexadecimal digits; ten of them are eight letters of base 32.
_ARCHIVE = """
WITH pages_read AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS d
    FROM pages_read
), largest AS (
    SELECT *, max(page_id) OVER (PARTITION BY d, payload_bytes) AS top FROM digests
)
SELECT page_id, payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(d, CAST(i // 8 * 10 + 1 AS INTEGER), 10) AS BIGINT)
              >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER) + 1, 1)
        FOR i IN range(32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM largest
"""

def _crc32(value: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(
        list_concat([4294967295], list_transform(
            range(1, length({value}) + 1), lambda p: CAST(ascii({value}[p]) AS BIGINT))),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
            lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _edited(state: str, cost: str, edits: str, line: str = "''") -> str:
    """A state's cheapest edits with more appended; null where the state cannot be reached."""
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, "
        f"'a': {state}.a || '{edits}', 'o': {state}.o || {line}}} END"
    )


def _cheapest(*candidates: str) -> str:
    return f"list_min([{', '.join(candidates)}])"


def _kept(state: str, initial: str, role: str | None) -> str:
    """Candidates that keep the row or give it ``role`` after ``state``."""
    stays = "(NOT blank AND NOT duplicate)"
    keep = _edited(state, "cut", "K", "(chr(10) || role || ':' || text)")
    found = f"CASE WHEN {stays} AND role[1] = '{initial}' THEN {keep} END"
    if role is not None:
        given = _edited(state, "(2 + cut)", "R", f"(chr(10) || '{role}:' || text)")
        found += f", CASE WHEN {stays} THEN {given} END"
    return found


_USER, _ASSISTANT = "(chr(10) || 'user:')", "(chr(10) || 'assistant:')"
_PAIR = "(chr(10) || 'user:' || chr(10) || 'assistant:')"

_REPAIR = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
               || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), kinds AS (
    SELECT *, {_crc32("k")} % 20 AS kind FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                     ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds)
    WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), met AS (
    SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open,
           lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
    FROM placed
), faults AS (
    SELECT *, again AND NOT blank AS duplicate,
           CASE WHEN open AND NOT blank AND NOT again THEN 1 ELSE 0 END AS cut
    FROM met
), counted AS (
    SELECT conv_id, count(*) AS n,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           sum(cut) AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
), edits AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i,
           {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS s0,
           CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s1,
           CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s2,
           CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s3
    FROM counted
    UNION ALL
    SELECT conv_id, i, {_edited("x0", "3", "D")},
           {_cheapest(_edited("x1", "3", "D"), _kept("x0", "s", None))},
           {_cheapest(_edited("x2", "3", "D"), _kept("x0", "u", "user"),
                      _kept("x1", "u", "user"), _kept("x3", "u", "user"))},
           {_cheapest(_edited("x3", "3", "D"), _kept("x2", "a", "assistant"))}
    FROM (
        SELECT f.conv_id, f.i, f.role, f.text, f.blank, f.duplicate, f.cut, s0 AS x0, s1 AS x1,
               {_cheapest("s2", _edited("s0", "2", "I", _USER), _edited("s1", "2", "I", _USER),
                          _edited("s3", "2", "I", _USER))} AS x2,
               {_cheapest("s3", _edited("s2", "2", "I", _ASSISTANT),
                          _edited("s0", "4", "II", _PAIR), _edited("s1", "4", "II", _PAIR))} AS x3
        FROM edits e JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i + 1
    )
), settled AS (
    SELECT conv_id, {_cheapest("s0", "s3", _edited("s2", "2", "I", _ASSISTANT),
                               _edited("s1", "4", "II", _PAIR))} AS best, c.*
    FROM edits e JOIN (SELECT conv_id AS counted_id, * EXCLUDE (conv_id) FROM counted) c
        ON c.counted_id IS NOT DISTINCT FROM e.conv_id AND c.n = e.i
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
       CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN settled s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
"""


_TRIE = rf"""
WITH said AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
           sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || ':'
               || coalesce(text, '')) AS item
    FROM conversations WHERE conv_id IS NOT NULL
), talks AS (
    SELECT conv_id, list({{'item': item, 'chars': chars}} ORDER BY turn NULLS FIRST, item) AS own,
           CAST(conv_id AS VARCHAR) AS k
    FROM said GROUP BY conv_id
), openings AS (
    SELECT *, {_crc32("k")} % 6 AS h FROM talks
), rebuilt AS (
    SELECT t.conv_id, list_concat(coalesce(b.own[1:t.h], []), t.own[t.h + 1:]) AS turns
    FROM openings t LEFT JOIN talks b ON b.conv_id = t.conv_id - t.conv_id % 100
), prefixes AS (
    SELECT conv_id, d AS depth, len(turns) AS n, turns,
           sha256(array_to_string(list_transform(turns[1:d], lambda t: t.item), ',')) AS node
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(any_value(turns[depth].chars), 0) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
               FILTER (depth = n), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, node
), paths AS (
    SELECT n.depth, n.node, n.n_convs, n.chars, p.depth AS above_depth, p.node AS above
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
), children AS (
    SELECT above_depth AS depth, above AS node, count(*) AS n_children
    FROM paths WHERE above_depth = depth - 1 GROUP BY above_depth, above
), sums AS (
    SELECT p.above_depth AS depth, p.above AS node,
           count(*) FILTER (c.n_children IS NULL) AS n_leaves,
           sum((p.n_convs - 1) * p.chars) AS saved_tokens
    FROM paths p LEFT JOIN children c ON c.depth = p.depth AND c.node = p.node
    GROUP BY p.above_depth, p.above
), parents AS (
    SELECT p.depth, p.node, m.conv_id AS parent_conv_id
    FROM paths p JOIN nodes m ON m.depth = p.above_depth AND m.node = p.above
    WHERE p.above_depth = p.depth - 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN sums s USING (depth, node)
LEFT JOIN children c USING (depth, node) LEFT JOIN parents m USING (depth, node)
"""


STATEMENTS: dict[str, str] = {
    "op3_warc": _ARCHIVE,
    "op8_quality_rules": _QUALITY,
    "op9_mixing": _MIX,
    "op11_conversation_repair": _REPAIR,
    "op13_prefix_trie": _TRIE,
}
