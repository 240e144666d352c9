"""DuckDB SQL for the operators on conversations and spellings: other ways to the same rows."""

from __future__ import annotations

#: CRC-32 by its table; the polynomial is the usual reversed one.
_CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)) r)"""


def _crc32(text: str) -> str:
    octets = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    step = "xor(c // 256, t[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda c, b: {step}), 4294967295)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SPELLING = f"""
    WITH RECURSIVE {_CRC_TABLE}, runs AS (
        SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]+'))")} AS run FROM documents
    ), hashed AS (
        SELECT run, times, {_crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h
        FROM (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY 1, 2) p, crc_table
    ), words AS (
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
            SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed) w
        WHERE length(word) >= 5 GROUP BY 1 HAVING sum(times) >= 3
    ), places AS (
        SELECT word, n, unnest(range(length(word))) AS i FROM words
    ), cut AS (
        SELECT word, n, substr(word, 1, i) || '?' || substr(word, i + 2) AS around, substr(word, 1, i) || substr(word, i + 2) AS short FROM places
    ), near AS (
        SELECT a.word, b.word AS other, b.n AS times FROM cut a JOIN cut b ON a.around = b.around AND a.word <> b.word
        UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.short = w.word
        UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.short = w.word
    ), best AS (
        SELECT word, count(*) AS n_near, arg_min(other, {{'less': -times, 'word': other}}) AS other, max(times) AS times FROM near GROUP BY 1
    ), judged AS (
        SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN times >= 2 * n THEN other END AS form, CASE WHEN times >= 2 * n THEN times END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), chain AS (
        SELECT word, word AS root, form AS next FROM judged
        UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON c.next = j.word
    )
    SELECT word, form, root, n, n_near, form_n FROM judged JOIN (SELECT word, root FROM chain WHERE next IS NULL) c USING (word)
"""


def _after(value: str, cost: str, letter: str) -> str:
    """Six digits of cost and the edits behind them, with an edit in front: texts compare as (cost, edits) do."""
    return f"(lpad(CAST(CAST(substr({value}, 1, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || '{letter}' || substr({value}, 7))"


def _best(state: int) -> str:
    made = 3 if state == 2 else 2
    keeps = {0: "CASE initial WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE initial WHEN 'u' THEN v2 END", 2: "CASE initial WHEN 'a' THEN v3 END",
             3: "CASE initial WHEN 'u' THEN v2 END"}[state]
    return (f"least({_after(f'v{state}', '3', 'D')}, CASE WHEN kind IN ('o', 't') THEN {_after(f'v{made}', '2 + cut', 'R')} END, "
            f"CASE WHEN kind IN ('o', 't') THEN {_after(f'({keeps})', 'cut', 'K')} END) AS b{state}")


_SPACE = "'[\\x20\\x09-\\x0D]+$'"

CONVERSATIONS = f"""
    WITH RECURSIVE {_CRC_TABLE}, marked AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fault
        FROM conversations, crc_table
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
               CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM marked
    ), numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS no,
               regexp_replace(text, {_SPACE}, '') AS bare, substr(role, 1, 1) AS initial
        FROM damaged
    ), classed AS (
        SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY no) > 1 THEN 'd'
                       WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'o' END AS kind,
               lead(initial) OVER (PARTITION BY conv_id ORDER BY no) AS following
        FROM numbered
    ), rows AS (
        SELECT *, CASE WHEN kind = 't' THEN 1 ELSE 0 END AS cut FROM classed
    ), counted AS (
        SELECT c.conv_id, count(r.no) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (kind = 'b') AS blank, count(*) FILTER (kind = 'd') AS duplicate, count(*) FILTER (kind = 't') AS truncated,
               count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY 1
    ), rest AS (
        SELECT conv_id, n AS place, '000000' AS v0, '000004II' AS v1, '000002I' AS v2, '000000' AS v3 FROM counted
        UNION ALL
        SELECT conv_id, place - 1, least(b0, {_after('n2', '2', 'I')}), least(b1, {_after('n2', '2', 'I')}), n2, n3
        FROM (SELECT *, least(b2, {_after('b3', '2', 'I')}) AS n2, least(b3, {_after('b2', '2', 'I')}) AS n3
              FROM (SELECT s.conv_id, place, {', '.join(map(_best, range(4)))}
                    FROM rest s JOIN rows r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.no = s.place) a) b
    ), audited AS (
        SELECT conv_id, CAST(substr(v0, 1, 6) AS BIGINT) AS cost, substr(v0, 7) AS audit FROM rest WHERE place = 0
    ), edited AS (
        SELECT conv_id, audit, 1 AS p, 0 AS no, 0 AS state, '' AS whole FROM audited
        UNION ALL
        SELECT conv_id, audit, p + 1, no, CASE WHEN edit = 'D' THEN state WHEN edit = 'K' THEN strpos('sua', initial) WHEN state = 2 THEN 3 ELSE 2 END,
               whole || CASE WHEN edit = 'D' THEN '' ELSE CASE WHEN whole = '' THEN '' ELSE chr(10) END || CASE WHEN edit = 'K' THEN role
                   WHEN state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END END
        FROM (SELECT e.conv_id, audit, p, e.no + CASE WHEN substr(audit, p, 1) = 'I' THEN 0 ELSE 1 END AS no, state, whole, substr(audit, p, 1) AS edit,
                     role, text, initial
              FROM edited e LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.no = e.no + 1
              WHERE p <= length(audit)) x
    )
    SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, cost, e.audit, sha256(whole) AS repaired_sha256
    FROM counted c JOIN audited a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
    JOIN edited e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND p = length(e.audit) + 1
"""
