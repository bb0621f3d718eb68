"""The queries over conversations as SQL for DuckDB, which has no CRC-32 of its own."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    byte = f"lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), {bit})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), {byte}))"


WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"

TRIE = f"""
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 4 AS h FROM t GROUP BY conv_id),
    own AS (
      SELECT c.conv_id, 0 AS part, pos, role, text
      FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
      UNION ALL
      SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
    s AS (
      SELECT c.conv_id, coalesce(list(md5(role || ':' || text) ORDER BY part, pos)
               FILTER (role IS NOT NULL), []) AS keys,
             coalesce(list({WORDS} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS words
      FROM c LEFT JOIN own ON own.conv_id = c.conv_id GROUP BY c.conv_id),
    p AS (SELECT conv_id, d, keys[1:d] AS path, coalesce(words[d], 0) AS w, d = len(keys) AS ends
          FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS d FROM s)),
    n AS (SELECT d AS depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
                   AS ends_sha256
          FROM p GROUP BY d, path),
    k AS (SELECT n.*, up.conv_id AS parent_conv_id,
                 (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.path[1:n.depth] = n.path)
                   AS n_children
          FROM n LEFT JOIN n up ON up.depth = n.depth - 1 AND up.path = n.path[1 : n.depth - 1])
    SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, b.n_leaves,
           b.saved_tokens, k.ends_sha256
    FROM k JOIN (
      SELECT top.depth, top.path, count(*) FILTER (x.n_children = 0) AS n_leaves,
             sum((x.n_convs - 1) * x.w)::BIGINT AS saved_tokens
      FROM k top JOIN k x ON x.depth >= top.depth AND x.path[1:top.depth] = top.path
      GROUP BY top.depth, top.path) b ON b.depth = k.depth AND b.path = k.path
"""


def _paid(state: str, cost: str, edits: str) -> str:
    """A cost of nine digits and its audit, with an edit in front."""
    return f"lpad((left({state}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{edits}' || substr({state}, 10)"


def _row_first(state: int) -> str:
    """The best of what a row can become in this state, without inserts."""
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    other = 3 if state == 2 else 2
    keep = " ".join(
        f"WHEN fault IN ('o', 't') AND initial = '{role}' THEN {_paid(f's{after}', 'late', 'K')}"
        for role, after in keeps.items()
    )
    rerole = f"CASE WHEN fault IN ('o', 't') THEN {_paid(f's{other}', 'late + 3', 'R')} END"
    return f"least({_paid(f's{state}', '4', 'D')}, CASE {keep} END, {rerole}) AS t{state}"


REPAIR = f"""
    WITH RECURSIVE h AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc32("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS k
      FROM conversations),
    g AS (
      SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM h WHERE k <> 0),
    r AS (
      SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11)
               || chr(12) || chr(13)) AS trimmed,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
      FROM g),
    f AS (
      SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
             CASE WHEN trimmed = '' THEN 'b' WHEN seen > 1 THEN 'd'
                  WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'o' END AS fault
      FROM r),
    c AS (
      SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
             count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY conv_id),
    go(conv_id, i, s0, s1, s2, s3) AS (
      SELECT conv_id, n, '000000000', '000000006II', '000000003I', '000000000' FROM c
      UNION ALL
      SELECT conv_id, i - 1, least(t0, {_paid("t2", "3", "I")}, {_paid("t3", "6", "II")}),
             least(t1, {_paid("t2", "3", "I")}, {_paid("t3", "6", "II")}),
             least(t2, {_paid("t3", "3", "I")}), least(t3, {_paid("t2", "3", "I")})
      FROM (SELECT go.conv_id, go.i, {", ".join(map(_row_first, range(4)))}
            FROM (SELECT go.*, role, fault, initial, CASE fault WHEN 't' THEN 3 ELSE 0 END AS late
                  FROM go JOIN f ON f.conv_id IS NOT DISTINCT FROM go.conv_id AND f.i = go.i) go)),
    b AS (SELECT conv_id, left(s0, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM go WHERE i = 0),
    e AS (
      SELECT conv_id, p, substr(audit, p, 1) AS edit,
             length(replace(left(audit, p), 'I', '')) AS i, length(replace(left(audit, p), 'D', '')) AS o
      FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM b)),
    w AS (
      SELECT e.*, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text,
             bool_or(edit = 'K' AND o = 1 AND initial = 's') OVER (PARTITION BY e.conv_id) AS led
      FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND edit <> 'I'),
    z AS (
      SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
                 WHEN (o - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
               chr(10) ORDER BY p) FILTER (edit <> 'D') AS repaired
      FROM w GROUP BY conv_id)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id
"""
