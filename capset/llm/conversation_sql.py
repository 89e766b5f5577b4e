"""DuckDB SQL of the conversation operators."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Of ASCII texts, bit by bit."""
    table = "list_reduce(range(8), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b))"
    return (f"xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)), "
            f"lambda c, b: {table}, CAST(4294967295 AS BIGINT)))")


def _edit(state: str, cost: str, letter: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'x': {state}.x || {line}}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def repair_sql() -> str:
    """The shortest path over what may come next (``e`` nothing yet, ``s``, ``u``, ``a``), folded over each conversation's turns."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    insert = lambda state, line: _edit(state, "2", "I", line)
    # inserts before a turn: bound as z of a list of one
    closed_u = _least("z.u", insert("z.e", user), insert("z.s", user), insert("z.a", user))
    closed = f"list_transform([{{'e': z.e, 's': z.s, 'a': z.a, 'u': {closed_u}}}], lambda y: {{'e': y.e, 's': y.s, 'u': y.u, 'a': {_least('y.a', insert('y.u', assistant))}}})[1]"
    must = "(CASE WHEN t.f IN ('blank', 'duplicate') THEN 1000000 ELSE 0 END + CASE WHEN t.f = 'truncated' THEN 1 ELSE 0 END)"
    drop = lambda s: _edit(f"w.{s}", "3", "D", "''")
    keep = lambda s, i: _edit(f"w.{s}", f"{must} + CASE WHEN t.i = '{i}' THEN 0 ELSE 1000000 END", "K", "chr(10) || t.r || ':' || t.t")
    rerole = lambda s, line: _edit(f"w.{s}", f"{must} + 2", "R", f"{line} || t.t")
    turn = (f"{{'e': {drop('e')}, 's': {_least(drop('s'), keep('e', 's'))}, "
            f"'u': {_least(drop('u'), *[f for s in 'esa' for f in (keep(s, 'u'), rerole(s, user))])}, "
            f"'a': {_least(drop('a'), keep('u', 'a'), rerole('u', assistant))}}}")
    none = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 'x': ''}"
    begin = f"{{'e': {{'c': CAST(0 AS BIGINT), 'a': '', 'x': ''}}, 's': {none}, 'u': {none}, 'a': {none}}}"
    # a turn's step reads the state as w, the inserts' as z
    step = f"list_transform(list_transform([z], lambda z: {closed}), lambda w: {turn})[1]"
    blank = "regexp_matches({0}, '[^\\x20\\x09-\\x0D]')"
    return f"""WITH keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT conv_id, turn, role, text, {crc32('k')} % 20 AS what FROM keyed),
damaged AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
  CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE what <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n FROM damaged),
faults AS (SELECT *, CASE WHEN NOT {blank.format('text')} THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS f,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] AS two FROM placed),
conv AS (SELECT conv_id, list({{'i': role[1], 'f': f, 'r': role, 't': text}} ORDER BY n) AS turns,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated,
  count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ended AS (SELECT * EXCLUDE (turns), list_transform([list_reduce(list_transform(turns, lambda q: {{'z': {begin}, 't': q}}),
  lambda acc, q: {{'z': list_transform([{{'z': acc.z, 't': q.t}}], lambda p: list_transform([p.z], lambda z: list_transform([p.t], lambda t: {step})[1])[1])[1], 't': q.t}},
  {{'z': {begin}, 't': turns[1]}}).z], lambda z: {closed})[1] AS z FROM conv),
best AS (SELECT *, {_least('z.e', 'z.a')} AS b FROM ended),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(substr(b.x, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id"""


def trie_sql() -> str:
    """Prefixes as lists of turns; a subtree is found by the prefixes of its members."""
    return f"""WITH placed AS (SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS q,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(q ORDER BY n) AS turns, {crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM placed GROUP BY c),
built AS (SELECT own.c, list_concat(coalesce(p.turns[1:own.h], []), own.turns[own.h + 1:]) AS turns
  FROM own LEFT JOIN own p ON p.c = own.c - own.c % 20),
prefixes AS (SELECT c, len(turns) AS n, unnest(range(len(turns) + 1)) AS d, turns FROM built),
node AS (SELECT d, turns[1:d] AS prefix, min(c) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends FROM prefixes GROUP BY 1, 2),
child AS (SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
counted AS (SELECT node.*, coalesce(n_children, 0) AS n_children,
  CASE WHEN node.d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node.prefix[node.d].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM node LEFT JOIN child ON node.d = child.d AND node.prefix = child.prefix),
above AS (SELECT unnest(range(d + 1)) AS e, prefix, n_children, saved FROM counted),
subtree AS (SELECT e AS d, prefix[1:e] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM above GROUP BY 1, 2)
SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves,
  CAST(subtree.saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
FROM counted a JOIN subtree ON a.d = subtree.d AND a.prefix = subtree.prefix
LEFT JOIN node p ON a.d > 0 AND p.d = a.d - 1 AND p.prefix = a.prefix[1:a.d - 1]"""
