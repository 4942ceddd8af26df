"""DuckDB SQL of the operators on conversations and words."""

# crc32 by its table: each entry comes from eight steps with the polynomial.
CRC_TABLE = """crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM range(256) r(i))"""


def crc32(text):
    """crc32 of a text with code points under 2048, given that crc.t is in scope."""
    codes = f"""flatten(list_transform(list_filter(string_split({text}, ''), lambda x: x <> ''), lambda x:
      CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::BIGINT[] END))"""
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def least(*options):
    """The least of (cost, audit, lines) structs."""
    return f"list_sort([{', '.join(options)}])[1]"


def step(state, cost, letter, line="''"):
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def inserted(state, role):
    return step(state, 3, "I", f"chr(10) || '{role}:'")


USER = least("u", inserted("e", "user"), inserted("s", "user"), inserted("a", "user"))
ASSISTANT = least("a", inserted("uu", "assistant"))
NEVER = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"


def kept(state, initial):
    """The row kept after state: beyond any cost if it must go or has another initial."""
    price = f"CASE WHEN gone OR left(role, 1) <> '{initial}' THEN 1000000 ELSE more END"
    return step(state, price, "K", "chr(10) || role || ':' || text")


def changed(state, role):
    return step(state, "CASE WHEN gone THEN 1000000 ELSE 3 + more END", "R", f"chr(10) || '{role}:' || text")


def deleted(state):
    return step(state, 4, "D")


OP12 = f"""
WITH RECURSIVE {CRC_TABLE},
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
r AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM f),
n AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
p(conv_id, i, e, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 't': ''}}, {NEVER}, {NEVER}, {NEVER} FROM n
  UNION ALL
  SELECT conv_id, i, {deleted("e")}, {least(deleted("s"), kept("e", "s"))},
    {least(deleted("uu"), *(kept(x, "u") for x in ("e", "s", "aa")), *(changed(x, "user") for x in ("e", "s", "aa")))},
    {least(deleted("aa"), kept("uu", "a"), changed("uu", "assistant"))}
  FROM (SELECT *, {ASSISTANT} AS aa FROM (
    SELECT p.conv_id, p.i + 1 AS i, e, s, u, a, {USER} AS uu, role, text, gone, more
    FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1))),
b AS (
  SELECT conv_id, {least("e", "aa")} AS b FROM (SELECT *, {ASSISTANT} AS aa FROM (
    SELECT p.conv_id, e, s, u, a, {USER} AS uu FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.i)))
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.b.c, 0)::BIGINT AS cost,
  coalesce(b.b.a, '') AS audit, sha256(coalesce(substr(b.b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run),
h AS (SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, crc),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
v AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS less FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT a.word AS a, b.word AS b FROM v a JOIN v b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON v.less = w.word
  UNION SELECT w.word, v.word FROM v JOIN w ON v.less = w.word),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS most, arg_min(b, {{'n': -n, 'b': b}}) AS form
  FROM near JOIN w ON w.word = near.b GROUP BY a),
f AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN form END AS form,
    CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
chain AS (SELECT word, word AS at FROM w UNION SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.at AND f.form IS NOT NULL)
SELECT f.*, c.at AS root FROM f JOIN chain c ON c.word = f.word
JOIN f AS last ON last.word = c.at AND last.form IS NULL
"""
