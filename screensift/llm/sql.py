"""DuckDB SQL of the pipeline operators whose text is generated."""

from __future__ import annotations

#: CRC-32 (reflected polynomial 0xEDB88320) of the text ``{0}``, byte by byte and bit by bit; ASCII texts only.
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
  4294967295)"""


def _levels(prefix: str, leaves: str, fanout: int, height: int) -> str:
    """CTEs {prefix}0.. of nodes with the digests left and right of them in their run; groups of one node stay as they are."""
    parts = [f"{prefix}0 AS ({leaves})"]
    for k in range(height):
        parts.append(f"""{prefix}{k + 1} AS (
  SELECT grp, idx // {fanout} AS idx, CASE WHEN n = 1 THEN 1 ELSE (n + {fanout - 1}) // {fanout} END AS n,
         CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {prefix}{k} GROUP BY grp, idx // {fanout}, n)""")
        around = f"OVER (PARTITION BY grp, idx // {fanout} ORDER BY idx ROWS BETWEEN"
        parts.append(f"""{prefix}s{k} AS (
  SELECT grp, idx, n, coalesce(string_agg(digest, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{k})""")
    return ",\n".join(parts)


def _climb(prefix: str, height: int, fanout: int, start: str, grp: str, idx: str, name: str) -> str:
    """CTEs {name}1.. that fold ``shown`` and gather the siblings level by level, from the CTE ``start``."""
    parts, last = [], start
    for k in range(height):
        parts.append(f"""{name}{k + 1} AS (
  SELECT t.* EXCLUDE (shown, proof), proof || l || r AS proof, CASE WHEN s.n = 1 THEN shown ELSE sha256(l || shown || r) END AS shown
  FROM {last} t JOIN {prefix}s{k} s ON s.grp = t.{grp} AND s.idx = t.{idx} // {fanout ** k})""")
        last = f"{name}{k + 1}"
    return ",\n".join(parts)


def merkle_sql(fanout: int, height: int = 6) -> str:
    """The manifest's rows with ``height`` levels written out in either tree (16 million leaves a group at fanout 16)."""
    def one(column: str) -> str:
        value = f"CAST({column} AS VARCHAR)"
        return f"coalesce(CAST(octet_length(encode({value})) AS VARCHAR) || ':' || {value}, '-')"

    head = " || ".join(one(c) for c in ("doc_id", "source", "lang", "n_chars"))
    tampered = f"{CRC32.format('CAST(doc_id AS VARCHAR)')} % 5 = 0"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shown = f"CASE WHEN {tampered} THEN {lower} ELSE text END"
    leaves = "SELECT grp, idx, n, digest FROM numbered"
    subs = f"""SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, digest, grp AS name
  FROM t{height}"""
    return f"""
WITH leaf AS (
  SELECT doc_id, coalesce('1' || source, '0') AS grp, sha256({head} || {one('text')}) AS digest,
         sha256({head} || {one(f'({shown})')}) AS shown FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM leaf),
{_levels('t', leaves, fanout, height)},
{_levels('u', subs, fanout, height)},
begun AS (SELECT d.doc_id, d.digest AS leaf, d.grp, d.idx, u.idx AS place, '' AS top, u.digest AS subroot, d.shown, '' AS proof
          FROM numbered d JOIN u0 u ON u.name = d.grp),
{_climb('t', height, fanout, 'begun', 'grp', 'idx', 'a')},
{_climb('u', height, fanout, f'a{height}', 'top', 'place', 'b')}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, shown AS folded_root, shown = digest AS verified
FROM b{height}, u{height}
"""


def repair_sql() -> str:
    """Damage and repair of ``conversations``: the edit lattice row by row, four states a conversation, (cost, audit) least in each."""
    white = r"\x20\x09-\x0D"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, coalesce('1' || CAST(conv_id AS VARCHAR), '0') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format(f'({key})')} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, (VALUES (0), (1)) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
marked AS (
  SELECT *, regexp_extract(text, '([^{white}])[{white}]*$', 1) AS last,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS c, CASE WHEN last = '' THEN 0 WHEN nth > 1 THEN 1 WHEN last NOT IN ('.', '!', '?') THEN 2 ELSE 3 END AS fault FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), fault DESC) AS i FROM faulty),
pairs AS (SELECT conv, i, c || coalesce(lead(c) OVER (PARTITION BY conv ORDER BY i), '') AS two, i = max(i) OVER (PARTITION BY conv) AS ends FROM placed),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 0) AS blank,
         count(*) FILTER (fault = 1) AS duplicate, count(*) FILTER (fault = 2) AS truncated, count(*) AS n FROM placed GROUP BY conv),
illegal AS (SELECT conv, count(*) FILTER (NOT ends AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv),
takes(s, c, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
puts(s, t) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
adds(s, t, price, edits) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
  (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
moves AS (
  SELECT conv, i, s, s AS t, 3 AS price, 'D' AS edit FROM placed, puts
  UNION ALL SELECT conv, i, s, t, CASE WHEN fault = 2 THEN 1 ELSE 0 END, 'K' FROM placed JOIN takes USING (c) WHERE fault > 1
  UNION ALL SELECT conv, i, s, t, CASE WHEN fault = 2 THEN 3 ELSE 2 END, 'R' FROM placed, puts WHERE fault > 1),
walk(conv, i, s, best) AS (
  SELECT conv, 0::BIGINT, 0, struct_pack(cost := 0, audit := '') FROM counts
  UNION ALL
  SELECT w.conv, m.i, m.t, min(struct_pack(cost := w.best.cost + a.price + m.price, audit := w.best.audit || a.edits || m.edit))
  FROM walk w JOIN adds a ON a.s = w.s JOIN moves m ON m.conv = w.conv AND m.i = w.i + 1 AND m.s = a.t GROUP BY w.conv, m.i, m.t),
ends AS (
  SELECT conv, min(struct_pack(cost := best.cost + price, audit := best.audit || edits)) AS best
  FROM walk w JOIN counts c USING (conv) JOIN adds a ON a.s = w.s WHERE w.i = c.n AND a.t IN (0, 3) GROUP BY conv),
steps AS (
  SELECT conv, unnest(string_split(best.audit, '')) AS edit, unnest(range(length(best.audit))) AS pos FROM ends WHERE best.audit <> ''),
numbered AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv ORDER BY pos) AS i FROM steps),
stays AS (
  SELECT n.conv, pos, edit, p.role, CASE WHEN edit = 'I' THEN '' ELSE p.text END AS text,
         row_number() OVER (PARTITION BY n.conv ORDER BY pos) - 1 AS q, first_value(CASE WHEN edit = 'K' AND c = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY n.conv ORDER BY pos) AS skip
  FROM numbered n LEFT JOIN placed p ON p.conv = n.conv AND p.i = n.i AND edit <> 'I' WHERE edit <> 'D'),
repaired AS (
  SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - skip) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY q) AS body
  FROM stays GROUP BY conv)
SELECT h.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM hit) h LEFT JOIN counts c USING (conv) LEFT JOIN illegal l USING (conv)
LEFT JOIN ends e USING (conv) LEFT JOIN repaired r USING (conv)
"""
