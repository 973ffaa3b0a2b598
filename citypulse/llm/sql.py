"""DuckDB twins of the queries that SQL can express on the driver's tables."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text expression, bit by bit."""
    steps = f"""flatten(list_transform(range(1, length({text}) + 1),
        lambda i: list_concat([ascii(substring({text}, CAST(i AS INTEGER), 1))::BIGINT], list_transform(range(8), lambda z: (-1)::BIGINT))))"""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x:
        CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, base: str) -> str:
    """All levels of the trees over ``base`` (g, pos, n, h)."""
    return f"""{name}(lev, g, pos, n, h) AS (
  SELECT 0, g, pos, n, h FROM {base}
  UNION ALL
  SELECT lev + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY lev, g, pos // 3, n)"""


def _siblings(name: str, levels: str) -> str:
    return f"""{name} AS (
  SELECT a.lev, a.g, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
  FROM {levels} a LEFT JOIN {levels} b ON b.lev = a.lev AND b.g = a.g AND b.pos // 3 = a.pos // 3 AND b.pos <> a.pos
  WHERE a.n > 1 GROUP BY a.lev, a.g, a.pos)"""


OP11 = f"""WITH RECURSIVE
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS h,
         {_leaf('t2')} AS changed
  FROM (SELECT *, CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t2 FROM documents)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{_levels('lv', 'placed')},
subroots AS (
  SELECT g AS name, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
{_levels('tv', 'subroots')},
{_siblings('low', 'lv')},
{_siblings('high', 'tv')},
climb(g, spot, lev, pos, acc, sibs) AS (
  SELECT g, pos, 0, pos, changed, '' FROM placed
  UNION ALL
  SELECT c.g, c.spot, c.lev + 1, c.pos // 3, sha256(s.before || c.acc || s.after), c.sibs || s.before || s.after
  FROM climb c JOIN low s ON s.lev = c.lev AND s.g = c.g AND s.pos = c.pos),
inside AS (SELECT g, spot, arg_max(acc, lev) AS acc, arg_max(sibs, lev) AS sibs FROM climb GROUP BY g, spot),
rest(g, spot, lev, pos, acc, sibs) AS (
  SELECT i.g, i.spot, 0, r.pos, i.acc, i.sibs FROM inside i JOIN subroots r ON r.name = i.g
  UNION ALL
  SELECT c.g, c.spot, c.lev + 1, c.pos // 3, sha256(s.before || c.acc || s.after), c.sibs || s.before || s.after
  FROM rest c JOIN high s ON s.lev = c.lev AND s.pos = c.pos),
proven AS (SELECT g, spot, arg_max(acc, lev) AS folded_root, sha256(arg_max(sibs, lev)) AS proof_sha256 FROM rest GROUP BY g, spot),
top AS (SELECT h AS root FROM tv WHERE n = 1)
SELECT p.doc_id, p.h AS leaf, r.h AS subroot, top.root, v.proof_sha256, v.folded_root, v.folded_root = top.root AS verified
FROM placed p JOIN subroots r ON r.name = p.g JOIN proven v ON v.g = p.g AND v.spot = p.pos, top"""

OP12 = f"""WITH
split AS (
  SELECT doc_id, row_number() OVER () AS r, {crc32('CAST(doc_id AS VARCHAR)')} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
measured AS (SELECT *, len(words) AS n, h // 10 AS g FROM split),
chosen AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a,
         CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM measured),
word AS (SELECT r, i, words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS w FROM chosen, unnest(range(n)) AS t(i)),
pair AS (SELECT x.r, x.i, y.i - x.i AS q FROM word x JOIN word y ON y.r = x.r AND y.w = x.w AND y.i > x.i),
island AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pair),
stretch AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM island GROUP BY r, q, k HAVING count(*) + q >= greatest(12, 2 * q)),
run AS (SELECT r, start, length, min(q) AS period FROM stretch GROUP BY r, start, length),
summed AS (
  SELECT r, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), [length, -start, -period]) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY r),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM word
  WHERE NOT EXISTS (SELECT 1 FROM run WHERE run.r = word.r AND word.i >= run.start + run.period AND word.i < run.start + run.length)
  GROUP BY r)
SELECT m.doc_id, coalesce(s.n_runs, 0) AS n_runs, s.best.s AS start, s.best.l AS length, s.best.p AS period,
       1000 * s.best.l // s.best.p AS exponent_milli, sha256(coalesce(s.lines, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM measured m LEFT JOIN summed s ON s.r = m.r LEFT JOIN kept k ON k.r = m.r"""

OP13 = """WITH
whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pair)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

def _escaped(x: str) -> str:
    """Length of an escaped text: each backslash and control string takes one more."""
    more = [f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in ("\\", "<s>", "</s>", "[INST]", "[/INST]")]
    return f"(length({x}) + {' + '.join(more)})"


OP7 = f"""WITH
said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
summed AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(CASE WHEN role = 'assistant' THEN 7 + {_escaped('text')}
      ELSE 16 + {_escaped('role')} + length(role) - length(replace(role, chr(31), '')) + {_escaped('text')} END) AS BIGINT) AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM summed"""

SQL: dict[str, str] = {"op7_chat": OP7, "op11_merkle": OP11, "op12_periodic_runs": OP12, "op13_exact_search": OP13}
