"""SQL for the rows of those queries that SQL can express."""

from quotelane.llm import quality

_SPACES = r"[\x20\x09-\x0D]+"
_CLASSES = {
    "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]",
    "mark": r"""[.,;:!?''"()-]""", "symbol": r"[#*$%&|<>]",
}


def _half(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) / 2 ELSE 0 END)"


def _divergence(p: str, q: str) -> str:
    return f"({_half(p, q)} + {_half(q, p)})"


def rules() -> str:
    counts = ", ".join(
        f"length(text) - length(regexp_replace(text, '{kind}', '', 'g')) AS c_{name}" for name, kind in _CLASSES.items())
    names = [f"c_{name}" for name in _CLASSES]
    sums = ", ".join(f"sum({c}) AS {c}" for c in [*names, "c_other", "chars", "n"])
    classes = " + ".join(
        _divergence(f"(c.{c} / greatest(c.chars, 1))", f"(f.{c} / greatest(f.chars, 1))") for c in [*names, "c_other"])
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '{_SPACES}'), lambda x: x <> '') AS ws FROM d),
c AS (
  SELECT *, chars - {" - ".join(names)} AS c_other
  FROM (SELECT r, doc_id, lang, len(ws) AS n, length(text) AS chars, {counts} FROM w)),
words AS (SELECT r, lang, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
windows AS (
  SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
repeated AS (
  SELECT r, i FROM windows WHERE three IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, three) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM repeated, range(3) t(k) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
totals AS (
  (SELECT lang, {sums} FROM c WHERE lang IS NOT NULL GROUP BY lang
   HAVING sum(n) >= {quality.REFERENCE_WORDS} ORDER BY sum(n) DESC, lang LIMIT {quality.LANGUAGES})
  UNION ALL SELECT NULL, {sums} FROM c),
counted AS (
  SELECT lang, lower(word) AS word, count(*) AS uses FROM words GROUP BY ALL HAVING count(*) > 1),
common AS (
  SELECT * FROM (
    SELECT lang, word, uses FROM counted WHERE lang IS NOT NULL
    UNION ALL SELECT NULL, word, sum(uses) FROM counted GROUP BY word)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY uses DESC, word) <= {quality.COMMON_WORDS}),
shares AS (
  SELECT common.lang, word, uses / t.n AS q FROM common JOIN totals t ON t.lang IS NOT DISTINCT FROM common.lang),
judged AS (
  SELECT c.r, c.n, f.lang AS ref, {classes} AS class_divergence
  FROM c JOIN totals f ON f.lang IS NOT DISTINCT FROM
    CASE WHEN c.lang IN (SELECT lang FROM totals WHERE lang IS NOT NULL) THEN c.lang END),
own AS (SELECT r, lower(word) AS word, count(*) AS uses FROM words GROUP BY ALL),
bins AS (
  SELECT j.r, coalesce(own.uses, 0) / j.n AS p, s.q
  FROM judged j JOIN shares s ON s.lang IS NOT DISTINCT FROM j.ref LEFT JOIN own ON own.r = j.r AND own.word = s.word
  WHERE j.n >= {quality.WORD_GUARD}),
rest AS (
  SELECT r, sum({_divergence("p", "q")}) AS common, 1 - sum(p) AS p, greatest(1 - sum(q), 0) AS q FROM bins GROUP BY r),
measured AS (
  SELECT c.doc_id, c.n AS n_words, c.chars - c.c_space AS word_chars, c.c_symbol AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    c.n < 50 OR 100 * coalesce(n_repeat, 0) > 50 * c.n AS base_failed,
    c.n < {quality.CLASS_GUARD} OR sqrt(greatest(class_divergence, 0)) <= {quality.CLASS_DISTANCE} AS near,
    c.n < {quality.WORD_GUARD}
      OR sqrt(greatest(rest.common + {_divergence("rest.p", "rest.q")}, 0)) <= {quality.WORD_DISTANCE} AS usual
  FROM c JOIN judged USING (r) LEFT JOIN rest USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND near AND usual AS kept
FROM measured"""


CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NOT DISTINCT FROM role AS goes_on,
    length(regexp_replace(text, '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS chars,
    length(regexp_replace(role, '([<\[])(\\*)(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS role_chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN goes_on THEN 8 ELSE 24 + role_chars END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""

NEIGHBOURS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20"""

_NODES = """
{name}(k, t, pos, n, hash) AS (
  SELECT 0, t, pos, n, hash FROM {leaves}
  UNION ALL
  SELECT k + 1, t, pos // 8, any_value((n + 7) // 8), sha256(string_agg(hash, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY k, t, pos // 8),
{name}_runs AS (
  SELECT k, t, pos // 8 AS run, string_agg(hash, '' ORDER BY pos) AS hashes FROM {name} WHERE n > 1 GROUP BY ALL)"""
_FOLD = """
{name}(k, t, pos, n, r, kept, hash, siblings) AS (
  SELECT 0, t, pos, n, r, kept, hash, siblings FROM {leaves}
  UNION ALL
  SELECT f.k + 1, f.t, f.pos // 8, (f.n + 7) // 8, f.r, f.kept,
    sha256(substr(hashes, 1, 64 * (f.pos % 8)) || f.hash || substr(hashes, 64 * (f.pos % 8) + 65)),
    f.siblings || substr(hashes, 1, 64 * (f.pos % 8)) || substr(hashes, 64 * (f.pos % 8) + 65)
  FROM {name} AS f JOIN {runs} AS u ON u.k = f.k AND u.t = f.t AND u.run = f.pos // 8 WHERE f.n > 1)"""


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def merkle() -> str:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = """xor(list_reduce(
      list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
    return f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, {_leaf("text")} AS hash
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, hash, r) - 1 AS pos,
    count(*) OVER (PARTITION BY t) AS n,
    CASE WHEN coalesce({crc} % 3 = 0, false)
      THEN {_leaf(f"translate(text, '{capitals}', '{capitals.lower()}')")} ELSE hash END AS given
  FROM d),
{_NODES.format(name="nodes", leaves="leaves")},
tops AS (
  SELECT 0 AS t, t AS pos, count(*) OVER () AS n, hash FROM nodes WHERE n = 1),
{_NODES.format(name="whole", leaves="tops")},
starts AS (
  SELECT t, pos, n, r, true AS kept, hash, '' AS siblings FROM leaves
  UNION ALL SELECT t, pos, n, r, false, given, '' FROM leaves),
{_FOLD.format(name="up", leaves="starts", runs="nodes_runs")},
between AS (
  SELECT 0 AS t, up.t AS pos, (SELECT count(*) FROM tops) AS n, r, kept, hash, siblings FROM up WHERE up.n = 1),
{_FOLD.format(name="above", leaves="between", runs="whole_runs")}
SELECT l.doc_id, l.hash AS leaf, s.hash AS subroot, w.hash AS root, sha256(a.siblings) AS proof_sha256,
  b.hash AS folded_root, b.hash = w.hash AS verified
FROM leaves AS l JOIN between AS s ON s.r = l.r AND s.kept
JOIN above AS a ON a.r = l.r AND a.kept AND a.n = 1 JOIN above AS b ON b.r = l.r AND NOT b.kept AND b.n = 1
JOIN whole AS w ON w.n = 1"""


ORACLE = {
    "op2_block_matrix_join": NEIGHBOURS,
    "op3_divergence_rules": rules(),
    "op5_chat_format": CHAT,
    "op12_merkle_manifest": merkle(),
}
