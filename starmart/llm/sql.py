"""DuckDB SQL for the queries of this package that SQL can express, over whole tables.

The others have a part SQL cannot state (a trained model, a tokenizer's merges, rolling
hashes, spans with scores); ``tests/llm`` holds them against brute-force versions.
"""

from __future__ import annotations

from starmart.llm import raking, replytree, resample, variants

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


#: Rounds of the statement: enough to be within the operator's tolerance on the given tables.
_ROUNDS = 40


def _rounds() -> tuple[str, str]:
    """The raking rounds, one table of cell weights a factor."""
    out, last = [], "w0"
    n = 0
    for _ in range(_ROUNDS):
        for m in raking.MARGINS:
            n += 1
            out.append(f"""f{n} AS MATERIALIZED (SELECT mix_{m}, sum(t * w) AS n FROM {last} GROUP BY 1),
w{n} AS MATERIALIZED (SELECT c.mix_source, c.mix_lang, c.mix_topic, c.t,
  CASE WHEN f.n > 0 THEN c.w * g.goal / f.n ELSE 0 END AS w
  FROM {last} c JOIN f{n} f USING (mix_{m}) JOIN goal_{m} g USING (mix_{m}))""")
            last = f"w{n}"
    return ",\n".join(out), last


def _raking_sql() -> str:
    rounds, last = _rounds()
    goals = ",\n".join(
        f"""goal_{m} AS MATERIALIZED (
  SELECT mix_{m}, (SELECT sum(t) FROM cells) * raw / sum(raw) OVER () AS goal FROM (
    SELECT mix_{m}, CASE WHEN sum(t) > 0 THEN power(sum(t)::DOUBLE / (SELECT sum(t) FROM cells), {raking.TARGETS[m]}) ELSE 0 END AS raw
    FROM cells GROUP BY 1))""" for m in raking.MARGINS)
    return rf"""
WITH counted AS MATERIALIZED (
  SELECT *, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS mix_tokens FROM documents),
named AS MATERIALIZED (
  SELECT doc_id, text, mix_tokens, coalesce(source, '(none)') AS mix_source, coalesce(lang, '(none)') AS mix_lang,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures'
         WHEN mix_tokens < 100 THEN 'note' ELSE 'prose' END AS mix_topic
  FROM counted),
cells AS MATERIALIZED (SELECT mix_source, mix_lang, mix_topic, sum(mix_tokens)::BIGINT AS t FROM named GROUP BY 1, 2, 3),
{goals},
w0 AS MATERIALIZED (SELECT *, 1.0::DOUBLE AS w FROM cells),
{rounds},
ranked AS MATERIALIZED (
  SELECT *, (SELECT sum(t) FROM cells) * {raking.BUDGET} - coalesce(sum(t) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
    sum(t * w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    row_number() OVER o AS k
  FROM {last} WHERE w > 0 WINDOW o AS (ORDER BY w DESC, mix_source, mix_lang, mix_topic)),
rate AS MATERIALIZED (
  SELECT left_ / rest AS c FROM ranked WHERE rest > 0 AND left_ / rest * w <= 1 ORDER BY k LIMIT 1),
shares AS MATERIALIZED (
  SELECT mix_source, mix_lang, mix_topic, w, least(1.0, c * w) AS p, c FROM {last}, rate)
SELECT d.doc_id, d.mix_source, d.mix_lang, d.mix_topic, d.mix_tokens, s.w AS token_weight, s.p AS probability,
  CASE WHEN s.p > 0 THEN s.c * s.w / s.p ELSE 0 END AS sample_weight,
  ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, '')))), 1, 12))::BIGINT / 16.0**12 < s.p AS sampled
FROM named d JOIN shares s USING (mix_source, mix_lang, mix_topic)
"""


OP7 = """
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, a.vec_id AS ida, b.vec_id AS idb FROM usable a JOIN usable b
  ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.ida, r.other FROM links l JOIN reach r ON r.id = l.idb),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
counts AS (SELECT ida, count(*) AS n FROM links GROUP BY ida)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n ON n.id = e.vec_id LEFT JOIN counts c ON c.ida = e.vec_id
"""

OP8 = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
t AS MATERIALIZED (SELECT doc_id, unnest(s) AS sh FROM s),
common AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM t a JOIN t b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT c.a, c.b FROM common c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (len(x.s) + len(y.s) - c.n)),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.other FROM links l JOIN reach r ON r.id = l.b),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, n.component_id FROM s JOIN named n ON n.id = s.doc_id
"""

# crc32 by its table, which is made from the polynomial
_CRC_TABLE = """tab AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(
  list_prepend(b::UBIGINT, list_transform(range(8), lambda x: 0::UBIGINT)),
  lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, strlen({text})::BIGINT),
  lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT)),
  lambda a, b: xor(a >> 8, tab.t[(xor(a, b) % 256 + 1)::INT])), 4294967295::UBIGINT)::BIGINT"""


_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP11 = rf"""
WITH {_CRC_TABLE},
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
q AS MATERIALIZED (SELECT unnest(regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS w FROM benchmark),
u AS MATERIALIZED (SELECT r, unnest(w) AS w FROM d),
k AS MATERIALIZED (SELECT w, {_crc("w")} % {resample.BUCKETS} AS b FROM (SELECT w FROM u UNION SELECT w FROM q), tab),
sums AS MATERIALIZED (
  SELECT b, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT b, count(*) AS s FROM u JOIN k USING (w) GROUP BY b)
  FULL JOIN (SELECT b, count(*) AS t FROM q JOIN k USING (w) GROUP BY b) USING (b)),
total AS MATERIALIZED (SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM sums),
gains AS MATERIALIZED (
  SELECT b, floor(1000 * ln((x.t + 1) * (y.s + {resample.BUCKETS}) / ((x.s + 1) * (y.t + {resample.BUCKETS}))))::BIGINT AS g FROM sums x, total y),
weights AS MATERIALIZED (SELECT r, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM u JOIN k USING (w) JOIN gains USING (b) GROUP BY r),
scored AS MATERIALIZED (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, d.r,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resample.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r))
SELECT doc_id, n_features, weight, score,
  CASE WHEN row_number() OVER o <= (SELECT count(*) FROM scored WHERE n_features >= {resample.LEAST_WORDS}) * {resample.PERCENT} // 100
    THEN row_number() OVER o END::BIGINT AS rank
FROM scored WINDOW o AS (ORDER BY n_features < {resample.LEAST_WORDS}, score DESC, doc_id NULLS LAST, r)
"""


def _escaped(text: str) -> str:
    """Code points of a text once its backslashes are doubled and its control strings broken."""
    control = "|".join(replytree.CONTROL).replace("'", "''")
    return rf"(length({text}) + length({text}) - length(replace({text}, '\', '')) + len(regexp_extract_all({text}, '{control}')))"


OP12 = rf"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(i))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(replytree.BEGIN + replytree.BODY + replytree.END)} + {_escaped("role")} + {_escaped("text")})::BIGINT AS formatted_chars
FROM m WHERE conv_id IS NOT NULL GROUP BY conv_id
"""

OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS MATERIALIZED (
  SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  GROUP BY doc_id, w),
hashed AS MATERIALIZED (SELECT w, c, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM runs, tab),
cut AS MATERIALIZED (
  SELECT c, CASE WHEN h % {variants.DROP_EVERY} = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w FROM hashed),
words AS MATERIALIZED (
  SELECT w, sum(c)::BIGINT AS n FROM cut WHERE length(w) >= {variants.LEAST_CHARS} GROUP BY w HAVING sum(c) >= {variants.LEAST_COUNT}),
less AS MATERIALIZED (SELECT w, n, length(w) AS l, i, left(w, i - 1) || substr(w, i + 1) AS x FROM (SELECT w, n, unnest(range(1, length(w) + 1))::INT AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (
    SELECT x.w AS a, y.w AS b FROM less x JOIN less y ON x.x = y.x AND x.i = y.i AND x.l = y.l AND x.w <> y.w
    UNION ALL SELECT x.w, y.w FROM less x JOIN words y ON x.x = y.w
    UNION ALL SELECT y.w, x.w FROM less x JOIN words y ON x.x = y.w)),
best AS MATERIALIZED (SELECT a, count(*) AS n_near, max(y.n) AS best_n, arg_min(b, (-y.n, b)) AS best FROM near JOIN words y ON y.w = b GROUP BY a),
forms AS MATERIALIZED (
  SELECT w, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= {variants.RATIO} * n THEN best END AS form,
    CASE WHEN best_n >= {variants.RATIO} * n THEN best_n END AS form_n FROM words LEFT JOIN best ON a = w),
walk(w, last) AS (SELECT w, w FROM forms UNION ALL SELECT walk.w, f.form FROM walk JOIN forms f ON f.w = walk.last WHERE f.form IS NOT NULL),
roots AS MATERIALIZED (SELECT walk.w, walk.last AS root FROM walk JOIN forms f ON f.w = walk.last WHERE f.form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN roots USING (w)
"""

LLM_SQL: dict[str, str] = {"op11_resample": OP11, "op12_replytree": OP12, "op13_variants": OP13, "op1_raking": _raking_sql(), "op7_int8": OP7, "op8_jaccard": OP8}
