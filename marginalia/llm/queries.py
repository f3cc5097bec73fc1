"""The package's registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.llm import (chat_format, collocations, conversation_repair, decontamination, embedding_dedup, language_id, packing, quality,
                            simhash_dedup, suffix_dedup, token_counts, toxicity, url_filter)
from marginalia.llm.common import crc_part, ship_package, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f):
    def run(spark, sf_dir):
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def _labels(spark, sf_dir, column):
    return table(spark, sf_dir, "labels").select("doc_id", F.col(column).alias("label"))


@_query
def op1_token_counts(spark, sf_dir):
    return token_counts.length_histogram(token_counts.token_lengths(table(spark, sf_dir, "documents")))


@_query
def op2_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.98)


@_query
def op3_simhash_near_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=3)


@_query
def op4_toxicity(spark, sf_dir):
    out = toxicity.classify(table(spark, sf_dir, "documents"), _labels(spark, sf_dir, "toxic"), crc_part("doc_id", 3) != 1, threshold=0.7)
    return out.select("doc_id", (crc_part("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@_query
def op5_decontamination(spark, sf_dir):
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13, min_share=0.05)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@_query
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(docs.where(crc_part("doc_id", 4) != 2))
    out = language_id.identify(docs, profiles)
    return out.select("doc_id", (crc_part("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@_query
def op7_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.col("text").alias("text"))
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("\\### Assistant: </turn> ok").alias("text"))
    turns = turns.union(extra).withColumn("parts", chat_format.text_part(F.col("text")))
    out = chat_format.format_chats(turns)
    read, loss = chat_format.read_turns(F.col("formatted")), chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256)
    return out.select("conv_id", read.alias("turns"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"), "expanded_tokens").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


@_query
def op8_quality(spark, sf_dir):
    out = quality.classify(table(spark, sf_dir, "documents"), _labels(spark, sf_dir, "quality"), crc_part("doc_id", 5) != 0, threshold=0.3)
    return out.select("doc_id", (crc_part("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@_query
def op9_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op10_packing(spark, sf_dir):
    out = packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=0)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@_query
def op12_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


@_query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000)


ORACLE_SQL["op2_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a AS vec_id, b AS other FROM link
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT vec_id, min(other) AS m FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(comp.m, v.vec_id)) AS component_id,
  v.vec_id <= coalesce(comp.m, v.vec_id) AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN comp USING (vec_id)
"""

_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL["op5_decontamination"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 12) AS s, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win ON p.s = win.s AND p.n = win.n),
words_hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op7_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length('<turn>') + length(role) + 1 + length(text) + length('</turn>') + 1
    + len(regexp_extract_all(text, '[<\\]')) + len(regexp_extract_all(role, '[<\\\n]')) AS chars FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  chars::BIGINT AS formatted_chars FROM c
"""

_LIVE = r"'[^\x20\x09-\x0D]'"

ORACLE_SQL["op11_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (  -- the checksum's table of bytes
  SELECT list_transform(range(256), lambda x: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT raw.*, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT),
    lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM raw, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM kinds, (VALUES (1), (2)) AS c(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    lead(role[1]) OVER w AS next_initial
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
row_faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, {_LIVE}) THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN regexp_extract_all(text, {_LIVE})[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
s AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra, role[1] AS initial FROM row_faults),
-- the cheapest way to each of four states, as eight digits of cost and the edits, so that least() gives the least cost and then the least text
way AS (
  SELECT conv_id, 0::BIGINT AS i, '00000000' AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS c, NULL::VARCHAR AS d
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i,
    lpad((a[:8]::INT + 3)::VARCHAR, 8, '0') || a[9:] || 'D',
    least(lpad((b[:8]::INT + 3)::VARCHAR, 8, '0') || b[9:] || 'D',
      CASE WHEN NOT gone AND initial = 's' THEN lpad((a[:8]::INT + extra)::VARCHAR, 8, '0') || a[9:] || 'K' END),
    least(lpad((c[:8]::INT + 3)::VARCHAR, 8, '0') || c[9:] || 'D',
      CASE WHEN NOT gone THEN lpad((u[:8]::INT + extra + CASE WHEN initial = 'u' THEN 0 ELSE 2 END)::VARCHAR, 8, '0') || u[9:] || CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END END),
    least(lpad((d[:8]::INT + 3)::VARCHAR, 8, '0') || d[9:] || 'D',
      CASE WHEN NOT gone THEN lpad((c[:8]::INT + extra + CASE WHEN initial = 'a' THEN 0 ELSE 2 END)::VARCHAR, 8, '0') || c[9:] || CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END END)
  FROM (
    SELECT conv_id, i, gone, extra, initial, a, b, c, d, least(a, b, d) AS u FROM (
      SELECT w.conv_id, s.i, s.gone, s.extra, s.initial, a, b,
        least(c, lpad((least(a, b, d)[:8]::INT + 2)::VARCHAR, 8, '0') || least(a, b, d)[9:] || 'I') AS c,
        least(d, lpad((c[:8]::INT + 2)::VARCHAR, 8, '0') || c[9:] || 'I', lpad((least(a, b)[:8]::INT + 4)::VARCHAR, 8, '0') || least(a, b)[9:] || 'II') AS d
      FROM way w JOIN s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1))),
ended AS (
  SELECT conv_id, least(a, d, lpad((b[:8]::INT + 4)::VARCHAR, 8, '0') || b[9:] || 'II', lpad((c[:8]::INT + 2)::VARCHAR, 8, '0') || c[9:] || 'I') AS best
  FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (
  SELECT conv_id, k, best[8 + k] AS e, k - length(regexp_replace(best[9 : 8 + k], '[^I]', '', 'g')) AS i FROM (SELECT conv_id, best, unnest(range(1, length(best) - 7)) AS k FROM ended)),
lines AS (
  SELECT e.conv_id, k, e, role, CASE WHEN e = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY k) AS place,
    coalesce(first_value(e = 'K' AND initial = 's') OVER (PARTITION BY e.conv_id ORDER BY k), false) AS led
  FROM edits e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND s.i = e.i WHERE e <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS told
  FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal FROM s GROUP BY conv_id)
SELECT ended.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best[:8]::BIGINT AS cost, best[9:] AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM ended LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ended.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM ended.conv_id
"""

ORACLE_SQL["op12_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(h, p, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM u LEFT JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
GROUP BY n, page_id, host, path
"""

ORACLE_SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL)),
words AS (SELECT lang, id, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS p, count(*) AS f FROM words, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, f AS a FROM grams WHERE k > 1 AND f >= 10),
inner_max AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, list_slice(p, 1, 2) AS p, a FROM cand WHERE k = 3 UNION ALL SELECT lang, list_slice(p, 2, 3), a FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_max m ON m.lang = c.lang AND m.p = c.p WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT kept.lang, kept.p, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) kept
  JOIN grams x ON x.lang = kept.lang AND x.k = cut AND x.p = list_slice(kept.p, 1, cut)
  JOIN grams y ON y.lang = kept.lang AND y.k = kept.k - cut AND y.p = list_slice(kept.p, cut + 1, kept.k)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
FROM ranked JOIN total USING (lang) QUALIFY rank <= 2000
"""
