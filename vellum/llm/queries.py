"""The operators applied to their whole tables, and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vellum.llm import bpe, chat, decontaminate, jaccard, language, lm, quality, ranked, repair, repeats, secrets, shards, topk
from vellum.llm.common import Query, sql_text, table

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if check:
            CHECKS[fn.__name__] = check
        return fn

    return wrap


# --- 1: secrets ------------------------------------------------------------------------------


def _secrets_sql() -> str:
    """Offsets from the pieces between the matches, per rule."""
    parts, lists = [], []
    for n, r in enumerate(secrets.RULES):
        p = sql_text(r.pattern)
        parts.append(
            f"regexp_extract_all(t, {p}) AS m{n}, regexp_extract_all(t, {p}, {r.group}) AS g{n},"
            f" string_split_regex(t, {p}) AS p{n}"
        )
        lists.append(
            f"list_filter(list_transform(range(1, len(m{n}) + 1), lambda i: {{"
            f"'s': list_sum(list_transform(p{n}[1:i], lambda x: length(x)))"
            f" + coalesce(list_sum(list_transform(m{n}[1:i-1], lambda x: length(x))), 0),"
            f"'o': {n}, 'e': list_sum(list_transform(p{n}[1:i], lambda x: length(x)))"
            f" + list_sum(list_transform(m{n}[1:i], lambda x: length(x))),"
            f"'k': '{r.kind}', 'g': length(g{n}[i])}}), lambda x: x.g >= {r.least})"
        )
    text = "array_to_string(list_transform({0}, lambda x: x.k || ':' || x.s::BIGINT || ':' || x.e::BIGINT), ',')"
    base = [r for r in secrets.RULES if r.base]
    kinds = ", ".join(f"'{r.kind}'" for r in base)
    return f"""
WITH m AS (SELECT doc_id, {", ".join(parts)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
s AS (SELECT doc_id, list_sort(flatten([{", ".join(lists)}])) AS a FROM m)
SELECT doc_id, {", ".join(f"len(list_filter(a, lambda x: x.k = '{r.kind}'))::BIGINT AS n_{r.kind}" for r in base)},
sha256(coalesce({text.format(f"list_filter(a, lambda x: x.k IN ({kinds}))")}, '')) AS base_sha256,
coalesce({text.format("a")}, '') AS spans FROM s"""


@query(_secrets_sql())
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


# --- 2: chat ---------------------------------------------------------------------------------

CONTROL = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    esc = (
        "regexp_replace(regexp_replace({0}, '(<)(\\\\*)(/?s>)', '\\1\\\\\\2\\3', 'g'),"
        " '(\\[)(\\\\*)(/?INST\\]|/?ROLE\\]|SAYS\\])', '\\1\\\\\\2\\3', 'g')"
    )
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'),
c AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(length({esc.format("text")}) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6
    ELSE 22 + length({esc.format("role")}) END) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM c"""


@query(_chat_sql())
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    message = F.struct(F.lit("user").alias("role"), F.lit(CONTROL).alias("content"))
    answer = F.struct(F.lit("assistant").alias("role"), F.lit(CONTROL).alias("content"))
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(message, answer).alias("messages"))
    records = chat.as_records(rows).unionByName(chat.as_records(extra))
    return chat.digest(chat.read_back(chat.formatted(chat.to_turns(records))))


# --- 6: benchmark ----------------------------------------------------------------------------


def _benchmark_sql() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = sql_text(decontaminate.WORD)
    n = decontaminate.SIZE
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({low}, {word}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({low}, {word}) AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), {n}) AS size,
  unnest(list_transform(range(1, greatest(len(w) - {n}, 0) + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))) AS gram
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM g),
placed AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, sizes WHERE len(w) >= size),
hit AS (SELECT doc_id, i, p.size, item_id FROM placed p JOIN g ON g.size = p.size AND array_to_string(w[i:i + p.size - 1], ' ') = gram),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query(_benchmark_sql())
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, items))


# --- 4: quality ------------------------------------------------------------------------------


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.digest(quality.score(docs, model))


# --- 8: byte-level BPE -----------------------------------------------------------------------


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.digest(bpe.decode(encoded, path))


# --- 3: top-k --------------------------------------------------------------------------------

_TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""


@query(_TOPK_SQL)
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


# --- 5: near-duplicate classes ---------------------------------------------------------------


@query()
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


# --- 9: language model -----------------------------------------------------------------------


@query()
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


# --- 7: repeats ------------------------------------------------------------------------------


@query()
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove(table(spark, sf_dir, "documents")))


# --- 10: shards ------------------------------------------------------------------------------

_SHARDS_SQL = f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, {shards.BITS // 4}))::BIGINT AS h FROM documents),
up AS (SELECT doc_id, n_bytes, d.h, depth, d.h >> ({shards.BITS} - depth)::INTEGER AS prefix FROM d, range(0, 31) r(depth)),
fits AS (SELECT depth, prefix FROM up GROUP BY ALL HAVING sum(n_bytes) <= {shards.LIMIT}),
own AS (SELECT doc_id, n_bytes, h, min(depth) AS depth FROM up JOIN fits USING (depth, prefix) GROUP BY ALL)
SELECT doc_id, n_bytes, depth::INTEGER AS depth,
substr(lpad(bin(h), {shards.BITS}, '0'), 1, depth::INTEGER) AS shard FROM own"""


@query(_SHARDS_SQL)
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "depth", "shard")


# --- 11: language ----------------------------------------------------------------------------


@query()
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


# --- 12: ranked search -----------------------------------------------------------------------


def _ranked_sql() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = sql_text(ranked.WORD)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({low}, {word}) AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({low}, {word})) AS term FROM benchmark),
size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM p, size GROUP BY term, docs),
x AS (SELECT r, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(w) * docs) // words))) AS x
  FROM p JOIN t USING (term) JOIN d USING (r), size),
s AS (SELECT item_id, r, sum(x)::BIGINT AS score FROM q JOIN x USING (term) GROUP BY ALL HAVING sum(x) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM s JOIN d USING (r)) WHERE rank <= {ranked.K}"""


@query(_ranked_sql())
def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- 13: conversation repair -----------------------------------------------------------------


def _repair_sql() -> str:
    """The states 0 to 3 (start, s, u, a) with the best (cost, audit) each, row by row."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),"
        " lambda h, b: list_reduce(list_prepend(xor(h, b), [0::BIGINT,0,0,0,0,0,0,0]),"
        " lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"
    )
    space = repair.SPACE
    moves = (
        "(SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) v(s, t, r))"
    )
    opened = f"""(SELECT s, s AS t, 0 AS k, []::VARCHAR[] AS o FROM {moves}
      UNION ALL SELECT s, t, 1, [r || ':'] FROM {moves}
      UNION ALL SELECT a.s, b.t, 2, [a.r || ':', b.r || ':'] FROM {moves} a JOIN {moves} b ON b.s = a.t)"""
    return f"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT *, {crc} % 20 AS kind FROM raw),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
flags AS (SELECT *, NOT regexp_matches(text, '[^{space}]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][{space}]*$') AS cut, substr(role, 1, 1) AS f,
  lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS e FROM placed),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
  count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
  count(*) FILTER (e IS NOT NULL AND e || f NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM flags GROUP BY conv_id),
best AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS o FROM counted
  UNION ALL
  SELECT conv_id, i, s, cost, audit, o FROM (
    SELECT b.conv_id, r.i, x.s, b.cost + 3 * p.k + x.cost AS cost, b.audit || repeat('I', p.k::BIGINT) || x.a AS audit,
      b.o || p.o || x.o AS o,
      row_number() OVER (PARTITION BY b.conv_id, x.s ORDER BY b.cost + 3 * p.k + x.cost, b.audit || repeat('I', p.k::BIGINT) || x.a) AS z
    FROM best b JOIN flags r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN {opened} p ON p.s = b.s,
    LATERAL (SELECT unnest([{{'s': p.t, 'cost': 4, 'a': 'D', 'o': []::VARCHAR[]}},
      {{'s': CASE p.t WHEN 2 THEN 3 ELSE 2 END, 'cost': CASE WHEN r.cut THEN 6 ELSE 3 END, 'a': 'R',
        'o': [CASE p.t WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text]}},
      {{'s': CASE r.f WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'cost': CASE WHEN r.cut THEN 3 ELSE 0 END, 'a': 'K',
        'o': [r.role || ':' || r.text]}}], recursive := true)) x
    WHERE x.a = 'D' OR NOT (r.blank OR r.again) AND (x.a = 'R' OR (r.f = 's' AND p.t = 0)
      OR (r.f = 'u' AND p.t <> 2) OR (r.f = 'a' AND p.t = 2))) WHERE z = 1),
done AS (SELECT b.conv_id, b.cost + 3 * p.k AS cost, b.audit || repeat('I', p.k::BIGINT) AS audit, b.o || p.o AS o
  FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i JOIN {opened} p ON p.s = b.s WHERE p.t IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 3 * p.k, b.audit || repeat('I', p.k::BIGINT)) = 1),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(o, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM ids.conv_id"""


@query(_repair_sql())
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digest(rows, repair.Repair(repair.damage(rows)))


# --- the pipeline ----------------------------------------------------------------------------


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL
