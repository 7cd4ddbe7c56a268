"""The subpackage's queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import ann, chat, decontam, funnel, lm, mixing, neardup, repeats, sharding, tokenstore, toxicity, urls, whiten
from tapeworks.llm.common import table


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.read_store(spark, tokenstore.write_store(table(spark, sf_dir, "documents")))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.read_chats(chat.format_chats(rows.unionByName(more))))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11_funnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnels(table(spark, sf_dir, "clicks"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_store, op2_mix_sources, op3_shard, op4_simhash, op5_chat_format, op6_nearest, op7_url_filter, op8_toxicity, op9_decontaminate, op10_lm_score, op11_funnels,
            op12_whiten, op13_repeats,
        )  # fmt: skip
    }


OP2_SQL = """
WITH n AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY doc_id, source, text) AS copy FROM documents),
d AS (
  SELECT doc_id, source, copy, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || coalesce(source, '~') || '|' || copy), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM n),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
i AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest FROM i),
f AS (SELECT *, cap * w_rest <= w * rest AS is_full FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full OR level IS NULL THEN cap ELSE w * level END AS target
      FROM f CROSS JOIN (SELECT arg_min(rest / w_rest, cap / w) FILTER (NOT is_full) AS level FROM f)),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
c AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / (1 + least(d.size, 1000) / 1000.0::DOUBLE), d.doc_id, d.copy ROWS UNBOUNDED PRECEDING) AS reach
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN budget > 0 AND reach - size / 2.0::DOUBLE <= budget THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
"""

OP5_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, role AS said_by, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, len(regexp_extract_all(role || chr(10) || text, '\\|<\|turn\|>|<\|said\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS escapes,
             row_number() OVER w - 1 AS i, CASE WHEN first_value(said_by) OVER w = 'system' THEN 1 ELSE 0 END AS off
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
o AS (SELECT *, CASE WHEN i < off THEN 'system' WHEN (i - off) % 2 = 0 THEN 'user' ELSE 'assistant' END AS due FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + escapes + 24) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role <> due) = 0 AS valid, CAST(min(i) FILTER (role <> due) AS INTEGER) AS broken_at
FROM o GROUP BY conv_id
"""

OP7_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS bare FROM pages),
p AS (SELECT page_id, translate(regexp_extract(bare, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(bare, length(regexp_extract(bare, '^[^/]*')) + 1) AS path FROM u),
j AS (SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""

OP9_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT item, w, least(len(w), 13) AS n FROM iw WHERE len(w) > 0 AND item IS NOT NULL),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM il)),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, (SELECT DISTINCT n FROM il) WHERE len(w) >= n)),
hit AS (SELECT doc_id, dg.n, i, item FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN names ON dw.doc_id = names.doc_id
"""


def _attempts(name: str, steps: tuple[str, ...], excluding: str) -> str:
    """One funnel over ``r`` (client_id, kind, t): as-of joins over the whole table, without ranges."""
    said = [f"{name}1 AS (SELECT client_id, t AS t1, t, 0::BIGINT AS dt FROM r WHERE kind = '{steps[0]}')"]
    for i, kind in enumerate(steps[1:], 2):
        said.append(f"""{name}{i} AS (SELECT p.client_id, p.t1, n.t, n.t - p.t AS dt FROM {name}{i - 1} p
  ASOF JOIN (SELECT * FROM r WHERE kind = '{kind}') n ON p.client_id = n.client_id AND p.t < n.t
  ASOF LEFT JOIN (SELECT * FROM r WHERE kind = '{excluding}') x ON p.client_id = x.client_id AND p.t < x.t
  WHERE n.t - p.t1 <= 300000000 AND (x.t IS NULL OR x.t > n.t))""")
    return ", ".join(said)


_FUNNELS = (("A", ("view", "click", "view", "purchase"), "error"), ("B", ("signup", "view", "click", "purchase"), "error"), ("C", ("click", "click", "purchase", "view"), "signup"))
OP11_SQL = f"""
WITH r AS (SELECT DISTINCT client_id, kind, epoch_us(arrived_at) AS t FROM clicks WHERE client_id IS NOT NULL AND kind IS NOT NULL AND arrived_at IS NOT NULL),
{", ".join(_attempts(*f) for f in _FUNNELS)},
a AS ({" UNION ALL ".join(f"SELECT '{f}' AS funnel, client_id, {i} AS step, dt FROM {f}{i}" for f in "ABC" for i in range(1, 5))}),
k AS (SELECT *, count(*) OVER (PARTITION BY funnel, client_id, step) AS n, row_number() OVER (PARTITION BY funnel, client_id, step ORDER BY dt) AS place FROM a),
c AS (SELECT funnel, client_id, {", ".join(f"count(*) FILTER (step = {i}) AS n{i}" for i in range(1, 5))}, max(step) AS deepest,
      {", ".join(f"max(dt) FILTER (step = {i} AND place = (25 * n + 99) // 100) AS t{i}" for i in range(2, 5))} FROM k GROUP BY funnel, client_id)
SELECT *, count(*) OVER (PARTITION BY funnel, deepest) AS same_depth FROM c
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
win AS (SELECT r, k, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT r, k, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
lo AS (SELECT g, min(k) AS k FROM win GROUP BY g HAVING min(k) < max(k)),
hit AS (SELECT r, i FROM win JOIN lo ON win.g = lo.g WHERE win.k > lo.k),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS p FROM hit),
one AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
kept AS (SELECT one.r, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY one.p) FILTER (gone.p IS NULL) AS said
         FROM one LEFT JOIN gone ON one.r = gone.r AND one.p = gone.p GROUP BY one.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.r = kept.r
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mix_sources": OP2_SQL, "op5_chat_format": OP5_SQL, "op7_url_filter": OP7_SQL, "op9_decontaminate": OP9_SQL, "op11_funnels": OP11_SQL, "op13_repeats": OP13_SQL}
