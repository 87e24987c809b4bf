"""The operators bound to the given tables with production parameters, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import REGISTRY, documents, query
from .convrepair import repair_damaged
from .jaccard import ngram_jaccard_join
from .langmix import identify_languages
from .licence_texts import standard_templates
from .licences import TERM, WINDOWS, scan_licences
from .linetemplates import drop_recurring_lines
from .mixing import mix_sources
from .sharding import place
from .simhash import simhash_components
from .tiling import contaminated
from .tokenfile import read_documents, token_folder, write_tokens
from .toxicity import toxicity
from .vptree import nearest
from .whitening import whiten

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHINGLES_CTE = rf"""
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM docs),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
         WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
cn AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
many AS (SELECT g FROM sh GROUP BY g HAVING count(*) > 1),
shm AS (SELECT doc_id, g FROM sh JOIN many USING (g)),
links AS (SELECT a.doc_id AS x, b.doc_id AS y
  FROM shm a JOIN shm b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN cn ca ON ca.doc_id = a.doc_id JOIN cn cb ON cb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, ca.n, cb.n
  HAVING 100 * count(*) >= 80 * (ca.n + cb.n - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)"""

OP2_SQL = f"""WITH RECURSIVE docs AS (SELECT doc_id, text FROM documents), {SHINGLES_CTE}
SELECT d.doc_id, coalesce(cn.n, 0) AS n_shingles, least(d.doc_id, min(r.y)) AS component_id
FROM docs d LEFT JOIN cn USING (doc_id) LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, cn.n"""


@query("op2_ngram_jaccard", OP2_SQL)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


SHARDS = [f"shard-{i:02d}" for i in range(16)]
TABLE_SIZE = 4099

_H = "CAST(CAST(('0x' || substr(md5({0}), 1, 8)) AS UBIGINT) AS BIGINT)"
OP4_SQL = f"""WITH RECURSIVE
s AS (SELECT i, {_H.format("'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') || ':offset'")} % {TABLE_SIZE} AS o,
             {_H.format("'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') || ':skip'")} % {TABLE_SIZE - 1} + 1 AS k
      FROM range({len(SHARDS)}) t(i)),
pref AS (SELECT i, list((o + j * k) % {TABLE_SIZE} ORDER BY j) AS p FROM s, range({TABLE_SIZE}) u(j) GROUP BY i),
fill(turn, slot, free) AS (
  SELECT 0, CAST(-1 AS BIGINT), list_transform(range({TABLE_SIZE}), lambda x: true)
  UNION ALL
  SELECT turn + 1, c, list_transform(free, lambda v, ix: v AND ix <> c + 1)
  FROM (SELECT turn, free, list_filter(p, lambda q: free[q + 1])[1] AS c
        FROM fill JOIN pref ON pref.i = turn % {len(SHARDS)} WHERE turn < {TABLE_SIZE})),
owner AS (SELECT slot, CAST((turn - 1) % {len(SHARDS)} AS INTEGER) AS shard FROM fill WHERE slot >= 0)
SELECT d.doc_id, CAST(slot AS INTEGER) AS slot, shard
FROM documents d JOIN owner ON {_H.format("coalesce(CAST(d.doc_id AS VARCHAR), '')")} % {TABLE_SIZE} = slot"""


@query("op4_sharding", OP4_SQL)
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(documents(spark, sf_dir).select("doc_id"), SHARDS, TABLE_SIZE)


OP5_SQL = r"""WITH r AS (SELECT doc_id, source,
  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS key FROM documents),
t0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
t1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no FROM t0),
t2 AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
  2.0::DOUBLE * source_size AS cap FROM t1),
t3 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - (sum(cap) OVER (ORDER BY cap / w, no) - cap)) / (sum(w) OVER () - sum(w) OVER (ORDER BY cap / w, no) + w) AS level,
  row_number() OVER (ORDER BY cap / w, no) AS pos FROM t2),
t4 AS (SELECT *, (SELECT level FROM t3 WHERE cap / w >= level ORDER BY pos LIMIT 1) AS lam FROM t3),
t AS (SELECT source, source_size, coalesce(least(cap, w * lam), cap) AS target FROM t4),
p AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS whole,
  CAST(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT)
    - size AS before
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN whole // source_size ELSE 0 END AS copies FROM p)
SELECT doc_id, size, source_size, target,
  copies * size + greatest(0, least(size, whole - copies * source_size - before)) AS taken FROM q"""


@query("op5_mixing", OP5_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v) AS score
  FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM p)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 20"""


@query("op9_vantage_point_search", OP9_SQL)
def op9_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return nearest(e, e.where("vec_id % 20 = 0"), k=20, factor=1.0)


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).drop("spans")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).drop("terms")


@query("op1_language_mixture")
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


@query("op3_line_templates")
def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(documents(spark, sf_dir))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = token_folder(spark)
    parts = write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, folder, parts)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TPL = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(standard_templates()))
_SIZES = ", ".join(f"({size})" for size in WINDOWS)
_TERMS = f"regexp_extract_all(translate({{0}}, '{UPPER}', '{LOWER}'), '{TERM}')"
OP8_SQL = f"""WITH tpl(tpl, name, txt) AS (VALUES {_TPL}),
tt AS (SELECT tpl, name, term, count(*) AS tf FROM (SELECT tpl, name, unnest({_TERMS.format("txt")}) AS term FROM tpl) GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS text,
        source || '/' || CAST(doc_id // 1000 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path FROM documents),
n AS (SELECT count(*) AS n FROM d),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({_TERMS.format("text")}) AS term FROM d) GROUP BY term),
tw AS (SELECT tpl, name, term, tf * (ln((1 + n) / (1 + coalesce(df, 0))::DOUBLE) + 1) AS wt FROM tt CROSS JOIN n LEFT JOIN df USING (term)),
tn AS (SELECT tpl, sqrt(sum(wt * wt)) AS nt FROM tw GROUP BY tpl),
ls AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM d),
wi AS (SELECT doc_id, size, ls, unnest(range(1, len(ls) - size + 2)) AS line FROM ls, (VALUES {_SIZES}) s(size)),
piece AS (SELECT doc_id, size, line, unnest({_TERMS.format("array_to_string(ls[line:line + size - 1], chr(10))")}) AS term FROM wi
          UNION ALL SELECT doc_id, 0, 0, unnest({_TERMS.format("text")}) FROM d),
ptf AS (SELECT doc_id, size, line, term, count(*) AS tf FROM piece GROUP BY ALL),
pw AS (SELECT doc_id, size, line, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM ptf CROSS JOIN n JOIN df USING (term)),
pn AS (SELECT doc_id, size, line, sqrt(sum(w * w)) AS nl FROM pw GROUP BY ALL),
dot AS (SELECT doc_id, size, line, tpl, name, sum(w * wt) AS dot FROM pw JOIN tw USING (term) GROUP BY ALL),
cs AS (SELECT doc_id, size, name, round(dot / (nl * nt), 9) AS cos FROM dot JOIN pn USING (doc_id, size, line) JOIN tn USING (tpl)),
own AS (SELECT doc_id, name, cos AS score FROM cs WHERE cos >= 0.7
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cos DESC, name) = 1),
whole AS (SELECT DISTINCT doc_id, name FROM cs WHERE size = 0 AND cos >= 0.4),
files AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, name, score FROM own JOIN whole USING (doc_id, name) JOIN d USING (doc_id)
          WHERE path IS NOT NULL),
dirs AS (SELECT dir, name, score FROM files QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, name) = 1),
heir AS (SELECT d.doc_id, x.name, x.score FROM d JOIN dirs x ON starts_with(d.path, x.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY len(x.dir) DESC) = 1)
SELECT d.doc_id, d.path, coalesce(o.name, h.name) AS licence,
  CASE WHEN o.name IS NOT NULL THEN 'own' WHEN h.name IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  coalesce(o.score, h.score) AS score
FROM d LEFT JOIN own o USING (doc_id) LEFT JOIN heir h USING (doc_id)"""


@query("op8_licence_scan", OP8_SQL)
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files ``source/<thousand>/<doc_id>.txt``."""
    block = F.floor(F.col("doc_id") / 1000).cast("string")
    path = F.concat("source", F.lit("/"), block, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return scan_licences(documents(spark, sf_dir).select("doc_id", "text", path.alias("path")))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


# crc32 of the bytes of the (ASCII) key, by the reflected polynomial's table
OP12_SQL = r"""WITH RECURSIVE
byte(i) AS (SELECT range FROM range(256)),
bits(i, k, v) AS (SELECT i, 0, CAST(i AS BIGINT) FROM byte UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
          list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda a, b: xor(a // 256, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS code FROM c, tab),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE code <> 0),
o AS (SELECT *, row_number() OVER w AS i, left(role, 1) AS ini, lag(left(role, 1)) OVER w AS before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS (SELECT conv_id, turn, role, text, i, ini, before, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
st AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
delta(q, ch, q2) AS (VALUES ('0', 's', 'S'), ('0', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
ins(q, x, q2) AS (VALUES ('0', '', '0'), ('0', 'u', 'U'), ('0', 'ua', 'A'), ('S', '', 'S'), ('S', 'u', 'U'), ('S', 'ua', 'A'),
  ('U', '', 'U'), ('U', 'a', 'A'), ('A', '', 'A'), ('A', 'u', 'U')),
act AS (SELECT conv_id, i, 'D' AS e, p.q AS q, p.q AS q2, '-' AS ch, 3 AS cost FROM r, (SELECT DISTINCT q FROM ins) p
  UNION ALL SELECT conv_id, i, 'K', q, q2, ch, CAST(fault = 'truncated' AS INTEGER) FROM r JOIN delta ON ch = ini
    WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, 'R', q, q2, ch, 2 + CAST(fault = 'truncated' AS INTEGER) FROM r JOIN delta ON ch IN ('u', 'a')
    WHERE fault NOT IN ('blank', 'duplicate')),
step(conv_id, i, q, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '0', {'cost': CAST(0 AS BIGINT), 'audit': '', 'roles': ''} FROM st
  UNION ALL
  SELECT s.conv_id, s.i + 1, a.q2, min({'cost': s.best.cost + 2 * len(x) + a.cost,
      'audit': s.best.audit || repeat('I', len(x)) || a.e, 'roles': s.best.roles || x || a.ch})
  FROM step s JOIN ins ON ins.q = s.q JOIN act a ON a.conv_id IS NOT DISTINCT FROM s.conv_id AND a.i = s.i + 1 AND a.q = ins.q2
  GROUP BY s.conv_id, s.i, a.q2),
win AS (SELECT s.conv_id, min({'cost': s.best.cost + 2 * len(x), 'audit': s.best.audit || repeat('I', len(x)),
          'roles': s.best.roles || x}) AS best
        FROM step s JOIN st ON st.conv_id IS NOT DISTINCT FROM s.conv_id AND st.n = s.i JOIN ins ON ins.q = s.q
        WHERE q2 IN ('0', 'A') GROUP BY s.conv_id),
ed AS (SELECT conv_id, p, best.audit[p] AS e, best.roles[p] AS ch, CAST(p - len(replace(best.audit[:p], 'I', '')) AS BIGINT) AS lead
       FROM (SELECT conv_id, best, unnest(range(1, len(best.audit) + 1)) AS p FROM win)),
lines AS (SELECT ed.conv_id, p, CASE WHEN e = 'K' THEN role WHEN ch = 'u' THEN 'user' ELSE 'assistant' END || ':'
            || CASE WHEN e = 'I' THEN '' ELSE text END AS line
          FROM ed LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM ed.conv_id AND e <> 'I' AND r.i = p - lead WHERE e <> 'D'),
txt AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS t FROM lines GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN win ON win.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN txt ON txt.conv_id IS NOT DISTINCT FROM ids.conv_id"""


@query("op12_conversation_repair", OP12_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read_table(spark, sf_dir, "conversations"))


@query("op13_simhash_anchors")
def op13_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
