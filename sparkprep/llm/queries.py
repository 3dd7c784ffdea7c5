"""The registered queries of this folder and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm import (
    chat,
    decontaminate,
    embedding_dedup,
    hard_negatives,
    line_cleaning,
    line_dedup,
    mixing,
    near_dedup,
    pii,
    quality,
    spelling,
    token_counts,
    toxicity,
)
from sparkprep.llm.frames import comma_joined, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@_query(
    "op1_embedding_dedup",
    """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
          ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, l.c AS component_id, e.vec_id = l.c AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.x LEFT JOIN counted n ON n.x = e.vec_id
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@_query(
    "op5_minhash_dedup",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r\v\f]+') AS w FROM documents),
runs AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
counts AS (SELECT doc_id, s, count(*) AS c FROM runs GROUP BY ALL),
sizes AS (SELECT doc_id, sum(c) AS n FROM counts GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS m FROM counts a JOIN counts b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE m >= 0.8 * (p.n + q.n - m)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT x AS doc_id, min(y) AS class_id, x = min(y) AS kept FROM reach GROUP BY x
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@_query(
    "op6_pfair_mixing",
    """
WITH RECURSIVE sizes AS (SELECT coalesce('=' || source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
w AS (SELECT s, n, CAST(ceil(n / 16.0) AS BIGINT) AS blocks, sqrt(CAST(n AS DOUBLE)) * 1000 / sum(sqrt(CAST(n AS DOUBLE))) OVER () AS x FROM sizes),
cut AS (SELECT *, CAST(greatest(1, floor(x)) AS BIGINT) AS q FROM w),
ranked AS (SELECT *, 1000 - sum(q) OVER () AS rest, row_number() OVER (ORDER BY x - q DESC, s) AS up,
                  row_number() OVER (ORDER BY q DESC, s) AS down FROM cut),
plan AS (SELECT s, n, blocks, CAST(CASE WHEN rest > 0 AND up <= rest THEN q + 1 WHEN rest < 0 AND down = 1 THEN q + rest ELSE q END AS BIGINT) AS p FROM ranked),
src AS (SELECT list(s ORDER BY s) AS names, list(p ORDER BY s) AS ps FROM plan),
sched(t, sent, j) AS (
  SELECT -1, list_transform(ps, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM src
  UNION ALL
  SELECT t + 1, list_transform(sent, lambda x, k: CASE WHEN k = c THEN x + 1 ELSE x END), c
  FROM (SELECT t, sent, list_min(list_transform(range(1, len(ps) + 1), lambda k:
          CASE WHEN sent[k] < ps[k] AND (sent[k] * 1000) // ps[k] <= t + 1
               THEN (((sent[k] + 1) * 1000 + ps[k] - 1) // ps[k]) * 100000 + k END)) % 100000 AS c
        FROM sched, src WHERE t < 999)),
slots AS (SELECT names[j] AS s, t AS slot, row_number() OVER (PARTITION BY j ORDER BY t) - 1 AS i FROM sched, src WHERE t >= 0),
ending AS (SELECT max(CAST(ceil(blocks * 1000 / p) AS BIGINT)) AS fin FROM plan),
numbered AS (SELECT doc_id, source, coalesce('=' || source, '') AS s,
                    row_number() OVER (PARTITION BY source ORDER BY md5(concat(CAST(doc_id AS VARCHAR), '#42')), doc_id) - 1 AS at FROM documents),
used AS (SELECT d.doc_id, d.source, d.s, d.at % 16 AS mix_place, d.at // 16 AS first, p.p, p.blocks,
                unnest(generate_series(0, greatest(1, CAST(ceil((ceil(e.fin * p.p / 1000) - d.at // 16) / p.blocks) AS BIGINT)) - 1)) AS mix_epoch
         FROM numbered d JOIN plan p USING (s) CROSS JOIN ending e),
placed AS (SELECT *, first + mix_epoch * blocks AS b FROM used)
SELECT d.doc_id, d.source, (d.b // d.p) * 1000 + l.slot AS mix_slot, CAST(d.mix_place AS BIGINT) AS mix_place,
       CAST(d.mix_epoch AS BIGINT) AS mix_epoch, d.b AS mix_block, (d.b * 1000) // d.p AS mix_release,
       ((d.b + 1) * 1000 + d.p - 1) // d.p AS mix_due
FROM placed d JOIN slots l ON l.s = d.s AND l.i = d.b % d.p
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


#: Control strings and backslashes, as the template escapes them.
_MARKS = r"\\|<\||\|>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<s>|</s>|<bos>|<eos>|<start_of_turn>|<end_of_turn>"


@_query(
    "op7_chat_format",
    f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(8 + sum(13 + length(role) + len(regexp_extract_all(role, '{_MARKS}')) + length(text) + len(regexp_extract_all(text, '{_MARKS}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], conversations.schema)
    return chat.read_back(chat.format_conversations(conversations.unionByName(own)))


@_query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@_query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.scores(docs, table(spark, sf_dir, "labels"))
    score = F.col("toxic_score")
    predicted = (score >= toxicity.TOXIC_FROM).cast("int")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), score.alias("score"), predicted.alias("predicted"), "toxic_evidence")


@_query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def listed(spans: str):
        one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("found").alias("spans"))


@_query("op4_decontaminate")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.benchmark_matches(docs, table(spark, sf_dir, "benchmark")).drop("text")
    matches = F.col("bench_matches")
    return found.select(
        "doc_id",
        (F.size(matches) > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(matches["item_id"])).alias("item_ids"),
        F.coalesce(F.array_max(matches["coverage"]), F.lit(0.0)).alias("coverage"),
    )


@_query("op9_quality_resample")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.resample(table(spark, sf_dir, "documents"), good)


@_query(
    "op10_line_dedup",
    r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
kept AS (SELECT doc_id, i, trim(line, E' \t\r') AS line FROM lines WHERE trim(line, E' \t\r') <> ''),
w AS (
  SELECT doc_id, i AS i0, lead(i, 1) OVER s AS i1, lead(i, 2) OVER s AS i2, row_number() OVER s AS k,
         line AS l0, lead(line, 1) OVER s AS l1, lead(line, 2) OVER s AS l2
  FROM kept WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, k) AS seen FROM w WHERE i2 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([i0, i1, i2]) AS i FROM placed WHERE seen > 1),
cut AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
               coalesce(string_agg(CAST(g.i AS VARCHAR), ',' ORDER BY l.i), '') AS removed,
               md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS text_md5
        FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, removed, text_md5 FROM cut
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    out = line_dedup.drop_repeated_lines(docs.select("doc_id", "text", n_lines.alias("n_lines")), removed_col="gone")
    return out.select(
        "doc_id",
        "n_lines",
        F.size("gone").cast("long").alias("n_removed"),
        comma_joined(F.col("gone")).alias("removed"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
    )


@_query(
    "op11_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, m.id AS negative_id, positive_score, m.score AS negative_score
FROM p JOIN met m ON m.anchor_id = p.anchor_id AND NOT m.same AND 80 * positive_score <= 100 * m.score AND m.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY m.score DESC, m.id)
QUALIFY row_number() OVER w <= 5
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


@_query(
    "op12_line_rules",
    r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
runs AS (
  SELECT doc_id, k, w[k + 1:k + 5] AS run FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS k FROM docs WHERE len(w) >= 5)),
again AS (SELECT doc_id, k, lead(k) OVER (PARTITION BY doc_id ORDER BY k) - k AS gap
          FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, run) AS c FROM runs) WHERE c > 1),
repeated AS (SELECT doc_id, sum(least(5, coalesce(gap, 5))) AS n FROM again GROUP BY 1),
lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars, length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(line, '[^\p{L}]', '', 'g')) AS letters, length(regexp_replace(line, '[^\p{Lu}]', '', 'g')) AS uppers
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)),
judged AS (
  SELECT *, symbols * 10 > chars
    OR (len(w) >= 3 AND len(list_filter(w, lambda x: x IN ('|', '›', '»', '>', '•', '·', '::'))) * 5 >= len(w))
    OR (len(w) <= 40 AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '@BOILERPLATE@'))
    OR (len(w) >= 3 AND uppers * 10 > letters * 6)
    OR NOT regexp_matches(line, '@SENTENCE_END@') AS bad
  FROM lines WHERE len(w) > 0),
lost AS (SELECT doc_id, sum(chars) FILTER (WHERE bad) AS lost, count(*) - count(DISTINCT line) AS dup FROM judged GROUP BY 1),
facts AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(l.lost, 0) AS lost_chars
  FROM docs d LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost_chars <= word_chars AS kept, CAST(lost_chars AS BIGINT) AS lost_chars
FROM facts
""".replace("@BOILERPLATE@", line_cleaning.BOILERPLATE)
    .replace("@SENTENCE_END@", line_cleaning.SENTENCE_END.replace("'", "''")),
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_cleaning.line_quality(table(spark, sf_dir, "documents")).drop("failed")


@_query(
    "op13_spelling_variants",
    r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
long AS (SELECT doc_id, run, n, length(run) AS len FROM runs WHERE length(run) >= 6),
crc AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), unicode(c) - 64] END))),
    lambda crc, byte: xor(crc >> 8, list_reduce(list_prepend(xor(crc, byte) & 255, range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))) AS h
  FROM long),
counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % len AS BIGINT)) || substr(run, CAST(h % len AS BIGINT) + 2) ELSE run END AS word, sum(n) AS n FROM crc GROUP BY 1),
words AS (SELECT word, CAST(n AS BIGINT) AS n FROM counted WHERE length(word) >= 6 AND n >= 5),
holes AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT x.word, y.word AS near FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.a || h.b
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.a || h.b),
best AS (SELECT e.word, w.word AS form, w.n AS form_n, count(*) OVER (PARTITION BY e.word) AS n_near
         FROM near e JOIN words w ON w.word = e.near QUALIFY row_number() OVER (PARTITION BY e.word ORDER BY w.n DESC, w.word) = 1),
found AS (SELECT w.word, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form, w.n, coalesce(b.n_near, 0) AS n_near,
                 CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain(word, root) AS (SELECT word, word FROM words UNION ALL SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM found f JOIN chain c USING (word) JOIN found e ON e.word = c.root WHERE e.form IS NULL
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
