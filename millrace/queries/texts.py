"""Pages, documents, conversations and vectors."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.columns import hash_bucket
from millrace.operators import text as jobs
from millrace.operators import similar, vectors
from millrace.operators.ann import VectorIndex, recall_of
from millrace.operators.sampling import top_per_group
from millrace.queries.registry import Tables, query, rnd
from millrace.session import materialize

DECODED = "x"
for entity, char in tx.ENTITIES:
    DECODED = f"replace({DECODED}, '{entity}', '{char}')"


def strip_sql(expr: str) -> str:
    body = f"regexp_replace(regexp_replace({expr}, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace({DECODED.replace('x', body, 1)}, '[ \\t\\r\\n]+', ' ', 'g'))"


@query("html_to_text", sql=f"""
SELECT page_id, url, {strip_sql("CASE WHEN regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) <> '' THEN regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) ELSE regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) END")} AS title,
 {strip_sql("html")} AS text FROM pages""")
def html_to_text(t: Tables):
    return t.pages.select("page_id", "url", tx.page_title(F.col("html")).alias("title"), tx.strip_markup(F.col("html")).alias("text"))


@query("chunk_text", sql=r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT doc_id, w, unnest(generate_series(0, greatest(1, ceil((len(w) - 40) / 160.0))::BIGINT - 1)) AS chunk FROM w)
SELECT doc_id, chunk, array_to_string(w[chunk * 160 + 1 : chunk * 160 + 200], ' ') AS body FROM s""")
def chunk_text(t: Tables):
    return t.documents.select("doc_id", F.posexplode(tx.word_chunks(F.col("text"), 200, 40)).alias("chunk", "body")).select(
        "doc_id", F.col("chunk").cast("long").alias("chunk"), "body")


@query("chunk_sections")
def chunk_sections(t: Tables):
    return t.pages.select("page_id", F.posexplode(tx.section_chunks(F.col("html"), 120, 10)).alias("chunk", "body"))


@query("embed_hashing")
def embed_hashing(t: Tables):
    from pyspark.ml.functions import vector_to_array

    v = jobs.embed(t.documents.select("doc_id", "text"), "text").select("doc_id", vector_to_array("features").alias("v"))
    return v.select("doc_id", F.size("v").alias("width"), rnd(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm"))


@query("vector_topk", sql="""
WITH d AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY 1, 2),
 c AS (SELECT label AS query_label, list(m ORDER BY i) AS center FROM d GROUP BY 1),
 s AS (SELECT query_label, vec_id, list_cosine_similarity(embedding::DOUBLE[], center) AS sim FROM embeddings, c)
SELECT query_label, vec_id, round(sim, 6) AS similarity FROM s QUALIFY row_number() OVER (PARTITION BY query_label ORDER BY sim DESC, vec_id) <= 10""")
def vector_topk(t: Tables):
    asks = vectors.centroids(t.embeddings, "label", "embedding").withColumnRenamed("label", "query_label")
    out = vectors.nearest(t.embeddings, "vec_id", "embedding", asks, "query_label", "center", 10)
    return out.withColumn("similarity", rnd("similarity", 6))


#: Wanted recall of the index, set by measuring it, not by searching everything.
RECALL = 0.9


def ann(t: Tables):
    """The index over all vectors, the rows asked (ids divisible by 100), and the cells that each reads."""
    index = VectorIndex.build(t.embeddings, "vec_id", "embedding", 64)
    asks = t.embeddings.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    probes, _ = index.probes_for(asks, "query_id", "embedding", 10, RECALL)
    return index, asks, index.search(asks, "query_id", "embedding", 10, probes)


@query("vector_ann", sql="""
SELECT vec_id AS query_id, least(10, (SELECT count(*) FROM embeddings))::BIGINT AS found, true AS recall_reached FROM embeddings WHERE vec_id % 100 = 0""")
def vector_ann(t: Tables):
    """Neighbours that the index finds for every row asked, and whether all answers together hold nine tenths of the exact ones."""
    _, asks, made = ann(t)
    found = materialize(made.select("query_id", "id"), "found")
    exact = vectors.nearest(t.embeddings, "vec_id", "embedding", asks, "query_id", "embedding", 10).select("query_id", F.col("vec_id").alias("id"))
    return found.groupBy("query_id").agg(F.count("*").alias("found")).withColumn("recall_reached", F.lit(recall_of(found, exact, ["query_id", "id"]) >= 0.9))


@query("vector_ann_neighbours")
def vector_ann_neighbours(t: Tables):
    """The neighbours themselves, with the share of all items whose codes the query compared."""
    index, _, made = ann(t)
    return made.select("query_id", F.col("id").alias("vec_id"), rnd("similarity", 6).alias("similarity"), rnd(F.col("touched") / F.lit(max(1, index.n)), 6).alias("share_touched"))


@query("text_similarity", sql=r"""
WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '[ \t\r\n]+'), lambda x: x <> '')) AS w FROM conversations)
SELECT a.conv_id, a.turn, round(coalesce(len(list_intersect(a.w, b.w)) / nullif(len(list_distinct(list_concat(a.w, b.w))), 0), 0), 6) AS similarity
FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def text_similarity(t: Tables):
    # each turn scored against the next one: an equality join, one partner per row
    sets = t.conversations.select("conv_id", "turn", F.array_distinct(tx.words(F.lower("text"))).alias("w"))
    nxt = sets.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("w2"))
    return sets.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", rnd(tx.jaccard(F.col("w"), F.col("w2")), 6).alias("similarity"))


TURN_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[ \t\r\n]+'), lambda x: x <> '')"


@query("turn_links", sql=f"""
WITH s AS (SELECT row_number() OVER () AS id, conv_id, turn, list_distinct({TURN_WORDS}) AS w FROM conversations), k AS (SELECT id, len(w) AS n, unnest(w) AS word FROM s),
 p AS (SELECT a.id, b.id AS other, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m FROM k a JOIN k b ON a.word = b.word AND a.id <> b.id GROUP BY 1, 2),
 l AS (SELECT id, count(*) AS links FROM p WHERE common >= 0.6 * (n + m - common) - 1e-9 GROUP BY 1), c AS (SELECT list_sort(w) AS w, count(*) AS copies FROM s GROUP BY 1)
SELECT conv_id, turn, copies, coalesce(links, 0) AS links FROM s JOIN c ON list_sort(s.w) = c.w LEFT JOIN l USING (id)""")
def turn_links(t: Tables):
    """Turns of any conversation with at least six tenths of their words in common."""
    turns = t.conversations.select("conv_id", "turn", tx.words(F.lower("text")).alias("w"))
    return similar.set_links(turns, ["conv_id", "turn"], "w", 0.6).drop("class_id")


@query("turn_cosine_links", sql=f"""
WITH s AS (SELECT row_number() OVER () AS id, conv_id, turn, {TURN_WORDS} AS w FROM conversations), k AS (SELECT id, word, count(*) AS times FROM (SELECT id, unnest(w) AS word FROM s) GROUP BY 1, 2),
 f AS (SELECT word, ln((SELECT count(*) FROM s) / count(*)) + 1 AS idf FROM k GROUP BY 1), v AS (SELECT id, word, times * idf AS x FROM k JOIN f USING (word)),
 u AS (SELECT id, word, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM v), p AS (SELECT a.id, b.id AS other, sum(a.x * b.x) AS likeness FROM u a JOIN u b ON a.word = b.word AND a.id <> b.id GROUP BY 1, 2),
 l AS (SELECT id, count(*) AS links FROM p WHERE likeness >= 0.3 - 1e-9 GROUP BY 1)
SELECT conv_id, turn, coalesce(links, 0) AS links FROM s LEFT JOIN l USING (id)""")
def turn_cosine_links(t: Tables):
    """Turns whose weighted words point the same way; the threshold is low, as invented turns share no topics."""
    turns = t.conversations.select("conv_id", "turn", tx.words(F.lower("text")).alias("w"))
    return similar.cosine_links(turns, ["conv_id", "turn"], "w", 0.3).drop("class_id", "copies")


# Patterns of the rule classifier and the extractor.
CLASS_RULES = {"link": "https?://", "mail": "[a-zA-Z0-9._]+@[a-zA-Z0-9.]+", "number": "[0-9]{3,}"}
FIELD_RULES = {"mail": "[a-zA-Z0-9._]+@[a-zA-Z0-9]+[.][a-z]+", "address": "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", "number": "[0-9]{4,}"}


@query("text_rules", sql="SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in CLASS_RULES.items()) + " ELSE 'plain' END AS class FROM documents")
def text_rules(t: Tables):
    return t.documents.select("doc_id", tx.first_rule(F.col("text"), CLASS_RULES, "plain").alias("class"))


@query("text_classify")
def text_classify(t: Tables):
    rows = t.documents.join(t.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    classify = jobs.train_text_classifier(rows, "text", "label")
    return classify(t.documents.select("doc_id", "text")).select("doc_id", "prediction")


@query("text_extract", sql="SELECT doc_id, " + ", ".join(f"nullif(regexp_extract(text, '{p}'), '') AS {n}" for n, p in FIELD_RULES.items()) +
       ", len(regexp_extract_all(text, '[0-9]+')) AS numbers FROM documents")
def text_extract(t: Tables):
    fields = tx.extract_fields(F.col("text"), FIELD_RULES)
    return t.documents.select("doc_id", fields.alias("f"), F.regexp_count("text", F.lit("[0-9]+")).cast("long").alias("numbers")).select("doc_id", "f.*", "numbers")


def find_numbers(text: str) -> str:
    """Stand-in for a hosted extractor: digits groups as JSON items."""
    return json.dumps([{"kind": "number", "value": m} for m in re.findall("[0-9]{3,}", text)])


@query("annotate_explode", sql="SELECT doc_id, lang, 'number' AS kind, unnest(regexp_extract_all(text, '[0-9]{3,}')) AS value FROM documents")
def annotate_explode(t: Tables):
    items = jobs.annotate(t.documents.select("doc_id", "text"), "doc_id", "text", find_numbers, "struct<kind:string, value:string>")
    return items.drop("text").join(t.documents.select("doc_id", "lang"), "doc_id").select("doc_id", "lang", "kind", "value")


SEGMENTS = """seg AS (SELECT conv_id, turn // 1000 AS segment, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS body, count(*) AS n,
 string_agg(role, ',' ORDER BY turn) AS roles, arg_max(role, turn) AS last_role FROM conversations GROUP BY 1, 2)"""


@query("prompt_build", sql=f"""
WITH {SEGMENTS} SELECT conv_id, segment, 'Summarise:' || chr(10) || body || chr(10) || '{{"conv_id":' || conv_id || ',"turns":' || n || '}}' AS prompt FROM seg""")
def prompt_build(t: Tables):
    seg = jobs.conversation_segments(t.conversations)
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n")
    facts = F.to_json(F.struct("conv_id", F.size("turns").alias("turns")))
    return seg.select("conv_id", "segment", F.concat_ws("\n", F.lit("Summarise:"), lines, facts).alias("prompt"))


@query("sample_per_hour", sql="""
SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY md5(event_id::VARCHAR || 'review'), event_id) <= 5""")
def sample_per_hour(t: Tables):
    recent = t.events.where("ts >= '2024-01-15' AND event_type <> 'error'").select(
        "event_id", "user_id", F.date_trunc("hour", "ts").alias("h"), F.md5(F.concat(F.col("event_id").cast("string"), F.lit("review"))).alias("r"))
    return top_per_group(recent, ["h"], [F.asc("r"), F.asc("event_id")], 5).select("event_id", "user_id")


@query("chat_dataset", sql=f"""
WITH {SEGMENTS}, whole AS (SELECT conv_id, arg_max(role, turn) AS closing FROM conversations GROUP BY 1)
SELECT conv_id, segment, n::INTEGER AS turns, roles,
 CASE WHEN ('0x' || substr(md5(conv_id::VARCHAR || 'chat'), 1, 15))::BIGINT % 10 < 9 THEN 'train' ELSE 'eval' END AS part FROM seg JOIN whole USING (conv_id)
 WHERE closing = 'assistant'""")
def chat_dataset(t: Tables):
    # training conversations end with the answer to learn; long ones are kept whole, in segments
    full = jobs.conversation_segments(jobs.with_last_turn(t.conversations).where("last_role = 'assistant'"))
    part = F.when(hash_bucket(F.col("conv_id"), 10, "chat") < 9, "train").otherwise("eval")
    full = full.withColumn("part", part)
    return full.select("conv_id", "segment", F.size("turns").alias("turns"), F.array_join(F.col("turns.role"), ",").alias("roles"), "part")


@query("chat_eval_prompts", sql="""
WITH l AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1)
SELECT c.conv_id, turn // 1000 AS segment, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS prompt FROM conversations c JOIN l ON c.conv_id = l.conv_id AND turn < last GROUP BY 1, 2""")
def chat_eval_prompts(t: Tables):
    # only the conversation's last turn is left out
    seg = jobs.conversation_segments(jobs.with_last_turn(t.conversations).where("turn < last_turn"))
    return seg.select("conv_id", "segment", F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n").alias("prompt"))


@query("assessment_merge", sql="""
WITH a AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, arg_max(value, (ts, event_id)) AS rating FROM events WHERE event_type = 'click' GROUP BY 1, 2),
 r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, list_sort(list(DISTINCT CAST(json_extract_string(props, '$.k') AS INTEGER) // 10)) AS grades FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT coalesce(a.user_id, r.user_id) AS user_id, coalesce(a.d, r.d) AS d, rating, array_to_string(grades, ',') AS grades FROM a FULL JOIN r ON a.user_id = r.user_id AND a.d = r.d""")
def assessment_merge(t: Tables):
    key = ["user_id", F.date_format("ts", "yyyy-MM-dd").alias("d")]
    latest = t.events.where("event_type = 'click'").groupBy(*key).agg(F.max_by("value", F.struct("ts", "event_id")).alias("rating"))
    grade = F.floor(F.get_json_object("props", "$.k").cast("int") / 10)
    # grades come from a scale of ten steps, so the collected set is bounded
    graded = t.events.where("event_type = 'view'").groupBy(*key).agg(F.array_sort(F.collect_set(grade)).alias("g"))
    return latest.join(graded, ["user_id", "d"], "full").select("user_id", "d", "rating", F.array_join(F.col("g").cast("array<string>"), ",").alias("grades"))


AT = "p[({r} + 1) * 8 + {c} + 2]"


@query("image_augment", sql=f"""
WITH e AS (SELECT vec_id, ('0x' || substr(md5(vec_id::VARCHAR || 'mirror'), 1, 15))::BIGINT % 2 = 1 AS flip,
  list_transform(embedding, lambda x: least(255, greatest(0, floor(128 + 64 * x::DOUBLE)))::BIGINT) AS p FROM embeddings),
 n AS (SELECT i, least(120, greatest(0, (2 * i + 1) * 6 - 12)) AS n FROM (SELECT unnest(generate_series(0, 11)) AS i)),
 a AS (SELECT i, n // 24 AS lo, least(n // 24 + 1, 5) AS hi, n % 24 AS f FROM n),
 px AS (SELECT vec_id, y.i * 12 + CASE WHEN flip THEN 12 - x.i ELSE x.i + 1 END AS place, ((24 - y.f) * ((24 - x.f) * {AT.format(r="y.lo", c="x.lo")} + x.f * {AT.format(r="y.lo", c="x.hi")})
  + y.f * ((24 - x.f) * {AT.format(r="y.hi", c="x.lo")} + x.f * {AT.format(r="y.hi", c="x.hi")}) + 288) // 576 AS v FROM e, a y, a x)
SELECT vec_id, CAST(157 AS BIGINT) AS n_bytes, sum(v)::BIGINT AS brightness, sum(v * place)::BIGINT AS checksum FROM px GROUP BY 1""")
def image_augment(t: Tables):
    """Vectors of 64 as 8 x 8 grey images: the middle 6 x 6 enlarged to 12 x 12, half of them mirrored."""
    from millrace.operators.images import augment, grey_map, pixel_values

    shade = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(128 + 64 * x.cast("double")))).cast("int"))
    rows = t.embeddings.select("vec_id", grey_map(shade, 8, 8).alias("image"))
    made = augment(rows, "image", (12, 12), (6, 6), hash_bucket(F.col("vec_id"), 2, "mirror") == 1)
    shown = made.select("vec_id", F.length("image").cast("long").alias("n_bytes"), pixel_values(F.col("image"), 12, 12).alias("v"))
    return shown.select("vec_id", "n_bytes", F.aggregate("v", F.lit(0).cast("long"), lambda s, v: s + v).alias("brightness"),
                        F.aggregate(F.transform("v", lambda v, i: v * (i + 1)), F.lit(0).cast("long"), lambda s, v: s + v).alias("checksum"))
