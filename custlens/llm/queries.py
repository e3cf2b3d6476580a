"""Registered queries of this subpackage: one ``opN_<name>`` per operator over
its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (attention_lm, chat, decontam, divergence, jaccard_join, langid, neardup, packing, sharding, topk, toxicity, url_filter,
               vector_codes)
from .common import held_out, read


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by mixture inference."""
    docs = read(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs.select("doc_id", "text", "lang"), usable=~out)
    got = langid.predict(docs, model, keep=["doc_id"])
    return got.select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages", "shares")


def op2_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every whole document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 10, 0)
    got = attention_lm.score(docs, ~out, tokenizer_path())
    return got.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have Jaccard >= 0.75."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_components(docs)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector among all others."""
    rows = read(spark, sf_dir, "embeddings")
    return topk.top_k(rows, F.col("vec_id") % 50 == 0, 5)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, (row_number() OVER w)::INTEGER AS rank, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0 AND len(q.e) = len(c.e)
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[]) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 5
"""


def _chat_log(rows: DataFrame) -> DataFrame:
    """A log that folds back to ``rows`` (conv_id, turn, role, text): by a hash of the
    row a text comes whole, as three streamed deltas, as a draft and its edit,
    or as a first try that is regenerated."""
    rows = rows.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    opens = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) == 1
    way = F.pmod(F.xxhash64("conv_id", "turn", "role", "text"), F.lit(4))
    # a regeneration voids its whole turn, so only the turn's first message may have one
    way = F.when((way == 3) & (~F.col("opens") | F.col("turn").isNull()), F.lit(2)).otherwise(way)
    text, third = F.col("text"), F.floor(F.length("text") / 3).cast("int")
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("said"))
    half = F.concat(F.lit("draft: "), F.substr(text, F.lit(1), F.floor(F.length("text") / 2).cast("int")))
    events = (F.when(way == 0, F.array(event("message", text)))
              .when(way == 1, F.array(event("message", F.lit("")), event("delta", F.substr(text, F.lit(1), third)),
                                      event("delta", F.substr(text, third + 1, third)), event("delta", F.substr(text, 2 * third + 1, F.length("text")))))
              .when(way == 2, F.array(event("message", half), event("edit", text)))
              .otherwise(F.array(event("message", half), event("delta", half), event("regenerate", F.lit(None).cast("string")), event("message", text))))
    log = rows.withColumns({"nth": nth, "opens": opens}).select("conv_id", "turn", "role", "nth", F.posexplode(events).alias("at", "event"))
    return log.select("conv_id", (F.col("nth") * 8 + F.col("at")).cast("long").alias("seq"), "turn", "event.kind", "role",
                      F.col("event.said").alias("text"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rebuilt from its log of deltas, edits and regenerations,
    rendered, and read back."""
    probe = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                      "(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = chat.parse(chat.format_conversations(_chat_log(rows)))
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(11 + length(role) + length(text)
      + length(role || text) - length(replace(role || text, '\', ''))
      + length(role || text) - length(replace(role || text, '<', ''))
      + length(role || text) - length(replace(role || text, '[', ''))
      + length(role || text) - length(replace(role || text, '|', '')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or word verdict of every page's URL."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into power-of-two sequences of at most 4096 tokens."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    got = packing.pack(docs, tokenizer_path())
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled uniformly into 16 shards of equal counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard_rows(rows, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold segments of benchmark items, one row per item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contaminated(docs, read(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 5, 0)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), usable=~out)
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every usable vector."""
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def _op11_sql() -> str:
    """The fixed number of rounds written out."""
    assign = """
near{r} AS (
  SELECT id, part, entry, d FROM (
    SELECT x.id, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d
    FROM x JOIN book{r} b USING (part, place) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY id, part ORDER BY d, entry) = 1)"""
    refine = """
book{n} AS (
  SELECT b.part, b.entry, b.place, CASE WHEN m.c IS NULL THEN b.v ELSE (m.s - ((m.s % m.c) + m.c) % m.c) // m.c END AS v
  FROM book{r} b LEFT JOIN (
    SELECT n.part, n.entry, x.place, sum(x.v) AS s, count(*) AS c
    FROM near{r} n JOIN x USING (id, part) GROUP BY ALL) m USING (part, entry, place))"""
    rounds = ",".join(assign.format(r=r) + "," + refine.format(r=r, n=r + 1) for r in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS id FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS (
  SELECT id, (k - 1) // (n // 8) AS part, (k - 1) % (n // 8) AS place, floor(4096 * v::DOUBLE)::HUGEINT AS v
  FROM (SELECT id, len(embedding) AS n, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS k FROM kept)),
book0 AS (SELECT part, id AS entry, place, v FROM x WHERE id < {vector_codes.ENTRIES}),{rounds},{assign.format(r=last)},
codes AS (SELECT id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{last} GROUP BY id),
sha AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (id) CROSS JOIN sha
"""


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN n USING (vec_id)
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked distances of sources and the terms that set them apart."""
    return divergence.audit(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
vocabulary AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, count(w.row) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term
  GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n, lang_n,
    1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (total + 5 * v) AS q
  FROM counts JOIN vocabulary USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.a = a.source AND s.b = b.source)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value,
    (row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term))::INTEGER AS rank FROM shares WHERE n > 0 AND p > q)
WHERE rank <= 50
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_attention_lm": op2_attention_lm,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_exact_topk": op4_exact_topk,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_url_filter": op6_url_filter,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_topk": OP4_SQL,
    "op5_chat_formatting": OP5_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_embedding_dedup": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
