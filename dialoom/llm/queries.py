"""One query per operator, over the whole table, and its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontamination, embeddings, filter_audit, html_text, language, minhash, packing, sharding, substrings, topk_search, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(chat.format_chats(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.remainder("doc_id", 3) == 1
    model = language.fit(docs.where(~held_out), "doc_id", "text", "lang")
    return language.label_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return packing.pack_documents(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    """Fitted on labelled documents whose checksum modulo 5 is not 0."""
    return toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(language.remainder("doc_id", 5) != 0))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(docs, toxicity_model(spark, sf_dir))
    held_out = language.remainder("doc_id", 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.find_collocations(table(spark, sf_dir, "documents"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ALL = (
    op1_chat_format, op2_minhash, op3_decontamination, op4_language, op5_near_vectors, op6_packing, op7_repeats, op8_toxicity, op9_shards, op10_main_text,
    op11_phrases, op12_top_k, op13_filter_audit,
)


def queries() -> dict:
    return {f.__name__: f for f in ALL}


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) t(conv_id, turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(17 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, k AS m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
ends AS (
  SELECT lang, m - 1 AS m, unnest([array_to_string(string_split(phrase, ' ')[1:m - 1], ' '), array_to_string(string_split(phrase, ' ')[2:m], ' ')]) AS phrase, f FROM counts WHERE m > 2
), held AS (SELECT lang, phrase, max(f) AS held FROM ends GROUP BY ALL),
candidates AS (
  SELECT c.*, string_split(c.phrase, ' ') AS w FROM counts c LEFT JOIN held h ON c.lang = h.lang AND c.phrase = h.phrase WHERE c.m >= 2 AND (h.held IS NULL OR 100 * h.held < 100 * c.f)
), cuts AS (
  SELECT lang, phrase, f, m, w, unnest(range(1, m)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, t.n, c.k, (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM worst
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
"""

OP12_SQL = """
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), terms AS (SELECT vec_id, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM numbers),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM terms q JOIN terms c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

OP13_SQL = r"""
WITH facts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), failed AS (
  SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM facts
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT v.x || w.x || x.x || y.x || z.x AS filter_order FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5
), steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
met AS (
  SELECT part, filter_order, step, n, good, toxic, mask, contains(mask, filter_order[step]) AS fails,
    len(list_filter(range(1, 6), lambda i: i < step AND contains(mask, filter_order[i]))) > 0 AS gone FROM steps, masks
), each AS (
  SELECT part, filter_order, step, filter_order[step] AS own,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails AND len(mask) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM each
"""


def oracle_sql() -> dict:
    return {"op1_chat_format": OP1_SQL, "op11_phrases": OP11_SQL, "op12_top_k": OP12_SQL, "op13_filter_audit": OP13_SQL}
