"""The registered queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.byte_language import fold, predict_languages
from blotter.llm.chat_trees import chain_nodes, format_records, read_records
from blotter.llm.common import stored, table
from blotter.llm.decontaminate import find_contamination, hit_words
from blotter.llm.embedding_links import link_vectors
from blotter.llm.filter_audit import audit_filters
from blotter.llm.line_quality import score_quality
from blotter.llm.packing import Capacity, pack_documents
from blotter.llm.piece_counts import count_tokens
from blotter.llm.simhash_links import simhash_groups
from blotter.llm.token_files import token_digests, write_token_files
from blotter.llm.url_rules import ALLOW, BLOCK, judge_urls
from blotter.llm.whitening import whiten
from blotter.llm.winnowing import compare_edits
from blotter.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -------------------------------------------------------- 1: embedding links


@query
def op1_embedding_links(spark, sf_dir):
    return link_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op1_embedding_links"] = """
WITH RECURSIVE vecs AS (
    SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
        sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm
    FROM embeddings
), good AS (
    SELECT * FROM vecs WHERE label IS NOT NULL AND norm > 0 AND isfinite(norm)
        AND len(list_filter(v, lambda x: x IS NULL)) = 0
), links AS (
    SELECT a.rid AS a, b.rid AS b, b.vec_id AS other FROM good a JOIN good b
      ON a.label = b.label AND a.rid <> b.rid AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counted AS (
    SELECT a AS rid, count(*) AS n FROM links GROUP BY a
), least AS (
    SELECT r.a AS rid, min(v.vec_id) AS m FROM reach r JOIN vecs v ON v.rid = r.b GROUP BY r.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM vecs LEFT JOIN counted USING (rid) LEFT JOIN least USING (rid)
"""

# -------------------------------------------------------- 2: decontamination


@query
def op2_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = hit_words("hit_spans")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("hit_items", ","), "UTF-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLES["op2_decontamination"] = r"""
WITH lowered AS (
    SELECT row_number() OVER () AS rid, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), docs AS (
    SELECT rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item_id, w, least(10, len(w)) AS m FROM items WHERE len(w) > 0
), starts AS (
    SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM sized
), wins AS (
    SELECT DISTINCT item_id, m, array_to_string(w[s : s + m - 1], ' ') AS win FROM starts
), doc_starts AS (
    SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS s
    FROM docs, (SELECT DISTINCT m FROM wins)
), doc_wins AS (
    SELECT rid, m, s, array_to_string(w[s : s + m - 1], ' ') AS win FROM doc_starts
), hits AS (
    SELECT rid, m, s, item_id FROM doc_wins JOIN wins USING (m, win)
), marked AS (
    SELECT rid, count(DISTINCT i) AS n_hit
    FROM (SELECT rid, unnest(range(s, s + m)) AS i FROM hits) GROUP BY rid
), named AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (rid) LEFT JOIN named USING (rid)
"""

# ------------------------------------------------------------ 3: token counts

PIECES = "piece_bpe_32k.model"
CONTEXT_TOKENS = 4096


@query
def op3_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(PIECES), CONTEXT_TOKENS)


# ------------------------------------------------------------- 4: token files

WORDS = "word_bpe_49k.json"


@query
def op4_token_files(spark, sf_dir):
    path = work_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORDS))
    return token_digests(spark, path)


# ----------------------------------------------------------- 5: near copies


@query
def op5_simhash_groups(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 6: quality


@query
def op6_line_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    return score_quality(docs, labels).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        "predicted",
    )


# ------------------------------------------------------------- 7: language id


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    return predict_languages(docs, ~held_out).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


# ------------------------------------------------------------ 8: chat records

CONTROL_TURN = "</s>[INST] ok [/INST]"


@query
def op8_chat_records(spark, sf_dir):
    """All conversations and the control-string one, formatted, stored, read back and digested."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TURN).alias("text"),
    )
    nodes = chain_nodes(turns.unionByName(control))
    records = read_records(stored(format_records(nodes), "records"))
    spelled = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return records.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(spelled, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op8_chat_records"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), marked AS (
    SELECT *, regexp_replace(
        replace(text, '\', '\\'),
        '(<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<<SYS>>|<</SYS>>)', '#\1', 'g') AS escaped
    FROM turns
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    CAST(sum(12 + length(url_encode(role)) + 1 + length(escaped) + 11) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

# -------------------------------------------------------------- 9: url rules

URL_RULES = (
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
)


@query
def op9_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLES["op9_url_rules"] = """
WITH rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tails AS (
    SELECT page_id, CASE WHEN position('://' IN url) > 0
        THEN substr(url, position('://' IN url) + 3) ELSE '' END AS tail FROM pages
), split AS (
    SELECT page_id, regexp_extract(tail, '^[^/?#]*') AS raw, tail FROM tails
), parts AS (
    SELECT row_number() OVER () AS rid, page_id,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(tail, length(raw) + 1), '^[^?#]*') AS path
    FROM split
), best AS (
    SELECT rid, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS verdict
    FROM parts JOIN rules
      ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (rid)
"""

# --------------------------------------------------------------- 10: packing


@query
def op10_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path(WORDS), Capacity.of_tokens(CONTEXT_TOKENS))


# -------------------------------------------------------------- 11: whitening


@query
def op11_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


# ----------------------------------------------------------- 12: filter audit


@query
def op12_filter_audit(spark, sf_dir):
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        min(doc_id) OVER (PARTITION BY t) AS first_id
    FROM docs
), marks AS (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CAST(len(w) < 200 AS INT)
        + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
        + 4 * CAST(100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT)
        + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
        + 16 * CAST(coalesce(doc_id > first_id, false) AS INT) AS mask
    FROM split LEFT JOIN marks USING (doc_id)
), cells AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), f AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, b)
), orders AS (
    SELECT f1.c || f2.c || f3.c || f4.c || f5.c AS filter_order,
        [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
    FROM f f1, f f2, f f3, f f4, f f5
    WHERE len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5
), steps AS (
    SELECT filter_order, CAST(s AS INT) AS step, bits[s] AS bit,
        CAST(coalesce(list_sum(bits[1 : s - 1]), 0) AS INT) AS before
    FROM orders, range(1, 6) r(s)
), counted AS (
    SELECT part, filter_order, step, bit,
        sum(n) FILTER (mask & (before | bit) = 0) AS kept,
        sum(n) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
        sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant,
        sum(n) FILTER (mask = bit) AS unique_fails,
        sum(good) FILTER (mask & before = 0 AND mask & bit <> 0) AS good_lost,
        sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
    CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

# ---------------------------------------------------- 13: document fingerprints


@query
def op13_document_fingerprints(spark, sf_dir):
    return compare_edits(table(spark, sf_dir, "documents"))
