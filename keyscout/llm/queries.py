"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyscout.llm import common, crosspolytope, decision_list, hard_negatives, kneser_ney, lexical, mixing, nbsvm, packing, preferences, secrets, simhash, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(text("base_spans"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nbsvm.score(docs, *nbsvm.learn(docs, table(spark, sf_dir, "labels")))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "conversations")
    return preferences.format_preferences(chosen, preferences.stale_answers(chosen)).withColumnRenamed("pair_id", "conv_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = decision_list.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.sampled_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = kneser_ney.held_out(F.col("doc_id"))
    model = kneser_ney.train(docs.where(~out))
    scored = kneser_ney.score_texts(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), hard_negatives.whole_numbers(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, "vec_id")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~out))
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


QUERIES = {
    q.__name__: q
    for q in (op1_secret_formats, op2_quality_nbsvm, op3_best_fit_packing, op4_simhash, op5_preferences, op6_warc, op7_cross_polytope, op8_quality_rules, op9_source_mixing, op10_kneser_ney, op11_hard_negatives, op12_lexical_search, op13_toxicity)
}

ORACLE = {
    "op5_preferences": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) - 1 AS place FROM conversations),
        k AS (
            SELECT conv_id, max(turn) FILTER (role = 'assistant') AS answer, arg_max(text, turn) FILTER (role = 'user') AS question FROM conversations GROUP BY conv_id),
        o AS (SELECT conv_id, arg_max(text, turn) AS older FROM conversations JOIN k USING (conv_id) WHERE role = 'assistant' AND turn < answer GROUP BY conv_id),
        r AS (
            SELECT c.conv_id, c.turn, c.role, c.place, CASE WHEN c.role = 'assistant' AND c.turn = k.answer THEN coalesce(o.older, k.question, c.text) ELSE c.text END AS text
            FROM c JOIN k USING (conv_id) LEFT JOIN o USING (conv_id)),
        p AS (SELECT c.conv_id, min(CASE WHEN c.text <> r.text OR c.role <> r.role THEN c.place END) AS turns FROM c JOIN r USING (conv_id, place) GROUP BY c.conv_id),
        u AS (
            SELECT conv_id, CASE WHEN turns IS NULL OR place < turns THEN 'prompt' ELSE 'chosen' END AS part, place, role, text FROM c JOIN p USING (conv_id)
            UNION ALL SELECT conv_id, 'rejected', place, role, text FROM r JOIN p USING (conv_id) WHERE place >= turns),
        z AS (SELECT conv_id, part, place, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM u),
        b AS (SELECT conv_id, sum(length(rendered)) AS size FROM z WHERE part = 'prompt' GROUP BY conv_id)
        SELECT z.conv_id, part, place::BIGINT AS place, role, rendered,
            (coalesce(sum(length(rendered)) OVER (PARTITION BY z.conv_id, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + CASE WHEN part = 'prompt' THEN 0 ELSE coalesce(b.size, 0) END)::BIGINT AS start,
            (CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 1 ELSE 0 END)::INTEGER AS mask
        FROM z LEFT JOIN b USING (conv_id)
    """,
    "op6_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS response FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN response <> page_id THEN response END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
    """,
    "op7_cross_polytope": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM v),
        l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.95 * a.len * b.len WHERE a.len > 0 AND b.len > 0),
        r AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
        c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
        d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN c ON c.node = vec_id LEFT JOIN d ON d.a = vec_id
    """,
    "op9_source_mixing": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 2 * source_size AS most FROM s),
        l AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM w),
        f AS (SELECT first(level ORDER BY most / weight, level) AS level FROM l WHERE most > weight * level),
        t AS (SELECT source, source_size, CASE WHEN most > weight * l.level THEN weight * f.level ELSE most::DOUBLE END AS target FROM l LEFT JOIN f ON true),
        k AS (SELECT greatest(1, ceil(count(*) / 100000.0))::BIGINT AS parts FROM d),
        o AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS step,
                     ('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN ':null' ELSE ':=' || source END), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift FROM t),
        r AS (SELECT doc_id, d.source, size, row_number() OVER (PARTITION BY source ORDER BY floor(sqrt(size)),
                     ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % (SELECT parts FROM k), size, doc_id NULLS FIRST) AS rank FROM d)
        SELECT doc_id, size, source_size, target, ((floor(shift + step * rank) - floor(shift + step * (rank - 1))) * size)::BIGINT AS taken
        FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
            s.id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        i AS (
            SELECT DISTINCT item_id, text,
                unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
            FROM benchmark),
        n AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
        f AS (SELECT row, doc_id, len(terms)::BIGINT AS size, unnest(terms) AS term FROM d),
        c AS (SELECT row, doc_id, size, term, count(*) AS tf FROM f WHERE term IN (SELECT term FROM i) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM c, n GROUP BY term, n_docs),
        p AS (SELECT row, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n_docs) // n_terms))) AS share FROM c JOIN w USING (term), n)
        SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY sum(share) DESC, doc_id NULLS LAST, row)::INTEGER AS rank, doc_id, sum(share)::BIGINT AS score
        FROM i JOIN p USING (term) GROUP BY item_id, text, row, doc_id HAVING sum(share) > 0
        QUALIFY rank <= 50
    """,
}
