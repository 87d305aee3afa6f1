"""The operators over the given tables, with the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import exact_dedup, importance, language_id, mixing, order_minhash, packing, phrases, scaled_sketch, secret_scan, sharding, token_counts, vector_forest, warc
from terrace.staging import new_folder

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    # A quarter of the findings has no label and is judged by the forest alone.
    labelled = ~language_id.held_out(F.col("doc_id"))
    return secret_scan.scan(documents, F.when(labelled, secret_scan.known_formats()))


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return packing.piece_table(documents, public_tokenizers.path(TOKENIZER))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(TOKENIZER),
        cache=new_folder(spark, "token-cache"),
    )


def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op6_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return language_id.predict(documents, language_id.fit(documents))


def op7_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_forest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(_table(spark, sf_dir, "documents"))


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    equal = {shard: 1.0 for shard in range(8)}
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), equal)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_classes(_table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance.resample_table(documents, benchmark)


def op13_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.neighbours(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_forest": op1_secret_forest,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_lexical_packing": op3_lexical_packing,
    "op4_token_counts": op4_token_counts,
    "op5_fair_mix": op5_fair_mix,
    "op6_compression_language": op6_compression_language,
    "op7_vector_forest": op7_vector_forest,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_rendezvous_shards": op9_rendezvous_shards,
    "op10_order_minhash": op10_order_minhash,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_scaled_fingerprints": op13_scaled_fingerprints,
}

LLM_ORACLES: dict[str, str] = {
    "op2_warc_round_trip": r"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
        ), g AS (
            SELECT page_id, strlen(payload) AS payload_bytes,
                   array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                       (('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::BIGINT, 1)), '') AS payload_digest,
                   min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, true AS complete
        FROM g
    """,
    "op5_fair_mix": r"""
        WITH d AS (
            SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   coalesce('0' || source, '1') AS src,
                   md5('17|' || coalesce(doc_id::VARCHAR, '\N') || '|' || md5(coalesce(text, ''))) AS k
            FROM documents
        ), s AS (
            SELECT src, sum(size)::BIGINT AS source_size,
                   [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY src) - 1) % 3)]::DOUBLE AS w
            FROM d GROUP BY src
        ), c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS e FROM s),
        l AS (
            SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
                   coalesce(sum(cap) OVER (ORDER BY e, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
                   sum(w) OVER (ORDER BY e, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
            FROM c
        ), f AS (
            SELECT src, (budget - used) / open AS level FROM l
            WHERE (budget - used) / open <= e ORDER BY e, src LIMIT 1
        ), t AS (SELECT src, w, source_size, least(cap, w * level) AS target FROM c, (SELECT level FROM f)),
        q AS (
            SELECT d.*, source_size, target, w, row_number() OVER () AS uid,
                   coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM d JOIN t USING (src)
        ), copies AS (
            SELECT q.*, round, (round * source_size + start + size)::DOUBLE / w AS finish
            FROM q, (SELECT unnest([0, 1]) AS round)
        ), sent AS (
            SELECT *, coalesce(sum(size) OVER (ORDER BY finish, src, round, start, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM copies
        )
        SELECT doc_id, size, source_size, target,
               sum(greatest(0, least(size, (SELECT floor(max(budget)) FROM l)::BIGINT - before)))::BIGINT AS taken
        FROM sent GROUP BY uid, doc_id, size, source_size, target
    """,
    "op8_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content,
                   length(coalesce(text, '')) AS points
            FROM documents
        ), g AS (
            SELECT *, count(*) OVER (PARTITION BY content) AS group_size,
                   first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
            FROM n WINDOW w AS (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM g
    """,
    "op9_rendezvous_shards": r"""
        WITH d AS (
            SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
                   md5(coalesce(doc_id::VARCHAR, '\N') || '|' || md5(coalesce(text, ''))) AS k,
                   regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes,
                   list_transform(range(9), lambda s: -1.0::DOUBLE / ln((
                       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '\N') || '|' || s), 1, 13))::BIGINT + 0.5::DOUBLE
                   ) / 4503599627370496.0::DOUBLE)) AS score
            FROM documents
        ), crc_table AS (
            SELECT list(r ORDER BY b) AS table_of FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, i:
                    CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
                FROM (SELECT unnest(range(256)) AS b))
        ), n AS (
            SELECT doc_id, size, k,
                   xor(list_reduce(list_prepend(4294967295, list_transform(bytes, lambda x: ('0x' || x)::BIGINT)),
                       lambda r, b: xor(r >> 8, table_of[1 + (xor(r, b) & 255)])), 4294967295) AS text_crc32,
                   list_position(score[1:8], list_max(score[1:8])) - 1 AS shard,
                   list_position(score, list_max(score)) - 1 AS grown_shard
            FROM d, crc_table
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY k, doc_id) - 1 AS slot,
               grown_shard::INTEGER AS grown_shard
        FROM n
    """,
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), starts AS (
            SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w
        ), spans AS (
            SELECT lang, unnest(list_transform(range(0, least(4, len(words) - i + 1)),
                       lambda k: array_to_string(words[i:i + k], ' '))) AS phrase FROM starts
        ), f AS (
            SELECT lang, phrase, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 30
        ), totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
        c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE phrase LIKE '% %'),
        cuts AS (SELECT *, unnest(range(1, len(p))) AS k FROM c),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
                   (2000000::HUGEINT * c.a) // (x.f + y.f)::HUGEINT AS score
            FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')
        ), best AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_parts AS (
            SELECT lang, a AS longer, m, unnest(range(1, len(p) - m + 2)) AS i, p
            FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < len(p)
        ), held AS (
            SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(longer) AS longer
            FROM inner_parts GROUP BY ALL
        ), kept AS (
            SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
            WHERE NOT coalesce(100::HUGEINT * h.longer >= 80::HUGEINT * b.a, false)
        )
        SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
               phrase, a, l, r, n, score::BIGINT AS score
        FROM kept k JOIN totals t ON t.lang = k.lang
        QUALIFY rank <= 2000
    """,
    "op12_importance_resampling": r"""
        WITH d AS (
            SELECT row_number() OVER () AS uid, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), b AS (
            SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
        ), dw AS (SELECT uid, unnest(words) AS word FROM d), bw AS (SELECT unnest(words) AS word FROM b),
        crc_table AS (
            SELECT list(r ORDER BY b) AS table_of FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, i:
                    CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
                FROM (SELECT unnest(range(256)) AS b))
        ), bucket_of AS (
            SELECT word, xor(list_reduce(list_prepend(4294967295,
                       list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::BIGINT)),
                       lambda r, x: xor(r >> 8, table_of[1 + (xor(r, x) & 255)])), 4294967295) % 10000 AS bucket
            FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc_table
        ), s AS (SELECT bucket, count(*) AS s FROM dw JOIN bucket_of USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM bw JOIN bucket_of USING (word) GROUP BY bucket),
        gain AS (
            SELECT bucket, floor(1000.0::DOUBLE * ln(((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000.0::DOUBLE))
                       / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000.0::DOUBLE))))::BIGINT AS gain
            FROM s FULL JOIN t USING (bucket)
        ), w AS (
            SELECT uid, sum(gain)::BIGINT AS weight FROM dw JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY uid
        ), scored AS (
            SELECT uid, doc_id, coalesce(len(words), 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                   (coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:'
                       || coalesce(doc_id::VARCHAR, '\N')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
            FROM d LEFT JOIN w USING (uid)
        ), placed AS (
            SELECT *, n_features >= 20 AS fit, row_number() OVER (PARTITION BY n_features >= 20
                       ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN fit AND place <= (SELECT 10 * count(*) // 100 FROM placed WHERE fit) THEN place END AS rank
        FROM placed
    """,
    "op13_scaled_fingerprints": r"""
        WITH d AS (
            SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS uid, doc_id, coalesce(text, '') AS text,
                   coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS following,
                   coalesce(lead(uid_) OVER w, first_value(uid_) OVER w) AS next_uid, uid_
            FROM (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST) AS uid_ FROM documents)
            WINDOW w AS (ORDER BY uid_ ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        ), e AS (
            SELECT uid_ AS uid, next_uid, doc_id, text, length(text) AS n_chars,
                   substr(text, 1, length(text) - length(text) // 4) || substr(following, 1, length(text) // 4) AS edited
            FROM d
        ), kinds AS (SELECT uid, 0 AS kind, text FROM e UNION ALL SELECT uid, 1, edited FROM e),
        words AS (
            SELECT uid, kind, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM kinds
        ), hashes AS (
            SELECT uid, kind, CASE
                WHEN text = '' THEN []
                WHEN len(w) = 0 THEN [md5(text)[1:10]]
                WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))[1:10]]
                ELSE list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))[1:10]) END AS h
            FROM words
        ), kept AS (
            SELECT uid, kind, CASE WHEN len(list_filter(h, lambda x: x < '2')) > 0
                THEN list_sort(list_distinct(list_filter(h, lambda x: x < '2')))
                WHEN len(h) > 0 THEN [list_min(h)] ELSE [] END AS k FROM hashes
        ), three AS (
            SELECT e.*, a.k AS a, b.k AS b, c.k AS c FROM e
            JOIN kept a ON a.uid = e.uid AND a.kind = 0
            JOIN kept b ON b.uid = e.uid AND b.kind = 1
            JOIN kept c ON c.uid = e.next_uid AND c.kind = 0
        )
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
               array_to_string(b, '') AS edited_fingerprint,
               CASE WHEN least(len(a), len(b)) = 0 THEN (len(a) = len(b))::INT::DOUBLE
                    ELSE len(list_intersect(a, b)) / least(len(a), len(b))::DOUBLE END AS near_edited,
               CASE WHEN least(len(a), len(c)) = 0 THEN (len(a) = len(c))::INT::DOUBLE
                    ELSE len(list_intersect(a, c)) / least(len(a), len(c))::DOUBLE END AS near_next
        FROM three
    """,
}
