"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import bpe, chat, decontam, dedup, lm, mixing, near, phrases, quality, resample, secrets, sharding, urls
from txlake.llm.common import tune
from txlake.plans.registry import Query, portable
from txlake.session import prepare

REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(tune(prepare(spark)), folder))

        REGISTRY[name] = Query(name, run, sql)
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(secrets.find_secrets(table(spark, folder, "documents")))


@query(
    "op2_exact_dedup",
    f"""
    WITH n AS (SELECT doc_id, {SQL_LOWER} AS norm FROM documents)
    SELECT doc_id,
           max(doc_id) OVER w AS keep_id,
           count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept,
           sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, folder, "documents"))


@query("op3_sharding")
def kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", (~decontam.clean(F.col("items"))).alias("contaminated"), F.col("items").alias("item_ids"), "similarity")


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), quality.score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


@query("op6_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.language_scores(table(spark, folder, "documents"))


@query(
    "op7_chat_formatting",
    r"""
    WITH t AS (
        SELECT conv_id, coalesce(role, 'unknown') AS role,
               replace(replace(coalesce(text, ''), '<|im_start|>', '< im_start >'), '<|im_end|>', '< im_end >') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), text) - 1 AS seq
        FROM conversations
    ), p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
    m AS (
        SELECT t.conv_id, p.participant, t.seq // 256 AS part, t.seq,
               t.role = p.participant AS mine,
               '<|im_start|>' || CASE WHEN t.role = p.participant THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                    ELSE 'user name=' || url_encode(t.role) END || chr(10) AS head,
               t.text || '<|im_end|>' || chr(10) AS body
        FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
    ), o AS (
        SELECT *, coalesce(sum(length(head) + length(body)) OVER (
                   PARTITION BY conv_id, participant, part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
        FROM m
    ), g AS (
        SELECT conv_id, participant, part, count(*) AS n_messages, sum(length(head) + length(body))::BIGINT AS n_chars,
               string_agg(head || body, '' ORDER BY seq) AS rendered,
               string_agg(CASE WHEN mine THEN (pos + length(head)) || ':' || (pos + length(head) + length(body)) END, ',' ORDER BY seq) AS spans,
               string_agg(CASE WHEN mine THEN pos || ':' || (pos + length(head))
                          ELSE pos || ':' || (pos + length(head)) || ',' || (pos + length(head)) || ':' || (pos + length(head) + length(body)) END,
                          ',' ORDER BY seq) AS masked
        FROM o GROUP BY ALL
    )
    SELECT conv_id, participant, part,
           coalesce(sum(n_chars) OVER (PARTITION BY conv_id, participant ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
           n_messages, n_chars, rendered, coalesce(spans, '') AS spans, coalesce(masked, '') AS masked
    FROM g
    """,
)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    told = chat.perspectives(table(spark, folder, "conversations"))
    text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return told.withColumns({"spans": text("spans"), "masked": text("masked"), "n_messages": F.col("n_messages").cast("long")})


@query("op8_url_filter")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"))


@query("op9_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents")).drop("root", "a", "b")


@query(
    "op10_source_mixing",
    r"""
    WITH d AS (
        SELECT doc_id, source, text,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
        FROM d GROUP BY source
    ), r AS (
        SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k,
               (sum(source_size) OVER ())::DOUBLE AS total,
               (sum(weight) OVER ())::DOUBLE AS all_weight
        FROM s
    ), c AS (
        SELECT *, coalesce(sum(3.0 * source_size) OVER b, 0)::DOUBLE AS spent, coalesce(sum(weight) OVER b, 0)::DOUBLE AS closed
        FROM r WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), l AS (
        SELECT (total - spent) / (all_weight - closed) AS level
        FROM c WHERE (total - spent) / (all_weight - closed) * weight < 3.0 * source_size ORDER BY k LIMIT 1
    ), t AS (
        SELECT source, source_size,
               least(3.0::DOUBLE * source_size, coalesce((SELECT level FROM l), 0) * weight)::DOUBLE AS target FROM c
    ), x AS (
        SELECT d.doc_id, d.size, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
               ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS coin
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target, rate,
           (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies,
           (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM x
    """,
)
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


@query("op11_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.vocabulary()
    # Every row gets ids and bytes again from them; the digests are taken from both.
    coded = table(spark, folder, "documents").select("doc_id", bpe.token_ids(F.col("text"), ranks).alias("ids"))
    return bpe.decode(coded, ranks, "ids").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


# CRC-32 of each distinct word in SQL: a table of 256 steps, then one step per byte.
SQL_BUCKETS = r"""
    crc_steps AS (
        SELECT list(list_reduce(list_concat([b], range(8)),
                    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
        FROM (SELECT unnest(range(256)) AS b)
    ), dw AS (
        SELECT doc_id, unnest(regexp_extract_all({lower}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')) AS word FROM documents
    ), bw AS (
        SELECT unnest(regexp_extract_all({lower}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')) AS word FROM benchmark
    ), codes AS (
        SELECT word, xor(list_reduce(
                   list_concat([4294967295], list_transform(range(1, octet_length(encode(word)) + 1),
                       lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc_steps
    )"""


@query(
    "op13_importance_resampling",
    f"""
    WITH {SQL_BUCKETS.format(lower=SQL_LOWER)},
    f AS (SELECT doc_id, bucket, count(*) AS c FROM dw JOIN codes USING (word) GROUP BY ALL),
    s AS (SELECT bucket, sum(c) AS s FROM f GROUP BY 1),
    t AS (SELECT bucket, count(*) AS t FROM bw JOIN codes USING (word) GROUP BY 1),
    g AS (
        SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
                   / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
        FROM s FULL JOIN t USING (bucket)
    ), w AS (
        SELECT doc_id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM f JOIN g USING (bucket) GROUP BY 1
    ), x AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
        FROM documents LEFT JOIN w USING (doc_id)
    ), y AS (
        SELECT doc_id, n_features, weight,
               weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
               n_features >= 20 AS able
        FROM x
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM y
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM r
    """,
)
def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op12_phrase_collocations",
    rf"""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({SQL_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    ), q AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
    ), g AS (
        SELECT lang, m, w[i:i + m - 1] AS words
        FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM q, (SELECT unnest(range(1, 5)) AS m) AS lengths)
    ), f AS (
        SELECT lang, m, words, count(*) AS f FROM g GROUP BY ALL
    ), totals AS (
        SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1
    ), c AS (
        SELECT * FROM f WHERE m >= 2 AND f >= 30
    ), cuts AS (
        SELECT c.lang, c.m, c.words, c.f AS a, k, x.f AS l, y.f AS r,
               ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
        JOIN f AS x ON x.lang = c.lang AND x.words = c.words[1:k]
        JOIN f AS y ON y.lang = c.lang AND y.words = c.words[k + 1:]
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
    ), inner_runs AS (
        SELECT lang, words[i:i + s - 1] AS words, max(f) AS longer
        FROM (SELECT lang, words, f, m, s, unnest(range(1, m - s + 2)) AS i FROM c, (SELECT unnest(range(2, 4)) AS s) AS t WHERE s < m)
        GROUP BY ALL
    ), kept AS (
        SELECT l.lang, array_to_string(l.words, ' ') AS phrase, a, l, r, score
        FROM lowest AS l LEFT JOIN inner_runs AS i ON i.lang = l.lang AND i.words = l.words
        WHERE longer IS NULL OR 100 * longer < 80 * a
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
