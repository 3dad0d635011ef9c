"""Registered queries of the operators: each applies one operator to its whole table.

``QUERIES`` maps names to functions of (spark, sf_dir); ``ORACLE_SQL`` has DuckDB SQL for those that
SQL can express. The others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm import (ctw, ftrl, golay_simhash, hamming_topk, lattice_dedup, mixing, packing, periodic_runs,
                          rendezvous, segtree_bpe, template_lines, warc_salvage, whitening)
from loanlake.llm.common import table

SHARDS = 8


def op1_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every hundredth vector, against all vectors."""
    codes = table(spark, sf_dir, "embeddings").select("vec_id", hamming_topk.sign_code("embedding").alias("code"))
    return hamming_topk.top_k(codes, codes.where("vec_id % 100 = 0"), k=10)


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    cache_entries=1_500_000)
    return pieces.select(F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op4_segtree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = segtree_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path,
                                 public_tokenizers.PATTERN)
    digests = encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                             F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return segtree_bpe.decode(digests, path, keep=["doc_id", "n_tokens", "ids_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = rendezvous.shard_records(docs, "doc_id", [1.0] * SHARDS, added_weight=1.0,
                                   columns=["size", "text_crc32"])
    return out.withColumn("law", F.lit("key"))


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"), ftrl.remainder("doc_id", 7) == 2)


def op7_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return template_lines.drop_recurring(docs).select("doc_id", "n_lines", "n_dropped", "text")


def op8_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = ftrl.remainder("doc_id", 5) == 0
    weights = ftrl.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return ftrl.score(docs.withColumn("held_out", held_out), weights, keep=["doc_id", "held_out"])


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_salvage.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"),
                                       payloads=False)
    return records.where("kind = 'record'").select(
        warc_salvage.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc_salvage.page_number("refers_to").alias("refers_to"))


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = golay_simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=4, max_bits=4)
    return groups.select("doc_id", golay_simhash.hex_print("fp").alias("fingerprint"), "component_id")


def op11_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=32)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), weights=(5, 2, 1), cap=3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                        "source", "copies")


def periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; in one document of ten, by the id's CRC-32, the words from the a-th repeat with
    period p, as the contract of op13 states it. Null ids and texts without words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({mixing.WORD})"), F.lit(1))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    numbered = cut.withColumn("n", F.size("words").cast("long"))
    placed = numbered.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                           lambda i: F.get("words", source(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op13_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # the earlier of two runs of equal exponent stays; runs come by start and period
    best = F.expr("""aggregate(runs, cast(null AS struct<start: bigint, length: bigint, period: bigint>), (m, r) ->
        if(m IS NULL OR r.length * m.period > m.length * r.period, r, m))""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    out = periodic_runs.collapse_runs(docs).withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_lattice_dedup, op2_hamming_topk, op3_vector_packing, op4_segtree_bpe, op5_rendezvous,
    op6_context_tree, op7_template_lines, op8_ftrl_toxicity,
    op9_warc_salvage, op10_golay_simhash, op11_polar_whitening, op12_source_mix, op13_synchronised_runs)}

_LINKS = """
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id < b.vec_id
    WHERE list_dot_product(a.u, b.u) >= 0.93"""

_CODES = """
    SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND list_count(list_filter(embedding, lambda x: isfinite(x))) = 64"""

#: Byte by byte with the table of the reflected polynomial 0xEDB88320, built by its rule.
_CRC32 = """
    crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: IF(c % 2 = 1, xor(c // 2, 3988292384), c // 2))) AS t),
    bytes AS (SELECT doc_id, octet_length(encode(COALESCE(text, ''))) + 1 AS size,
        list_transform(regexp_extract_all(hex(encode(COALESCE(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
        FROM documents),
    crc AS (SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(4294967295, b),
        lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS BIGINT) AS text_crc32
        FROM bytes, crc_table)"""

_SCORE = """-ln((('0x' || substr(md5(key || ':' || s), 1, 12))::BIGINT + 0.5) / 281474976710656.0)"""

ORACLE_SQL: dict[str, str] = {
    "op1_lattice_dedup": f"""
        WITH RECURSIVE norm AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0),
        unit AS (
            SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM norm
            WHERE list_count(list_filter(v, lambda x: isfinite(x))) = len(v) AND list_dot_product(v, v) > 0),
        link AS ({_LINKS}),
        both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach(v, r) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT x.b, reach.r FROM reach JOIN both_ways x ON x.a = reach.v WHERE x.b > reach.r),
        part AS (SELECT v AS vec_id, MIN(r) AS component_id FROM reach GROUP BY v)
        SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM part LEFT JOIN (SELECT a AS vec_id, COUNT(*) AS n FROM both_ways GROUP BY a) USING (vec_id)""",
    "op2_hamming_topk": f"""
        WITH codes AS ({_CODES})
        SELECT q.vec_id AS query_id, r.vec_id,
               CAST(list_sum(list_transform(list_zip(q.bits, r.bits), lambda p: (p[1] <> p[2])::INTEGER)) AS INTEGER)
                   AS distance,
               CAST(ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY distance, r.vec_id) AS INTEGER) AS rank
        FROM codes q JOIN codes r ON q.vec_id <> r.vec_id
        WHERE q.vec_id % 100 = 0 QUALIFY rank <= 10""",
    "op5_rendezvous": f"""
        WITH {_CRC32},
        named AS (SELECT *, COALESCE(CAST(doc_id AS VARCHAR), '\\N') AS key FROM crc),
        placed AS (
            SELECT doc_id, size, text_crc32,
                   substr(md5(concat_ws('|', key, size, text_crc32)), 1, 3) AS bucket,
                   list_transform(range(9), lambda s: {_SCORE}) AS scores
            FROM named),
        chosen AS (SELECT *, CAST(list_position(scores[1:8], list_min(scores[1:8])) - 1 AS INTEGER) AS shard,
                          CAST(list_position(scores, list_min(scores)) - 1 AS INTEGER) AS grown_shard FROM placed)
        SELECT doc_id, size, text_crc32, shard, grown_shard, 'key' AS law,
               ROW_NUMBER() OVER (PARTITION BY shard ORDER BY bucket, doc_id, size, text_crc32) - 1 AS slot
        FROM chosen""",
    "op9_warc_salvage": """
        WITH hashed AS (
            SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS h,
                   MIN(page_id) OVER (PARTITION BY sha1(COALESCE(html, ''))) AS first
            FROM pages)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '')
                   AS payload_digest,
               IF(first = page_id, 'response', 'revisit') AS record_type, NULLIF(first, page_id) AS refers_to
        FROM hashed""",
    "op12_source_mix": """
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   md5(concat_ws('|', COALESCE(CAST(doc_id AS VARCHAR), '\\N'), COALESCE(source, '\\N'), COALESCE(text, '\\N'))) AS k
            FROM documents),
        numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k) AS i FROM sized),
        totals AS (
            SELECT source, CAST(SUM(size) AS HUGEINT) AS s,
                   [5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
            FROM sized GROUP BY source),
        -- by cap per weight: a source is held if the price of those before it, all held, exceeds its cap
        judged AS (
            SELECT source, s, w, w * (SUM(s) OVER () - 3 * COALESCE(SUM(s) OVER before, 0))
                       > 3 * s * (SUM(w) OVER () - COALESCE(SUM(w) OVER before, 0)) AS held
            FROM totals WINDOW before AS (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        priced AS (
            SELECT source, CAST(s AS BIGINT) AS source_size,
                   CASE WHEN s = 0 THEN 0 WHEN held THEN CAST(3 * s AS DOUBLE)
                        ELSE CAST(w * (SUM(s) OVER () - 3 * COALESCE(SUM(s) FILTER (held) OVER (), 0)) AS DOUBLE)
                             / CAST(SUM(w) FILTER (NOT held) OVER () AS DOUBLE) END AS target
            FROM judged),
        rated AS (SELECT *, IF(source_size = 0, 0, least(target / source_size, 3.0::DOUBLE)) AS rate FROM priced),
        drawn AS (
            SELECT d.*, p.source_size, p.target, CAST(floor(rate) AS BIGINT)
                   + CAST((('0x' || substr(md5('0:' || k || ':' || i), 1, 12))::BIGINT + 0.5) / 281474976710656.0
                          < rate - floor(rate) AS BIGINT) AS copies
            FROM numbered d JOIN rated p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM drawn""",
}
