"""The registered queries of this subpackage: each applies one operator with
production parameters to its whole table. ORACLE holds DuckDB SQL for those
that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    decontamination,
    divergence,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    packing,
    quality,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)
from quarry.llm.common import held_out, staged
from quarry.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        quality.quality_score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        toxicity.toxicity_score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def packed_digests(docs: DataFrame) -> DataFrame:
    """Packed pieces with the CRC of their ids in place of the ids."""
    pieces = packing.cut_documents(docs, tokenizer_path())
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(staged(narrow, "pieces"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.page_digests(warc.read_archive(spark, path))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit_whitening(whitening.fit_list(vectors))
    rows = whitening.whiten(vectors, model).select(
        "vec_id", F.posexplode("whitened").alias("at", "whitened"), F.col("deviation").try_cast("long").alias("deviation")
    )
    shares = model.explained.tolist() if model else []
    explained = F.array(*[F.lit(x) for x in shares]).cast("array<double>")
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(~language_id.held_out("doc_id")))
    found = language_id.predict_language(model, F.col("text"))
    rows = docs.select("doc_id", language_id.held_out("doc_id").alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_language_id": op12_language_id,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, p.n, q.n
            HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
        reach AS (
            SELECT doc_id AS x, doc_id AS r FROM documents
            UNION
            SELECT links.y, reach.r FROM reach JOIN links ON links.x = reach.x)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
        JOIN (SELECT x, min(r) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id""",
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i - 1 AS i, l[i] AS line
            FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
                  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE coalesce(text, '') <> ''))),
        filled AS (
            SELECT *, lead(i) OVER d AS b, lead(line) OVER d AS next
            FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
            WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        windows AS (
            SELECT doc_id, i AS a, b,
                   row_number() OVER (PARTITION BY line || chr(10) || next ORDER BY doc_id, i) AS nth
            FROM filled WHERE b IS NOT NULL),
        gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM windows WHERE nth > 1),
        kept AS (
            SELECT k.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
                   coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (g.i IS NULL), '') AS body
            FROM lines k LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.i = k.i
            GROUP BY k.doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(k.body, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "op6_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM payloads
            WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100""",
    "op9_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents),
        ranked AS (
            SELECT doc_id, body,
                   first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size
            FROM rows)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM ranked""",
    "op10_decontamination": r"""
        WITH docs AS (
            SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
        benches AS (
            SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
        wanted AS (
            SELECT DISTINCT id, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT id, w, least(len(w), 5) AS k, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
                  FROM benches WHERE len(w) > 0)),
        items AS (SELECT id, k, s, count(*) OVER (PARTITION BY id) AS n FROM wanted),
        shingles AS (
            SELECT DISTINCT id, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                  FROM docs, (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k))
        SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n)::INT AS n_shingles, count(*)::INT AS n_shared
        FROM shingles d JOIN items i ON d.s = i.s AND d.k = i.k
        GROUP BY d.id, i.id HAVING count(*) * 4 >= any_value(i.n) * 3""",
    "op13_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        tokens AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
        kept AS (
            SELECT lang, term, count(*)::HUGEINT AS n FROM tokens
            GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
        counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n
            FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
        groups AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
            FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source)
            GROUP BY g.lang, g.source),
        cells AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
                   1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
            FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        found AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
            FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
            LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM cells WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        WHERE part = 'pair' OR rank <= 10""",
}
