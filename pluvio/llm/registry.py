"""The named queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pluvio.llm import (
    fill_middle, fingerprints, graph_search, html_extract, importance, line_dedup, mixing, ngram_join, packing, quality, sharding, simhash,
    toxicity,
)
from pluvio.llm.common import held_out, on_workers, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.learning_rows())
    scored = quality.scored(docs.select("doc_id", "text"), model)
    fold = held_out(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"), threshold=75)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = line_dedup.drop_lines(docs, site="source", ratio=0.05, min_pages=5)
    return kept.select("doc_id", "source", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sized(table(spark, sf_dir, "documents"))
    plan = mixing.plan_mixture(rows, cycle=(3, 1, 2), budget=1.5, max_epochs=2.0)
    taken = F.col("_repeats") * F.col("size")
    return mixing.with_repeats(rows.select("doc_id", "source", "size"), plan).select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"), "source"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learning_rows())
    scored = toxicity.scored(docs.select("doc_id", "text"), model)
    fold = held_out(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.transform(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(back, 256)}
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[c.alias(name) for name, c in digests.items()])


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: on_workers(f)
    for f in (
        op1_quality, op2_ngram_join, op3_line_dedup, op4_html_extract, op5_packing,
        op6_graph_search, op7_fingerprints, op8_sharding, op9_mixing, op10_toxicity,
        op11_importance, op12_fill_middle, op13_simhash,
    )
}

ORACLE: dict[str, str] = {
    "op2_ngram_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
          FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
          FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
          SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON e.x = r.other),
        components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN components g ON g.doc_id = d.doc_id""",
    "op3_line_dedup": r"""
        WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
        totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
        lines AS (
          SELECT DISTINCT source, text, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
          FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
        often AS (
          SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
          WHERE l.line <> '' GROUP BY l.source, l.line, t.total HAVING count(*) >= 5 AND count(*) > 0.05 * t.total),
        dropped AS (SELECT source, list(line) AS lines FROM often GROUP BY source),
        cut AS (
          SELECT d.doc_id, d.source, d.text, string_split(d.text, chr(10)) AS lines,
                 list_filter(string_split(d.text, chr(10)), lambda x: NOT coalesce(list_contains(b.lines,
                     regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), false)) AS kept
          FROM documents d LEFT JOIN dropped b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, source, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text,
               coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped
        FROM cut""",
    "op9_mixing": r"""
        WITH rows AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                 md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
          FROM documents),
        sources AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
          FROM rows GROUP BY source),
        caps AS (SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM sources),
        levels AS (
          SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM caps WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
        targets AS (
          SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap
                 ELSE weight * max(CASE WHEN cap > level * weight THEN level END) OVER () END AS target
          FROM levels),
        plan AS (
          SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
        ordered AS (
          SELECT r.doc_id, r.source, r.size, source_size, target, whole, target - whole * source_size AS rest,
                 sum(size) OVER (PARTITION BY r.source ORDER BY key) AS upto, sum(size) OVER (PARTITION BY r.source, key) AS unit
          FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target, source,
               CAST(size * (whole + CASE WHEN rest > 0 AND upto - unit + unit / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM ordered""",
    # CRC-32 by the step of each byte, on distinct words; the table of steps follows from the polynomial.
    "op11_importance": r"""
        WITH steps AS (
          SELECT list(step ORDER BY byte) AS step FROM (
            SELECT byte, list_reduce(list_prepend(byte, range(8)),
                     lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
            FROM (SELECT unnest(range(256)) AS byte))),
        texts AS (
          SELECT TRUE AS own, doc_id, text FROM documents UNION ALL SELECT FALSE, NULL, text FROM benchmark),
        listed AS (
          SELECT row_number() OVER () AS r, own, doc_id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
          FROM texts),
        used AS (SELECT r, own, unnest(w) AS word FROM listed),
        hashed AS (
          SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                     list_transform(range(1, len(hex(word)) + 1, 2), lambda i: CAST('0x' || hex(word)[i:i + 1] AS BIGINT))),
                     lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
          FROM (SELECT DISTINCT word FROM used), steps),
        counted AS (
          SELECT r, bucket, count(*) AS n, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
          FROM used JOIN hashed USING (word) GROUP BY r, bucket),
        sums AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM counted GROUP BY bucket),
        gains AS (
          SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
          FROM sums),
        weights AS (SELECT r, sum(n * gain) AS weight FROM counted JOIN gains USING (bucket) GROUP BY r),
        scored AS (
          SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                 CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
                   AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
          FROM listed LEFT JOIN weights USING (r) WHERE own),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                 count(*) FILTER (n_features >= 20) OVER () AS eligible
          FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
        FROM placed""",
    "op12_fill_middle": r"""
        WITH tokens AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                 list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
          FROM documents),
        cuts AS (
          SELECT *, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a, greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
          FROM tokens),
        parts AS (
          SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix
          FROM cuts),
        outputs AS (
          SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
          FROM parts),
        marked AS (
          SELECT *, instr(output, CASE form WHEN 'psm' THEN '<S>' ELSE '<P>' END) AS second, instr(output, '<M>') AS third FROM outputs)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN output
                 WHEN 'psm' THEN output[4:second - 1] || output[third + 3:] || output[second + 3:third - 1]
                 ELSE output[second + 3:third - 1] || output[third + 3:] || output[4:second - 1] END) AS restored_sha256
        FROM marked""",
}
