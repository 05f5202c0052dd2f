"""The queries opN_<name> over the whole tables, and their oracle texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.llm import decontaminate, exact, jaccard, linededup, negatives, packing, pages, phrases, quality, sharding, substrings, superminhash, toxicity
from estate.llm.ngrams import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """The place of the word-level vocabulary; it is a parameter of the packing operator."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def quality_grade() -> Column:
    """Ratings of `labels`: 0 poor, 1 good but toxic, 2 good and clean."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of `docs` with expected_grade and tail, by a model fitted on labelled rows of the documents."""
    model = quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quality_grade(), grades=3)
    return quality.score_quality(docs, model)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_scores(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), "expected_grade", F.element_at("tail", 1).alias("p_at_least_1"),
        F.element_at("tail", 2).alias("p_at_least_2"), quality.selected(1).alias("selected"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer(), capacity=4096, end_id=1)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = linededup.drop_frequent_lines(docs, min_docs=10, min_chars=1)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", "n_chars")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=50, digest=True)
    return rows.withColumnRenamed("kept", "kept_sha256")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), window=10)
    add = lambda a, b: a + b
    hit = F.aggregate(F.zip_with("span_start", "span_end", lambda a, b: b - a), F.lit(0).cast("long"), add)
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("span_start") > 0).alias("contaminated"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"), percent=80, shingle=5)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digests = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = sharding.shard_rows(digests, shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), support=100, first=2000)


def op12_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85, shingle=5)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_toxicity, op3_packing, op4_line_dedup, op5_html_extraction, op6_substring_dedup, op7_decontamination, op8_jaccard_join, op9_exact_dedup, op10_sharding, op11_phrases, op12_near_dedup, op13_hard_negatives)}
ORACLES = {
    "op4_line_dedup": """
WITH l AS (SELECT doc_id, rowid AS r, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)),
  k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r, doc_id""",
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op11_phrases": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
  g AS (SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase FROM w, range(1, 6) t(k)),
  f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
  n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
  c AS (SELECT lang, phrase, f AS a, ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
  s AS (SELECT c.lang, c.phrase, a, cut, h.f AS l, t.f AS r, n, CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
    FROM c JOIN n USING (lang) JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[1:cut], ' ') JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.ws[cut + 1:], ' ')),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  o AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.f = b.a AND f.phrase <> b.phrase AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a, v b WHERE a.vec_id % 100 = 0),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5""",
}
