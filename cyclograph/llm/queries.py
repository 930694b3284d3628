"""Registered queries of the pipeline operators, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cyclograph.llm import chat_format, decontamination, jaccard_join, language_id, mixing, pii, quality_classifier, quality_rules, sharding, substring_dedup, token_alignment, url_filter, whitening
from cyclograph.llm.words import small_batches
from cyclograph.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    extra = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionAll(spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string"))
    return chat_format.read_back(chat_format.format_conversations(turns), in_order=True)


SQL["op1_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *,
    CASE role WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'system' THEN 12
      ELSE 18 + length(regexp_replace(role, '(\\|###|</turn>|</role>)', '\\\1', 'g')) END
    + CASE
        WHEN NOT regexp_matches(text, '###|</turn>|</role>|\\\\|\\$') THEN length(text)
        WHEN NOT regexp_matches(text, '\\\\|\\###|\\</turn>|\\</role>|\\$')
          THEN length(regexp_replace(text, '(###|</turn>|</role>)', '\\\1', 'g'))
        ELSE length(regexp_replace(text, '(\\|###|</turn>|</role>)', '\\\1', 'g'))
      END + 8 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the documents that aren't held out."""
    documents = table(spark, folder, "documents")
    kept_back = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(documents.filter(~kept_back & F.col("doc_id").isNotNull()))
    return language_id.predict(documents.select("doc_id", kept_back.alias("held_out"), "text"), model).drop("text")


@query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.with_spans(table(spark, folder, "documents").select("doc_id", "text")))


URL_RULES = (
    ("net/", url_filter.BLOCK),
    ("example.net/en/", url_filter.ALLOW),
    ("example.com/de/", url_filter.BLOCK),
    ("org/fr/", url_filter.ALLOW),
)


@query
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES).drop("url")


SQL["op7_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules (rule, rule_host, rule_path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), numbered AS (SELECT *, row_number() OVER () AS id FROM parts),
fits AS (
  SELECT n.id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM numbered n JOIN rules r
    ON (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host)) AND starts_with(n.path, r.rule_path)
  GROUP BY n.id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM numbered LEFT JOIN fits USING (id)
"""


@query
def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What every document shares with the benchmark."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_words",
        F.size("hit_words").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(found).alias("contaminated"),
    )


SQL["op10_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)
), hits AS (SELECT DISTINCT doc_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, phrase)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes."""
    placed = sharding.shard(table(spark, folder, "documents").select("doc_id", "text"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes from every document."""
    documents = table(spark, folder, "documents").select("doc_id", "source", mixing.count_words("text").alias("size"))
    mixed = mixing.mix(materialize(documents, "mix-documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality features of every document and whether it is kept."""
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "stratum", F.array_join("broken", ",").alias("broken"),
    )


@query
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard_join.join_texts(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


SQL["op3_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 9 * c >= 4 * (x.n + y.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, r.class_id, coalesce(l.n_links, 0) AS n_links
FROM documents d JOIN (SELECT a, min(b) AS class_id FROM reach GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) l ON l.a = d.doc_id
"""


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document once its repeated passages are gone."""
    cleaned = substring_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL["op5_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS p
  FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (s)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN p IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string(
    [w[x] FOR x IN range(1, len(w) + 1) IF NOT list_contains(p, x)], ' '), '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


LEAST_QUALITY = 0.3


@query
def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document, learned from the labels of documents that aren't held out."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    kept_back = quality_classifier.held_out(F.col("doc_id"))
    network = quality_classifier.fit(documents, labels.filter(~kept_back))
    scored = quality_classifier.predict(documents.select("doc_id", kept_back.alias("held_out"), "text"), network)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"))


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on up to four whitened components."""
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"), components=4)
    explained = F.array(*[F.lit(e) for e in found.explained]).cast("array<double>")
    return found.rows.select("vec_id", F.col("n_fit").alias("n"), "deviation", F.posexplode("whitened")).select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        "n",
        "deviation",
        F.col("col").alias("whitened"),
        F.get(explained, F.col("pos")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )


TOKENIZERS = "/opt/tokenizers"


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = token_alignment.align(documents, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, folder)
