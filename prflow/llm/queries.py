"""The registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow.llm import (
    conversations, decontaminate, lines, mixing, near_vectors, paragraphs, pii, quality, simhash, substrings, tokens,
    urls, whitening,
)
from prflow.llm.common import table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(make):
    QUERIES[make.__name__] = make
    return make


# The rules of the contract.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = lines.dropped_lines(table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", F.size("dropped").alias("n_dropped"), "dropped")


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    done = pii.pseudonymize(table(spark, folder, "documents"), key="production key comes from a secret store")
    return done.select("doc_id", "text", F.size("replaced").cast("long").alias("n_replaced"))


@query
def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Labels belong to the document whose number is in the path."""
    number = F.regexp_extract(urls.path_of(F.col("url")), r"^/[a-z]+/(\d{1,18})", 1)
    pages = table(spark, folder, "pages").withColumn("label_key", F.when(number != "", number.cast("long")))
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("label_key"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return urls.judge_urls(pages, labels, URL_RULES)


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = paragraphs.repeated_paragraphs(table(spark, folder, "documents"))
    return found.select("doc_id", "start", "end", "class_doc_id", "class_start", "removed")


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "kept", "answered")


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality(table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col(f"measures.{c}").alias(c) for c in counts], "base_failed", "kept")


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, folder, "documents"), width=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def in_turn():
    """Weights 1, 2, 3, repeating over the ranked sources."""
    return F.pmod(F.col("rank") - 1, F.lit(3)) + 1


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), in_turn())
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = near_vectors.near_vectors(table(spark, folder, "embeddings"), similar=0.98)
    return found.select("vec_id", "n_links", "component_id", "kept")


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    done = whitening.whiten(table(spark, folder, "embeddings"), components=8)
    return done.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage; rows that are dropped stay as ``present`` false."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    kind = F.pmod(F.crc32(name), F.lit(20))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", (F.col("kind") != 0).alias("present"),
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


@query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    done = conversations.repair(damaged(table(spark, folder, "conversations")), present=F.col("present"))
    return done.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def _quality_sql() -> str:
    stop = sorted({w for words in quality.STOP_WORDS.values() for w in words})
    listed = ", ".join(f"'{w}'" for w in stop)
    broken = []
    for _, measure, low, high in quality.RULES:
        broken += [f"{measure} < {low}"] if low is not None else []
        broken += [f"{measure} > {high}"] if high is not None else []
    return rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents
    ), windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n
        FROM (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))
    ), repeated AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM windows, (VALUES (0), (1), (2)) o(k) WHERE n > 1 GROUP BY doc_id
    ), counted AS (
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
               len(list_filter(w, lambda x: lower(x) IN ({listed}))) AS stop_words,
               length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
               length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals
        FROM d LEFT JOIN repeated USING (doc_id)
    ), ratios AS (
        SELECT *, word_chars / nullif(n_words, 0) AS mean_word_length, n_symbols / nullif(word_chars, 0) AS symbol_share,
               n_repeat_words / nullif(n_words, 0) AS repeat_share, n_dup_lines / nullif(n_lines, 0) AS dup_line_share,
               capitals / nullif(letters, 0) AS upper_share
        FROM counted
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT ({" OR ".join(f"coalesce({b}, false)" for b in broken)}) AS kept
    FROM ratios
    """


ORACLE_SQL["op7_quality_rules"] = _quality_sql()

# Strings of 50 bytes as hex digits: two for each byte, so a match starts at an
# even place; texts in overlapping pieces. The rest of a text is what no covered place holds.
ORACLE_SQL["op8_suffix_dedup"] = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (
        SELECT doc_id, 1000 * k + q AS p, substr(piece, 2 * q + 1, 100) AS s
        FROM (SELECT doc_id, k, piece, unnest(range(0, len(piece) // 2 - 49)) AS q
              FROM (SELECT doc_id, k, substr(h, 2000 * k + 1, 2098) AS piece
                    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS k FROM d)))
    ), least AS (SELECT s, min(doc_id) AS first FROM starts GROUP BY s HAVING min(doc_id) < max(doc_id)),
    covered AS (SELECT doc_id, p FROM starts JOIN least USING (s) WHERE doc_id > first),
    edges AS (
        SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM covered
    ), runs AS (
        SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM edges
    ), spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM runs GROUP BY doc_id, run),
    ordered AS (
        SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
    ), parts AS (
        SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
               string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
        FROM ordered JOIN d USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN parts USING (doc_id)
"""
