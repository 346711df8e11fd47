"""Registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.llm import bpe, credentials, kneserney, langid, lines, phrases, quotes, simhash, topk, triemodel, whitening, wumanber
from augury.llm.minhash import near_duplicates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The radius is searched for every document whose id is divisible by 50, against all documents."""
    return simhash.likeness(table(spark, sf_dir, "documents"), queries=F.col("doc_id") % 50 == 0)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """Digest columns of encoded documents (row.doc_id, ids, the bytes they decode to, and more columns that are passed on)."""
    return encoded.select(
        "row.doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_split: tokens that end within a character, which the next one shares."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, pattern, with_split=True, keep=["doc_id"], with_bytes=True)
    return digests(encoded, "n_split")


def op5_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = lines.without_boilerplate(pages, lines.page_host(F.col("url")), lines.page_text(F.col("html")), keep=["page_id"])
    return found.select("row.page_id", "host", "n_lines", "n_dropped", F.col("clean").alias("text"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.credentials(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, credentials.KINDS))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"),
    )


def op7_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wumanber.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    model = triemodel.fit(docs.where(~held_out()))
    found = triemodel.score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    found = langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def quality(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Judged documents; those that a label calls good, and none calls bad or toxic, are the trusted ones."""
    marks = labels.groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return kneserney.judged(docs, marks.where("good"), keep=keep, crossed=True)


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality(docs, table(spark, sf_dir, "labels"), keep=["doc_id", "lang"]).select("row.doc_id", "row.lang", "n_symbols", "perplexity", "threshold", "slack", "accepted")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where the exact sum passes 64 bits; deviation_exact holds up to 38 digits."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = found.select("row.vec_id", "n", "deviation", "eigenvalues", "trace", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.when(F.col("trace") > 0, F.get("eigenvalues", F.col("at")) / F.col("trace"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
        explained.alias("explained"), "identity_error", F.col("deviation").alias("deviation_exact"),
    )


def op12_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("cut")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_quote_threads": op2_quote_threads,
    "op3_simhash": op3_simhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_site_lines": op5_site_lines,
    "op6_secret_scan": op6_secret_scan,
    "op7_wu_manber": op7_wu_manber,
    "op8_trie_scores": op8_trie_scores,
    "op9_language_id": op9_language_id,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_whitening": op11_whitening,
    "op12_threshold_topk": op12_threshold_topk,
    "op13_phrase_graph": op13_phrase_graph,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op12_threshold_topk": """
        WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
            FROM x q JOIN x c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
    """,
    "op13_phrase_graph": rf"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
        grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS g
            FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
        f AS (SELECT lang, k, g, count(*)::HUGEINT AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
        kept AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (
            SELECT 1 FROM f b WHERE b.lang = f.lang AND b.k > f.k AND contains(' ' || b.g || ' ', ' ' || f.g || ' ') AND 100 * b.c >= 100 * f.c)),
        cuts AS (SELECT *, string_split(g, ' ') AS w, unnest(range(1, k)) AS j FROM kept),
        scored AS (SELECT c.lang, c.g, c.c AS a, x.c AS l, y.c AS r, n, j, (1000 * c.c * n) // (x.c * y.c) AS score FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.g = array_to_string(w[1:j], ' ') JOIN f y ON y.lang = c.lang AND y.g = array_to_string(w[j+1:], ' ')
            JOIN totals t ON t.lang = c.lang),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank, g AS phrase,
            a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM lowest QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) <= 2000
    """,
    "op1_minhash": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
            FROM words
        ), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        items AS (SELECT doc_id, unnest(s) AS x FROM sets),
        shared AS (
            SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM items p JOIN items q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS r FROM documents
            UNION
            SELECT links.b AS a, reach.r FROM reach JOIN links ON links.a = reach.a
        ), least AS (SELECT a, min(r) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON a = doc_id
    """,
    "op7_wu_manber": rf"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), item_words AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS x
            FROM (SELECT item_id, w, least(10, len(w)) AS k FROM item_words WHERE len(w) > 0)
        ), places AS (
            SELECT doc_id, w, len(w) AS n, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
        ), found AS (
            SELECT doc_id, i, p.k, item_id FROM places p JOIN windows x ON x.k = p.k AND x.x = array_to_string(w[i:i+p.k-1], ' ')
        ), hit AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id
        ), listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    # Its own constants: a fifth of the pages of a host, and the block elements.
    "op5_site_lines": r"""
        WITH shown AS (
            SELECT page_id, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
                regexp_replace(regexp_replace(regexp_replace(html,
                    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'),
                    '(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>', chr(10), 'g'),
                    '<[^>]*>', '', 'g') AS text
            FROM pages
        ), parts AS (SELECT *, string_split(text, chr(10)) AS l, row_number() OVER () AS r FROM shown),
        lines AS (
            SELECT r, host, i, l[i] AS line, trim(l[i], ' ' || chr(9) || chr(13)) AS k FROM (SELECT r, host, l, unnest(range(1, len(l) + 1)) AS i FROM parts)
        ), totals AS (SELECT host, count(*) AS total FROM parts WHERE text IS NOT NULL GROUP BY host),
        shares AS (
            SELECT n.host, k, n / total AS share FROM (SELECT host, k, count(DISTINCT r) AS n FROM lines WHERE k <> '' GROUP BY host, k) n
            JOIN totals t ON t.host IS NOT DISTINCT FROM n.host
        ), marked AS (
            SELECT r, i, line, x.k, coalesce(share > 0.2, false) AS gone FROM lines x LEFT JOIN shares s ON s.host IS NOT DISTINCT FROM x.host AND s.k = x.k
        ), summed AS (
            SELECT r, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
            FROM marked GROUP BY r
        )
        SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
        FROM parts LEFT JOIN summed USING (r)
    """,
}
