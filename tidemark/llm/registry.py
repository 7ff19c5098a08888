"""Queries of this subpackage over the test tables, and SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    exact_dedup,
    line_quality,
    main_text,
    mixing,
    ngram_join,
    quality_model,
    ranked_search,
    relative_lz,
    spelling,
    suffix_dedup,
    token_counts,
    warc,
    winnowing,
)
from tidemark.session import scratch_path, use_utc, with_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_package(use_utc(spark)).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.remove_passages(table(spark, sf_dir, "documents")).drop("spans")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    streams, archives = scratch_path(spark, "warc-streams"), scratch_path(spark, "warc")
    warc.write_archives(pages, streams)
    warc.normalise_archives(spark, streams, archives)
    records = warc.read_archives(spark, archives)
    # A record counts only where the sidecar index has it, at its place.
    index = warc.read_index(spark, archives).withColumnsRenamed({"page_id": "index_page_id", "length": "index_length"})
    found = records.join(index, ["archive", "place"])
    checked = found.where(F.col("length") == F.col("index_length"))
    return checked.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, _ = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, weights)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(table(spark, sf_dir, "pages"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_strings(table(spark, sf_dir, "documents")).drop("spans")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_relative_lz,
        op2_warc,
        op3_ngram_join,
        op4_mixing,
        op5_line_quality,
        op6_quality_model,
        op7_main_text,
        op8_winnowing,
        op9_suffix_dedup,
        op10_token_counts,
        op11_ranked_search,
        op12_spelling,
        op13_exact_dedup,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op1_relative_lz": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
        ), windows AS (
            SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d WHERE len(ws) >= 50)
        ), later AS (
            SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first_id FROM windows)
            WHERE first_id < doc_id
        ), removed AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place FROM later
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
            FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM d)
            ANTI JOIN removed USING (doc_id, place)
            GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id) USING (doc_id)
    """,
    "op2_warc": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM rows
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
                 AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM firsts
    """,
    "op3_ngram_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS s FROM d WHERE len(ws) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
            WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION
            SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other
        )
        SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(other) AS component_id
        FROM d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, sizes.n
    """,
    "op4_mixing": mixing.ORACLE_SQL.format(documents="documents"),
    "op8_winnowing": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS ws FROM documents
        ), items AS (
            SELECT CAST(item_id AS VARCHAR) AS item, ws, least(10, len(ws)) AS n
            FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS ws FROM benchmark) WHERE len(ws) > 0
        ), sought AS (
            SELECT DISTINCT item, n, array_to_string(ws[s:s + n - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS s FROM items)
        ), windows AS (
            SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS g
            FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
                  FROM d, (SELECT DISTINCT n FROM items) WHERE len(ws) >= n)
        ), hits AS (
            SELECT doc_id, n, s, item FROM windows JOIN sought USING (n, g)
        ), hit_words AS (
            SELECT doc_id, count(*) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id
        ), hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op9_suffix_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits,
                   octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents
        ), slices AS (
            SELECT doc_id, n_bytes, a, substr(digits, 2 * a + 1, 2 * (256 + 49)) AS digits
            FROM (SELECT *, unnest(range(0, n_bytes, 256)) AS a FROM d)
        ), windows AS (
            SELECT doc_id, a + o + 1 AS s, md5(substr(digits, 2 * o + 1, 100)) AS h
            FROM (SELECT *, unnest(range(0, least(256, n_bytes - a - 49))) AS o FROM slices)
        ), later AS (
            SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first_id FROM windows)
            WHERE first_id < doc_id
        ), removed AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place FROM later
        ), kept AS (
            SELECT doc_id, string_agg(digits, '' ORDER BY place) AS digits
            FROM (SELECT doc_id, substr(digits, 2 * o + 1, 2) AS digits, a + o + 1 AS place
                  FROM (SELECT *, unnest(range(0, least(256, n_bytes - a))) AS o FROM slices))
            ANTI JOIN removed USING (doc_id, place)
            GROUP BY doc_id
        ), counts AS (
            SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS DISTINCT FROM place - 1) AS n_spans
            FROM (SELECT *, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM removed) GROUP BY doc_id
        )
        SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.digits, ''))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
    """,
    "op11_ranked_search": f"""
        WITH terms AS (
            SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents) GROUP BY ALL
        ), lengths AS (
            SELECT doc_id, sum(tf) AS n FROM terms GROUP BY doc_id
        ), totals AS (
            SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM terms GROUP BY term), totals
        ), items AS (
            SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark
        ), scores AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * all_docs) // all_terms))))) AS BIGINT) AS score
            FROM items JOIN weights USING (term) JOIN terms USING (term) JOIN lengths USING (doc_id), totals
            GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
        WHERE rank <= 10
    """,
    # CRC-32 byte by byte from its table of 256 remainders; near words by what is left without one code point.
    "op12_spelling": f"""
        WITH RECURSIVE remainders AS (
            SELECT list(list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8],
                                    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
            FROM (SELECT unnest(range(CAST(0 AS BIGINT), 256)) AS b)
        ), runs AS (
            SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS digits
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
            GROUP BY ALL
        ), hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, len(digits), 2), lambda i: CAST('0x' || substr(digits, i + 1, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
            FROM runs, remainders
        ), counted AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                                 ELSE run END AS word FROM hashed)
            GROUP BY word
        ), words AS (
            SELECT * FROM counted WHERE length(word) >= 6 AND n >= 5
        ), less AS (
            SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS part
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)
        ), near AS (
            SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.p = b.p AND a.part = b.part AND a.word <> b.word
            UNION
            SELECT a.word, b.word FROM less a JOIN words b ON a.part = b.word
            UNION
            SELECT b.word, a.word FROM less a JOIN words b ON a.part = b.word
        ), best AS (
            SELECT x, count(*) AS n_near, arg_min(y, (-n, y)) AS y, max(n) AS n
            FROM near JOIN words ON words.word = y GROUP BY x
        ), forms AS (
            SELECT word, words.n, CASE WHEN best.n >= 5 * words.n THEN y END AS form,
                   CASE WHEN best.n >= 5 * words.n THEN best.n END AS form_n, coalesce(n_near, 0) AS n_near
            FROM words LEFT JOIN best ON x = word
        ), chains AS (
            SELECT word, word AS root, form FROM forms
            UNION ALL
            SELECT chains.word, chains.form, forms.form FROM chains JOIN forms ON forms.word = chains.form
        )
        SELECT forms.word, forms.n, forms.form, forms.form_n, chains.root, forms.n_near
        FROM forms JOIN chains ON chains.word = forms.word AND chains.form IS NULL
    """,
    "op13_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW w AS (PARTITION BY t)
    """,
}
