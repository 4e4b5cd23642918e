"""Registered queries of the corpus operators, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (divergence, ngram_join, packing, pieces, quality, ranked_search, records, secrets,
                          substrings, token_counts, top_vectors, vectors, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def op1(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op2_packing")
def op2(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2, marks=True)


@query("op3_ngram_join", """
    WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
        '[\\x20\\x09-\\x0D]'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)
        AS g FROM t),
    n AS (SELECT doc_id, count(*) AS n_ngrams, bit_xor(hash(g)) AS h, sum(hash(g)) AS k FROM s GROUP BY doc_id),
    c AS (SELECT *, count(*) OVER (PARTITION BY h, k, n_ngrams) AS copies FROM n),
    i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s AS a JOIN s AS b USING (g)
        WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM i JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
        WHERE n_both >= 0.8e0 * (x.n_ngrams + y.n_ngrams - n_both)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
    k AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a)
    SELECT t.doc_id, coalesce(n_ngrams, 0) AS n_ngrams, coalesce(copies, 1) AS copies,
      (SELECT count(*) FROM l WHERE l.a = t.doc_id) AS n_links, class_id
    FROM t LEFT JOIN c USING (doc_id) JOIN k USING (doc_id)""")
def op3(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_ngrams", "copies", "n_links", "class_id")


@query("op4_substring_dedup", """
    WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
        '[\\x20\\x09-\\x0D]'), lambda x: x <> '') AS w FROM documents),
    e AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM t WHERE len(w) >= 50),
    g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM e),
    d AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM g),
    r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM d WHERE least < doc_id),
    z AS (SELECT doc_id, count(*) AS n_removed, list(j) AS gone FROM r GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
      sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_sort(
        list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x))), lambda x: w[x]) END, ' '))
        AS kept_sha256
    FROM t LEFT JOIN z USING (doc_id)""")
def op4(spark, sf_dir):
    return substrings.judged(table(spark, sf_dir, "documents"))


@query("op5_vector_near_dedup", """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98e0),
    reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id,
      vec_id = component_id AS kept FROM c""")
def op5(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_warc", """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h,
        max(page_id) OVER (PARTITION BY b) AS owner FROM p),
    s AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT)) AS g FROM d)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
      list_aggregate(list_transform(g, lambda x: concat(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 15) & 31), 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 10) & 31), 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 5) & 31), 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (x & 31), 1))), 'string_agg', '') AS payload_digest,
      CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
    FROM s""")
def op6(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


@query("op7_quality_rules", r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]'), lambda x: x <> '') AS w,
        string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
    g AS (SELECT *, list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
        list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]]) AS tri FROM t),
    e AS (SELECT doc_id, unnest(tri) AS tri, unnest(range(len(tri))) AS i FROM g),
    r AS (SELECT doc_id, i FROM e QUALIFY count(*) OVER (PARTITION BY doc_id, tri) > 1),
    c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM r CROSS JOIN (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
    f AS (SELECT g.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(all_lines) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
        FROM g LEFT JOIN c USING (doc_id))
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
      CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
      CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
      n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND word_chars >= 2 * n_words
        AND word_chars <= 20 * n_words AND 100 * n_symbols <= 30 * n_words
        AND (n_dup_lines < 3 OR 100 * n_dup_lines <= 30 * n_lines)
        AND 100 * n_capitals <= 50 * word_chars AS kept
    FROM f""")
def op7(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark, sf_dir):
    return secrets.scanned(table(spark, sf_dir, "documents"))


@query("op9_sentence_pieces")
def op9(spark, sf_dir):
    return pieces.encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op10_token_records")
def op10(spark, sf_dir):
    manifest = records.write_sequences(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0,
                                       marks=True)
    return records.read_sequences(manifest)


@query("op11_ranked_search", r"""
    WITH a AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    d AS (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM a WHERE len(t) > 0),
    s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
    i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    o AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d)
        WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    f AS (SELECT term, CAST(floor(1000e0 * ln(CAST(2 * any_value(nn) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT)
        AS w FROM o CROSS JOIN s GROUP BY term),
    c AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))
        AS BIGINT) AS score FROM o JOIN f USING (term) JOIN i USING (term) CROSS JOIN s GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
      doc_id, score FROM c WHERE score > 0 QUALIFY rank <= 50""")
def op11(spark, sf_dir):
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_top_vectors", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256e0 * CAST(x AS DOUBLE))) AS e
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
        FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
      vec_id, score FROM s QUALIFY rank <= 5""")
def op12(spark, sf_dir):
    return top_vectors.top_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_source_divergence", r"""
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    o AS (SELECT doc, lang, source, unnest(t) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS ln FROM o GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
    v AS (SELECT lang, count(*) AS vv, sum(ln) AS lt FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
    t AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY ALL),
    p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * vv) AS p,
        1 + (CAST(1000000000 AS HUGEINT) * (ln + 5)) // (lt + 5 * vv) AS q
        FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
        LEFT JOIN t USING (lang, source)),
    w AS (SELECT lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p AS a JOIN p AS b USING (lang, term)
        GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
        FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(row_number() OVER (
      PARTITION BY lang, source, part ORDER BY f DESC, encode(item)) AS INTEGER) AS rank
    FROM r QUALIFY part = 'pair' OR rank <= 50""")
def op13(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))
