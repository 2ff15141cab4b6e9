"""The registered queries opN_<name>, one per operator, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.llm import (
    caps, chunks, coder, fim, merkle, minhash, mixing, packing, pieces, quality, template, urls, winnow,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return coder.round_trip(spark, docs, vocabulary("byte_bpe_50k.json"), 2, with_ids=False)


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op3_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template.main_text(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op4_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = caps.near_vectors(spark, table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(spark, table(spark, sf_dir, "documents"))


@query
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they read back as the text."""
    docs, path = table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    found = pieces.decoded(pieces.encoded(docs, path), path)
    return found.select(
        F.col("id").alias("doc_id"), "n_ids", "ids_crc32", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(spark, docs, vocabulary("word_bpe_49k.json"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.remove_repeats(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.char_length("text").alias("n_chars"), "n_spans", "removed_bytes")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(spark, docs, labels)


@query
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(spark, table(spark, sf_dir, "documents"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document proved; those with an even checksum claim a tampered text."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    key = F.col("doc_id").cast("string").cast("binary")
    tampered = F.when(F.crc32(key) % 2 == 0, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))
    claimed = merkle.leaf(*[F.col(f) for f in fields[:-1]], tampered)
    found = merkle.manifest(
        spark, table(spark, sf_dir, "documents"), fields, kept={"claimed": claimed}
    )
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.proof_text(F.col("proof"))).alias("proof_sha256"),
        merkle.folded(F.col("claimed"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transformed(table(spark, sf_dir, "documents"))

    def sha256(text) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(F.col("output")).alias("output_sha256"),
        sha256(fim.restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


# The rules that the query judges by.
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


@query
def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judged(spark, table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


SQL["op2_minhash"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), roots AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)
"""

SQL["op4_caps"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), roots AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN degree USING (vec_id)
"""

# The number of a row tells rows of equal ids apart.
SQL["op11_merkle"] = r"""
WITH RECURSIVE given AS (
    SELECT row_number() OVER () AS r, doc_id, source, source IS NOT NULL AS has_source, text,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
        list_reduce(
            list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda c, b: list_reduce(
                list_prepend(xor(c, b), range(8)),
                lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
    FROM documents
), hashed AS (
    SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown
    FROM given
), leaves AS (
    SELECT r, doc_id, coalesce('=' || source, '-') AS g, leaf,
        sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS claimed,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n
    FROM hashed
), nodes AS (
    SELECT 0 AS lvl, g, pos, leaf AS digest, n FROM leaves
    UNION ALL
    SELECT lvl + 1, g, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY lvl, g, pos // 3, n
), heights AS (
    SELECT g, max(lvl) AS height FROM nodes GROUP BY g
), tops AS (
    SELECT 0 AS lvl, g, row_number() OVER (ORDER BY g) - 1 AS pos, digest, count(*) OVER () AS n
    FROM nodes JOIN heights USING (g) WHERE lvl = height
), upper AS (
    SELECT lvl, pos, digest, n FROM tops
    UNION ALL
    SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM upper WHERE n > 1 GROUP BY lvl, pos // 3, n
), whole AS (
    SELECT max(lvl) AS height, max_by(digest, lvl) AS root FROM upper
), steps AS (  -- the node that stands for each document at each level, and its place
    SELECT r, lvl AS step, lvl, leaves.g AS g, leaves.pos // CAST(pow(3, lvl) AS BIGINT) AS place
    FROM leaves JOIN heights USING (g), range(64) t(lvl) WHERE lvl < height
    UNION ALL
    SELECT r, h.height + t.lvl, t.lvl, NULL, tops.pos // CAST(pow(3, t.lvl) AS BIGINT)
    FROM leaves JOIN tops USING (g) JOIN heights h USING (g), whole, range(64) t(lvl) WHERE t.lvl < whole.height
), every_node AS (
    SELECT g, lvl, pos, digest FROM nodes UNION ALL SELECT NULL, lvl, pos, digest FROM upper
), flanks AS (
    SELECT r, step,
        coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < place), '') AS before,
        coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > place), '') AS behind
    FROM steps LEFT JOIN every_node e
        ON e.lvl = steps.lvl AND coalesce(e.g, '') = coalesce(steps.g, '') AND e.pos // 3 = place // 3
    GROUP BY r, step
), folds AS (
    SELECT r, 0 AS step, claimed AS h FROM leaves
    UNION ALL
    SELECT r, step + 1, sha256(before || h || behind) FROM folds JOIN flanks USING (r, step)
), ends AS (
    SELECT r, max_by(h, step) AS folded_root FROM folds GROUP BY r
), proofs AS (
    SELECT r, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256 FROM flanks GROUP BY r
)
SELECT doc_id, leaf, tops.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM leaves JOIN tops USING (g) JOIN ends USING (r) LEFT JOIN proofs USING (r), whole
"""

SQL["op12_middle"] = r"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
    FROM documents
), units AS (
    SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u,
        list_transform(range(4), lambda i: CAST('0x' || hash[8 * i + 1:8 * i + 8] AS BIGINT)) AS h
    FROM given
), cuts AS (
    SELECT *, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
        greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h[3] % 100 >= 100 THEN 'plain'
            WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM units
), pieces AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
    FROM cuts
)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM pieces
"""

# Of the links it follows absolute ones in elements that are written plainly.
SQL["op13_urls"] = r"""
WITH RECURSIVE given AS (
    SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), targets AS (
    SELECT r, unnest(
        regexp_extract_all(html, '(?i)<link[^>]*rel="canonical"[^>]*href="([^"]*://[^"]*)"', 1)
        || regexp_extract_all(html, '(?i)<meta[^>]*http-equiv="refresh"[^>]*content="[^"]*url=([^"]*://[^"]*)"', 1)
    ) AS url
    FROM given
), addresses AS (
    SELECT r, true AS own, url FROM given UNION ALL SELECT r, false, url FROM targets
), cut AS (
    SELECT r, own, CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS rest,
        contains(url, '://') AS valid
    FROM addresses
), places AS (
    SELECT r, own, valid, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS query
    FROM cut
), rules(verdict, rhost, rpath) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), decided AS (
    SELECT p.*, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS address,
        (SELECT max({'size': length(rhost || rpath), 'host': length(rhost), 'allows': verdict = 'allow', 'rule': rhost || rpath})
         FROM rules WHERE (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)) AS best
    FROM places p
), links AS (
    SELECT DISTINCT a.r AS a, b.r AS b
    FROM decided a JOIN decided b ON a.valid AND b.valid AND a.address = b.address AND a.r <> b.r
    WHERE a.address IN (SELECT address FROM decided WHERE r IN (SELECT r FROM targets))
), reach AS (
    SELECT r AS a, r AS b FROM targets
    UNION
    SELECT links.b, reach.b FROM reach JOIN links ON reach.a = links.a
), blocked AS (
    SELECT DISTINCT reach.b AS start FROM reach JOIN decided d ON d.r = reach.a WHERE NOT d.best.allows
), caught AS (
    SELECT DISTINCT reach.a AS r FROM reach JOIN blocked ON reach.b = blocked.start
)
SELECT page_id, host, path, best.rule AS rule,
    CASE WHEN best.allows THEN 'allow' WHEN best IS NOT NULL OR caught.r IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM decided d JOIN given USING (r) LEFT JOIN caught USING (r) WHERE own
"""
