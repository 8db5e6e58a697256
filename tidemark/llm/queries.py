"""The registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    conversations,
    divergence,
    extraction,
    language,
    lines,
    packing,
    quality,
    sharding,
    simhash,
    tokencounts,
    topk,
    toxicity,
)
from tidemark.llm.common import remainder, table, vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those with another remainder than 2."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(remainder("doc_id", 4) != 2))
    held_out = (remainder("doc_id", 4) == 2).alias("held_out")
    return language.predict(docs, model, keep=("doc_id",)).select("doc_id", held_out, "lang_pred", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of `embeddings` for every twentieth, by integer inner product."""
    rows = table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").alias("id"), topk.quantized(F.col("embedding"), 64.0).alias("vector"))
    return topk.search(vectors, vectors.filter(F.col("id") % 20 == 0), 20)


OP2_SQL = """
WITH vectors AS (
    SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.id AS query_id, c.id AS vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.id <> c.id WHERE q.id % 20 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of every document, and whether it keeps all rules."""
    judged = quality.judge(quality.counts(table(spark, sf_dir, "documents"), keep=("doc_id",)))
    failed = quality.base_failed()
    return judged.select(
        "doc_id",
        *quality.COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.size("failed") == 0)).alias("kept"),
    )


# Windows of three words by their first place, joined with the window text's count.
OP3_SQL = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT r, doc_id, text,
           regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(0, 3) AS t(k) GROUP BY r
), counted AS (
    SELECT doc_id, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           len(list_filter(words, lambda w: list_contains(<STOP_WORDS>, w))) AS n_stop_words,
           len(lines) AS n_lines
    FROM split LEFT JOIN covered USING (r)
), based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND <RULES> AS kept FROM based
"""


def rules_as_sql(rules: tuple[quality.Rule, ...] = quality.RULES) -> str:
    parts = [f"{r.ratio} >= {r.least}" for r in rules if r.least is not None]
    parts += [f"{r.ratio} <= {r.most}" for r in rules if r.most is not None]
    return " AND ".join(f"({p})" for p in parts)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    pieces = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, 2048, order=("doc_id", "piece", "ids_crc32"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels with another remainder than 0."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels)
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    scored = toxicity.score(docs, model, keep=("doc_id",))
    return scored.select("doc_id", held_out, "score", "predicted")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document over three-word shingles, and its component."""
    prints = simhash.fingerprints(table(spark, sf_dir, "documents"), 3, ("doc_id",))
    found = simhash.grouped(prints, 3)
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that five or more sources have."""
    cleaned = lines.clean(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_chars", "n_removed")


OP7_SQL = """
WITH occurrences AS (
    SELECT doc_id, source, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
), spread AS (
    SELECT line, min(doc_id) AS keeper FROM occurrences WHERE line <> ''
    GROUP BY line HAVING count(DISTINCT source) >= <SITES>
), numbered AS (
    SELECT row_number() OVER () AS r, doc_id, text, n_chars FROM documents
), parts AS (
    SELECT r, doc_id, unnest(string_split(text, chr(10))) AS part,
           unnest(range(0, len(string_split(text, chr(10))))) AS i FROM numbered
), judged AS (
    SELECT r, part, i, line IS NOT NULL AND p.doc_id IS DISTINCT FROM keeper AS removed
    FROM parts p LEFT JOIN spread ON line = trim(part, ' ' || chr(9) || chr(11) || chr(12) || chr(13))
), rebuilt AS (
    SELECT r, string_agg(part, chr(10) ORDER BY i) FILTER (NOT removed) AS kept, count(*) FILTER (removed) AS n
    FROM judged GROUP BY r
)
SELECT doc_id, CASE WHEN n > 0 THEN coalesce(kept, '') ELSE text END AS text,
       CASE WHEN n > 0 THEN length(coalesce(kept, '')) ELSE n_chars END AS n_chars, coalesce(n, 0) AS n_removed
FROM numbered LEFT JOIN rebuilt USING (r)
"""

def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, keep=("doc_id",))
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


SHARD_BYTES = 1 << 20


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the shard of at most a mebibyte of text that it goes to."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        sharding.row_hash("doc_id", "text").alias("hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
    )
    return sharding.shard(rows, SHARD_BYTES).select("doc_id", "bytes", "shard", "depth", "page")


# Copies of a row are beyond it: it numbers no pages, since ids are distinct.
OP9_SQL = """
WITH hashed AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) AS bytes,
           ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 15))::BIGINT AS hash
    FROM documents
), sizes AS (
    SELECT d, hash >> (60 - d) AS prefix, sum(bytes) AS total, min(hash) = max(hash) AS alone
    FROM hashed, range(0, 61) AS t(d) GROUP BY ALL
), depths AS (
    SELECT r, min(sizes.d) AS depth FROM hashed, sizes
    WHERE prefix = hash >> (60 - d) AND (total <= <LIMIT> OR alone) GROUP BY r
)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(hash >> (60 - depth)), 60, '0'), depth) END AS shard,
       depth::INTEGER AS depth, 0::BIGINT AS page
FROM hashed JOIN depths USING (r)
"""


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH texts AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), occurrences AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts
), terms AS (
    SELECT lang, term, count(*) AS n FROM occurrences GROUP BY ALL HAVING count(DISTINCT r) >= 3
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN terms USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, sum(n)::HUGEINT AS lang_total, count(*)::HUGEINT AS kept FROM terms GROUP BY lang
), groups AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (total + kept) AS p,
           1 + 1000000000::HUGEINT * (t.n + 1) // (lang_total + kept) AS q
    FROM groups g JOIN terms t ON t.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(v, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS v
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
    ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), above AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM above
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations, one row for each node."""
    turns = conversations.numbered(table(spark, sf_dir, "conversations"))
    return conversations.trie(conversations.rebuilt(turns))


# The cyclic redundancy check is worked out bit by bit.
OP12_SQL = """
WITH ids AS (
    SELECT DISTINCT conv_id, encode(conv_id::VARCHAR) AS b FROM conversations WHERE conv_id IS NOT NULL
), bits AS (
    SELECT conv_id, list_transform(range(0, 8 * octet_length(b)),
        lambda i: (('0x' || substr(hex(b), (2 * (i // 8) + 1)::INTEGER, 2))::BIGINT >> (i % 8)) & 1) AS bits FROM ids
), asked AS (
    SELECT conv_id, conv_id - conv_id % 20 AS first_id, xor(list_reduce(list_prepend(4294967295, bits),
        lambda c, x: xor(c >> 1, CASE WHEN (xor(c, x) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 4 AS h FROM bits
), numbered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, role, text
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), turns AS (
    SELECT a.conv_id, 0 AS part, n, role, text FROM asked a JOIN numbered t ON t.conv_id = first_id AND n <= h
    UNION ALL
    SELECT conv_id, 1, n, role, text FROM asked JOIN numbered USING (conv_id) WHERE n > h
), rebuilt AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, n) FILTER (role IS NOT NULL) AS turns
    FROM ids LEFT JOIN turns USING (conv_id) GROUP BY conv_id
), prefixes AS (
    SELECT conv_id, len(coalesce(turns, [])) AS size, d, sha256(list_slice(turns, 1, d)::VARCHAR) AS key,
           sha256(list_slice(turns, 1, d - 1)::VARCHAR) AS parent, turns[d].text AS text
    FROM (SELECT conv_id, coalesce(turns, []) AS turns, unnest(range(0, len(coalesce(turns, [])) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, key, min(conv_id) AS conv_id, CASE WHEN d > 0 THEN any_value(parent) END AS parent, count(*) AS n_convs,
           (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')), 0) AS saving,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = size), '')) AS ends_sha256
    FROM prefixes GROUP BY d, key
), above AS (
    SELECT DISTINCT a.d, a.key, b.d AS below_d, b.key AS below
    FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.d <= b.d
), children AS (
    SELECT d - 1 AS d, parent AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), totals AS (
    SELECT a.d, a.key, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(b.saving)::BIGINT AS saved_tokens
    FROM above a JOIN nodes b ON b.d = below_d AND b.key = below LEFT JOIN children c ON c.d = below_d AND c.key = below GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.d = n.d AND t.key = n.key LEFT JOIN children c ON c.d = n.d AND c.key = n.key
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = n.parent
"""


TOKEN_LIMIT = 512


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens are over a limit."""
    counted = tokencounts.prefix_counts(
        table(spark, sf_dir, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")),
        vocabulary("byte_bpe_50k.json"),
        keep=("doc_id", "n_bytes"),
    )
    n_tokens = tokencounts.tokens().cast("long")
    return counted.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > TOKEN_LIMIT).alias("over_limit"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_sharding": op9_sharding,
    "op10_html_extraction": op10_html_extraction,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_top_k": OP2_SQL,
    "op3_quality_rules": OP3_SQL.replace("<STOP_WORDS>", str(list(quality.STOP_WORDS))).replace("<RULES>", rules_as_sql()),
    "op7_line_dedup": OP7_SQL.replace("<SITES>", "5"),
    "op9_sharding": OP9_SQL.replace("<LIMIT>", str(SHARD_BYTES)),
    "op11_source_divergence": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
}
