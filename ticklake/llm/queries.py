"""The registered queries of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    best_fit,
    bpe_stream,
    euler_trie,
    exact_grace,
    html_consensus,
    license_rules,
    line_variants,
    masked_lm,
    phrase_parsing,
    simhash_pivots,
    spherical_cells,
    toxicity_trees,
    warc_archives,
)
from ticklake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def byte_bpe(path: str | None = None) -> str:
    """The JSON of a public byte-level BPE tokenizer; read by the driver, sent with the tasks."""
    import public_tokenizers

    return bpe_stream.read_definition(path or public_tokenizers.path("byte_bpe_50k.json"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_pivots.groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_grace.exact_groups(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), byte_bpe())


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.licenses(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.packing(table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical_cells.linked_vectors(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archives.page_records(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_variants.dropped_lines(table(spark, sf_dir, "documents")).drop("whole")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_trees.scored(docs, toxicity_trees.fit(docs, table(spark, sf_dir, "labels")))


def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.scored(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return euler_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_parsing.collocations(table(spark, sf_dir, "documents"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.main_texts(table(spark, sf_dir, "pages"))


_QUERIES: tuple[Query, ...] = (
    op1_simhash,
    op2_licenses,
    op3_packing,
    op4_embeddings,
    op5_warc,
    op6_exact_dedup,
    op7_bpe,
    op8_line_dedup,
    op9_toxicity,
    op10_masked_lm,
    op11_prefix_trie,
    op12_collocations,
    op13_html_text,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": """
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       (((('0x' || substr(sha1(coalesce(html, '')), 5 * (i // 4)::INT + 1, 5))::INT
                          >> (5 * (3 - i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
                   CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
            FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))""",
        "op6_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op11_prefix_trie": """
            WITH convs AS (
                SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                                     ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
                FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
            ), shared AS (  -- the CRC-32 of the id's digits, bit by bit
                SELECT *, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, c:
                    list_reduce(range(8)::BIGINT[], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, c)), 4294967295::BIGINT),
                    4294967295) % 6 AS h
                FROM convs
            ), rebuilt AS (
                SELECT c.conv_id, coalesce(list_slice(b.turns, 1, c.h), []) || list_slice(c.turns, c.h + 1, len(c.turns)) AS turns
                FROM shared c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100
            ), prefixes AS (
                SELECT conv_id, depth, list_slice(turns, 1, depth) AS key, len(turns) = depth AS ended
                FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
            ), nodes AS (
                SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                       sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
                FROM prefixes GROUP BY key, depth
            ), placed AS (
                SELECT v.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children,
                       CASE WHEN v.depth = 0 THEN 0 ELSE (v.n_convs - 1) * length(v.key[v.depth].text) END AS saved
                FROM nodes v LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.key = list_slice(v.key, 1, v.depth - 1)
                LEFT JOIN (SELECT list_slice(key, 1, depth - 1) AS key, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL) c
                ON c.key = v.key AND c.depth = v.depth
            ), sums AS (
                SELECT key, depth, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
                FROM (SELECT list_slice(v.key, 1, up) AS key, up AS depth, (n_children = 0)::BIGINT AS leaf, saved
                      FROM (SELECT *, unnest(range(depth + 1)) AS up FROM placed) v) GROUP BY ALL
            )
            SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
            FROM placed JOIN sums USING (key, depth)""",
        "op12_collocations": r"""
            WITH pieces AS (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents
            ), worded AS (
                SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
            ), placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM worded
            ), counts AS (
                SELECT lang, size, array_to_string(words[pos:pos + size - 1], ' ') AS phrase, count(*) AS f
                FROM placed CROSS JOIN (SELECT unnest([1, 2, 3]) AS size) WHERE pos + size - 1 <= len(words) GROUP BY ALL
            ), candidates AS (
                SELECT lang, phrase, string_split(phrase, ' ') AS words, f AS a FROM counts WHERE size > 1 AND f >= 10
            ), cuts AS (
                SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
                       (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
                FROM (SELECT *, unnest(range(1, len(words))) AS k FROM candidates) c
                JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[:k], ' ')
                JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
            ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
            ), longer AS (
                SELECT lang, array_to_string(words[pos:pos + 1], ' ') AS phrase, a
                FROM (SELECT *, unnest([1, 2]) AS pos FROM candidates WHERE len(words) = 3)
            )
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
                   (SELECT sum(f)::BIGINT FROM counts t WHERE t.size = 1 AND t.lang = b.lang) AS n, score
            FROM best b
            WHERE NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = b.lang AND longer.phrase = b.phrase AND 100 * longer.a >= 50 * b.a)
            QUALIFY rank <= 2000""",
        "op8_line_dedup": r"""
            WITH parts AS (
                SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL
            ), lines AS (
                SELECT DISTINCT doc_id, line_no, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
                FROM (SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line FROM parts)
            ), placed AS (
                SELECT {'d': doc_id, 'l': line_no} AS own, words, array_to_string(words, ' ') AS line,
                       first_value({'d': doc_id, 'l': line_no}) OVER (PARTITION BY words ORDER BY doc_id, line_no) AS head
                FROM lines WHERE len(words) > 0
            ), heads AS (SELECT own, words, line FROM placed WHERE own = head
            ), variants AS (
                SELECT own, place, array_to_string(words[1:place - 1] || words[place + 1:], ' ') AS line
                FROM (SELECT own, words, unnest(range(1, len(words) + 1)) AS place FROM heads WHERE len(words) >= 8)
            ), near AS (
                SELECT a.own, b.own AS head FROM variants a JOIN variants b ON a.line = b.line AND a.place = b.place
                UNION ALL SELECT a.own, b.own FROM variants a JOIN heads b ON a.line = b.line
                UNION ALL SELECT b.own, a.own FROM variants a JOIN heads b ON a.line = b.line
            )
            SELECT own.d AS doc_id, own.l AS line_no, head.d AS first_doc_id, head.l AS first_line_no, edits
            FROM (SELECT own, head, 0 AS edits FROM placed WHERE own <> head
                  UNION ALL SELECT own, min(head), 1 FROM near WHERE head < own GROUP BY own)""",
    }
