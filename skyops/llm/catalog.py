"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.llm import (
    chat, decontaminate, fill_in_middle, katz, line_dedup, mixing, prefix_trie, quality, simhash, token_counts, url_rules, warc,
    weighted_sampling,
)
from skyops.session import workspace

Query = Callable[[SparkSession, str], DataFrame]

# Public vocabulary; a parameter of the operator, never part of this repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "n_lines", "n_dropped", "text")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), n=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.katz_scores(read(spark, sf_dir, "documents"), held_out)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "warc-archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path)
    stored_here = F.col("payload").isNotNull()
    return records.select(
        "page_id",
        F.when(stored_here, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored_here, F.sha2("payload", 256)).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), PIECES)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.measured(docs, quality.fit_lines(docs, read(spark, sf_dir, "labels")))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_rules")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mask as text: start+length of each span."""
    rendered = chat.perspectives(read(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("+", m["start"].cast("string"), m["length"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compare_with_next(read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    again = fill_in_middle.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(again, 256).alias("restored_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(read(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_katz": op4_katz,
    "op5_warc": op5_warc,
    "op6_token_counts": op6_token_counts,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality": op8_quality,
    "op9_url_rules": op9_url_rules,
    "op10_chat": op10_chat,
    "op11_fingerprints": op11_fingerprints,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_prefix_trie": op13_prefix_trie,
}

_LINES = r"""
raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no FROM raw),
w AS (SELECT doc_id, line_no, line, list_filter(string_split_regex(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
e AS (SELECT doc_id, line_no, ws, array_to_string(ws, ' ') AS norm, len(ws) AS n FROM w WHERE len(ws) >= 1),
f AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, line_no) AS copy FROM e),
d AS (SELECT * FROM f WHERE copy = 1 AND n >= 5),
v AS (SELECT doc_id, line_no, i, array_to_string(ws[1:i - 1] || ws[i + 1:n], ' ') AS rest
 FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d) x),
s AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY rest, i ORDER BY doc_id, line_no) AS k FROM v),
o AS (SELECT v.doc_id AS a_id, v.line_no AS a_no, d.doc_id AS b_id, d.line_no AS b_no FROM v JOIN d ON v.rest = d.norm),
gone AS (
 SELECT doc_id, line_no FROM f WHERE copy > 1 UNION SELECT doc_id, line_no FROM s WHERE k > 1
 UNION SELECT a_id, a_no FROM o WHERE b_id < a_id OR b_id = a_id AND b_no < a_no
 UNION SELECT b_id, b_no FROM o WHERE a_id < b_id OR a_id = b_id AND a_no < b_no)
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH {_LINES}, k AS (
            SELECT l.doc_id, count(g.doc_id) AS n_dropped,
                string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.doc_id IS NULL) AS kept
            FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id
        )
        SELECT raw.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
            CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
        FROM raw LEFT JOIN k ON raw.doc_id = k.doc_id
    """,
    "op10_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<\|') AS speaker,
                replace(coalesce(text, ''), '<|', '<\|') AS body FROM conversations
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) - 1 AS rank FROM t
        ), s AS (
            SELECT conv_id, rank, rank // 256 AS stretch, speaker, body || '<|end|>' || chr(10) AS body FROM r
        ), p AS (
            SELECT DISTINCT conv_id, speaker AS me FROM s
        ), j AS (
            SELECT s.*, me, speaker = me AS own,
                CASE WHEN speaker = me THEN '<|assistant|>' ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
            FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
        ), a AS (
            SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, me ORDER BY rank) - length(body) AS offs FROM j
        )
        SELECT conv_id, stretch, me AS speaker, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
            string_agg(head || body, '' ORDER BY rank) AS rendered,
            coalesce(string_agg(offs::BIGINT::VARCHAR || '+' || length(body)::VARCHAR, ',' ORDER BY rank) FILTER (WHERE own), '') AS mask
        FROM a GROUP BY conv_id, stretch, me
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op12_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), u AS (
            SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
                ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
                ('0x' || h[25:32])::BIGINT AS h4 FROM d
        ), c AS (
            SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                    THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
        ), p AS (
            SELECT *, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:b], '') AS mid, array_to_string(us[b + 1:n], '') AS suf FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
        FROM p
    """,
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
            FROM conversations WHERE conv_id IS NOT NULL
        ), s AS (
            SELECT conv_id, count(*) AS n, conv_id::VARCHAR AS dec FROM t GROUP BY conv_id
        ), c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(8 * length(dec)), lambda i: (ascii(dec[i // 8 + 1]) >> (i % 8)::INT) & 1)),
                lambda a, b: xor(a >> 1, (xor(a, b) & 1) * 3988292384))) % 6 AS h FROM s
        ), e AS (
            SELECT c.*, least(h, coalesce(n, 0)) AS lent FROM c LEFT JOIN s ON c.base = s.conv_id
        ), r AS (
            SELECT e.conv_id, k - h + lent AS depth, role, text FROM e JOIN t ON e.conv_id = t.conv_id WHERE k > h
            UNION ALL SELECT e.conv_id, k, role, text FROM e JOIN t ON e.base = t.conv_id WHERE k <= h
        ), p AS (
            SELECT conv_id, depth, text, sha256(string_agg(sha256(length(role) || ':' || role || text), '' ORDER BY depth)
                OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
            UNION ALL SELECT conv_id, 0, '', '' FROM c
        ), q AS (
            SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS at_end, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM p
        ), v AS (
            SELECT key, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * length(any_value(text)) AS weight, count(*) = count(*) FILTER (WHERE at_end) AS leaf,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256
            FROM q GROUP BY key
        ), k AS (
            SELECT parent AS key, count(*) AS n_children FROM v WHERE parent IS NOT NULL GROUP BY parent
        ), x AS (
            SELECT q.key, sum(weight) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
            FROM v JOIN q ON q.conv_id = v.conv_id AND q.depth <= v.depth GROUP BY q.key
        )
        SELECT v.conv_id, v.depth, o.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
            saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
        FROM v JOIN x ON v.key = x.key LEFT JOIN k ON v.key = k.key LEFT JOIN v o ON v.parent = o.key
    """,
}
