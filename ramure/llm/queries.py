"""The registered queries of these operators: each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ramure.llm import (
    decontaminate, near_dedup, packing, prefix_trie, quality_classifier, quality_rules, secrets,
    structure_repair, token_counts, token_ids, url_filter, vector_tree, warc,
)
from ramure.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def _spans_sql(kind: str, rank: int, pattern: str, kept: str) -> str:
    """SQL: matches of a kind with their places, found by adding up the lengths of what lies between and of the matches."""
    return f"""
        SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(m) AS stop FROM (
            SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS start
            FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{pattern}')) AS m,
                         unnest(list_slice(regexp_split_to_array(t, '{pattern}'), 1, len(regexp_extract_all(t, '{pattern}')))) AS gap,
                         unnest(range(len(regexp_extract_all(t, '{pattern}')))) AS i
                  FROM texts)) WHERE {kept}"""


def _secrets_sql() -> str:
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = f"{rule.head}{rule.body}+".replace("'", "''")
        if rule.head:  # the head matches once, so what is left of the match is the body
            head = rule.head.replace("'", "''")
            kept = f"length(m) - length(regexp_extract(m, '^(?:{head})')) >= {rule.least}"
        else:
            kept = f"length(m) >= {rule.least}"
        parts.append(_spans_sql(rule.kind, rank, pattern, kept))
    spans = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank)"
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{rule.kind}'), 0) AS n_{rule.kind}" for rule in secrets.BASE_RULES)
    base = f"rank < {len(secrets.BASE_RULES)}"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({' UNION ALL '.join(parts)}),
        found AS (SELECT doc_id, {counts}, {spans} FILTER ({base}) AS base, {spans} AS spans FROM spans GROUP BY doc_id)
        SELECT doc_id, {', '.join(f'coalesce(n_{rule.kind}, 0)::BIGINT AS n_{rule.kind}' for rule in secrets.BASE_RULES)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN found USING (doc_id)"""


@query(_secrets_sql())
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and a digest of the base kinds, and all spans."""
    docs = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = [rule.kind for rule in secrets.BASE_RULES]
    base = F.filter("secrets", lambda span: span["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", *map(count, kinds), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


_LINKS_SQL = """
    WITH RECURSIVE texts AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM texts WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y
                          ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
        JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
    reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT id, b FROM reach JOIN links ON a = other)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, low AS component_id, d.doc_id = low AS kept
    FROM documents d JOIN (SELECT id, min(other) AS low FROM reach GROUP BY id) ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


@query(_LINKS_SQL)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near duplicates that it belongs to."""
    linked = near_dedup.link_documents(table(spark, sf_dir, "documents"), near_dedup.Similarity(shingle=3, percent=85))
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and the learned list's verdict of every document."""
    labels = table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0")
    judged, _ = quality_rules.quality_rules(table(spark, sf_dir, "documents"), labels)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy longest-match pieces of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, with the items and the place and size of the overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model that has seen no label of held-out documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality_classifier.with_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to binary files in the order of documents, and read from them."""
    read = token_ids.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of 2048 tokens."""
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("""
    SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
           CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM (SELECT page_id, h, CASE WHEN octet_length(encode(h)) >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first
          FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of normalised archives, read back from them."""
    read = warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _urls_sql() -> str:
    """SQL: the rules, all sets of tokens of labelled rows counted with and without the verdict, and the best rule that fits."""
    def fits(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    rules = sorted(url_filter.RULES, key=lambda rule: -len(rule[1] + rule[2]))
    rule = " ".join(f"WHEN {fits(host, path)} THEN '{host}{path}'" for _, host, path in rules)
    known = " ".join(f"WHEN rule = '{host}{path}' THEN '{verdict}'" for verdict, host, path in rules)
    named = " || ".join(
        f"list_transform(list_filter({values}, lambda v: v <> ''), lambda v: '{prefix}' || v)" for prefix, values in (
            ("top:", "list_slice(labels, -1, -1)"), ("label:", "others"),
            ("part:", "flatten(list_transform(list_filter(others, lambda v: contains(v, '-')), lambda v: string_split(v, '-')))"),
            ("segment:", "string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/')"),
            ("query:", "string_split(regexp_extract(u, '[?]([^#]*)', 1), '&')")))
    return f"""
        WITH RECURSIVE parsed AS (
            SELECT page_id, u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                         'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
        ruled AS (SELECT *, CASE {known} END AS known FROM (SELECT *, CASE {rule} END AS rule FROM parsed)),
        labelled AS (SELECT *, list_slice(labels, 1, len(labels) - 1) AS others
                     FROM (SELECT *, list_filter(string_split(host, '.'), lambda v: v <> '') AS labels FROM ruled)),
        tokens AS (SELECT page_id, known, unnest(list_distinct({named})) AS token FROM labelled),
        size AS (SELECT count(*) AS rows FROM ruled WHERE known IS NOT NULL),
        sets AS (
            SELECT page_id, known, [token] AS items, token AS last FROM tokens WHERE known IS NOT NULL
            UNION ALL SELECT s.page_id, s.known, list_append(s.items, t.token), t.token FROM sets s JOIN tokens t ON t.page_id = s.page_id AND t.token > s.last),
        counted AS (SELECT items, known, count(*) AS n, sum(count(*)) OVER (PARTITION BY items) AS covered FROM sets GROUP BY items, known),
        mined AS (SELECT *, n / covered::DOUBLE AS confidence FROM counted, size
                  WHERE n >= ceil(rows * greatest(0.01, 9.5 / greatest(rows, 1))) AND n / covered::DOUBLE >= 0.8),
        own AS (SELECT page_id, list(token) AS tokens FROM tokens WHERE known IS NULL GROUP BY page_id),
        judged AS (SELECT page_id, arg_max(mined.known, (confidence, n, mined.known)) AS verdict FROM own, mined
                   WHERE list_has_all(tokens, items) GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(known, verdict, 'allow') AS verdict FROM ruled LEFT JOIN judged USING (page_id)"""


@query(_urls_sql())
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


#: SQL: the table of CRC-32 from its polynomial, and the CRC-32 of a text of ASCII characters where the table's row is joined.
_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i) AS v
            FROM range(256) r(i)))"""


def _crc_sql(text: str) -> str:
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT), "
            "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))")


def _trie_sql() -> str:
    """SQL: prefixes named by chained hashes; each node counts what its members' smallest ones find below."""
    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT conv_id, conv_id - conv_id % 100 AS first, {_crc_sql('conv_id::VARCHAR')} % 6 AS h
                FROM (SELECT DISTINCT conv_id FROM own), crc_table),
        rebuilt AS (
            SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM (
                SELECT i.conv_id, 0 AS part, o.pos, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.first AND o.pos <= i.h
                UNION ALL SELECT o.conv_id, 1, o.pos, o.role, o.text FROM own o JOIN ids i USING (conv_id) WHERE o.pos > i.h)),
        way AS (
            SELECT conv_id, 0::BIGINT AS depth, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS size FROM ids
            UNION ALL
            SELECT r.conv_id, r.depth, md5(w.node || length(role) || ':' || role || text), w.node, length(text)
            FROM way w JOIN rebuilt r ON r.conv_id = w.conv_id AND r.depth = w.depth + 1),
        last AS (SELECT conv_id, max(depth) AS turns, arg_max(node, depth) AS node FROM way GROUP BY conv_id),
        nodes AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id,
                         count(*) AS n_convs FROM way GROUP BY node),
        kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        below AS (SELECT w.node, sum((u.n_convs - 1) * u.size) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
                  FROM nodes u JOIN way w ON w.conv_id = u.conv_id AND w.depth <= u.depth LEFT JOIN kids k ON k.node = u.node GROUP BY w.node),
        ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM last GROUP BY node)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
               leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node JOIN below b ON b.node = n.node
        LEFT JOIN ends e ON e.node = n.node"""


@query(_trie_sql())
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt so that they share beginnings."""
    turns = stored(prefix_trie.digested(table(spark, sf_dir, "conversations")), "digested")
    nodes, ends = prefix_trie.trie(prefix_trie.share_starts(turns), turns.select("conv_id").distinct())
    listed = prefix_trie.joined_digests(ends, "node", "conv_id")
    return nodes.join(listed, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def _repair_sql() -> str:
    """SQL: turns after damage, their faults, and the cheapest edits by states of the order of roles, turn by turn."""
    blank = "NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]')"
    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        drawn AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc_sql("(conv_id::VARCHAR || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fate
            FROM conversations, crc_table WHERE conv_id IS NOT NULL),
        turns AS (
            SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
            FROM drawn WHERE fate <> 0),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM turns),
        judged AS (
            SELECT *, CASE WHEN {blank} THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
                   substr(role, 1, 1) AS initial FROM numbered),
        facts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
            FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM judged) GROUP BY conv_id),
        inserted(a, b, n, added) AS (VALUES
            (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, 'user:' || chr(10)), (1, 2, 1, 'user:' || chr(10)),
            (3, 2, 1, 'user:' || chr(10)), (2, 3, 1, 'assistant:' || chr(10)), (0, 3, 2, 'user:' || chr(10) || 'assistant:' || chr(10)),
            (1, 3, 2, 'user:' || chr(10) || 'assistant:' || chr(10))),
        moves(a, b, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
        edits AS (
            SELECT conv_id, i, s.a, s.a AS b, 2 AS cost, 'D' AS letter, '' AS added FROM judged, (VALUES (0), (1), (2), (3)) s(a)
            UNION ALL
            SELECT conv_id, i, a, b, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', role || ':' || text || chr(10)
            FROM judged JOIN moves USING (initial) WHERE fault IN ('none', 'truncated')
            UNION ALL
            SELECT conv_id, i, a, b, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
                   CASE m.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text || chr(10)
            FROM judged, moves m WHERE fault IN ('none', 'truncated') AND m.initial <> 's'),
        ways AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0, 'audit': '', 'kept': ''}} AS best FROM facts
            UNION ALL
            SELECT conv_id, i, state, min(way) FROM (
                SELECT e.conv_id, e.i, e.b AS state, {{'cost': best.cost + 5 * s.n + e.cost, 'audit': best.audit || repeat('I', s.n) || e.letter,
                                                       'kept': best.kept || s.added || e.added}} AS way
                FROM ways w JOIN inserted s ON s.a = w.state JOIN edits e ON e.conv_id = w.conv_id AND e.i = w.i + 1 AND e.a = s.b)
            GROUP BY conv_id, i, state),
        ended AS (
            SELECT conv_id, min({{'cost': best.cost + 5 * s.n, 'audit': best.audit || repeat('I', s.n), 'kept': best.kept || s.added}}) AS best
            FROM ways JOIN facts USING (conv_id) JOIN inserted s ON s.a = state AND s.b IN (0, 3) WHERE i = facts.n GROUP BY conv_id)
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.kept, length(best.kept) - 1), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM drawn) LEFT JOIN facts USING (conv_id) LEFT JOIN ended USING (conv_id)"""


@query(_repair_sql())
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every conversation after damage, the cheapest edits that mend its order of roles, and a digest of what they leave."""
    conversations = table(spark, sf_dir, "conversations")
    ids = conversations.where("conv_id IS NOT NULL").select("conv_id").distinct()
    reports, repaired = structure_repair.repair_structure(structure_repair.damaged(conversations), ids)
    return (reports.join(structure_repair.digests(repaired), "conv_id", "left")
            .select(*reports.columns, F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


@query()
def op12_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one, among all others."""
    return vector_tree.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
