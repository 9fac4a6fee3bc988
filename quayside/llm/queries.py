"""The registered queries of the operators, each over the whole of its table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    config_packing,
    exact_dedup,
    grid_join,
    language,
    lattice_lm,
    line_dedup,
    main_text,
    pfair_mixing,
    prefix_trie,
    simhash,
    token_output,
    turn_repair,
    warc,
)
from quayside.session import new_run_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """crc32 of the document's id as text, modulo the divisor: it tells which documents teach."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@registered
def op9_exact_dedup(spark, sf_dir):
    """Which documents stay when each text may occur once; the largest doc_id wins."""
    verdicts = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return verdicts.selectExpr("doc_id", "keep_id", "group_size", "kept", "digest AS text_sha256")


@registered
def op7_simhash(spark, sf_dir):
    """Documents whose fingerprints are linked by differences of at most two bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("print")).alias("fingerprint"), "component_id")


@registered
def op1_token_output(spark, sf_dir):
    """All documents packed and written as binary rows, then every segment read back."""
    folder = new_run_folder(spark, "packed")
    token_output.write_packed(table(spark, sf_dir, "documents"), folder)
    return token_output.read_segments(spark, folder)


@registered
def op2_config_packing(spark, sf_dir):
    """All documents as token ids, packed into as few sequences of 2048 as the plan needs."""
    return config_packing.pack(table(spark, sf_dir, "documents"))


@registered
def op3_lattice_lm(spark, sf_dir):
    """The log10 probability of every document, learned from nine tenths of them."""
    found = lattice_lm.score_texts(table(spark, sf_dir, "documents"), remainder(10) != 0)
    return found.withColumn("held_out", F.coalesce(remainder(10) == 0, F.lit(False)))


@registered
def op4_pfair_mixing(spark, sf_dir):
    """Where each document stands when sources are interleaved by the root of their sizes."""
    mixed = pfair_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("source", F.expr("CASE WHEN source_key != '-' THEN substring(source_key, 2) END")).drop(
        "source_key"
    )


@registered
def op5_warc(spark, sf_dir):
    """All pages written as WARC archives, and what is read back from them."""
    folder = new_run_folder(spark, "warc")
    collection = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, collection).drop("archive")


@registered
def op6_grid_order_join(spark, sf_dir):
    """Vectors linked by a cosine of at least 0.9, as components with link counts."""
    return grid_join.near_vectors(table(spark, sf_dir, "embeddings"))


@registered
def op8_language(spark, sf_dir):
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    net = language.fit(docs, remainder(4) != 2)
    answers = language.predict(docs, net)
    return answers.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@registered
def op10_main_text(spark, sf_dir):
    """The article of every page, by the container paths its host's pages agree on."""
    return main_text.extract(table(spark, sf_dir, "pages"))


@registered
def op11_prefix_trie(spark, sf_dir):
    """The prefixes that conversations share after their heads have been taken from others."""
    paths = prefix_trie.numbered_paths(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie.prefix_nodes(prefix_trie.with_shared_heads(paths, 20, 4, head.cast("int")))


@registered
def op12_turn_repair(spark, sf_dir):
    """Conversations damaged by checksum, and the cheapest edits that bring them into order."""
    return turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")))


@registered
def op13_line_dedup(spark, sf_dir):
    """What is left of each document without the lines that ten documents or more share."""
    found = line_dedup.line_verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", exact_dedup.sha256_hex(F.col("kept_text")).alias("kept_sha256"))


# CRC-32 of an ASCII text ``s``, bit by bit; DuckDB has no function for it.
CRC32 = """
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                                 list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_pfair_mixing": """
        WITH RECURSIVE docs AS (
            SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS name,
                   coalesce(length(text), 0) AS chars, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
            FROM documents
        ), roots AS (
            SELECT name, CAST(floor(sqrt(CAST(sum(chars) AS DOUBLE))) AS BIGINT) + 1 AS root FROM docs GROUP BY name
        ), spread AS (
            SELECT name, (1000 - count(*) OVER ()) * root AS due, CAST(sum(root) OVER () AS BIGINT) AS total
            FROM roots
        ), ranked AS (
            SELECT name, 1 + due // total AS whole,
                   row_number() OVER (ORDER BY due % total DESC, name) AS place,
                   sum(1 + due // total) OVER () AS given
            FROM spread
        ), shares AS (
            SELECT name, CAST(whole + CASE WHEN place <= 1000 - given THEN 1 ELSE 0 END AS BIGINT) AS k FROM ranked
        ), sources AS (
            SELECT list(name ORDER BY name) AS names, list(k ORDER BY name) AS ks, count(*) AS n FROM shares
        ), frame(slot, chosen, done) AS (
            SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), [CAST(0 AS BIGINT) FOR x IN ks] FROM sources
            UNION ALL
            SELECT slot + 1, pick.j, [done[j] + CASE WHEN j = pick.j THEN 1 ELSE 0 END FOR j IN range(1, n + 1)]
            FROM (
                SELECT slot, done, n, list_min([
                    {'deadline': ((done[j] + 1) * 1000 + ks[j] - 1) // ks[j], 'j': j}
                    FOR j IN range(1, n + 1)
                    IF done[j] < ks[j] AND done[j] * 1000 // ks[j] <= slot + 1
                ]) AS pick
                FROM frame, sources
                WHERE slot < 999
            )
        ), slots AS (
            SELECT names[chosen] AS name, ks[chosen] AS k, slot,
                   row_number() OVER (PARTITION BY chosen ORDER BY slot) AS i
            FROM frame, sources WHERE slot >= 0
        ), placed AS (
            SELECT *, CAST(sum(chars) OVER (PARTITION BY name ORDER BY digest, doc_id
                           ROWS UNBOUNDED PRECEDING) AS BIGINT) - chars AS start
            FROM docs
        ), turns AS (
            SELECT doc_id, source, name, start, start // 200000 + 1 AS block FROM placed
        )
        SELECT doc_id, source, CAST(s.k AS INTEGER) AS k, block, start,
               (block - 1) // s.k * 1000 + (s.i - 1) * 1000 // s.k AS release,
               (block - 1) // s.k * 1000 + (s.i * 1000 + s.k - 1) // s.k AS deadline,
               (block - 1) // s.k * 1000 + s.slot AS position
        FROM turns t JOIN slots s ON s.name = t.name AND s.i = (t.block - 1) % s.k + 1
    """,
    "op5_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), firsts AS (
            SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                   CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload)
                        ELSE page_id END AS first
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id != first THEN first END AS refers_to
        FROM firsts
    """,
    "op6_grid_order_join": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), usable AS (
            SELECT * FROM vectors
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
        ), reached(a, b) AS (
            SELECT vec_id, vec_id FROM vectors
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
        ), counted AS (
            SELECT a, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, coalesce(max(n), 0) AS n_links, min(reached.b) AS component_id,
               vec_id = min(reached.b) AS kept
        FROM vectors JOIN reached ON reached.a = vec_id LEFT JOIN counted ON counted.a = vec_id
        GROUP BY vec_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_line_dedup": """
        WITH docs AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS n
            FROM documents
        ), lines AS (
            SELECT n, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), common AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT n) >= 10
        ), kept AS (
            SELECT n, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY place) AS text
            FROM keyed WHERE key NOT IN (SELECT key FROM common) GROUP BY n
        )
        SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n_kept, 0) AS n_dropped,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (n)
    """,
    "op11_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, list({{'role': role, 'text': text}} ORDER BY place) AS path
            FROM turns GROUP BY conv_id
        ), headed AS (
            SELECT *, conv_id - conv_id % 20 AS base, ({CRC32}) % 4 AS h FROM own
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.path[1:c.h], []), c.path[c.h + 1:]) AS path
            FROM headed c LEFT JOIN own b ON b.conv_id = c.base
        ), prefixes AS (
            SELECT conv_id, len(path) AS n, unnest(range(len(path) + 1)) AS depth, path FROM rebuilt
        ), nodes AS (
            SELECT path[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends,
                   CASE WHEN depth = 0 THEN 0 ELSE
                       (count(*) - 1) * len(regexp_extract_all(path[1:depth][depth].text, '[^\\x20\\x09-\\x0D]+'))
                   END AS saved
            FROM prefixes GROUP BY 1, 2, path[1:depth][depth].text
        ), linked AS (
            SELECT n.*, p.conv_id AS parent_conv_id
            FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
        ), counted AS (
            SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
        ), tops AS (
            SELECT n.prefix[1:t.d] AS prefix, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
            FROM nodes n LEFT JOIN counted c USING (prefix), LATERAL (SELECT unnest(range(n.depth + 1)) AS d) t
            GROUP BY 1
        )
        SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(c.n, 0) AS n_children,
               t.leaves AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(l.ends) AS ends_sha256
        FROM linked l JOIN tops t USING (prefix) LEFT JOIN counted c USING (prefix)
    """,
    # Forward over the rows: of each role state the cheapest way, its audit and its text.
    "op12_turn_repair": f"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
            FROM conversations
        ), kinds AS (
            SELECT *, ({CRC32}) % 20 AS kind FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds
        ), placed AS (
            SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
            FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN body = '' THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
                   lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
            FROM placed
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), seqs AS (
            SELECT conv_id, list({{'role': role, 'text': text, 'fault': fault}} ORDER BY i) AS turns
            FROM judged GROUP BY conv_id
        ), moves AS (  -- state, the role that it may take next, and the state after it
            SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) m(q, role, q2)
        ), inserts AS (  -- up to two inserted turns in a row; three never pay
            SELECT q, q AS q2, 0 AS cost, '' AS audit, '' AS said FROM (SELECT DISTINCT q FROM moves)
            UNION ALL
            SELECT q, q2, 2, 'I', chr(10) || CASE role WHEN 'u' THEN 'user:' ELSE 'assistant:' END
            FROM moves WHERE role != 's'
            UNION ALL
            SELECT a.q, b.q2, 4, 'II', chr(10) || CASE a.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END
                                     || chr(10) || CASE b.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END
            FROM moves a JOIN moves b ON a.q2 = b.q WHERE a.role != 's' AND b.role != 's'
        ), edits AS (  -- what may become of a row in a state, before the row is known
            SELECT q, 'D' AS edit, q AS q2, NULL AS role FROM (SELECT DISTINCT q FROM moves)
            UNION ALL SELECT q, 'K', q2, role FROM moves
            UNION ALL SELECT q, 'R', q2, role FROM moves WHERE role != 's'
        ), ways(conv_id, i, q, best) AS (
            SELECT conv_id, CAST(0 AS BIGINT), q2, {{'cost': cost, 'audit': audit, 'said': said}}
            FROM seqs, inserts WHERE q = 0
            UNION ALL
            SELECT * FROM (
                SELECT w.conv_id, w.i + 1 AS i, n.q2 AS q, min({{
                    'cost': w.best.cost + n.cost + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                            + CASE WHEN e.edit != 'D' AND coalesce(t.fault, '') = 'truncated' THEN 1 ELSE 0 END,
                    'audit': w.best.audit || e.edit || n.audit,
                    'said': w.best.said || CASE e.edit WHEN 'D' THEN '' ELSE chr(10) || CASE
                                WHEN e.edit = 'K' THEN t.role WHEN e.role = 'u' THEN 'user' ELSE 'assistant' END
                            || ':' || t.text END || n.said}}) AS best
                FROM ways w JOIN seqs s ON w.conv_id IS NOT DISTINCT FROM s.conv_id
                JOIN edits e ON e.q = w.q JOIN inserts n ON n.q = e.q2,
                LATERAL (SELECT s.turns[w.i + 1] AS t)
                WHERE w.i < len(s.turns)
                      AND (e.edit = 'D' OR coalesce(t.fault, '') NOT IN ('blank', 'duplicate'))
                      AND (e.edit != 'K' OR t.role[1] = e.role)
                GROUP BY 1, 2, 3
            )
        ), ends AS (
            SELECT w.conv_id, min(w.best) AS best
            FROM ways w JOIN seqs s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = len(s.turns)
            WHERE w.q IN (0, 3) GROUP BY w.conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(best.said[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
