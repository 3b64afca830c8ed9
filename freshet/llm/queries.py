"""Queries ``opN_<name>``: every operator on its whole table, reduced to checkable digests."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import chat, decontam, html_text, langid, packing, quality, ranking, secrets, sharding, simhash, substrings, turns, warc
from freshet.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    return placed.select(
        "row.doc_id",
        "size",
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_quality(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    assessed = quality.assess(table(spark, sf_dir, "documents"), quality.trusted(labels))
    return assessed.select("row.doc_id", "quality.*")


@query
def op4_chat(spark, sf_dir):
    trap = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    nodes, places = chat.prefix_tree(turns, tokenizer)
    return chat.read_back(nodes, places, tokenizer)


@query
def op5_html_text(spark, sf_dir):
    texts = table(spark, sf_dir, "pages").select("page_id", "url", html_text.extracted("html").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op6_decontamination(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op9_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark, sf_dir):
    index = warc.archive_and_index(warc.dated(table(spark, sf_dir, "pages")))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


@query
def op11_substrings(spark, sf_dir):
    cut = substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_repair(spark, sf_dir):
    return turns.repair(turns.damaged(table(spark, sf_dir, "conversations")), F.col("present"))


@query
def op13_ranking(spark, sf_dir):
    found = ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _repair_sql() -> str:
    """Damage, faults and the cheapest edits row by row; a state is its cost and audit as one text, and the lines so far."""

    def add(state: str, cost: str, letter: str, line: str = "''") -> str:
        total = f"lpad((left({state}.k, 6)::INT + {cost})::VARCHAR, 6, '0')"
        return f"{{'k': {total} || substr({state}.k, 7) || '{letter}', 't': {state}.t || {line}}}"

    def least(*states: str) -> str:
        return f"list_sort([{', '.join(states)}])[1]"

    def only(test: str, state: str) -> str:
        return f"CASE WHEN {test} THEN {state} ELSE {{'k': '900000', 't': ''}} END"

    def row(state: str, kept: str, role: str) -> tuple[str, str]:
        keep = only(f"free AND r = '{kept}'", add(state, "cut", "K", "chr(10) || role || ':' || text"))
        return keep, only("free", add(state, "2 + cut", "R", f"chr(10) || '{role}:' || text"))

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    to_user = [arc for state in ("s0", "ss", "sa") for arc in row(state, "u", "user")]
    return f"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(
                string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS key
            FROM conversations),
        harmed AS (
            SELECT *, xor(list_reduce(
                list_concat([4294967295::BIGINT], flatten(list_transform(key, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 20 AS harm
            FROM keyed),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) AS again
            FROM harmed WHERE harm <> 0),
        marked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy,
                rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
            FROM damaged),
        placed AS (
            SELECT conv_id, turn, role, text, left(role, 1) AS r,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                CASE WHEN bare = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate'
                    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM marked),
        steps AS (
            SELECT *, fault NOT IN ('blank', 'duplicate') AS free, (fault = 'truncated')::INT AS cut,
                lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed),
        states AS (
            SELECT conv_id, 0::BIGINT AS i, {{'k': '000000', 't': ''}} AS s0, {{'k': '900000', 't': ''}} AS ss,
                {{'k': '000002I', 't': {user}}} AS su, {{'k': '000004II', 't': {user} || {assistant}}} AS sa
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, i, s0, ss, su, {least("sa", add("su", "2", "I", assistant))} AS sa FROM (
                SELECT conv_id, i, s0, ss, sa, {least("su", *(add(s, "2", "I", user) for s in ("s0", "ss", "sa")))} AS su FROM (
                    SELECT states.conv_id, steps.i, {add("s0", "3", "D")} AS s0,
                        {least(add("ss", "3", "D"), row("s0", "s", "user")[0])} AS ss,
                        {least(add("su", "3", "D"), *to_user)} AS su,
                        {least(add("sa", "3", "D"), *row("su", "a", "assistant"))} AS sa
                    FROM states JOIN steps ON states.conv_id IS NOT DISTINCT FROM steps.conv_id AND steps.i = states.i + 1))),
        counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
            FROM steps GROUP BY conv_id),
        ended AS (SELECT conv_id, i, {least("s0", "sa")} AS best FROM states)
        SELECT ended.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, left(best.k, 6)::BIGINT AS cost,
            substr(best.k, 7) AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
        FROM ended LEFT JOIN counted ON ended.conv_id IS NOT DISTINCT FROM counted.conv_id WHERE ended.i = coalesce(n, 0)
    """


ORACLES: dict[str, str] = {
    "op12_repair": _repair_sql(),
    "op4_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(15 + length(role) + length(text) + length(text) - length(replace(replace(text, chr(92), ''), '<', '')))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op10_warc": r"""
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                regexp_replace(url, '#.*$', '') AS url
            FROM pages),
        marked AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS stored
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN stored = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN stored <> page_id THEN stored END AS refers_to,
            array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(url, '^[a-z]+://([^/?]*)', 1), '^www\.', ''), '.')), ',')
                || ')' || CASE WHEN regexp_extract(url, '^[a-z]+://[^/?]*([^?]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-z]+://[^/?]*([^?]*)', 1) END
                || regexp_extract(url, '(\?.+)?$', 1) AS url_key,
            strftime(make_timestamp(1704067200000000 + page_id * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
        FROM marked
    """,
    "op6_decontamination": """
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')
            FROM benchmark),
        widths AS (SELECT DISTINCT least(len(w), 5) AS width FROM words WHERE side = 'b' AND len(w) > 0),
        places AS (
            SELECT side, id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM words, widths
            WHERE len(w) >= width AND (side = 'd' OR width = least(len(w), 5))),
        shingles AS (SELECT DISTINCT side, id, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM places),
        sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'b' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
            FROM shingles d JOIN shingles b ON d.s = b.s AND d.width = b.width WHERE d.side = 'd' AND b.side = 'b' GROUP BY ALL)
        SELECT doc_id, item_id, n_shared, n AS n_shingles, n_shared / n AS containment
        FROM shared JOIN sizes ON id = item_id WHERE 5 * n_shared >= 4 * n
    """,
    "op11_substrings": """
        WITH words AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
        places AS (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
        windows AS (
            SELECT r, doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS s FROM places),
        ranked AS (
            SELECT *, min({'known': doc_id IS NOT NULL, 'doc': coalesce(doc_id, 0), 'i': i}) OVER (PARTITION BY s) AS least FROM windows),
        judged AS (
            SELECT *, s IS NOT NULL AND {'known': doc_id IS NOT NULL, 'doc': coalesce(doc_id, 0), 'i': i} > least AS later FROM ranked),
        covered AS (
            SELECT r, i, word, max(later) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM judged),
        kept AS (
            SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (r)
    """,
    "op13_ranking": """
        WITH terms AS (
            SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
            FROM documents
            UNION ALL
            SELECT 'b', row_number() OVER (), item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')
            FROM benchmark),
        corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM terms WHERE side = 'd' AND len(w) > 0),
        wanted AS (SELECT DISTINCT r, id AS item_id, unnest(w) AS term FROM terms WHERE side = 'b'),
        counts AS (
            SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, id AS doc_id, len(w) AS n, unnest(w) AS term FROM terms WHERE side = 'd')
            GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
            FROM counts, corpus GROUP BY term),
        scored AS (
            SELECT wanted.r, item_id, counts.r AS d, doc_id,
                sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM wanted JOIN counts USING (term) JOIN weights USING (term), corpus GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
}
