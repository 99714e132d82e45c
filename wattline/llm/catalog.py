"""Registered queries of the text operators and, where SQL can say it, their SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, exact_dedup, language, line_dedup, merkle, mixing, near_dedup, neighbours, prefix_trie, token_counts, token_files, toxicity, url_filter
from wattline.llm.common import table
from wattline.session import shared_folder


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the class of its near copies."""
    return near_dedup.near_classes(table(spark, folder, "documents"))


RANKS, PATTERN = "byte_bpe_50k.tiktoken", public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again, as counts and digests."""
    docs, path = table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path(RANKS)
    encoded = bpe.encode_and_decode(docs, path, PATTERN)
    return encoded.select(
        "doc_id",
        bpe.n_tokens(F.col("token_ids")).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the number of lines it loses and the digest of what is left."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.without_duplicate_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and unigram tokens of every document, with the score of the best cut."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = (i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, [model.id_to_piece(i) for i in plain])
    return counted.select("doc_id", "token_counts.*")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a time of fetching, spread over 2024 by the page number."""
    hours = (F.col("page_id") * 37 % 8784).cast("int")
    return pages.select("page_id", "url", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=hours)).alias("fetched_at"))


def list_changes(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts of the pages: some are listed for a while, some again, some for one path."""
    host = url_filter.host_of(F.col("url"))
    number = F.conv(F.substring(F.md5("host"), 1, 8), 16, 10).cast("long")
    hosts = pages.select(host.alias("host")).filter("host <> ''").distinct().withColumn("x", number)
    changes = {
        "x % 2 = 0": [("host", "add", "x % 150"), ("host", "remove", "x % 150 + 40 + x % 90")],
        "x % 6 = 0": [("host", "add", "300 + x % 30")],
        "x % 5 = 0": [("concat(host, '/en/')", "add", "x div 7 % 300")],
        "host LIKE '%pills%' OR host LIKE '%ads-%'": [("host", "add", "0")],
    }
    made = [
        F.when(F.expr(which), F.struct(F.expr(entry).alias("entry"), F.lit(action).alias("action"), F.expr(f"CAST({day} AS INT)").alias("day")))
        for which, rows in changes.items()
        for entry, action, day in rows
    ]
    listed = hosts.select(F.explode(F.array_compact(F.array(*made))).alias("change")).select("change.*")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("day"))
    return listed.select("entry", "action", at.alias("at"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with the list entries that covered it when it was fetched."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.verdicts(captures(pages), list_changes(pages)).drop("url", "fetched_at")


OP5 = r"""
WITH p AS (
    SELECT page_id, url, page_id * 37 % 8784 AS hour,
           regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''),
                          ':[0-9]*$', '') AS host,
           regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '') AS path
    FROM pages),
hosts AS (SELECT DISTINCT host, CAST(concat('0x', substr(md5(host), 1, 8)) AS BIGINT) AS x FROM p WHERE host <> ''),
changes AS (
    SELECT host AS key, true AS active, x % 150 AS day FROM hosts WHERE x % 2 = 0
    UNION ALL SELECT host, false, x % 150 + 40 + x % 90 FROM hosts WHERE x % 2 = 0
    UNION ALL SELECT host, true, 300 + x % 30 FROM hosts WHERE x % 6 = 0
    UNION ALL SELECT host || '/en', true, x // 7 % 300 FROM hosts WHERE x % 5 = 0
    UNION ALL SELECT host, true, 0 FROM hosts WHERE host LIKE '%pills%' OR host LIKE '%ads-%'),
states AS (SELECT key, day, bool_and(active) AS active FROM changes GROUP BY key, day),
spans AS (
    SELECT *, lead(day) OVER (PARTITION BY key ORDER BY day) AS until FROM states),
hits AS (
    SELECT p.page_id, s.key FROM p JOIN spans s
    ON (p.host = s.key OR ends_with(p.host, '.' || s.key) OR p.host || p.path = s.key
        OR starts_with(p.host || p.path, s.key || '/') AND contains(s.key, '/'))
    AND s.active AND p.hour >= s.day * 24 AND (s.until IS NULL OR p.hour < s.until * 24))
SELECT p.page_id, 1::BIGINT AS rows, count(h.key) AS n_entries,
       arg_min(h.key, (length(h.key), h.key)) AS entry, count(h.key) > 0 AS blocked
FROM p LEFT JOIN hits h ON p.page_id = h.page_id GROUP BY p.page_id
"""


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest others of every twentieth vector."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the token files have it."""
    out = shared_folder(spark, "tokens")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(table(spark, folder, "documents"), out, vocabulary, end_id=2)
    return token_files.read_tokens(spark, out, crc=True)


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its language, learned from those that are not held out."""
    return language.identify(table(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its group of equal texts."""
    return exact_dedup.copies(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP9 = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
    FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY bare) AS group_size,
       row_number() OVER (PARTITION BY bare ORDER BY n DESC, doc_id) = 1 AS kept,
       sha256(bare) AS text_sha256
FROM t
"""


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    return mixing.mix(table(spark, folder, "documents"))


OP10 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) >> 10 AS place
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST([1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
    FROM sized GROUP BY source),
ratios AS (
    SELECT *, 3.0::DOUBLE * source_size AS ceiling, 3.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
    SELECT ratio, source,
           ((SELECT sum(source_size) FROM sources)::DOUBLE
            - coalesce(sum(ceiling) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ratios),
targets AS (
    SELECT source, source_size, least(ceiling, weight * (SELECT arg_min(level, (ratio, source)) FROM levels WHERE level <= ratio)) AS target
    FROM ratios),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds
    FROM targets),
leaves AS (
    SELECT source, place, CAST(sum(size) AS BIGINT) AS size FROM sized GROUP BY source, place),
reached AS (
    SELECT source, place, size, sum(size) OVER (PARTITION BY source ORDER BY place) AS reached FROM leaves),
thresholds AS (
    SELECT r.source, max(r.place) AS last
    FROM reached r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
    WHERE r.reached <= b.target - b.rounds * b.source_size
       OR (r.reached - r.size < b.target - b.rounds * b.source_size
           AND r.reached - (b.target - b.rounds * b.source_size)
               < (b.target - b.rounds * b.source_size) - (r.reached - r.size))
    GROUP BY r.source)
SELECT s.doc_id, s.size, b.source_size, b.target,
       s.size * (b.rounds + CASE WHEN s.place <= t.last THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN thresholds t ON s.source IS NOT DISTINCT FROM t.source
"""


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of conversations that were rebuilt on common starts."""
    turns = prefix_trie.numbered_turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(prefix_trie.grafted(turns), turns.select("conv_id").distinct())


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its proof, checked once more after some texts were tampered with."""
    docs = table(spark, folder, "documents")
    return merkle.proofs(merkle.manifest(docs, changed=merkle.tampered(docs))).withColumnRenamed("id", "doc_id")


#: The usual reflected polynomial, bit by bit, as DuckDB has no such function; of a whole number in decimal digits.
CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _merkle_sql(levels: int) -> str:
    """Level by level, for at most 16 ** ``levels`` nodes; ``up`` has the path of every leaf or subroot so far."""

    def climb(start: str, keys: str, prefix: str) -> str:
        steps = []
        for level in range(levels):
            before = start if level == 0 else f"{prefix}{level}"
            # Of the nodes of a level, one for each place; leaves that share a node carry it along.
            steps.append(f"""
{prefix}n{level} AS (SELECT DISTINCT {keys}, place, node FROM {before}),
{prefix}r{level} AS (
    SELECT {keys}, place // 16 AS run, list(node ORDER BY place) AS nodes, sum(count(*)) OVER (PARTITION BY {keys}) AS total
    FROM {prefix}n{level} GROUP BY {keys}, place // 16),
{prefix}{level + 1} AS (
    SELECT b.* EXCLUDE (place, node, proof, folded), b.place // 16 AS place,
           CASE WHEN r.total = 1 THEN b.node ELSE sha256(array_to_string(r.nodes, '')) END AS node,
           CASE WHEN r.total = 1 THEN b.proof ELSE b.proof || array_to_string(r.nodes[:b.place % 16], '') || array_to_string(r.nodes[b.place % 16 + 2:], '') END AS proof,
           CASE WHEN r.total = 1 THEN b.folded ELSE sha256(array_to_string(r.nodes[:b.place % 16], '') || b.folded || array_to_string(r.nodes[b.place % 16 + 2:], '')) END AS folded
    FROM {before} b JOIN {prefix}r{level} r ON b.place // 16 = r.run AND b.name = r.name)""")
        return ",".join(steps)

    fields = " || ".join(f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')" for name in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    return f"""
WITH leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS name, sha256({fields.replace('{text}', 'text')}) AS leaf,
           CASE WHEN {CRC32.format('doc_id')} % 5 = 0 THEN sha256({fields.replace('{text}', lower)}) END AS changed
    FROM documents),
l0 AS (
    SELECT doc_id, name, leaf, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           leaf AS node, '' AS proof, coalesce(changed, leaf) AS folded
    FROM leaves),
{climb('l0', 'name', 'w')},
roots AS (SELECT DISTINCT name, node FROM w{levels}),
ranked AS (SELECT name, row_number() OVER (ORDER BY encode(name)) - 1 AS place FROM roots),
a0 AS (
    SELECT w.doc_id, w.leaf, w.node AS subroot, '' AS name, r.place, w.node, w.proof, w.folded
    FROM w{levels} w JOIN ranked r ON w.name = r.name),
{climb('a0', 'name', 'x')}
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM x{levels}
"""


OP12 = _merkle_sql(5)


OP11 = f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, {CRC32.format('conv_id')} % 4 AS h
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, h FROM own),
pieces AS (
    SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.place <= c.h
    UNION ALL SELECT conv_id, place, role, text FROM own WHERE place > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM pieces),
paths AS (
    SELECT conv_id, depth, list(struct_pack(role := role, text := text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM numbered
    UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
lengths AS (SELECT conv_id, max(depth) AS len FROM paths GROUP BY conv_id),
nodes AS (
    SELECT p.path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.words) AS words, max(l.len) = p.depth AS is_leaf,
           sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (l.len = p.depth), '')) AS ends_sha256
    FROM paths p JOIN lengths l ON p.conv_id = l.conv_id GROUP BY p.path, p.depth),
above AS (
    SELECT p.path, p.depth, n.is_leaf, (n.n_convs - 1) * n.words AS saved, n.depth AS below
    FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
totals AS (
    SELECT path, depth, count(*) FILTER (below = depth + 1) AS n_children, count(*) FILTER (is_leaf) AS n_leaves,
           CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM above GROUP BY path, depth),
places AS (SELECT p.conv_id, p.depth, n.conv_id AS first FROM paths p JOIN nodes n ON p.path = n.path AND p.depth = n.depth)
SELECT n.conv_id, n.depth, a.first AS parent_conv_id, n.n_convs, t.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON n.path = t.path AND n.depth = t.depth
LEFT JOIN places a ON a.conv_id = n.conv_id AND a.depth = n.depth - 1
"""


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its toxicity, learned from labelled ones that are not held out."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    held_out = toxicity.fold_of(F.col("doc_id")) == toxicity.TEST_FOLD
    return toxicity.scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_url_filter": op5_url_filter,
    "op6_neighbours": op6_neighbours,
    "op7_token_files": op7_token_files,
    "op8_language": op8_language,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_source_mix": op10_source_mix,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_toxicity": op13_toxicity,
}
SQL = {"op5_url_filter": OP5, "op9_exact_dedup": OP9, "op10_source_mix": OP10, "op11_prefix_trie": OP11, "op12_merkle_manifest": OP12}
