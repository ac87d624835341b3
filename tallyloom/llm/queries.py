"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact, jaccard, mixing, packing, periodic, permutation, quality, sharding, suffix, toxicity, trie, warc
from .common import bounded_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096)


@query("op2_ngram_jaccard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_source_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    substring(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, 2 * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(cap) OVER b, 0)::DOUBLE)
    / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap / w <= level THEN cap::DOUBLE
    ELSE w * (SELECT max(level) FROM l WHERE cap / w > level) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
c AS (SELECT d.*, e.source_size, e.target, e.epochs, CAST(floor(e.target) AS BIGINT) - e.epochs * e.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken FROM c""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op4_permutation_index")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest_neighbours(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


@query("op5_compression_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_B32 = " || ".join(f"lpad(to_base(CAST('0x' || substring(s, {5 * k + 1}, 5) AS BIGINT), 32), 4, '0')" for k in range(8))


@query("op6_warc_archive", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS keeper,
  translate({_B32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM d""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_facts(spark, warc.write_archive(table(spark, sf_dir, "pages"), least=0))


_ESCAPED = (r"regexp_replace(replace(t, '\', '\\'), "
            r"'(\[)(INST\]|/INST\]|ROLE |/ROLE\])|(<)(s>|/s>|<SYS>>|</SYS>>)', '\1\3\\\2\4', 'g')")


@query("op7_chat_formatting", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length({_ESCAPED}) + CASE r WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
    ELSE 14 + length(replace(replace(r, '', '\'), ']', '\]')) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    records = chat.conversation_records(rows, layouts=chat.PLAIN)
    return chat.read_back(chat.format_records(records, "conv_id", mappings=chat.PLAIN), "conv_id")


@query("op8_co_trained_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_sparse_suffix_array")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_passages(table(spark, sf_dir, "documents"))


@query("op10_content_sort", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.content_sort(table(spark, sf_dir, "documents"), keep="max")


def _repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one document in ten the words from some place on repeat a period; a null id has the checksum of no text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), shape=_repeating)


# crc32 in SQL: {0} is a text; a table of 256 checksums, joined as crc, is looked up for each byte
_CRC = ("xor(list_reduce(list_transform(string_split(rtrim(regexp_replace(hex({0}), '(..)', '\\1,', 'g'), ','), ','), "
        "lambda x: CASE WHEN x = '' THEN -1 ELSE CAST('0x' || x AS BIGINT) END), "
        "lambda c, x: CASE WHEN x < 0 THEN c ELSE xor(c >> 8, crc.t[(xor(c, x) & 255) + 1]) END, 4294967295), 4294967295)")
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)))"""


@query("op12_conversation_trie", rf"""
WITH {_CRC_TABLE},
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, {_CRC.format('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT conv_id, max(pos) AS n FROM o GROUP BY conv_id), crc),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
r AS (SELECT k.conv_id, o.pos, o.role, o.text FROM k JOIN o ON o.conv_id = k.conv_id - k.conv_id % 20 AND o.pos <= k.head
  UNION ALL SELECT k.conv_id, k.head + o.pos - k.h, o.role, o.text FROM k JOIN o ON o.conv_id = k.conv_id AND o.pos > k.h),
t AS (SELECT *, list([role, text]) OVER (PARTITION BY conv_id ORDER BY pos) AS p, max(pos) OVER (PARTITION BY conv_id) AS length,
    len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM r
  UNION ALL SELECT conv_id, 0, '', '', [], head + greatest(0, n - h), 0 FROM k),
e AS (SELECT sha256(p::VARCHAR || len(p)) AS p, sha256(p[:-2]::VARCHAR || (len(p) - 1)) AS up, conv_id, pos, length, words FROM t),
n AS (SELECT p, pos AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (pos = length), '')) AS ends_sha256 FROM e GROUP BY p, pos),
f AS (SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM n m WHERE m.up = n.p AND m.depth = n.depth + 1) AS n_children
  FROM n LEFT JOIN n u ON u.p = n.up AND u.depth = n.depth - 1),
s AS (SELECT a.p, f.p AS under, f.own, f.n_children FROM f JOIN e ON e.conv_id = f.conv_id AND e.pos <= f.depth JOIN f a ON a.p = e.p)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent_conv_id, f.n_convs, f.n_children,
  CAST(count(*) FILTER (s.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(s.own) AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.p = f.p GROUP BY ALL""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"), heads=F.crc32(F.col("conv").cast("string")) % 4)


@query("op13_virtual_slots", rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, CAST({_CRC.format("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents, crc),
k AS (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || (row_number() OVER (PARTITION BY doc_id ORDER BY size, text_crc32) - 1)) AS k FROM d),
v AS (SELECT *, CAST(CAST('0x' || substring(k, 1, 8) AS BIGINT) % 4096 AS INT) AS virtual_slot FROM k),
s AS (SELECT i AS virtual_slot, CAST(coalesce(b, 0) AS BIGINT) AS b, row_number() OVER (ORDER BY coalesce(b, 0) DESC, i) AS rank
  FROM range(4096) r(i) LEFT JOIN (SELECT virtual_slot, sum(size) AS b FROM v GROUP BY virtual_slot) z ON z.virtual_slot = i),
m AS (SELECT 0::BIGINT AS rank, [0::BIGINT for x in range(24)] AS loads, 0::BIGINT AS shard
  UNION ALL SELECT s.rank, list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + s.b ELSE x END),
    list_position(loads, list_min(loads)) - 1 FROM m JOIN s ON s.rank = m.rank + 1),
p AS (SELECT s.virtual_slot, CAST(m.shard AS INT) AS shard,
    CASE WHEN sum(s.b) OVER (PARTITION BY m.shard ORDER BY s.virtual_slot) <= sum(s.b) OVER () / 25 THEN CAST(m.shard AS INT) ELSE 24 END AS next_shard
  FROM m JOIN s USING (rank))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, k, doc_id NULLS FIRST) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard, virtual_slot, next_shard FROM v JOIN p USING (virtual_slot)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))
