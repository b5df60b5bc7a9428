"""The registered queries on shards and conversations, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import conversation_repair, prefix_trie, sharding
from moodtide.llm.common import table
from moodtide.llm.registry import query

#: CRC-32 by table, over a list of bytes.
_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(range(8),
  lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS v FROM range(256) r(i)))"""


def _crc(byte_list: str) -> str:
    steps = f"list_reduce({byte_list}, lambda a, x: xor(a >> 8, tab[xor(a & 255, x) + 1]), 4294967295::BIGINT)"
    return f"xor({steps}, 4294967295::BIGINT)"


def _ascii_crc(text: str) -> str:
    return _crc(f"list_transform(range(length({text})), lambda i: ord(substr({text}, CAST(i AS INTEGER) + 1, 1)))")


# --- 11 conversation repair ------------------------------------------------------------------------------------


def _plus(label: str, cost: str, letters: str) -> str:
    """A label is a path's cost in eight digits and its edits; the least label is the best path."""
    return f"(lpad(CAST(CAST(substr({label}, 1, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({label}, 9) || '{letters}')"


_CLOSED = f"""c0, c1, least(c2, {_plus('c0', '3', 'I')}, {_plus('c1', '3', 'I')}, {_plus('c3', '3', 'I')}) AS c2,
    least(c3, {_plus('c2', '3', 'I')}, {_plus('c0', '6', 'II')}, {_plus('c1', '6', 'II')}) AS c3"""


def _next(state: int) -> str:
    found = [_plus(f"c{state}", "4", "D")]
    if state == 1:
        found.append(f"CASE WHEN ok AND initial = 's' THEN {_plus('c0', 'extra', 'K')} END")
    for before in {2: (0, 1, 3), 3: (2,)}.get(state, ()):
        kept, changed = (_plus(f"c{before}", cost, letter) for cost, letter in (("extra", "K"), ("3 + extra", "R")))
        found.append(f"CASE WHEN NOT ok THEN NULL WHEN initial = '{'u' if state == 2 else 'a'}' THEN {kept} ELSE {changed} END")
    return f"least({', '.join(found)}) AS c{state}" if len(found) > 1 else f"{found[0]} AS c{state}"


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_ascii_crc('k')} % 20 AS kind FROM keyed, crc_table),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS time FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    CASE WHEN role = '' THEN '?' ELSE substr(role, 1, 1) END AS initial FROM damaged),
faulty AS (SELECT *, CASE WHEN rtrim(text, {_SPACES}) = '' THEN 'blank'
      WHEN pos > min(pos) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
      WHEN right(rtrim(text, {_SPACES}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed),
turns AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS ok, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM faulty),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    max(pos) AS n FROM turns GROUP BY conv_id),
paths(conv_id, pos, c0, c1, c2, c3) AS (
  SELECT conv_id, 0::BIGINT, '00000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counts
  UNION ALL
  SELECT p.conv_id, t.pos, {', '.join(map(_next, range(4)))}
  FROM (SELECT conv_id, pos, {_CLOSED} FROM paths) p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.pos = p.pos + 1),
ended AS (SELECT p.conv_id, least(c0, c3, {_plus('c2', '3', 'I')}, {_plus('c1', '6', 'II')}) AS label
  FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.pos),
plans AS (SELECT conv_id, CAST(substr(label, 1, 8) AS BIGINT) AS cost, substr(label, 9) AS audit FROM ended),
letters AS (SELECT conv_id, k, substr(audit, CAST(k AS INTEGER), 1) AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM plans)),
steps AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos FROM letters),
joined AS (SELECT s.conv_id, s.k, letter, t.role, CASE letter WHEN 'I' THEN '' ELSE t.text END AS text, letter = 'K' AND t.initial = 's' AS is_system
  FROM steps s LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.pos = s.pos WHERE letter <> 'D'),
numbered AS (SELECT *, count(*) FILTER (NOT coalesce(is_system, false)) OVER (PARTITION BY conv_id ORDER BY k) AS place FROM joined),
lines AS (SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE place % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || text, chr(10) ORDER BY k) AS lines FROM numbered GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query("op11_conversation_repair", _OP11_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, damaged as the query's contract has it, and repaired."""
    report, repaired = conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))
    digests = conversation_repair.conversation_digests(repaired).withColumnRenamed("conv_id", "_c")
    joined = report.join(digests, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(*report.columns, F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


# --- 12 sharding -----------------------------------------------------------------------------------------------

_OP12_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {sharding.RECORD_BYTES} AS size,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents),
m AS (SELECT doc_id, size, {_crc("list_transform(bytes, lambda b: ('0x' || b)::BIGINT)")} AS text_crc32 FROM d, crc_table),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1 AS copy FROM m),
r AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32 || ':' || copy), 1, 15) AS BIGINT) AS place FROM n),
slots AS (SELECT v, coalesce(sum(size), 0)::BIGINT AS bytes FROM range({sharding.SLOTS}) s(v) LEFT JOIN r ON r.place % {sharding.SLOTS} = v GROUP BY v),
ranked AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, v) AS i FROM slots),
dealt(i, loads, v, shard) AS (
  SELECT 0::BIGINT, list_transform(range({sharding.SHARDS}), lambda x: 0::BIGINT), NULL::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT k.i, list_transform(loads, lambda x, j: CASE WHEN j = lowest THEN x + k.bytes ELSE x END), k.v, lowest - 1
  FROM (SELECT *, list_position(loads, list_min(loads))::BIGINT AS lowest FROM dealt) g JOIN ranked k ON k.i = g.i + 1)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, text_crc32, copy) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM r JOIN dealt ON dealt.v = r.place % {sharding.SLOTS}"""


@query("op12_sharding", _OP12_SQL)
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By bytes, so that there is no shard for one shard more to hold."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", none)


# --- 13 conversation prefix trie -------------------------------------------------------------------------------

_OP13_SQL = rf"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_ascii_crc('CAST(conv_id AS VARCHAR)')} % {prefix_trie.HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {prefix_trie.BLOCK} AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND pos >= h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS n_chars, lead(pos) OVER w IS NULL AS is_end,
    md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY part, pos)) AS key FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, conv_id NOT IN (SELECT conv_id FROM rebuilt), '' FROM convs),
nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_chars) AS n_chars,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end) AS ends FROM prefixes GROUP BY depth, key),
parents AS (SELECT n.depth, n.key, u.key AS parent_key, m.conv_id AS parent_conv_id FROM nodes n
  JOIN prefixes u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1 JOIN nodes m ON m.depth = u.depth AND m.key = u.key),
children AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM parents GROUP BY ALL),
within AS (SELECT a.depth, a.key, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.n_chars)::BIGINT AS saved_tokens
  FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.depth = n.depth AND c.key = n.key GROUP BY a.depth, a.key)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, w.n_leaves, w.saved_tokens,
  sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN within w USING (depth, key) LEFT JOIN parents p USING (depth, key) LEFT JOIN children c USING (depth, key)"""


@query("op13_prefix_trie", _OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
