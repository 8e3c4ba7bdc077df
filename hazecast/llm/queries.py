"""Queries over the corpus tables, one per operator: name -> (build, SQL twin or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazecast.llm import byte_bpe, chat, embeddings, language, lines, manifest, mixing, quality, repair, repeats, simhash, token_counts, toxicity
from hazecast.llm.common import table, text_digest
from hazecast.session import new_folder

Build = Callable[[SparkSession, str], DataFrame]

MULTI = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.read(public_tokenizers.path(MULTI), public_tokenizers.PATTERN)
    return byte_bpe.digests(table(spark, folder, "documents"), vocabulary)


TOOLS = {
    "words": {"text": ("string", True), "count": ("integer", True), "after": ("array", False)},
    "lines": {"text": ("string", True), "count": ("integer", True), "after": ("array", False)},
}


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    """The table has no tool calls: every assistant turn is made into one that waits for the one
    before, some with broken or mistyped arguments, some without a result, and some user turns
    become results without a call."""
    messages = table(spark, folder, "conversations")
    name = F.concat("conv_id", F.lit("-"), "turn")
    before = F.array(F.concat(F.lit("c"), "conv_id", F.lit("-"), F.col("turn") - 2))
    text, size = F.col("text"), F.length("text")
    arguments = (
        F.when(size % 11 == 0, '{"count": ')
        .when(size % 5 == 0, F.to_json(F.struct(text, size.cast("string").alias("count"))))
        .otherwise(F.to_json(F.struct(text, size.alias("count"), before.alias("after"))))
    )
    tool = F.when(F.contains("text", F.lit("\n")), "lines").otherwise("words")
    made = messages.where("role = 'assistant'").withColumn("call_id", F.concat(F.lit("c"), name))
    calls = made.select("conv_id", "turn", "call_id", tool.alias("name"), arguments.alias("arguments"))
    answers = made.where(size % 7 != 0).select("conv_id", "call_id", F.col("text").alias("content"))
    loose = messages.where("role = 'user'").where(size % 13 == 0)
    loose = loose.select("conv_id", F.concat(F.lit("x"), name).alias("call_id"), F.col("text").alias("content"))
    return chat.formatted(messages, calls, answers.union(loose), TOOLS)


OP2_SQL = """
WITH RECURSIVE made AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, text, length(text) AS size,
         CASE WHEN contains(text, chr(10)) THEN 'lines' ELSE 'words' END AS name,
         length(text) % 11 <> 0 AND length(text) % 5 <> 0 AS waits
  FROM conversations WHERE role = 'assistant'
), depths AS (
  SELECT m.*, 0 AS depth FROM made m
  WHERE NOT (waits AND EXISTS (SELECT 1 FROM made b WHERE b.conv_id = m.conv_id AND b.turn = m.turn - 2))
  UNION ALL
  SELECT m.*, d.depth + 1 FROM made m JOIN depths d ON m.conv_id = d.conv_id AND m.turn = d.turn + 2 WHERE m.waits
), called AS (
  SELECT *, CASE WHEN size % 11 = 0 THEN 'not a JSON object' WHEN size % 5 = 0 THEN 'count is no integer'
                 WHEN size % 7 = 0 THEN 'no result' ELSE 'ok' END AS status,
         CASE WHEN size % 11 = 0 THEN '{"count": '
              WHEN size % 5 = 0 THEN '{"count":"' || size || '","text":' || to_json(text) || '}'
              ELSE '{"after":["c' || conv_id || '-' || (turn - 2) || '"],"count":' || size || ',"text":' || to_json(text) || '}'
         END AS arguments
  FROM depths
)
SELECT conv_id, turn, 0 AS step, 'message' AS kind, NULL AS call_id, 'ok' AS status,
       '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS line FROM conversations
UNION ALL
SELECT conv_id, turn, 1 + 2 * depth, 'call', call_id, status,
       '{"arguments":' || to_json(arguments) || ',"id":"' || call_id || '","name":"' || name || '","role":"assistant"}' FROM called
UNION ALL
SELECT conv_id, turn, 2 + 2 * depth, 'result', call_id, status,
       '{"content":' || to_json(text) || ',"id":"' || call_id || '","role":"tool"}' FROM called WHERE size % 7 <> 0
UNION ALL
SELECT conv_id, NULL, NULL, 'result', 'x' || conv_id || '-' || turn, 'no call',
       '{"content":' || to_json(text) || ',"id":"x' || conv_id || '-' || turn || '","role":"tool"}'
FROM conversations WHERE role = 'user' AND length(text) % 13 = 0
"""


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(spark, folder, "documents"), weights=(5.0, 2.0, 1.0), most=3.0)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), width=3, max_distance=2)


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    clean = repeats.removed_repeats(table(spark, folder, "documents"), length=400)
    return clean.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identified(docs, language.fit(docs))


def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), least=0.98)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """With a cache of its own, so that a run never depends on earlier ones. An eighth of the texts, by
    digest, is counted first; the run over all rows finds those stored and appends the others."""
    tokenizer = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    docs, cache = table(spark, folder, "documents"), new_folder(spark, "token-counts")
    token_counts.fill(docs.where(text_digest() < F.lit(b"\x20")), tokenizer, cache)
    return token_counts.token_counts(docs, tokenizer, cache)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    proved = manifest.proofs(table(spark, folder, "documents"), found=manifest.tampered_text())
    return proved.withColumn("proof", F.sha2("proof", 256)).withColumnRenamed("proof", "proof_sha256")


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    clean = lines.deduplicated(table(spark, folder, "documents"))
    return clean.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP12_SQL = """
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(split) AS line, generate_subscripts(split, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents))
), owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> owner) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (owner IS NULL OR doc_id = owner), '')) AS kept_sha256
FROM lines LEFT JOIN owners USING (key) GROUP BY doc_id
"""


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.report(repair.damaged(conversations), conversations)


# crc32 has no SQL function here: its 256 codes, and a fold over the characters of a key
CRC32_CODES = """bits AS (
  SELECT range AS byte, 0 AS round, range AS crc FROM range(256)
  UNION ALL
  SELECT byte, round + 1, CASE WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM bits WHERE round < 8
), codes AS (
  SELECT list(crc ORDER BY byte) AS codes FROM bits WHERE round = 8
)"""
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, [ascii(c)::BIGINT FOR c IN string_split({key}, '')]),
                                       LAMBDA a, b: xor(a >> 8, codes[(xor(a, b) & 255) + 1])))"""

# the grammar as an automaton (0 nothing, 1 system, 2 user, 3 assistant), walked row by row for all
# conversations at once; up to two insertions after each row
OP13_SQL = f"""
WITH RECURSIVE {CRC32_CODES}, keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format(key='key')} % 20 AS fault
  FROM keyed, codes
), damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM faulty, unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS times(time)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), turns AS (
  SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
              WHEN bare[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
), walks AS (
  SELECT conv_id, 0::BIGINT AS i, state, {{'cost': cost::BIGINT, 'audit': audit}} AS best
  FROM counts, (VALUES (0, 0, ''), (2, 2, 'I'), (3, 4, 'II')) AS s(state, cost, audit)
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT w.conv_id, t.i, ins.after AS state,
           {{'cost': w.best.cost + edit.cost + 2 * length(ins.audit), 'audit': w.best.audit || edit.audit || ins.audit}} AS best
    FROM walks w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
    JOIN (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2), (0, 'D', 0), (1, 'D', 1), (2, 'D', 2), (3, 'D', 3)) AS move(state, letter, next)
      ON move.state = w.state
    CROSS JOIN LATERAL (SELECT CASE WHEN letter = 'D' THEN 3 ELSE (CASE letter WHEN t.initial THEN 0 ELSE 2 END) + (fault = 't')::INT END AS cost,
                               CASE WHEN letter = 'D' THEN 'D' WHEN letter = t.initial THEN 'K' ELSE 'R' END AS audit
                        WHERE letter = 'D' OR fault NOT IN ('b', 'd') AND (letter <> 's' OR t.initial = 's')) AS edit
    JOIN (VALUES (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3), (0, 'I', 2), (1, 'I', 2), (2, 'I', 3), (3, 'I', 2),
                 (0, 'II', 3), (1, 'II', 3), (2, 'II', 2), (3, 'II', 3)) AS ins(before, audit, after) ON ins.before = move.next
  ) GROUP BY conv_id, i, state
), found AS (
  SELECT c.conv_id, min(w.best) AS best FROM counts c JOIN walks w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n AND w.state IN (0, 3)
  GROUP BY c.conv_id
), steps AS (
  SELECT conv_id, k, audit[k] AS edit, length(replace(audit[:k], 'I', '')) AS i, length(replace(audit[k + 1:], 'D', '')) AS follow
  FROM (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS k FROM found)
), texts AS (
  SELECT s.conv_id, string_agg((CASE WHEN edit = 'K' THEN role WHEN follow % 2 = 0 THEN 'assistant' ELSE 'user' END) || ':' ||
                               (CASE WHEN edit = 'I' THEN '' ELSE text END), chr(10) ORDER BY k) AS repaired
  FROM steps s LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i AND s.edit <> 'I' WHERE edit <> 'D' GROUP BY s.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP11_SQL = f"""
WITH RECURSIVE {CRC32_CODES}, told AS (
  SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS fields,
         CASE WHEN {CRC32.format(key="doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS found
  FROM documents, codes
), digests AS (
  SELECT doc_id, source, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(fields || coalesce(strlen(found) || ':' || found, '-')) AS folded
  FROM told
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM digests
), built AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM built WHERE n > 1 GROUP BY ALL
), upper AS (
  SELECT 0::BIGINT AS tree, 0 AS level, tree - 1 AS pos, count(*) OVER () AS n, digest FROM built WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY ALL
), nodes AS (
  SELECT tree, level, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after,
         CASE WHEN n <= 3 AND tree > 0 THEN 0 ELSE tree END AS up_tree, CASE WHEN n <= 3 AND tree > 0 THEN 0 ELSE level + 1 END AS up_level,
         CASE WHEN n <= 3 AND tree > 0 THEN tree - 1 ELSE pos // 3 END AS up_pos
  FROM (FROM built UNION ALL FROM upper) WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, pos // 3 ORDER BY pos)
), climb AS (
  SELECT tree, pos, 0 AS step, CASE n WHEN 1 THEN 0 ELSE tree END AS at_tree, 0 AS at_level, CASE n WHEN 1 THEN tree - 1 ELSE pos END AS at_pos,
         folded, '' AS siblings
  FROM leaves
  UNION ALL
  SELECT c.tree, c.pos, step + 1, up_tree, up_level, up_pos, sha256(before || folded || after), before || after
  FROM climb c JOIN nodes n ON n.tree = at_tree AND n.level = at_level AND n.pos = at_pos
), proofs AS (
  SELECT tree, pos, sha256(string_agg(siblings, '' ORDER BY step)) AS proof_sha256, arg_max(folded, step) AS folded_root FROM climb GROUP BY tree, pos
)
SELECT doc_id, leaf, b.digest AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos JOIN built b ON b.tree = l.tree AND b.n = 1,
     (SELECT digest AS root FROM upper WHERE n = 1)
"""


OP3_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT 0.0::DOUBLE AS level, NULL::DOUBLE AS last
  UNION ALL
  SELECT greatest(level, (SELECT sum(source_size)::DOUBLE
                                 - coalesce(sum(source_size * 3.0::DOUBLE) FILTER (source_size * 3.0 <= level * weight), 0)
                          FROM sources)
                  / (SELECT sum(weight) FROM sources WHERE source_size * 3.0 > level * weight)), level
  FROM levels
  WHERE (last IS NULL OR level > last) AND EXISTS (SELECT 1 FROM sources WHERE source_size * 3.0 > level * weight)
), targets AS (
  SELECT source, source_size, least(source_size * 3.0::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target,
         ('0x' || substr(md5('7 ' || coalesce(source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS begin
  FROM sources
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS k FROM sized
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM (
  SELECT r.doc_id, r.size, t.source_size, t.target,
         (floor(begin + rate * k) - floor(begin + rate * (k - 1)))::BIGINT AS copies
  FROM ranked r JOIN (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate FROM targets) t
    ON r.source IS NOT DISTINCT FROM t.source)
"""

QUERIES: dict[str, tuple[Build, str | None]] = {
    "op1_byte_bpe": (op1_byte_bpe, None),
    "op2_chat": (op2_chat, OP2_SQL),
    "op3_mixing": (op3_mixing, OP3_SQL),
    "op4_toxicity": (op4_toxicity, None),
    "op5_simhash": (op5_simhash, None),
    "op6_language": (op6_language, None),
    "op7_embeddings": (op7_embeddings, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_repeats": (op9_repeats, None),
    "op10_quality": (op10_quality, None),
    "op11_merkle_manifest": (op11_merkle_manifest, OP11_SQL),
    "op12_line_dedup": (op12_line_dedup, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
}
