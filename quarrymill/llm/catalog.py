"""The operators' queries over the driver tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import balltree, chat, infill, lines, media, mixing, pieces, quality, repair, rules, secrets, simhash, substrings
from quarrymill.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.deduplicated(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2(F.col("text"), 256).alias("kept_sha256"))


#: Lines that are not only white space; runs of two of them; a line goes if a run with it also starts earlier.
OP1_SQL = r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents),
pos AS (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS p FROM split),
part AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM pos WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM part),
firsts AS (SELECT *, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, i) AS k FROM runs WHERE nxt IS NOT NULL),
gone AS (SELECT doc_id, i FROM firsts WHERE k > 1 UNION SELECT doc_id, i + 1 FROM firsts WHERE k > 1),
marked AS (SELECT pos.doc_id, pos.p, pos.line, part.i IS NOT NULL AS takes, gone.i IS NOT NULL AS goes
  FROM pos LEFT JOIN part USING (doc_id, p) LEFT JOIN gone ON gone.doc_id = pos.doc_id AND gone.i = part.i),
per AS (SELECT doc_id, count(*) FILTER (takes) AS n_lines, count(*) FILTER (goes) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT goes), '') AS kept FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256 FROM split LEFT JOIN per USING (doc_id)
""".replace("\\\\", "\\")


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


#: Windows of 20 words, the first place of each, the words that later ones cover.
OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
p AS (SELECT doc_id, i, string_agg(word, ' ') OVER q AS key, count(*) OVER q AS n FROM t WINDOW q AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5(key) ORDER BY doc_id, i) > 1 AS later FROM p WHERE n = 20),
g AS (SELECT doc_id, list(i) AS later FROM k WHERE later GROUP BY 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM (SELECT doc_id, unnest(later) AS s FROM g)),
r AS (SELECT t.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (c.i IS NULL) AS kept FROM t LEFT JOIN c USING (doc_id, i) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count_of(kind: str):
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    counts = [_count_of(k).alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))


def op6_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0").withColumn("rank", F.col("rank").cast("int"))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.windows(turns.unionByName(own)))


OP7_TURNS_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM t GROUP BY conv_id
"""


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media_columns(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what decoding them gives back."""
    model = pieces.Model.read()
    coded = pieces.encode(table(spark, sf_dir, "documents"), model)
    back = pieces.decode(coded, model, keep_ids=True)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each conversation of the table, also where the damage leaves none of its rows."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.reports(repair.repair(repair.damaged(turns))).withColumnRenamed("conv_id", "r_conv")
    out = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("r_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# A state of the search is its cost in six digits and its audit, so that the least string is the least (cost, audit); ~ is a state that can't be reached.
_ADD = "CASE WHEN {0} = '~' THEN '~' ELSE printf('%06d', {0}[1:6]::INT + {1}) || {0}[7:] || '{2}' END".format


def _sql_kept(state: str, initial: str) -> str:
    return f"CASE WHEN r.must OR r.initial <> '{initial}' THEN '~' ELSE {_ADD(state, 'r.more', 'K')} END"


def _sql_reroled(state: str) -> str:
    return f"CASE WHEN r.must THEN '~' ELSE {_ADD(state, '3 + r.more', 'R')} END"


_USERS = ", ".join(f"{_sql_kept(s, 'u')}, {_sql_reroled(s)}" for s in ("s0", "s1", "s3"))

#: The damage by CRC-32 bit by bit; the search row by row; the audit read back letter by letter.
OP11_SQL = rf"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 20 AS kind FROM src),
hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS again FROM crc WHERE kind <> 0),
rows_ AS (SELECT *, i > min(i) OVER (PARTITION BY conv_id, role, text) AS again_ FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text)) AS i FROM hurt)),
r AS (SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT blank AND again_ AS duplicate, NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS truncated,
  blank OR duplicate AS must, CASE WHEN truncated THEN 3 ELSE 0 END AS more, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM rows_),
convs AS (SELECT DISTINCT conv_id FROM conversations),
best(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, '000000', '~', '000003I', '000006II' FROM convs
  UNION ALL
  SELECT conv_id, i, d0, d1, e2, least(d3, {_ADD("e2", 3, "I")}) FROM (
    SELECT *, least(d2, {_ADD("d0", 3, "I")}, {_ADD("d1", 3, "I")}, {_ADD("d3", 3, "I")}) AS e2 FROM (
      SELECT b.conv_id, r.i, {_ADD("s0", 4, "D")} AS d0, least({_ADD("s1", 4, "D")}, {_sql_kept("s0", "s")}) AS d1, least({_ADD("s2", 4, "D")}, {_USERS}) AS d2, least({_ADD("s3", 4, "D")}, {_sql_kept("s2", "a")}, {_sql_reroled("s2")}) AS d3
      FROM best AS b JOIN r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = b.i + 1))),
won AS (SELECT conv_id, least(s0, s3)[1:6]::BIGINT AS cost, least(s0, s3)[7:] AS audit FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS k FROM best) WHERE k = 1),
read(conv_id, audit, k, i, last, said) AS (
  SELECT conv_id, audit, 0, 0::BIGINT, '', NULL::VARCHAR FROM won
  UNION ALL
  SELECT conv_id, audit, k, i, CASE WHEN said IS NULL THEN last ELSE left(said, 1) END, said FROM (
    SELECT x.conv_id, audit, k, x.i, last, CASE letter WHEN 'D' THEN NULL WHEN 'I' THEN wanted || ':' WHEN 'R' THEN wanted || ':' || r.text ELSE r.role || ':' || r.text END AS said
    FROM (SELECT conv_id, audit, k + 1 AS k, audit[k + 1] AS letter, i + CASE audit[k + 1] WHEN 'I' THEN 0 ELSE 1 END AS i, last, CASE last WHEN 'u' THEN 'assistant' ELSE 'user' END AS wanted FROM read WHERE k < length(audit)) AS x
    LEFT JOIN r ON x.conv_id IS NOT DISTINCT FROM r.conv_id AND x.i = r.i)),
texts AS (SELECT conv_id, sha256(coalesce(string_agg(said, chr(10) ORDER BY k), '')) AS repaired_sha256 FROM read GROUP BY 1),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, repaired_sha256
FROM convs AS c JOIN won ON c.conv_id IS NOT DISTINCT FROM won.conv_id JOIN texts ON c.conv_id IS NOT DISTINCT FROM texts.conv_id LEFT JOIN sums ON c.conv_id IS NOT DISTINCT FROM sums.conv_id
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.decided(rules.ledger(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ablations(rules.patterns(rules.ledger(table(spark, sf_dir, "documents"))))


_BIT = {r.name: 1 << r.bit for r in rules.RULES}
_POLICY = rules.POLICIES[rules.CURRENT]

#: The measures of every document, its failure bits, and the verdict of the current policy.
_LEDGER = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT row, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
g AS (SELECT row, i, w || ' ' || lead(w, 1) OVER q || ' ' || lead(w, 2) OVER q AS tri FROM t WINDOW q AS (PARTITION BY row ORDER BY i)),
c AS (SELECT row, i, count(*) OVER (PARTITION BY row, tri) > 1 AS twice FROM g WHERE tri IS NOT NULL),
m AS (SELECT t.row, count(*) FILTER (c0.twice OR c1.twice OR c2.twice) AS n_repeat_words FROM t LEFT JOIN c AS c0 ON c0.row = t.row AND c0.i = t.i LEFT JOIN c AS c1 ON c1.row = t.row AND c1.i = t.i - 1 LEFT JOIN c AS c2 ON c2.row = t.row AND c2.i = t.i - 2 GROUP BY 1),
x AS (SELECT row, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z\x{80}-\x{10FFFF}]')))::BIGINT AS n_letter_words, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
  len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•◦‣]')))::BIGINT AS n_bullets, coalesce(list_max(list_transform(words, lambda w: octet_length(encode(w)))), 0)::BIGINT AS longest_word FROM d),
l AS (SELECT x.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM x LEFT JOIN m USING (row)),
b AS (SELECT *, (""" + " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in rules.RULES) + """)::BIGINT AS fail_bits FROM l)
"""


def _sql_keeps(without: int = 0) -> str:
    return f"(fail_bits & {_POLICY.hard & ~without} = 0 AND bit_count(fail_bits & {_POLICY.soft & ~without}) <= {_POLICY.most})"


OP12_SQL = _LEDGER + f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT base_failed AND {_sql_keeps()} AS kept, fail_bits FROM b"
RULE_ABLATIONS_SQL = _LEDGER + " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER (fail_bits & {bit} <> 0) AS n_failed, count(*) FILTER (NOT {_sql_keeps()} AND {_sql_keeps(bit)}) AS n_alone, count(*) FILTER ({_sql_keeps()}) AS n_kept FROM b" for name, bit in _BIT.items())


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.transformed(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c, 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


#: The restored text is the text.
OP13_SQL = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
v AS (SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
  CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(units[greatest(a, b) + 1:], '') AS suffix FROM v)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""


# What SQL can say of the queries above, as queries of their own; the others are held against brute force in tests.


def sql4_mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_source_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


#: Water-filling in closed form: with the sources by cap / weight, the first k are clamped where the level after them is below the next cap.
SQL4 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY 1),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM s),
o AS (SELECT *, 3.0 * size / weight AS ratio, sum(size) OVER () AS total, sum(weight) OVER () AS weights FROM w),
k AS (SELECT *, coalesce(sum(3.0 * size) OVER q, 0) AS taken, coalesce(sum(weight) OVER q, 0) AS used FROM o WINDOW q AS (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((total - taken) / (weights - used), ratio) AS level FROM k WHERE (total - taken) / (weights - used) <= ratio)
SELECT doc_id, d.size, o.size AS source_size, round(least(level * weight, 3.0 * o.size)::DOUBLE, 3) AS target FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source, l
"""


def sql5_secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


SQL5 = r"""
SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS n_assign,
  len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS n_access,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS n_hex FROM documents
"""


def sql7_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_chat_format(spark, sf_dir).drop("formatted_chars")


def sql8_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_media_columns(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


SQL8 = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
p AS (SELECT *, octet_length(raw)::BIGINT AS n_bytes, greatest(1, (octet_length(raw) + 575) // 576)::BIGINT * 576 AS payload_bytes FROM b)
SELECT doc_id, n_bytes, payload_bytes, sha256(raw || unhex(repeat('FF', (payload_bytes - n_bytes)::INT))) AS payload_sha256 FROM p
"""


def sql9_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_sentencepiece(spark, sf_dir).select("doc_id", "decoded_sha256")


SQL9 = "SELECT doc_id, sha256(text) AS decoded_sha256 FROM documents"

_PLAIN = (sql4_mix_targets, sql5_secret_counts, sql7_chat_turns, sql8_payloads, sql9_decoded)
QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_recompression, op3_quality, op4_source_mixing, op5_secret_scan, op6_ball_tree, op7_chat_format, op8_media_columns, op9_sentencepiece, op10_simhash, op11_conversation_repair, op12_quality_rules, rule_ablations, op13_fill_in_middle, *_PLAIN)}
ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op2_recompression": OP2_SQL, "op6_ball_tree": OP6_SQL, "op11_conversation_repair": OP11_SQL, "op12_quality_rules": OP12_SQL, "rule_ablations": RULE_ABLATIONS_SQL, "op13_fill_in_middle": OP13_SQL} | dict(zip([f.__name__ for f in _PLAIN], (SQL4, SQL5, OP7_TURNS_SQL, SQL8, SQL9), strict=True))
