"""Registered queries of the training-data operators, with their DuckDB SQL.

Each query applies its operator with production parameters to the whole
intended table and derives the digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read_table
from .bag_minhash import near_duplicate_classes
from .bpe_rounds import bpe_encode
from .chat_windows import chat_windows, read_windows
from .decontaminate import UNITS, leaked_ids, leaks
from .language_id import UNKNOWN, held_out, identify_language, learn_dictionaries
from .lexical_packing import lexical_packing
from .line_dedup import line_dedup
from .merkle_manifest import folded, merkle_manifest, proof_text, row_digest
from .qdwh_whitening import fit_whitening
from .quality_divergence import learn_reference, quality_scores
from .secrets import BASE_KINDS, find_secrets
from .suffix_dedup import suffix_dedup
from .url_reputation import judge_urls, page_outcomes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text_kept", 256).alias("kept_sha256"))


QUERIES["op10_line_dedup"] = op10_line_dedup
ORACLE["op10_line_dedup"] = r"""
WITH parts AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
),
lines AS (
    SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM parts
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
),
shared AS (
    SELECT k, min(doc_id) AS first_id FROM keyed
    WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
    SELECT keyed.*, shared.k IS NOT NULL AND keyed.doc_id > shared.first_id AS dropped
    FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge_urls(pages, page_outcomes(read_table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict")


QUERIES["op6_url_reputation"] = op6_url_reputation
_TWO = "('co.uk','org.uk','ac.uk','gov.uk','com.au','net.au','org.au','co.nz','co.jp','or.jp','ne.jp','co.kr','com.br','org.br','gov.br','com.mx','com.ar','com.tr','com.cn','com.tw','co.in','co.za','com.sg','com.hk')"
_RHO = """greatest(least(coalesce(CASE WHEN sum(CASE WHEN n > 0 THEN (n - 1) * m * (1 - m) END) > 0 THEN
    (sum(CASE WHEN n > 0 THEN n * (bad / n - m) * (bad / n - m) END) - sum(CASE WHEN n > 0 THEN m * (1 - m) END))
    / sum(CASE WHEN n > 0 THEN (n - 1) * m * (1 - m) END) END, 0.5), 0.5), 0.0001)"""
ORACLE["op6_url_reputation"] = rf"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
),
outcome AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
    FROM labels GROUP BY doc_id
),
hosts AS (
    SELECT host, count(bad) * 1.0::DOUBLE AS n, coalesce(sum(bad), 0) * 1.0::DOUBLE AS bad,
        regexp_replace(regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', ''), '\.$', '') AS site
    FROM split LEFT JOIN outcome USING (page_id) GROUP BY host
),
labelled AS (
    SELECT *, string_split(site, '.') AS ls, regexp_full_match(site, '\[.*\]|[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') AS address FROM hosts
),
named AS (
    SELECT host, n, bad,
        CASE WHEN address THEN site WHEN array_to_string(ls[-2:], '.') IN {_TWO} THEN array_to_string(ls[-3:], '.') ELSE array_to_string(ls[-2:], '.') END AS domain,
        CASE WHEN address THEN '[]' WHEN array_to_string(ls[-2:], '.') IN {_TWO} THEN array_to_string(ls[-2:], '.') ELSE ls[-1] END AS suffix
    FROM labelled
),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM named) AS m, (SELECT sum(n) + 2 FROM named) AS k FROM named GROUP BY suffix),
s1 AS (SELECT 1 / {_RHO} - 1 AS s FROM s0),
s2 AS (SELECT suffix, (m * least(s, k) + bad) / (least(s, k) + n) AS mean, least(s, k) + n AS k FROM s0, s1),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(s2.mean) AS m, any_value(s2.k) AS k FROM named JOIN s2 USING (suffix) GROUP BY domain, suffix),
d1 AS (SELECT 1 / {_RHO} - 1 AS s FROM d0),
d2 AS (SELECT domain, (m * least(s, k) + bad) / (least(s, k) + n) AS mean, least(s, k) + n AS k FROM d0, d1),
h0 AS (SELECT host, n, bad, d2.mean AS m, d2.k AS k FROM named JOIN d2 USING (domain)),
h1 AS (SELECT 1 / {_RHO} - 1 AS s FROM h0),
h2 AS (SELECT host, (m * least(s, k) + bad) / (least(s, k) + n) AS mean, least(s, k) + n AS total FROM h0, h1),
judged AS (
    SELECT page_id, host, path, mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) > 0.3 AS bad,
        CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule
    FROM split JOIN h2 USING (host)
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
         WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_windows(chat_windows(turns)).select(
        "conv_id", "span", "n_chars", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("loss"),
    )
    parts = back.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("span", "turns", "loss"))).alias("w"),
        F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("w", lambda x: x["loss"]), "")
    return parts.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.transform("w", lambda x: x["turns"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


QUERIES["op7_chat_windows"] = op7_chat_windows
ORACLE["op7_chat_windows"] = r"""
WITH src AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS tok,
        length(regexp_replace(role, '[\\<\[\n]', 'xx', 'g')) + length(regexp_replace(text, '[\\<\[]', 'xx', 'g')) + 8 AS chars
    FROM src
),
summed AS (
    SELECT *, i = 1 AND role = 'system' AS lead,
        sum(CASE WHEN i = 1 AND role = 'system' THEN 0 ELSE tok END) OVER (PARTITION BY conv_id ORDER BY i) AS p_end
    FROM numbered
),
celled AS (
    SELECT *, p_end - tok AS p, CASE WHEN NOT lead THEN CAST(p_end - 1 AS BIGINT) // 1024 END AS cell FROM summed
),
spans AS (
    SELECT conv_id, cell, min(p) AS p0 FROM celled WHERE NOT lead GROUP BY conv_id, cell
),
system AS (
    SELECT conv_id, sum(CASE WHEN lead THEN tok ELSE 0 END) AS tok FROM celled GROUP BY conv_id
),
repeats AS (
    SELECT t.conv_id, sum(t.chars) AS chars FROM celled t JOIN system y ON t.conv_id = y.conv_id JOIN spans s
      ON t.conv_id = s.conv_id AND NOT t.lead AND s.cell > t.cell AND y.tok + s.p0 - t.p <= 512 GROUP BY t.conv_id
),
heads AS (
    SELECT t.conv_id, any_value(t.chars) * greatest(count(s.cell) - 1, 0) AS chars
    FROM celled t LEFT JOIN spans s ON t.conv_id = s.conv_id WHERE t.lead GROUP BY t.conv_id
),
base AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '') AS loss
    FROM numbered GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(base.chars + coalesce(repeats.chars, 0) + coalesce(heads.chars, 0) AS BIGINT) AS formatted_chars
FROM base LEFT JOIN repeats USING (conv_id) LEFT JOIN heads USING (conv_id)
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return find_secrets(read_table(spark, sf_dir, "documents")).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


QUERIES["op9_secrets"] = op9_secrets


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify_language(docs.select("doc_id", "text"), learn_dictionaries(docs))
    # the contract wants a learned language for every text with a letter; a narrow margin is told beside it
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("lang_best").alias("lang_pred"), "score",
        (F.col("lang_pred") == UNKNOWN).alias("rejected"),
    )


QUERIES["op2_language_id"] = op2_language_id


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_scores(docs, learn_reference(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


QUERIES["op3_quality_divergence"] = op3_quality_divergence


def op5_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_packing(read_table(spark, sf_dir, "documents"))


QUERIES["op5_lexical_packing"] = op5_lexical_packing


def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


QUERIES["op4_bag_minhash"] = op4_bag_minhash


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaked_ids(leaks(docs, read_table(spark, sf_dir, "benchmark")))


QUERIES["op8_decontaminate"] = op8_decontaminate
_WORDS = r"string_split_regex(trim(coalesce(text, '')), '[\x20\x09-\x0D]+')"
_KINDS = f"""[CASE WHEN regexp_matches(w[i], '[0-9]') THEN chr(1)
    WHEN i > 1 AND regexp_matches(w[i - 1], '[0-9]') AND lower(regexp_replace(w[i], '[.,;:!?)]*$', '')) IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN chr(2)
    WHEN regexp_matches(w[i], '^\\pP*\\p{{Lu}}') THEN chr(3) ELSE lower(w[i]) END FOR i IN range(1, len(w) + 1)]"""
_PLAIN = """[CASE WHEN regexp_matches(w[i], '^\\pP*$') THEN lower(w[i]) ELSE regexp_replace(lower(w[i]), '^\\pP+|\\pP+$', '', 'g') END FOR i IN range(1, len(w) + 1)]"""
ORACLE["op8_decontaminate"] = rf"""
WITH dw AS (SELECT DISTINCT doc_id, coalesce(text, '') AS x, {_WORDS} AS w FROM documents),
dt AS (SELECT doc_id, x, w, {_KINDS} AS k, {_PLAIN} AS p FROM dw),
bw AS (SELECT DISTINCT item_id, trim(text) AS x, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND trim(coalesce(text, '')) <> ''),
bt AS (SELECT item_id, x AS v, w, {_KINDS} AS k, {_PLAIN} AS p FROM bw),
ball AS (SELECT item_id, v, i - 1 AS ipos, len(w) AS m, k[i:i+4] AS kw, array_to_string(p[i:i+4], ' ') AS h,
    len(k) >= 5 AND len(list_filter(k[i:i+4], lambda x: x NOT IN (chr(1), chr(2), chr(3)))) >= 2 AS says
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM bt)),
told AS (SELECT *, bool_or(says) OVER (PARTITION BY item_id, v) AS any_says FROM ball),
bwin AS (SELECT *, count(*) OVER (PARTITION BY item_id, v) AS n FROM told WHERE says OR NOT any_says),
bform AS (
    SELECT item_id, v, ipos, n, m, 5 AS size, false AS plain, array_to_string(kw, ' ') AS h FROM bwin WHERE says
    UNION ALL SELECT item_id, v, ipos, n, m, least(m, 5), true, h FROM bwin
),
dform AS (
    SELECT doc_id, x, i - 1 AS pos, len(w) AS m, 5 AS size, false AS plain, array_to_string(k[i:i+4], ' ') AS h
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM dt)
    UNION ALL SELECT doc_id, x, i - 1, len(w), s, true, array_to_string(p[i:i+s-1], ' ')
    FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS i FROM dt, (SELECT DISTINCT size AS s FROM bform))
),
hit AS (
    SELECT d.doc_id, d.x, b.item_id, b.v, b.n, d.pos, b.ipos, d.pos - b.ipos AS shift, bool_or(b.plain) AS plain
    FROM dform d JOIN bform b ON d.h = b.h AND d.plain = b.plain AND d.size = b.size AND (d.size >= 3 OR d.m = d.size) GROUP BY ALL
),
likely AS (SELECT doc_id, x, item_id, v FROM hit GROUP BY doc_id, x, item_id, v, n HAVING count(DISTINCT ipos) >= n * 0.8 - 1e-9),
cand AS (SELECT hit.* FROM hit JOIN likely USING (doc_id, x, item_id, v)),
covered AS (
    SELECT doc_id, x, item_id, v, shift, iat, bool_or(plain) AS plain
    FROM (SELECT *, unnest(range(ipos, ipos + 5)) AS iat FROM cand) GROUP BY ALL
),
slotted AS (
    SELECT c.doc_id, c.x, c.item_id, c.v, c.shift, c.iat, bt.k[c.iat + 1] AS kind, regexp_replace(lower(bt.w[c.iat + 1]), '^\pP+|\pP+$', '', 'g') AS ivalue,
        CASE WHEN c.plain THEN regexp_replace(lower(bt.w[c.iat + 1]), '^\pP+|\pP+$', '', 'g')
             WHEN dt.k[c.iat + c.shift + 1] IN (chr(1), chr(2), chr(3)) THEN regexp_replace(lower(dt.w[c.iat + c.shift + 1]), '^\pP+|\pP+$', '', 'g') END AS value
    FROM covered c JOIN bt ON c.item_id = bt.item_id AND c.v = bt.v JOIN dt ON c.doc_id IS NOT DISTINCT FROM dt.doc_id AND c.x = dt.x
    WHERE bt.k[c.iat + 1] IN (chr(1), chr(2), chr(3))
),
torn AS (
    SELECT DISTINCT s.doc_id, s.x, s.item_id, s.v, s.shift, unnest(range(s.iat - 4, s.iat + 1)) AS ipos
    FROM slotted s JOIN (SELECT doc_id, x, item_id, v, shift, kind, ivalue FROM slotted WHERE value IS NOT NULL GROUP BY ALL HAVING min(value) <> max(value)) t
      ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.x = t.x AND s.item_id = t.item_id AND s.v = t.v AND s.shift = t.shift AND s.kind = t.kind AND s.ivalue = t.ivalue
    WHERE s.value IS NOT NULL
),
judged AS (
    SELECT c.doc_id, c.x, c.item_id, c.v, c.n, count(DISTINCT c.ipos) AS hits, bool_and(c.plain) AS same
    FROM cand c LEFT JOIN torn t ON c.doc_id IS NOT DISTINCT FROM t.doc_id AND c.x = t.x AND c.item_id = t.item_id AND c.v = t.v AND c.shift = t.shift AND c.ipos = t.ipos
    WHERE c.plain OR t.ipos IS NULL GROUP BY ALL HAVING count(DISTINCT c.ipos) >= c.n * 0.8 - 1e-9
),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, x, item_id ORDER BY hits / n DESC, hits DESC, v DESC) AS place FROM judged)
SELECT doc_id, item_id, hits AS n_matched, n AS n_windows, same AS same_slots FROM best WHERE place = 1
"""


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


QUERIES["op1_suffix_dedup"] = op1_suffix_dedup


def op13_bpe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES["op13_bpe_rounds"] = op13_bpe_rounds


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    front = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = row_digest(*front, F.col("text"))
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, row_digest(*front, small)).otherwise(leaf)
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), shown.alias("shown"))
    return merkle_manifest(rows, "leaf", "lang", ["doc_id"]).proofs().select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"),
        folded(F.col("shown"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES["op12_merkle_manifest"] = op12_merkle_manifest


def _merkle_sql(prefix: str, n_levels: int, leaves: str) -> str:
    """Levels, siblings and proofs of the trees over ``leaves`` (id, tree, pos, m, h), for up to 8 ** n_levels leaves."""
    out = [f"{prefix}0 AS ({leaves})"]
    for k in range(n_levels):
        out.append(f"""{prefix}{k + 1} AS (SELECT tree, pos // 8 AS pos, any_value((m + 7) // 8) AS m,
            CASE WHEN any_value(m) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
            FROM {prefix}{k} GROUP BY tree, pos // 8)""")
        run = "string_agg(h, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        out.append(f"""{prefix}s{k} AS (SELECT tree, pos, m, coalesce({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{k})""")
    return ",\n".join(out)


def _merkle_fold_sql(prefix: str, n_levels: int, start: str) -> str:
    """Proof text and folded node of each row of ``start`` (id, tree, pos, node, proof)."""
    out = [f"{prefix}p0 AS ({start})"]
    for k in range(n_levels):
        out.append(f"""{prefix}p{k + 1} AS (SELECT p.id, p.tree, p.pos // 8 AS pos, CASE WHEN s.m > 1 THEN p.proof || s.l || s.r ELSE p.proof END AS proof,
            CASE WHEN s.m > 1 THEN sha256(s.l || p.node || s.r) ELSE p.node END AS node
            FROM {prefix}p{k} p JOIN {prefix}s{k} s ON p.tree = s.tree AND p.pos = s.pos)""")
    return ",\n".join(out)


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


_FRONT = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"""
ORACLE["op12_merkle_manifest"] = f"""
WITH leaf AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_FRONT} || {_field_sql("text")}) AS leaf,
        CASE WHEN {_CRC} % 3 = 0 THEN sha256({_FRONT} || {_field_sql(_SMALL)}) ELSE sha256({_FRONT} || {_field_sql("text")}) END AS shown
    FROM documents
),
numbered AS (
    SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS m
    FROM leaf
),
{_merkle_sql("a", 7, "SELECT tree, pos, m, leaf AS h FROM numbered")},
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS m FROM a7),
{_merkle_sql("b", 3, "SELECT '' AS tree, pos, m, subroot AS h FROM subroots")},
{_merkle_fold_sql("a", 7, "SELECT id, tree, pos, shown AS node, '' AS proof FROM numbered")},
{_merkle_fold_sql("b", 3, "SELECT p.id, '' AS tree, s.pos, p.node, p.proof FROM ap7 p JOIN subroots s ON p.tree = s.tree")}
SELECT n.doc_id, n.leaf, s.subroot, b3.h AS root, sha256(p.proof) AS proof_sha256, p.node AS folded_root, p.node = b3.h AS verified
FROM numbered n JOIN subroots s ON n.tree = s.tree JOIN bp3 p ON n.id = p.id, b3
"""


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    fit = fit_whitening(rows, components=4)
    out = fit.apply(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(v) for v in fit.explained()]).cast("array<double>")
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.try_element_at(explained, F.col("at") + 1).alias("explained"), F.lit(fit.identity_error).alias("identity_error"),
    )


QUERIES["op11_qdwh_whitening"] = op11_qdwh_whitening
