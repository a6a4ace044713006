"""The registered queries of the operators: whole tables in, digests out."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpusgauge.llm import chat, decontaminate, mixing, neardup, packing, periodic, quality_classifier, quality_rules, substrings, token_counts, toxicity, trie, warc
from corpusgauge.llm.common import table
from corpusgauge.session import cut

QUERIES: dict = {}
SQL: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).drop("_id", "_tag")


@query
def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of an archive of the pages with their fixity. The replica it is compared with has lost the records of some
    pages and holds others with one byte's value changed, cut off in the middle, or put in."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    at = F.col("page_id")
    body = F.when(at % 97 == 13, F.concat(F.lit("?"), F.substring("html", 2, 1 << 30))).when(
        at % 79 == 3, F.expr("substring(html, 1, char_length(html) div 2)")).otherwise(F.col("html"))
    more = pages.where(at % 83 == 5).withColumn("html", F.concat(F.lit("put in "), F.coalesce("html", F.lit(""))))
    stored = cut(warc.archive(pages), "archive")
    other = cut(warc.archive(pages.where((at % 89 != 7) | at.isNull()).withColumn("html", body).union(more)), "archive")
    found = cut(warc.audit(stored, other), "findings")
    known = found.where("status <> 'extra'").select("file", "slot", "status", "other_start", "other_digest")
    columns = [F.col("key").alias("page_id"), "file", "start", "length", "digest", "status", "other_start", "other_digest"]
    held = stored.join(known, ["file", "slot"], "left").withColumn("status", F.coalesce("status", F.lit("intact"))).select(*columns)
    return held.union(found.where("status = 'extra'").select(*columns))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_line(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run


_PLAIN = r"translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = r"regexp_extract_all(" + _PLAIN + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op5_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, coalesce({_RUNS}, []) AS w FROM documents),
b AS (SELECT item_id, {_RUNS} AS w FROM benchmark),
own AS (SELECT item_id, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s, w FROM b WHERE len(w) > 0),
known AS (SELECT DISTINCT m, array_to_string(w[s:s + m - 1], ' ') AS win, item_id FROM own),
sizes AS (SELECT DISTINCT m FROM known),
tried AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS s, w FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT t.doc_id, t.s, t.m, k.item_id FROM (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS win FROM tried) t JOIN known k USING (m, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

SQL["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY x) AS owner FROM win) WHERE owner < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_STOPS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


def _rules_sql() -> str:
    parts = [f"{name} >= {low}" for name, low, _ in quality_rules.RULES if low is not None]
    return " AND ".join(parts + [f"{name} <= {high}" for name, _, high in quality_rules.RULES if high is not None])


SQL["op4_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce({_WORDS}, []) AS w FROM documents),
win AS (SELECT doc_id, s, w[s:s + 2] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n >= 2),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + 3)) FROM twice) GROUP BY doc_id),
line AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS own, sum(length(x)) AS chars, list_sum(list_transform(list(DISTINCT x), lambda y: length(y))) AS own_chars
         FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
         WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             length(regexp_replace(t, '[^!]+', '', 'g')) AS shouts,
             length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS uppers,
             CAST(coalesce(line.n - line.own, 0) AS BIGINT) AS n_dup_lines, coalesce(line.n, 0) AS n_lines,
             coalesce(line.chars, 0) AS line_chars, coalesce(line.chars - line.own_chars, 0) AS dup_chars,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             len(list_filter(w, lambda x: x IN ({_STOPS}))) AS stops
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN line USING (doc_id)),
r AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
             CASE WHEN n_words > 0 THEN shouts / n_words ELSE 0 END AS shouts_per_word,
             CASE WHEN word_chars > 0 THEN uppers / word_chars ELSE 0 END AS upper_share,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
             CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_share,
             CASE WHEN line_chars > 0 THEN dup_chars / line_chars ELSE 0 END AS dup_char_share,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_rules_sql()} AS kept
FROM r
"""


def _record_sql(body: str) -> str:
    line = "chr(13) || chr(10)"
    return (
        f"'WARC/1.1' || {line} || 'WARC-Type: response' || {line} || 'WARC-Target-URI: ' || coalesce(url, '') || {line}"
        f" || 'Content-Length: ' || strlen(coalesce({body}, '')) || {line} || {line} || coalesce({body}, '') || {line} || {line}"
    )


_OFFSET = "CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING) - length AS BIGINT)"

SQL["op8_warc_fixity"] = f"""
WITH o AS (SELECT page_id, url, html AS body FROM pages),
p AS (SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN '?' || html[2:] WHEN page_id % 79 = 3 THEN html[1:length(html) // 2] ELSE html END AS body
      FROM pages WHERE page_id % 89 <> 7
      UNION ALL SELECT page_id, url, 'put in ' || coalesce(html, '') FROM pages WHERE page_id % 83 = 5),
h AS (SELECT *, {_OFFSET} AS start FROM (SELECT page_id, page_id // 1024 AS file, CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS digest FROM (SELECT page_id, {_record_sql('body')} AS r FROM o))),
g AS (SELECT *, {_OFFSET} AS start FROM (SELECT page_id, page_id // 1024 AS file, CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS digest FROM (SELECT page_id, {_record_sql('body')} AS r FROM p))),
same AS (SELECT h.*, CASE WHEN h.start <> g.start THEN g.start END AS other_start FROM h JOIN g USING (page_id, file, digest)),
x AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY digest) AS i FROM h ANTI JOIN g USING (page_id, digest)),
y AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY digest) AS i FROM g ANTI JOIN h USING (page_id, digest))
SELECT page_id, file, start, length, digest, CASE WHEN other_start IS NULL THEN 'intact' ELSE 'moved' END AS status, other_start,
       CASE WHEN other_start IS NOT NULL THEN digest END AS other_digest FROM same
UNION ALL SELECT coalesce(x.page_id, y.page_id), coalesce(x.file, y.file), x.start, x.length, x.digest,
       CASE WHEN x.digest IS NULL THEN 'extra' WHEN y.digest IS NULL THEN 'missing' ELSE 'altered' END, y.start, y.digest
FROM x FULL JOIN y ON x.page_id = y.page_id AND x.i = y.i
"""


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.spliced(turns, 100, 6), turns.select("conv_id"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT),"
        f" lambda a, b: list_reduce(range(8), lambda c, i: {step}, xor(a, b)), 4294967295), 4294967295)"
    )


SQL["op11_conversation_trie"] = f"""
WITH t AS (SELECT conv_id, turn, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS d, length(coalesce(text, '')) AS n
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(d, n) ORDER BY turn NULLS FIRST, d) AS own FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, {_crc32_sql('conv_id::VARCHAR')} % 6 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(c.own, [])[1:h.h], h.own[h.h + 1:]) AS w
      FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % 100),
k AS (SELECT conv_id, len(w) AS total, unnest(range(0, len(w) + 1)) AS depth, w FROM r),
p AS (SELECT conv_id, total, depth, CASE WHEN depth > 0 THEN w[depth].n ELSE 0 END AS n,
             list_transform(w[1:depth], lambda x: x.d) AS ds FROM k),
q AS (SELECT conv_id, total, depth, n, ds, array_to_string(ds, '') AS key, array_to_string(ds[1:depth - 1], '') AS up FROM p),
node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(n) AS n, any_value(ds) AS ds,
                coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = depth), '') AS ends
         FROM q GROUP BY key, depth),
kids AS (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON kids.up = node.key AND kids.depth = node.depth),
over_ AS (SELECT array_to_string(ds[1:a], '') AS key, a AS depth, n_children = 0 AS leaf, (n_convs - 1) * n AS saved
          FROM (SELECT ds, n_children, n_convs, n, unnest(range(0, depth + 1)) AS a FROM full_)),
sums AS (SELECT key, depth, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved FROM over_ GROUP BY ALL)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN sums USING (key, depth) LEFT JOIN node u ON u.key = f.up AND u.depth = f.depth - 1
"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periodic.collapse(periodic.planted(table(spark, sf_dir, "documents"), 10))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return done.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def _turn_digests(batches):
    """Task: blocks in the order of conversations to one row of digests each, read back from the formatted text."""
    key = None

    def row():
        return {"conv_id": [key], "n_turns": [n], "turns_sha256": [turns.hexdigest()], "loss_chars": [chars], "loss_sha256": [loss.hexdigest()], "formatted_chars": [size]}

    for batch in batches:
        rows = []
        for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")), strict=True):
            if conv != key:
                if key is not None:
                    rows.append(row())
                key, n, chars, size, turns, loss = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, said in chat.read_plain(text):
                turns.update(f"{role}\n{said}\n".encode())
                n += 1
            for s in spans:
                if s["role"] == "assistant":
                    said = chat.PLAIN.unescape(text[s["text_start"] : s["text_end"]])
                    loss.update(said.encode())
                    chars += len(said)
            size += len(text)
        if rows:
            yield pa.RecordBatch.from_pydict({c: [r[c][0] for r in rows] for c in rows[0]})
    if key is not None:
        yield pa.RecordBatch.from_pydict(row())


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    usual, dealt = chat.parts(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra))
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    done = usual.mapInArrow(_turn_digests, schema)
    if dealt is not None:
        done = done.union(dealt.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_turn_digests, schema))
    return done


def _signs_sql(text: str, signs) -> str:
    for sign, stand_in in signs:
        sign, stand_in = ("chr(10)" if x == "\n" else f"'{x}'" for x in (sign, stand_in))
        text = f"replace({text}, {sign}, {stand_in})"
    return text


SQL["op13_chat_formatting"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
           UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\\### Assistant: </turn> ok' FROM (SELECT unnest([0, 1]) AS n))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || {_signs_sql('role', chat._ROLE_SIGNS)} || ': ' || {_signs_sql('text', chat._SIGNS)} || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
