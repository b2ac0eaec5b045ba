"""The registered queries of this package, each over its whole table, and the SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import (
    byte_bpe,
    chat_format,
    embedding_dedup,
    exact_topk,
    fill_middle,
    filter_audit,
    html_extract,
    language_id,
    line_dedup,
    minhash_dedup,
    mixing,
    quality_rules,
    toxicity,
)
from recurra.llm.stopwords import ALL_STOP_WORDS

QUERY_EVERY = 50
SCALE = 256
TOP = 5
VOCABULARY = "byte_bpe_50k.tiktoken"
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every 50th embedding by integer inner product."""
    given = _table(spark, sf_dir, "embeddings").where(exact_topk.usable("embedding"))
    vectors = given.select("vec_id", exact_topk.scaled("embedding", SCALE).alias("vector"))
    found = exact_topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), TOP)
    most = 2**63 - 1
    return found.withColumn("score", F.greatest(F.lit(-most), F.least(F.lit(most), F.col("score"))).cast("long"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of two thirds of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out(F.col("doc_id"))
    found = toxicity.classified(docs, docs.where(~held_out), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").alias("predicted"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between embeddings at a cosine of 0.95 or more."""
    given = _table(spark, sf_dir, "embeddings")
    return embedding_dedup.near_duplicates(given.select("vec_id", F.col("embedding").alias("vector")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents that bring the two quality domains to their target weights."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rated = mixing.rates(docs, mixing.quality_domains(labels), mixing.QUALITY_TARGETS, mixing.BUDGET)
    return rated.select(
        "doc_id", "n_tokens", F.element_at("posteriors", "high").alias("p_high"), "rate", "copies"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without recurring lines, by template and word for word."""
    found = line_dedup.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_dropped")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings: logged as deltas, edits and regenerations, folded, formatted, read back."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, k, role, CONTROL_TEXT) for k, role in enumerate(("user", "assistant"))], given.schema)
    events = chat_format.streamed(chat_format.events_of_turns(given.union(extra)))
    return chat_format.digests(chat_format.formatted(events))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a public vocabulary, and decoded again."""
    shared = byte_bpe.shared_ranks(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), shared)


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_extract.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    found = language_id.identified(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by five-word shingles."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = quality_rules.judged(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-the-middle form, and rebuilt from that form."""
    moved = fill_middle.transformed(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restored(moved.drop("text"))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of all documents, in every order."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: The same rules by DuckDB, with texts where Spark has hashes and lists of constants where it has checksums.
LINE_DEDUP = """
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), tidy AS (
  SELECT doc_id, place, raw, trim(regexp_replace(raw, '[ \\t\\r\\f\\x0B]+', ' ', 'g')) AS bare FROM split
), lines AS (
  SELECT DISTINCT doc_id, bare, string_split(regexp_replace(bare, '[^ ]*[0-9][^ ]*', '<*>', 'g'), ' ') AS tokens FROM tidy
), verbatim AS (
  SELECT bare, min(doc_id) AS first FROM lines WHERE length(bare) >= 10 GROUP BY bare
  HAVING count(DISTINCT doc_id) >= CASE WHEN length(bare) >= 20 THEN 2 ELSE 3 END
), contents AS (
  SELECT tokens, len(tokens) AS n, tokens[1:3] AS head, count(DISTINCT doc_id) AS docs FROM lines WHERE len(tokens) >= 4 GROUP BY tokens
), spread AS (
  SELECT tokens, n, head, docs, unnest(tokens) AS token, unnest(range(len(tokens))) AS spot FROM contents
), constants AS (
  SELECT n, head, spot, token FROM spread WHERE spot >= 3 AND token <> '<*>' GROUP BY n, head, spot, token HAVING sum(docs) >= 3
), templates AS (
  SELECT s.tokens, n, head, list((spot, token) ORDER BY spot) AS template FROM spread s JOIN constants c USING (n, head, spot, token)
  GROUP BY s.tokens, n, head HAVING count(*) >= 0.6 * (n - 3)
), members AS (
  SELECT l.doc_id, l.bare, n, head, template FROM lines l JOIN templates t USING (tokens)
), recurring AS (
  SELECT n, head, template, min(doc_id) AS first FROM members GROUP BY n, head, template HAVING count(DISTINCT doc_id) >= 3
), dropped AS (
  SELECT l.doc_id, l.bare FROM lines l JOIN verbatim v USING (bare) WHERE l.doc_id > v.first
  UNION
  SELECT m.doc_id, m.bare FROM members m JOIN recurring r USING (n, head, template) WHERE m.doc_id > r.first
), kept AS (
  SELECT t.doc_id, string_agg(t.raw, chr(10) ORDER BY t.place) FILTER (WHERE d.bare IS NULL) AS text,
         count(*) AS n_lines, count(d.bare) AS n_dropped
  FROM tidy t LEFT JOIN dropped d USING (doc_id, bare) GROUP BY t.doc_id
)
SELECT o.doc_id, CASE WHEN k.doc_id IS NULL THEN o.text ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents o LEFT JOIN kept k USING (doc_id)
"""

#: Counts by list functions, windows of five words as rows; the rules of the threshold table spelled out.
QUALITY_RULES = r"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lang FROM documents
), split AS (
  SELECT r, doc_id, text, coalesce(lang IN ('de', 'en', 'es', 'fr'), false) AS listed,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM given
), starts AS (
  SELECT r, w, unnest(range(1, len(w) - 3)) AS spot FROM split WHERE len(w) >= 5
), windows AS (
  SELECT r, spot, count(*) OVER (PARTITION BY r, w[spot], w[spot + 1], w[spot + 2], w[spot + 3], w[spot + 4]) AS times FROM starts
), covered AS (
  SELECT r, count(DISTINCT spot + k) AS n FROM windows, range(5) AS t(k) WHERE times > 1 GROUP BY r
), counts AS (
  SELECT s.r, doc_id, text, listed, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_capitals,
         len(list_filter(w, lambda x: lower(x) IN (STOPS))) AS n_stops,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣◦]'))) AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_dots,
         coalesce(c.n, 0) AS n_repeat_words,
         regexp_matches(text, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]') AS unspaced
  FROM split s LEFT JOIN covered c ON s.r = c.r
), ruled AS (
  SELECT *, coalesce(chars, 0) AS word_chars, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN NOT unspaced AND (chars < 2.0 * n_words OR chars > 15.0 * n_words) THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN n_words > 0 AND n_letters / chars < 0.4 THEN 'letters' END,
      CASE WHEN n_letters > 0 AND n_capitals / n_letters > 0.5 THEN 'capitals' END,
      CASE WHEN n_words >= 50 AND listed AND n_stops / n_words < 0.05 THEN 'stop_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END,
      CASE WHEN n_lines >= 10 AND n_dup_lines / n_lines > 0.3 THEN 'repeated_lines_long' END,
      CASE WHEN n_lines >= 5 AND n_bullets / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines >= 5 AND n_dots / n_lines > 0.3 THEN 'ellipsis_lines' END) AS broken_rules
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken_rules = '' AS kept, broken_rules
FROM ruled
""".replace("STOPS", ", ".join(f"'{word}'" for word in sorted(ALL_STOP_WORDS)))

#: The contract by DuckDB's string functions; the text is cut and joined, nothing is rotated.
FILL_MIDDLE = """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents
), drawn AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
         ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM given
), shaped AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1, n - b) AS suffix FROM shaped
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

#: The filters one by one in each of the orders, as flags of whole documents.
FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), flags AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM words
), marks AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), docs AS (
  SELECT f.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM flags f LEFT JOIN marks m ON f.doc_id = m.doc_id
), sets AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM docs GROUP BY ALL
), letters AS (
  SELECT unnest(range(1, 6)) AS x
), orders AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), run AS (
  SELECT part, fails, n, good, toxic, o, step, fails[o[step]] AS here,
         list_bool_or(list_transform(o[1:step - 1], lambda x: fails[x])) IS TRUE AS before,
         len(list_filter(fails, lambda x: x)) AS width
  FROM sets, orders, range(1, 6) AS t(step)
), counted AS (
  SELECT part, o, step, o[step] AS own,
         coalesce(sum(n) FILTER (WHERE NOT here AND NOT before), 0) AS kept, coalesce(sum(n) FILTER (WHERE here AND NOT before), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE here AND before), 0) AS redundant, coalesce(sum(n) FILTER (WHERE here AND width = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE here AND NOT before), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE here AND NOT before), 0) AS toxic_lost
  FROM run GROUP BY part, o, step
)
SELECT part, array_to_string(list_transform(o, lambda x: chr((64 + x)::INTEGER)), '') AS filter_order, step::INTEGER AS step,
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_toxicity": op2_toxicity,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_html_extract": op8_html_extract,
    "op9_language_id": op9_language_id,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_fill_middle": op12_fill_middle,
    "op13_filter_audit": op13_filter_audit,
}

CHAT_FORMAT = r"""WITH given AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM given),
marked AS (
    SELECT *, [regexp_replace(replace(x, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|</?SYS>>|n>)', '\1\\\2', 'g') FOR x IN [role, text]] AS safe
    FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|>' || replace(safe[1], chr(10), '<n>') || chr(10) || safe[2] || '<|im_end|>' || chr(10))) AS BIGINT)
        AS formatted_chars
FROM marked GROUP BY conv_id"""

EXACT_TOPK = """WITH usable AS (
    SELECT vec_id, min([CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored) WHERE place <= 5"""

EMBEDDING_DEDUP = """WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
    SELECT vec_id AS node, vec_id AS least FROM embeddings
    UNION SELECT links.b, reached.least FROM reached JOIN links ON links.a = reached.node WHERE reached.least < links.b),
smallest AS (SELECT node, min(least) AS component_id FROM reached GROUP BY node),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest ON node = vec_id LEFT JOIN counted ON a = vec_id"""

MINHASH_DEDUP = r"""WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingled AS (
    SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
    FROM worded WHERE len(w) > 0),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_hold
    FROM (SELECT * FROM shingled JOIN sized USING (doc_id)) x JOIN (SELECT * FROM shingled JOIN sized USING (doc_id)) y
      ON x.s = y.s AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
    GROUP BY x.doc_id, y.doc_id),
found AS (
    SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
    WHERE 100 * both_hold >= 75 * (x.n + y.n - both_hold)),
links AS (SELECT a, b FROM found UNION ALL SELECT b, a FROM found),
reached AS (
    SELECT doc_id AS node, doc_id AS least FROM documents
    UNION SELECT links.b, reached.least FROM reached JOIN links ON links.a = reached.node WHERE reached.least < links.b),
smallest AS (SELECT node, min(least) AS component_id FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN smallest ON node = d.doc_id LEFT JOIN sized ON sized.doc_id = d.doc_id"""

ORACLES: dict[str, str] = {
    "op1_exact_topk": EXACT_TOPK,
    "op3_embedding_dedup": EMBEDDING_DEDUP,
    "op10_minhash_dedup": MINHASH_DEDUP,
    "op6_chat_format": CHAT_FORMAT,
    "op5_line_dedup": LINE_DEDUP,
    "op11_quality_rules": QUALITY_RULES,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_filter_audit": FILTER_AUDIT,
}
