"""The registered queries of the text operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import bucket_refine, cascade, decontaminate, jaccard, lexical, monoid_bpe, packing, pii, piece_count, recompression, revisit
from waymark.llm import variants as spelling
from waymark.llm import toxicity as tox


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tox.toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"), max_train=20_000)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisit.resolve(revisit.page_records(_table(spark, sf_dir, "pages")))
    return found.select("record_id", "url_key", "ts", F.coalesce("refers_to", F.lit(-1)).alias("refers_to"), "outcome", revisit.headers_text(F.col("headers")).alias("headers"), "payload_digest")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.quality(_documents(spark, sf_dir)).drop("first_failed")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return pii.find_pii(_documents(spark, sf_dir)).select(
        "doc_id",
        *[pii.count_of(spans, k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.spans_text(spans, tuple(pii.BASE)), 256).alias("base_sha256"),
        pii.spans_text(spans).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(_documents(spark, sf_dir), window=35, outputs=("n_words", "n_removed", "kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_links: the other documents that a document links with."""
    return jaccard.jaccard_components(_documents(spark, sf_dir), shingle=3, least=90).select("doc_id", "n_shingles", "component_id", "n_links")


def op3_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at the corpus pipeline's shingles of five words and similarity of 0.8."""
    return jaccard.jaccard_components(_documents(spark, sf_dir), shingle=5, least=80).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_refine.remove_repeats(_documents(spark, sf_dir), window=400, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monoid_bpe.encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir), least_length=5, least_count=3, ratio=2, drop_one_in=97)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"), top=10)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, terminator=0, outputs=("ids_crc32",))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_recompression, op3_jaccard_join, op3_jaccard_links, op4_token_counts, op5_revisits, op6_bucket_refinement, op7_quality, op8_byte_bpe, op9_decontaminate, op10_pii, op11_variants, op12_lexical_search, op13_packing)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PLAIN = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op2_recompression": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) t(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, j FROM twice, unnest(range(i, i + 35)) t(j)),
lists AS (SELECT doc_id, list(j) AS js, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: js IS NULL OR NOT list_contains(js, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS s FROM d, unnest(range(1, greatest(2, len(w) - 1))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON r = x)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, coalesce(min(r), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op5_revisits": r"""
WITH base AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, url, length(html) AS size, md5(html) AS digest,
    '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS day,
    lower(regexp_extract(url, '^(?i:https?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1)) AS h,
    regexp_extract(url, '^(?i:https?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2) AS p,
    regexp_extract(url, '^(?i:https?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3) AS q
  FROM pages),
keyed AS (
  SELECT page_id, size, digest, day,
    regexp_replace(regexp_replace(h, '^www\.', ''), ':(80|443)$', '') || regexp_replace(regexp_replace(p, '/index\.html?$', '/'), '/+$', '')
      || CASE WHEN len(params) = 0 THEN '' ELSE '?' || array_to_string(params, '&') END AS url_key
  FROM (SELECT *, list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params FROM base)),
full_r AS (SELECT 2 * page_id AS record_id, url_key, 10 * page_id AS ts, '"' || digest || '"' AS etag, day AS last_modified, digest, size, day FROM keyed),
again AS (
  SELECT 2 * page_id + 1 AS record_id, url_key, 10 * page_id + CASE WHEN size % 5 = 0 THEN -5 ELSE 5 END AS ts,
    CASE WHEN size % 7 = 0 THEN '"changed"' WHEN size % 11 = 0 THEN NULL ELSE '"' || digest || '"' END AS etag,
    CASE WHEN size % 11 = 0 THEN day END AS last_modified, day FROM keyed),
matched AS (
  SELECT a.*, f.record_id AS f_id, f.etag AS f_etag, f.last_modified AS f_mod, f.digest AS f_digest, f.size AS f_size,
    row_number() OVER (PARTITION BY a.record_id ORDER BY f.ts DESC, f.record_id DESC) AS rn
  FROM again a LEFT JOIN full_r f ON a.url_key = f.url_key AND f.ts < a.ts),
judged AS (
  SELECT *, CASE WHEN f_id IS NULL THEN 'no_earlier_response'
    WHEN etag IS NOT NULL THEN CASE WHEN etag = f_etag THEN 'resolved' ELSE 'validator_mismatch' END
    WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = f_mod THEN 'resolved' ELSE 'validator_mismatch' END
    ELSE 'unverified' END AS outcome
  FROM matched WHERE rn = 1)
SELECT record_id, url_key, CAST(ts AS BIGINT) AS ts, CASE WHEN outcome IN ('resolved', 'unverified') THEN f_id ELSE -1 END AS refers_to, outcome,
  CASE WHEN outcome IN ('resolved', 'unverified')
    THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || f_size || chr(10) || 'content-type: text/html' || chr(10) || 'date: later than ' || day
    ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10) || 'date: later than ' || day END AS headers,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN f_digest END AS payload_digest
FROM judged
UNION ALL
SELECT record_id, url_key, CAST(ts AS BIGINT), -1, 'full', 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || day, digest FROM full_r
""",
    "op7_quality": rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s FROM w, unnest(range(1, len(words) - 1)) t(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT j) AS n FROM twice, unnest(range(i, i + 3)) t(j) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, text, words, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeated r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_words > 100000 OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 5 * n_dup_lines > 2 * n_lines
    OR 2 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > length(regexp_replace(text, '[^A-Za-z]+', '', 'g'))
    OR 10 * length(regexp_replace(text, '[^!]+', '', 'g')) > n_words
    OR 5 * len(list_filter(words, lambda x: NOT regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) > n_words) AS kept
FROM b
""",
    "op9_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS k FROM (SELECT item_id, {_PLAIN} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM b, unnest(range(1, len(w) - k + 2)) t(i)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s FROM d, ks, unnest(range(1, len(w) - k + 2)) t(i) WHERE len(w) >= k),
h AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, s)),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM h, unnest(range(i, i + k)) t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}


#: Texts are hexadecimal, two digits a byte, in chunks that overlap by a window less a byte. Only starts whose first 64 bytes are met twice can begin a repeated window.
ORACLES["op6_bucket_refinement"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunk AS (SELECT doc_id, 512 * k AS base, substr(h, 1024 * k + 1, 1024 + 798) AS s FROM d, unnest(range(0, (length(h) // 2 + 511) // 512)) t(k)),
gram AS (SELECT doc_id, base, j, hash(substr(s, 2 * j + 1, 128)) AS g FROM chunk, unnest(range(0, least(512, length(s) // 2 - 399))) t(j)),
met AS (SELECT doc_id, base, j FROM gram SEMI JOIN (SELECT g FROM gram GROUP BY g HAVING count(*) > 1) USING (g)),
windows AS (SELECT doc_id, base + j AS i, md5(substr(s, 2 * j + 1, 800)) AS w FROM met JOIN chunk USING (doc_id, base)),
twice AS (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -401) AS before FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM (SELECT *, count(*) FILTER (WHERE i > before + 400) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM twice) GROUP BY doc_id, k),
piece AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM span),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head, max(b) AS rest FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, 2 * rest + 1) END)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

_LAST = "SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles,"
ORACLES["op3_jaccard_join"] = ORACLES["op3_jaccard_join"].replace(_LAST, _LAST + " (SELECT count(*) FROM both_ways WHERE x = d.doc_id) AS n_links,")
_FIVE = {"len(w) < 3": "len(w) < 5", "w[i : i + 2]": "w[i : i + 4]", "len(w) - 1)": "len(w) - 3)", ">= 90 *": ">= 80 *"}
ORACLES["op3_jaccard_links"] = ORACLES["op3_jaccard_join"]
for _three, _five in _FIVE.items():
    ORACLES["op3_jaccard_links"] = ORACLES["op3_jaccard_links"].replace(_three, _five)

ORACLES["op11_variants"] = r"""
WITH RECURSIVE crcs AS (SELECT 0 AS k, x AS i, CAST(x AS BIGINT) AS c FROM range(256) t(x)
  UNION ALL SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crcs WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM crcs WHERE k = 8),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY 1, 2),
bytes AS (SELECT doc_id, run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS s FROM runs),
summed AS (SELECT doc_id, run, n, xor(4294967295, list_reduce(list_transform(range(0, length(s) // 2), lambda j: CAST('0x' || s[2 * j + 1 : 2 * j + 2] AS BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS h FROM bytes, tab),
kept AS (SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
without AS (SELECT word, n, p, word[1 : p] || word[p + 2 :] AS d FROM words, unnest(range(0, length(word))) t(p)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM without a JOIN without b ON a.d = b.d AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.d = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS stop FROM forms UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = stop WHERE form IS NOT NULL)
SELECT f.word, f.form, stop AS root, f.n, f.n_near, f.form_n FROM walk JOIN forms e ON e.word = stop AND e.form IS NULL JOIN forms f ON f.word = walk.word
"""

_TERMS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
ORACLES["op12_lexical_search"] = f"""
WITH t AS (SELECT doc_id, {_TERMS} FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
m AS (SELECT doc_id, 10 + 90 * n * docs // total AS m FROM n, whole),
items AS (SELECT DISTINCT item_id, {_TERMS} FROM benchmark),
scores AS (SELECT item_id, doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM items JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0) WHERE rank <= 10
"""
