"""The queries this subpackage registers, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodix.llm import decontaminate, dedup, licenses, ngram_join, packing, periodic_runs, pii, prefix_trie, quality, secret_scan, token_files, toxicity, url_filter
from periodix.llm.sample import in_fold
from periodix.llm.work import ship_package, work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rule list of the URL filter's query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: A key for the query's pseudonyms; real runs pass their own secret.
PII_KEY = "example-key"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path and verdict, by the listed rules and, where none fits, by rules mined from the pages they decide.

    Null urls, and those without ``://``, have an empty host and path; rows are judged one by one, whatever their ids."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of 0.9 or more of their distinct three-word shingles.

    Null and empty texts have no shingles and are their own component; a null id has a null one; rows with one id share its."""
    return ngram_join.similar_sets(_table(spark, sf_dir, "documents"), rule=ngram_join.Jaccard(words=3, percent=90))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts and single lines that are a known licence; null and empty texts match nothing, rows are judged one by one."""
    return licenses.scan(_table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and whether they are 5 % or more of its words.

    Null and empty texts have no words; items without an id or without words never occur; rows are judged one by one."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document from an additive model of the labelled ones that are not held out.

    Null and empty texts are scored like any other, equal texts alike; labels and ids that are null are not learned."""
    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = quality.train(docs, _table(spark, sf_dir, "labels"), held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document from a counterfactually regularised model of the labelled ones that are not held out.

    Null and empty texts score what the bias says, equal texts alike; labels and ids that are null are not learned."""
    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its valid private values replaced; a null text stays null, rows are treated one by one."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), PII_KEY)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 ids.

    A null text is empty and has only the end id; rows with null or repeated ids are documents of their own."""
    packed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to token files in ascending order of doc_id and read back.

    A null text is empty and has only the end id; a null id comes first, rows with one id in the order of their texts."""
    path = f"{work_folder(spark)}/token-files"
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    read = token_files.read_checksums(spark, path)
    index = token_files.chunk_index(spark, path).select("shard", "chunk", "start")
    return read.join(index, ["shard", "chunk"]).select("doc_id", (F.col("start") + F.col("chunk_start")).alias("start"), "n_tokens", "ids_crc32")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with equal texts but for white space; null and empty texts are equal, a null id never stays
    where its class has another."""
    return dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def _rebuilt(lists: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the one whose number is the next lower multiple of 20."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = lists.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base_id"), F.slice("turns", F.lit(1), F.lit(3)).alias("head"))
    rows = lists.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("base_id"), "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return rows.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), h), own)).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations, a row for each node.

    Null turn numbers come first, equal ones in the order of their turns' digests; null roles and texts are empty; rows with
    a null conversation id are left out; an empty table gives an empty result."""
    return prefix_trie.prefix_trie(_rebuilt(prefix_trie.turn_lists(_table(spark, sf_dir, "conversations"))))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: fixed patterns, and long runs that character Markov models take for random strings.

    Null and empty texts have none; rows with null or repeated ids are judged row by row."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    fixed = F.filter("spans", lambda s: s.kind != "markov")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", counted("assign"), counted("access"), counted("hex"),
        F.sha2(listed(fixed), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _repeating(docs: DataFrame) -> DataFrame:
    """``docs`` where every tenth text, by crc32 of its id, repeats the words from a given one on, as the query's contract says."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("words").cast("long"), F.floor(h / 10).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"))
    index = F.sequence(F.lit(0).cast("long"), n - 1)
    again = F.transform(index, lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return rows.select("doc_id", F.when((h % 10 == 0) & (n > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least four periods and six words in every document, and the texts without their repetitions.

    Words are separated by ASCII white space; every tenth text is first made to repeat itself. Null and empty texts
    have no runs; a null id stays null and its text as it is; rows repeated are judged row by row."""
    found = periodic_runs.periodic_runs(_repeating(_table(spark, sf_dir, "documents")))
    top, lines = F.get("runs", F.col("top")), F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top.start.alias("start"), top.length.alias("length"), top.period.alias("period"),
        F.floor(1000 * top.length / top.period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_url_filter, op2_ngram_jaccard_join, op3_license_scan, op4_benchmark_decontamination, op5_quality_classifier, op6_toxicity,
        op7_pii_pseudonyms, op8_pattern_packing, op9_token_files, op10_exact_dedup, op11_prefix_trie, op12_secret_scan, op13_periodic_runs)}

_WORDS4 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _license_sql() -> str:
    def canonical(text: str) -> str:
        out = f"regexp_replace({text}, '{licenses.COPYRIGHT_LINE.replace('(?imd)', '(?im)')}', ' ', 'g')"
        out = rf"' ' || lower(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
        for old, new in licenses.SPELLINGS:
            out = f"replace({out}, ' {old} ', ' {new} ')"
        return f"trim({out}, ' ')"

    known = ", ".join(f"('{name}', '{body.replace(chr(39), chr(39) * 2)}')" for name, body in licenses.KNOWN)
    return f"""
WITH known AS (SELECT sha256({canonical('body')}) AS digest, min(license_id) AS license_id
               FROM (VALUES {known}) AS k(license_id, body) GROUP BY 1),
units AS (
  SELECT doc_id, 'text' AS unit, 0 AS line, text AS body FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line', CAST(i AS INTEGER), string_split(text, chr(10))[i]
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS r(i)),
words AS (SELECT doc_id, unit, line, {canonical('body')} AS w FROM units)
SELECT doc_id, unit, line, license_id, digest
FROM (SELECT doc_id, unit, line, sha256(w) AS digest FROM words WHERE w <> '') JOIN known USING (digest)"""


def _url_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cases = ""
    for verdict, rule in sorted(URL_RULES, key=lambda r: (-len(r[1]), r)):
        name, _, start = rule.partition("/")
        cases += f" WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}') THEN {{'rule': '{rule}', 'verdict': '{verdict}'}}"
    plain = lambda x: f"regexp_replace({x}, '[0-9]+', '0', 'g')"
    return rf"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, url, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] END AS rest FROM pages),
hp AS (
  SELECT r, page_id, url, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
rows_ AS (SELECT *, CASE{cases} END AS listed FROM hp),
parts AS (
  SELECT r, unnest(list_concat(
    list_transform(list_filter(string_split({plain('host')}, '.')[:-2], lambda x: x <> ''), lambda x: 'host:' || x),
    list_transform(list_filter(string_split({plain('host')}, '.')[-1:], lambda x: x <> ''), lambda x: 'end:' || x),
    list_transform(list_filter(string_split(lower({plain('path')}), '/'), lambda x: x <> ''), lambda x: 'path:' || x),
    list_transform(list_filter(list_transform(string_split(lower({plain("regexp_extract(url, '[?]([^#]*)', 1)")}), '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'query:' || x),
    list_transform(list_filter([lower({plain("regexp_extract(url, '(?s)#(.*)$', 1)")})], lambda x: x <> ''), lambda x: 'fragment:' || x))) AS token
  FROM rows_ WHERE url IS NOT NULL),
tok AS (SELECT DISTINCT r, token FROM parts),
marked AS (SELECT r, token, listed.verdict AS label FROM tok JOIN rows_ USING (r) WHERE listed IS NOT NULL),
least AS (SELECT ceil({url_filter.MIN_SUPPORT} * count(DISTINCT r)) AS n FROM marked),
combos AS (
  SELECT r, label, [token] AS c FROM marked
  UNION ALL SELECT a.r, a.label, [a.token, b.token] FROM marked AS a JOIN marked AS b ON a.r = b.r AND a.token < b.token
  UNION ALL SELECT a.r, a.label, [a.token, b.token, d.token] FROM marked AS a JOIN marked AS b ON a.r = b.r AND a.token < b.token JOIN marked AS d ON a.r = d.r AND b.token < d.token),
every AS (SELECT c, count(*) AS n FROM combos GROUP BY c),
scored AS (
  SELECT c, label, count(*) AS support, count(*) / any_value(n) AS confidence FROM combos JOIN every USING (c) GROUP BY c, label HAVING count(*) >= (SELECT n FROM least)),
rules AS (
  SELECT row_number() OVER () AS k, * FROM scored AS s
  WHERE confidence >= {url_filter.MIN_CONFIDENCE} AND NOT EXISTS (
    SELECT 1 FROM scored AS p WHERE p.label = s.label AND len(p.c) < len(s.c) AND list_has_all(s.c, p.c) AND p.confidence >= s.confidence)),
fits AS (
  SELECT r, k FROM (SELECT k, unnest(c) AS token, len(c) AS size FROM rules) JOIN tok USING (token) JOIN rows_ USING (r)
  WHERE listed IS NULL GROUP BY r, k HAVING count(*) = any_value(size)),
best AS (
  SELECT r, label FROM fits JOIN rules USING (k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY confidence DESC, support DESC, len(c) DESC, array_to_string(c, ' ') DESC, label DESC) = 1)
SELECT page_id, host, path, listed.rule AS rule, coalesce(listed.verdict, label, 'allow') AS verdict FROM rows_ LEFT JOIN best USING (r)"""


def _crc32_sql(ids: str) -> str:
    """Recursive tables that give (id, crc) of the decimal ids that ``ids`` selects; after WITH RECURSIVE."""
    return f"""
crc_steps(id, rest, crc, bits) AS (
  SELECT id, CAST(id AS VARCHAR)[2:], xor(CAST(4294967295 AS BIGINT), CAST(ascii(CAST(id AS VARCHAR)[1]) AS BIGINT)), 8 FROM ({ids}) AS i(id)
  UNION ALL
  SELECT id, CASE WHEN bits = 0 THEN rest[2:] ELSE rest END,
         CASE WHEN bits = 0 THEN xor(crc, CAST(ascii(rest[1]) AS BIGINT))
              WHEN crc & 1 = 1 THEN xor(crc >> 1, CAST(3988292384 AS BIGINT)) ELSE crc >> 1 END,
         CASE WHEN bits = 0 THEN 8 ELSE bits - 1 END
  FROM crc_steps WHERE bits > 0 OR rest <> ''),
crcs AS (SELECT id, xor(crc, CAST(4294967295 AS BIGINT)) AS h FROM crc_steps WHERE bits = 0 AND rest = '')"""


def _secret_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    S = secret_scan
    located = " UNION ALL ".join(
        f"SELECT r, {k} AS rank, '{kind}' AS kind, text, regexp_extract_all(text, {quoted(p)}) AS h, string_split_regex(text, {quoted(p)}) AS g FROM d"
        for k, (kind, p) in enumerate(zip(S.KINDS, (S.ASSIGN, S.ACCESS, S.HEX, S.RUN))))
    listed = "coalesce(string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
located AS ({located}),
hits AS (
  SELECT r, rank, kind, h[k] AS value, list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:k - 1], lambda x: length(x))), 0) AS start
  FROM located, unnest(range(1, len(h) + 1)) AS u(k)),
spans AS (SELECT *, start + length(value) AS stop FROM hits WHERE kind <> 'assign' OR length(regexp_extract(value, {quoted(S.ASSIGN)}, 2)) >= {S.ASSIGNED_LENGTH}),
fixed AS (SELECT * FROM spans WHERE kind <> 'markov'),
sampled AS (
  SELECT doc_id, name FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS name FROM d WHERE doc_id IS NOT NULL) ORDER BY md5(name), name LIMIT {S.SAMPLE_IDS}),
strings AS (
  SELECT CASE kind WHEN 'assign' THEN regexp_extract(value, {quoted(S.ASSIGN)}, 2) ELSE value END AS value, true AS random FROM fixed
  UNION ALL SELECT to_base64(unhex(sha256(name))), true FROM sampled
  UNION ALL SELECT unnest(regexp_extract_all(text, {quoted(S.ORDINARY)})), false
  FROM d JOIN sampled USING (doc_id) WHERE r NOT IN (SELECT r FROM fixed)),
seen AS (
  SELECT random, value[i] AS a, value[i + 1] AS b, count(*) AS n FROM strings, unnest(range(1, length(value))) AS u(i) GROUP BY ALL),
letters AS (SELECT '{S.ALPHABET}'[i] AS c FROM range(1, {len(S.ALPHABET) + 1}) AS t(i)),
smooth AS (
  SELECT x.c AS a, y.c AS b, 1 + coalesce(p.n, 0) AS p, 1 + coalesce(q.n, 0) AS q
  FROM letters AS x CROSS JOIN letters AS y LEFT JOIN seen AS p ON p.random AND p.a = x.c AND p.b = y.c LEFT JOIN seen AS q ON NOT q.random AND q.a = x.c AND q.b = y.c),
weights AS (
  SELECT a, b, CAST(round(1000 * (ln(p / sum(p) OVER w) - ln(q / sum(q) OVER w))) AS BIGINT) AS weight FROM smooth WINDOW w AS (PARTITION BY a)),
runs AS (
  SELECT row_number() OVER () AS m, * FROM spans AS s
  WHERE kind = 'markov' AND NOT EXISTS (SELECT 1 FROM fixed AS f WHERE f.r = s.r AND f.start < s.stop AND s.start < f.stop)),
scores AS (
  SELECT m, sum(weight) AS score FROM (SELECT m, value[i] AS a, value[i + 1] AS b FROM runs, unnest(range(1, length(value))) AS u(i)) JOIN weights USING (a, b) GROUP BY m),
kept AS (
  SELECT r, rank, kind, start, stop FROM fixed
  UNION ALL SELECT r, rank, kind, start, stop FROM runs JOIN scores USING (m) WHERE score >= {S.MARGIN} * (stop - start - 1)),
base AS (
  SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex, {listed} AS listed FROM fixed GROUP BY r),
every AS (SELECT r, {listed} AS listed FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base.listed, '')) AS base_sha256, coalesce(every.listed, '') AS spans
FROM d LEFT JOIN base USING (r) LEFT JOIN every USING (r)"""


ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": _url_sql(),
    "op2_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS gram FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s AS a JOIN s AS b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * inter >= 90 * (x.size + y.size - inter)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, component_id
FROM d JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op3_license_scan": _license_sql(),
    "op4_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
b AS (SELECT item_id, {_WORDS4} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(w) AS size, array_to_string(w, ' ') AS gram FROM b WHERE len(w) BETWEEN 1 AND 12
  UNION
  SELECT DISTINCT item_id, 13, array_to_string(w[i:i+12], ' ') FROM b, unnest(range(1, len(w) - 11)) AS r(i) WHERE len(w) >= 13),
sizes AS (SELECT DISTINCT size FROM win),
occ AS (
  SELECT DISTINCT doc_id, item_id, i, size FROM (
    SELECT doc_id, i, size, array_to_string(w[i:i+size-1], ' ') AS gram
    FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS r(i) WHERE len(w) >= size) JOIN win USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM occ, unnest(range(i, i + size)) AS r(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM occ GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op10_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
       sha256(body) AS text_sha256
FROM n WINDOW g AS (PARTITION BY body)""",
    "op11_prefix_trie": rf"""
WITH RECURSIVE {_crc32_sql("SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL")},
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
digests AS (
  SELECT conv_id, turn, md5(concat(length(role), ':', role, text)) AS d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
texts AS (SELECT DISTINCT d, words FROM digests),
lists AS (SELECT conv_id, list(d ORDER BY turn NULLS FIRST, d) AS own FROM digests GROUP BY conv_id),
rebuilt AS (
  SELECT l.conv_id, list_concat(coalesce(b.own[1:h % 4], []), l.own[h % 4 + 1:]) AS path
  FROM lists AS l JOIN crcs ON id = l.conv_id LEFT JOIN lists AS b ON b.conv_id = l.conv_id - l.conv_id % 20),
steps AS (
  SELECT conv_id, CAST(d AS BIGINT) AS depth, len(path) AS whole, md5(array_to_string(path[1:d], '')) AS node, path[d] AS last,
         CASE WHEN d > 0 THEN md5(array_to_string(path[1:d - 1], '')) END AS parent
  FROM rebuilt, unnest(range(0, len(path) + 1)) AS u(d)),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce((count(*) - 1) * max(words), 0) AS saved,
         coalesce(string_agg(CASE WHEN depth = whole THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM steps LEFT JOIN texts ON d = last GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes GROUP BY parent),
below AS (SELECT DISTINCT a.node AS top, b.node FROM steps AS a JOIN steps AS b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
subtrees AS (
  SELECT top, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves
  FROM below JOIN nodes USING (node) LEFT JOIN children AS c USING (node) GROUP BY top)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved_tokens,
       sha256(x.ends) AS ends_sha256
FROM nodes AS x JOIN subtrees ON top = x.node LEFT JOIN nodes AS p ON p.node = x.parent LEFT JOIN children AS c ON c.node = x.node""",
    "op12_secret_scan": _secret_sql(),
    "op13_periodic_runs": rf"""
WITH RECURSIVE {_crc32_sql("SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL")},
plain AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
shaped AS (
  SELECT r, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS again, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a
  FROM plain LEFT JOIN crcs ON id = doc_id),
texts AS (
  SELECT r, doc_id, n, CASE WHEN again THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
                            ELSE w END AS w
  FROM shaped),
words AS (SELECT r, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts),
-- every run has at least five words in a row that equal those one period later
grams AS (SELECT r, n, CAST(i AS BIGINT) AS i, array_to_string(w[i + 1:i + 5], ' ') AS gram FROM texts, unnest(range(0, n - 4)) AS u(i)),
pairs AS (SELECT x.r, y.i - x.i AS q, x.i FROM grams AS x JOIN grams AS y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island),
found AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= 6 AND length >= 4 * q GROUP BY r, start, length),
lists AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM found GROUP BY r),
top AS (
  SELECT r, start, length, period FROM found
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
dropped AS (
  SELECT DISTINCT words.r, i FROM words JOIN found ON words.r = found.r AND i >= start + period AND i < start + length),
collapsed AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts LEFT JOIN lists USING (r) LEFT JOIN top USING (r) LEFT JOIN collapsed USING (r)""",
}
