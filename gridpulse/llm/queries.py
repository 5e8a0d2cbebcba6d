"""The corpus operators as queries over whole tables, and SQL for those that it can express.

Each query gives the digest columns of its operator's result over every row of its
table, with the parameters of production; the operators themselves offer more.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import collocations, html, langid, lcp, manifest, mixing, packing, pii, quality, rans, simhash, urls, warc
from gridpulse.llm.common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The tokenizer of the packed and the written ids.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


#: Documents whose id has this remainder by 4 of its CRC-32 are held out.
HELD_OUT = 2


@query
def op1_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    identifier = langid.learn(docs, fold != HELD_OUT)
    judged = docs.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    found, names = langid.identified(judged, identifier)
    return found.select("doc_id", "held_out", *names)


@query
def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of all sources, weights being square roots of their sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("size"))
    docs, size = stored(docs, "sizes"), F.col("size")
    mix = mixing.mixed(docs, mixing.tempered(docs, size), size)
    return mix.select(F.col("id").alias("doc_id"), "source", F.col("size").alias("n_chars"), "block", "release", "deadline", "slot", "place")


@query
def op3_locally_consistent_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return lcp.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER))


@query
def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op6_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to entropy-coded files, then read back from them."""
    folder, blocks = rans.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return rans.read_tokens(folder, blocks)


@query
def op7_minimum_cut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op8_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, then read back from them."""
    folder, index = warc.write_archives(table(spark, sf_dir, "pages"))
    found = warc.read_archives(folder, index)
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op8_seekable_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for every document."""
    full, names, base, kept = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return full.select("doc_id", *names[1:], F.col(base).alias("base_failed"), F.col(kept).alias("kept"))


ORACLE_SQL["op9_quality_cascade"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r
),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
m AS (
  SELECT w.doc_id, w.t, w.ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(n_lines, 0) AS n_lines, cast(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND 10 * n_symbols <= n_words
  AND 2 * word_chars >= 5 * n_words AND word_chars <= 12 * n_words
  AND 2 * n_dup_lines <= n_lines
  AND 10 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{L}'))) <= 3 * n_words
  AND 2 * len(regexp_extract_all(t, '\p{Lu}')) <= word_chars
  AND 5 * len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) <= n_words AS kept
FROM b
"""


URL_RULES = [
    urls.Rule("com", "/", urls.ALLOW),
    urls.Rule("example.com", "/en/", urls.BLOCK),
    urls.Rule("www.example.com", "/en/", urls.ALLOW),
    urls.Rule("net", "/es/", urls.BLOCK),
    urls.Rule("net", "/fr/", urls.BLOCK),
]
#: Hosts with one of these as a word of their name are listed.
LISTED_HOSTS = "(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)"


@query
def op10_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    full, names = urls.judged(pages, URL_RULES, F.col("key").rlike(LISTED_HOSTS))
    return full.select("page_id", *names)


ORACLE_SQL["op10_bloom_cascade_urls"] = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
best AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM (SELECT page_id, host, path FROM p) LEFT JOIN (SELECT h, p AS rp, v FROM rules) r(h, p, v)
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule,
  coalesce(v, CASE WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""


@query
def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two or three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_son_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
),
f AS (
  SELECT lang, words, phrase, count(*) AS f
  FROM (
    SELECT lang, v.words, unnest(list_transform(range(1, len(ws) - v.words + 2), lambda i: array_to_string(ws[i:i + v.words - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) v(words) WHERE len(ws) >= v.words
  )
  GROUP BY ALL
),
totals AS (SELECT lang, cast(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE words > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, a, unnest([array_to_string(s[1:2], ' '), array_to_string(s[2:3], ' ')]) AS phrase FROM c WHERE words = 3)
  GROUP BY ALL
),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(s[1:k], ' ') AS first, array_to_string(s[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, words)) AS k FROM kept)
),
scored AS (
  SELECT cuts.*, x.f AS l, y.f AS r,
    cast((1000000::HUGEINT * cuts.a * cuts.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf and proof of every document, and the root that an offered document's leaf folds to."""
    docs = table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    offered = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaf = manifest.digest(*[F.col(f) for f in LEAF_FIELDS[:-1]], offered)
    found = manifest.proofs(manifest.build(docs, LEAF_FIELDS, carried={"offered": leaf}))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(manifest.siblings(F.col("proof")), 256).alias("proof_sha256"),
        manifest.folded(F.col("carried.offered"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _framed(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


_LEAF = " || ".join(_framed(f"{f}::VARCHAR") for f in LEAF_FIELDS[:-1])
#: CRC-32 of the decimal doc_id, bit by bit (fixed values: its polynomial, and all ones before and after).
_BYTE = "CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1)) ELSE 0 END"
_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295], range(0, 8 * length(doc_id::VARCHAR))),
  lambda c, i: xor(xor(c, {_BYTE}) >> 1, CASE WHEN xor(c, {_BYTE}) % 2 = 1 THEN 3988292384 ELSE 0 END)))"""


def _tree_sql(name: str, start: str) -> str:
    """CTEs of trees' nodes and of what stands beside each of them; `start` gives (tree, level, rank, digest, total)."""
    return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), any_value((total + 2) // 3)
  FROM {name} WHERE total > 1 GROUP BY tree, level, rank // 3
),
{name}_beside AS (
  SELECT a.tree, a.level, a.rank, coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS after
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.rank // 3 = b.rank // 3
  WHERE a.total > 1 GROUP BY a.tree, a.level, a.rank
)"""


def _fold_sql(name: str, beside: str, start: str) -> str:
    """CTE of the folds up a tree; `start` gives (id, tree, level, rank, digest, path)."""
    return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.rank // 3, sha256(before || f.digest || after), path || before || after
  FROM {name} f JOIN {beside} b ON f.tree = b.tree AND f.level = b.level AND f.rank = b.rank
)"""


ORACLE_SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE sent AS (
  SELECT *, CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS sent FROM documents
),
d AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, sha256({_LEAF} || {_framed('text')}) AS leaf,
      sha256({_LEAF} || {_framed('sent')}) AS offered FROM sent
  )
),
{_tree_sql('nodes', "SELECT tree, 0 AS level, rank, leaf AS digest, count(*) OVER (PARTITION BY tree) AS total FROM d")},
subroots AS (SELECT tree, digest FROM nodes WHERE total = 1),
{_tree_sql('tops', "SELECT 0 AS tree, 0 AS level, tree AS rank, digest, count(*) OVER () AS total FROM subroots")},
{_fold_sql('low', 'nodes_beside', "SELECT id, tree, 0 AS level, rank, offered AS digest, '' AS path FROM d")},
{_fold_sql('high', 'tops_beside', """SELECT id, 0 AS tree, 0 AS level, tree AS rank, arg_max(digest, level) AS digest,
    arg_max(path, level) AS path FROM low GROUP BY id, tree""")},
ends AS (SELECT id, arg_max(digest, level) AS folded_root, arg_max(path, level) AS path FROM high GROUP BY id)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(path) AS proof_sha256, folded_root, folded_root = r.digest AS verified
FROM d JOIN subroots s USING (tree) JOIN ends USING (id), (SELECT digest FROM tops WHERE total = 1) r
"""


@query
def op13_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    rows, base, every = pii.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(name).cast("long").alias(f"n_{kind}") for kind, name in base.items()]
    return rows.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(every).alias("spans"))
