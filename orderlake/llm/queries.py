"""Registered queries of the operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm.common import documents
from orderlake.llm.license_scan import license_matches
from orderlake.llm.merkle import fingerprints
from orderlake.llm.minhash import near_duplicates
from orderlake.llm.mixing import mix
from orderlake.llm.packing import pack
from orderlake.llm.permutation_index import neighbours
from orderlake.llm.prefix_trie import prefix_trie
from orderlake.llm.secret_scan import secret_report
from orderlake.llm.speculative_bpe import bpe_round_trip
from orderlake.llm.spelling import spelling_variants
from orderlake.llm.suffix_dedup import without_repeats
from orderlake.llm.tokens import token_counts
from orderlake.llm.toxicity import toxicity_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(documents(spark, sf_dir))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir))


@query
def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


@query
def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


@query
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLES["op5_merkle_fingerprints"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT doc_id, text, length(text) AS n, length(text) // 3 AS k,
         coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS nt
  FROM d),
e AS (SELECT *, left(text, n - k) || left(nt, k) AS edited FROM o),
g AS (
  SELECT doc_id, n, edited,
         list_transform(regexp_extract_all(text, '[^\n.!?]{0,95}[.!?\n]+|[^\n.!?]{1,96}'), lambda x: md5(x)) AS own_w,
         list_transform(regexp_extract_all(edited, '[^\n.!?]{0,95}[.!?\n]+|[^\n.!?]{1,96}'), lambda x: md5(x)) AS other_w,
         list_transform(regexp_extract_all(nt, '[^\n.!?]{0,95}[.!?\n]+|[^\n.!?]{1,96}'), lambda x: left(md5(x), 8)) AS nxt
  FROM e),
f AS (
  SELECT *, array_to_string(own_w, '') AS own_s, array_to_string(other_w, '') AS other_s, least(len(own_w), len(other_w)) AS m,
         list_transform(own_w, lambda x: left(x, 8)) AS own, list_transform(other_w, lambda x: left(x, 8)) AS other FROM g),
p AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, m + 1), lambda i: own_w[i] = other_w[i]), false), 0) - 1, m) AS same FROM f),
q AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, m - same + 1),
    lambda i: own_w[len(own_w) - i + 1] = other_w[len(other_w) - i + 1]), false), 0) - 1, m - same) AS ends FROM p)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
  md5(array_to_string(list_transform(regexp_extract_all(own_s, '(?:[2-9a-f][0-9a-f]{31})*[01][0-9a-f]{31}|(?:[2-9a-f][0-9a-f]{31})+'), lambda x: md5(x)), '')) || ':' || array_to_string(own, '') AS fingerprint,
  md5(array_to_string(list_transform(regexp_extract_all(other_s, '(?:[2-9a-f][0-9a-f]{31})*[01][0-9a-f]{31}|(?:[2-9a-f][0-9a-f]{31})+'), lambda x: md5(x)), '')) || ':' || array_to_string(other, '') AS edited_fingerprint,
  CASE WHEN len(list_distinct(own)) + len(list_distinct(other)) = 0 THEN 1.0::DOUBLE
       ELSE 2 * len(list_intersect(own, other))::DOUBLE / (len(list_distinct(own)) + len(list_distinct(other))) END AS near_edited,
  CASE WHEN len(list_distinct(own)) + len(list_distinct(nxt)) = 0 THEN 1.0::DOUBLE
       ELSE 2 * len(list_intersect(own, nxt))::DOUBLE / (len(list_distinct(own)) + len(list_distinct(nxt))) END AS near_next,
  same AS edit_start, len(own_w) - same - ends AS edit_removed, len(other_w) - same - ends AS edit_added
FROM q
"""

# Matches are found by splitting a text at them, as positions are not returned by the functions.
ORACLES["op9_secret_scan"] = r"""
WITH rule(kind, k, pat, grp, least) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 1, '(AKIA[A-Z0-9]+)', 1, 20),
  ('hex', 2, '([0-9a-f]+)', 1, 24)),
blob AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT text, kind, k, least, regexp_split_to_array(text, pat) AS parts,
         regexp_extract_all(text, pat, 0) AS found,
         CASE grp WHEN 2 THEN regexp_extract_all(text, pat, 2) ELSE regexp_extract_all(text, pat, 1) END AS vals
  FROM blob, rule WHERE regexp_matches(text, pat)),
each AS (
  SELECT text, kind, k, least, i, length(parts[i]) AS gap, length(found[i]) AS len, length(vals[i]) AS val
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM cut)),
placed AS (
  SELECT text, kind, k, val >= least AS ok, len,
         sum(gap + len) OVER (PARTITION BY text, kind ORDER BY i) AS stop FROM each),
agg AS (
  SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(stop - len AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY stop - len, k) AS spans
  FROM placed WHERE ok GROUP BY text)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN agg a ON coalesce(d.text, '') = a.text
"""

# The checksum is worked out byte by byte, from a table that is made here. Words that lack the same
# letter at the same place, or one of which lacks a letter of the other, are near.
ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (
  SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS s FROM runs),
sums AS (
  SELECT run, k, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(1, length(s), 2), lambda i: CAST('0x' || substr(s, i, 2) AS BIGINT))),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc),
v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM sums) GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3),
cut AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.rest = v.word
  UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.rest = v.word),
ranked AS (
  SELECT near.word, other, v.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) AS r
  FROM near JOIN v ON v.word = other),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
         CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN ranked ON ranked.word = v.word AND r = 1),
way AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT way.word, formed.form, step + 1 FROM way JOIN formed ON formed.word = root AND formed.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, n, n_near, form_n
FROM formed JOIN way USING (word) GROUP BY word, form, n, n_near, form_n
"""

# A node stands for its members by the smallest one, whose prefixes are the nodes above it.
ORACLES["op13_prefix_trie"] = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS b, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (
  SELECT v.c, 0 AS part, p, role, text FROM convs v JOIN turns t ON t.c = v.b AND p < h
  UNION ALL SELECT v.c, 1, p, role, text FROM convs v JOIN turns t ON t.c = v.c AND p >= h),
seq AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, length(text) AS len,
         length(role) || ':' || role || md5(text) AS turn FROM rebuilt),
pre AS (
  SELECT c, d, len, md5(string_agg(turn, '|') OVER (PARTITION BY c ORDER BY d)) AS key FROM seq
  UNION ALL SELECT c, 0, 0, 'root' FROM convs),
linked AS (
  SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS above, d = max(d) OVER (PARTITION BY c) AS last FROM pre),
node AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, max(len) AS len, any_value(above) AS above,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM linked GROUP BY key, d),
kids AS (SELECT above AS key, count(*) AS n FROM node WHERE above IS NOT NULL GROUP BY above),
below AS (
  SELECT a.key, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((y.n_convs - 1) * y.len) AS saved
  FROM node y JOIN pre a ON a.c = y.conv_id AND a.d <= y.d LEFT JOIN kids ON kids.key = y.key GROUP BY a.key)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n_convs, coalesce(kids.n, 0) AS n_children,
       n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM node x JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN node up ON up.key = x.above
"""
