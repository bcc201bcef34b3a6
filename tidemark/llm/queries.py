"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontam, jaccard, lm, media, packing, quality, secrets, sharding, spelling, substring, toxicity, warc
from .common import read_table

#: Where the public tokenizers' files are; every operator takes these as parameters.
PACK_VOCABULARY = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
SCAN_VOCABULARY = PACK_VOCABULARY[1:]
ALIGNED_VOCABULARIES = (*SCAN_VOCABULARY, public_tokenizers.path("piece_bpe_32k.model"))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), PACK_VOCABULARY).drop("ids")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(read_table(spark, sf_dir, "pages"), warc.archive_dir(spark))
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return warc.read_warc(spark, manifest, payloads=False).select(
        number(F.col("record_id")).alias("page_id"), F.col("http_length").alias("payload_bytes"),
        F.coalesce("payload_sha1", "payload_digest").alias("payload_digest"), "record_type", number(F.col("refers_to")).alias("refers_to"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("items", "hit_spans")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.shard(read_table(spark, sf_dir, "documents"))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(read_table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"), fold_case=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"), SCAN_VOCABULARY).drop("n_random")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


def op11_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = media.text_media(read_table(spark, sf_dir, "documents"))
    return m.select(
        "doc_id", "n_bytes", F.col("samples_bytes").alias("payload_bytes"), F.col("samples_sha256").alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256",
        F.lower(F.hex("hash")).alias("feature"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), ALIGNED_VOCABULARIES).docs


QUERIES = {f.__name__: f for f in (op1_pack, op2_warc, op3_decontaminate, op4_quality, op5_shard, op6_substrings, op7_lm_score, op8_toxicity, op9_secrets, op10_jaccard, op11_media, op12_spelling, op13_alignment)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
#: Five hexadecimal digits are four of base 32.
_DIGEST = " || ".join(f"substr({_BASE32}, ((('0x' || substr(h, {5 * k + 1}, 5))::INT >> {5 * (3 - j)}) & 31) + 1, 1)" for k in range(8) for j in range(4))

ORACLE_SQL: dict[str, str] = {
    "op2_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages), b AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS best FROM p)
SELECT page_id, octet_length(encode(t)) AS payload_bytes, {_DIGEST} AS payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to FROM b""",
    "op3_decontaminate": rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT dw.doc_id, dw.i, dw.k, item_id FROM dw JOIN bw USING (k, x)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op6_substrings": r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, hash(w[i:i + 49]) AS h, sha1(array_to_string(w[i:i + 49], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h, s) AS first FROM x),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM f WHERE first < doc_id),
r AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM g GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(v, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op10_jaccard": rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sha1(array_to_string(w[i:i + 2], ' ')) AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x FROM s GROUP BY x HAVING count(*) > 1),
t AS (SELECT s.doc_id, s.x FROM s JOIN c USING (x)),
e AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT e.a, e.b FROM e JOIN n na ON na.doc_id = e.a JOIN n nb ON nb.doc_id = e.b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(root) AS component_id FROM r GROUP BY a) m USING (doc_id)""",
    "op12_spelling": rf"""WITH RECURSIVE t AS (SELECT list(list_reduce(range(8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS crc FROM (SELECT unnest(range(256)) AS i)),
r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
h AS (SELECT w, n, xor(list_reduce(flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c)::BIGINT - 64] END)), lambda a, b: xor(a // 256, t.crc[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM r, t),
s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM s GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
d AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS x FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
near AS (SELECT a.word, b.word AS other FROM d a JOIN d b ON a.x = b.x AND a.i = b.i AND a.word <> b.word UNION SELECT d.word, v.word FROM d JOIN v ON d.x = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.x = v.word),
g AS (SELECT near.word, count(*) AS n_near, first(v.word ORDER BY v.n DESC, encode(v.word)) AS best, max(v.n) AS m FROM near JOIN v ON v.word = near.other GROUP BY near.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN best END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM v LEFT JOIN g USING (word)),
p AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT p.word, f.word, f.form FROM p JOIN f ON f.word = p.next)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n FROM f JOIN p ON p.word = f.word AND p.next IS NULL""",
}
