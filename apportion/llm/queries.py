"""Queries over the text tables, one for each operator; each takes (spark, sf_dir)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, divergence, html, langid, media, ngram, pieces, quality, resample, secrets, simhash, toxicity, wordpiece
from .common import cut, fold, shared_folder, table

TOKENIZERS = "/opt/tokenizers"


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """Number and hash of each text's ids, and whether they decode to the text."""
    model = pieces.load(model_file)
    # Hashes go along with the id, so that what decoding gives is held against the text without a join.
    keyed = table(spark, sf_dir, "documents").select(F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("was")).alias("key"), "text")
    coded = pieces.encode(keyed, model, "key").select(F.struct("key.*", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash")).alias("key"), "ids")
    back = pieces.decode(coded, model, "key")
    return back.select("key.doc_id", "key.n_pieces", "key.ids_hash", (F.xxhash64("text") == F.col("key.was")).alias("round_trip"))


def sentencepiece_paths(spark: SparkSession, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """Number and hash of the ids of each text's path of the greatest sum of scores, by Viterbi over the lattice."""
    coded = pieces.encode(table(spark, sf_dir, "documents"), pieces.by_score(pieces.load(model_file)))
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media.demux(media.mux(table(spark, sf_dir, "documents")))
    # Timestamps of the access units, and where in the payload those begin that a reader can start from.
    points = F.transform(F.filter("units", lambda u: u["random_access"]), lambda u: u["offset"])
    return found.select("*", F.transform("units", lambda u: u["pts"]).alias("timestamps"), points.alias("random_access")).drop("units")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Two deliveries, of all rows between them, go through one stored ledger; the second scans what the first didn't hold.
    folder = f"{shared_folder(spark)}/secrets-{uuid.uuid4()}"
    for delivery in (0, 1):
        ledger = secrets.update(docs.where(fold(F.col("doc_id"), 2) == delivery), folder)
    found = cut(secrets.findings(docs, ledger))
    secrets.forget(spark, folder)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op5_token_counts(spark: SparkSession, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), *wordpiece.pieces(model_file))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return quality.score(docs, model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.where(F.col("coverage") >= decontaminate.THRESHOLD)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    return langid.predict(docs, model).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # The url is carried in a struct with the id, so that rows which repeat an id keep their own.
    keyed = pages.select(F.struct("page_id", "url").alias("page"), F.col("page_id"), "html")
    return html.extract(keyed, html.fit(pages), id_col="page").select("page.page_id", "page.url", "text", "n_chars")


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = ngram.score(docs, fold(F.col("doc_id"), 5) != 1)
    return scores.select("doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of the language model's scores: all but the interpolated ones."""
    base = F.round(F.col("base_score").cast("decimal(38,12)"), 6).cast("double")
    return op10_lm_scores(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base.alias("base_score"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return toxicity.score(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash": op2_simhash,
    "op3_media": op3_media,
    "op4_secrets": op4_secrets,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_language": op8_language,
    "op9_html": op9_html,
    "op10_lm_scores": op10_lm_scores,
    "op11_toxicity": op11_toxicity,
    "op12_resample": op12_resample,
    "op13_divergence": op13_divergence,
    "sentencepiece_paths": sentencepiece_paths,
    "lm_base_scores": lm_base_scores,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The checksum of g goes by half bytes, the lower one first; t holds the sixteen checksums of half bytes.
_HALVES = "halves AS (SELECT [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108] AS t)"
_CRC32 = r"""xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(regexp_replace(hex(encode(g)), '(.)(.)', '\2\1', 'g'), '.'), lambda h: strpos('0123456789ABCDEF', h)::BIGINT - 1),
    lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295)"""


def _matches(*patterns: tuple[str, str]) -> str:
    """Texts x as parts, one before and one from each match of a kind's pattern on: group 1, chr(3), group 2, chr(2), the rest."""
    return " UNION ALL ".join(f"SELECT r, {k} AS k, '{kind}' AS kind, string_split(regexp_replace(x, '{pattern}', chr(1) || '\\1' || chr(3) || '\\2' || chr(2), 'g'), chr(1)) AS parts FROM t" for k, (kind, pattern) in enumerate(patterns))


_MARKED = _matches(
    ("assign", r"""((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"(AKIA)([A-Z0-9]+)"),
    ("hex", r"()([0-9a-f]+)"),
    ("pem", r"(-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----)([A-Za-z0-9+/=\s]+(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?)"),
)

ORACLES: dict[str, str] = {
    # Places of matches are sums of the lengths of the parts before them.
    "op4_secrets": rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), chr(4) || chr(4) || chr(4)) AS x FROM documents),
m AS ({_MARKED}),
s AS (SELECT r, k, kind, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM m WHERE len(parts) > 1),
l AS (SELECT *, CASE WHEN i = 1 THEN length(part) ELSE length(part) - 2 END AS n, CASE WHEN i > 1 THEN strpos(part, chr(3)) - 1 END AS a, CASE WHEN i > 1 THEN strpos(part, chr(2)) - strpos(part, chr(3)) - 1 END AS b FROM s),
w AS (SELECT *, (sum(n) OVER (PARTITION BY r, k ORDER BY i) - n)::BIGINT AS start FROM l),
f AS (SELECT r, k, start, kind || ':' || start || ':' || (start + a + b) AS span FROM w WHERE i > 1 AND CASE k WHEN 0 THEN b >= 12 WHEN 1 THEN a + b >= 18 WHEN 2 THEN b >= 16 ELSE true END),
g AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY start, k) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (r)""",
    "lm_base_scores": rf"""
WITH {_HALVES}, ids AS (SELECT g, {_CRC32} % 5 AS part FROM (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS g FROM documents), halves),
docs AS (SELECT row_number() OVER () AS r, doc_id, part, list_append(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), chr(10)) AS w FROM documents JOIN ids ON g = coalesce(doc_id::VARCHAR, '')),
tokens AS (SELECT r, part, unnest(w) AS word FROM docs),
counts AS (SELECT word, count(*) AS c FROM tokens WHERE part <> 1 GROUP BY word),
size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM counts),
sums AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))) AS base FROM tokens LEFT JOIN counts USING (word) CROSS JOIN size GROUP BY r)
SELECT doc_id, part = 1 AS held_out, n_tokens, n_known, n AS train_tokens, round(base::DECIMAL(38, 12), 6)::DOUBLE AS base_score FROM docs JOIN sums USING (r) CROSS JOIN size""",
    "op12_resample": rf"""
WITH {_HALVES},
tokens AS (
  SELECT 0 AS side, doc_id AS id, row_number() OVER () AS row_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, NULL, NULL, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
grams AS (SELECT side, row_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM tokens),
counted AS (SELECT side, row_id, g, count(*) AS n FROM grams GROUP BY ALL),
hashed AS (
  SELECT g, {_CRC32} % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM counted), halves),
bucketed AS (SELECT side, row_id, bucket, n FROM counted JOIN hashed USING (g)),
sums AS (SELECT bucket, sum(CASE WHEN side = 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN side = 1 THEN n ELSE 0 END)::DOUBLE AS t FROM bucketed GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM sums),
weighed AS (SELECT row_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM bucketed JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM tokens LEFT JOIN weighed USING (row_id) WHERE side = 0),
placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * (SELECT count(*) FROM placed) // 100 THEN place END AS rank FROM placed
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < 20""",
    "op13_divergence": rf"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d, regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occurrences AS (SELECT lang, source, d, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT d) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
pools AS (SELECT DISTINCT lang, source, false AS whole FROM docs UNION ALL SELECT DISTINCT lang, '', true FROM docs),
counts AS (
  SELECT lang, source, false AS whole, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL
  UNION ALL SELECT lang, '', true, term, count(*) FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT lang, source, whole, term, coalesce(n, 0) AS n FROM pools JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, whole, term)),
shares AS (SELECT lang, source, whole, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source, whole) + 2 * v) AS p FROM every JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source AND NOT a.whole AND NOT b.whole GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM pools a JOIN pools b ON a.lang = b.lang AND a.source <> b.source AND NOT a.whole AND NOT b.whole LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT a.lang, a.source, 'term', a.term, (a.p - b.p) * (a.p - b.p) // (a.p + b.p)
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND NOT a.whole AND b.whole WHERE a.n > 0 AND a.p > b.p)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10""",
}
