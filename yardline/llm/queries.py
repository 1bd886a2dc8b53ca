"""Queries of the operators over the given tables, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardline.llm import merkle, quality_classifier, vector_join
from yardline.llm.bpe import encode_and_decode
from yardline.llm.collocations import collocations
from yardline.llm.decontaminate import find_leaks
from yardline.llm.language import fit, held_out, identify
from yardline.llm.quality_rules import judge
from yardline.llm.simhash import near_duplicates
from yardline.llm.suffix_array import remove_repeated_bytes
from yardline.llm.suffix_trees import remove_repeated_words
from yardline.llm.token_counts import section_tokens
from yardline.llm.url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the package of public tokenizers keeps a vocabulary."""
    return public_tokenizers.path(name)


def digest(name: str) -> Column:
    return F.sha2(F.col(name).cast("binary"), 256)


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of documents that 200-byte strings repeat."""
    out = remove_repeated_bytes(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", digest("kept").alias("kept_sha256"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Words of documents that 50-word windows of earlier documents cover."""
    out = remove_repeated_words(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", digest("kept").alias("kept_sha256"))


PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1)"

OP4 = rf"""
WITH cut AS (SELECT page_id, {PATH} AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM split)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fit
"""


@query("op4_url_filters", OP4)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return filter_urls(table(spark, folder, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP9 = r"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after
          FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, sum(least(5, coalesce(after - i, 5))) AS n FROM twice GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS kinds
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT doc_id, lang, source, len(words) AS n_words,
                  length(array_to_string(words, '')) AS word_chars,
                  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
                  coalesce(l.n - l.kinds, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
           FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
measured AS (SELECT *, CASE WHEN word_chars > 0 THEN n_symbols / word_chars END AS symbol_share,
                    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines END AS dup_line_share,
                    CASE WHEN n_words > 0 THEN word_chars / n_words END AS mean_word_length FROM counts),
pairs AS (SELECT lang, source, 'symbol_share' AS measure, symbol_share AS v FROM measured
          UNION ALL SELECT lang, source, 'dup_line_share', dup_line_share FROM measured
          UNION ALL SELECT lang, source, 'mean_word_length', mean_word_length FROM measured),
bins AS (SELECT *, CASE WHEN v > 0 THEN CAST(ceil(ln(v) / 0.01980262729617973) AS INT) END AS bin FROM pairs
         WHERE v IS NOT NULL),
sketch AS (SELECT 0 AS level, lang, source, measure, bin, count(*) AS n FROM bins GROUP BY lang, source, measure, bin
           UNION ALL SELECT 1, lang, NULL, measure, bin, count(*) FROM bins GROUP BY lang, measure, bin
           UNION ALL SELECT 2, NULL, NULL, measure, bin, count(*) FROM bins GROUP BY measure, bin),
placed AS (SELECT *, CASE WHEN bin IS NULL THEN 0.0 ELSE exp(bin * 0.01980262729617973) * (2.0 / 2.02) END AS value,
                  sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin NULLS FIRST) AS upto,
                  sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM sketch),
q AS (SELECT level, lang, source, measure, max(total) AS docs, min(value) FILTER (upto >= total * 0.25) AS a,
             min(value) FILTER (upto >= total * 0.75) AS b FROM placed GROUP BY level, lang, source, measure),
picked AS (SELECT f.lang, f.source, f.measure,
                  CASE WHEN f.docs >= 100 THEN f.a WHEN l.docs >= 100 THEN l.a ELSE t.a END AS a,
                  CASE WHEN f.docs >= 100 THEN f.b WHEN l.docs >= 100 THEN l.b ELSE t.b END AS b
           FROM q f JOIN q l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM f.lang AND l.measure = f.measure
           JOIN q t ON t.level = 2 AND t.measure = f.measure WHERE f.level = 0),
fences AS (SELECT lang, source, max(b + 3 * greatest(b - a, 0.01)) FILTER (measure = 'symbol_share') AS symbols,
                  max(b + 3 * greatest(b - a, 0.15)) FILTER (measure = 'dup_line_share') AS dups,
                  max(b + 3 * greatest(b - a, 1.5)) FILTER (measure = 'mean_word_length') AS longest,
                  max(a - 3 * greatest(b - a, 1.5)) FILTER (measure = 'mean_word_length') AS shortest
           FROM picked GROUP BY lang, source),
judged AS (SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  coalesce(symbol_share > symbols, false) OR coalesce(dup_line_share > dups, false)
                  OR coalesce(mean_word_length > longest, false) OR coalesce(mean_word_length < shortest, false) AS beyond
           FROM measured m LEFT JOIN fences f
           ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT beyond AS kept
FROM judged
"""


@query("op9_quality_rules", OP9)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs, drop_text=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_bpe")
def op5(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Every document to tokens and back; ``vocabulary`` is the file's path on every executor."""
    path = vocabulary or tokenizer_path("word_bpe_49k.json")
    rows = encode_and_decode(table(spark, folder, "documents").select("doc_id", "text"), path)
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        digest("decoded").alias("decoded_sha256"),
    )


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies of benchmark items in documents: the best window of each document and item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, folder, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    names = {"item": "item_id", "start": "start_word", "words": "n_words", "similarity": "similarity", "distance": "distance"}
    return found.select("doc_id", *[F.col(f"leak.{a}").alias(b) for a, b in names.items()])


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = table(spark, folder, "documents")
    labelled = docs.filter(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang")
    out = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), fit(labelled))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op8_token_counts")
def op8(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Tokens of every line of every document."""
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")
    out = section_tokens(table(spark, folder, "documents").select("doc_id", "text"), path)
    return out.select("doc_id", F.inline("sections"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels."""
    docs = table(spark, folder, "documents")
    pages = docs.select(F.col("doc_id").alias("id"), "text", "source", "lang", F.col("n_chars").alias("size"))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    out = quality_classifier.score(docs, quality_classifier.fit(pages, labels))
    return out.select("doc_id", "quality", "text_quality", "metadata_quality", F.col("good").alias("kept"))


OP11 = """
WITH RECURSIVE
v AS (SELECT row_number() OVER () AS i, vec_id, CASE WHEN len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
links AS (SELECT a.i, b.i AS j FROM v a JOIN v b ON a.i <> b.i AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT i, i AS j FROM v UNION SELECT r.i, l.j FROM reach r JOIN links l ON l.i = r.j),
least AS (SELECT r.i, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.i = r.j GROUP BY r.i),
counts AS (SELECT i, count(*) AS n FROM links GROUP BY i)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN least USING (i) LEFT JOIN counts USING (i)
"""


@query("op11_embedding_near_dedup", OP11)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return vector_join.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))"""
PAIRED = "list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))"
LEAF = "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
FOLDED = """list_reduce(list_prepend({leaf}, steps), lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END))"""
BESIDE = "coalesce(s.l[xor({i} >> s.h, 1) + 1], '')"

OP12 = f"""
WITH RECURSIVE
d AS (SELECT *, doc_id::VARCHAR AS d FROM documents),
t AS (SELECT *, coalesce(xor({CRC32}, 4294967295::BIGINT) % 7 = 0, false) AS bad FROM d),
leaves AS (SELECT doc_id, lang, {LEAF.format(n="n_chars")} AS leaf, CASE WHEN bad THEN {LEAF.format(n="(n_chars + 1)")}
           ELSE {LEAF.format(n="n_chars")} END AS claimed FROM t),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
levels AS (SELECT lang, 0 AS h, list(leaf ORDER BY i) AS l FROM placed GROUP BY lang
           UNION ALL SELECT lang, h + 1, {PAIRED} FROM levels WHERE len(l) > 1),
roots AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM levels WHERE len(l) = 1),
tops AS (SELECT 0 AS h, list(subroot ORDER BY r) AS l FROM roots
         UNION ALL SELECT h + 1, {PAIRED} FROM tops WHERE len(l) > 1),
steps AS (SELECT p.doc_id, p.leaf, p.claimed, p.lang, p.i, s.h, (p.i >> s.h) & 1 AS side, {BESIDE.format(i="p.i")} AS beside
          FROM placed p JOIN levels s ON s.lang IS NOT DISTINCT FROM p.lang AND len(s.l) > 1
          UNION ALL SELECT p.doc_id, p.leaf, p.claimed, p.lang, p.i, 1000 + s.h, (r.r >> s.h) & 1, {BESIDE.format(i="r.r")}
          FROM placed p JOIN roots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN tops s ON len(s.l) > 1),
found AS (SELECT lang, i, string_agg(beside, '' ORDER BY h) AS proof,
                 list(CASE side WHEN 1 THEN 'L' ELSE 'R' END || beside ORDER BY h) AS steps FROM steps GROUP BY lang, i),
out AS (SELECT p.doc_id, p.leaf, r.subroot, (SELECT l[1] FROM tops WHERE len(l) = 1) AS root, sha256(coalesce(f.proof, '')) AS proof_sha256,
               CASE WHEN f.steps IS NULL THEN p.claimed ELSE {FOLDED.format(leaf="p.claimed").replace("steps", "f.steps")} END AS folded_root
        FROM placed p JOIN roots r ON r.lang IS NOT DISTINCT FROM p.lang
        LEFT JOIN found f ON f.lang IS NOT DISTINCT FROM p.lang AND f.i = p.i)
SELECT *, folded_root = root AS verified FROM out
"""


@query("op12_merkle_manifest", OP12)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document; every seventh row's proof is tried with a size that is one too large."""
    docs = table(spark, folder, "documents")
    text = lambda size: merkle.digest(merkle.leaf_text(F.col("doc_id"), F.col("source"), F.col("lang"), size, F.col("text")))
    size = F.col("n_chars")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select("doc_id", "lang", text(size).alias("leaf"), text(F.when(tampered, size + 1).otherwise(size)).alias("claimed"))
    out = merkle.proofs(merkle.manifest(rows, "lang", ["doc_id"], "leaf"), "claimed", ["doc_id"])
    hexed = lambda name: F.lower(F.hex(name))
    return out.select(
        "doc_id",
        hexed("digest").alias("leaf"),
        hexed("subroot").alias("subroot"),
        hexed("root").alias("root"),
        F.sha2(merkle.joined_hex(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
        hexed("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


OP13 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM places),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
parted AS (SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:c.cut], ' ')
           JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[c.cut + 1:], ' ') JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
whole AS (SELECT b.* FROM best b WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.lang = b.lang AND g.k > b.k AND 100 * g.a >= 100 * b.a
                                                   AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM whole)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


@query("op13_phrase_collocations", OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest phrases of each language."""
    return collocations(table(spark, folder, "documents").select("text", "lang"))
