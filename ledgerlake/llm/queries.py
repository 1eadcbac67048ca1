"""The operators as registered queries, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_filter
from .chunk_dedup import repeated_passages
from .hard_negatives import hard_negatives, integer_vector
from .imatch import build_lexicon, compare_with_next
from .jaccard_join import jaccard_components
from .kd_sharding import shard_documents
from .kneser_ney import fold, score_texts, train_bigrams
from .line_dedup import CORPUS_DEVIATIONS, CORPUS_RATIO, MIN_PAGES, drop_boilerplate
from .mixing import mix
from .packing import pack_documents
from .quality_rules import quality_rules, train_quality
from .site_quality import site_quality
from .small_tables import word_count
from .storage import stored
from .token_alignment import aligned, pair_counts, with_pair_scores


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return compare_with_next(documents, build_lexicon(documents))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(_documents(spark, sf_dir), tokenizer)


def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host, its language within it the path."""
    documents = _documents(spark, sf_dir)
    model = train_quality(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return site_quality(documents, model, host=F.col("source"), path=F.col("lang"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_documents(spark, sf_dir), word_count(F.col("text")))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        "shards",
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = fold(F.col("doc_id")) == 2
    model = train_bigrams(documents.where(~held_out).select("text"))
    scored = score_texts(documents.withColumn("held_out", held_out), model)
    return scored.drop("text")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_components(_documents(spark, sf_dir), n=3, percent=90)
    return groups.withColumnRenamed("component", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules(documents.select("doc_id", "text"), train_quality(documents, labels))
    return judged.drop("text")


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(_documents(spark, sf_dir), shards=8)
    return sharded.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = repeated_passages(_documents(spark, sf_dir))
    return passages.withColumnRenamed("first_key", "first_doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a text are one page of their source, so they keep their lines."""
    documents = _documents(spark, sf_dir).select("doc_id", "source", "text")
    return drop_boilerplate(
        documents, max_ratio=CORPUS_RATIO, different=True, deviations=CORPUS_DEVIATIONS
    )


# The verdict of each rule.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = url_filter.train_url_filter(url_filter.labelled_urls(spark))
    return url_filter.judge_urls(pages, model, URL_RULES).drop("score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a = public_tokenizers.path("byte_bpe_50k.json")
    b = public_tokenizers.path("piece_bpe_32k.model")
    found = aligned(_documents(spark, sf_dir), a, b)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    # Stored: the links are read twice, the texts of the groups are not needed again.
    links = stored(found.withColumn("groups_sha256", digest).drop("groups"))
    return with_pair_scores(links, pair_counts(links))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    vectors = table.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        integer_vector(F.col("embedding")).alias("vector"),
    )
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def queries() -> dict:
    registered = (
        op1_imatch_fingerprints,
        op2_best_fit_packing,
        op3_site_quality,
        op4_source_mixing,
        op5_language_model,
        op6_jaccard_join,
        op7_quality_rules,
        op8_kd_sharding,
        op9_chunk_dedup,
        op10_line_dedup,
        op11_url_filter,
        op12_token_alignment,
        op13_hard_negatives,
    )
    return {query.__name__: query for query in registered}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

_OP6 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1),
                             lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles
  FROM worded
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
)
SELECT sets.doc_id, len(sets.shingles) AS n_shingles, component_id
FROM sets JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) ON sets.doc_id = x"""

_OP10 = f"""
WITH split AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), pages AS (
  SELECT DISTINCT source, text, lines FROM split
), found AS (
  SELECT DISTINCT source, text, line
  FROM (SELECT source, text, unnest(lines) AS line FROM pages)
  WHERE regexp_matches(line, {_WORDS})
), bad AS (
  SELECT source, list(line) AS bad_lines
  FROM (SELECT source, line, count(*) AS n FROM found GROUP BY source, line)
  JOIN (SELECT source, count(*) * CAST({CORPUS_RATIO} AS DOUBLE) AS most FROM pages GROUP BY source) USING (source)
  WHERE n >= {MIN_PAGES} AND n > most + CAST({CORPUS_DEVIATIONS} AS DOUBLE) * sqrt(most)
  GROUP BY source
), kept AS (
  SELECT doc_id, split.source, lines,
         list_filter(lines, lambda x: NOT list_contains(coalesce(bad_lines, []), x)) AS kept_lines
  FROM split LEFT JOIN bad ON split.source = bad.source
)
SELECT doc_id, source, array_to_string(kept_lines, chr(10)) AS text, len(lines) AS n_lines,
       len(lines) - len(kept_lines) AS n_dropped
FROM kept"""

def _grams(codes: str, kind: int) -> str:
    """Buckets of all n-grams of a list of code points."""
    sizes = []
    for n in url_filter.GRAMS:
        total = " + ".join(f"{codes}[i + {k + 1}] * {url_filter.FACTORS[k]}" for k in range(n))
        sizes.append(
            f"list_transform(range(0, len({codes}) - {n - 1}), lambda i: ({total} + {kind + n}) % {url_filter.BUCKETS})"
        )
    return f"list_concat({', '.join(sizes)})"


def _valued(grams: str, norm: float) -> str:
    return f"list_transform({grams}, lambda b: {{'b': b, 'v': CAST({norm} AS DOUBLE) / sqrt(len({grams}))}})"


def _rule_case(rules, result: int) -> str:
    """The longest rule first; ``result`` 0 gives its verdict, 1 its name."""
    cases = []
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, path = rule[1].partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        cases.append(f"WHEN {fits} THEN '{rule[result]}'")
    return f"CASE {' '.join(cases)} END"


def _op11() -> str:
    listed = [(u, 1) for u in url_filter.BLOCKED_URLS] + [(u, 0) for u in url_filter.ALLOWED_URLS]
    values = ", ".join(f"('{u}', {y})" for u, y in listed)
    size = url_filter.BUCKETS + 1
    return f"""
WITH RECURSIVE labelled(url, y) AS (VALUES {values}
), urls AS (
  SELECT url, CAST(y AS DOUBLE) AS y, CAST(NULL AS BIGINT) AS page_id FROM labelled
  UNION ALL SELECT url, NULL, page_id FROM pages
), cut AS (
  SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls
), parts AS (
  SELECT y, page_id, url, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM cut
), codes AS (
  SELECT *, list_transform(string_split('^' || host || '$', ''), lambda c: unicode(c)) AS h,
         list_transform(string_split('^' || path || '$', ''), lambda c: unicode(c)) AS p FROM parts
), grams AS (
  SELECT *, {_grams("h", url_filter.HOST[0])} AS hg, {_grams("p", url_filter.PATH[0])} AS pg FROM codes
), featured AS (
  SELECT y, page_id, url, host, path, list_concat({_valued("hg", url_filter.HOST[1])}, {_valued("pg", url_filter.PATH[1])},
         [{{'b': CAST({url_filter.BUCKETS} AS BIGINT), 'v': CAST(1 AS DOUBLE)}}]) AS x FROM grams
), numbered AS (
  SELECT row_number() OVER (ORDER BY url) AS i, y, x FROM featured WHERE y IS NOT NULL
), entries AS (
  SELECT e.b AS b, list({{'i': i, 'v': e.v}} ORDER BY i) AS l FROM (SELECT i, unnest(x) AS e FROM numbered) GROUP BY e.b
), problem AS (
  SELECT (SELECT list(x ORDER BY i) FROM numbered) AS xs, (SELECT list(y ORDER BY i) FROM numbered) AS ys,
         (SELECT list(coalesce(l, []) ORDER BY n) FROM range({size}) r(n) LEFT JOIN entries ON b = n) AS ls,
         (SELECT 2 / sum(list_sum(list_transform(x, lambda e: e.v * e.v))) FROM numbered) AS step
), fit AS (
  SELECT 0 AS n, list_transform(range({size}), lambda i: CAST(0 AS DOUBLE)) AS w,
         list_transform(range({size}), lambda i: CAST(0 AS DOUBLE)) AS v
  UNION ALL
  SELECT n + 1, list_transform(range(1, {size + 1}), lambda j: w[j] + moved[j]), moved
  FROM (
    SELECT n, w, list_transform(range(1, {size + 1}), lambda j: CAST({url_filter.MOMENTUM} AS DOUBLE) * v[j] - step * (
             coalesce(list_sum(list_transform(ls[j], lambda e: err[e.i] * e.v)), 0)
             + CAST({url_filter.SHRINK} AS DOUBLE) * w[j])) AS moved
    FROM (
      SELECT n, w, v, step, ls, list_transform(range(1, len(xs) + 1), lambda k:
               1 / (1 + exp(-list_sum(list_transform(xs[k], lambda e: w[e.b + 1] * e.v)))) - ys[k]) AS err
      FROM fit, problem WHERE n < {url_filter.STEPS}
    )
  )
), model AS (SELECT w FROM fit WHERE n = {url_filter.STEPS})
SELECT page_id, host, path, {_rule_case(URL_RULES, 1)} AS rule,
       coalesce({_rule_case(URL_RULES, 0)}, CASE WHEN
         list_sum(list_transform(x, lambda e: w[e.b + 1] * e.v)) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM featured, model WHERE y IS NULL"""


# Every anchor against every row, without lists or thresholds.
_OP13 = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])), 0) AS BIGINT) AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, id, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS "rank",
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 3"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_jaccard_join": _OP6,
        "op10_line_dedup": _OP10,
        "op11_url_filter": _op11(),
        "op13_hard_negatives": _OP13,
    }
