"""One query per operator of this package over the driver's tables, and SQL where it can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import (
    ann, backoff, decontamination, infilling, license_scan, line_dedup, mixing, ngram_join, packing, pii, quality,
    token_counts, vector_codes,
)
from earshot.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def packed(docs: DataFrame) -> DataFrame:
    path = tokenizer_file("word_bpe_49k.json")
    return packing.pack(docs, lambda: packing.WordEncoder(path))


@query
def op1_pack_sequences(spark, sf_dir):
    pieces = packed(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op4_benchmark_matches(spark, sf_dir):
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_line_dedup(spark, sf_dir):
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op5_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS place,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
spread AS (
  SELECT trim(line, ' ') AS bare, min((doc_id, place)) AS first
  FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 8),
marked AS (
  SELECT l.*, s.bare IS NOT NULL AND (l.doc_id, l.place) <> s.first AS removed
  FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.bare)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed), '') AS text
FROM marked GROUP BY doc_id"""


@query
def op7_personal_data(spark, sf_dir):
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


#: Rows of fold 2 are held out: their labels are not used.
FOLD = "crc32(cast(doc_id as string)) % 4"
LEAST_QUALITY = 0.7


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.fit(docs, labels, "quality", F.expr(f"{FOLD} != 2"))


@query
def op8_quality_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", F.expr(f"{FOLD} = 2").alias("held_out"), "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


@query
def op9_lm_scores(spark, sf_dir):
    return backoff.ngram_scores(table(spark, sf_dir, "documents"))


@query
def op6_ngram_join(spark, sf_dir):
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), words=4, percent=85)


ORACLES["op6_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM sides UNION SELECT r.doc_id, l.b FROM reach r JOIN sides l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""


@query
def op10_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def license_sql(notices: dict[str, str], share: float = 0.8) -> str:
    """All windows of all documents against all notices, without any hashing."""
    size = license_scan.SHINGLE
    rows = ", ".join(
        "('{}', {}, [{}])".format(
            name, len(license_scan.notice_words(text)),
            ", ".join(f"'{s}'" for s in license_scan.shingles(license_scan.notice_words(text))),
        )
        for name, text in notices.items()
    )
    marks = ", ".join(f"'{w}'" for w in license_scan.telling_words(notices))
    return f"""
WITH notices AS (SELECT * FROM (VALUES {rows}) AS v(license_id, size, notice)),
sizes AS (SELECT DISTINCT size, greatest(1, size // 4) AS step FROM notices),
words AS (
  SELECT * FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)
  WHERE list_has_any(w, [{marks}])),
windows AS (
  SELECT doc_id, size, start, w[start + 1:start + size + step] AS run
  FROM (SELECT doc_id, w, size, step, unnest(range(0, greatest(len(w) - size, 0) + 1, step)) AS start FROM words, sizes)),
grams AS (
  SELECT doc_id, size, start, [array_to_string(run[i:i + {size - 1}], ' ') FOR i IN range(1, len(run) - {size - 2})] AS grams
  FROM windows WHERE len(run) >= {size} AND list_has_any(run, [{marks}])),
met AS (
  SELECT doc_id, license_id, start, len(list_intersect(grams, notice)) / len(notice) AS containment
  FROM grams JOIN notices USING (size))
SELECT doc_id, license_id, max(containment) AS containment, arg_max(start, (containment, -start)) AS first_word
FROM met WHERE containment >= {share} GROUP BY ALL"""


ORACLES["op10_license_scan"] = license_sql(license_scan.NOTICES)


@query
def op11_fill_in_middle(spark, sf_dir):
    made = infilling.fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, suffix_rate=50)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM texts),
cut AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS prefix,
         coalesce(array_to_string(lines[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(lines[b + 1:n], ''), '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024).drop("label")


def codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256, scale: int = 1024) -> str:
    """Every distance between every part and every entry, once for each round and once for the codes."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
near{turn} AS MATERIALIZED (
  SELECT vec_id, part, min((d, entry)) AS best
  FROM (SELECT c.vec_id, part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
        FROM cells c JOIN book{turn} b USING (part, place) GROUP BY ALL)
  GROUP BY ALL)""")
        if turn < rounds:
            steps.append(f"""
book{turn + 1} AS MATERIALIZED (
  SELECT part, b.entry, place, coalesce(m.x, b.x) AS x
  FROM book{turn} b LEFT JOIN (
    SELECT part, n.best[2] AS entry, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
    FROM cells JOIN near{turn} n USING (vec_id, part) GROUP BY ALL) m USING (part, entry, place))""")
    return f"""
WITH listed AS (
  SELECT vec_id, label, embedding, len(embedding) AS size, unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
broken AS (
  SELECT DISTINCT vec_id FROM listed WHERE embedding[i] IS NULL OR NOT isfinite(embedding[i])),
kept AS (SELECT * FROM listed WHERE vec_id NOT IN (FROM broken)),
cells AS MATERIALIZED (
  SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS place, floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM kept, (SELECT max(size) // {parts} AS w FROM kept)),
book0 AS MATERIALIZED (
  SELECT part, entry, place, x FROM cells JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
    FROM (SELECT DISTINCT vec_id FROM kept) ORDER BY vec_id LIMIT {entries}) USING (vec_id)),{",".join(steps)},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM near{rounds} GROUP BY ALL)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM codes JOIN embeddings USING (vec_id)"""


ORACLES["op12_vector_codes"] = codes_sql()


@query
def op13_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, weights=(1, 2, 3), share=1.0, most=3, seed=7)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op13_source_mix"] = r"""
WITH texts AS (
  SELECT doc_id, source, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
measured AS MATERIALIZED (
  SELECT doc_id, source, len(w) AS size,
         -ln((('0x' || h[1:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / CASE WHEN len(w) > 0 THEN ln(len(list_distinct(w)) + 1::DOUBLE) / ln(len(w) + 1::DOUBLE) ELSE 1e-6 END AS key
  FROM texts),
weighed AS (
  SELECT source, total, 3 * total AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
         sum(total) OVER () AS wanted
  FROM (SELECT source, sum(size) AS total FROM measured GROUP BY source)),
held AS (
  SELECT source, total, cap, w, wanted,
         cap * sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           <= w * (wanted - coalesce(sum(cap) OVER (
                ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_held
  FROM weighed),
aims AS (
  SELECT source, total, CASE WHEN is_held THEN cap::DOUBLE ELSE level * w END AS target
  FROM held, (SELECT (max(wanted) - coalesce(sum(cap) FILTER (is_held), 0))::DOUBLE
                / (sum(w) FILTER (NOT is_held))::DOUBLE AS level FROM held)),
budgets AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS epochs FROM aims),
running AS (
  SELECT source, key, sum(bulk) OVER (PARTITION BY source ORDER BY key) - bulk / 2 AS middle
  FROM (SELECT source, key, sum(size)::DOUBLE AS bulk FROM measured GROUP BY ALL))
SELECT m.doc_id, m.size, b.total::BIGINT AS source_size, b.target,
       (m.size * (b.epochs + (r.middle <= b.target - b.epochs * b.total)::INT))::BIGINT AS taken
FROM measured m JOIN budgets b ON m.source IS NOT DISTINCT FROM b.source
JOIN running r ON m.source IS NOT DISTINCT FROM r.source AND m.key = r.key"""
