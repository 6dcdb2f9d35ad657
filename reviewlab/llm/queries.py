"""One query per operator over its whole table, each with SQL where SQL states the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlab.llm import (
    bpe,
    decontaminate,
    divergence,
    licenses,
    line_dedup,
    near_dedup,
    negatives,
    phrase_dedup,
    quality_model,
    quality_rules,
    secrets,
    suffix_dedup,
    url_filter,
)
from reviewlab.llm.common import table
from reviewlab.session import configure

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}

#: Name of the tokenizer file the encoding query uses, among the public tokenizers.
WORD_VOCABULARY = "word_bpe_49k.json"


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with its SQL unless SQL cannot state it."""

    def add(run: Run) -> Run:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        configured.__name__ = run.__name__
        configured.__doc__ = run.__doc__
        RUNS[run.__name__] = configured
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_bpe(spark, sf):
    """Ids of every text, and the text decoded from them."""
    coded = bpe.round_trip(table(spark, sf, "documents"), vocabulary_path(WORD_VOCABULARY))
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _rules_sql() -> str:
    """The measures on arrays of words and lines, and the same threshold table."""
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in quality_rules.known_words())
    passed = ",\n".join(
        f"(m.{r.numerator} >= {r.low} * m.{r.denominator} AND "
        f"m.{r.numerator} <= {r.high} * m.{r.denominator}) AS passed_{r.name}"
        for r in quality_rules.RULES
    )
    kept = " AND ".join(f"passed_{r.name}" for r in quality_rules.RULES)
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3),
windows AS (
  SELECT rid, i, count(*) OVER (
    PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n
  FROM places),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY rid),
m AS (
  SELECT s.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(text) - length(regexp_replace(text, '\\p{{L}}+', '', 'g')) AS BIGINT) AS n_letters,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) AS BIGINT) AS n_ellipsis_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]'))) AS BIGINT) AS n_bullet_lines
  FROM split s LEFT JOIN covered c ON s.rid = c.rid),
judged AS (
  SELECT m.*,
    n_words < {quality_rules.MIN_WORDS}
      OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words AS base_failed,
    {passed}
  FROM m)
SELECT * EXCLUDE (rid), NOT base_failed AND {kept} AS kept FROM judged"""


@query(_rules_sql())
def op2_quality_rules(spark, sf):
    """Measures, base rules and the verdict of the threshold table."""
    return quality_rules.apply_rules(table(spark, sf, "documents"))


# The rules of the address query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _urls_sql() -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {rows}),
cut AS (
  SELECT page_id, row_number() OVER () AS rid,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fit AS (
  SELECT rid, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC) AS k
  FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
    AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM cut LEFT JOIN fit ON cut.rid = fit.rid AND k = 1"""


@query(_urls_sql())
def op10_url_filter(spark, sf):
    """Verdict of the longest rule that fits each address; the method's own is to allow."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.match_rules(table(spark, sf, "pages"), rules)


LINES_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
    string_split(text, chr(10)) AS parts FROM documents),
placed AS (
  SELECT rid, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
normal AS (
  SELECT *, trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS norm FROM placed),
marked AS (
  SELECT *, norm <> '' AND length(norm) - length(replace(norm, ' ', ''))
    >= {line_dedup.MIN_WORDS - 1} AS may_go FROM normal),
shared AS (
  SELECT norm FROM marked WHERE may_go GROUP BY norm
  HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
judged AS (
  SELECT rid, pos, line, may_go AND norm IN (SELECT norm FROM shared) AS gone FROM marked),
joined AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept_text,
    count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
  FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept_text, '')) END AS text_sha256
FROM split LEFT JOIN joined ON split.rid = joined.rid"""


@query(LINES_SQL)
def op4_line_dedup(spark, sf):
    """Texts without the lines that many sites share."""
    cleaned = line_dedup.drop_shared_lines(table(spark, sf, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", digest)


@query()
def op8_quality_model(spark, sf):
    """Score of every text by trees fitted on the labels that are not held out."""
    docs = table(spark, sf, "documents")
    model = quality_model.fit(docs, table(spark, sf, "labels"))
    scored = quality_model.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality_model.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query()
def op9_near_dedup(spark, sf):
    """Groups of documents whose sets of two-word shingles are 0.8 similar."""
    found = near_dedup.near_duplicates(table(spark, sf, "documents"), size=2, percent=80)
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _terms_sql(name: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    return f"""SELECT *, row_number() OVER () AS rid,
    regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM {name}"""


BENCHMARK_SQL = f"""
WITH d AS ({_terms_sql("documents")}),
b AS (
  SELECT DISTINCT item_id, words, least({decontaminate.WINDOW}, len(words)) AS k
  FROM ({_terms_sql("benchmark")}) WHERE len(words) > 0),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(words[s:s + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS s FROM b)),
dw AS (
  SELECT rid, s, k, array_to_string(words[s:s + k - 1], ' ') AS gram
  FROM (SELECT rid, words, k, unnest(range(1, len(words) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM b) WHERE len(words) >= k)),
hit AS (SELECT rid, s, k, item_id FROM dw JOIN bw USING (k, gram)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hit) GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0
    AND {decontaminate.MIN_SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""


@query(BENCHMARK_SQL)
def op7_decontaminate(spark, sf):
    """Words of each document inside 13-word windows of the benchmark's items."""
    found = decontaminate.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def _licenses_sql() -> str:
    known = ", ".join(f"'{s}'" for s in licenses.SENTENCES.values())
    names = ", ".join(f"'{n}'" for n in licenses.SENTENCES)
    hits = ", ".join(
        f"CASE WHEN contains(line, '{licenses.rule_sequence(r)}') THEN '{r.licence}' END"
        for r in licenses.RULES
    )
    wrapped = licenses.WRAPPED.replace("\\", "\\")
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(regexp_replace(regexp_replace(
    coalesce(text, ''), '{wrapped}', ' \\1', 'g'), '{licenses.ENDED}', '\\1' || chr(10), 'g'),
    chr(10)) AS pieces
  FROM documents),
numbered AS (
  SELECT rid, doc_id, list_filter(list_transform(
    list_filter(pieces, lambda s: regexp_matches(s, '{licenses.STEMS}')),
    lambda s: coalesce(list_position([{known}],
      trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), 0)), lambda n: n > 0) AS numbers
  FROM cut),
lined AS (
  SELECT *, ',' || array_to_string(numbers, ',') || ',' AS line FROM numbered)
SELECT doc_id, CAST(len(numbers) AS BIGINT) AS n_sentences,
  array_to_string(list_transform(numbers, lambda n: ([{names}])[n]), ',') AS sentences,
  array_to_string(list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))), ',')
    AS licences
FROM lined"""


@query(_licenses_sql())
def op3_licenses(spark, sf):
    """Known licence sentences of every text, and the licences whose rules match."""
    found = licenses.scan(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


#: Name of the rank file the secret scan counts tokens with.
SECRET_VOCABULARY = "byte_bpe_50k.tiktoken"


@query()
def op6_secrets(spark, sf):
    """Known shapes and strings that no tokenizer shortens, in every text."""
    import public_tokenizers

    found = secrets.scan(
        table(spark, sf, "documents"),
        vocabulary_path(SECRET_VOCABULARY),
        public_tokenizers.PATTERN,
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans):
        line = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
        return F.array_join(line, ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )


@query()
def op5_suffix_dedup(spark, sf):
    """Bytes of each text outside 400-byte strings that stand anywhere else too."""
    found = suffix_dedup.remove_repeated(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_KEPT_TERMS = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents),
kept AS (
  SELECT lang, term, count(*) AS all_n FROM d GROUP BY lang, term
  HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}),
own AS (
  SELECT lang, source, term, all_n, count(*) AS n FROM d JOIN kept USING (lang, term)
  GROUP BY ALL),
langs AS (
  SELECT lang, count(*) AS v, sum(all_n) AS lang_total FROM kept GROUP BY lang),
groups AS (
  SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
facts AS (
  SELECT lang, source, coalesce(v, 0) AS v, lang_total, coalesce(total, 0) AS total
  FROM groups LEFT JOIN langs USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source)
    USING (lang, source))"""


def _share_sql(n: str, total: str, v: str) -> str:
    top = f"{divergence.SCALE}::HUGEINT * ({n} + {divergence.PRIOR})"
    return f"(1 + ({top}) // ({total} + {divergence.PRIOR} * {v}))"


_DIVERGENCE_SQL = f"""{_KEPT_TERMS},
p AS (
  SELECT f.lang, f.source, k.term, {_share_sql("coalesce(n, 0)", "total", "v")} AS p
  FROM facts f JOIN kept k ON k.lang = f.lang
  LEFT JOIN own o ON o.lang = f.lang AND o.source = f.source AND o.term = k.term),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
above AS (
  SELECT lang, source, term AS item, CAST({_share_sql("n", "total", "v")}
    - {_share_sql("all_n", "lang_total", "v")} AS BIGINT) AS value
  FROM own JOIN facts USING (lang, source)),
both_parts AS (
  SELECT *, 'pair' AS part FROM pairs
  UNION ALL BY NAME SELECT *, 'term' AS part FROM above WHERE value > 0)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


@query(_DIVERGENCE_SQL)
def op12_divergence(spark, sf):
    """How far each source is from the others of its language, and by which terms."""
    return divergence.audit(table(spark, sf, "documents"))


NEGATIVES_SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({negatives.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(r.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k
    FROM scored WHERE same) WHERE k <= {negatives.POSITIVES})
SELECT * FROM (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
  FROM pos JOIN scored USING (anchor_id)
  WHERE NOT same AND {negatives.LOW} * positive_score <= 100 * score
    AND 100 * score <= {negatives.HIGH} * positive_score)
WHERE rank <= {negatives.NEGATIVES}"""


@query(NEGATIVES_SQL)
def op13_hard_negatives(spark, sf):
    """Rows of another label that score nearly as high as an anchor's own best."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, label=label)


PASSAGES_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
w AS (
  SELECT rid, s, array_to_string(words[s:s + {phrase_dedup.LENGTH - 1}], ' ') AS content
  FROM (SELECT rid, words, unnest(range(1, len(words) - {phrase_dedup.LENGTH - 2})) AS s FROM d)),
twice AS (SELECT rid, s, content FROM (
  SELECT *, count(*) OVER (PARTITION BY content) AS n FROM w) WHERE n > 1),
gone AS (
  SELECT rid, list(DISTINCT p) AS places FROM (
    SELECT rid, unnest(range(s, s + {phrase_dedup.LENGTH})) AS p FROM twice) GROUP BY rid),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text FROM (
    SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d) x
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT rid, unnest(places) AS p FROM gone) g WHERE g.rid = x.rid AND g.p = x.p)
  GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""


@query(PASSAGES_SQL)
def op11_phrase_dedup(spark, sf):
    """Words of each text outside 35-word windows that stand anywhere else too."""
    found = phrase_dedup.remove_repeated(table(spark, sf, "documents"))
    gone = F.transform("spans", lambda s: s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(gone, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
