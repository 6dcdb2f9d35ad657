"""Generation queries: extractive summaries, pluggable generators, prompts' output."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from reviewlab.operators import generate as g
from reviewlab.operators import tfidf
from reviewlab.operators.sampling import first_n
from reviewlab.operators.summarize import summarize_long as summarize
from reviewlab.queries import views as v
from reviewlab.queries.registry import query
from reviewlab.queries.texts import _ngram_views, _vocab_view

# Workers need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SENTENCES_SQL = f"""sent0 AS (SELECT review_id, unnest(string_split(regexp_replace(
    regexp_replace(text, '[{v.WS_SQL}]', ' ', 'g'), '([.!?]) +', '\\1' || chr(1), 'g'), chr(1))) AS s,
  generate_subscripts(string_split(regexp_replace(
    regexp_replace(text, '[{v.WS_SQL}]', ' ', 'g'), '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)), 1) AS i
  FROM docs WHERE word_len > 100),
sent1 AS (SELECT review_id, {v.squeeze_sql('s')} AS sentence, i FROM sent0),
sent AS (SELECT review_id, sentence, row_number() OVER (PARTITION BY review_id ORDER BY i) AS pos,
    len(string_split(sentence, ' ')) AS n_words FROM sent1 WHERE sentence <> '')"""


@query(f"""{v.with_views(v.DOCS)}, {_ngram_views('docs')},
uni AS (SELECT * FROM grams WHERE NOT contains(term, ' ')), {_vocab_view('uni')},
{_SENTENCES_SQL},
stok AS (SELECT review_id, pos, unnest(string_split({v.tokens_text_sql('sentence')}, ' ')) AS term
         FROM sent),
used AS (SELECT review_id, pos, term, count(*) AS times FROM stok WHERE length(term) >= 2
         GROUP BY review_id, pos, term),
tfs AS (SELECT *, sum(times) OVER (PARTITION BY review_id, term) AS tf FROM used),
scored AS (SELECT review_id, pos, round(sum(times * coalesce((1 + ln(tf)) * idf, 0)) / sum(times), 6)
             AS score FROM tfs LEFT JOIN vocab USING (term) GROUP BY review_id, pos),
ranked AS (SELECT s.*, row_number() OVER o AS rank, sum(n_words) OVER o AS budget
  FROM sent s LEFT JOIN scored c ON c.review_id = s.review_id AND c.pos = s.pos
  WINDOW o AS (PARTITION BY s.review_id ORDER BY coalesce(score, 0) DESC, s.pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kept AS (SELECT review_id, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM ranked
         WHERE rank = 1 OR budget <= 50 GROUP BY review_id)
SELECT d.review_id, d.word_len AS word_count, coalesce(summary, '') AS generated_summary
FROM docs d LEFT JOIN kept k ON k.review_id = d.review_id WHERE d.word_len > 100""")
def summarize_long(spark, sf):
    """Extractive summaries of every long document."""
    docs = v.docs(spark, sf)
    terms = tfidf.row_terms(tfidf.prepare_text(docs, label=None), "review_id", ngram=(1, 1))
    vocabulary = tfidf.fit_vocabulary(terms)
    return summarize(docs, vocabulary, n=None).drop("original_text")


def _quoting() -> g.Generator:
    return lambda text: f"> {text}"


def _unavailable() -> g.Generator:
    raise g.TaskUnavailable("no such task")


def _echoing() -> g.Generator:
    """Repeats its prompt before answering, as causal models do."""
    return lambda prompt: f"{prompt} Review: one remark. Summary: short and useful text"


def _touchy() -> g.Generator:
    def run(text: str) -> str:
        if len(text) % 2:
            raise ValueError("odd length")
        return text

    return run


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, word_len AS word_count FROM docs WHERE word_len > 100
ORDER BY review_id LIMIT 10""")
def first_long_texts(spark, sf):
    """The first ten long documents."""
    return first_n(g.long_texts(v.docs(spark, sf)), 10, "review_id").drop("original_text")


@query(f"""{v.with_views(v.URLS)}
SELECT review_id, url AS original_text,
       'Thank you for your message. Our team will look into your question and get back to you with the details.'
         AS response,
       'primary' AS generator_used,
       CASE WHEN length(url) > 120 THEN substr(url, 1, 120) || '...' ELSE url END AS review_preview
FROM urls WHERE contains(url, '?') AND length(url) > 5""")
def reply_questions(spark, sf):
    """A reply to every page address that reads as a question, by the template."""
    texts = v.urls(spark, sf).withColumnRenamed("url", "text")
    return g.reply_to_questions(texts, g.template_reply).drop("word_count", "response_preview")


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, word_len AS word_count, 'one remark. Summary: short and useful text'
         AS generated_summary, 'fallback' AS generator_used
FROM docs WHERE word_len > 100""")
def generate_fallback(spark, sf):
    """Summaries where the first kind of task is unavailable and the second echoes."""
    out = g.generate_summaries(v.docs(spark, sf), _unavailable, _echoing, n=None)
    return out.select("review_id", "word_count", "generated_summary", "generator_used")


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, CASE WHEN length(text) % 2 = 1 THEN '' ELSE {v.strip_sql('text')} END
         AS generated,
       'primary' AS generator_used, length(text) % 2 = 1 AS failed FROM docs""")
def generate_errors(spark, sf):
    """A generator that fails on some rows: they stay, empty, with their error."""
    out = g.generate(v.docs(spark, sf).select("review_id", "text"), "text", _touchy)
    return out.select(
        "review_id", "generated", "generator_used", F.col("error").isNotNull().alias("failed")
    )


@query(f"""{v.with_views(v.DOCS)}
SELECT review_id, {v.strip_sql("'> ' || text")} AS generated_summary FROM docs
WHERE word_len > 100
ORDER BY review_id LIMIT 10""")
def generate_summaries(spark, sf):
    """The first ten long texts through a generator that needs no prompt."""
    out = g.generate_summaries(v.docs(spark, sf), _quoting)
    return out.select("review_id", "generated_summary")


@query("""SELECT step, status, message FROM (
  SELECT 'count' AS step, 'ok' AS status, CAST(NULL AS VARCHAR) AS message
  UNION ALL SELECT 'check', 'error', count(*) || ' turns are empty or missing' FROM conversations
    WHERE text IS NULL OR text = ''
  UNION ALL SELECT 'later', 'ok', NULL
  UNION ALL SELECT 'left out', 'skipped', NULL)""")
def step_status(spark, sf):
    """Steps over the conversations, one of which fails."""
    turns = v.table(spark, sf, "conversations")

    def check() -> None:
        n = turns.filter("text IS NULL OR text = ''").count()
        raise ValueError(f"{n} turns are empty or missing")

    return g.step_status(
        spark, {"count": turns.count, "check": check, "later": turns.count, "left out": None}
    )
