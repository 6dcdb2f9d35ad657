import json
import sys

import pytest
from pyspark import cloudpickle

from reviewlab.operators import generate as g
from reviewlab.sources import reviews, stages


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def upper():
    return lambda t: t.upper()


def absent():
    raise g.TaskUnavailable("none")


def broken():
    raise RuntimeError("bad weights")


def failing():
    def run(text):
        if "bad" in text:
            raise ValueError("no")
        return text

    return run


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(
        [(1, "is this bad?"), (2, "fine"), (3, "can i wash it")], "review_id int, text string"
    )


def test_generate(asked):
    rows = g.generate(asked, "text", upper).orderBy("review_id").collect()
    assert [(r.generated, r.generator_used, r.error) for r in rows][1] == ("FINE", "primary", None)
    assert {r.generator_used for r in g.generate(asked, "text", absent, upper).collect()} == {
        "fallback"
    }
    rows = g.generate(asked, "text", failing).orderBy("review_id").collect()
    assert [r.generated for r in rows] == ["", "fine", "can i wash it"]
    assert rows[0].error == "ValueError: no"


def test_failures_that_abort(asked):
    with pytest.raises(Exception, match="no"):
        g.generate(asked, "text", failing, keep_going=False).collect()
    with pytest.raises(Exception, match="bad weights"):
        g.generate(asked, "text", broken, upper).collect()
    with pytest.raises(Exception, match="none"):
        g.generate(asked, "text", absent).collect()


def test_replies(asked):
    rows = g.reply_to_questions(asked, g.template_reply).collect()
    assert {r.review_id for r in rows} == {1, 3}
    first = g.reply_to_questions(asked, absent, lambda: lambda p: p + " Summary: my reply", n=1)
    row = first.first()
    assert (row.review_id, row.generator_used, row.response) == (1, "fallback", "my reply")
    with pytest.raises(ValueError, match="no questions"):
        g.reply_to_questions(asked.filter("review_id = 2"), upper, n=1)


def test_step_status(spark):
    def fails():
        raise ValueError("boom")

    rows = g.step_status(spark, {"a": lambda: None, "b": fails, "c": None}).collect()
    assert [tuple(r) for r in rows] == [
        ("a", "ok", None), ("b", "error", "boom"), ("c", "skipped", None),
    ]


def test_scan(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(
        '{"overall":5.0,"vote":"1,234","verified":true,"unixReviewTime":7}\n\n{bad\n'
        '{"overall":"4","vote":3,"unixReviewTime":"soon","asin":"0123"}\n{"overall":NaN}\n'
    )
    rows = reviews.scan_reviews(spark, str(path)).collect()
    assert [r.overall for r in rows] == ["5.0", "4", "NaN"]
    assert [r.vote for r in rows] == ["1,234", "3", None]
    assert (rows[0].verified, rows[0].unixReviewTime, rows[1].unixReviewTime) == (True, 7, None)
    assert rows[1].asin == "0123"
    quality = reviews.scan_quality(reviews.scan_raw(spark, str(path))).first()
    assert (quality.good_rows, quality.malformed_rows) == (3, 1)
    limited = reviews.scan_reviews(spark, str(path), limit=1, order=["overall"])
    assert [r.overall for r in limited.collect()] == ["4"]


def test_texts_that_look_missing_survive(spark, tmp_path):
    values = ["null", "nan", "n/a", "NA", "", None, 'a "quoted", text', "two\nlines"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        stages.write_table(df, path, fmt)
        back = stages.read_stage(spark, path, fmt, "i int, t string").orderBy("i").collect()
        # Only Parquet keeps an empty text apart from a missing one.
        expected = [v or None for v in values] if fmt == "csv" else values
        assert [r.t for r in back] == expected, fmt
    with pytest.raises(ValueError, match="schema"):
        stages.read_stage(spark, str(tmp_path / "csv"), "csv")


def test_summary_and_text(spark, tmp_path):
    df = spark.sql("select named_struct('a', 1, 'b', cast(null as int)) as s, 2 as n")
    stages.write_summary(df, str(tmp_path / "s"))
    part = next((tmp_path / "s").glob("part-*.json"))
    assert json.loads(part.read_text()) == {"s": {"a": 1, "b": None}, "n": 2}
    texts = spark.createDataFrame([("q", "r")], "q string, r string")
    stages.write_text(texts, str(tmp_path / "t"), ["q", "r"], ["Q", "R"])
    written = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*.txt"))
    assert written.rstrip("\n") == "=== Q ===\n\nq\n\n=== R ===\n\nr"


def test_scratch_folder_is_shared_or_an_error():
    from types import SimpleNamespace

    from reviewlab.session import scratch_root

    def session(master, root=None):
        conf = SimpleNamespace(get=lambda key, default: root)
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session(master))
    assert scratch_root(session("yarn", "hdfs:///scratch")) == "hdfs:///scratch"
