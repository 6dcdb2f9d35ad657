"""Copies of one document through the lines and the near-copy stage."""

import corpus_pipeline
from reviewlab.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BANNER = "please accept all cookies of this site"


def body(name):
    return [f"{name} says in line {i} what only {name} can say {i * 7}" for i in range(20)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA)


def stages(spark, rows):
    docs = corpus_pipeline.lines(spark, table(spark, rows), "")
    cleaned = {r.doc_id: r.text for r in docs.collect()}
    return cleaned, {r.doc_id: r.text for r in corpus_pipeline.near_copies(spark, docs, "").collect()}


def test_one_of_a_group_of_copies_stays_whole(spark):
    exact, changed = body("exact"), body("changed")
    rows = [(i, "\n".join(exact), f"s{i}") for i in range(12)]
    # Each of these has one word of its own.
    rows += [(100 + i, "\n".join([*changed, f"own{i}"]), f"s{i}") for i in range(14)]
    # The banner is boilerplate, also in copies.
    rows += [(200 + i, "\n".join([*body(f"b{i}"), BANNER]), f"s{i}") for i in range(11)]
    rows += [(300 + i, "\n".join([*body("third"), BANNER]), f"s{i}") for i in range(12)]
    cleaned, kept = stages(spark, rows)
    assert all(cleaned[i] == "\n".join(exact) for i in range(12))
    assert all(cleaned[100 + i].startswith("\n".join(changed)) for i in range(14))
    assert all(cleaned[200 + i] == "\n".join(body(f"b{i}")) for i in range(11))
    assert all(cleaned[300 + i] == "\n".join(body("third")) for i in range(12))
    assert sorted(i // 100 for i in kept if not 200 <= i < 300) == [0, 1, 3]
    assert {i for i in kept if 200 <= i < 300} == {200 + i for i in range(11)}


def test_a_text_of_nothing_but_boilerplate_is_left_to_the_next_stage(spark):
    rows = [(i, f"{BANNER}\n" + "\n".join(body(f"c{i}")[:2]), f"s{i}") for i in range(12)]
    rows += [(50 + i, BANNER, f"s{i}") for i in range(12)] + [(90, None, "s1"), (91, " \n", "s2")]
    rows = [(i, t, s) for i, t, s in rows if t is not None]
    cleaned, kept = stages(spark, rows)
    assert all(BANNER not in cleaned[i] for i in range(12))
    assert [i for i in kept if 50 <= i < 62] == [50] and kept[50] == BANNER


def test_texts_are_counted_beside_sites(spark):
    rows = [(s * 100 + t * 20 + i, f"line of {t} texts on {s} sites\nx{i % t}", f"s{i % s}")
            for s in (9, 10, 12) for t in (9, 10) for i in range(90)]
    docs = table(spark, rows).selectExpr("row_number() over (order by doc_id, text) as doc_id", "text", "source")
    found = line_dedup.drop_shared_lines(docs, min_texts=10)
    gone = {tuple(r) for r in found.filter("n_removed > 0").join(docs.selectExpr("doc_id", "text as was"), "doc_id")
            .selectExpr("split(was, ' ')[2]", "split(was, ' ')[5]").distinct().collect()}
    assert gone == {("10", "10"), ("10", "12")}
