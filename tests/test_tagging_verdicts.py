"""T1-T3 district tagging, R2-R4 verdict parsing and consensus."""

import datetime as dt

from newsfunnel.operators import tagging as TG
from newsfunnel.operators import verdicts as VD

SCHEMA = ("ord long, title string, url string, source string, date timestamp_ntz, language string, state string, "
          "district string, search_term string, full_text string, districts array<string>")
GZ = [("Punjab", "Mansa", 0), ("Punjab", "Una", 1), ("Punjab", "Moga", 2), ("Bihar", "Patna", 0)]


def art(o, title, text=None, district=None, state="Punjab", batch=None):
    return (o, title, f"u{o}", "s", dt.datetime(2026, 2, 1), "en", state, district, "heat", text, batch or [])


def test_batch_tagging(spark):
    df = spark.createDataFrame([
        art(1, "Heat in Moga", batch=[]),
        art(2, "Heat somewhere", district="Old", batch=["Una"]),
        art(3, "Heat in MOGA and Mansa", batch=["Mansa", "Moga"]),
        art(4, "Heat elsewhere", batch=["Mansa", "Moga"]),
    ], SCHEMA)
    got = {r.ord: r.district for r in TG.tag_from_batch(df).collect()}
    assert got == {1: None, 2: "Una", 3: "Mansa", 4: None}


def test_text_tagging_plain_substring(spark):
    gz = spark.createDataFrame(GZ, "state string, district string, district_ord int")
    df = spark.createDataFrame([
        art(1, "Heat wave", "fortunately cool"),  # 'una' inside 'fortunately': plain substring hits
        art(2, "Heat in Moga", None),
        art(3, "Heat", "nothing", district="Kept"),
        art(4, "Heat in Patna", "x", state="Nowhere"),
    ], SCHEMA)
    got = {r.ord: r.district for r in TG.tag_from_text(df, gz).collect()}
    assert got == {1: "Una", 2: "Moga", 3: "Kept", 4: None}


def test_answer_resolution(spark):
    gz = spark.createDataFrame(GZ, "state string, district string, district_ord int")
    df = spark.createDataFrame([art(i, "t") for i in range(1, 8)] + [art(8, "t", state="Nowhere")], SCHEMA)
    answers = spark.createDataFrame(
        [(1, ' "moga" '), (2, "None"), (3, "Una district"), (4, ""), (5, "xyz"), (6, None), (8, "Patna")],
        "ref_id long, answer string")
    got = {r.ord: r.district for r in TG.tag_from_answers(df, gz, answers).collect()}
    assert got == {1: "Moga", 2: None, 3: "Una", 4: "Mansa", 5: None, 6: None, 7: None, 8: None}


def test_verdicts_fail_open_and_majority(spark):
    refs = spark.createDataFrame([art(i, f"t{i}") for i in range(1, 5)], SCHEMA)
    votes = spark.createDataFrame([
        (1, "a", "Yes"), (1, "b", "no"), (1, "c", " YES."),
        (2, "a", "No"), (2, "b", "nope"),  # c missing -> yes; 1 of 3 -> drop
        (3, "a", "no"), (3, "b", None),  # failed -> yes; a no, b yes, c yes -> keep
        (4, "a", "no"), (4, "b", "no"), (4, "d", "no"),  # d has no key: ignored
    ], "ref_id long, voter string, response string")
    voters = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", False)], "voter string, has_key boolean")
    kept = sorted(r.ord for r in VD.majority_vote(refs, votes, voters).collect())
    assert kept == [1, 3]
    two = spark.createDataFrame([("a", True), ("b", True)], "voter string, has_key boolean")
    tie = spark.createDataFrame([(1, "a", "yes"), (1, "b", "no")], "ref_id long, voter string, response string")
    assert 1 not in [r.ord for r in VD.majority_vote(refs, tie, two).collect()]  # 1 of 2 is not a majority
    single = VD.filter_by_verdict(refs, votes.where("voter = 'a'"))
    assert sorted(r.ord for r in single.collect()) == [1]


def test_scorer_equals_the_table_of_answers(spark):
    from pyspark.sql import functions as F

    from newsfunnel.operators import scorers as SC
    from newsfunnel.operators.tagging import tag_from_answers
    from newsfunnel.operators.verdicts import filter_by_verdict

    rows = [(k, f"title {k}", "Bihar" if k % 3 else "Nowhere", "Gaya" if k % 7 == 0 else None) for k in range(300)]
    refs = spark.createDataFrame(rows, "ord long, title string, state string, district string").repartition(3)
    refs = refs.withColumn("full_text", F.lit("some text")).withColumn("at", F.lit("2026-02-01").cast("timestamp_ntz"))

    def number(p):
        return int(p.split("Title: title ")[1].split("\n")[0])

    def scorer(system, prompts):
        assert ("classifier" in system) != ("geographic" in system)
        if any(number(p) % 50 == 13 for p in prompts):
            raise RuntimeError("no answer today")
        if "classifier" in system:
            assert all("(no text)" in p for p in prompts)
            return [["Yes", "no", None, " yes!"][number(p) % 4] for p in prompts]
        return [["'Patna'", "None", "gay", "", None][number(p) % 5] for p in prompts]

    def table(answers, per):
        return spark.createDataFrame([(k, answers[k % len(answers)] if k % 50 != 13 else None) for k in range(300)], f"ref_id long, {per} string")

    got = SC.filter_refs(refs, scorer, batch_rows=1, give_up=99)
    assert got.columns == refs.columns
    want = filter_by_verdict(refs, table(["Yes", "no", None, " yes!"], "response"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() < 300
    gaz = spark.createDataFrame([("Bihar", "Patna", 0), ("Bihar", "Gaya", 1)], "state string, district string, district_ord int")
    got = SC.tag_with_scorer(refs, gaz, scorer, batch_rows=1, give_up=99)
    want = tag_from_answers(refs, gaz, table(["'Patna'", "None", "gay", "", None], "answer"))
    assert sorted(map(str, got.select(*refs.columns).collect())) == sorted(map(str, want.select(*refs.columns).collect()))


def test_scorer_that_fails_keeps_every_ref(spark, tmpdir_path):
    import os

    from newsfunnel.operators import scorers as SC

    refs = spark.range(400).selectExpr("id AS ord", "concat('t', id) AS title", "'Bihar' AS state", "cast(NULL AS string) AS district").coalesce(1)
    log = os.path.join(tmpdir_path, "calls")

    def broken(system, prompts):
        with open(log, "a") as f:
            f.write("x")
        raise TimeoutError

    assert SC.filter_refs(refs, broken, batch_rows=10, give_up=3).count() == 400
    assert len(open(log).read()) == 3  # then the task stops asking
    assert SC.filter_refs(refs, lambda system, prompts: ["No"] * (len(prompts) - 1), batch_rows=10).count() == 400  # answers of the wrong number
    assert SC.filter_refs(refs, lambda system, prompts: ["No"] * len(prompts)).count() == 0
    assert SC.filter_refs(refs.limit(0), broken).count() == 0
