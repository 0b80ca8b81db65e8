import os
import subprocess
import sys

from llm_helpers import AWKWARD, docs_frame, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_sql_queries_match_duckdb():
    names = ["op1_ngram_join", "op8_topk_search", "op12_filter_audit"]
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"), "--sf", SF, *names], capture_output=True, text=True, timeout=900)
    assert "FAIL" not in out.stdout and "passed" in out.stdout, out.stdout + out.stderr[-2000:]


def test_every_operator_has_its_query():
    import __spark_entry__ as E

    names = E.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names


def test_pipeline_stages(spark, tmp_path):
    """Stage by stage against plain loops, on planted cases."""
    import random

    import corpus_pipeline as P

    from newsfunnel.llm import linedup

    rnd = random.Random(5)
    item = prose(rnd, 30)
    base = "\n".join(prose(rnd, 40) for _ in range(6))
    near = base.replace(" ", "  ", 1).split(" ")
    near[100] = "changed"
    clean = [(n, prose(rnd, 60)) for n in range(20)]
    rows = clean + [(50, base), (51, base), (52, " ".join(near).replace("\n", " ")), (60, "a b " + item + " c d"),
                    (70, prose(rnd, 20) + " vilest scoundrel " + prose(rnd, 20))] + AWKWARD
    labels = [(n, 0) for n in range(20)] + [(1000 + n, 1) for n in range(30)]
    rows += [(1000 + n, prose(rnd, 20) + " vilest scoundrel " + prose(rnd, 20)) for n in range(30)]
    docs = docs_frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "bpe"]
    kept = {}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "bpe":
            assert now.columns == docs.columns
        kept[name] = sorted((r.doc_id for r in now.collect() if r.doc_id is not None))
    clean_ids = {n for n, _ in clean}
    assert not {70, *range(1000, 1030)} & set(kept["toxicity"]) and clean_ids <= set(kept["toxicity"])
    assert 51 not in kept["line_dedup"] and 50 in kept["line_dedup"] and clean_ids <= set(kept["line_dedup"])
    assert 52 not in kept["ngram_join"] and 107 not in kept["ngram_join"] and kept["ngram_join"].count(106) == 1
    assert set(kept["line_dedup"]) - set(kept["ngram_join"]) == {52, 107}
    assert set(kept["ngram_join"]) - set(kept["decontamination"]) == {60}
    last = now.collect()
    assert kept["bpe"] == kept["decontamination"] and all(r.round_trip and r.n_tokens == len(r.ids) for r in last)
    whole = P.run(spark, str(tmp_path))
    assert whole.columns == now.columns and sorted(map(str, whole.collect())) == sorted(map(str, last))
    assert linedup.chunks("") == []
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
