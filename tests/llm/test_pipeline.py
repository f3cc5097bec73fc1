"""The pipeline's stages against their operators' rules, stage by stage."""

import os
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from marginalia.llm import quality, tokens  # noqa: E402
from marginalia.llm.common import crc_part, write_shared  # noqa: E402
from test_dedup import plain_fingerprint, plain_repeats  # noqa: E402
from test_text_ops import plain_hits  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    names, state = [n for n, _ in corpus_pipeline.STAGES], [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        state.append(write_shared(stage(spark, state[-1], SF), "test-stage"))
        assert state[-1].columns == docs.columns
    rows = [{r.doc_id: r.text for r in s.collect()} for s in state]
    assert names == ["quality", "simhash_near_dedup", "suffix_dedup", "decontamination", "packing"]
    good = {r.doc_id for r in quality.classify(docs, labels, crc_part("doc_id", 5) != 0).where("predicted = 1").collect()}
    assert set(rows[1]) == good and len(good) < len(rows[0])
    fps = {i: plain_fingerprint(t) for i, t in rows[1].items()}
    group = {i: i for i in fps}
    for _ in range(20):
        for i in fps:
            group[i] = min(group[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3)
    assert set(rows[2]) == set(group.values()) and len(rows[2]) < len(rows[1])
    assert set(rows[3]) == set(rows[2])
    removed = {i: n for i, _, n, _, _ in plain_repeats(list(rows[2].items()), 200)}
    assert all(len(rows[3][i].encode()) <= len(t.encode()) - removed[str(i)] <= len(rows[3][i].encode()) + 6 * 4 for i, t in rows[2].items())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(rows[4]) == {i for i, t in rows[3].items() if not plain_hits(t, items)[3]}
    pieces = corpus_pipeline.STAGES[-1][1](spark, state[-1], SF).collect()
    total = {i: len(tokens.encode(t)) + 1 for i, t in rows[4].items()}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == total
    run = corpus_pipeline.run(spark, SF)
    assert run.agg(F.sum("length")).first()[0] == sum(total.values())


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names) and np.all([callable(f) for f in names.values()])


def test_steps_are_cleared_but_what_is_read(spark, tmp_path):
    from pathlib import Path

    from marginalia.llm import common

    mark = common.steps_written()
    a, b = (common.write_shared(spark.range(3), x) for x in ("a", "b"))
    folders = [Path(df.inputFiles()[0].removeprefix("file://")).parent for df in (a, b)]
    assert common.clear_steps(spark, mark, keep=b) == 1 and common.steps_written() == mark + 1
    assert not folders[0].exists() and b.count() == 3
    assert common.clear_steps(spark, mark) == 1 and not folders[1].exists()


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, an empty table and columns named like the operators' own pass through every stage."""
    d = tmp_path / "sf"
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "x"), (1, words, "x"), (None, None, None), (2, "", "y"), (3, words.upper() + " more", "z"), (None, "other text here", None)]
    for name, ddl, data in (("labels", "doc_id long, quality int, toxic int", [(1, 1, 0), (2, 0, 0)]), ("benchmark", "item_id string, text string", [("q", "nothing like it")])):
        spark.createDataFrame(data, ddl).write.parquet(str(d / f"{name}.parquet"))
    for table in (rows, []):
        df = spark.createDataFrame(table, "doc_id long, text string, __doc string").selectExpr("*", "1 as __marks", "map('a', 1) as m", "2 as score")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, str(d))
            assert name == "packing" or out.columns == df.columns, name
            assert (out.count() > 0) == bool(table) or name == "quality", name
