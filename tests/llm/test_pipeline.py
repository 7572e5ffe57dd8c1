"""Each stage against a plain version on its own input, and the whole run."""

import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline as P
from skein.llm import quality
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert [name for name, _ in P.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        after = out.collect()
        if name == "quality":
            want = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.predicted}
            assert {r.doc_id for r in after} == want and len(want) < len(before)
        elif name == "near_dedup":
            assert {r.doc_id for r in after} == {d for d, (_, c) in brute.near_dup(list(before.items()), 80).items() if d == c}
        elif name == "decontamination":
            assert {r.doc_id for r in after} == set(before) - {d for d, _ in brute.leaks(list(before.items()), items)}
        elif name == "pii":
            assert {r.doc_id for r in after} == set(before)
            for r in after:
                assert not brute.base_spans(r.text) and r.n_chars == len(r.text)
                if not brute.base_spans(before[r.doc_id]) and "<" not in r.text:
                    assert r.text == before[r.doc_id]
        else:
            assert {r.doc_id for r in after} == set(before)
            lengths = brute.token_ids(list(before.values()), "word_bpe_49k.json", 1)
            assert sum(r.length for r in after) == sum(map(len, lengths))
        if k < len(P.STAGES) - 1:
            assert out.columns == columns
            assert all(r.text == before[r.doc_id] for r in after) or name == "pii"
        docs = out
    assert P.run(spark, SF_SMALL).count() == docs.count()


def _tables(spark, folder, rows, items, labels):
    schema = "sequence_id int, doc_id long, text string, lang string, source string, n_chars long, `uid` int, score double, `__key` int"
    docs = spark.createDataFrame([(9, d, t, "en", "s", None if t is None else len(t), 1, 0.5, 3) for d, t in rows], schema)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(*x, "e") for x in labels], "doc_id long, quality int, toxic int, text string").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_run_over_nulls_repeats_clashing_columns_and_empty_tables(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(i, " ".join(f"word{j}" for j in rng.integers(0, 500, 80)) + ".") for i in range(40)]
    bad = [(100 + i, "buy now cheap pills " * 20 + f"{i}") for i in range(40)]
    leak = " ".join(f"word{j}" for j in rng.integers(0, 500, 30))
    odd = [(200, None), (201, ""), (None, good[0][1]), (None, None), (3, good[3][1]), (3, good[39][1] + " other text entirely"),
           (202, good[5][1] + " " + leak), (203, good[7][1] + " mail a.b@example.com"), (204, good[9][1] + " x" * 30_000)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 1), (3, None, None)]
    folder = _tables(spark, str(tmp_path / "a"), good + bad + odd, [(1, leak), (1, None), (None, leak)], labels)
    out = P.run(spark, folder).collect()
    assert {r.doc_id for r in out} <= {d for d, _ in good + odd + bad} and 202 not in {r.doc_id for r in out}
    at = defaultdict(list)
    for r in out:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        ends = [0] + [o + n for o, n in sorted(places)]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
    empty = _tables(spark, str(tmp_path / "b"), [], [], [])
    assert P.run(spark, empty).count() == 0
