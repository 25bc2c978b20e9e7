import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from gridmart.llm.oracle import ORACLE_SQL
from gridmart.llm.queries import QUERIES
from tests.llm.conftest import edge_rows, frame
from tests.llm.test_near_dedup import brute
from tests.llm.test_tokens_packing_wavelet import check_pieces

SF = "/root/testdata/sf0.001"


def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    import numpy as np
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()


def stages(spark, scratch, docs):
    out = [docs]
    for name, stage in pipeline.STAGES[:-1]:
        out.append(scratch.write(stage(spark, out[-1], SF), name))
        assert out[-1].columns == docs.columns
    return out, pipeline.STAGES[-1][1](spark, out[-1], SF)


def test_stages_on_edges_against_brute_force(spark, scratch):
    rows = edge_rows()
    (docs, named, exact, near, mixed), packed = stages(spark, scratch, frame(spark, rows))
    key = lambda df: sorted([(r.doc_id, r.text, r._gone) for r in df.collect()], key=str)
    letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert key(named) == sorted([(i, t, 4) for i, t, *_ in letters], key=str)
    left = {}
    for i, t, *_ in letters:
        n = "".join(c.lower() if c.isascii() else c for c in t)
        left[n] = max([left.get(n, (None, "")), (i, t)], key=lambda x: -1 if x[0] is None else x[0])
    assert sorted([r.doc_id for r in exact.collect()], key=str) == sorted([i for i, _ in left.values()], key=str)
    stays = [(r.doc_id, r.text, None, None) for r in exact.collect()]
    keep = [i for i, _, c in brute(stays) if i is None or c == i]
    assert sorted([r.doc_id for r in near.collect()], key=str) == sorted(keep, key=str)
    copies = {}
    for r in mixed.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert set(copies) <= {r.doc_id for r in near.collect()} and max(copies.values()) <= 2
    check_pieces(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()], library())


def test_run_on_the_table_and_on_an_empty_one(spark, scratch, tmpdir_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, named, exact, near, mixed), _ = stages(spark, scratch, docs)
    assert named.count() == docs.count() >= exact.count() >= near.count()
    got = pipeline.run(spark, SF).collect()
    assert check_pieces(got, [(r.doc_id, r.text) for r in mixed.collect()], library()) == 0
    docs.limit(0).write.parquet(f"{tmpdir_path}/documents.parquet")
    assert pipeline.run(spark, tmpdir_path).count() == 0


def test_registered_queries():
    names = [n.split("_")[0] for n in QUERIES if n != "pipeline"]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_rows_that_share_an_id_are_told_apart(spark, scratch):
    """x and y share id 1; x is near the text of 0, y near that of 2 and of a row without id."""
    from tests.llm.conftest import words
    x, y = words(50, 100), words(51, 100)
    rows = [(0, x + " end", "aa", "s"), (1, x, "aa", "s"), (1, y, "aa", "s"), (2, y + " end", "aa", "s"), (None, y + " more", "aa", "s"),
            (None, words(52, 100), "aa", "s"), (None, words(52, 100) + " z", "aa", "s")]
    near = pipeline.near_dedup_stage(spark, frame(spark, rows), SF)
    got = sorted([(r.doc_id, r.text) for r in near.collect()], key=str)
    assert [g for g in got if g[0] is not None] == [(0, x + " end"), (1, y)]
    assert len([g for g in got if g[0] is None]) == 1


def test_without_labels_texts_with_letters_stay(spark, scratch):
    rows = [(1, "some text", None, "s"), (2, "12 34", None, "s"), (3, None, None, "s"), (4, "\u65e5\u672c", None, None), (5, "", None, "s")]
    assert sorted(r.doc_id for r in pipeline.language_id(spark, frame(spark, rows), SF).collect()) == [1, 4]


def test_two_runs_agree(spark):
    rows = [sorted(map(str, pipeline.mixing(spark, spark.read.parquet(f"{SF}/documents.parquet").repartition(n), SF).collect())) for n in (2, 7)]
    assert rows[0] == rows[1]
