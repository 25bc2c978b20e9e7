import math
import random
import zlib

import numpy as np

from gridmart.llm.langid import SAMPLE_ROWS, Model, codewords, gram_counts, identify
from tests.llm.conftest import edge_rows, frame

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark, scratch):
    docs = spark.read.parquet(DOCS)
    got = identify(docs, scratch, carry=["doc_id", "lang"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r["row"].doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r["row"].lang for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark, scratch):
    docs = spark.read.parquet(DOCS).limit(300)
    wrong = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 'xx' ELSE lang END AS lang")
    a = {r["row"].doc_id: (r.lang_pred, r.score) for r in identify(docs, scratch).collect()}
    b = {r["row"].doc_id: (r.lang_pred, r.score) for r in identify(wrong, scratch).collect()}
    assert a == b


def test_edges(spark, scratch):
    rows = edge_rows()
    docs = frame(spark, rows)
    got = identify(docs, scratch)
    assert got.select("row.*").columns == docs.columns
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        blank = not any(c.isalpha() for c in (r["row"].text or ""))
        assert (r.lang_pred == "und") == blank and (r.score == 0.0) == blank
    assert identify(frame(spark, []), scratch).count() == 0
    unlabelled = frame(spark, [(i, "some text", None, None) for i in range(5)])
    assert {r.lang_pred for r in identify(unlabelled, scratch).collect()} == {"und"}
    single = frame(spark, [(i, "some text", "aa", None) for i in range(5)])
    assert {r.lang_pred for r in identify(single, scratch).collect()} == {"aa"}


def test_codewords_differ_and_have_both_classes():
    for n in (2, 3, 4, 7, 8, 30):
        code = codewords(n)
        assert len({tuple(r) for r in code}) == n and (np.abs(code.sum(axis=0)) < n).all()
    four = codewords(4)
    assert four.shape == (4, 7) and min((four[i] != four[j]).sum() for i in range(4) for j in range(i)) == 4


def test_one_wrong_bit_is_corrected():
    code = codewords(4)
    model = Model(list("abcd"), code, np.zeros((1, 7)), np.ones(7), np.full((4, 7), 1 / 7))
    for k in range(4):
        for bit in range(7):
            margins = code[k].copy()
            margins[bit] *= -1
            model.margins = lambda text, m=margins: m
            assert model.predict("x")[0] == "abcd"[k]
    model.margins = lambda text: np.zeros(7)
    assert model.predict("x")[2]                              # nothing to go by: ambiguous
    assert SAMPLE_ROWS == 2000 and gram_counts("ab").sum() == 4 + 3 + 2


def grams(text):
    """Buckets of a text's n-grams, character by character."""
    chars = [32, *[ord(c) if c.isalpha() else 32 for c in text.lower()], 32]
    out = {}
    for at in range(len(chars)):
        mixed = 0
        for order, c in enumerate(chars[at: at + 3], 1):
            mixed = ((mixed ^ c) * (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)[order - 1]) & 0xFFFFFFFF
            bucket = (((mixed ^ mixed >> 15) * 0x9E3779B1) & 0xFFFFFFFF) >> 18
            out[bucket] = out.get(bucket, 0) + 1
    return out


def test_predictions_against_plain_counting(spark, scratch):
    """Bit classifiers, their weights and the decoding, once more with dictionaries over all labelled texts."""
    r = random.Random(3)
    letters = {"aa": "abcdefgh ", "bb": "defghijk ", "cc": "ghijklmé ", "dd": "ijklmnop "}
    rows = [(i, "".join(r.choice(letters[lang]) for _ in range(r.randrange(5, 60))), lang, "s")
            for i in range(160) for lang in [r.choice(sorted(letters))]]
    languages, code = sorted(letters), codewords(4)
    learn = [(grams(t), languages.index(lang)) for i, t, lang, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    share = []
    for k in range(4):
        total = {}
        for g, of in learn:
            for b, n in g.items() if of == k else ():
                total[b] = total.get(b, 0) + n
        size = sum(total.values()) + 0.5 * (1 << 14)
        share.append(lambda b, total=total, size=size: (total.get(b, 0) + 0.5) / size)

    def margins(g):
        out = []
        for bit in range(code.shape[1]):
            plus, minus = ([s for s, c in zip(share, code[:, bit]) if c == sign] for sign in (1, -1))
            out.append(sum(n * (math.log(sum(s(b) for s in plus) / len(plus)) - math.log(sum(s(b) for s in minus) / len(minus)))
                           for b, n in g.items()) / sum(g.values()))
        return np.array(out)

    found = [(margins(g), k) for g, k in learn]
    scale = np.mean([abs(m) for m, _ in found], axis=0)
    trust = np.array([[(sum(m[b] * code[k, b] > 0 for m, of in found if of == k) + 1) / (sum(of == k for _, of in found) + 2)
                       for b in range(code.shape[1])] for k in range(4)])
    trust /= trust.sum(axis=1, keepdims=True)
    for got in identify(frame(spark, rows), scratch, carry=["doc_id", "text"]).collect():
        if not any(c.isalpha() for c in got["row"].text):
            continue
        loss = (trust * np.log1p(np.exp(-2 * code * margins(grams(got["row"].text)) / scale))).sum(axis=1)
        chance = np.exp(-4 * loss) / np.exp(-4 * loss).sum()
        assert got.lang_pred == languages[int(chance.argmax())]
        assert abs(got.score - chance.max()) < 1e-4


def test_very_many_labels(spark, scratch):
    """More labels than are learned: those with most rows are."""
    rows = [(i, "alpha beta gamma", f"l{i}", "s") for i in range(700)] + [(1000 + i, "delta epsilon", "many", "s") for i in range(30)]
    got = identify(frame(spark, rows), scratch, carry=["doc_id"]).collect()
    assert len(got) == len(rows) and all(r.lang_pred != "und" for r in got)
    assert {r.lang_pred for r in got if r["row"].doc_id >= 1000} == {"many"}
