"""Whitening, exact top-k and collocations against brute force, with nulls, ties, repeats, odd lengths and clashing columns."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from augury.llm import phrases, topk, whitening

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, row string, x long, n long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1, 2) for i, v in rows], VECTORS)


def odd_vectors(rng, count=120, size=12):
    base = rng.normal(0, 0.2, (count, size)) @ rng.normal(0, 1, (size, size))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # a third are copies
    return [*rows, (5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (2000, None), (2001, []), (2002, [None] * size), (2003, [NAN, *[0.0] * (size - 1)]), (2004, [INF, *[0.0] * (size - 1)])]


@pytest.mark.parametrize("weight", ["count", "one"])
def test_whitening_equals_numpy(spark, weight):
    rows = [*odd_vectors(np.random.default_rng(3)), (3000, [1.0, 2.0])]
    found = whitening.whiten(vectors(spark, rows), components=5, weight=weight).select("row.vec_id", "row.row", "x", "n", "deviation", "whitened", "eigenvalues", "trace", "identity_error").collect()
    good = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows if v and len(v) == 12 and all(c is not None and math.isfinite(c) for c in v)]
    assert sorted(((r["vec_id"] is None, r["vec_id"], r["x"]) for r in found), key=str) == sorted(((i is None, i, x) for i, x in good), key=str)
    fit = np.array([x for _, x in good] if weight == "count" else sorted({tuple(x) for _, x in good}), float)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh((fit - sums / n).T @ (fit - sums / n) / n)
    values, axes = values[::-1], axes[:, ::-1][:, :5]
    for r in found:
        assert r["n"] == n and r["row"] == "r"
        assert int(r["deviation"]) == sum((n * int(x) - int(s)) ** 2 for x, s in zip(r["x"], sums))
        want = (np.array(r["x"], float) - sums / n) @ axes / np.sqrt(values[:5])
        assert np.allclose(np.abs(r["whitened"]), np.abs(want), atol=1e-8)
        assert np.allclose(r["eigenvalues"], values[:5], rtol=1e-10) and math.isclose(r["trace"], values.sum(), rel_tol=1e-10)
        assert r["identity_error"] < 1e-9
    one = {tuple(r["x"]): r["whitened"] for r in found}
    assert all(one[tuple(r["x"])] == r["whitened"] for r in found)
    w = np.array([one[tuple(int(c) for c in x)] for x in fit])  # one sign for all rows
    assert np.allclose(w.T @ w / n, np.eye(5), atol=1e-9)


def test_whitening_of_few_and_constant_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [0.5, -0.5])] * 3)).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["trace"]) for r in one] == [(3, 0, [None, None], 0.0)] * 3
    line = whitening.whiten(vectors(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [3.0e12, 1.0])])).collect()  # one direction, huge entries
    assert sorted(r["row"]["vec_id"] for r in line) == [1, 2, 3]
    assert all(r["whitened"][1] is None and r["whitened"][0] is not None for r in line) and len({int(r["deviation"]) for r in line}) >= 2
    with pytest.raises(ValueError):
        whitening.whiten(vectors(spark, []), weight="all")


def brute_nearest(rows, k, asks):
    good = [(at, i, [math.floor(1024 * c) for c in v]) for at, (i, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, i, q in good:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j is not None, j or 0, other) for other, j, v in good if other != at and len(v) == len(q))
            out += [(i, rank + 1, s[2] if s[1] else None, -s[0]) for rank, s in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("lists", [1, 2, 3, 20])
def test_topk_equals_brute_force(spark, lists):
    rng = np.random.default_rng(5)
    rows = [*odd_vectors(rng), *[(7000 + i, [float(c) for c in rng.integers(-2, 3, 3)]) for i in range(40)], (8000, [1.0])]
    asks = lambda i: i is not None and i % 20 == 0
    got = [tuple(r) for r in topk.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=4, lists=lists).collect()]
    assert sorted(got, key=str) == sorted(brute_nearest(rows, 4, asks), key=str)


def test_topk_with_few_candidates_and_small_groups(spark, monkeypatch):
    assert topk.nearest(vectors(spark, []), F.col("vec_id") % 2 == 0).count() == 0
    assert topk.nearest(vectors(spark, [(2, [1.0]), (4, None)]), F.col("vec_id") % 2 == 0).count() == 0
    rows = [(2, [1.0, 1.0]), (2, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [-1.0, 0.5]), (4, [0.0, 0.0])]
    got = [tuple(r) for r in topk.nearest(vectors(spark, rows), F.col("vec_id") % 2 == 0).collect()]
    assert sorted(got, key=str) == sorted(brute_nearest(rows, 10, lambda i: i is not None and i % 2 == 0), key=str)
    monkeypatch.setattr(topk, "GROUP", 7)  # several groups of queries
    rows = odd_vectors(np.random.default_rng(9))
    got = [tuple(r) for r in topk.nearest(vectors(spark, rows), F.lit(True), k=3).collect()]
    assert sorted(got, key=str) == sorted(brute_nearest(rows, 3, lambda i: True), key=str)
    with pytest.raises(ValueError):
        topk.nearest(vectors(spark, [(1, [4.0e12, 0.0]), (2, [1.0, 1.0])]), F.lit(True))


def test_topk_partial_scores_are_exact():
    big = np.array([[2**30, -(2**30) + 1]]), np.array([[2**30 - 3, 2**30 - 5], [1, 1]])
    assert topk._partial(*big).tolist() == [[2**30 * (2**30 - 3) - (2**30 - 1) * (2**30 - 5), 1]]


def brute_phrases(rows, least, first):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", *w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    for (lang, *g), a in f.items():
        if a < least or len(g) < 2:
            continue
        inside = lambda b: any(b[i : i + len(g)] == g for i in range(len(b) - len(g) + 1))  # noqa: E731,B023
        if any(c >= a and la == lang and len(b) > len(g) and inside(b) for (la, *b), c in f.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *g[:k]] * f[lang, *g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(g).encode("utf-8", "surrogatepass"), f[lang, *g[:k]], f[lang, *g[k:]]))
    return [(lang, at + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in found.items() for at, x in enumerate(sorted(xs)[:first])]


def phrase_rows(rng):
    vocabulary = ["The", "of", "und", "x" * 40, "é", "É", "日本", "a b", "c-d", "tab\tbed", "1.5", "Z"]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(int(rng.integers(0, 40))):
            words.append(str(rng.choice(vocabulary)) + str(rng.choice(["", "", "", "", ",", ".", "\n", " \x0b", "!?"])))
        texts.append(str(rng.choice([" ", "  ", " \t"])).join(words))
    rows = [(t, str(rng.choice(["en", "de"]))) for t in texts]
    rows += [("red Green blue yellow black white", "en")] * 9 + [("red green blue", "en")] * 2 + [("alpha beta", None), ("alpha beta", "und"), ("Alpha  BETA", None), ("alpha beta.", None)] * 2
    return [*rows, (None, "en"), ("", "en"), (" \n.\t", None), ("again and " * 3000, "fr"), ("one", "xx")]


@pytest.mark.parametrize("least,first,bits", [(2, 10_000, 16), (6, 5, None), (6, 10_000, 16), (300, 10, 16)])
def test_phrases_equal_brute_force(spark, least, first, bits):
    rows = phrase_rows(np.random.default_rng(11))
    table = spark.createDataFrame([(i, t, lang, "w", 7, 8) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, word string, n long, w1 long").repartition(3)
    got = [tuple(r)[:8] for r in phrases.collocations(table, least, first, bits=bits).collect()]
    want = brute_phrases(rows, least, first)
    assert sorted(got) == sorted(want) and len(want) > 1


def test_phrases_of_empty_tables_and_shared_numbers(spark, monkeypatch):
    table = spark.createDataFrame([("to be or not to be", "en")] * 4, "text string, lang string")
    assert phrases.collocations(table.limit(0), 2).count() == 0
    want = sorted(brute_phrases([("to be or not to be", "en")] * 4, 2, 10))
    assert sorted(tuple(r)[:8] for r in phrases.collocations(table, 2, 10).collect()) == want
    tried = []
    plain = phrases._grams

    def clash(docs, sent, bits, seed):
        tried.append(seed)
        found = plain(docs, sent, bits, seed)
        return found if seed else found.unionByName(found.where("word is not null").withColumn("word", F.lit("other")))

    monkeypatch.setattr(phrases, "_grams", clash)
    assert sorted(tuple(r)[:8] for r in phrases.collocations(table, 2, 10).collect()) == want and tried == [0, 1]


def test_word_numbers_depend_on_language_and_place():
    import pyarrow as pa

    w = phrases.Words(pa.array(["ab ba ab", None, "AB", "ab"]), pa.array(["en", "en", None, "und"]), 0)
    assert len({int(x) for x in w.number}) == 3 and w.number[0] == w.number[2] and w.number[3] == w.number[4] != w.number[0]
    assert w.opens.tolist() == [True, False, False, True, True]
