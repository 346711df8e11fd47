"""The corpus pipeline against a brute-force version of its stages."""

import base64
import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 8)))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words, n)).capitalize() + "."
    rows = [[i, prose(80), "en" if i % 3 else "fr", f"s{i % 2}"] for i in range(90)]
    for r in rows[:40]:
        r[1] = "Shared menu line\n" + r[1] if r[3] == "s0" else r[1]
    for r in rows[51:81:10]:  # three of a source
        assert r[3] == "s1"
        r[1] += "\nRare footer line"
    for i in range(90, 100):  # near copies of the first ten, and exact ones
        w = rows[i - 90][1].split(" ")
        w[40] = "changed"
        rows.append([i, " ".join(w) if i % 2 else rows[i - 90][1], "en", "s0"])
    passage = " ".join(rng.choice(words, 14))
    for i in range(100, 103):
        rows.append([i, prose(40) + " " + passage.upper() + " " + prose(40), "en", "s1"])
    for i in range(103, 108):
        rows.append([i, " ".join("$#%" + "".join(rng.choice(list("QXZ0189|"), 6)) for _ in range(60)), "en", "s1"])
    rows += [[108, None, "en", "s0"], [109, "", None, None], [None, prose(70), None, None]]
    rows = [(*r, len(r[1] or "")) for r in rows]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(103, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "Intro " + passage + " end"), (2, "unrelated item text of many words that no document has at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_pipeline_equals_brute_force(spark, inputs):
    import public_tokenizers
    import tiktoken

    folder, rows = inputs
    docs = [list(r) for r in rows if r[1] and "$#%" not in r[1]]
    totals, counts = {}, {}
    for r in docs:
        totals.setdefault(r[3], set()).add(r[1])
    for source, texts in totals.items():
        for t in texts:
            for line in {x.strip() for x in t.split("\n")} - {""}:
                counts[source, line] = counts.get((source, line), 0) + 1
    for r in docs:
        keep = [x for x in r[1].split("\n") if not x.strip() or not (counts[r[3], x.strip()] >= 3 and counts[r[3], x.strip()] > 0.01 * len(totals[r[3]]))]
        r[1] = "\n".join(keep) if any(x.strip() for x in keep) else r[1]
    assert all(any(x in r[1] for r in rows if r[1]) and not any(x in r[1] for r in docs) for x in ("Shared menu", "Rare footer"))
    assert 0.01 < counts["s1", "Rare footer line"] / len(totals["s1"]) < 0.1  # a ratio of 0.1 would keep it
    sets, up = [shingles(r[1]) for r in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up = [up[j] if x == up[i] else x for x in up]
    groups = {}
    for r, g in zip(docs, up):
        groups.setdefault(g, []).append(r)
    docs = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    items = [words(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(len(w) - 9)}
    docs = [r for r in docs if not windows & {tuple(words(r[1])[i : i + 10]) for i in range(len(words(r[1])))}]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == {r[0] for r in docs} and 80 < len(got) < 95 and not {100, 101, 102} & set(got)
    for r in docs:
        assert got[r[0]]["ids"] == other.encode_ordinary(r[1])
        assert got[r[0]]["decoded_sha256"] == hashlib.sha256(r[1].encode()).hexdigest()


def test_stages_take_empty_tables_and_keep_columns(spark, inputs):
    folder, _ = inputs
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0, name
        if name != "tokens":
            assert out.columns == docs.columns


def test_line_dedup_drops_lines_of_a_small_share_of_a_source(spark, inputs):
    folder, _ = inputs
    rows = [(i, f"own text {i}" + ("\nPlanted footer" if i % 40 == 0 else "") + ("\nQuoted twice" if i in (1, 2) else ""), "en", "s", 0) for i in range(400)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, DOCS), folder).collect()}
    assert not any("Planted footer" in t for t in got.values())  # 10 of 400 texts
    assert "Quoted twice" in got[1] and all(got[i].startswith(f"own text {i}") for i in range(400))


def test_near_dedup_keeps_one_row_of_each_group(spark, inputs):
    folder, _ = inputs
    words = [f"w{i}" for i in range(120)]
    text, near = " ".join(words), " ".join([*words[:60], "changed", *words[61:]])
    other = " ".join(reversed(words))
    far = " ".join(words[::2])
    rows = [(1, text, "en", "a")] * 5 + [(1, near, "en", "a"), (2, text, "en", "a"), (None, text, "en", "a")]  # one group
    rows += [(None, other, "en", "b")] * 3 + [(None, far, "en", "c")] * 2 + [(7, " ", "en", "d")] * 2 + [(8, " ", "en", "d"), (9, "alone", "en", "d")]
    table = spark.createDataFrame([(*r, 0, "p", "q", "r") for r in rows], DOCS + ", k_id string, hash string, row string")
    got = corpus_pipeline.near_dedup(spark, table, folder)
    assert got.columns == table.columns
    got = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(got) == 6 and {x for i, x in got if i == 1} <= {text, near}
    assert sorted(map(str, got)) == sorted(map(str, [next(g for g in got if g[0] == 1), (None, other), (None, far), (7, " "), (8, " "), (9, "alone")]))
