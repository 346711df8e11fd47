"""Operators of the llm subpackage against brute force, on small fixtures with nulls, ties, repeats and odd columns."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from augury.llm import bpe, credentials, eliasfano, kneserney, langid, lines, queries, quotes, simhash, triemodel, wumanber
from augury.llm.common import components, ranked
from augury.llm.minhash import least_matches, near_duplicates, shared_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string"


def docs(spark, rows):
    """Documents (id, text, lang, source) with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y") for r in rows], DOCS)


def prose(rng, n, words=None):
    words = words or [f"w{i}" for i in range(300)]
    return " ".join(rng.choice(words, n))


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    base = [prose(rng, int(rng.integers(1, 90))) for _ in range(60)]
    rows = [(i, t, "en", "a") for i, t in enumerate(base)]
    for i in range(60, 110):  # near copies of different strength, and copies of copies
        words = rows[int(rng.integers(0, len(rows)))][1].split()
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, len(words)))] = f"n{i}"
        rows.append((i, " ".join(words), "en", "b"))
    return [*rows, (200, None, None, None), (201, "", "en", "a"), (202, " \t\n", "en", "a"), (203, "One Two", "en", None), (203, "One Two", "en", None), (None, base[0], "en", "a"), (204, "x " * 30_000, "en", "a")]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_minhash_equals_brute_force(spark, corpus):
    got = sorted(map(tuple, near_duplicates(docs(spark, corpus)).drop("text_hash").collect()), key=str)
    sets = [shingles(r[1]) for r in corpus]
    up = list(range(len(corpus)))
    for i in range(len(up)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = up[i], up[j]
                up = [b if x == a else x for x in up]
    want = []
    for i, r in enumerate(corpus):
        ids = [corpus[j][0] for j in range(len(up)) if up[j] == up[i] and corpus[j][0] is not None]
        least = min(ids) if ids else None
        want.append((r[0], len(sets[i]), least, r[0] == least))
    assert got == sorted(want, key=str)
    assert len({w[2] for w in want}) < len({r[0] for r in corpus}) - 10


def test_minhash_chain_without_common_lead(spark):
    """A group whose members lie too far from its first one is still joined through the others."""
    words = [f"a{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words[8 * i : 8 * i + 3] = [f"b{i}", f"c{i}", f"d{i}"]
        rows.append((i, " ".join(words), None, None))
    got = near_duplicates(docs(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_minhash_empty(spark):
    assert near_duplicates(docs(spark, [])).count() == 0


def test_pruning_bound_and_shared_counts():
    needed = least_matches([16, 64, 128], 0.75, 1e-6)
    assert needed == sorted(needed) and 60 < needed[2] < 96
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, n).astype(np.uint64)) for n in (1, 50, 300, 400)]
    want = [[len(np.intersect1d(x, y)) for y in sets[2:]] for x in sets[:2]]
    assert shared_counts(sets[:2], sets[2:]).tolist() == want


def test_components_and_ranks(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 3), (None, 1), (9, 8), (8, 7), (7, 9), (5, 4)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(3, 3), (4, 3), (5, 3), (7, 7), (8, 7), (9, 7)}
    assert components(edges.limit(0)).count() == 0
    rows = spark.createDataFrame([(i * 7 % 50,) for i in range(50)] + [(None,), (3,)], "x long")
    got = [r["x"] for r in ranked(rows, ["x"]).orderBy("rank").collect()]
    assert got == [None, 0, 1, 2, 3, 3, *range(4, 50)]
    assert sorted(r["rank"] for r in ranked(rows, ["x"]).collect()) == list(range(52))


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?"),
        (1, 1, "assistant", "> hello   THERE.\nFine, thanks."),
        (1, 2, "user", ">> Hello there.\n> Fine, thanks.\nGood."),
        (1, 3, "user", ">How are you?\n> > unknown\nMe too."),
        (2, 0, "user", "Hello there."), (2, 1, "user", "> nothing said before"), (2, None, "user", None),
        (None, 0, "user", "a"), (None, 1, "user", "> A\n\nb"), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "user", ">same\nyes"),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = {(r["conv_id"], r["turn"], r["text"]): r for r in quotes.conversations(table).collect()}
    assert len(quotes.conversations(table).collect()) == len(rows)
    assert [got[1, t, x]["parent"] for t, x in ((0, "Hello there.\nHow are you?"), (1, "Fine, thanks."), (2, "Good."), (3, "Me too."))] == [None, 0, 1, 0]
    assert [got[1, t, x]["depth"] for t, x in ((2, "Good."), (3, "Me too."))] == [2, 1]
    assert [got[1, t, x]["position"] for t, x in ((0, "Hello there.\nHow are you?"), (1, "Fine, thanks."), (3, "Me too."), (2, "Good."))] == [0, 1, 2, 3]
    assert got[2, 1, ""]["parent"] is None and got[2, None, ""]["position"] == 0
    assert got[None, 1, "b"]["parent"] == 0 and got[3, 1, "yes"]["parent"] == 0
    assert quotes.conversations(table.limit(0)).count() == 0


def test_quotes_of_parts(spark):
    original = "One first line\nand its second.\n\nTwo begins here\nand goes on\nto its end.\n\nThree."
    rows = [
        (1, 0, original), (1, 1, "Something else."),
        (1, 2, "> Two begins here\n> and goes on\n> to its end.\nOne paragraph."),
        (1, 3, "> and goes on\n> to its end.\nTwo of three lines."),
        (1, 4, "> One first line\n> and its second.\n\n> Three.\nA blank line without a mark."),
        (1, 5, "> Two begins\n> here and goes on to\n> its end.\nWrapped anew."),
        (1, 6, "Three."), (1, 7, "> Three.\nThe latest."), (1, 8, "> goes\nNo part."), (1, 9, "> Two begins here\n> and goes on\n>\n> Three.\nMost parts."),
        (2, 5, "Three."), (2, 5, "> Three.\nNot of its own turn."),
    ]
    table = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r["text"].split("\n")[-1]: r["parent"] for r in quotes.conversations(table).collect() if r["n_quotes"]}
    assert got == {"One paragraph.": 0, "Two of three lines.": 0, "A blank line without a mark.": 0, "Wrapped anew.": 0, "The latest.": 6, "No part.": None, "Most parts.": 0, "Not of its own turn.": None}


def brute_threads(rows):
    """(conv, turn, text) -> (parent, thread, depth, position, clean), by comparing texts message by message."""
    normal = lambda t: re.sub(r"\s+", " ", t).strip().lower()
    parsed = []
    for conv, turn, role, text in rows:
        runs = []
        for line in re.split(r"\r?\n", text or ""):
            marks = re.match(r"(?:[ \t]*>)+", line)
            level = marks[0].count(">") if marks else 0
            if runs and runs[-1][0] == level:
                runs[-1][1].append(line[marks.end() if marks else 0 :])
            else:
                runs.append((level, [line[marks.end() if marks else 0 :]]))
        own = ["\n".join(ls) for level, ls in runs if level == 0]
        quotes = [(level, "\n".join(ls)) for level, ls in runs if level and normal("\n".join(ls))]
        clean = "\n".join(own).strip(" \t\r\n")
        paragraphs = [x for p in own for x in re.split(r"\n\s*\n", p) if normal(x)]
        full = [x for p in own for x in p.split("\n") if normal(x)]
        offers = {normal(clean), *map(normal, own), *map(normal, paragraphs)} | {normal("\n".join(full[a:z])) for a in range(len(full)) for z in range(a + 1, len(full) + 1)}
        parsed.append((conv, turn, role, clean, quotes, offers - {""}))
    up = {}
    for k, (conv, turn, _, _, quotes, _) in enumerate(parsed):
        found = []
        for nth, (level, text) in enumerate(quotes):
            parts = [[x for x in re.split(by, text) if normal(x)] if len(re.split(by, text)) > 1 else [] for by in (r"\n\s*\n", "\n")]
            for part, pieces in ((False, [text]), (True, sum(parts, []))):
                votes = collections.Counter()
                for piece in pieces:
                    turns = [t for c, t, _, _, _, offers in parsed if c == conv and t < turn and normal(piece) in offers]
                    if turns:
                        votes[max(turns)] += len(normal(piece))
                found += [((level, nth, part, -n, -t), t) for t, n in votes.items()]
        up[conv, turn] = min(found)[1] if found else None
    out = {}
    for conv, turn, role, clean, _, _ in parsed:
        top, depth = turn, 0
        while up[conv, top] is not None:
            top, depth = up[conv, top], depth + 1
        out[conv, turn] = [up[conv, turn], top, depth, clean]
    for conv in {c for c, _ in out}:
        for place, turn in enumerate(sorted((t for c, t in out if c == conv), key=lambda t: (out[conv, t][1], out[conv, t][2], t))):
            out[conv, turn].insert(3, place)
    return {k: tuple(v) for k, v in out.items()}


def test_quotes_equal_brute_force(spark):
    """Generated conversations that quote wholes, paragraphs, lines and runs of lines of earlier turns, nested ones too."""
    rng = np.random.default_rng(13)
    rows = []
    for conv in range(250):
        said = []
        for turn in range(int(rng.integers(1, 8))):
            own = ["\n".join(prose(rng, int(rng.integers(1, 6)), ["Aa", "bb", "cc", "Dd", "ee"]) for _ in range(int(rng.integers(1, 4)))) for _ in range(int(rng.integers(1, 3)))]
            text = "\n\n".join(own)
            if said and rng.random() < 0.75:
                lines = str(rng.choice(said)).split("\n")
                a = int(rng.integers(0, len(lines)))
                z = int(rng.integers(a, len(lines))) + 1
                quote = lines if rng.random() < 0.3 else lines[a:z]
                mark = str(rng.choice(["> ", ">", ">> ", "  > "]))
                quote = [x if not x and rng.random() < 0.5 else mark + (x.upper() if rng.random() < 0.2 else x.replace(" ", "  ")) for x in quote]
                text = "\n".join([*quote, *([text] if rng.random() < 0.9 else [])])
                if rng.random() < 0.2:
                    text += "\r\n> made up\r\nend"
            said.append(text)
            rows.append((conv, turn * 2, "user", text))
    got = {(r["conv_id"], r["turn"]): (r["parent"], r["thread"], r["depth"], r["position"], r["text"]) for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    want = brute_threads(rows)
    assert {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    assert sum(v[0] is not None for v in want.values()) > 300 and max(v[2] for v in want.values()) > 3
    assert all(got[k][4].split() == want[k][4].split() for k in want)


def test_simhash(spark, corpus):
    table = docs(spark, corpus)
    got = simhash.likeness(table).collect()
    assert len(got) == len(corpus)
    order = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in corpus})
    by_id = {r["doc_id"]: r for r in got}
    prints = {}
    for k, (_, i, text) in enumerate(order):
        i = i if order[k][0] else None
        following = order[(k + 1) % len(order)][2]
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        row = by_id[i]
        assert row["n_chars"] == n and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert prints.setdefault(edited, row["edited_fingerprint"]) == row["edited_fingerprint"]
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        assert row["near_edited"] == bits(row["fingerprint"], row["edited_fingerprint"])
    assert simhash.likeness(table.limit(0)).count() == 0


def pair(r):
    return (r["q1"] % (1 << 64)) << 64 | r["q0"] % (1 << 64), (r["f1"] % (1 << 64)) << 64 | r["f0"] % (1 << 64)


def test_simhash_votes_and_radius(spark):
    text = "a b a b c " * 9_000  # several chunks of votes
    rows = spark.createDataFrame([(1, text), (2, "a"), (3, "")], "i long, text string")
    got = {r["i"]: r for r in simhash.fingerprints(rows.select("i", simhash.terms(F.col("text")).alias("terms")), ["i"]).collect()}
    words = re.split(r"[\x20\x09-\x0D]+", text)
    pairs = collections.Counter((a, b) for a, b in zip(words, [*words[1:], None]))
    table = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "a string, b string, n long").select(F.xxhash64(F.xxhash64("a"), F.when(F.col("b").isNotNull(), F.xxhash64("b"))).alias("h"), "n").collect()
    votes = [sum(r["n"] * (1 if r["h"] >> k & 1 else -1) for r in table) for k in range(64)]
    assert sum(1 << k for k in range(64) if votes[k] > 0) == got[1]["f0"] % (1 << 64)

    rng = np.random.default_rng(3)
    prints = []
    for _ in range(40):
        x = int.from_bytes(rng.bytes(16), "big")
        prints += [x, *(x ^ sum(1 << int(b) for b in rng.choice(128, k, False)) for k in (1, 2, 3, 4))]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(p & (1 << 64) - 1), signed(p >> 64)) for p in prints], "f0 long, f1 long")
    found = {pair(r) for r in simhash.within_radius(frame, frame, 3).collect()}
    assert found == {(p, q) for p in prints for q in prints if p != q and (p ^ q).bit_count() <= 3}


def test_simhash_links_near_copies_at_any_radius(spark):
    rng = np.random.default_rng(5)
    prints = []
    for _ in range(30):
        x = int.from_bytes(rng.bytes(16), "big")
        prints += [x, *(x ^ sum(1 << int(b) for b in rng.choice(128, k, False)) for k in (1, 2, 5, 8, 12, 17, 20, 21, 24))]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(p & (1 << 64) - 1), signed(p >> 64)) for p in prints], "f0 long, f1 long")
    some = prints[::7]
    asked = spark.createDataFrame([(signed(p & (1 << 64) - 1), signed(p >> 64)) for p in some], "f0 long, f1 long")
    for radius in (0, 1, 2, 8, 20):
        rows = [pair(r) for r in simhash.within_radius(asked, frame.unionByName(frame), radius).collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == {(p, q) for p in some for q in prints if p != q and (p ^ q).bit_count() <= radius}
    words = [f"w{i}" for i in rng.integers(0, 300, 120)]
    near = [*words[:60], "changed", *words[61:]]
    table = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, prose(rng, 120))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_links"] for r in simhash.likeness(table).collect()} == {1: 1, 2: 1, 3: 0}
    assert {r["doc_id"]: r["n_links"] for r in simhash.likeness(table, queries=F.col("doc_id") == 2).collect()} == {1: None, 2: 1, 3: None}


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_equals_tiktoken_and_round_trips(spark, corpus, vocabulary):
    import tiktoken

    path, pattern = vocabulary
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    extra = [(300, "naïve \U0001f600\U0001f600 日本語\x85 <|endoftext|>  \n\n x", None, None), (301, "a" * 5_000 + "-" * 777, None, None), (302, "\x1c\x1d a  b ", None, None)]
    rows = [*corpus, *extra]
    encoded = bpe.encode(docs(spark, rows), path, pattern, with_offsets=True, with_split=True)
    found = encoded.select("row.doc_id", "row.text", "ids", "starts", "ends", "n_split").collect()
    assert len(found) == len(rows)
    for r in found:
        text = r["text"] or ""
        assert r["ids"] == other.encode_ordinary(text)
        assert r["n_split"] == sum(a < z for a, z in zip(r["starts"][1:], r["ends"]))
        for i, a, b in zip(r["ids"], r["starts"], r["ends"]):
            piece = other.decode_single_token_bytes(i)
            assert piece in text[a:b].encode()
            assert len(text[a:b].encode()) - len(piece) < 6  # at most split characters at both ends
    decoded = bpe.decode(encoded.select("ids", "row.text"), path, pattern, with_text=True).collect()
    assert all(r["bytes"] == (r["row"]["text"] or "").encode() and r["decoded"] == (r["row"]["text"] or "") for r in decoded)
    odd = bpe.decode(spark.createDataFrame([([50_000_000, None, 0],), (None,)], "ids array<int>"), path, pattern).collect()
    assert [bytes(r["bytes"]) for r in odd] == [next(t for t, i in ranks.items() if i == 0), b""]
    assert bpe._encoder(path, pattern).token_bytes() == [next((t for t, i in ranks.items() if i == k), b"") for k in range(300)] + list(bpe.token_bytes(path)[300:])
    emoji = next(r for r in bpe.decode(encoded.where("row.doc_id = 300").select("ids"), path, pattern, keep=["ids"]).collect())
    alone = bpe.decode(spark.createDataFrame([([i],) for i in emoji["row"]["ids"]], "ids array<int>"), path, pattern, with_text=True).collect()
    assert any("\ufffd" in r["decoded"] for r in alone) and b"".join(bytes(r["bytes"]) for r in alone).decode() == extra[0][1]
    none = bpe.encode(docs(spark, []), path, pattern, keep=["doc_id"])
    assert none.count() == 0 and bpe.decode(none.select("ids"), path, pattern).count() == 0


def test_bpe_bytes_come_from_the_worker_that_encodes(spark, corpus, vocabulary):
    given = docs(spark, [*corpus, (300, "naïve \U0001f600 日本語\x85  \n x", None, None)])
    found = bpe.encode(given, *vocabulary, keep=["text"], with_offsets=True, with_split=True, with_bytes=True)
    assert found.columns == ["row", "ids", "starts", "ends", "n_split", "bytes"]
    rows = found.collect()
    apart = bpe.decode(found.select("ids"), *vocabulary).collect()
    assert len(rows) == len(corpus) + 1 and all(bytes(r["bytes"]) == (r["row"]["text"] or "").encode() for r in rows)
    assert sorted((tuple(r["ids"]), bytes(r["bytes"])) for r in rows) == sorted((tuple(r["row"]["ids"]), bytes(r["bytes"])) for r in apart)
    steps = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    assert steps(corpus_pipeline.tokens(spark, given, "")) == 1  # so many workers are at work for each core
    assert steps(queries.op4_byte_bpe(spark, "/root/testdata/sf0.001")) == 1


def test_bpe_parts_are_cut_where_no_match_goes_on(vocabulary):
    import tiktoken

    path, pattern = vocabulary
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(12)
    pieces = [" ", "  ", "\n", "\t ", " \n", "\x1c", "\x85", "\u3000", "a", "Ab's", "'ll", "12", "-", "é", "日本", "\u2028", "don't", "(x", "_"]
    texts = ["".join(rng.choice(pieces, int(rng.integers(0, 40)))) for _ in range(3000)]
    encoder, known = bpe.Encoder(path, pattern), (bpe.Recent(), bpe.Recent())
    for at in range(0, len(texts), 500):
        for t, ids in zip(texts[at : at + 500], encoder.encode(texts[at : at + 500], known)):
            assert ids.tolist() == other.encode_ordinary(t), t


def brute_lines(rows, ratio, distinct=False, least=1, spare=False):
    """(text, lines, dropped lines) of each row (host, text), by counting whole lines in dictionaries."""
    pages = collections.defaultdict(list)
    for host, text in rows:
        if text is not None and not (distinct and text in pages[host]):
            pages[host].append(text)
    bare = lambda x: x.strip(" \t\r")
    counts = {h: collections.Counter(k for t in texts for k in {bare(x) for x in t.split("\n")} - {""}) for h, texts in pages.items()}
    out = []
    for host, text in rows:
        all_ = [] if text is None else text.split("\n")
        gone = lambda x: bare(x) != "" and counts[host][bare(x)] >= least and counts[host][bare(x)] > ratio * len(pages[host])
        full, lost = sum(bare(x) != "" for x in all_), sum(map(gone, all_))
        if spare and lost == full:
            lost = 0
        out.append((text if not lost else "\n".join(x for x in all_ if not gone(x)), full, lost))
    return out


@pytest.mark.parametrize("rules", [{"ratio": 0.5}, {"ratio": 0.25}, {"ratio": 0.6, "distinct": True, "least": 3, "spare": True}])
def test_site_lines_equal_brute_force(spark, rules):
    rng = np.random.default_rng(9)
    rows = [(i, "\n".join(rng.choice(["Menu", " Menu\t", "Foot", "", "\r", f"own {i}", "again", "x y"], int(rng.integers(0, 9)))), "en", str(rng.choice(["big", "big", "big", "mid", "tiny"]))) for i in range(80)]
    rows += [(90, None, "en", "big"), (91, "", "en", None), (92, "Menu\n" * 20_000 + "end", "en", "mid"), (93, "alone\nhere", "en", "single"), (94, "half\na", "en", "two"), (95, "half\nb", "en", "two"), (96, "half\nc", None, None), (None, "q\n\nMenu", "en", None)]
    rows += rows[:6]
    call = {{"least": "least_pages"}.get(k, k): v for k, v in rules.items()}
    found = lines.without_boilerplate(docs(spark, rows), F.col("source"), **call).select("row.doc_id", "host", "clean", "n_lines", "n_dropped").collect()
    want = [(r[0], r[3], *x) for r, x in zip(rows, brute_lines([(r[3], r[1]) for r in rows], **rules))]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert lines.without_boilerplate(docs(spark, []), F.col("source")).count() == 0


def test_credentials(spark):
    key, bare = "AKIA" + "Q7" * 8, "Ab1" * 13 + "x"
    filler = " word" * 200
    texts = [
        f"token = '{'s' * 6}' and Api_Key:short API_KEY=longer-1 paſſword=aaaaaa", f"{key} {key[:19]}", "f" * 24 + " " + "0" * 23, None, "",
        f"{key} then {bare} at https://db.example/x", f"{bare}", f"{key}{filler}{bare}", f"https://db.example/x {key}", "secret=token:abcdef password==abcdef", "ASIA" + "B" * 16 + " secret=abcdefg", "ASIA" + "B" * 16,
        "asiapacificregionalx secret=abcdefg", f"{'secret=' + 'ab' * 9 + ' '}{'x ' * 40_000}{key} {bare} https://a.example/q", "User_ID: abcdef-1 token=zyxwvu AROA" + "C" * 16, f"secret={bare} {key}",
    ]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(0, texts[0], None, None), (None, texts[5], None, None)]
    found = credentials.credentials(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    got = {r["doc_id"]: r for r in found}
    for i, t in enumerate(texts):
        t = t or ""
        want = [("assign", m) for m in re.finditer(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
        want += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [("hex", m) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert [(credentials.KINDS[s["kind"]], s["start"], s["end"]) for s in got[i]["base"]] == sorted(((k, *m.span()) for k, m in want), key=lambda s: (s[1], credentials.KINDS.index(s[0])))
    kinds = lambda i: [credentials.KINDS[s["kind"]] for s in got[i]["spans"]]
    assert kinds(5) == kinds(None) == ["access", "bare", "endpoint"]
    assert kinds(6) == [] and kinds(7) == ["access"] and kinds(8) == ["access"] and kinds(11) == []
    assert kinds(10) == ["identifier", "assign"] and kinds(12) == ["assign"] and kinds(13) == ["assign", "access", "bare", "endpoint"]
    assert kinds(14) == ["identifier", "assign", "identifier"] and kinds(15) == ["assign", "access"]
    assert credentials.credentials(docs(spark, [])).count() == 0


def test_linked_spans_equal_brute_force(spark):
    """All pairs of parts of a text, tested one by one."""
    rng = np.random.default_rng(15)
    parts = ["AKIA" + "R2" * 9, "ASIA" + "D4" * 8, "account-id=abc.def", "Zz9" * 14, "secret: hunter22", "https://x.example/a?b=1", "0123456789abcdef01234567", "word " * 30, "lorem " * 15]
    texts = [" ".join(rng.choice(parts, int(rng.integers(0, 14)))) for _ in range(60)]
    found = credentials.credentials(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]), scope=200).collect()
    assert any(s["kind"] > 2 for r in found for s in r["spans"])
    for r in found:
        text = texts[r["doc_id"]]
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        weak = [(k, *m.span()) for k, pattern in ((3, credentials._IDENTIFIER), (4, credentials._BARE), (5, credentials._ENDPOINT)) for m in pattern.finditer(text)]
        weak = [w for w in weak if not any(b[1] < w[2] and w[1] < b[2] for b in base)]
        near = lambda w, kinds: any(k in kinds and abs(a - w[1]) <= 200 for k, a, _ in base + weak)
        kept = [w for w in weak if (w[0] == 4 or near(w, (0, 2, 4))) and (w[0] == 3 or near(w, (1, 3)))]
        assert [(s["start"], s["kind"], s["end"]) for s in r["spans"]] == sorted((a, k, z) for k, a, z in base + kept)


def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        x = words(t)
        n = min(10, len(x))
        for a in range(len(x) - n + 1) if n else ():
            for at in range(len(w) - n + 1):
                if w[at : at + n] == x[a : a + n]:
                    hit.update(range(at, at + n))
                    ids.add(i)
    return len(w), len(hit), sorted(str(x) for x in ids if x is not None), bool(hit)


@pytest.mark.parametrize("pass_bytes", [1_000_000, 200])
def test_wu_manber_equals_brute_force(spark, pass_bytes):
    rng = np.random.default_rng(5)
    small = ["a", "b", "c", "ä1"]
    items = [(i, " ".join(rng.choice(small, int(n)))) for i, n in enumerate([0, 1, 3, 9, 10, 11, 14, 30, 30])] + [(7, "only this"), (None, "b B-b"), (11, None)]
    items[1] = (1, "zz")
    texts = [" , ".join(rng.choice(small, int(n))) for n in rng.integers(0, 300, 12)] + [None, "", "ZZ top", "x" * 100_000, items[8][1].upper().replace("Ä", "ä")]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None)]
    found = wumanber.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), pass_bytes=pass_bytes)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found.select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()}
    assert got == {r[0]: brute_hits(r[1], items) for r in rows}
    for r in found.select("hits", "n_hit").collect():
        assert all(a["last"] < b["first"] for a, b in zip(r["hits"], r["hits"][1:])) and sum(h["last"] - h["first"] for h in r["hits"]) == r["n_hit"]
    assert wumanber.contamination(docs(spark, []), spark.createDataFrame(items, "item_id long, text string"), pass_bytes=pass_bytes).count() == 0
    none = wumanber.contamination(docs(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == len(rows)


def test_wu_manber_cuts_long_items_and_takes_ids_of_text(spark, monkeypatch):
    monkeypatch.setattr(wumanber, "PIECE", 20)
    monkeypatch.setattr(wumanber, "SEGMENT", 7)
    rng = np.random.default_rng(6)
    items = [("q-1", prose(rng, 130)), ("q-2", prose(rng, 29)), ("q-10", prose(rng, 30)), ("q-3", "tiny")]
    texts = [f"{prose(rng, 200)} {' '.join(items[0][1].split()[a : a + n])} {prose(rng, 50)} {items[2][1]}" for a, n in ((0, 10), (15, 11), (19, 10), (20, 10), (100, 30), (5, 9))] + [items[0][1], items[1][1] + " Tiny"]
    table = spark.createDataFrame(items, "item_id string, text string")
    found = wumanber.contamination(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]), table).select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == {i: brute_hits(t, items) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n, universe", [(1, 5), (200, 201), (1000, 10**6), (3000, 2**60)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
    e = eliasfano.EliasFano(eliasfano.encode("x", x, universe), "x")
    asked = np.concatenate([x, rng.integers(0, universe, 500, dtype=np.uint64)])
    place = {int(v): i for i, v in enumerate(x)}
    assert e.find(asked).tolist() == [place.get(int(v), -1) for v in asked]
    assert e.at(np.arange(len(x))).tolist() == x.tolist()
    first, after = e.ranges(np.arange(len(x) - 1))
    assert first.tolist() == x[:-1].tolist() and after.tolist() == x[1:].tolist()


def test_elias_fano_file(tmp_path):
    arrays = eliasfano.encode("x", np.array([1, 5, 9]), 10) | {"y": np.array([1, 2, 3], np.uint8)}
    eliasfano.save(str(tmp_path / "f"), arrays)
    back = eliasfano.load(str(tmp_path / "f"))
    assert set(back) == set(arrays) and all((back[k] == arrays[k]).all() for k in arrays)
    assert eliasfano.EliasFano(back, "x").find(np.array([5, 6])).tolist() == [1, -1]


@pytest.mark.parametrize("hot", [1 << 20, 3])
def test_trie_scores_equal_brute_force(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(triemodel, "HOT", hot)
    monkeypatch.setattr(triemodel, "SHARD", 500)
    monkeypatch.setattr(triemodel, "HELD", 900)
    rows = [*corpus, (205, "Straße STRASSE\x1cé\u3000x \x0b\x0cÉ", "de", None), (206, corpus[3][1] + " " + corpus[4][1] + " unseenword", None, None), (207, "y" * 70_000 + " Y" + "y" * 69_999, None, None)]
    table = docs(spark, rows)
    train = [r for r in rows if r[0] is None or (zlib.crc32(str(r[0]).encode()) % 10 and r[0] != 206)]
    model = triemodel.fit(docs(spark, train))
    assert model["shards"] > 3 and (hot > 3 or (len(model["spread"][0]) and len(model["hot_pairs"][0])))
    got = triemodel.score(table, model).collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]
    c = collections.Counter(w for r in train for w in tokens(r[1]))
    start = lambda t: ["<s>", *tokens(t)]
    pairs = collections.Counter(p for r in train for p in zip(start(r[1]), tokens(r[1])))
    triples = collections.Counter(p for r in train for p in zip(start(r[1]), tokens(r[1]), tokens(r[1])[1:]))
    seen, kinds = collections.Counter(), collections.Counter()
    for (*context, _), n in [*pairs.items(), *triples.items()]:
        seen[tuple(context)] += n
        kinds[tuple(context)] += 1
    total, v = sum(c.values()), len(c)
    assert model["tokens"] == total and model["words"] == v
    down = lambda x, w, counts, lower: max(counts[*x, w] - 0.75, 0) / seen[x] + 0.75 * kinds[x] / seen[x] * lower if seen[x] else lower
    want = collections.defaultdict(list)
    for r in rows:
        t = tokens(r[1])
        p1 = [(c[w] + 0.1) / (total + 0.1 * (v + 1)) for w in t]
        p2 = [down((x,), w, pairs, p) for x, w, p in zip(["<s>", *t], t, p1)]
        p3 = [down((x, y), w, triples, p) if k else p for k, (x, y, w, p) in enumerate(zip([None, "<s>", *t], ["<s>", *t], t, p2))]
        want[r[0]].append((len(t), sum(c[w] > 0 for w in t), sum(map(math.log10, p1)), sum(map(math.log10, p3))))
    for r in got:
        n, known, base, full = want[r["doc_id"]][0]
        assert (r["n_tokens"], r["n_known"]) == (n, known) and r["base_score"] == pytest.approx(base)
        assert abs(r["score"] - full) <= 0.02 * n, (r, full)
    assert len(got) == len(rows)
    empty = triemodel.score(table, triemodel.fit(table.limit(0))).collect()
    assert len(empty) == len(rows) and all(r["n_known"] == 0 for r in empty)
    assert triemodel.score(table.limit(0), model).count() == 0


def test_language_needs_a_letter(spark):
    model = langid.fit(docs(spark, [(1, "abc", "en", None), (2, "½ ② ²", "fr", None)]))
    texts = {1: "½ ²", 2: "①", 3: "Ⅷ", 4: "12 _ !", 5: "½a", 6: "日", 7: "ª"}
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs(spark, [(i, t, None, None) for i, t in texts.items()]), model).select("row.doc_id", "lang_pred").collect()}
    assert {i for i, lang in got.items() if lang == "und"} == {1, 2, 3, 4}


@pytest.mark.parametrize("slab", [64, 2])
def test_language_id_equals_brute_force(spark, slab):
    rng = np.random.default_rng(2)
    parts = {"xx": ["ka", "ta", "ro", "mi"], "yy": ["schn", "ung", "ber", "ei"], "zz": ["çã", "õe", "lh", "nh"]}
    make = lambda p: " ".join("".join(rng.choice(p, 3)) for _ in range(30))
    rows = [(i, make(parts[lang]), lang, None) for i, lang in enumerate(list(parts) * 30)]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1] + [(900, None, "xx", None), (901, "text", None, None), (905, "", "zz", None)]
    model = langid.fit(docs(spark, train), slab=slab)
    assert [lang for langs, _ in model for lang in langs] == ["xx", "yy", "zz"] and len(model) == -(-3 // slab)
    odd = [(902, None, None, None), (903, "12 34 _ !", None, None), (904, "", None, None), (None, rows[1][1], None, None), (906, rows[0][1] * 300, None, None), (906, "kata schnung", None, None), (907, "q", None, None)]
    found = langid.predict(docs(spark, rows + odd), model).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    assert len(found) == len(rows + odd)
    # The textbook sum over dictionaries of n-grams.
    counts, priors = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t, lang, _ in train:
        if t is not None and lang is not None:
            counts[lang].update(langid.features(t).tolist())
            priors[lang] += 1
    for r in found:
        if r["text"] is None or not re.search(r"[^\W\d_]", r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        grams = collections.Counter(langid.features(r["text"]).tolist())
        logs = {lang: math.log(priors[lang]) + sum(n * math.log((counts[lang][g] + 0.5) / (counts[lang].total() + 0.5 * 65536)) for g, n in grams.items()) for lang in sorted(priors)}
        best = max(logs, key=logs.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), rel=1e-3)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    got = {r["doc_id"]: r["lang_pred"] for r in found}
    assert sum(got[r[0]] == r[2] for r in held) >= 0.98 * len(held)
    nothing = langid.predict(docs(spark, rows), langid.fit(docs(spark, []))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and langid.predict(docs(spark, []), model).count() == 0


def brute_kneser_ney(texts, alphabet):
    """Probability of each 4-gram code, by the textbook recursion over dictionaries."""
    counts = {4: collections.Counter(c for t in texts for c in kneserney.codes(kneserney.symbols(t, alphabet)).tolist())}
    for k in (3, 2, 1):
        counts[k] = collections.Counter(c & (64**k - 1) for c in counts[k + 1])
    off, total, left = {}, {}, {}
    for k in counts:
        n = [sum(v == i for v in counts[k].values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else None
        d = [0.5] * 3 if y is None else [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else 0.5 for i in (1, 2, 3)]
        off[k] = lambda c, d=d: d[min(c, 3) - 1]
        total[k], left[k] = collections.Counter(), collections.Counter()
        for code, c in counts[k].items():
            total[k][code >> 6] += c
            left[k][code >> 6] += off[k](c)

    def p(k, code):
        if k == 0:
            return 1 / 64
        code &= 64**k - 1
        t, lower = total[k][code >> 6], p(k - 1, code)
        if not t:
            return lower
        c = counts[k][code]
        return (c - off[k](c) if c else 0) / t + left[k][code >> 6] / t * lower

    return p


def test_kneser_ney_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    good = [prose(rng, 40, ["alpha", "beta", "gamma", "delta."]) for _ in range(30)]
    table = docs(spark, [(i, t, "en", None) for i, t in enumerate(good)])
    model = kneserney.fit(table)
    alphabet = kneserney._alphabet(model["chars"])
    p, dense = brute_kneser_ney(good, alphabet), kneserney.unfolded(model)
    seen = kneserney.codes(kneserney.symbols(good[0] + "zzz alphabet" + good[1], alphabet))
    for code in [*seen.tolist(), *rng.integers(0, 64**4, 300).tolist()]:
        assert dense[code] == pytest.approx(math.log(p(4, code)) - math.log(model["sharing"][code & 63]), abs=1e-3)
    rows = np.exp(dense.reshape(-1, 64).astype(float)) * model["sharing"]
    assert np.allclose(rows.sum(axis=1), 1, atol=1e-3)


def test_kneser_ney_keeps_the_letters_of_any_script_apart(spark):
    """With most text in one script, shuffled letters of another one are still far less likely than its words."""
    rng = np.random.default_rng(14)
    latin = [prose(rng, 60, ["alpha", "Beta", "gamma.", "DELTA", "omega,", "QXZ", "jkvwy", "fuchs", "Prim"]) for _ in range(60)]
    greek = [prose(rng, 40, ["λόγος", "φως", "θάλασσα", "ψυχή", "άνθρωπος", "χρόνος"]) for _ in range(10)]
    shuffled = [" ".join("".join(rng.permutation(list(w))) for w in t.split()) for t in greek]
    table = docs(spark, [(i, t, "la", None) for i, t in enumerate(latin)] + [(100 + i, t, "el", None) for i, t in enumerate(greek)])
    model = kneserney.fit(table)
    losses = [r["loss"] / r["n_symbols"] for r in kneserney.perplexities(docs(spark, [(i, t, "el", None) for i, t in enumerate(greek + shuffled)]), model).collect()]
    assert min(losses[10:]) > 1.3 * max(losses[:10])


def test_quality_keeps_clean_and_drops_junk(spark):
    rng = np.random.default_rng(6)
    clean = [prose(rng, 60, ["alpha", "beta", "gamma", "delta.", "omega"]) for _ in range(60)]
    junk = [prose(rng, 60, ["$$#%", "QX9", "|||", "zzkq"]) for _ in range(10)]
    rows = [(i, t, "en", None) for i, t in enumerate(clean)] + [(100 + i, t, "en" if i % 2 else None, None) for i, t in enumerate(junk)]
    rows += [(200, None, "en", None), (201, "", None, None), (None, clean[0], "fr", None), (202, " ".join(clean) * 50, "en", None), (3, clean[3], "en", None)]
    table = docs(spark, rows)
    trusted = table.where("doc_id < 40")
    found = kneserney.judged(table, trusted).select("row.doc_id", "row.text", "accepted", "perplexity", "threshold", "slack", "n_symbols").collect()
    got = {r["doc_id"]: r["accepted"] for r in found}
    # About 20 documents set the threshold: one of 20 others lies beyond it by chance.
    assert len(found) == len(rows) and sum(got[i] for i in range(60)) >= 54 and got[202]
    assert not any(got[100 + i] for i in range(10)) and not got[200] and not got[201]
    # The perplexity is the document's own, and the decision follows from the two numbers that are shown.
    ids = [r["doc_id"] for r in trusted.select("doc_id").distinct().collect()]
    chosen = {r["doc_id"] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(kneserney.TRAINED * (1 << 30))).collect()}
    model = kneserney.fit(table.where(F.col("doc_id").isin(*chosen)))
    alphabet, dense = kneserney._alphabet(model["chars"]), kneserney.unfolded(model)
    own = lambda t: -dense[kneserney.codes(kneserney.symbols(t, alphabet))].astype(float).sum() / len(t)
    for r in found:
        if r["text"]:
            assert math.log(r["perplexity"]) == pytest.approx(own(r["text"]), abs=1e-4) and r["accepted"] == (math.log(r["perplexity"]) <= math.log(r["threshold"]) + 1e-12)
    held = [own(r["text"]) for r in found if r["doc_id"] in set(ids) - chosen]
    limit = sorted(math.ceil(v / kneserney.STEP) for v in held)[math.ceil(len(held) * kneserney.QUANTILE - 1e-6) - 1] * kneserney.STEP
    assert all(math.log(r["threshold"]) == pytest.approx(limit, abs=2e-4) for r in found)
    untrained = kneserney.judged(table, table.limit(0)).select("accepted", "row.text").collect()
    assert all(r["accepted"] == bool(r["text"]) for r in untrained)


def test_quantiles(spark):
    rng = np.random.default_rng(8)
    x, y = rng.random(500), rng.random(3) / 10
    frame = spark.createDataFrame([("a", float(v)) for v in x] + [(None, float(v)) for v in y], "lang string, value double")
    rows = kneserney.quantiles(frame, 0.9).collect()
    got = {r["lang"]: r["limit"] for r in rows}
    assert next(r["error"] for r in rows if r["lang"] == "a") == pytest.approx(np.std(x) / math.sqrt(500), rel=1e-2)
    for lang, own in (("a", x), (None, y)):
        exact = sorted(own)[math.ceil(0.9 * len(own) - 1e-6) - 1]
        assert exact <= got[lang] + 1e-12 and got[lang] - exact <= kneserney.STEP
