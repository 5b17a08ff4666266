"""Fill-in-middle, line deduplication and phrase mining against brute force, and
their defined cases (nulls, blanks, very long texts, ties, repeats, empty tables,
clashing column names)."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import collocations, fim, line_dedup


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill in middle -----------------------------------------------------------------

def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text)


def plain_fim(doc_id, text):
    text, h = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    u = units(text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block, window", [(1, 4), (3, 6), (4, 8), (64, 64 * 4)])
def test_block_tree_finds_every_unit(block, window):
    text = "abc, dé𝄞f\n  Zz" + "q" * 70 + "éé" * 9 + "<P" + "x y " * 11
    tree = fim.BlockTree(np.frombuffer(text.encode(), np.uint8), block, window)
    u = units(text)
    assert (tree.n_units, tree.n_points) == (len(u), len(text))
    assert [tree.code_points_before(k) for k in range(len(u) + 2)] == [
        len("".join(u[:k])) for k in range(len(u) + 1)] + [len(text)]


def test_fill_in_middle(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["a", "bc", " ", "é", "𝄞", "<", "P>", "S", ">", "\n", "M"]) for _ in range(rng.randrange(60))))
            for i in range(300)]
    rows += [(300, None), (301, ""), (302, "<M>"), (303, "word " * 60000 + "end"), (304, "x" * 50000), (None, "null id"),
             (7, "same id"), (7, "same id"), (305, "<"), (306, "\x00\r\n")]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, n long, h1 long, output string")
    out = fim.fill_in_middle(df, block=16).withColumn("back", fim.restored())
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())
    assert got == collections.Counter((i, *plain_fim(i, t)) for i, t in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in out.collect()) == sorted(t or "" for _, t in rows)
    assert fim.fill_in_middle(df.where("false")).count() == 0


# -- line deduplication ----------------------------------------------------------------

def plain_lines(rows):
    upper = {c: c + 32 for c in range(65, 91)}
    key = [[x.strip(" \t\n\x0b\x0c\r").translate(upper) for x in (t or "").split("\n")] for _, t in rows]
    order = lambda i: (i is None, i or 0)
    first = {}
    for (i, _), keys in zip(rows, key):
        for k in keys:
            if len(k) >= 10 and (k not in first or order(i) < order(first[k])):
                first[k] = i
    return [(i, [x for x, k in zip((t or "").split("\n"), keys) if len(k) < 10 or first[k] == i])
            for (i, t), keys in zip(rows, key)]


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(5)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["short", "", "ÄÖÜ Große Zeile", "äÖÜ große zeile", "  Line Number 3 of the POOL\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for i in rng.sample(range(1000), 60)]
    rows += [(2000 + i, "the one very common line\n" * rng.randrange(1, 4) + f"own line of {i}") for i in range(150)]
    rows += [(5000, None), (5001, ""), (5002, "\n\n"), (5003, "only line of its own"), (None, "line number 1 of the pool\nno id here at all"),
             (None, "no id here at all\nanother line"), (5004, "twice in one\ntwice in one"), (5005, "repeated row line\nthe one very common line"),
             (5005, "repeated row line\nthe one very common line"), (5006, "same id, other text\nx"), (5006, "y\nsame id, other text\nrepeated row line"),
             (1500, "\n".join(f"long text line {i % 300}" for i in range(5000))), (1501, "\n".join(f"long text line {i}" for i in range(250, 900)))]
    return rows


@pytest.mark.parametrize("group", [4, 100000])
def test_line_dedup(spark, line_rows, group):
    df = spark.createDataFrame([(*r, 1, "k", 3) for r in line_rows], "doc_id long, text string, pos long, key string, keep int").repartition(5)
    want = plain_lines(line_rows)
    got = line_dedup.with_bitmaps(df, group=group).select(
        "doc_id", "text", "key", line_dedup.n_dropped("__keep").alias("n"),
        line_dedup.kept_text(F.col("text"), "__keep").alias("kept")).collect()
    assert collections.Counter((r.doc_id, r.kept, r.n) for r in got) == collections.Counter(
        (i, "\n".join(lines), len((t or "").split("\n")) - len(lines)) for (i, t), (_, lines) in zip(line_rows, want))
    cut = line_dedup.drop_repeated_lines(df, group=group)
    assert cut.columns == df.columns and cut.where("doc_id = 5000 and text is null").count() == 1
    maps = line_dedup.keep_bitmaps(df, group=group)
    assert maps.where("doc = 1500").count() == 0 and maps.where("doc = 1501").selectExpr("size(keep)").first()[0] == 1


def test_line_dedup_empty_and_plan(spark, line_rows):
    df = spark.createDataFrame(line_rows, "doc_id long, text string")
    assert line_dedup.keep_bitmaps(df.where("false")).count() == 0
    plan = line_dedup.op12_line_dedup.__globals__["keep_bitmaps"](df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_keys_are_dealt_out(spark):
    lines = spark.range(5000).selectExpr("if(id % 2 = 0, 'hot', cast(id as string)) as h")
    assert [(r.hot_h, r.ranges) for r in line_dedup.hot_keys(lines, group=100).collect()] == [("hot", 25)]


# -- phrases -------------------------------------------------------------------------

def plain_phrases(rows, support, top, inside=80):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    upper = {c: c + 32 for c in range(65, 91)}
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(upper)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= support}
        best = []
        for p, a in often.items():
            if len(p) == 1 or any(100 * b >= inside * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                                  for q, b in often.items()):
                continue
            score, _, left, right = min((2000000 * a // (often[p[:k]] + often[p[k:]]), k, often[p[:k]], often[p[k:]])
                                        for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(8)
    words = ["the", "of", "New", "york", "city", "san", "é", "zürich", "a", "b", "c", "d"]
    def text():
        out = []
        for _ in range(rng.randrange(1, 40)):
            out.append(rng.choice(["new york city hall", "San  Francisco", "a b c d", "É é"]) if rng.random() < .4 else rng.choice(words))
            out.append(rng.choice([" ", " ", "\t", ", ", ".", "\n", "? "]))
        return "".join(out)
    rows = [(i, text(), rng.choice(["en", "en", "de", None, "und"])) for i in range(200)]
    rows += [(1, None, "en"), (2, "", "xx"), (3, " .,; ", None), (4, "same row twice new york", "en"), (4, "same row twice new york", "en"),
             (5, "ha " * 4000, "en"), (6, "x" * 3000 + " tail", "de"), (None, "a b c d, a b c d", "fr"), (7, "only two words here" * 3, "nl")]
    return rows


@pytest.mark.parametrize("share, lower, bits, block", [(4, 0.6, 1 << 20, 1 << 20), (1, 1.0, 1 << 20, 150), (100000, 1.0, 1 << 20, 40),
                                                       (4, 0.6, 64, 1000)])
def test_collocations_against_brute_force(spark, phrase_rows, share, lower, bits, block):
    """Whatever the sample proposes (a quarter, everything, nothing) and the filter
    lets through, and wherever texts are cut."""
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in phrase_rows], "doc_id long, text string, lang string, n long, words int, phrase string")
    got = collocations.collocations(df.repartition(4), support=12, top=25, share=share, lower=lower, gate_bits=bits, block=block)
    assert {tuple(r) for r in got.collect()} == plain_phrases(phrase_rows, 12, 25)


def test_collocations_of_nothing(spark, phrase_rows):
    df = spark.createDataFrame(phrase_rows, "doc_id long, text string, lang string")
    assert collocations.collocations(df.where("false")).count() == 0
    assert collocations.collocations(df.where("text is null or text = ''")).count() == 0


def test_scores_beyond_64_bits(spark):
    a = 8 * 10 ** 15
    exact = spark.sql(f"select cast({a}L as decimal(20,0)) * cast({collocations.SCALE} as decimal(8,0)) "
                      f"div (cast({a + 1}L as decimal(20,0)) + {a}L) as s").first().s
    assert exact == 2000000 * a // (2 * a + 1)


def test_segments_cover_the_text():
    text = b"one two three, four five six seven eight nine ten eleven twelve " * 5 + b"y" * 90 + b" z"
    for limit in (1, 7, 30, 64, 1000):
        parts = list(collocations.segments(text, limit))
        assert b"".join(p[:own] for p, own in parts) == text
