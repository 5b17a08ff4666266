"""Small-table tests of the training-data operators: brute force, round trips,
and the defined cases (nulls, blanks, long texts, ties, repeats, empty tables,
clashing column names)."""

import collections
import hashlib
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from webloom.llm import ann, bpe, chat, exact_dedup, langid, lm, mixing, simhash, urlfilter, warc
from webloom.llm.common import connected_components, word_blocks

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id int, h string"
EN = "the cat and the dog went to the house with a small bird and they were happy that day "
DE = "der hund und die katze gingen in das haus mit einem kleinen vogel und sie waren gluecklich "


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, EN * 3, "en", "a"), (2, EN * 3, "en", "a"), (3, (EN * 3).replace(" ", "  \n"), "en", None),
            (4, DE * 3, "de", "b"), (5, None, None, "b"), (6, "", "en", "b"), (7, " \t\n", None, None),
            (8, "one", "en", "a"), (9, EN * 20000 + "x", "en", "c"), (10, EN * 2, "en", "a"), (10, EN * 2, "en", "a"),
            (None, DE, "de", "b"), (11, "12 34 !!", "en", "c"), (12, DE + " ende", "de", "é")]
    return spark.createDataFrame([(*r, 1, 2, "z") for r in rows], DOCS)


def empty(docs):
    return docs.where("false")


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_word_blocks_keep_every_word():
    data = b"  a bb\x0bccc " * 50 + b"x" * 300
    assert [w for b in word_blocks(data, 16) for w in b] == data.split()


def test_simhash_against_brute_force(spark, docs):
    rows = [r for r in docs.collect() if not r.doc_id == 9]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_groups(docs.where("doc_id <> 9 or doc_id is null")).collect()}
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    label = list(range(len(fps)))
    for i, (_, a) in enumerate(fps):
        for j, (_, b) in enumerate(fps):
            if bin(a ^ b).count("1") <= 2:
                old, new = label[j], label[i]
                label = [new if x == old else x for x in label]
    low = {x: min((d for (d, _), y in zip(fps, label) if x == y and d is not None), default=None) for x in label}
    assert got == {(d, f"{f:016x}"): low[x] for (d, f), x in zip(fps, label)}
    assert simhash.simhash_groups(empty(docs)).count() == 0
    assert simhash.drop_near_duplicates(docs).columns == docs.columns


@pytest.mark.parametrize("n", [3, 700, 4000])
def test_tree_finds_every_link(spark, n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 63, n).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, n).astype(np.uint64))
    x = np.unique(np.concatenate([base, near, base[0] ^ (np.uint64(1) << np.arange(40, dtype=np.uint64))]))
    u, v = [], []
    for at in range(0, len(x), 256):
        i, j = np.nonzero(np.bitwise_count(x[at:at + 256, None] ^ x[None]) <= 2)
        u.append(i + at)
        v.append(j)
    want = simhash._roots(len(x), np.concatenate(u), np.concatenate(v))
    moved, root = simhash.link_shard(x)
    got = np.arange(len(x))
    got[moved] = root
    assert (got == want).all()
    nodes = simhash.fit_tree(x[: 2000], max(1, len(x) // 64))
    shard, at = simhash.route(x, nodes)
    assert set(at) == set(range(len(x)))
    us, vs = [], []
    for s in np.unique(shard):
        own = at[shard == s]
        m, r = simhash.link_shard(x[own])
        us.append(own[m])
        vs.append(own[r])
    assert (simhash._roots(len(x), np.concatenate(us), np.concatenate(vs)) == want).all()


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 100), (7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 31)}, 101: 100, 102: 100}


def norm(text):
    return b" ".join((b"\x01" + (text or "").encode() + b"\x01").split())[1:-1]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, docs, weak):
    hashed = (lambda c: F.octet_length(c).cast("string")) if weak else F.md5
    got = exact_dedup.exact_groups(docs, content_hash=hashed).collect()
    group = collections.defaultdict(list)
    for r in docs.collect():
        group[norm(r.text)].append(r.doc_id)
    by_sha = {hashlib.sha256(k).hexdigest(): v for k, v in group.items()}
    assert len(got) == docs.count()
    for r in got:
        own = by_sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (min((x for x in own if x is not None), default=None), len(own))
    assert sum(r.kept for r in got) == len(group)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted(group)
    assert exact_dedup.drop_exact_copies(empty(docs)).count() == 0


def test_language(spark, docs):
    learned = langid.fit_dictionaries(docs)
    assert set(learned) == {"en", "de"} and all(len(v) <= langid.DICT_BYTES for v in learned.values())
    rows = docs.select("doc_id", "text", langid.language(F.col("text"), learned).alias("p")).collect()
    for r in rows:
        assert 0 <= r.p.score <= 1
        if not r.text or r.doc_id in (7, 11):
            assert r.p.lang_pred == "und" and r.p.rejected
        elif r.text[:20] in (EN[:20], DE[:20]):
            assert r.p.lang_pred == ("en" if r.text.startswith("the") else "de")
    assert langid.fit_dictionaries(empty(docs)) == {}
    assert langid.keep_identified(docs, empty(docs)).count() == 0
    assert langid.keep_identified(docs, docs).columns == docs.columns


def test_held_out_accuracy(spark):
    got = langid.op2_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("i"), "lang")
    row = got.where("held_out").join(docs, F.col("doc_id") == F.col("i")).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert row[0] >= 0.95 and row[1] <= 0.02


def test_warc_round_trip(spark, tmp_path):
    big = "x\r\n\r\nWARC/1.1 é" * 300
    rows = [(5, "http://a/1", big), (3, "http://a/ 2", big), (9, None, "short"), (8, "u", "short"), (7, "u", None), (None, "u", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(1)
    chunks = warc.record_chunks(pages, chunk=64)
    manifest = warc.write_archives(chunks, f"file://{tmp_path}/w", file_bytes=500)
    assert manifest.agg(F.sum("records")).first()[0] == 6 and manifest.count() > 1
    read = warc.read_archives(manifest, f"file://{tmp_path}/w", chunk=100)
    last = {r.record_id: r for r in read.where("is_last").collect()}
    sha = hashlib.sha256(big.encode()).hexdigest()
    assert [(last[i].record_type, last[i].refers_to, last[i].digest, last[i].payload_bytes) for i in ("3", "5", None)] == [
        ("response", None, sha, len(big.encode()))] + [("revisit", "3", sha, len(big.encode()))] * 2
    assert last["9"].record_type == last["8"].record_type == "response" and last["7"].payload_bytes == 0
    body = collections.defaultdict(bytes)
    for r in warc.resolve_revisits(read).orderBy("record_id", "chunk_no").collect():
        body[r.record_id] += bytes(r.data)
    assert body["3"] == body["5"] == big.encode() and body["9"] == b"short" and body["7"] == b""
    none = warc.write_archives(warc.record_chunks(pages.where("false")), f"file://{tmp_path}/e")
    assert warc.read_archives(none, f"file://{tmp_path}/e").count() == 0


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(size.values()), {s: 0.0 for s in order}, set(order)
    while True:
        left = total - sum(target[s] for s in order if s not in free)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        target |= share if not over else {s: 2.0 * size[s] for s in over}
        if not over:
            break
        free -= over
    return target


def test_mixing_targets_and_sums(spark, docs):
    got = mixing.mix(docs).collect()
    size = collections.defaultdict(int)
    for r in docs.collect():
        size[r.source] += len((r.text or "").encode().split())
    target = plain_targets(size)
    taken = collections.defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    assert len(got) == docs.count()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    assert mixing.mix(empty(docs)).count() == 0 and mixing.mixed(docs).columns == docs.columns


def test_subset_sum_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.choice(np.arange(1, 30), rng.integers(1, 6), replace=False).tolist()
        counts = rng.integers(1, 4, len(sizes)).tolist()
        want = int(rng.integers(0, 60))
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {x + s * k for x in sums for k in range(c + 1)}
        take = mixing.nearest_sum(sizes, counts, want)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        assert abs(sum(s * t for s, t in zip(sizes, take)) - want) == min(abs(x - want) for x in sums)
    sizes, counts = np.arange(1, 2000), np.full(1999, 40)
    k = mixing.fit_counts(sizes, counts, 31_234_567.4)
    assert (sizes * k).sum() == 31_234_567 and (k <= counts).all() and k.min() >= 14


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 12)).astype(np.float32) * rng.uniform(0.5, 2, (900, 1)).astype(np.float32)
    x[300:600] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (2000, None), (2001, [0.0] * 12),
                                                         (2002, [float("nan")] * 12), (2020, [1.0, None] + [0.0] * 10), (2040, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    d, hits = x.astype(np.float64), 0
    for q, near in got.items():
        s = d @ d[q]
        want = [i for i in np.lexsort((np.arange(900), -np.round(s, 12))) if i != q][:20]
        assert len(near) == 20 and all(math.isclose(a, s[i], abs_tol=1e-9) for i, a in near)
        hits += len({i for i, _ in near} & set(want))
    assert hits / (20 * len(got)) >= 0.9
    few = ann.nearest_neighbours(df.where("vec_id in (0, 5, 9)"), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r["rank"])] == sorted((5, 9), key=lambda i: -(d[0] @ d[i]))
    assert ann.nearest_neighbours(df.where("false"), F.lit(True)).count() == 0


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "", None, "a\\b", "\\\\", "<s>", "x [/INST]</s><s>", "\n", "[INST] y [/INST]", "</s", "é" * 9]
    roles = ["user", "assistant", None, "a\nb\\", "[INST]"]
    rows = [(c, t, roles[(c + t) % 5], said[(c * 3 + t) % 11], 1) for c in range(11) for t in range(7)] + [(None, None, "user", "z", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted int")
    done = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.read_back(done).collect()}
    spans = {r.conv_id: r for r in done.collect()}
    for c in [*range(11), None]:
        want = [(r or "", t or "") for i, _, r, t, _ in rows if i == c]
        assert [(t.role, t.text) for t in got[c].turns] == want
        raw = [spans[c].formatted[s.start:s.end] for s in spans[c].loss_spans]
        assert len(raw) == sum(r == "assistant" for r, _ in want) and "</s>" not in "".join(raw)
        assert spans[c].formatted.count("</s>") == len(want)
    assert chat.format_conversations(df.where("false")).count() == 0


def test_url_filter(spark):
    day = "2024-0"
    entries = [("l", False, "host", "a.b.com", day + "1-10", True), ("l", False, "host", "a.b.com", day + "3-01", False),
               ("l", False, "host", "a.b.com", day + "5-01", True), ("l", False, "host", "a.b.com", day + "5-01", False),
               ("d", False, "domain", "com", day + "2-01", True), ("x", True, "prefix", "a.b.com/ok/y", day + "1-01", True),
               (None, False, "host", "z", day + "1-01", True)]
    e = spark.createDataFrame(entries, "list string, allow boolean, kind string, value string, d string, added boolean").select(
        "list", "allow", "kind", "value", F.to_date("d").alias("listed_on"), "added")
    caps = [(1, "http://u@A.b.com:80/q", "2024-01-09"), (2, "http://a.b.com/q", "2024-01-10"), (3, "http://a.b.com", "2024-03-01"),
            (4, "http://a.b.com/ok/y/z?q", "2024-05-02"), (5, None, "2024-05-02"), (6, "http://a.b.com/", None), (7, "http://z/", "2024-05-02"),
            (8, "http://a.b.com/ok/yy", "2025-01-01"), (8, "http://a.b.com/ok/yy", "2025-01-01")]
    c = spark.createDataFrame([(*x, 1) for x in caps], "page_id long, url string, t string, list int").select(
        "page_id", "url", F.to_timestamp("t").alias("fetched_at"), "list")
    got = sorted((r.page_id, r.blocked, r.n_active, r["list"]) for r in urlfilter.filter_captures(c, e).collect() if r["list"])
    assert got == [(2, True, 1, "l"), (3, True, 1, "d"), (4, False, 3, "x"), (8, True, 2, "l"), (8, True, 2, "l")]
    assert urlfilter.filter_captures(c, e.where("false")).where("blocked").count() == 0
    assert urlfilter.filter_captures(c.where("false"), e).count() == 0


def test_bpe_against_reference_encoder(spark, docs):
    import public_tokenizers as public
    import tiktoken
    model, pattern = bpe.public_model()
    plain = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                              mergeable_ranks=bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")))
    odd = ["<|endoftext|>  a\n\n b", "中文\U0001f600 'll\xa0 x", "it's  \t", "\x00\x1c", "a" * 5000, " " * 50 + "b"]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 100)), "doc_id long, text string"))
    done = bpe.encode(df, model, pattern, offsets=True, decoded=True)
    texts = collections.Counter((r.doc_id, r.text or "") for r in df.collect())
    for r in done.withColumn("ids", bpe.unpack(F.col("tokens"))).where("doc_id is null or doc_id <> 9").collect():
        text = bytes(r.decoded).decode()
        assert texts[(r.doc_id, text)] and r.ids == plain.encode_ordinary(text)
        if r.ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(text) and all(a < b for a, b in zip(r.starts, r.ends))
    codec = bpe.Codec(model, pattern)
    packed = codec.encode("\U0001f600é ok")
    assert codec.text([packed[i:i + 4] for i in range(0, len(packed), 4)]) == "\U0001f600é ok"
    back = {r.doc_id: r.text for r in bpe.decode(done, model, pattern).collect()}
    assert back[100] == odd[0] and back[5] == ""
    assert bpe.encode(empty(docs), model, pattern).count() == 0


def test_lm_base_and_distribution(spark, docs):
    out = F.coalesce(F.col("doc_id") == 12, F.lit(False))
    got = lm.score(docs, out, keep=14).collect()
    rows = [(r.doc_id, (r.text or "").lower().encode().split() + [None]) for r in docs.collect()]
    c = collections.Counter(t for i, ts in rows if i != 12 for t in ts)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(ts), sum(c[t] > 0 for t in ts)) for i, ts in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known) for r in got) == want
    base = {str(i): sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts) for i, ts in rows}
    assert all(r.train_tokens == n and math.isclose(r.base_score, base[str(r.doc_id)], rel_tol=1e-9) for r in got)
    train = docs.where(~out).select("text")
    model = lm.fit(train, lm.count_words(train), keep=14)
    assert model.levels[0].kept.any()
    # in every state the symbols' probabilities, with what unknown words get, add up to one
    everything = np.arange(model.symbols)
    root = model.root(model.count)
    rest = 1 - root.sum()
    for s in np.flatnonzero(model.levels[0].kept):
        p = model.chance(0, np.full(model.symbols, s), everything, root)
        none = model.levels[0].rest[s] * rest / (model.levels[0].total[s] + lm.STRENGTH)
        assert math.isclose(p.sum() + none, 1, rel_tol=1e-9)
    assert lm.score(empty(docs), out).count() == 0


def plain_tree_score(train, often):
    """A function that scores tokens (None ends a text) by the suffix tree, from plain counts."""
    c = collections.Counter(t for ts in train for t in ts)
    n, v = sum(c.values()), len(c)
    symbols = {t for t in c if t is None or c[t] >= often}
    pairs = collections.Counter((a, x) for ts in train for a, x in zip(ts, ts[1:]) if a in symbols and x in symbols)
    pairs = {k: m for k, m in pairs.items() if m >= often}
    threes = collections.Counter((a, b, x) for ts in train for a, b, x in zip(ts, ts[1:], ts[2:])
                                 if (a, b) in pairs and (b, x) in pairs)
    counts = pairs | {k: m for k, m in threes.items() if m >= often}
    total = {(a,): c[a] for a in c} | pairs
    after = collections.defaultdict(dict)
    for k, m in counts.items():
        after[k[:-1]][k[-1]] = m
    retained = set()

    def chance(context, x):
        if not context:
            return (c[x] + 1) / (n + v + 1)
        shorter = chance(context[1:], x)
        if context not in retained:
            return shorter
        rest = total[context] - sum(after[context].values()) + lm.STRENGTH
        return (after[context].get(x, 0) + rest * shorter) / (total[context] + lm.STRENGTH)

    for context in sorted(after, key=len):
        shorter = {x: chance(context[1:], x) for x in after[context]}
        gain = sum(m * math.log(m / total[context] / shorter[x]) for x, m in after[context].items())
        rest = total[context] - sum(after[context].values())
        gain += rest * math.log(rest / total[context] / max(1 - sum(shorter.values()), 1e-12)) if rest else 0
        if gain > 0.5 * len(shorter) * math.log(n):
            retained.add(context)
    return lambda ts: sum(math.log10(chance(tuple(ts[max(0, i - 2):i]), t)) for i, t in enumerate(ts)), retained


def test_lm_score_against_brute_force(spark, docs):
    rows = [(r.doc_id, (r.text or "").lower().encode().split() + [None])
            for r in docs.where("doc_id is null or doc_id <> 9").collect()]
    rows += [(20 + i, [*w.split(), None]) for i, w in enumerate([b"the cat and zzz", b"the dog went", b"in das haus die katze q"])]
    df = spark.createDataFrame([(i, b" ".join(ts[:-1]).decode()) for i, ts in rows], "doc_id long, text string")
    out = F.coalesce(F.col("doc_id") >= 20, F.lit(False))
    train = [ts for i, ts in rows if i is None or i < 20]
    scored, retained = plain_tree_score(train, lm.least(sum(map(len, train))))
    assert {len(x) for x in retained} == {1, 2}
    got = lm.score(df, out).collect()
    assert len(got) == len(rows)
    want = collections.defaultdict(list)
    for i, ts in rows:
        want[i].append(scored(ts))
    for r in got:
        assert any(math.isclose(r.score, w, rel_tol=1e-9) for w in want[r.doc_id]), r
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_lm_tree_grows_with_the_corpus():
    sizes = [10 ** e for e in range(4, 15, 2)]
    bounds = [n / lm.least(n) for n in sizes]
    assert all(2 * a < b for a, b in zip(bounds, bounds[1:]))
    assert all(b <= max(n / 2, lm.KEEP * n ** (1 / 3)) for n, b in zip(sizes, bounds))


def test_lm_long_texts_pass_in_blocks(monkeypatch):
    texts = [b"a b c d e f g", b"", b"h i j"]
    whole = [(p.at.tolist(), p.row.tolist()) for p in lm.portions(iter(texts))]
    monkeypatch.setattr(lm, "PORTION", 4)
    words, rows = [], []
    for p in lm.portions(iter(texts)):
        words += [p.words[int(i)].as_py() if i >= 0 else None for i in p.at[p.old:]]
        rows += p.row[p.old:].tolist()
    assert words == [*"abcdefg", None, None, *"hij", None] and rows == whole[0][1]


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    import public_tokenizers as public
    import tiktoken
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    speaker = langid.Classifier(langid.fit_dictionaries(table.where(~langid.held_out())))
    rows = [r for r in table.orderBy("doc_id").collect() if not speaker.predict(r.text)[2]]
    rows = list({norm(r.text): r for r in reversed(rows)}.values())
    rows.sort(key=lambda r: r.doc_id)
    fps = [plain_fingerprint(r.text) for r in rows]
    label = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    got = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id].append(r)
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        words = len(r.text.encode().split())
        size[r.source] += words
        taken[r.source] += words * len(got[r.doc_id])
        assert len(got[r.doc_id]) <= 2
    target = plain_targets(size)
    for source, want in target.items():
        assert abs(taken[source] - want) <= max(0.01 * want, 0.5), source
    plain = tiktoken.Encoding("own", pat_str=public.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")))
    by_id = {r.doc_id: r for r in rows}
    for doc_id, copies in got.items():
        for r in copies:
            ids = plain.encode_ordinary(by_id[doc_id].text)
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(by_id[doc_id].text.encode()).hexdigest()


def test_pipeline_keeps_one_of_each(spark, docs, tmp_path):
    import corpus_pipeline
    now = docs.drop("component_id", "h")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert len(corpus_pipeline.STAGES) == 5
    docs.drop("component_id", "h").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, 4, 8, 9, 10, 12, None} and got


def plain_deep_score(train, often):
    """As plain_tree_score, with contexts of any length."""
    c = collections.Counter(t for ts in train for t in ts)
    n, v = sum(c.values()), len(c)
    kept = {(t,): m for t, m in c.items() if t is None or m >= often}
    retained, depth = {}, 0

    def chance(context, x):
        p = (c[x] + 1) / (n + v + 1)
        for d in range(1, len(context) + 1):
            if (state := retained.get(context[len(context) - d:])) is not None:
                after, total, rest = state
                p = (after.get(x, 0) + rest * p) / (total + lm.STRENGTH)
        return p

    while True:
        depth += 1
        grams = collections.Counter(
            g for ts in train for g in zip(*[ts[i:] for i in range(depth + 1)]) if g[:-1] in kept and g[1:] in kept)
        grams = {g: m for g, m in grams.items() if m >= often}
        after = collections.defaultdict(dict)
        for g, m in grams.items():
            after[g[:-1]][g[-1]] = m
        new = {}
        for context, own in after.items():
            total, near = kept[context], {x: chance(context[1:], x) for x in own}
            rest = total - sum(own.values())
            gain = sum(m * math.log(m / total / near[x]) for x, m in own.items())
            gain += rest * math.log(max(rest / total, 1e-300) / max(1 - sum(near.values()), 1e-12))
            if gain > 0.5 * len(own) * math.log(n):
                new[context] = (own, total, rest + lm.STRENGTH)
        if depth > 1 and not new:
            break
        retained |= new
        kept = grams
    longest = max(map(len, retained))
    seen = {}

    def score(ts):
        for i, x in enumerate(ts):
            key = (tuple(ts[max(0, i - longest):i]), x)
            if key not in seen:
                seen[key] = math.log10(chance(*key))
        return sum(seen[tuple(ts[max(0, i - longest):i]), x] for i, x in enumerate(ts))
    return score, retained


@pytest.fixture(scope="module")
def deep(spark):
    """Texts whose words depend on the four before, a passage that occurs twice and one
    text that passes in two portions, and their plain scores."""
    rng = np.random.default_rng(5)
    odds = rng.dirichlet([0.15] * 4, (4, 4, 4, 4))

    def walk(n):
        w = [0, 1, 2, 3]
        for _ in range(n):
            w.append(int(rng.choice(4, p=odds[tuple(w[-4:])])))
        return " ".join(f"w{x}" for x in w)

    rows = [(i, walk(1200)) for i in range(12)] + [(12, EN * 50000)]
    rows += [(13, "alpha beta gamma delta"), (14, "alpha beta gamma delta"), (20, "alpha beta gamma delta"), (21, walk(800))]
    assert len(rows[12][1]) > lm.PORTION
    tokens = {i: [*x.encode().split(), None] for i, x in rows}
    scored, retained = plain_deep_score([ts for i, ts in tokens.items() if i < 20], 2)
    out = F.coalesce(F.col("doc_id") >= 20, F.lit(False))
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), out).collect()}
    return tokens, scored, retained, got


def test_lm_keeps_contexts_seen_twice_at_any_size(deep):
    tokens, scored, _, got = deep
    assert len({lm.least(10 ** e) for e in range(4, 14)}) == 1
    # far below the cube-root threshold of so many tokens
    assert got[20].train_tokens > 800_000 and got[20].score > got[20].base_score + 5


def test_lm_contexts_of_any_depth(deep):
    tokens, scored, retained, got = deep
    assert max(map(len, retained)) >= 4
    assert got.keys() == tokens.keys()
    for i, ts in tokens.items():
        assert math.isclose(got[i].score, scored(ts), rel_tol=1e-9), i


def test_language_sample_counts_copies_once(spark):
    texts = spark.createDataFrame([(f"word{i} " * 20, "en") for i in range(100)], "text string, lang string")
    first = texts.orderBy(F.xxhash64("text")).first()
    copies = texts.union(spark.createDataFrame([first] * 3 * langid.SAMPLE_ROWS, texts.schema))
    assert langid.fit_dictionaries(copies) == langid.fit_dictionaries(texts)
    assert len(langid.fit_dictionaries(copies)["en"]) > 100 * 100


def test_near_duplicates_of_repeated_ids(spark):
    def text(seed):
        return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10 ** 6, 60))

    a, b, c = map(text, range(3))
    rows = [(3, b, "x"), (5, b, "y"), (5, a, "x"), (6, a, "z"), (7, c, "x"), (7, c, "y"), (None, b, "n")]
    got = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, k string"))
    assert got.columns == ["doc_id", "text", "k"]
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(3, b), (5, a), (7, c), (0, b)])
