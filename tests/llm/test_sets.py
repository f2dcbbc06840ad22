"""Operators on whole tables: conversations, lines, vectors, near copies, mixing, and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulage.llm import bloom, chat, embeddings, jaccard, lines, mixing, quality
from haulage.llm.graph import components
from haulage.llm.queries import QUERIES
from haulage.session import stored


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(1, 80)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == union_find(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- conversations

def plain_chat(rows):
    out, groups = {}, {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        every = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


CHAT = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (2, 0, "user", "hello"), (2, 1, "assistant", "hi"), (2, 2, "user", "more"), (3, 0, "user", "hello"), (3, 1, "assistant", "ho"),
    (4, 0, None, None), (5, 1, "assistant", "\\### : </turn>\n\\h"), (5, 0, "a: b\\c", "x\ny"), (None, 0, "user", "no id"), (6, 0, "user", "twice"), (6, 0, "user", "twice"), (7, None, "user", "z" * 300_000),
    (8, 0, "user", "hello"), (8, 1, "assistant", "hi"),
]


def test_conversations_read_back(spark):
    frame = spark.createDataFrame([(*r, 1, "x") for r in CHAT], "conv_id long, turn long, role string, text string, node_start int, path string")
    for size in (50, 1 << 18):
        got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(stored(chat.prefix_blocks(frame, size), "chat")).collect()}
        assert got == plain_chat(CHAT)
    assert chat.prefix_blocks(frame.limit(0)).count() == 0


def test_shared_turns_stand_once(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < 3 else f"own {c} {t}") for c in range(200) for t in range(5)]
    blocks = chat.prefix_blocks(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1)).collect()
    assert sum(b.text.count("turn 1<") for b in blocks) == len(blocks) < 20
    for b in blocks:
        for k, parent in enumerate(b.node_parent):
            seen = sum(e - s for s, e in zip(b.attend_from[k], b.attend_to[k]))
            assert seen == b.node_position[k] and (parent < 0) == (seen == 0)
            assert all(e <= b.node_start[k] for e in b.attend_to[k])
        leaf = b.conv_leaf[-1]
        assert len(b.attend_from[leaf]) <= 2  # ancestors that stand side by side are one interval


# --- lines

def plain_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for doc, text in rows:
        if doc is not None:
            for x in (text or "").split("\n"):
                holders.setdefault(key(x), set()).add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if doc is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_of_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    done = lines.without_repeated_lines(docs)
    assert done.columns == [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in done.collect()], key=repr) == plain_lines([r[:2] for r in odd_rows])
    assert lines.without_repeated_lines(documents([])).count() == 0


def test_lines_with_all_inner_names(spark):
    """Columns that bear the operator's own names are passed on."""
    names = ["_keys", "_drop", "_doc_id", "key", "first", "last", "salt", "_KEYS_"]
    rows = [(i, "a line that all share\nown line %d here" % i, *[f"{n} {i}" for n in names]) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = lines.without_repeated_lines(docs).orderBy("doc_id").collect()
    assert [tuple(r)[2:10] for r in out] == [r[2:] for r in rows] and [r.n_dropped for r in out] == [0, 1, 1, 1, 1]


def test_lines_with_a_full_filter(documents, monkeypatch):
    """A filter that is much too small suspects nearly everything, and changes nothing."""
    rng = random.Random(9)
    rows = [(i, "\n".join(f"line number {rng.randrange(3000)} of many" for _ in range(20))) for i in range(150)]
    monkeypatch.setattr(lines, "size_for", lambda entries: 1 << 10)
    monkeypatch.setattr(lines, "SHARD", 64)
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.without_repeated_lines(documents(rows)).collect()], key=repr) == plain_lines(rows)


def test_merged_filters_lose_no_line():
    rng = np.random.default_rng(0)
    hashes, bits = rng.integers(0, 2**63, 500, dtype=np.uint64), 1 << 13
    a, b = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    bloom.put(a, hashes[:300], bits)
    bloom.put(b, hashes[200:], bits)
    assert bloom.has(a & b, hashes[200:300], bits).all() and bloom.has(a, hashes[:300], bits).all() and not bloom.has(a & b, hashes, bits).all()


# --- vectors

def plain_links(vectors, similar=0.95):
    good = {i: np.asarray(v, float) for i, v in vectors.items() if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 16}
    ids = sorted(good)
    unit = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    close = unit @ unit.T >= similar
    links = [(ids[x], ids[y]) for x, y in zip(*np.nonzero(close)) if x < y]
    return links, union_find(vectors, links)


def clouds(seed=0, n=400, groups=25, noise=0.03):
    rng = np.random.default_rng(seed)
    out = {}
    centres = rng.standard_normal((groups, 16))
    for i in range(n):
        c = centres[rng.integers(groups)] if i % 2 else rng.standard_normal(16)
        out[i] = (c + noise * rng.standard_normal(16)).astype(np.float32).tolist()
    return out


@pytest.mark.parametrize("block", [4096, 30])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    vectors = clouds() | {500 + i: [1.0] * 16 for i in range(50)} | {600: None, 601: [0.0] * 16, 602: [float("nan")] * 16, 603: [1.0] * 15 + [float("inf")], 604: [1.0, None] * 8, 605: [1.0] * 3, 606: [], 607: [1e30] * 16, 608: [1e-30] * 16}
    monkeypatch.setattr(embeddings, "close_codes", lambda coded, f=embeddings.close_codes: f(coded, block=block))
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors.items()], "vec_id long, embedding array<float>, label int, cls string")
    got = {r.vec_id: r for r in embeddings.near_vectors(frame).collect()}
    links, root = plain_links(vectors)
    assert len(got) == len(vectors)
    degree = {i: sum(i in x for x in links) for i in vectors}
    found = sum(r.n_links for r in got.values())
    assert 0.9 * 2 * len(links) <= found <= 2 * len(links)
    assert all(got[i].n_links <= degree[i] for i in vectors)
    assert np.mean([got[i].component_id == root[i] for i in vectors]) > 0.97
    assert all(got[i].n_links == 0 and got[i].kept for i in range(600, 607)) and got[607].component_id == got[608].component_id == 500


def test_vectors_of_the_table(spark, sf_dir):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    unit = np.array([vectors[i] for i in sorted(vectors)], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    wanted = ((unit @ unit.T) >= 0.95).sum() - len(unit)
    found = sum(r.n_links for r in QUERIES["op6_vectors"](spark, sf_dir).collect())
    assert 0.9 * wanted <= found <= wanted


def test_few_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(make([])).count() == 0
    assert [tuple(r) for r in embeddings.near_vectors(make([(1, None)])).collect()] == [(1, 0, 1, True)]
    assert sorted(tuple(r) for r in embeddings.near_vectors(make([(3, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()) == [(2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False)]


def test_vectors_of_all_lengths_link(spark, monkeypatch):
    """Short and rare lengths are compared as well, each with its own kind, also where rotations come in turns."""
    rng = np.random.default_rng(5)
    vectors = {i: v for i, v in clouds(n=120).items()} | {1000: [1.0, 2.0], 1001: [1.0, 2.0], 1002: [2.0, 4.0], 1003: [2.0, -1.0], 1004: [3.0], 1005: [5.0], 1006: [-1.0]}
    base = rng.standard_normal(90)
    vectors |= {1100 + i: (base + 0.02 * rng.standard_normal(90)).tolist() for i in range(12)} | {1200 + i: rng.standard_normal(90).tolist() for i in range(30)}
    for at_once in (embeddings.AT_ONCE, 1):
        monkeypatch.setattr(embeddings, "AT_ONCE", at_once)
        got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")).collect()}
        assert [(got[i].n_links, got[i].component_id) for i in range(1000, 1007)] == [(2, 1000), (2, 1000), (2, 1000), (0, 1003), (1, 1004), (1, 1004), (0, 1006)]
        assert all(got[1100 + i].component_id == 1100 and got[1100 + i].n_links == 11 for i in range(12)) and all(got[1200 + i].n_links == 0 for i in range(30))


def test_every_pair_within_the_radius_meets_once():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = np.array([np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, rng.integers(0, 15), replace=False).astype(np.uint64), initial=np.uint64(0)) for _ in codes], np.uint64)
    differ = flips
    met = [set(a) & set(b) for a, b in zip(embeddings.keys_of(codes, 64).tolist(), embeddings.keys_of(codes ^ flips, 64).tolist())]
    first = embeddings.first_meeting(differ, 64)
    for m, f, d in zip(met, first, np.bitwise_count(differ)):
        here = {(e >> 56) << 8 | (e >> 48 & 255) for e in m}
        assert (f in here) if here else f == 2**32 - 1
        assert here or d > embeddings.RADIUS


# --- near copies

def plain_groups(rows, size, percent):
    sets = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}) if words else set())
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root = union_find({r[0] for r in rows}, links)
    return sorted((r[0], len(s), root[r[0]]) for r, s in zip(rows, sets))


def near_copies(seed, n=160):
    """Chains of copies with more and more words changed, passages that many texts share, and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    out, base = [], [word() for _ in range(80)]
    for i in range(n):
        if i % 20 == 0:
            base = [word() for _ in range(rng.choice([6, 30, 80, 200]))]
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = word()
        if i % 3 == 0:
            base = text
        if i % 4 == 0:
            text = text + passage
        if i % 7 == 0:
            text = passage + [word() for _ in range(rng.randrange(8))]
        if i % 11 == 0:
            text = [rng.choice("ab") for _ in range(rng.randrange(6))]
        out.append((i, " ".join(text) if i % 2 else " ".join(text).upper()))
    return out


@pytest.mark.parametrize("seed, size, percent", [(1, 4, 85), (2, 5, 80), (3, 1, 50)])
def test_groups_against_brute_force(documents, monkeypatch, seed, size, percent):
    monkeypatch.setattr(jaccard, "HUBS", 1 + seed % 2)
    rows = near_copies(seed)
    assert sorted(map(tuple, jaccard.similar_groups(documents(rows), size, percent).collect())) == plain_groups(rows, size, percent)


def test_groups_of_odd_rows(documents, odd_rows):
    got = jaccard.similar_groups(documents(odd_rows), 4, 85).collect()
    assert len(got) == len(odd_rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[5][0][1] == 4 and by[7] == [(1, 6)] and by[6] == [(1, 6)] * 2 and by[9] == [(1, 9)]
    assert {g for _, g in by[8]} == {8}
    assert jaccard.similar_groups(documents([])).count() == 0


# --- mixing

def plain_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, open_ = {}, sum(sizes.values()) * 1.5, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if rest * weight[s] / total > 2 * sizes[s]}
        if not above:
            return target | {s: rest * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        rest -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return target


def held_to_plain(rows, texts):
    sizes = {}
    for doc, text, source in texts:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target, sums = plain_targets(sizes), {}
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size) and r.source_size in sizes.values()
        sums[r.source] = sums.get(r.source, 0) + r.taken
    for s in sizes:
        assert all(abs(r.target - target[s]) <= 1e-9 * max(1, target[s]) for r in rows if r.source == s)
        # a source with few documents may have no subset of exactly this size, but what is missing is less than any document left
        own = [r for r in rows if r.source == s and r.size]
        left = [r.size for r in own if r.copies == min(o.copies for o in own)]
        assert -1 <= target[s] - sums[s] <= max(1, min(left, default=0)), (s, sums[s], target[s])


def decided(docs):
    return mixing.mixed(docs).withColumn("taken", F.col("size") * F.col("copies")).collect()


def test_mix_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = decided(docs)
    held_to_plain(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert sorted(map(tuple, rows)) == sorted(map(tuple, decided(docs.repartition(5))))


def test_mix_with_one_length_for_a_third(documents, monkeypatch):
    """A hot source in which many documents have one length, cut into many hash ranges."""
    monkeypatch.setattr(mixing, "RANKED", 20)
    rng = random.Random(4)
    rows = [(i, "w " * (7 if i % 3 else rng.randrange(1, 60)), None, "hot" if i % 2 else rng.choice(["a", "b", "zz", None])) for i in range(1500)]
    rows += [(5000, "same row twice", None, "a")] * 4 + [(None, "no id", None, "b"), (6000, None, None, "empty"), (6001, "", None, "empty")]
    docs = documents(rows)
    got = decided(docs)
    assert len(got) == len(rows)
    held_to_plain(got, [(r[0], r[1], r[3]) for r in rows])
    out = mixing.taken(docs)
    assert out.columns == docs.columns
    per_source = {r.source: r.n_words for r in out.groupBy("source").agg(F.sum(mixing.n_words()).alias("n_words")).collect()}
    assert per_source == {s: sum(r.taken for r in got if r.source == s) for s in per_source}


def test_mix_with_all_inner_names(spark):
    names = ["_doc_id", "_hash", "_copies", "_rows", "_text_hash", "_place", "_copy", "_each", "row", "copies", "n", "place", "text_hash", "col"]
    rows = [(i // 2, f"word {i // 2} here", "s", *[f"{n} {i // 2}" for n in names]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    out = mixing.taken(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == sum(r.copies for r in mixing.mixed(docs).collect()) > 0 and all(tuple(r) in rows for r in got)


def test_mix_of_odd_rows(documents, odd_rows):
    got = decided(documents(odd_rows))
    assert len(got) == len(odd_rows) and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mixed(documents([])).count() == 0 and mixing.taken(documents([])).count() == 0
    assert [r.taken for r in decided(documents([(1, None, None, "a"), (2, "", None, None)]))] == [0, 0]


def test_fit_against_every_subset():
    rng = random.Random(7)
    for _ in range(60):
        lengths = rng.sample(range(1, 30), rng.randrange(1, 5))
        left = [rng.randrange(1, 4) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, left):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        budget = rng.randrange(0, 60)
        got = mixing.fit(lengths, left, budget)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= budget)
        assert all(k <= left[lengths.index(n)] for n, k in got.items())


# --- pipeline

def test_stages_take_any_columns_and_no_rows(spark, sf_dir):
    """Columns that operators name themselves and nulls in all columns do no harm; no rows stay no rows."""
    names = ["_doc_id", "_keys", "_drop", "cls", "score", "n", "text_hash", "copies", "size", "row", "component_id"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    more = docs.limit(60).unionByName(spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, 0)], docs.schema))
    more = more.select("*", *[F.lit("x").alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, more, sf_dir).columns and stage(spark, more, sf_dir).count() >= 0
        if stage is not corpus_pipeline.of_good_quality:
            assert stage(spark, more.limit(0), sf_dir).count() == 0


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = docs
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, seen, sf_dir), f"stage-{place}")
        before, after = seen.collect(), out.collect()
        if place < 4:
            assert out.columns == docs.columns and all(r.n_chars == len(r.text or "") for r in after)
        if place == 0:
            score = {r.doc_id: r.predicted for r in quality.with_scores(docs, quality.trained(docs, labels)).collect()}
            assert sorted(r.doc_id for r in after) == sorted(d for d, p in score.items() if p)
        elif place == 1:
            wanted = [(d, t) for d, _, n, t in plain_lines([(r.doc_id, r.text) for r in before]) if n == 0 or t.strip(" \t\n\x0b\x0c\r")]
            assert sorted((r.doc_id, r.text) for r in after) == sorted(wanted)
        elif place == 2:
            groups = plain_groups([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in after) == sorted(d for d, _, g in groups if d == g)
        elif place == 3:
            held = {r.doc_id: r.copies for r in mixing.mixed(seen).collect()}
            assert sorted(r.doc_id for r in after) == sorted(d for d, k in held.items() for _ in range(k))
        else:
            assert len(after) == len(before) and all(r.decoded_same for r in after) and sum(r.n_chars for r in after) == sum(len(r.text) for r in before)
        seen = out
    assert corpus_pipeline.run(spark, sf_dir).count() == seen.count()
