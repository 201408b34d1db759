import random
from collections import Counter

import numpy as np
import pytest

from logtally.llm import ngram_join, tables
from logtally.llm.words import shingle_hashes, split_words
from tests.llm.cases import LONG, ROWS, documents, empty, plain


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    root = lambda i: i if comp[i] == i else root(comp[i])
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        if doc_id is not None:
            low[r] = min(low.get(r, doc_id), doc_id)
    return sorted(((d, len(sets[i]), low.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def test_awkward_rows(spark):
    assert plain(ngram_join.near_duplicates(documents(spark))) == expected(ROWS)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits_and_shared_passages(spark, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    shared = [word() for _ in range(40)]
    bases = [[word() for _ in range(rng.randrange(20, 120))] for _ in range(6)]
    rows = []
    for i in range(160):
        words = list(rng.choice(bases)) if rng.random() < 0.8 else [word() for _ in range(rng.randrange(3, 100))]
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.3:
            words[rng.randrange(len(words)) :][:0] = shared
        if rng.random() < 0.2:
            words += words[: rng.randrange(len(words))]
        rows.append((i, " ".join(words)))
    assert plain(ngram_join.near_duplicates(documents(spark, rows))) == expected(rows)


def test_chains_are_followed(spark):
    """Each text is linked with the next one only, and the leaders of their shingles don't cover all of it."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(40)]
    got = plain(ngram_join.near_duplicates(documents(spark, rows)))
    assert got == expected(rows) and {r[2] for r in got} == {0}


def test_keep_one(spark):
    out = ngram_join.keep_one(documents(spark))
    assert out.columns == documents(spark).columns
    texts = [r["text"] for r in out.collect()]
    assert LONG in texts and LONG + " end" not in texts and texts.count(None) == 1


def test_one_row_stays_of_repeated_and_missing_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near = lambda k: " ".join([*base, f"end{k}"])
    rows = [(None, near(0)), (None, near(1)), (None, near(1))]
    rows += [(i, x.replace("w", "v")) for i, x in ((7, near(0)), (7, near(1)), (8, near(2)), (7, near(0)))]
    rows += [(7, "something else altogether that stands here by itself"), (8, ""), (None, None), (9, " \n")]
    out = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(documents(spark, rows)).collect()]
    assert len([x for x in out if not (x[1] or "").strip()]) == 3
    assert len([x for x in out if x[0] is None and (x[1] or "").startswith("w0")]) == 1
    assert len([x for x in out if (x[1] or "").startswith("v0")]) == 1 and (7, rows[-4][1]) in out and len(out) == 6
    # Which one it is does not depend on the order of the rows.
    again = ngram_join.keep_one(documents(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(out, key=repr) == sorted(((r["doc_id"], r["text"]) for r in again), key=repr)


@pytest.mark.parametrize("vocabulary", [10**9, 12])
def test_forms_of_one_template_are_hardly_compared(spark, monkeypatch, vocabulary):
    """Two words of a hundred are another in each form: most pairs of forms are near but not near enough."""
    rng = random.Random(6)
    template = [f"w{i}" for i in range(104)]
    rows = []
    for i in range(600):
        words = list(template)
        for k in rng.sample(range(104), 2):
            words[k] = f"x{rng.randrange(vocabulary)}"
        rows.append((i, " ".join(words)))
    compared, verified = [], ngram_join._verified

    def counted(pairs, shared):
        compared.append(pairs.where("a != b").selectExpr("least(a, b)", "greatest(a, b)").distinct().count())
        return verified(pairs, shared)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    got = plain(ngram_join.near_duplicates(documents(spark, rows)))
    assert got == expected(rows)
    sets = [shingles(t) for _, t in rows]
    links = sum(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert sum(compared) < 10 * len(rows) + links, compared


def test_a_hot_shingle_is_dealt_into_shares(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHARE", 7)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(40)] + [(100 + i, " ".join([*words[:80], *(f"y{i}_{j}" for j in range(16))])) for i in range(40)]
    assert plain(ngram_join.near_duplicates(documents(spark, rows))) == expected(rows)


def test_whole_sets_go_before_pairs_are_compared(spark, monkeypatch, tmp_path):
    """Prefixes and sets are as large as the texts: none of them is left once the classes are ranked."""
    labels, verified = [], ngram_join._verified

    def fresh(session, label):
        labels.append(tmp_path / f"{label}-{len(labels)}")
        return str(labels[-1])

    left = []

    def seen(pairs, shared):
        left.append({x.name.split("-")[0] for x in labels if x.exists()})
        return verified(pairs, shared)

    monkeypatch.setattr(tables, "fresh_dir", fresh)
    monkeypatch.setattr(ngram_join, "_verified", seen)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[20 * i : 20 * i + 100] + [f"end{j}"])) for i in range(10) for j in range(3)]
    assert plain(ngram_join.near_duplicates(documents(spark, rows))) == expected(rows)
    assert left and all("ranked" in x and not x & {"prefixes", "sets"} for x in left), left


@pytest.mark.parametrize("entries", [1, 150, 10**6])
def test_ranks_over_chunks_shards_and_pieces(spark, monkeypatch, entries):
    """Shared shingles by how many classes have them, as counted one by one, however classes and shards are cut; ids repeat."""
    monkeypatch.setattr(ngram_join, "CHUNK_ENTRIES", entries)
    monkeypatch.setattr(ngram_join, "SHARD_ENTRIES", 100)
    rng = random.Random(entries)
    words = [f"w{i}" for i in range(80)]
    rows = [(i // 2, " ".join([*words[: rng.randrange(60, 80)], f"end{i % 7}"])) for i in range(40)] + [(None, "another one"), (3, " ".join(words))]
    pieces = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        docs = documents(spark, rows).repartition(2)
        with tables.scratch(spark):
            _, heads, ranked = ngram_join._classes(docs)
            got = {r["cid"]: r for r in ranked.collect()}
            names = {(r["h1"], r["h2"]): r["cid"] for r in heads.collect()}
        assert plain(ngram_join.near_duplicates(docs)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", pieces)
    sets = {tuple(shingle_hashes(split_words(t)).tolist()) for _, t in rows}
    sets = {names[m]: s for s in sets if (m := ngram_join._signature(np.array(s, np.uint64))) in names}
    df = Counter(x for s in sets.values() for x in s)
    assert len(names) == len(sets) > 20 and got
    for cid, s in sets.items():
        shared = sorted((df[x], x) for x in s if df[x] > 1)
        left = len(s) - ngram_join.least_overlap(len(s)) + 1 - (len(s) - len(shared))
        if len(shared) < ngram_join.least_overlap(len(s)) or left <= 0:
            assert cid not in got
            continue
        row = got[cid]
        assert [x % 2**64 for x in row["shared"]] == [x for _, x in shared] and row["own"] == len(s) - len(shared) and row["n"] == len(s)
        assert list(row["prefix"]) == list(row["shared"][:left])
        bits = Counter(x % ngram_join.MASK for _, x in shared)
        assert [x % 2**64 for x in row["mask"]] == [sum(1 << b for b in range(64) if bits[64 * i + b] % 2) for i in range(ngram_join.MASK // 64)]


def test_scratch_tables_go(spark):
    with tables.scratch(spark) as keep:
        first = tables.saved(spark.range(3), "first")
        with tables.scratch(spark) as keep_inner:
            inner = keep_inner(first.selectExpr("id + 1 AS id"), "inner")
            lost = tables.saved(spark.range(2), "lost")
        out = keep(inner.selectExpr("id + 1 AS id"), "out")
    assert [r["id"] for r in out.orderBy("id").collect()] == [2, 3, 4]
    for gone in (first, inner, lost):
        with pytest.raises(Exception, match="(?i)does not exist|not_exist"):
            gone.collect()


def test_empty(spark):
    assert plain(ngram_join.near_duplicates(empty(spark))) == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    assert plain(tables.components(df)) == sorted([(i, 0) for i in range(51)] + [(i, 100) for i in range(100, 160)], key=repr)


def test_look_up_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(tables, "HOT_ROWS", 10)
    rows = spark.createDataFrame([(1, i) for i in range(100)] + [(i, i) for i in range(2, 20)], "k long, v long")
    table = spark.createDataFrame([(1, 100, "a")] + [(i, 1, "b") for i in range(2, 10)], "k long, w long, name string")
    got = tables.look_up(rows, table, ["k"], "w")
    assert plain(got.select("k", "v", "name")) == plain(rows.join(table, "k", "left").select("k", "v", "name"))
