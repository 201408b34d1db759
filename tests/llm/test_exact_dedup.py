import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from logtally.llm import binary_fuse, exact_dedup
from tests.llm.cases import ROWS, documents, empty, plain


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_filters_find_every_key_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(2**63), 2**63, n)
    f = binary_fuse.build(np.r_[keys, keys[: n // 2]])
    assert binary_fuse.contains(f, keys).all()
    others = binary_fuse.contains(f, rng.integers(-(2**63), 2**63, 100_000)).mean()
    assert others < 0.006
    if n >= 1000:
        assert len(f.cells) < 1.5 * n


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = 0
        for i in ids:
            now = i == keep and not kept
            kept += now
            out.append((i, keep, len(ids), now, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def found(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in df.collect())


@pytest.mark.parametrize("bucket_texts", [1, 3, 1000])
def test_keepers(spark, bucket_texts):
    assert found(exact_dedup.keepers(documents(spark), bucket_texts)) == expected(ROWS)


def test_a_group_with_most_rows(spark):
    rows = [(i, "copy") for i in range(3000)] + [(i, f"t{i % 500}") for i in range(3000, 4000)]
    assert found(exact_dedup.keepers(documents(spark, rows), 50)) == expected(rows)


def test_the_filter_lets_through_all_that_the_snapshot_has(spark):
    snapshot = exact_dedup.build_snapshot(documents(spark, [(i, f"t{i}") for i in range(500)]), 40)
    assert snapshot.buckets == 13 and snapshot.filters.count() == 13
    batch = exact_dedup._grouped(documents(spark, [(i, f"t{i}") for i in range(400, 2000)]))
    likely = {bytes(r["digest"]) for r in exact_dedup.screen(batch, snapshot).collect()}
    both = {hashlib.sha256(f"t{i}".encode()).digest() for i in range(400, 500)}
    assert both <= likely and len(likely) < 100 + 60


def test_drop_copies_keeps_columns_and_one_row_of_each_text(spark):
    out = exact_dedup.drop_copies(documents(spark))
    assert out.columns == documents(spark).columns
    assert sorted((r["text"] or "") for r in out.collect()) == sorted({t or "" for _, t in ROWS})


def test_empty(spark):
    assert plain(exact_dedup.keepers(empty(spark))) == [] and plain(exact_dedup.drop_copies(empty(spark))) == []
