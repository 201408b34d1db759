import random

import pytest

from logtally.llm import toxicity as t
from tests.conftest import TESTDATA
from tests.llm.cases import ROWS, documents, empty, plain


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, features double, text string, half int")


def text(rng, toxic, word="grolk"):
    words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega", "you", "the"]) for _ in range(rng.randrange(12, 70))]
    if toxic:
        for _ in range(2):
            words.insert(rng.randrange(len(words)), f"you {word}")
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    """One document in five is toxic by a word that no fixed list has; one label in twenty is wrong."""
    rng = random.Random(3)
    rows = [(i, text(rng, i % 5 == 0)) for i in range(700)]
    return rows, [(i, 1, int((i % 5 == 0) != (i % 20 == 7)), None, None, None) for i in range(500)]


def test_toxic_texts_are_told_from_others(spark, corpus):
    rows, labels = corpus
    more = [(9999, 1, 1, None, None, None), (5, None, None, None, None, None), (None, 1, 1, None, None, None)]
    out = t.scored(documents(spark, rows), table(spark, labels + more)).collect()
    assert len(out) == len(rows) and all((r["predicted"] == 1) == (r["score"] >= t.CUT) and 0 <= r["score"] <= 1 for r in out)
    unseen = [r for r in out if r["held_out"] or r["doc_id"] >= 500]
    assert sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in unseen) >= 0.98 * len(unseen)


def test_scores_are_calibrated(spark, corpus):
    rows, labels = corpus
    truth = {i: toxic for i, _, toxic, *_ in labels}
    out = [(r["score"], truth[r["doc_id"]]) for r in t.scored(documents(spark, rows), table(spark, labels)).collect() if r["doc_id"] in truth]
    for low, high in ((0, 0.5), (0.5, 1.01)):
        part = [(s, y) for s, y in out if low <= s < high]
        assert abs(sum(s for s, _ in part) / len(part) - sum(y for _, y in part) / len(part)) < 0.1


def test_labels_of_held_out_rows_are_not_used(spark, corpus):
    rows, labels = corpus
    docs = documents(spark, rows)
    held = {r["doc_id"] for r in t.scored(docs, table(spark, [])).where("held_out").collect()}
    turned = [(i, q, 1 - y if i in held else y, *rest) for i, q, y, *rest in labels]
    assert held and plain(t.scored(docs, table(spark, labels))) == plain(t.scored(docs, table(spark, turned)))


def test_a_row_does_not_vouch_for_its_own_words():
    lexicon = t.Lexicon({"once": (1, 0), "often": (40, 1)}, 50, 50)
    assert t.describe("once", lexicon, 1)[1] == t.describe("nothing", lexicon, 1)[1] == 0
    assert t.describe("often", lexicon, 1)[1] == 1
    odds, error = lexicon.odds("once", 1)
    assert odds == pytest.approx(lexicon.odds("once")[0] - 1.0786, abs=0.01) and error > lexicon.odds("once")[1]


def test_what_is_measured():
    lexicon = t.Lexicon({"grolk": (40, 0)}, 50, 50)
    plainly, hidden = t.describe("you are a grolk", lexicon), t.describe("you are a gr0lk", lexicon)
    assert plainly[1] > 0 and plainly[7] > 0 and plainly[14] == 0
    assert hidden[1] == 0 and hidden[13] > 0 and hidden[14] == 1
    assert t.describe("grolk far away from a word that says who is meant by you", lexicon)[7] == 0
    loud = t.describe("WHAT?! NO!!! soooo", lexicon)
    assert loud[9] > 0.4 and loud[10] > 0 and loud[11] > 0 and loud[12] > 0 and loud[13] > 0
    assert len(t.describe("", lexicon)) == t.FEATURES and not any(t.describe("", lexicon))
    assert not any(t.describe(" \n1 2 ", lexicon))


@pytest.mark.parametrize(("labels", "score"), [([], 0), ([(7, 1, 1, None, None, None), (8, 1, 1, None, None, None)], 1), ([(4, 1, 0, None, None, None)], 0)])
def test_awkward_rows_with_labels_of_one_kind(spark, labels, score):
    out = t.scored(documents(spark), table(spark, labels)).collect()
    assert len(out) == len(ROWS) and {r["score"] for r in out} <= {0, score} and sum(r["doc_id"] is None for r in out) == 2


def test_awkward_rows_among_others(spark, corpus):
    rows, labels = corpus
    rows = [(None if i is None else i + 10_000, x) for i, x in ROWS] + rows
    labels = labels + [(10_009, 1, 1, None, None, None), (10_009, 1, 0, None, None, None), (10_001, 1, 0, None, None, None), (10_010, 1, 0, None, None, None)]
    out = t.scored(documents(spark, rows), table(spark, labels)).collect()
    assert len(out) == len(rows)
    by_text = {}
    texts = dict(rows)
    for r in out:
        if r["doc_id"] is not None:
            by_text.setdefault(texts[r["doc_id"]] or "", set()).add(r["score"])
    assert all(len(scores) == 1 for scores in by_text.values())


def test_empty(spark):
    assert plain(t.scored(empty(spark), table(spark, []))) == []
    assert plain(t.scored(empty(spark), table(spark, [(1, 1, 1, None, None, None)]))) == []


def test_given_data(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/{name}.parquet") for name in ("documents", "labels"))
    rows = t.scored(docs, labels).where("held_out").join(labels, "doc_id").where("toxic IS NOT NULL").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.8 * len(rows)
