import math
import zlib
from collections import Counter

import numpy as np
import pytest

from logtally.llm import context_mixing as mixing
from logtally.llm import lm_scoring
from tests.llm.cases import ROWS, documents, empty, plain

TEXTS = [f"the {a} {b} ran to the {a} house and sat on the {b} mat.".encode() for a in ("red", "old", "big") for b in ("cat", "dog", "fox")]


def model(texts=TEXTS):
    code = mixing.code_of(np.bincount(np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8), minlength=256))
    return mixing.learn(mixing.start_model(mixing.count(texts, code), code), texts)


def test_code_is_complete():
    code = mixing.code_of(np.arange(256) ** 3)
    assert sum(2.0 ** -code.lengths) == 1 and code.nodes.max() == 255


def test_a_text_alone_scores_as_among_others():
    m = model()
    texts = [b"", b"x", "é漢".encode(), *TEXTS, b"the cat " * 2000]
    together = mixing.log_probabilities(m, texts)
    assert np.allclose(together, [mixing.log_probabilities(m, [t])[0] for t in texts], rtol=1e-5)
    assert (together < 0).all()


def test_probabilities_of_the_next_byte_add_up():
    """P(end after prefix) and of every longer text: the first byte's 256 choices make 1."""
    m = model()
    first = 0.0
    for b in range(256):
        s = mixing.sequence([bytes([b])], m.code)
        total = 1.0
        for depth in range(len(m.code.nodes)):
            node, bit, _, _, odds = mixing._mixed(m, s, depth)
            odds = (odds + m.refined[mixing._cell(node, odds)]) / 2
            p = 1 / (1 + np.exp(-odds.astype(float)))
            own = np.flatnonzero(s.order[: len(odds)] == 0)
            if len(own):
                total *= float(p[own[0]] if bit[own[0]] else 1 - p[own[0]])
        first += total
    assert abs(first - 1) < 1e-6


def test_learning_lowers_the_cost():
    code = mixing.code_of(np.ones(256, int))
    plain_model = mixing.start_model(mixing.count(TEXTS, code), code)
    assert mixing.log_probabilities(mixing.learn(plain_model, TEXTS), TEXTS).sum() > mixing.log_probabilities(plain_model, TEXTS).sum()
    assert mixing.log_probabilities(plain_model, TEXTS[:1])[0] > mixing.log_probabilities(plain_model, [TEXTS[0][::-1]])[0]


@pytest.mark.parametrize("head", [0, 2, 1000])
def test_base(spark, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    rows = ROWS + [(i, TEXTS[i % 9].decode()) for i in range(100, 140)]
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = lm_scoring.scored(documents(spark, rows)).collect()
    score = lambda t: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[4], 6))
    got = sorted(key((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"])) for r in out)
    assert got == sorted(key((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), score(t))) for i, t in rows)
    assert {r["train_tokens"] for r in out} == {n} and all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in out)


def test_empty(spark):
    assert plain(lm_scoring.scored(empty(spark))) == []


def test_what_a_task_learns_is_of_every_text():
    """The different bytes in their contexts stand for all of them; what learners have seen adds up."""
    texts = [*TEXTS, b"", b"the cat " * 50, "é漢".encode()]
    code = mixing.code_of(np.bincount(np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8), minlength=256))
    s, times = mixing.different(texts, code)
    whole = mixing.sequence(texts, code)
    assert times.sum() == len(whole.symbols) > 2 * len(times)
    assert (np.bincount(s.symbols, times, 256) == np.bincount(whole.symbols, minlength=256)).all()
    total = mixing.count(texts, code)
    assert (total == sum(mixing.count([t], code) for t in texts)).all()
    assert total[: 2 * mixing.SLOTS[0]].sum() == code.lengths[whole.symbols].sum()
    m = mixing.start_model(total, code)
    learners = [mixing.Learner(m.weights) for _ in texts]
    for learner, text in zip(learners, texts, strict=True):
        learner.add(m, [text])
    sums = sum(learner.sums() for learner in learners)
    assert sums[: mixing._GATES].sum() == code.lengths[whole.symbols].sum()
    assert mixing.log_probabilities(mixing.learned(m, sums), texts).sum() > mixing.log_probabilities(m, texts).sum()


def test_long_and_late_texts_are_learned_from(spark, monkeypatch):
    """Every training text reaches a learner: one of more than 50 KB, and each of more than a thousand."""
    seen = []
    own = mixing.learned
    monkeypatch.setattr(mixing, "learned", lambda m, sums: seen.append((m, sums)) or own(m, sums))
    rows = [(i, f"{TEXTS[i % 9].decode()} {i}") for i in range(1_500)] + [(2_000, "all day " * 10_000), (None, None)]
    lm_scoring.scored(documents(spark, rows)).collect()
    ((m, sums),) = seen
    training = [(t or "").encode() + b"\xff" for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
    histogram = np.bincount(np.frombuffer(b"".join(training), np.uint8), minlength=256)
    assert len(training) > 1_300 and sums[: mixing._GATES].sum() == (m.code.lengths * histogram).sum()


@pytest.mark.parametrize("size", [1, 2, 1_000, 50_000])
def test_different_contexts_stand_for_all(size):
    rng = np.random.default_rng(size)
    keys = (rng.zipf(1.3, size) % 5_000).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    first, place = mixing._firsts(keys)
    assert (keys[first][place] == keys).all()
    assert len(np.unique(keys)) <= len(first) <= 1.5 * len(np.unique(keys)) + 5


@pytest.mark.parametrize("bits", [1, 6, 16])
def test_kept_contexts_count_like_all(bits):
    """Also where most contexts find their place in the table taken, and in a second use."""
    texts = [*TEXTS, b"", b"\0\0", "é漢".encode(), b"the cat " * 50]
    code = mixing.code_of(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256))
    counter = mixing.SlotCounter(code, bits=bits)
    for i in range(3):
        counter.add(0, texts[i:])
        counter.add(1, texts[: i + 1])
    for half, parts in enumerate(([texts[i:] for i in range(3)], [texts[: i + 1] for i in range(3)])):
        assert (counter.counts()[half] == sum(mixing.count(part, code) for part in parts)).all()


def test_contexts_that_come_again_are_not_worked_out_again(monkeypatch):
    m, asked, own = model(), [], mixing._lost
    monkeypatch.setattr(mixing, "_lost", lambda m, keys: asked.append(len(keys)) or own(m, keys))
    texts = [b"", b"\0", *TEXTS]
    for bits in (2, 16):
        scorer = mixing.Scorer(m, bits)
        asked.clear()
        first, again, other = scorer.add(texts), scorer.add(texts), scorer.add(texts[::-1])
        assert (first == again).all() and (first == other[::-1]).all() and (first < 0).all()
    assert sum(asked[1:]) < 0.1 * asked[0]
