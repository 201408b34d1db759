import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from logtally.llm import packing, token_ids
from tests.llm.cases import ROWS, documents, empty, plain

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_whole_text():
    texts = [t or "" for _, t in ROWS] + ["don't, we'll ... it's 3.14!!! <|endoftext|> a\x0bb\x85c  d’e İstanbul ΑΣ ΑΣ. ½x² \u2028 ﬁ", "'s 's' 'S x's"]
    texts += ["hello <|endoftext|> world", "<|ENDOFTEXT|><|endoftext", "a<|startoftext|>b <| c", "x < | y"]
    got = [np.frombuffer(b, np.uint16).tolist() for b in token_ids.WordIds(PATH).encode(texts, 2)]
    tokenizer = whole()
    assert got == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_special_strings_are_one_id():
    ids = np.frombuffer(token_ids.WordIds(PATH).encode(["hello <|endoftext|> world"], 2)[0], np.uint16).tolist()
    assert ids == [3306, 49407, 1002, 2]


def test_ids_when_words_are_forgotten():
    encoder = token_ids.WordIds(PATH, kept_bytes=3)
    for text in ("a b c d e f", "g a b", "a"):
        assert np.frombuffer(encoder.encode([text, text], 2)[1], np.uint16).tolist()[:-1] == whole().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_item_once_and_fill_windows(seed):
    rng = np.random.default_rng(seed)
    slots = 32
    histogram = np.zeros(slots + 1, np.int64)
    histogram[rng.integers(1, slots + 1, 5 + seed)] = rng.integers(1, 2000, 5 + seed)
    uses, windows = packing.plan(histogram)
    filled = np.zeros(windows, np.int64)
    for s in range(1, slots + 1):
        for rank in range(histogram[s]):
            at, r = s, rank
            while at:
                own = uses[at]
                k = max(i for i, u in enumerate(own) if u.rank <= r)
                filled[own[k].sequence + r - own[k].rank] += own[k].steps
                at, r = own[k].left_step, own[k].left_rank + r - own[k].rank
    assert (filled <= slots).all() and (filled < slots).sum() <= 1
    assert filled.sum() == (histogram * np.arange(slots + 1)).sum()


def check(pieces, rows, window):
    tokenizer = whole()
    own = {}
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own.setdefault(doc_id, []).append(ids)
    left = {k: sum(map(len, v)) for k, v in own.items()}
    by_sequence = {}
    for r in pieces.collect():
        left[r["doc_id"]] -= r["length"]
        crcs = {zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) for x in own[r["doc_id"]] if len(x) == r["doc_tokens"]}
        assert r["ids_crc32"] in crcs
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert not any(left.values())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sum(map(len, (x for v in own.values() for x in v))) / (len(by_sequence) * window)


def test_pieces(spark):
    pieces = packing.pack(packing.tokenised(documents(spark), PATH), window=64, step=4, ranked_rows=3)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(pieces, ROWS, 64) > 0.9


def test_many_equal_lengths_are_cut_to_fit(spark):
    rows = [(i, " ".join(["house"] * 41)) for i in range(300)]
    assert check(packing.pack(packing.tokenised(documents(spark, rows), PATH), 64, 4), rows, 64) > 0.95


def test_sequences_hold_the_ids(spark):
    rows = [r for r in ROWS[:10] if r[0] != 9]
    tokens = packing.tokenised(documents(spark, rows), PATH)
    pieces = packing.pack(tokens, 64, 4)
    built = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u2") for r in packing.sequences(pieces, tokens).collect()}
    for r in pieces.collect():
        ids = built[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]


def test_empty(spark):
    assert plain(packing.pack_documents(empty(spark), PATH)) == []


def test_a_batch_is_encoded_in_little_memory():
    """What is traced while 4 MB of text are encoded: 24 MB at a million characters at a time, 88 MB at four."""
    texts = [" ".join(f"{chr(97 + k % 26)}{chr(97 + i % 26)}{k % 7}" for k in range(2_500)) for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    encoder = token_ids.word_ids(PATH)
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in packing._encoded(batch, encoder, 2))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 400 and most < 50_000_000


def test_few_of_many_different_words_are_kept():
    """What is traced as kept after 300,000 different words: 4 MB, where it were 34 MB with a table of 80 MB."""
    letters = str.maketrans("0123456789", "bcdfghjklm")
    texts = [" ".join("x" + f"{i * 1_000 + k}".translate(letters) for k in range(1_000)) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    encoder = token_ids.WordIds(PATH)
    tracemalloc.start()
    try:
        for part in packing._encoded(batch, encoder, 2):
            del part
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 20_000_000
