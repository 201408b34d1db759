"""Near duplicates by a grouped prefix join: word shingle sets with a Jaccard similarity of 0.8 or more, and no other.

Two linked sets that are both sorted by one order of all shingles have a shingle in common among their first
n - ceil(0.8 n) + 1, their prefixes, and k in common in prefixes that are longer by k - 1. This is used twice. By the order of
the hashes and with a prefix longer by a fifth of the set, only those sets go on that share so many of these shingles with
other sets. Of those, all shingles are counted, and rare ones come first in the order that the join itself uses, so that
a passage in many documents reaches few prefixes.

Documents with the same set are one class from the start. Classes with the same prefix and size are one group; groups
are paired by their prefixes, pairs are filtered by size and by how much can still follow the shared shingle, and the
classes of what remains are compared by their whole sets. Before that, a pair must pass a mask: each class has ``MASK`` bits in
which every shingle that others have, too, turns one over, so two sets differ by at least as many shingles as their masks do
by bits, besides those that are theirs alone. Sets that differ by more than a ninth of both sizes cannot be linked.

A class that is already connected with another one is not compared with it again: first every class is compared with the
leader of its group, and that with two leaders of each of its shingles, then with a few more where components are left apart.
What these leave open is joined in full, shingle by shingle, with all these conditions in the join: a hot shingle is dealt over
many tasks, and of its pairs only those come out whose masks are near. So a group of n copies costs about n comparisons, n
forms of one template that are not alike enough cost next to none, and no link between different components is lost.

Null text counts as empty. Texts may be of any length. Other columns are ignored. Documents without words are linked with nothing. Rows that repeat an id are documents of their
own but have one component, the smallest id of all. A null id is larger than any other. No documents, no rows.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logtally.llm.tables import components, look_up, only, saved, scratch, text_of, without
from logtally.llm.words import shingle_hashes, split_words

#: Similarity as a fraction of whole numbers, so that no rounding decides.
SIMILAR = (80, 100)
#: Entries that one shard holds, about, where shingles are counted.
SHARD_ENTRIES = 1_000_000
#: Shingles of the sets that are sent to the shards together, and ranked together; a longer set goes by itself.
CHUNK_ENTRIES = 1_000_000
#: Leaders of a shingle that classes are compared with before all the rest are.
LEADERS = 6
#: Bits of a class's mask, in words of 64.
MASK = 512
#: Entries of a shingle that one task sets against all of its entries, about.
SHARE = 10_000

_SIGNED = "doc_id long, n long, h1 long, h2 long, batch long, at int, own int, shard long, tokens binary, owners binary"
# White space between words.
_SPACE = " \t\n\x0b\f\r"

_SETS = "doc_id long, n long, h1 long, h2 long, chunk long, tokens binary"
_PIECES = "chunk long, first long, last long, shard long, tokens binary, counts binary"
_COUNTED = "chunk long, first long, last long, shard long, counts binary"
_RANKED = "cid long, gid string, n long, own long, mask array<long>, prefix array<long>, shared array<long>"

#: Owner of a shingle that several sets of a batch have: they are counted there.
_MANY = 2**16 - 1


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return tuple(np.array([whole >> 64, whole % 2**64], np.uint64).astype(np.int64).tolist())


def least_overlap(n: int) -> int:
    """The fewest shingles a set of n shares with any set it is linked with."""
    return -(-n * SIMILAR[0] // SIMILAR[1])


def extra(n: int) -> int:
    """By so many shingles the first filter's prefix is longer than one common shingle needs; at least so many are common then."""
    return max(1, n // 5)


def least_common(n: int) -> int:
    """Shingles of the longer prefix of a set of n that a linked set, of any size, has in its own."""
    return extra(least_overlap(n))


def _shard_of(tokens: np.ndarray, shards: int) -> np.ndarray:
    """The shards of shingles, by their high bits: in order if the shingles are."""
    return ((tokens >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes before all second ones: small ones take little space in a compressed shuffle."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _signed(shards: int):
    """Signatures of all sets, and the longer prefixes of each batch by shard, every shingle once.

    A shingle that several sets of the batch have is counted for them at once (``own``), so a frequent one is as many entries
    as there are batches.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for begin in range(0, len(whole), _MANY):
                yield from part(whole.iloc[begin : begin + _MANY])

    def part(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        sizes, marks, prefixes = [], [], []
        for text in batch["text"]:
            tokens = shingle_hashes(split_words(text))
            n = len(tokens)
            sizes.append(n)
            marks.append(_signature(tokens))
            prefixes.append(tokens[: n - least_overlap(n) + extra(n)])
        _, first = np.unique(np.array(marks, np.int64).reshape(-1, 2), axis=0, return_index=True)
        number = int.from_bytes(os.urandom(8), "little", signed=True)
        lengths = np.array([len(prefixes[i]) for i in first], np.int64)
        tokens = np.concatenate([prefixes[i] for i in first] or [np.zeros(0, np.uint64)])
        owners = np.repeat(first, lengths)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order].astype(np.uint16)
        new = np.r_[True, tokens[1:] != tokens[:-1]][: len(tokens)]
        same = ~new | np.r_[~new[1:], False][: len(tokens)]
        own = np.bincount(owners[same], minlength=len(batch))
        at = np.full(len(batch), -1)
        at[first] = first
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": sizes, "h1": [m[0] for m in marks], "h2": [m[1] for m in marks], "batch": number, "at": at, "own": own, "shard": None, "tokens": None, "owners": None})
        if not len(tokens):
            return
        owners[same] = _MANY
        tokens, owners = tokens[new], owners[new]
        shard = _shard_of(tokens, shards)
        edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
        # 32 bits tell the shingles of a shard apart well enough for a filter.
        low = tokens.astype(np.uint32)
        out = [(int(shard[i]), low[i:j].tobytes(), owners[i:j].tobytes()) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        rest = {c: None for c in ("doc_id", "n", "h1", "h2", "at", "own")}
        yield pd.DataFrame(rest | {"batch": number, "shard": [x[0] for x in out], "tokens": [x[1] for x in out], "owners": [x[2] for x in out]})[["doc_id", "n", "h1", "h2", "batch", "at", "own", "shard", "tokens", "owners"]]

    return run


def _shared(parts: pd.DataFrame) -> pd.DataFrame:
    """How many shingles of one shard each set shares with sets of other batches."""
    tokens = np.frombuffer(b"".join(parts["tokens"]), np.uint32)
    owners = np.frombuffer(b"".join(parts["owners"]), np.uint16).astype(np.int64)
    owners += np.repeat(np.arange(len(parts)) << 16, [len(x) // 2 for x in parts["owners"]])
    order = np.argsort(tokens)
    tokens, owners = tokens[order], owners[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]]
    same = (~new | np.r_[~new[1:], False]) & (owners % 2**16 != _MANY)
    found, count = np.unique(owners[same], return_counts=True)
    edges = np.searchsorted(found, np.arange(len(parts) + 1) << 16)
    cells = np.stack([found % 2**16, count], 1).astype("<i8")
    return pd.DataFrame({"batch": parts["batch"], "cells": [cells[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]})


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    """The counts of one batch's sets over all shards."""
    cells = np.frombuffer(b"".join(parts["cells"]), "<i8").reshape(-1, 2)
    common = np.bincount(cells[:, 0], cells[:, 1]).astype(np.int64)
    at = np.flatnonzero(common)
    return pd.DataFrame({"batch": parts["batch"].iloc[0], "at": at.astype(np.int32), "common": common[at]})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_hashes(split_words(text)) for text in batch["text"]]
        marks = [_signature(tokens) for tokens in sets]
        sizes = np.array([len(s) for s in sets], np.int64)
        numbers = np.frombuffer(os.urandom(8 * len(sets)), np.int64)
        # A set opens a chunk if it does not go into the last one.
        at, held = np.zeros(len(sets), np.int64), 0
        for i, n in enumerate(sizes):
            opens = held + n > CHUNK_ENTRIES
            held = n if opens else held + n
            at[i] = i if opens or not i else at[i - 1]
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": sizes, "h1": [m[0] for m in marks], "h2": [m[1] for m in marks], "chunk": numbers[at], "tokens": [s.tobytes() for s in sets]})


def _shingles(sets: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(sets["tokens"]), np.uint64)


def _pieces(shards: int):
    """The shingles of each chunk by shard, every one once and with its count; of a chunk that is cut, those of each piece.

    The rows of a chunk are in the order of their numbers, so a piece is all of its chunk from its first class to its last.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, sets in batch.groupby("chunk"):
                tokens, counts = np.unique(_shingles(sets), return_counts=True)
                shard = _shard_of(tokens, shards)
                edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
                cuts = list(zip(edges[:-1], edges[1:], strict=True))
                steps = [_planes(np.diff(tokens[i:j], prepend=np.uint64(0))) for i, j in cuts]
                yield pd.DataFrame({"chunk": chunk, "first": sets["cid"].iloc[0], "last": sets["cid"].iloc[-1], "shard": shard[edges[:-1]].astype(np.int64), "tokens": steps, "counts": [_planes(counts[i:j].astype("<u4")) for i, j in cuts]})

    return run


def _counted(parts: pd.DataFrame) -> pd.DataFrame:
    """Of one shard's shingles, in the order in which each piece has them, how many classes have them at all."""
    tokens = [np.cumsum(_numbers(x, "<u8"), dtype=np.uint64) for x in parts["tokens"]]
    ends = np.cumsum([len(x) for x in tokens])
    _, which = np.unique(np.concatenate(tokens), return_inverse=True)
    counts = np.bincount(which, np.concatenate([_numbers(x, "<u4") for x in parts["counts"]])).astype("<i8")[which]
    return parts[["chunk", "first", "last", "shard"]].assign(counts=[_planes(x) for x in np.split(counts, ends[:-1])])


def _ranked(sets: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """The classes of one chunk that can be linked: their group, size, shingles that no other has (``own``), mask, prefix and
    shared shingles, rare ones first."""
    sets = sets.sort_values("cid")
    rows = []
    for (first, last), parts in counted.groupby(["first", "last"]):
        piece = sets[sets["cid"].between(first, last)]
        flat = _shingles(piece)
        df = np.concatenate([_numbers(x, "<i8") for x in parts.sort_values("shard")["counts"]])
        df = df[np.unique(flat, return_inverse=True)[1]]
        end = 0
        for cid, n in zip(piece["cid"], piece["n"], strict=True):
            tokens, held = flat[end : end + n], df[end : end + n]
            end += n
            keep = held > 1
            # Shingles are in order already, so those that as many sets have stay so.
            shared = tokens[keep][np.argsort(held[keep], kind="stable")]
            own = n - len(shared)
            # The shingles that no other set has come first and need no entry.
            length = n - least_overlap(n) + 1 - own
            if len(shared) < least_overlap(n) or length <= 0:
                continue
            mask = np.packbits(np.bincount((shared % np.uint64(MASK)).astype(np.int64), minlength=MASK) % 2 == 1, bitorder="little").view("<i8")
            prefix = shared[:length].view(np.int64)
            gid = hashlib.md5(n.to_bytes(8, "little") + prefix.tobytes()).hexdigest()
            rows.append((cid, gid, n, own, mask, prefix, shared.view(np.int64)))
    return pd.DataFrame(rows, columns=["cid", "gid", "n", "own", "mask", "prefix", "shared"])


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n, h1, h2) of every document; the classes that may be linked, cid, h1, h2, low; those of ``_ranked``.

    The longer prefixes and the whole sets are removed as soon as they have been counted.
    """
    documents = text_of(documents)
    with scratch(documents.sparkSession) as keep:
        signed, heads = _candidates(documents, keep)
    with scratch(documents.sparkSession) as keep:
        # One text per class: of rows that share an id only those with the class's own set count.
        texts = only(documents, heads.select("low").distinct(), "low")
        sets = saved(texts.mapInPandas(_sets, _SETS).withColumn("cid", F.monotonically_increasing_id()), "sets")
        wanted = sets.select("cid", "doc_id", "h1", "h2").join(heads, ["h1", "h2"]).where(F.col("doc_id").eqNullSafe(F.col("low")))
        wanted = saved(wanted.groupBy("h1", "h2").agg(F.min("cid").alias("cid")), "wanted")
        if wanted.count() < sets.count():
            # Only ids that repeat come here.
            sets = sets.join(wanted.select("cid"), "cid", "left_semi")
            sets = saved(sets.repartition("chunk").sortWithinPartitions("chunk", "cid"), "sets")
        shards = max(1, math.ceil((sets.agg(F.sum("n")).first()[0] or 0) / SHARD_ENTRIES))
        counted = sets.select("cid", "chunk", "tokens").mapInPandas(_pieces(shards), _PIECES).groupBy("shard").applyInPandas(_counted, _COUNTED)
        chunks = sets.select("cid", "n", "chunk", "tokens").groupBy("chunk")
        ranked = keep(chunks.cogroup(counted.groupBy("chunk")).applyInPandas(_ranked, _RANKED), "ranked")
        return signed, keep(sets.select("cid", "h1", "h2").join(heads, ["h1", "h2"]), "heads"), ranked


def _candidates(documents: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, h1, h2) of every document; h1, h2, low of the classes that share enough of their longer prefixes."""
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, math.ceil(chars / 15 / SHARD_ENTRIES))
    both = saved(documents.mapInPandas(_signed(shards), _SIGNED), "prefixes")
    signed = both.where("shard IS NULL").select("doc_id", "n", "h1", "h2", "batch", "at", "own")
    blobs = both.where("shard IS NOT NULL").select("batch", "shard", "tokens", "owners")
    common = blobs.groupBy("shard").applyInPandas(_shared, "batch long, cells binary").where("length(cells) > 0")
    common = common.groupBy("batch").applyInPandas(_summed, "batch long, at int, common long")
    # Sets that a batch holds several times are counted with the first of them.
    near = signed.where("n > 0 AND at >= 0").join(common, ["batch", "at"], "left")
    least = f"greatest(1, ((n * {SIMILAR[0]} + {SIMILAR[1] - 1}) div {SIMILAR[1]}) div 5)"
    near = near.where(f"own + coalesce(common, 0) >= {least}").select("h1", "h2").distinct()
    classes = signed.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("low"))
    heads = keep(classes.join(near, ["h1", "h2"], "left_semi"), "heads")
    return keep(signed.select("doc_id", "n", "h1", "h2"), "signed"), heads


def _entries(ranked: DataFrame) -> DataFrame:
    """The prefixes of groups: gid, token, rest."""
    groups = ranked.groupBy("gid").agg(F.first("n").alias("n"), F.min("own").alias("own"), F.first("prefix").alias("prefix"))
    entries = groups.select("gid", "n", "own", F.posexplode("prefix").alias("at", "token"))
    return saved(entries.select("gid", "token", F.expr("n - own - at").alias("rest")), "entries")


def _verified(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked; shingles that no other set has cannot be common and only count.

    The joins are plain: adaptive execution splits what many are compared with.
    """
    pairs = saved(pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    both = pairs.join(shared.selectExpr("cid AS a", "n AS na", "shared AS sa"), "a")
    both = both.join(shared.selectExpr("cid AS b", "n AS nb", "shared AS sb"), "b")
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")).cast("long"))
    linked = f"common * {SIMILAR[1]} >= {SIMILAR[0]} * (na + nb - common)"
    return saved(both.where(linked).select("a", "b"), "linked")


def connected(ranked: DataFrame) -> DataFrame:
    """(node, component) of the classes that have a link."""
    shared, members, entries = ranked.select("cid", "n", "shared"), ranked.select("cid", "gid", "n", "own", "mask"), _entries(ranked)
    # Every class with the leader of its group, and every leader with two leaders of each shingle of its prefix: the
    # one with the fewest shingles of its own, which is likely to be what the others were made from, and any one.
    heads = saved(members.groupBy("gid").agg(F.min_by(F.struct("cid", "n", "own", "mask"), "cid").alias("b")), "heads")
    pairs = _alike(members.select("gid", F.struct("cid", "n", "own", "mask").alias("a")).join(heads, "gid"), rest=False)
    led = entries.join(heads, "gid").select("token", F.struct("b.*", "rest").alias("a"))
    order = F.xxhash64("a.cid")
    leads = led.groupBy("token").agg(F.min_by("a", F.struct("a.own", order)).alias("first"), F.max_by("a", order).alias("last"), F.count("*").alias("held"))
    leads = saved(leads.where("held > 1").select("token", F.array("first", "last").alias("leads")), "leads")
    near = _alike(led.join(leads, "token").select("a", F.explode("leads").alias("b")))
    found = saved(components(_verified(pairs.union(near), shared)), "components")
    still = _still_open(entries, members, found)
    # Where a large group is left, a few more leaders join most of what a single one did not.
    leads = F.array(*(F.min_by("a", F.xxhash64("a.cid", F.lit(seed))) for seed in range(LEADERS)))
    leads = saved(still.groupBy("token").agg(leads.alias("leads")), "leads")
    near = still.join(leads, "token").select("a", F.explode("leads").alias("b")).where("a.comp != b.comp")
    more = _verified(_alike(near), shared)
    if not more.isEmpty():
        found = _joined(found, more)
        still = _still_open(entries, members, found)
    # What the leaders leave open. A shingle's entries are dealt into shares, and each share meets all of them.
    shares = still.groupBy("token").agg(F.expr(f"cast(ceil(count(*) / {SHARE}) AS int)").alias("shares"))
    still = still.join(saved(shares, "shares"), "token")
    one = still.select("token", F.expr("cast(pmod(xxhash64(a.cid), shares) AS int)").alias("share"), "a")
    two = still.select("token", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.col("a").alias("b"))
    both = one.join(two.withColumnsRenamed({"token": "token_b", "share": "share_b"}), F.expr(f"token = token_b AND share = share_b AND a.comp < b.comp AND {_ALIKE} AND {_REACHABLE}"))
    more = _verified(both.selectExpr("a.cid AS a", "b.cid AS b"), shared)
    return found if more.isEmpty() else _joined(found, more)


#: Sets a and b of these sizes that differ by a ninth of both at most, as far as their masks and what each has alone can tell.
_ALIKE = (
    f"(a.own + b.own + {' + '.join(f'bit_count(a.mask[{i}] ^ b.mask[{i}])' for i in range(MASK // 64))}) * {SIMILAR[0] + SIMILAR[1]}"
    f" <= (a.n + b.n) * {SIMILAR[1] - SIMILAR[0]}"
)
#: Sets that first meet with so much left can still overlap enough: s / (1 + s) of both sizes.
_REACHABLE = f"least(a.rest, b.rest) * {sum(SIMILAR)} >= {SIMILAR[0]} * (a.n + b.n)"


def _alike(pairs: DataFrame, rest: bool = True) -> DataFrame:
    """Pairs of structs a and b that may be linked, as (a, b) of their classes."""
    near = pairs.where("a.cid != b.cid").where(_ALIKE)
    return (near.where(_REACHABLE) if rest else near).selectExpr("a.cid AS a", "b.cid AS b")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components with some more links."""
    return saved(components(links.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))), "components")


def _still_open(entries: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """token and a (cid, n, own, mask, comp, rest) of the shingles that more than one component has in its prefixes."""
    nodes = members.join(found.withColumnRenamed("node", "cid"), "cid", "left")
    nodes = saved(nodes.select("gid", "cid", "n", "own", "mask", F.coalesce("component", "cid").alias("comp")), "nodes")
    several = entries.join(nodes.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "gid")
    several = saved(several.groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("token"), "open")
    still = entries.join(several, "token").join(nodes, "gid")
    return saved(still.select("token", F.struct("cid", "n", "own", "mask", "comp", "rest").alias("a")), "still")


def _placed(documents: DataFrame) -> DataFrame:
    """doc_id, n, h1, h2, component_id, place of every row: its set's signature, and its component by id and for itself.

    ``place`` is null for a row without words, and else the same for all rows of a component and for no others.
    """
    with scratch(documents.sparkSession) as keep:
        signed, heads, ranked = _classes(documents)
        found = connected(ranked).withColumnRenamed("node", "cid")
        of_class = heads.join(found, "cid")
        lowest = saved(of_class.groupBy("component").agg(F.min("low").alias("component_id"), F.min(F.struct("h1", "h2")).alias("place")), "lowest")
        of_class = of_class.select("component", "h1", "h2").join(lowest, "component")
        classes = signed.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.count("*").alias("w"))
        classes = classes.join(of_class.select("h1", "h2", "component_id", "place"), ["h1", "h2"], "left")
        place = F.coalesce("place", F.struct("h1", "h2")).alias("place")
        id_of = F.when(F.col("place").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id")
        classes = saved(classes.select("h1", "h2", "w", id_of, place), "classes")
        rows = look_up(signed.where("n > 0"), classes, ["h1", "h2"], "w").select("doc_id", "n", "h1", "h2", "component_id", "place")
        none = signed.where("n = 0").select("doc_id", "n", "h1", "h2", F.col("doc_id").alias("component_id"))
        return keep(rows.unionByName(none, allowMissingColumns=True), "placed")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links lead to."""
    return _placed(documents).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the signatures of their sets."""
    for batch in batches:
        marks = [_signature(shingle_hashes(split_words(t or ""))) for t in batch.column("text").to_pylist()]
        own = [pa.array([m[i] for m in marks], pa.int64()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "__h1", "__h2"])


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, with all columns; documents without words all stay.

    Where rows share that id, or none of the component has one, one row of them stays: one with the smallest signature.
    """
    rows = _placed(documents).where("n > 0").groupBy("doc_id", "h1", "h2", "place").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h1", "h2")).alias("first")
    rows = saved(rows, "rows")
    # One row per component, of ids and numbers: no component is moved whole.
    heads = rows.groupBy("place").agg(first).selectExpr("first.doc_id AS head", "first.h1 AS head1", "first.h2 AS head2", "true AS stays")
    rows = rows.join(heads, F.expr("doc_id <=> head AND h1 = head1 AND h2 = head2"), "left")
    rows = saved(rows.select("doc_id", "h1", "h2", "copies", F.coalesce("stays", F.lit(False)).alias("stays")), "stays")
    # By id alone where that says it all. Else, of ids that several rows have, each row's own set decides.
    by_id = saved(rows.groupBy("doc_id").agg(F.max("stays").alias("some"), F.sum("copies").alias("copies")).where("NOT some OR copies > 1"), "ids")
    wordless = F.rtrim(F.coalesce("text", F.lit("")), F.lit(_SPACE)) == ""
    plain = documents.where(~wordless)
    left = without(plain, by_id, "doc_id").unionByName(documents.where(wordless))
    mixed = by_id.where("some")
    if mixed.isEmpty():
        return left
    schema = StructType([*documents.schema.fields, StructField("__h1", LongType()), StructField("__h2", LongType())])
    stay = rows.where("stays").select(F.col("doc_id").alias("__id"), F.col("h1").alias("__own1"), F.col("h2").alias("__own2"))
    again = only(plain, mixed, "doc_id").mapInArrow(_marked, schema)
    again = again.join(stay, again["doc_id"].eqNullSafe(stay["__id"]) & (again["__h1"] == stay["__own1"]) & (again["__h2"] == stay["__own2"]), "left_semi")
    again = again.dropDuplicates(["doc_id", "__h1", "__h2"])
    return left.unionByName(again.select(documents.columns))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.reach)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""
