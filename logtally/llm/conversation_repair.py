"""Cheapest repair of a conversation's structure, by block tables in the manner of the Four Russians.

A good conversation is empty, or an optional system row and then pairs of a user's and an assistant's row. Each row is kept
(0), given the role that the place asks for (3) or deleted (4, a must for blank rows and copies of earlier ones); an empty row
can be inserted anywhere (3), and a row that breaks off costs 3 more unless it goes. Of the cheapest repairs, the one whose
letters D, I, K, R, in order of the rows, come first in ASCII is taken. The letters fix the roles: what comes next is always known.

What a rest of rows costs depends on what stood before, one of four states, so it is a vector of four costs. Less its least
one, it is one of a few dozen vectors, whatever the conversation. A row has one of nine symbols: its role, if it breaks off, if
it must go. For every vector behind every block of ``BLOCK`` symbols a table holds the vector in front of it and what it adds.
A conversation is gone through from its end with one lookup per block; only the vectors between blocks are kept. Then, from its
start, each block is expanded backward once more, and its letters are read off forward, the least of the cheapest each time.

In Spark, rows lose their texts first: equal ones (role, text, turn) are one row with a number, then come a shuffle by
(conversation, role, text), which finds the copies, and one by ranges of (conversation, turn), which cuts a conversation with a
third of all rows over many tasks. Each task turns its part into strings of a byte per row. A conversation's strings, no longer
than the letters it gets, meet in one task. Texts are moved once, to apply the letters in a stream that holds no conversation.

Null roles and texts count as one space, and rows come by turn, nulls first, then role, then the digest of the text. A role
is what its first character says, in lower case; others, and the empty role, can't be kept. A null id is a conversation like
any other. Texts may be of any length; repeated rows are copies; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import saved

#: Symbols of a block, and rows of a string of symbols.
BLOCK = 3
PIECE = 1 << 16
REROLED, DELETED, INSERTED, BROKEN = 3, 4, 3, 3
_ROLES = "sua"
_FULL = ("system", "user", "assistant")
#: States: nothing yet, behind a system row, a user's, an assistant's. What a kept role leads to, and what is due next.
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
_DUE = (2, 2, 3, 2)
_GONE = 8
_SYMBOLS = 9
#: What is left to pay at the end: from a user's row an answer, from a system row a pair.
_END = (0, 2 * INSERTED, INSERTED, 0)

_SPACE = " \t\n\x0b\f\r"
_KEY = "turn long, role string, digest binary"
_FACTS = "blank long, duplicate long, truncated long, illegal long, first string, last string, lowest long, highest long, turns long, end_turn long"


def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """The costs in front of a row, given those behind it."""
    rows = []
    for state in range(4):
        costs = [DELETED + behind[state]]
        if symbol != _GONE:
            more = BROKEN * (symbol % 2)
            costs.append(REROLED + more + behind[_DUE[state]])
            if (state, symbol // 2) in _KEPT:
                costs.append(more + behind[_KEPT[state, symbol // 2]])
        rows.append(min(costs))
    two, three = min(rows[2], INSERTED + rows[3]), min(rows[3], INSERTED + rows[2])
    return (min(rows[0], INSERTED + two), min(rows[1], INSERTED + two), two, three)


class _Tables:
    """Vectors less their least cost, and for each of them and each block: the vector in front, and what is added."""

    def __init__(self, block: int = BLOCK) -> None:
        self.vectors, numbers, single, waiting = [_END], {_END: 0}, [], deque([_END])
        while waiting:
            vector, row = waiting.popleft(), []
            for symbol in range(_SYMBOLS):
                front = _before(symbol, vector)
                least = min(front)
                front = tuple(c - least for c in front)
                if front not in numbers:
                    numbers[front] = len(numbers)
                    self.vectors.append(front)
                    waiting.append(front)
                row.append((numbers[front], least))
            single.append(row)
        self.single, one = single, np.array(single, np.int64)
        front, added = one[:, :, 0], one[:, :, 1]
        for _ in range(block - 1):
            # [vector, block behind, symbol in front], whose code is the symbol and then the block.
            paid = one[:, :, 1][front] + added[:, :, None]
            front, added = (x.transpose(0, 2, 1).reshape(len(single), -1) for x in (one[:, :, 0][front], paid))
        self.front, self.added = front.tolist(), added.tolist()


@lru_cache(maxsize=1)
def _tables() -> _Tables:
    return _Tables()


@lru_cache(maxsize=1 << 16)
def _expanded(behind: int, symbols: bytes, state: int) -> tuple[str, int]:
    """The letters of a block's rows and the state they lead to, given the vector behind the block."""
    vectors = [_tables().vectors[behind]]
    for symbol in reversed(symbols):
        vectors.append(_before(symbol, vectors[-1]))
    vectors.reverse()
    letters = []
    for i, symbol in enumerate(symbols):
        here, after = vectors[i], vectors[i + 1]
        more = BROKEN * (symbol % 2)
        while True:
            if DELETED + after[state] == here[state]:
                letters.append("D")
            elif INSERTED + here[_DUE[state]] == here[state]:
                letters.append("I")
                state = _DUE[state]
                continue
            elif symbol != _GONE and (state, symbol // 2) in _KEPT and more + after[_KEPT[state, symbol // 2]] == here[state]:
                letters.append("K")
                state = _KEPT[state, symbol // 2]
            else:
                letters.append("R")
                state = _DUE[state]
            break
    return "".join(letters), state


def _blocks(symbols: bytes) -> list[bytes]:
    return [symbols[i : i + BLOCK] for i in range(0, len(symbols), BLOCK)]


def cheapest(pieces: list[bytes]) -> tuple[int, list[str]]:
    """What a conversation costs, given as strings of symbols, and the letters of each string."""
    tables = _tables()
    vector = cost = 0
    behind: list[list[int]] = []
    for piece in reversed(pieces):
        marks = []
        for block in reversed(_blocks(piece)):
            marks.append(vector)
            if len(block) == BLOCK:
                code = 0
                for symbol in block:
                    code = code * _SYMBOLS + symbol
                vector, more = tables.front[vector][code], tables.added[vector][code]
                cost += more
                continue
            for symbol in reversed(block):
                vector, more = tables.single[vector][symbol]
                cost += more
        behind.append(marks[::-1])
    cost += tables.vectors[vector][0]
    state, letters = 0, []
    for piece, marks in zip(pieces, reversed(behind), strict=True):
        written = []
        for block, mark in zip(_blocks(piece), marks, strict=True):
            found, state = _expanded(mark, block, state)
            written.append(found)
        letters.append("".join(written))
    if letters:
        letters[-1] += "I" * (_END[state] // INSERTED)
    return cost, letters


_short = lru_cache(maxsize=1 << 12)(lambda symbols: cheapest([symbols]))


def _rows(turns: DataFrame) -> DataFrame:
    """The columns that count, without nulls in role and text, and the text's digest."""
    fill = lambda name: F.coalesce(name, F.lit(" ")).alias(name)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), fill("role"), fill("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _symbols(turns: DataFrame) -> DataFrame:
    """A row per conversation, turn, role and text: how many there are, if one of them is the first, blank, broken."""
    end = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    key = ["conv_id", "turn", "role", "digest"]
    rows = _rows(turns).select(*key, (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("broken"))
    rows = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("broken").alias("broken"))
    same = "row_number() OVER (PARTITION BY conv_id, role, digest ORDER BY turn ASC NULLS FIRST) = 1 AS new"
    return rows.selectExpr(*key, "n", "blank", "broken", same)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to strings of symbols, each with its first row's key and the facts of its rows."""
    schema = _arrow(f"conv_id long, {_KEY}, seq long, symbols binary, {_FACTS}")
    out: list[tuple] = []
    conv: object = _pieces
    key, symbols, seq = None, bytearray(), 0
    blank = duplicate = truncated = illegal = turns = 0
    first = last = lowest = highest = end_turn = None

    def close() -> None:
        if symbols:
            out.append((conv, *key, seq, bytes(symbols), blank, duplicate, truncated, illegal, first, last, lowest, highest, turns, end_turn))

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv_id, turn, role, digest, n, is_blank, is_broken, new in zip(*columns, strict=True):
            initial = role[:1]
            own = _ROLES.find(initial) if initial else -1
            symbol = _GONE if is_blank or not new else 2 * (own if own >= 0 else 3) + is_broken
            for i in range(n):
                if conv_id != conv or len(symbols) >= PIECE:
                    close()
                    if conv_id != conv:
                        seq, conv = 0, conv_id
                    key, symbols, seq = (turn, role, digest), bytearray(), seq + 1
                    blank = duplicate = truncated = illegal = turns = 0
                    first, last, lowest, highest = initial, None, turn, turn
                    end_turn = None
                symbols.append(_GONE if i else symbol)
                blank += is_blank
                duplicate += not is_blank and (i > 0 or not new)
                truncated += not is_blank and i == 0 and new and is_broken
                if last is not None:
                    illegal += last + initial not in ("su", "ua", "au")
                if turn is not None:
                    turns += turn != end_turn
                    lowest = turn if lowest is None else lowest
                    highest = turn
                last, end_turn = initial, turn
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema)
                out = []
    close()
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LETTERS = f"array<struct<{_KEY.replace(' ', ':')}, seq:long, letters:string>>".replace(",:", ",")


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations as lists of pieces to their facts, costs and letters."""
    letter = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("seq", pa.int64()), ("letters", pa.string())])
    schema = _arrow(_AUDIT).append(pa.field("letters", pa.list_(letter)))
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            pieces = row["pieces"]
            symbols = [p["symbols"] for p in pieces]
            cost, letters = _short(symbols[0]) if len(symbols) == 1 and len(symbols[0]) <= 64 else cheapest(symbols)
            low = [p["lowest"] for p in pieces if p["lowest"] is not None]
            turns = sum(p["turns"] for p in pieces)
            illegal = sum(p["illegal"] for p in pieces)
            for a, b in zip(pieces, pieces[1:], strict=False):
                # A turn that goes on behind the cut was counted on both sides of it.
                turns -= b["turn"] is not None and a["end_turn"] == b["turn"]
                illegal += a["last"] + b["first"] not in ("su", "ua", "au")
            gaps = max(p["highest"] for p in pieces if p["highest"] is not None) - min(low) + 1 - turns if low else 0
            facts = {name: sum(p[name] for p in pieces) for name in ("blank", "duplicate", "truncated")}
            places = [{k: p[k] for k in ("turn", "role", "digest", "seq")} | {"letters": x} for p, x in zip(pieces, letters, strict=True)]
            rows.append({"conv_id": row["conv_id"], "gaps": gaps, **facts, "illegal": illegal, "cost": cost, "audit": "".join(letters), "letters": places})
        yield pa.RecordBatch.from_pylist(rows, schema)


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation with rows: gaps, blank, duplicate, truncated, illegal, cost, audit, and the letters by place."""
    key = ["conv_id", "turn", "role", "digest"]
    ordered = saved(_symbols(turns), "symbols").repartitionByRange(*key).sortWithinPartitions(*key)
    pieces = ordered.mapInArrow(_pieces, f"conv_id long, {_KEY}, seq long, symbols binary, {_FACTS}")
    whole = F.sort_array(F.collect_list(F.struct(*[c for c in pieces.columns if c != "conv_id"]))).alias("pieces")
    listed = pieces.groupBy("conv_id").agg(whole)
    return saved(listed.mapInArrow(_audited, f"{_AUDIT}, letters {_LETTERS}"), "audits")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A stream of letters and of the rows they are for to repaired rows."""
    schema = _arrow("conv_id long, place long, role string, text string")
    conv: object = _applied
    due: deque[str] = deque()
    state = place = 0
    out: list[dict] = []

    def add(role: str, text: str) -> None:
        nonlocal place
        out.append({"conv_id": conv, "place": place, "role": role, "text": text})
        place += 1

    def insert() -> None:
        nonlocal state
        while due and due[0] == "I":
            due.popleft()
            state = _DUE[state]
            add(_FULL[state - 1], "")

    for batch in batches:
        for conv_id, role, letters, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "letters", "text")), strict=True):
            if conv_id != conv:
                insert()
                conv, state, place, due = conv_id, 0, 0, deque()
            if letters is not None:
                due.extend(letters)
                continue
            insert()
            letter = due.popleft()
            if letter == "K":
                state = _KEPT[state, _ROLES.index(role[0])]
                add(role, text)
            elif letter == "R":
                state = _DUE[state]
                add(_FULL[state - 1], text)
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    insert()
    yield pa.RecordBatch.from_pylist(out, schema)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place from 0, role, text. A conversation's rows stand together, in order."""
    rows = _rows(turns).select("conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("seq"), F.lit(None).cast("string").alias("letters"), "text")
    places = audited.select("conv_id", F.explode("letters").alias("p"))
    places = places.select("conv_id", "p.turn", "p.role", "p.digest", F.lit(0), "p.seq", "p.letters", F.lit(None))
    order = ["conv_id", "turn", "role", "digest", "kind", "seq"]
    stream = rows.union(places).repartition("conv_id").sortWithinPartitions(*order)
    return stream.select("conv_id", "role", "letters", "text").mapInArrow(_applied, "conv_id long, place long, role string, text string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per conversation of its rows, as they come."""
    schema = _arrow("conv_id long, repaired_sha256 string")
    conv, digest = None, None
    for batch in batches:
        out = []
        for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not place:
                if digest:
                    out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_pylist(out, schema)
    if digest:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema)


def repair_report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per id of ``conversations``: the audit of its ``turns``, and the digest of what the repair makes of them."""
    audited = audits(turns)
    digests = repaired(turns, audited).mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), *[F.lit(0).cast("long").alias(c) for c in counts], F.lit("").alias("audit"), F.lit("").alias("repaired_sha256"))
    facts = audited.select("conv_id", *counts, "audit", F.lit(""))
    hashes = digests.select("conv_id", *[F.lit(0) for _ in counts], F.lit(""), "repaired_sha256")
    every = ids.union(facts).union(hashes).groupBy("conv_id")
    # One of a conversation's rows has the value; a sum is that value, too, and the longest text is the one that isn't empty.
    report = every.agg(*[F.sum(c).alias(c) for c in counts], F.max("audit").alias("audit"), F.max("repaired_sha256").alias("found"))
    nothing = hashlib.sha256().hexdigest()
    return report.select("conv_id", *counts, "audit", F.when(F.col("found") == "", nothing).otherwise(F.col("found")).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults by a checksum of their place: dropped, emptied, cut off, repeated, given a role."""
    named = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    rows = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"), fault.alias("fault")).where("fault != 0")
    text = _case({1: F.lit(""), 2: F.regexp_replace("text", "[.!?]", "")}, F.col("text"))
    role = _case({4: F.lit("user")}, F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def _case(values: dict[int, Column], other: Column) -> Column:
    for fault, value in values.items():
        other = F.when(F.col("fault") == fault, value).otherwise(other)
    return other


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(conversations, damaged(conversations))


def _sql() -> str:
    """The same costs by a recursive query from the first row on; CRC-32 is worked out bit by bit."""
    paid = lambda s, cost, letter, row="''": f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 'r': {s}.r || {row}}}"
    user, assistant = ("'user:' || chr(10)", "'assistant:' || chr(10)")
    far = "{'c': 1000000000, 'a': '', 'r': ''}"
    kept = "role || ':' || text || chr(10)"
    least = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    keep = lambda s, initial: f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {paid(s, 'more', 'K', kept)} ELSE {far} END"
    rerole = lambda s, role: f"""CASE WHEN NOT gone THEN {paid(s, f"{REROLED} + more", 'R', f"'{role}:' || text || chr(10)")} ELSE {far} END"""
    gone = lambda s: paid(s, DELETED, "D")
    to_user = lambda f: ", ".join(f("s", s) for s in ("s0", "s1", "s3"))
    step2 = least(gone("s2"), to_user(lambda _, s: keep(s, "u")), to_user(lambda _, s: rerole(s, "user")))
    inserted2 = least("s2", to_user(lambda _, s: paid(s, INSERTED, "I", user)))
    inserted3 = least("s3", paid("s2", INSERTED, "I", assistant))
    closed = lambda source: f"SELECT * REPLACE ({inserted3} AS s3) FROM (SELECT * REPLACE ({inserted2} AS s2) FROM {source})"
    crc = """(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(key) + 1), lambda i: CAST(ord(substr(key, i, 1)) AS BIGINT))),
   lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)) % 20"""
    return f"""WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
fault AS (SELECT *, {crc} AS fault FROM source),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fault, range(2) AS t(copy) WHERE fault != 0 AND (copy = 0 OR fault = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM damaged),
marked AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ending,
         pos > min(pos) OVER (PARTITION BY conv_id, role, text) AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
rows AS MATERIALIZED (
  SELECT *, ending = '' AS blank, ending != '' AND again AS duplicate,
         ending != '' AND NOT again AND right(ending, 1) NOT IN ('.', '!', '?') AS truncated,
         ending = '' OR again AS gone, CASE WHEN truncated THEN {BROKEN} ELSE 0 END AS more FROM marked),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (pos > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM rows GROUP BY conv_id),
paths AS (
  {closed(f"(SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': 0, 'a': '', 'r': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3 FROM facts)")}
  UNION ALL
  {closed(f'''(SELECT conv_id, pos, {gone('s0')} AS s0, {least(gone('s1'), keep('s0', 's'))} AS s1, {step2} AS s2,
    {least(gone('s3'), keep('s2', 'a'), rerole('s2', 'assistant'))} AS s3
    FROM (SELECT p.s0, p.s1, p.s2, p.s3, r.* FROM paths AS p JOIN rows AS r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1))''')}),
best AS (SELECT p.conv_id, {least('p.s0', 'p.s3')} AS b FROM paths AS p JOIN facts AS f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.pos)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit,
       sha256(CASE WHEN coalesce(b.r, '') = '' THEN '' ELSE left(b.r, length(b.r) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN facts AS f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id"""


OP12_SQL = _sql()
