"""Conversation structure repair: cheapest edits that give a well-formed sequence of roles, decided by integer minima."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE
from tidemark.operators.ordered import row_index
from tidemark.session import stage

#: Rows of a conversation that one call of the dynamic program takes; longer conversations are several such blocks.
BLOCK_ROWS = 1024
#: Output rows of one Arrow batch.
BATCH_ROWS = 2048

#: Cost of each edit, by its initial.
COSTS = {"Keep": 0, "Rerole": 3, "Delete": 4, "Insert": 3}
TRUNCATED_COST = 3
#: Letters of the audit in ASCII order; digit 0 of a weight stands for its end.
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4

#: What has been put out so far: nothing, a system row, a user row last, an assistant row last. From each state an
#: initial leads on to one other; only nothing and an assistant row may end a conversation.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (NOTHING, ASSISTANT)
#: The role that a state calls for next, put in by Insert and Rerole.
CALLS = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}

FINE, TRUNCATED, GONE = 0, 1, 2


class Weights:
    """Whole numbers that stand for edits: high digits the cost, below them one digit of three bits for each place of the
    audit, the first place highest and places past its end zero, and the number of letters lowest. Adding an edit adds its
    cost and its letter in the next place, so the smaller number is the cheaper audit, and of equally cheap ones the one
    that is less in ASCII order."""

    def __init__(self, rows: int) -> None:
        self.places = 3 * rows + 2  # at most two inserts in each gap
        self.count = self.places.bit_length()
        self.high = 3 * self.places + self.count

    def add(self, weight: int | None, letter: int, cost: int) -> int | None:
        if weight is None:
            return None
        place = self.high - 3 * (1 + (weight & ((1 << self.count) - 1)))
        return weight + (cost << self.high) + (letter << place) + 1

    def read(self, weight: int) -> tuple[int, str]:
        n, digits = weight & ((1 << self.count) - 1), weight >> self.count
        return weight >> self.high, "".join(LETTERS[digits >> 3 * (self.places - 1 - i) & 7] for i in range(n))


def least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def cheapest(initials: list[str], faults: list[int], start: int) -> list[tuple[int, str] | None]:
    """Cost and audit of the cheapest edits that lead from ``start`` to each state, by one pass over the rows: the graph's
    nodes are the gaps between rows by state, its arcs the edits."""
    weights = Weights(len(initials))
    insert, truncated = COSTS["Insert"], TRUNCATED_COST

    def gap(at: list) -> list:
        user = least(at[USER], *(weights.add(at[q], INSERT, insert) for q in (NOTHING, SYSTEM, ASSISTANT)))
        return [at[NOTHING], at[SYSTEM], user, least(at[ASSISTANT], weights.add(user, INSERT, insert))]

    at: list = [0 if q == start else None for q in range(4)]
    for initial, fault in zip(initials, faults):
        at = gap(at)
        to = [weights.add(w, DELETE, COSTS["Delete"]) for w in at]
        if fault != GONE:
            more = truncated if fault == TRUNCATED else 0
            for q, r in STEPS.get(initial, {}).items():
                to[r] = least(to[r], weights.add(at[q], KEEP, COSTS["Keep"] + more))
            for q, r in CALLS.items():
                to[r] = least(to[r], weights.add(at[q], REROLE, COSTS["Rerole"] + more))
        at = to
    return [None if w is None else weights.read(w) for w in gap(at)]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def batches_from(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


PATHS = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("start", pa.int32()), ("finish", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def paths_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, start, finish, cost, audit) from rows (conv, block, rn, initial, fault) sorted by them. The first
    block starts with nothing; a later one may start in any state."""

    def paths() -> Iterator[tuple]:
        for (conv, block), rows in groupby(rows_of(batches), lambda r: r[:2]):
            _, _, _, initials, faults = zip(*rows)
            for start in range(4) if block else (NOTHING,):
                for finish, path in enumerate(cheapest(initials, faults, start)):
                    if path is not None:
                        yield conv, block, start, finish, *path

    return batches_from(paths(), PATHS)


CHOSEN = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("start", pa.int32()), ("finish", pa.int32()), ("before", pa.int64()), ("total", pa.int64())])


def joined_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, start, finish, before, total): the path taken through each block, the rows put out before it and by the
    whole conversation; from paths sorted by conversation and block.

    The same minimum over the blocks' paths. Audits of equal cost never begin one another (a longer one with the same beginning
    has more inserts), so the best path to a state is the best one to any state before it, carried on. Of the audits so
    far only what follows their common beginning is held.
    """

    def chosen() -> Iterator[tuple]:
        for conv, blocks in groupby(rows_of(batches), lambda r: r[0]):
            at = {NOTHING: (0, "", 0, None)}  # cost, audit past the common beginning, rows out, path
            for block, paths in groupby(blocks, lambda r: r[1]):
                to: dict = {}
                for _, _, start, finish, cost, audit in paths:
                    if start in at:
                        c, text, out, path = at[start]
                        here = (c + cost, text + audit)
                        if finish not in to or here < to[finish][:2]:
                            to[finish] = (*here, out + len(audit) - audit.count("D"), (path, block, start, finish, out))
                common = len(commonprefix([v[1] for v in to.values()]))
                at = {q: (v[0], v[1][common:], *v[2:]) for q, v in to.items()}
            _, _, total, path = min((at[q] for q in ENDS if q in at), key=lambda v: v[:2])
            while path is not None:
                path, block, start, finish, before = path
                yield conv, block, start, finish, before, total

    return batches_from(chosen(), CHOSEN)


EDITS = pa.schema([("conv", pa.string()), ("rn", pa.int64()), ("letter", pa.string()), ("pos", pa.int64()), ("role", pa.string())])


def edits_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, rn, letter, pos, role) of each letter of (conv, block, audit, before, total): the row it falls on (NULL for
    inserts), the place it takes in the result (NULL for deletions) and the role that stands there."""
    for batch in batches:
        for conv, block, audit, before, total in zip(*(c.to_pylist() for c in batch.columns)):
            letters = np.frombuffer(audit.encode(), np.uint8)
            used, put = letters != ord("I"), letters != ord("D")
            rn, pos = block * BLOCK_ROWS + np.cumsum(used) - 1, before + np.cumsum(put)
            # s?(ua)+: a system row makes the number of rows odd.
            user = (pos - total % 2) % 2 == 1
            yield pa.RecordBatch.from_arrays([
                pa.array([conv] * len(letters), pa.string()), pa.array(rn, mask=~used), pa.array(list(audit), pa.string()),
                pa.array(pos, mask=~put), pa.array(np.where(user, "user", "assistant").astype(object), pa.string(), mask=~put),
            ], schema=EDITS)


def in_order(df: DataFrame, by: list[str], within: list[str]) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by, *within)


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int' if f.type == pa.int32() else 'string'}" for f in schema)


NOT_SPACE = f"[^{SPACE}]"


def key_of(conv_id: Column) -> Column:
    """A text for each conversation, and one for no conversation."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def id_of(conv: Column, kind) -> Column:
    return F.when(conv != "", F.substr(conv, F.lit(2))).cast(kind)


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``: blank (nothing but white space), duplicate (an earlier row of the conversation has this role and
    text), truncated (the last character that is no white space is none of ``.!?``); the first that holds, else NULL."""
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    marked = rows.withColumn("said", said)
    firsts = marked.groupBy("conv", "said").agg(F.min("rn").alias("rn")).select(F.col("conv").alias("__conv"), F.col("rn").alias("__rn"))
    # One row per conversation and place on either side: no key is hot, however often a text is repeated.
    joined = marked.join(firsts, (F.col("conv") == F.col("__conv")) & (F.col("rn") == F.col("__rn")), "left")
    return joined.withColumn("fault", (
        F.when(~F.rlike("text", F.lit(NOT_SPACE)), "blank").when(F.col("__rn").isNull(), "duplicate")
        .when(~F.rlike("text", F.lit(rf"[.!?][{SPACE}]*\z")), "truncated")
    )).drop("said", "__conv", "__rn")


def with_illegal(rows: DataFrame) -> DataFrame:
    """Adds ``illegal``: whether the initials of the row before and of this one are neither su nor ua nor au. Blocks are
    compared each in itself, and their first rows with a copy of the last row before."""
    block = F.floor(F.col("rn") / BLOCK_ROWS)
    own = F.explode(F.when((F.col("rn") + 1) % BLOCK_ROWS == 0, F.array(block, block + 1)).otherwise(F.array(block)))
    copied = rows.withColumn("initial", F.substring("role", 1, 1)).withColumn("block", own)
    pair = F.concat(F.lag("initial").over(Window.partitionBy("conv", "block").orderBy("rn")), "initial")
    told = copied.withColumn("illegal", F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
    return told.filter(F.floor(F.col("rn") / BLOCK_ROWS) == F.col("block"))


class Repair:
    """What ``repair`` found: ``conversations`` one row each, ``rows`` the repaired rows."""

    def __init__(self, conversations: DataFrame, rows: DataFrame) -> None:
        self.conversations, self.rows = conversations, rows


def repair(
    rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> Repair:
    """Repairs the roles of conversations with the fewest costs.

    ``conversations`` has conv_id, gaps (turns missing between the smallest and the largest), the numbers of blank,
    duplicate and truncated rows and of illegal neighbours, cost, and audit: the initials of the edits in order. Edits are Keep
    (0), Rerole (3), Delete (4; blank and duplicate rows must go) and Insert of a row without text (3); truncated rows that stay
    cost 3 more. They give role initials ``(s?(ua)+)?``; of equally cheap audits the least in ASCII order is taken. ``rows`` has
    conv_id, pos (from 1), role, text and edit of the repaired rows.

    Rows are taken by turn, NULL first, rows of one turn by role and text. A NULL conversation is one of its own; NULL
    roles and texts are read as one space, so such texts are blank. Repeated rows are duplicates. Gaps ignore NULL turns, and
    stop at the largest 64-bit number. Texts of any length are only read, not gathered. Other columns are ignored. An empty
    table gives no rows.

    A conversation is cut into blocks of ``BLOCK_ROWS`` rows. Each block finds the cheapest edits from every state to every
    state, and the blocks are joined by the same minimum, so a conversation with a third of all rows is many tasks. Only the
    blocks' paths, not their rows, meet in one task, as a stream.
    """
    kind = rows.schema[conv_col].dataType
    given = rows.select(key_of(F.col(conv_col)).alias("conv"), F.col(turn_col).cast("long").alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(name) for c, name in ((role_col, "role"), (text_col, "text"))])
    placed = stage(row_index(given, ["turn", "role", "text"], ["conv"]), "conversation-rows")
    facts = stage(with_illegal(with_faults(placed)).select("conv", "turn", "block", "rn", "initial", "fault", "illegal"), "conversation-facts")
    fault = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", TRUNCATED).otherwise(FINE)
    slim = facts.select("conv", "block", "rn", "initial", fault.alias("fault"))
    paths = stage(in_order(slim, ["conv", "block"], ["rn"]).mapInArrow(paths_of_blocks, ddl(PATHS)), "conversation-paths")
    chosen = in_order(paths, ["conv"], ["block"]).mapInArrow(joined_blocks, ddl(CHOSEN))
    taken = stage(chosen.join(paths, ["conv", "block", "start", "finish"]), "conversation-edits")

    listed = F.array_sort(F.collect_list(F.struct("block", "audit")))
    edits = taken.groupBy("conv").agg(F.sum("cost").alias("cost"), F.concat_ws("", F.transform(listed, lambda x: x["audit"])).alias("audit"))
    turns = facts.groupBy("conv", "turn").agg(
        *[F.count_if(F.col("fault") == c).alias(c) for c in ("blank", "duplicate", "truncated")], F.count_if("illegal").alias("illegal"))
    wide = F.max(F.col("turn").cast("decimal(38,0)")) - F.min(F.col("turn").cast("decimal(38,0)")) + 1 - F.count("turn")
    counts = turns.groupBy("conv").agg(
        F.least(F.coalesce(wide, F.lit(0)), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    whole = counts.join(edits, "conv").select(id_of(F.col("conv"), kind).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    letters = taken.select("conv", "block", "audit", "before", "total").mapInArrow(edits_of_blocks, ddl(EDITS))
    put = letters.filter("pos IS NOT NULL").withColumnRenamed("role", "called")
    stay = put.filter("rn IS NOT NULL").join(placed.select("conv", "rn", "role", "text"), ["conv", "rn"]).select(
        "conv", "pos", F.when(F.col("letter") == "R", F.col("called")).otherwise(F.col("role")).alias("role"), "text", "letter")
    new = put.filter("rn IS NULL").select("conv", "pos", F.col("called").alias("role"), F.lit("").alias("text"), "letter")
    named = stay.unionByName(new).select(id_of(F.col("conv"), kind).alias("conv_id"), "pos", "role", "text", F.col("letter").alias("edit"))
    return Repair(whole, named)


HASHES = pa.schema([("conv", pa.string()), ("sha256", pa.string())])


def digests(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of each conversation in order of ``pos``, joined by line feeds. A hash takes
    its text from the beginning on, so a conversation is one task here, but as a stream: no more than a batch is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes() -> Iterator[tuple]:
            for conv, lines in groupby(rows_of(batches), lambda r: r[0]):
                whole, parted = hashlib.sha256(), ""
                for _, _, role, text in lines:
                    whole.update(f"{parted}{role}:{text}".encode())
                    parted = "\n"
                yield conv, whole.hexdigest()

        return batches_from(hashes(), HASHES)

    kind = rows.schema[conv_col].dataType
    slim = rows.select(key_of(F.col(conv_col)).alias("conv"), "pos", "role", "text")
    hashed = in_order(slim, ["conv"], ["pos"]).mapInArrow(run, ddl(HASHES))
    return hashed.select(id_of(F.col("conv"), kind).alias("conv_id"), "sha256")


def damage(rows: DataFrame) -> DataFrame:
    """Spoils rows (conv_id, turn, role, text) by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    removes ``.!?`` from it, 3 repeats the row, 4 makes its role user. NULLs are read as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    way = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(role).alias("role"),
        F.when(way == 1, "").when(way == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(way == 0, 0).when(way == 3, 2).otherwise(1).alias("times"))
    return hurt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("times", F.lit(1))))).filter("times > 0").drop("times", "copy")


def sql() -> str:
    """Damage and repair of the table ``conversations`` in DuckDB's SQL: the dynamic program runs from the last row back."""
    table = []  # CRC-32 by half bytes, low half first
    for i in range(16):
        c = i
        for _ in range(4):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        table.append(c)

    def edit(letter: str, cost: str, state: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a}} END"

    keep, rerole = "more", f"{COSTS['Rerole']} + more"
    follow = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}

    def row(q: int) -> str:
        kept = [f"CASE WHEN NOT gone AND initial = '{c}' THEN {edit('K', keep, f'g{r}')} END" for c, r in follow[q]]
        called = f"CASE WHEN NOT gone THEN {edit('R', rerole, f'g{CALLS[q]}')} END"
        return f"list_min([{edit('D', str(COSTS['Delete']), f'g{q}')}, {', '.join(kept)}, {called}]) AS r{q}"

    def insert(state: str) -> str:
        return edit("I", str(COSTS["Insert"]), state)

    return rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x, dense_rank() OVER (ORDER BY conv_id) AS k FROM conversations),
way AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split(regexp_replace(x, '(.)(.)', '\2\1', 'g'), ''), lambda d: (strpos('0123456789ABCDEF', d) - 1)::BIGINT)),
    lambda c, d: xor(c >> 4, ({table}::BIGINT[])[(xor(c, d) & 15) + 1]))) % 20 AS way FROM raw),
hurt AS (SELECT k, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
    CASE way WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(generate_series(1, CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM way),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
judged AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY k ORDER BY i) || substr(role, 1, 1) AS pair FROM placed),
facts AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN {TRUNCATED_COST} ELSE 0 END AS more FROM judged),
counts AS (SELECT k, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY k),
path AS (
    SELECT k, n + 1 AS i, {{'c': 0, 'a': ''}} AS g0, {{'c': {2 * COSTS['Insert']}, 'a': 'II'}} AS g1, {{'c': {COSTS['Insert']}, 'a': 'I'}} AS g2, {{'c': 0, 'a': ''}} AS g3 FROM counts
    UNION ALL
    SELECT k, i, list_min([r0, {insert('u2')}]), list_min([r1, {insert('u2')}]), u2, list_min([r3, {insert('u2')}]) FROM (
        SELECT *, list_min([r2, {insert('r3')}]) AS u2 FROM (
            SELECT f.k, f.i, {', '.join(row(q) for q in range(4))} FROM path p JOIN facts f ON f.k = p.k AND f.i = p.i - 1))),
best AS (SELECT k, g0.c::BIGINT AS cost, g0.a AS audit FROM path WHERE i = 1),
letters AS (SELECT k, audit, unnest(generate_series(1, len(audit))) AS p FROM best),
moves AS (SELECT k, p, substr(audit, p, 1) AS letter FROM letters),
spots AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS pos,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY k) AS total FROM moves WINDOW w AS (PARTITION BY k ORDER BY p)),
said AS (SELECT s.k, pos, CASE WHEN letter = 'K' THEN role WHEN (pos - total % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line FROM spots s LEFT JOIN facts f ON f.k = s.k AND f.i = s.i WHERE letter <> 'D'),
whole AS (SELECT k, sha256(string_agg(line, chr(10) ORDER BY pos)) AS h FROM said GROUP BY k)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, k FROM raw) LEFT JOIN counts USING (k) LEFT JOIN best USING (k) LEFT JOIN whole USING (k)"""
