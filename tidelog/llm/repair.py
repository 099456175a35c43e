"""Cheapest repair of damaged conversations by bidirectional search over the edit lattice.

A repaired conversation has the role initials `(s?(ua)+)?`. States say what came last: 0 nothing,
1 a system turn, 2 a user turn, 3 an assistant turn; 0 and 3 may end. A node of the lattice is a
number of rows read and a state; its edges are the edits of the next row and the turns that may be
inserted in front of it. From a node each edit leads to one node only, so an audit names its path.

A forward and a reverse heap settle nodes by cost until no cheaper or equal crossing is left; of
all crossings of least cost the one with the least audit is taken. Nodes of equal cost settle in
the order of their rows, so a settled node has its least audit.

A long conversation is split. Rows are sorted over all tasks by conversation and turn; each task
cuts its rows into blocks, and a conversation that lies in one block is finished there. The others
pass three small steps: a table of 4 x 4 costs per block, the cost from each block's end to the
end of the conversation, and a search inside each block from each of the four states. Inserts
belong to the block of the row behind them, so that no audit is counted twice. Only what has one
value for the whole, the audit and the digest, is put together in order, block by block.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5  # a truncated row that stays
WHITE = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
SALTS = 16
FAR = 1 << 60
ROLES = {2: "user", 3: "assistant"}
EXPECTED = (2, 2, 3, 2)  # the state behind a turn that the pattern allows next
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
INTO = {2: (0, 1, 3), 3: (2,)}  # the states whose next turn leads there
KEPT_INTO = {"s": {1: (0,)}, "u": {2: (0, 1, 3)}, "a": {3: (2,)}}
END = (0, 10, 5, 0)  # cost of ending in each state
TAIL = ("", "II", "I", "")
LEGAL = {"su", "ua", "au"}


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, m): rows after damage by crc32 of `conv:turn` modulo 20, in m copies
    that stand side by side: 0 drops a row, 1 empties its text, 2 takes its `.!?` away, 3 repeats
    it, 4 makes it a user's. A null role or text, and a null in the key, is one space."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn)).cast("binary")) % 20
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), filled(role).alias("role"),
                       filled(text).alias("text"), kind.alias("kind")).select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("m"))


def edits(code: str, state: int):
    """(label, cost, next state) of the edits of a row, as its initial and its fault say."""
    initial, fault = code
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        to = KEPT.get(initial, {}).get(state)
        if to is not None:
            yield KEEP, more, to
        yield REROLE, COST[REROLE] + more, EXPECTED[state]
    yield DELETE, COST[DELETE], state


def edits_into(code: str, state: int):
    """(label, cost, state before) of the edits of a row that lead to a state."""
    initial, fault = code
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        for before in KEPT_INTO.get(initial, {}).get(state, ()):
            yield KEEP, more, before
        for before in INTO.get(state, ()):
            yield REROLE, COST[REROLE] + more, before
    yield DELETE, COST[DELETE], state


def search(codes: list[str], entry: int = 0, end: tuple = END) -> tuple[int, int, str]:
    """(cost, state at the end, audit) of the cheapest way from a state through the rows, `end`
    being the cost from each state behind them; of equal ones the ASCII-least audit."""
    n = len(codes)
    found: tuple = (FAR, "", 0)  # cost, audit, state at the end
    ahead, back = [(0, entry)], []
    f_cost, f_audit, r_cost, r_audit = {entry: 0}, {entry: ""}, {}, {}
    for state in range(4):
        if end[state] < FAR:
            node = 4 * n + state
            r_cost[node], r_audit[node] = end[state], ("", state)
            heappush(back, (end[state], -node))
    f_done, r_done = set(), set()

    def crossing(cost, left, right):
        nonlocal found
        if cost <= found[0] and cost < FAR:
            found = min(found, (cost, left + right[0], right[1]))

    while ahead or back:
        near, far = ahead[0][0] if ahead else 0, back[0][0] if back else 0
        if near + far > found[0]:
            break
        if ahead and (not back or near <= far):
            cost, node = heappop(ahead)
            if node in f_done:
                continue
            f_done.add(node)
            at, state = divmod(node, 4)
            audit = f_audit[node]
            if at == n:  # the edge to the end, which the reverse side starts from
                crossing(cost + end[state], audit, ("", state))
                continue
            if node in r_done:
                crossing(cost + r_cost[node], audit, r_audit[node])
            steps = [(label, w, node - state + 4 + to) for label, w, to in edits(codes[at], state)]
            steps.append((INSERT, COST[INSERT], node - state + EXPECTED[state]))
            for label, w, to in steps:
                total, longer = cost + w, audit + label
                if to in r_done:
                    crossing(total + r_cost[to], longer, r_audit[to])
                known = f_cost.get(to, FAR)
                if total < known or total == known and longer < f_audit[to]:
                    f_cost[to], f_audit[to] = total, longer
                    if total < known:
                        heappush(ahead, (total, to))
        else:
            cost, node = heappop(back)
            node = -node
            if node in r_done:
                continue
            r_done.add(node)
            at, state = divmod(node, 4)
            audit, last = r_audit[node]
            if node in f_done:
                crossing(cost + f_cost[node], f_audit[node], r_audit[node])
            steps = []
            if at:
                steps = [(label, w, node - state - 4 + before) for label, w, before in edits_into(codes[at - 1], state)]
            if at < n:
                steps += [(INSERT, COST[INSERT], node - state + before) for before in INTO.get(state, ())]
            for label, w, to in steps:
                total, longer = cost + w, (label + audit, last)
                if to in f_done:
                    crossing(total + f_cost[to], f_audit[to], longer)
                known = r_cost.get(to, FAR)
                if total < known or total == known and longer < r_audit[to]:
                    r_cost[to], r_audit[to] = total, longer
                    if total < known:
                        heappush(back, (total, -to))
    return found[0], found[2], found[1]


def through(codes: list[str]) -> list[int]:
    """The least cost through a block from each state to each, row by row; FAR where there is no way."""
    out = []
    for entry in range(4):
        cost = [FAR] * 4
        cost[entry] = 0
        for code in codes:
            for _ in range(3):
                for state in range(4):
                    to = EXPECTED[state]
                    cost[to] = min(cost[to], cost[state] + COST[INSERT])
            after = [FAR] * 4
            for state in range(4):
                for _, w, to in edits(code, state):
                    after[to] = min(after[to], cost[state] + w, FAR)
            cost = after
        out += cost
    return out


def repaired(lines: list[tuple[str, str]], audit: str, state: int) -> list[bytes]:
    """The lines `role:text` an audit makes of rows (role, text), from a state on."""
    out, at = [], 0
    for label in audit:
        if label == INSERT:
            state = EXPECTED[state]
            out.append(f"{ROLES[state]}:".encode())
            continue
        role, text = lines[at]
        at += 1
        if label == KEEP:
            state = KEPT[role[0]][state]
        elif label == REROLE:
            state = EXPECTED[state]
            role = ROLES[state]
        else:
            continue
        out.append(f"{role}:{text}".encode("utf-8", "surrogatepass"))
    return out


class Block:
    """Rows of one conversation that stand side by side."""

    def __init__(self, conv: str):
        self.conv, self.codes, self.lines, self.size = conv, [], [], 0

    def add(self, role: str, text: str, fault: str) -> None:
        self.codes.append((role[:1] or " ") + fault)
        self.lines.append((role, text))
        self.size += len(role) + len(text)

    def counts(self) -> dict[str, int]:
        faults, initials = [c[1] for c in self.codes], [c[0] for c in self.codes]
        return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
                "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))}


COUNTS = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), pa.int64())
DONE = {"conv": pa.string(), **COUNTS, "audit": pa.string(), "repaired_sha256": pa.string()}
OPEN = {"conv": pa.string(), "block": pa.int64(), **{k: v for k, v in COUNTS.items() if k != "cost"},
        "codes": pa.list_(pa.string()), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
        "costs": pa.list_(pa.int64())}
PIECES = DONE | OPEN
_SQL = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int"}


def sql(types: dict) -> str:
    return ", ".join(f"{k} array<{_SQL[t.value_type]}>" if pa.types.is_list(t) else f"{k} {_SQL[t]}"
                     for k, t in types.items())


def _pieces(most: int):
    """Blocks of sorted rows, of `most` rows: a conversation that begins and ends in this task and
    fits one block is finished, every other block stays open."""
    def listed(rows):
        return batch({k: [r[k] for r in rows] for k in PIECES}, PIECES)

    def made(block, whole, number):
        row = dict.fromkeys(PIECES) | {"conv": block.conv} | block.counts()
        if whole:
            cost, state, audit = search(block.codes)
            audit += TAIL[state]
            body = b"\n".join(repaired(block.lines, audit, 0))
            return row | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(body).hexdigest()}
        return row | {"block": number, "codes": block.codes, "roles": [r for r, _ in block.lines],
                      "texts": [t for _, t in block.lines], "costs": through(block.codes)}

    def cut(batches):
        number, ready, size = TaskContext.get().partitionId() << 32, [], 0
        held, edge, split = None, True, False  # edge: the held one may have begun in an earlier task
        for b in batches:
            for conv, role, text, fault, m in zip(*(b.column(c).to_pylist() for c in range(5))):
                if held is not None and held.conv != conv:
                    ready.append(made(held, not (edge or split), number))
                    number, size = number + 1, size + held.size * (edge or split)
                    held, edge, split = None, False, False
                for copy in range(m):
                    if held is not None and (len(held.codes) >= most or held.size >= BLOCK_BYTES):
                        ready.append(made(held, False, number))
                        number, size = number + 1, size + held.size
                        held, split = None, True
                    if held is None:
                        held = Block(conv)
                    held.add(role, text, fault if copy == 0 or fault == "b" else "d")
                    if len(ready) >= 1000 or size > BLOCK_BYTES:
                        yield listed(ready)
                        ready, size = [], 0
        if held is not None:  # it may go on in the next task
            ready.append(made(held, False, number))
        if ready:
            yield listed(ready)

    return cut


def _ends(batches):
    """Of each conversation's blocks in order, with their costs: the cost from each block's end on."""
    types = {"conv": pa.string(), "block": pa.int64(), "end": pa.list_(pa.int64())}
    for b in batches:
        for conv, listed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            end, out = np.array(END, np.int64), []
            for piece in reversed(listed):
                out.append((conv, piece["block"], end.tolist()))
                costs = np.array(piece["costs"], np.int64).reshape(4, 4)
                end = np.minimum((costs + end).min(axis=1), FAR)
            yield batch(dict(zip(types, map(list, zip(*out)))), types)


def _ways(batches):
    """Of each block the cheapest way from every state, given the cost behind it."""
    types = {"conv": pa.string(), "block": pa.int64(), "exits": pa.list_(pa.int32()), "audits": pa.list_(pa.string())}
    for b in batches:
        out = []
        for conv, block, codes, end in zip(*(b.column(c).to_pylist() for c in range(4))):
            ways = [search(codes, entry, tuple(end)) for entry in range(4)]
            out.append((conv, block, [w[1] for w in ways], [w[2] for w in ways]))
        yield batch(dict(zip(types, map(list, zip(*out)))) if out else dict.fromkeys(types, []), types)


def _chained(batches):
    """Conversations of several blocks, in order: the state runs through them, the digest goes on."""
    held = None

    def closed():
        row, digest, lines, state, audits, last = held
        audits.append(TAIL[state])
        for line in repaired([], TAIL[state], state):
            digest.update((b"\n" if lines else b"") + line)
            lines += 1
        cost = sum(COST.get(x, 0) * a.count(x) for a in audits for x in COST)
        done = row | {"cost": cost + row.pop("kept"), "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
        return batch({k: [done[k]] for k in DONE}, DONE)

    names = ("blank", "duplicate", "truncated", "illegal")
    for b in batches:
        for row in b.to_pylist():
            if held is not None and held[0]["conv"] != row["conv"]:
                yield closed()
                held = None
            if held is None:
                held = [{"conv": row["conv"], "kept": 0, **dict.fromkeys(names, 0)}, hashlib.sha256(), 0, 0, [], None]
            totals, digest, lines, state, audits, last = held
            for k in names:
                totals[k] += row[k]
            if last is not None and last + row["codes"][0][0] not in LEGAL:
                totals["illegal"] += 1
            audit = row["audits"][state]
            rows = [x for x in audit if x != INSERT]
            totals["kept"] += TRUNCATED * sum(c[1] == "t" and x != DELETE for c, x in zip(row["codes"], rows))
            for line in repaired(list(zip(row["roles"], row["texts"])), audit, state):
                digest.update((b"\n" if lines else b"") + line)
                lines += 1
            audits.append(audit)
            held[2], held[3], held[5] = lines, row["exits"][state], row["codes"][-1][0]
    if held is not None:
        yield closed()


def repair(rows: DataFrame, conv: str = "conv", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows: (conv, turn, role, text, m), m copies of each row side by side. Per conversation:
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; equal turns by role and text. An empty role has no initial
    that the pattern knows. Conversations whose rows all have m = 0 have zeros, an empty audit and
    the digest of nothing. A null conversation id is one conversation.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))
    kind = rows.schema[conv].dataType
    same = stored(rows.select(name.alias("conv"), "turn", "role", "text", "m").groupBy(
        "conv", "turn", "role", "text").agg(F.sum("m").alias("m")), "turns")
    here = same.where(F.col("m") > 0).withColumn(
        "place", F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).withColumn(
        "said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))

    # The first place of what is said in several turns of a conversation, in parts against a hot one.
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")
    again = here.groupBy("conv", "said").agg(F.min("place").alias("first"), F.count("*").alias("n")).where(
        F.col("n") > 1).select("conv", "said", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    marked = here.withColumn("salt", salt).join(again, ["conv", "said", "salt"], "left")
    body = F.rtrim("text", F.lit(WHITE))
    new = F.col("first").isNull() | (F.col("first") == F.col("place"))
    fault = F.when(body == "", "b").when(~new, "d").when(~F.right(body, F.lit(1)).isin(*".!?"), "t").otherwise("-")
    ordered = marked.select("conv", "turn", "role", "text", fault.alias("fault"), "m")
    keys = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = stored(ordered.select("conv", "role", "text", "fault", "m").mapInArrow(
        _pieces(block_rows), sql(PIECES)), "pieces")

    whole, open_ = pieces.where("block is null").select(*DONE), pieces.where("block is not null").select(*OPEN)
    ends = stored(open_.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "costs"))).alias("listed"))
                  .mapInArrow(_ends, "conv string, block long, end array<long>"), "ends")
    ways = stored(open_.join(ends, ["conv", "block"]).select("conv", "block", "codes", "end").mapInArrow(
        _ways, "conv string, block long, exits array<int>, audits array<string>"), "ways")
    chained = open_.drop("costs").join(ways, ["conv", "block"]).repartition("conv").sortWithinPartitions("conv", "block")
    found = whole.unionByName(chained.mapInArrow(_chained, sql(DONE)))

    gaps = same.groupBy("conv").agg(
        F.max(F.when(F.col("m") > 0, F.col("turn"))).alias("high"), F.min(F.when(F.col("m") > 0, F.col("turn"))).alias("low"),
        F.count_distinct(F.when(F.col("m") > 0, F.col("turn"))).alias("turns"))
    made = gaps.join(found, "conv", "left")

    def number(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long")

    return made.select(
        F.when(F.col("conv") != "", F.substring("conv", 2, 2**31 - 1)).cast(kind).alias("conv"),
        number(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"),
        *(number(F.col(c)).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
