"""Conversation repair by bidirectional Dijkstra over the edit lattice (operator 12).

A node of a conversation's lattice is (rows consumed, state of the role
pattern); Keep, Rerole and Delete consume a row, Insert does not. The search
runs a heap forward from the empty prefix and one in reverse from the accepted
ends until their least keys add up to more than the best crossing, so every
crossing of that cost is finished; of all concatenations of equal cost the least
audit is picked. An audit fixes its path, for a state allows one role.

Two sorted streams do the work, both dealt by conversation. The first carries
no text, only a role and flags a row, and yields the audit; the second streams
the texts behind their conversation's audit into the digest. So a task never
holds the texts of a conversation: its state is under 64 bytes a row of the one
conversation at hand, and its audit, which is one value of the result anyway.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screensift.llm.frames import materialise, shuffle_partitions

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a. Initials a state takes, and the one that edits put there.
START, SYSTEM, USER, ASSISTANT = range(4)
TAKES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
PUTS = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
ACCEPTED = (START, ASSISTANT)
MAX_LONG = (1 << 63) - 1

BLANK, DUPLICATE, CUT, CLEAN = range(4)
WHITE = " \t\n\x0b\f\r"


class Lattice:
    """Edits of one conversation: ``initials`` and ``faults`` (a byte a row), nodes numbered 4 * rows consumed + state."""

    def __init__(self, initials: bytes, faults: bytes):
        self.initials, self.faults, self.rows = initials, faults, len(faults)

    def forward(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(edit, cost, node after it); the edits in ASCII order."""
        at, state = divmod(node, 4)
        put = TAKES[state][PUTS[state]]
        if at < self.rows:
            yield "D", DELETE, node + 4
        yield "I", INSERT, 4 * at + put
        if at < self.rows and self.faults[at] >= CUT:
            stays = TRUNCATED if self.faults[at] == CUT else 0
            kept = TAKES[state].get(chr(self.initials[at]))
            if kept is not None:
                yield "K", stays, 4 * at + 4 + kept
            yield "R", REROLE + stays, 4 * at + 4 + put

    def backward(self, node: int) -> Iterator[tuple[int, int]]:
        """(cost, node before) of every edit that ends in ``node``."""
        at, state = divmod(node, 4)
        for before in range(4):
            put = TAKES[before][PUTS[before]] == state
            if put:
                yield INSERT, 4 * at + before
            if at:
                fault = self.faults[at - 1]
                if before == state:
                    yield DELETE, node - 4
                if fault >= CUT:
                    stays = TRUNCATED if fault == CUT else 0
                    if TAKES[before].get(chr(self.initials[at - 1])) == state:
                        yield stays, 4 * at - 4 + before
                    if put:
                        yield REROLE + stays, 4 * at - 4 + before


def cheapest_audit(initials: bytes, faults: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of equal costs the ASCII-least audit."""
    lattice = Lattice(initials, faults)
    nodes = 4 * (lattice.rows + 1)
    far = (1 << 31) - 1
    ahead, behind = array("i", [far]) * nodes, array("i", [far]) * nodes
    done_ahead, done_behind = bytearray(nodes), bytearray(nodes)
    ahead[START] = 0
    front, rear = [(0, START)], []
    for state in ACCEPTED:  # the reverse heap orders equal costs from the end, where free edits come from
        behind[nodes - 4 + state] = 0
        heapq.heappush(rear, (0, -(nodes - 4 + state)))
    best = far
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, node = heapq.heappop(front)
            if done_ahead[node]:
                continue
            done_ahead[node] = 1
            best = min(best, cost + behind[node])
            for _, price, to in lattice.forward(node):
                if cost + price < ahead[to]:
                    ahead[to] = cost + price
                    heapq.heappush(front, (cost + price, to))
        else:
            cost, node = heapq.heappop(rear)
            node = -node
            if done_behind[node]:
                continue
            done_behind[node] = 1
            best = min(best, cost + ahead[node])
            for price, to in lattice.backward(node):
                if cost + price < behind[to]:
                    behind[to] = cost + price
                    heapq.heappush(rear, (cost + price, -to))

    # crossings of the best cost lie on an edge from a node settled ahead to one settled behind (or on such a node, or on
    # an accepted end); ``alive``: nodes settled ahead that reach one by tight edges
    alive = bytearray(nodes)
    stack = []
    for node in range(nodes):
        met = done_behind[node] or node - nodes + 4 in ACCEPTED
        if done_ahead[node] and (met and ahead[node] + behind[node] == best or any(
                done_behind[to] and ahead[node] + price + behind[to] == best for _, price, to in lattice.forward(node))):
            alive[node] = 1
            stack.append(node)
    while stack:
        node = stack.pop()
        for price, before in lattice.backward(node):
            if done_ahead[before] and not alive[before] and ahead[before] + price == ahead[node]:
                alive[before] = 1
                stack.append(before)
    audit, node, left = [], START, best
    while not (node >= nodes - 4 and left == 0 and node - nodes + 4 in ACCEPTED):
        for edit, price, to in lattice.forward(node):
            on = best - left + price
            if alive[to] and ahead[to] == on or done_behind[to] and behind[to] == left - price:
                audit.append(edit)
                node, left = to, left - price
                break
        else:
            raise AssertionError("no edit leads on")
    return best, "".join(audit)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _as_long(value: int) -> int:
    return max(-MAX_LONG - 1, min(MAX_LONG, value))


def _sorted_stream(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows), "conv").sortWithinPartitions("conv", *order)


_AUDITS = ("conv binary, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _audits(rows: DataFrame) -> DataFrame:
    """Sorted (conv, present, turn, initial, fault) -> a row of counts and the audit for each conversation."""

    def finish(conv, turns, initials, faults):
        lo, hi, distinct = turns
        gaps = _as_long(hi - lo + 1 - distinct) if distinct else 0
        legal = {"su", "ua", "au"}
        text = initials.decode("latin-1")
        illegal = sum(text[i:i + 2] not in legal for i in range(len(text) - 1))
        cost, audit = cheapest_audit(bytes(initials), bytes(faults))
        return (conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit)

    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv", pa.binary()), *[(n, pa.int64()) for n in counts], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, open_conv = [], 0, None
        for batch in batches:
            for conv, present, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != open_conv:
                    if open_conv is not None:
                        out.append(finish(open_conv, (lo, hi, distinct), initials, faults))
                        size += len(faults)
                    open_conv, lo, hi, distinct, initials, faults = conv, None, None, 0, bytearray(), bytearray()
                    if len(out) >= 4096 or size > 1 << 20:
                        yield _batch(out, schema)
                        out, size = [], 0
                if not present:
                    continue
                if turn is not None and turn != hi:  # rows come by turn
                    lo, hi, distinct = turn if lo is None else lo, turn, distinct + 1
                initials.append(initial)
                faults.append(fault)
        if open_conv is not None:
            out.append(finish(open_conv, (lo, hi, distinct), initials, faults))
            yield _batch(out, schema)

    return rows.mapInArrow(run, _AUDITS)


def _repaired(rows: DataFrame) -> DataFrame:
    """Sorted (conv, kind, audit, role, text), kind 0 the audit, 1 a row -> (conv, repaired_sha256)."""

    class Digest:
        """The digest of a conversation's repaired rows, fed row by row."""

        def __init__(self, conv, audit):
            self.conv, self.audit, self.at, self.state, self.sha = conv, audit, 0, START, None

        def put(self, role: str, text: str) -> None:
            if self.sha is None:
                self.sha = hashlib.sha256()
            else:
                self.sha.update(b"\n")
            self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.state = TAKES[self.state][role[:1]]

        def inserts(self) -> None:
            while self.audit[self.at:self.at + 1] == "I":
                self.put(ROLES[PUTS[self.state]], "")
                self.at += 1

        def row(self, role: str, text: str) -> None:
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.put(role, text)
            elif edit == "R":
                self.put(ROLES[PUTS[self.state]], text)

        def result(self) -> tuple[bytes, str]:
            self.inserts()
            return self.conv, (self.sha or hashlib.sha256()).hexdigest()

    schema = pa.schema([("conv", pa.binary()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, kind, audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if now:
                        out.append(now.result())
                    now = Digest(conv, audit)
                else:
                    now.row(role, text)
            if out:
                yield _batch(out, schema)
                out = []
        if now:
            out.append(now.result())
            yield _batch(out, schema)

    return rows.mapInArrow(run, "conv binary, repaired_sha256 string")


def with_fault(rows: DataFrame) -> DataFrame:
    """(conv, turn, copy, role, text, present) -> adds ``print`` (of the text) and ``fault``: the row's first fault, as a number.

    A duplicate is found by a window over the rows of one conversation with
    equal role and text; equal blank rows count as blank before that.
    """
    text = F.col("text")
    last = F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)
    again = F.row_number().over(Window.partitionBy("conv", "present", "role", "print").orderBy("turn", "copy")) > 1
    marked = rows.select("*", F.md5(text).alias("print"), last.alias("last")).drop("text")
    return marked.withColumn("fault", F.when(F.col("last") == "", BLANK).when(again, DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT)
                             .otherwise(CLEAN))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           edits: Column | None = None) -> DataFrame:
    """One row per conversation: ``conv_col``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``edits`` may give, per row, the rows that stand in for it, an
    array<struct<role, text>> (empty: the row is gone); default is the row
    itself. Rows are taken by turn, NULL turns first; ties by role, then by the
    MD5 of the text, so repeated rows give one result in any order of the input.
    A NULL role or text is one space, so such a text is blank; a role without an
    initial of ``sua`` fits nowhere and is reroled or deleted. A NULL
    conversation is one conversation. A conversation left without rows has
    zeros, an empty audit and the digest of nothing; an empty table gives an
    empty result. Further columns of the input are not read.
    """
    role, text = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" "))
    now = F.array(F.struct(role.alias("role"), text.alias("text"))) if edits is None else edits
    conv = F.col(f"`{conv_col}`")
    key = F.coalesce(F.concat(F.lit("1"), conv.cast("string")), F.lit("0")).cast("binary")
    each = rows.select(key.alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), F.posexplode_outer(now).alias("copy", "row"))
    each = each.select("conv", "turn", "copy", F.col("row").isNotNull().alias("present"), F.coalesce("row.role", F.lit("")).alias("role"),
                       F.coalesce("row.text", F.lit("")).alias("text"))
    first = F.coalesce(F.ascii(F.substring("role", 1, 1)), F.lit(0))
    initial = F.when(first.between(1, 127), first).otherwise(0)
    light = with_fault(each).select("conv", "present", "turn", "role", "print", initial.cast("int").alias("initial"), F.col("fault").cast("int"))
    # of equal rows of one turn the first is the one that is no duplicate
    light = _sorted_stream(light, "turn", "role", "print", F.desc("fault"))
    audits = materialise(_audits(light.select("conv", "present", "turn", "initial", "fault")), "audits")
    heads = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("print"),
                          "audit", F.lit("").alias("text"))
    texts = each.where("present").select("conv", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("print"),
                                         F.lit(None).cast("string").alias("audit"), "text")
    stream = _sorted_stream(heads.unionByName(texts), "kind", "turn", "role", "print").select("conv", "kind", "audit", "role", "text")
    ids = rows.select(key.alias("conv"), conv.alias(conv_col)).groupBy("conv").agg(F.first(conv_col).alias(conv_col))
    return audits.join(_repaired(stream), "conv").join(ids, "conv").select(
        conv_col, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", of: int = 20) -> Column:
    """The rows that stand in for a row after damage by the CRC-32 of ``conv:turn``, as ``repair`` takes them."""
    def read(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    role, text = read(role_col), read(text_col)
    kind = F.crc32(F.concat(read(conv_col), F.lit(":"), read(turn_col)).cast("binary")) % of

    def one(r: Column, t: Column) -> Column:
        return F.struct(r.alias("role"), t.alias("text"))

    same = one(role, text)
    return (F.when(kind == 0, F.array().cast("array<struct<role:string,text:string>>")).when(kind == 1, F.array(one(role, F.lit(""))))
            .when(kind == 2, F.array(one(role, F.regexp_replace(text, "[.!?]", "")))).when(kind == 3, F.array(same, same))
            .when(kind == 4, F.array(one(F.lit("user"), text))).otherwise(F.array(same)))
