"""Conversation structure repair: a grammar-compressed dynamic programme.

Each row of a conversation becomes one of nine symbols (role initial and fault). The least
edits that make the roles fit `(s?(ua)+)?` are a min-plus product of 4 x 4 matrices over the
states of that pattern, one matrix for each symbol. Re-Pair replaces repeated symbol pairs
by rules, over all conversations of a slice at once; a rule's matrix is computed once,
bottom-up, whatever the number of conversations that use it. Beside the least cost each
entry keeps the state in the middle (the link of its audit rope: the left rule's audit,
then the right one's) and its place among the audits of its row in ASCII order. Audits of a
rule end with a row's letter and have as many rows, so none is a prefix of another, and
the order of two products follows from the order of their parts.

Rows are sorted over ranges of (conversation, turn, role, text digest) and cut into slices,
so a conversation of any length is spread over tasks. A conversation inside one slice is
finished there. Of the others each slice yields one matrix; the few matrices of a
conversation are multiplied, and each slice then writes the audit between its two states.
Only the digest of a whole conversation's text is sequential: its lines pass in order
through one task as a stream.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from meshtally.llm.common import stored

SLICE = 1 << 16  # rows of a slice
WHITE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1  # costs; CUT: a truncated row that stays
STATES = 4  # nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(STATES)
INFINITE = 1 << 50
MUST_GO = 8  # the symbol of blank and repeated rows; 0-3: s, u, a, other; 4-7: the same, truncated
# What is inserted before the end in each state, so that it ends complete.
ENDING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}


def step(state: int, initial: int) -> int | None:
    """State after a role initial (0 s, 1 u, 2 a); None where the pattern forbids it."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def wanted(state: int) -> int:
    """The initial, u or a, that the pattern takes in a state."""
    return 2 if state == USER else 1


def terminal(symbol: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to): least cost and its ASCII-least audit, for inserts before a row and the row's own edit."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(STATES):
        state = start
        for inserts in range(3):  # more lead to the same states
            ways = [(DELETE, "D", state)]
            if symbol != MUST_GO:
                cut = CUT if symbol >= 4 else 0
                ways.append((REROLE + cut, "R", step(state, wanted(state))))
                if step(state, symbol % 4) is not None:
                    ways.append((KEEP + cut, "K", step(state, symbol % 4)))
            for cost, letter, end in ways:
                way = (cost + INSERT * inserts, "I" * inserts + letter)
                found[start, end] = min(found.get((start, end), way), way)
            state = step(state, wanted(state))
    return found


TERMINALS = [terminal(s) for s in range(MUST_GO + 1)]


def by_rank(keys: np.ndarray) -> np.ndarray:
    return np.argsort(np.argsort(keys, axis=-1, kind="stable"), axis=-1, kind="stable")


def terminal_matrices() -> tuple[np.ndarray, np.ndarray]:
    cost = np.full((len(TERMINALS), STATES, STATES), INFINITE, np.int64)
    order = np.full(cost.shape, STATES * STATES, np.int64)
    for s, found in enumerate(TERMINALS):
        for i in range(STATES):
            audits = sorted(a for (start, _), (_, a) in found.items() if start == i)
            for j in range(STATES):
                if (i, j) in found:
                    cost[s, i, j] = found[i, j][0]
                    order[s, i, j] = audits.index(found[i, j][1])
    return cost, by_rank(order)


def product(cost_a, rank_a, cost_b, rank_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Min-plus product of stacks of matrices: cost, rank of the audit in its row, and the middle state."""
    total = cost_a[:, :, :, None] + cost_b[:, None, :, :]
    mid = np.argmin(total * STATES + rank_a[:, :, :, None], axis=2)
    m, i, j = np.ogrid[:len(cost_a), :STATES, :STATES]
    cost = np.minimum(total[m, i, mid, j], INFINITE)
    return cost, by_rank(rank_a[m, i, mid] * STATES + rank_b[m, mid, j]), mid


class Grammar:
    """Rules of symbol sequences, a root for each, and the matrices of all rules."""

    def __init__(self, sequences: list[bytes]):
        self.rules: list[tuple[int, int]] = []
        self.number: dict[tuple[int, int], int] = {}
        self.roots = [self.reduced(s) for s in self.re_pair(sequences)]
        self.evaluate()

    def rule(self, pair: tuple[int, int]) -> int:
        if pair not in self.number:
            self.number[pair] = len(TERMINALS) + len(self.rules)
            self.rules.append(pair)
        return self.number[pair]

    def re_pair(self, sequences: list[bytes]) -> list[list[int]]:
        """Replace the commonest pair by a rule until no pair occurs twice; the sequences that are left."""
        at: list[int] = []
        for s in sequences:
            at.extend(s)
            at.append(-1)
        n = len(at)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i in range(n - 1):
            if at[i] >= 0 and at[i + 1] >= 0:
                places[at[i], at[i + 1]].append(i)
        heap = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
        heapq.heapify(heap)
        while heap:
            count, (a, b) = heapq.heappop(heap)
            held = places.get((a, b), ())
            if len(held) != -count:
                continue  # counted anew since
            live = [i for i in held if at[i] == a and after[i] < n and at[after[i]] == b]
            places[a, b] = live
            if len(live) < len(held):
                if len(live) > 1:
                    heapq.heappush(heap, (-len(live), (a, b)))
                continue
            del places[a, b]
            new, touched = self.rule((a, b)), set()
            for i in live:
                j = after[i]
                if at[i] != a or j >= n or at[j] != b:
                    continue  # an overlap, as in a a a
                k = after[j]
                at[i], at[j], after[i] = new, -2, k
                if k < n:
                    before[k] = i
                    if at[k] >= 0:
                        places[new, at[k]].append(i)
                        touched.add((new, at[k]))
                if before[i] >= 0 and at[before[i]] >= 0:
                    places[at[before[i]], new].append(before[i])
                    touched.add((at[before[i]], new))
            for pair in sorted(touched):
                if len(places[pair]) > 1:
                    heapq.heappush(heap, (-len(places[pair]), pair))
        out, i = [], 0
        for _ in sequences:
            out.append([])
            while at[i] != -1:
                out[-1].append(at[i])
                i = after[i]
            i = after[i]
        return out

    def reduced(self, sequence: list[int]) -> int:
        """One root for what is left of a sequence, of balanced rules."""
        while len(sequence) > 1:
            pairs = [self.rule(p) for p in zip(sequence[::2], sequence[1::2])]
            sequence = pairs + sequence[len(pairs) * 2:]
        return sequence[0]

    def evaluate(self) -> None:
        base = len(TERMINALS)
        cost, rank = terminal_matrices()
        shape = (base + len(self.rules), STATES, STATES)
        self.cost, self.rank, self.mid = np.empty(shape, np.int64), np.empty(shape, np.int64), np.zeros(shape, np.int8)
        self.cost[:base], self.rank[:base] = cost, rank
        depth = [0] * shape[0]
        for r, (left, right) in enumerate(self.rules, base):
            depth[r] = max(depth[left], depth[right]) + 1
        pairs, depths = np.array(self.rules, np.int64).reshape(-1, 2), np.array(depth[base:], np.int64)
        order = np.argsort(depths, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1):
            if len(at):
                left, right = pairs[at].T
                self.cost[base + at], self.rank[base + at], self.mid[base + at] = product(
                    self.cost[left], self.rank[left], self.cost[right], self.rank[right])

    def audit(self, root: int, start: int, end: int) -> str:
        """The audit rope of a root between two states, written out."""
        out, stack, base = [], [(root, start, end)], len(TERMINALS)
        while stack:
            r, i, j = stack.pop()
            if r < base:
                out.append(TERMINALS[r][i, j][1])
            else:
                left, right = self.rules[r - base]
                k = int(self.mid[r, i, j])
                stack += ((right, k, j), (left, i, k))
        return "".join(out)


def best_end(cost: np.ndarray, rank: np.ndarray) -> int:
    """State before the last inserts, from costs and ranks of the audits by state."""
    return min(range(STATES), key=lambda j: (cost[j] + INSERT * len(ENDING[j]), rank[j]))


def repaired_rows(audit: str, state: int, rows: list[tuple[int | None, str, bytes, int]]) -> list[dict]:
    """The rows that an audit leaves, from a state: the role lines before and at each, and the key of its text.

    rows: turn, role, digest and number of equal copies. Inserted rows at the end come as one without text.
    """
    out, lead, names = [], [], {1: "user", 2: "assistant"}
    keys = (row for row in rows for _ in range(row[3]))
    for letter in audit:
        if letter == "D":
            next(keys)
            continue
        initial = wanted(state)
        role = names[initial]
        if letter == "I":
            lead.append(role + ":")
        else:
            turn, own, digest, _ = next(keys)
            if letter == "K":
                role, initial = own, "sua".index(own[0])
            out.append({"place": len(out), "lead": "\n".join([*lead, role + ":"]), "turn": turn, "role": own, "digest": digest})
            lead = []
        state = step(state, initial)
    if lead:
        out.append({"place": len(out), "lead": "\n".join(lead), "turn": None, "role": None, "digest": None})
    return out


def initial_class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def marked_rows(rows: DataFrame) -> DataFrame:
    """Equal rows as one with `copies`, and the symbol of the first of them. Texts stay behind as digests.

    rows: conv, turn, role, text, copies.
    """
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    light = rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), (last == "").alias("blank"),
                        (~last.isin(".", "!", "?")).alias("cut"), "copies")
    light = stored(light.groupBy("conv", "turn", "role", "digest").agg(
        F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.sum("copies").alias("copies")))
    # Stored, so that Spark sees its size and can split a join on a text that one conversation repeats.
    repeats = stored(light.where("NOT blank").groupBy("conv", "role", "digest").agg(
        F.count("*").alias("n"), F.count_if(F.isnull("turn")).alias("null_turns"), F.min("turn").alias("least"))
        .where("n > 1").select("conv", F.col("role").alias("r"), F.col("digest").alias("d"), "null_turns", "least"))
    again = F.col("null_turns").isNotNull() & F.when(F.col("null_turns") > 0, F.col("turn").isNotNull()).otherwise(
        F.col("turn") > F.col("least"))
    both = light.join(repeats.withColumnRenamed("conv", "c"), F.expr("conv <=> c AND role = r AND digest = d"), "left")
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated")
    code = initial_class(F.col("role"))
    symbol = F.when(fault.isin("blank", "duplicate"), MUST_GO).when(fault == "truncated", code + 4).otherwise(code)
    return both.select("conv", "turn", "role", "digest", "copies", fault.alias("fault"), symbol.cast("tinyint").alias("symbol"))


KEPT = "array<struct<place:bigint,lead:string,turn:bigint,role:string,digest:binary>>"
STATS = "lo bigint, hi bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def statistics(rows: list[tuple]) -> dict:
    """Counts of a run of a conversation's rows (turn, role, digest, copies, fault, symbol)."""
    turns = sorted({r[0] for r in rows} - {None})
    initials = [r[1][:1] for r in rows]
    out = {"lo": turns[0] if turns else None, "hi": turns[-1] if turns else None, "turns": len(turns),
           "blank": 0, "duplicate": 0, "truncated": 0, "head": initials[0], "tail": initials[-1],
           "illegal": sum(not legal(a, b) for a, b in zip(initials, initials[1:])) + sum(r[3] - 1 for r in rows)}
    for _, _, _, copies, fault, _ in rows:
        out["blank" if fault == "blank" else "duplicate"] += copies - 1
        if fault:
            out[fault] += 1
    return out


def segments(sorted_rows: DataFrame, conv_type: str, most: int) -> DataFrame:
    """One row for each run of a conversation in a slice, in the order of `seg`.

    `audit` and `kept` are given for a conversation that lies inside a slice; for others the
    matrix, the symbols and the rows.
    """
    ddl = (f"conv {conv_type}, seg bigint, {STATS}, cost bigint, audit string, kept {KEPT}, matrix binary, ranks binary,"
           "rows array<struct<turn:bigint,role:string,digest:binary,copies:bigint>>, symbols binary")
    shape = arrow_schema(ddl)

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "digest", "copies", "fault", "symbol")))
            while len(rows) >= most:
                yield rows[:most]
                rows = rows[most:]
        if rows:
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 36
        for part in sliced(batches):
            cuts = [i for i in range(1, len(part)) if part[i][0] != part[i - 1][0]]
            runs = [[r[1:] for r in part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)])]
            sequences = [b"".join(bytes([r[5]]) + bytes([MUST_GO]) * (r[3] - 1) for r in rows) for rows in runs]
            distinct = {s: k for k, s in enumerate(dict.fromkeys(sequences))}
            grammar, audits = Grammar(list(distinct)), {}
            out = []
            for k, (conv, rows, symbols) in enumerate(zip((part[c][0] for c in [0, *cuts]), runs, sequences)):
                seg += 1
                row = {"conv": conv, "seg": seg} | statistics(rows)
                root = grammar.roots[distinct[symbols]]
                if 0 < k < len(runs) - 1:
                    if symbols not in audits:
                        end = best_end(grammar.cost[root, START], grammar.rank[root, START])
                        audits[symbols] = (int(grammar.cost[root, START, end]) + INSERT * len(ENDING[end]),
                                           grammar.audit(root, START, end) + ENDING[end])
                    row["cost"], row["audit"] = audits[symbols]
                    row["kept"] = repaired_rows(row["audit"], START, [r[:4] for r in rows])
                else:
                    row |= {"matrix": grammar.cost[root].astype("<i8").tobytes(), "ranks": grammar.rank[root].astype("<i8").tobytes(),
                            "rows": [dict(zip(("turn", "role", "digest", "copies"), r)) for r in rows], "symbols": symbols}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    return sorted_rows.mapInArrow(run, ddl)


def joined_ends(edges: DataFrame, conv_type: str) -> DataFrame:
    """seg, first and last state of each run; the last one of a conversation carries its totals."""
    ddl = f"conv {conv_type}, seg bigint, first bigint, last bigint, total_cost bigint, totals struct<{STATS.replace(' bigint', ':bigint').replace(' string', ':string')}>"
    shape = arrow_schema(ddl)

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["seg"])
        cost, rank = None, None
        mids = []
        for r in rows:
            c, k = (np.frombuffer(r[x], "<i8").reshape(1, STATES, STATES) for x in ("matrix", "ranks"))
            if cost is None:
                cost, rank = c, k
            else:
                cost, rank, mid = product(cost, rank, c, k)
                mids.append(mid[0])
        total = {c: rows[0][c] for c in ("lo", "hi", "turns", "blank", "duplicate", "truncated", "illegal", "head", "tail")}
        for r in rows[1:]:
            total["illegal"] += r["illegal"] + (not legal(total["tail"], r["head"]))
            total["turns"] += r["turns"] - (r["lo"] is not None and r["lo"] == total["hi"])
            total |= {"lo": r["lo"] if total["lo"] is None else total["lo"], "hi": total["hi"] if r["hi"] is None else r["hi"],
                      "tail": r["tail"]} | {c: total[c] + r[c] for c in ("blank", "duplicate", "truncated")}
        last = best_end(cost[0, START], rank[0, START])
        out = [{"total_cost": int(cost[0, START, last]) + INSERT * len(ENDING[last]), "totals": total}]
        for r, mid in zip(rows[:0:-1], mids[::-1]):
            first = int(mid[START, last])
            out[-1] |= {"conv": r["conv"], "seg": r["seg"], "first": first, "last": last}
            out.append({})
            last = first
        out[-1] |= {"conv": rows[0]["conv"], "seg": rows[0]["seg"], "first": START, "last": last}
        return pa.Table.from_pylist(out, schema=shape)

    return edges.groupBy("conv").applyInArrow(run, ddl)


def written_audits(edges: DataFrame, ends: DataFrame, conv_type: str) -> DataFrame:
    """conv, seg, audit, kept, total_cost and totals of the runs that joined_ends has placed."""
    both = edges.select("seg", "rows", "symbols").join(ends, "seg")
    ddl = f"conv {conv_type}, seg bigint, audit string, kept {KEPT}"
    shape = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                grammar = Grammar([r["symbols"]])
                audit = grammar.audit(grammar.roots[0], r["first"], r["last"]) + (ENDING[r["last"]] if r["totals"] else "")
                rows = [tuple(x[c] for c in ("turn", "role", "digest", "copies")) for x in r["rows"]]
                yield pa.RecordBatch.from_pylist([{"conv": r["conv"], "seg": r["seg"], "audit": audit,
                                                   "kept": repaired_rows(audit, r["first"], rows)}], schema=shape)

    return both.mapInArrow(run, ddl)


def repaired_lines(kept: DataFrame, rows: DataFrame) -> DataFrame:
    """conv, seg, place and line of the repaired conversations: kept texts below their roles, inserted ones empty."""
    each = kept.select("conv", "seg", F.inline("kept"))
    texts = (rows.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
             .dropDuplicates(["conv", "turn", "role", "digest"]).toDF("c", "t", "r", "d", "text"))
    both = each.join(texts, F.expr("digest = d AND role = r AND turn <=> t AND conv <=> c"), "left")
    return both.select("conv", "seg", "place", F.concat("lead", F.coalesce("text", F.lit(""))).alias("line"))


def conversation_digests(lines: DataFrame, conv_type: str) -> DataFrame:
    """conv and the digest of its lines, newline-joined; a long conversation is a stream, not held."""
    ddl = f"conv {conv_type}, repaired_sha256 string"
    shape = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if digest is not None and conv == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        out.append({"conv": now, "repaired_sha256": digest.hexdigest()})
                    now, digest = conv, hashlib.sha256()
                digest.update(line.encode())
            yield pa.RecordBatch.from_pylist(out, schema=shape)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv": now, "repaired_sha256": digest.hexdigest()}], schema=shape)

    return lines.repartition("conv").sortWithinPartitions("conv", "seg", "place").select("conv", "line").mapInArrow(run, ddl)


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: Column | None = None, slice_rows: int = SLICE) -> DataFrame:
    """One row for each conversation of rows: conv_id, gaps, the fault counts, cost, audit and repaired_sha256.

    A conversation's rows stand by turn, null first; rows of one turn by role, then by the
    SHA-256 of their text. A row's first fault counts: blank, duplicate (role and text stood
    before), truncated. Kept rows cost nothing, a new role 2, deletion 3 (a must for blank and
    duplicate rows), an inserted row 2, a truncated row that stays 1. The cheapest edits whose
    role initials fit `(s?(ua)+)?` are taken, of equal ones the ASCII-least `audit` (K, R, D, I).
    A role with another initial cannot be kept; only the initial counts, in its own case.
    A null role or text is one space; null conv_ids are one conversation, null turns count for
    no gap. Equal rows, very many too, are one row with a count. `copies`: how often a row
    counts. A long conversation is split over tasks; its audit and digest are single values of
    its length. An empty table gives no row; other columns are not read.
    """
    conv_type = conversations.schema[conv_id].dataType.simpleString()
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("bigint").alias("copies"))
    marked = stored(marked_rows(rows))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), marked.count() // slice_rows + 1)
    order = ["conv", "turn", "role", "digest"]
    found = stored(segments(marked.repartitionByRange(parts, *order).sortWithinPartitions(*order), conv_type, slice_rows))
    edges = found.where("audit IS NULL")
    ends = stored(joined_ends(edges.select("conv", "seg", *(f.split()[0] for f in STATS.split(", ")), "matrix", "ranks"), conv_type))
    rest = stored(written_audits(edges, ends, conv_type))
    lines = repaired_lines(found.where("audit IS NOT NULL").select("conv", "seg", "kept").unionByName(
        rest.select("conv", "seg", "kept")), rows)
    digests = conversation_digests(lines, conv_type)

    counts = ["lo", "hi", "turns", "blank", "duplicate", "truncated", "illegal", "cost"]
    # The pieces of an audit are as long together as the value that they make.
    audits = rest.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "audit"))).alias("pieces"))
    audits = audits.select(F.col("conv").alias("c"), F.array_join("pieces.audit", "").alias("audit"))
    split = ends.where("totals IS NOT NULL").select("conv", "totals.*", F.col("total_cost").alias("cost"))
    split = split.join(audits, F.expr("conv <=> c")).select("conv", *counts, "audit")
    whole = found.where("audit IS NOT NULL").select("conv", *counts, "audit").unionByName(split)
    return (whole.join(digests.withColumnRenamed("conv", "c"), F.expr("conv <=> c"), "left")
            .select(F.col("conv").alias("conv_id"), F.coalesce(F.expr("hi - lo + 1 - turns"), F.lit(0)).alias("gaps"),
                    "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with faults put in by a hash of conv_id and turn, and the column of their copies."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")),
                                (F.crc32(named.cast("binary")) % 20).alias("fault")).where("fault <> 0")
    fault = F.col("fault")
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       "fault"), F.when(fault == 3, 2).otherwise(1)


def report(conversations: DataFrame) -> DataFrame:
    """Every conversation's repair after damage; one that lost all its rows has zeros, no audit and the empty digest."""
    rows, copies = damaged(conversations)
    every = conversations.select(F.col("conv_id").alias("c")).distinct()
    found = repair(rows, copies=copies)
    filled = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return every.join(found, F.expr("c <=> conv_id"), "left").select(
        F.col("c").alias("conv_id"),
        *(F.coalesce(n, filled.get(n, F.lit(0).cast("bigint"))).alias(n) for n in found.columns if n != "conv_id"))
