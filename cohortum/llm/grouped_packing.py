"""Best-fit packing by linear grouping.

Documents longer than a sequence are cut; then only the number of pieces of each length matters,
at most a row for each length. From these counts the driver makes a plan: large lengths, in
descending order, are put into groups of equal cardinality and rounded up to the longest of their
group; column generation finds the best mix of configurations of these few sizes (a linear
programme whose pricing step is an integer knapsack), rounded down to whole sequences; real
lengths take the places of the rounded ones; what is left over, and the small lengths, go into the
sequence with the least room that holds them. Sequences that rounding left with a gap beyond a
limit are taken apart before that step; the limit is the one of a few that needs fewest sequences. The plan counts equal sequences together, so its
size depends on the capacity and the number of groups, not on the number of documents.

Spark numbers the pieces of each length (counts per task first, so that a frequent length meets in
no single task), and a piece's number says its sequence and its place there.

Defined cases: a null or empty text is a piece with the end id alone; repeated rows and null
identifiers are pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortum.llm.common import pieces, texts
from cohortum.llm.tokens import encoder
from cohortum.llm.wordcache import SMALLER
from cohortum.sources.tables import materialise

CAPACITY, GROUPS, SMALL = 2048, 32, 8
GAPS = (64, 32, 16, 8, 4, 2, 0)  # of sequences that are kept as they were configured, tried in turn
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, number bigint"
Plan = list[tuple[int, tuple[int, ...]]]


def cut(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; only the first may be shorter than a sequence."""
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def pieces_of(batches: Iterator[pa.RecordBatch], path: str, spaced: bool, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    """The pieces of every document, numbered within task and length."""
    tokens, task = encoder(path, spaced), TaskContext.get().partitionId()
    end, numbers = np.array([end_id], dtype="<u4").tobytes(), [0] * (capacity + 1)
    names = [x.split(" ")[0] for x in PIECES.split(", ")]
    for batch in pieces(batches, SMALLER):
        pa.default_memory_pool().release_unused()  # of earlier pieces, and of earlier steps
        rows: list[tuple] = []
        some = [text or "" for text in batch["text"].to_pylist()]
        for doc_id, ids in zip(batch["doc_id"].to_pylist(), tokens.encode(some)):
            raw, start = memoryview(ids + end), 0
            for piece, length in enumerate(cut(len(raw) // 4, capacity)):
                checksum = zlib.crc32(raw[4 * start : 4 * (start + length)])
                rows.append((doc_id, piece, start, length, checksum, task, numbers[length]))
                numbers[length] += 1
                start += length
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def linear_groups(counts: dict[int, int], number: int) -> tuple[list[int], list[list[list[int]]]]:
    """Rounded size of each group, and its real lengths with their counts, longest first."""
    share = -(-sum(counts.values()) // number)
    sizes: list[int] = []
    members: list[list[list[int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                sizes.append(length)
                members.append([])
                room = share
            taken = min(left, room)
            members[-1].append([length, taken])
            left, room = left - taken, room - taken
    return sizes, members


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most worthy configuration: an integer knapsack, solved room by room."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    ordered, gains = sizes[order], worth[order]
    fitting = np.searchsorted(ordered, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if n := fitting[room]:
            totals = value[room - ordered[:n]] + gains[:n]
            at = int(totals.argmax())
            if totals[at] > value[room] + 1e-12:
                value[room], choice[room] = totals[at], order[at]
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), pattern


def configurations(sizes: list[int], wanted: list[int], capacity: int) -> list[tuple[int, np.ndarray]]:
    """Whole numbers of configurations from the linear programme's best mix."""
    lengths, demand = np.array(sizes), np.array(wanted, dtype=float)
    basis = np.diag((capacity // lengths).astype(float))
    for _ in range(600):
        worth = np.linalg.solve(basis.T, np.ones(len(lengths)))
        value, pattern = best_pattern(lengths, worth, capacity)
        if value <= 1 + 1e-7:
            break
        amounts, change = np.linalg.solve(basis, demand), np.linalg.solve(basis, pattern)
        usable = change > 1e-9
        ratios = np.where(usable, amounts / np.where(usable, change, 1), np.inf)
        basis[:, int(ratios.argmin())] = pattern
    amounts = np.linalg.solve(basis, demand)
    return [(int(x + 1e-9), basis[:, i].astype(int)) for i, x in enumerate(amounts) if x >= 1 - 1e-9]


def substituted(mixes: list[tuple[int, np.ndarray]], members: list[list[list[int]]]) -> Plan:
    """Fill the places of the configurations with real lengths; what is used leaves ``members``."""
    plan: Plan = []
    heads = [list(reversed(m)) for m in members]
    for times, pattern in mixes:
        slots = np.flatnonzero(pattern)
        while times > 0:
            runs = [heads[g][-1][1] // pattern[g] for g in slots if heads[g]]
            if not runs:
                break
            run, lengths = max(1, min(times, min(runs))), []
            for g in slots:
                for _ in range(pattern[g]):
                    if not heads[g]:
                        continue
                    head = heads[g][-1]
                    lengths.append(head[0])
                    head[1] -= run
                    if not head[1]:
                        heads[g].pop()
            plan.append((int(run), tuple(lengths)))
            times -= run
    for m, head in zip(members, heads):
        m[:] = head
    return plan


def best_fit(counts: dict[int, int], plan: Plan, capacity: int) -> Plan:
    """Put lengths, longest first, where they leave the least room; open sequences if none fits."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    open_rooms = np.zeros(capacity + 1, dtype=bool)

    def put(times: int, lengths: tuple[int, ...], room: int) -> None:
        by_room[room].append((times, lengths))
        open_rooms[room] = True

    for times, lengths in plan:
        put(times, lengths, capacity - sum(lengths))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fitting = int(open_rooms[length:].argmax()) + length
            if not open_rooms[fitting]:
                each = capacity // length
                if left >= each:
                    put(left // each, (length,) * each, capacity - each * length)
                    left %= each
                else:
                    put(1, (length,) * left, capacity - left * length)
                    left = 0
                continue
            times, lengths = by_room[fitting].pop()
            used = min(times, left)
            if used < times:
                by_room[fitting].append((times - used, lengths))
            open_rooms[fitting] = bool(by_room[fitting])
            put(used, (*lengths, length), fitting - length)
            left -= used
    return [entry for room in sorted(by_room) for entry in by_room[room]]


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """How many sequences hold which lengths."""
    large = {x: n for x, n in counts.items() if x * SMALL >= capacity and x < capacity}
    rest = {x: n for x, n in counts.items() if x * SMALL < capacity}
    plan: Plan = [(counts[capacity], (capacity,))] if counts.get(capacity) else []
    if large:
        sizes, members = linear_groups(large, GROUPS)
        # A length that fills several groups is one size.
        merged: dict[int, list[list[int]]] = {}
        for size, own in zip(sizes, members):
            merged.setdefault(size, []).extend(own)
        wanted = [sum(n for _, n in own) for own in merged.values()]
        mixes = configurations(list(merged), wanted, capacity)
        members = list(merged.values())
        filled = substituted(mixes, members)
        for length, n in (run for own in members for run in own):
            rest[length] = rest.get(length, 0) + n
        # What rounding up left open is worth keeping only as far as small lengths can fill it.
        plans = [replaced(filled, gap, rest, plan, capacity) for gap in (capacity, *GAPS)]
        return min(plans, key=lambda found: sum(times for times, _ in found))
    return best_fit(rest, plan, capacity)


def replaced(filled: Plan, gap: int, rest: dict[int, int], plan: Plan, capacity: int) -> Plan:
    """Sequences with more room than ``gap`` are taken apart; their lengths and the rest go into
    the others, and into new ones, by best fit."""
    kept, counts = list(plan), dict(rest)
    for times, lengths in filled:
        if capacity - sum(lengths) <= gap:
            kept.append((times, lengths))
            continue
        for length in lengths:
            counts[length] = counts.get(length, 0) + times
    return best_fit(counts, kept, capacity)


def places(plan: Plan) -> tuple[np.ndarray, ...]:
    """For runs of pieces of a length: length, first number, first sequence, offset; in order."""
    numbers: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for times, lengths in plan:
        offset = 0
        for length in lengths:
            rows.append((length, numbers[length], sequence, offset))
            numbers[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(table.T)


def placed(batches: Iterator[pa.RecordBatch], table: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    lengths, firsts, sequences, offsets = table
    begins = np.searchsorted(lengths, np.arange(lengths.max(initial=0) + 2))
    for batch in batches:
        length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
        at = np.zeros(len(length), dtype=np.int64)
        for value in np.unique(length):
            own = length == value
            low, high = begins[value], begins[value + 1]
            at[own] = low + np.searchsorted(firsts[low:high], number[own], side="right") - 1
        columns = [batch[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
        columns += [pa.array(sequences[at] + number - firsts[at]), pa.array(offsets[at])]
        yield pa.RecordBatch.from_arrays(
            columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        )


def packed(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, spaced: bool = True) -> DataFrame:
    """A row for each piece of each document with its sequence and place."""
    cut_up = materialise(
        texts(docs).mapInArrow(lambda it: pieces_of(it, path, spaced, end_id, capacity), PIECES)
    )
    per_task = cut_up.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task")
    before = per_task.withColumn("before", F.sum("n").over(earlier) - F.col("n"))
    # At most a row for each length up to the capacity.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(places(make_plan(counts, capacity)))
    return (
        cut_up.join(before, ["task", "length"])
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("before") + F.col("number")).alias("number"),
        )
        .mapInArrow(
            lambda it: placed(it, table.value),
            "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
            "sequence_id bigint, offset bigint",
        )
    )
