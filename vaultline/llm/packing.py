"""Best-fit packing by bin completion with branch and bound.

Documents become token pieces of at most ``CAPACITY`` (only longer documents
are cut) that go into as few sequences as possible. What has to be solved
depends on the lengths alone, so the search runs on the histogram of lengths:
at most ``CAPACITY`` rows, however many documents there are. A node takes the
largest length left and enumerates fillings of the room beside it; each is used
as often as the counts allow. A first search over a few likely fillings improves
the incumbent; a second one takes all undominated fillings, least waste first
and only as far as they are asked for, also once instead of as often as it goes. Best-fit-decreasing gives the first
incumbent; branches whose waste already rules out an improvement are cut, and
the search ends at the Martello-Toth lower bound, with all branches tried (both
prove the result optimal), or after ``NODES`` nodes each. The
result is a list of patterns with multiplicities.

Pieces find their places by rank: the pieces of a length are numbered in
``SALTS`` independent runs (so a length that holds a third of all rows does not
meet in one task), and rank intervals of the patterns give the sequence and
the offset by arithmetic.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; a null doc_id is carried; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm import tokenizing
from vaultline.llm.common import materialize, text_or_empty

TOKENIZER, END_ID, CAPACITY = "word_bpe_49k.json", 1, 4096
SALTS, NODES, WIDTH = 64, 20_000, 8
LIVE = 8  # enumerations of fillings kept open: each holds a table of up to capacity sets of capacity bits
COMPARED = 64  # fillings that a later one is held against; past them a dominated one only costs a node

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # (how often, ((length, uses), ...))


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
           end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt) of every piece."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        encoder = tokenizing.load(tokenizing.WordIds, tokenizer)
        seen = 0
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for r, value in enumerate(b.column(1)):
                ids = encoder.ids(value.as_py()) + end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    row.append(r), piece.append(p), start.append(at // 4)
                    length.append(len(part) // 4), crc.append(zlib.crc32(part))
            salt = (np.arange(seen, seen + len(row)) % SALTS).astype(np.int32)
            seen += len(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(salt)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, salt int")


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: for each threshold k, lengths over capacity - k
    stand alone, those over half need a sequence each, and what the middle
    lengths cannot take of the rest needs more."""
    n, s = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for length, c in counts.items():
        n[length] += c
        s[length] += c * length
    n_to, s_to = np.cumsum(n), np.cumsum(s)
    best, half = -(-int(s_to[capacity]) // capacity), capacity // 2
    for k in range(0, half + 1):
        alone = int(n_to[capacity] - n_to[capacity - k])
        top = max(capacity - k, half)
        large_n, large_s = int(n_to[top] - n_to[half]), int(s_to[top] - s_to[half])
        small = int(s_to[half] - (s_to[k - 1] if k else 0))
        over = small - (large_n * capacity - large_s)
        best = max(best, alone + large_n + max(0, -(-over // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit-decreasing on the histogram: all open sequences with the same
    contents are one class and are filled together."""
    classes: dict[int, list[list]] = {}  # room -> [[how many, pattern], ...]
    rooms: list[int] = []

    def put(room: int, many: int, pattern: tuple) -> None:
        if room not in classes:
            classes[room] = []
            insort(rooms, room)
        classes[room].append([many, pattern])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_right(rooms, length - 1)
            if i < len(rooms):
                room = rooms[i]
                many, pattern = classes[room].pop()
                if not classes[room]:
                    del classes[room], rooms[i]
            else:
                room, many, pattern = capacity, left, ()
            uses = min(room // length, left)
            fill = min(many, left // uses)
            if pattern and fill < many:
                put(room, many - fill, pattern)
            put(room - uses * length, fill, pattern + ((length, uses),))
            left -= fill * uses
    return [(many, pattern) for room in classes for many, pattern in classes[room]]


def likely_fillings(left: list[int], counts: dict[int, int], room: int, width: int = WIDTH) -> list[tuple[int, tuple]]:
    """A few good fillings of ``room``: (waste, ((length, uses), ...)), least
    waste first. ``left``: lengths still there, ascending."""
    first = bisect_right(left, room)
    if not first:
        return [(room, ())]
    found: dict[tuple, int] = {}
    lengths = set()
    # A pair that fills the room exactly.
    for a in reversed(left[max(0, first - 512):first]):
        b = room - a
        if b and b <= a and counts.get(b, 0) >= (2 if a == b else 1):
            found[((a, 1), (b, 1)) if a != b else ((a, 2),)] = 0
            lengths.add(a)
            if len(found) >= width // 2:
                break
    for a in left[max(0, first - width):first]:
        rest, used, r = [], {a: 1}, room - a
        i = bisect_right(left, r)
        while r and i:
            c = left[i - 1]
            can = min(counts[c] - used.get(c, 0), r // c)
            if can > 0:
                used[c] = used.get(c, 0) + can
                r -= can * c
            i = bisect_right(left, min(r, c - 1))
        rest = tuple(sorted(used.items(), reverse=True))
        found[rest] = r
    ranked = sorted((waste, sum(u for _, u in f), f) for f, waste in found.items())
    out: list[tuple[int, tuple]] = []
    for waste, _, f in ranked:
        if not any(_dominates(g, f) for _, g in out):
            out.append((waste, f))
    return out


def fillings(left: list[int], counts: dict[int, int], large: int, room: int, most: int) -> Iterator[tuple[int, tuple | None]]:
    """All undominated fillings of the ``room`` beside one ``large``: (waste,
    ((length, uses), ...)), least waste first, up to waste ``most``; None in
    place of a dominated one. ``left``: lengths still there, ascending. Made as
    they are asked for; ``counts`` must then be as at the start."""
    def free(n: int) -> int:
        return counts[n] - (n == large)

    fit = [n for n in left[:bisect_right(left, room)] if free(n)]
    if not fit:
        if room <= most:
            yield room, ()
        return
    full = (1 << room + 1) - 1
    sums = [1]  # sums[i]: bit t is set if the lengths fit[:i] can reach the total t
    for n in fit:
        reach, many, step = sums[-1], min(free(n), room // n), 1
        while many:
            take = min(step, many)
            reach |= (reach << take * n) & full
            many, step = many - take, 2 * step
        sums.append(reach)

    def exact(total: int) -> Iterator[tuple]:
        # Depth first; a total that cannot be reached is never tried, so each descent ends in a filling.
        todo = [(len(fit), total, ())]
        while todo:
            i, need, taken = todo.pop()
            if not need:
                yield taken
                continue
            i = min(i, bisect_right(fit, need))
            if not sums[i] >> need & 1:
                continue
            n = fit[i - 1]
            for uses in range(min(free(n), need // n) + 1):
                if sums[i - 1] >> (need - uses * n) & 1:
                    todo.append((i - 1, need - uses * n, taken + ((n, uses),) if uses else taken))

    tried: list[tuple] = []
    for waste in range(min(room, most) + 1):
        if not sums[-1] >> (room - waste) & 1:
            continue
        for f in exact(room - waste):
            used = dict(f)
            spare = next((n for n in fit if free(n) > used.get(n, 0)), None)
            # With room for one more length, a fuller filling dominates it.
            if spare is not None and spare <= waste or any(_dominates(g, f) for g in tried):
                yield waste, None
                continue
            if len(tried) < COMPARED:
                tried.append(f)
            yield waste, f


def _dominates(better: tuple, worse: tuple) -> bool:
    """Whether worse's lengths fit, grouped, into better's (first fit)."""
    holes = sorted((n for n, u in better for _ in range(u)), reverse=True)
    if len(holes) > 12 or sum(u for _, u in worse) > 12:
        return False
    for n, u in worse:
        for _ in range(u):
            fit = [h for h in range(len(holes)) if holes[h] >= n]
            if not fit:
                return False
            holes[min(fit, key=holes.__getitem__)] -= n
    return True


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold every length as often as ``counts`` says, in as few
    sequences as the search finds."""
    return search(counts, capacity, nodes)[0]


def search(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> tuple[list[Pattern], bool]:
    """The patterns, and whether no plan with fewer sequences exists (proven)."""
    counts = {n: c for n, c in counts.items() if c}
    best = best_fit(counts, capacity)
    used = sum(m for m, _ in best)
    bound = lower_bound(counts, capacity)
    if used == bound:
        return best, True
    for whole in (False, True):
        best, ended = _descend(counts, capacity, nodes, best, bound, whole)
        used = sum(m for m, _ in best)
        if used == bound:
            return best, True
    return best, ended


def _descend(counts: dict[int, int], capacity: int, nodes: int, best: list[Pattern], bound: int,
             whole: bool) -> tuple[list[Pattern], bool]:
    """The best of ``best`` and what at most ``nodes`` nodes find; whether all branches were tried."""
    # Depth first over an explicit stack of choices, so depth is no limit.
    used, total = sum(m for m, _ in best), sum(n * c for n, c in counts.items())
    left, rest = sorted(counts), dict(counts)
    path: list[tuple[Pattern, int]] = []
    opened, waste, seen = 0, 0, 0

    def apply(pattern: Pattern, sign: int) -> None:
        for n, u in pattern[1]:
            before = rest.get(n, 0)
            rest[n] = before - sign * u * pattern[0]
            if not rest[n]:
                left.remove(n)
            elif not before:
                insort(left, n)

    def choices(most: int) -> Iterator[tuple[Pattern | None, int]]:
        large = left[-1]
        if whole:
            def options():
                return fillings(left, rest, large, capacity - large, most)
        else:
            there = [n for n in left if n != large or rest[n] > 1]
            few = likely_fillings(there, {**rest, large: rest[large] - 1}, capacity - large)

            def options():
                return few
        for once in (False, True)[:1 + whole]:  # as often as it goes; then once, and the next node decides again
            for w, f in options():
                if f is None:
                    yield None, w
                    continue
                uses = dict(f)
                uses[large] = uses.get(large, 0) + 1
                many = min(rest[n] // u for n, u in uses.items())
                if not once or many > 1:
                    yield (1 if once else many, tuple(sorted(uses.items(), reverse=True))), w

    # A node: the waste it may add, how many choices were taken, and the open enumeration. Only the deepest LIVE are
    # open; one that the search comes back to is made anew (lengths left are then as before) up to where it was.
    def node() -> list:
        most = (used - 1) * capacity - total - waste
        if len(todo) >= LIVE:
            todo[-LIVE][2] = None
        return [most, 0, choices(most) if left else iter(())]

    todo: list[list] = []
    if left:
        todo.append(node())
    while todo and seen < nodes and used > bound:
        top = todo[-1]
        if top[2] is None:
            top[2] = islice(choices(top[0]), top[1], None)
        pattern, w = next(top[2], (None, None))
        top[1] += 1
        if w is None:
            todo.pop()
            if path:
                last, w = path.pop()
                apply(last, -1)
                opened, waste = opened - last[0], waste - w
            continue
        seen += 1
        if pattern is None:
            continue
        # To improve by one sequence, the waste may not pass this.
        if waste + w * pattern[0] > (used - 1) * capacity - total:
            many = ((used - 1) * capacity - total - waste) // w if w else 0
            if many < 1:
                continue
            pattern = (min(many, pattern[0]), pattern[1])
        apply(pattern, 1)
        path.append((pattern, w * pattern[0]))
        opened, waste = opened + pattern[0], waste + w * pattern[0]
        if not left and opened < used:
            best, used = [p for p, _ in path], opened
        todo.append(node())
    return best, not todo


def intervals(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, uses, first sequence, first offset), sorted."""
    out, taken, sequence = [], {}, 0
    for many, pattern in patterns:
        offset = 0
        for n, u in pattern:
            out.append((n, taken.get(n, 0), u, sequence, offset))
            taken[n] = taken.get(n, 0) + many * u
            offset += n * u
        sequence += many
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
         end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    cut = materialize(pieces(docs, doc_id, text, tokenizer, end_id, capacity), "pieces")
    kind = cut.schema["doc_id"].dataType.simpleString()
    runs = materialize(cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-runs")
    counts = {n: c for n, c in runs.groupBy("length").agg(F.sum("n")).collect()}  # at most capacity rows
    table = intervals(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = runs.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (cut.withColumn("place", F.row_number().over(within) - 1)
              .join(F.broadcast(firsts), ["length", "salt"])  # at most capacity * SALTS rows
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank")))

    def locate(batches: Iterator) -> Iterator:
        import pyarrow as pa
        key = (table[:, 0] << 40) | table[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = table[np.searchsorted(key, (length << 40) | rank, "right") - 1]
            at = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(row[:, 3] + at // row[:, 2]), pa.array(row[:, 4] + at % row[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(locate, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
