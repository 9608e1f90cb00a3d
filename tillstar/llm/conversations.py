"""Conversation structure repair: the cheapest edits that make roles read ``(s?(ua)+)?``.

Rows of a conversation are ordered by turn. Each row's first fault counts: blank, duplicate (role and text
seen earlier in the conversation) or truncated. Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (a
must for blank and duplicate rows), Insert an empty user or assistant row anywhere 2; a truncated row that is not
deleted adds 1. The audit is the edits' initials in order; of the cheapest ones the ASCII-least is taken.

A node is (row, grammar state), with four states: begin, after system, after user, after assistant. The cost DP runs
backwards and keeps the arcs that lie on some cheapest way. Then prefix doubling: an optimal arc's rank
by its first letter becomes its rank by 2, 4, 8, ... letters of the least audit that begins with it, since the
rank of a doubled prefix is that of (its rank, the rank of the arc its pointer leads to). Ranks choose the first arc, the
doubled pointers list the whole path. Letters of the arcs out of a node differ, so each arc has one least successor.

No conversation has to fit a task. Rows are range partitioned by (conversation, turn, ...), so a long conversation
is cut into pieces that follow each other. Where it crosses a border the DP needs the four costs behind it: each
border piece gives a 4 x 4 (min, +) matrix, and the driver folds these few numbers (two border pieces a partition)
from the right; the state in which the path enters a piece is folded from the left in the same way. SHA-256 of a
conversation that crosses borders is inherently one stream: its rendered text passes through one task in parts of a
megabyte, never whole in memory; all others are hashed where their piece is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import cut, n_partitions, run_folder, table

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
CLASSES = " sua"                                # role initials; 0: any other
KEEPS = {(BEGIN, 1): SYSTEM, (BEGIN, 2): USER, (SYSTEM, 2): USER, (USER, 3): ASSISTANT, (ASSISTANT, 2): USER}
NEXT = (USER, USER, ASSISTANT, USER)            # where an inserted or reroled row leads
LEGAL = ((1, 2), (2, 3), (3, 2))                # su, ua, au
LETTERS = "DIKR"                                # in ASCII order
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
END = (0, 4, 2, 0)                              # cheapest ways to an accepted end from each state
FAR = 1 << 50
WHITE = " \t\n\x0b\x0c\r"
PART_BYTES = 1 << 20


# ---- rows, their order and their faults (DataFrame functions) ---------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage that CRC-32 of ``conv_id:turn`` modulo 20 says.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets role user. Nulls read as one
    space (in the key, role and text; a null turn or conv_id stays null itself).
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), harm.alias("harm")).where("harm != 0")
    rows = rows.withColumn("role", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")))
    rows = rows.withColumn("text", F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def in_order(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with ``piece`` and ``pos``: sorted by conversation, turn (nulls first), role and digest of the text.

    Equal rows are told apart by where they were read, so a row repeated without end is still cut into pieces.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    marked = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).select(
        "conv_id", "turn", "role", "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        last.alias("last"), F.monotonically_increasing_id().alias("seen"))
    by = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "digest", "seen"]
    dealt = marked.repartitionByRange(n_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut(dealt.select("conv_id", "turn", "role", "text", "digest", "last", F.spark_partition_id().alias("piece"), pos.alias("pos")), folder, "rows")


def with_faults(rows: DataFrame, folder: str) -> DataFrame:
    """(piece, pos, conv_id, cls, fault) of ordered rows. A duplicate lies behind the first row of its role and text."""
    place = F.shiftleft(F.col("piece").cast("long"), 33) + F.col("pos")
    cls = F.coalesce(*[F.when(F.substring("role", 1, 1) == CLASSES[k], F.lit(k)) for k in (1, 2, 3)], F.lit(0))
    thin = rows.select("piece", "pos", "conv_id", cls.alias("cls"), "role", "digest", "last", place.alias("place"))
    first = (thin.where("last != ''").groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    met = thin.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    fault = (F.when(F.col("last") == "", F.lit(BLANK)).when(F.col("place") > F.col("first"), F.lit(DUPLICATE))
             .when(~F.col("last").isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(FINE)))
    return cut(met.select("piece", "pos", "conv_id", "cls", fault.alias("fault")), folder, "faults")


# ---- cost DP and path ranking (inside tasks) ---------------------------------------------------------------------------

class Costs:
    """Backward steps of the DP, made on first use: (kind of row, costs behind it) -> costs before it and optimal arcs.

    Costs are kept less their minimum; few vectors occur, so a step is a dictionary look-up. ``tables[t][state][letter]``
    is the head of an optimal arc, ``4 * rows onward + state``, or -1.
    """

    def __init__(self):
        self.vectors: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, int]] = {}
        none = [[-1] * 4 for _ in range(4)]
        ending = [list(row) for row in none]
        for state in (SYSTEM, USER):
            ending[state][1] = NEXT[state]
        self.tables = [none, ending]            # behind a piece that another one follows; behind the last row

    def vector(self, costs) -> tuple[int, int]:
        least = min(costs)
        key = tuple(c - least if c < FAR else FAR for c in costs)
        if key not in self.ids:
            self.ids[key] = len(self.vectors)
            self.vectors.append(key)
        return self.ids[key], least

    def step(self, kind: int, behind: int) -> tuple[int, int, int]:
        found = self.steps.get((kind, behind))
        if found is None:
            out, cls, fault = self.vectors[behind], kind % 4, kind // 4
            more = CUT_SHORT if fault == TRUNCATED else 0
            ways = []
            for s in range(4):
                way = {0: (DELETE + out[s], 4 + s)}
                if fault < BLANK:
                    if (s, cls) in KEEPS:
                        way[2] = (more + out[KEEPS[s, cls]], 4 + KEEPS[s, cls])
                    way[3] = (REROLE + more + out[NEXT[s]], 4 + NEXT[s])
                ways.append(way)
            cost = [min(min(w[0] for w in way.values()), FAR) for way in ways]
            for _ in range(3):
                cost = [min(cost[s], INSERT + cost[NEXT[s]], FAR) for s in range(4)]
            arcs = [[-1] * 4 for _ in range(4)]
            for s in range(4):
                if cost[s] < FAR:
                    ways[s][1] = (INSERT + cost[NEXT[s]], NEXT[s])
                    for letter, (c, head) in ways[s].items():
                        if c == cost[s]:
                            arcs[s][letter] = head
            self.tables.append(arcs)
            found = self.steps[kind, behind] = (*self.vector(cost), len(self.tables) - 1)
        return found

    def before(self, kinds, behind) -> list[int]:
        """Costs before some rows, given those behind them."""
        v, total = self.vector(behind)
        for kind in reversed(kinds):
            v, least, _ = self.step(kind, v)
            total += least
        return [c + total if c < FAR else FAR for c in self.vectors[v]]


class Paths:
    """The optimal arcs of some fragments (rows ``ends[f-1]:ends[f]``), ranked by prefix doubling.

    ``behind``: the costs behind each fragment, None if its conversation ends there. Layer ``row + fragment`` holds
    the nodes before a row, one more layer those behind the fragment.
    """

    def __init__(self, kinds: list[int], ends: list[int], behind: list):
        costs, tables, start = Costs(), [0] * (len(kinds) + len(ends)), 0
        for f, (end, out) in enumerate(zip(ends, behind, strict=True)):
            tables[end + f] = 1 if out is None else 0
            v, _ = costs.vector(END if out is None else out)
            for row in range(end - 1, start - 1, -1):
                v, _, tables[row + f] = costs.step(kinds[row], v)
            start = end
        heads = np.asarray(costs.tables, np.int64)[tables]                        # layer, state, letter
        at = np.flatnonzero(heads >= 0)
        self.node, self.letter = at // 4, at % 4
        self.head = (self.node // 4) * 4 + heads.ravel()[at]
        n = len(at)
        number = np.full(heads.size, n)
        number[at] = np.arange(n)
        number = number.reshape(-1, 4)
        rank = np.append(self.letter + 1, 0)                                      # 0: the path has ended
        self.none = n

        def least_arc(nodes):
            """The arc of least rank out of each node, ``none`` if it has no arc."""
            ranks = np.where(number[nodes] < n, rank[number[nodes]], np.iinfo(np.int64).max)
            return number[nodes, ranks.argmin(1)]

        jump = np.append(least_arc(self.head), n).astype(np.int32)
        self.jumps = []
        while True:                              # ranks of 1, 2, 4, ... letters; pointers that many arcs onward
            self.jumps.append(jump)
            if (jump == n).all():
                break
            pair = rank * (n + 2) + rank[jump]
            pair[n] = -1
            rank = np.unique(pair, return_inverse=True)[1]
            jump = jump[jump]
        self.first = least_arc

    def follow(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least paths from ``nodes``: (number of the start, arc) in path order, by doubled pointers."""
        arcs = self.first(nodes)
        starts, steps = np.flatnonzero(arcs < self.none), np.zeros((arcs < self.none).sum(), np.int64)
        arcs = arcs[starts]
        for k in range(len(self.jumps) - 1, -1, -1):
            on = self.jumps[k][arcs]
            more = on < self.none
            arcs, starts, steps = np.append(arcs, on[more]), np.append(starts, starts[more]), np.append(steps, steps[more] + (1 << k))
        order = np.lexsort((steps, starts))
        return starts[order], arcs[order]


def _fragments(group: pa.Table) -> tuple[pa.Table, list[int]]:
    """A piece sorted by ``pos``, and the ends of its fragments (runs of one conversation)."""
    group = group.sort_by("pos").combine_chunks()
    ids = group.column("conv_id").combine_chunks().dictionary_encode()
    codes = np.asarray(ids.indices.fill_null(-1))
    return group, [*(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]


def _kinds(group: pa.Table) -> list[int]:
    return (np.asarray(group["cls"]) + 4 * np.minimum(np.asarray(group["fault"]), BLANK)).tolist()


def border_matrices(group: pa.Table) -> pa.Table:
    """The first and last fragment of a piece: costs from each state before it to each one behind it."""
    group, ends = _fragments(group)
    kinds, cls, costs = _kinds(group), group["cls"].to_pylist(), Costs()
    picked = [(0, ends[0])] if len(ends) == 1 else [(0, ends[0]), (ends[-2], ends[-1])]
    matrix = [[costs.before(kinds[a:b], [0 if s == t else FAR for s in range(4)]) for t in range(4)] for a, b in picked]
    return pa.table({
        "piece": group["piece"].take([0] * len(picked)), "conv_id": group["conv_id"].take([a for a, _ in picked]),
        "head": [a == 0 for a, _ in picked], "tail": [b == ends[-1] for _, b in picked],
        "matrix": pa.array([[m[t][s] for s in range(4) for t in range(4)] for m in matrix], pa.list_(pa.int64())),
        "first": pa.array([cls[a] for a, _ in picked], pa.int32()), "last": pa.array([cls[b - 1] for _, b in picked], pa.int32()),
    })


def exits_of(given: dict) -> Callable[[pa.Table], pa.Table]:
    """For the last fragment of a piece that its conversation leaves: the state behind it for each state before it."""
    def run(group: pa.Table) -> pa.Table:
        group, ends = _fragments(group)
        piece, start = group["piece"][0].as_py(), ends[-2] if len(ends) > 1 else 0
        paths = Paths(_kinds(group)[start:], [ends[-1] - start], [given[piece]["behind"]])
        starts, arcs = paths.follow(np.arange(4))
        last = np.append(starts[1:] != starts[:-1], True)
        return pa.table({"piece": group["piece"].take([0]), "exits": pa.array([(paths.head[arcs[last]] % 4).tolist()], pa.list_(pa.int64()))})
    return run


def edits_of(given: dict) -> Callable[[pa.Table], pa.Table]:
    """(piece, pos, conv_id, fault, illegal, audit, state, cost, whole) of every row of a piece.

    A row's audit holds the inserts before it, its own letter and, behind a conversation's last row, the closing
    inserts; ``state`` is the grammar state before all these.
    """
    def run(group: pa.Table) -> pa.Table:
        group, ends = _fragments(group)
        known = given.get(group["piece"][0].as_py(), {})
        n, f = len(group), len(ends)
        behind: list = [None] * f
        behind[-1] = known.get("behind")
        paths = Paths(_kinds(group), ends, behind)
        starts = np.array([0, *ends[:-1]])
        entry = (starts + np.arange(f)) * 4
        entry[0] += known.get("state", BEGIN)
        fragment, arcs = paths.follow(entry)
        row = np.minimum(paths.node[arcs] // 4 - fragment, np.asarray(ends)[fragment] - 1)
        letters = np.frombuffer(LETTERS.encode(), np.uint8)[paths.letter[arcs]].tobytes().decode()
        cut_at = np.searchsorted(row, np.arange(n + 1))                            # every row has a letter of its own
        audit = [letters[a:b] for a, b in zip(cut_at[:-1], cut_at[1:], strict=True)]
        fault, cls = np.asarray(group["fault"]), np.asarray(group["cls"])
        price = np.array([DELETE, INSERT, 0, REROLE])[paths.letter[arcs]]
        short = np.array(["D" not in a for a in audit], bool) & (fault == TRUNCATED)
        before = np.append(known.get("before", -1), cls[:-1])
        before[starts[1:]] = -1
        legal = (before < 0) | np.isin(before * 4 + cls, [a * 4 + b for a, b in LEGAL])
        whole = np.ones(n, bool)
        whole[:ends[0]] &= "state" not in known
        whole[starts[-1]:] &= "behind" not in known
        return pa.table({
            "piece": group["piece"], "pos": group["pos"], "conv_id": group["conv_id"], "fault": group["fault"], "illegal": pa.array((~legal).astype(np.int32)),
            "audit": pa.array(audit, pa.string()), "state": pa.array((paths.node[arcs[cut_at[:-1]]] % 4).astype(np.int32)),
            "cost": pa.array(np.bincount(row, price, n).astype(np.int64) + CUT_SHORT * short), "whole": pa.array(whole),
        })
    return run


def spoken(audit: str, state: int, role: str, text: str) -> Iterator[tuple[str, str]]:
    """The repaired rows (role, text) that a row with this audit gives."""
    for letter in audit:
        if letter == "K":
            state = KEEPS[state, max(CLASSES.find(role[:1]), 0)]
            yield role, text
        elif letter != "D":
            state = NEXT[state]
            yield "user" if state == USER else "assistant", text if letter == "R" else ""


# ---- the borders (driver: two small rows a partition) -------------------------------------------------------------------

def across_borders(faults: DataFrame) -> dict[int, dict]:
    """For pieces whose first or last conversation goes on beyond them: the costs ``behind``, the ``state`` in
    which the path enters, and the class of the row ``before``."""
    rows = faults.groupBy("piece").applyInArrow(
        border_matrices, f"piece int, {_key(faults)}, head boolean, tail boolean, matrix array<long>, first int, last int").collect()
    rows.sort(key=lambda r: (r["piece"], not r["head"]))
    given: dict[int, dict] = {}
    chains: list[list] = []
    for before, row in zip([None, *rows], rows, strict=False):
        if before is not None and before["tail"] and row["head"] and row["piece"] != before["piece"] and before["conv_id"] == row["conv_id"]:
            chains[-1].append(row)
            given.setdefault(row["piece"], {})["before"] = before["last"]
        else:
            chains.append([row])
    chains = [c for c in chains if len(c) > 1]
    for chain in chains:
        behind = list(END)
        for row, left in zip(chain[:0:-1], chain[-2::-1], strict=True):
            m = row["matrix"]
            behind = [min(m[4 * s + t] + behind[t] for t in range(4)) for s in range(4)]
            behind = [b - min(behind) for b in behind]
            given.setdefault(left["piece"], {})["behind"] = behind
    if chains:
        inner = [row["piece"] for chain in chains for row in chain[:-1]]
        exits = faults.where(F.col("piece").isin(inner)).groupBy("piece").applyInArrow(exits_of(given), "piece int, exits array<long>").collect()
        exits = {r["piece"]: r["exits"] for r in exits}
        for chain in chains:
            state = BEGIN
            for left, row in zip(chain, chain[1:], strict=False):
                state = given[row["piece"]]["state"] = exits[left["piece"]][state]
    return given


# ---- the operator ---------------------------------------------------------------------------------------------------------

def repair(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Ordered rows (conv_id, turn, role, text, ..., piece, pos) and their edits, both written below ``folder``.

    Null roles and texts read as one space, so such a text is blank; null turns come first; the rows without
    conv_id are a conversation of their own. Rows of one turn are ordered by role, then by the SHA-256 of the text;
    equal rows are duplicates of the first of them. An empty table gives no rows. Only the four columns named are
    read, so others cannot clash.
    """
    rows = in_order(rows, folder)
    faults = with_faults(rows, folder)
    given = across_borders(faults)
    edits = faults.groupBy("piece").applyInArrow(
        edits_of(given), f"piece int, pos long, {_key(faults)}, fault int, illegal int, audit string, state int, cost long, whole boolean")
    return rows, cut(edits, folder, "edits")


def _key(df: DataFrame) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}"


def _merged(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Each row's edit directly before the row, in order, a piece within one partition."""
    nothing = lambda kind: F.lit(None).cast(kind)
    both = edits.select("piece", "pos", F.lit(0).alias("kind"), "conv_id", nothing("string").alias("role"), nothing("string").alias("text"), "audit", "state", "whole").unionAll(
        rows.select("piece", "pos", F.lit(1), "conv_id", "role", "text", nothing("string"), nothing("int"), nothing("boolean")))
    return both.repartition(n_partitions(rows.sparkSession), "piece").sortWithinPartitions("piece", "pos", "kind")


def _pairs(batches: Iterable[pa.RecordBatch], types: list) -> Iterator[tuple]:
    """(conv_id, piece, pos, whole, audit, state, role, text) of merged rows; ``types[0]`` becomes the type of conv_id."""
    edit = None
    for batch in batches:
        types[0] = batch.column("conv_id").type
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for piece, pos, kind, conv, role, text, audit, state, whole in zip(*[part.column(k).to_pylist() for k in range(9)], strict=True):
                if kind == 0:
                    edit = (whole, audit, state)
                else:
                    yield conv, piece, pos, *edit, role, text


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, piece, pos, part, role, text): the repaired conversations, in the order of piece, pos and part."""
    def run(batches):
        types = [None, pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        out: list[tuple] = []

        def batch():
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for conv, piece, pos, _, audit, state, role, text in _pairs(batches, types):
            out.extend((conv, piece, pos, part, *said) for part, said in enumerate(spoken(audit, state, role, text)))
            if len(out) >= 256:
                yield batch()
        if out:
            yield batch()

    names = ["conv_id", "piece", "pos", "part", "role", "text"]
    return _merged(rows, edits).mapInArrow(run, f"{_key(rows)}, piece int, pos long, part int, role string, text string")


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of every conversation with rows."""
    key = _key(rows)
    parts = _merged(rows, edits).mapInArrow(digest_parts, f"{key}, piece int, part int, audit string, body binary, sha string")
    parts = cut(parts, run_folder(rows.sparkSession, "repaired"), "parts")
    joined = parts.where("sha is null").repartition("conv_id").sortWithinPartitions("conv_id", "piece", "part").mapInArrow(
        digest_whole, f"{key}, audit string, repaired_sha256 string")
    return parts.where("sha is not null").select("conv_id", "audit", F.col("sha").alias("repaired_sha256")).unionAll(joined)


def digest_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations within a piece: their digest. Others: their lines, each after a newline, a megabyte a row."""
    types = [None, pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string()]
    out: list[tuple] = []
    now, number, audit, body, held, sha = None, 0, [], [], 0, None

    def close(whole):
        nonlocal number, audit, body, held
        out.append((*now, number, "".join(audit), None if whole else b"".join(body), sha.hexdigest() if whole else None))
        number, audit, body, held = number + 1, [], [], 0

    def batch():
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "piece", "part", "audit", "body", "sha"])

    was_whole = True
    for conv, piece, _, whole, letters, state, role, text in _pairs(batches, types):
        if now != (conv, piece):
            if now is not None:
                close(was_whole)
            now, was_whole, number, sha, first = (conv, piece), whole, 0, hashlib.sha256(), True
        audit.append(letters)
        for who, said in spoken(letters, state, role, text):
            line = f"{who}:{said}".encode("utf-8", "surrogatepass")
            if whole:
                sha.update(line if first else b"\n" + line)
                first = False
            else:
                body.append(b"\n" + line)
                held += len(line)
        if held >= PART_BYTES:
            close(False)
        if len(out) >= 64:
            yield batch()
    if now is not None:
        close(was_whole)
        yield batch()


def digest_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose parts come one after the other. The first line's newline is left out."""
    done: list[tuple] = []
    now, sha, audit, begun, any_rows, kind = None, None, [], False, False, None
    for batch in batches:
        kind = batch.column(0).type
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            conv, letters, body = row.column(0)[0].as_py(), row.column(3)[0].as_py(), row.column(4)[0].as_py()
            if not any_rows or conv != now:
                if any_rows:
                    done.append((now, "".join(audit), sha.hexdigest()))
                now, sha, audit, begun, any_rows = conv, hashlib.sha256(), [], False, True
            audit.append(letters)
            sha.update(body if begun else body[1:])
            begun = begun or bool(body)
    if any_rows:
        done.append((now, "".join(audit), sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (kind, pa.string(), pa.string()), strict=True)], names=["conv_id", "audit", "repaired_sha256"])


def report(conversations: DataFrame, damaged: DataFrame, folder: str) -> DataFrame:
    """One row for every conv_id of ``conversations``: what repairing ``damaged`` found and did (see the module)."""
    rows, edits = repair(damaged, folder)
    turns = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    hits = lambda fault: F.sum((F.col("fault") == fault).cast("long"))
    counts = edits.groupBy("conv_id").agg(hits(BLANK).alias("blank"), hits(DUPLICATE).alias("duplicate"), hits(TRUNCATED).alias("truncated"),
                                          F.sum(F.col("illegal").cast("long")).alias("illegal"), F.sum("cost").alias("cost"))
    out = conversations.select("conv_id").distinct()
    for found in (turns, counts, digests(rows, edits)):
        found = found.withColumnRenamed("conv_id", "found")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").drop("found")
    zero: list[Column] = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return report(conversations, damage(conversations), run_folder(spark, "conversations"))


def oracle_sql() -> str:
    """DuckDB: the same DP by recursion over suffixes, with the audit and the repaired text carried along as strings."""
    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def way(cost: str, letter: str, line: str | None, behind: str) -> str:
        body = f"{behind}.body" if line is None else f"{line} || CASE WHEN {behind}.body = '' THEN '' ELSE chr(10) || {behind}.body END"
        return f"{{c: {cost} + {behind}.c, a: '{letter}' || {behind}.a, body: {body}}}"

    def row_ways(state: str, cls_next: dict[str, str], forced: str, said: str) -> str:
        """Ways over a row: delete, keep where the initial allows it, rerole."""
        never = "{c: 1000000000, a: '', body: ''}"
        keep = " ".join(f"WHEN NOT must AND left(r.role, 1) = '{c}' THEN {way('short', 'K', 'r.role || chr(58) || r.text', f'w.{n}')}" for c, n in cls_next.items())
        rerole = f"CASE WHEN must THEN {never} ELSE {way('2 + short', 'R', f'{said!r} || r.text', f'w.{forced}')} END"
        return least(way("3", "D", None, f"w.{state}"), f"CASE {keep} ELSE {never} END", rerole)

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) AS t(i)),
k AS (
  SELECT *, regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..') AS bytes,
    dense_rank() OVER (ORDER BY conv_id) AS conv FROM conversations),
h AS (
  SELECT conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || list_transform(bytes, lambda x: ('0x' || x)::BIGINT), lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 20 AS harm
  FROM k, crc_table),
damaged AS (
  SELECT conv, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
marked AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) AS nth FROM placed),
r AS (
  SELECT conv, turn, role, text, i, shown = '' AS blank, shown <> '' AND nth > 1 AS again,
    shown <> '' AND nth = 1 AND right(shown, 1) NOT IN ('.', '!', '?') AS cut_off, blank OR again AS must, CASE WHEN cut_off THEN 1 ELSE 0 END AS short,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair
  FROM marked),
w AS (
  SELECT conv, max(i) + 1 AS i, {{c: 0, a: '', body: ''}} AS b, {{c: 4, a: 'II', body: 'user:' || chr(10) || 'assistant:'}} AS s,
    {{c: 2, a: 'I', body: 'assistant:'}} AS u, {{c: 0, a: '', body: ''}} AS e FROM r GROUP BY conv
  UNION ALL
  SELECT conv, i, {least("b", way("2", "I", "'user:'", "u2"))} AS b, {least("s", way("2", "I", "'user:'", "u2"))} AS s, u2 AS u, {least("e", way("2", "I", "'user:'", "u"))} AS e
  FROM (SELECT *, {least("u", way("2", "I", "'assistant:'", "e"))} AS u2 FROM (
    SELECT w.conv, r.i, {row_ways("b", {"s": "s", "u": "u"}, "u", "user:")} AS b, {row_ways("s", {"u": "u"}, "u", "user:")} AS s,
      {row_ways("u", {"a": "e"}, "e", "assistant:")} AS u, {row_ways("e", {"u": "u"}, "u", "user:")} AS e
    FROM w JOIN r ON r.conv = w.conv AND r.i = w.i - 1))),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate,
    count(*) FILTER (WHERE cut_off) AS truncated, count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.b.c, 0)::BIGINT AS cost, coalesce(w.b.a, '') AS audit, sha256(coalesce(w.b.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM k) AS ids LEFT JOIN counts USING (conv) LEFT JOIN w ON w.conv = ids.conv AND w.i = 1"""
