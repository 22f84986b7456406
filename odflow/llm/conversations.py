r"""Repair of the turn structure of conversations.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Its rows, in
order of turn, are edited: Keep costs 0, Rerole to user or assistant 1, Delete
2, Insert of an empty user or assistant text 5; a truncated row that stays
costs 5 more, and blank rows and repeats of an earlier role and text must go.
The cheapest edits are a shortest path in the lattice of (rows done, state),
where the state says what the output ends in: nothing, s, u or a.  A state and
a letter fix the role that comes out, so the letters of a path name it.

``prices`` is the auction algorithm for shortest paths: a path from a node is
extended along the arc that its price makes cheapest, or contracted with the
price raised to that of its best arc.  Paths start at the nodes of the last
rows first and keep all prices; a layer's prices start at the least of the next
layer's, which no arc undercuts.  On return every price is the exact distance,
so the arcs ``price = cost + price`` are those of shortest paths, and ``trace``
follows the least letter among them.

Rows are sorted over the cluster by ranges of (conversation, turn, role, text,
row), so a conversation of a third of all rows is spread over many tasks.
Conversations inside one task and of at most BLOCK_ROWS rows and BLOCK_CHARS
characters, nearly all, are done in the task that sorts them.  The others leave
it as blocks, and go on by themselves: repeats by a grouping of hashed rows,
the cost from every entry state to every exit state of a block by the same
auction, these costs chained from the last block to the first (one small row a
block), every block traced from each entry state, and the traces chained
forward.  Only what the result holds in one value, the audit and the digest of
the repaired text, is put together in one task for each conversation: one
letter a row, and texts streamed through a running hash.

Rows of one turn are ordered by role, text (their first KEY_CHARS characters,
then a hash) and copies stay beside each other.  A null conv_id is a
conversation of its own; nulls count as one space, and null turns come first
and are left out of the gaps.  A role that does not begin with s, u or a, an
empty one included, cannot be kept.  Conversations without rows after the
damage, and those whose rows are all deleted, have an empty audit or one of
D only, and the hash of the empty text.  An empty table gives no rows; only the
four columns named are read.
"""

from __future__ import annotations

import hashlib
from math import inf

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import stored, table

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, system, user, assistant.  Role that may come next, and the state after it.
EXPECTED, AFTER = "uuau", {"s": 1, "u": 2, "a": 3}
FULL = {"u": "user", "a": "assistant"}
#: Cost and letters to end from each state.
TAIL, TAIL_LETTERS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
#: States that can be reached from each.
LATER = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
BLOCK_ROWS = 512
BLOCK_CHARS = 1 << 21
KEY_CHARS = 64
MEMORY = 50_000
LEGAL = {"su", "ua", "au"}


# ------------------------------------------------------------ the lattice of one block

def arcs(row: str, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows done, state) of the edits before or of a row: its
    initial (o: another), in capitals if truncated, or x if it must go."""
    role = EXPECTED[state]
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, AFTER[role])]
    if row != "x":
        more, initial = (TRUNCATED if row.isupper() else 0), row.lower()
        if initial == role or (initial == "s" and state == 0):
            out.append(("K", more, 1, AFTER[initial]))
        out.append(("R", RETYPE + more, 1, AFTER[role]))
    return out


ARCS = {row: [arcs(row, state) for state in range(4)] for row in "suaoSUAOx"}


def prices(rows: str, ends: tuple) -> list[list]:
    """Exact distance from (rows done, state) to the end, where leaving after
    the last row in a state costs ``ends[state]`` (inf: not allowed)."""
    price = [list(ends)]
    hopeless = [all(ends[later] == inf for later in LATER[state]) for state in range(4)]
    for row in reversed(rows):
        after, out = price[-1], ARCS[row]
        floor = min(after)
        here = [inf if hopeless[state] else floor for state in range(4)]
        exact = hopeless.copy()
        for origin in (3, 2, 1, 0):
            path = [origin]         # states of this layer; the layer after it is exact already
            while path and not exact[path[-1]]:
                state = path[-1]
                cost, to = min((c + (after[q] if step else here[q]), -1 if step else q) for _, c, step, q in out[state])
                if here[state] < cost:                  # contract
                    here[state] = cost
                    if cost == inf:
                        exact[state] = True
                    if len(path) > 1:
                        path.pop()
                elif to < 0:                            # the arc ends in an exact node: so is the path
                    break
                else:                                   # extend
                    path.append(to)
            for state in path:
                exact[state] = True
        price.append(here)
    price.reverse()
    return price


def trace(rows: str, price: list[list], state: int) -> tuple[str, int]:
    """Least letters among the tight arcs from ``state``, and the state after the rows."""
    letters, done = [], 0
    while done < len(rows):
        for letter, cost, step, q in ARCS[rows[done]][state]:       # in order of the letters
            if price[done][state] == cost + price[done + step][q]:
                letters.append(letter)
                done, state = done + step, q
                break
        else:
            raise AssertionError("a node without a tight arc")
    return "".join(letters), state


def repaired(letters: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The output rows ``role:text`` that the letters make of the rows."""
    out, i = [], 0
    for letter in letters:
        if letter == "I":
            role = EXPECTED[state]
            out.append(f"{FULL[role]}:")
            state = AFTER[role]
            continue
        if letter == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state = AFTER[roles[i][0]]
        elif letter == "R":
            role = EXPECTED[state]
            out.append(f"{FULL[role]}:{texts[i]}")
            state = AFTER[role]
        i += 1
    return out


class Solver:
    """Shortest repairs of whole conversations; equal rows of classes are solved once."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, str]] = {}

    def __call__(self, rows: str) -> tuple[int, str]:
        if rows not in self.known:
            if len(self.known) >= MEMORY:
                self.known.clear()
            price = prices(rows, TAIL)
            letters, state = trace(rows, price, 0)
            self.known[rows] = price[0][0], letters + TAIL_LETTERS[state]
        return self.known[rows]


def classes(initials: str, faults: str) -> str:
    """Rows as the lattice reads them, from initials (s, u, a, o) and faults
    (b blank, d repeated, t truncated, - none)."""
    return "".join("x" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, faults))


def illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


# ------------------------------------------------------------ rows

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows changed by their key's CRC-32;
    dropped ones stay with ``gone``, so that every conversation stays."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    r = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    out = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(r == 4, F.lit("user")).otherwise(text["role"]).alias("role"),
        F.when(r.isin(0, 1), F.lit("")).when(r == 2, F.regexp_replace(text["text"], "[.!?]", "")).otherwise(text["text"]).alias("text"),
        (r == 0).alias("gone"), F.when(r == 3, 2).otherwise(1).alias("_times"))
    return out.withColumn("_copy", F.explode(F.expr("sequence(1, _times)"))).drop("_times", "_copy")


def marked(rows: DataFrame) -> DataFrame:
    """Adds ``initial`` (s, u, a, o) and ``fault``: b blank, t truncated, - neither."""
    end = F.right(F.expr(r"trim(TRAILING ' \t\n\u000b\f\r' FROM text)"), F.lit(1))
    first = F.substring("role", 1, 1)
    return rows.withColumns({
        "initial": F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o")),
        "fault": F.when(end == "", "b").when(end.isin(".", "!", "?"), "-").otherwise("t")})


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
BLOCK = "seq long, turns array<long>, roles array<string>, texts array<string>, initials string, faults string"


def in_order(rows: DataFrame) -> DataFrame:
    """Rows dealt by ranges of their order and sorted; copies spread by a row number."""
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, KEY_CHARS).asc(),
             F.substring("text", 1, KEY_CHARS).asc(), F.xxhash64("role", "text").asc(), F.col("_row").asc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")


def solved_or_cut(rows: DataFrame, block_rows: int, block_chars: int) -> DataFrame:
    """RESULT of the conversations that lie whole inside a task and a block,
    BLOCK of the others: the first and the last of a task, and long ones."""
    def result(solve, conv, turns, roles, texts, initials, faults):
        known = [t for t in turns if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        seen, marks = set(), []
        for fault, row in zip(faults, zip(roles, texts)):
            marks.append("d" if fault != "b" and row in seen else fault)
            seen.add(row)
        initials = "".join(initials)
        cost, audit = solve(classes(initials, marks))
        digest = hashlib.sha256("\n".join(repaired(audit, 0, roles, texts)).encode()).hexdigest()
        return (conv, gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal(initials), cost, audit, digest)

    names = [c.split()[0] for c in f"{RESULT}, {BLOCK}".split(", ")]
    n_result = len(RESULT.split(", "))

    def run(batches):
        solve, schema = Solver(), None
        task, n_blocks = TaskContext.get().partitionId() << 33, 0
        conv, now, size, whole, out = None, None, 0, False, []

        def block():
            nonlocal n_blocks, now, size
            n_blocks += 1
            out.append((conv, *[None] * (n_result - 1), task + n_blocks, now[0], now[1], now[2], "".join(now[3]), "".join(now[4])))
            now, size = ([], [], [], [], []), 0

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or row[0] != conv:
                    if now is not None and whole:
                        out.append((*result(solve, conv, *now), *[None] * (len(names) - n_result)))
                    elif now is not None:
                        block()
                    whole, conv = now is not None, row[0]
                    now, size = ([], [], [], [], []), 0
                if not row[6]:
                    if len(now[0]) >= block_rows or size >= block_chars:
                        whole = False
                        block()
                    for part, value in zip(now, row[1:6]):
                        part.append(value)
                    size += len(row[3])
            if out:
                yield as_batch(out)
                out = []
        if now is not None:
            block()
            yield as_batch(out)

    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string()]

    def as_batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rows.select("conv_id", "turn", "role", "text", "initial", "fault", "gone").mapInArrow(run, f"{RESULT}, {BLOCK}")


# ------------------------------------------------------------ conversations in blocks

def with_repeats(blocks: DataFrame) -> DataFrame:
    """(conv_id, seq, turns, initials, faults) with rows marked d that an
    earlier row of the conversation equals."""
    rows = blocks.select("conv_id", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "row"))
    key = F.sha2(F.concat(F.length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts").cast("binary"), 256)
    firsts = (rows.groupBy("conv_id", key.alias("key")).agg(F.min(F.struct("seq", "i")).alias("at"))
              .groupBy(F.col("at.seq").alias("_seq")).agg(F.collect_list("at.i").alias("_firsts")))
    joined = blocks.select("conv_id", "seq", "turns", "initials", "faults").join(firsts, F.col("seq") == F.col("_seq"), "left")
    marks = F.expr("""array_join(transform(filter(split(faults, ''), f -> f <> ''),
        (f, i) -> if(f = 'b' or array_contains(coalesce(_firsts, array()), i), f, 'd')), '')""")
    return joined.withColumn("faults", marks).drop("_seq", "_firsts")


def chained(blocks: DataFrame) -> DataFrame:
    """(conv_id, seq, rows, ends, gaps, blank, duplicate, truncated, illegal,
    cost): of every block what leaving it in each state costs, and the numbers
    of its conversation in the first block's row (null in the others)."""
    def costs(batches):
        for batch in batches:
            out = []
            for conv, seq, turns, initials, faults in zip(*[c.to_pylist() for c in batch.columns]):
                rows = classes(initials, faults)
                to = [prices(rows, tuple(0 if e == q else inf for q in range(4)))[0] for e in range(4)]
                known = [t for t in turns if t is not None]
                out.append((conv, seq, rows, initials[:1], initials[-1:], [*known[:1], *known[-1:]], len(set(known)),
                            [faults.count("b"), faults.count("d"), faults.count("t"), illegal(initials)],
                            [-1 if to[e][q] == inf else to[e][q] for q in range(4) for e in range(4)]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(),
                     pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["conv_id", "seq", "rows", "first", "last", "turns", "distinct", "counts", "costs"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    small = blocks.select("conv_id", "seq", "turns", "initials", "faults").mapInArrow(
        costs, "conv_id long, seq long, rows string, first string, last string, turns array<long>, distinct long, counts array<long>, costs array<long>")
    small = stored(small, "costs")

    def back(batches):
        for batch in batches:
            for conv, parts in zip(*[c.to_pylist() for c in batch.columns]):
                ends, found = list(TAIL), []
                gaps, last_turn, counts, last = 0, None, [0, 0, 0, 0], ""
                for p in reversed(parts):
                    found.append(ends)
                    costs = p["costs"]
                    ends = [min((costs[4 * q + e] + ends[e] for e in range(4) if costs[4 * q + e] >= 0), default=inf) for q in range(4)]
                found.reverse()
                distinct, first_turn = 0, None
                for p in parts:
                    counts = [a + b for a, b in zip(counts, p["counts"])]
                    if last and p["first"] and last + p["first"] not in LEGAL:
                        counts[3] += 1
                    last = p["last"] or last
                    if p["turns"]:
                        distinct += p["distinct"] - (p["turns"][0] == last_turn)
                        first_turn = p["turns"][0] if first_turn is None else first_turn
                        last_turn = p["turns"][1]
                gaps = last_turn - first_turn + 1 - distinct if first_turn is not None else 0
                whole = [gaps, *counts, ends[0]]
                for at in range(0, len(parts), 4096):
                    chunk = parts[at:at + 4096]
                    rows = [(conv, p["seq"], [-1 if e == inf else e for e in found[at + i]], whole if at + i == 0 else None)
                            for i, p in enumerate(chunk)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                        ["conv_id", "seq", "ends", "whole"])

    parts = F.sort_array(F.collect_list(F.struct("seq", "first", "last", "turns", "distinct", "counts", "costs")))
    ends = small.groupBy("conv_id").agg(parts.alias("parts")).mapInArrow(back, "conv_id long, seq long, ends array<long>, whole array<long>")
    ends = ends.select(F.col("seq").alias("_seq"), "ends", "whole")
    return small.select("conv_id", "seq", "rows").join(ends, F.col("seq") == F.col("_seq")).drop("_seq")


def traced(blocks: DataFrame) -> DataFrame:
    """(conv_id, seq, state, letters, whole): the letters of every block and
    the state before it; the last block's letters end the conversation."""
    def each(batches):
        for batch in batches:
            out = []
            for conv, seq, rows, ends, whole in zip(*[c.to_pylist() for c in batch.columns]):
                price = prices(rows, tuple(inf if e < 0 else e for e in ends))
                found = [trace(rows, price, q) if price[0][q] < inf else ("", -1) for q in range(4)]
                out.append((conv, seq, [s for _, s in found], [x for x, _ in found], whole))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             ["conv_id", "seq", "states", "letters", "whole"])

    def forward(batches):
        for batch in batches:
            for conv, parts in zip(*[c.to_pylist() for c in batch.columns]):
                state, out = 0, []
                for i, p in enumerate(parts):
                    after = p["states"][state]
                    more = TAIL_LETTERS[after] if i == len(parts) - 1 else ""
                    out.append((conv, p["seq"], state, p["letters"][state] + more, p["whole"]))
                    state = after
                for at in range(0, len(out), 4096):
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out[at:at + 4096]], k) for i, k in enumerate(kinds)],
                                                     ["conv_id", "seq", "state", "letters", "whole"])

    ways = blocks.select("conv_id", "seq", "rows", "ends", "whole").mapInArrow(
        each, "conv_id long, seq long, states array<long>, letters array<string>, whole array<long>")
    parts = F.sort_array(F.collect_list(F.struct("seq", "states", "letters", "whole")))
    return ways.groupBy("conv_id").agg(parts.alias("parts")).mapInArrow(
        forward, "conv_id long, seq long, state long, letters string, whole array<long>")


def from_blocks(blocks: DataFrame) -> DataFrame:
    """RESULT of the conversations that were cut into blocks."""
    ways = traced(chained(with_repeats(blocks))).withColumnsRenamed({"conv_id": "_conv", "seq": "_seq"})

    def edit(batches):
        for batch in batches:
            out = []
            for conv, seq, roles, texts, state, letters, whole in zip(*[c.to_pylist() for c in batch.columns]):
                lines = repaired(letters, state, roles, texts)
                out.append((conv, seq, "\n".join(lines), len(lines), letters, whole))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             ["conv_id", "seq", "piece", "n_lines", "letters", "whole"])

    def joined(batches):
        conv, started, digest, any_line, letters, numbers = None, False, None, False, [], None

        def row():
            values = (conv, *numbers, "".join(letters), digest.hexdigest())
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in RESULT.split(", ")])

        for batch in batches:
            for c, _, piece, n_lines, part, whole in zip(*[x.to_pylist() for x in batch.columns]):
                if not started or c != conv:
                    if started:
                        yield row()
                    conv, started, digest, any_line, letters, numbers = c, True, hashlib.sha256(), False, [], whole
                if n_lines:
                    digest.update((("\n" if any_line else "") + piece).encode())
                    any_line = True
                letters.append(part)
        if started:
            yield row()

    pieces = blocks.select("conv_id", "seq", "roles", "texts").join(ways, F.col("seq") == F.col("_seq")).select(
        "conv_id", "seq", "roles", "texts", "state", "letters", "whole").mapInArrow(
        edit, "conv_id long, seq long, piece string, n_lines long, letters string, whole array<long>")
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(joined, RESULT)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """RESULT for every conversation of ``rows`` (conv_id, turn, role, text and,
    true for rows that only name their conversation, gone)."""
    done = stored(solved_or_cut(in_order(marked(rows)), block_rows, block_chars), "conversations")
    names = [c.split()[0] for c in RESULT.split(", ")]
    blocks = done.filter("seq is not null").select("conv_id", "seq", "turns", "roles", "texts", "initials", "faults")
    return done.filter("seq is null").select(*names).unionByName(from_blocks(blocks))


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


ORACLE = r"""
WITH RECURSIVE step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
c AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS r FROM k, step),
d AS (
  SELECT conv_id, turn, CASE r WHEN 4 THEN 'user' ELSE role END AS role,
    CASE r WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE r WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE r <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last FROM d),
f AS (
  SELECT conv_id, turn, role, text, pos, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS ini,
    CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
      WHEN last IN ('.', '!', '?') THEN '-' ELSE 't' END AS fault FROM o),
ins AS (
  SELECT * FROM (VALUES
    (0, 0, '', []::VARCHAR[]), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
    (1, 1, '', []::VARCHAR[]), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
    (2, 2, '', []::VARCHAR[]), (2, 3, 'I', ['assistant:']),
    (3, 3, '', []::VARCHAR[]), (3, 2, 'I', ['user:'])) AS t(q, q1, pre, add)),
acts AS (
  SELECT conv_id, pos, q1, act, role, text, CASE act WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
      + CASE WHEN act <> 'D' AND fault = 't' THEN 5 ELSE 0 END AS cost,
    CASE act WHEN 'D' THEN q1 WHEN 'K' THEN CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE q1 WHEN 2 THEN 3 ELSE 2 END END AS q2
  FROM f, (VALUES (0), (1), (2), (3)) AS s(q1), (VALUES ('D'), ('K'), ('R')) AS a(act)
  WHERE act = 'D' OR (fault NOT IN ('b', 'd') AND (act = 'R' OR ini = CASE q1 WHEN 2 THEN 'a' ELSE 'u' END OR (ini = 's' AND q1 = 0)))),
best AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS q, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS b FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, q, b FROM (
    SELECT best.conv_id, acts.pos, acts.q2 AS q, min({'cost': b.cost + 5 * length(pre) + acts.cost, 'audit': b.audit || pre || act,
      'lines': b.lines || add || CASE act WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
        ELSE [CASE ins.q1 WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END}) AS b
    FROM best JOIN ins USING (q) JOIN acts ON acts.conv_id IS NOT DISTINCT FROM best.conv_id AND acts.pos = best.pos + 1 AND acts.q1 = ins.q1
    GROUP BY best.conv_id, acts.pos, acts.q2)),
n AS (
  SELECT conv_id, max(pos) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE bad) AS illegal
  FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini NOT IN ('su', 'ua', 'au') AS bad FROM f) GROUP BY conv_id),
w AS (
  SELECT best.conv_id, min({'cost': b.cost + CASE q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
    'audit': b.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'lines': b.lines || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END}) AS b,
    any_value(coalesce(gaps, 0)) AS gaps, any_value(coalesce(blank, 0)) AS blank, any_value(coalesce(duplicate, 0)) AS duplicate,
    any_value(coalesce(truncated, 0)) AS truncated, any_value(coalesce(illegal, 0)) AS illegal
  FROM best LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM best.conv_id WHERE pos = coalesce(n, 0) GROUP BY best.conv_id)
SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, b.cost::BIGINT AS cost, b.audit AS audit,
  sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM w
"""
