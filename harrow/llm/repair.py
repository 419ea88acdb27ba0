"""Conversation structure repair: the cheapest edits that make a conversation an optional system turn and user/assistant pairs.

Every row is a symbol: its role's initial and its fault. Equal consecutive symbols form a run, and a run of n rows moves the costs of
the four states through binary powers of the symbol's min-plus transition, which are computed once. Costs to the end are found run by run
from the back; choices are then unrolled from the front, smallest letter first.

A conversation of any length is cut into chunks of rows. A chunk is summed up by its 4 x 4 matrix, the matrices of a conversation
give the costs at every chunk's end, and each chunk is unrolled for all four entry states, so chunks run in parallel. Only the
digest of the repaired text, which is sequential by its definition, streams a conversation's rows through one task, in order and without holding them.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import batch, written
from harrow.operators import ordered

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
CHUNK_ROWS = 65_536
#: Longer runs are unrolled by halves.
STEP_ROWS = 64
FAR = 1 << 60
#: States: nothing yet, after system, after user (an assistant must follow), after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant row, whichever may come next, leads.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_AT = {USER: "user", ASSISTANT: "assistant"}
SPACE = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


# Symbols: s, u, a, o (other) by role initial, in capitals when truncated; b is blank, d a duplicate.


def _keep(state: int, symbol: str) -> int | None:
    """The state after an unchanged row, if it may stand there."""
    if symbol in "sS":
        return SYSTEM if state == START else None
    if symbol in "uU":
        return USER if state != USER else None
    return ASSISTANT if symbol in "aA" and state == USER else None


def edits(state: int, symbol: str):
    """(letter, cost, next state) of the edits of one row, by letter."""
    yield "D", DELETE, state
    if symbol not in "bd":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _keep(state, symbol)
        if kept is not None:
            yield "K", KEEP + extra, kept
        yield "R", REROLE + extra, NEXT[state]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def after(m: Matrix, f: Vector) -> Vector:
    """Costs to the end before the rows of `m`, from those after them."""
    return tuple(min(FAR, *(m[i][k] + f[k] for k in range(4))) for i in range(4))


def _inserted() -> Matrix:
    """Any number of inserted rows."""
    m = [[FAR] * 4 for _ in range(4)]
    for i in range(4):
        at, cost = i, 0
        for _ in range(3):
            m[i][at] = min(m[i][at], cost)
            at, cost = NEXT[at], cost + INSERT
    return tuple(map(tuple, m))


INSERTED = _inserted()
IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
#: Costs when no row is left: accepted before the first turn and after an assistant's.
END: Vector = tuple(min(INSERTED[i][START], INSERTED[i][ASSISTANT]) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """Transition of 2**k rows of one symbol, rows inserted before each of them included."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    m = [[FAR] * 4 for _ in range(4)]
    for i in range(4):
        for _, cost, to in edits(i, symbol):
            m[i][to] = min(m[i][to], cost)
    return times(INSERTED, tuple(map(tuple, m)))


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def _bits(n: int):
    return (k for k in range(n.bit_length()) if n >> k & 1)


@lru_cache(maxsize=65_536)
def transition(symbols: str) -> Matrix:
    """The matrix of a whole chunk."""
    m = IDENTITY
    for symbol, n in runs(symbols):
        for k in _bits(n):
            m = times(m, power(symbol, k))
    return m


def _unroll(symbol: str, n: int, state: int, end: Vector, out: list[str]) -> int:
    """Letters of a run of n rows entered in `state`, whose costs after it are `end`; returns the state after it."""
    if n > STEP_ROWS:
        k = n.bit_length() - 1
        k -= n == 1 << k
        state = _unroll(symbol, n - (1 << k), state, after(power(symbol, k), end), out)
        return _unroll(symbol, 1 << k, state, end, out)
    one, costs = power(symbol, 0), [end]
    for _ in range(n):
        costs.append(after(one, costs[-1]))
    for left in range(n, 0, -1):
        here, then = costs[left], costs[left - 1]
        while True:
            best = {letter: to for letter, cost, to in edits(state, symbol) if cost + then[to] == here[state]}
            if "D" not in best and INSERT + here[NEXT[state]] == here[state]:
                out.append("I")
                state = NEXT[state]
                continue
            letter = min(best)
            out.append(letter)
            state = best[letter]
            break
    return state


@lru_cache(maxsize=65_536)
def choices(symbols: str, state: int, end: Vector, last: bool) -> tuple[str, int]:
    """(letters, state after) of the cheapest edits of a chunk, ASCII-least among equals; rows are added behind the last one if needed."""
    parts = runs(symbols)
    ends = [end]
    for symbol, n in reversed(parts):
        f = ends[-1]
        for k in _bits(n):
            f = after(power(symbol, k), f)
        ends.append(f)
    out: list[str] = []
    for i, (symbol, n) in enumerate(parts):
        state = _unroll(symbol, n, state, ends[len(parts) - 1 - i], out)
    while last and state in (SYSTEM, USER):
        out.append("I")
        state = NEXT[state]
    return "".join(out), state


# Rows


def damaged(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): rows after damage chosen by crc32 of `conv_id:turn`, null as one space."""
    base = convs.select(
        convs["conv_id"].cast("long").alias("conv_id"),
        convs["turn"].cast("long").alias("turn"),
        *[F.coalesce(convs[c].cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(named.cast("binary")) % 20
    hit = base.withColumn("kind", kind).where("kind <> 0")
    return hit.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def _symbol(role: Column, text: Column, duplicate: Column) -> Column:
    solid = F.rtrim(text, F.lit(SPACE))
    initial = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise(F.lit("o"))
    marked = F.substring(solid, -1, 1).isin(".", "!", "?")
    return F.when(solid == "", F.lit("b")).when(duplicate, F.lit("d")).when(marked, initial).otherwise(F.upper(initial))


def symbols(rows: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """`rows` with pos (from 0 in each conversation) and symbol. Order: turn (nulls first), role, text (64 characters, then its digest)."""
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    keyed = rows.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", digest)
    numbered = ordered.over_order(keyed, ["conv_id"], ["turn", "role", "head", "digest", "copy"], {"pos": ordered.row_number()}, hot_rows)
    numbered = written(numbered.withColumn("pos", F.col("pos") - 1).drop("head", "copy"), "turns")
    again = numbered.groupBy("conv_id", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = ordered.join_groups(numbered, again, ["conv_id", "digest"], "left")
    duplicate = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    return written(joined.select("conv_id", "turn", "role", "text", "pos", _symbol(F.col("role"), F.col("text"), duplicate).alias("symbol")), "symbols")


_LETTERS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("audit", pa.string())])


def _ends(batches):
    """Costs at the end of every chunk, from the matrices of all chunks of the conversation."""
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("f", pa.list_(pa.int64())), ("last", pa.bool_())])
    for b in batches:
        out: list[tuple] = []
        for conv, chunks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f = END
            for i, c in enumerate(reversed(chunks)):
                out.append((conv, c["chunk"], list(f), i == 0))
                m = c["m"]
                f = after(tuple(tuple(m[r : r + 4]) for r in range(0, 16, 4)), f)
        yield batch(schema, *(zip(*out) if out else [[]] * 4))


def _matrices(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("m", pa.list_(pa.int64()))])
    for b in batches:
        yield batch(schema, b.column(0), b.column(1), [[x for row in transition(s) for x in row] for s in b.column(2).to_pylist()])


def _options(batches):
    """Letters and exit of every chunk, for each entry state."""
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("letters", pa.list_(pa.string())), ("exits", pa.list_(pa.int32()))])
    for b in batches:
        rows = zip(*(b.column(i).to_pylist() for i in range(5)))
        # A first chunk is entered at the start only.
        found = [(conv, chunk, [choices(s, e, tuple(f), last) for e in range(4 if chunk else 1)]) for conv, chunk, s, f, last in rows]
        yield batch(schema, [x[0] for x in found], [x[1] for x in found], [[a for a, _ in x[2]] for x in found], [[e for _, e in x[2]] for x in found])


def _entries(batches):
    """Entry state of every chunk, from the exits of those before it."""
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("entry", pa.int32())])
    for b in batches:
        out = []
        for conv, chunks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            state = START
            for c in chunks:
                out.append((conv, c["chunk"], state))
                state = c["exits"][state]
        yield batch(schema, *(zip(*out) if out else [[]] * 3))


def _by_conversation(df: DataFrame, value: str) -> DataFrame:
    """One row per conversation with its chunks in order; a chunk stands for `chunk_rows` rows, so the list is short."""
    return df.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", value))).alias("chunks"))


def audits(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(conv_id, chunk, audit): letters of the cheapest edits for every chunk of rows with conv_id, pos and symbol."""
    placed = rows.select("conv_id", F.floor(F.col("pos") / chunk_rows).cast("long").alias("chunk"), "pos", "symbol")
    ordered_symbols = F.array_sort(F.collect_list(F.struct("pos", "symbol")))
    chunks = written(placed.groupBy("conv_id", "chunk").agg(F.array_join(F.transform(ordered_symbols, lambda x: x["symbol"]), "").alias("symbols")), "chunks")
    matrices = chunks.mapInArrow(_matrices, "conv_id long, chunk long, m array<long>")
    ends = _by_conversation(matrices, "m").mapInArrow(_ends, "conv_id long, chunk long, f array<long>, last boolean")
    options = ordered.join_groups(chunks, ends, ["conv_id", "chunk"]).mapInArrow(_options, "conv_id long, chunk long, letters array<string>, exits array<int>")
    options = written(options, "options")
    entries = _by_conversation(options.select("conv_id", "chunk", "exits"), "exits").mapInArrow(_entries, "conv_id long, chunk long, entry int")
    return ordered.join_groups(options, entries, ["conv_id", "chunk"]).select("conv_id", "chunk", F.expr("letters[entry]").alias("audit"))


SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_OUT = pa.schema(
    [("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


class _Conversation:
    """What is known of one conversation while its rows stream by."""

    def __init__(self, conv):
        self.conv, self.state, self.cost = conv, START, 0
        self.letters: list[str] = []
        self.todo = iter(())
        self.faults = {"b": 0, "d": 0, "T": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.turns = 0
        self.digest, self.empty = hashlib.sha256(), True

    def emit(self, role: str, text: str) -> None:
        if not self.empty:
            self.digest.update(b"\n")
        self.empty = False
        self.digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.cost += INSERT
        self.emit(ROLE_AT[self.state], "")

    def chunk(self, audit: str) -> None:
        self.letters.append(audit)
        self.todo = iter(audit)

    def row(self, turn, role: str, text: str, symbol: str) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        fault = "T" if symbol.isupper() else symbol
        if fault in self.faults:
            self.faults[fault] += 1
        while (letter := next(self.todo)) == "I":
            self.insert()
        for name, cost, to in edits(self.state, symbol):
            if name == letter:
                self.state = to
                self.cost += cost
        if letter != "D":
            self.emit(ROLE_AT[self.state] if letter == "R" else role, text)

    def result(self) -> tuple:
        for _ in self.todo:
            self.insert()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        gaps = (gaps + 2**63) % 2**64 - 2**63  # as long arithmetic does
        f = self.faults
        return (self.conv, gaps, f["b"], f["d"], f["T"], self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest())


def _replay(batches):
    """Rows come by conversation, position and kind: first a mark, before each chunk its letters, then the rows."""
    now = None
    for b in batches:
        done = []
        for conv, kind, turn, role, text, symbol in zip(*(b.column(i).to_pylist() for i in range(6))):
            if kind == 0:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv)
            elif kind == 1:
                now.chunk(text)
            else:
                now.row(turn, role, text, symbol)
        if done:
            yield batch(_OUT, *zip(*done))
    if now is not None:
        yield batch(_OUT, *zip(*[now.result()]))


def repaired(convs: DataFrame, chunk_rows: int = CHUNK_ROWS, hot_rows: int | None = None) -> DataFrame:
    """One row per conv_id of `convs`: faults of its rows after damage, cheapest edits and digest of the repaired text.

    Null role and text are one space; rows with a null conv_id are one conversation, returned with a null conv_id; null turns come
    first and do not count for gaps. Rows of one turn are ordered by role, then text, so repeated rows are neighbours (all but
    one are duplicates). A conversation that loses all rows has zeros, an empty audit and the digest of nothing. An empty table
    gives no rows. Only the four columns are read, so others cannot clash. A conversation's audit is one string, so Spark's 2 GB for a value limit its
    rows; nothing else does.
    """
    rows = symbols(damaged(convs), hot_rows)
    none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"))]
    empty = F.lit(None).cast("string")
    marks = convs.select(convs["conv_id"].cast("long").alias("conv_id")).distinct()
    marks = marks.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("kind"), *none, empty.alias("text"), empty.alias("symbol"))
    letters = audits(rows, chunk_rows)
    letters = letters.select("conv_id", (F.col("chunk") * chunk_rows).alias("pos"), F.lit(1).alias("kind"), *none, F.col("audit").alias("text"), empty.alias("symbol"))
    turns = rows.select("conv_id", "pos", F.lit(2).alias("kind"), "turn", "role", "text", "symbol")
    told = marks.unionByName(letters).unionByName(turns)
    told = told.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
    return told.select("conv_id", "kind", "turn", "role", "text", "symbol").mapInArrow(_replay, SCHEMA)
