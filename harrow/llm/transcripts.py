"""Chat formatting: speakers of unlabelled transcript lines by a hidden Markov model, then canonical turns.

States are (role, whether the line opens a turn). A line is seen as its speaker marker, its length and its ending. The counts
of a labelled table give the model. Viterbi runs over chunks of lines: each chunk is first reduced to a states x states
matrix of best scores, the matrices of a conversation (one per CHUNK lines) give the states at the chunk borders, and
then every chunk is decoded between its borders, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harrow.llm.common import written

ROLES = ("system", "user", "assistant")
CHUNK = 256
LENGTHS = 8
#: Speaker markers, lower case, by the kind they are read as. Which role a kind stands for is learnt.
MARKERS = {1: ("system", "instructions", "context"), 2: ("user", "human", "question", "q"), 3: ("assistant", "bot", "answer", "ai", "a")}
OBSERVATIONS = (len(MARKERS) + 1) * LENGTHS * 2
_MARKER = r"^\s*(?:[#<\[*]*)\s*([A-Za-z]+)\s*[\]>*]*\s*:\s*"


def observation(line: Column) -> Column:
    """Marker kind, length class (powers of two of 8 characters) and question mark, as one number."""
    word = F.lower(F.regexp_extract(line, _MARKER, 1))
    kind = F.lit(0)
    for k, names in MARKERS.items():
        kind = F.when(word.isin(*names), k).otherwise(kind)
    size = F.least(F.lit(LENGTHS - 1), F.floor(F.log2(F.length(line) / 8 + 1)))
    ask = F.rtrim(line).endswith("?").cast("int")
    return (kind * (LENGTHS * 2) + size * 2 + ask).cast("int")


def spoken(line: Column) -> Column:
    """The line without a known speaker marker."""
    word = F.lower(F.regexp_extract(line, _MARKER, 1))
    return F.when(word.isin(*[n for names in MARKERS.values() for n in names]), F.regexp_replace(line, _MARKER, "")).otherwise(line)


@dataclass
class Hmm:
    start: np.ndarray  # log, by state; state = 2 * role + opens
    step: np.ndarray
    emit: np.ndarray


def fit(lines: DataFrame) -> Hmm:
    """Counts of labelled lines (conv_id, line_no, line, role, opens), each plus one; lines of unknown role are not counted."""
    role = F.lit(None).cast("int")
    for i, r in enumerate(ROLES):
        role = F.when(F.col("role") == r, i).otherwise(role)
    state = (2 * role + F.col("opens").cast("int")).alias("state")
    seen = lines.select("conv_id", "line_no", state, observation(F.col("line")).alias("obs"))
    # The line before is found by its number, so one long conversation is not one task.
    next_ = seen.select("conv_id", (F.col("line_no") - 1).alias("line_no"), F.col("state").alias("to"))
    n = 2 * len(ROLES)
    start, step, emit = np.ones(n), np.ones((n, n)), np.ones((n, OBSERVATIONS))
    for r in seen.where("state is not null").groupBy("state", "obs").count().collect():  # at most n * OBSERVATIONS rows
        emit[r["state"], r["obs"]] += r["count"]
    for r in seen.where("line_no = 0 and state is not null").groupBy("state").count().collect():
        start[r["state"]] += r["count"]
    for r in seen.join(next_, ["conv_id", "line_no"]).where("state is not null and `to` is not null").groupBy("state", "to").count().collect():
        step[r["state"], r["to"]] += r["count"]
    return Hmm(np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), np.log(emit / emit.sum(1, keepdims=True)))


def chunk_matrices(model: Hmm, obs: list[np.ndarray]) -> np.ndarray:
    """Best score from the state before each chunk to its last state; all chunks step together."""
    n = len(model.start)
    size = np.array([len(o) for o in obs])
    order = np.argsort(-size, kind="stable")
    grid = np.zeros((len(obs), int(size.max(initial=0))), np.int64)
    for row, i in enumerate(order):
        grid[row, : size[i]] = obs[i]
    best = np.full((len(obs), n, n), -np.inf)
    best[:, np.arange(n), np.arange(n)] = 0
    for t in range(grid.shape[1]):
        live = int((size > t).sum())
        moved = (best[:live, :, :, None] + model.step[None, None, :, :]).max(2)
        best[:live] = moved + model.emit[:, grid[:live, t]].T[:, None, :]
    out = np.empty_like(best)
    out[order] = best
    return out


def decode(model: Hmm, obs: np.ndarray, before: int, last: int) -> np.ndarray:
    """The best states of a chunk, given the state before it (-1: the conversation starts here) and its last state."""
    n, m = len(model.start), len(obs)
    back = np.zeros((m, n), np.int64)
    score = (model.start if before < 0 else model.step[before]) + model.emit[:, obs[0]]
    for t in range(1, m):
        moved = score[:, None] + model.step
        back[t] = moved.argmax(0)
        score = moved.max(0) + model.emit[:, obs[t]]
    states = np.empty(m, np.int64)
    states[-1] = last
    for t in range(m - 1, 0, -1):
        states[t - 1] = back[t, states[t]]
    return states


def borders(model: Hmm, first: np.ndarray, matrices: np.ndarray) -> np.ndarray:
    """Last state of every chunk on the best path: `first` holds the start scores after chunk 0, `matrices` the other chunks."""
    score, back = first, []
    for m in matrices:
        moved = score[:, None] + m
        back.append(moved.argmax(0))
        score = moved.max(0)
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return np.array(out[::-1])


def _chunks(lines: DataFrame) -> DataFrame:
    obs = observation(F.col("line"))
    pairs = F.sort_array(F.collect_list(F.struct("line_no", obs.alias("obs"))))
    grouped = lines.groupBy("conv_id", F.expr(f"line_no div {CHUNK}").alias("chunk")).agg(pairs.alias("o"))
    return grouped.select("conv_id", "chunk", F.col("o.obs").alias("obs"))


def labelled(lines: DataFrame, model: Hmm) -> DataFrame:
    """(conv_id, line_no, role, opens) of transcript lines (conv_id, line_no from 0 without holes, line)."""
    chunks = written(_chunks(lines), "chunks")
    n = len(model.start)

    def reduced(batches):
        for df in batches:
            obs = [np.asarray(o) for o in df["obs"]]
            m = chunk_matrices(model, obs)
            for i in np.flatnonzero(df["chunk"].to_numpy() == 0):  # the first line starts from `start`
                first = np.full(n, -np.inf)
                score = model.start + model.emit[:, obs[i][0]]
                if len(obs[i]) > 1:
                    rest = chunk_matrices(model, [obs[i][1:]])[0]
                    first = (score[:, None] + rest).max(0)
                else:
                    first = score
                m[i] = first[None, :]
            yield pd.DataFrame({"conv_id": df["conv_id"], "chunk": df["chunk"], "m": [x.ravel().tolist() for x in m]})

    def ends(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["conv_id", "chunk"], ignore_index=True)
        m = np.array(df["m"].tolist()).reshape(-1, n, n)
        at = np.flatnonzero(np.concatenate([[True], df["conv_id"].to_numpy()[1:] != df["conv_id"].to_numpy()[:-1]]))
        last = np.concatenate([borders(model, m[s][0], m[s + 1 : e]) for s, e in zip(at, [*at[1:], len(df)])])
        before = np.concatenate([[-1], last[:-1]])
        before[at] = -1
        return pd.DataFrame({"conv_id": df["conv_id"], "chunk": df["chunk"], "before": before, "last": last})

    matrices = chunks.mapInPandas(reduced, "conv_id long, chunk long, m array<double>")
    parts = 4 * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.pmod(F.xxhash64("conv_id"), F.lit(parts))
    marked = matrices.withColumn("task", task).groupBy("task").applyInPandas(lambda df: ends(df.drop(columns="task")), "conv_id long, chunk long, before long, last long")

    def states(batches):
        for df in batches:
            out = []
            for c, k, o, b, e in zip(df["conv_id"], df["chunk"], df["obs"], df["before"], df["last"]):
                s = decode(model, np.asarray(o), int(b), int(e))
                out.append(pd.DataFrame({"conv_id": c, "line_no": k * CHUNK + np.arange(len(s)), "state": s}))
            yield pd.concat(out) if out else pd.DataFrame({"conv_id": [], "line_no": [], "state": []}).astype("int64")

    found = chunks.join(marked, ["conv_id", "chunk"]).mapInPandas(states, "conv_id long, line_no long, state long")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), (F.col("state").cast("int") / 2).cast("int") + 1)
    return found.select("conv_id", "line_no", role.alias("role"), (F.col("state") % 2 == 1).alias("opens"))


def turns(lines: DataFrame, model: Hmm) -> DataFrame:
    """Canonical turns: conv_id, turn (from 0), role, n_lines, rendered.

    A turn begins at a line that opens one or where the role changes. Rendered: <|role|>, line feed, the lines without speaker markers,
    <|end|>. Turn numbers come from counts per chunk of lines.
    """
    lab = labelled(lines, model).withColumn("chunk", F.expr(f"line_no div {CHUNK}"))
    body = lines.select("conv_id", "line_no", spoken(F.col("line")).alias("line"))
    before = lab.select("conv_id", (F.col("line_no") + 1).alias("line_no"), F.col("role").alias("was"))
    rows = lab.join(before, ["conv_id", "line_no"], "left").join(body, ["conv_id", "line_no"])
    begins = (F.col("was").isNull() | F.col("opens") | (F.col("was") != F.col("role"))).cast("int")
    rows = written(rows.select("conv_id", "chunk", "line_no", "role", "line", begins.alias("begins")), "labelled")
    counts = rows.groupBy("conv_id", "chunk").agg(F.sum("begins").alias("n"))  # one row per CHUNK lines
    upto = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("conv_id", "chunk", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inner = Window.partitionBy("conv_id", "chunk").orderBy("line_no")
    numbered = rows.withColumn("k", F.sum("begins").over(inner)).join(base, ["conv_id", "chunk"]).withColumn("turn", F.col("base") + F.col("k") - 1)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    out = numbered.groupBy("conv_id", "turn").agg(F.first("role").alias("role"), F.count(F.lit(1)).alias("n_lines"), text.alias("text"))
    rendered = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>"))
    return out.select("conv_id", "turn", "role", "n_lines", rendered.alias("rendered"))


#: How a table of turns is written down as raw transcripts: names of the speakers by style.
STYLES = {"system": ("System", "Instructions", "Context"), "user": ("User", "Human", "Q"), "assistant": ("Assistant", "Bot", "A")}


def transcript_lines(conversations: DataFrame, unmarked: int = 4) -> DataFrame:
    """Raw lines of a table of turns (conv_id, turn, role, text): conv_id, line_no, line, role, opens.

    A style per conversation names the speakers; one turn in `unmarked`, by hash, has no marker. role and opens are the
    truth to learn from and compare with; the parser reads only conv_id, line_no and line. Turns with a null
    conv_id are left out; null text is an empty line; null turns come first; turns that share a number follow by role and text.
    """
    c = conversations.select(*[conversations[x] for x in ("conv_id", "turn", "role", "text")]).where(F.col("conv_id").isNotNull())
    c = c.withColumn("text", F.coalesce("text", F.lit("")))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(3)).cast("int") + 1
    name = F.lit(None).cast("string")
    for r, names in STYLES.items():
        name = F.when(F.col("role") == r, F.element_at(F.array(*[F.lit(x) for x in names]), style)).otherwise(name)
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit(5)), F.lit(unmarked)) == 0
    lines = F.split(F.when(name.isNull() | bare, F.col("text")).otherwise(F.concat(name, F.lit(": "), "text")), "\n")
    # Lines of a turn stay together until they are numbered: one row per turn here.
    per_turn = c.select("conv_id", "turn", "role", lines.alias("lines"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "lines").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_turn.withColumn("base", F.coalesce(F.sum(F.size("lines")).over(order), F.lit(0)))
    spread = placed.select("conv_id", "role", "base", F.posexplode("lines").alias("k", "line"))
    return spread.select("conv_id", (F.col("base") + F.col("k")).cast("long").alias("line_no"), "line", "role", (F.col("k") == 0).alias("opens"))
