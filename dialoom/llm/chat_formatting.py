"""Chat transcripts: a hidden Markov model recovers who speaks, then turns are rendered canonically.

A transcript is lines. Every line is an observation: the kind of its speaker marker (if any), whether it
opens a paragraph, its length, and how it ends. The states are role x (begins a turn, goes on); their
transition and emission tables are counted, with a little added to each, over all conversations whose roles
are known and that are not held out (crc32 of the conv_id as text, mod 5, is not 2). Viterbi decoding gives
the likeliest state of each line, so a turn whose marker is missing or misleading is still told by what
stands around it. Only markers in the transcript's own style count as markers; they are cut off, lines of a
turn are joined, and each turn is rendered as ``<|im_start|>role\\ncontent<|im_end|>``. Marks that a content
holds itself are escaped by a backslash behind their ``<`` (``unescaped`` takes it away again).

A conversation of any length is decoded as a whole. Its turns are dealt into blocks of ``BLOCK`` turns; a
block of a longer conversation becomes the table of its best scores from each state before it to each state
at its end, the tables are multiplied up in levels, and the best states at the blocks' ends come down the
levels again. So no task holds more than ``BLOCK`` turns or ``FAN`` tables of one conversation. A block is one
row of the result (``part``); the texts of a conversation's parts in order are its rendering.

Defined results: every row is a turn, repeated rows too; a null or empty text is a turn with an empty content
line; null roles, and roles that the model does not know, are written without a marker; turns of one number are
ordered by role, then a hash of the text, nulls first; null turns come first; rows with a null conv_id are one
conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, shuffle_partitions

ROLES = ("system", "user", "assistant")
#: Turns of a block, and tables that are multiplied at once.
BLOCK, FAN = 256, 64

SPEAKERS = {"user": "user human question q customer client me prompt".split(), "assistant": "assistant ai bot answer a agent model gpt response".split(), "system": "system instruction instructions context sys".split()}
KIND_OF = {name: role for role, names in SPEAKERS.items() for name in names}
MARKER = re.compile(r"(#{1,4}[ ]|\*\*|<\|?|\[|> )?([A-Za-z]{1,12})(\|?>|\]|\*\*)?(:(?:\*\*)?)?( |$)", re.ASCII)
#: How the writers of transcripts mark speakers; {} is the role's name.
STYLES = ("{}: ", "[{}] ", "<|{}|> ", "**{}**: ", "### {}:\n", "{}:\n")
LABELS = ({"user": "User", "assistant": "Assistant", "system": "System"}, {"user": "Human", "assistant": "AI", "system": "System"}, {"user": "Q", "assistant": "A", "system": "Context"}, {"user": "Customer", "assistant": "Agent", "system": "Instructions"})
MARK = re.compile(r"<(\\*)\|im_")


def escaped(content: str) -> str:
    return MARK.sub(r"<\1\\|im_", content) if "|im_" in content else content


def unescaped(content: str) -> str:
    return re.sub(r"<(\\*)\\\|im_", r"<\1|im_", content)


def held_out(conv_id: Column) -> Column:
    return F.coalesce(F.crc32(conv_id.cast("string").cast("binary")) % 5 == 2, F.lit(False))


def split_marker(line: str) -> tuple[str | None, tuple, int]:
    """(role that a marker names, its style, where the rest of the line begins)."""
    m = MARKER.match(line)
    if m is None or not (m[1] and m[3] or m[4]):
        return None, (), 0
    role = KIND_OF.get(m[2].lower())
    return (role, (m[1], m[3], m[4], bool(m[5])), m.end()) if role else (None, (), 0)


class Lines:
    """What the lines of a block look like: roles that markers in the block's own style name, and where contents begin."""

    def __init__(self, lines: list[str], blank_before: bool = True):
        found = [split_marker(line) for line in lines]
        styles = Counter(style for role, style, _ in found if role)
        own = min(styles, key=lambda s: (-styles[s], str(s))) if styles else None
        self.lines = lines
        self.roles = [role if style == own else None for role, style, _ in found]
        self.begins = [at if role else 0 for role, (_, _, at) in zip(self.roles, found, strict=True)]
        self.seen = np.zeros((len(lines), FEATURES), np.int64)
        blank = blank_before
        for k, line in enumerate(lines):
            rest = line[self.begins[k] :].strip()
            empty = not line.strip()
            self.seen[k] = 0 if self.roles[k] is None else 1 + ROLES.index(self.roles[k]), 2 if empty else int(blank), min(7, int(math.log2(len(rest) + 1))) * 2 + rest.endswith("?")
            blank = empty


def style_of(conversation: str) -> tuple[str, dict[str, str]]:
    h = xxhash.xxh32_intdigest(conversation)
    return STYLES[h % len(STYLES)], LABELS[(h >> 8) % len(LABELS)]


def write_turn(role: str | None, text: str | None, conversation: str, k: int) -> tuple[list[str], int]:
    """(lines of turn k of a transcript, the line that begins it). About one marker in nine is missing; a blank line stands in its place."""
    style, label = style_of(conversation)
    lines = (text or "").split("\n")
    if role in label and (k == 0 or xxhash.xxh32_intdigest(f"{conversation}/{k}") % 9 != 0):
        head = style.format(label[role])
        if head.endswith("\n"):
            return [head[:-1], *lines], 0
        return [head + lines[0], *lines[1:]], 0
    return (["", *lines], 1) if k else (lines, 0)


FEATURES = 3
SIZES = (4, 3, 16)
STATES = 2 * len(ROLES)  # 2 * role + (1 if the line goes on)


class Model:
    def __init__(self, counts: np.ndarray | None = None):
        self.start = np.ones(STATES)
        self.start[1::2] = 1e-3
        self.move = np.ones((STATES, STATES)) * 0.1
        for r in range(len(ROLES)):  # a line goes on only within its role
            self.move[:, 2 * r + 1] = 1e-6
            self.move[2 * r : 2 * r + 2, 2 * r + 1] = 1
        self.emit = [np.ones((STATES, n)) for n in SIZES]
        if counts is not None:
            for table in (self.start, self.move, *self.emit):
                table += counts[: table.size].reshape(table.shape)
                counts = counts[table.size :]

    def count(self, seen: np.ndarray, states: np.ndarray, first: bool, enter: int = -1) -> None:
        """Adds lines with their states, ``enter`` before the first of them; -1: not known."""
        known = states >= 0
        if first and known[0]:
            self.start[states[0]] += 1
        if enter >= 0 and known[0]:
            self.move[enter, states[0]] += 1
        pairs = known[1:] & known[:-1]
        np.add.at(self.move, (states[:-1][pairs], states[1:][pairs]), 1)
        for f in range(FEATURES):
            np.add.at(self.emit[f], (states[known], seen[known, f]), 1)

    def flat(self) -> np.ndarray:
        return np.concatenate([t.reshape(-1) for t in (self.start, self.move, *self.emit)])

    def logs(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        return np.log(self.start / self.start.sum()), np.log(self.move / self.move.sum(1, keepdims=True)), [np.log(e / e.sum(1, keepdims=True)) for e in self.emit]


def viterbi(seen: np.ndarray, logs, enter: int | None = None, leave: int | None = None) -> list[int]:
    """The likeliest states; ``enter``: the state before the first line, ``leave``: the state of the last one."""
    start, move, emit = logs
    every = sum(emit[f][:, seen[:, f]] for f in range(FEATURES))
    score = (start if enter is None else move[enter]) + every[:, 0]
    back = np.empty((len(seen), STATES), np.int8)
    for k in range(1, len(seen)):
        via = score[:, None] + move
        back[k] = via.argmax(0)
        score = via.max(0) + every[:, k]
    path = [int(score.argmax()) if leave is None else leave]
    for k in range(len(seen) - 1, 0, -1):
        path.append(int(back[k, path[-1]]))
    return path[::-1]


def block_table(seen: np.ndarray, logs, first: bool) -> np.ndarray:
    """(STATES, STATES): the best score from each state before the block to each state at its end; the first block starts from the model."""
    start, move, emit = logs
    every = sum(emit[f][:, seen[:, f]] for f in range(FEATURES))
    score = np.tile(start, (STATES, 1)) + every[:, 0] if first else move + every[:, 0]
    for k in range(1, len(seen)):
        score = (score[:, :, None] + move).max(1) + every[:, k]
    return score


def product_of(tables: list[np.ndarray]) -> np.ndarray:
    out = tables[0]
    for t in tables[1:]:
        out = (out[:, :, None] + t).max(1)
    return out


def boundaries(tables: list[np.ndarray], enter: int, leave: int | None) -> list[int]:
    """The state at the end of each table's block, on the best way from ``enter`` to ``leave``."""
    score, back = tables[0][enter], []
    for t in tables[1:]:
        via = score[:, None] + t
        back.append(via.argmax(0))
        score = via.max(0)
    path = [int(score.argmax()) if leave is None else leave]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def render(block: Lines, states: list[int], first: bool, last: bool) -> tuple[str, list[str]]:
    """(text, roles of the turns that begin here). A turn is closed where the next one begins, so parts of a conversation join up."""
    roles, out, lines, fresh = [], [], block.lines, False
    for k, (line, state) in enumerate(zip(lines, states, strict=True)):
        if state % 2 == 0 or first and k == 0:
            role = ROLES[state // 2]
            if roles or not first:
                out.append("<|im_end|>\n")
            roles.append(role)
            out.append(f"<|im_start|>{role}\n")
            fresh = block.begins[k] == len(line) > 0 and not line.endswith(" ")  # a marker on a line of its own
            if not fresh:
                out.append(escaped(line[block.begins[k] :]))
        else:
            # A blank line before an unmarked turn stands for its marker.
            stands = not line and k + 1 < len(lines) and states[k + 1] % 2 == 0 and block.roles[k + 1] is None
            if not stands:
                out.append(escaped(line) if k and fresh else "\n" + escaped(line))
            fresh = fresh and stands
    if last:
        out.append("<|im_end|>\n")
    return "".join(out), roles


# --- blocks ----------------------------------------------------------------------------------------

def _numbers(starts):
    """Rows come in order; each gets the number of its turn in the conversation. The conversation that a task begins with goes on from earlier tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, upto, begun = None, 0, False
        for batch in batches:
            conv, part = batch.column("conv_id").to_pylist(), batch.column("_part").to_pylist()
            numbers = []
            for c, p in zip(conv, part, strict=True):
                if not begun or c != now:
                    now, upto = c, 0 if begun else starts.value.get(p, 0)
                    begun = True
                numbers.append(upto)
                upto += 1
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(numbers, pa.int64()), batch.column("role"), batch.column("text")], ["conv_id", "k", "role", "text"])

    return run


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv_id, part, turns, before, after): blocks of BLOCK turns in order; ``before``: the turn before, ``after``: whether one follows."""
    spark = rows.sparkSession
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = turns.withColumn("_h", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "_h", "_row"]  # the last one tells equal rows apart, so they need not share a task
    dealt = turns.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.select("conv_id", "role", "text", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    # Where a conversation goes on from one task into the next: two rows for each task.
    ends = dealt.groupBy("_part", "conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("at"))
    ends = ends.groupBy("_part").agg(F.min_by(F.struct("conv_id", "n"), "at").alias("first"), F.max_by(F.struct("conv_id", "n"), "at").alias("last")).orderBy("_part").collect()
    starts, conv, n = {}, object(), 0
    for r in ends:
        same = r["first"]["conv_id"] == conv
        starts[r["_part"]] = n if same else 0
        one = r["first"]["conv_id"] == r["last"]["conv_id"]
        conv, n = r["last"]["conv_id"], r["last"]["n"] + (n if one and same else 0)
    numbered = dealt.mapInArrow(_numbers(spark.sparkContext.broadcast(starts)), "conv_id long, k long, role string, text string")
    # A block's last turn is told to the next block, and its first one to the block before.
    place = F.floor(F.col("k") / BLOCK)
    turn = F.struct("k", "role", "text").alias("t")
    none = F.lit(None).cast("struct<k:bigint,role:string,text:string>").alias("t")
    copies = F.array(
        F.struct(place.alias("part"), F.lit(1).alias("kind"), turn),
        F.when(F.col("k") % BLOCK == BLOCK - 1, F.struct((place + 1).alias("part"), F.lit(0).alias("kind"), turn)),
        F.when((F.col("k") % BLOCK == 0) & (F.col("k") > 0), F.struct((place - 1).alias("part"), F.lit(2).alias("kind"), none)),
    )
    each = numbered.select("conv_id", F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("c")).select("conv_id", "c.part", "c.kind", "c.t")
    here = F.collect_list(F.when(F.col("kind") == 1, F.col("t")))
    blocks = each.groupBy("conv_id", "part").agg(F.array_sort(here).alias("turns"), F.max(F.when(F.col("kind") == 0, F.col("t"))).alias("before"), F.max(F.when(F.col("kind") == 2, 1)).isNotNull().alias("after"))
    return blocks.where(F.size("turns") > 0)


class Block:
    """The transcript's lines of one block, with what is known of them."""

    def __init__(self, conv_id: int | None, turns: list[dict], before: dict | None):
        key = str(conv_id)
        lines: list[str] = []
        self.at, self.known = [], []
        for t in turns:
            more, begin = write_turn(t["role"], t["text"], key, t["k"])
            self.at.append(len(lines) + begin)
            self.known.append(t["role"])
            lines += more
        self.first = turns[0]["k"] == 0
        # The line before: whether it is blank, and its state.
        earlier, begin = write_turn(before["role"], before["text"], key, before["k"]) if before else ([""], 0)
        self.seen = Lines(lines, not earlier[-1].strip())
        self.enter = 2 * ROLES.index(before["role"]) + (begin < len(earlier) - 1) if before and before["role"] in ROLES else -1

    def states(self) -> np.ndarray:
        """Of every line; -1 where the role is not one of the model's. A line that stands for a marker ends the turn before."""
        out = np.full(len(self.seen.lines), -1)
        ends = [*self.at[1:], len(out)]
        for at, end, role in zip(self.at, ends, self.known, strict=True):
            if role in ROLES:
                out[at:end] = 2 * ROLES.index(role) + 1
                out[at] -= 1
        if self.at[0] and self.enter >= 0:
            out[0] = self.enter | 1
        return out


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for c, turns, before in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist(), batch.column("before").to_pylist(), strict=True):
        yield Block(c, turns, before)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Model()
    empty = model.flat()
    for batch in batches:
        for block in _blocks(batch):
            model.count(block.seen.seen, block.states(), block.first, block.enter)
    yield pa.RecordBatch.from_arrays([pa.array([(model.flat() - empty).tolist()], pa.list_(pa.float64()))], ["counts"])


def fit(blocks: DataFrame):
    """Tables of the model, counted over all conversations that are not held out."""
    counts = blocks.where(~held_out(F.col("conv_id"))).mapInArrow(_count, "counts array<double>")
    total = counts.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()
    return Model(np.array([r["n"] for r in total]) if total else None).logs()


def _tables(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [block_table(b.seen.seen, shared.value, b.first).tobytes() for b in _blocks(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(made, pa.binary())], ["conv_id", "part", "score"])

    return run


def _array(score: bytes) -> np.ndarray:
    return np.frombuffer(score).reshape(STATES, STATES)


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [product_of([_array(x["score"]) for x in parts]).tobytes() for parts in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(made, pa.binary())], ["conv_id", "part", "score"])


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, part, enter, leave) of the parts below: the states before each and at its end."""
    for batch in batches:
        rows = []
        for c, parts, enter, leave in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "parts", "enter", "leave")), strict=True):
            path = boundaries([_array(x["score"]) for x in parts], enter, leave)
            rows += [(c, x["part"], a, b) for x, a, b in zip(parts, [enter, *path[:-1]], path, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], ["conv_id", "part", "enter", "leave"])


def block_ends(blocks: DataFrame, shared) -> DataFrame:
    """(conv_id, part, enter, leave): the best states around each block of the conversations in ``blocks``."""
    kinds = "conv_id long, part long, score binary"
    levels = [cut_lineage(blocks.mapInArrow(_tables(shared), kinds))]
    grouped = lambda d: d.groupBy("conv_id", F.floor(F.col("part") / FAN).alias("part")).agg(F.array_sort(F.collect_list(F.struct("part", "score"))).alias("parts"))
    while (levels[-1].agg(F.max("part")).first()[0] or 0) > 0:
        levels.append(cut_lineage(grouped(levels[-1]).mapInArrow(_products, kinds)))
    known = levels[-1].select("conv_id", "part", F.lit(0).alias("enter"), F.lit(None).cast("int").alias("leave"))
    for below in reversed(levels[:-1]):
        over = known.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "enter", "leave")
        both = grouped(below).join(over, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
        known = cut_lineage(both.select("conv_id", "parts", "enter", "leave").mapInArrow(_down, "conv_id long, part long, enter int, leave int"))
    return known


OUT = "conv_id long, part long, held_out boolean, n_turns long, n_found long, n_right long, roles array<string>, text string"


def _format(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_turns, n_found, right, said, texts = [], [], [], [], []
            for block, after, enter, leave in zip(_blocks(batch), *(batch.column(x).to_pylist() for x in ("after", "enter", "leave")), strict=True):
                states = viterbi(block.seen.seen, shared.value, None if block.first else enter, leave)
                text, roles = render(block.seen, states, block.first, not after)
                n_turns.append(len(block.known))
                n_found.append(len(roles))
                right.append(sum(role in ROLES and states[at] == 2 * ROLES.index(role) for at, role in zip(block.at, block.known, strict=True)))
                said.append(roles)
                texts.append(text)
            numbers = [pa.array(x, pa.int64()) for x in (n_turns, n_found, right)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("held_out"), *numbers, pa.array(said, pa.list_(pa.string())), pa.array(texts, pa.string())], ["conv_id", "part", "held_out", "n_turns", "n_found", "n_right", "roles", "text"])

    return run


def op8_chat_formatting(rows: DataFrame) -> DataFrame:
    """One row per block of a conversation: conv_id, part, held_out, n_turns, n_found, n_right (turns found at their first line with their role), roles, text."""
    blocks = cut_lineage(blocks_of(rows)).withColumn("held_out", held_out(F.col("conv_id")))
    shared = rows.sparkSession.sparkContext.broadcast(fit(blocks))
    several = F.col("after") | (F.col("part") > 0)
    alone = blocks.where(~several).withColumns({"enter": F.lit(None).cast("int"), "leave": F.lit(None).cast("int")})
    ends = block_ends(blocks.where(several), shared).select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "enter", "leave")
    long = blocks.where(several).join(ends, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))).drop("_c", "_p")
    return alone.unionByName(long).mapInArrow(_format(shared), OUT)
