"""Chat formatting: roles are recovered from transcripts before turns are rendered.

A hidden Markov model runs over the lines of a conversation. Its states are
roles. A line shows a speaker marker or none, its place in its row, its length
and its shape; a row of the table may also name its role, which counts as one
more marker. Viterbi decoding gives the most likely role of every line. Runs
of lines of one role become canonical turns.

A long conversation is decoded in blocks of turns whose scores are composed:
each block gives the best score from each state before it to each state at its
end, these are chained in block order, and every block is then decoded between
the states in which the best path over the whole conversation enters and
leaves it.

The model's tables are counts over all rows that name a role.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from moraine.sources.shared import stored

ROLES = ("system", "user", "assistant")
# What speakers are called in common transcript formats.
ALIASES = {
    "system": 0, "instruction": 0, "instructions": 0, "context": 0, "developer": 0,
    "user": 1, "human": 1, "prompter": 1, "question": 1, "q": 1, "me": 1, "customer": 1, "customer support": 2,
    "assistant": 2, "ai": 2, "bot": 2, "gpt": 2, "model": 2, "answer": 2, "a": 2, "chatbot": 2, "agent": 2, "response": 2,
}
_NAMES = "|".join(sorted(map(re.escape, ALIASES), key=len, reverse=True))
_MARKER = re.compile(
    rf"^\s*(?:<\|(?:im_start\|>)?\s*({_NAMES})\b\s*(?:\|>|$)|\[({_NAMES})\]\s*:?|#{{1,4}}\s*({_NAMES})\s*:?\s*$|(?:\*\*)?({_NAMES})(?:\*\*)?\s*:(?:\*\*)?)\s?",
    re.I,
)
WAYS = ("entry", "leave", "blind_entry", "blind_leave")
TURNS = 64  # consecutive turns of one conversation that are decoded together
UNNUMBERED = 1024  # blocks of the rows of a conversation that have no turn number
# Inside a row, a line without a marker all but never changes the speaker.
_STAY = np.log(1 - 2e-6)
_MOVE = np.log(1e-6)
# Kinds of evidence a line gives, each with its values.
_SHAPES = 6
_LENGTHS = 10
N_EVIDENCE = 2 * _LENGTHS + 2 * _SHAPES
UNKNOWN = 3  # a marker that names no role


def marker(line: str) -> tuple[int, str]:
    """(role that the line's marker names or UNKNOWN, the line without the marker)."""
    m = _MARKER.match(line)
    if not m:
        return UNKNOWN, line
    name = next(g for g in m.groups() if g).lower()
    return ALIASES[name], line[m.end() :]


def role_of(name: str | None) -> int:
    return ALIASES.get((name or "").strip().lower(), UNKNOWN)


def evidence(line: str, first: bool) -> tuple[int, int]:
    """Two categories of a line: its length in doublings and its shape, by whether it opens its row."""
    size = min(len(line).bit_length(), _LENGTHS - 1)
    end = line.rstrip()[-1:]
    shape = 0 if not end else 1 if end == "?" else 2 if end in ".!" else 3 if end in ":;," else 4
    if line[:1] in "-*#`>|" and line:
        shape = 5
    return size + first * _LENGTHS, 2 * _LENGTHS + shape + first * _SHAPES


class Model:
    """Log probabilities of the first role, of the next row's role, and of each piece of evidence."""

    def __init__(self, start: np.ndarray, move: np.ndarray, seen: np.ndarray):
        self.start = np.log((start + 1) / (start + 1).sum())
        self.move = np.log((move + 1) / (move + 1).sum(1, keepdims=True))
        log = []
        for a, b in ((0, 2 * _LENGTHS), (2 * _LENGTHS, N_EVIDENCE)):
            part = seen[:, a:b] + 0.5
            log.append(np.log(part / part.sum(1, keepdims=True)))
        self.seen = np.concatenate(log, axis=1)
        # A marker names the wrong speaker now and then.
        self.marked = np.log(np.full((3, 3), 0.005) + np.eye(3) * 0.985)

    def _steps(self, rows):
        """Per line its own scores and the scores of the step to it from the line before."""
        for named, lines in rows:
            for k, (mark, a, b) in enumerate(lines):
                own = self.seen[:, a] + self.seen[:, b]
                if mark != UNKNOWN:
                    own = own + self.marked[:, mark]
                if named != UNKNOWN and k == 0:
                    own = own + self.marked[:, named]
                if k == 0:
                    step = self.move
                elif mark != UNKNOWN:
                    step = np.maximum(self.move, np.log(0.1))
                else:
                    step = np.where(np.eye(3, dtype=bool), _STAY, _MOVE)
                yield own, step

    def links(self, rows: list[tuple[int, list[tuple[int, int, int]]]]) -> np.ndarray:
        """Best score of a block by the state at its end: a row for each state before it, the last for none."""
        best = None
        for own, step in self._steps(rows):
            if best is None:
                best = np.vstack([step, self.start]) + own
            else:
                best = (best[:, :, None] + step).max(1) + own
        return best

    def decode(
        self, rows: list[tuple[int, list[tuple[int, int, int]]]], entry: int | None = None, leave: int | None = None
    ) -> list[list[int]]:
        """The role of each line; a row is (its named role, [(marker, evidence, evidence)]).

        ``entry`` is the state of the line before, if there is one; ``leave``
        the state of the last line, if it is settled.
        """
        best, back = None, []
        for own, step in self._steps(rows):
            if best is None:
                best = own + (self.start if entry is None else step[entry])
                back.append(None)
                continue
            ways = best[:, None] + step
            back.append(ways.argmax(0))
            best = ways.max(0) + own
        if best is None:
            return [[] for _ in rows]
        state = int(best.argmax()) if leave is None else leave
        path = [state]
        for came in reversed(back[1:]):
            state = int(came[state])
            path.append(state)
        path.reverse()
        out, at = [], 0
        for _, lines in rows:
            out.append(path[at : at + len(lines)])
            at += len(lines)
        return out


def chain(links: list[np.ndarray]) -> list[tuple[int | None, int]]:
    """(entry, leave) of each block of a conversation on its best path, from the blocks' ``links`` in order."""
    scores = [links[0][3]]
    for block in links[1:]:
        scores.append((scores[-1][:, None] + block[:3]).max(0))
    leave = int(scores[-1].argmax())
    out = []
    for k in range(len(links) - 1, 0, -1):
        entry = int((scores[k - 1] + links[k][:3, leave]).argmax())
        out.append((entry, leave))
        leave = entry
    return [(None, leave), *reversed(out)]


def _rows(conversations: DataFrame) -> DataFrame:
    """Distinct turns with the block they are decoded in."""
    chosen = conversations.select("conv_id", "turn", "role", "text").distinct()
    # A row without a conversation stands alone.
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    # Rows without a turn number are dealt by hash, below every block of numbered turns.
    unnumbered = F.lit(-(1 << 60)) + F.pmod(F.xxhash64("role", "text"), F.lit(UNNUMBERED))
    block = F.coalesce(F.floor(F.col("turn") / TURNS).cast("long"), unnumbered)
    return chosen.withColumn("block", block).withColumn("alone", alone)


def _views(text: str | None) -> list[tuple[int, str, int, int]]:
    lines = (text or "").split("\n")
    out = []
    for k, line in enumerate(lines):
        mark, rest = marker(line)
        out.append((mark, rest, *evidence(rest, k == 0)))
    return out


def train(conversations: DataFrame) -> Model:
    """Counts over all rows that name a role; without any the model is even."""
    return _train(_rows(conversations))


def _train(rows: DataFrame) -> Model:
    named = F.lower(F.trim("role"))
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    rows = rows.withColumn("r", known[F.coalesce(named, F.lit(""))]).drop("role")

    def count(batches):
        for batch in batches:
            seen = np.zeros((3, N_EVIDENCE), np.int64)
            for role, text in zip(batch.column("r").to_pylist(), batch.column("text").to_pylist()):
                for _, _, a, b in _views(text):
                    seen[role, a] += 1
                    seen[role, b] += 1
            r, e = np.nonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, pa.int32()), pa.array(e, pa.int32()), pa.array(seen[r, e])], names=["r", "e", "n"]
            )

    seen = np.zeros((3, N_EVIDENCE))
    lines = rows.where("r is not null").select("r", "text").mapInArrow(count, "r int, e int, n bigint")
    for r in lines.groupBy("r", "e").agg(F.sum("n").alias("n")).collect():
        seen[r.r, r.e] = r.n
    place = [F.col("turn"), F.col("r"), F.xxhash64("text").alias("h")]
    order = Window.partitionBy("conv_id", "alone", "block").orderBy(*place)
    steps = rows.select("r", F.lag("r").over(order).alias("before"), F.lit(False).alias("first"))
    # The first row of each block follows the last one of the block before.
    ends = rows.groupBy("conv_id", "alone", "block").agg(
        F.min_by("r", F.struct(*place)).alias("r"), F.max_by("r", F.struct(*place)).alias("last")
    )
    blocks = Window.partitionBy("conv_id", "alone").orderBy("block")
    borders = ends.select("r", F.lag("last").over(blocks).alias("before"), (F.row_number().over(blocks) == 1).alias("first"))
    start, move = np.zeros(3), np.zeros((3, 3))
    for r in steps.unionByName(borders).where("r is not null and (first or before is not null)").groupBy("before", "r", "first").count().collect():
        if r["first"]:
            start[r["r"]] += r["count"]
        else:
            move[r["before"], r["r"]] += r["count"]
    return Model(start, move, seen)


def render(role: str, text: str) -> str:
    """The canonical form of a turn."""
    return f"<|{role}|>\n{text}\n<|end|>\n"


def format_chat(conversations: DataFrame, model: Model | None = None) -> DataFrame:
    """(conv_id, turn, part, role, recovered_role, n_lines, text, rendered): canonical turns.

    Lines of a row that share a role are one part, numbered from 0; a marker
    in front of a line is left out of its text. ``role`` counts the row's own
    role as a marker, ``recovered_role`` is decoded from the text and the order
    of turns alone, at the part's first line. A null or empty text is one
    empty line. Rows that repeat count once; turns that tie are ordered by
    role and text; rows without a conversation id are conversations of their
    own, rows without a turn number come first, in 1,024 blocks by hash. An unheard-of role is no
    marker. Blocks of 64 turn numbers go to tasks of their own and are composed,
    so a conversation of any length is spread over tasks and decoded as a whole;
    one row for each of its blocks is chained in one task.
    """
    rows = stored(_rows(conversations), "turns")
    model = model or _train(rows)

    def read(table):
        rows = sorted(
            zip(*(table.column(c).to_pylist() for c in ("turn", "role", "text", "conv_id"))),
            key=lambda r: (r[0] is not None, r[0] or 0, role_of(r[1]), r[2] or ""),
        )
        views = [_views(r[2]) for r in rows]
        observed = [[(m, a, b) for m, _, a, b in v] for v in views]
        return rows, views, list(zip([role_of(r[1]) for r in rows], observed)), [(UNKNOWN, o) for o in observed]

    def link(key, table):
        _, _, named, blind = read(table)
        both = np.stack([model.links(named), model.links(blind)])
        return pa.table([pa.array([k.as_py()], k.type) for k in key] + [pa.array([both.ravel().tolist()])], names=["conv_id", "block", "links"])

    def join(key, table):
        blocks = sorted(zip(table.column("block").to_pylist(), table.column("links").to_pylist()), key=lambda b: (b[0] is not None, b[0] or 0))
        links = np.array([b[1] for b in blocks]).reshape(-1, 2, 4, 3)
        ways = [named + blind for named, blind in zip(chain(list(links[:, 0])), chain(list(links[:, 1])))]
        return pa.table(
            [pa.array([key[0].as_py()] * len(blocks), key[0].type), pa.array([b[0] for b in blocks], pa.int64())]
            + [pa.array(c, pa.int32()) for c in zip(*ways)],
            names=["of_conv", "of_block", *WAYS],
        )

    def run(key, table):
        rows, views, named, blind = read(table)
        entry, leave, blind_entry, blind_leave = (table.column(c)[0].as_py() for c in WAYS)
        with_role = model.decode(named, entry, leave)
        without = model.decode(blind, blind_entry, blind_leave)
        out = []
        for row, view, path, blind in zip(rows, views, with_role, without):
            first = 0
            for k in range(1, len(view) + 1):
                if k < len(view) and path[k] == path[first] and view[k][0] == UNKNOWN:
                    continue
                text = "\n".join(v[1] for v in view[first:k])
                role = ROLES[path[first]]
                part = out[-1][2] + 1 if first else 0
                out.append((row[3], row[0], part, role, ROLES[blind[first]], k - first, text, render(role, text)))
                first = k
        columns = list(zip(*out))
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(types, columns)})

    kinds = {n: rows.schema[n].dataType for n in ("conv_id", "turn")}

    types = [(n, to_arrow_type(kinds[n])) for n in ("conv_id", "turn")] + [
        ("part", pa.int32()), ("role", pa.string()), ("recovered_role", pa.string()), ("n_lines", pa.int32()),
        ("text", pa.string()), ("rendered", pa.string()),
    ]
    schema = ", ".join(f"{n} {kinds[n].simpleString()}" for n in ("conv_id", "turn"))
    conv = f"conv_id {kinds['conv_id'].simpleString()}"
    several = rows.where("conv_id is not null").groupBy("conv_id").agg(
        F.min("block").alias("least"), F.max("block").alias("most"), F.count("block").alias("n"), F.count(F.lit(1)).alias("all")
    ).where("least <> most or n not in (0, all)")
    parts = rows.select("conv_id", "block").distinct().join(several, "conv_id", "left_semi")
    parts = parts.select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"))
    own = (F.col("conv_id") == F.col("of_conv")) & F.col("block").eqNullSafe(F.col("of_block"))
    linked = rows.join(parts, own, "left_semi").groupBy("conv_id", "block").applyInArrow(link, f"{conv}, block bigint, links array<double>")
    ways = linked.groupBy("conv_id").applyInArrow(join, f"of_{conv[:4]}{conv[7:]}, of_block bigint, " + ", ".join(f"{w} int" for w in WAYS))
    ways = ways.withColumn("of_alone", F.lit(None).cast("long"))
    own = F.col("conv_id").eqNullSafe(F.col("of_conv")) & F.col("block").eqNullSafe(F.col("of_block")) & F.col("alone").eqNullSafe(F.col("of_alone"))
    placed = rows.join(ways, own, "left").select("conv_id", "turn", "role", "text", "block", "alone", *WAYS)
    return placed.groupBy("conv_id", "block", "alone").applyInArrow(
        run, f"{schema}, part int, role string, recovered_role string, n_lines int, text string, rendered string"
    )


def op1_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
