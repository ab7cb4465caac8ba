"""Chat formatting: recover speaker roles of raw transcripts with a hidden Markov model, then render them canonically.

A transcript is a text of lines in which some turns open with a speaker
marker (``User:``, ``### Assistant``, ``<|system|>``) and some don't.  The
hidden state of a line is its role and whether it opens a turn or continues
one.  A line is observed as a tuple of features: its speaker marker, its
length, its end, and whether an empty line precedes it.  Start, transition and
feature probabilities are counted from labelled lines; Viterbi finds the best
state sequence of each transcript; runs between opening lines are its turns,
which are rendered as ``<|im_start|>role\\ncontent<|im_end|>\\n``.

``transcripts`` writes the raw transcripts of a table of turns.  A
conversation is cut into pages of ``PAGE`` turn numbers, each a transcript of
its own, and a page of more than ``PAGE_ROWS`` rows is dealt into several by a
hash of its rows, so that a conversation of any size is spread over tasks.

Defined cases: repeated turns are written as often as they occur.  A turn
whose conv_id or turn is null cannot be placed, so it is a transcript of its
own.  A null text is an empty one, written as one empty line.  A role that is
not one of ``ROLES`` (null too) is written without a marker and not learned
from.  A transcript that is null, empty or blank has no turn.  Other columns of the
turns are not read; those of a transcript table are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import written

ROLES = ("system", "user", "assistant")
STATES = tuple((r, opens) for r in ROLES for opens in (True, False))
PAGE, PAGE_ROWS = 256, 4096
MAX_TRANSCRIPTS = 4000

# What a marker may look like, by role.
NAMES = {"system": "system|instructions?", "user": "user|human|question|q|you", "assistant": "assistant|ai|bot|answer|a|gpt|model"}
_ANY = "|".join(f"(?P<{r}>{n})" for r, n in NAMES.items())
MARKER = re.compile(rf"[ \t]*(?:(?:#{{1,4}}[ \t]*|\*\*|\[)?(?:{_ANY})(?:\*\*|\])?[ \t]*:|###[ \t]*(?:{_ANY.replace('P<', 'P<h_')})[ \t]*$|"
                    rf"<\|(?:{_ANY.replace('P<', 'P<t_')})\|>)[ \t]*", re.IGNORECASE)

MARKS = ("none", *ROLES)
LENGTHS = (0, 1, 20, 60, 120, 250, 500)
ENDS = {"?": 1, ".": 2, ":": 3}
FEATURES = (len(MARKS) + 1, len(LENGTHS), 4, 2)             # no marker counts apart where the transcript has none at all


def marker(line: str) -> tuple[str, int]:
    """Role that the line's marker names (``none`` without one), and the marker's length."""
    m = MARKER.match(line)
    if not m:
        return "none", 0
    return next(k.removeprefix("h_").removeprefix("t_") for k, x in m.groupdict().items() if x is not None), m.end()


def observe(lines: list[str]) -> np.ndarray:
    """Lines x features."""
    out = np.zeros((len(lines), len(FEATURES)), np.int64)
    before = True
    for k, line in enumerate(lines):
        role, at = marker(line)
        body = line[at:].strip()
        out[k] = (MARKS.index(role), np.searchsorted(LENGTHS, len(body), "right") - 1, ENDS.get(body[-1:], 0), before)
        before = not line.strip()
    if not out[:, 0].any():
        out[:, 0] = len(MARKS)
    return out


@dataclass(frozen=True)
class RoleModel:
    """Log probabilities of start, transition and each feature's values by state."""

    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    def viterbi(self, seen: np.ndarray) -> np.ndarray:
        """Best state of each line; the first state on ties."""
        if not len(seen):
            return np.empty(0, np.int64)
        said = sum(e[:, seen[:, k]].T for k, e in enumerate(self.emit))
        best, back = self.start + said[0], np.empty((len(seen), len(STATES)), np.int64)
        for t in range(1, len(seen)):
            ways = best[:, None] + self.move
            back[t] = ways.argmax(axis=0)
            best = ways[back[t], np.arange(len(STATES))] + said[t]
        path = np.empty(len(seen), np.int64)
        path[-1] = best.argmax()
        for t in range(len(seen) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


def model_of(start: np.ndarray, move: np.ndarray, emit: list[np.ndarray], smooth: float = 0.1) -> RoleModel:
    """From counts.  A continuing line keeps its turn's role, and a transcript begins with an opening line."""
    opens = np.array([o for _, o in STATES])
    role = np.array([ROLES.index(r) for r, _ in STATES])
    with np.errstate(divide="ignore"):
        s = np.where(opens, start + smooth, 0.0)
        m = np.where(opens[None, :] | (role[None, :] == role[:, None]), move + smooth, 0.0)
        return RoleModel(np.log(s / s.sum()), np.log(m / m.sum(axis=1, keepdims=True)),
                         [np.log((e + smooth) / (e + smooth).sum(axis=1, keepdims=True)) for e in emit])


def written_lines(lines: list[str]) -> np.ndarray:
    """Which lines are not blank; only those are observed."""
    return np.array([bool(x.strip()) for x in lines], bool)


def states_of(model: RoleModel, lines: list[str]) -> np.ndarray:
    """State of each line; a blank line continues the turn before it (leading ones: the first turn)."""
    said = written_lines(lines)
    path = model.viterbi(observe(lines)[said])
    if not len(path):
        return np.full(len(lines), 1, np.int64)
    last = np.maximum(np.cumsum(said) - 1, 0)
    return np.where(said, path[last], path[last] // 2 * 2 + 1)


def turns_of(lines: list[str], states: np.ndarray) -> list[tuple[str, str]]:
    """Role and content of each turn; an opening line's own-role marker is not content."""
    out: list[tuple[str, list[str]]] = []
    for line, k in zip(lines, states.tolist(), strict=True):
        role, opens = STATES[k]
        if not out and not line.strip():
            continue
        if opens or not out:
            said, at = marker(line)
            out.append((role, [line[at:] if said == role else line]))
        else:
            out[-1][1].append(line)
    return [(r, "\n".join(x).strip("\n")) for r, x in out]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)


_PARSED = pa.struct([("states", pa.list_(pa.int32())), ("turns", pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))),
                     ("rendered", pa.string())])
PARSED = "struct<states:array<int>,turns:array<struct<role:string,content:string>>,rendered:string>"


def parse_batch(model: RoleModel, col: pa.Array) -> pa.Array:
    out = []
    for t in col:
        lines = (t.as_py() or "").split("\n") if t.as_py() else []
        states = states_of(model, lines)
        turns = turns_of(lines, states)
        out.append({"states": states.tolist(), "turns": [{"role": r, "content": x} for r, x in turns], "rendered": render(turns)})
    return pa.array(out, _PARSED)


def _parse(said: Broadcast, col: pa.Array) -> pa.Array:
    return parse_batch(said.value, col)


def parse(transcripts_: DataFrame, model: RoleModel, text_col: str = "transcript", to: str = "parsed") -> DataFrame:
    """``transcripts_`` with the struct ``to``: states (of lines), turns and rendered."""
    said = transcripts_.sparkSession.sparkContext.broadcast(model)

    def of(col: pa.Array) -> pa.Array:
        return _parse(said, col)
    return transcripts_.withColumn(to, F.arrow_udf(of, PARSED)(F.col(text_col)))


def transcripts(turns: DataFrame) -> DataFrame:
    """``conv_id, page, part, transcript, states (true ones; -1: no known role), n_turns`` of ``turns(conv_id, turn, role, text)``.

    The style of a page's markers is drawn by a hash of its key; turns in some
    styles, and a share of turns in the others, have no marker.
    """
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    rows = (turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("page", F.when(placed, F.floor(F.col("turn") / PAGE)).otherwise(F.lit(None).cast("bigint")))
            .withColumn("own", F.xxhash64("turn", "role", "text")))
    big = (rows.groupBy("conv_id", "page").agg(F.sum("times").alias("n")).where(F.col("n") > PAGE_ROWS)
           .select(F.col("conv_id").alias("c"), F.col("page").alias("p"), F.ceil(F.col("n") / PAGE_ROWS).alias("parts")))
    rows = rows.join(big, rows.conv_id.eqNullSafe(big.c) & rows.page.eqNullSafe(big.p), "left")
    # a row that occurs more often than a page is long is written over several parts as well
    rows = rows.withColumn("copies", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.col("times") - 1) / PAGE_ROWS).cast("int")),
        lambda k: F.struct(k.alias("k"), F.least(F.lit(PAGE_ROWS), F.col("times") - k * PAGE_ROWS).cast("int").alias("n")))))
    salt = F.xxhash64("own", "copies.k")
    rows = rows.withColumn("part", F.when(~placed, salt).otherwise(F.coalesce(F.pmod(salt, F.col("parts")), F.lit(0))))
    one = F.struct("turn", "role", "text", F.col("copies.n").alias("times"))
    pages = rows.groupBy("conv_id", "page", "part").agg(F.array_sort(F.collect_list(one)).alias("t"))
    style = F.xxhash64(F.coalesce("conv_id", "part"), "page", "part")
    said = F.arrow_udf(_written, "struct<transcript:string,states:array<int>,n_turns:bigint>")(F.col("t"), style)
    return pages.select("conv_id", "page", "part", said.alias("s")).select("conv_id", "page", "part", "s.*")


# The markers that raw transcripts are written with.
STYLES = ({"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
          {"system": "### System:\n", "user": "### Human:\n", "assistant": "### Assistant:\n"},
          {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"},
          {"system": "[Instructions]: ", "user": "Q: ", "assistant": "A: "},
          {})


def _written(turns: pa.Array, style: pa.Array) -> pa.Array:
    out = []
    for t, h in zip(turns, style.to_pylist(), strict=True):
        lines, states, n = [], [], 0
        for x in t.as_py():
            role = x["role"] if x["role"] in ROLES else None
            for _ in range(x["times"]):
                mark = STYLES[h % len(STYLES)].get(role, "") if (h // 8 + 5 * n) % 7 else ""    # one turn in seven lacks its marker
                own = (mark + x["text"]).split("\n")
                first = STATES.index((role, True)) if role else -1
                lines += own
                states += [first] + [first + 1 if role else -1] * (len(own) - 1)
                n += 1
        out.append({"transcript": "\n".join(lines), "states": states, "n_turns": n})
    return pa.array(out, pa.struct([("transcript", pa.string()), ("states", pa.list_(pa.int32())), ("n_turns", pa.int64())]))


def train(labelled: DataFrame, most: int = MAX_TRANSCRIPTS) -> RoleModel:
    """Count a model from ``transcript, states``: a hashed share of about ``most`` transcripts."""
    share = min(1.0, most / max(1, labelled.count()))
    pick = labelled.where(F.pmod(F.xxhash64("transcript"), F.lit(1 << 30)) < int(share * (1 << 30)))
    size = len(STATES)
    width = size + size * size + size * sum(FEATURES)

    def count(batches):
        total = np.zeros(width, np.int64)
        for b in batches:
            for text, states in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text or not states:
                    continue
                lines = text.split("\n")
                said = written_lines(lines)
                s, seen = np.array(states)[said], observe(lines)[said]
                if not len(s):
                    continue
                if s[0] >= 0:
                    total[s[0]] += 1
                pair = (s[:-1] >= 0) & (s[1:] >= 0)
                total[size:size + size * size] += np.bincount(s[:-1][pair] * size + s[1:][pair], minlength=size * size)
                at, ok = size + size * size, s >= 0
                for k, n in enumerate(FEATURES):
                    total[at:at + size * n] += np.bincount(s[ok] * n + seen[ok, k], minlength=size * n)
                    at += size * n
        yield pa.RecordBatch.from_arrays([pa.array(range(width)), pa.array(total)], ["k", "n"])

    got = dict(pick.select("transcript", "states").mapInArrow(count, "k bigint, n bigint").groupBy("k").sum("n").collect())
    total = np.array([got.get(k, 0) for k in range(width)], float)
    emit, at = [], size + size * size
    for n in FEATURES:
        emit.append(total[at:at + size * n].reshape(size, n))
        at += size * n
    return model_of(total[:size], total[size:size + size * size].reshape(size, size), emit)


def held_out(conv_id: Column) -> Column:
    return F.coalesce(F.crc32(conv_id.cast("string")) % 4 == 2, F.lit(False))


@register("op9_chat_formatting")
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transcripts of all conversations parsed and rendered; per transcript, how many lines got their true state.

    The model is counted from the conversations that are not held out.
    """
    raw = written(transcripts(table(spark, sf_dir, "conversations")).withColumn("held_out", held_out(F.col("conv_id"))), "transcripts")
    got = parse(raw, train(raw.where(~F.col("held_out"))))
    right = F.size(F.filter(F.zip_with("states", "parsed.states", lambda a, b: a == b), lambda x: x)).cast("long")
    return got.select("conv_id", "page", "part", "held_out", F.size("states").cast("long").alias("n_lines"), right.alias("n_right"), "n_turns",
                      F.size("parsed.turns").cast("long").alias("n_turns_found"), F.sha2("parsed.rendered", 256).alias("rendered_sha256"))
