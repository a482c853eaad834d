"""Chat formatting with a template taken as a black box.

A template is any function from a list of (role, text) turns to one string. It is called
for successive beginnings of a conversation, and each output is compared with the one
before:

* where the output only grew, what was added is the turn's span;
* where it did not, the template rewrites history (it drops earlier thoughts, moves a system
  prompt or an end mark). The turn is listed in ``rewrites``, spans end where the two outputs
  part, and a text that reaches beyond that is no longer marked for learning.

Where a turn's own text lies in its span is found the same way, by rendering the same
beginning with the texts "A" and "B" in its place: before the text and behind it the two
agree. A template that repeats, reorders or changes texts as it likes gives no such place
if what lies around it does not agree, and such a turn is not learnt from.

A conversation above ``PIECE_TURNS`` turns or ``PIECE_BYTES`` is formatted in pieces, since
successive beginnings of n turns hold n squared texts. A piece is rendered behind its
conversation's first ``CONTEXT`` turns and the last ``CONTEXT`` of the piece before. That
this is enough is checked at every turn of every piece: it must add the same text behind a
short context as behind the piece up to it. Conversations that fail this or are rewritten
are formatted whole by one task, as their output is no chain of pieces.

NULLs: a NULL role or text is empty, a NULL ``turn`` comes first, rows of NULL ``conv_id``
are one conversation. Ties in ``turn`` are ordered by role and text, and repeated rows are
turns of their own. Empty and very long texts are turns like others. An empty table gives
no rows. Other columns are not read, whatever their names.

``inst_template`` is the template of the registered query. Its marks are control strings;
inside texts and roles they are broken by a backslash, and backslashes are doubled. No
control string has its first character in it again and none holds a backslash, so that none
arises where texts and marks meet, and ``read_inst`` gives back the very turns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm import turns
from salesmart.llm.common import stored

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

PIECE_TURNS = 128
PIECE_BYTES = 4 << 20
CONTEXT = 2
LEARNT_ROLES = ("assistant",)

FORMATTED = (
    "conv_id bigint, part bigint, formatted string, turns array<struct<role:string, start:bigint,"
    " end:bigint, text_start:bigint, text_end:bigint, learn:boolean>>, rewrites array<int>"
)

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|role|>", "<|text|>", "<|end|>")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_BACKSLASH = re.compile(r"\\(\\?)")
_READ = re.compile(
    r"(?P<begin><s>)|\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)<\|end\|>|(?P<assistant>.*?)</s>",
    re.S,
)


def escape(text: str) -> str:
    if "\\" not in text and "<" not in text and "[" not in text:
        return text
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _BACKSLASH.sub(r"\1", text) if "\\" in text else text


def inst_template(conversation: list[Turn]) -> str:
    out = ["<s>"]
    for role, text in conversation:
        text = escape(text)
        if role == "user":
            out.append(f"[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f"{text}</s>")
        else:
            out.append(f"<|role|>{escape(role)}<|text|>{text}<|end|>")
    return "".join(out)


def read_inst(formatted: str) -> Iterator[Turn]:
    """The turns of a formatted conversation, or of a piece of one."""
    at = 0
    while at < len(formatted):
        found = _READ.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        at, kind = found.end(), found.lastgroup
        if kind == "text":
            yield unescape(found["role"]), unescape(found["text"])
        elif kind != "begin":
            yield kind, unescape(found[kind])


def longest(agree: Callable[[int, int], bool], most: int) -> int:
    """How far two texts agree, by halving; ``agree(m, n)`` compares what lies between."""
    known, end = 0, most
    while known < end:
        middle = (known + end + 1) // 2
        if agree(known, middle):
            known = middle
        else:
            end = middle - 1
    return known


def common_begin(a: str, b: str) -> int:
    return longest(lambda m, n: a[m:n] == b[m:n], min(len(a), len(b)))


def common_end(a: str, b: str, most: int) -> int:
    """How many characters, ``most`` at most, two texts have in common at their ends."""
    i, j = len(a), len(b)
    return longest(lambda m, n: a[i - n : i - m] == b[j - n : j - m], most)


def text_place(template: Template, before: list[Turn], role: str, output: str) -> tuple[int, int] | None:
    """Where the text of the last turn lies in the output, if its surroundings show it."""
    a, b = (template([*before, (role, probe)]) for probe in "AB")
    head = common_begin(a, b)
    tail = common_end(a, b, min(len(a), len(b)) - head)
    if len(a) - head - tail != 1 or head + tail > len(output):
        return None
    if output[:head] != a[:head] or (tail and output[-tail:] != a[-tail:]):
        return None
    return head, len(output) - tail


def render(
    template: Template, conversation: list[Turn], context: list[Turn] = (), learnt=LEARNT_ROLES
) -> dict:
    """Output, spans and rewrites of turns that follow a context; positions from the first turn on."""
    context = [*context]
    before = template(context) if context else ""
    base, spans, rewrites = len(before), [], []
    for k, (role, text) in enumerate(conversation):
        earlier = context + conversation[:k]
        now = template([*earlier, (role, text)])
        kept = len(before)
        if not now.startswith(before):
            kept = common_begin(before, now)
            rewrites.append(k)
            for span in spans:
                span["start"], span["end"] = min(span["start"], kept), min(span["end"], kept)
                if span["text_end"] is not None and span["text_end"] > kept:
                    span |= {"text_start": None, "text_end": None, "learn": False}
        place = text_place(template, earlier, role, now) if role in learnt else None
        if place and place[0] < kept:
            place = None
        spans.append({
            "role": role, "start": kept, "end": len(now), "learn": place is not None,
            "text_start": place and place[0], "text_end": place and place[1],
        })
        before = now
    if context:
        for span in spans:
            moved = {c: span[c] - base for c in ("start", "end", "text_start", "text_end") if span[c] is not None}
            span |= moved
    return {"formatted": before[base:], "turns": spans, "rewrites": rewrites}


def looks_far(template: Template, conversation: list[Turn], head: list[Turn], tail: list[Turn], found: dict) -> bool:
    """Whether some turn adds another text behind a short context than behind all before it."""
    known = [*tail, *conversation]
    for k, span in enumerate(found["turns"]):
        last = known[max(0, len(tail) + k - CONTEXT) : len(tail) + k]
        # At the beginning of the conversation the short context is all there is.
        short = [*head, *last] if head else conversation[:k] if k <= 2 * CONTEXT else [*conversation[:CONTEXT], *last]
        start = template(short) if short else ""
        added = template([*short, conversation[k]])
        if not added.startswith(start) or added[len(start) :] != found["formatted"][span["start"] : span["end"]]:
            return True
    return False


_COLUMNS = ["turn", "role", "text"]


def _whole(template: Template, learnt) -> Callable[[Iterator], Iterator[dict]]:
    def make(batches: Iterator) -> Iterator[dict]:
        for conv, rows in turns.runs(batches, _COLUMNS):
            found = render(template, [(role, text) for _, role, text in rows], (), learnt)
            yield {"conv_id": conv, "part": 0, **found, "_bytes": len(found["formatted"])}

    return make


def _pieces(template: Template, learnt) -> Callable[[Iterator], Iterator[dict]]:
    def make(batches: Iterator) -> Iterator[dict]:
        for batch in batches:
            for piece in batch.to_pylist():
                rows, head, tail = (
                    [(r["role"], r["text"]) for r in piece[c] or []] for c in ("rows", "head", "tail")
                )
                if not tail:  # the first piece
                    head = []
                else:
                    tail = tail[max(0, len(head) + len(tail) - piece["before"]) :]
                found = render(template, rows, [*head, *tail], learnt)
                far = bool(found["rewrites"]) or looks_far(template, rows, head, tail, found)
                yield {"conv_id": piece["conv_id"], "part": piece["part"], **found, "far": far,
                       "_bytes": len(found["formatted"])}

    return make


def _in_pieces(heavy: DataFrame, template: Template, learnt) -> DataFrame:
    listed = stored(turns.pieces(heavy, _COLUMNS), "format-pieces")
    n = F.size("rows")
    # Some turns of each piece; the texts of a conversation do not meet in one task.
    edges = listed.select(
        F.col("conv_id").alias("c"),
        F.col("part").alias("p"),
        n.alias("n"),
        F.slice("rows", 1, CONTEXT).alias("head"),
        F.slice("rows", F.greatest(n - (CONTEXT - 1), F.lit(1)), CONTEXT).alias("tail"),
    )
    along = Window.partitionBy("c").orderBy("p")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    context = edges.select(
        "c",
        "p",
        F.first("head").over(along).alias("head"),
        F.lag("tail").over(along).alias("tail"),
        F.sum("n").over(before).alias("before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    found = listed.join(context, same).drop("c", "p")
    done = stored(turns.mapped(found, _pieces(template, learnt), FORMATTED + ", far boolean"), "format-done")
    far = stored(done.where("far").select(F.col("conv_id").alias("_far")).distinct(), "format-far")
    if far.isEmpty():
        return done.drop("far")
    same = F.col("conv_id").eqNullSafe(F.col("_far"))
    chained = done.join(far, same, "left_anti").drop("far")
    whole = turns.ordered(heavy.join(far, same, "left_semi"))
    return chained.unionByName(turns.mapped(whole, _whole(template, learnt), FORMATTED))


def format_chat(
    conversations: DataFrame, template: Template = inst_template, learnt: tuple[str, ...] = LEARNT_ROLES
) -> DataFrame:
    """Formatted text, spans of its turns and where history was rewritten.

    One row per conversation (``whole``), or per piece of a long one; the pieces' texts in
    the order of ``part`` are the conversation's. Positions are code points in the row's text.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    light, heavy = turns.split_long(rows, "format", PIECE_TURNS, PIECE_BYTES)
    done = turns.mapped(turns.ordered(light), _whole(template, learnt), FORMATTED)
    done = done.withColumn("whole", F.lit(True))
    if heavy is None:
        return done
    return done.unionByName(_in_pieces(heavy, template, learnt).withColumn("whole", F.lit(False)))


def probe_rows(spark) -> DataFrame:
    """A conversation whose texts hold the template's own control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


_SUMMARY = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_rewrites bigint"
)


def _read_back(batches: Iterator) -> Iterator[dict]:
    """From formatted texts alone, and the mask; of a conversation's pieces one is held at a time."""

    def found():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0]

    for conv, pieces in groupby(found(), lambda p: p["conv_id"]):
        n, loss_chars, chars, rewrites, seen, loss = 0, 0, 0, 0, sha256(), sha256()
        for piece in pieces:
            text = piece["formatted"]
            chars, rewrites = chars + len(text), rewrites + len(piece["rewrites"])
            for role, said in read_inst(text):
                n += 1
                seen.update(f"{role}\n{said}\n".encode())
            for turn in piece["turns"]:
                if turn["learn"]:
                    learnt = unescape(text[turn["text_start"] : turn["text_end"]])
                    loss_chars += len(learnt)
                    loss.update(learnt.encode())
        yield {
            "conv_id": conv, "n_turns": n, "turns_sha256": seen.hexdigest(), "loss_chars": loss_chars,
            "loss_sha256": loss.hexdigest(), "formatted_chars": chars, "n_rewrites": rewrites,
        }


def summary(formatted: DataFrame) -> DataFrame:
    """What ``inst_template`` wrote, read back: one row per conversation."""
    whole = turns.mapped(formatted.where("whole"), _read_back, _SUMMARY)
    parts = formatted.where(~F.col("whole")).repartition("conv_id")
    parts = parts.sortWithinPartitions("conv_id", "part")
    return whole.unionByName(turns.mapped(parts, _read_back, _SUMMARY))
