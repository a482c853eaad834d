"""Conversation structure repair: the cheapest edits that make the roles of a conversation legal.

Legal is ``(s?(ua)+)?`` over the first letters of the roles: nothing, or pairs of user and
assistant behind at most one system turn. Knuth's generalisation of the shortest path finds
the edits. Items ``[i, q]`` say that the first ``i`` rows are repaired and the last turn so
far is ``q``. Hyperedges carry an edit each, and their functions map the weight
``(cost, audit)`` of their antecedents to that of their consequent: the cost grows by the
edit's, the audit by its letter. Weights are compared by cost, then by audit in ASCII order.
The functions are superior (no result is below an argument: costs are not negative, and a
text is below its extensions). They are monotone for weights of one item: two audits of
equal cost that both edit the same rows are never one the beginning of the other, since the
longer one would have further inserts, at a further cost. So the agenda may finalise items
in the order of their weights, and stops when the goal is final.

Faults of a row, the first that holds: ``blank`` (no character but white space),
``duplicate`` (role and text of an earlier row of the conversation), ``truncated`` (the last
such character is none of ``.!?``). Keep costs nothing, a new role (user or assistant) 1,
deletion 2 and an inserted empty turn 5; blank and duplicate rows have to be deleted, and a
truncated row that stays adds 5.

A conversation above ``PIECE_ROWS`` rows or ``PIECE_BYTES`` is repaired in pieces: earlier
copies are found by a join, every piece gives its lightest spans from each turn it may
begin after to each it may end with, and these spans are the hyperedges of a second agenda
along the pieces. The result is the same.

NULLs: a NULL role or text is one space, a row of NULL ``turn`` comes first, the rows of
NULL ``conv_id`` are one conversation. Empty texts are blank; very long ones only move a
piece's end. Rows of one turn are ordered by role and text; repeated rows are duplicates of
the first. A role whose first letter is none of s, u, a (or that is empty) can only get a
new role or go. Rows with ``dropped`` true count as not there, but their conversation is
reported. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import turns
from salesmart.llm.common import per_process, stored

COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
# The turn that was last: nothing yet, system, user, assistant. What may follow, and ends.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
# Answers kept by a worker process, for conversations of at most so many rows.
REMEMBERED, REMEMBERED_ROWS = 20_000, 64

WHITE = "\t\n\x0b\x0c\r "
RESULT = (
    "conv_id bigint, part bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint,"
    " illegal bigint, cost bigint, audit string, repaired array<struct<role:string,text:string>>"
)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
COLUMNS = ["turn", "role", "text", "dropped"]

Weight = tuple[int, str]
Item = tuple[int, int]


def finalise(
    axioms: Iterable[tuple[Item, Weight]],
    complete: Callable[[Item, Weight], Iterable[tuple[Item, Weight]]],
    goal: Item | None = None,
) -> dict[Item, Weight]:
    """Lightest weight of every item, or of those up to the goal.

    ``complete`` gives consequent and weight of each hyperedge that has all its
    antecedents once this item is final.
    """
    heap = [(weight, item) for item, weight in axioms]
    heapify(heap)
    final: dict[Item, Weight] = {}
    while heap:
        weight, item = heappop(heap)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for consequent, found in complete(item, weight):
            if consequent not in final:
                heappush(heap, (found, consequent))
    return final


def edits_of(code: str) -> Callable[[Item, Weight], Iterator[tuple[Item, Weight]]]:
    """The hyperedges over rows, a letter of ``code`` for each (see ``row_code``)."""

    def complete(item: Item, weight: Weight) -> Iterator[tuple[Item, Weight]]:
        (i, q), (cost, audit) = item, weight
        if i < len(code):
            row = code[i]
            yield (i + 1, q), (cost + COST["D"], audit + "D")
            if row != "x":
                more = TRUNCATED_COST if row.isupper() else 0
                for role, after in FOLLOWS[q].items():
                    if role == row.lower():
                        yield (i + 1, after), (cost + more, audit + "K")
                    elif role in NAMES:
                        yield (i + 1, after), (cost + COST["R"] + more, audit + "R")
        elif i == len(code) and q in ENDS:
            yield (i + 1, START), weight
        for role, after in FOLLOWS[q].items():
            if role in NAMES and i <= len(code):
                yield (i, after), (cost + COST["I"], audit + "I")

    return complete


def cheapest(code: str) -> Weight:
    goal = (len(code) + 1, START)
    return finalise([((0, START), (0, ""))], edits_of(code), goal)[goal]


def cheapest_known(code: str) -> Weight:
    """The same, looked up if a short conversation like this one was met before."""
    if len(code) > REMEMBERED_ROWS:
        return cheapest(code)
    known = per_process("repair", dict)
    if code not in known:
        if len(known) >= REMEMBERED:
            known.clear()
        known[code] = cheapest(code)
    return known[code]


def spans(code: str) -> dict[tuple[int, int], Weight]:
    """Lightest span of a piece per turn that was last before it and in it."""
    found = {}
    for q in FOLLOWS:
        # No goal: all items at the end are wanted.
        final = finalise([((0, q), (0, ""))], edits_of(code))
        found |= {(q, r): final[len(code), r] for r in FOLLOWS if (len(code), r) in final}
    return found


def along(pieces: list[dict[tuple[int, int], Weight]]) -> tuple[Weight, list[tuple[int, int]]]:
    """The cheapest chain of spans, and the (turn before, turn after) chosen for each piece."""
    goal = (len(pieces) + 1, START)
    back: dict[Item, tuple[Weight, int]] = {}

    def complete(item: Item, weight: Weight) -> Iterator[tuple[Item, Weight]]:
        k, q = item
        if k == len(pieces):
            found = [((k + 1, START), weight, q)] if q in ENDS else []
        else:
            found = [
                ((k + 1, r), (weight[0] + cost, weight[1] + audit), q)
                for (before, r), (cost, audit) in pieces[k].items()
                if before == q
            ]
        for consequent, reached, q in found:
            if consequent not in back or reached < back[consequent][0]:
                back[consequent] = reached, q
            yield consequent, reached

    best = finalise([((0, START), (0, ""))], complete, goal)[goal]
    chosen, state = [], back[goal][1]
    for k in range(len(pieces), 0, -1):
        before = back[k, state][1]
        chosen.append((before, state))
        state = before
    return best, chosen[::-1]


def row_code(role: str, blank: bool, duplicate: bool, truncated: bool) -> str:
    """A row as the agenda sees it: x must go, a capital letter is truncated, o is no role."""
    if blank or duplicate:
        return "x"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return letter.upper() if truncated else letter


def look(rows: list[tuple[str, str, bool]]) -> tuple[str, dict[str, int]]:
    """Code of (role, text, duplicate) rows, and how many have each fault."""
    code, seen = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text, duplicate in rows:
        last = text.rstrip(WHITE)[-1:]
        blank = not last
        truncated = not blank and not duplicate and last not in ".!?"
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
        if fault:
            seen[fault] += 1
        code.append(row_code(role, blank, duplicate, truncated))
    return "".join(code), seen


def applied(rows: list[tuple[str, str]], audit: str, state: int = START) -> Iterator[dict[str, str]]:
    """The repaired turns. The audit alone tells the roles: only one is legal at each place."""
    left = iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = "", ""
        else:
            role, text = next(left)
            if edit == "D":
                continue
        if edit == "K":
            letter = role[:1]
        else:
            letter = "a" if state == USER else "u"
            role = NAMES[letter]
        state = FOLLOWS[state][letter]
        yield {"role": role, "text": text}


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))


def gaps_of(numbers: list[int]) -> int:
    """Turn numbers missing between the smallest and the largest."""
    return max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0


def _whole(batches: Iterator) -> Iterator[dict]:
    for conv, rows in turns.runs(batches, COLUMNS):
        rows = [r[:3] for r in rows if not r[3]]
        known: set[tuple[str, str]] = set()
        flagged = []
        for _, role, text in rows:
            flagged.append((role, text, (role, text) in known))
            known.add((role, text))
        code, faults = look(flagged)
        cost, audit = cheapest_known(code)
        texts = [(role, text) for _, role, text in rows]
        yield {
            "conv_id": conv,
            "part": 0,
            "gaps": gaps_of([t for t, _, _ in rows if t is not None]),
            "illegal": illegal_pairs([role[:1] for role, _ in texts]),
            "cost": cost,
            "audit": audit,
            "repaired": list(applied(texts, audit)),
            "_bytes": sum(len(text) for _, text in texts),
            **faults,
        }


_SPAN = "array<struct<before:int,after:int,cost:bigint,audit:string>>"
_PIECE = (
    "conv_id bigint, part bigint, first_turn bigint, last_turn bigint, first_initial string,"
    f" last_initial string, spans {_SPAN}, gaps bigint, blank bigint, duplicate bigint,"
    " truncated bigint, illegal bigint"
)
_CHOSEN = "conv_id bigint, part bigint, before int, gaps bigint, illegal bigint, cost bigint, audit string"


def _pieces(batches: Iterator) -> Iterator[dict]:
    for batch in batches:
        for piece in batch.to_pylist():
            rows = piece["rows"]
            code, faults = look([(r["role"], r["text"], r["copied"]) for r in rows])
            numbers = [r["turn"] for r in rows if r["turn"] is not None]
            initials = [r["role"][:1] for r in rows]
            yield {
                "conv_id": piece["conv_id"],
                "part": piece["part"],
                "first_turn": min(numbers, default=None),
                "last_turn": max(numbers, default=None),
                "first_initial": initials[0] if rows else None,
                "last_initial": initials[-1] if rows else None,
                "spans": [
                    {"before": q, "after": r, "cost": cost, "audit": audit}
                    for (q, r), (cost, audit) in spans(code).items()
                ],
                "gaps": gaps_of(numbers),
                "illegal": illegal_pairs(initials),
                **faults,
            }


def _along(batches: Iterator) -> Iterator[dict]:
    columns = ["part", "first_turn", "last_turn", "first_initial", "last_initial", "spans", "gaps", "illegal"]
    for conv, found in turns.runs(batches, columns):
        tables = [{(s["before"], s["after"]): (s["cost"], s["audit"]) for s in p[5]} for p in found]
        _, chosen = along(tables)
        turn = initial = None
        for (part, first, last, begins, ends, _, gaps, illegal), (q, r), spans_ in zip(found, chosen, tables):
            if first is not None:
                gaps += max(0, first - turn - 1) if turn is not None else 0
                turn = last
            if begins is not None:
                illegal += initial is not None and initial + begins not in LEGAL_PAIRS
                initial = ends
            cost, audit = spans_[q, r]
            yield {"conv_id": conv, "part": part, "before": q, "gaps": gaps, "illegal": illegal,
                   "cost": cost, "audit": audit}


def _rebuild(batches: Iterator) -> Iterator[dict]:
    for batch in batches:
        for piece in batch.to_pylist():
            texts = [(r["role"], r["text"]) for r in piece.pop("rows")]
            done = list(applied(texts, piece["audit"], piece.pop("before")))
            yield {**piece, "repaired": done, "_bytes": sum(len(t) for _, t in texts)}


def _in_pieces(heavy: DataFrame) -> DataFrame:
    """Conversations that are too long for one task's memory."""
    named = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    key = F.sha2(named, 256)
    place = F.struct("part", "pos")
    first = (
        heavy.where(~F.col("dropped"))
        .groupBy("conv_id", key.alias("key"))
        .agg(F.min(place).alias("first"))
        .select(F.col("conv_id").alias("c"), "first.*", F.lit(False).alias("is_copy"))
        .withColumnsRenamed({"part": "p", "pos": "i"})
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("pos") == F.col("i"))
    rows = heavy.join(first, same, "left").withColumn("copied", F.coalesce("is_copy", F.lit(True)))
    whole = turns.pieces(rows, ["turn", "role", "text", "dropped", "copied"])
    # Dropped rows go, but a piece stays, so that its conversation does.
    whole = stored(whole.withColumn("rows", F.filter("rows", lambda r: ~r["dropped"])), "repair-pieces")
    looked = stored(turns.mapped(whole, _pieces, _PIECE), "repair-spans")
    dealt = looked.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    chosen = turns.mapped(dealt, _along, _CHOSEN)
    names = {"conv_id": "c", "part": "p"}
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    joined = whole.join(chosen.withColumnsRenamed(names), same).drop("c", "p")
    faults = looked.select("conv_id", "part", "blank", "duplicate", "truncated").withColumnsRenamed(names)
    joined = joined.join(faults, same).drop("c", "p")
    return turns.mapped(joined, _rebuild, RESULT)


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired turns, the edits and what was wrong, one row per conversation or piece.

    ``whole`` is false for pieces; counts, costs, audits and turns of a conversation's
    pieces add up, in the order of ``part``, to those of the conversation.
    """
    space = F.lit(" ")
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", space).alias("role"),
        F.when(dropped, "").otherwise(F.coalesce("text", space)).alias("text"),
        dropped.alias("dropped"),
    )
    light, heavy = turns.split_long(rows, "repair", turns.PIECE_ROWS, turns.PIECE_BYTES)
    done = turns.mapped(turns.ordered(light), _whole, RESULT).withColumn("whole", F.lit(True))
    if heavy is None:
        return done
    return done.unionByName(_in_pieces(heavy).withColumn("whole", F.lit(False)))


def damage(conversations: DataFrame) -> DataFrame:
    """Faults put into a twentieth of the rows each, by a checksum of conversation and turn."""
    space = F.lit(" ")
    named = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    )
    which = F.crc32(named.cast("binary")) % 20
    text = F.coalesce("text", space)
    stops = F.translate(text, ".!?", "")
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(which == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(which == 1, "").when(which == 2, stops).otherwise(text).alias("text"),
        (which == 0).alias("dropped"),
        F.when(which == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def _digests(batches: Iterator) -> Iterator[dict]:
    """One row per conversation from its pieces in order, of which one is held at a time."""
    from hashlib import sha256
    from itertools import groupby

    def found():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0]

    for conv, parts in groupby(found(), lambda p: p["conv_id"]):
        total, audit, digest, first = dict.fromkeys(COUNTS, 0), [], sha256(), True
        for piece in parts:
            for c in COUNTS:
                total[c] += piece[c]
            audit.append(piece["audit"])
            for turn in piece["repaired"]:
                digest.update((("" if first else "\n") + f"{turn['role']}:{turn['text']}").encode())
                first = False
        yield {"conv_id": conv, **total, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation: the counts, cost and audit, and a digest of the repaired turns."""
    line: Callable[[Column], Column] = lambda t: F.concat(t["role"], F.lit(":"), t["text"])
    text = F.array_join(F.transform("repaired", line), "\n")
    columns = ["conv_id", *COUNTS, "audit"]
    whole = repaired.where("whole").select(*columns, F.sha2(text, 256).alias("repaired_sha256"))
    parts = repaired.where(~F.col("whole")).select(*columns, "part", "repaired")
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = ", ".join(["conv_id bigint", *(f"{c} bigint" for c in COUNTS), "audit string, repaired_sha256 string"])
    return whole.unionByName(turns.mapped(parts, _digests, schema))
