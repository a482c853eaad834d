"""Repair and formatting of conversations."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import defaultdict

import pytest
from pyspark import cloudpickle

from salesmart.llm import chatformat, repair, turns
from salesmart.llm.queries import queries

# Templates of this file travel to the tasks by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, rows string, n string"
BLANKS = " \t\n\x0b\x0c\r"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "other", "other", "other") for r in rows], SCHEMA)


def as_rows(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


EDGE = [
    (None, None, None, None),
    (None, 1, "user", "no id."),
    (1, None, "user", "first?"),
    (1, None, "assistant", "second."),
    (1, 4, "user", "first?"),
    (2, 1, "assistant", "only"),
    (2, 1, "assistant", "only"),
    (2, 7, "", "no role."),
    (3, 0, "tool", " \t "),
    (4, 0, "system", "Be good."),
    (4, 1, "user", "Hello ! "),
    (4, 2, "user", "cut off"),
    (4, 3, "assistant", "x" * 100_000 + "."),
    (4, 9, "übel", "Ä."),
]
EDGE += [(5, t, ("user", "assistant")[t % 2], f"turn {t}" + ".!? "[t % 4]) for t in range(60)]
EDGE += [(6, 3, "user", "the same.")] * 30


# ---- repair, by other means


def brute_damage(rows):
    """Rows left, with the names of all conversations."""
    out, names = [], set()
    for conv, turn, role, text in rows:
        names.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        which = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(which, text)
        role = "user" if which == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(which, 1)
    return out, names


def brute_edits(rows):
    """Cheapest edits by relaxing every edge until nothing changes; rows are (initial, fault)."""
    legal = re.compile("(s?(ua)+)?")
    state = lambda made: {"": 0, "s": 1, "u": 2, "a": 3}[made[-1:]]
    best = {(0, 0): (0, "", "")}
    changed = True
    while changed:
        changed = False
        for (i, _), (cost, audit, made) in list(best.items()):
            steps = [(i, 5, "I", r) for r in "ua"]
            if i < len(rows):
                initial, fault = rows[i]
                more = 5 if fault == "truncated" else 0
                steps.append((i + 1, 2, "D", ""))
                if fault not in ("blank", "duplicate"):
                    steps += [(i + 1, 1 + more, "R", r) for r in "ua"]
                    steps += [(i + 1, more, "K", initial)] if initial in list("sua") else []
            for j, price, edit, role in steps:
                if not legal.fullmatch(made + role) and not legal.fullmatch(made + role + "a") and not legal.fullmatch(made + role + "ua"):
                    continue
                new = (cost + price, audit + edit, made + role)
                key = (j, state(new[2]))
                if key not in best or new[:2] < best[key][:2]:
                    best[key] = new
                    changed = True
    ends = [best[k] for k in ((len(rows), 0), (len(rows), 3)) if k in best]
    return min(ends)[:2]


def brute_repair(rows):
    left, names = brute_damage(rows)
    grouped = defaultdict(list)
    for row in left:
        grouped[row[0]].append(row)
    out = {}
    for conv in names:
        found = sorted(grouped[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in found:
            bare = text.strip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
            seen.add((role, text))
            faults.append(fault or ("" if bare[-1] in ".!?" else "truncated"))
        cost, audit = brute_edits([(r[2][:1], f) for r, f in zip(found, faults)])
        numbers = [r[1] for r in found if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(found, found[1:])]
        left_rows, made, lines = iter(found), "", []
        for edit in audit:
            _, _, role, text = next(left_rows) if edit != "I" else (0, 0, "", "")
            if edit in "RI":
                role = "assistant" if made[-1:] == "u" else "user"
            if edit != "D":
                made += role[0]
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        count = faults.count
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest)
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(frame):
    found = repair.summary(repair.repair(repair.damage(frame))).select("conv_id", *FIELDS).collect()
    out = {r[0]: tuple(r[1:]) for r in found}
    assert len(out) == len(found)
    return out


def test_agenda_against_every_sequence_of_edits():
    legal = re.compile("(s?(ua)+)?")

    def cheapest(code):
        best = None
        for inserts in range(3):
            for edits in itertools.product("DKR", repeat=len(code)):
                for places in itertools.combinations_with_replacement(range(len(code) + 1), inserts):
                    for given in itertools.product("ua", repeat=edits.count("R") + inserts):
                        letters, made, cost, audit = iter(given), "", 0, ""
                        for i in range(len(code) + 1):
                            for _ in range(places.count(i)):
                                made, cost, audit = made + next(letters), cost + 5, audit + "I"
                            if i == len(code):
                                break
                            row, edit = code[i], edits[i]
                            cost += {"D": 2, "K": 0, "R": 1}[edit]
                            cost += 5 if row.isupper() and edit != "D" else 0
                            cost += 99 if row == "x" and edit != "D" or row in "oO" and edit == "K" else 0
                            audit += edit
                            made += {"D": "", "K": row.lower()}.get(edit) if edit in "DK" else next(letters)
                        if cost < 99 and legal.fullmatch(made) and (best is None or (cost, audit) < best):
                            best = cost, audit
        return best

    for n in range(4):
        for code in itertools.product("suaUAox", repeat=n):
            assert repair.cheapest("".join(code)) == cheapest("".join(code)), code
    draw = random.Random(5)
    for _ in range(300):
        code = "".join(draw.choices("suaUAox", k=draw.randrange(30)))
        cuts = sorted(draw.choices(range(len(code) + 1), k=draw.randrange(4)))
        parts = [code[a:b] for a, b in zip([0, *cuts], [*cuts, len(code)])]
        weight, chosen = repair.along([repair.spans(p) for p in parts])
        assert weight == repair.cheapest(code)
        texts = "".join(repair.spans(p)[c][1] for p, c in zip(parts, chosen))
        assert texts == weight[1]


@pytest.mark.parametrize("rows_, bytes_", [(2000, 1 << 20), (7, 1 << 20), (3, 100), (1, 1)])
def test_repair_whole_and_in_pieces(spark, monkeypatch, rows_, bytes_):
    monkeypatch.setattr(turns, "PIECE_ROWS", rows_)
    monkeypatch.setattr(turns, "PIECE_BYTES", bytes_)
    assert repaired(conversations(spark, EDGE)) == brute_repair(EDGE)
    assert repaired(conversations(spark, [])) == {}


def test_repair_of_random_conversations(spark, monkeypatch):
    draw = random.Random(3)
    texts = ["one.", "two", "", " ", "three!", None, "one."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None]
    rows = [
        (draw.randrange(40), draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts))
        for _ in range(600)
    ]
    monkeypatch.setattr(turns, "PIECE_ROWS", 9)
    assert repaired(conversations(spark, rows)) == brute_repair(rows)


def test_repair_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = as_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = queries()["op11_structure_repair"](spark, sf_dir)
    assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in found.collect()} == brute_repair(rows)


# ---- formatting


def eos_template(conversation):
    """Ends with a mark that moves on: history is rewritten by each turn."""
    return "".join(f"[{r}]{t};" for r, t in conversation) + "<eos>"


def thought_template(conversation):
    """Thoughts of all but the last turn are dropped."""
    drop = lambda t: re.sub("<think>.*?</think>", "", t)
    last = len(conversation) - 1
    return "".join(f"[{r}]{t if i == last else drop(t)};" for i, (r, t) in enumerate(conversation))


def numbered_template(conversation):
    """Looks back to the beginning: a turn's text depends on how many came before."""
    return "".join(f"{i}. {r}: {t}\n" for i, (r, t) in enumerate(conversation))


def trimmed_template(conversation):
    return "".join(f"[{r}] {t.strip()} ;" for r, t in conversation)


def twice_template(conversation):
    return "".join(f"{r}: {t} / {t}\n" for r, t in conversation)


NASTY = ["\\", "[INST", "]", "</s>", "<s>", " [/INST]", "<|end|>", "<|text|>", "<", "[", "\\INST]", " ", "x", "</", "s>", "é"]


def test_template_is_read_back():
    draw = random.Random(9)
    for _ in range(3000):
        made = [
            (draw.choice(["user", "assistant", "system", "", "<|text|>", "a[b"]), "".join(draw.choices(NASTY, k=draw.randrange(6))))
            for _ in range(draw.randrange(1, 5))
        ]
        output = chatformat.inst_template(made)
        assert list(chatformat.read_inst(output)) == made
        found = chatformat.render(chatformat.inst_template, made)
        assert found["formatted"] == output and not found["rewrites"]
        starts = [s["start"] for s in found["turns"]]
        assert starts == sorted(starts) and all(a["end"] == b["start"] for a, b in zip(found["turns"], found["turns"][1:]))
        learnt = [chatformat.unescape(output[s["text_start"] : s["text_end"]]) for s in found["turns"] if s["learn"]]
        assert learnt == [t for r, t in made if r == "assistant"]


TALK = [("system", "sys"), ("user", "hi"), ("assistant", "<think>hm</think>yes"), ("user", "so"), ("assistant", "<think>ok</think>no")]


def learnt_texts(found):
    return [found["formatted"][s["text_start"] : s["text_end"]] for s in found["turns"] if s["learn"]]


def test_templates_that_rewrite_history():
    moved = chatformat.render(eos_template, TALK)
    # The mark moves with every turn but the first; the texts before it stand.
    assert moved["rewrites"] == [1, 2, 3, 4]
    assert learnt_texts(moved) == [t for r, t in TALK if r == "assistant"]
    thoughts = chatformat.render(thought_template, TALK)
    assert thoughts["rewrites"] == [3]
    assert learnt_texts(thoughts) == ["<think>ok</think>no"]
    assert chatformat.render(numbered_template, TALK)["rewrites"] == []
    assert learnt_texts(chatformat.render(trimmed_template, [("assistant", " a b  ")])) == ["a b"]
    assert learnt_texts(chatformat.render(twice_template, TALK)) == []


def brute_format(rows):
    grouped = defaultdict(list)
    for conv, turn, role, text in [*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        grouped[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, found in grouped.items():
        said = [r[2:] for r in sorted(found)]
        learnt = "".join(t for r, t in said if r == "assistant")
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out[conv] = (
            len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learnt), sha(learnt),
            len(chatformat.inst_template(said)), 0,
        )
    return out


def summarised(found):
    return {r[0]: tuple(r[1:]) for r in found.collect()}


@pytest.mark.parametrize("rows_, bytes_", [(128, 1 << 20), (7, 1 << 20), (3, 100), (1, 1)])
def test_format_whole_and_in_pieces(spark, monkeypatch, rows_, bytes_):
    monkeypatch.setattr(chatformat, "PIECE_TURNS", rows_)
    monkeypatch.setattr(chatformat, "PIECE_BYTES", bytes_)
    both = conversations(spark, EDGE).select("conv_id", "turn", "role", "text")
    both = both.unionByName(chatformat.probe_rows(spark))
    found = chatformat.format_chat(both)
    assert summarised(chatformat.summary(found)) == brute_format(EDGE)
    if rows_ < 128:
        assert found.where("conv_id = 5 and not whole").count() >= 60 // 7
    assert chatformat.format_chat(conversations(spark, [])).count() == 0


@pytest.mark.parametrize(
    "template, cut", [(chatformat.inst_template, True), (eos_template, False), (thought_template, False), (numbered_template, False)]
)
def test_pieces_join_to_the_whole_output(spark, monkeypatch, template, cut):
    """Templates that look far back, or rewrite, are called with whole conversations."""
    monkeypatch.setattr(chatformat, "PIECE_TURNS", 6)
    rows = [(1, i, ("user", "assistant")[i % 2], f"<think>t{i}</think>said {i}") for i in range(40)]
    found = chatformat.format_chat(conversations(spark, rows), template).orderBy("part").collect()
    assert (len(found) > 1) == cut
    said = [r[2:] for r in rows]
    assert "".join(r.formatted for r in found) == template(said)
    whole = chatformat.render(template, said)
    learnt = [r.formatted[t.text_start : t.text_end] for r in found for t in r.turns if t.learn]
    assert learnt == learnt_texts(whole)
    assert sum(len(r.rewrites) for r in found) == len(whole["rewrites"])


def test_format_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = as_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert summarised(queries()["op12_chat_format"](spark, sf_dir)) == brute_format(rows)
