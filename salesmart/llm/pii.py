"""Personal data in texts, plain or in disguise, as spans of the source.

Plain identifiers are found by base rules. Then two transducers rewrite the
text, each keeping for every character it writes the span of the source it came
from: the first turns look-alike and compatibility letters, foreign digits, spaces
and dashes into ASCII and drops invisible characters; the second turns spelled
digits and disguised at and dot signs into what they stand for. The same rules find
identifiers in what comes out, and their spans are mapped back to the source. A found
span is added unless it lies within a plain one of its kind: of an address of which
only the end is plain, the whole is added beside its end.

Every rule is linear in the text and has no bound on words, pieces or spaces: repeats
are possessive, and addresses are put together from a single pass over words and signs.

Cases: NULL and empty texts have no spans, very long ones are judged whole; every row is
judged by itself, so repeated rows, NULL ids and empty tables need nothing special; of
spans that tie in start the order of kinds decides; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, not overlapping; found from the at signs, so in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            # What stands before this sign belongs to no later match.
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * v - 9 * (v > 4) for v in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find(text: str) -> list[Span]:
    """Spans by the base rules, ordered by start, then kind."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return ordered(spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУаеѕіјорсхуԁԛԝһкмтнвӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαιυνρκıɡօսհո∙•",
        "ABESIJKMHOPCTXYaesijopcxydqwhkmthblABEZHIKMNOPTYXoaiuvpkigouhn..",
        strict=True,
    )
)
# Characters beyond the Latin letters, the no-break space and the soft hyphen.
_STRANGE = re.compile(r"[\xa0\xad]|[^\x00-ɏ]")

# Digits as words in four languages.
_DIGIT_WORDS = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(words.split())
}
_DOTS = "dot|punkt|point|punto"
_ATS = "at|arroba|ät"
_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_OPEN, _SHUT = r"[\[({<]\s*+", r"\s*+[\])}>]"
_TOKEN = rf"(?:(?:{_WORD}|{_DOTS}|plus)\b|{_OPEN}(?:\.|{_DOTS}){_SHUT}|[+(]?[0-9]++[).]?)"
_SPELLED = re.compile(rf"(?i)(?<!\w){_TOKEN}(?:[\s,-]++{_TOKEN})+")
_SPELLED_HINT = re.compile(
    rf"(?i)\b(?:{_WORD})\b[\s,-]++(?:(?:{_WORD}|{_DOTS}|plus)\b|[\[({{<+]?\s?[0-9.]|{_OPEN}(?:{_DOTS})\b)"
    rf"|(?:[0-9][).]?|[\])}}>]|\b(?:{_DOTS}|plus))[\s,-]++(?:{_WORD})\b"
)
_BRACKETED = re.compile(
    rf"(?i)\s*+{_OPEN}(?:(?P<at>@|{_ATS})|(?P<dot>\.|{_DOTS})){_SHUT}\s*+"
)


def _sign(plain: str, words: str) -> str:
    """A sign as itself, in brackets, between dashes, or as a word or itself between spaces."""
    framed = rf"\s++[-*_/~|]++(?:{plain}|{words})[-*_/~|]++\s++"
    return rf"(?:\s*+{_OPEN}(?:{plain}|{words}){_SHUT}\s*+|{framed}|\s++(?:{plain}|{words})\s++|{plain})"


_AT_SIGN, _DOT_SIGN = _sign("@", _ATS), _sign(r"\.", _DOTS)
# What addresses are made of, one after another.
_PARTS = re.compile(rf"(?i)(?P<at>{_AT_SIGN})|(?P<dot>{_DOT_SIGN})|(?P<word>[\w%+-]++)|\s++|.", re.S)
_LABEL, _TOP = re.compile("[A-Za-z0-9-]+"), re.compile("[A-Za-z]{2,24}")
_SAID_IP = re.compile(rf"(?i)(?<![\w.])[0-9]{{1,3}}(?:{_DOT_SIGN}[0-9]{{1,3}}){{3}}(?!\w)")
_DOT = re.compile(rf"(?i){_DOT_SIGN}")
_SAID_HINT = re.compile(
    rf"(?i)\s(?:{_DOTS}|[.@])\s|[\[({{<]\s*+(?:[@.]|(?:{_ATS}|{_DOTS})\b)"
    rf"|\s(?:{_ATS})\s++[A-Za-z0-9-]++\.[a-z]|\s[-*_/~|]++(?:{_ATS}|{_DOTS})[-*_/~|]"
)
# What an address with little disguise ends in beside two-letter endings, the
# words of prose that look like such an ending, and those that stand before "at" in prose.
_TOPS = frozenset("com org net edu gov info biz example test dev app online shop site".split())
_NO_TOPS = frozenset("an as at be by do go he if in is it me my no of on or so to up us we".split())
_PROSE = frozenset(
    "a about all am an and are arrive arrived as ask at available back based be been begin bought buy "
    "call check click come created directly documentation documented download downloaded email "
    "everyone file files find found free from go guide had has have he help her here him home hosted i "
    "is it join know learn listed live located look looked looking mail me meet more "
    "not now of online or order our out page pages people post posted published read "
    "register registered report see seen she shop sign site sold start started staying stop store "
    "talk that the them there these they this those time up update us version "
    "visit was we website were with work worked working works write written you".split()
)
# Names of accounts that are words of prose, too: they count where a sentence or field begins.
_ROLES = frozenset("contact information news questions support team".split())
_BEGINS = re.compile(r"(?i)(?:^|[\n:;,(\[<>\"'|]|\b(?:to|mail|email|e-mail|contact|reach|via|or|and))\s*\Z")
_LEAST_SPELLED, _PHONE_DIGITS = 4, (10, 15)


class Rewritten:
    """A text written anew, and for each character the source span it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits (start, end, written), in order and not overlapping. All that is
        written for a stretch stands for the whole stretch."""
        if not edits:
            return
        texts, starts, ends, done = [], [], [], 0
        for start, end, written in edits:
            if start < done:
                continue
            texts += [self.text[done:start], written]
            starts += [self.starts[done:start], np.full(len(written), self.starts[start])]
            ends += [self.ends[done:start], np.full(len(written), self.ends[end - 1])]
            done = end
        self.text = "".join([*texts, self.text[done:]])
        self.starts = np.concatenate([*starts, self.starts[done:]])
        self.ends = np.concatenate([*ends, self.ends[done:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


def plain_character(c: str) -> str:
    """ASCII for look-alikes, compatibility letters, foreign digits, spaces and dashes."""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    kind = unicodedata.category(c)
    if kind == "Cf":
        return ""
    if kind == "Zs":
        return " "
    if kind == "Pd" or c == "−":
        return "-"
    if (value := unicodedata.decimal(c, None)) is not None:
        return str(value)
    if c in "。․":
        return "."
    written = unicodedata.normalize("NFKC", c)
    return written if len(written) == 1 and written.isascii() else c


def plain_characters(found: Rewritten) -> None:
    edits = [(m.start(), m.end(), plain_character(m[0])) for m in _STRANGE.finditer(found.text)]
    found.replace([e for e in edits if found.text[e[0]] != e[2]])


def spelled_digits(found: Rewritten) -> list[tuple[int, int]]:
    """Writes runs of spelled digits as digits. Returns the source spans of runs
    that are as long as a telephone number and need no plus sign to be one."""
    edits, phones = [], []
    for m in _SPELLED.finditer(found.text):
        parts = re.findall(rf"(?i){_TOKEN}", m[0])
        written, spelled = [], 0
        for part in map(str.lower, parts):
            spelled += part in _DIGIT_WORDS
            sign = "." if part.strip("[](){}<> \t\n") in (".", *_DOTS.split("|")) else "+" if part == "plus" else part
            written.append(_DIGIT_WORDS.get(part, sign))
        joined = "".join(written)
        # A few words are a disguise only if they make the whole an identifier.
        if not spelled or spelled < _LEAST_SPELLED and not any(
            s[1:] == (0, len(joined)) for s in find(joined)
        ):
            continue
        edits.append((m.start(), m.end(), joined))
        digits = _NOT_DIGIT.sub("", joined)
        if spelled >= _PHONE_DIGITS[0] and len(digits) <= _PHONE_DIGITS[1] and "." not in joined:
            phones.append(found.source(*m.span()))
    found.replace(edits)
    return phones


class Chain:
    """Words with dot signs between them, as (start, end) in the text."""

    def __init__(self) -> None:
        self.words: list[tuple[int, int]] = []
        self.dots: list[tuple[int, int]] = []

    def whole(self) -> bool:
        """Ends with a word."""
        return len(self.words) > len(self.dots)


def is_address(text: str, local: Chain, at: str, domain: Chain) -> bool:
    """Whether the signs between these words stand for those of an address."""
    signs = [text[a:b].strip().lower() for a, b in domain.dots]
    top = text[slice(*domain.words[-1])]
    spaced = at != at.strip()
    at = at.strip().lower()
    if at == "@" and not spaced or any(x == "dot" or not x.isalpha() and x != "." for x in signs):
        return True
    if at not in ("@", *_ATS.split("|")):
        return True
    # Said "at", and dots that are plain or words of prose: "look at this point".
    first = text[slice(*domain.words[0])].lower()
    end = top in _TOPS or len(top) == 2 and top.islower() and top not in _NO_TOPS or top == "uk"
    if not end or first == "www" or any(x != "." for x in signs) and top.lower() not in _TOPS and at == "at":
        return False
    start, word = local.words[0][0], text[local.words[0][0] : local.words[-1][1]].lower()
    if word in _ROLES:
        return bool(_BEGINS.search(text[max(0, start - 24) : start]))
    follows = text[domain.words[-1][1] : domain.words[-1][1] + 1]
    return at not in ("at", "@") or not (word in _PROSE or follows == "/")


def addresses(text: str) -> Iterator[tuple[Chain, tuple[int, int], Chain]]:
    """Local part, at sign and domain of what may be an address, in one pass."""
    local, at, chain = None, None, Chain()

    def complete() -> tuple[Chain, tuple[int, int], Chain] | None:
        """The address that ends here, its domain cut at the last word that may end one."""
        if at is None:
            return None
        n = 0
        while n < len(chain.words) and _LABEL.fullmatch(text, *chain.words[n]):
            n += 1
        while n > 1 and not _TOP.fullmatch(text, *chain.words[n - 1]):
            n -= 1
        if n < 2:
            return None
        domain = Chain()
        domain.words, domain.dots = chain.words[:n], chain.dots[: n - 1]
        found = (local, at, domain)
        return found if is_address(text, local, text[slice(*at)], domain) else None

    for m in _PARTS.finditer(text):
        kind = m.lastgroup
        if kind == "word" and not chain.whole():
            chain.words.append(m.span())
        elif kind == "dot" and chain.whole():
            chain.dots.append(m.span())
        elif kind == "at" and chain.whole():
            found = complete()
            if found:
                yield found
                local, at, chain = None, None, Chain()
            else:
                local, at, chain = chain, m.span(), Chain()
        else:
            found = complete()
            if found:
                yield found
            local, at, chain = None, None, Chain()
            if kind == "word":
                chain.words.append(m.span())
    if found := complete():
        yield found


def said_signs(found: Rewritten) -> None:
    """Writes at and dot signs that are in brackets, framed, spaced or said as in an address."""
    edits = []
    for local, at, domain in addresses(found.text):
        dots = [*local.dots, *domain.dots]
        edits += [(a, b, ".") for a, b in dots if found.text[a:b] != "."]
        if found.text[slice(*at)] != "@":
            edits.append((*at, "@"))
    found.replace(sorted(edits))
    edits = []
    for m in _SAID_IP.finditer(found.text):
        signs = _DOT.finditer(found.text, *m.span())
        edits += [(x.start(), x.end(), ".") for x in signs if x[0] != "."]
    found.replace(edits)
    found.replace(
        [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(found.text)]
    )


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that show only after the transducers."""
    strange = _STRANGE.search(text)
    found = Rewritten(text)
    if strange:
        plain_characters(found)
    phones: list[tuple[int, int]] = []
    if spelled := _SPELLED_HINT.search(found.text):
        phones = spelled_digits(found)
    said = _SAID_HINT.search(found.text)
    if said:
        said_signs(found)
    if not (strange or spelled or said) or found.text == text:
        return []
    spans = [(kind, *found.source(a, b)) for kind, a, b in find(found.text)]
    spans += [("phone", a, b) for a, b in phones]
    plain = {kind: [s[1:] for s in base if s[0] == kind] for kind in KINDS}
    last = dict.fromkeys(KINDS, 0)
    added: list[Span] = []
    for span in ordered(spans):
        kind, start, end = span
        before = bisect_left(plain[kind], (start + 1, 0))
        within = before and plain[kind][before - 1][1] >= end
        if start >= last[kind] and not within:
            last[kind] = end
            added.append(span)
    return added


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_private(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, and base and all spans as text."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            counts: list[list[int]] = []
            digests, spans, more = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = find(text)
                added = disguised(text, base)
                counts.append([sum(s[0] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(ordered(base + added)))
                more.append(len(added))
            numbers = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(numbers[:, i]) for i in range(len(KINDS))),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array(more, pa.int64()),
                ],
                names,
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return narrow.mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_disguised bigint"
    )
