"""Personal data in texts, also in disguise, as spans of the source text.

Base spans are found in the text as it is. For disguises the text runs through a chain of transducers,
each of which rewrites what it knows and hands the rest on, with the source span of every character:
homoglyphs and invisible characters, at and dot disguises, spelled digits. The same detectors run over
the result, and what they find there through rewritten characters is mapped back to the source.
Texts in which no transducer finds anything to rewrite are done after the base spans.

Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from receiptflow.llm.text import arrow, bounded, pieces, schema_of

KINDS = ("email", "ip", "card", "phone")
FOUND = schema_of("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long")

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that gives no match gives none from its middle either, so only its first digit is tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """All base spans, by start, then kind in the order of ``KINDS``."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        else:
            # The next address can't begin before this sign.
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ο": "O", "Ρ": "P", "Τ": "T",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
#: Digits in words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
INVISIBLE = frozenset("­​‌‍⁠﻿")

_word = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_open, _close = r"[\[({<]", r"[\])}>]"
_dot = rf"(?:\s*{_open}\s*(?:dot|punkt|punto|point|\.)\s*{_close}\s*|\s+(?:dot|punkt)\s+)"
AT = re.compile(
    rf"\s*{_open}\s*(?:at|@|arroba|arobase)\s*{_close}\s*"
    rf"|(?<=[a-z0-9])\s+(?:at|arroba|arobase)\s+(?=[a-z0-9-]+(?:{_dot}[a-z0-9-]+)+)",
    re.IGNORECASE,
)
DOT = re.compile(_dot, re.IGNORECASE)
_named = r"\s+(?:punto|point)\s+"
_domain = rf"[a-z0-9-]++(?:(?:\.|{_dot}|{_named})[a-z0-9-]++)+"
#: What ``AT`` leaves: a plain at whose domain has real dots, or punto and point, which are words of their own as well.
SPOKEN = re.compile(rf"(?<=[a-z0-9_%+-])\s+(at|arroba|arobase)\s+(?={_domain})", re.IGNORECASE)
PLAIN_DOMAIN = re.compile(_domain, re.IGNORECASE)
AFTER = re.compile(rf"@{_domain}", re.IGNORECASE)
SEPARATOR = re.compile(rf"\.|{_dot}|{_named}", re.IGNORECASE)
NAMED = re.compile(_named, re.IGNORECASE)
#: The local part that ends a text, with its named dots; ``LOCAL`` characters are looked at.
BEFORE = re.compile(rf"[a-z0-9_%+-]+(?:(?:\.|{_named})[a-z0-9_%+-]+)+$", re.IGNORECASE)
LOCAL = 100
#: Endings of domains, besides those of two letters.
ENDINGS = frozenset("com org net edu gov mil int info biz name pro coop museum aero jobs mobi travel cat tel xxx post asia eus gal app dev xyz online site shop store cloud tech club blog wiki page email live news world life agency space website top vip work team group company digital media studio design email berlin hamburg koeln wien paris madrid london nyc test example invalid localhost".split())
#: Endings of two letters that are words of the four languages and may follow point.
SHORT_WORDS = frozenset("am an as at be by do go he hi if in is it me my no of on or so to up us we ab da du er es im ja ob so um wo zu au ce de du en et il je la le ma me ne ni on ou sa se si ta te tu un va vu al lo mi os su ti ya yo".split())
#: Words before a plain at that name a site and no person.
SITES = frozenset("a about also am an and are arrive arrived available based be been blog bought buy buying by can check checked checking click com come details directly do download everything find first for found free from go hear her here him hosted i in information is it item items its join just learn link links listed listen live located look looked looking looks meet more my not now of on online only or order ordered our out over page pages play please posted products published purchase read register registered reserved see seen sell she shop shopping shown sign site sites sold something start started starting stay stop store stream subscribe that the their them there these they things this those tickets to today together up us use view visit was watch watching we web website were what work worked working works you your yourself".split())
#: Runs of three or more digits, at least one of them in words, with their signs.
SPELLED = re.compile(rf"\b(?:plus\s+)?(?:{_word}|[0-9]+)(?:[\s,.-]+(?:(?:dot|point|punkt|dash|hyphen)\s+)?(?:{_word}|[0-9]+))+\b", re.IGNORECASE)
WORD = re.compile(rf"(?P<digit>{_word})|(?P<plain>[0-9]+)|(?P<plus>plus)|(?P<dot>dot|point|punkt)|(?P<dash>dash|hyphen)|(?P<sign>\.)|(?P<gap>[\s,-]+)", re.IGNORECASE)
BRACKETED = re.compile(rf"{_open}\s*(?:at|@|arroba|arobase|dot|punkt|punto|point|\.)\s*{_close}", re.IGNORECASE)
TRIGGERS = frozenset(w.encode() for w in (*DIGIT_WORDS, "dot", "punkt"))
PLAIN = frozenset((b"at", b"punto", b"point", b"arroba", b"arobase"))
APART = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
RUN = re.compile(rf"\b(?:{_word})[\s,.-]+(?:(?:dot|point|punkt|dash|hyphen)\s+)?(?:{_word}|[0-9])", re.IGNORECASE)


@lru_cache(maxsize=4096)
def plain(char: str) -> str | None:
    """What a character stands for: itself is None, nothing is empty."""
    if char < "\u0080":
        return None
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    if unicodedata.category(char) == "Nd":
        return str(unicodedata.digit(char))
    folded = unicodedata.normalize("NFKC", char)
    return folded if folded != char and folded.isascii() else None


class Tape:
    """A rewritten text: each character with its source span, and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.begin = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.new = bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put ``value`` for each [start, end), given in order; all of a value stands for all of the range."""
        if not edits:
            return
        text, begin, end, new, at = [], [], [], bytearray(), 0
        for start, stop, value in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:start])
            begin += self.begin[at:start]
            end += self.end[at:start]
            new += self.new[at:start]
            text.append(value)
            if value:
                begin += [self.begin[start]] * len(value)
                end += [self.end[stop - 1]] * len(value)
                new += b"\1" * len(value)
            elif new and stop > start:
                # What was taken out may have split what stands before and after.
                new[-1] = 1
            at = stop
        self.text, self.begin, self.end, self.new = "".join(text), begin, end, new


def homoglyphs(tape: Tape) -> None:
    if not tape.text.isascii():
        tape.rewrite([(i, i + 1, value) for i, char in enumerate(tape.text) if (value := plain(char)) is not None])


def ends_domain(label: str, strict: bool) -> bool:
    """Whether a domain can end so; ``strict`` where the label may as well be a word of the text."""
    name = label.lower()
    return name in ENDINGS or len(name) == 2 and name.isalpha() and not (strict and name in SHORT_WORDS)


def spoken_ats(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPOKEN.finditer(text):
        domain = PLAIN_DOMAIN.match(text, m.end())
        labels = SEPARATOR.split(domain[0])
        named, real = NAMED.search(domain[0]), "." in SEPARATOR.findall(domain[0])
        last = labels[-1]
        if named:
            good = any(ends_domain(x, m[1].lower() == "at") for x in labels[1:])
        elif m[1].lower() != "at":
            good = ends_domain(last, False)
        else:
            before = re.search(r"[a-z0-9._%+-]+$", text[max(0, m.start() - LOCAL) : m.start()], re.IGNORECASE)
            # Sentences run together (it.It), sites and addresses of pages are none.
            good = real and ends_domain(last, False) and (last.islower() or domain[0].isupper()) and labels[0].lower() != "www"
            good = good and before[0].lower() not in SITES and text[domain.end() : domain.end() + 1] not in ("/", ":", "@")
        if good:
            edits.append((m.start(), m.end(), "@"))
    return edits


def named_dots(tape: Tape) -> list[tuple[int, int, str]]:
    """The plain punto and point in addresses whose at is known: up to the last ending, and in the local part."""
    edits, floor = [], 0
    for m in AFTER.finditer(tape.text):
        parts = [*SEPARATOR.finditer(tape.text, m.start(), m.end())]
        named = [NAMED.fullmatch(x[0]) is not None for x in parts]
        new = tape.new[m.start()]
        if new:
            start = max(floor, m.start() - LOCAL)
            local = BEFORE.search(tape.text[start : m.start()])
            if local:
                edits += [(x.start(), x.end(), ".") for x in NAMED.finditer(tape.text, start + local.start(), m.start())]
        if not any(named) or not new and not named[0]:
            continue
        stops = [x.start() for x in parts[1:]] + [m.end()]
        ends = [ends_domain(tape.text[x.end() : stop], not new) for x, stop in zip(parts, stops, strict=True)]
        upto = max((i for i, good in enumerate(ends) if good), default=-1)
        floor = stops[upto] if upto >= 0 else m.start() + 1
        edits += [(x.start(), x.end(), ".") for x, n in zip(parts[: upto + 1], named, strict=False) if n]
    return edits


def disguises(tape: Tape) -> None:
    ats = {m.start(): (m.start(), m.end(), "@") for m in AT.finditer(tape.text)}
    ats |= {e[0]: e for e in spoken_ats(tape.text) if e[0] not in ats}
    tape.rewrite([ats[start] for start in sorted(ats)])
    if "@" in tape.text:
        tape.rewrite(named_dots(tape))
    tape.rewrite([(m.start(), m.end(), ".") for m in DOT.finditer(tape.text)])


def spelled_digits(tape: Tape) -> None:
    edits = []
    for run in SPELLED.finditer(tape.text):
        if not RUN.search(tape.text, run.start(), run.end()):
            continue
        parts = [m for m in WORD.finditer(tape.text, run.start(), run.end())]
        for part in parts:
            value = {"digit": DIGIT_WORDS.get(part[0].lower()), "plus": "+", "dot": ".", "dash": "-", "gap": ""}.get(part.lastgroup)
            if value is not None:
                edits.append((part.start(), part.end(), value))
    tape.rewrite(edits)


def disguised(text: str) -> bool:
    """Whether a transducer could rewrite anything."""
    if not text.isascii() and any(plain(c) is not None for c in set(text)):
        return True
    words = text.lower().encode().translate(APART).split()
    if not TRIGGERS.isdisjoint(words):
        return True
    # These are words of any text, so their places are looked at.
    if not PLAIN.isdisjoint(words) and (spoken_ats(text) or any(NAMED.search(m[0]) for m in AFTER.finditer(text))):
        return True
    return any(c in text for c in "[({<") and bool(BRACKETED.search(text))


def added(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows."""
    if not disguised(text):
        return []
    tape = Tape(text)
    homoglyphs(tape)
    disguises(tape)
    spelled_digits(tape)
    known = set(base)
    out = []
    for kind, start, end in detect(tape.text):
        if any(tape.new[start:end]):
            span = (kind, tape.begin[start], tape.end[end - 1])
            if span not in known and not any(k == kind and a <= span[1] and span[2] <= b for k, a, b in base):
                out.append(span)
    return out


def shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in pieces(batches):
        out: dict[str, list] = {name: [] for name in FOUND.names[1:]}
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            base = detect(text)
            more = added(text, base)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
            out["base"].append(shown(base))
            out["spans"].append(shown(base + more))
            out["n_added"].append(len(more))
        yield arrow({"doc_id": rows.column("doc_id")} | out, FOUND)


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base counts by kind, ``base`` and all ``spans``, and how many were added.

    Spans are written ``kind:start:end``, by start, then kind, comma-joined. A null text is empty and
    has none.
    """
    return bounded(docs).select("doc_id", "text").mapInArrow(find, FOUND)
