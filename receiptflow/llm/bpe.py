"""Byte-pair encoding by an automaton, and decoding by its labels.

``compile_merges`` turns a list of merges into a deterministic automaton whose arcs are labelled with tokens
and whose paths are exactly the token sequences that the merges produce. It starts with one state and an arc
for each base symbol, and puts in one merge gadget after the other: for the merge of u and v, the state that
arcs u lead to loses its arc v, every state with an arc u gets an arc uv, and uv leads to a copy of the state
that v led to before. States are kept copy-on-write: token x leads to state x, which is the state of x's second
part as it was when x came to be, less the arcs it has lost since. ``has_arc`` reads an arc through these copies.

A text has one path only, so what was read so far has one last token, whatever comes after. ``Transducer`` follows
the arcs that a word's symbols may still be in the middle of, and keeps each set of such places as a numbered
state with its last token. Words run through the table of these states, one lookup for each symbol; a state or
transition that is not there yet is worked out from the automaton. The last tokens, read from the end of the
word backwards, are its tokens. The table is bounded, and starts anew when it is full.

Words are split off as the vocabulary file says: by two expressions where these are known to agree with the
``tokenizers`` library, else by the library's own normalizer and pre-tokenizer.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from receiptflow.llm.text import arrow, bounded, pieces, plus

START, NEVER = -1, sys.maxsize
#: States of a task's table, and words whose tokens it remembers, at most.
STATES, WORDS = 150_000, 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Automaton:
    """Arcs are numbers: base symbols first, then one for each merge. ``born`` is when an arc came to be, if it did."""

    def __init__(self, symbols: int):
        self.left, self.right, self.born = [-1] * symbols, [-1] * symbols, [-1] * symbols
        self.lost: dict[tuple[int, int], int] = {}

    def has_arc(self, state: int, arc: int, before: float = NEVER) -> bool:
        """Whether the state that ``state``'s arcs lead to had ``arc`` just before a time."""
        left, right, born, lost = self.left, self.right, self.born, self.lost
        if state == START:
            return born[arc] < before
        if born[state] >= before:
            return False
        while True:
            if born[arc] >= before or lost.get((state, arc), NEVER) < before:
                return False
            if born[arc] < 0 and born[state] < 0:
                return True
            if born[arc] >= born[state]:
                # The arc was added then, where its first part could be read, after that gadget's own cut.
                before, arc = born[arc] + 0.5, left[arc]
            else:
                before, state = born[state], right[state]

    def gadget(self, u: int, v: int) -> int:
        """Put in the next merge and return its arc; a merge whose parts never meet adds an arc that no path takes."""
        time = len(self.left)
        meet = self.has_arc(u, v, time)
        if meet:
            self.lost[u, v] = time
        self.left.append(u)
        self.right.append(v)
        self.born.append(time if meet else NEVER)
        return time


def compile_merges(symbols: list[str], merges: list[tuple[str, str]]) -> tuple[Automaton, dict[str, int]]:
    """The automaton, and the arc of each token. Every merge joins tokens that are there already, to a new one."""
    automaton, arcs = Automaton(len(symbols)), {s: i for i, s in enumerate(symbols)}
    for u, v in merges:
        if u not in arcs or v not in arcs or u + v in arcs:
            raise ValueError(f"the merge of {u!r} and {v!r} does not make a new token of two known ones")
        arcs[u + v] = automaton.gadget(arcs[u], arcs[v])
    return automaton, arcs


class Transducer:
    """Tokens of words by table: ``step`` maps state and symbol to a state, ``last`` names each state's last token."""

    def __init__(self, automaton: Automaton, spelled: list[bytes | tuple[int, ...]], width: int, states: int = STATES):
        self.automaton, self.width, self.bound = automaton, width, states
        self.size = [len(s) for s in spelled]
        self.child: dict[int, int] = {}
        self.end, self.inner = [-1], [False]
        for arc, symbols in enumerate(spelled):
            node = 0
            for symbol in symbols:
                key = node * width + symbol
                if key not in self.child:
                    self.child[key] = len(self.end)
                    self.inner[node] = True
                    self.end.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.end[node] = arc
        self.clear()

    def clear(self) -> None:
        start = ((START, 0),)
        self.step: dict[int, int] = {}
        self.known, self.places, self.last = {start: 0}, [start], [START]

    def extend(self, state: int, symbol: int) -> int:
        """Work out a transition: places are (token before, node of the tokens' tree)."""
        found, on = None, []
        for before, node in self.places[state]:
            node = self.child.get(node * self.width + symbol)
            if node is None:
                continue
            if found is None and self.end[node] >= 0 and self.automaton.has_arc(before, self.end[node]):
                found = self.end[node]
            if self.inner[node]:
                on.append((before, node))
        if found is None:
            raise ValueError(f"symbol {symbol} has no token")
        places = ((found, 0), *on)
        target = self.known.get(places)
        if target is None:
            target = self.known[places] = len(self.places)
            self.places.append(places)
            self.last.append(found)
        self.step[state * self.width + symbol] = target
        return target

    def arcs(self, symbols: list[int] | bytes) -> list[int]:
        """The only path that spells ``symbols``."""
        if len(self.places) > self.bound:
            self.clear()
        state, step, width, seen = 0, self.step, self.width, []
        for symbol in symbols:
            then = step.get(state * width + symbol)
            state = self.extend(state, symbol) if then is None else then
            seen.append(state)
        at, out = len(seen), []
        while at:
            arc = self.last[seen[at - 1]]
            out.append(arc)
            at -= self.size[arc]
        return out[::-1]


#: Fixed value: the way to take a text apart that ``Splitter`` knows. No word of it holds white space.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}
PATTERN = KNOWN["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]


def load(path: str) -> dict:
    """What tasks need of a vocabulary file of the ``tokenizers`` library (a BPE model over bytes)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, letters = spec["model"], byte_letters()
    if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
        raise ValueError("not a vocabulary of plain byte pairs")
    suffix = model.get("end_of_word_suffix") or ""
    symbols = letters + [c + suffix for c in letters] * bool(suffix)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    automaton, arcs = compile_merges(symbols, merges)
    spelled: list[tuple[int, ...]] = [(i,) for i in range(len(symbols))]
    for arc in range(len(symbols), len(arcs)):
        spelled.append(spelled[automaton.left[arc]] + spelled[automaton.right[arc]])
    decoder = (spec.get("decoder") or {}).get("type")
    if decoder not in (None, "ByteLevel"):
        raise ValueError(f"unknown decoder {decoder}")
    texts = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("added tokens must stand for their plain text")
    return {
        "tables": (automaton.left, automaton.right, automaton.born, automaton.lost, spelled),
        "ids": [model["vocab"][token] for token in arcs],
        "suffix": bool(suffix),
        "known": {k: spec[k] for k in KNOWN} == KNOWN,
        "library": json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}),
        "added": {t["content"]: t["id"] for t in spec["added_tokens"]},
        "texts": [texts.get(i) for i in range(max(texts, default=-1) + 1)],
        "decoder": decoder,
    }


class Splitter:
    """The words of a text, as UTF-8, and between them the ids of added tokens that it names."""

    def __init__(self, vocabulary: dict):
        self.added = vocabulary["added"]
        names = sorted(self.added, key=lambda t: -len(t))
        self.names = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.pattern = regex.compile(PATTERN) if vocabulary["known"] else None
        # Every letter below U+0378 is in all versions of Unicode; of the others, those met so far that Python knows.
        self.later, self.fine = re.compile("[^\x00-\u0377]"), set()
        self.json, self.library = vocabulary["library"], None
        self.bytes = {c: b for b, c in enumerate(byte_letters())}

    def certain(self, text: str) -> bool:
        """Whether this Python knows all letters; newer libraries may treat others otherwise."""
        if self.later.search(text):
            new = set(text) - self.fine
            self.fine |= {c for c in new if unicodedata.category(c) != "Cn"}
            return new <= self.fine
        return True

    def words(self, text: str) -> list[str]:
        if self.pattern is None or not text.isascii() and not self.certain(text):
            return self.by_library(text)
        if not text.isascii():
            # Lower case by the letter: str.lower looks around a capital sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.json)
        if self.library.normalizer:
            text = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(text) if self.library.pre_tokenizer else [(text, None)] * bool(text)
        # As bytes that need not be whole characters, so they come as surrogates where they are not.
        return [bytes(self.bytes[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in found]

    def runs(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Words, and the added token after them (none at the end)."""
        parts = self.names.split(text) if self.names else [text]
        for i in range(0, len(parts), 2):
            yield self.words(parts[i]) if parts[i] else [], self.added[parts[i + 1]] if i + 1 < len(parts) else None


class Encoder(dict):
    """Ids of words, little-endian 32 bits each, remembered up to a bound."""

    def __init__(self, vocabulary: dict, states: int = STATES, words: int = WORDS):
        left, right, born, lost, spelled = vocabulary["tables"]
        automaton = Automaton(0)
        automaton.left, automaton.right, automaton.born, automaton.lost = left, right, born, lost
        self.suffix, self.bound = 256 * vocabulary["suffix"], words
        self.transducer = Transducer(automaton, spelled, 512, states)
        self.packed = [i.to_bytes(4, "little") for i in vocabulary["ids"]]
        self.splitter = Splitter(vocabulary)

    def __missing__(self, word: str) -> bytes:
        symbols = list(word.encode("utf-8", "surrogateescape"))
        symbols[-1] += self.suffix
        ids = b"".join([self.packed[arc] for arc in self.transducer.arcs(symbols)])
        if len(word) <= 64:
            if len(self) >= self.bound:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        out = []
        for words, added in self.splitter.runs(text):
            out += map(self.__getitem__, words)
            if added is not None:
                out.append(added.to_bytes(4, "little"))
        return b"".join(out)


class Decoder:
    """Texts of ids: their labels with a space between, or as bytes if the vocabulary says so; unknown ids have none."""

    def __init__(self, vocabulary: dict):
        self.texts, self.as_bytes = vocabulary["texts"], vocabulary["decoder"] == "ByteLevel"
        if self.as_bytes:
            of = {c: b for b, c in enumerate(byte_letters())}
            self.texts = [None if t is None else bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t in self.texts]

    def text(self, ids: bytes) -> str:
        numbers = memoryview(ids[: len(ids) // 4 * 4]).cast("I") if sys.byteorder == "little" else [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids) - 3, 4)]
        texts, n = self.texts, len(self.texts)
        labels = [texts[i] for i in numbers if i < n]
        if None in labels:
            labels = [t for t in labels if t is not None]
        return b"".join(labels).decode("utf-8", "replace") if self.as_bytes else " ".join(labels)


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary: each id as a little-endian unsigned 32-bit integer) and ``n_tokens``.

    ``path`` is a vocabulary file, read by the driver only; tasks get it compiled, bounded by the size of the vocabulary.
    Null is taken as empty, and an empty text has no ids. Whole texts are encoded, whatever their length. Rows
    stay as they are, repeated ones too; columns that are named ``ids`` or ``n_tokens`` are replaced.
    """
    schema = plus(docs.schema, "ids binary, n_tokens long")
    held = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        encoder = vocabulary.setdefault("encoder", None) or Encoder(vocabulary)
        vocabulary["encoder"] = encoder  # for the worker's next task
        for batch, texts in pieces(batches, column):
            ids = [encoder.ids(t.decode("utf-8", "replace")) for t in texts]
            own = {name: batch.column(name) for name in batch.schema.names}
            yield arrow(own | {"ids": ids, "n_tokens": [len(i) // 4 for i in ids]}, schema)

    return bounded(docs).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids that ``encode`` has packed (null: empty). A column of that name is replaced."""
    schema = plus(rows.schema, "decoded string")
    vocabulary = load(path)
    held = rows.sparkSession.sparkContext.broadcast({k: vocabulary[k] for k in ("texts", "decoder")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(held.value)
        for batch, packed in pieces(batches, column):
            own = {name: batch.column(name) for name in batch.schema.names}
            yield arrow(own | {"decoded": [decoder.text(ids) for ids in packed]}, schema)

    return bounded(rows).mapInArrow(run, schema)
