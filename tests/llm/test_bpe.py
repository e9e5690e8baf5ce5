"""The merge automaton against pair merging by hand, and whole texts against the tokenizers library."""

import random
import struct

import public_tokenizers
import pytest
from llm_fixtures import clashing, edges, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from receiptflow.llm import bpe

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module")
def coders():
    out = {}
    for name in FILES:
        vocabulary = bpe.load(public_tokenizers.path(name))
        out[name] = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary), Tokenizer.from_file(public_tokenizers.path(name))
    return out


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def merged(word, merges):
    """Each merge in turn, from left to right."""
    parts = list(word)
    for u, v in merges:
        i = 0
        while i < len(parts) - 1:
            if (parts[i], parts[i + 1]) == (u, v):
                parts[i : i + 2] = [u + v]
            i += 1
    return parts


def random_merges(r, symbols, n):
    tokens, merges = list(symbols), []
    while len(merges) < n:
        u, v = r.choice(tokens), r.choice(tokens)
        if u + v not in tokens and len(u + v) < 9:
            tokens.append(u + v)
            merges.append((u, v))
    return merges


@pytest.mark.parametrize("seed", range(25))
def test_automaton_has_the_merged_path(seed):
    r = random.Random(seed)
    symbols = "abc"[: 1 + seed % 3] if seed % 3 else "ab"
    merges = random_merges(r, symbols, r.randrange(1, 5 if len(symbols) == 1 else 14))
    automaton, arcs = bpe.compile_merges(list(symbols), merges)
    names = list(arcs)
    transducer = bpe.Transducer(automaton, [tuple(symbols.index(c) for c in t) for t in names], len(symbols), states=50)
    for _ in range(200):
        word = "".join(r.choice(symbols) for _ in range(r.randrange(1, 25)))
        assert [names[a] for a in transducer.arcs([symbols.index(c) for c in word])] == merged(word, merges)
    assert len(transducer.places) < 50 + 25


@pytest.mark.parametrize("seed", range(10))
def test_automaton_has_no_other_path(seed):
    """Of all ways to cut a word into tokens just one is a path."""
    r = random.Random(seed)
    merges = random_merges(r, "ab", 8)
    automaton, arcs = bpe.compile_merges(["a", "b"], merges)

    def paths(word, state=bpe.START):
        if not word:
            yield []
        for token, arc in arcs.items():
            if word.startswith(token) and automaton.has_arc(state, arc):
                for rest in paths(word[len(token) :], arc):
                    yield [token, *rest]

    for _ in range(60):
        word = "".join(r.choice("ab") for _ in range(r.randrange(1, 11)))
        assert list(paths(word)) == [merged(word, merges)]


def test_merges_that_make_no_new_token():
    for merges in ([("a", "c")], [("ab", "a")], [("a", "b"), ("a", "b")]):
        with pytest.raises(ValueError):
            bpe.compile_merges(["a", "b"], merges)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text("aeinrst 's<|endoftext|>ΣσİÉ́́漢😀\x85\x1c\n\t12½͸꟎", max_size=60)))
def test_any_text_as_the_library_does(coders, name, text):
    encoder, decoder, library = coders[name]
    ids = library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text) == packed(ids)
    assert decoder.text(packed(ids)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", FILES)
def test_documents_as_the_library_does(spark, sf_dir, coders, name):
    path = public_tokenizers.path(name)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(300)
    texts = dict(docs.collect())
    rows = bpe.decode(bpe.encode(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path), path).collect()
    assert len(rows) == len(texts)
    library = coders[name][2]
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert bytes(row["ids"]) == packed(ids) and row["n_tokens"] == len(ids)
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_edges_and_clashing_columns(edges, clashing, no_docs, coders):
    path = public_tokenizers.path(FILES[0])
    assert bpe.decode(bpe.encode(no_docs, path), path).count() == 0
    rows = bpe.decode(bpe.encode(edges, path), path).collect()
    assert len(rows) == edges.count()
    for row in rows:
        assert bytes(row["ids"]) == packed(coders[FILES[0]][2].encode(row["text"] or "", add_special_tokens=False).ids)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    more = clashing.withColumns({"ids": F.lit("mine"), "n_tokens": F.lit("mine"), "decoded": F.lit("mine")})
    mixed = bpe.decode(bpe.encode(more, path), path)
    assert mixed.select("doc_id", "ids", "n_tokens", "decoded").exceptAll(bpe.decode(bpe.encode(edges, path), path).select("doc_id", "ids", "n_tokens", "decoded")).isEmpty()
    assert {r["kept"] for r in mixed.collect()} == {"mine"}


def test_ids_that_are_none(coders):
    decoder = coders[FILES[0]][1]
    assert decoder.text(packed([10**9, 320])) == decoder.text(packed([320])) and decoder.text(b"") == ""


def test_long_words(coders):
    encoder, _, library = coders[FILES[0]]
    text = "ab" * 30_000 + " " + "é" * 5000
    assert encoder.ids(text) == packed(library.encode(text, add_special_tokens=False).ids)
