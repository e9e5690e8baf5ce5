"""Personal data, lines, quality rules, decontamination and language model against plain models in Python."""

import re
from collections import Counter
from math import log

import pytest
from llm_fixtures import clashing, edges, no_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from receiptflow.llm import decontam, lines, ngram, pii, rules

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="ab1234567890..@@+-- ()%_é", max_size=60))
def test_base_spans(text):
    assert pii.detect(text) == spans(text)


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "one " * 50_000):
        base = pii.detect(text)
        pii.added(text, base)


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("mail jane.doe [at] example (dot) com now", "email", "jane.doe [at] example (dot) com"),
        ("write john at mail dot example dot org", "email", "john at mail dot example dot org"),
        ("j​ane@exаmple.com", "email", "j​ane@exаmple.com"),
        ("plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("at one nine two dot one six eight dot one dot two.", "ip", "one nine two dot one six eight dot one dot two"),
        ("10[.]0[.]0[.]1", "ip", "10[.]0[.]0[.]1"),
    ],
)
def test_disguises(text, kind, part):
    assert pii.detect(text) == []
    assert [(k, text[a:b]) for k, a, b in pii.added(text, [])] == [(kind, part)]


@pytest.mark.parametrize(
    "text, part",
    [
        ("write to jane at example.com soon", "jane at example.com"),
        ("Mail jane.doe at mail.example.co.uk.", "jane.doe at mail.example.co.uk"),
        ("schreib hans at beispiel punkt de heute", "hans at beispiel punkt de"),
        ("hans at beispiel.de", "hans at beispiel.de"),
        ("escribe a juan arroba ejemplo punto com hoy", "juan arroba ejemplo punto com"),
        ("juan punto ruiz arroba ejemplo punto com punto final", "juan punto ruiz arroba ejemplo punto com"),
        ("juan arroba ejemplo.es", "juan arroba ejemplo.es"),
        ("a jeanne arobase exemple point fr merci", "jeanne arobase exemple point fr"),
        ("jeanne [arobase] exemple point fr", "jeanne [arobase] exemple point fr"),
        ("juan@ejemplo punto com", "juan@ejemplo punto com"),
    ],
)
def test_disguised_addresses_of_four_languages(text, part):
    assert pii.detect(text) == []
    assert [(k, text[a:b]) for k, a, b in pii.added(text, [])] == [("email", part)]


def test_two_disguised_addresses_in_a_row():
    text = "juan arroba uno punto com punto ana arroba dos punto es"
    assert [text[a:b] for _, a, b in pii.added(text, [])] == ["juan arroba uno punto com", "ana arroba dos punto es"]


@pytest.mark.parametrize(
    "text",
    [
        "Find us at example.com or look at www.example.org.", "We are at this point in time, at one point it was.", "I met him at noon.Then we left at six.It rained.",
        "See jane at example.com/about", "un punto de vista at home", "Bob at file.txt", "mail bob@example.com point made", "le point de vue",
    ],
)
def test_words_of_disguises_in_plain_text(text):
    assert pii.added(text, pii.detect(text)) == []


def test_plain_text_has_no_disguises():
    text = "We met at noon. One of two dots (see [1]) at home, naïve café. Call 12345 at seven."
    assert pii.added(text, pii.detect(text)) == []


def test_pii_on_edges(spark, edges, no_docs):
    assert pii.find_spans(no_docs).count() == 0
    found = pii.find_spans(edges).collect()
    assert len(found) == 9 and all(r.spans == "" for r in found)


def kept_lines(texts, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)}))
    counts = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if counts[key(x)] < least) for t in texts]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (5, 3)])
def test_lines(spark, batches, fanout):
    texts = [f"Shared LINE\n own {i} \n\nÉtat {i % 4}\n shared line\t" for i in range(30)] + [None, "", "\n", "shared line"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in lines.drop_common_lines(docs, 8, batches, fanout).collect()}
    for i, expected in enumerate(kept_lines(texts, 8)):
        assert (rows[i].text or "") == expected
        assert rows[i].n_lines == (texts[i] or "").count("\n") + 1
    assert rows[30].text is None and rows[33].text == ""


def test_lines_on_edges(spark, edges, no_docs, clashing):
    assert lines.drop_common_lines(no_docs).count() == 0
    assert lines.drop_common_lines(edges).count() == 9
    rows = lines.drop_common_lines(clashing, 2)
    assert rows.count() == 9 and rows.where("kept = 'mine'").count() == 9
    assert rows.where("doc_id = 4").first().text == ""


def repeated(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(inside)


def test_rule_counts(spark):
    texts = ["a b c d e f g h " * 3, "x", "# $%& <a> | é\n\n# $%& <a> | é\n", "a b c d e f g h i a b c d e f g h", None]
    rows = rules.document_stats(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), repeated(words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", texts[r.doc_id] or ""))
    assert [r.n_dup_lines for r in sorted(rows, key=lambda r: r.doc_id)] == [0, 0, 1, 0, 0]


def test_outliers(spark):
    import random

    draw = random.Random(5)
    syllables = ["ba", "den", "ti", "ro", "lu", "mes", "ka", "ni"]
    text = lambda n: " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n))
    rows = [(i, text(draw.randint(30, 300)), "en", "s") for i in range(300)] + [(1000 + i, text(80).replace(" ", " | "), "en", "s") for i in range(20)]
    rows += [(2000 + i, text(100).upper() + "!!", "en", f"small{i}") for i in range(9)]
    found = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(not found[i].kept for i in range(300)) <= 1
    assert not any(found[1000 + i].kept for i in range(20))
    # All of the small groups of a language are judged together.
    assert all(found[2000 + i].kept for i in range(9))


def test_rules_on_edges(spark, edges, no_docs, clashing):
    assert rules.judge(no_docs).count() == 0
    rows = {r.doc_id: r for r in rules.judge(edges).collect()}
    assert not any(r.kept for r in rows.values())  # too short, or one word again and again
    assert rules.judge(edges.select("doc_id", "text")).count() == 9
    assert set(rules.passing(clashing).columns) == set(clashing.columns)


def hits(words, items, size=10):
    inside, found = set(), set()
    for name, item in items.items():
        n = min(size, len(item))
        tests = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in tests:
                inside |= set(range(i, i + n))
                found.add(name)
    return len(inside), sorted(found)


@pytest.mark.parametrize("block", [decontam.BLOCK, 60])
def test_decontamination(spark, block):
    import random

    draw = random.Random(3)
    word = lambda: draw.choice("the of and to in é ü x1 y2 z3 w4 v5".split())
    items = {str(i): [word() for _ in range(draw.choice([0, 2, 9, 10, 15, 25]))] for i in range(12)}
    docs = []
    for i in range(60):
        words = [word() for _ in range(draw.randint(0, 60))]
        item = items[str(i % 12)]
        at = draw.randint(0, len(words))
        docs.append(words[:at] + (item if i % 2 else item[:9]) + words[at:])
    rows = spark.createDataFrame([(i, ", ".join(d).upper().replace("É", "é").replace("Ü", "ü")) for i, d in enumerate(docs)], "doc_id long, text string")
    table = spark.createDataFrame([(int(k), " ".join(v) if v else None) for k, v in items.items()], "item_id long, text string")
    found = decontam.search(spark, decontam.build_index(rows), table, block=block).collect()
    assert len(found) == 60
    for r in found:
        assert (r.n_hit, r["items"]) == hits(docs[int(r.key)], items)
        assert r.n_words == len(docs[int(r.key)])


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, item), (2, item.replace("zeta", "well zeta")), (3, " ".join(reversed(item.split()))), (4, item.replace("zeta", "a b c d zeta"))]
    table = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    assert [(found[i]["items"], found[i].near) for i in (1, 2, 3, 4)] == [(["7"], []), ([], ["7"]), ([], []), ([], [])]


def test_benchmark_passes_the_driver_block_by_block(spark, monkeypatch):
    held = []
    inner = decontam.search_shards
    monkeypatch.setattr(decontam, "search_shards", lambda tests, *a: held.append(len(tests[2])) or inner(tests, *a))
    words = [f"w{i}" for i in range(400)]
    table = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1]))], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(0, 380, 19)] + [(999, None)], "doc_id long, text string")
    found = decontam.search(spark, decontam.build_index(docs), table, block=400).collect()
    assert {(r.n_hit, *r["items"]) for r in found if r.key != "999"} == {(12, "1")} and len(found) == 21
    assert len(held) > 4 and max(held) <= 8 * 200


@pytest.mark.parametrize("block", [decontam.BLOCK, 10])
def test_items_without_an_id(spark, block):
    table = spark.createDataFrame([(None, "one two"), (3, "two three"), (None, "three x one")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two"), (3, "none")], "doc_id long, text string")
    found = decontam.search(spark, decontam.build_index(docs), table, block=block).collect()
    assert {r.key: (r.n_hit, r["items"]) for r in found} == {"1": (3, ["3", None]), "2": (2, [None]), "3": (0, [])}


def test_decontamination_on_edges(spark, edges, no_docs, clashing):
    table = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, "one two three")], "item_id long, text string")
    assert decontam.contaminated(no_docs, table).count() == 0
    assert decontam.contaminated(edges, table.limit(0)).where("n_hit > 0").count() == 0
    assert sorted(r.doc_id for r in decontam.contaminated(edges, table).where("n_hit = 3").collect()) == [4, 5, 5]
    assert decontam.clean(clashing, table).count() == 6


def scores(texts):
    docs = [(t or "").encode().lower().split() for t in texts]
    words, pairs = Counter(w for d in docs for w in d), Counter(p for d in docs for p in zip(d, d[1:]))
    total, micro = sum(words.values()), lambda x: round(log(x) * 1e6)
    out = []
    for d in docs:
        value = [micro(0.4 * words[d[0]] / total)] if d else []
        for u, w in zip(d, d[1:]):
            value.append(micro(pairs[u, w]) - micro(words[u]) if pairs[u, w] >= 2 else micro(0.4 * words[w] / total))
        out.append((len(d), sum(pairs[p] >= 2 for p in zip(d, d[1:])), sum(value)))
    return out


@pytest.mark.parametrize("vocabulary, heavy", [(ngram.VOCABULARY, 1000), (3, 1000), (ngram.VOCABULARY, 5)])
def test_language_model(spark, monkeypatch, vocabulary, heavy):
    import random

    draw = random.Random(1)
    monkeypatch.setattr(ngram, "HEAVY", heavy)
    texts = [" ".join(draw.choices("a b c d e f g h é THE the".split(), k=draw.randint(0, 40))) for _ in range(50)] + [None, " \n"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r.micro) for r in ngram.score(docs, vocabulary).collect()}
    assert [rows[i] for i in range(len(texts))] == scores(texts)


@pytest.mark.parametrize("vocabulary", [ngram.VOCABULARY, 3])
def test_language_model_of_few_words(spark, vocabulary):
    texts = ["a b c d", "a b x y", "e f", "g", "a b a b a b q r s"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r.micro) for r in ngram.score(docs, vocabulary).collect()}
    assert [rows[i] for i in range(len(texts))] == scores(texts)


def test_language_model_in_many_buckets_and_batches(spark, monkeypatch):
    """One plan, without joins, however many words there are."""
    import random

    draw = random.Random(2)
    monkeypatch.setattr(ngram, "BUCKET", 20)
    texts = [" ".join(f"w{min(draw.randint(0, 99), draw.randint(0, 99))}" for _ in range(draw.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    found = ngram.score(docs, 5)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    rows = {r.doc_id: (r.n_words, r.n_hit, r.micro) for r in found.collect()}
    assert [rows[i] for i in range(len(texts))] == scores(texts)


def test_language_model_sends_no_more_to_more_buckets():
    import random

    import pyarrow as pa

    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randint(0, 9999)}" for _ in range(30)) for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"row": range(4000), "doc_id": range(4000), "text": texts})
    words = list(ngram.read_words(iter([batch])))
    assert len(words) == 1  # both runs of about a megabyte

    def sent(buckets):
        return sum(len(x) for rows in ngram.ask(1, buckets)(iter(words)) for x in rows.column("body").to_pylist())

    assert sent(512) < 1.2 * sent(8)


def test_language_model_on_edges(edges, no_docs, clashing):
    assert ngram.score(no_docs).count() == 0
    assert ngram.score(edges).where("score IS NULL").count() == 3
    assert ngram.score(clashing).count() == 9


