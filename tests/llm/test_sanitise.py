import hashlib
import math
import random
from collections import Counter

from odd_rows import TEXTS, empty, frame
from pattern_spans import base
from twinsieve.llm import sanitise
from twinsieve.llm.queries import table


def _joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def _check(rows, found):
    assert len(rows) == len(found)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    for key, text in rows:
        spans = base(text)
        digest = hashlib.sha256(_joined(spans).encode()).hexdigest()
        match = [r for r in by[key] if r.base_sha256 == digest]
        assert match, (key, text and text[:80], _joined(spans))
        assert [match[0].n_email, match[0].n_ip, match[0].n_card, match[0].n_phone] == [
            sum(k == x for *_, k in spans) for x in ("email", "ip", "card", "phone")]
        assert {_joined([s]) for s in spans} <= set(match[0].spans.split(",")) | {""}


def test_query_equals_plain_patterns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    _check([(r.doc_id, r.text) for r in docs.collect()], sanitise.personal_data_digest(docs).collect())


def test_random_and_long_texts(spark):
    draw = random.Random(1)
    parts = ["a", "b.", "@", "x.y", "1", "22", "255", "256", ".", "-", " ", "+1", "+49", "(0)", "4111 1111 1111 1111", "378282246310005",
             "é", "𝒳", "%", "_", "\n", "a@b.c", "@d.e", "1.2.3.4", "0001"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))) for i in range(1500)]
    rows += [(5000, "a@b.c " * 2000), (5001, "1.2.3." * 1500), (5002, "+1" * 2000), (5003, "1 " * 2000)]
    _check(rows, sanitise.personal_data_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    runs = [(1, "a" * 100_000), (2, "1" * 100_000), (3, "." * 50_000 + "@")]           # nothing to find, however long
    assert all(r.spans == "" for r in sanitise.personal_data_digest(spark.createDataFrame(runs, "doc_id long, text string")).collect())


def test_disclosing_terms(spark):
    draw = random.Random(3)
    common = [" ".join(draw.choice(["alpha", "bravo", "delta", "gamma"]) for _ in range(40)) for _ in range(700)]
    rows = [(i, t) for i, t in enumerate(common)]
    rows += [(1000 + k, f"{common[k]} zanzibar alpha jo@corp.example bravo {common[k + 1]}") for k in range(5)]
    rows += [(2000 + k, f"{common[k]} quixotic alpha ann@corp.example bravo") for k in range(4)] + [(2010 + k, f"{common[k]} quixotic") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in sanitise.personal_data_digest(docs).collect()}
    text = dict(rows)
    marked = {key: {text[key][int(a):int(b)] for kind, a, b in (s.split(":") for s in spans.split(",") if s) if kind == "term"} for key, spans in found.items()}
    assert all(marked[1000 + k] == {"zanzibar"} for k in range(5))
    # Four of its seven places are near the entity: generalised, there and where no entity stands.
    assert all(marked[k] == {"quixotic"} for k in (*range(2000, 2004), *range(2010, 2013)))
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert "zanzibar" not in clean[1000] and "jo@" not in clean[1000] and "<EMAIL>" in clean[1000] and "alpha" in clean[1000]
    assert "<TERM> alpha <EMAIL> bravo" in clean[2000] and clean[2010] == f"{common[0]} <TERM>" and clean[0] == text[0]
    assert all(found[k] == "" for k in range(700))


def test_terms_against_a_count_by_documents(spark):
    """Each term that the counts by documents convict is marked; none without SUPPORT documents beside an entity is."""
    draw = random.Random(9)
    vocabulary = [f"{a}{b}{c}{d}" for a in "bcdf" for b in "aeiou" for c in "lmnr" for d in ("sta", "vek", "dor")]
    rows = []
    for i in range(900):
        words = [draw.choice(vocabulary) for _ in range(25)]
        if draw.random() < 0.08:
            k = draw.randrange(6)
            words.insert(draw.randrange(25), f"person{k}@corp.example")
            for _ in range(draw.randint(0, 2)):
                words.insert(draw.randrange(25), "".join("uvwxyz"[k] for _ in range(4)) + draw.choice("abc"))
        if draw.random() < 0.01:
            words.insert(3, draw.choice("uvwxyz") * 4 + draw.choice("abc"))
        rows.append((i, " ".join(words)))
    shown = {i: ({w for w in t.split() if "@" in w}, {w for w in t.split() if "@" not in w}) for i, t in rows}
    entities, terms, both = Counter(), Counter(), Counter()
    for who, words in shown.values():
        entities.update(who), terms.update(words), both.update((w, e) for w in words for e in who)
    convicted = {w for (w, e), n in both.items() if n >= sanitise.SUPPORT and n / terms[w] >= sanitise.SHARE
                 and math.log2(n * len(rows) / (terms[w] * entities[e])) >= sanitise.BITS}
    assert convicted
    docs, text = spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)
    marked = {}
    for r in sanitise.personal_data_digest(docs).collect():
        for kind, a, b in (s.split(":") for s in r.spans.split(",") if s):
            if kind == "term":
                marked.setdefault(text[r.doc_id][int(a):int(b)], set()).add(r.doc_id)
    supported = {w for (w, _), n in both.items() if n >= sanitise.SUPPORT}
    assert convicted <= set(marked) <= supported
    assert all(marked[w] == {i for i, (_, words) in shown.items() if w in words} for w in marked)


def test_odd_rows(spark):
    _check(TEXTS, sanitise.personal_data_digest(frame(spark)).collect())
    kept = sanitise.sanitised(frame(spark))
    assert kept.columns == frame(spark).columns and kept.count() == len(TEXTS)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[2] is None and texts[3] == "" and texts[9] == "mail <EMAIL> or <PHONE> ip <IP> card <CARD>"
    assert sanitise.personal_data_digest(empty(spark)).count() == 0


def test_disclosing_terms_are_marked_wherever_they_stand(spark):
    draw = random.Random(4)
    filler = lambda: " ".join(draw.choice(["alpha", "bravo", "delta", "gamma"]) for _ in range(60))
    rows = [(i, filler()) for i in range(700)]
    rows += [(1000 + k, f"Zanzibar {filler()} zanzibar {filler()} jo@corp.example") for k in range(5)]       # far from the entity
    rows += [(1010 + k, f"quixotic {filler()} ann@corp.example") for k in range(4)]
    rows += [(1020, f"{filler()} ZANZIBAR {filler()} quixotic"), (None, "zanzibar"), (None, "zanzibar")]     # texts without it
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = sanitise.sanitised(docs).collect()
    assert len(clean) == len(rows)
    assert not [r for r in clean if "zanzibar" in r.text.lower() or "quixotic" in r.text]
    by = {r.doc_id: r.text for r in clean}
    assert by[1020].endswith("<TERM>") and all(by[i] == text for i, text in rows[:700])
    assert all(by[1010 + k].startswith("<TERM> ") and by[1010 + k].endswith("<EMAIL>") for k in range(4))
