"""Toxicity grammar: transducers against rules spelled out, edge cases, held-out labels."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ROWS
from tillroll.llm import toxicity as tox

LABELS = [(1, 0), (2, 1), (2, 0), (3, None), (7, 0), (None, 1), (99, 1), (13, 1)]


def patterns(text: str, arcs=None) -> list[str]:
    return [tox.PATTERNS[p][0] for _, p, _ in tox.Grammar(arcs or {}).match(text).found]


@pytest.mark.parametrize("text, want", [
    ("What an idiot.", ["insult"]),
    ("You are an idiot.", ["aimed"]),
    ("An idiot, you know.", ["insult", "aims"]),
    ("You know. An idiot.", ["insult"]),
    ("This is not an idiot.", ["negated"]),
    ("Not that anyone would ever be an idiot.", ["insult"]),
    ("She said he is an idiot.", ["reported"]),
    ("She said so. An idiot.", ["insult"]),
    ('He wrote: "what an idiot. a moron" and left, a fool', ["reported", "reported", "insult"]),
    ('"left open idiot\na moron', ["reported", "insult"]),
    ("We will kill you.", ["threat"]),
    ("We will not kill you.", []),
    ("Kill the lights. You know.", []),
    ("Ich hasse dich, du Dummkopf", ["aimed"]),
    ("idiotic idiots", ["insult"]),
    ("", []), ("\n\n", []), ("IDIOT", ["insult"]),
])
def test_patterns(text, want):
    assert patterns(text) == want


def by_rules(symbols: bytes) -> list[int]:
    """The four rewritings one after the other, as loops over whole lists."""
    out, left = [], 0
    for s in symbols:
        new = s
        if left and s in (tox.INSULT, tox.THREAT):
            new = tox.NEGATED if s == tox.INSULT else tox.NEGATED_THREAT
        if s == tox.NEGATION:
            left = tox.SCOPE
        elif s in (tox.CLAUSE, tox.LINE):
            left = 0
        elif s != tox.QUOTE:
            left = max(left - 1, 0)
        out.append(new)
    quoted = told = False
    for k, s in enumerate(out):
        if s == tox.LINE:
            quoted = told = False
        elif s == tox.QUOTE:
            quoted, told = not quoted, False
        elif s == tox.CLAUSE:
            told = False
        elif s == tox.REPORT:
            told = told or not quoted
        elif (quoted or told) and s in (tox.INSULT, tox.THREAT):
            out[k] = tox.REPORTED if s == tox.INSULT else tox.OTHER
    waits = False
    for k, s in enumerate(out):
        if s in (tox.CLAUSE, tox.LINE):
            waits = False
        elif s == tox.THREAT:
            out[k], waits = tox.OTHER, True
        elif s == tox.NEGATED_THREAT:
            out[k] = tox.OTHER
        elif s == tox.TARGET and waits:
            out[k], waits = tox.ATTACK, False
    named = pending = False
    for k, s in enumerate(out):
        if s in (tox.CLAUSE, tox.LINE):
            named = pending = False
        elif s == tox.ATTACK:
            named, pending = True, False
        elif s == tox.TARGET:
            if pending:
                out[k] = tox.AIMS
            named, pending = True, False
        elif s == tox.INSULT:
            if named:
                out[k] = tox.AIMED
            else:
                pending = True
    return out


@pytest.mark.parametrize("seed", range(4))
def test_composed_machine_equals_the_rules_in_turn(seed):
    rng, machine = random.Random(seed), tox.grammar()
    for _ in range(300):
        symbols = bytes(rng.choices(b"IHTNRQOEL", weights=[4, 3, 3, 2, 2, 1, 5, 2, 1], k=rng.randrange(30)))
        state, got = 0, []
        for s in symbols:
            state, made = machine.step(state, s)
            got.append(made)
        assert got == by_rules(symbols)


def test_weights_and_pieces(monkeypatch):
    rules = tox.Grammar({"réeu": 2.0, "réeuxs$": 3.0})
    assert rules.match("réeuxs réeux réc").found == [(0, tox.INSULT, 3.0), (1, tox.INSULT, 2.0)]
    text = ("You are réeux. She said réeux \"idiot\nnot réeuxs " * 40)
    whole = rules.match(text)
    monkeypatch.setattr(tox, "PIECE", 7)
    assert rules.match(text) == whole and whole.words == len([w for w in text.replace('"', " ").replace(".", " ").split()])


def scores(spark, docs, labels):
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return sorted(map(tuple, tox.score_toxicity(docs, marks, ~tox.held_out(F.col("doc_id"))).select(
        "id", "score", "predicted", "n_words", F.size("matches")).collect()), key=repr)


def test_edge_rows(spark, edge_docs, clash_docs, no_docs):
    got = scores(spark, edge_docs, LABELS)
    assert len(got) == len(ROWS) and all(0 <= r[1] <= 1 and r[2] == int(r[1] >= 0.5) for r in got)
    assert scores(spark, clash_docs.withColumns({n: F.lit("clash") for n in ("toxic", "matches", "x", "arc", "predicted")}), LABELS) == got
    assert scores(spark, no_docs, LABELS) == []
    unlabelled = scores(spark, edge_docs, [])
    assert all(r[1] == 0 for r in unlabelled) and max(r[3] for r in unlabelled) == sum(w.rstrip("0123456789").isalpha() for w in LONG.split())
    assert scores(spark, edge_docs, [(1, 1), (2, 1)])[0][1] == unlabelled[0][1]      # one label only: nothing to fit


def test_held_out_labels_are_found_and_never_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = tox.held_out(F.col("doc_id"))
    first = tox.score_toxicity(docs, labels, ~held).select("id", "score").collect()
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(first) == sorted(tox.score_toxicity(docs, turned, ~held).select("id", "score").collect())
    score = {r.id: r.score for r in first}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    flagged = {i for i in truth if score[i] >= 0.5}
    toxic = {i for i, t in truth.items() if t}
    assert len(flagged & toxic) >= 0.7 * len(toxic) and len(flagged - toxic) <= 0.01 * len(truth)
