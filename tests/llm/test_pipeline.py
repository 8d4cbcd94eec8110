"""The registered queries and the pipeline's stages over a whole small table."""

import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tillroll.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def items():
    return [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]


def by_id(df, key="doc_id"):
    got = {r[key]: r for r in df.collect()}
    return got


def test_one_query_per_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


def test_op1(spark, documents):
    got = by_id(QUERIES["op1_mixing"](spark, SF_SMALL))
    sizes, taken = {}, {}
    for d in documents:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(brute.words(d["text"]))
    target = brute.targets(sizes)
    for d in documents:
        r = got[d["doc_id"]]
        assert (r["size"], r.source_size) == (len(brute.words(d["text"])), sizes[d["source"]])
        assert r.target == pytest.approx(target[d["source"]]) and 0 <= r.taken <= 3 * r["size"]
        taken[d["source"]] = taken.get(d["source"], 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 0.51 for s in sizes)


def test_op2(spark):
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = by_id(QUERIES["op2_urls"](spark, SF_SMALL), "page_id")
    assert len(got) == len(pages)
    for p in pages:
        rule, verdict = brute.rule(p["url"])
        r = got[p["page_id"]]
        assert (r.host, r.path, r.rule, r.verdict) == (*brute.host_path(p["url"]), rule, verdict or "allow")


def test_op3_and_op5(spark, documents):
    lib = Tokenizer.from_file(tokenizer_path())
    counts = by_id(QUERIES["op3_token_counts"](spark, SF_SMALL))
    file = by_id(QUERIES["op5_token_file"](spark, SF_SMALL))
    start = 0
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids
        c, f = counts[d["doc_id"]], file[d["doc_id"]]
        assert (c.n_bytes, c.n_tokens, c.over_limit) == (len((d["text"] or "").encode()), len(ids), len(ids) > 2048)
        assert (f.start, f.n_tokens, f.ids_crc32) == (start, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))
        start += len(ids) + 1


def test_op4(spark, documents):
    from tests.llm.test_operators import base_scores
    got = by_id(QUERIES["op4_lm"](spark, SF_SMALL))
    base = base_scores([(d["doc_id"], d["text"]) for d in documents], lambda k: brute.crc_mod(k, 7) != 2)
    for k, (n, known, total, score) in base.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.crc_mod(k, 7) == 2, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op6(spark, documents, items):
    got = by_id(QUERIES["op6_decontaminate"](spark, SF_SMALL))
    hits = 0
    for d in documents:
        r = got[d["doc_id"]]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute.contamination(d["text"], items)
        hits += r.contaminated
    assert len(got) == len(documents)


def test_op7(spark, documents):
    fps = [brute.fingerprint(d["text"]) for d in documents]
    comp = brute.components([d["doc_id"] for d in documents], fps)
    got = by_id(QUERIES["op7_simhash"](spark, SF_SMALL))
    assert all((got[d["doc_id"]].fingerprint, got[d["doc_id"]].component_id) == (f"{f:016x}", c)
               for d, f, c in zip(documents, fps, comp))


def test_op8(spark):
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = by_id(QUERIES["op8_html"](spark, SF_SMALL), "page_id")
    import html
    for p in pages:
        body = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip()
                  for x in re.split(r"</?(?:p|h1)>", body)]
        r = got[p["page_id"]]
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text) and r.url == p["url"]


def test_op9(spark, documents):
    got = by_id(QUERIES["op9_quality"](spark, SF_SMALL))
    for d in documents:
        assert tuple(got[d["doc_id"]])[1:6] == brute.quality(d["text"])
        assert got[d["doc_id"]].kept != brute.quality_rejects(d["text"])


def test_stages(spark, documents, items):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {d["doc_id"]: d["text"] for d in documents}
    stage = dict(corpus_pipeline.STAGES)

    out = stage["quality_rules"](spark, docs, SF_SMALL)
    kept = {k: t for k, t in kept.items() if not brute.quality_rejects(t)}
    assert out.columns == columns and {r.doc_id: r.text for r in out.collect()} == kept

    out = stage["simhash_near_dedup"](spark, out, SF_SMALL)
    ids = list(kept)
    comp = brute.components(ids, [brute.fingerprint(kept[i]) for i in ids])
    kept = {i: kept[i] for i, c in zip(ids, comp) if i == c}
    assert out.columns == columns and {r.doc_id: r.text for r in out.collect()} == kept

    out = stage["benchmark_decontamination"](spark, out, SF_SMALL).persist()
    kept = {k: t for k, t in kept.items() if not brute.contamination(t, items)[4]}
    assert out.columns == columns and {r.doc_id: r.text for r in out.collect()} == kept

    mixed = stage["mixing_to_weights"](spark, out, SF_SMALL).persist()
    source = {d["doc_id"]: d["source"] for d in documents}
    sizes, took = {}, {}
    for k, t in kept.items():
        sizes[source[k]] = sizes.get(source[k], 0) + len(brute.words(t))
    for r in mixed.collect():
        assert r.text == kept[r.doc_id] or set(brute.words(r.text)) <= set(brute.words(kept[r.doc_id]))
        took[r.source] = took.get(r.source, 0) + len(brute.words(r.text))
    assert mixed.columns == columns
    assert all(abs(took[s] - v) <= 0.51 for s, v in brute.targets(sizes).items())

    lib = Tokenizer.from_file(tokenizer_path())
    final = sorted(stage["token_output"](spark, mixed, SF_SMALL).collect(), key=lambda r: r.start)
    want = sorted((r.doc_id, zlib.crc32(np.array([*lib.encode(r.text, add_special_tokens=False).ids, 1], "<u4").tobytes()))
                  for r in mixed.collect())
    assert sorted((r.doc_id, r.ids_crc32) for r in final) == want
    assert [r.doc_id for r in final] == sorted(r.doc_id for r in final)
    whole = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, final))
