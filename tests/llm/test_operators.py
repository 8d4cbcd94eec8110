"""Every operator against its plain-Python definition, with the edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import LONG, ROWS, SENTENCE
from tillroll.llm import decontaminate, html, langid, lm, mixing, packing, quality, simhash, tokens, urls
from tillroll.session import work_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ---- 1 mixing -------------------------------------------------------------------

def check_mix(got, docs):
    sizes = defaultdict(int)
    for _, t, _, s, _ in docs:
        sizes[s] += len(brute.words(t))
    target = brute.targets(dict(sizes))
    taken = Counter()
    by_id = defaultdict(list)
    for i, t, _, s, _ in docs:
        by_id[i].append((len(brute.words(t)), sizes[s], s))
    for r in got:
        match = [x for x in by_id[r.id] if x[0] == r.size and x[1] == r.source_size and abs(target[x[2]] - r.target) < 1e-6]
        assert match
        assert 0 <= r.taken <= 3 * r.size
        taken[match[0][2]] += r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= 0.5 + 1e-6
    assert len(got) == len(docs)


def test_mix_reaches_targets(spark, edge_docs, no_docs):
    for block in (4, 512):
        a = mixing.mix_report(edge_docs, block_words=block, slots_per_shard=16).collect()
        check_mix(a, ROWS)
        b = mixing.mix_report(edge_docs.repartition(5), block_words=block, slots_per_shard=16).collect()
        assert sorted(map(repr, a)) == sorted(map(repr, b))
    assert mixing.mix_report(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_targets_match_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice((0, 1, 7, 50, 400, 9000)) * rng.randrange(1, 4) for k in range(rng.randrange(1, 25))}
    sizes[None] = rng.randrange(100)
    rows_ = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows_, "source string, size long")).collect()}
    want = brute.targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_mixed_documents_hold_the_words_taken(spark, clash_docs):
    rep = mixing.mix_report(clash_docs, block_words=16)
    mixed = mixing.mixed_documents(clash_docs, block_words=16)
    assert mixed.columns == clash_docs.columns
    took = Counter()
    for r in rep.collect():
        took[r.id] += r.taken
    have = Counter()
    for r in mixed.collect():
        have[r.doc_id] += len(brute.words(r.text))
    assert {k: v for k, v in took.items() if v} == dict(have)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100, 1023):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    assert [r.p for r in got] != list(range(n))


def test_shard_counts_are_drawn(spark):
    t = spark.createDataFrame([(0, 100_000, 100_000.0), (1, 50_000, 150_000.0)], "sid long, source_size long, target double")
    slots = mixing.draw_slots(t, block_words=10, slots_per_shard=1000).collect()
    assert Counter(s.sid for s in slots) == {0: 10_000, 1: 15_000}
    per = Counter((s.shard, s.sid) for s in slots)
    assert len({k for k, _ in per}) == 25 and all(300 < n < 750 for n in per.values())
    assert len({n for n in per.values()}) > 5
    assert Counter(Counter(s.block for s in slots if s.sid == 1).values()) == {3: 5000}
    assert sorted(s.slot for s in slots if s.sid == 0) == list(range(10_000))


# ---- 2 URLs ---------------------------------------------------------------------

def page(head="", body="x"):
    return f"<html><head>{head}</head><body>{body}</body></html>"


def test_urls_rules_and_aliases(spark):
    canonical = '<link href="{}" rel="canonical">'.format
    refresh = '<meta http-equiv="Refresh" content="0; url={}">'.format
    data = [
        (1, "http://A.net/x", page()), (2, "https://www.example.net/en/1", page()), (3, "http://example.net/de/", page()),
        (4, "http://b.example.com/de/2?x#y", page()), (5, "http://x.org/fr/1", page()), (6, "http://x.net", page()),
        (7, None, page()), (8, "no scheme", page()), (9, "http://c.com/start", page(refresh("http://bad.net/"))),
        (10, "http://d.com/a", page(canonical("http://c.com/start"))), (11, "http://e.com/p/q", page(canonical("/root"))),
        (12, "http://e.com/root#frag", page(refresh("http://ok.org/fr/z"))), (13, "http://e.com/root", None),
        (14, "http://f.com/1", page(canonical("http://bad.net/")) ), (15, "http://g.com/1", page("", canonical("http://bad.net/"))),
        (16, "http://h.com/1", page(refresh("http://f.com/2") + canonical("http://example.net/en/9"))),
        (17, "http://f.com/2", page(canonical("http://f.com/1"))), (None, "http://c.com/start", page()), (18, "http://i.com/1", ""),
        (19, "http://j.com/d/a", page(canonical("b"))), (20, "http://j.com/d/b", page(refresh("//www.bad.net/q"))),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, node string")
    got = urls.judge(df).collect()
    assert len(got) == len(data)
    by = {(r.id, r.host): r for r in got}
    for i, u, _ in data:
        host, path = brute.host_path(u)
        r = by[(i, host)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == brute.rule(u)[0]
        if r.rule:
            assert r.verdict == brute.rule(u)[1]
    verdict = {r.id: (r.verdict, r.by) for r in got}
    assert verdict[9] == verdict[10] == verdict[None] == ("allow", "alias")     # 16 joins an explicit allow to bad.net/
    assert verdict[11] == verdict[12] == verdict[13] == ("allow", "alias")
    assert verdict[14] == verdict[17] == verdict[16] == ("allow", "alias")
    assert verdict[15] == verdict[18] == verdict[7] == verdict[8] == ("allow", "default")
    assert verdict[19] == verdict[20] == ("block", "alias")
    only = df.where("page_id is null or page_id not in (16)")
    verdict = {r.id: r.verdict for r in urls.judge(only).collect()}
    assert verdict[9] == verdict[10] == verdict[14] == verdict[17] == verdict[None] == "block"
    assert urls.judge(df.limit(0)).count() == 0


def test_long_alias_chain(spark):
    n = 60
    data = [(k, f"http://s{k}.com/", page(f'<link rel=canonical href=http://s{k + 1}.com/>')) for k in range(n)]
    data.append((n, f"http://s{n}.com/", page('<meta content="5;URL=http://spam.net/" http-equiv=refresh>')))
    got = urls.judge(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {r.verdict for r in got} == {"block"}


# ---- 3 token counts ---------------------------------------------------------------

TEXTS = [SENTENCE, LONG, "", "it's they're we'll I'd rock'n'roll ''s 've", "<|endoftext|>hello<|startoftext|> World <|STARTOFTEXT|>",
         "a b\x1cd\x85e é ́x ÀÉ İstanbul ß ﬁ １ 3٣ 日本語 \U0001F600!!..",
         "\n\t ", "don't.\"' 'S 'LL \"'re\" ...'s", "a" * 300, "é" * 90 + "!" * 70, "​﻿x \x00y<||>", "x<|endoftext|"]


def test_token_counts_and_every_prefix(spark):
    lib = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    got = {r.id: r for r in tokens.prefix_counts(df, PATH, budget=20).collect()}
    for k, t in enumerate([*TEXTS, None]):
        t = t or ""
        assert got[k].n_bytes == len(t.encode())
        assert got[k].n_tokens == len(lib.encode(t, add_special_tokens=False).ids)
        table = tokens.TokenTable(got[k].steps)
        assert table.counts[-1] == got[k].n_tokens
        assert got[k].budget_chars == table.longest_prefix(20)
        if len(t) > 400 or "<|" in t:
            continue
        norm = " ".join(lib.normalizer.normalize_str(c.decode()) for c in t.encode().split())
        for n in range(len(norm) + 1):
            assert table.tokens(n) == len(lib.encode(norm[:n], add_special_tokens=False).ids)


def test_cache_keeps_its_bound():
    known = tokens.Known(lambda c: c * 2, 5)
    for k in range(40):
        key = b"%d" % (k % 11) * (1 + 40 * (k % 2))
        assert known[key] == key * 2
    assert len(known) == 5 and all(len(k) <= tokens.CACHE_BYTES for k in known)


# ---- 4 language model ---------------------------------------------------------------

def make_text(rng, lang):
    a = [f"{lang}{x}" for x in "abcdefghijkl"]
    out = [rng.choice(a)]
    for _ in range(rng.randrange(20, 120)):
        nxt = a[(a.index(out[-1]) * 5 + rng.randrange(3)) % 12] if rng.random() < 0.8 else rng.choice(a)
        out.append(nxt if rng.random() < 0.95 else out[-1] + str(rng.randrange(50)))
        out[-1] = out[-1] if out[-1] in a else nxt
        if rng.random() < 0.1:
            out[-1] = nxt
    return " ".join(w + (str(rng.randrange(300)) if rng.random() < 0.08 else "") for w in out)


def base_scores(data, learn):
    from math import log10
    c = Counter(w for k, t in data if learn(k) for w in [*brute.words(brute.lower(t or "")), None])
    n, v = sum(c.values()), len(c)
    out = {}
    for k, t in data:
        w = [*brute.words(brute.lower(t or "")), None]
        out[k] = (len(w), sum(c[x] > 0 for x in w), n, sum(log10((c[x] + 1) / (n + v + 1)) for x in w))
    return out


def test_lm_base_and_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "DICTIONARY", 600)     # most rare words take the join
    rng = random.Random(3)
    data = [(k, make_text(rng, "xy"[k % 2])) for k in range(400)] + [(1000, None), (1001, "Never SEEN words"), (1002, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.id: r for r in lm.score_documents(df, ~lm.held_out(F.col("doc_id"))).collect()}
    base = base_scores(data, lambda k: brute.crc_mod(k, 7) != 2)
    assert len(got) == len(data)
    for k, (n, known, total, score) in base.items():
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert r.score < 0
    held = [k for k, _ in data if brute.crc_mod(k, 7) == 2 and k < 1000]
    assert sum(got[k].score for k in held) > sum(got[k].base_score for k in held) + 0.05 * sum(got[k].n_tokens for k in held)


def test_lm_does_not_follow_the_layout(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(k, make_text(rng, "xy"[k % 2])) for k in range(700)], "doc_id long, text string")
    gain = {}
    for n in (1, 60):
        got = lm.score_documents(df.repartition(n), ~lm.held_out(F.col("doc_id"))).where("not learned")
        gain[n] = got.agg((F.sum("score") - F.sum("base_score")) / F.sum("n_tokens")).first()[0]
    assert gain[1] > 0.1 and gain[60] > 0.8 * gain[1]


def test_lm_is_a_distribution(spark):
    rng = random.Random(4)
    texts = [make_text(rng, "z").encode() for _ in range(50)]
    counts = Counter(w for t in texts for w in lm.tokens_of(t))
    top = [x for x in counts.most_common() if x[0]]
    rare = Counter()
    for w, c in top[lm.FREQUENT - 1:]:
        rare[lm.ending(w) % lm.RARE_CLASSES] += c + 1
    lex = lm.Lexicon(top, sum(counts.values()), len(counts), rare, counts[b""])
    w = lm.Weights(lex)
    for t in texts:
        idx, cls, code, _ = lm.read_text(t, lex)
        lm.train_step(w, lex, idx, cls, lex.context_rows(code), np.zeros(len(w.a)), np.zeros(len(w.b)))
    lead = _prefix_log10(lex, w, [b"za", b"zb"])
    total = sum(10 ** (_prefix_log10(lex, w, [b"za", b"zb", tok]) - lead) for tok in lex.index)
    share = _class_shares(lex, w, [b"za", b"zb", b""])[-1]
    total += sum(share[lex.classes:] / lex.rare_mass)            # one unknown word per class
    assert total == pytest.approx(1.0, abs=2e-3)
    text = texts[0]
    assert lm.score_texts([text], lex, w)[0][3] == pytest.approx(_prefix_log10(lex, w, lm.tokens_of(text)), rel=1e-4)


def _class_shares(lex, w, toks):
    z = w.class_weights(lex.context_rows(lex.code[[lex.index[t] for t in toks]])).astype(float)
    return z / z.sum(axis=1, keepdims=True)


def _prefix_log10(lex, w, toks):
    idx = np.array([lex.index[t] for t in toks])
    cls, rows_ = lex.cls[idx], lex.context_rows(lex.code[idx])
    out = 0.0
    for k, share in enumerate(_class_shares(lex, w, toks)):
        out += np.log10(share[cls[k]])
        if idx[k] < lex.frequent:
            z = w.in_weights(lm.in_rows(rows_[:, k:k + 1], cls[k:k + 1]), cls[k:k + 1])[0].astype(float)
            out += np.log10(z[idx[k] % lm.SLOTS] / z.sum())
        else:
            out += np.log10((lex.counts[idx[k]] + 1.0) / lex.rare_mass[cls[k] - lex.classes])
    return out


def test_lm_edge_cases(spark, clash_docs, no_docs):
    got = lm.score_documents(clash_docs, F.col("n_chars") > 2).collect()
    assert len(got) == len(ROWS) and all(r.score < 0 and np.isfinite(r.score) for r in got)
    assert lm.score_documents(no_docs, F.lit(True)).count() == 0
    got = lm.score_documents(clash_docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and all(np.isfinite(r.score) for r in got)


# ---- 5 token files -------------------------------------------------------------------

def test_pack_round_trip_any_width():
    rng = np.random.default_rng(0)
    for width in (1, 3, 7, 8, 11, 16, 17, 31, 32):
        ids = rng.integers(0, 1 << width, 1001, dtype=np.uint64).astype(np.uint32)
        data = packing.pack(ids, width)
        assert len(data) == -(-1001 * width // 8)
        assert (packing.unpack(data, width, 0, 1001) == ids).all()
        assert (packing.unpack(data, width, 517, 83) == ids[517:600]).all()
    assert packing.bits_for(49_408) == 16 and packing.bits_for(1) == 1 and packing.bits_for(65_537) == 17


def test_token_file(spark, clash_docs, no_docs):
    lib = Tokenizer.from_file(PATH)
    path = work_dir(spark, "t-file")
    packing.write_token_file(clash_docs, path, PATH, block_ids=500, parts=4)
    got = sorted((r for r in packing.read_token_file(spark, path, with_ids=True).collect()), key=lambda r: r.start)
    ids = [r.id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(ROWS)
    expect = sorted((str(i), [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in ROWS)
    assert sorted((str(r.id), r.ids) for r in got) == expect
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    empty = work_dir(spark, "t-file")
    packing.write_token_file(no_docs, empty, PATH)
    assert packing.read_token_file(spark, empty).count() == 0


# ---- 6 decontamination ---------------------------------------------------------------

ITEMS = [(1, SENTENCE), (2, "warm and dry summer"), (3, None), (4, ""), (4, "one two"), (None, "x"), (5, "no such words anywhere in there"),
         (6, "word1 tail1 word2 tail4 word3 tail9 word4 tail16 word5 tail25 word6"), (6, "tail25 word6")]


def test_contamination(spark, clash_docs, no_docs):
    bench = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id long, text string, n long")
    data = [*ROWS, (20, "Prefix " + " ".join(SENTENCE.split()[3:12]) + " stop", "en", "z", 1),
            (21, "...THE-quick_brown;fox went over the hill and came+back", "en", "z", 1), (22, "dry summer warm and", "en", "z", 1)]
    docs = spark.createDataFrame(data, clash_docs.schema["doc_id"].name + " long, text string, lang string, source string, n_chars long")
    expect = sorted((repr(i), *brute.contamination(t, ITEMS)[:3]) for i, t, *_ in data)
    for kw in ({}, {"block_words": 100}, {"query_words": 30, "block_words": 700}):
        got = decontaminate.contamination(docs, bench, **kw)
        assert sorted((repr(r.id), r.n_words, r.n_hit, len(r.items)) for r in got.collect()) == expect
    near = {r.id: set(r.near_items) for r in got.collect()}
    assert 2 in near[22] and 2 not in {r.id: set(r.items) for r in got.collect()}[22]
    split = spark.createDataFrame([(1, "so warm and"), (2, "dry summer x"), (3, "and dry so warm it was a summer")], "doc_id long, text string")
    near = {r.id: (r.n_hit, set(r.near_items)) for r in decontaminate.contamination(split, bench).collect()}
    assert near == {1: (0, set()), 2: (1, {None}), 3: (0, {2})}      # never across documents
    clean = decontaminate.clean_documents(clash_docs, bench)
    bad = {repr((i, t)) for i, t, *_ in ROWS if brute.contamination(t, ITEMS)[4]}
    assert rows(clean, "doc_id", "text") == sorted(((i, t) for i, t, *_ in ROWS if repr((i, t)) not in bad), key=repr)
    assert clean.columns == clash_docs.columns
    assert decontaminate.contamination(no_docs, bench).count() == 0
    none = decontaminate.contamination(clash_docs, bench.limit(0)).collect()
    assert len(none) == len(ROWS) and not any(r.n_hit for r in none)


# ---- 7 SimHash -----------------------------------------------------------------------

def test_simhash_components(spark, clash_docs, no_docs):
    expect = Counter()
    fps = [brute.fingerprint(t) for _, t, *_ in ROWS]
    for (i, *_), f, c in zip(ROWS, fps, brute.components([r[0] for r in ROWS], fps)):
        expect[(i, f"{f:016x}", c)] += 1
    got = simhash.near_duplicates(clash_docs).select("id", simhash.fingerprint_hex(F.col("fp")), "component_id")
    assert Counter(tuple(r) for r in got.collect()) == expect
    kept = simhash.keep_one(clash_docs)
    assert kept.columns == clash_docs.columns
    groups = len(set(brute.components(list(range(len(fps))), fps)))
    assert kept.count() == groups
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("radius,chunk", [(3, 2048), (3, 5), (1, 4), (6, 7)])
def test_bit_sliced_links_match_brute_force(spark, radius, chunk):
    rng = random.Random(radius * chunk)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:25]:                       # balls, chains and near misses around some
        for _ in range(8):
            for _ in range(rng.randrange(1, radius + 3)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [tuple(r) for r in simhash.fingerprint_links(df, radius, chunk).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= radius * len(fps) for a, b in edges)
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[find(a)] = find(b)
    want = brute.components(list(range(len(signed))), [f & mask for f in signed], radius)
    low = {}
    for k, f in enumerate(signed):
        low.setdefault(find(f), k)
    assert [low[find(f)] for f in signed] == want


# ---- 8 HTML --------------------------------------------------------------------------

def test_main_text():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> </p>") == ""
    page_ = ('<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</li></ul></nav>'
             '<div class="cookie-notice">We use cookies, sorry.</div><article><h1>Head &amp; line</h1><p>One  <b>two</b>\nthree&nbsp;four.'
             '<p>Short.<br>Next<script>var x = "</p>";</script></p><form>Mail<input></form><div class="comments"><p>Nice!</p></div>'
             '</article><aside>Also, read this.</aside><footer>2024</footer></body></html>')
    assert html.main_text(page_) == "Head & line\nOne two three four.\nShort. Next"
    plain = ('<body><div id="menu">a b c</div><div id="main"><h2>T</h2><p>First one, with words.</p><p>Second; more words.</p></div>'
             '<div class="sidebar">side, text, here.</div></body>')
    assert html.main_text(plain) == "T\nFirst one, with words.\nSecond; more words."


def test_marks_leave_wrappers_of_the_content():
    article = "<article><h1>Head</h1><p>One, two. Three.</p></article>"
    want = "Head\nOne, two. Three."
    side = '<div class="sidebar">side, text, here.</div>'
    for start, stop in (('<div style="overflow:hidden">', "</div>"), ('<div style="overflow-x: hidden">', "</div>"),
                        ('<div class="has-sidebar">', "</div>"), ('<div class="no-sidebar">', "</div>"),
                        ('<div id="page-menu-open">', "</div>"), ('<form action="/x">', "</form>"),
                        ('<form><div class="menu-open">', "</div></form>")):
        page_ = f"<body>{start}{article}{side}{stop}<footer>2024, all of it.</footer></body>"
        assert html.main_text(page_) == want, start
        plain = f"<body>{start}<p>{'One, two. ' * 9}</p>{stop}{side}<footer>2024</footer></body>"
        assert html.main_text(plain) == ("One, two. " * 9).strip(), start
    for hidden in ("display:none", "color:red; visibility : hidden"):
        assert html.main_text(f'<body><div style="{hidden}">No, not this.</div>{article}</body>') == want
    assert html.main_text(f"<html><head><title>t</title><body><p>Yes, this.</p>{side}</body>") == "Yes, this."
    svg = '<svg width="1" height="2"/>'
    assert html.main_text(f"<body>{svg}{article}<math/>{side}<svg><text>x</text></svg></body>") == want
    # what is marked rightly stays outside, also with an article inside or longer than the article
    comments = '<div class="comments"><article class="comment-body"><p>' + "Nice, and good. " * 40 + "</p></article></div>"
    related = '<div class="related"><article><p>Read, also.</p></article></div>'
    assert html.main_text(f"<body>{article}{comments}{related}</body>") == want


def test_blocks_are_chosen_by_their_paths():
    long = "Words, and more words; a sentence that ends. " * 4
    p = f"<p>{long}</p>"
    text = long.strip()
    links = "<ul>" + '<li><a href="/x">Some other page</a></li>' * 6 + "</ul>"
    # articles under different tag paths, each with a list at its end
    two = (f"<body><div><article><h1>A</h1>{p}<ul><li>one</li></ul></article></div>{links}"
           f"<section><div><article><h1>B</h1><p>Short, but whole.</p></article></div></section></body>")
    assert html.main_text(two) == f"A\n{text}\none\nB\nShort, but whole."
    # no article: unmarked link lists and short pieces around the content are below the threshold
    plain = (f"<body><div>{links}</div><div><h1>T</h1><div>By someone</div>{p}<h2>S</h2><ul><li>one</li><li>two</li></ul>{p}</div>"
             f"<div><h3>More</h3>{links}</div><div><span>Imprint</span></div></body>")
    assert html.main_text(plain) == f"T\nBy someone\n{text}\nS\none\ntwo\n{text}"
    # text above the threshold outside the article, and a link list inside main
    mixed = f"<body><main><article>{p}</article><div>{links}</div></main><div>{p}</div></body>"
    assert html.main_text(mixed) == f"{text}\n{text}".replace("\n", "\n" + "Some other page\n" * 0)
    assert html.main_text("<article><h1>Only a head</h1></article>") == "Only a head"
    assert html.main_text('<p><a href="/x">Only, a link.</a></p>') == "Only, a link."
    assert html.main_text(f"<body><div>{p}</div><h3>Foot</h3></body>") == text
    # one very long block does not push the others below
    assert html.main_text(f"<body><pre>{long * 500}</pre><div>{p}</div></body>").endswith("\n" + text)


def test_extract_text(spark):
    data = [(1, "u", "<article><p>" + "a, b. " * 50_000 + "</p></article>"), (2, None, None), (2, None, None), (None, "v", ""),
            (3, "w", "<!-- only a comment"), (4, "w", "<script>never closed <p>x</p>"), (5, "w", "a < b & c > d"), (6, "w", "<p>x<p>y")]
    df = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, text string")
    got = {(r.id, r.url): r for r in html.extract_text(df, keep=("url",)).collect()}
    assert got[(1, "u")].n_chars == len(got[(1, "u")].text) == 50_000 * 6 - 1
    assert {got[k].text for k in ((2, None), (None, "v"), (3, "w"), (4, "w"))} == {""}
    assert got[(5, "w")].text == "a < b & c > d" and got[(6, "w")].text == "x\ny"
    assert html.extract_text(df.limit(0)).count() == 0


# ---- 9 quality -----------------------------------------------------------------------

def test_quality(spark, clash_docs, no_docs):
    got = quality.quality_report(clash_docs).collect()
    assert sorted(repr((r.id, *tuple(r)[1:6])) for r in got) == sorted(repr((i, *brute.quality(t))) for i, t, *_ in ROWS)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert sorted(repr(r.id) for r in got if r.kept) == sorted(repr(i) for i, t, *_ in ROWS if not brute.quality_rejects(t))
    kept = quality.passes(clash_docs)
    assert kept.columns == clash_docs.columns
    assert rows(kept, "doc_id") == sorted(((i,) for i, t, *_ in ROWS if not brute.quality_rejects(t)), key=repr)
    assert quality.quality_report(no_docs).count() == 0 and quality.passes(no_docs).count() == 0


def test_cascade_order_does_not_change_the_verdict(spark, edge_docs):
    est = quality.estimate(edge_docs)
    assert {e["rule"] for e in est} == {r.name for r in quality.RULES}
    want = [r[0] for r in rows(quality.passes(edge_docs), "doc_id")]
    for order in (quality.RULES, quality.RULES[::-1]):
        ok = edge_docs.where(quality.first_failure(quality.Text(F.coalesce("text", F.lit(""))), order).isNull())
        assert [r[0] for r in rows(ok, "doc_id")] == want
    ranked = quality.order(quality.RULES, [{"rule": r.name, "rejected": k, "seconds": 1.0} for k, r in enumerate(quality.RULES)])
    assert [r.name for r in ranked] == [r.name for r in quality.RULES[::-1]]


# ---- 10 language ---------------------------------------------------------------------

def test_language(spark, clash_docs, no_docs):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    got = langid.predict_language(docs, ~langid.held_out(F.col("doc_id"))).join(docs, F.col("id") == F.col("doc_id")).collect()
    held = [r for r in got if brute.crc_mod(r.doc_id, 4) == 2]
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    edge = langid.predict_language(clash_docs, F.lit(True)).collect()
    assert len(edge) == len(ROWS)
    silent = sum(t is None or not any(c.isalpha() for c in t) for _, t, *_ in ROWS)
    assert sum(r.lang_pred == "und" and r.score == 0 and r.rejected for r in edge) == silent
    assert {r.lang_pred for r in edge} <= {"en", "de", "fr", "es", "und"}
    assert langid.predict_language(no_docs, F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.predict_language(clash_docs, F.lit(False)).collect()} == {"und"}
