import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
from tests.llm.frames import DOCUMENTS, awkward_rows, clashing, documents, labels
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm.common import crc_fold, shingle_set
from medallion.llm.fingerprints import edited_fingerprints, merged, resemblance, with_sketch
from medallion.llm.html_text import Evidence, kept_text, main_texts, page_blocks, run_pages
from medallion.llm import mixing
from medallion.llm.mixing import hypergeometric, mix, mixed_documents, source_targets, splitting_tree
from medallion.llm.packing import SumOfSquares, pack
from medallion.llm.quality import quality_scores
from medallion.llm.secret_scan import log_ratios, random_spans, secret_scan, transition_counts
from medallion.llm.toxicity import toxicity_scores


def test_edited_fingerprints(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = {r.doc_id: r for r in edited_fingerprints(clashing(documents(spark, rows))).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint == got[i].edited_fingerprint) <= (got[i].near_edited == 1)
        if len(text.split()) < 100 and len(edited.split()) < 100:  # all hashes are in the sketch

            def cut(t):
                w = re.findall(r"[^\x20\x09-\x0D]+", t)
                return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()

            a, b = cut(text), cut(edited)
            if len(a | b) <= 128:
                assert got[i].near_edited == (len(a & b) / len(a | b) if a | b else 1)
    assert got[0].fingerprint == got[60].fingerprint and got[81].fingerprint == ""


def test_next_of_repeated_null_and_single_rows(spark):
    rows = [(None, "n", "", "", 1), (1, "abcd", "", "", 4), (1, "abcd", "", "", 4)]
    got = edited_fingerprints(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 4), (1, 4)]
    one = edited_fingerprints(documents(spark, [(5, "wxyz", "", "", 4)])).first()
    assert one.edited_sha256 == hashlib.sha256(b"wxwx").hexdigest() and one.near_next == 1
    assert edited_fingerprints(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_sketches_of_parts_merge_and_estimate(spark):
    a = " ".join(f"a{k}" for k in range(3000))
    b = " ".join(f"a{k}" for k in range(1500, 4500))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = with_sketch(with_sketch(df, "a", "sa"), "b", "sb")
    r = df.select(resemblance(F.col("sa"), F.col("sb")).alias("r"), F.size(merged(F.col("sa"), F.col("sb"))).alias("n")).first()
    assert abs(r.r - 1 / 3) < 0.15 and r.n == 128


def test_secret_scan(spark):
    text = 'é password = "hunter22" token=ab\nAKIA' + "A1B2" * 4 + " " + "deadbeef" * 3 + " API-KEY api_key:'x.y/z=+1' AKIAX"
    rows = [(1, text, "", "", 0), (2, None, "", "", 0), (3, "", "", "", 0), (4, "plain words only", "", "", 0)]
    rows += [(9, text, "", "", 0)]
    got = {r.doc_id: r for r in secret_scan(clashing(documents(spark, rows))).collect()}
    spans = [("assign", m.start(), m.end()) for m in re.finditer(r'password = "hunter22', text)]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA(A1B2){4}", text)]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"(deadbeef){3}", text)]
    spans += [("assign", m.start(), m.end()) for m in re.finditer(r"api_key:'x\.y/z=\+1", text)]
    written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (2, 1, 1)
    assert got[1].base_sha256 == hashlib.sha256(written.encode()).hexdigest() and got[1].spans == got[9].spans
    assert set(written.split(",")) <= set(got[1].spans.split(","))
    for k in (2, 3, 4):
        assert got[k].spans == "" and got[k].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_scan(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_markov_models_find_random_strings_only(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    secret = ["".join(rng.choice(letters, 32)) for _ in range(200)]
    name = "get_user_account_name_from_request"
    rows = [(k, f"token={secret[k]} {name} and plain identifiers like make_connection_pool {k}", "", "", 0) for k in range(199)]
    rows.append((500, f"first {secret[199]} then internationalization_of_documents", "", "", 0))
    got = {r.doc_id: r for r in secret_scan(documents(spark, rows)).collect()}
    assert got[500].spans == "random:6:38" and all(got[k].n_random == 0 for k in range(199))


def test_markov_models_learn_from_rare_samples(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    secret = ["".join(rng.choice(letters, 32)) for _ in range(61)]
    rows = [(k, f"plain identifiers like make_connection_pool_{k % 9}", "", "", 0) for k in range(40_000)]
    rows[7::670] = [(r[0], f"token={secret[n]} {r[1]}", "", "", 0) for n, r in enumerate(rows[7::670])]
    rows.append((500_000, f"first {secret[60]} then internationalization_of_documents", "", "", 0))
    counts = transition_counts(spark.createDataFrame(rows, DOCUMENTS)).toPandas()
    assert counts.loc[counts["kind"] == 1, "n"].sum() == 60 * 32
    ratios = log_ratios(counts)
    assert random_spans(rows[-1][1], [], ratios) == [(6, 3, 38, 6)]


def test_packing_places_every_id_once(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = awkward_rows()
    got = pack(clashing(documents(spark)), path).toPandas()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(whole.encode(t or "", add_special_tokens=False).ids + [1])
    single = {i: ids[0] for i, ids in texts.items() if len(ids) == 1}
    for i, part in got[got["doc_id"].isin(list(single))].groupby("doc_id"):
        part, at = part.sort_values("start"), 0
        for r in part.itertuples():
            ids = np.array(single[i][r.start : r.start + r.length], "<u4")
            assert r.start == at and len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(single[i]) == part["doc_tokens"].iloc[0]
    assert got["length"].sum() == sum(len(x) for ids in texts.values() for x in ids)
    for _, window in got.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert (window["offset"].to_numpy() == window["length"].cumsum().shift(fill_value=0).to_numpy()).all()
        assert window["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) * 1.02 + 3
    assert pack(spark.createDataFrame([], DOCUMENTS), path).count() == 0


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(2)
    levels = SumOfSquares(24)
    for _ in range(400):
        length = int(rng.integers(1, 24))
        costs = {}
        for h in range(0, 25 - length):
            if h == 0 or levels.count[h]:
                n = levels.count.copy()
                if h:
                    n[h] -= 1
                if h + length < 24:
                    n[h + length] += 1
                costs[h] = int((n**2).sum())
        h = levels.level_for(length)
        assert costs[h] == min(costs.values())
        levels.move(h, length)


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[o] for o in open_) for s in open_}
        more = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in capped else share[s] for s in order}
        capped |= more


def test_targets_stop_at_three_times_a_source(spark):
    for sizes in ({"a": 10, "b": 900, "c": 90, None: 400, "d": 0}, {"x": 5}, {"p": 1, "q": 1, "r": 1000, "s": 7}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_mix_comes_near_targets(spark):
    rows = awkward_rows()
    got = mix(clashing(documents(spark)), block_words=500, shards=8).toPandas()
    assert len(got) == len(rows)
    got["taken"] = got["size"] * got["shards"].map(len)
    assert got["shards"].map(len).max() <= 3
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(sizes)
    for s, part in got.groupby(got["source"].where(got["source"].notna(), None).map(lambda x: x or "-")):
        s = None if s == "-" else s
        assert part["source_size"].iloc[0] == sizes[s] and abs(part["target"].iloc[0] - want[s]) < 1e-6
        if sizes[s] < 19_000:  # without the long text, which is a third of everything
            assert abs(part["taken"].sum() - want[s]) <= 60
    again = mix(documents(spark), block_words=500, shards=8).toPandas()
    assert sorted(map(str, again["shards"])) == sorted(map(str, got["shards"]))
    assert mix(spark.createDataFrame([], DOCUMENTS)).count() == 0
    copies = mixed_documents(documents(spark), block_words=500, shards=8)
    assert copies.columns == documents(spark).columns and copies.count() == got["shards"].map(len).sum()


def test_splitting_tree_deals_exact_quotas(spark):
    quotas = spark.createDataFrame([(1, 100), (2, 7), (3, 0), (4, 41)], "source_no int, quota long")
    got = splitting_tree(quotas, 8).toPandas()
    assert got.groupby("source_no")["quota"].sum().to_dict() == {1: 100, 2: 7, 3: 0, 4: 41}
    per_shard = got.groupby("shard")["quota"].sum()
    assert len(per_shard) == 8 and per_shard.max() - per_shard.min() <= 1


def labelled(n=600):
    good = "the quick brown fox jumps over a lazy dog while rain falls on green hills"
    rows, marks = [], []
    for k in range(n):
        junk, rude = k % 4 == 0, k % 3 == 0
        words = ("*** $$$ " * 20 if junk else f"{good} number{k} ") * 2
        rows.append((k, words + ("you horrible nitwit" if rude else "you dear friend"), "en", "s", 0))
        marks.append((k, int(not junk), int(rude)))
    return rows, marks


def test_classifiers_learn_outside_the_held_out_fold(spark):
    rows, marks = labelled()
    rows += [(1000, None, "", "", 0), (1001, "", "", "", 0), (None, "no id", "", "", 0)]
    for f, at, folds, out in ((quality_scores, 1, 5, 0), (toxicity_scores, 2, 4, 2)):
        got = f(clashing(documents(spark, rows)), labels(spark, marks + [(3, None, None), (None, 1, 1)])).toPandas()
        assert len(got) == len(rows) and got["score"].between(0, 1).all()
        assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
        known = got[got["doc_id"] < 1000]
        assert (known["held_out"] == known["doc_id"].map(lambda i: crc_fold(int(i), folds) == out)).all()
        held = known[known["held_out"]]
        truth = held["doc_id"].map({m[0]: m[at] for m in marks})
        assert (held["predicted"] == truth).mean() > 0.97
        flipped = [(i, *(1 - x if crc_fold(i, folds) == out else x for x in m)) for i, *m in marks]
        again = f(documents(spark, rows), labels(spark, flipped)).toPandas()
        assert sorted(again["score"].round(9)) == sorted(got["score"].round(9))
        empty = f(documents(spark, rows), labels(spark, []))
        assert {r.score for r in empty.collect()} == {0.5}
        assert f(documents(spark, []), labels(spark, marks)).count() == 0


def test_shingles_of_short_and_cased_texts():
    assert shingle_set(None).size == 0 and shingle_set(" \n").size == 0 and shingle_set("a b").size == 1
    assert (shingle_set("A b C d E f") == shingle_set("a\tB c\nd e  F")).all()
    assert (shingle_set("É b c d e") != shingle_set("é b c d e")).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="page">
<header>Site name</header><nav><ul><li><a href="/x">Home</a><li>News</ul></nav><!-- <p>no</p> --><div class="ad-box">Buy</div>
<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld<br>two&nbsp;&#8211; <p>Three<aside>side</aside> four
<form><input value="a>b">name</form><section id="comments"><p>Reader says</section></article><footer>&copy; us</footer>"""


def test_pages_keep_the_article(spark):
    rows = [(1, "http://a.example/1", PAGE), (2, None, None), (3, "http://a.example/3", ""), (4, "x", "plain &lt;text")]
    df = spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string")
    got = {r.page_id: r for r in main_texts(df.withColumns({"text": F.lit(1), "host": F.lit(2)})).collect()}
    assert got[1].text == "Head & line One bold two – Three four" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[4].text == "plain <text" and got[2].url is None
    assert main_texts(df.limit(0)).count() == 0


def test_a_class_word_makes_no_whole_page_surrounding():
    kinds = {
        '<div class="content with-sidebar">t</div>': 1,
        '<div id="page" class="no-sidebar">t</div>': 1,
        '<article class="post has-comments">t</article>': 0,
        '<div class="search-result article">t</div>': 1,
        "<form id=f><div>t</div></form>": 1,
        "<form><main>t</main></form>": 0,
        '<div class="sidebar layout"><article>t</article></div>': 0,
        '<article class="share">t</article>': 0,
        '<div id="comments"><article class="comment">t</article></div>': 1,
        "<main><form><p>t</p></form></main>": 1,
        "<main><form>t</form></main>": 2,
        '<div class="sidebar">t</div>': 2,
        '<article><div class="share-links">t</div></article>': 2,
        '<div class="sidebar-content">t</div>': 2,
        "<nav><article>t</article></nav>": 2,
        '<div class="main-content">t</div>': 0,
    }
    assert {page: page_blocks(page) for page in kinds} == {page: [(kind, "t")] for page, kind in kinds.items()}


def test_open_text_loses_what_pages_of_a_host_share(spark):
    shared = "all rights reserved by the owners of this very fine site since long ago"
    rows = [(k, f"https://h.example/{k}", f"<body><div>Story {k} tells of unique{k}.</div><div>{shared}</div>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(df, Evidence(long=8)).collect()}
    assert got == {k: f"Story {k} tells of unique{k}." for k in range(9)}


def test_evidence_follows_the_host_and_removes_blocks(spark):
    notice, quote, copy, end = (" ".join(f"{w}{j}" for j in range(n)) for w, n in (("notice", 20), ("quote", 20), ("copied", 40), ("end", 17)))

    def page(k):
        said = f"{quote} " if k < 3 else ""
        inside = f"<p>{notice}</p><p>share this line now</p><p>{quote if k < 5 else k}</p><p>{'long story ' * 30}{k}</p><p>{end}</p>"
        return f"<article><p>{notice}</p><p>story {k} {said}tells of it</p>{inside}</article><div>open {k} {said}end</div><div>{notice}</div>"

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(60)]
    rows += [(k, f"http://h.example/{k}", f"<div>{copy}</div>") for k in range(60, 72)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {k: copy for k in range(60, 72)}
    for k in range(60):
        said = f"{quote} " if k < 3 else ""
        middle = f"{notice} share this line now {quote if k < 5 else k} {'long story ' * 30}{k}"
        want[k] = f"story {k} {said}tells of it {middle} open {k} {said}end"
    for group in (256, 7):
        assert {r.page_id: r.text for r in main_texts(df, group=group).collect()} == want


def test_copies_of_an_article_keep_it(spark):
    long = [" ".join(f"{w}{j}" for j in range(30)) for w in ("first", "second")]
    same = "".join(f"<p>{t}</p>" for t in long)
    rows = [(k, f"http://h.example/{k}", f"<article>{same}<p>Visited copy number {k}</p></article>") for k in range(12)]
    rows += [(k, f"http://h.example/{k}", f"<article><p>{' '.join(f'own{k}x{j}' for j in range(40))}</p></article>") for k in range(12, 40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(df).collect()}
    assert all(got[k] == f"{long[0]} {long[1]} Visited copy number {k}" for k in range(12))
    assert all(len(got[k].split()) == 40 for k in range(12, 40))


def test_only_edges_of_an_article_go():
    blocks = [(0, "a b"), (0, "c d e f g h"), (0, "i"), (1, "open"), (2, "menu"), (0, "k l")]
    assert kept_text(blocks, {0, 2, 5}, set(), 0.5) == "c d e f g h open"
    assert kept_text(blocks, {2, 0}, set(), 0.5) == "c d e f g h i open k l"
    assert kept_text(blocks, {0, 1}, set(), 0.5) == "a b c d e f g h i open k l"  # over half of it
    assert kept_text(blocks, {0, 1}, {3}, 1.0) == "i k l"
    assert kept_text([(1, "x"), (2, "y")], {0}, set(), 0.5) == "x" and kept_text([], set(), set(), 0.5) == ""


def brute_texts(rows, evidence):
    """The registered rule in plain Python: per host, blocks, begins, candidates, runs among them, cover."""
    found, long = [], evidence.long
    for page_id, url, text in rows:
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url or "")
        found.append((page_id, url, (host[1] if host else "").lower(), page_blocks(text)))
    out = []
    for host in {h for _, _, h, _ in found}:
        pages = [(i, u, b) for i, u, h, b in found if h == host]
        n = len(pages)
        few = max(evidence.open_pages, math.ceil(evidence.open_share * n))
        many = max(evidence.article_pages, math.ceil(evidence.article_share * n))
        tokens = [[[w.translate({c: c + 32 for c in range(65, 91)}) for w in t.split()] for _, t in b] for _, _, b in pages]
        begins = {}
        for p, (_, _, blocks) in enumerate(pages):
            for (kind, _), words in zip(blocks, tokens[p]):
                if len(words) >= (long if kind == 0 else 4):
                    begins.setdefault((len(words) < long, tuple(words[:long])), set()).add(p)
        runs, candidates = {}, set()
        for p, page in enumerate(tokens):
            for k, words in enumerate(page):
                if len(words) >= long and len(begins[False, tuple(words[:long])]) >= few:
                    candidates.add((p, k))
                    for at in range(len(words) - long + 1):
                        runs.setdefault(tuple(words[at : at + long]), set()).add(p)
        for p, (page_id, url, blocks) in enumerate(pages):
            marks = {few: set(), many: set()}
            strong = set()
            for least, into in ((few, marks[few]), (many, strong)):
                for k, words in enumerate(tokens[p]):
                    if (p, k) in candidates and blocks[k][0] != 2:
                        covered = set()
                        for at in range(len(words) - long + 1):
                            if len(runs[tuple(words[at : at + long])]) >= least:
                                covered |= set(range(at, at + long))
                        if len(covered) == len(words):
                            into.add(k)
            for k, words in enumerate(tokens[p]):
                if blocks[k][0] == 1 and 4 <= len(words) < long and len(begins[True, tuple(words)]) >= many:
                    strong.add(k)
            out.append((page_id, url, kept_text(blocks, strong, marks[few], evidence.most)))
    return out


def test_texts_equal_brute_force_over_parts(spark):
    rng = random.Random(4)
    phrases = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(3, 14))) for _ in range(25)]

    def page(k):
        def some(n, tags):
            return "".join(f"<{t}>{rng.choice(phrases)}</{t}>" for t in rng.choices(tags, k=n))

        own = f"<p>only{k} here and {' '.join(f'own{k}x{j}' for j in range(rng.randrange(30)))}</p>"
        return f"<article>{some(rng.randrange(3), ['p'])}{own}{some(rng.randrange(3), ['p'])}</article>{some(2, ['div', 'div', 'nav'])}"

    rows = [(k, f"http://{'big' if k % 3 else 'Other'}.example/{k}", page(k)) for k in range(70)]
    rows += [(71, None, page(71)), (72, None, page(72)), (73, "", None), (74, "http://big.example/", ""), (None, None, page(5))]
    rows += [rows[4]] * 3 + [(75, "http://big.example/x", rows[7][2].upper())]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumns({n: F.lit("extra") for n in ("host", "k1", "place", "kind", "h", "strong", "some", "text", "page")})
    for evidence in (Evidence(4, 2, 0.0, 3, 0.0, 0.7), Evidence(6, 3, 0.05, 4, 0.2, 0.5)):
        want = sorted(map(str, brute_texts(rows, evidence)))
        for group in (256, 9) if evidence.long == 4 else (1,):
            got = main_texts(df, evidence, group).collect()
            assert sorted(str((r.page_id, r.url, r.text)) for r in got) == want
            assert all(r.n_chars == len(r.text) for r in got)


def test_very_long_and_no_pages(spark):
    body = " ".join(f"word{k}" for k in range(120_000))
    rows = [(1, "http://h.example/1", f"<article><p>{body}</p></article>")] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r.n_chars for r in main_texts(df).collect()] == [len(body)] * 3
    assert main_texts(df.limit(0)).count() == 0


def test_run_pages_equal_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(60):
        tokens = rng.integers(0, 3, 60)
        blocks = np.sort(rng.integers(0, 9, 60))
        pages = blocks // 2
        for long in (2, 3, 5, 8):
            runs = {}
            for i in range(60 - long + 1):
                if blocks[i] == blocks[i + long - 1]:
                    runs.setdefault(tuple(tokens[i : i + long]), []).append(i)
            want = np.zeros(60, int)
            for at in runs.values():
                want[at] = len({pages[i] for i in at})
            assert (run_pages(tokens, pages, long, blocks) == want).all()


def test_broken_markup_doesnt_stop_a_page():
    for page in ("<", "<p", "<p class='a", "</x></y>", "<script>never ends", "a<b", "<!-- open", "&am &#x110000; &", "<div" * 5000):
        page_blocks(page)


def test_draws_follow_the_hypergeometric_law(spark):
    keys = spark.range(4000)
    for total, marked, drawn in ((100, 30, 50), (100, 80, 50), (100, 30, 90), (100, 95, 97), (10**9, 4 * 10**8, 5 * 10**8), (5, 0, 3), (5, 5, 2), (0, 0, 0), (7, 3, 0)):
        args = [F.lit(x).cast("long") for x in (total, marked, drawn)]
        got = keys.select(hypergeometric(*args, [F.col("id")]).alias("x")).toPandas()["x"].to_numpy()
        assert got.min() >= max(0, drawn - (total - marked)) and got.max() <= min(marked, drawn)
        share = marked / max(total, 1)
        spread = math.sqrt(drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1))
        assert abs(got.mean() - drawn * share) <= 5 * spread / math.sqrt(4000) + 1e-9
        assert spread == 0 or 0.9 < got.std() / spread < 1.1
    got = keys.select(hypergeometric(*(F.lit(x).cast("long") for x in (6, 3, 2)), [F.col("id")]).alias("x"))
    shares = {r.x: r["count"] / 4000 for r in got.groupBy("x").count().collect()}
    assert all(abs(shares[x] - p) < 0.04 for x, p in {0: 0.2, 1: 0.6, 2: 0.2}.items())


def test_equal_rows_are_taken_one_by_one(spark):
    rows = [(1, "ten words " * 5, "en", "a", 0)] * 100 + [(2 + k, "one " * 10, "en", "b", 0) for k in range(100)]
    got = mix(documents(spark, rows)).toPandas()
    assert len(got) == 200
    for source, part in got.groupby("source"):
        assert abs((part["size"] * part["shards"].map(len)).sum() - part["target"].iloc[0]) < 10, source


def test_a_mix_lies_by_shard_in_the_order_of_places(spark):
    rows = [(k, f"text {k} of some words", "en", "ab"[k % 2], 0) for k in range(300)]
    df = documents(spark, rows)
    placed = {}
    for r in mix(df, block_words=50, shards=8).collect():
        placed[r.doc_id] = list(zip(r.shards, r.places))
    shards = {}
    for doc_id, copies in placed.items():
        for shard, place in copies:
            shards.setdefault(shard, []).append((place, doc_id))
    copies = mixed_documents(df, block_words=50, shards=8).withColumn("task", F.spark_partition_id())
    lines = {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for r in copies.collect():
            lines.setdefault(r.task, []).append(r.doc_id)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    met = []
    for ids in lines.values():
        for shard in sorted(shards):
            line = [doc_id for _, doc_id in sorted(shards[shard])]
            if ids[: len(line)] == line:
                met.append(shard)
                ids = ids[len(line) :]
        assert not ids
    assert sorted(met) == sorted(shards) and len(lines) > 1


def test_blocks_and_shards_follow_the_corpus(spark, monkeypatch):
    rows = [(k, f"w{k} x y z", "en", "ab"[k % 2], 0) for k in range(400)]
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 8)
    got = mix(documents(spark, rows), block_words=2).toPandas()
    assert max(s for shards in got["shards"] for s in shards) >= 64  # beyond the least number of shards
    for _, part in got.groupby("source"):
        assert abs((part["size"] * part["shards"].map(len)).sum() - part["target"].iloc[0]) <= 4
