import random

import numpy as np
import pytest
from tests.llm.frames import DOCUMENTS, awkward_rows, clashing, documents, sentence

from medallion.llm import jaccard_join
from medallion.llm.common import by_marks, components, shingle_set
from medallion.llm.jaccard_join import jaccard_components, one_of_each, parities, possible_links, region_links
from medallion.llm.line_dedup import line_report, near_kept, within, without_repeated_lines
from medallion.llm.topk_search import ImpactIndex, quantised, top_k

BLANKS = " \t\n\x0b\x0c\r"


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in BLANKS:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, s in sets:
        for b, t in sets:
            shared = len(s & t)
            if shared and 100 * shared >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("block", [400, 2])
@pytest.mark.parametrize("change", [lambda df: df, clashing])
def test_components_equal_brute_force(spark, block, change):
    rows = awkward_rows()
    got = jaccard_components(change(documents(spark)), block=block).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {
        (i, *v) for i, v in want.items()
    }
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_one_of_each_keeps_the_smallest_id_once(spark):
    kept = one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    want = {c for _, c in brute_components(awkward_rows()).values()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    for f in (jaccard_components, one_of_each, line_report, without_repeated_lines):
        assert f(none).count() == 0


def test_region_links_join_what_brute_force_joins():
    rng = np.random.default_rng(3)
    for _ in range(40):
        base = np.unique(rng.integers(0, 60, 40))
        sets = [np.unique(np.where(rng.random(base.size) < 0.12, rng.integers(0, 90, base.size), base)) for _ in range(12)]
        root = list(range(12))
        linked = [
            (i, j) for i in range(12) for j in range(i) if 100 * np.intersect1d(sets[i], sets[j]).size >= 75 * np.union1d(sets[i], sets[j]).size
        ]
        near = [100 * np.intersect1d(sets[0], s).size >= 75 * np.union1d(sets[0], s).size for s in sets]
        got = region_links([s.astype(np.int64) for s in sets], np.where(near, 0, np.arange(12)))
        for pairs, out in ((linked, []), (got + [(0, k) for k in range(12) if near[k]], [])):
            root = list(range(12))
            for a, b in pairs * 12:
                root[a] = root[b] = min(root[a], root[b])
            out += root
            if pairs is linked:
                want = out
        assert out == want


def test_parities_lose_no_link():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(-(2**62), 2**62, n)) for n in (3, 70, 200, 64, 65)]
    sets += [np.unique(np.concatenate([s[: int(s.size * 0.9)], rng.integers(-(2**62), 2**62, 2)])) for s in sets]
    i, j = possible_links(np.array([s.size for s in sets]), [parities(s) for s in sets], 75)
    possible = {frozenset(p) for p in zip(i.tolist(), j.tolist())}
    for a in range(len(sets)):
        for b in range(a):
            if 100 * np.intersect1d(sets[a], sets[b]).size >= 75 * np.union1d(sets[a], sets[b]).size:
                assert frozenset((a, b)) in possible


def stored_rows(monkeypatch):
    """Rows of the working tables that the join stores, by label."""
    rows, write = {}, jaccard_join.stored

    def counting(df, label):
        out = write(df, label)
        rows[label] = rows.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", counting)
    return rows


def test_documents_that_share_spans_of_common_words_only_meet_in_no_region(spark, monkeypatch):
    rng = random.Random(7)
    common = [f"w{k}" for k in range(30)]
    spans = [" ".join(rng.choice(common) for _ in range(6)) for _ in range(40)]
    unlike = [" ".join([*(f"d{k}x{j}" for j in range(60)), *rng.sample(spans, 2)]) for k in range(120)]
    near = [unlike[0] + " more", unlike[1].replace("d1x30", "changed")]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(unlike + near)]
    stored = stored_rows(monkeypatch)
    got = jaccard_components(documents(spark, rows)).where("doc_id <> component_id").collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(120, 0), (121, 1)}
    assert stored["members"] == 2


def test_rows_are_told_from_keys_by_marks(spark):
    rows = spark.range(5000).selectExpr("if(id % 7 = 0, null, int(id)) as id", "'t' as _mark")
    among, others = by_marks(rows, "id", spark.range(0, 5000, 9).withColumnRenamed("id", "key"), "key")
    a, b = [r.id for r in among.collect()], [r.id for r in others.collect()]
    assert among.columns == others.columns == rows.columns and len(a) + len(b) == 5000
    assert {k for k in range(0, 5000, 9) if k % 7} <= set(a) and None not in a and len(a) < 1000
    none, every = by_marks(rows, "id", rows.where("false"), "id")
    assert none.isEmpty() and every.count() == 5000


@pytest.mark.parametrize("again", [False, True])
def test_texts_of_ids_that_stay_are_not_joined(spark, again):
    rng = random.Random(9)
    rows = [(k, sentence(rng, 12), "en", "s", 0) for k in range(40)]
    rows += [(50, rows[3][1], "en", "s", 0), (51, None, "en", "s", 0), (None, "no id", "en", "s", 0)] + rows[:1] * again
    kept = one_of_each(documents(spark, rows))
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted([-1, *range(40), 51])
    plan = kept._jdf.queryExecution().optimizedPlan()
    first, last = plan.children().head().toString(), plan.children().last().toString()
    assert plan.nodeName() == "Union" and "LeftSemi" in last and "LeftSemi" not in first
    assert not any("Aggregate" in line and "text#" in line for line in first.splitlines())


def test_long_texts_hash_alike_in_pieces():
    text = " ".join(f"w{k}" for k in range(400_000))
    assert shingle_set(text).size == 400_000 - 4


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1002), (7000, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(201)} == {0} and {got[k] for k in (1000, 1001, 1002)} == {1000}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_within_equals_levenshtein():
    rng = random.Random(2)
    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in "xy")
        for most in (1, 2, 3):
            assert within(a, b, most) == (levenshtein(a, b) <= most)


def edited_lines(seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(7, 30))) for _ in range(30)]

    def edit(line):
        chars = list(line)
        for _ in range(rng.randrange(4)):
            k, o = rng.randrange(len(chars) + 1), rng.random()
            if o < 0.4:
                chars.insert(k, rng.choice("abcé"))
            elif k < len(chars):
                chars[k : k + 1] = [rng.choice("abcé")] if o < 0.7 else []
        return "".join(chars)

    rows = [(k, "\n".join(edit(rng.choice(base)) for _ in range(rng.randrange(6)))) for k in range(150)]
    return [(i, t, "en", "s", len(t)) for i, t in rows] + [(150, None, None, None, None), (None, base[0] * 2, "en", None, 1)]


def test_lines_equal_brute_force(spark):
    rows = edited_lines()
    seen, want = [], {}
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want[i] = []
        for k, line in enumerate((t or "").split("\n")):
            if len(line) >= 8:
                if not any(levenshtein(line, s) <= 2 for s in seen if abs(len(s) - len(line)) <= 2):
                    want[i].append(k)
                seen.append(line)
    got = line_report(clashing(documents(spark, rows)).drop("n_lines")).collect()
    assert {r.doc_id: list(r.kept) for r in got} == want
    texts = {r.doc_id: r for r in without_repeated_lines(documents(spark, rows)).collect()}
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        left = [x for k, x in enumerate(lines) if len(x) < 8 or k in want[i]]
        if t is None or want[i] or not any(len(x) >= 8 for x in lines):
            assert texts[i].text == (None if t is None else "\n".join(left))
            assert t is None or texts[i].n_chars == len(texts[i].text)
        else:
            assert i not in texts


@pytest.mark.parametrize("per", [6, 20])
def test_lines_by_length_equal_brute_force(spark, per):
    rows = edited_lines() + [(151, "\n \nTable 11\nTable 27\n\nTable 11", "en", "s", 1), (152, "x\nx\u3000\n\u3000\nx", "en", "s", 1)]
    kept, want = [], {}
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want[i] = []
        for k, line in enumerate((t or "").split("\n")):
            near = [s for s in kept if abs(len(s) - len(line)) <= 2]
            if line.strip() and not any(levenshtein(line, s) <= min(2, min(len(line), len(s)) // per) for s in near):
                want[i].append(k)
                kept.append(line)
    got = line_report(documents(spark, rows), least=1, per=per).collect()
    assert {r.doc_id: list(r.kept) for r in got} == want and want[151] == [2, 3]
    texts = {r.doc_id: r.text for r in without_repeated_lines(documents(spark, rows), least=1, short_count=True, per=per).collect()}
    for i, t, *_ in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if not x.strip() or k in want[i]]
        assert texts.get(i) == ("\n".join(left) if t is not None and (want[i] or not t.strip()) else None)


def test_chains_are_decided_in_order_in_rounds_and_in_one_task(spark):
    rng = random.Random(4)
    edges = {(k, k - 1) for k in range(1, 12)} | {tuple(sorted(rng.sample(range(40), 2), reverse=True)) for _ in range(60)}
    gone = set()
    for k in range(40):
        if any((k, j) in edges and j not in gone for j in range(k)):
            gone.add(k)
    pairs = spark.createDataFrame([(a, (a,), b) for a, b in edges], "line long, place struct<doc_id long>, earlier long")
    for one_task in (0, 20, 1000):
        assert sorted(r.line for r in near_kept(pairs, one_task).collect()) == sorted(gone)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(k, [rng.choice([-0.5, -0.1, 0.0, 0.2, 0.5]) for _ in range(6)]) for k in range(90)]
    rows += [(90, None), (91, [None, 1.0, 0.0, 0.0, 0.0, 0.0]), (92, [float("nan")] * 6), (93, [float("inf")] + [0.0] * 5)]
    rows += [(94, [1.0]), (95, []), (None, [0.1] * 6), (4, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = quantised(df)
    got = [tuple(r) for r in top_k(v, v.where("vec_id % 20 = 0"), 5).orderBy("query_id", "rank").collect()]
    ints = {}
    ok = [(i, x) for i, x in rows if i is not None and x is not None and all(c is not None and abs(c) < 9 for c in x)]
    ints = [(i, [int(np.floor(64 * np.float64(np.float32(c)))) for c in x]) for i, x in ok]
    want = []
    for q, x in sorted((i, x) for i, x in ints if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ints if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == want
    assert top_k(v.limit(0), v.limit(0)).count() == 0


def test_copies_of_a_query_leave_its_rivals_their_places():
    vectors = np.array([[100, 0]] * 40 + [[k, 1] for k in range(60)])
    ids = np.array([7] * 40 + list(range(100, 160)))
    (got, scores), = ImpactIndex(ids, vectors).search(np.array([[100, 0]]), np.array([7]), 5)
    assert got.tolist() == [159, 158, 157, 156, 155] and scores.tolist() == [5900, 5800, 5700, 5600, 5500]


def test_index_stops_early_only_with_proof():
    rng = np.random.default_rng(1)
    vectors = np.floor(64 * rng.normal(0, 0.2, (3000, 16))).astype(np.int64)
    vectors[:30] *= 4
    index = ImpactIndex(np.arange(3000), vectors)
    for q, (ids, scores) in enumerate(index.search(vectors[:20], np.arange(20), 20)):
        exact = vectors @ vectors[q]
        exact[q] = -(10**12)
        want = np.lexsort((np.arange(3000), -exact))[:20]
        assert (ids == want).all() and (scores == exact[want]).all()


def test_large_finite_components_stay(spark):
    rows = [(0, [1e15, 1.0]), (20, [-1e15, 3.0]), (1, [2.0, 2.0]), (2, [1e-3, 5.0]), (3, [2.0**56, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = quantised(df)
    assert v.count() == len(rows)
    ints = {i: [int(np.floor(64 * c)) for c in x] for i, x in rows}
    small = v.where("vec_id <> 3")
    with pytest.raises(Exception, match="int64|too large|OverflowError"):
        top_k(small, small.where("vec_id = 0"), 5).collect()  # a score beyond a long
    rest = v.where("vec_id in (1, 2)")
    got = [tuple(r) for r in top_k(v.where("vec_id <> 3"), rest, 1).orderBy("query_id").collect()]
    best = lambda q: min((-sum(a * b for a, b in zip(ints[q], x)), i) for i, x in ints.items() if i not in (q, 3))
    assert got == [(q, 1, best(q)[1], -best(q)[0]) for q in (1, 2)]
    beyond = spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a long"):
        quantised(beyond).collect()


def test_some_queries_stop_early_on_skewed_vectors():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-2, 3, (2000, 8))
    vectors[:40, 0] = 10_000
    index, seen = ImpactIndex(np.arange(2000), vectors), []
    segments = index.segments
    index.segments = lambda exact: (seen.append(low) or (matrix, low) for matrix, low in segments(exact))
    queries = np.zeros((3, 8), np.int64)
    queries[:, 0] = [9, 5, 1]
    for q, (ids, scores) in enumerate(index.search(queries, np.array([-1, -2, -3]), 20)):
        exact = vectors @ queries[q]
        want = np.lexsort((np.arange(2000), -exact))[:20]
        assert (ids == want).all() and (scores == exact[want]).all()
    assert len(seen) < len(index.cuts) and seen[-1] > 0
