import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tests.llm.frames import DOCUMENTS, awkward_rows, clashing, documents
from tokenizers import Tokenizer

from medallion.llm import sentence_pieces
from medallion.llm.alignment import BYTE_MODEL, align_tokenizers
from medallion.llm.sentence_pieces import MODEL, encode_documents, piece_digests, piece_model, public_path
from medallion.llm.whitening import shifted, whitened

BITS = [
    *[" ", "  ", "   ", "a", "b", "e", "the", " the", "ing", "aa", "ab", "é", "ß", "日", "😀", "ا", "Ж", "▁"],
    *["\n", "\t", "\x00", "\x85", "\xa0", "　", "\x0b", "\x1c", "\r\n", "<s>", "</s>", "<unk>", "<0x41>"],
    *["<|endoftext|>", "'s", "'ll", "1", "23", "...", "==", "----", "�", "×", ".", " ."],
]


def odd_texts(n, seed=7):
    rng = random.Random(seed)
    out = ["", " ", "  ", "▁", "a", "\x00", "e" * 99, " " * 70, "-" * 65, "abab" * 40]
    out += ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    out += ["".join(rng.choice("-= ") for _ in range(rng.randrange(1, 60))) for _ in range(n // 4)]
    return out + ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(20)) for _ in range(n // 4)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_path(MODEL))


@pytest.mark.parametrize("part", [1 << 20, 16])
def test_ids_and_texts_equal_the_library(library, monkeypatch, part):
    monkeypatch.setattr(sentence_pieces, "PART", part)
    model, texts = piece_model(public_path(MODEL)), odd_texts(3000)
    flat, counts = model.encode(texts)
    ends = np.cumsum(counts)
    got = [flat[e - n : e].tolist() for e, n in zip(ends, counts)]
    want = library.encode(texts)
    assert got == want
    assert [model.decode([*ids, 2]) for ids in want] == [library.decode([*ids, 2]) for ids in want]


def test_any_ids_decode_as_in_the_library(library):
    rng, model = random.Random(3), piece_model(public_path(MODEL))
    choices = [lambda: rng.randrange(32000), lambda: rng.randrange(270), lambda: 29871, lambda: rng.randrange(3)]
    for _ in range(5000):
        ids = [rng.choice(choices)() for _ in range(rng.randrange(12))]
        assert model.decode(ids) == library.decode(ids)


def test_equal_ranks_merge_one_at_a_time(library):
    model = piece_model(public_path(MODEL))
    for text in [" " * 40_000, " a " * 50 + " " * 33, "e" * 50_000]:
        assert model.encode([text])[0].tolist() == library.encode(text)


@pytest.mark.parametrize("change", [lambda df: df, clashing])
def test_piece_digests_of_awkward_rows(spark, library, change):
    rows = awkward_rows()
    got = piece_digests(encode_documents(change(documents(spark)))).collect()

    def digest(doc_id, text):
        ids = [*library.encode(text or ""), 2]
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        return (doc_id, len(ids), *sha)

    assert Counter(map(tuple, got)) == Counter(digest(i, t) for i, t, *_ in rows)
    assert piece_digests(encode_documents(spark.createDataFrame([], DOCUMENTS))).count() == 0


def brute_alignment(rows, library):
    bytewise = Tokenizer.from_file(public_path(BYTE_MODEL))
    bytewise.encode_special_tokens = True
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}

    def spelled(k):
        piece = library.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if library.is_byte(k) else piece.replace("▁", " ").encode()

    def ends(tokens):
        return np.cumsum([len(t) for t in tokens]).tolist()

    def one(text):
        if not text:
            return None
        a, b = bytewise.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
        own_a = [bytes(byte[c] for c in bytewise.id_to_token(k)) for k in a]
        own_b = [spelled(k) for k in b]
        if not b"".join(own_a) == b"".join(own_b) == (" " + text).encode():
            return None
        end_a, end_b = ends(own_a), ends(own_b)
        shared, links = sorted(set(end_a) & set(end_b)), []
        for i, k in enumerate(a):
            for j in range(len(b)):
                if end_b[j] > end_a[i] - len(own_a[i]) and end_b[j] - len(own_b[j]) < end_a[i]:
                    links.append((k, b[j]))
        groups, before = [], 0
        for e in shared:
            sides = [[str(k) for k, x in zip(*s) if before < x <= e] for s in ((a, end_a), (b, end_b))]
            groups.append("|".join(",".join(s) for s in sides))
            before = e
        return len(a), len(b), len(shared), links, ";".join(groups)

    found = [one(text) for _, text in rows]
    count = Counter(pair for f in found if f for pair in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        *sizes, links, groups = f
        n_best = sum(count[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        yield doc_id, *sizes, len(links), n_best, sum(count[p] for p in links), digest


@pytest.mark.parametrize("chunk", [3 << 20, 300])
def test_alignment_equals_brute_force(spark, library, chunk):
    rows = [(i, t[:700] if t else t) for i, t, *_ in awkward_rows()]
    rows += [(1000 + k, t) for k, t in enumerate(odd_texts(120))]
    frame = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = align_tokenizers(frame, chunk=chunk).collect()
    assert Counter(map(tuple, got)) == Counter(brute_alignment(rows, library))


def test_alignment_of_a_long_text_and_of_none(spark, library):
    text = " ".join(f"w{k % 997}" for k in range(60_000)) + " é" * 50_000
    row = align_tokenizers(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_b == len(library.encode(text)) and row.n_links == row.n_a + row.n_b - row.n_groups
    assert row.n_best <= row.n_links == row.count_sum
    for rows in ([], [(1, None), (2, ""), (None, "▁")]):
        got = align_tokenizers(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((tuple(r)[1:] for r in got)) == [(0,) * 6 + ("",)] * len(rows)


VECTORS = "vec_id long, embedding array<float>, n int, x string, at int"


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20)) * 0.3
    base[100:200] = base[7]  # a hot vector
    vectors = base.astype(np.float32).tolist()
    rows = [(k, v, 1, "x", 2) for k, v in enumerate(vectors)] + [(3, vectors[3], None, None, None), (None, vectors[4], 1, "", 1)]
    bad = [None, [], [1.0] * 19 + [None], [float("nan")] * 20, [0.0] * 19 + [float("inf")]]
    rows += [(900 + k, v, 1, "x", 2) for k, v in enumerate(bad)]
    got = whitened(spark.createDataFrame(rows, VECTORS).repartition(4)).toPandas()
    kept = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 20 and None not in v and np.isfinite(v).all()]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    deep = n * x - total
    centred = (n * fit - total) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    want = deep / n @ turn[:, order] / np.sqrt(values[order])
    assert len(got) == len(kept) * 16 and set(got.n) == {n}
    ids = np.array([-1 if i is None else i for i, _ in kept])
    own = got.assign(vec_id=got.vec_id.fillna(-1).astype(int))
    for component in range(1, 17):
        part = own[own.component == component].sort_values(["vec_id", "whitened"], kind="stable")
        z = want[:, component - 1]
        sign = np.sign(np.dot(part.whitened, z[np.argsort(ids, kind="stable")]))
        assert np.allclose(np.sort(part.whitened), np.sort(sign * z), rtol=0, atol=1e-9)
        assert np.allclose(part.explained, values[order][component - 1] / values.sum(), rtol=1e-9)
    assert sorted(own[own.component == 1].deviation) == sorted((deep**2).sum(1).tolist())
    assert own.identity_error.max() < 1e-9


def test_whitening_of_little(spark):
    frame = spark.createDataFrame
    for rows in ([], [(1, None, 1, "", 1)], [(1, [1.0, 2.0], 1, "", 1), (2, [1.0, 2.0], 1, "", 1)]):
        assert whitened(frame(rows, VECTORS)).count() == 0
    line = whitened(frame([(k, [float(k), 2.0 * k, 5.0], 1, "", 1) for k in range(5)], VECTORS)).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-9 for r in line)
    with pytest.raises(ValueError, match="of 1 to 2 components"):
        whitened(frame([(1, [1.0], 1, "", 1), (2, [1.0, 2.0], 1, "", 1)], VECTORS))
    assert shifted(frame([(1, [-0.01, 0.5], 1, "", 1)], VECTORS)).first().x == [999_999, 1_000_032]
