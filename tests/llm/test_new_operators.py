"""Whitening, phrase collocations and genetic packing beside brute force, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clinlake.llm import collocations, ga_packing, whitening

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def in_parts(frame, n=5):
    return frame.repartition(n)


# -- whitening ------------------------------------------------------------------------------------

def spectra():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
        yield from ((name, (turn * values) @ turn.T) for name, values in {
            "random": rng.random(n),
            "graded": 10.0 ** -np.arange(n),
            "repeated": np.where(np.arange(n) < n // 2, 3.0, 1.0),
            "low rank": np.where(np.arange(n) < max(1, n // 4), 2.0, 0.0),
            "equal": np.ones(n),
            "zero": np.zeros(n),
            "negative": -rng.random(n),
        }.items())


def test_eigenpairs_of_many_spectra():
    for name, matrix in spectra():
        matrix = (matrix + matrix.T) / 2
        values, vectors = whitening.eigenpairs(matrix)
        size = max(1e-300, np.abs(matrix).max())
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1], atol=1e-13 * max(1, size)), name
        assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-13, name
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * max(1, size), name


def test_polar_factor_is_orthogonal_and_splits_by_sign():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((20, 20))
    u, (left, _, right) = whitening.polar_factor(a), np.linalg.svd(a)
    assert np.abs(u - left @ right).max() < 1e-12


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, `a.b` int, vector string")


def test_whitening_beside_brute_force(spark):
    rng = np.random.default_rng(5)
    mixed = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12)) * 0.3 + 1
    rows = [(i, [float(x) for x in v.astype(np.float32)], 1, "x") for i, v in enumerate(mixed)]
    rows += [rows[0], rows[0], (None, [0.0] * 12, 1, "x")]
    bad = [(900, None, 1, "x"), (901, [None] + [1.0] * 11, 1, "x"), (902, [math.nan] * 12, 1, "x"), (903, [math.inf] + [0.0] * 11, 1, "x"), (904, [1.0, 2.0], 1, "x"), (905, [], 1, "x")]
    got = whitening.whiten(in_parts(vectors(spark, rows + bad))).collect()
    x = np.array([[math.floor(1024 * np.float64(np.float32(c))) + 100_000 for c in r[1]] for r in rows], np.int64)
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums) / n
    v = c.T @ c / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    deviation = Counter(((None if r[0] is None else r[0]), int(((n * a - sums) ** 2).sum())) for r, a in zip(rows, x))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 3) == deviation
    for k in range(8):
        mine = {r.vec_id: r for r in got if r.component == k + 1}
        want = c @ basis[:, k] / math.sqrt(values[k])
        sign = np.sign(want[1] * mine[1].whitened)
        assert all(abs(mine[r[0]].whitened - sign * w) < 1e-8 for r, w in zip(rows, want))
        assert mine[0].explained == pytest.approx(values[k] / np.trace(v), rel=1e-9)


def test_whitening_of_small_and_odd_tables(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0, "")])).collect() == []
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0], 0, "") for i in range(9)])).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0], 0, "") for i in range(50)]
    got = whitening.whiten(vectors(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 50
    assert got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-4


def test_whitening_sums_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * (i % 3)), float(i)], 0, "") for i in range(200)]
    got = {r.vec_id: r for r in whitening.whiten(in_parts(vectors(spark, rows))).collect() if r.component == 1}
    x = [[int(1024 * c) + 100_000 for c in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    for (i, *_), a in zip(rows, x):
        exact = sum((200 * p - s) ** 2 for p, s in zip(a, sums))
        assert got[i].deviation == (exact if exact < 2**63 else None)


# -- phrases --------------------------------------------------------------------------------------

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    return counts


def brute(rows, min_count, top=2000):
    counts = counted(rows)
    frequent = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= min_count}
    longer = Counter()
    for (lang, words), f in frequent.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longer[lang, part] = max(longer[lang, part], f)
    found = []
    for (lang, words), a in frequent.items():
        if len(words) == 2 and 100 * longer[lang, words] >= 50 * a:
            continue
        cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.append((lang, score, a, " ".join(words), counts[lang, words[:k]], counts[lang, words[k:]]))
    out = []
    for lang in {f[0] for f in found}:
        n = sum(f for (x, w), f in counts.items() if x == lang and len(w) == 1)
        own = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[1], -f[2], f[3].encode()))
        out += [(lang, i + 1, p, a, left, right, n, s) for i, (_, s, a, p, left, right) in enumerate(own[:top])]
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["ab", "Ab", "été", "x-y", "日本", "a", "the", "\x00", "of", "it's"]
    for _ in range(n):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60))]
        yield rng.choice(["en", "de", None, "und"]), "".join(parts)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, x, 0) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, `a.b` int")


def shown(frame):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect())


@pytest.mark.parametrize("max_phrases, burst, chunk", [(10**6, 4096, 1 << 20), (60, 5, 40)])
def test_phrases_beside_brute_force(spark, monkeypatch, max_phrases, burst, chunk):
    """Also with containers that burst, subtrees that are written out and texts read in many chunks."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = [*texts(1, 200), ("en", None), ("en", ""), (None, "one two"), ("en", "w " * 500), ("de", "long" * 50 + " tail")]
    got = shown(collocations.phrases(in_parts(documents(spark, rows)), min_count=5, max_phrases=max_phrases, burst=burst))
    assert got == brute(rows, 5) and len(got) > 50


def test_phrases_are_cut_off_by_rank(spark):
    rows = list(texts(2, 200))
    assert shown(collocations.phrases(documents(spark, rows), min_count=3, top=7)) == brute(rows, 3, 7)


def test_phrases_of_small_tables(spark):
    assert shown(collocations.phrases(documents(spark, []))) == []
    assert shown(collocations.phrases(documents(spark, [("en", "a b c"), (None, None)]))) == []
    repeated = [("en", "Alpha beta.")] * 10
    assert shown(collocations.phrases(documents(spark, repeated))) == [("en", 1, "alpha beta", 10, 10, 10, 20, 10**6)]


def test_scores_are_exact_beyond_64_bits(spark):
    frame = spark.sql("select 3037000500000 a, 4000000000001 l, 5000000000003 r")
    wide = "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))"
    score = frame.select(F.expr(f"cast({wide} div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long) s")).first()["s"]
    assert score == 10**6 * 3037000500000**2 // (4000000000001 * 5000000000003)


def test_a_burst_trie_counts_as_a_plain_one():
    rng = np.random.default_rng(1)
    small, plain = collocations.Trie(), Counter()
    for _ in range(20):
        parts = rng.integers(1, 2**21, (3, 300)) % np.array([[1 << 20], [9], [5]])
        keys, counts = np.unique(parts[0] << 42 | parts[1] << 21 | parts[2], return_counts=True)
        small.add(keys, counts, 8)
        plain.update(dict(zip(keys.tolist(), counts.tolist())))
    assert small.children is not None and dict(zip(*(x.tolist() for x in small.arrays()))) == dict(plain) and small.size() == len(plain)


# -- packing --------------------------------------------------------------------------------------

def test_crossover_keeps_every_document_once():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 100, 400))[::-1]
    block = ga_packing.Block(lengths, 128, rng)
    groups = [block.random() for _ in range(4)]
    for _ in range(30):
        child = block.mutate(block.cross(groups[0], groups[1]))
        fills = block.fills(child)
        assert len(child) == 400 and fills.max() <= 128 and fills.min() > 0 and fills.sum() == lengths.sum()
        groups = groups[1:] + [child]


def test_evolution_saves_windows():
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(150, 420, 600))[::-1]
    block = ga_packing.Block(lengths, 1000, rng)
    first = [block.random() for _ in range(6)]
    last = block.evolve(first, 300)
    assert block.fitness(last[0]) > max(block.fitness(g) for g in first)
    assert len(block.fills(last[0])) < min(len(block.fills(g)) for g in first)


def checked(frame, texts_of, capacity):
    """Windows of a packing, after every piece is found where it says."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = frame.collect()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts_of.items()}
    by_doc, windows = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert set(by_doc) == set(texts_of)
    for i, held in by_doc.items():
        held.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in held] == [(k, k * capacity) for k in range(-(-len(ids[i]) // capacity))]
    for held in windows.values():
        held.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in held])
        assert [r.offset for r in held] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity
    return windows, sum(map(len, ids.values()))


def test_packing_of_a_table(spark):
    rng = random.Random(7)
    texts_of = {i: " ".join(rng.choice(["alpha", "beta", "Ünïcode", "x1"]) for _ in range(rng.choice([3, 20, 60, 150, 400]))) for i in range(300)}
    texts_of |= {300: None, 301: "", 302: "word " * 3000, 303: "日本語 " * 20}
    rows = [(i, t, 1, 2) for i, t in texts_of.items()]
    frame = in_parts(spark.createDataFrame(rows, "doc_id long, text string, uid int, `a.b` int"))
    for size in (4096, 64):
        windows, tokens = checked(ga_packing.pack(frame, TOKENIZER, capacity=256, rows_per_block=size), texts_of, 256)
        assert len(windows) <= -(-tokens // 256) + 6
    whole, _ = checked(ga_packing.pack(frame, TOKENIZER), texts_of, 4096)
    again = ga_packing.pack(frame.coalesce(1), TOKENIZER)
    assert len(whole) == again.select("sequence_id").distinct().count()


def test_packing_of_repeated_rows_null_ids_and_none(spark):
    schema = "doc_id long, text string"
    rows = [(5, "same text")] * 4 + [(None, "no id"), (None, None)]
    got = ga_packing.pack(spark.createDataFrame(rows, schema), TOKENIZER, with_ids=True).collect()
    assert Counter(r.doc_id for r in got) == {5: 4, None: 2} and len({r.sequence_id for r in got}) == 1
    assert all(len(r.ids) == 4 * r.length for r in got)
    assert ga_packing.pack(spark.createDataFrame([], schema), TOKENIZER).collect() == []
