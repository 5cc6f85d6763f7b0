"""Whitening, spelling variants and best-fit packing against brute force."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from gridtally.llm import byte_tokens, packing, pieces, spelling, units, whitening
from gridtally.llm.oracle import SPELLING
from gridtally.llm.queries import BYTE_VOCABULARY, MERGE_VOCABULARY, op13_best_fit_packing


def whole(rows):
    """Name and whole numbers of the rows that the operator keeps."""
    out = []
    for name, v in rows:
        if v and all(c is not None and np.isfinite(c) for c in v):
            out.append((name, [int(np.floor(256 * float(c))) for c in v]))
    return out


def check_whitening(spark, rows, components=4, steps=None):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, v array<float>, n int, x int")
    rows = whole([(i, v) for i, v in rows])
    size = collections.Counter(len(x) for _, x in dict((tuple(x), (i, x)) for i, x in rows).values())
    size = max(size, key=lambda k: (size[k], k))
    rows = [(i, x) for i, x in rows if len(x) == size]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > 1e-9 * max(values.sum(), 1e-300)).sum()))
    found = collections.defaultdict(dict)
    repeats = collections.Counter()
    for r in whitening.whitening(frame, "vec_id", "v", components, steps=steps).collect():
        found[r.vec_id][r.component] = r
        repeats[r.vec_id, r.component] += 1
    each = collections.Counter(i for i, _ in rows)
    assert repeats == {(i, k): m for i, m in each.items() for k in range(1, kept + 1)}
    if not kept:
        return
    x = np.array([v for _, v in rows])
    seen = np.array([[found[i][k].whitened for k in range(1, kept + 1)] for i, _ in rows])
    for i, v in rows:
        assert found[i][1].deviation == sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
        assert found[i][1].n == n and found[i][1].identity_error < 1e-9
    explained = [found[rows[0][0]][k].explained for k in range(1, kept + 1)]
    assert explained == pytest.approx(values[:kept] / values.sum(), rel=1e-9)
    if len(set(np.round(values[: kept + 1], 6))) == min(kept + 1, len(values)):  # else axes are not unique
        mine = (x - sums / n) @ axes[:, :kept] / np.sqrt(values[:kept])
        mine *= np.sign((mine * seen).sum(axis=0))
        assert np.abs(mine - seen).max() < 1e-7
    else:
        first = {tuple(v): row for (_, v), row in zip(rows, seen)}
        t = np.array(list(first.values()))
        assert np.abs(np.cov(t.T, bias=True) - np.eye(kept)).max() < 1e-8


def test_whitening(spark):
    r = np.random.default_rng(5)
    mixed = r.normal(size=(80, 9)) @ r.normal(size=(9, 9))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # copies count once
    nan, inf = float("nan"), float("inf")
    rows += [(200, None), (201, []), (202, [nan] * 9), (203, [1.0] * 8 + [None]), (204, [inf] + [0.0] * 8), (205, [1.0, 2.0])]
    check_whitening(spark, [*rows, (None, rows[5][1]), (7, rows[7][1])])
    check_whitening(spark, rows, components=2, steps=9)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, [1.0, 2.0])],
        [(1, None)],
        [(1, [1.0, 0.0, 5.0]), (2, [-1.0, 0.0, 5.0]), (3, [0.0, 1.0, 5.0]), (4, [0.0, -1.0, 5.0])],  # a tie, a constant
        [(i, [float(i == k) for k in range(6)]) for i in range(6)],  # five equal deviations
        [(i, [float(i), 2.0 * i, 3.0]) for i in range(7)],  # one direction only
        [(1, [0.5]), (2, [-0.25]), (3, [0.5])],
    ],
)
def test_whitening_of_few_directions(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, v array<float>")
    if sum(v is not None for _, v in rows) < 2:
        assert whitening.whitening(frame, "vec_id", "v").count() == 0
    else:
        check_whitening(spark, rows)


def test_whitening_of_nothing_and_of_too_much(spark):
    none = spark.createDataFrame([], "vec_id long, v array<float>")
    assert whitening.whitening(none, "vec_id", "v").columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whitening(none, "vec_id", "v").count() == 0
    much = spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, v array<float>")
    with pytest.raises(Exception, match="too large"):
        whitening.whitening(much, "vec_id", "v").collect()


def variants(rows, least_count=5):
    count, low = collections.Counter(), {i: chr(i + 32) for i in range(65, 91)}
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 6
    n = {w: c for w, c in count.items() if c >= least_count}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))

    mates = {w: [x for x in n if x != w and near(w, x)] for w in n}
    best = {w: min(m, key=lambda x: (-n[x], x)) for w, m in mates.items() if m}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n[w], len(mates[w]), n[form[w]] if w in form else None) for w in n}


@pytest.fixture(scope="module")
def spelled():
    r = random.Random(8)
    bases = ["".join(r.choices("abéÿÀs", k=r.choice([5, 6, 7, 9, 14]))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "b" * 40]
    rows = [(None, "Straße strasse STRASSE"), (1, None), (2, ""), (3, " \n"), (4, "Qwertz " * 700 + "qwert1 qwerty " * 3)]
    for i in range(300):
        out = []
        for _ in range(40):
            w = r.choice(bases[: 1 + int(len(bases) * r.random() ** 2)])
            if r.random() < 0.3:
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", "x", "ab"]) + w[k + 1 :]
            out.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i * 7, r.choice([" ", "-", "1"]).join(out)))
    rows += [(9, rows[-1][1])] * 2 + [(10, ("häufig " * 30 + "haufig ") * 3 + "häufigx " * 130 + "x" * 30_000)]
    rows += [(20_000 + i, "kettex " + "kettexy " * 6 + "kettexyz " * 35) for i in range(8)]
    return rows


@pytest.mark.parametrize(("group", "tile"), [(512, 1 << 21), (3, 50)])
def test_variants(spark, spelled, group, tile, monkeypatch):
    monkeypatch.setattr(spelling, "_GROUP", group)
    monkeypatch.setattr(spelling, "_TILE", tile)
    frame = spark.createDataFrame([(*r, 1, "x") for r in spelled], "doc_id long, text string, n int, word string")
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame).collect()}
    expected = variants(spelled)
    assert found == expected
    assert any(v[0] for v in expected.values()) and any(v[1] != v[0] and v[0] for v in expected.values())
    empty = spark.createDataFrame([], frame.schema)
    assert spelling.variants(empty).count() == 0


def test_variants_in_sql(spelled):
    documents = pa.table({"doc_id": pa.array([r[0] for r in spelled], pa.int64()), "text": [r[1] for r in spelled]})
    with duckdb.connect() as db:
        db.register("documents", documents)
        found = {r[0]: r[1:] for r in db.execute(SPELLING).fetchall()}
    assert found == variants(spelled)


def test_near_pairs():
    words = ["abcdef", "abcdeg", "abcxef", "bbcdeg", "aaaaaa"]
    shorter = ["abcde", "bcdef", "aaaaa", "abxde"]
    found = {frozenset(p) for p in spelling.near_pairs(words, shorter)}
    assert found == {frozenset(p) for p in [
        ("abcdef", "abcdeg"), ("abcdef", "abcxef"), ("abcdeg", "bbcdeg"), ("abcdef", "abcde"),
        ("abcdeg", "abcde"), ("abcdef", "bcdef"), ("aaaaaa", "aaaaa"),
    ]}


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.randint(1, 60)
    counts = {r.randint(1, capacity): r.randint(1, 150) for _ in range(30)}
    held, placed = collections.defaultdict(list), collections.Counter()
    for length, first, n, sequence, each, offset in packing.plan(counts, capacity):
        assert first == placed[length]
        placed[length] += n
        for k in range(n):
            held[sequence + k // each].append((offset + k % each * length, length))
    assert placed == counts
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    bins = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [b for b in range(len(bins)) if bins[b] >= length]
            if fits:
                bins[min(fits, key=lambda b: bins[b])] -= length
            else:
                bins.append(capacity - length)
    assert len(held) == len(bins)


TEXTS = [
    None, "", " ", "one", "two words", "a  b", "x\n\n\ny \t z ", "<|endoftext|> x", "café  　 au lait", "it's   don't",
    "word " * 3000, "\n" * 90, "z" * 3000, "ß\U0001f600 " * 50, "one", "one",
]


@pytest.mark.parametrize("added", [True, False])
def test_byte_tokens(added, monkeypatch):
    monkeypatch.setattr(units, "_MOST_UNITS", 5)
    tokens = byte_tokens.ByteTokens(BYTE_VOCABULARY, added)
    for texts in (TEXTS, TEXTS[::-1], TEXTS[:1], []):
        ids, counts = tokens.encode(pa.array(texts, pa.string()), 2)
        expected = [[*tokens.library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
        assert ids.tolist() == [i for row in expected for i in row]
        assert counts.tolist() == [len(row) for row in expected]


def test_byte_tokens_of_units_in_a_row():
    draw = np.random.default_rng(1)
    signs = [" ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u3000", "a", "Zz", "\u00e9", "'s", "'", "##", ".", "12", "\U0001f600", "<|endoftext|>"]
    texts = ["".join(draw.choice(signs, draw.integers(0, 40), p=[0.3, *[0.7 / 16] * 16])) for _ in range(400)]
    for added in (True, False):
        tokens = byte_tokens.ByteTokens(BYTE_VOCABULARY, added)
        given = []

        class Library:
            def __getattr__(self, name, library=tokens.library, given=given):
                def call(texts, **options):
                    given.extend(texts)
                    return getattr(library, name)(texts, **options)

                return call if name.startswith("encode_batch") else getattr(library, name)

        tokens.library = Library()
        expected = [[*tokens.whole(t).tolist(), 2] for t in texts]
        ids, counts = tokens.encode(pa.array(texts), 2)
        assert ids.tolist() == [i for row in expected for i in row]
        assert counts.tolist() == [len(row) for row in expected]
        given.clear()
        words = pa.array([" ".join(f"w{i:05}" for i in range(k, k + 100)) for k in range(0, 5000, 100)])
        assert (tokens.encode(words, 2)[1] > 100).all()
        # 4,950 units of seven bytes that can follow another, and 50 that begin a text
        assert len(given) < 250


def test_full_memory_of_units_keeps_those_met_again(monkeypatch):
    monkeypatch.setattr(units, "_MOST_UNITS", 8)
    learned = []

    def encode(raw, offsets):
        learned.extend(raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:]))
        return raw.astype(np.uint32), np.diff(offsets)

    memory = units.Units(encode)

    def ids_of(*words):
        raw = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        begins = np.zeros(len(raw), bool)
        begins[ends - [len(w) for w in words]] = True
        ids, counts = memory.ids_of(raw, np.array([0, len(raw)]), begins, 7)
        assert ids.tolist() == [*raw.tolist(), 7] and counts.tolist() == [len(raw) + 1]

    ids_of("one", "two", "three")
    ids_of("two", "four", "three")
    ids_of(*(f"x{i}" for i in range(9)))
    learned.clear()
    ids_of("three", "one", "two", "x1")
    assert sorted(learned) == [b"one", b"x1"]
    # all of them were met again, more than a full memory can keep half of
    ids_of(*(f"x{i}" for i in range(9)))
    ids_of(*(f"x{i}" for i in range(9)))
    ids_of("three")
    assert memory.places.count <= 9


def test_units_of_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(units, "run_values", lambda raw, starts, ends: (ends - starts).astype(np.uint64))
    tokens = byte_tokens.ByteTokens(BYTE_VOCABULARY)
    texts = ["one two six", "ten", "abc abd", "abd abc"]
    ids, counts = tokens.encode(pa.array(texts), 2)
    expected = [[*tokens.library.encode(t).ids, 2] for t in texts]
    assert ids.tolist() == [i for row in expected for i in row] and counts.tolist() == [len(r) for r in expected]
    merges = pieces.Pieces(MERGE_VOCABULARY)
    ids, counts = merges.encode(pa.array(texts))
    expected = merges.library.encode(texts, add_eos=True)
    assert ids.tolist() == [i for row in expected for i in row] and counts.tolist() == [len(r) for r in expected]


def test_pieces_of_odd_texts(monkeypatch):
    monkeypatch.setattr(units, "_MOST_UNITS", 5)
    merges = pieces.Pieces(MERGE_VOCABULARY)
    texts = [*TEXTS, "\u2581a \u2581\u2581 b\u2581", " ", "  a", "a  "]
    ids, counts = merges.encode(pa.array(texts))
    expected = merges.library.encode([t or "" for t in texts], add_eos=True)
    assert ids.tolist() == [i for row in expected for i in row] and counts.tolist() == [len(r) for r in expected]


def test_pieces_are_decoded_some_rows_at_a_time(monkeypatch):
    merges = pieces.Pieces(MERGE_VOCABULARY)
    texts = [*TEXTS, "one more " * 40_000, "\u2581 x", None] + ["some words of a text " * 100] * 400
    library, at_once = merges.library, []

    class Library:
        def __getattr__(self, name):
            return getattr(library, name)

        def decode(self, rows):
            at_once.append(sum(map(len, rows)))
            return library.decode(rows)

    merges.library = Library()
    monkeypatch.setattr(pieces, "pieces", lambda path: merges)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["row", "text"])
    out = pa.Table.from_batches(pieces._encode("")([batch, batch.slice(0, 0)]))
    expected = library.encode([t or "" for t in texts], add_eos=True)
    assert out["ids"].to_pylist() == expected and out["decoded"].to_pylist() == library.decode(expected)
    longest = max(map(len, expected))
    assert longest > 1 << 16 and max(at_once) == longest
    assert sum(n > 1 << 16 for n in at_once) == 1 and sum(at_once) > 4 << 16


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_packing(spark, capacity):
    rows = [(i if i % 5 else None, t, 1, 2, 3) for i, t in enumerate(TEXTS * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, part int, place int, length int").repartition(5)
    packed = packing.pack(frame, BYTE_VOCABULARY, 2, capacity, added=True)
    placed = packed.placed().collect()
    tokens = byte_tokens.ByteTokens(BYTE_VOCABULARY, added=True)
    expected = collections.Counter()
    for doc, text, *_ in rows:
        ids = [*tokens.whole(text or "").tolist(), 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in placed) == expected
    held = collections.defaultdict(list)
    for r in placed:
        held[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    whole = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in packed.sequences().collect()}
    for name, parts in held.items():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and whole[name] == (at, b"".join(p[2] for p in sorted(parts)))
    total = sum(r.length for r in placed)
    assert len(held) == len(whole) == packed.n_sequences
    assert packed.n_sequences <= -(-total // capacity) + 1  # these lengths leave no more room than that
    assert packing.pack(frame.where("false"), BYTE_VOCABULARY, 2, capacity).placed().count() == 0


def test_packing_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = op13_best_fit_packing(spark, sf_dir)
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    tokens = byte_tokens.ByteTokens(BYTE_VOCABULARY, added=True)
    expected = set()
    for row in ids:
        whole = np.append(tokens.whole(row.text or ""), 2).astype("<u4")
        first = len(whole) % 1024 or 1024
        for piece, a in enumerate([0, *range(first, len(whole), 1024)]):
            b = first if piece == 0 else a + 1024
            expected.add((row.doc_id, piece, a, b - a, zlib.crc32(whole[a:b].tobytes())))
    assert {tuple(r)[:5] for r in out.collect()} == expected
