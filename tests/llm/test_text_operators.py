"""Text operators against brute force, on texts that are null, empty, long, repeated or alike."""

import collections
import hashlib
import random
import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gridtally.llm import (
    cluster,
    decontaminate,
    html_extract,
    line_dedup,
    near_dup,
    pieces,
    quality_model,
    quality_rules,
    sketches,
    substring_dedup,
    token_counts,
    token_files,
)
from gridtally.llm.html_tree import parse
from gridtally.llm.queries import BYTE_VOCABULARY, MERGE_VOCABULARY, op9_token_files
from gridtally.llm.words import slices

GAP = re.compile(rb"[^\x20\x09-\x0D]+")
#: Columns whose names clash with those the operators make and use.
CLASHES = ["row", "key", "node", "words", "n_words", "kept", "ids", "text_", "size"]


def words(text):
    return [w.decode() for w in GAP.findall((text or "").encode())]


def sentence(r, n):
    return " ".join("".join(r.choices(["ka", "lo", "mi", "ru", "Été", "ßa", "ne"], k=r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    base, common = sentence(r, 120), sentence(r, 40)
    out = [None, "", "  \n\t ", "one", "two words here", "a b c d", "x y  z", base, base, base.upper()]
    for _ in range(40):  # near copies of one text, with one to twelve words changed
        w = base.split()
        for k in r.sample(range(len(w)), r.randint(1, 12)):
            w[k] = sentence(r, 1)
        out.append(" ".join(w))
    out += [sentence(r, 30) + "\n" + common + "\n" + sentence(r, 25) for _ in range(12)]
    out += [sentence(r, 60) for _ in range(12)]
    out += [("again and again " * 60).strip(), "ab " * 3000, sentence(r, 9000), "w***\n" * 30, "z" * 5000]
    out += ["double  space \n and <s> </s> <|endoftext|> ▁x 😀 \x00 ﬁ", " lead and trail "]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], None, *([i] * len(CLASHES))) for i, t in enumerate(texts)]
    names = ", ".join(f"{c} int" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}").repartition(5)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_words_are_those_of_the_pattern(texts):
    for lower in (False, True):
        found = []
        for part in slices(pa.array(texts), lower):
            for row, begin in enumerate(part.begins()[:-1]):
                stop = begin + part.counts[row]
                found.append([part.bytes[s:e].tobytes().decode() for s, e in zip(part.starts[begin:stop], part.ends[begin:stop])])
        low = {i: chr(i + 32) for i in range(65, 91)}
        assert found == [[w.translate(low) if lower else w for w in words(t)] for t in texts]


@pytest.mark.parametrize(
    ("length", "hot_share", "piece", "pivots"), [(4, 10_000, 512, 3), (4, 10, 2, 1), (5, 10_000, 512, 1)]
)
def test_near_duplicates(docs, texts, empty, length, hot_share, piece, pivots, monkeypatch):
    monkeypatch.setattr(near_dup, "_PIVOTS", pivots)
    monkeypatch.setattr(cluster, "HOT_SHARE", hot_share)
    monkeypatch.setattr(near_dup, "_PIECE", piece)
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for t in texts:
        w = GAP.findall((t or "").encode().translate(low))
        sets.append({tuple(w[k : k + length]) for k in range(len(w) - length + 1)} if len(w) >= length else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    expected = {i: (len(x), root(i), root(i) == i) for i, x in enumerate(sets)}
    assert by_id(near_dup.near_duplicates(docs, length), "n_shingles", "component_id", "kept") == expected
    if length == 5:
        assert near_dup.near_duplicates(empty).count() == 0
        assert {r.doc_id for r in near_dup.keep_one(docs).collect()} == {i for i, v in expected.items() if v[2]}


def test_near_duplicates_of_repeated_and_nameless_rows(spark):
    text = "one two three four five six seven"
    rows = spark.createDataFrame([(5, text), (5, text), (3, text), (None, text), (7, None)], "doc_id long, text string")
    found = sorted(map(tuple, near_dup.near_duplicates(rows).collect()), key=repr)
    assert found == sorted([(5, 3, 3, False)] * 2 + [(3, 3, 3, True), (None, 3, None, True), (7, 0, 7, True)], key=repr)
    assert sorted(r.doc_id or 0 for r in near_dup.keep_one(rows).collect()) == [0, 3, 7]


def test_levels_of_cells_take_few_jobs(spark):
    r = np.random.default_rng(4)
    values = [(r.zipf(1.3, 400).astype(np.uint64) << np.uint64(44)) for _ in range(40)]
    cluster.ship(spark)
    rows = spark.createDataFrame([(bytearray(v.tobytes()),) for v in values], "shingles binary").repartition(5)
    # as many partitions as a large input has; each job costs the driver time and memory
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("levels", "levels of cells")
    try:
        found = sketches.cell_levels(rows, near_dup._cells(20), 1 << 20)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("levels")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    times = np.bincount((np.concatenate(values) >> np.uint64(44)).astype(np.int64), minlength=1 << 20)
    assert times.max() > 1000 and (found == sketches.level(times)).all()
    assert found.nbytes == 1 << 20 and len(jobs) <= 4


def test_levels_keep_the_order_of_counts():
    counts = np.unique(np.concatenate((np.arange(5000), 2 ** np.arange(34), 2 ** np.arange(34) + 1)))
    levels = sketches.level(counts).astype(int)
    assert (np.diff(levels) >= 0).all() and (levels[:33] == np.arange(33)).all() and levels[-1] == 255


def test_components_carry_known_ones_on(spark):
    r = random.Random(8)
    space, found, least = cluster.Workspace(spark, "links"), None, {}
    for k, n in enumerate((90, 60, 0, 40)):
        links = [(r.randrange(300), r.randrange(300)) for _ in range(n)]
        found = near_dup.components(space, spark.createDataFrame(links, "a long, b long"), f"known-{k}", found)
        for a, b in links:
            if a != b:
                ends = {least.setdefault(a, a), least.setdefault(b, b)}
                least.update({x: min(ends) for x, c in least.items() if c in ends})
        assert sorted(map(tuple, found.select("node", "component").collect())) == sorted(least.items())


def test_components_take_few_tasks(spark):
    space, r = cluster.Workspace(spark, "links"), random.Random(9)
    links = [(k, k + 1) for k in range(0, 400, 2)] + [(r.randrange(40), r.randrange(40, 80)) for _ in range(60)]
    known = near_dup.components(space, spark.createDataFrame(links[:150], "a long, b long"), "first")
    # as many partitions as a large input has; each job and each task costs the driver time and memory
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("components", "components")
    try:
        found = near_dup.components(space, spark.createDataFrame(links[150:], "a long, b long"), "second", known)
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup("components")
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    least = {}
    for a, b in links:
        ends = {least.setdefault(a, a), least.setdefault(b, b)}
        least.update({x: min(ends) for x, c in least.items() if c in ends})
    assert sorted(map(tuple, found.select("node", "component").collect())) == sorted(least.items())
    assert len(jobs) <= 45 and tasks <= 300
    for step in ("hook-0", "jump-0", "edges-1"):
        assert spark.read.parquet(space.path(f"second-{step}")).rdd.getNumPartitions() == 1, step


def test_word_weights_take_few_jobs(spark):
    cluster.ship(spark)
    texts = [f"word{k % 7} word{k % 11} always" for k in range(50)] + [None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("weights", "weights of words")
    try:
        found = decontaminate.inverse_frequencies(rows)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("weights")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    held = collections.Counter(w for t in texts for w in set((t or "").split()))
    expected = sorted(np.log(53 / (1 + n)) + 1e-3 for n in held.values())
    assert found.shape == (1 << decontaminate.BITS,) and len(jobs) <= 4
    assert np.sort(found)[: len(held)] == pytest.approx(expected)


def test_small_tables_are_counted_and_cut_in_few_parts(spark, monkeypatch):
    monkeypatch.setattr(cluster, "PART_ROWS", 10)
    space = cluster.Workspace(spark, "parts")
    rows = spark.range(25, numPartitions=8)
    assert [cluster.in_parts(rows, n).rdd.getNumPartitions() for n in (0, 10, 11, 25, 1000)] == [1, 1, 2, 3, 8]
    kept, n = space.keep_with(cluster.in_parts(rows, 25), "some", F.sum("id"))
    assert n == 300 and kept.count() == 25 and kept.columns == ["id"]
    assert [space.keep_with(rows.where("id < 0"), "none", x)[1] for x in (F.sum("id"), F.count("id"))] == [0, 0]


def without(texts, length=20):
    first, out = {}, {}
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), (i, k))
    for i, t in enumerate(texts):
        w, gone = words(t), set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] != (i, k):
                gone.update(range(k, k + length))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substring_dedup(docs, texts, empty, spark):
    found = by_id(substring_dedup.without_repeats(docs, sketch_bits=21), "n_words", "n_removed", "kept_text")
    assert found == without(texts)
    assert substring_dedup.without_repeats(empty, sketch_bits=21).count() == 0
    twice = spark.createDataFrame([(1, "w " * 25), (1, "w " * 25), (None, None)], "doc_id long, text string")
    rows = sorted(map(tuple, substring_dedup.without_repeats(twice, sketch_bits=21).collect()), key=repr)
    one = (1, *without(["w " * 25])[0])
    assert rows == sorted([one, one, (None, 0, 0, "")], key=repr)


def test_quality_counts(docs, texts, empty):
    expected = {}
    for i, t in enumerate(texts):
        w, lines = words(t), [x for x in (t or "").split("\n") if GAP.search(x.encode())]
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        expected[i] = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality_rules.judge(docs, ["doc_id"])
    assert by_id(judged, *columns) == expected
    assert judged.where("base_failed AND kept").count() == 0
    assert quality_rules.judge(empty, ["doc_id"]).count() == 0
    assert quality_rules.good_documents(docs).columns == docs.columns


def brute_verdicts(rows, languages, full_words=60, max_distance=0.46, slack=2.0):
    """Verdicts in plain numpy, for rows (lang, text): both histograms, references twice, distances."""
    known = sorted({w for group in languages.values() for w in group})
    free = (max(map(len, languages.values())), len(quality_rules.CLASSES) - 1)

    def histograms(text):
        w = words(text)
        kinds = collections.Counter()
        for c in "".join(w):
            kind = unicodedata.category(c)
            place = {"Ll": 0, "Lu": 1, "Nd": 2}.get(kind, 3 if c in ".,;:!?" else 5)
            kinds[place] += c not in quality_rules.SYMBOLS
        kinds[4] = sum(c in quality_rules.SYMBOLS for c in text or "")
        lower = collections.Counter(x.lower() for x in w if x in known or x.lower().capitalize() == x)
        common = [lower[x] for x in known]
        return np.array([kinds[k] for k in range(6)]), np.array([*common, len(w) - sum(common)]), len(w), sum(map(len, w))

    def distance(counts, total, reference):
        p, q = counts / total, reference / reference.sum()
        m = (p + q) / 2
        parts = [(x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() / 2 for x in (p, q)]
        return max(sum(parts), 0) ** 0.5

    made = [(lang, *histograms(text)) for lang, text in rows]
    base = [n < 10 or 100 * repeated_words(text) > 20 * n for (_, _, _, n, _), (_, text) in zip(made, rows, strict=True)]

    def far(references):
        out = []
        for (_, classes, common, n, chars), failed in zip(made, base, strict=True):
            if failed or not references:
                out.append(False)
                continue
            apart = sum(min(distance(h, t, r[k]) for r in references) for k, (h, t) in enumerate([(classes, chars), (common, n)]))
            noise = sum((f / (8 * np.log(2) * n)) ** 0.5 - (f / (8 * np.log(2) * full_words)) ** 0.5 for f in free)
            out.append(apart > max_distance + slack * (noise if n < full_words else 0))
        return out

    def references(skip):
        groups = collections.defaultdict(list)
        for (lang, classes, common, *_), failed, s in zip(made, base, skip, strict=True):
            if lang in languages and not failed and not s:
                groups[lang].append((classes, common))
        return [(sum(a for a, _ in g), sum(b for _, b in g)) for g in groups.values()]

    second = far(references(far(references([False] * len(rows)))))
    return [not failed and not f for failed, f in zip(base, second, strict=True)]


def repeated_words(text):
    w = words(text)
    windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    return len({k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)})


def test_quality_verdicts(spark):
    """Verdicts against brute force: texts of 0 to 200 words, of letters, tables, numbers; no length goes unjudged."""
    rng = np.random.default_rng(8)
    syllables = ["an", "the", "of", "or", "ti", "ra", "el", "un", "is"]
    rows = [(None, None), ("en", ""), ("xx", "one two"), ("en", "| " * 40)]
    for k in range(240):
        n = int(rng.integers(5, 200)) if k % 2 else int(rng.integers(9, 60))
        lang = ["en", "de", "xx", None][k % 4]
        plain = ["".join(rng.choice(syllables, 3)).capitalize() if rng.random() < 0.1 else "".join(rng.choice(syllables, 3)) for _ in range(n)]
        common = [str(x) for x in rng.choice(quality_rules.COMMON_WORDS["de" if lang == "de" else "en"], n)]
        odd = [str(rng.integers(10**8)) if k % 7 == 0 else "|#" * int(rng.integers(1, 4)) for _ in range(n)]
        share = [0.0, 0.0, 0.0, 0.5, 0.95][k % 5]
        rows.append((lang, " ".join(o if rng.random() < share else c if rng.random() < 0.4 else p for p, c, o in zip(plain, common, odd, strict=True))))
    table = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")
    found = by_id(quality_rules.judge(table, ["doc_id"]), "kept", "base_failed", "n_words")
    expected = brute_verdicts(rows, quality_rules.COMMON_WORDS)
    assert {i: kept for i, (kept, _, _) in found.items()} == dict(enumerate(expected))
    # some are rejected by distance alone, at either length
    far = [n for kept, failed, n in found.values() if not kept and not failed]
    assert min(far) < 60 < max(far) and sum(expected) > 100


def test_js_distance(spark):
    row = spark.range(1).select(
        quality_rules.js_distance(F.array(F.lit(3), F.lit(1)), F.lit(4), [3, 1]).alias("same"),
        quality_rules.js_distance(F.array(F.lit(4), F.lit(0)), F.lit(4), [0, 9]).alias("apart"),
        quality_rules.js_distance(F.array(F.lit(0)), F.lit(0), [1]).alias("none"),
    ).first()
    assert row.same == pytest.approx(0) and row.apart == pytest.approx(1) and row.none is None


def test_sentencepiece(docs, texts, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MERGE_VOCABULARY)
    done = pieces.encode_decode(docs, MERGE_VOCABULARY, ["doc_id", "ids", "key"])
    for row in done.collect():
        expected = library.encode(texts[row.doc_id] or "", add_eos=True)
        assert row.ids == expected and row.decoded == library.decode(expected)
    assert pieces.encode_decode(empty, MERGE_VOCABULARY, ["doc_id"]).count() == 0


def test_token_counts(docs, texts, empty):
    scores = token_counts.unigram_scores(MERGE_VOCABULARY)
    unknown, longest = min(scores.values()) - token_counts.UNKNOWN_PENALTY, max(map(len, scores))

    def best(token):
        table = [(0.0, 0)]
        for end in range(1, len(token) + 1):
            options = []
            for start in range(max(0, end - longest), end):
                score = scores.get(token[start:end])
                if score is not None:
                    options.append((table[start][0] + score, table[start][1] - 1))
            if token[end - 1] not in scores:
                n = len(token[end - 1].encode())
                options.append((table[end - 1][0] + unknown, table[end - 1][1] - n))
            table.append(max(options))
        return -table[-1][1]

    cut = pieces.pieces(MERGE_VOCABULARY).parts
    expected = {i: (len(p := cut(t or "")), sum(map(best, p))) for i, t in enumerate(texts) if len(t or "") < 4000}
    found = by_id(token_counts.token_counts(docs, MERGE_VOCABULARY, ["doc_id"]), "n_pretokens", "n_tokens")
    assert {i: found[i] for i in expected} == expected and len(found) == len(texts)
    assert token_counts.token_counts(empty, MERGE_VOCABULARY, ["doc_id"]).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 999, dtype=np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits), len(ids), bits) == ids).all()
    assert len(token_files.pack(ids, bits)) == -(-len(ids) * bits // 8)


def test_random_access(tmp_path):
    from pyarrow import fs

    r = np.random.default_rng(0)
    rows = [(None if k == 2 else k * 7, r.integers(0, 5000, n, dtype=np.uint32)) for k, n in enumerate((0, 1, 9000, 4096, 3))]
    with fs.LocalFileSystem().open_output_stream(str(tmp_path / "x.ids")) as sink:
        writer = token_files.Writer(sink, 13)
        for name, ids in rows:
            writer.add([name], ids, np.array([len(ids)]))
        writer.close()
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x.ids")) as source:
        reader = token_files.Reader(source)
        whole = np.concatenate([ids for _, ids in rows])
        assert [(n, i.tolist()) for n, _, i in reader.documents()] == [(n, i.tolist()) for n, i in rows]
        for begin, end in ((0, 0), (0, 5), (4095, 4097), (5000, 13100), (len(whole) - 1, len(whole))):
            assert (reader.ids(begin, end) == whole[begin:end]).all()


def test_token_files(spark, docs, texts, empty, tmp_path):
    library = Tokenizer.from_file(BYTE_VOCABULARY)
    library.encode_special_tokens = True
    token_files.write_token_files(docs, BYTE_VOCABULARY, f"file://{tmp_path}/a", end_id=2)
    found = {r.doc_id: (r.start, bytes(r.ids)) for r in token_files.read_token_files(spark, f"file://{tmp_path}/a").collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert found[i][0] == at and zlib.crc32(found[i][1]) == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)
    token_files.write_token_files(empty, BYTE_VOCABULARY, f"file://{tmp_path}/b", end_id=2)
    assert token_files.read_token_files(spark, f"file://{tmp_path}/b").count() == 0


def test_token_files_with_added_tokens(spark, tmp_path):
    library = Tokenizer.from_file(BYTE_VOCABULARY)
    token = "<|endoftext|>"
    quoting = ["end <|endoftext|> x", token, f" {token}", f"a{token} b", f"{token}{token}  c", f"a\n {token}\n", "<|endof text|>", f"plain <| {token[:-1]}", f"say {token}, {token} twice"]
    docs = spark.createDataFrame(list(enumerate(["plain text", *quoting])), "doc_id long, text string").repartition(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op9_token_files(spark, str(tmp_path)).collect()}
    assert library.encode(quoting[0], add_special_tokens=False).ids == [437, 220, 50256, 2124]
    at, expected = 0, {}
    for i, t in enumerate(["plain text", *quoting]):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        expected[i] = (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert found == expected


def test_line_dedup(spark, empty):
    rows = [(i, "  menu \nown line %d\n\nmenu" % i if i < 8 else "own %d\nmenu" % i, "hot" if i < 20 else None) for i in range(40)]
    rows += [(100, None, "hot"), (101, "", "hot"), (102, "menu", "small")]
    pages = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = by_id(line_dedup.without_boilerplate(pages, F.col("source"), ["doc_id"]), "n_lines", "n_dropped", "kept_text")
    assert found[3] == (3, 2, "own line 3\n") and found[25] == (2, 1, "own 25")
    assert found[100] == (0, 0, None) and found[101] == (0, 0, "") and found[102] == (1, 0, "menu")
    assert line_dedup.without_boilerplate(empty, F.col("source"), ["doc_id"]).count() == 0
    assert line_dedup.documents_without_boilerplate(pages, F.col("source")).columns == pages.columns


def test_isotonic():
    assert quality_model.isotonic(np.array([0.2, 0.1, 0.9, 0.5]), np.array([1, 3, 1, 1])).tolist() == pytest.approx([0.125, 0.125, 0.7, 0.7])


def test_quality_model(spark, docs, empty):
    r = random.Random(5)
    good = [(i, sentence(r, r.randint(20, 90)) + ".") for i in range(150)]
    bad = [(150 + i, " ".join(w + "***" for w in sentence(r, r.randint(20, 90)).split())) for i in range(150)]
    table = spark.createDataFrame(good + bad + [(500, None), (501, "")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(3, 1), (None, 1), (7, None)], "doc_id long, quality int")
    train = F.col("doc_id") % 3 != 0
    scored = quality_model.quality_scores(table, labels, ["doc_id"], train)
    found = by_id(scored, "score", "predicted")
    held_out = range(0, 300, 3)
    assert np.mean([found[i][1] == int(i < 150) for i in held_out]) > 0.97
    assert all(0 <= score <= 1 for score, _ in found.values()) and found[500] == found[501]
    other = quality_model.quality_scores(table.repartition(9), labels, ["doc_id"], train)
    assert by_id(other, "score", "predicted") == found  # however the rows are dealt out
    nothing = quality_model.quality_scores(docs, labels.where("false"), ["doc_id"], train)
    assert {row.score for row in nothing.collect()} == {0.5}
    assert quality_model.quality_scores(empty, labels, ["doc_id"], train).count() == 0


def test_decontamination(spark, docs, empty):
    r = random.Random(8)
    items = [(k, ". ".join(sentence(r, 9) for _ in range(4)) + ".") for k in range(30)]
    rows, leaked = [], set()
    for i in range(120):
        text = sentence(r, r.randint(5, 120))
        if i % 4 == 0:
            w = items[i % 30][1].split()
            if i % 8 == 0:  # every sixth word replaced
                w = [sentence(r, 1) if k % 6 == 5 else x for k, x in enumerate(w)]
            own = " ".join(w)
            text = f"{text} {own.upper() if i % 12 == 0 else own} {sentence(r, 40)}"
            leaked.add(i)
        rows.append((i, text))
    table = spark.createDataFrame(rows + [(500, None), (501, "")], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items + [(99, ""), (98, None)], "item_id long, text string")
    found = by_id(decontaminate.contamination(table, benchmark, ["doc_id"]), "contaminated", "item_id")
    assert {i for i, v in found.items() if v[0]} == leaked
    assert all(found[i][1] == i % 30 for i in leaked) and len(found) == 122
    assert decontaminate.clean_documents(docs, benchmark.where("false")).count() == docs.count()
    assert decontaminate.contamination(empty, benchmark, ["doc_id"]).count() == 0


def test_copies_of_a_benchmark_larger_than_the_space(spark):
    r = random.Random(12)

    def text(n):
        return " ".join(f"w{r.randrange(40_000)}" for _ in range(n))

    items = [(k, text(36)) for k in range(3000)]
    rows = [(i, f"{text(50 + i % 16)} {items[i * 25][1]} {text(50)}") for i in range(120)]
    rows += [(200 + i, text(140)) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    found = by_id(decontaminate.contamination(table, benchmark, ["doc_id"]), "contaminated", "item_id", "overlap")
    assert {i: v for i, v in found.items() if v[0]} == {i: (True, i * 25, 1.0) for i in range(120)}


def test_decontamination_checks_every_passage(spark):
    r = random.Random(21)
    vocabulary = [f"w{n}" for n in range(3000)]
    often = [f"o{n}" for n in range(12)]

    def text(n):
        return [r.choice(often if r.random() < 0.4 else vocabulary) for _ in range(n)]

    sizes = [4, 6, 9, 14, 18, 24, 30, 36, 45, 80]
    items = [text(sizes[k % 10]) for k in range(20)]
    rows = []
    for i in range(80):  # copies with 20 to 50 % of the words replaced, anywhere in a text
        own = [text(1)[0] if k < len(items[i % 20]) - 2 and r.random() < 0.2 + i % 4 / 10 else w for k, w in enumerate(items[i % 20])]
        rows.append((i, " ".join(text(r.randint(0, 90)) + own + text(r.randint(0, 90)))))
    table = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    weights = decontaminate.inverse_frequencies(table)

    def values(t):
        return next(slices(pa.array([t]), marks=True)).values

    own = [values(" ".join(w)) for w in items]
    expected = {500: (0.0, False), 501: (0.0, False)}
    for i, t in rows:
        best, leaked, doc = 0.0, False, values(t)
        for item in own:
            weight = weights[decontaminate._features(item)]
            for start in decontaminate._starts(len(doc)):
                around = doc[max(start - len(item) // 2, 0) : start + decontaminate.WINDOW + len(item)]
                share = round(decontaminate.common_share(item, around, weight), 6)
                # without a mark that ends a sentence the whole item is its answer
                best, leaked = max(best, share if share >= 0.45 else 0.0), leaked or share >= 0.6
        expected[i] = (best, leaked)
    found = by_id(decontaminate.contamination(table, benchmark, ["doc_id"]), "overlap", "contaminated")
    assert found == expected and sum(v[1] for v in expected.values()) > 50


def test_common_share():
    item, weight = np.array([1, 2, 3, 4]), np.array([1.0, 2.0, 1.0, 4.0])
    assert decontaminate.common_share(item, np.array([4, 9, 2, 1, 3]), weight) == 4 / 8
    assert decontaminate.common_share(item, np.array([1, 9, 2, 4]), weight) == 7 / 8


def test_marginals_are_exact():
    """Message passing against the sum over all assignments."""
    tree = parse("<div class=nav><a href=x>go</a></div><article><p>text here.<p>more</article>")
    forest = html_extract.Forest.of([tree])
    r = np.random.default_rng(1)
    model = html_extract.Model(r.normal(size=forest.x.shape[1]), r.normal(size=(2, 2, 2)))
    n = len(tree.tags)
    total, hits = 0.0, np.zeros(n)
    for code in range(1 << n):
        y = [(code >> k) & 1 for k in range(n)]
        energy = sum(forest.x[k] @ model.weights for k in range(n) if y[k])
        energy += sum(model.edges[forest.kinds[k], y[tree.parents[k]], y[k]] for k in range(1, n))
        total += np.exp(energy)
        hits += np.exp(energy) * np.array(y)
    assert html_extract.marginals(forest, model)[0] == pytest.approx(hits / total)


def test_html_on_held_out_layouts():
    pages = html_extract.labelled_pages(120, seed=77)
    trees = [parse(p) for p in pages]
    forest = html_extract.Forest.of(trees)
    truth = np.concatenate([t.labels for t in trees])[forest.kinds == 1]
    said = html_extract.marginals(forest, html_extract.default_model())[0][forest.kinds == 1] >= 0.5
    assert (said == truth).mean() > 0.95


def test_html(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies.</div>"
        "<article><h1>Title &amp; more</h1><p><b>First   line.<br><p>Second&nbsp;line, longer than the first one.</p>"
        "<div class=ad>Buy now</div><p>Last &lt;p&gt; line</article>"
        "<section class='comments'><p>I liked it very much.</p></section><footer>&copy; 2020</footer></body>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<nav><a href=x>x</a></nav>"), (1, "u", page), (5, "t", page[: page.index("Last")] + "La &am<p")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    found = collections.Counter(map(tuple, html_extract.main_text(table, ["page_id", "url", "text"]).collect()))
    text = "Title & more\n\nFirst line.\n\nSecond line, longer than the first one."
    whole = f"{text}\n\nLast <p> line"
    assert found[(1, "u", whole, len(whole))] == 2
    assert found[(2, None, "", 0)] == found[(3, "v", "", 0)] == found[(4, "w", "", 0)] == 1
    cut = f"{text}\n\nLa &am"
    assert found[(5, "t", cut, len(cut))] == 1
    assert html_extract.main_text(table.where("false"), ["page_id"]).count() == 0


def test_pipeline(spark, docs, texts, tmp_path):
    """run() against its stages by brute force; every stage copes with odd rows and an empty table."""
    folder = str(tmp_path)
    columns = docs.select("doc_id", "text", "lang", "source", "n_chars")
    columns.write.parquet(f"{folder}/documents.parquet")
    item = " ".join(texts[60].split()[:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()}
    judged = by_id(quality_rules.judge(docs, ["doc_id"]), "kept")
    left = {i: texts[i] for i, (kept,) in judged.items() if kept}
    hosts = collections.Counter(i % 3 for i in left)
    lines = collections.Counter((i % 3, x) for i, t in left.items() for x in {y.strip(" \t\n\x0b\f\r") for y in t.split("\n")} if x)
    often = {k for k, n in lines.items() if n >= 5 and n > 0.07 * hosts[k[0]]}
    left = {i: "\n".join(x for x in t.split("\n") if (i % 3, x.strip(" \t\n\x0b\f\r")) not in often) for i, t in left.items()}
    rows = spark.createDataFrame(sorted(left.items()), "doc_id long, text string")
    kept = {i for i, (k,) in by_id(near_dup.near_duplicates(rows), "kept").items() if k}
    leak = {i for i in kept if item.lower() in left[i].lower()}
    library = sentencepiece.SentencePieceProcessor(model_file=MERGE_VOCABULARY)
    expected = {}
    for i in kept - leak:
        ids = library.encode(left[i], add_eos=True)
        expected[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert leak and found == expected
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, columns.where("false"), folder)
        assert out.count() == 0 and (k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns.columns)
