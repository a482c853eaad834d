"""SimHash, line dedup, repeated passages, packing, mixing and quality against brute force."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesmart.llm import linededup, mixing, packing, quality, simhash, substring
from salesmart.llm.components import components
from salesmart.llm.queries import oracle_sql, queries

from . import brute
from .conftest import EDGE, PROSE, SCHEMA, sorted_rows


def some(sample):
    return [tuple(r) for r in sample.select("doc_id", "text", "lang", "source").collect()]


def near_copies():
    """Copies of copies, a few words apart."""
    draw = random.Random(3)
    rows = []
    for g in range(12):
        words = [f"{draw.choice('abcdefgh')}{draw.randrange(50)}" for _ in range(300)]
        for c in range(6):
            words = list(words)
            for _ in range(draw.randrange(3)):
                words[draw.randrange(300)] = f"z{draw.randrange(99)}"
            rows.append((g * 100 + c, " ".join(words), "en", f"s{c % 2}"))
    return rows


# --- SimHash


@pytest.mark.parametrize("rows", [EDGE, near_copies()], ids=["edge", "near"])
def test_simhash_equals_brute_force(docs, rows):
    found = simhash.near_duplicates(docs(rows))
    prints = [brute.fingerprint(r[1]) for r in rows]
    groups = {}
    roots = brute.components(prints)
    for r, root in zip(rows, roots):
        groups.setdefault(root, []).append(r[0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    expected = [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, roots)]
    assert sorted_rows(found, "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)


def test_simhash_of_nothing(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.drop_near_duplicates(docs([])).count() == 0


def test_one_document_of_each_group_stays(docs):
    rows = near_copies() + EDGE
    kept = simhash.drop_near_duplicates(docs(rows))
    assert kept.columns == docs(rows).columns
    # The two sets of rows share ids, so a group is told by its root.
    groups = set(sorted_rows(simhash.near_duplicates(docs(rows)), "root", "component_id"))
    ids = [(r.doc_id,) for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted(((g[1],) for g in groups), key=repr)


def test_rows_of_one_id_in_different_groups_stay(docs):
    rows = [(1, "one text about the sea and its boats", "en", "a"), (1, PROSE, "en", "a")]
    kept = simhash.drop_near_duplicates(docs([*rows, (2, PROSE, "en", "a")]))
    assert sorted_rows(kept, "doc_id", "text") == sorted(r[:2] for r in rows)


def test_tree_finds_all_pairs(spark):
    draw = np.random.default_rng(5)
    centres = draw.integers(0, 2**63, 60, np.uint64)
    points = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(d)) for c in centres
              for a, b, d in draw.integers(0, 64, (40, 3))}
    points = sorted(points)
    frame = spark.createDataFrame(
        [(p - 2**64 if p >= 2**63 else p,) for p in points], "fingerprint bigint"
    )
    links = simhash.near_links(frame, 2, shard_points=100)
    assert links.count() < 4 * len(points)
    roots = {r.node % 2**64: r.root for r in components(links).collect()}
    expected = brute.components(points)
    same = Counter((e, roots.get(p, p)) for p, e in zip(points, expected))
    assert len(same) == len(set(expected)) == len({r for _, r in same})


def test_chunks_of_a_large_shard_find_all_pairs(spark, monkeypatch):
    """Points so close that no vantage point separates them well."""
    monkeypatch.setattr(simhash, "MOST_POINTS", 150)
    points = sorted({0} | {1 << a | 1 << b for a in range(64) for b in range(a)} | {1 << a for a in range(64)})
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in points], "fingerprint bigint")
    links = simhash.near_links(frame, 2, shard_points=5_000)
    assert {r.root for r in components(links).collect()} == {min(p - 2**64 if p >= 2**63 else p for p in points)}
    draw = np.random.default_rng(8)
    points = sorted({int(x) for x in draw.integers(0, 2**20, 1500)})
    frame = spark.createDataFrame([(p,) for p in points], "fingerprint bigint")
    roots = {r.node: r.root for r in components(simhash.near_links(frame, 2, shard_points=5_000)).collect()}
    expected = brute.components(points)
    same = Counter((e, roots.get(p, p)) for p, e in zip(points, expected))
    assert len(same) == len(set(expected)) == len({r for _, r in same})


def test_every_shard_pair_has_a_home():
    draw = np.random.default_rng(6)
    points = np.unique(draw.integers(0, 2**12, 900, np.uint64))
    nodes = simhash.build_tree(points, 50, 2)
    pairs = set()
    for _, part, home in simhash.route(points, nodes, 2):
        for a, b in simhash.linked_blocks(part, home, 2):
            pairs |= {frozenset(p) for p in zip(part[a].tolist(), part[b].tolist())}
    every = {frozenset((int(a), int(b))) for a in points for b in points
             if a != b and (int(a) ^ int(b)).bit_count() <= 2}
    assert pairs == every


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, 1001 + i) for i in range(500)] + [(5, 5)]
    found = components(spark.createDataFrame(chain + hub, "a bigint, b bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1501)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- Lines


def test_lines_equal_brute_force(docs):
    found = linededup.drop_lines(docs())
    expected = brute.drop_lines([r[:2] for r in EDGE])
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == sorted(expected, key=repr)
    assert linededup.drop_lines(docs([])).count() == 0


def test_a_line_in_most_documents_is_salted(docs):
    rows = [(i, f"the very same line\nline of its own {i}", "en", "a") for i in range(3000)]
    rows += [(5000, "only here, many times\n" * 3000, "en", "a")]
    found = linededup.drop_lines(docs(rows, clashing=False))
    expected = brute.drop_lines([r[:2] for r in rows])
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == sorted(expected, key=repr)


def test_bitmaps_hold_only_words_with_dropped_lines(docs):
    lines = [f"line number {i} of the text" for i in range(200)]
    rows = [(1, lines[150], "en", "a"), (2, "\n".join(lines), "en", "a")]
    (found,) = linededup.keep_bitmaps(docs(rows)).collect()
    assert [(w.word, ~w.bits) for w in found.words] == [(150 // 64, 1 << 150 % 64)]


def test_a_text_of_very_many_lines(docs):
    lines = [f"line number {i} of a long text" for i in range(200_000)]
    shared = "\n".join(lines[i] for i in (0, 63, 64, 77_777, 199_999))
    rows = [(1, shared, "en", "a"), (2, "\n".join(lines), "en", "a"), (3, "\n".join(lines[:130]) + "\nown line here", "en", "a")]
    found = linededup.drop_lines(docs(rows, clashing=False))
    expected = brute.drop_lines([r[:2] for r in rows])
    assert sorted_rows(found, "doc_id", "n_lines", "n_dropped", "text") == sorted(expected, key=repr)


@pytest.mark.parametrize("name", ["op7_poisson_mixing", "op8_line_dedup"])
def test_native_query_equals_sql(spark, testdata, name):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from read_parquet('{testdata}/documents.parquet')")
    frame = queries()[name](spark, testdata)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "InArrow", "InPandas", "NestedLoop", "Cartesian"))
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted_rows(frame, *columns) == sorted(result.fetchall(), key=repr)


# --- Passages


def test_passages_equal_brute_force(docs):
    found = substring.remove_repeats(docs())
    expected = brute.remove_repeats([r[:2] for r in EDGE])
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "text") == sorted(expected, key=repr)
    assert substring.remove_repeats(docs([])).count() == 0


def thue_morse(n):
    """A word of two letters and its complement, which polynomials modulo 2 to the 64 take for one."""
    ones = [i.bit_count() & 1 for i in range(n)]
    return "".join("ab"[x] for x in ones), "".join("ba"[x] for x in ones)


def test_different_words_of_one_polynomial_hash(docs):
    one, other = thue_morse(1024)
    around = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join([*around, one, *around[::-1]]), "en", "a"), (2, " ".join([*around, other, *around[::-1]]), "en", "a")]
    rows += [(3, " ".join([*"abcdefg", one, *"hijklmn", *"abcdefg", other, *"hijklmn"]), "en", "a")]
    rows += [(4, "x" * 5_000 + " " + " ".join(around * 2), "en", "a"), (5, "x" * 4_999 + " " + " ".join(around * 2), "en", "a")]
    found = substring.remove_repeats(docs(rows))
    expected = brute.remove_repeats([r[:2] for r in rows])
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "text") == sorted(expected, key=repr)
    assert [r[2] for r in expected[:2]] == [0, 0]
    counts = {r.doc_id: r.n_repeat_words for r in quality.judge(docs(rows)).collect()}
    assert counts == {r[0]: brute.base_counts(r[1])[4] for r in rows} and counts[3] == 0


def test_passages_are_compared_word_by_word(docs, monkeypatch):
    """With word hashes that all meet, nothing but the work changes."""
    from salesmart.llm.common import Words

    monkeypatch.setattr(Words, "hashes", lambda self, seed: self.row.astype(np.uint64) * np.uint64(0) + np.uint64(5))
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choices("abc", k=40)), "en", "a") for i in range(30)]
    found = substring.remove_repeats(docs(rows), size=7, short=3)
    expected = brute.remove_repeats([r[:2] for r in rows], 7)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "text") == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_passages_of_few_words(docs, seed):
    """Periodic texts, passages that start and end in the middle of others, copies."""
    draw = random.Random(seed)
    passage = [draw.choice("abcdefgh") for _ in range(40)]
    rows = []
    for i in range(60):
        words = [draw.choice("abcdefghijkl"[: 2 + i % 10]) for _ in range(draw.randrange(60))]
        at = draw.randrange(30)
        words += passage[at : at + draw.randrange(20)] + words[: draw.randrange(12)]
        rows.append((i // 2, " ".join(words), "en", "a"))
    found = substring.remove_repeats(docs(rows), size=7, short=3)
    expected = brute.remove_repeats([r[:2] for r in rows], 7)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "text") == sorted(expected, key=repr)


# --- Packing


def test_pieces_are_the_tokenizers_ids(docs, tokenizer):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer[0]).encode
    rows = [*EDGE, (20, "a<|endoftext|>b", "en", "a"), (21, "число 数字 ١٢", "ru", "a")]
    found = packing.pack(docs(rows), *tokenizer, ids=True)
    pieces = found.collect()
    got = Counter()
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        got[(p.doc_id, p.start, tuple(p.ids), p.doc_tokens)] += 1
    expected = Counter()
    for doc, text, *_ in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 2048):
            expected[(doc, k, tuple(ids[k : k + 2048]), len(ids))] += 1
    assert got == expected
    check_sequences(pieces)
    assert packing.pack(docs([]), *tokenizer).count() == 0


def check_sequences(pieces, window=2048):
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert filled.get(p.sequence_id, 0) == p.offset
        filled[p.sequence_id] = p.offset + p.length
        assert filled[p.sequence_id] <= window
    return filled


def test_little_padding_and_groups(sample, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 60)
    filled = check_sequences(packing.pack(sample, *tokenizer).collect())
    assert sum(filled.values()) / (2048 * len(filled)) > 0.9


def test_groups_of_a_task_hold_all_rows_in_order():
    for rows in (0, 1, 7, 8, 40, 41):
        for step in (1, 3, 50):
            batches = [
                pa.RecordBatch.from_arrays([pa.array(range(k, min(rows, k + step)), pa.int64())], ["x"])
                for k in range(0, max(rows, 1), step)
            ]
            groups = [g.column("x").to_pylist() for g in packing.in_groups(iter(batches), 4)]
            assert [x for g in groups for x in g] == list(range(rows))
            assert all(len(g) == 4 for g in groups[:-1]) and all(0 < len(g) < 8 for g in groups)


def test_several_groups_a_task(sample, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 10)
    monkeypatch.setattr(packing, "TASK_GROUPS", 7)
    assert sum(check_sequences(found := packing.pack(sample, *tokenizer).collect()).values()) == sum(
        p.length for p in found
    )
    assert len({p.sequence_id >> 32 for p in found}) < len(found) / 10


def test_best_fit_decreasing():
    draw = random.Random(1)
    for window in (16, 100, 128):
        lengths = np.array([draw.randint(1, window) for _ in range(400)])
        sequence, offset = packing.best_fit(lengths, window)
        rooms = [window - int(lengths[sequence == s].sum()) for s in range(sequence.max() + 1)]
        assert sorted(rooms) == brute.best_fit(lengths.tolist(), window)


def test_packing_does_not_depend_on_the_order_of_rows(docs, tokenizer):
    rows = [(i % 40, f"some words {'and more ' * (i % 30)}", "en", "a") for i in range(200)]
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    found = [
        sorted_rows(packing.pack(docs(order), *tokenizer, window=64), *columns)
        for order in (rows, rows[::-1], random.Random(3).sample(rows, len(rows)))
    ]
    assert found[0] == found[1] == found[2]


# --- Mixing


@pytest.mark.parametrize(
    ("weights", "epochs"),
    [(None, 1.0), ({"a": 3.0, "b": 1.0}, 2.0), ({None: 1.0}, 1.0), ({"none": 1.0}, 1.0)],
)
def test_copies_equal_brute_force(docs, weights, epochs):
    rows = EDGE + [(i, f"t {i}", "en", "abc"[i % 3]) for i in range(30, 330)]
    found = mixing.mix(docs(rows), weights, epochs)
    got = Counter((r.doc_id, r.text, r.copy) for r in found.collect())
    if weights and not any(r[3] in weights for r in rows):
        assert not got
        return
    assert got == brute.copies([(r[0], r[1], r[3]) for r in rows], mixing.SEED, weights, epochs)
    assert mixing.mix(docs([])).count() == 0


def test_rates_reach_the_weights(spark):
    rows = [(i, "x" * 100, "en", "big" if i % 10 else "small") for i in range(20_000)]
    made = spark.createDataFrame([(*r, 100) for r in rows], SCHEMA)
    found = mixing.mix(made, {"big": 1.0, "small": 1.0}).groupBy("source").count().collect()
    assert all(abs(r["count"] - 10_000) < 400 for r in found)


def test_documents_without_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text {i}", "en", "a", 9) for i in range(20_000)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    per_text = Counter(r.text for r in found.select("text").collect())
    assert sum(per_text.values()) == pytest.approx(20_000, rel=0.03)
    assert 0.36 < 1 - len(per_text) / 20_000 < 0.38
    parts = found.repartition(16, "shuffle_key", F.xxhash64("text")).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in parts.collect()) < 2 * sum(per_text.values()) / 16
    # Rows of one id are spread as well.
    rows = [(7, f"text {i}", "en", "a", 9) for i in range(4_000)]
    one = mixing.mix(spark.createDataFrame(rows, SCHEMA)).groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in one.collect()]
    assert not counts or max(counts) < 2 * sum(counts) / len(counts)


def test_mixing_equals_sql_with_odd_rows(docs):
    rows = [r for r in EDGE if len(r[1] or "") < 99_999]
    rows += [(None, f"t {i}", "en", "abc"[i % 3]) for i in range(200)] + [(None, "no source " * 50, "en", None)] * 3
    made = docs(rows, clashing=False)
    duck = duckdb.connect()
    duck.register("documents", made.toArrow())
    columns = ["doc_id", "lang", "source", "copy", "shuffle_key", "text"]
    expected = duck.execute(f"select {', '.join(columns)} from ({oracle_sql()['op7_poisson_mixing']})").fetchall()
    assert sorted_rows(mixing.mix(made), *columns) == sorted(expected, key=repr)


# --- Quality


def judged(rows, found):
    expected = brute.quality(
        rows, list(quality.FLOORS.values()), quality.SHARE, quality.STEPS, quality.CUTOFF,
        quality.MIN_GROUP, quality.HALF_WORDS, quality.chi_square_quantile(quality.SHARE),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted_rows(found, "doc_id", *counts, "kept", F.round("distance", 4))
    wanted = [
        (r[0], *brute.base_counts(r[1]), bool(k), None if np.isnan(d) else float(d))
        for r, (_, k, d) in zip(rows, expected)
    ]
    for a, b in zip(got, sorted(wanted, key=repr), strict=True):
        assert a[:-1] == b[:-1]
        assert (a[-1] is None) == (b[-1] is None)
        assert a[-1] is None or a[-1] == pytest.approx(b[-1], abs=2e-3, rel=1e-3)
    return expected


def test_quality_of_odd_rows(docs):
    judged(EDGE, quality.judge(docs()))
    assert quality.judge(docs([])).count() == 0
    assert quality.keep_good(docs([])).count() == 0


def test_quality_equals_brute_force(sample):
    rows = some(sample)
    expected = judged(rows, quality.judge(sample))
    assert any(not k and not b for b, k, _ in expected)
    kept = sorted(r.doc_id for r in quality.keep_good(sample).collect())
    assert kept == sorted(r[0] for r, (_, k, _) in zip(rows, expected) if k)


def test_a_block_of_alike_junk_does_not_capture_a_group(docs):
    """A third of the rows is one kind of junk, far from the others and nearly alike."""
    draw = random.Random(4)
    words = ["stone", "river", "a", "of", "winter", "the", "garden", "light", "over", "and", "mountain", "we"]
    good = [" ".join(draw.choices(words, k=draw.randrange(60, 120))).capitalize() + "." for _ in range(400)]
    junk = [" ".join(f"BUY{draw.randrange(9999)} $$$ !!! XXL;" for _ in range(25)) for _ in range(200)]
    rows = [(i, t, "en", "a") for i, t in enumerate(good + junk)]
    draw.shuffle(rows)
    kept = {r.doc_id for r in quality.judge(docs(rows)).where("kept").collect()}
    assert not kept & set(range(400, 600))
    assert len(kept & set(range(400))) >= 396


def test_a_small_rest_is_judged_by_all_rows(docs):
    draw = random.Random(5)
    words = ["stone", "river", "a", "of", "winter", "the", "garden", "light", "over", "and"]
    rows = [(i, " ".join(draw.choices(words, k=80)) + ".", "en", "a") for i in range(120)]
    rows += [(200, " ".join(draw.choices(words, k=80)) + ".", "xx", "other")]
    rows += [(201, "$$$ &&& ### !!! " * 3 + " ".join(f"UPPER{i}" for i in range(30)), "yy", None)]
    found = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    assert found[200].kept and not found[201].kept
    assert found[201].distance is not None
    judged(rows, quality.judge(docs(rows)))


def test_labelled_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"))
    both = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 20")
    rows = both.select("quality", "kept").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) > 0.9 * sum(r.quality == 0 for r in rows)


def test_short_junk_is_rejected(spark):
    """The bounded sample that cutoff and shrinkage were chosen on, short texts apart."""
    sf = "/root/testdata/sf0.1"
    found = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).where("not base_failed")
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    kept = Counter((r.quality, r.n_words < 80) for r in rows if r.kept)
    all_ = Counter((r.quality, r.n_words < 80) for r in rows)
    assert (kept[1, True], kept[1, False]) == (all_[1, True], all_[1, False])
    assert kept[0, False] == 0 and kept[0, True] <= 3


def test_equal_rows_are_no_outliers(docs):
    text = " ".join(f"word{i}" for i in range(50))
    found = quality.judge(docs([(i, text, "en", "a") for i in range(200)]))
    assert found.where("kept").count() == 200
