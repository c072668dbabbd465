"""Operators against brute force on small fixtures, and the cases their docstrings define."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskstream.llm import (
    common,
    licences,
    mixing,
    packing,
    passages,
    quality_classifier,
    quality_rules,
    queries,
    set_sketch,
    toxicity,
    vector_index,
)
from riskstream.llm.common import Scratch
from tests.conftest import TESTDATA

SMALL = f"{TESTDATA}/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls, empties, repeats, one very long word and text, columns with names of results.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, None), (None, "same words"),
    (None, "same words"), (5, "x" * 100_000), (6, "a b c d e " * 20_000), (7, "a\nb\n\nb\n" * 9),
    (8, "<|endoftext|> ### &&& <s>"), (9, "éßİ \U0001F600 　 z"),
]
CLASH = "n_words long, kept boolean, node long, bucket long, value long, piece int, items binary"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None, 1, True, 2, 3, 4, 5, b"") for i, t in ODD]
    return spark.createDataFrame(rows, f"{DOCS}, {CLASH}")


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def texts(spark, folder=SMALL):
    return dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())


# Quality rules


def base_counts(text):
    words = WORD.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {
        i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)
    }
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(repeated),
        len(words) < 20 or 100 * len(repeated) > 30 * len(words),
    )


def test_quality_counts_equal_brute_force(spark, odd):
    found = queries.op1_quality_rules(spark, SMALL).collect()
    expected = texts(spark)
    assert len(found) == len(expected)
    for row in found:
        assert tuple(row)[1:7] == base_counts(expected[row.doc_id])
        assert not (row.base_failed and row.kept)
    judged = quality_rules.quality_rules(odd, None).collect()
    assert len(judged) == len(ODD)
    for row, (_, text) in zip(judged, ODD, strict=True):
        assert tuple(row)[1:7] == base_counts(text)


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(3)
    for n in range(1, 7):
        field = quality_rules.Field(draw.normal(size=3), draw.normal(size=(2, 2)))
        x = draw.normal(size=(n, 3))
        paths = [[(k >> i) & 1 for i in range(n)] for k in range(2**n)]

        def score(path):
            own = sum((x[i] @ field.weights) * label for i, label in enumerate(path))
            return own + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

        assert quality_rules.viterbi(field, x).tolist() == max(paths, key=score)


def test_field_gradient_equals_differences():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(3, 4, 2)), draw.integers(0, 2, (3, 4)).astype(float)
    mask = np.array([[1, 1, 1, 1], [1, 1, 1, 0], [1, 0, 0, 0]], bool)
    y *= mask
    field = quality_rules.Field(draw.normal(size=2), draw.normal(size=(2, 2)))

    def likelihood(weights, moves):
        total = 0.0
        for d in range(3):
            n = int(mask[d].sum())

            def score(path):
                own = sum((x[d, i] @ weights) * label for i, label in enumerate(path))
                return own + sum(moves[int(a), int(b)] for a, b in zip(path, path[1:]))

            every = [score([(k >> i) & 1 for i in range(n)]) for k in range(2**n)]
            total += score(y[d, :n]) - np.logaddexp.reduce(every)
        return total / mask.sum()

    by_weight, by_move = quality_rules._gradient(field, x, y, mask)
    step = 1e-6
    for i in range(2):
        more = field.weights + step * (np.arange(2) == i)
        slope = (likelihood(more, field.moves) - likelihood(*field)) / step
        assert by_weight[i] == pytest.approx(slope, abs=1e-4)
    for i in range(4):
        more = field.moves + step * (np.arange(4) == i).reshape(2, 2)
        slope = (likelihood(field.weights, more) - likelihood(*field)) / step
        assert by_move.ravel()[i] == pytest.approx(slope, abs=1e-4)


def test_quality_agrees_with_labels(spark):
    folder = f"{TESTDATA}/sf0.01"
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect())
    rows = [r for r in queries.op1_quality_rules(spark, folder).collect() if r.doc_id in labels]
    judged = [(labels[r.doc_id] == 1, r.kept) for r in rows if not r.base_failed]
    assert all(kept for good, kept in judged if good)
    assert sum(not kept for good, kept in judged if not good) >= 0.8 * sum(not g for g, _ in judged)


# Ordinal classifier


def test_thresholds_are_ordered_and_grades_held_out(spark):
    folder = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ratings = queries._ratings(spark.read.parquet(f"{folder}/labels.parquet"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = quality_classifier.learn(docs, ratings.where(fold != 1))
    assert (np.diff(model.thresholds) > 0).all() and len(model.grades) == 3
    judged = quality_classifier.quality_grades(docs, model).join(ratings.where(fold == 1), "doc_id")
    pairs = [(r.grade >= 1, r.kept) for r in judged.collect()]
    assert sum(a == b for a, b in pairs) > 0.9 * len(pairs)


def test_ordinal_chances_add_up():
    model = quality_classifier.Model(np.zeros(1), np.array([-1.0, 2.0]), np.array([0.0, 1.0, 2.0]))
    mean, tail = quality_classifier.grade(model, np.array([0.3]), 1)
    low, high = (1 / (1 + np.exp(-(t - 0.3))) for t in model.thresholds)
    assert tail[0] == pytest.approx(1 - low)
    assert mean[0] == pytest.approx((high - low) + 2 * (1 - high))


# Packing


def brute_pieces(text, tokenizer, capacity):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)] if len(ids) > capacity else [0]
    ends = [*starts[1:], len(ids)]
    return [
        (k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes()))
        for k, (s, e) in enumerate(zip(starts, ends, strict=True))
    ]


@pytest.mark.parametrize("capacity", [7, 2048])
def test_packing_pieces_and_places(spark, odd, capacity):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = odd.select(*DOCS.replace(" long", "").replace(" string", "").split(", "))
    docs = docs.union(spark.read.parquet(f"{SMALL}/documents.parquet").select(docs.columns).limit(30))
    rows = docs.collect()
    found = packing.packed(docs, path, capacity).collect()
    expected = sorted(
        (str(r.doc_id), *p) for r in rows for p in brute_pieces(r.text, library, capacity)
    )
    assert sorted((str(r.doc_id), *tuple(r)[1:5]) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    lengths = np.array([r.length for r in found])
    bound = packing.lower_bound(lengths, capacity)
    assert bound <= len(sequences) <= 1.02 * bound + 1


def test_bound_never_exceeds_the_best_packing():
    draw = random.Random(4)

    def best(items, bins):
        if not items:
            return len(bins)
        found = len(bins) + len(items)
        for i, room in enumerate(bins):
            if items[0] <= room and room not in bins[:i]:
                found = min(found, best(items[1:], bins[:i] + [room - items[0]] + bins[i + 1 :]))
        return min(found, best(items[1:], [*bins, 10 - items[0]]))

    for _ in range(60):
        items = sorted((draw.randint(1, 10) for _ in range(7)), reverse=True)
        exact = best(items, [])
        assert packing.lower_bound(np.array(items), 10) <= exact
        assert packing.best_fit_decreasing(np.array(items), 10)[2] >= exact


def test_partitions_with_gaps_exchange_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 40)
    path = queries.tokenizer("byte_bpe_50k.json")
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 37 + 1).cast("int")).alias("text")
    )
    found = packing.packed(docs, path, 64)
    lengths = np.array([r.length for r in found.collect()])
    used = found.select("sequence_id").distinct().count()
    monkeypatch.setattr(packing, "ROUNDS", 1)
    alone = packing.packed(docs, path, 64).select("sequence_id").distinct().count()
    assert len(lengths) == 400 and used < alone
    assert used <= 1.08 * packing.lower_bound(lengths, 64)


def test_packed_ids_round_trip(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "round trip, été " * 50)], "doc_id long, text string")
    rows = packing.packed(docs, path, 16, keep_ids=True).orderBy("piece").collect()
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    assert Tokenizer.from_file(path).decode(ids[:-1].tolist()) == "round trip, été " * 50


# Mixing


def test_mix_meets_its_targets(spark):
    found = queries.op5_soft_mixing(spark, f"{TESTDATA}/sf0.01").toPandas()
    whole = found.n_words.sum()
    for domain, share in queries.TARGETS.items():
        got = (found.n_words * found.rate * found[f"p_{domain}"]).sum() / whole
        assert got == pytest.approx(share, abs=0.01)
    assert (found.rate >= 0).all()


def test_rates_equal_brute_force_least_squares(spark):
    draw = np.random.default_rng(1)
    p = draw.dirichlet([0.5, 0.5], 40)
    n = draw.integers(1, 100, 40)
    rows = [(i, int(n[i]), float(p[i, 0]), float(p[i, 1])) for i in range(40)]
    members = spark.createDataFrame(rows, "id long, n_words long, p0 double, p1 double")
    rate = mixing.fit_rates(members, [0.8, 0.2])
    found = np.array([r[0] for r in members.select(rate, "id").orderBy("id").collect()])
    # The same objective by many small plain steps.
    whole, share = n.sum(), np.array([0.8, 0.2])
    present = n @ p
    rates = np.ones(40)
    for _ in range(200_000):
        miss = ((n * rates) @ p - share * whole) / present
        rates = np.maximum(0, rates - 0.02 * (p @ miss + mixing.PULL * (rates - 1)))
    assert np.abs((n * found) @ p / whole - share).max() < 0.01
    assert np.abs(found - rates).max() < 0.1


def test_mixing_odd_rows(spark, odd, no_labels):
    scratch = Scratch(spark, "test")
    labels = no_labels
    mixed = mixing.mixed(odd, labels, {"a": 0.5, "b": 0.5}, scratch)
    assert mixed.count() == len({i for i, _ in ODD})
    empty = mixing.mixed(odd.limit(0), labels, {"a": 1.0}, Scratch(spark, "test"))
    assert empty.count() == 0
    twice = mixed.withColumn("copies", F.lit(2))
    copied = mixing.mix_documents(odd, twice)
    assert copied.columns == odd.columns and copied.count() == 2 * len(ODD)


# Near duplicates


def brute_components(rows, words, percent):
    """Component of each row's id, by all pairs."""

    def shingles(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = WORD.findall(low)
        if not found:
            return frozenset()
        if len(found) < words:
            return frozenset([tuple(found)])
        return frozenset(zip(*(found[i:] for i in range(words))))

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                one, two = sorted((top(a), top(b)))
                parent[two] = one
    return {i: (len(sets[i]), top(i)) for i in ids}


def respelt(draw, words, share):
    return " ".join(w if draw.random() > share else f"n{draw.randrange(10**6)}" for w in words)


def test_components_equal_all_pairs(spark):
    """Families of variants that straddle the threshold, among unrelated texts."""
    draw = random.Random(9)
    rows = [(i, " ".join(f"w{draw.randrange(400)}" for _ in range(draw.randrange(0, 60)))) for i in range(150)]
    for family in range(3):
        base = [f"b{family}-{k}" for k in range(120)]
        start = 1000 * (family + 1)
        rows += [(start + k, respelt(draw, base, draw.choice((0.01, 0.04, 0.08)))) for k in range(120)]
    rows += [(9000, "Mixed CASE words"), (9001, "mixed case WORDS"), (9002, ""), (9003, None), (9004, "É a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_components(rows, 2, 80)
    found = set_sketch.near_duplicates(docs, words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_query_equals_all_pairs(spark):
    found = queries.op6_minhash_near_dedup(spark, SMALL).collect()
    expected = brute_components(texts(spark).items(), 2, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(2)
    pool = draw.integers(0, 2**63, 1500).astype(np.uint64)
    one, two = np.unique(pool[:1000]), np.unique(pool[500:])
    a, b, union = set_sketch.sketches([one, two, np.union1d(one, two)])
    assert (np.maximum(a, b) == union).all()
    likely = set_sketch.estimate(a[None], b[None], np.array([len(one)]), np.array([len(two)]))
    assert likely[0] == pytest.approx(1 / 3, abs=0.1)


def test_near_duplicates_odd_rows(spark, odd):
    found = set_sketch.near_duplicates(odd, words=2).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert (by_id[4].n_shingles, by_id[4].component_id) == (1, 4)
    assert set_sketch.near_duplicates(odd.limit(0)).count() == 0
    kept = set_sketch.first_of_each(odd, words=2)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert ids.count(None) == 2  # the empty one, and one of the two alike


GOOD_LINE = "This is a line of the prose that people write and others read with pleasure.\n"
POOR_LINE = "$$ 123 | 456 >>\n"


def near_copies(count):
    """Variants of one text, of which many pairs are just below the threshold or above."""
    draw = random.Random(5)
    source = [f"s{i}" for i in range(150)]
    texts = []
    for i in range(count):
        words = list(source)
        for k in draw.sample(range(150), draw.randint(3, 6)):
            words[k] = f"v{i}x{k}"
        texts.append(" ".join(words))
    return texts


def test_near_copies_that_stay_apart_make_few_candidates(spark, monkeypatch):
    texts = near_copies(300)
    asked = []
    confirmed = set_sketch._confirmed

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(set_sketch, "_confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in set_sketch.near_duplicates(docs, words=2).collect()}
    sets = [set(set_sketch.shingle_set(t, 2).tolist()) for t in texts]
    top = list(range(len(texts)))
    for i, one in enumerate(sets):
        for j in range(i):
            if 100 * len(one & sets[j]) >= 80 * len(one | sets[j]) and top[i] != top[j]:
                low, high = sorted((top[i], top[j]))
                top = [low if x == high else x for x in top]
    assert found == dict(enumerate(top))
    assert sum(asked) <= 2 * len(texts)


def test_middle_equals_brute_force_without_a_join_by_item(spark, monkeypatch):
    draw = random.Random(8)
    rows, sets = [], defaultdict(dict)
    for node in range(120):
        family = node % 3
        common = [i for i in range(12) if draw.random() < 0.7]
        items = [100 * family + i for i in common] + [10_000 * (node + 1) + i for i in range(node % 5)]
        if family == 2:  # nothing that more than half of the family hold
            items = [10_000 * (node + 1) + i for i in range(3)]
        sets[family][node] = set(items)
        rows.append((node, 90, family, family, 90, items, len(items), False))
    apart = spark.createDataFrame(
        rows, "node long, n_shingles long, family long, base long, n_base long, "
        "items array<long>, apart int, near boolean",
    )
    plans = []
    keep = Scratch.keep

    def noted(scratch, frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return keep(scratch, frame, name)

    monkeypatch.setattr(Scratch, "keep", noted)
    roots = spark.createDataFrame([], "node long, root long")
    found = set_sketch._from_middle(apart, roots, 80, Scratch(spark, "middle")).collect()
    assert not [p for p in plans if re.search(r"Join Inner, .*item#", p)]
    bases = {}
    for family, nodes in sets.items():
        held = [x for items in nodes.values() for x in items]
        usual = {x for x in set(held) if 2 * held.count(x) > len(nodes)}
        ways = [(len(x) - 2 * len(x & usual), node) for node, x in nodes.items()]
        bases[family] = min(ways)[1] if min(ways)[0] < 0 else family
    assert len(found) == 120 and bases[2] == 2 and {0, 1}.isdisjoint(bases[f] for f in (0, 1))
    for r in found:
        moved = sets[r.family][bases[r.family]] if r.family < 2 else set()
        assert r.base == bases[r.family]
        assert set(r["items"]) == sets[r.family][r.node] ^ moved and r.apart == len(r["items"])


def test_candidates_just_at_the_threshold(spark):
    # One difference lies in the other: 40 of 360 is what similarity 0.8 leaves.
    rows = [(1, 180, 7, 9, 180, list(range(10)), 10, True),
            (2, 180, 7, 9, 180, list(range(50)), 50, False)]
    apart = spark.createDataFrame(
        rows, "node long, n_shingles long, family long, base long, n_base long, "
        "items array<long>, apart int, near boolean",
    )
    roots = spark.createDataFrame([], "node long, root long")
    rarest = set_sketch._rarest(apart, roots, 80, Scratch(spark, "threshold"))
    pairs = set_sketch._across(rarest, roots, 80)
    assert [tuple(r) for r in pairs.collect()] == [(1, 2)]


def test_candidates_hold_every_link(spark):
    draw = random.Random(3)
    universe = range(60)
    sets = [set(universe) ^ set(draw.sample(range(90), draw.randint(0, 24))) for _ in range(60)]
    base = sets[0]
    rows = []
    for node, one in enumerate(sets):
        items = sorted(one ^ base)
        near = 180 * len(items) <= 20 * (len(one) + len(base))
        rows.append((node, len(one), 7, 0, len(base), items, len(items), near))
    apart = spark.createDataFrame(
        rows, "node long, n_shingles long, family long, base long, n_base long, "
        "items array<long>, apart int, near boolean",
    )
    roots = spark.createDataFrame([(r[0], 0) for r in rows if r[-1]], "node long, root long")
    top = {r[0]: 0 if r[-1] else r[0] for r in rows}
    links = {
        (i, j) for j in range(60) for i in range(j)
        if top[i] != top[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    }
    rarest = set_sketch._rarest(apart, roots, 80, Scratch(spark, "links"))
    pairs = {tuple(r) for r in set_sketch._across(rarest, roots, 80).collect()}
    assert links and links <= pairs


def test_field_is_fitted_to_long_documents(spark):
    rows = [(i, (GOOD_LINE if i % 2 else POOR_LINE) * 900) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    field = quality_rules.learn(docs, labels)
    assert field is not None
    shares = {r.doc_id: r.content_share for r in quality_rules.quality_rules(docs, field).collect()}
    assert all((shares[i] > 0.5) == bool(i % 2) for i in shares)


def test_field_learns_from_the_ends_of_long_documents(spark):
    """The only boilerplate stands after thousands of good lines."""
    rows = [(i, GOOD_LINE * 3000 + ("" if i % 2 else POOR_LINE * 200)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    field = quality_rules.learn(docs, labels)
    features, _ = quality_rules.line_features(GOOD_LINE * 50 + POOR_LINE * 50)
    assert quality_rules.viterbi(field, features).tolist() == [0] * 50 + [1] * 50


def test_chunks_are_spread_over_the_whole_text():
    text = "".join(f"{'word ' * (i + 1)}\n" for i in range(50))
    chunks = quality_rules.taught(text, 3, 4)
    lines = quality_rules.line_features(text)[0].astype(np.float32)
    assert [len(c) for c in chunks] == [3, 3, 3, 2]
    assert (chunks[0] == lines[:3]).all() and (chunks[-1] == lines[-2:]).all()
    assert np.concatenate(quality_rules.taught(text, 3, 99)).shape == lines.shape


def test_padding_is_at_most_half():
    chunks = [np.ones((n, len(quality_rules.FEATURES)), np.float32) for n in (1, 2, 3, 200, 256, 255)]
    groups = quality_rules._padded([(chunks, True)])
    assert sum(g.mask.size for g in groups) <= 2 * sum(map(len, chunks))
    assert sum(int(g.mask.sum()) for g in groups) == sum(map(len, chunks))


# Passages


def test_compact_windows_equal_brute_force():
    draw = np.random.default_rng(7)
    for n in (0, 5, 6, 40):
        items = draw.integers(0, 12, n).astype(np.uint64)
        owners, values, hashes, c, left, right = passages.compact_windows([items], 6)
        for i, seed in enumerate(passages._SEEDS):
            value = passages.mix(items ^ seed)
            least = [int((value[s : s + 6] & passages._HIGH).min()) for s in range(n - 5)]
            runs = []
            for s, v in enumerate(least):
                if s and v == least[s - 1]:
                    runs[-1][1] = s + 5
                else:
                    runs.append([s, s + 5])
            mine = hashes == i
            assert list(zip(left[mine], right[mine])) == [tuple(r) for r in runs]
            for v, at, l, r in zip(values[mine], c[mine], left[mine], right[mine]):
                assert l <= at <= r and value[at].view(np.int64) == v


def planted(draw):
    def filler():
        return [f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(60, 120))]

    rows = {i: filler() for i in range(60)}
    spans = []
    for k in range(12):
        passage = [f"p{k}-{j}" for j in range(draw.randrange(51, 90))]
        for i in draw.sample(range(60), 3):
            rows[i] += passage + filler()
            spans.append((i, k, len(passage)))
    return rows, spans


def test_planted_passages_are_found_and_cut(spark):
    rows, spans = planted(random.Random(11))
    docs = spark.createDataFrame(
        [(i, " ".join(w), 0) for i, w in rows.items()], "doc_id long, text string, n_chars long"
    )
    found = defaultdict(set)
    for r in passages.repeated_passages(docs).collect():
        found[r.doc_id].update(range(r.begin, r.end))
        words = rows[r.doc_id][r.begin : r.end]
        assert sum(w.startswith("p") for w in words) >= 0.75 * len(words)
    first = {}
    for i, k, _ in sorted(spans):
        first.setdefault(k, i)
        if i != first[k]:
            places = [n for n, w in enumerate(rows[i]) if w.startswith(f"p{k}-")]
            assert set(places) <= found[i]
    left = {r.doc_id: r for r in passages.without_repeats(docs).collect()}
    for k, i in first.items():
        mine = [w for w in rows[i] if w.startswith(f"p{k}-")]
        assert mine and all(w in left[i].text.split() for w in mine)
    for i, k, _ in spans:
        if i != first[k]:
            assert not any(w.startswith(f"p{k}-") for w in left[i].text.split())
    touched = {i for i, k, _ in spans}
    for i in set(rows) - touched:
        assert left[i].text == " ".join(rows[i]) and left[i].n_chars == 0


def test_slices_are_taken_in_small_batches_and_other_texts_stay_in_spark(spark, monkeypatch):
    @F.arrow_udf("string")
    def strict(text: pa.Array, spans: pa.Array) -> pa.Array:
        assert all(s.is_valid or not t.is_valid for t, s in zip(text, spans, strict=True))
        return pa.array(
            [
                passages.cut(t.as_py(), [(x["begin"], x["end"]) for x in s.as_py()])
                if s.is_valid else None
                for t, s in zip(text, spans, strict=True)
            ],
            pa.string(),
        )

    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, f"a{i} {passage} b{i}" if i % 2 else f"alone{i}  here") for i in range(40)]
    rows += [(None, passage), (50, None), (51, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(docs)
    # The caller's own batches of whole texts may be of any size.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and found.count() == 19
    monkeypatch.setattr(passages, "_cut", strict)
    kept = {(r.doc_id, r.text) for r in passages.without_repeats(docs).collect()}
    assert kept == {
        (i, f"a{i} b{i}" if text and i and 1 < i < 40 and i % 2 else text) for i, text in rows
    }


def test_passages_odd_rows(spark, odd):
    assert passages.repeated_passages(odd).count() == 0
    left = passages.without_repeats(odd)
    assert left.columns == odd.columns and left.count() == len(ODD)
    assert passages.without_repeats(odd.limit(0)).count() == 0


def test_passage_of_lines_that_its_first_document_has_before(spark):
    draw = random.Random(3)

    def filler():
        return [f"w{draw.randrange(10**9)}" for _ in range(60)]

    rows = {}
    for k in range(20):
        one, two = ([f"l{k}-{i}-{j}" for j in range(30)] for i in range(2))
        rows[2 * k] = filler() + two + filler() + one + filler() + one + two + filler()
        rows[2 * k + 1] = filler() + one + two + filler()
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id long, text string")
    found = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    assert sorted(found) == [2 * k + 1 for k in range(20)]
    for i, r in found.items():
        assert (r.begin, r.end, r.first_doc_id, r.similarity) == (60, 120, i - 1, 1.0)
        assert (r.first_begin, r.first_end) == (240, 300)


def jaccard(one, two):
    one, two = set(one.tolist()), set(two.tolist())
    return len(one & two) / len(one | two)


def edited(draw, words, edits, size):
    """Words with ``edits`` changes, each of up to ``size`` words next to each other."""
    words = list(words)
    for _ in range(edits):
        at, n = draw.randrange(len(words)), draw.randrange(1, size + 1)
        kind = draw.choice(["change", "insert", "leave"])
        new = [] if kind == "leave" else [f"e{draw.randrange(10**9)}" for _ in range(n)]
        words[at : at if kind == "insert" else at + n] = new
    return words


def test_matches_equal_brute_force():
    draw, length = random.Random(4), 12
    some = 0
    for _ in range(120):
        base = [f"b{draw.randrange(10**9)}" for _ in range(draw.randrange(16, 34))]
        ends = [[f"f{draw.randrange(10**9)}" for _ in range(draw.randrange(6))] for _ in range(2)]
        one = passages.shingles(" ".join(ends[0] + edited(draw, base, draw.randrange(3), 2) + ends[1]), 3)
        two = passages.shingles(" ".join(base), 3)
        best = 0
        for b in range(len(one)):
            for e in range(b + length, len(one) + 1):
                if e - b > best and any(
                    jaccard(one[b:e], two[l:h]) >= 0.8
                    for l in range(len(two))
                    for h in range(l + length - 1, min(l + 2 * (e - b), len(two)) + 1)
                    if 0.8 <= (h - l) / (e - b) <= 1.25
                ):
                    best = e - b
        found = passages.matches(one, two, length, 80)
        for b, e, l, h, similarity in found:
            assert e - b + 1 >= length
            assert similarity == jaccard(one[b : e + 1], two[l : h + 1]) >= 0.8
        some += best > 0
        # Changed words at its ends may make a passage longer by a quarter.
        assert bool(best) == bool(found)
        if best:
            assert max(e - b + 1 for b, e, *_ in found) >= 0.7 * best
    assert 40 < some < 120


def test_three_words_next_to_each_other_may_change():
    draw = random.Random(9)
    base = [f"b{i}" for i in range(95)]
    changed = base[:46] + ["x", "y", "z"] + base[49:]
    inserted = base[:47] + [f"i{i}" for i in range(9)] + base[47:]
    for words in (changed, inserted):
        one = [f"o{draw.randrange(10**9)}" for _ in range(70)] + words
        one, two = (passages.shingles(" ".join(x), passages.SHINGLE) for x in (one, base))
        [(b, e, l, h, similarity)] = passages.matches(one, two, 46, 80)
        assert (b, e, l, h) == (70, len(one) - 1, 0, 90) and similarity >= 0.8


def test_edited_passages_are_found(spark):
    draw = random.Random(21)
    rows, wanted = {}, {}

    def filler():
        return [f"w{draw.randrange(10**9)}" for _ in range(60)]

    for k in range(150):
        base = [f"p{draw.randrange(10**9)}" for _ in range(draw.randrange(60, 200))]
        copy = edited(draw, base, draw.randrange(1, 5), 4)
        rows[2 * k], rows[2 * k + 1] = filler() + base + filler(), filler() + copy + filler()
        sets = [passages.shingles(" ".join(x), passages.SHINGLE) for x in (base, copy)]
        if jaccard(*sets) >= 0.8 and len(sets[1]) >= 46:
            wanted[2 * k + 1] = {i for i, w in enumerate(rows[2 * k + 1]) if w in set(base)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id long, text string")
    found = defaultdict(set)
    for r in passages.repeated_passages(docs).collect():
        assert r.similarity >= 0.8 and r.first_doc_id == r.doc_id - 1
        found[r.doc_id].update(range(r.begin, r.end))
    assert len(wanted) > 60
    shares = [len(words & found[i]) / len(words) for i, words in wanted.items()]
    assert sum(share == 0 for share in shares) <= 1  # all five hashes may miss one
    assert np.mean(shares) > 0.97


def test_hashes_seldom_all_miss_a_near_passage():
    draw = np.random.default_rng(5)
    missed, rounds = 0, 20_000
    for _ in range(rounds):
        # 90 of 112 shingles shared: similarity 0.8.
        one = draw.integers(0, 2**63, 101).astype(np.uint64)
        two = np.concatenate([one[:90], draw.integers(0, 2**63, 11).astype(np.uint64)])
        missed += all(
            passages.mix(one ^ seed).min() != passages.mix(two ^ seed).min()
            for seed in passages._SEEDS
        )
    assert missed <= 8e-4 * rounds  # four hashes miss twice as many


def test_windows_hold_their_place_and_contexts(spark):
    words = [f"w{i % 300}" for i in range(700)]
    docs = spark.createDataFrame([(" ".join(words),)], "text string")
    rows = docs.select(F.explode(passages.windows(F.col("text"), 46)).alias("w")).select("w.*")
    sequence = passages.shingles(" ".join(words), passages.SHINGLE)
    _, values, _, c, left, right = passages.compact_windows([sequence], 46)
    low = (1 << passages.REACH) - 1
    found = rows.collect()
    assert [r.value for r in found] == values.tolist()
    assert [r.place >> 2 * passages.REACH for r in found] == c.tolist()
    assert [(r.place >> passages.REACH) & low for r in found] == (c - left).tolist()
    assert [r.place & low for r in found] == (right - c).tolist()
    after, before = defaultdict(set), defaultdict(set)
    for r, at in zip(found, c.tolist()):
        lacking = at + passages.CONTEXT > len(sequence), at < passages.CONTEXT - 1
        assert (r.sides >> 32 == 0, r.sides & 0xFFFFFFFF == 0) == lacking
        if not lacking[0]:
            after[at % 300].add(r.sides >> 32)
        if not lacking[1]:
            before[at % 300].add(r.sides & 0xFFFFFFFF)
    assert all(len(x) == 1 for x in [*after.values(), *before.values()])


def test_cut():
    text = "a b  c\nd e"
    assert passages.cut(text, [(1, 3)]) == "a d e"
    assert passages.cut(text, [(0, 5)]) == ""
    assert passages.cut(text, [(0, 2), (1, 3), (4, 5)]) == "d "


def test_unlike_texts_under_one_id(spark):
    """The text of least hash is the document; others come after all ids, each by itself."""
    draw = random.Random(8)
    passage = " ".join(f"p{draw.randrange(10**6)}" for _ in range(70))
    rest = " ".join(f"r{draw.randrange(10**6)}" for _ in range(60))
    rows = [(1, passage), (2, f"x y {passage} z"), (2, "short one"), (2, "short one"),
            (3, f"{rest} a"), (3, f"{rest} b"), (9, f"c {rest}"), (9, f"c {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.first_doc_id) for r in passages.repeated_passages(docs).collect()}
    assert found == {(2, 1), (3, 3), (9, 3)}
    left = sorted((r.doc_id, r.text) for r in passages.without_repeats(docs).collect())
    kept = [text for doc, text in left if doc == 3]
    assert [t for d, t in left if d == 1] == [passage]
    assert sorted(t for d, t in left if d == 2) == ["short one", "short one", "x y z"]
    assert sorted(map(len, kept)) == [1, len(rest) + 2]  # one is cut, but for its last word
    assert [t for d, t in left if d == 9] == ["c ", "c "]


def test_windows_of_parts_cover_those_of_the_whole():
    draw = np.random.default_rng(3)
    items = draw.integers(0, 1 << 62, 400).astype(np.uint64)
    whole = passages.compact_windows([items], 20)
    parts = passages.compact_windows([items[:5], items], 20, most=64)
    assert set(parts[0].tolist()) == {1}
    # Every stretch has the same least value at the same position, in one window or another.
    for found in (whole, parts):
        tops = {}
        for value, hashed, c, left, right in zip(*(x.tolist() for x in found[1:]), strict=True):
            for start in range(max(left, c - 19), min(c, right - 19) + 1):
                tops[hashed, start] = (value, c)
        assert len(tops) == passages.HASHES * (400 - 19)
        first = first if found is parts else tops
    assert tops == first


def test_word_hashes_tell_words_apart():
    draw = random.Random(2)
    for _ in range(300):
        text = "".join(draw.choice("ab \n\té\x0b\x85") for _ in range(draw.randrange(30)))
        words = text.encode().split()
        hashes = common.word_hashes(text.encode()).tolist()
        assert len(hashes) == len(words) and len(set(hashes)) == len(set(words))
        assert [words.index(w) for w in words] == [hashes.index(h) for h in hashes]
    long = ["x" * 5000, "x" * 4097, "x" * 4096 + "y" * 904, "y" * 904 + "x" * 4096]
    assert len(set(common.word_hashes(" ".join(long).encode()).tolist())) == 4


# Toxicity


def test_toxicity_on_the_held_out_fold(spark):
    folder = f"{TESTDATA}/sf0.1"
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect())
    rows = queries.op7_toxicity(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    scores = sorted((r.score, labels[r.doc_id]) for r in judged)
    yes = sum(y for _, y in scores)
    ranks = sum(i for i, (_, y) in enumerate(scores) if y)
    area = (ranks - yes * (yes - 1) / 2) / (yes * (len(scores) - yes))
    assert area > 0.9
    assert sum(r.predicted for r in judged if not labels[r.doc_id]) <= 0.01 * len(judged)


def test_class_models_are_distributions():
    """For each context the letters' probabilities sum to one, in both classes."""
    words = ["aba", "abc", "bca", "caa"]
    grams = toxicity._grams(words)
    top = grams[2]
    assert len(top.slot) == sum(len(w) for w in words)
    assert set(np.unique(top.word)) == {0, 1, 2, 3}
    assert top.started.sum() == len(words)


def test_toxicity_odd_rows(spark, odd, no_labels):
    model = toxicity.learn(odd, no_labels)
    rows = toxicity.toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score < 0.01 for r in rows)
    assert toxicity.toxicity(odd.limit(0), model).count() == 0


def kneser_ney(texts, classes):
    """Evidence of letter groups by their definition, from texts and toxic or ordinary ones."""
    counts = [defaultdict(float) for _ in range(3)]
    for count, listed in zip(counts, [*classes, texts]):
        for text in listed:
            for word in toxicity.words_of(text):
                word = toxicity.START + word + toxicity.END
                for end in range(2, len(word) + 1):
                    for n in range(1, min(end, toxicity.ORDER) + 1):
                        count[word[end - n : end]] += 1
    letters = sum(len(g) == 1 for g in counts[2])
    evidence, below = {}, {"": 1 / letters}

    def interpolated(count, listed, lower):
        total, kinds = defaultdict(float), defaultdict(int)
        for g in listed:
            total[g[:-1]] += count[g]
            kinds[g[:-1]] += count[g] > 0
        return {
            g: (max(count[g] - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * kinds[g[:-1]] * lower[g])
            / total[g[:-1]] if total[g[:-1]] else lower[g]
            for g in listed
        }

    for n in range(1, toxicity.ORDER + 1):
        listed = [g for g in counts[2] if len(g) == n]
        lower = {g: below[g[1:]] for g in listed}
        toxic, ordinary = (interpolated(c, listed, lower) for c in counts[:2])
        for g in listed:
            if n == toxicity.ORDER or g[0] == toxicity.START:
                evidence[g] = np.log(max(toxic[g], 1e-12)) - np.log(max(ordinary[g], 1e-12))
        continued = defaultdict(float)
        for g in counts[2]:
            if len(g) == n + 1:
                continued[g[1:]] += 1
        count = {g: counts[2][g] if g[0] == toxicity.START else continued[g] for g in listed}
        below = interpolated(count, listed, lower)
    return evidence


def test_evidence_equals_brute_force_beyond_any_table(spark, tmp_path):
    # More letter groups than any fixed table would hold: letters of many scripts.
    draw = random.Random(2)
    rows = [
        (i, " ".join("".join(chr(draw.randrange(0x4E00, 0x9F00)) for _ in range(8)) for _ in range(60)))
        for i in range(900)
    ]
    rows += [(900 + i, "plain words of ordinary people" if i % 2 else "vile WORDS of vilest people") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = {i: i % 2 == 0 for i, _ in rows if i >= 900 or i % 5 == 0}
    frame = spark.createDataFrame([(i, 0, int(t)) for i, t in labels.items()], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, frame)
    found = dict(model.evidence.collect())
    taught = [[t for i, t in rows if zlib.crc32(str(i).encode()) % 3 == 0 and labels.get(i) == c] for c in (True, False)]
    expected = kneser_ney([t for _, t in rows], taught)
    assert sum(len(g) == toxicity.ORDER for g in expected) > 200_000
    assert found.keys() == expected.keys()
    assert max(abs(found[g] - e) for g, e in expected.items()) < 1e-4
    # The features are those of the words' evidence.
    text = rows[-1][1]
    totals = []
    for word in toxicity.words_of(text):
        word = toxicity.START + word + toxicity.END
        totals.append(sum(expected[word[max(0, e - toxicity.ORDER) : e]] for e in range(2, len(word) + 1)))
    x = {r.doc_id: r.x for r in toxicity._features(docs, model.evidence, Scratch(spark, "test")).collect()}
    assert len(x) == len(rows)
    assert x[rows[-1][0]][1] == pytest.approx(max(totals), abs=1e-4)
    assert x[rows[-1][0]][0] == pytest.approx(sum(totals) / (len("".join(text.split())) + len(totals)), abs=1e-4)


# Licences


def test_licences_of_files_and_directories(spark):
    mit, gpl = licences.TEMPLATES["MIT"][0], licences.TEMPLATES["GPL-3.0"][0]
    files = spark.createDataFrame(
        [
            ("LICENSE", mit), ("a/b/COPYING", gpl), ("a/x.txt", "plain text"), ("a/b/c/y", "plain"),
            ("a/b/z", f"some words of a file\n{mit}\nand many more of them"), ("other", None), ("a/b/c/y", "plain"), (None, gpl),
            (None, "nothing"), ("a/e", ""),
        ],
        "path string, text string",
    )
    found = defaultdict(list)
    for r in licences.licences(files).collect():
        found[r.path].append((r.licence, r.origin, r.from_path))
    assert found["a/x.txt"] == [("MIT", "directory", "LICENSE")]
    assert found["a/b/c/y"] == [("GPL-3.0", "directory", "a/b/COPYING")] * 2
    assert found["a/b/z"] == [("MIT", "header", "a/b/z")]
    assert found["other"] == found["a/e"][:0] + [("MIT", "directory", "LICENSE")]
    assert sorted(map(str, found[None])) == ["('GPL-3.0', 'header', None)", "(None, 'none', None)"]
    assert licences.licences(files.limit(0)).count() == 0


def test_licences_of_documents_without_ids(spark, tmp_path):
    """Each by its own text: none states or gives what another one does."""
    rows = [(None, "A recipe of flour and milk.", "en", "web"), (None, None, "en", "web"),
            (None, "Some words first. Released under the MIT License. And many words more, and more.", "en", "web"),
            (5, "A text about the sea.", "en", "web"), (6, licences.TEMPLATES["GPL-3.0"][0], "de", "web"),
            (7, "Ein Text.", "de", "web")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op8_licence_scan(spark, str(tmp_path))
    stated = [(str(r.doc_id), r.licence, r.origin) for r in found.collect()]
    assert sorted(stated, key=str) == sorted(
        [("None", None, "none"), ("None", None, "none"), ("None", "MIT", "header"), ("5", None, "none"),
         ("6", "GPL-3.0", "header"), ("7", "GPL-3.0", "directory")], key=str
    )


def test_licence_query_finds_the_statements(spark):
    folder = f"{TESTDATA}/sf0.01"
    docs = texts(spark, folder)
    rows = {r.doc_id: r for r in queries.op8_licence_scan(spark, folder).collect()}
    assert len(rows) == len(docs)
    for name, line in (("MIT", "Released under the MIT License."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.")):
        for i, text in docs.items():
            if line in text.split("\n"):
                assert rows[i].origin == "header"
    plan = queries.op8_licence_scan(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_statements_within_longer_lines(spark):
    draw = random.Random(8)

    def prose(n):
        return " ".join(draw.choice(["the", "under", "of", f"w{draw.randrange(9999)}"]) for _ in range(n))

    rows, wanted = [], {}
    for name, listed in licences.TEMPLATES.items():
        for text in listed:
            words = text.split()
            for kind in range(3):
                stated = text if kind else "\n * ".join(" ".join(words[i : i + 4]) for i in range(0, len(words), 4))
                before, after = (prose(40), prose(40)) if kind < 2 else (f"Copyright 2020 {prose(3)} Corp.", "")
                path = f"d{len(rows)}/f"
                rows.append((path, f"{before} {stated} {after}"))
                wanted[path] = name
    rows += [(f"plain{i}/f", prose(200)) for i in range(200)]
    rows += [("id/x", "// SPDX-License-Identifier: MIT"), ("id/y", "SPDX-License-Identifier: ISC")]
    rows += [("bsd/x", "Copyright 2020 Acme. All rights reserved.\n" + licences.TEMPLATES["BSD-3-Clause"][0])]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: r for r in licences.licences(files).collect()}
    assert {p: found[p].licence for p in wanted} == wanted
    assert all(found[p].origin == "header" for p in wanted)
    assert not any(found[f"plain{i}/f"].licence for i in range(200))
    assert found["id/x"].licence == "MIT" and found["id/x"].similarity == pytest.approx(1)
    assert found["id/y"].origin != "header" and found["bsd/x"].licence == "BSD-3-Clause"


# Nearest neighbours


def brute_nearest(rows, k):
    vectors = {i: np.array(v, float) for i, v in rows}
    found = {}
    for q in vectors:
        if q % 20 == 0:
            scored = sorted((-float(vectors[q] @ vectors[i]), i) for i in vectors if i != q)
            found[q] = [i for _, i in scored[:k]]
    return found


def test_recall_against_brute_force(spark):
    folder = f"{TESTDATA}/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    vectors = {i: np.array(v, float) for i, v in rows}
    expected = brute_nearest(rows, 20)
    found = defaultdict(dict)
    for r in queries.op10_nearest_neighbours(spark, folder).collect():
        found[r.query_id][r.rank] = r.vec_id
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), abs=1e-12)
    assert set(found) == set(expected)
    assert all(sorted(f) == list(range(1, 21)) for f in found.values())
    hits = sum(len(set(found[q].values()) & set(expected[q])) for q in expected)
    assert hits >= 0.95 * 20 * len(expected)


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 2.0]), (101, [3.0, 1.0])]
    bad = [(200, None), (201, []), (202, [0.0, 0.0]), (203, [nan, 1.0]), (204, [inf, 1.0]),
           (205, [None, 1.0]), (None, [1.0, 1.0]), (220, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in vector_index.nearest(table, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert dict(found) == {q: v for q, v in brute_nearest(rows, 5).items()}
    few = vector_index.nearest(table.where("vec_id in (0, 100)"), F.col("vec_id") == 0, k=5)
    assert [(r.vec_id, r.rank) for r in few.collect()] == [(100, 1)]
    assert vector_index.nearest(table.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("case", ["one long", "one huge", "heavy tails", "eight orders"])
def test_recall_for_vectors_of_unlike_lengths(spark, case):
    draw = np.random.default_rng(17)
    centres = draw.normal(size=(30, 24))
    vectors = centres[draw.integers(0, 30, 3000)] + 0.4 * draw.normal(size=(3000, 24))
    lengths = np.ones(3000)
    if case == "one long":
        lengths[77] = 1e4
    elif case == "one huge":
        vectors[77] *= 1e200 / np.linalg.norm(vectors[77])
    elif case == "heavy tails":
        lengths = draw.pareto(0.7, 3000) + 0.01
    else:
        lengths = 10.0 ** draw.uniform(-4, 4, 3000)
    vectors *= lengths[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute_nearest(rows, 20)
    found = defaultdict(dict)
    for r in vector_index.nearest(table, F.col("vec_id") % 20 == 0, shard=1000).collect():
        found[r.query_id][r.rank] = r.vec_id
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), rel=1e-9, abs=1e-9)
    assert all(sorted(found[q]) == list(range(1, 21)) for q in expected)
    hits = sum(len(set(found[q].values()) & set(expected[q])) for q in expected)
    assert hits >= 0.95 * 20 * len(expected)


def test_products_beyond_double_precision(spark):
    big, small = 1e200, 5e-324
    rows = [(0, [big, big]), (1, [big, big / 2]), (2, [big, -big]), (3, [1.0, 1.0]), (4, [small, 0.0]),
            (20, [small, small])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in vector_index.nearest(table, F.col("vec_id") % 20 == 0, k=9).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert found[0] == [1, 3, 20, 4, 2] and sorted(found[20]) == [0, 1, 2, 3, 4]


