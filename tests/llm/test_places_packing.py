import random
from collections import Counter
from fractions import Fraction

import pytest

from kartoteka.llm import p6_places as p6
from kartoteka.llm import p7_packing as p7
from kartoteka.llm import p8_mixing as p8
from kartoteka.llm import queries, tokens

REF = [
    (1, "Jasutziska", "powiat stadoltowski", []), (2, "Przenardowo Górne", "powiat x", []), (3, "Przenardowo Dolne", "powiat x", []), (4, "Chadedwowo", "powiat y", ["Chadburg"]),
    (5, "Trzawsin", "powiat z", None), (6, "Barelrec", "powiat a", []), (7, "Barelrowo", "powiat b", []), (8, "Włolymzowa Nowe", None, []),
]
REF_KIND = "place_id bigint, name string, district string, aliases array<string>"
CASES = [
    ("Jasutziska", 1), ("jasutziska", 1), ("JASUTZISKA;", 1), ("w Jasutziskach", 1), ("Jasutizska", 1), ("Jasutziska, ul. Długa 5", 1), ("ul. Długa 5/7, Jasutziska", 1), ("Jasutziska (pow. stadoltowski)", 1),
    ("Przenardowo Gór.", 2), ("Przenardowo D.", 3), ("Prz-wo Górne", 2), ("Chadburg", 4), ("w Trzawsinie", 5), ("Trzawsin ?", 5), ("we wsi Barelrcu", 6), ("Barel., pow. b", 7),
    ("Wlolymzowa N.", 8), ("za granicą", -1), ("Holmaddoukka, ul. Długa 5", -1), ("12", -1), ("dom rodziców", -1), ("ul. Długa 136 / Trzawsin", 5), ("x" * 30_000, -1),
]


@pytest.mark.parametrize("block", [20_000, 3])
def test_places(spark, block):
    data = [(i, v, 9, "own") for i, (v, _) in enumerate(CASES)] + [(900, None, 9, ""), (901, "", 9, ""), (902, " ?—", 9, ""), (903, "Jasutziska", 9, "")]
    df = spark.createDataFrame(data, "id bigint, location string, place_id int, name string")
    out = {r.id: (r.place_id, r.penalty) for r in p6.map_to_reference(df, "id", "location", spark.createDataFrame(REF, REF_KIND), block=block).collect()}
    assert {i: out[i][0] for i in range(len(CASES))} == {i: want for i, (_, want) in enumerate(CASES)}
    assert set(out) == {*range(len(CASES)), 903} and out[903] == (1, 0.0) and out[0][1] == 0.0


def test_misses_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "zzz"), (2, "zzz"), (3, "Trzawsin")], "id bigint, location string")
    ref = spark.createDataFrame(REF, REF_KIND)
    assert rows(p6.misses(p6.map_to_reference(df, "id", "location", ref))) == [("zzz", 2)]
    assert p6.map_to_reference(df.limit(0), "id", "location", ref).count() == 0
    assert rows(p6.map_to_reference(df, "id", "location", ref.limit(0)), "place_id") == [(-1,)] * 3


@pytest.mark.parametrize("block", [20_000, 3])
def test_found_leaves_out_only_names_character_for_character(spark, monkeypatch, tmp_path, block):
    values = ["Jasutziska", "JASUTZISKA", "Jasutziska ", "Jasutziska, ul. Długa 5", "Jasutziska (pow. stadoltowski)", "w Jasutziska", "zzz", None, " ?"]
    spark.createDataFrame(list(enumerate(values)), "id bigint, location string").write.parquet(f"{tmp_path}/life_events.parquet")
    spark.createDataFrame(REF, REF_KIND).write.parquet(f"{tmp_path}/place_ref.parquet")
    real = p6.map_to_reference
    monkeypatch.setattr(p6, "map_to_reference", lambda *a: real(*a, block=block))
    assert {r.id: r.place_id for r in queries.p6_found(spark, str(tmp_path)).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: -1}


@pytest.mark.parametrize("block", [20_000, 1])
def test_ties_go_to_the_more_frequent_entry_in_every_block(spark, rows, block):
    ref = spark.createDataFrame([(1, "Kalinów", None, None), (2, "Kalinow", None, None), (3, "Kalinów", None, None)], REF_KIND)
    df = spark.createDataFrame([(1, "Kalinow"), (2, "Kalinow"), (3, "Kalinów"), (4, "KALINOW x"), (5, "w Kalinowie")], "id bigint, location string")
    out = {r.id: r.place_id for r in p6.map_to_reference(df, "id", "location", ref, block=block).collect()}
    assert out[3] == 1 and out[5] == 2  # equal penalties, so the name written more often


def test_one_worker_keeps_lists_apart(spark, rows):
    df = spark.createDataFrame([(1, "kalinów")], "id bigint, location string")
    for alias, want in ((["Kalinów"], 7), (["Brzezie"], -1)):
        ref = spark.createDataFrame([(7, "Sosnowa", None, alias)], REF_KIND)
        assert rows(p6.map_to_reference(df, "id", "location", ref), "place_id") == [(want,)]


def test_weighted_distance():
    assert p6.distance("lodz", "łódź", 2) < 0.5 < p6.distance("kot", "kos", 2) and p6.distance("ab", "ba", 2) < 1 and p6.distance("kot", "pies", 2) == float("inf")


def test_token_count_is_exact_over_pieces(monkeypatch):
    text = "Zażółć gęślą jaźń, 12 kwietnia. " * 40
    whole = tokens.count(text)
    monkeypatch.setattr(tokens, "PIECE", 50)
    assert tokens.count(text) == whole == len(tokens.encoder(tokens.VOCABULARY).encode_ordinary(text)) and tokens.count(None) == 0


def test_knapsack_like_brute_force():
    import numpy as np

    random.seed(1)
    for _ in range(20):
        lengths = np.array(sorted(random.sample(range(1, 15), 4)))
        values = np.array([random.random() for _ in lengths])
        best = [0.0] * 31
        for w in range(1, 31):
            best[w] = max([best[w - 1]] + [best[w - n] + v for n, v in zip(lengths, values) if n <= w])
        chosen, value = p7.knapsack(lengths, values, 30)
        assert abs(value - best[30]) < 1e-9 and sum(int(lengths[i]) * n for i, n in chosen.items()) <= 30


def test_plan_holds_every_item_and_is_near_the_bound():
    random.seed(2)
    histogram = Counter(min(512, int(random.lognormvariate(4.5, 0.9)) + 1) for _ in range(20_000))
    configs, bound, loose = p7.plan(dict(histogram), 512)
    held = Counter()
    for config, times in configs:
        assert sum(n * k for n, k in config.items()) <= 512
        for n, k in config.items():
            held[n] += k * times
    assert held == histogram
    used = sum(times for _, times in configs)
    assert bound <= used + 1e-6 and used <= 1.01 * bound + 1 and loose <= 0.05 * 20_000


def test_plan_of_few_and_of_skewed_lengths():
    few, skewed = {52: 10, 34: 8, 32: 12, 29: 10, 46: 4, 38: 12}, {257: 5000, 300: 4000, 100: 3000, 201: 2000}
    for histogram, capacity, most in ((few, 100, 22), (skewed, 512, 9000), ({257: 10**9}, 512, 10**9)):
        configs, bound, loose = p7.plan(histogram, capacity)
        held = Counter()
        for config, times in configs:
            assert sum(n * k for n, k in config.items()) <= capacity
            for n, k in config.items():
                held[n] += k * times
        assert held == histogram and bound <= sum(t for _, t in configs) <= most


def test_plan_rests_on_a_solved_program():
    import numpy as np

    for histogram, capacity, least in (({171: 6000, 1: 170}, 512, 3000), ({257: 5000, 300: 4000, 100: 3000, 201: 2000}, 512, 9000), ({26: 300, 51: 200, 34: 500, 23: 90}, 100, 400)):
        configs, bound, loose = p7.plan(histogram, capacity)
        used = sum(times for _, times in configs)
        assert bound <= used <= 1.01 * least and bound >= least / (1 + p7.GAP)
        lengths = np.array(sorted(histogram))
        counts = np.array([histogram[int(n)] for n in lengths])
        found, low, dual = p7.fractional(lengths, counts, capacity)
        held = Counter()
        for config, x in found.items():
            assert x >= 0 and sum(int(lengths[i]) * n for i, n in config) <= capacity and all(n <= counts[i] for i, n in config)
            held.update({i: n * x for i, n in config})
        assert all(held[i] >= n * (1 - 1e-9) for i, n in enumerate(counts)) and low <= sum(found.values()) <= (1 + p7.GAP) * low + 1e-6
        assert abs(float(dual @ counts) - low) < 1e-6 * low and p7.bounded_knapsack(lengths, dual, counts, capacity)[1] <= 1 + 1e-9


@pytest.mark.parametrize("cells", [1 << 26, 100])
def test_bounded_knapsack_like_brute_force(monkeypatch, cells):
    import numpy as np

    monkeypatch.setattr(p7, "CELLS", cells)
    random.seed(5)
    for _ in range(20):
        lengths, most = np.array(random.sample(range(1, 15), 4)), np.array([random.randrange(4) for _ in range(4)])
        values = np.array([random.random() for _ in lengths])
        best = [0.0] * 31
        for n, v, k in zip(lengths.tolist(), values, most.tolist()):
            for _ in range(k):
                best = [max(best[w], best[w - n] + v if w >= n else 0) for w in range(31)]
        chosen, value = p7.bounded_knapsack(lengths, values, most, 30)
        assert abs(value - best[30]) < 1e-9 and abs(sum(values[i] * n for i, n in chosen.items()) - value) < 1e-9
        assert sum(int(lengths[i]) * n for i, n in chosen.items()) <= 30 and all(n <= most[i] for i, n in chosen.items())


def test_best_fit_takes_items_of_one_length_together():
    random.seed(4)
    for _ in range(100):
        capacity = random.randrange(5, 60)
        histogram = {random.randrange(1, capacity): random.randrange(1, 12) for _ in range(6)}
        space, held = [], Counter()
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [f for f in space if f >= length]
                if fits:
                    space.remove(min(fits))
                space.append(min(fits, default=capacity) - length)
        found = p7.best_fit(histogram, capacity)
        for config, times in found:
            for n, k in config.items():
                held[n] += k * times
        assert held == histogram and len(space) == sum(t for _, t in found) and len(found) <= 2 * len(histogram) + 1


def check_packed(packed, wanted, capacity):
    held, sizes = {}, Counter()
    for r in packed:
        held.setdefault(r.doc_id, []).append((r.piece, r.n_tokens))
        sizes[r.container_id] += r.n_tokens
    assert max(sizes.values(), default=0) <= capacity
    for d, n in wanted.items():
        pieces = sorted(held.pop(d))
        assert [p for p, _ in pieces] == list(range(-(-n // capacity))) and sum(t for _, t in pieces) == n and all(t == capacity for _, t in pieces[:-1])
    assert not held


@pytest.mark.parametrize("bucket", [50_000, 7])
def test_packing(spark, monkeypatch, bucket):
    monkeypatch.setattr(p7, "BUCKET_ROWS", bucket)
    random.seed(3)
    texts = {i: "a b " * random.randrange(1, 60) for i in range(120)} | {500: "x y " * 900, 501: "", 502: None, 503: "q"}
    df = spark.createDataFrame([(i, t, 1, "own") for i, t in texts.items()], "doc_id bigint, text string, piece int, length string")
    sizes = spark.createDataFrame([(1, 100), (2, 64), (3, 0)], "pack_id int, capacity_tokens int")
    out = p7.pack(df, sizes)
    wanted = {i: tokens.count(t) for i, t in texts.items() if t}
    for pack, capacity in ((1, 100), (2, 64)):
        check_packed(out.where(f"pack_id = {pack}").collect(), wanted, capacity)
    assert {r.pack_id: r.fill > 0.9 for r in p7.report(out, sizes).collect()} == {1: True, 2: True}


def test_packing_nothing(spark):
    sizes = spark.createDataFrame([(1, 100)], "pack_id int, capacity_tokens int")
    assert p7.pack(spark.createDataFrame([], "doc_id bigint, text string"), sizes).count() == 0
    assert p7.pack(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), sizes.limit(0)).count() == 0


def test_schedule_stays_within_a_block():
    weights = {"a": Fraction(1, 2), "b": Fraction(3, 10), "c": Fraction(1, 5)}
    slots = p8.schedule(weights, {"a": 500, "b": 300, "c": 200})
    assert sorted(slots) == sorted((s, j) for s, n in (("a", 500), ("b", 300), ("c", 200)) for j in range(n))
    seen = Counter()
    for t, (s, j) in enumerate(slots, 1):
        assert j == seen[s]
        seen[s] += 1
        assert all(abs(seen[x] - w * t) < 1 for x, w in weights.items())


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(p8, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(p8, "BUCKET_ROWS", 20)
    docs = [(i, "słowo " * (1 + i % 9), s, 1) for s, n in (("a", 200), ("b", 40), ("other", 30)) for i in range(1000 * len(s) + ord(s[0]), 1000 * len(s) + ord(s[0]) + n)] + [(9, None, "a", 1), (8, "", "b", 1), (7, "x", None, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, slot int")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 3), ("none", 0.2, 2)], "source string, target_share double, max_repeats int")
    mixed = p8.mix(df, targets)
    got = mixed.collect()
    times = Counter((r.source, r.doc_id) for r in got)
    assert max(n for (s, _), n in times.items() if s == "b") <= 3 and max(n for (s, _), n in times.items() if s == "a") <= 2
    shares = {r.source: r.actual_share for r in p8.report(mixed, targets).collect()}
    assert abs(shares["a"] - 0.625) < 0.01 and abs(shares["b"] - 0.375) < 0.01 and shares["none"] == 0
    assert p8.mix(df.limit(0), targets).count() == 0 and p8.mix(df, targets.limit(0)).count() == 0
