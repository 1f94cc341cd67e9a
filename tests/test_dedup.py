import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.operators import components, dedup, nearest, segments, similarity, topk, windows
from broadsheet.plans import resolution


def greedy(rows):
    seen, kept = set(), []
    for row, keys in rows:
        if not seen & set(keys):
            kept.append(row)
            seen |= set(keys)
    return kept


def run_greedy(spark, rows):
    df = spark.createDataFrame([(r, r, list(k)) for r, k in rows], "id long, ord long, ks array<string>")
    return sorted(r.id for r in dedup.keep_first_by_keys(df, "id", "ord", F.col("ks")).collect())


def test_dropped_rows_do_not_claim(spark):
    # b shares a key with a and one with c; b falls, c stays.
    assert run_greedy(spark, [(1, ["a"]), (2, ["a", "c"]), (3, ["c"]), (4, [])]) == [1, 3, 4]


def test_greedy_equals_scan_with_a_hot_key(spark):
    rnd = random.Random(1)
    rows = [(i, sorted({f"k{rnd.randrange(25)}" for _ in range(rnd.randrange(4))} | ({"hot"} if i % 3 == 0 else set()))) for i in range(120)]
    assert run_greedy(spark, rows) == greedy(rows)


def test_greedy_chain_of_5000_and_large_components(spark):
    chain = [(i, [f"k{i}", f"k{i + 1}"]) for i in range(5000)]
    assert run_greedy(spark, chain) == list(range(0, 5000, 2))
    rnd = random.Random(3)
    rows = [(i, sorted({f"a{i // 3}", f"a{i // 3 + rnd.randrange(2)}", f"b{rnd.randrange(40)}"} if i < 300 else {f"c{i}", f"c{i + 1 if i % 20 else 0}"})) for i in range(500)]
    df = spark.createDataFrame([(r, r, list(k)) for r, k in rows], "id long, ord long, ks array<string>").repartition(3)
    # Up to 60 claims: the large component goes on in rounds, the chains of 20 rows are scanned.
    got = dedup.keep_first_by_keys(df, "id", "ord", F.col("ks"), rounds=2, component_claims=60)
    assert sorted(r.id for r in got.collect()) == greedy(rows)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 900), (901, 500), (7000, 7000)] + [(10_000, 20_000 + i) for i in range(300)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(201)} | {500: 500, 900: 500, 901: 500, 7000: 7000, 10_000: 10_000} | {20_000 + i: 10_000 for i in range(300)}
    assert got == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sets(st.sampled_from("abcdefgh"), max_size=3), min_size=1, max_size=18))
def test_greedy_property(spark, key_sets):
    rows = [(i, sorted(k)) for i, k in enumerate(key_sets)]
    assert run_greedy(spark, rows) == greedy(rows)


def sim(a, b):
    a, b = set(a), set(b)
    return round(len(a & b) / max(len(a), len(b)) + 1e-12, 3) if a and b else 0.0


def families(rnd, n):
    """Titles of which a third come from one template with one or two words exchanged."""
    base = [f"w{i}" for i in range(12)]
    out = []
    for i in range(n):
        if i % 3 == 0:
            words = list(base)
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(12)] = f"v{rnd.randrange(6)}"
        elif i % 3 == 1:
            words = [f"u{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 40))]
        else:
            words = [f"w{i}" for i in range(32) if rnd.random() < 0.97]
        out.append(sorted(set(words)))
    return out


def test_earliest_similar_equals_brute_force(spark):
    titles = families(random.Random(2), 150)
    want = {i: next((j for j in range(i) if sim(titles[i], titles[j]) >= 0.9), None) for i in range(len(titles))}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id long, words array<string>")
    got = {r.id: r.similar_to for r in similarity.earliest_similar(df, "id", "id", "words", 0.9).collect()}
    assert got == want and any(v is not None for v in want.values())


def test_similar_pairs_equal_brute_force(spark):
    titles = families(random.Random(3), 90)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id long, words array<string>")
    for limit in (0.62, 0.72):
        want = {(i, j): sim(a, b) for i, a in enumerate(titles) for j, b in enumerate(titles) if sim(a, b) >= limit}
        got = {(r.left_id, r.right_id): r.similarity for r in similarity.similar_pairs(df, df, "id", "id", "words", "words", limit).collect()}
        assert got == want


def test_rounding_before_the_threshold(spark):
    """188 of 209 words are 0.8995, which rounds up to 0.9; 179 of 199 do not."""
    wide = [f"a{i}" for i in range(209)], [f"a{i}" for i in range(188)] + [f"b{i}" for i in range(21)]
    narrow = [f"c{i}" for i in range(199)], [f"c{i}" for i in range(179)] + [f"d{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate([*wide, *narrow])), "id long, words array<string>")
    got = {r.id: r.similar_to for r in similarity.earliest_similar(df, "id", "id", "words", 0.9).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: None}


def test_a_family_of_2000_near_equal_titles(spark):
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(40)]
    titles = []
    for i in range(2000):
        words = list(base)
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(40)] = f"x{i}" if rnd.random() < 0.7 else f"v{rnd.randrange(9)}"
        titles.append(frozenset(words) if i % 50 else frozenset(f"u{i}{j}" for j in range(8)))
    want = {i: next((j for j in range(i) if sim(titles[i], titles[j]) >= 0.9), None) for i in range(2000)}
    df = spark.createDataFrame([(i, sorted(t)) for i, t in enumerate(titles)], "id long, words array<string>").repartition(8)
    got = similarity.earliest_similar(df, "id", "id", "words", 0.9).collect()
    assert len(got) == 2000 and {r.id: r.similar_to for r in got} == want


def test_top_similar_equals_brute_force(spark):
    rnd = random.Random(9)
    titles = families(rnd, 240)
    rows = [(i, t, rnd.choice("xyy"), rnd.randrange(40) if rnd.random() < 0.9 else None) for i, t in enumerate(titles + [titles[0]] * 30)]
    left, right = [r for r in rows if r[0] % 2], [r for r in rows if r[0] % 2 == 0]
    want = {}
    for i, t, b, at in left:
        scored = sorted((-sim(t, u), abs((at or 0) - (v or 0)), j) for j, u, c, v in right if c == b and sim(t, u) >= 0.62)
        want.update({(i, n + 1): (j, -s) for n, (s, _, j) in enumerate(scored[:5])})
    frame = lambda rs: spark.createDataFrame(rs, "id long, words array<string>, label string, at int")
    after = lambda a, b: [F.abs(F.coalesce(f"{a}.at", F.lit(0)) - F.coalesce(f"{b}.at", F.lit(0))), F.col(f"{b}.id")]
    got = similarity.top_similar(frame(left), frame(right), "id", "id", "words", 0.62, 5, after, "label", ["at"]).collect()
    assert {(r.left_id, r["rank"]): (r.right_id, r.similarity) for r in got} == want and len(got) == len(want)


def test_classify_entries(spark):
    rows = [(1, ["u1", "g1"], ["a", "b", "c"]), (2, ["u2", "g1"], ["x", "y"]), (3, ["u2", "g3"], ["p", "q"]), (4, ["u4"], ["a", "b", "c"]), (5, ["u5"], ["n"])]
    df = spark.createDataFrame([(i, k, w) for i, k, w in rows], "id long, ks array<string>, words array<string>")
    got = {r.id: (r.status, r.duplicate_of) for r in similarity.classify_entries(df, "id", "id", "ks", "words").collect()}
    # 3 shares its URL with 2, itself a duplicate: dropped rows claim their keys here.
    assert got == {1: ("unique", None), 2: ("exact-duplicate", 1), 3: ("exact-duplicate", 2), 4: ("update-of-existing", 1), 5: ("unique", None)}


def test_related_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(80):
        topics = [t for t in "abc" if rnd.random() < 0.5] if i % 3 else ["a", "b"]
        ents = [f"e{j}" for j in range(14 if i == 7 else 4) if rnd.random() < (0.9 if i == 7 else 0.3)]
        rows.append((f"{i:03d}", topics, ents, rnd.choice("xy"), rnd.random() < 0.8, rnd.randrange(30)))
    df = spark.createDataFrame(rows, "id string, topics array<string>, ents array<string>, cat string, ok boolean, t long").withColumn("ts", F.timestamp_seconds("t"))
    want = {}
    for a in rows:
        scored = sorted((-(10 * len(set(a[1]) & set(b[1])) + 18 * len(set(a[2]) & set(b[2])) + 3 * (a[3] == b[3])), -b[5], b[0]) for b in rows if b[0] != a[0] and b[4])
        want[a[0]] = [(k + 1, x[2], -x[0]) for k, x in enumerate(scored[:5])]
    got = {}
    for r in topk.related(df, "id", "topics", "ents", "cat", "ok", "ts").collect():
        got.setdefault(r.id, []).append((r["rank"], r.related, r.score))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_segments_equal_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", rnd.randrange(400)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    order = [F.col("v"), F.col("id")]
    by_group = {}
    for i, g, v in rows:
        by_group.setdefault(g, []).append((v, i))
    want_rn, want_prev, want_next = {}, {}, {}
    for members in by_group.values():
        members.sort()
        for k, (_, i) in enumerate(members):
            want_rn[i] = k + 1
            want_prev[i] = members[k - 1][1] if k else None
            want_next[i] = members[k + 1][1] if k + 1 < len(members) else None
    ranked = segments.row_number(df, ["g"], F.floor(F.col("v") / 50), order)
    assert {r.id: r.rn for r in ranked.collect()} == want_rn
    near = segments.neighbours(df, ["g"], F.floor(F.col("v") / 50), order, F.col("id"), "p", "n").collect()
    assert {r.id: r.p for r in near} == want_prev and {r.id: r.n for r in near} == want_next
    medians = {r.g: r.m for r in segments.value_at(df, ["g"], "v", F.floor(F.col("n") / 2), F.floor(F.col("v") / 50), "m").collect()}
    assert medians == {g: sorted(m)[len(m) // 2][0] for g, m in by_group.items()}


def test_capped_pick_equals_greedy(spark):
    rnd = random.Random(6)
    rows = [(i, "big" if i % 2 else f"s{i % 5}", rnd.randrange(20)) for i in range(100)]
    taken, want = {}, []
    for i, s, v in sorted(rows, key=lambda r: (-r[2], r[0])):
        if len(want) < 12 and taken.get(s, 0) < 3:
            taken[s] = taken.get(s, 0) + 1
            want.append(i)
    df = spark.createDataFrame(rows, "id long, s string, v long")
    got = [r.id for r in windows.capped_pick(df, "s", [F.col("v").desc(), F.col("id")], 3, 12).collect()]
    assert got == want


def test_repeated_images_are_cleared_everywhere(spark):
    df = spark.createDataFrame([(1, "k", "u1"), (2, "k", "u2"), (3, "z", "u3"), (4, None, None)], "id long, k string, img string")
    assert {r.id: r.img for r in dedup.clear_repeated(df, "k", "img").collect()} == {1: None, 2: None, 3: "u3", 4: None}


def test_streak_resets_and_is_capped(spark):
    rows = [("a", i, i != 3) for i in range(6)] + [("b", i, True) for i in range(30)] + [("c", 1, False)]
    df = spark.createDataFrame(rows, "feed string, o long, ok boolean")
    got = {r.feed: r.consecutive_successes for r in windows.success_streak(df, "feed", "o", "ok").collect()}
    assert got == {"a": 2, "b": 20, "c": 0}


def test_best_similar_equals_brute_force(spark):
    rnd = random.Random(8)
    sets = sorted({tuple(t) for t in families(rnd, 160)}, key=lambda t: rnd.random())
    half = len(sets) // 2
    left, right = list(enumerate(sets[:half])), list(enumerate(sets[half:]))
    want = {}
    for i, a in left:
        best = min(((-sim(a, b), j) for j, b in right if sim(a, b) >= 0.72), default=None)
        if best:
            want[i] = (best[1], -best[0])
    schema = "id long, words array<string>"
    frame = lambda rows: spark.createDataFrame([(i, list(t)) for i, t in rows], schema)
    got = similarity.best_similar(frame(left), frame(right), "id", "id", "id", "words", 0.72).collect()
    assert {r.left_id: (r.right_id, r.similarity) for r in got} == want and len(got) == len(want)


def test_resolve_sources_equals_brute_force(spark):
    """Copies of one title on both sides, with unknown, equal and rounded times."""
    rnd = random.Random(11)
    titles = families(rnd, 60)
    ids = rnd.sample(range(10_000), 400)
    when = lambda: None if rnd.random() < 0.1 else rnd.choice([rnd.randrange(3 * 86_400), rnd.randrange(1_200 * 86_400), 4320 * rnd.randrange(40)])
    rows = [(i, "xy"[i % 3 == 0], when(), titles[0] if rnd.random() < 0.6 else rnd.choice(titles)) for i in ids]
    relay, direct = rows[:150], rows[150:]
    gap = lambda a, b: None if a is None or b is None else (abs(a - b) + 4320) // 8640 / 10
    want = {}
    for i, label, at, words in relay:
        near = [(-sim(words, w), gap(at, t), j) for j, c, t, w in direct if c == label and sim(words, w) >= 0.62]
        near.sort(key=lambda x: (x[0], 999.0 if x[1] is None else x[1], x[2]))
        want.update({(i, n + 1): (j, -s, g) for n, (s, g, j) in enumerate(near[:5])})
    schema = "id long, label string, at long, words array<string>"
    frame = lambda rs: spark.createDataFrame(rs, schema).withColumn("ts", F.timestamp_seconds("at"))
    got = resolution.resolve_sources(frame(relay).withColumns({"decision": F.lit(None).cast("string"), "mapped": F.lit(True)}), frame(direct), "id").where("candidate IS NOT NULL").collect()
    assert {(r.id, r["rank"]): (r.candidate, r.similarity, r.gap) for r in got} == want and len(got) == len(want)


def test_nearest_in_time_builds_no_pairs(spark):
    """4000 rows ask 4000 rows of one key: a few hundred thousand candidates at most, not 16 million."""
    asked = spark.range(4000).select(F.lit("a").alias("key"), (F.col("id") * 7).alias("at"), F.col("id").alias("row"))
    held = spark.range(4000).select(F.lit("a").alias("key"), (F.col("id") * 5).alias("at"), F.col("id").alias("id"))
    got = nearest.nearest_in_time(asked, held, "key", "at", "id", 2, 1000)
    assert got.count() <= 4000 * 2 * 9 * 2


def test_best_similar_keeps_frequent_words_apart(spark):
    """1500 long titles that share frequent words only: the join of the last step stays near the number of titles."""
    rnd = random.Random(12)
    title = lambda i: [f"f{n}" for n in rnd.sample(range(30), 14)] + [f"r{i}x{n}" for n in range(16)]
    rows = [(i, title(i)) for i in range(1500)]
    rows[1] = (1, rows[0][1][:20] + [f"z{n}" for n in range(10)])
    frame = lambda part: spark.createDataFrame(part, "id long, words array<string>")
    sets = frame(rows).select(F.col("id").alias("set_id"), "words")
    x = similarity._prefixed(sets, similarity._frequency(sets), 0.5).alias("x")
    y = similarity._prefixed(sets, similarity._frequency(sets), 0.5).alias("y")
    assert x.join(y, (F.col("x.word") == F.col("y.word")) & similarity._may_be_similar("x", "y", 0.5)).count() < 1500 * 40
    got = similarity.best_similar(frame(rows[::2]), frame(rows[1::2]), "id", "id", "id", "words", 0.5).collect()
    assert [(r.left_id, r.right_id, r.similarity) for r in got] == [(0, 1, sim(rows[0][1], rows[1][1]))]


def test_best_similar_with_long_sets_and_low_thresholds(spark):
    """Sets that meet on words, on pairs of words and in sub-sets, with words of one side only, against brute force."""
    rnd = random.Random(21)
    sets = sorted({tuple(sorted(set(t))) for t in families(rnd, 50)} | {tuple(sorted({f"w{rnd.randrange(14)}" for _ in range(rnd.randrange(1, 16))})) for _ in range(160)}, key=lambda t: rnd.random())
    half = len(sets) // 2
    left = [(i, t + (f"l{i}",) if i % 3 == 0 else t) for i, t in enumerate(sets[:half])]
    right = [(i, t + (f"r{i}", f"q{i}") if i % 4 == 0 else t) for i, t in enumerate(sets[half:])]
    frame = lambda rows: spark.createDataFrame([(i, list(t)) for i, t in rows], "id long, words array<string>")
    for threshold, widest, paired in [(0.5, 24, 64), (0.5, 4, 8), (0.3, 24, 64), (0.72, 6, 9)]:
        want = {}
        for i, a in left:
            best = min(((-sim(a, b), j) for j, b in right if sim(a, b) >= threshold), default=None)
            if best:
                want[i] = (best[1], -best[0])
        got = similarity.best_similar(frame(left), frame(right), "id", "id", "id", "words", threshold, widest, paired=paired).collect()
        assert {r.left_id: (r.right_id, r.similarity) for r in got} == want and len(got) == len(want), (threshold, widest, paired)


def test_short_titles_of_frequent_words_meet_on_pairs(spark):
    """600 titles a side whose prefixes reach their frequent words: pairs of words keep them apart, single words do not."""
    rnd = random.Random(22)
    rare = lambda i: [f"r{i}x{n}" if i % 2 else f"r{2 * rnd.randrange(600) + 1}x{n}" for n in range(4)]
    rows = [(i, [f"f{n}" for n in rnd.sample(range(60), 5)] + rare(i)) for i in range(1200)]
    sets = spark.createDataFrame(rows, "set_id long, words array<string>")
    left, right = sets.where("set_id % 2 = 0"), sets.where("set_id % 2 = 1")
    shared = similarity._shared_words(left, right)
    ranked = [similarity._by_rarity(df, shared) for df in (left, right)]
    keys = lambda width, on: similarity._keyed(ranked[0], 0.5, width).join(similarity._keyed(ranked[1], 0.5, width), on).count()
    assert keys(1, ["word"]) > 5000 > 5 * keys(2, ["word", "next"])


def test_subsets_leave_out_words_of_one_side(spark):
    """A set with three words that no partner has gives no sub-set, one with two gives one."""
    left = spark.createDataFrame([(0, ["a", "b", "c", "d", "x", "y", "z"]), (1, ["a", "b", "c", "u", "v"]), (2, ["a", "b", "c"])], "set_id long, words array<string>")
    right = spark.createDataFrame([(5, ["a", "b", "c", "d"])], "set_id long, words array<string>")
    got = similarity._subsets(similarity._by_rarity(left, similarity._shared_words(left, right)), 0.5, 24).groupBy("set_id").count().collect()
    assert {r.set_id: r["count"] for r in got} == {1: 1, 2: 4}


def test_top_similar_ranks_words_once(spark, monkeypatch):
    """The words of each side are ranked once, not at every level."""
    calls, ranked = [], similarity._by_rarity
    monkeypatch.setattr(similarity, "_by_rarity", lambda *a: calls.append(1) or ranked(*a))
    rows = [(i, ["a", "b", "c", f"w{i // 4}"], "x", i) for i in range(24)]
    df = spark.createDataFrame(rows, "id long, words array<string>, label string, at int").withColumn("ts", F.timestamp_seconds("at"))
    got = similarity.top_similar(df.where("id % 2 = 0"), df.where("id % 2 = 1"), "id", "id", "words", 0.62, 5, None, "label", ["ts"], time="ts").collect()
    assert len(calls) == 2 and len(got) == 12 * 5
