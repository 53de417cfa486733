"""Mixing, sharding, packing, preference pairs and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm_support import SCHEMA, SF, edge, edge_rows, empty, row  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logpulse.llm import mixing, packing, sharding
from logpulse.llm.preference import answered_otherwise, neighbour_pairs, preference_pairs, preference_turns
from logpulse.llm.queries import ORACLE_SQL, QUERIES
from logpulse.llm.tokens import token_ids


def n_words(t):
    return len((t or "").encode().split())


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Reshares the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        target = {s: cap * sizes[s] if s in capped else left * w[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_targets_equal_resharing(spark):
    for sizes in ({"a": 1000, "b": 5, "c": 5, None: 7, "é": 90, "z": 0}, {"a": 10}, {"a": 0}, {"b": 1, "a": 100, "c": 100}):
        frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        want = brute_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_meets_targets_and_repeats_itself(edge, empty):
    rows = mixing.mix_report(edge).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_report(edge.repartition(7)).collect()), key=str)
    assert sorted((r.doc_id, r["size"]) for r in rows if r.doc_id is not None) == sorted(
        (r[0], n_words(r[1])) for r in edge_rows() if r[0] is not None)
    assert all(r.taken <= 3 * r["size"] for r in rows)
    by_target = defaultdict(lambda: [0, 0])
    for r in rows:
        by_target[(r.source_size, r.target)][0] += r.taken
    assert all(abs(taken - target) <= 1 for (_, target), (taken, _) in by_target.items())
    assert mixing.mix_report(empty).count() == 0


def test_tree_deals_out_disjoint_blocks(spark, edge):
    sizes, blocks = mixing.mixed_blocks(edge, shards=8)
    rows = blocks.collect()
    assert len({(r.doc_id, r.source_key, r["size"], r["copy"], r["pass"], r.block) for r in rows}) == len(rows)
    per = Counter(r.shard for r in rows)
    assert set(per) <= set(range(8)) and max(per.values()) - min(per.get(k, 0) for k in range(8)) <= 3


def test_shards_of_the_tree_reach_the_report_and_the_rows(spark, edge):
    sizes, blocks = mixing.mixed_blocks(edge)
    want = Counter()
    for r in blocks.collect():
        want[r.doc_id, r["size"], r.copy, r.shard] += r.drawn
    got = Counter()
    for r in mixing.mix_report(edge).collect():
        parts = [tuple(map(int, p.split(":"))) for p in r.shards.split(",") if p]
        assert sum(t for _, t in parts) == r.taken and parts == sorted(parts)
        for shard, t in parts:
            got[r.doc_id, shard] += t
    summed = Counter()
    for (d, _, _, shard), t in want.items():
        summed[d, shard] += t
    assert got == summed and len({s for _, s in got}) > 8
    first = {}
    for r in blocks.collect():
        k = (r.doc_id, r.source_key, r["size"], r["pass"], r.copy)
        first[k] = min(first.get(k, (r.first, r.shard, r.place)), (r.first, r.shard, r.place))
    places = {d: {(s, p) for (x, *_), (_, s, p) in first.items() if x == d} for d in {k[0] for k in first}}
    rows = mixing.mixed_documents(edge).select("doc_id", F.spark_partition_id().alias("part"),
                                               F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    assert len(rows) == len(first)
    for part in {r.part for r in rows}:
        low = (-1, -(1 << 63))  # some place of each row comes after one of the row before
        for r in (r for r in rows if r.part == part):
            low = min(p for p in places[r.doc_id] if p >= low)


def test_tree_draws_follow_the_multivariate_hypergeometric():
    quotas, shards, runs = [12, 30, 18], 4, 600
    total = sum(quotas)
    frame = pd.DataFrame({"source_key": ["a", "b", "c"], "quota": quotas})
    drawn = np.array([[np.diff([0, *x["ends"].iloc[0]]) for x in mixing._tree(shards, seed)(iter([frame]))] for seed in range(runs)])
    assert (drawn.sum(axis=2) == quotas).all() and (drawn.sum(axis=1) == total // shards).all()
    n = total // shards
    for s, q in enumerate(quotas):
        mean, var = n * q / total, n * q / total * (1 - q / total) * (total - n) / (total - 1)
        for j in range(shards):
            x = drawn[:, s, j]
            assert abs(x.mean() - mean) < 4.5 * (var / runs) ** 0.5 and 0.75 < x.var() / var < 1.3


def test_matrix_draws_follow_the_hypergeometric(spark):
    sizes = spark.createDataFrame([(0, 12), (1, 20), (2, 16)], "part long, n long").cache()
    draws = np.array([[np.diff([0, *r.ends]) for r in sorted(sharding.communication_matrix(sizes, 48, 4, 4, seed).collect(), key=lambda r: r.part)]
                      for seed in range(60)])
    for p, q in enumerate((12, 20, 16)):
        mean, var = q / 4, 12 * q / 48 * (1 - q / 48) * (48 - 12) / 47
        assert (abs(draws[:, p].mean(axis=0) - mean) < 4.5 * (var / 60) ** 0.5).all()
        assert 0.45 < draws[:, p].var() / var < 1.8


def test_mixed_documents_hold_the_taken_words(edge):
    docs = mixing.mixed_documents(edge)
    assert docs.columns == edge.columns
    taken = Counter()
    for r in docs.collect():
        taken[(r.doc_id, r.source)] += n_words(r.text)
        assert r.n_chars == len(r.text)
    want = Counter()
    source = {r[0]: r[3] for r in edge_rows()}
    for r in mixing.mix_report(edge).collect():
        want[(r.doc_id, source[r.doc_id])] += r.taken
    assert taken == +want


def test_shards_are_gapless_and_within_one_row(spark, edge, empty):
    rows = sharding.shuffled(edge.select("doc_id", "text"), 8, rows_per_partition=4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(edge_rows())
    assert sharding.shuffled(empty).count() == 0


def test_hypergeometric_draws_follow_their_distribution(spark):
    from math import comb

    from pyspark.sql import functions as F

    n = 20_000
    u = (F.col("id") + 0.5) / n
    got = Counter(r[0] for r in spark.range(n).select(sharding.hypergeometric(
        F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(12).cast("long"), u)).collect())
    for k in range(13):
        want = n * comb(20, k) * comb(30, 12 - k) / comb(50, 12)
        assert abs(got[k] - want) <= 1.01


def test_matrix_keeps_row_and_column_sums(spark):
    sizes = [(p, 37 * (p % 5)) for p in range(16) if p % 5]
    total = sum(n for _, n in sizes)
    rows = sharding.communication_matrix(spark.createDataFrame(sizes, "part long, n long"), total, 16, 8, 1).collect()
    m = np.array([np.diff([0, *r.ends]) for r in sorted(rows, key=lambda r: r.part)])
    assert (m >= 0).all() and m.sum(axis=1).tolist() == [dict(sizes).get(p, 0) for p in range(16)]
    assert m.sum(axis=0).max() - m.sum(axis=0).min() <= 1


def brute_schedule(totals, whole, weights=None):
    """Source of each token: the one whose next token is due first."""
    sent, out, rate = [0] * len(totals), [], weights or totals
    for _ in range(whole):
        s = min((s for s in range(len(totals)) if sent[s] < totals[s]), key=lambda s: (Fraction(2 * sent[s] + 1, rate[s]), s))
        sent[s] += 1
        out.append(s)
    return out


@pytest.mark.parametrize("totals, weights", [
    ([5], None), ([1, 1, 1], None), ([700, 1, 13, 90], None), ([64, 64, 63], None), ([1000, 3], None),
    ([100, 300, 50], [1, 1, 1]), ([700, 1, 13, 90], [3, 2, 7, 1]), ([64, 64, 63], [5, 1, 1]), ([40, 40], [1, 1000]), ([9], [4])])
def test_sent_before_equals_one_token_at_a_time(totals, weights):
    whole = sum(totals)
    order = brute_schedule(totals, whole, weights)
    x = np.arange(whole + 1)
    got = packing.sent_before(x, np.array(totals), None if weights is None else np.array(weights))
    want = np.array([[order[:i].count(s) for s in range(len(totals))] for i in x])
    assert (got == want).all() and (np.diff(got, axis=0) >= 0).all()


def test_sent_before_stays_exact_beyond_64_bits():
    totals, weights = np.array([3 * 10**12, 10**12 + 7, 5]), np.array([7, 10**9, 1])
    x = np.array([0, 4096, 10**12, 10**12 + 8, 4 * 10**12 - 1, int(totals.sum())])
    got = packing.sent_before(x, totals, weights)
    assert (got.sum(axis=1) == x).all() and (np.diff(got, axis=0) >= 0).all() and got[-1].tolist() == totals.tolist()


@pytest.mark.parametrize("weights", [None, [1, 6, 2, 1]])
def test_pieces_of_documents_equal_a_walk_over_the_schedule(monkeypatch, weights):
    rnd = random.Random(61)
    monkeypatch.setattr(packing, "WINDOW", 16)
    monkeypatch.setattr(packing._Windows, "CHUNK", 8)
    docs = [(rnd.randrange(4), rnd.choice([1, 2, 5, 40, 300])) for _ in range(60)]
    totals = [sum(n for q, n in docs if q == s) for s in range(4)]
    order, place, want = brute_schedule(totals, sum(totals), weights), [0] * 4, []
    sent, position = [0] * 4, {}
    for w in range(0, len(order), 16):
        run = sorted(order[w:w + 16])
        for offset, s in enumerate(run):
            position[s, sent[s]] = (w // 16, offset)
            sent[s] += 1
    places = []
    for d, (q, n) in enumerate(docs):
        places.append(place[q])
        for t in range(n):
            want.append((d, t, *position[q, place[q] + t]))
        place[q] += n
    windows = packing._Windows(totals, weights or totals)
    got = windows.pieces(np.array([q for q, _ in docs]), np.array(places), np.array([n for _, n in docs]))
    tokens = sorted((int(d), int(a) + i, int(w), int(o) + i) for d, a, k, w, o in zip(*got, strict=True) for i in range(k))
    assert tokens == sorted(want)


def test_small_sources_share_queues_and_windows_meet_the_weights(spark):
    rnd = random.Random(67)
    word = lambda: "".join(rnd.choices("etaoin", k=4))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [row(i, text(400), "en", "ab"[i % 2]) for i in range(80)] + [row(1000 + i, text(3), "en", f"tiny{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tokens = packing.packed_tokens(docs)
    parts = tokens.groupBy("pid", "source_key").agg(F.sum("doc_tokens").alias("n"))
    plan = packing.queue_plan(parts, queues=20).collect()
    assert {r.queue for r in plan if r.source_key in ("=a", "=b")} == {"=a", "=b"}
    common = {r.queue for r in plan if r.source_key.startswith("=tiny")}
    assert len(common) <= 20 and all(q.startswith("+") for q in common)
    pieces = packing.packed_pieces(docs, weights={"a": 1, "b": 3}).collect()
    source = {r[0]: r[3] for r in rows}
    share = Counter()
    for r in pieces:
        share[r.sequence_id, source[r.doc_id]] += r.length
    first = {s: share[0, s] for s in "ab"}
    assert abs(first["b"] - 3 * first["a"]) <= 4 and sum(r.length for r in pieces) == tokens.agg(F.sum("doc_tokens")).first()[0]
    with pytest.raises(ValueError):
        packing.packed_pieces(docs, weights={"a": 0})


def test_pieces_hold_every_token_once(edge, empty):
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = {r[0]: [*t.encode(r[1] or "", add_special_tokens=False).ids, packing.END_ID] for r in edge_rows()}
    rows = [r for r in packing.packed_pieces(edge).collect()]
    places = defaultdict(list)
    by_doc = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for w, parts in places.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == packing.WINDOW or (w == max(places) and at <= packing.WINDOW)
    repeats = Counter(r[0] for r in edge_rows())
    for d, parts in by_doc.items():
        if repeats[d] == 1:
            parts.sort(key=lambda r: r.start)
            assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
            for p in parts:
                assert p.doc_tokens == len(ids[d])
                assert p.ids_crc32 == zlib.crc32(np.array(ids[d][p.start:p.start + p.length], "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(
        len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in edge_rows())
    assert packing.packed_pieces(empty).count() == 0


def test_cached_ids_equal_the_tokenizer():
    path = public_tokenizers.path(packing.VOCABULARY)
    t = Tokenizer.from_file(path)
    texts = ["Don't STOP, it's 1234!!", "Ünḯcóde 　 ideographic 中文 ΣΟΦΟΣ İstanbul", "a\x1cb\x85c\xa0d", "",
             "<|endoftext|> x", "é é", "mixed'S 'LL we'll 12ab ab12 ..!? ​ z", "👍🏽 ok"]
    for x in texts:
        assert np.frombuffer(token_ids(path).encode(x), "<u2").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_preference_prompt_is_the_longest_common_prefix(spark, empty):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "r"), (0, 3, "assistant", "good"),
            (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "bad"),
            (1, 3, "assistant", "bad"), (2, 0, "user", "alone"), (None, 0, "user", "lost"),
            (4, None, None, None), (5, None, None, None), (6, 0, "user", "x"), (7, 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.pair_id, r.side, r.turn, r.role, r.train) for r in preference_turns(neighbour_pairs(frame)).collect())
    assert got == sorted([
        (0, "prompt", 0, "user", False), (0, "prompt", 1, "assistant", False), (0, "prompt", 2, "user", False),
        (0, "chosen", 3, "assistant", True), (0, "rejected", 3, "assistant", True), (1, "chosen", 0, "user", False),
        (2, "prompt", -1, "unknown", False), (3, "chosen", 0, "user", False), (3, "rejected", 1, "user", False)])
    assert preference_turns(neighbour_pairs(frame.limit(0))).count() == 0


def test_preference_pairs_share_a_prompt(spark, empty):
    chat = [("user", "q1"), ("assistant", "a1"), ("user", "é2"), ("assistant", "a2"), ("user", "bye")]
    rows = [(c, i, role, f"{text} of {c}") for c in range(6) for i, (role, text) in enumerate(chat[:2 + c % 4])]
    rows += [(10, 0, "user", "nobody answers"), (None, 0, "assistant", "lost"), (11, None, None, None), (11, 1, "assistant", ""),
             (11, 1, "assistant", ""), (12, 0, "assistant", "tie b"), (12, 0, "assistant", "tie a")]
    schema = "conv_id long, turn long, role string, text string"
    got = {r.pair_id: r for r in preference_pairs(answered_otherwise(spark.createDataFrame(rows, schema).repartition(3))).collect()}
    assert set(got) == {*range(6), 11, 12}
    for c in range(6):
        turns = chat[:2 + c % 4]
        turns = turns[:max(i for i, t in enumerate(turns) if t[0] == "assistant") + 1]
        render = lambda ts: "".join(f"<|{role}|>\n{t} of {c}<|end|>\n" for role, t in ts)  # noqa: B023, E731
        assert got[c].prompt == render(turns[:-1]) and got[c].chosen == render(turns[-1:])
        a, b = map(int, got[c].chosen_train.split(":"))
        assert got[c].chosen[a:b] == f"{turns[-1][1]} of {c}<|end|>\n"
        a, b = map(int, got[c].rejected_train.split(":"))
        assert got[c].rejected[a:b].endswith("<|end|>\n") and got[c].rejected != got[c].chosen
    assert got[11].prompt.startswith("<|unknown|>\n<|end|>") and got[11].chosen_train == "14:22"
    assert len(got[12].chosen_train.split(",")) == 2  # both of the tie
    none = spark.createDataFrame([], schema)
    assert preference_pairs(answered_otherwise(none)).count() == 0
    assert preference_pairs(answered_otherwise(spark.createDataFrame([(1, 0, "assistant", "alone")], schema))).count() == 0


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, key):
    from logpulse.plans.compare import compare, duck_connection

    want = duck_connection(SF).execute(ORACLE_SQL[key]).df()
    assert compare(QUERIES[key](spark, SF).toPandas(), want) is None


def test_pipeline_run_leaves_the_tables_of_its_last_stage_only(spark):
    import os

    import corpus_pipeline
    from logpulse.llm import common
    from logpulse.llm.common import documents, written

    since = len(common.made)
    pieces = corpus_pipeline.run(spark, SF)
    names = [os.path.basename(p).rsplit("-", 1)[0] for p in common.made[since:]]
    assert names[0] == "stage_mix_sources" and set(names[1:]) <= {"pack_tokens", "pack_parts", "pack_plan"}
    assert all(os.path.isdir(p.removeprefix("file:")) for p in common.made[since:])
    docs = documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"again_{name}")
    again = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    total = lambda p: p.groupBy("doc_id").agg(F.sum("length").alias("n")).orderBy("doc_id").collect()
    assert total(pieces) == total(again)


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    import corpus_pipeline
    from logpulse.llm.common import documents, written

    docs = documents(spark, SF)
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), f"test_{name}")
        assert out.columns == docs.columns, name
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "simhash_near_dedup", "mix_sources", "pack_windows"]
