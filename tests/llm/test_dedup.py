"""Exact, near and passage dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_support import SCHEMA, edge, edge_rows, empty, row  # noqa: F401
from xxhash import xxh64_intdigest

from logpulse.llm import simhash, suffix_dedup
from logpulse.llm.components import connected_components
from logpulse.llm.exact_dedup import drop_exact_copies, exact_groups
from logpulse.llm.induced_sort import permuted_prefixes, suffix_array


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_groups_equal_brute_force(edge):
    rows = edge_rows()
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    want = sorted(((r[0], min((x for x in groups[norm(r[1])] if x is not None), default=None),
                    len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows), key=str)
    got = exact_groups(edge).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_groups_across_partition_borders(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot text', concat('t ', id)) as text")
    got = exact_groups(docs.repartition(5)).where("doc_id % 3 = 0").selectExpr(
        "min(keep_id) k", "max(keep_id) m", "min(group_size) g", "sum(int(kept)) n").first()
    assert tuple(got) == (0, 0, 1000, 1)


def test_drop_exact_copies_keeps_one_row_of_each(edge, empty):
    kept = drop_exact_copies(edge)
    assert kept.columns == edge.columns
    texts = [norm(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r[1]) for r in edge_rows()})
    assert exact_groups(empty).count() == 0 and drop_exact_copies(empty).count() == 0


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    return {n: find(n) for n in nodes}


def test_near_groups_equal_brute_force(edge):
    rows = edge_rows()
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, f in zip(rows, fps, strict=True):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    want = sorted(((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(rows, fps, strict=True)), key=str)
    got = simhash.near_groups(edge).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("bucket_pairs", [64, 1])
def test_links_connect_all_within_two_bits(spark, bucket_pairs):
    rnd = random.Random(3)
    fps = set()
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(8):
            fps.add(f)
            for _ in range(rnd.randint(1, 3)):
                f ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame(signed, "fp long, node long")
    got = {r.u: r.v for r in connected_components(simhash.fingerprint_links(nodes, 2, bucket_pairs)).collect()}
    number = {f: i for i, f in enumerate(fps)}
    assert {f: got.get(number[f], number[f]) for f in fps} == {f: number[w] for f, w in want.items()}


def test_drop_near_copies(edge, empty):
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    # of the two without an id one is a copy of document 6
    assert 26 not in ids and 0 in ids and ids.count(None) == 1 and 6 in ids
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0


def test_rows_without_or_with_one_id_lose_only_their_copies(spark):
    rnd = random.Random(71)
    prose = [" ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(80)) for _ in range(4)]
    rows = [row(None, prose[0]), row(None, prose[0].upper()), row(None, prose[1]), row(5, prose[2]), row(5, prose[3]),
            row(5, prose[3]), row(7, prose[2]), row(None, prose[2]), row(9, prose[1])]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((str(r.doc_id), prose.index(r.text.lower())) for r in kept) == sorted(
        [("None", 0), ("5", 2), ("5", 3), ("9", 1)])


def brute_repeats(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out, seen, waiting, last = [], set(), [], object()
    for d, text in ((r[0], r[1]) for r in rows):
        if d != last:
            seen.update(waiting)
            waiting, last = [], d
        raw = (text or "").encode()
        mask = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if raw[p:p + 50] in seen:
                mask[p:p + 50] = b"\1" * 50
            waiting.append(raw[p:p + 50])
        kept = bytes(b for b, m in zip(raw, mask, strict=True) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and not (i and mask[i - 1]))
        out.append((d, len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_equal_brute_force(edge, empty, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    got = suffix_dedup.without_repeats(edge)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute_repeats(edge_rows())
    if hot > 1:
        assert suffix_dedup.without_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_texts_that_share_an_id_or_have_none_lose_their_own_bytes(spark, monkeypatch, hot):
    """A passage at other offsets in each text, in some cut off at other ends."""
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    rnd = random.Random(37)
    noise = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    passage, other = noise(150), noise(120)
    rows = [row(1, noise(40) + passage + noise(500)), row(9, other + noise(30))]
    rows += [row(i, noise(k) + passage[5 * n:150 - 9 * n] + noise(20 * n)) for n, (i, k) in enumerate(
        [(None, 900), (None, 3), (None, 71), (4, 600), (4, 0), (4, 33)])]
    rows += [row(None, noise(7) + other[10:] + noise(5)), row(None, noise(300) + other[:80]), row(4, noise(11) + other)]
    rows += [rows[3], rows[-1]]  # repeated rows
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute_repeats(rows)


def test_segments_left_out_share_no_string():
    rnd = random.Random(79)
    word = lambda: bytes(rnd.choices(b"abcd", k=rnd.randint(8, 14)))
    words = [word() for _ in range(40)]
    left_out = 0
    for _ in range(30):
        raws = [b" ".join(rnd.choices(words, k=40)) for _ in range(6)]
        raws += [raws[0][:150] + raws[1][70:], raws[2][100:300], b"ab" * 80 + raws[3][:90]]
        held = {}
        for raw in raws:
            for k, a, n in zip(*suffix_dedup.segments(raw), strict=True):
                held.setdefault(int(k), set()).add(raw[a:a + n + 49])
        contents = sorted({c for cs in held.values() if len(cs) > 1 for c in cs})
        keep = suffix_dedup.may_share(contents)
        strings = {}
        for i, c in enumerate(contents):
            for p in range(len(c) - 49):
                strings.setdefault(c[p:p + 50], set()).add(i)
        for s in strings.values():
            if len(s) > 1:
                assert all(keep[i] for i in s)
        left_out += int((~keep).sum())
    assert left_out > 100


def test_suffix_arrays_equal_sorting():
    rnd = random.Random(1)
    for _ in range(200):
        s = [rnd.randint(2, rnd.choice([2, 3, 9])) for _ in range(rnd.randint(1, 80))] + [0]
        assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_permuted_prefixes():
    rnd = random.Random(2)
    parts = [[rnd.randint(2, 3) for _ in range(rnd.randint(1, 30))] for _ in range(20)]
    s, first = [], []
    for p in parts:
        first.append(len(s))
        s += [*p, 1]
    t = np.array([*s, 0])
    length = np.array([len(p) for p in parts])
    sa = suffix_array(t)
    got = permuted_prefixes(t, sa, np.array(first), length, 10, 1)
    place = {int(p): i for i, p in enumerate(sa)}
    for f, n in zip(first, length, strict=True):
        for p in range(f, f + n):
            q, same = int(sa[place[p] - 1]), 0
            while same < 10 and t[p + same] > 1 and t[p + same] == t[q + same]:
                same += 1
            assert got[p] == same


def test_segments_give_equal_strings_equal_keys():
    rnd = random.Random(4)
    passage = bytes(rnd.choices(b"abc ", k=90))
    keys = []
    for _ in range(20):
        raw = bytes(rnd.choices(b"abc ", k=rnd.randint(0, 90))) + passage + bytes(rnd.choices(b"abc ", k=700)) + b"z" * 900
        key, first, strings = suffix_dedup.segments(raw)
        assert int(strings.sum()) == len(raw) - 49 and strings.max() <= suffix_dedup.MAX_STRINGS
        each = np.repeat(key, strings)
        at = raw.index(passage)
        keys.append(each[at:at + 41].tolist())
    assert all(k == keys[0] for k in keys)
