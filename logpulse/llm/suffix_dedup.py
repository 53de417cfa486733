"""Removal of repeated passages by suffix arrays built per shard with induced sorting.

A byte goes when a 50-byte string covering it also starts in a document with
a smaller doc_id. Shards must bring equal 50-byte strings together without
sending every suffix, so each string is keyed by the smallest hash of its
20-byte substrings: equal strings have equal keys, and a run of neighbouring
strings with one key travels as one segment (about one per 17 bytes).

1. Each task lists its (key, segment) pairs, packed per bucket of keys. Of equal
   segments in a task only that of the smallest doc_id is listed as a candidate: the others
   are copies already, and go as such. So however many documents hold a segment,
   a bucket meets it once a task. Buckets grow in number with the input. A
   bucket keeps the keys that several documents hold; of equal segments the one of
   the smallest doc_id represents all, and the other holders lose every string of
   it, as the representative starts it before them. A representative without another
   segment of its key has no strings in common with any other: it needs no sorting.
2. Representatives are cut from the texts and sent to the shard of their
   key. Each shard leaves out the segments that agree with no other in enough bytes
   beside the key's place to have a string in common, sorts the suffixes of the rest, takes the permuted
   common prefixes, and in every stretch of suffixes that share 50 bytes the
   strings of larger doc_ids than the smallest go. Keys with more than
   ``HOT_SEGMENTS`` representatives send single strings, sharded by the whole
   string, so no shard holds a common passage's contexts at once.
3. Removed ranges, packed per text and shard, meet the texts again (by the same exchange of
   the compressed texts as in 2), and what is left is hashed. Texts with one doc_id, or none,
   have numbers that keep them apart; only doc_ids decide which string comes first.

Keys and segments are compared by 40-bit and 46-bit hashes together; segments
of one shard are compared by bytes.

Defined cases: a null text counts as empty; matches never cross documents; texts
under 50 bytes lose nothing; rows with one doc_id never remove from each
other; null doc_ids count as larger than all, and so does 2^63 - 1; repeated rows give
repeated result rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import document_columns, documents, partitions, text_or_empty, written
from .induced_sort import permuted_prefixes, suffix_array

SPAN = 50
GRAM = 20
#: Longer runs of strings with one key are cut, which no equality depends on.
MAX_STRINGS = 512
#: Segments a task holds before it sends its packed lists; segments a bucket is meant to have.
PACK_ROWS = 2_000_000
BUCKET_ROWS = 1_000_000
#: (doc_id, checksum) of texts that share a doc_id are broadcast up to here, and joined beyond.
BROADCAST_SHARED = 200_000
HOT_SEGMENTS = 20_000
#: Bytes of segments that a task holds, and that one suffix array is built over, at least one key.
SHARD_BYTES = 4_000_000
SORT_BYTES = 1_500_000
NO_ID = 2**63 - 1

_MULTIPLIER = 0x9E3779B97F4A7C15
_MIXER = np.uint64(0xD6E8FEB86659FD93)
_POWER = {k: np.uint64(pow(_MULTIPLIER, k, 1 << 64)) for k in (1, 2, 4, 8, 16)}


def _gram_hashes(a: np.ndarray) -> np.ndarray:
    """A hash of each GRAM-byte substring: polynomials of 1, 2, 4, 8, 16 bytes, then 16 + 4."""
    h, four = a, None
    for k in (1, 2, 4, 8):
        h = h[:-k] * _POWER[k] + h[k:]
        four = h if k == 2 else four
    m = len(a) - GRAM + 1
    h = h[:m] * _POWER[4] + four[16:16 + m]
    h = (h ^ (h >> np.uint64(32))) * _MIXER
    return h ^ (h >> np.uint64(32))


def segments(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first byte, number of strings) of the runs of SPAN-byte strings with one key."""
    if len(raw) < SPAN:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    m = _gram_hashes(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1))
    width, n = SPAN - GRAM + 1, 1
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    if n < width:
        m = np.minimum(m[:n - width], m[width - n:])
    first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
    strings = np.diff(np.r_[first, len(m)])
    if strings.max() > MAX_STRINGS:
        parts = -(-strings // MAX_STRINGS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole_first, whole = np.repeat(first, parts), np.repeat(strings, parts)
        first = whole_first + nth * MAX_STRINGS
        strings = np.minimum(whole - nth * MAX_STRINGS, MAX_STRINGS)
    return m[first] >> np.uint64(24), first, strings  # 40 bits of the key


def _segment_hashes(raw: bytes, first: np.ndarray, strings: np.ndarray) -> np.ndarray:
    return np.array([xxh64_intdigest(raw[a:b], 3) & ((1 << 46) - 1) for a, b in zip(
        first.tolist(), (first + strings + SPAN - 1).tolist(), strict=True)], dtype=np.uint64)


#: Segment hashes have 46 bits of 48: in lists the highest bit marks a candidate that has copies in its own
#: task, in roles the two highest are the role (0 copy, 1 own, 2 own with a hot key).
_SEGMENT_MASK = np.uint64((1 << 46) - 1)
_ROLE = np.uint64(46)


def _short(v: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number."""
    return np.ascontiguousarray(v.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_short(raw: bytes, width: int) -> np.ndarray:
    v = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    v[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return v.view("<u8").ravel()


def _starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where any of the sorted columns changes."""
    changed = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        changed |= c[1:] != c[:-1]
    return np.r_[True, changed] if len(columns[0]) else changed


_LISTS = "bucket int, kind int, low binary, high binary, subs binary, counts binary, keys binary, segs binary"


def _list_segments(n_buckets: int):
    """Texts -> per bucket, packed lists of candidates (kind 0: keys and segments) and of copies
    (kind 1: segments), with how many each text has."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in (
        "low", "high", "subs", "counts", "keys", "segs")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, int, int]] = []
        rows = 0

        def pack() -> pa.RecordBatch:
            order = sorted(range(len(held)), key=lambda i: held[i][2:])  # by doc_id and number
            ids, subs = (np.array([held[i][k] for i in order], dtype="<i8") for k in (2, 3))
            keys = np.concatenate([held[i][0] for i in order])
            segs = np.concatenate([held[i][1] for i in order])
            text = np.repeat(np.arange(len(order)), [len(held[i][0]) for i in order])
            # equal segments have equal keys; the one of the smallest doc_id in this task comes first
            by = np.argsort(segs, kind="stable")
            g, d = segs[by], ids[text[by]]
            start = np.flatnonzero(_starts_of(g))
            size = np.diff(np.r_[start, len(g)])
            copy = d != np.repeat(d[start], size)
            many = np.repeat(np.logical_or.reduceat(copy, start), size) & ~copy
            is_copy, marked = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
            is_copy[by], marked[by] = copy, many
            segs = segs | (marked.astype(np.uint64) << np.uint64(47))
            # candidates go by their key, what is settled all together by its text
            own = ((ids ^ subs).view("<u8") * _MIXER >> np.uint64(24)) % np.uint64(n_buckets)
            part = np.where(is_copy, own[text], keys % np.uint64(n_buckets)).astype(np.int64) * 2 + is_copy
            by = np.argsort(part.astype(np.uint16) if 2 * n_buckets < 1 << 16 else part, kind="stable")  # texts stay in order
            cuts = np.searchsorted(part[by], np.arange(2 * n_buckets + 1))
            out = []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                at = by[cuts[p]:cuts[p + 1]]
                t = text[at]
                # a text has an entry for each 255 of its segments
                run = np.arange(len(t)) - np.maximum.accumulate(np.where(_starts_of(t), np.arange(len(t)), 0))
                new = np.flatnonzero(run % 255 == 0)
                count = np.diff(np.r_[new, len(t)])
                whole = ids[t[new]].view("<u8")
                out.append((p // 2, p % 2, (whole & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                            (whole >> np.uint64(32)).astype("<u4").tobytes(), subs[t[new]].tobytes(),
                            count.astype("u1").tobytes(),
                            b"" if p % 2 else _short(keys[at], 5), _short(segs[at], 6)))
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                                   schema=schema)

        for batch in batches:
            for d, x, text in zip(*[batch[c].to_pylist() for c in ("id", "sub", "text")], strict=True):
                raw = text.encode()
                key, first, strings = segments(raw)
                if len(key):
                    seg = _segment_hashes(raw, first, strings)
                    once = np.unique(seg, return_index=True)[1]  # a document's repeats count once
                    held.append((key[once], seg[once], d, x))
                    rows += len(once)
            if rows >= PACK_ROWS:
                yield pack()
                held.clear()
                rows = 0
        if held:
            yield pack()

    return run


_ROLES = "id long, sub long, roles binary"


def _packed_roles(ids: np.ndarray, subs: np.ndarray, role: np.ndarray, segs: np.ndarray) -> pa.RecordBatch:
    """Rows sorted by text -> one row a text: its segments with their roles.

    One column, so that every reader asks for the same."""
    new = np.flatnonzero(_starts_of(ids, subs))
    raw = _short(segs | (role.astype(np.uint64) << _ROLE), 6)
    at = (6 * np.r_[new, len(ids)]).tolist()
    return pa.record_batch([pa.array(ids[new], pa.int64()), pa.array(subs[new], pa.int64()),
                            pa.array([raw[a:b] for a, b in zip(at, at[1:], strict=False)], pa.binary())], names=["id", "sub", "roles"])


def _roles_of(parts: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The segments of a text and their roles, from its packed rows."""
    v = _from_short(b"".join(parts or []), 6)
    return v & _SEGMENT_MASK, v >> _ROLE


def _assign_roles(hot_segments: int):
    """Lists sorted by bucket and kind -> per text: segments it repeats from a smaller
    doc_id, segments it represents, and those of them with a hot key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
            ids = (np.frombuffer(row["low"], "<u4").astype(np.uint64) | np.frombuffer(row["high"], "<u4").astype(np.uint64) << np.uint64(32))
            counts = np.frombuffer(row["counts"], "u1")
            return np.repeat(ids.view(np.int64), counts), np.repeat(np.frombuffer(row["subs"], "<i8"), counts)

        def decide(lists: list[dict]) -> pa.RecordBatch | None:
            parts = [texts(x) for x in lists]
            doc, text = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            key = np.concatenate([_from_short(x["keys"], 5) for x in lists])
            seg = np.concatenate([_from_short(x["segs"], 6) for x in lists])
            many, seg = seg >> np.uint64(47) > 0, seg & _SEGMENT_MASK
            order = np.lexsort((text, doc, seg, key))
            key, seg, doc, text, many = key[order], seg[order], doc[order], text[order], many[order]
            # repeated rows count once
            first = np.flatnonzero(_starts_of(key, seg, doc, text))
            many = np.logical_or.reduceat(many, first)
            key, seg, doc, text = key[first], seg[first], doc[first], text[first]
            new_key = _starts_of(key)
            new_seg = _starts_of(key, seg)
            first_key = np.flatnonzero(new_key)
            of_key = np.cumsum(new_key) - 1
            shared = (np.minimum.reduceat(doc, first_key) != np.maximum.reduceat(doc, first_key)) | np.logical_or.reduceat(many, first_key)
            n_own = np.add.reduceat(new_seg.astype(np.int64), first_key)
            least = doc[np.flatnonzero(new_seg)][np.cumsum(new_seg) - 1]
            # texts of one doc_id represent it together; a segment alone with its key has no other to be sorted with
            own = (doc == least) & shared[of_key] & (n_own > 1)[of_key]
            copy = (doc > least) & shared[of_key]
            role = np.where(copy, 0, np.where(own, np.where(n_own[of_key] > hot_segments, 2, 1), -1))
            at = np.flatnonzero(role >= 0)
            if not len(at):
                return None
            at = at[np.lexsort((role[at], text[at], doc[at]))]
            return _packed_roles(doc[at], text[at], role[at], seg[at])

        lists: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"]:  # settled in its task
                    ids, subs = texts(row)
                    yield _packed_roles(ids, subs, np.zeros(len(ids), dtype=np.int64), _from_short(row["segs"], 6))
                    continue
                if lists and row["bucket"] != lists[0]["bucket"]:
                    if (out := decide(lists)) is not None:
                        yield out
                    lists = []
                lists.append(row)
        if lists and (out := decide(lists)) is not None:
            yield out

    return run


_SEGMENTS = "shard_key long, id long, sub long, first int, bytes binary"


def _cut_representatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts with their roles -> the segments (or, of hot keys, the strings) to sort."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for d, x, z, roles in zip(*[batch[c].to_pylist() for c in ("id", "sub", "z", "roles")], strict=True):
            segs, role = _roles_of(roles)
            own, hot = segs[role == 1], segs[role == 2]
            if not len(own) and not len(hot):
                continue
            raw = unpack(z)
            key, first, strings = segments(raw)
            seg = _segment_hashes(raw, first, strings)
            for i in np.flatnonzero(np.isin(seg, own)).tolist():
                a = int(first[i])
                for values, v in zip(out, (int(key[i]), d, x, a, raw[a:a + int(strings[i]) + SPAN - 1]), strict=True):
                    values.append(v)
            for i in np.flatnonzero(np.isin(seg, hot)).tolist() if len(hot) else ():
                for a in range(int(first[i]), int(first[i] + strings[i])):
                    piece = raw[a:a + SPAN]
                    for values, v in zip(out, (xxh64_intdigest(piece, 5) >> 1, d, x, a, piece), strict=True):
                        values.append(v)
        if out[0]:
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                   pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()),
                                   pa.array(out[4], pa.binary())],
                                  names=["shard_key", "id", "sub", "first", "bytes"])


def may_share(contents: list[bytes]) -> np.ndarray:
    """Which segments may have a SPAN-byte string in common with another one.

    Every string of a segment holds the gram with its smallest hash, and half of what the string has beside the gram
    lies on one side of it. So two segments with a common string agree in the gram and that half to its left
    or to its right; those that agree so with no other are left out."""
    length = np.array([len(c) for c in contents], dtype=np.int64)
    start = np.cumsum(length) - length
    a = np.frombuffer(b"".join(contents), np.uint8).astype(np.uint64) + np.uint64(1)
    h = _gram_hashes(a)
    seg = np.repeat(np.arange(len(contents)), length)
    inside = np.arange(len(h)) + GRAM <= (start + length)[seg[:len(h)]]
    least = np.minimum.reduceat(np.where(inside, h, np.uint64(0xFFFFFFFFFFFFFFFF)), start)
    at = np.flatnonzero(inside & (h == least[seg[:len(h)]]))
    half = (SPAN - GRAM) // 2
    beside = np.zeros(len(a) - half + 1, dtype=np.uint64)
    for i in range(half):
        beside = beside * _POWER[1] + a[i:len(a) - half + 1 + i]
    owner = seg[at]
    left, right = at - half >= start[owner], at + GRAM + half <= (start + length)[owner]
    value = np.r_[(beside[at[left] - half] ^ least[owner[left]]) * _MIXER,
                  (beside[at[right] + GRAM] + least[owner[right]]) * _POWER[2]]
    owner = np.r_[owner[left], owner[right]]
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    once = _starts_of(value, owner)
    value, owner = value[once], owner[once]
    first = np.flatnonzero(_starts_of(value))
    size = np.diff(np.r_[first, len(value)])
    out = np.zeros(len(contents), dtype=bool)
    out[owner[np.repeat(size > 1, size)]] = True
    return out


def repeated_strings(contents: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments and the smallest doc_id of each -> (segment, offset) of the SPAN-byte
    strings that some segment of a smaller doc_id has too."""
    length = np.array([len(c) for c in contents], dtype=np.int64)
    first = np.cumsum(length + 1) - length - 1
    t = np.r_[np.frombuffer(b"\n".join(contents), np.uint8).astype(np.int64) + 2, 1, 0]
    t[first[1:] - 1] = 1  # between segments
    sa = suffix_array(t)
    prefix = permuted_prefixes(t, sa, first, length, SPAN, 1)
    stretch = np.flatnonzero(np.r_[True, prefix[sa[1:]] < SPAN])
    size = np.diff(np.r_[stretch, len(sa)])
    many = np.flatnonzero(size > 1)
    if not len(many):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = np.repeat(size > 1, size)
    place = sa[inside]
    seg = np.searchsorted(first, place, side="right") - 1
    doc = docs[seg]
    starts = np.cumsum(size[many]) - size[many]
    gone = doc > np.repeat(np.minimum.reduceat(doc, starts), size[many])
    seg, offset = seg[gone], place[gone] - first[seg[gone]]
    order = np.lexsort((offset, seg))
    return seg[order], offset[order]


_RANGES = "id long, sub long, ranges binary"


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by shard key, doc_id and text -> byte ranges to remove, packed per text."""

    def frame(ids: list, subs: list, low: list, high: list) -> pa.RecordBatch:
        ids, subs = np.array(ids, dtype=np.int64), np.array(subs, dtype=np.int64)
        pairs = np.column_stack([np.array(low, dtype="<u4"), np.array(high, dtype="<u4")]) if len(ids) else np.zeros((0, 2), "<u4")
        order = np.lexsort((subs, ids))
        ids, subs, pairs = ids[order], subs[order], np.ascontiguousarray(pairs[order])
        new = np.flatnonzero(_starts_of(ids, subs))
        packed = [pairs[a:b].tobytes() for a, b in zip(new.tolist(), [*new[1:].tolist(), len(ids)], strict=False)] if len(ids) else []
        return pa.record_batch([pa.array(ids[new], pa.int64()), pa.array(subs[new], pa.int64()), pa.array(packed, pa.binary())],
                               names=["id", "sub", "ranges"])

    def work(held: dict[bytes, tuple], copies: list[list]) -> Iterator[pa.RecordBatch]:
        contents, owners = list(held), list(held.values())
        ids, subs, low, high = copies
        kept = np.flatnonzero(may_share(contents)).tolist()
        size, group = 0, []
        for i, at in enumerate(kept):
            group.append(at)
            size += len(contents[at]) + 1
            # equal strings have equal keys: cut between keys
            if i + 1 == len(kept) or (size >= SORT_BYTES and owners[kept[i + 1]][2] != owners[at][2]):
                seg, offset = repeated_strings([contents[k] for k in group], np.array([owners[k][0] for k in group], dtype=np.int64))
                runs = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (offset[1:] != offset[:-1] + 1)][:len(seg)])
                lasts = np.r_[runs[1:], len(seg)] - 1 if len(runs) else runs
                for s, a, b in zip(seg[runs].tolist(), offset[runs].tolist(), offset[lasts].tolist(), strict=True):
                    d, places, _ = owners[group[s]]
                    for x, p in places:
                        ids.append(d)
                        subs.append(x)
                        low.append(p + a)
                        high.append(p + b + SPAN)
                size, group = 0, []
        yield frame(ids, subs, low, high)

    held: dict[bytes, tuple] = {}
    copies: list[list] = [[], [], [], []]
    size, key = 0, None
    for batch in batches:
        for k, d, x, a, c in zip(*[batch[n].to_pylist() for n in ("shard_key", "id", "sub", "first", "bytes")], strict=True):
            if k != key and size >= SHARD_BYTES:
                yield from work(held, copies)
                held, copies, size = {}, [[], [], [], []], 0
            key = k
            if c not in held:
                held[c] = (d, [(x, a)], k)
                size += len(c) + 1
            elif held[c][0] == d:
                if held[c][1][-1] != (x, a):  # a repeated row
                    held[c][1].append((x, a))
            else:  # rows come by doc_id: an equal segment or string of a smaller one is held
                for values, v in zip(copies, (d, x, a, a + len(c)), strict=True):
                    values.append(v)
        if len(copies[0]) > PACK_ROWS:
            yield frame(*copies)
            copies = [[], [], [], []]
    if held:
        yield from work(held, copies)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for d, z, roles, ranges in zip(*[batch[c].to_pylist() for c in ("doc_id", "z", "roles", "ranges")], strict=True):
                raw = unpack(z)
                segs, role = _roles_of(roles)
                n, copies = len(raw), segs[role == 0]
                kept, gone, spans = raw, 0, 0
                if len(copies) or ranges:
                    change = np.zeros(n + 1, dtype=np.int32)
                    if len(copies):
                        _, first, strings = segments(raw)
                        hit = np.isin(_segment_hashes(raw, first, strings), copies)
                        np.add.at(change, first[hit], 1)
                        np.add.at(change, first[hit] + strings[hit] + SPAN - 1, -1)
                    if ranges:
                        pairs = np.frombuffer(b"".join(ranges), "<u4").reshape(-1, 2)
                        np.add.at(change, pairs[:, 0], 1)
                        np.add.at(change, pairs[:, 1], -1)
                    mask = np.cumsum(change[:-1]) > 0
                    gone = int(mask.sum())
                    spans = int((np.diff(np.r_[0, mask.astype(np.int8)]) == 1).sum())
                    kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                for values, v in zip(out, (d, n, gone, spans, sha256(kept).hexdigest(),
                                           kept if keep_bytes else None), strict=True):
                    values.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, types, strict=True)],
                                  names=[f.split()[0] for f in _RESULT.split(", ")])

    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which is what their exchange writes."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["id"], batch["sub"], pa.array(
            [pack(t.encode()) for t in batch["text"].to_pylist()], pa.binary())], names=["id", "sub", "z"])


def without_repeats(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """documents -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), a row per row.

    ``kept`` holds the remaining bytes (null without ``keep_bytes``)."""
    n = partitions(docs.sparkSession)
    texts = numbered_texts(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(n, size // 16 // BUCKET_ROWS)
    roles = (texts.mapInArrow(_list_segments(n_buckets), _LISTS)
             .repartition(n, "bucket").sortWithinPartitions("bucket", "kind")
             .mapInArrow(_assign_roles(HOT_SEGMENTS), _ROLES)
             .groupBy("id", "sub").agg(F.collect_list("roles").alias("roles")))  # bounded by the document's own length
    # left joins on purpose: both read the texts and the roles by the same exchanges
    packed = texts.mapInArrow(_compress, "id long, sub long, z binary").join(roles, ["id", "sub"], "left")
    ranges = (packed.mapInArrow(_cut_representatives, _SEGMENTS)
              .repartition(n, "shard_key").sortWithinPartitions("shard_key", "id", "sub", "first")
              .mapInArrow(_sort_shards, _RANGES)
              .groupBy("id", "sub").agg(F.collect_list("ranges").alias("ranges")))
    return (packed.join(ranges, ["id", "sub"], "left")
            .select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "z", "roles", "ranges")
            .mapInArrow(_remove(keep_bytes), _RESULT))


def numbered_texts(docs: DataFrame) -> DataFrame:
    """documents -> (id, sub, text): ``sub`` tells the texts of one doc_id (or of none) apart, and is 0
    for a doc_id with one text."""
    rows = document_columns(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), text_or_empty().alias("text"))
    summed = rows.withColumn("sum", F.xxhash64("text"))
    pairs = written(summed.select("id", "sum").distinct(), "repeat_texts")
    several = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    shared = written(pairs.join(several, "id", "left_semi").withColumn("sub", F.monotonically_increasing_id() + 1), "repeat_shared")
    few = shared.count()
    if not few:
        return rows.select("id", F.lit(0).cast("long").alias("sub"), "text")
    told = summed.join(F.broadcast(shared) if few <= BROADCAST_SHARED else shared, ["id", "sum"], "left")
    return told.select("id", F.coalesce("sub", F.lit(0).cast("long")).alias("sub"), "text")


def op3_induced_suffix_sort(spark, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), keep_bytes=False).drop("kept")
