"""Small tables of signatures with all kinds of dirt, and plain answers to check against."""

import random
import struct

SCHEMA = "id long, sequence_id string, segment_name string, kmer_signature binary, distance_to_centroid double, cluster_version string, cid int, n string, lanes string"


def signature(lanes, seed=42, unique=9):
    return bytearray(struct.pack("<4I", len(lanes), seed, 99, unique) + struct.pack(f"<{len(lanes)}Q", *lanes))


def table(groups=6, each=9, n=64, seed=1, copies=12):
    """Rows (id, sequence_id, segment_name, signature, distance, version) with clashing helper names besides."""
    rng = random.Random(seed)
    rows, k = [], 0
    for g in range(groups):
        centre = [rng.getrandbits(64) for _ in range(n)]
        for i in range(each):
            v = list(centre)
            for j in rng.sample(range(n), rng.choice([0, 3, 6, 12, 20, 30])):
                v[j] = rng.getrandbits(64)
            rows.append((k := k + 1, f"g{g}-{i}", "HA" if g % 2 else "NA", signature(v), rng.random(), "provisional"))
    one = [rng.getrandbits(64) for _ in range(n)]
    rows += [(k := k + 1, f"copy{i:02d}", "HA", signature(one), None if i else 0.5, "provisional") for i in range(copies)]
    other = [rng.getrandbits(64) for _ in range(128)]
    rows += [(k := k + 1, f"wide{i}", "HA", signature(other[:-i] + [i] * i if i else other), 0.1, "provisional") for i in range(4)]
    rows += [(k := k + 1, f"seven{i}", "HA", signature(one, 7), float("nan"), "provisional") for i in range(3)]
    good = signature(one)
    dirt = [None, bytearray(), good[:100], good[:8], signature(one, unique=0), good + b"x", bytearray(b"y" * 5000)]
    rows += [(k := k + 1, f"dirt{i}", "HA", d, -1.0, "provisional") for i, d in enumerate(dirt)]
    rows += [(k := k + 1, None, "HA", good, 0.2, "provisional"), (k := k + 1, "noseg", None, good, 0.2, "provisional")]
    rows += rows[:10]
    rng.shuffle(rows)
    return [(*r, 1, "n", "lanes") for r in rows]


def records(rows):
    """{(segment, sequence): ((n, seed), lanes)} of usable ones."""
    out = {}
    for r in rows:
        s = r[3]
        if r[1] is None or r[2] is None or s is None or len(s) < 16:
            continue
        n, seed, _, unique = struct.unpack("<4I", s[:16])
        if unique and len(s) == 16 + 8 * n:
            out[(r[2], r[1])] = ((n, seed), struct.unpack(f"<{n}Q", s[16:]))
    return out


def agreements(rows):
    """{(segment, a, b): agreement} of comparable records, a < b."""
    rec = records(rows)
    return {(x[0], x[1], y[1]): sum(p == q for p, q in zip(rec[x][1], rec[y][1])) / rec[x][0][0] for x in rec for y in rec if x[0] == y[0] and x[1] < y[1] and rec[x][0] == rec[y][0]}
